"""Registered queries of the operators in this package, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .cube_mix import mix
from .decontam import contaminated
from .filter_audit import any_of, audit, capitals, fewer_words, repeated_words, words_of
from .html_extract import main_text
from .jaccard_join import jaccard_components
from .language_id import languages
from .license_scan import CUES, TEMPLATES, VOCABULARY, scan_licenses
from .lm_score import lm_scores
from .packing import pack
from .periodic_runs import periodic_runs
from .pivot_dedup import near_vectors
from .suffix_dedup import remove_repeats
from .tokens import tokenizer_path
from .warc import read_warc, write_pages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _words_sql(source: str) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (f"list_filter(regexp_split_to_array(translate(coalesce({source}, ''), '{upper}', '{upper.lower()}'),"
            " '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')")


def _shingles_sql(key: str, relation: str, k: int) -> str:
    """One row per distinct k-word shingle of each row of a table."""
    return f"""SELECT {key}, unnest(CASE WHEN len(w) >= {k} THEN list_distinct(list_transform(range(1, len(w) - {k - 2}),
        lambda i: array_to_string(w[i:i + {k - 1}], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS sh
      FROM (SELECT {key}, {_words_sql('text')} AS w FROM {relation})"""


@query("op1_decontam", f"""
WITH d AS ({_shingles_sql('doc_id', 'documents', 5)}), b AS ({_shingles_sql('item_id', 'benchmark', 5)}),
n AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id),
c AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN b USING (sh) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
FROM c JOIN n USING (item_id) WHERE 10 * n_shared >= 8 * n_item""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=5, threshold=0.8)


@query("op2_jaccard_join", f"""
WITH RECURSIVE s AS ({_shingles_sql('doc_id', 'documents', 4)}),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT doc_id AS v, doc_id AS u FROM documents UNION SELECT r.v, e.b FROM r JOIN e ON e.a = r.u)
SELECT v AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(u) AS component_id
FROM r LEFT JOIN n ON n.doc_id = v GROUP BY v""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near copies among all documents."""
    return jaccard_components(table(spark, sf_dir, "documents"), k=4, percent=85)


@query("op3_pivot_dedup", """
WITH RECURSIVE x AS (SELECT vec_id, label, list_transform(embedding, lambda v: v::DOUBLE) AS v FROM embeddings),
ok AS (SELECT * FROM x WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda y: y IS NULL OR NOT isfinite(y))) = 0
       AND list_max(list_transform(v, lambda y: abs(y))) > 0),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
r AS (SELECT vec_id AS v, vec_id AS u FROM embeddings UNION SELECT r.v, e.b FROM r JOIN e ON e.a = r.u),
n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT v AS vec_id, coalesce(any_value(n.n), 0) AS n_links, min(u) AS component_id, v = min(u) AS kept
FROM r LEFT JOIN n ON n.a = r.v GROUP BY v""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-copies among all embeddings of equal label."""
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


@query("op4_suffix_dedup", """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, h, unnest(range(0, len(h) // 2)) AS i FROM d),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 2) AS byte, CASE WHEN 2 * i + 200 <= len(h) THEN substr(h, 2 * i + 1, 200) END AS s FROM b),
f AS (SELECT doc_id, i, byte, s IS NOT NULL AND row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1 AS again FROM w),
c AS (SELECT doc_id, i, byte, coalesce(max(CASE WHEN again THEN i END) OVER (PARTITION BY doc_id ORDER BY i) > i - 100, false) AS gone FROM f),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM c),
g AS (SELECT doc_id, sum(gone::INT)::BIGINT AS n_removed, sum(opens::INT)::BIGINT AS n_spans,
      coalesce(string_agg(byte, '' ORDER BY i) FILTER (NOT gone), '') AS kept FROM e GROUP BY doc_id)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 100-byte strings removed from every whole document."""
    out = remove_repeats(table(spark, sf_dir, "documents"), "doc_id", "text", length=100)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole document, learned from three quarters of the ids."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return languages(docs, ~held).withColumn("held_out", held).select("doc_id", "held_out", "lang_pred", "score")


_PATH = "source || '/' || (doc_id // 5000) || '/' || (doc_id // 500) || '/' || CASE WHEN doc_id % 25 = 0 THEN 'LICENSE' ELSE 'f' || doc_id || '.txt' END"
_TOKENS = "list_filter(regexp_split_to_array(lower({}), '[^a-z0-9]+'), lambda x: x <> '')"


@query("op6_license_scan", f"""
WITH files AS (SELECT doc_id AS id, {_PATH} AS path, text FROM documents),
temps AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{lic}', '{s}')" for i, (lic, s) in enumerate(TEMPLATES))}) v(template, license, s)),
vocab AS (SELECT unnest({VOCABULARY}) AS t),
tot AS (SELECT count(*) AS n FROM files),
held AS (SELECT t, count(*) AS df FROM (SELECT unnest(list_distinct({_TOKENS.format('text')})) AS t FROM files) JOIN vocab USING (t) GROUP BY t),
idf AS (SELECT t, ln((1.0 + n) / (1 + df)) + 1 AS idf FROM held, tot),
tt AS (SELECT template, license, t, count(*) * coalesce(any_value(idf), any_value(ln(1.0 + n) + 1)) AS w
       FROM (SELECT template, license, unnest({_TOKENS.format('s')}) AS t FROM temps) CROSS JOIN tot LEFT JOIN idf USING (t) GROUP BY template, license, t),
tn AS (SELECT template, sqrt(sum(w * w)) AS norm FROM tt GROUP BY template),
parts AS (SELECT id, 0 AS unit, text AS part FROM files WHERE regexp_matches(lower(text), '{CUES}')
  UNION ALL SELECT id, i, line FROM (SELECT id, text, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i
  FROM files WHERE regexp_matches(lower(text), '{CUES}')) WHERE regexp_matches(lower(line), '{CUES}')),
uw AS (SELECT id, unit, t, count(*) * coalesce(any_value(idf), any_value(ln(1.0 + n) + 1)) AS w
       FROM (SELECT id, unit, unnest({_TOKENS.format('part')}) AS t FROM parts) CROSS JOIN tot LEFT JOIN idf USING (t) GROUP BY id, unit, t),
un AS (SELECT id, unit, sqrt(sum(w * w)) AS norm FROM uw GROUP BY id, unit),
sc AS (SELECT id, unit = 0 AS whole, license, round(sum(uw.w * tt.w / tn.norm) / any_value(un.norm), 6) AS score
       FROM uw JOIN tt USING (t) JOIN tn USING (template) JOIN un USING (id, unit) GROUP BY id, unit, template, license),
own AS (SELECT id, license, score, CASE WHEN whole THEN 'file' ELSE 'header' END AS how FROM sc WHERE score >= 0.9
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY whole DESC, score DESC, license) = 1),
named AS (SELECT id, path, regexp_replace(path, '/[^/]*$', '') AS dir, license, score, how FROM files LEFT JOIN own USING (id)),
holders AS (SELECT dir, path, license FROM named WHERE license IS NOT NULL AND (how = 'file' OR path LIKE '%/LICENSE')
            QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, path, license) = 1),
near AS (SELECT d.dir, h.license, h.path FROM (SELECT DISTINCT dir FROM named) d JOIN holders h ON d.dir = h.dir OR starts_with(d.dir, h.dir || '/')
         QUALIFY row_number() OVER (PARTITION BY d.dir ORDER BY len(h.dir) DESC) = 1)
SELECT id AS doc_id, n.path, coalesce(n.license, near.license) AS license,
  CASE WHEN n.license IS NOT NULL THEN how WHEN near.license IS NOT NULL THEN 'inherited' ELSE 'none' END AS how,
  coalesce(score, 0.0) AS score, CASE WHEN n.license IS NULL THEN near.path END AS origin
FROM named n LEFT JOIN near USING (dir)""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents.  They have no paths, so the query lays them
    out by source and id; every 25th id is its directory's LICENSE."""
    docs = table(spark, sf_dir, "documents")
    name = F.when(F.col("doc_id") % 25 == 0, F.lit("LICENSE")).otherwise(F.concat(F.lit("f"), "doc_id", F.lit(".txt")))
    part = lambda n: F.floor(F.col("doc_id") / n).cast("string")
    files = docs.withColumn("path", F.concat_ws("/", "source", part(5000), part(500), name))
    return scan_licenses(files, "doc_id", "path", "text", threshold=0.9).withColumnRenamed("id", "doc_id")


@query("op7_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), capacity=2048, end_id=1)


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


@query("op8_warc", f"""
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS hx, strlen(coalesce(html, ''))::BIGINT AS n FROM pages),
l AS (SELECT hx, max(page_id) AS last FROM p GROUP BY hx)
SELECT page_id, n AS payload_bytes, array_to_string(list_transform(range(0, 8), lambda g: array_to_string(list_transform([15, 10, 5, 0],
    lambda s: substr('{_BASE32}', ((('0x' || substr(hx, 5 * g + 1, 5))::BIGINT >> s) & 31)::INT + 1, 1)), '')), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to
FROM p JOIN l USING (hx)""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back."""
    path = write_pages(table(spark, sf_dir, "pages"), min_bytes=0)
    number = lambda c: F.nullif(F.substring_index(c, ":", -1), F.lit("")).cast("long")
    return read_warc(spark, path, payload="false", verify="true").select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))


# crc32 of the id's digits, bit by bit (the reflected polynomial), as DuckDB has no crc32
_CRC = ("list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({x}, ''), lambda c: ascii(c)::BIGINT)), lambda a, c: "
        "list_reduce(list_prepend(xor(a, c), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda r, z: "
        "CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384::BIGINT) ELSE r // 2 END))")


@query("op9_lm_score", f"""
WITH d AS (SELECT doc_id, xor({_CRC.format(x="doc_id::VARCHAR")}, 4294967295::BIGINT) % 10 = 0 AS held_out, {_words_sql('text')} AS w FROM documents),
t AS (SELECT doc_id, held_out, unnest(list_append(w, '')) AS tok, unnest(range(1, len(w) + 2)) AS i FROM d),
u AS (SELECT tok, count(*) AS c FROM t WHERE NOT held_out GROUP BY tok),
s AS (SELECT coalesce(sum(c), 0)::BIGINT AS n, count(*) AS v FROM u),
g AS (SELECT doc_id, held_out, i, tok, lag(tok) OVER (PARTITION BY doc_id ORDER BY i) AS h FROM t),
b AS (SELECT h, tok, count(*) AS c FROM g WHERE NOT held_out AND h IS NOT NULL GROUP BY h, tok),
p AS (SELECT g.doc_id, g.held_out, g.h, n, u.c IS NOT NULL AS known, (coalesce(u.c, 0) + 0.1) / (n + 0.1 * (v + 1)) AS p1,
      coalesce(b.c, 0) AS c2, coalesce(uh.c, 0) AS ch
      FROM g CROSS JOIN s LEFT JOIN u ON u.tok = g.tok LEFT JOIN u uh ON uh.tok = g.h LEFT JOIN b ON b.h = g.h AND b.tok = g.tok)
SELECT doc_id, held_out, count(*) AS n_tokens, sum(known::INT)::BIGINT AS n_known, any_value(n) AS train_tokens,
  sum(log10(p1)) AS base_score, sum(log10(CASE WHEN h IS NULL THEN p1 ELSE (c2 + 256.0 * p1) / (ch + 256.0) END)) AS score
FROM p GROUP BY doc_id, held_out""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document under a model of nine tenths of them."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(True))
    out = lm_scores(docs, ~held, order=2, prior=256.0)
    return out.withColumn("held_out", held).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op10_html_extract")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query("op11_filter_audit", """
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
lab AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
        + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t))::INT
        + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS m
      FROM d LEFT JOIN lab USING (doc_id)),
c AS (SELECT part, m, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, m),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS k, unnest([1, 2, 4, 8, 16]) AS v),
o AS (SELECT a.k || b.k || c.k || d.k || e.k AS filter_order, [a.v, b.v, c.v, d.v, e.v] AS vs FROM x a, x b, x c, x d, x e
      WHERE a.v + b.v + c.v + d.v + e.v = 31 AND len(list_distinct([a.v, b.v, c.v, d.v, e.v])) = 5),
s AS (SELECT filter_order, i AS step, vs[i] AS bit, coalesce(list_sum(vs[1:i - 1]), 0)::INT AS before
      FROM (SELECT filter_order, vs, unnest(range(1, 6)) AS i FROM o)),
r AS (SELECT part, filter_order, step, bit, sum(CASE WHEN m & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN m & before = 0 AND m & bit > 0 THEN n ELSE 0 END) AS removed, sum(CASE WHEN m & before > 0 AND m & bit > 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN m = bit THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN m & before = 0 AND m & bit > 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN m & before = 0 AND m & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step::INT AS step, substr(filter_order, step::INT, 1) AS filter, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over all documents in all their orders, per source."""
    filters = {"A": fewer_words(50), "B": repeated_words(65), "C": capitals(5), "D": any_of("#$%&*|")}
    return audit(table(spark, sf_dir, "documents"), filters, "E", table(spark, sf_dir, "labels"),
                 {"good_lost": "quality = 1", "toxic_lost": "toxic = 1"})


@query("op12_source_mix")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by source to weights 5, 2, 1, repeating."""
    return mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.0, most=3).select("doc_id", "size", "source_size", "target", "taken")


@query("op13_periodic_runs", f"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
  xor({_CRC.format(x="doc_id::VARCHAR")}, 4294967295::BIGINT) AS h FROM documents),
e AS (SELECT doc_id, w, h, (h // 10) % len(w) AS a, 1 + (len(w) - (h // 10) % len(w)) // (3 + (h // 10) % 8) AS p FROM d WHERE len(w) > 0),
t AS (SELECT doc_id, CASE WHEN h % 10 = 0 THEN list_transform(range(0, len(w)), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w FROM e),
g AS (SELECT doc_id, i, array_to_string(w[i + 1:i + 6], ' ') AS x FROM (SELECT doc_id, w, unnest(range(0, len(w) - 5)) AS i FROM t)),
b AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS grp
      FROM (SELECT a.doc_id, a.i, z.i - a.i AS q FROM g a JOIN g z ON a.doc_id = z.doc_id AND a.x = z.x AND z.i > a.i)),
s AS (SELECT doc_id, q, min(i) AS s, max(i) + 6 + q - min(i) AS n FROM b GROUP BY doc_id, q, grp),
r AS (SELECT doc_id, s, n, min(q) AS q FROM s WHERE n >= greatest(12, 2 * q) GROUP BY doc_id, s, n),
o AS (SELECT doc_id, count(*) AS n_runs, min(struct_pack(n := -n, s := s, q := q)) AS f, string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS txt FROM r GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + n)) AS i FROM r),
k AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS txt FROM (SELECT doc_id, unnest(w) AS x, unnest(range(0, len(w))) AS i FROM t) ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, f.s AS start, -f.n AS length, f.q AS period, (1000 * -f.n) // f.q AS exponent_milli,
  sha256(coalesce(o.txt, '')) AS runs_sha256, sha256(coalesce(k.txt, '')) AS collapsed_sha256
FROM d LEFT JOIN o USING (doc_id) LEFT JOIN k USING (doc_id)""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words in all documents, of which a tenth is made periodic: by the
    id's crc32, words from a on repeat the p words that begin there."""
    words, n = words_of(F.col("text")), F.size(words_of(F.col("text")))
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("long")
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    again = F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))
    periodic = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(F.flatten(again), F.lit(1), n - a)), " ")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when((h % 10 == 0) & (n > 0), periodic).otherwise(F.col("text")).alias("text"))
    out = periodic_runs(docs, least=12)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("q"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])), "\n")
    return out.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), (-longest["s"]).alias("start"), longest["length"].alias("length"),
        (-longest["q"]).alias("period"), F.floor(1000 * longest["length"] / -longest["q"]).alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
