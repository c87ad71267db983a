"""Pipeline stages: (spark, docs, sf_dir) -> DataFrame.

Each works on all documents that it is given; all but the last return the columns
``doc_id, text, lang, source, n_chars`` of the documents that stay.  Decisions
are by id: rows that repeat an id share them, and a row without an id stays, as
no decision can name it.  Empty input gives empty output.  Texts go through
scans and tasks in small batches (``lean_batches``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontam import contaminated
from .jaccard_join import jaccard_components
from .language_id import languages
from .packing import pack
from .suffix_dedup import remove_repeats
from .tokens import tokenizer_path
from .work import lean_batches, without_ids, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; those without text or without a letter go (these
    alone, also where no labelled row teaches a language)."""
    lean_batches(spark)
    train = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 != 2, F.lit(False))
    bad = languages(docs, train).where("lang_pred = 'und' and doc_id is not null").select("doc_id").distinct()
    return without_ids(docs.select(COLUMNS), written(bad, "rejected"), "doc_id").select(COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, Jaccard 0.8 or more) the least id."""
    lean_batches(spark)
    groups = jaccard_components(docs, k=5, percent=80)
    copies = groups.where("component_id != doc_id").select("doc_id").distinct()
    return without_ids(docs.select(COLUMNS), written(copies, "copies"), "doc_id").select(COLUMNS)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 100-byte strings that occur earlier; a document of
    which nothing but white space is left is repeated in full and goes."""
    lean_batches(spark)
    out = remove_repeats(docs.select(COLUMNS), rows=True)
    return out.where("n_removed = 0 or kept_text rlike '[^\\\\s]'").select(
        "row.doc_id", F.when((F.col("n_bytes") > 0), F.col("kept_text")).alias("text"), "row.lang", "row.source",
        F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("row.n_chars")).alias("n_chars"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (0.8 of its five-word shingles)."""
    lean_batches(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = contaminated(docs, items, k=5, threshold=0.8).where("doc_id is not null").select("doc_id").distinct()
    return without_ids(docs.select(COLUMNS), written(leaks, "leaks"), "doc_id").select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 ids: one row per piece."""
    lean_batches(spark)
    return pack(docs, tokenizer_path("word_bpe_49k.json"), capacity=2048, end_id=1)
