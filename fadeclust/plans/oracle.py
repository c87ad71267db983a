"""DuckDB SQL text for the oracle side of the query set.

These strings are the independent reference each Spark query is checked
against: the same semantics written as plain SQL over the driver tables.  The
multi-batch fold is one recursive CTE whose step assigns the next batch's
points to the previous centers (LATERAL), aggregates them and applies the
update, so the SQL works for any number of batches.
"""

from __future__ import annotations


def r6(x: str) -> str:
    """Round to 6 places and fold -0.0 into 0.0 (as ``plans.queries.r6``)."""
    return f"(round({x}, 6) + 0.0)"


# ---- point inputs ---------------------------------------------------------

EMB_POINTS = ("SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS f "
              "FROM embeddings")

LINEITEM_POINTS = ("SELECT l_orderkey, l_linenumber, "
                   "[l_quantity, l_extendedprice, l_discount, l_tax]::DOUBLE[] AS f "
                   "FROM lineitem")

# valid points of the event stream: sign-up and error events are rejected
EVENT_POINTS = ("SELECT event_id AS id, ts, CAST(ts AS DATE) AS day, value AS x, "
                "CAST(props->>'$.k' AS DOUBLE) AS y, "
                "[value, CAST(props->>'$.k' AS DOUBLE)]::DOUBLE[] AS f "
                "FROM events WHERE event_type NOT IN ('signup', 'error')")


def sqdist(a: str, b: str) -> str:
    return (f"list_sum(list_transform(list_zip({a}, {b}), "
            f"lambda z: (z[1] - z[2]) * (z[1] - z[2])))")


def dists_to(cs: str, f: str = "f") -> str:
    """List of squared distances from ``f`` to each center of ``cs``."""
    return f"list_transform({cs}, lambda c: {sqdist(f, 'c')})"


def vec_sum_agg(col: str = "f") -> str:
    return (f"list_reduce(list({col}), lambda a, x: "
            f"list_transform(list_zip(a, x), lambda z: z[1] + z[2]))")


def lit_weights(k: int, w0: float) -> str:
    return "[" + ", ".join(repr(float(w0)) for _ in range(k)) + "]::DOUBLE[]"


def fold_ctes(k: int, w0: float, decay: float, time_unit: str = "batches",
              split: bool = False, init_order: str = "id") -> str:
    """CTE text defining ``st(b, cs, ws)``: the model after batch ``b``
    (``b = -1`` initial).  Needs a CTE ``pts(id, b, f)`` with dense batch
    indexes ``b = 0..B-1``; the initial centers are the first ``k`` points in
    ``init_order`` (default: the smallest ids)."""
    if time_unit == "points":
        disc = f"pow({float(decay)!r}, (SELECT count(*) FROM lab))"
    else:
        disc = repr(float(decay))
    lam = "(agg.m / greatest(st.ws[c.i] * disc.a + agg.m, 1e-16))"
    upd_select = "SELECT cs, ws FROM upd"
    if split:
        upd_select = """SELECT CASE WHEN ws[sm] < 1e-8 * ws[lg] THEN list_transform(cs, lambda c, i:
                 CASE WHEN i = lg THEN list_transform(cs[lg], lambda x: x + 1e-14 * greatest(abs(x), 1.0))
                      WHEN i = sm THEN list_transform(cs[lg], lambda x: x - 1e-14 * greatest(abs(x), 1.0))
                      ELSE c END) ELSE cs END AS cs,
               CASE WHEN ws[sm] < 1e-8 * ws[lg] THEN list_transform(ws, lambda w, i:
                 CASE WHEN i = lg OR i = sm THEN (ws[lg] + ws[sm]) / 2.0 ELSE w END) ELSE ws END AS ws
        FROM (SELECT cs, ws, list_position(ws, list_max(ws)) AS lg,
                     list_position(ws, list_min(ws)) AS sm FROM upd) spl"""
    return f"""
st(b, cs, ws) AS (
  SELECT -1,
         (SELECT list(f ORDER BY __o) FROM (SELECT f, row_number() OVER (ORDER BY {init_order}) AS __o
                                           FROM pts ORDER BY {init_order} LIMIT {int(k)})),
         {lit_weights(k, w0)}
  UNION ALL
  SELECT st.b + 1, u.cs, u.ws
  FROM st, LATERAL (
    WITH lab AS (
      SELECT p.f, list_position(p.d, list_min(p.d)) AS lbl
      FROM (SELECT f, {dists_to('st.cs')} AS d FROM pts WHERE pts.b = st.b + 1) p
    ), agg AS (
      SELECT lbl, count(*) AS m, {vec_sum_agg()} AS s FROM lab GROUP BY lbl
    ), disc AS (SELECT {disc} AS a),
    upd AS (
      SELECT list(CASE WHEN agg.m IS NULL THEN c.c
                       ELSE list_transform(list_zip(c.c, agg.s),
                            lambda z: (1 - {lam}) * z[1] + ({lam} / agg.m) * z[2]) END
                  ORDER BY c.i) AS cs,
             list(st.ws[c.i] * disc.a + coalesce(agg.m, 0) ORDER BY c.i) AS ws
      FROM (SELECT unnest(st.cs) AS c, generate_subscripts(st.cs, 1) AS i) c
      LEFT JOIN agg ON agg.lbl = c.i, disc
    )
    {upd_select}
  ) u
  WHERE st.b < (SELECT max(b) FROM pts)
)"""


def history_long_select(where: str = "st.b >= 0") -> str:
    """``(batch_id, label, dim, center, weight)`` rows of ``st``."""
    return f"""SELECT CAST(st.b AS BIGINT) AS batch_id, CAST(c.i - 1 AS INTEGER) AS label,
       CAST(e.j - 1 AS INTEGER) AS dim, {r6('e.v')} AS center, {r6('st.ws[c.i]')} AS weight
FROM st,
     LATERAL (SELECT unnest(st.cs) AS cc, generate_subscripts(st.cs, 1) AS i) c,
     LATERAL (SELECT unnest(c.cc) AS v, generate_subscripts(c.cc, 1) AS j) e
WHERE {where}"""
