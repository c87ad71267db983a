"""Point records: parse, validate, assemble, label and serialise.

A point arrives as one JSON text per row (``{"x": .., "y": ..}``).  Parsing
uses ``from_json`` with a fixed schema, so it stays a JVM projection; rows that
do not carry two numbers are routed to a reject table instead of failing the
query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, StructField,
                               StructType)

from .vectors import to_array

# The declared parse schema of one point: two nullable doubles.
POINT_SCHEMA = StructType([
    StructField("x", DoubleType()),
    StructField("y", DoubleType()),
])

# A labelled output record, field order as written: point, center, label.
LABELLED_SCHEMA = StructType([
    StructField("point", POINT_SCHEMA),
    StructField("center", POINT_SCHEMA),
    StructField("label", IntegerType()),
])

# The three-colour colour-blind-safe palette used to draw
# clusters 0, 1 and 2, in label order.
PALETTE = ("#0072B2", "#E69F00", "#F0E442")


def parse_points(df: DataFrame, line_col: str = "value",
                 schema: StructType = POINT_SCHEMA) -> DataFrame:
    """Parse ``line_col`` with a fixed schema and flatten the struct
    next to the existing columns (``select("json.*")``)."""
    parsed = F.from_json(F.col(line_col), schema)
    return df.withColumn("__json", parsed).select(
        *[F.col(c) for c in df.columns], "__json.*")


def _point_ok(fields) -> Column:
    ok = F.lit(True)
    for f in fields:
        ok = ok & F.col(f).isNotNull()
    return ok


def valid_points(df: DataFrame, fields=("x", "y")) -> DataFrame:
    """Rows whose point fields are all present (the typed-view check)."""
    return df.filter(_point_ok(fields))


def rejected_points(df: DataFrame, line_col: str = "value",
                    fields=("x", "y")) -> DataFrame:
    """The complement of :func:`valid_points`, with a ``reason``."""
    all_null = F.lit(True)
    for f in fields:
        all_null = all_null & F.col(f).isNull()
    reason = (F.when(F.col(line_col).isNull(), F.lit("null_line"))
              .when(all_null, F.lit("no_point"))
              .otherwise(F.lit("bad_field")))
    return df.filter(~_point_ok(fields)).withColumn("reason", reason)


def parse_valid_points(df: DataFrame, line_col: str = "value",
                       schema: StructType = POINT_SCHEMA) -> DataFrame:
    """P1+P3 in one step: parse each line once and keep the rows whose fields
    are all present.  The parse sits inside a generator (``inline`` of a
    filtered one-element array), so the optimizer cannot copy ``from_json``
    into a pushed-down filter and parse the text several times."""
    parsed = F.from_json(F.col(line_col), schema)
    keep = F.filter(F.array(parsed), lambda s: _struct_ok(s, schema.names))
    return df.select(*[F.col(c) for c in df.columns], F.inline(keep))


REASON_COL = "reject_reason"


def check_points(df: DataFrame, line_col: str = "value",
                 schema: StructType = POINT_SCHEMA) -> DataFrame:
    """P1+P3 without dropping a line: the point's fields and ``reject_reason``,
    NULL for a valid point, else ``null_line``, ``no_point``, ``bad_field`` or
    ``not_finite`` (a NaN or infinite coordinate).  Each line is parsed once
    (inside a generator, as in :func:`parse_valid_points`)."""
    names = schema.names
    one = F.inline(F.array(F.from_json(F.col(line_col), schema)))
    out = df.select(*[F.col(c) for c in df.columns], one)
    missing = [F.col(n).isNull() for n in names]
    every, some = missing[0], missing[0]
    for m in missing[1:]:
        every, some = every & m, some | m
    odd = F.lit(False)
    for n in names:
        odd = odd | F.isnan(n) | (F.abs(F.col(n)) == float("inf"))
    reason = (F.when(F.col(line_col).isNull(), "null_line").when(every, "no_point")
              .when(some, "bad_field").when(odd, "not_finite"))
    return out.withColumn(REASON_COL, reason)


def _struct_ok(s: Column, names) -> Column:
    ok = F.lit(True)
    for n in names:
        ok = ok & s[n].isNotNull()
    return ok


def split_points(df: DataFrame, line_col: str = "value", fields=("x", "y")):
    """``(valid, rejected)`` from one parsed frame."""
    return valid_points(df, fields), rejected_points(df, line_col, fields)


def assemble_features(df: DataFrame, cols, out: str = "features",
                      as_vector: bool = False) -> DataFrame:
    """P5: numeric columns into one ``ARRAY<DOUBLE>`` (or ML vector) column."""
    arr = F.array(*[F.col(c).cast("double") for c in cols])
    if as_vector:
        from .vectors import to_vector
        arr = to_vector(arr)
    return df.withColumn(out, arr)


def features_to_xy(df: DataFrame, features_col: str = "features",
                   x: str = "x", y: str = "y") -> DataFrame:
    """Elements 0 and 1 of an array or ML vector as two columns."""
    f = F.col(features_col)
    if df.schema[features_col].dataType.typeName() != "array":
        f = to_array(f)
    return df.withColumn(x, f[0]).withColumn(y, f[1])


def label_points(x: str = "x", y: str = "y", cx: str = "cx", cy: str = "cy",
                 label: str = "prediction") -> Column:
    """``struct(point struct(x, y), center struct(x, y), label)``."""
    return F.struct(
        F.struct(F.col(x).alias("x"), F.col(y).alias("y")).alias("point"),
        F.struct(F.col(cx).alias("x"), F.col(cy).alias("y")).alias("center"),
        F.col(label).cast("int").alias("label"),
    )


def points_to_json(col: Column) -> Column:
    """Serialise a struct as one JSON text (field order as declared)."""
    return F.to_json(col)


def parse_labelled(df: DataFrame, json_col: str = "value") -> DataFrame:
    """Read a labelled JSON line back into ``point``, ``center``, ``label``."""
    parsed = F.from_json(F.col(json_col), LABELLED_SCHEMA)
    return df.withColumn("__lab", parsed).select(
        *[F.col(c) for c in df.columns if c != "__lab"], "__lab.*")


def label_color(label: str | Column = "label", palette=PALETTE) -> Column:
    """Colour of a label; NULL for a label outside the palette."""
    lab = F.col(label) if isinstance(label, str) else label
    colors = F.array(*[F.lit(c) for c in palette])
    return F.try_element_at(colors, lab.cast("int") + 1)
