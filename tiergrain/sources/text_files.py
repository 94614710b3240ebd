"""Delimited and JSON files with a declared schema; lines that break it go to quarantine.

Every line is parsed against the schema (permissive mode keeps the raw line of a
malformed one). ``read_delimited`` and ``read_json`` return the raw line in
``CORRUPT`` where something is wrong; ``clean`` and ``broken`` split the frame without
losing a line, the latter with a reason: ``surplus_field``, ``missing_field``, ``bad_value`` or
``not_json``. Spark splits files into tasks by lines, so a file's size does not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_line"


def _schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, delimiter: str = ",") -> DataFrame:
    """Lines of delimited files. A record is one line (no line breaks in quotes), judged whole whichever columns are used."""
    parsed = F.from_csv("value", _schema(schema).toDDL(), {"sep": delimiter, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return spark.read.text(path).select(parsed.alias("p")).select("p.*")


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Lines of JSON objects; a field the schema does not have makes a line ``surplus_field``."""
    lines = spark.read.text(path)
    names = F.json_object_keys("value")
    parsed = F.from_json("value", _schema(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    known = F.array(*[F.lit(f) for f in schema.fieldNames()])
    surplus = F.size(F.array_except(F.coalesce(names, F.array().cast("array<string>")), known)) > 0
    rows = lines.select("value", parsed.alias("p"), surplus.alias("s"))
    return rows.select(*[F.col(f"p.{f}") for f in schema.fieldNames()],
                       F.when(F.col("s") | F.col("p").isNull(), F.col("value")).otherwise(F.col(f"p.{CORRUPT}")).alias(CORRUPT))


def clean(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def _delimited_reason(schema: T.StructType, delimiter: str) -> Column:
    n = F.size(F.split(F.col(CORRUPT), f"\\Q{delimiter}\\E", -1))
    return F.when(n > len(schema), "surplus_field").when(n < len(schema), "missing_field").otherwise("bad_value")


def broken(rows: DataFrame, schema: T.StructType, delimiter: str | None = None) -> DataFrame:
    """``line`` and ``reason``; ``delimiter`` is None for JSON."""
    if delimiter is not None:
        reason = _delimited_reason(schema, delimiter)
    else:
        names = F.json_object_keys(CORRUPT)
        known = F.array(*[F.lit(f) for f in schema.fieldNames()])
        reason = F.when(names.isNull(), "not_json").when(F.size(F.array_except(names, known)) > 0, "surplus_field") \
            .otherwise("bad_value")
    return rows.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line"), reason.alias("reason"))
