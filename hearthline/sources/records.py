"""Raw listing records: JSON lines to source-neutral rows, and file ranges.

Blank lines are dropped (they do not end a file). Lines that are not JSON objects become rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_EVENT, RAW_KEYS, RAW_RECORD, SOURCE_NAME

_TYPES = {name: kind for name, kind in (field.split(" ", 1) for field in RAW_RECORD.split(", ") if " " in field) if name in RAW_KEYS.values()} | {"history": f"array<{RAW_EVENT}>"}
_JSON_SCHEMA = ", ".join(f"`{k}` {_TYPES[v]}" for k, v in RAW_KEYS.items()) + ", _bad string"


def parse_lines(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(rows of the raw-record schema with record_key and payload, rejects)."""
    text = lines.where(F.trim(column) != "").select(*[c for c in lines.columns if c != column], F.col(column).alias("payload"))
    parsed = text.withColumn("r", F.from_json("payload", _JSON_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    broken = F.col("r._bad").isNotNull() | F.col("r").isNull()
    key = F.sha2("payload", 256)
    good = parsed.where(~broken).select(*[c for c in text.columns if c != "payload"], key.alias("record_key"), "payload", *[_field(k, v) for k, v in RAW_KEYS.items()], F.lit(SOURCE_NAME).alias("data_source_name"))
    bad = parsed.where(broken).select(key.alias("record_key"), F.lit("read").alias("stage"), F.lit("InvalidPropertyDataFormat").alias("error_code"), F.lit("not a JSON record").alias("message"), "payload")
    return good, bad


def _field(json_name: str, name: str) -> Column:
    value = F.col(f"r.{json_name}")
    if name == "status":  # the default is for a missing key; an explicit null stays null
        value = F.when(F.array_contains(F.json_object_keys("payload"), "status"), value).otherwise("Unknown")
    if name == "history":
        value = F.coalesce(value, F.from_json(F.lit("[]"), f"array<{RAW_EVENT}>"))
    return value.alias(name)


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.text(list(paths)).select("value", F.col("_metadata.file_name").alias("file_name"))


def file_range(lines: DataFrame, start: str, end: str) -> DataFrame:
    """Rows of the files from ``start`` to ``end`` by name, both included; none if either is missing or they are reversed."""
    ends = lines.where(F.col("file_name").isin(start, end)).select("file_name").distinct()
    both = ends.agg(F.count("*").alias("n")).where(F.col("n") == (1 if start == end else 2)).select(F.lit(True).alias("both"))
    return lines.where(F.col("file_name").between(start, end)).join(both, how="cross").drop("both")  # one row at most on the right
