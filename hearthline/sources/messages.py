"""Messages between jobs: maps of strings, checked and decoded into columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import blank_to_null
from ..schemas import RAW_KEYS, RAW_MESSAGE, URL_MESSAGE
from .records import parse_lines

KINDS = ["TEST", "PROPERTY_URL", "PROPERTY_RAW_DATA"]


def kind(fields: Column) -> Column:
    """The routing type; an unknown or missing one is UNKNOWN."""
    named = fields["type"]
    return F.when(named.isin(KINDS), named).otherwise("UNKNOWN")


def _split(df: DataFrame, faulty: Column, stage: str, fields: str) -> tuple[DataFrame, DataFrame]:
    marked = df.withColumn("_faulty", F.coalesce(faulty, F.lit(True)))
    payload = F.to_json(fields)
    bad = marked.where("_faulty").select(F.sha2(payload, 256).alias("record_key"), F.lit(stage).alias("stage"), F.lit("MalformedMessage").alias("error_code"), F.lit("a required field is missing or empty").alias("message"), payload.alias("payload"))
    return marked.where("not _faulty").drop("_faulty"), bad


def url_messages(df: DataFrame, fields: str = "fields") -> tuple[DataFrame, DataFrame]:
    """Four non-empty strings and an optional property_id."""
    empty = F.lit(False)
    for name in URL_MESSAGE:
        empty = empty | F.coalesce(F.trim(F.col(fields)[name]) == "", F.lit(True))
    good, bad = _split(df, empty, "url message", fields)
    return good.select(*[F.col(fields)[c].alias(c) for c in [*URL_MESSAGE, "property_id"]]), bad


def raw_messages(df: DataFrame, fields: str = "fields") -> tuple[DataFrame, DataFrame]:
    """Six present fields (they may be empty); the payload is then read as a raw record. An empty property id is none."""
    absent = F.lit(False)
    for name in RAW_MESSAGE:
        absent = absent | F.col(fields)[name].isNull()
    good, bad = _split(df, absent, "raw message", fields)
    other = [c for c in df.columns if c != fields]
    lines = good.select(*other, F.col(fields)["data"].alias("value"), F.col(fields)["propertyId"].alias("message_property_id"))
    records, broken = parse_lines(lines)
    records = records.withColumn("property_id", F.coalesce(blank_to_null(F.col("message_property_id")), blank_to_null(F.col("property_id")))).drop("message_property_id")
    return records, bad.unionByName(broken)


def to_url_messages(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with the message's columns to (messages, rejects); a message without a property id leaves that field out."""
    good, bad = _split(df.withColumn("fields", F.create_map(*[x for c in [*URL_MESSAGE, "property_id"] for x in (F.lit(c), F.col(c).cast("string"))])).select("fields"), F.exists(F.array(*[F.coalesce(F.trim(F.col("fields")[c]), F.lit("")) for c in URL_MESSAGE]), lambda x: x == ""), "publish", "fields")
    return good.select(F.map_filter("fields", lambda _, v: v.isNotNull()).alias("fields")), bad


def to_raw_messages(records: DataFrame) -> DataFrame:
    """The whole record as JSON with routing columns; a missing url, time or spider only warns."""
    route = {"url": "url", "redfinId": "data_source_id", "zipCode": "zip_code", "scrapedAt": "scraped_at", "spiderName": "spider_name", "propertyId": "property_id"}
    value = lambda c: F.col(c).cast("string") if c in records.columns else F.lit(None).cast("string")
    warnings = F.filter(F.array(*[F.when(F.coalesce(value(route[m]), F.lit("")) == "", F.lit(m)) for m in ("url", "scrapedAt", "spiderName")]), lambda x: x.isNotNull())
    back = {v: k for k, v in RAW_KEYS.items()}
    item = F.to_json(F.struct(*[F.col(c).alias(back.get(c, c)) for c in records.columns if c not in ("payload", "record_key")]))
    return records.select(F.lit("PROPERTY_RAW_DATA").alias("type"), *[F.coalesce(value(c), F.lit("")).alias(m) for m, c in route.items()], item.alias("data"), warnings.alias("warnings"))


def publishable(df: DataFrame, fields: str = "fields") -> DataFrame:
    """Messages with at least one field and no null value; a column that is no map of plain values raises TypeError."""
    kind_ = df.schema[fields].dataType
    if not isinstance(kind_, T.MapType) or not isinstance(kind_.keyType, T.StringType) or isinstance(kind_.valueType, (T.StructType, T.ArrayType, T.MapType)):
        raise TypeError(f"{fields} is no map of strings to plain values: {kind_.simpleString()}")
    return df.where((F.size(fields) > 0) & F.forall(F.map_values(fields), lambda v: v.isNotNull()))


def publish(rows: DataFrame, path: str, stream: str, a_file: int = 1000) -> DataFrame:
    """Append URL messages to the folder of a stream as the entries that ``message_stream`` reads, at most
    ``a_file`` in a file; returns the rejects. An entry's id is the hash of its stream and fields, so that
    one which is sent again keeps its id."""
    good, bad = to_url_messages(rows)
    sent = publishable(good.select(F.map_concat(F.create_map(F.lit("type"), F.lit("PROPERTY_URL")), "fields").alias("fields")))
    text = F.to_json(F.array_sort(F.map_entries("fields")))
    entries = sent.select(F.lit(stream).alias("stream"), F.sha2(F.concat_ws(" ", F.lit(stream), text), 256).alias("id"), "fields")
    entries.write.mode("append").option("maxRecordsPerFile", a_file).json(path)
    return bad
