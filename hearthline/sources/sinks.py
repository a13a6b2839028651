"""Sinks: JSON lines, the raw archive by source and day, and backfills."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.values import blank_to_null, utc_time
from ..operators import fold, metrics, records
from ..schemas import PROPERTIES, PROPERTY_EVENTS, SOURCE_NAME
from ..streaming.scratch import discard, stash
from . import tables
from .records import file_range, parse_lines, read_lines

SCHEMAS = {"properties": PROPERTIES, "property_events": PROPERTY_EVENTS}


def archive_plan(records_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records with data_source and scrape_date, the UTC day; rejects without an id or a time)."""
    day = F.date_format(utc_time(F.col("scraped_at")), "yyyyMMdd")
    df = records_.withColumns({"data_source": F.lit(SOURCE_NAME), "scrape_date": day})
    fine = F.col("data_source_id").isNotNull() & F.col("scrape_date").isNotNull()
    return df.where(fine), records.rejects(df.where(~fine), "archive", F.lit("MissingRequiredField"))


def archive(records_: DataFrame, path: str) -> DataFrame:
    """Append to the archive, 500 records a file, never over what is there; returns the rejects."""
    good, bad = archive_plan(records_)
    good.write.partitionBy("data_source", "scrape_date").option("maxRecordsPerFile", 500).mode("append").json(path)
    return bad


def json_lines(df: DataFrame, path: str) -> None:
    df.write.json(path)


def _range(spark: SparkSession, files: str, start: str, end: str, most: int | None) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of a range of files; with ``most`` only the first records by file and content."""
    raw, unread = parse_lines(file_range(read_lines(spark, files), start, end))
    first = raw if most is None else raw.orderBy("file_name", "record_key").limit(most)
    return first.drop("file_name"), unread


def backfill_archive(spark: SparkSession, files: str, start: str, end: str, path: str, most: int | None = None) -> DataFrame:
    good, bad = _range(spark, files, start, end, most)
    return bad.unionByName(archive(good, path))


def backfill_store(spark: SparkSession, files: str, start: str, end: str, root: str, most: int | None = None) -> DataFrame:
    """A range of files into the store, as one batch; returns the rejects."""
    raw, unread = _range(spark, files, start, end, most)
    return unread.unionByName(store(spark, raw, root))


def unstored(raw: DataFrame, stored: DataFrame) -> DataFrame:
    """The records whose property id is none of ``stored``. Those without an id match nothing; a key of their own keeps
    them from meeting in one task."""
    key = F.coalesce("property_id", F.concat(F.lit("none "), "record_key"))
    return raw.join(stored.select(F.col("property_id").alias("_stored")).hint("merge"), (key == F.col("_stored")) & F.col("property_id").isNotNull(), "left_anti")


def store(spark: SparkSession, raw: DataFrame, root: str, done: dict[str, int] | None = None, before_commit=None, counted: metrics.Counters | None = None) -> DataFrame:
    """Raw records into the store, as if one by one, oldest first; returns the rejects.

    A record whose property id is stored is a re-scan: it changes status, history and, on a sale, the
    price. Others are upserted by address. What a batch changes and adds is written as new parts of both
    tables, and one commit makes them count together with ``done``, the batches of streams that are in it;
    a run that is repeated after a crash starts from the state before. Records are parsed once.
    ``before_commit`` is given the rejects when all is written and nothing counts yet; ``counted`` takes
    the counters of what is read and written, without another pass."""
    counted = counted or metrics.Counters()
    at = tables.snapshot(spark, root)
    properties = tables.contents(spark, root, "properties", PROPERTIES, at).drop("bucket")
    events = tables.contents(spark, root, "property_events", PROPERTY_EVENTS, at).drop("bucket")
    raw = raw.withColumn("property_id", blank_to_null(F.col("property_id")))
    stored = properties.select("property_id")
    kept: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(stash(df))
        return kept[-1]

    parsed, bad = records.split(keep(counted.observe(records.judged(unstored(raw, stored)), "listing", records.ERRORS)))
    scanned, unread = records.split_scans(keep(counted.observe(records.judged_scans(raw.join(stored.hint("merge"), "property_id", "left_semi")), "rescan", records.ERRORS)))
    changed, new, odd = fold.apply(properties, events, parsed, scanned, keep)
    rejected = stash(bad.unionByName(unread).unionByName(odd))
    if before_commit:
        before_commit(rejected)
    now = tables.append(spark, root, at, {"properties": changed, "property_events": new}, done)
    for name in SCHEMAS:
        counted.add("written", name, sum(p["rows"] for p in now.parts[name]) - sum(p["rows"] for p in at.parts.get(name, [])))
    discard(*kept)
    tables.compact(spark, root, SCHEMAS)
    return rejected
