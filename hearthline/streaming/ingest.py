"""Continuous jobs: message streams into the store, URLs to page records, new events into a table.

A stream runs the batch functions on each micro-batch. Checkpoints replace acknowledgements: a
failed batch runs again as a whole, and deterministic ids make that harmless. Bad rows go to the
rejects sink instead of being lost. ``available_now`` stops when idle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.classify import STATUS_TEXTS
from ..functions.pages import raw_records
from ..operators import history, metrics
from ..schemas import PROPERTY_EVENTS, URL_MESSAGE
from ..sources import messages, sinks, tables
from . import letters, scratch


def message_stream(spark: SparkSession, path: str, files_a_batch: int = 10) -> DataFrame:
    """Stream entries from the start: JSON lines of (stream, id, fields)."""
    return spark.readStream.schema("stream string, id string, fields map<string, string>").option("maxFilesPerTrigger", files_a_batch).json(path)


def _start(df: DataFrame, step, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _log_rejects(bad: DataFrame, root: str, batch: int) -> None:
    bad.write.mode("overwrite").parquet(f"{root}/rejects/batch={batch}")


ROUTES = [*messages.KINDS, "UNKNOWN"]


def ingest(stream: DataFrame, root: str, checkpoint: str, available_now: bool = True, now=None) -> StreamingQuery:
    """Raw-data messages into properties and property_events below ``root``. The commit of a batch names it,
    so that one that ran through before a crash is not applied again. What is rejected becomes a dead
    letter, and counters of messages by kind and of records by branch and outcome are written, before the commit."""

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if tables.snapshot(spark, root).done.get(checkpoint, -1) >= number:
            return
        counted = metrics.Counters()
        kinds = counted.observe(batch.select("fields", messages.kind(F.col("fields")).alias("kind")), "message", ROUTES, "kind")
        kept = scratch.stash(kinds)  # the one time that the source is read
        if kept.isEmpty():
            return scratch.discard(kept)
        mine = kept.where("kind = 'PROPERTY_RAW_DATA'").select("fields")
        raw, bad = messages.raw_messages(mine)

        def keep(rejected: DataFrame) -> None:
            every = bad.unionByName(rejected)
            _log_rejects(every, root, number)
            letters.record(spark, root, letters.of_rejects(mine, every), now or _now(spark), f"{checkpoint}#{number}")

        sinks.store(spark, raw, root, {checkpoint: number}, keep, counted)
        counted.write(spark, f"{root}/counters/batch={number}")
        scratch.discard(kept)

    return _start(stream, step, checkpoint, available_now)


def _now(spark: SparkSession):
    return spark.range(1).select(F.current_timestamp()).first()[0]


def once_a_url(stream: DataFrame, keep: str = "7 days") -> DataFrame:
    """The messages of a stream without those whose URL came before, in this run or one that it goes on from: the URLs
    are state in the checkpoint, each for ``keep`` from its first arrival. Messages that are no valid URL message stay."""
    urls = stream.withColumn("_arrived", F.current_timestamp())
    whole = F.lit(True)
    for name in URL_MESSAGE:
        whole = whole & F.coalesce(F.trim(F.col("fields")[name]) != "", F.lit(False))
    is_url = whole & (messages.kind(F.col("fields")) == "PROPERTY_URL")
    key = F.when(is_url, F.concat(F.lit("url "), F.col("fields")["property_url"])).otherwise(F.concat_ws(" ", F.lit("id"), "stream", "id"))
    return urls.withColumn("_key", key).withWatermark("_arrived", keep).dropDuplicatesWithinWatermark(["_key"]).drop("_key", "_arrived")


def pages_to_records(stream: DataFrame, pages: DataFrame, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """URL messages, each URL once over the whole run, joined with stored pages, extracted, and published as raw-data messages."""

    def step(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        urls, bad = messages.url_messages(batch.where(messages.kind(F.col("fields")) == "PROPERTY_URL").select("fields"))
        asked = urls.select(F.col("property_url").alias("url"), "property_id", F.col("scraped_at_utc").alias("scraped_at"))
        good, unread = raw_records(asked.join(pages.select("url", "html"), "url"))
        messages.to_raw_messages(good).write.mode("overwrite").json(f"{out}/batch={number}")
        _log_rejects(bad.unionByName(unread), f"{out.rstrip('/')}-log", number)  # beside the records, which stay readable as one folder

    return _start(once_a_url(stream), step, checkpoint, available_now)


def distinct_urls(discovered: DataFrame, rescanned: DataFrame) -> DataFrame:
    """URLs of both ways, once each; the message that carries a property id is preferred."""
    both = discovered.unionByName(rescanned, allowMissingColumns=True)
    return history.newest_per_key(both, "property_url", [F.col("property_id").asc_nulls_last()])


def rescan_messages(properties: DataFrame, states: list[str], statuses: list[str], now) -> DataFrame:
    """The messages of ``rescan_queries`` for each of the states with each of the statuses."""
    return rescan_queries(properties, [(state, status) for state in states for status in statuses], now)


def rescan_queries(properties: DataFrame, queries: list[tuple[str, str]], now) -> DataFrame:
    """A message for each property that one of the (state, status) pairs asks for, from its first source;
    properties without one are left out, pairs that repeat count once. A status that is not known raises ValueError."""
    unknown = sorted({status for _, status in queries} - set(STATUS_TEXTS.values()))
    if unknown:
        raise ValueError(f"unknown statuses: {', '.join(unknown)}")
    first = F.try_element_at("data_sources", F.lit(1))
    asked = F.lit(False)
    for state in sorted({state for state, _ in queries}):  # the tests of one column reach the scan
        asked = asked | ((F.col("state") == state) & F.col("status").isin([status for s, status in queries if s == state]))
    rows = properties.where(asked).where(first.isNotNull())
    return rows.select(first["source_url"].alias("property_url"), F.lit(now).cast("string").alias("scraped_at_utc"), first["source_name"].alias("data_source"), F.lit("rescan").alias("from_page_url"), "property_id")


def merge_events(stream: DataFrame, root: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """A stream of event rows into the property_events of a store: each batch adds what is new; equal events count once."""

    def step(batch: DataFrame, number: int) -> None:
        spark, at = batch.sparkSession, tables.snapshot(batch.sparkSession, root)
        if batch.isEmpty() or at.done.get(checkpoint, -1) >= number:
            return
        stored = tables.contents(spark, root, "property_events", PROPERTY_EVENTS, at).drop("bucket")
        fresh = history.first_of_equals(batch)
        known = stored.join(fresh.select("property_id").distinct(), "property_id", "left_semi")
        tables.append(spark, root, at, {"property_events": history.only_new(known, fresh)}, {checkpoint: number})
        tables.compact(spark, root, {"property_events": PROPERTY_EVENTS})

    return _start(stream, step, checkpoint, available_now)
