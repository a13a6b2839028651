"""Queries that run whole streams over the driver tables: ingest, distinct URLs, counters, dead letters."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics
from ..schemas import PROPERTIES, PROPERTY_EVENTS, RAW_EVENT
from ..sources import messages, tables
from ..streaming import ingest, letters, scratch
from .driver_tables import table
from .registry import raw_customers, registered

_NOW = datetime(2024, 6, 1)
_FILES = 200  # a batch: a run's messages came in two files before and were one batch


def _folder(spark: SparkSession) -> str:
    return f"{scratch.folder(spark)}/stream-{uuid.uuid4().hex}"


def _send(records: DataFrame, path: str) -> None:
    """Raw records as messages of a stream, in more files of its folder, as many as their size asks for; those of one
    listing share a file, so that no batch boundary falls between them."""
    sent = messages.to_raw_messages(records).drop("warnings")
    fields = F.create_map(*[x for c in sent.columns for x in (F.lit(c), F.col(c).cast("string"))])
    entries = sent.select(F.lit("raw").alias("stream"), F.sha2("data", 256).alias("id"), fields.alias("fields"))
    entries.repartition(F.col("fields")["redfinId"]).write.mode("append").json(path)


def _observed_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's page as seen on two days, the later one under way to a sale for some."""
    first, key = raw_customers(spark, sf_dir), F.col("record_key").cast("long")
    later = first.withColumns({"scraped_at": F.lit("2024-01-20T10:30:00Z"), "status": F.when((key % 3 == 0) & (F.col("status") == "for sale"), "pending").otherwise(F.col("status")), "price": F.when(key % 4 == 0, 600000.0)})
    return first.unionByName(later)


def _run(spark: SparkSession, root: str) -> None:
    ingest.ingest(ingest.message_stream(spark, f"{root}/in", _FILES), f"{root}/store", f"{root}/checkpoint", now=_NOW).awaitTermination()


_FINE = "SELECT c_custkey AS k FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey HAVING c_custkey % 10 > 6 AND NOT coalesce(bool_or(o_orderkey % 501 = 7), false)"


@registered(f"""WITH k AS ({_FINE}),
v AS (SELECT k, o_orderdate, CASE o_orderstatus WHEN 'F' THEN 'Sold' WHEN 'P' THEN 'Pending' ELSE 'Listed' END AS event_type, CAST(o_totalprice AS DOUBLE) AS price, o_orderkey::VARCHAR AS source_id FROM k JOIN orders ON o_custkey = k),
s AS (SELECT k, count(v.price) AS n, coalesce(bool_or(event_type = 'Listed'), false) AS listed, arg_max(v.price, (date_trunc('day', o_orderdate), event_type, v.price, source_id)) AS last_price FROM k LEFT JOIN v USING (k) GROUP BY k)
SELECT k::VARCHAR AS source_key, CASE k % 4 WHEN 0 THEN 'ListRemoved' WHEN 1 THEN 'Sold' WHEN 2 THEN 'Active' ELSE CASE WHEN k % 3 = 0 THEN 'Pending' ELSE 'Active' END END AS status,
  CASE WHEN k % 4 = 1 THEN NULL WHEN k % 4 = 0 THEN 600000.0 ELSE last_price END::DOUBLE AS price, CASE WHEN k % 4 = 3 THEN TIMESTAMP '2024-01-20 10:30:00' ELSE TIMESTAMP '2024-03-02 00:00:00' END AS last_updated,
  (n + CASE WHEN k % 4 = 0 AND (n = 0 OR listed) THEN 1 ELSE 0 END)::BIGINT AS n_events, CASE WHEN k % 4 = 0 AND (n = 0 OR listed) THEN 1 ELSE 0 END::BIGINT AS n_system, 1::BIGINT AS n_sources FROM s""")
def ingest_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages seen on two days, in any order within a batch of the stream, then re-scans of all that was stored, twice each, the later one first."""
    root = _folder(spark)
    _send(_observed_twice(spark, sf_dir), f"{root}/in")
    _run(spark, root)
    stored = tables.read(spark, f"{root}/store", "properties", PROPERTIES)
    key, raw = F.col("data_sources")[0]["source_id"].cast("long"), raw_customers(spark, sf_dir)
    banner = F.element_at(F.array(*[F.lit(x) for x in ("off market", "sold", "for sale", "odd")]), (key % 4 + 1).cast("int"))
    scan = stored.select("property_id", key.cast("string").alias("data_source_id"), banner.alias("status"), F.explode(F.array(F.lit("2024-03-02T00:00:00Z"), F.lit("2024-03-01T00:00:00Z"))).alias("scraped_at"))
    null = {c: F.lit(None).cast(t) for c, t in raw.dtypes if c not in scan.columns}
    scan = scan.withColumns(null | {"url": F.lit("u"), "record_key": F.col("property_id"), "history": F.from_json(F.lit("[]"), f"array<{RAW_EVENT}>")})
    _send(scan.select(*raw.columns), f"{root}/in")
    _run(spark, root)
    told = tables.read(spark, f"{root}/store", "property_events", PROPERTY_EVENTS).groupBy("property_id").agg(F.count("*").alias("n"), F.count_if(F.col("source") == "system").alias("s"))
    now = tables.read(spark, f"{root}/store", "properties", PROPERTIES).join(told, "property_id", "left")
    return now.select(F.col("data_sources")[0]["source_id"].alias("source_key"), "status", F.col("price").cast("double").alias("price"), "last_updated", F.coalesce("n", F.lit(0)).alias("n_events"), F.coalesce("s", F.lit(0)).alias("n_system"), F.size("data_sources").cast("long").alias("n_sources"))


@registered(f"""WITH x AS (SELECT c_custkey AS k, coalesce(bool_or(o_orderkey % 501 = 7), false) AS painted, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey),
o AS (SELECT *, CASE WHEN k % 10 = 0 THEN 'ReadyToBuildTagEncountered' WHEN k % 10 = 1 THEN 'VacantLandEncountered' WHEN k % 10 = 2 THEN 'UnknownPropertyType' WHEN k % 10 = 3 THEN 'InvalidPropertyAddress' WHEN k % 10 = 4 THEN 'UnknownAreaUnit'
  WHEN k % 10 = 5 THEN 'MissingRequiredField' WHEN painted THEN 'Unexpected' WHEN k % 10 = 6 THEN 'UnknownPropertyStatus' ELSE 'passed' END AS outcome FROM x)
SELECT 'listing' AS stage, outcome, 2 * count(*)::BIGINT AS n FROM o GROUP BY outcome UNION ALL SELECT 'listing', 'received', 2 * count(*) FROM o UNION ALL SELECT 'message', 'received', 2 * count(*) FROM o UNION ALL SELECT 'message', 'PROPERTY_RAW_DATA', 2 * count(*) FROM o
UNION ALL SELECT 'written', 'properties', count(*) FROM o WHERE outcome = 'passed' UNION ALL SELECT 'written', 'property_events', sum(n)::BIGINT FROM o WHERE outcome = 'passed'""")
def ingest_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run of ``ingest`` counted by the way: messages by kind, records by outcome, rows written."""
    root = _folder(spark)
    sent = _observed_twice(spark, sf_dir)
    _send(sent, f"{root}/in")
    ingest.ingest(ingest.message_stream(spark, f"{root}/in", _FILES), f"{root}/store", f"{root}/checkpoint", now=_NOW).awaitTermination()
    return spark.read.schema(metrics.COUNTERS).parquet(f"{root}/store/counters/*").groupBy("stage", "outcome").agg(F.sum("n").alias("n"))


@registered("SELECT o_custkey AS k, 1::BIGINT AS n FROM orders GROUP BY o_custkey")
def urls_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A URL message for each order's customer, spread over micro-batches and two runs of the stream: each URL comes out once."""
    root = _folder(spark)
    url = F.concat(F.lit("https://homes.example/home/"), F.col("o_custkey").cast("string"))
    fields = F.create_map(*[x for k, v in {"type": F.lit("PROPERTY_URL"), "property_url": url, "scraped_at_utc": F.lit("2024-01-01T00:00:00Z"), "data_source": F.lit("x"), "from_page_url": F.lit("y")}.items() for x in (F.lit(k), v)])
    entries = table(spark, sf_dir, "orders").select(F.lit("urls").alias("stream"), F.col("o_orderkey").cast("string").alias("id"), fields.alias("fields"), (F.col("o_orderkey") % 2).alias("half"))

    def publish(batch: DataFrame, number: int) -> None:
        batch.select(F.col("fields")["property_url"].alias("url")).write.mode("overwrite").parquet(f"{root}/out/batch={number}")

    for half in (0, 1):  # the second run goes on from the checkpoint of the first
        entries.where(F.col("half") == half).drop("half").repartition("id").write.mode("append").json(f"{root}/in")
        once = ingest.once_a_url(ingest.message_stream(spark, f"{root}/in", _FILES))
        once.writeStream.foreachBatch(publish).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    came = spark.read.schema("url string").parquet(f"{root}/out/*")
    return came.groupBy(F.regexp_extract("url", r"(\d+)$", 1).cast("long").alias("k")).agg(F.count("*").alias("n"))


@registered("""WITH x AS (SELECT c_custkey AS k, coalesce(bool_or(o_orderkey % 501 = 7), false) AS painted FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)
SELECT k::VARCHAR AS source_key, CASE WHEN k % 10 = 6 AND NOT painted AND k % 4 = 0 THEN 'stored' ELSE 'resting' END AS state, CASE WHEN k % 10 = 6 AND NOT painted AND k % 4 = 0 THEN NULL ELSE 3 END::INT AS attempts FROM x WHERE k % 10 < 7 OR painted""")
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that fail are delivered three times and then rest; those that somebody mends are stored once and gone."""
    root = _folder(spark)
    store = f"{root}/store"
    _send(raw_customers(spark, sf_dir), f"{root}/in")
    _run(spark, root)
    source = F.get_json_object(F.col("fields")["data"], "$.redfinId")
    everyone = scratch.stash(letters.read(spark, store).select(source.alias("source_key")))
    for day in (1, 2, 3):  # the third finds nothing due
        letters.retry(spark, store, _NOW + timedelta(days=day), f"day {day}")
    odd = letters.read(spark, store).where((F.col("error_code") == "UnknownPropertyStatus") & (source.cast("long") % 4 == 0))
    mended = F.map_concat(F.map_filter("fields", lambda k, _: k != "data"), F.create_map(F.lit("data"), F.replace(F.col("fields")["data"], F.lit('"status":"odd"'), F.lit('"status":"for sale"'))))
    letters.mend(spark, store, scratch.stash(odd.select("letter_key", mended.alias("fields"))))
    for day in (4, 5):
        letters.retry(spark, store, _NOW + timedelta(days=day), f"day {day}")
    left = letters.read(spark, store).select(source.alias("source_key"), "state", "attempts")
    stored = tables.read(spark, store, "properties", PROPERTIES).select(F.col("data_sources")[0]["source_id"].alias("source_key"), F.lit("stored").alias("now"))
    return everyone.join(left, "source_key", "left").join(stored, "source_key", "left").select("source_key", F.coalesce("state", "now").alias("state"), "attempts")


@registered("SELECT * FROM events WHERE ts::DATE >= (SELECT min(ts::DATE) FROM (SELECT ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000))")
def retention_by_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream kept by days of which whole days below the newest 1000 messages are let go."""
    path, sent = _folder(spark), table(spark, sf_dir, "events")
    sent.withColumn("day", F.to_date("ts")).repartition("day").write.partitionBy("day").parquet(path)
    metrics.drop_old_files(spark.read.parquet(path), 1000)
    return spark.read.parquet(path).select(*sent.columns)
