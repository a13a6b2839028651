"""The driver tables seen as listing data: users' events as histories, customers as properties."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import lookup

EVENT_TYPES = {"view": "Listed", "click": "PriceChange", "signup": "Pending", "purchase": "Sold", "error": "ListRemoved"}

EVENTS_SQL = """SELECT event_id, user_id AS property_id, ts AS event_ts,
  CASE event_type WHEN 'view' THEN 'Listed' WHEN 'click' THEN 'PriceChange' WHEN 'signup' THEN 'Pending' WHEN 'purchase' THEN 'Sold' WHEN 'error' THEN 'ListRemoved' END AS event_type,
  value AS price, CASE WHEN event_id % 7 <> 0 THEN 'mls' END AS source, CAST(json_extract(props, '$.k') AS VARCHAR) AS source_id, event_type AS description FROM events"""

PROPERTIES_SQL = """SELECT o_orderkey AS property_id, r_name AS state, o_orderstatus AS status, n_name AS city, CAST(c_nationkey + 98000 AS VARCHAR) AS zip_code, c_mktsegment AS property_type,
  CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS price, c_custkey AS owner FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    source_id = F.from_json("props", "k int")["k"].cast("string")
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("property_id"), F.col("ts").alias("event_ts"), lookup(EVENT_TYPES, F.col("event_type")).alias("event_type"), F.col("value").alias("price"),
        F.when(F.col("event_id") % 7 != 0, "mls").alias("source"), source_id.alias("source_id"), F.col("event_type").alias("description"),
    )


def properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda name: table(spark, sf_dir, name)
    rows = read("orders").join(read("customer"), F.col("o_custkey") == F.col("c_custkey")).join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select(
        F.col("o_orderkey").alias("property_id"), F.col("r_name").alias("state"), F.col("o_orderstatus").alias("status"), F.col("n_name").alias("city"), (F.col("c_nationkey") + 98000).cast("string").alias("zip_code"),
        F.col("c_mktsegment").alias("property_type"), F.when(F.col("o_orderkey") % 11 != 0, F.col("o_totalprice")).alias("price"), F.col("c_custkey").alias("owner"),
    )
