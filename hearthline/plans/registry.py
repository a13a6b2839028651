"""All registered queries over the driver tables, with the SQL that must agree."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import address, classify, pages, values
from ..operators import correction, goals, history, merge, metrics, query, records, repair
from ..schemas import RAW_EVENT
from .driver_tables import EVENTS_SQL, PROPERTIES_SQL, events, properties, table

_QUERIES: dict[str, tuple] = {}


def registered(sql: str | None = None):
    def add(function):
        _QUERIES[function.__name__] = (function, sql)
        return function

    return add


def queries() -> dict:
    return {name: function for name, (function, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _QUERIES.items() if sql}


_E = f"WITH e AS ({EVENTS_SQL})"
_SAME = "a.property_id = b.property_id AND a.event_ts IS NOT DISTINCT FROM b.event_ts AND a.event_type IS NOT DISTINCT FROM b.event_type AND a.price IS NOT DISTINCT FROM b.price AND a.source IS NOT DISTINCT FROM b.source AND a.source_id IS NOT DISTINCT FROM b.source_id"


@registered(f"""{_E}, both_sides AS (
  SELECT *, 0 AS origin FROM e WHERE event_id % 3 <> 2 UNION ALL
  SELECT event_id + 1000000 AS event_id, property_id, event_ts, event_type, price, source, source_id, 'again ' || description AS description, 1 AS origin FROM e WHERE event_id % 3 <> 1)
SELECT event_id, property_id, event_ts, event_type, price, source, source_id, description FROM (
  SELECT *, row_number() OVER (PARTITION BY property_id, event_ts, event_type, price, source, source_id ORDER BY origin, description) AS n FROM both_sides) WHERE n = 1""")
def history_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    again = e.where("event_id % 3 <> 1").withColumns({"event_id": F.col("event_id") + 1000000, "description": F.concat(F.lit("again "), "description")})
    return history.merge(e.where("event_id % 3 <> 2"), again)


@registered(f"{_E} SELECT a.* FROM e a WHERE NOT EXISTS (SELECT 1 FROM e b WHERE day(b.event_ts) % 2 = 0 AND {_SAME})")
def new_events_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    return history.only_new(e.where(F.dayofmonth("event_ts") % 2 == 0), e)


@registered(f"""{_E}, seen AS (
  SELECT property_id, event_type AS last_type, event_ts AS last_ts, lag(event_type) OVER w AS previous_type, lag(event_ts) OVER w AS previous_ts, lead(1) OVER w AS nxt
  FROM e WINDOW w AS (PARTITION BY property_id ORDER BY event_ts NULLS FIRST, event_type NULLS FIRST, price NULLS FIRST, source NULLS FIRST, source_id NULLS FIRST, description NULLS FIRST))
SELECT property_id, last_type, last_ts, previous_type, previous_ts, (floor(epoch(last_ts)) - floor(epoch(previous_ts))) / 86400.0 AS gap_days,
  CASE WHEN last_type = 'Sold' OR (last_type = 'Pending' AND previous_type = 'Sold' AND (floor(epoch(last_ts)) - floor(epoch(previous_ts))) / 86400.0 <= 2) THEN 'Sold' WHEN last_type = 'Pending' THEN 'Pending' WHEN last_type = 'ListRemoved' THEN 'ListRemoved' ELSE 'Active' END AS status
FROM seen WHERE nxt IS NULL""")
def latest_event_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = history.last_events(events(spark, sf_dir))
    sold = (F.col("last_type") == "Sold") | ((F.col("last_type") == "Pending") & (F.col("previous_type") == "Sold") & (F.col("gap_days") <= 2))
    return last.withColumn("status", F.when(sold, "Sold").when(F.col("last_type").isin("Pending", "ListRemoved"), F.col("last_type")).otherwise("Active"))


_TEXT_SQL = "CASE event_type WHEN 'view' THEN 'Listed (Active)' WHEN 'click' THEN 'PRICE Changed' WHEN 'signup' THEN 'Listed by current owner' WHEN 'purchase' THEN 'sold (MLS)' ELSE CASE WHEN event_id % 2 = 0 THEN 'Listing Removed' ELSE 'painted' END END"


@registered(f"""WITH t AS (SELECT event_id, lower({_TEXT_SQL}) AS d FROM events)
SELECT event_id, CASE WHEN d LIKE 'listed%' AND d LIKE '%rent%' THEN 'ListedForRent' WHEN d LIKE 'listed%' THEN 'Listed' WHEN d LIKE 'sold%' THEN 'Sold' WHEN d LIKE 'price changed%' THEN 'PriceChange' WHEN d LIKE 'listing removed%' THEN 'ListRemoved' END AS event_type FROM t""")
def event_type_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", classify.event_type(F.expr(_TEXT_SQL)).alias("event_type"))


_HALF = "SELECT o_custkey AS property_id, o_orderstatus AS status, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS price, nullif(o_orderpriority, '5-LOW') AS priority, o_orderdate AS last_updated, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS n FROM orders"
_MERGED_SAME = "n.status IS NOT DISTINCT FROM o.status AND n.price IS NOT DISTINCT FROM o.price AND coalesce(n.priority, o.priority) IS NOT DISTINCT FROM o.priority"


@registered(f"""WITH o AS (SELECT * FROM ({_HALF} WHERE o_orderkey % 2 = 0) WHERE n = 1), n AS (SELECT * FROM ({_HALF} WHERE o_orderkey % 2 = 1) WHERE n = 1),
j AS (SELECT coalesce(o.property_id, n.property_id) AS property_id, o.status AS os, o.price AS op, o.priority AS opr, o.last_updated AS ot, n.status AS ns, n.price AS np, coalesce(n.priority, o.priority) AS npr, n.last_updated AS nt,
  CASE WHEN n.property_id IS NULL THEN 'kept' WHEN o.property_id IS NULL THEN 'inserted' WHEN NOT coalesce(n.last_updated > o.last_updated, false) AND {_MERGED_SAME} THEN 'unchanged' ELSE 'merged' END AS outcome FROM o FULL JOIN n ON o.property_id = n.property_id)
SELECT property_id, CASE WHEN outcome IN ('kept', 'unchanged') THEN os ELSE ns END AS status, CASE WHEN outcome IN ('kept', 'unchanged') THEN op ELSE np END AS price, CASE WHEN outcome IN ('kept', 'unchanged') THEN opr ELSE npr END AS priority,
  CASE WHEN outcome IN ('kept', 'unchanged') THEN ot ELSE nt END AS last_updated, outcome, outcome = 'merged' AND NOT coalesce(nt > ot, false) AS late_overwrite FROM j""")
def metadata_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")

    def half(odd: int) -> DataFrame:
        newest = history.newest_per_key(orders.where(F.col("o_orderkey") % 2 == odd), "o_custkey", [F.desc("o_orderdate"), F.asc("o_orderkey")])
        return newest.select(F.col("o_custkey").alias("property_id"), F.col("o_orderstatus").alias("status"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")).alias("price"), F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"), F.col("o_orderdate").alias("last_updated"))

    return merge.merge_metadata(half(0), half(1), kept_if_null=["priority"], sources=None)


@registered("""WITH o AS (SELECT c_custkey, c_name, c_mktsegment, c_nationkey FROM customer WHERE c_custkey % 13 <> 1),
n AS (SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_name END AS c_name, CASE WHEN c_custkey % 7 = 0 THEN 'HOUSEHOLD' ELSE c_mktsegment END AS c_mktsegment, CASE WHEN c_custkey % 5 = 0 THEN c_nationkey + 1 ELSE c_nationkey END AS c_nationkey FROM customer WHERE c_custkey % 13 <> 2),
j AS (SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, o.c_name a1, n.c_name b1, o.c_mktsegment a2, n.c_mktsegment b2, o.c_nationkey::VARCHAR a3, n.c_nationkey::VARCHAR b3 FROM o FULL JOIN n ON o.c_custkey = n.c_custkey)
SELECT * FROM (SELECT c_custkey, 'c_name' AS field, a1 AS old_value, b1 AS new_value FROM j UNION ALL SELECT c_custkey, 'c_mktsegment', a2, b2 FROM j UNION ALL SELECT c_custkey, 'c_nationkey', a3, b3 FROM j) WHERE old_value IS DISTINCT FROM new_value""")
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    new = old.where(key % 13 != 2).withColumns({"c_name": F.when(key % 9 != 0, F.col("c_name")), "c_mktsegment": F.when(key % 7 == 0, "HOUSEHOLD").otherwise(F.col("c_mktsegment")), "c_nationkey": F.when(key % 5 == 0, F.col("c_nationkey") + 1).otherwise(F.col("c_nationkey"))})
    return merge.snapshot_diff(old.where(key % 13 != 1), new, "c_custkey", ["c_name", "c_mktsegment", "c_nationkey"])


@registered(f"""SELECT * FROM ({PROPERTIES_SQL}) WHERE state IN ('ASIA', 'EUROPE') AND status IN ('O', 'F') AND CAST(zip_code AS INT) BETWEEN 98002 AND 98019 AND property_type IN ('BUILDING', 'MACHINERY')
  AND (price IS NULL OR price = 0 OR price BETWEEN 100000 AND 300000)""")
def pattern_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = query.Pattern(states=["ASIA", "EUROPE"], statuses=["O", "F"], zip_codes=[str(z) for z in range(98002, 98020)], property_types=["BUILDING", "MACHINERY"], price=(100000, 300000))
    return query.find(properties(spark, sf_dir), p)


@registered("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus IN ('F', 'P') AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1996-06-30')")
def event_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("event_type"), F.col("o_orderdate").alias("event_ts"))
    return goals.happened(table(spark, sf_dir, "customer"), sales, ["F", "P"], (datetime(1996, 1, 1), datetime(1996, 6, 30)), "c_custkey")


@registered(f"{_E} SELECT * FROM (SELECT *, lag(price) OVER (PARTITION BY property_id ORDER BY event_ts, event_id) AS previous_price FROM e WHERE event_type IN ('Listed', 'ReListed', 'PriceChange') AND price IS NOT NULL) WHERE price < previous_price")
def price_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return goals.price_drops(events(spark, sf_dir))


@registered(f"""{_E} SELECT * FROM (SELECT *, last_value(CASE WHEN event_type IN ('Listed', 'ReListed', 'PriceChange') THEN price END IGNORE NULLS) OVER (PARTITION BY property_id ORDER BY event_ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS list_price FROM e)
WHERE event_type = 'Sold' AND price > list_price""")
def sold_over_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return goals.sold_over_list(events(spark, sf_dir))


@registered(f"{_E} SELECT property_id, max(event_ts) AS listed_ts FROM e WHERE event_type = 'Listed' GROUP BY property_id HAVING max(event_ts) >= TIMESTAMP '2024-01-29'")
def newly_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return goals.newly_listed(events(spark, sf_dir), F.lit("2024-01-29").cast("timestamp"))


@registered("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1")
def newest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.newest_per_key(table(spark, sf_dir, "orders"), "o_custkey", [F.desc("o_orderdate"), F.asc("o_orderkey")])


@registered("SELECT md5(text) AS text_hash, count(*) AS copies, count(DISTINCT lang) = 1 AS consistent FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.duplicate_groups(table(spark, sf_dir, "documents").withColumn("text_hash", F.md5("text")), ["text_hash"], "lang")


@registered("SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1997-03-01' OR (o_orderdate = TIMESTAMP '1997-03-01' AND o_orderkey > 500) ORDER BY o_orderdate, o_orderkey LIMIT 100")
def keyset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query.page(table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"], 100, (datetime(1997, 3, 1), 500))


@registered("SELECT event_id, timezone('UTC', timezone('America/Los_Angeles', ts)) AS utc_ts FROM events")
def pacific_to_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", values.wall_time_to_utc(F.col("ts").cast("timestamp")).alias("utc_ts"))


@registered("""WITH l AS (SELECT page_id, url, unnest(list_distinct(regexp_extract_all(html, '<a\\s[^>]*?href=["'']([^"'']*)', 1))) AS link FROM pages)
SELECT page_id, CASE WHEN regexp_matches(link, '^\\w+://') THEN link WHEN link LIKE '/%' THEN regexp_extract(url, '^(\\w+://[^/?#]+)', 1) || link END AS link_url FROM l WHERE regexp_matches(link, '^\\w+://') OR link LIKE '/%'""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", "url", F.explode(pages.links(F.col("html"))).alias("link"))
    return rows.where(F.col("link").rlike(r"^\w+://") | F.col("link").startswith("/")).select("page_id", pages.absolute(F.col("link"), F.col("url")).alias("link_url"))


@registered("""SELECT page_id, nullif(regexp_extract(url, '^\\w+://([^/?#]+)', 1), '') AS host, nullif(regexp_extract(html, '<title>([^<]*)', 1), '') AS title, coalesce(TRY_CAST(nullif(regexp_extract(url, '[?&]page=(\\d+)', 1), '') AS INT), 1) AS page_no,
  nullif(regexp_extract(url, '^\\w+://[^/?#]+/([a-z][a-z])/', 1), '') AS lang FROM pages""")
def page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    url, html = F.col("url"), F.col("html")
    return table(spark, sf_dir, "pages").select("page_id", pages.extract(url, r"^\w+://([^/?#]+)").alias("host"), pages.extract(html, "<title>([^<]*)").alias("title"), F.coalesce(pages.extract(url, r"[?&]page=(\d+)").try_cast("int"), F.lit(1)).alias("page_no"), pages.extract(url, r"^\w+://[^/?#]+/([a-z][a-z])/").alias("lang"))


@registered("SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k, json_extract(props, '$.k') IS NULL AS missing FROM events")
def json_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.from_json("props", "k int")["k"]
    return table(spark, sf_dir, "events").select("event_id", k.alias("k"), k.isNull().alias("missing"))


@registered("SELECT CASE WHEN event_type = 'error' THEN 'failed' ELSE 'processed' END AS outcome, user_id % 2 = 0 AS from_rescan, count(*) AS n FROM events GROUP BY ALL")
def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.when(F.col("event_type") == "error", "failed").otherwise("processed").alias("outcome"), (F.col("user_id") % 2 == 0).alias("from_rescan"))
    return metrics.outcome_counts(rows, "outcome", "from_rescan")


_RENTS = "CASE WHEN event_type = 'Pending' THEN 'ListedForRent' ELSE event_type END"


@registered(f"""{_E}, f AS (SELECT property_id, event_ts, {_RENTS} AS event_type, price, source, source_id, description FROM e WHERE property_id % 3 <> 0 OR event_type <> 'ListRemoved'),
r AS (SELECT *, row_number() OVER w AS no, lead(event_type) OVER w AS nt, lead(event_ts) OVER w AS nts FROM f WINDOW w AS (PARTITION BY property_id ORDER BY event_ts, event_type, price, source NULLS FIRST, source_id, description)),
p AS (SELECT property_id, max(no) FILTER (event_type = 'Listed') AS l, max(no) FILTER (event_type = 'ListRemoved') AS rm, max(event_ts) FILTER (event_type = 'Listed') AS lts, max(event_ts) FILTER (event_type = 'ListRemoved') AS rts FROM r GROUP BY property_id),
m AS (SELECT r.property_id, min(no) AS first_no, arg_min(nt, no) AS nt, arg_min(nts, no) AS nts FROM r JOIN p USING (property_id) WHERE event_type = 'Listed' AND no >= CASE WHEN rm IS NULL THEN 1 ELSE least(l, rm) END GROUP BY r.property_id)
SELECT p.property_id, CASE WHEN first_no > 1 AND nt IN ('ListedForRent', 'RentalRemoved') THEN nts - INTERVAL 12 HOUR ELSE TIMESTAMP '2024-02-01' END AS event_ts FROM p JOIN m USING (property_id) WHERE lts IS NOT NULL AND (rts IS NULL OR rts < lts)""")
def list_removed_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("event_type", F.expr(_RENTS)).where("property_id % 3 <> 0 or event_type <> 'ListRemoved'")
    withdrawn = e.select("property_id").distinct().withColumn("seen_at", F.lit("2024-02-01").cast("timestamp"))
    return correction.removals_to_add(e, withdrawn)


@registered("SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000")
def retention_newest_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.newest_n(table(spark, sf_dir, "events"), 1000)


@registered("""SELECT c_custkey, unnest(range(1, len(l) + 1))::INT AS event_no, unnest([x.o_orderdate for x in l]) AS event_ts, unnest([x.o_orderkey for x in l]) AS order_id, len(l)::INT AS n_events
FROM (SELECT c_custkey, list({'o_orderdate': o_orderdate, 'o_orderkey': o_orderkey} ORDER BY o_orderdate, o_orderkey) AS l FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)""")
def nested_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    nested = table(spark, sf_dir, "customer").select("c_custkey").join(history.as_arrays(orders, "c_custkey", ["o_orderdate", "o_orderkey"]), "c_custkey")
    flat = nested.select("c_custkey", F.size("history").alias("n_events"), F.posexplode("history").alias("at", "e"))
    return flat.select("c_custkey", (F.col("at") + 1).alias("event_no"), F.col("e.o_orderdate").alias("event_ts"), F.col("e.o_orderkey").alias("order_id"), "n_events")


@registered("""SELECT c_custkey, lower(replace(c_custkey || '-' || c_mktsegment || '-ave-ne|' || CASE WHEN c_custkey % 3 = 0 THEN 'apt-' || (c_custkey % 50) || '|' ELSE '' END || n_name || '|wa|' || (98000 + c_nationkey), ' ', '-')) AS address_hash
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def address_standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    unit = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit(" Unit "), (F.col("c_custkey") % 50).cast("string"))).otherwise("")
    text = F.concat(F.col("c_custkey").cast("string"), F.lit(" "), "c_mktsegment", F.lit(" Avenue Northeast"), unit, F.lit(", "), "n_name", F.lit(", WA "), (F.col("c_nationkey") + 98000).cast("string"))
    return address.standardise(rows.select("c_custkey", text.alias("text")), "text").select("c_custkey", F.col("parsed_address.address_hash").alias("address_hash"))


@registered(f"""{_E}, scraped AS (SELECT * FROM e WHERE property_id % 2 = 0 AND event_id % 4 <> 0)
SELECT a.* FROM e a WHERE a.property_id IN (SELECT property_id FROM scraped) AND NOT EXISTS (SELECT 1 FROM scraped b WHERE {_SAME})""")
def missing_from_scrape(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    return goals.missing_from_scrape(e, e.where("property_id % 2 = 0 and event_id % 4 <> 0"))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and their orders as raw records, some of them faulty by their key."""
    key = F.col("c_custkey")
    event = F.struct(F.date_format("o_orderdate", "MMM d, yyyy").alias("date"), F.when(F.col("o_orderkey") % 501 == 7, "Painted").when(F.col("o_orderstatus") == "F", "Sold (MLS)").when(F.col("o_orderstatus") == "P", "Pending").otherwise("Listed (Active)").alias("description"), F.col("o_totalprice").alias("price"), F.lit("MLS").alias("source"), F.col("o_orderkey").cast("string").alias("mlsNumber"))
    sales = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.array_sort(F.collect_list(event)).alias("history"))
    rows = table(spark, sf_dir, "customer").join(sales.hint("merge"), "c_custkey", "left")
    kind = F.when(key % 10 == 1, "Vacant land").when(key % 10 == 2, "Castle").otherwise("Single-family")
    return rows.select(
        key.cast("string").alias("record_key"), F.concat(F.lit("https://homes.example/home/"), key.cast("string")).alias("url"), F.lit(records.SOURCE_NAME).alias("data_source_name"), key.cast("string").alias("data_source_id"),
        F.lit("2024-01-15T10:30:00Z").alias("scraped_at"), F.when(key % 10 == 3, "nowhere").otherwise(F.concat(key.cast("string"), F.lit(" Oak St, Bend, OR 97701"))).alias("address"), F.when(key % 10 == 4, "12 miles").otherwise("1200.0 sqft").alias("area"),
        kind.alias("property_type"), F.lit(None).cast("string").alias("lot_area"), F.when(key % 10 != 5, 3.0).alias("bedrooms"), F.lit(2.0).alias("bathrooms"), F.lit(1990).alias("year_built"),
        F.when(key % 10 == 6, "odd").otherwise("for sale").alias("status"), F.when(key % 2 == 0, 500000.0).alias("price"), (key % 10 == 0).alias("ready_to_build"), F.lit(None).cast("string").alias("property_id"), F.coalesce("history", F.from_json(F.lit("[]"), f"array<{RAW_EVENT}>")).alias("history"),
    )


@registered("""WITH x AS (SELECT c_custkey AS k, coalesce(bool_or(o_orderkey % 501 = 7), false) AS painted FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)
SELECT CASE WHEN k % 10 = 0 THEN 'ReadyToBuildTagEncountered' WHEN k % 10 = 1 THEN 'VacantLandEncountered' WHEN k % 10 = 2 THEN 'UnknownPropertyType' WHEN k % 10 = 3 THEN 'InvalidPropertyAddress' WHEN k % 10 = 4 THEN 'UnknownAreaUnit'
  WHEN k % 10 = 5 THEN 'MissingRequiredField' WHEN painted THEN 'Unexpected' WHEN k % 10 = 6 THEN 'UnknownPropertyStatus' ELSE 'parsed' END AS outcome, count(*) AS n FROM x GROUP BY 1""")
def ingest_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = records.parse(raw_customers(spark, sf_dir))
    return good.select(F.lit("parsed").alias("outcome")).unionByName(bad.select(F.col("error_code").alias("outcome"))).groupBy("outcome").agg(F.count("*").alias("n"))


@registered("""WITH k AS (SELECT c_custkey AS k FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey HAVING c_custkey % 10 > 6 AND NOT coalesce(bool_or(o_orderkey % 501 = 7), false)),
v AS (SELECT k, timezone('UTC', timezone('America/Los_Angeles', date_trunc('day', o_orderdate))) AS event_ts, CASE o_orderstatus WHEN 'F' THEN 'Sold' WHEN 'P' THEN 'Pending' ELSE 'Listed' END AS event_type, CAST(o_totalprice AS DOUBLE) AS price, o_orderkey::VARCHAR AS source_id FROM k JOIN orders ON o_custkey = k)
SELECT k::VARCHAR AS source_key, 'Active' AS status, CASE WHEN k % 2 = 0 THEN 500000.0 ELSE (SELECT arg_max(v.price, (v.event_ts, v.event_type, v.price, v.source_id)) FROM v WHERE v.k = k.k) END::DOUBLE AS price, (SELECT count(*) FROM v WHERE v.k = k.k) AS n_events FROM k""")
def ingest_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed records upserted into an empty store, then upserted again: the second time changes nothing."""
    good, _ = records.parse(raw_customers(spark, sf_dir))
    rows, happened = records.property_rows(good), records.event_rows(good)
    none = lambda df: df.where(F.lit(False))
    first = merge.upsert(none(rows), none(happened), rows, happened)
    again = merge.upsert(*first, rows, happened)
    per = again[1].groupBy("property_id").agg(F.count("*").alias("n_events"))
    return again[0].join(per, "property_id", "left").select(F.col("data_sources")[0]["source_id"].alias("source_key"), "status", F.col("price").cast("double").alias("price"), F.coalesce("n_events", F.lit(0)).alias("n_events"))


@registered(f"{_E} SELECT property_id, event_type, count(*) AS n, sum(price) IS NOT NULL AS priced FROM (SELECT DISTINCT property_id, event_ts, event_type, price, source, source_id FROM e) GROUP BY ALL")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream of files, merged batch by batch into a versioned table, and read back."""
    from ..streaming import ingest, scratch

    root = f"{scratch.folder(spark)}/stream-{uuid.uuid4().hex}"
    rows = events(spark, sf_dir)
    typed = rows.select(F.col("event_id").cast("string").alias("event_id"), F.col("property_id").cast("string").alias("property_id"), "event_ts", "event_type", F.col("price").cast("decimal(18,2)").alias("price"), "source", "source_id", "description")
    typed.repartition(4, "property_id").write.parquet(f"{root}/in")
    stream = spark.readStream.schema(typed.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/in")
    ingest.merge_events(stream, root, f"{root}/checkpoint").awaitTermination()
    from ..schemas import PROPERTY_EVENTS
    from ..sources import tables

    stored = tables.read(spark, root, "property_events", PROPERTY_EVENTS)
    return stored.groupBy(F.col("property_id").cast("long").alias("property_id"), "event_type").agg(F.count("*").alias("n"), F.sum("price").isNotNull().alias("priced"))


@registered(f"""WITH p AS ({PROPERTIES_SQL}), e AS ({EVENTS_SQL})
SELECT p.property_id, p.price, p.city, count(e.event_id) AS n_events, max(e.event_ts) AS last_event_ts FROM p LEFT JOIN e ON p.owner = e.property_id
WHERE state = 'ASIA' AND status = 'O' AND (p.price IS NULL OR p.price = 0 OR p.price <= 150000) GROUP BY ALL""")
def active_with_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open listings of one state under a price, with the events of their owner's history."""
    p = query.Pattern(states=["ASIA"], statuses=["O"], price=(None, 150000))
    found = query.find(properties(spark, sf_dir), p)
    told = history.as_arrays(events(spark, sf_dir), "property_id", ["event_ts", "event_type", "price", "event_id"]).withColumnRenamed("property_id", "owner")
    full = found.join(told, "owner", "left")
    return full.select("property_id", "price", "city", F.coalesce(F.size("history"), F.lit(0)).cast("long").alias("n"), F.try_element_at("history", F.lit(-1))["event_ts"].alias("last_event_ts")).select("property_id", "price", "city", F.greatest("n", F.lit(0).cast("long")).alias("n_events"), "last_event_ts")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return active_with_history(spark, sf_dir)


from . import listing_queries, stream_queries  # noqa: E402, F401  (they register their queries here)
