"""More queries over the driver tables: messages, re-scans, pages, statuses, keys, repairs and searches."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import address, address_tags, classify, keys, pages
from ..operators import goals, history, merge, query, records, repair
from ..schemas import PROPERTIES, PROPERTY_EVENTS, RAW_EVENT
from ..sources import lookup_index, messages, sinks, tables
from ..sources.records import parse_lines, read_lines
from ..streaming import ingest, scratch
from .driver_tables import EVENTS_SQL, PROPERTIES_SQL, events, properties, table
from .registry import raw_customers, registered

_PARSED = "SELECT c_custkey AS k FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey HAVING c_custkey % 10 > 6 AND NOT coalesce(bool_or(o_orderkey % 501 = 7), false)"


def _folder(spark: SparkSession) -> str:
    return f"{scratch.folder(spark)}/query-{uuid.uuid4().hex}"


def _as_fields(df: DataFrame) -> DataFrame:
    return df.select(F.create_map(*[x for c in df.columns if c != "warnings" for x in (F.lit(c), F.col(c).cast("string"))]).alias("fields"))


@registered(f"SELECT k::VARCHAR AS source_key, 1 AS copies FROM ({_PARSED})")
def message_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records published as messages and read back: every new listing gets an id of its own."""
    raw, _ = messages.raw_messages(_as_fields(messages.to_raw_messages(raw_customers(spark, sf_dir))))
    good, _ = records.parse(raw)
    ids = good.groupBy("property_id").agg(F.count("*").cast("int").alias("copies"), F.min(F.col("data_sources")[0]["source_id"]).alias("source_key"))
    return ids.select("source_key", "copies")


@registered(f"""WITH k AS ({_PARSED}),
v AS (SELECT k, o_orderdate, CASE o_orderstatus WHEN 'F' THEN 'Sold' WHEN 'P' THEN 'Pending' ELSE 'Listed' END AS event_type, CAST(o_totalprice AS DOUBLE) AS price, o_orderkey::VARCHAR AS source_id FROM k JOIN orders ON o_custkey = k),
s AS (SELECT k, count(v.price) AS n, coalesce(bool_or(event_type = 'Listed'), false) AS listed, arg_max(v.price, (date_trunc('day', o_orderdate), event_type, v.price, source_id)) AS last_price FROM k LEFT JOIN v USING (k) GROUP BY k)
SELECT k::VARCHAR AS source_key, CASE k % 4 WHEN 0 THEN 'ListRemoved' WHEN 1 THEN 'Sold' ELSE 'Active' END AS status, CASE WHEN k % 4 = 1 THEN NULL WHEN k % 2 = 0 THEN 500000.0 ELSE last_price END::DOUBLE AS price,
  (n + CASE WHEN k % 4 = 0 AND (n = 0 OR listed) THEN 1 ELSE 0 END)::BIGINT AS n_events, CASE WHEN k % 4 = 0 AND (n = 0 OR listed) THEN 1 ELSE 0 END::BIGINT AS n_system FROM s""")
def rescan_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New listings stored, then scanned again by id, the same scan twice: sold ones lose their price, withdrawn ones gain a removal."""
    root, raw = _folder(spark), raw_customers(spark, sf_dir)
    sinks.store(spark, raw.where(F.col("record_key").cast("int") % 10 > 6), root)
    stored = tables.read(spark, root, "properties", PROPERTIES)
    key = F.col("data_sources")[0]["source_id"].cast("int")
    status = F.element_at(F.array(*[F.lit(x) for x in ("off market", "sold", "for sale", "odd")]), (key % 4 + 1).cast("int"))
    seen = stored.select("property_id", status.alias("status"))
    null = {c: F.lit(None).cast(t) for c, t in raw.dtypes if c not in seen.columns}
    scan = seen.withColumns(null | {"record_key": F.col("property_id"), "scraped_at": F.lit("2024-03-01T00:00:00Z"), "history": F.from_json(F.lit("[]"), f"array<{RAW_EVENT}>")})
    for _ in range(2):
        sinks.store(spark, scan.select(*raw.columns), root)
    told = tables.read(spark, root, "property_events", PROPERTY_EVENTS).groupBy("property_id").agg(F.count("*").alias("n"), F.count_if(F.col("source") == "system").alias("s"))
    now = tables.read(spark, root, "properties", PROPERTIES).join(told.hint("merge"), "property_id", "left")
    return now.select(F.col("data_sources")[0]["source_id"].alias("source_key"), "status", F.col("price").cast("double").alias("price"), F.coalesce("n", F.lit(0)).alias("n_events"), F.coalesce("s", F.lit(0)).alias("n_system"))


_HISTORY = "array<struct<event_ts: timestamp, event_type: string, id: bigint, description: string>>"
_TEXTS = ["for sale", "pending - offer", "sold", "off market", "Sold by owner", "off market— sold once", "soldonjun 1, 1997", "closed deal", "rental removed", "odd", "for rent", "soldonjan 40, 1997"]
_KIND = "CASE WHEN o_orderstatus = 'F' THEN 'Sold' WHEN o_orderstatus = 'P' THEN 'Pending' WHEN o_orderkey % 4 = 0 THEN 'Listed' WHEN o_orderkey % 4 = 1 THEN 'ListedForRent' WHEN o_orderkey % 4 = 2 THEN 'DeListed' ELSE 'RentalRemoved' END"


@registered(f"""WITH v AS (SELECT o_custkey AS k, o_orderdate AS ts, {_KIND} AS kind, o_orderkey AS id FROM orders),
l AS (SELECT k, list({{'ts': ts, 'kind': kind}} ORDER BY ts, kind, id) AS h, list(kind ORDER BY ts, kind, id) FILTER (WHERE kind IN ('ListedForRent', 'RentalRemoved', 'Listed')) AS t FROM v GROUP BY k),
c AS (SELECT c_custkey AS k, [{", ".join(f"'{t}'" for t in _TEXTS)}][c_custkey % 12 + 1] AS t, h[-1].kind AS kind, h[-1].ts AS ts, h[-2].kind AS before_kind, h[-2].ts AS before_ts,
  l.t[-1] AS telling, TIMESTAMP '1997-06-01 07:00:00' AS sale FROM customer LEFT JOIN l ON c_custkey = k)
SELECT k, t AS banner, CASE t WHEN 'for sale' THEN 'Active' WHEN 'pending - offer' THEN 'Pending' WHEN 'sold' THEN 'Sold' WHEN 'off market' THEN 'ListRemoved' WHEN 'Sold by owner' THEN 'Sold' WHEN 'rental removed' THEN 'RentalRemoved' WHEN 'for rent' THEN 'ActiveForRental'
  WHEN 'off market— sold once' THEN CASE WHEN kind IN ('Listed', 'DeListed', 'RentalRemoved', 'Pending') THEN 'ListRemoved' WHEN kind = 'Sold' THEN 'Sold' END
  WHEN 'soldonjun 1, 1997' THEN CASE WHEN kind IN ('Sold', 'DeListed') AND abs(epoch(ts) - epoch(sale)) / 86400 <= 7 THEN 'Sold' WHEN kind = 'Pending' AND before_kind = 'Sold' AND abs(epoch(ts) - epoch(before_ts)) / 86400 <= 2 THEN 'Sold'
    WHEN kind = 'RentalRemoved' THEN 'RentalRemoved' WHEN kind = 'Listed' THEN 'ListRemoved' WHEN ts < sale THEN 'ListRemoved' ELSE 'Sold' END
  WHEN 'closed deal' THEN CASE WHEN telling = 'Listed' THEN 'ListRemoved' WHEN telling IS NOT NULL THEN 'RentalRemoved' END END AS status,
  CASE WHEN t = 'soldonjan 40, 1997' THEN 'Unexpected' WHEN t = 'odd' OR (t = 'closed deal' AND telling IS NULL) OR (t = 'off market— sold once' AND (kind IS NULL OR kind = 'ListedForRent')) THEN 'UnknownPropertyStatus' END AS error FROM c""")
def status_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule of the status table, on banners and the customers' order histories."""
    told = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.struct(F.col("o_orderdate").alias("event_ts"), F.expr(_KIND).alias("event_type"), F.col("o_orderkey").alias("id"), F.when(F.expr(_KIND) == "RentalRemoved", "Rental removed").otherwise("x").alias("description")).alias("e"))
    rows = table(spark, sf_dir, "customer").join(told.groupBy("c_custkey").agg(F.array_sort(F.collect_list("e")).alias("h")), "c_custkey", "left")
    text = F.element_at(F.array(*[F.lit(t) for t in _TEXTS]), (F.col("c_custkey") % 12 + 1).cast("int"))
    none = F.array().cast(_HISTORY)
    rows = rows.select(F.col("c_custkey").alias("k"), text.alias("banner"), F.coalesce(F.col("h").cast(_HISTORY), none).alias("h"))
    found = classify.resolve_status(F.col("banner"), F.col("h"), F.lit("2024-01-01").cast("timestamp"))
    return rows.select("k", "banner", found.alias("s")).select("k", "banner", "s.status", "s.error")


def _home_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing page for each customer, of its orders; each seventh without a status banner."""
    k = F.col("c_custkey")
    event = F.struct(F.date_format("o_orderdate", "MMM d, yyyy").alias("eventDateString"), F.lit("Sold (MLS)").alias("eventDescription"), F.col("o_totalprice").cast("double").alias("price"), F.col("o_orderkey").cast("string").alias("sourceId"), F.lit("MLS").alias("source"))
    told = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.collect_list(event).alias("e"))
    rows = table(spark, sf_dir, "customer").join(told, "c_custkey", "left")
    meta = lambda name, value: F.concat(F.lit(f'<meta name="twitter:text:{name}" content="'), value, F.lit('">'))
    detail = lambda label, value: F.concat(F.lit('<div class="keyDetails-row x"><span class="valueText">'), value, F.lit(f'</span><span class="valueType">{label}</span></div>'))
    text = lambda c: c.cast("string")
    parts = [
        meta("beds", text(k % 6)), meta("baths", text((k % 4 + 1) / 2)), meta("sqft", F.concat(F.lit("1,"), text(k % 900 + 100))), meta("price", F.concat(F.lit("$"), text(k), F.lit(",000"))),
        F.when(k % 7 != 0, F.lit('<div class="a ListingStatusBannerSection b">For <b>sale</b></div>')).otherwise(""), F.concat(F.lit('<div class="full-address street-address">'), text(k), F.lit(" Oak St, Bend, OR 97701</div><section>")),
        detail("Property Type", F.lit("Condo")), detail("Year Built", text(k % 60 + 1950)), detail("Lot Size", F.when(k % 2 == 0, "7,405 sq ft").otherwise("—")), F.lit("</section><script>propertyHistoryInfo = "),
        F.to_json(F.struct(F.col("e").alias("events"))), F.lit(";</script>"),
    ]
    return rows.select(F.concat(F.lit("https://homes.example/OR/Bend/x/home/"), text(k), F.lit("?y")).alias("url"), F.concat(*parts).alias("html")).repartition("url")


@registered("""WITH n AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1)
SELECT c_custkey::VARCHAR AS data_source_id, '97701' AS zip_code, printf('%.1f sqft', (1000 + c_custkey % 900 + 100)::DOUBLE) AS area, 'Condo' AS property_type, CASE WHEN c_custkey % 2 = 0 THEN '7405.0 sqft' END AS lot_area, (c_custkey % 6)::DOUBLE AS bedrooms, ((c_custkey % 4 + 1) / 2)::DOUBLE AS bathrooms,
  (c_custkey % 60 + 1950)::INT AS year_built, 'for sale' AS status, c_custkey * 1000.0::DOUBLE AS price, false AS ready_to_build, coalesce(n, 0)::INT AS history_count FROM customer LEFT JOIN n ON k = c_custkey WHERE c_custkey % 7 <> 0""")
def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored listing pages to raw records: meta tags, key details, lot, banner and embedded history."""
    good, _ = pages.raw_records(_home_pages(spark, sf_dir))
    return good.select("data_source_id", "zip_code", "area", "property_type", "lot_area", "bedrooms", "bathrooms", "year_built", "status", "price", "ready_to_build", "history_count")


@registered("SELECT 'StatusNotFound' AS error_code, 'https://homes.example/OR/Bend/x/home/' || c_custkey || '?y' AS payload FROM customer WHERE c_custkey % 7 = 0")
def page_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.raw_records(_home_pages(spark, sf_dir))[1].select("error_code", "payload")


def _search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A search page for each nation, with its customers as cards, a link outside of them and one to the next page."""
    card = F.concat(F.lit('<div data-rf-test-name="mapHomeCard"><a href="/OR/Bend/home/'), F.col("c_custkey").cast("string"), F.lit('">x</a><a href="/blog">y</a></div>'))
    rows = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.array_join(F.array_sort(F.collect_list(card)), "").alias("cards"))
    n = F.col("c_nationkey").cast("string")
    url = F.when(F.col("c_nationkey") % 3 == 0, F.concat(F.lit("https://homes.example/city/"), n)).otherwise(F.concat(F.lit("https://homes.example/zipcode/98"), F.lpad(n, 3, "0"), F.lit("/page-"), n))
    more = F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit('<a class="n" href="/next/page-'), (F.when(F.col("c_nationkey") % 3 == 0, 1).otherwise(F.col("c_nationkey")) + 1).cast("string"), F.lit('">n</a>'))).otherwise("")
    return rows.select("c_nationkey", url.alias("url"), F.concat(F.lit('<a href="/home/0">no card</a><div id="DesktopBlueprintSearchPage__pageContainer">'), "cards", F.lit("</div>"), more).alias("html"))


@registered("""SELECT 'https://homes.example/OR/Bend/home/' || c_custkey AS property_url, CASE WHEN c_nationkey % 3 = 0 THEN 'https://homes.example/city/' || c_nationkey ELSE 'https://homes.example/zipcode/98' || lpad(c_nationkey::VARCHAR, 3, '0') || '/page-' || c_nationkey END AS from_page_url FROM customer""")
def search_page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.property_links(_search_pages(spark, sf_dir))


@registered("""SELECT DISTINCT c_nationkey, CASE WHEN c_nationkey % 3 = 0 THEN 1 ELSE c_nationkey END::INT AS page_number, CASE WHEN c_nationkey % 2 = 0 THEN '/next/page-' || (CASE WHEN c_nationkey % 3 = 0 THEN 1 ELSE c_nationkey END + 1) END AS next_page, CASE WHEN c_nationkey % 3 = 0 THEN 'meta' ELSE '98' || lpad(c_nationkey::VARCHAR, 3, '0') END AS zip_code FROM customer""")
def search_page_paging(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _search_pages(spark, sf_dir).withColumn("page_number", pages.page_number(F.col("url")))
    return rows.select("c_nationkey", "page_number", pages.next_page(F.col("html"), F.col("page_number")).alias("next_page"), pages.url_zip(F.col("url"), F.lit("meta")).alias("zip_code"))


_FORMS = [("Street", "st"), ("Boulevard", "blvd"), ("Road", "rd"), ("Drive", "dr"), ("Lane", "ln"), ("Court", "ct"), ("Place", "pl"), ("Circle", "cir"), ("Parkway", "pkwy"), ("Trail", "trl")]
_WAYS = [("", ""), (" North", "-n"), (" Southwest", "-sw"), (" East", "-e"), (" NW", "-nw")]


@registered(f"""SELECT c_custkey, c_custkey || '-oak-' || [{", ".join(f"'{b}'" for _, b in _FORMS)}][c_custkey % 10 + 1] || [{", ".join(f"'{b}'" for _, b in _WAYS)}][c_custkey % 5 + 1] || '|'
  || CASE c_custkey % 3 WHEN 1 THEN 'apt-' || (c_custkey % 50) || '|' WHEN 2 THEN 'ste-' || (c_custkey % 50) || '|' ELSE '' END || 'bend|or|97701' AS address_hash FROM customer""")
def address_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suffixes, directions and units in their long forms."""
    k = F.col("c_custkey")
    pick = lambda values, by: F.element_at(F.array(*[F.lit(a) for a, _ in values]), (by + 1).cast("int"))
    unit = F.when(k % 3 == 1, F.concat(F.lit(" Apartment "), (k % 50).cast("string"))).when(k % 3 == 2, F.concat(F.lit(" Suite "), (k % 50).cast("string"))).otherwise("")
    text = F.concat(k.cast("string"), F.lit(" Oak "), pick(_FORMS, k % 10), pick(_WAYS, k % 5), unit, F.lit(", Bend, OR 97701"))
    return address.standardise(table(spark, sf_dir, "customer").select("c_custkey", text.alias("text")), "text").select("c_custkey", F.col("parsed_address.address_hash").alias("address_hash"))


_NAMES = ["Oak", "Old Mill", "166th", "Lake Forest Park", "Crockett", "5th", "Saint Helens"]


@registered(f"""WITH p AS (SELECT c_custkey AS k, [{", ".join(f"'{n.lower().replace(' ', '-')}'" for n in _NAMES)}] AS l, [{", ".join(f"'{b}'" for _, b in _FORMS)}] AS f, [{", ".join(f"'{b}'" for _, b in _WAYS)}] AS w FROM customer)
SELECT k AS c_custkey, CASE WHEN k % 11 = 3 THEN 'intersection' ELSE 'street' END AS kind, CASE WHEN k % 11 <> 3 THEN (k + 99) || '-' ELSE '' END || l[k % 7 + 1] || '-' || f[k % 10 + 1] || w[k % 5 + 1]
  || CASE WHEN k % 11 = 3 THEN '-&-' || l[(k + 2) % 7 + 1] || '-' || f[(k + 3) % 10 + 1] WHEN k % 3 = 1 THEN '|apt-' || (k % 50) WHEN k % 3 = 2 THEN '|ste-' || (k % 50) ELSE '' END || CASE WHEN k % 2 = 0 THEN '|bend' ELSE '|mill-creek' END || '|or|97701' AS address_hash FROM p""")
def address_tagging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streets and intersections with and without commas, read by a model fitted on the labelled words of four customers in five."""
    k = F.col("c_custkey")
    pick = lambda values, by: F.element_at(F.array(*[F.lit(a) for a in values]), (by + 1).cast("int"))
    piece = lambda text, label: F.struct(text.alias("text"), F.lit(label).alias("label"))
    crossing, unit = k % 11 == 3, (k % 11 != 3) & (k % 3 > 0)
    forms, ways = [a for a, _ in _FORMS], [a.strip() for a, _ in _WAYS]
    comma = F.when(k % 4 < 3, ", ").otherwise(" ")
    pieces = [
        F.when(~crossing, piece((k + 99).cast("string"), "number")), piece(pick(_NAMES, k % 7), "name"), piece(pick(forms, k % 10), "suffix"), F.when(k % 5 > 0, piece(pick(ways, k % 5), "direction_after")),
        F.when(crossing, piece(F.lit("&"), "joint")), F.when(crossing, piece(pick(_NAMES, (k + 2) % 7), "name")), F.when(crossing, piece(pick(forms, (k + 3) % 10), "suffix")),
        F.when(unit, piece(F.when(k % 3 == 1, "Apartment").otherwise("Suite"), "unit_word")), F.when(unit, piece((k % 50).cast("string"), "unit")),
        piece(F.concat(comma, F.when(k % 2 == 0, "Bend").otherwise("Mill Creek")), "city"), piece(F.concat(comma, F.lit("OR")), "state"), piece(F.lit("97701"), "zip_code"),
    ]
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.filter(F.array(*pieces), lambda p: p.isNotNull()).alias("pieces"))
    model = address_tags.fit(rows.where("c_custkey % 5 <> 0"))
    told = rows.select("c_custkey", F.array_join(F.transform("pieces", lambda p: p["text"]), " ").alias("text"))
    told = told.repartition(spark.sparkContext.defaultParallelism, "c_custkey")  # decoding takes milliseconds a row, and the table is one small file
    return address_tags.tag(told, "text", model).select("c_custkey", "tagged_address.kind", "tagged_address.address_hash")


@registered(f"""SELECT p.* FROM (SELECT *, (property_id % 6)::INT AS bedrooms, (property_id % 4)::INT AS bathrooms FROM ({PROPERTIES_SQL})) p WHERE city IN ('NATION_1', 'NATION_2', 'NATION_5') AND bedrooms >= 2 AND bathrooms BETWEEN 1 AND 2
  AND EXISTS (SELECT 1 FROM ({EVENTS_SQL}) e WHERE e.property_id = p.owner AND e.event_type IN ('Sold', 'Pending') AND e.event_ts >= TIMESTAMP '2024-01-05' AND e.event_ts <= TIMESTAMP '2024-01-20')""")
def wide_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City, bedrooms, bathrooms and events in a range."""
    rows = properties(spark, sf_dir).withColumns({"bedrooms": (F.col("property_id") % 6).cast("int"), "bathrooms": (F.col("property_id") % 4).cast("int")})
    p = query.Pattern(cities=["NATION_1", "NATION_2", "NATION_5"], bedrooms=(2, None), bathrooms=(1, 2), event_types=["Sold", "Pending"], event_time=(datetime(2024, 1, 5), datetime(2024, 1, 20)))
    return query.find(rows, p, events(spark, sf_dir).withColumnRenamed("property_id", "owner"), key="owner").select(*rows.columns)


def _homes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers as stored properties, orders as their events."""
    k = F.col("c_custkey")
    area = F.struct((k % 3 + 1).cast("decimal(18,4)").alias("value"), F.when(k % 2 == 0, "Acres").otherwise("SquareFeet").alias("unit"))
    rows = table(spark, sf_dir, "customer").select(k.cast("string").alias("property_id"), F.concat(F.lit("home-"), (k % 40).cast("string")).alias("address_hash"), F.when(k % 5 != 0, area).alias("area"), "c_mktsegment", F.when(k % 4 != 0, k % 6).cast("decimal(5,2)").alias("bedrooms"), F.lit(2).cast("decimal(5,2)").alias("bathrooms"), F.lit("Active").alias("status"), F.lit(0).cast("decimal(18,2)").alias("price"), F.lit("2024-01-01").cast("timestamp").alias("last_updated"))
    told = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("property_id"), F.col("o_orderdate").alias("event_ts"), F.lit("Sold").alias("event_type"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"), F.lit("mls").alias("source"), F.col("o_orderkey").cast("string").alias("source_id"), F.lit(None).cast("string").alias("description"))
    return rows, told


_HEAD = "c_custkey || ': home-' || (c_custkey % 40) || ', Active, ' || CASE WHEN c_custkey % 4 <> 0 THEN (c_custkey % 6)::DECIMAL(5,2) ELSE 0::DECIMAL(5,2) END || ' beds, 2.00 baths'"


@registered(f"""SELECT c_custkey::VARCHAR AS property_id, {_HEAD} || coalesce(chr(10) || l, '') AS summary FROM customer LEFT JOIN (SELECT o_custkey, string_agg(strftime(o_orderdate, '%Y-%m-%d') || ' Sold ' || o_totalprice::DECIMAL(18,2), chr(10) ORDER BY o_orderdate, o_totalprice::DECIMAL(18,2), o_orderkey::VARCHAR) AS l FROM orders GROUP BY 1) ON o_custkey = c_custkey WHERE c_custkey % 5 <> 0""")
def text_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query.summaries(*_homes(spark, sf_dir))


@registered("""SELECT c_custkey::VARCHAR AS property_id, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey)::INT AS n_events FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 2 = 0 AND c_custkey % 3 >= 1
  AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '1996-01-01')""")
def large_homes_with_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas from 50,000 square feet, whatever their unit, with a sale since 1996, and their full history."""
    rows, told = _homes(spark, sf_dir)
    found = goals.matching_with_history(rows, told, query.Pattern(event_types=["Sold"], event_time=(datetime(1996, 1, 1), None)), area=(50_000, None))
    return found.select("property_id", F.size("history").alias("n_events"))


@registered("""SELECT c_custkey::VARCHAR AS property_id, NULL::VARCHAR AS price, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey)::INT AS n_events, CASE WHEN c_custkey % 4 <> 0 THEN (c_custkey % 6)::DOUBLE ELSE 0 END AS bedrooms FROM customer WHERE c_custkey % 5 <> 0""")
def nested_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON documents read back."""
    shape = "price double, bedrooms double, history array<struct<event_type: string>>"
    docs = query.as_documents(*_homes(spark, sf_dir)).withColumn("d", F.from_json("document", shape))
    return docs.select("property_id", F.col("d.price").cast("string").alias("price"), F.size("d.history").alias("n_events"), F.col("d.bedrooms").alias("bedrooms"))


@registered("""WITH f AS (SELECT min(c_custkey::VARCHAR) AS id, 'home-' || (c_custkey % 40) AS h FROM customer GROUP BY 2), x AS (SELECT c_custkey, 'home-' || (c_custkey % 40) AS h FROM customer WHERE c_custkey % 3 = 0)
SELECT c_custkey::VARCHAR AS asked, id AS property_id, c_custkey % 2 = 0 AS found_by_id FROM x JOIN f USING (h)""")
def lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By address (of several properties the smallest id) and by id."""
    rows, _ = _homes(spark, sf_dir)
    asked = rows.where(F.col("property_id").cast("int") % 3 == 0).select(F.col("property_id").alias("asked"), "address_hash")
    by_id = query.by_ids(asked.where(F.col("asked").cast("int") % 2 == 0).select(F.col("asked").alias("property_id")), rows).select(F.col("property_id").alias("hit"))
    found = query.by_address(asked, rows.select("property_id", "address_hash"))
    return found.join(by_id, F.col("asked") == F.col("hit"), "left").select("asked", "property_id", F.col("hit").isNotNull().alias("found_by_id"))


@registered("""WITH f AS (SELECT min(o_orderkey) AS id, o_custkey FROM orders GROUP BY 2)
SELECT id AS property_id, 'home-' || f.o_custkey AS address_hash, o_totalprice AS price, 'address' AS asked_by FROM f JOIN orders ON o_orderkey = id WHERE f.o_custkey % 10 = 0
UNION ALL SELECT o_orderkey, 'home-' || o_custkey, o_totalprice, 'id' FROM orders WHERE o_orderkey % 100 = 0""")
def indexed_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as properties of their customers' addresses, indexed, and asked for by id and by address."""
    root = f"{scratch.folder(spark)}/index-{uuid.uuid4().hex}"
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("property_id"), F.concat(F.lit("home-"), F.col("o_custkey").cast("string")).alias("address_hash"), F.col("o_totalprice").alias("price"))
    lookup_index.build(rows, root)
    homes = table(spark, sf_dir, "customer").where("c_custkey % 10 = 0").select(F.concat(F.lit("home-"), F.col("c_custkey").cast("string")).alias("address_hash"))
    found = lookup_index.by_addresses(spark, root, homes).withColumn("asked_by", F.lit("address"))
    return found.unionByName(lookup_index.by_ids(spark, root, rows.where("property_id % 100 = 0").select("property_id")).withColumn("asked_by", F.lit("id")))


@registered("SELECT c_custkey::VARCHAR AS property_id, CASE WHEN c_custkey % 4 = 1 THEN 'Sold' ELSE 'Active' END AS status FROM customer WHERE c_custkey % 7 <> 0")
def table_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some rows overwritten, others deleted."""
    rows = _homes(spark, sf_dir)[0].select("property_id", "status")
    k = F.col("property_id").cast("int")
    (left,) = merge.delete(rows.where(k % 7 == 0), merge.overwrite(rows, rows.where(k % 4 == 1).withColumn("status", F.lit("Sold"))))
    return left


@registered(f"""WITH e AS ({EVENTS_SQL}), o AS (SELECT *, row_number() OVER w AS no FROM e WHERE event_id % 5 <> 0 WINDOW w AS (PARTITION BY property_id ORDER BY event_ts, event_type, price NULLS FIRST, source NULLS FIRST, source_id NULLS FIRST, description)),
n AS (SELECT *, row_number() OVER w AS no FROM e WHERE event_id % 50 <> 1 AND event_id % 5 <> 0 WINDOW w AS (PARTITION BY property_id ORDER BY event_ts, event_type, price NULLS FIRST, source NULLS FIRST, source_id NULLS FIRST, description))
SELECT coalesce(o.property_id, n.property_id) AS property_id, coalesce(o.no, n.no)::INT AS event_no, n.no IS NULL AS gone FROM o FULL JOIN n ON o.property_id = n.property_id AND o.no = n.no
WHERE (o.event_ts, o.event_type, o.price, o.source, o.source_id, o.description) IS DISTINCT FROM (n.event_ts, n.event_type, n.price, n.source, n.source_id, n.description) OR n.no IS NULL""")
def event_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = events(spark, sf_dir).where("event_id % 5 <> 0")
    diff = merge.event_diff(old, old.where("event_id % 50 <> 1"))
    return diff.select("property_id", "event_no", F.col("new_event").isNull().alias("gone"))


@registered("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'HISTORY#' || event_id || '#' || strftime(u, '%Y-%m-%dT%H:%M:%S+00:00') ELSE 'HISTORY#' || event_id || '#' || strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') END AS sk,
  CASE WHEN event_id % 2 = 0 THEN strftime(u, '%Y-%m-%dT%H:%M:%S+00:00') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') END AS event_time FROM (SELECT event_id, ts, timezone('UTC', timezone('America/Los_Angeles', date_trunc('second', ts))) AS u FROM events)""")
def time_zone_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History items with naive Pacific times in key and attribute, planned and rewritten; the plan is empty afterwards."""
    shown = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("event_id") % 2 == 1, "+00:00").otherwise(""))
    items = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("P#"), F.col("user_id").cast("string")).alias("pk"), F.concat(F.lit("HISTORY#"), F.col("event_id").cast("string"), F.lit("#"), shown).alias("sk"), shown.alias("event_time"))
    fixed = repair.apply_time_zone_plan(items, repair.capped(repair.time_zone_plan(items), None))
    left = repair.time_zone_plan(fixed).select("pk", "sk")
    return fixed.join(left, ["pk", "sk"], "left_anti").select("event_id", "sk", "event_time")


@registered("""SELECT c_custkey, 'META#' || (c_custkey % 50) AS sk FROM customer WHERE c_custkey % 2 = 0""")
def keys_without_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that carry a time are found and shortened."""
    k = F.col("c_custkey")
    items = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("P#"), k.cast("string")).alias("pk"), F.concat(F.lit("META#"), (k % 50).cast("string"), F.when(k % 2 == 0, "#2024-01-01T00:00:00").otherwise("")).alias("sk"))
    return repair.strip_time_from_keys(repair.keys_with_time(items)).select("c_custkey", "sk")


@registered("""SELECT c_custkey::VARCHAR AS property_id, 'home-' || (c_custkey % 40) AS address_hash FROM customer WHERE c_custkey % 2 = 0""")
def newest_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of several metadata rows of a property the newest stays."""
    rows = _homes(spark, sf_dir)[0].where(F.col("property_id").cast("int") % 2 == 0).select("property_id", "address_hash", "last_updated")
    twice = rows.withColumn("sk", F.lit("a")).unionByName(rows.withColumns({"last_updated": F.col("last_updated") - F.expr("interval 1 day"), "sk": F.lit("b")}))
    return repair.keep_newest_metadata(twice).where("sk = 'a'").select("property_id", "address_hash")


@registered("""SELECT 'https://homes.example/home/' || c_custkey AS property_url, c_custkey % 5 = 0 AS rejected, CASE WHEN c_custkey % 2 = 0 AND c_custkey % 5 <> 0 THEN c_custkey::VARCHAR END AS property_id FROM customer""")
def url_message_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL messages published and decoded; those with an empty field go to the rejects of either side."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(F.concat(F.lit("https://homes.example/home/"), k.cast("string")).alias("property_url"), F.lit("2024-01-01T00:00:00Z").alias("scraped_at_utc"), F.when(k % 5 != 0, "homes").otherwise(" ").alias("data_source"), F.lit("https://homes.example/city/1").alias("from_page_url"), F.when(k % 2 == 0, k).cast("string").alias("property_id"))
    good, bad = messages.to_url_messages(rows)
    sent, late = messages.url_messages(messages.publishable(good))
    refused = bad.unionByName(late).select(F.get_json_object("payload", "$.property_url").alias("property_url"), F.lit(True).alias("rejected"), F.lit(None).cast("string").alias("property_id"))
    return sent.select("property_url", F.lit(False).alias("rejected"), "property_id").unionByName(refused)


@registered("""WITH r AS (SELECT 'https://homes.example/home/' || (o_orderkey % 500) AS u, o_orderkey::VARCHAR AS id FROM orders WHERE o_orderstatus IN ('O', 'P') AND o_orderkey % 3 = 1 AND o_orderkey % 4 <> 0),
d AS (SELECT 'https://homes.example/home/' || c_custkey AS u FROM customer) SELECT u AS property_url, min(id) AS property_id FROM (SELECT u, id FROM r UNION ALL SELECT u, NULL FROM d) GROUP BY u""")
def discovered_and_rescanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discovered URLs and those of stored properties in scope, once each; the one with an id is preferred."""
    k = F.col("o_orderkey")
    source = F.array(F.struct(k.cast("string").alias("source_id"), F.concat(F.lit("https://homes.example/home/"), (k % 500).cast("string")).alias("source_url"), F.lit("homes").alias("source_name")))
    stored = table(spark, sf_dir, "orders").select(k.cast("string").alias("property_id"), F.when(k % 3 == 1, "WA").otherwise("OR").alias("state"), F.expr("CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'P' THEN 'Pending' ELSE 'Sold' END").alias("status"), F.when(k % 4 != 0, source).otherwise(F.array().cast("array<struct<source_id: string, source_url: string, source_name: string>>")).alias("data_sources"))
    found = table(spark, sf_dir, "customer").select(F.concat(F.lit("https://homes.example/home/"), F.col("c_custkey").cast("string")).alias("property_url"))
    return ingest.distinct_urls(found, ingest.rescan_messages(stored, ["WA"], ["Active", "Pending"], "2024-06-01")).select("property_url", "property_id")


@registered("SELECT strftime(o_orderdate, '%Y%m01') AS scrape_date, count(*) AS n FROM orders WHERE o_orderkey % 9 <> 0 GROUP BY 1")
def archive_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records into the archive by UTC day and read back from it; records without an id are rejected."""
    path = f"{_folder(spark)}/archive"
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("record_key"), F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderkey").cast("string")).alias("data_source_id"), F.date_format("o_orderdate", "yyyy-MM-01'T'HH:mm:ss'Z'").alias("scraped_at"))
    sinks.archive(rows, path)
    return spark.read.schema("data_source_id string, data_source string, scrape_date string").json(path).groupBy("scrape_date").agg(F.count("*").alias("n"))


@registered("SELECT c_custkey, n_name AS city, c_custkey % 3 = 0 AS malformed FROM customer JOIN nation ON c_nationkey = n_nationkey")
def location_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location keys built and parsed; those with a part too few or an unknown type are told apart."""
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    index = keys.location_index(F.lit("WA"), F.col("n_name"), F.lit("98001"), F.lit("Condo"))
    index = F.when(F.col("c_custkey") % 3 == 0, F.replace(index, F.lit("#98001"), F.lit(""))).otherwise(index)
    return rows.select("c_custkey", F.col("n_name").alias("city"), keys.parse_location_index(index, ["Condo"]).alias("p")).select("c_custkey", F.coalesce("p.city", "city").alias("city"), F.col("p").isNull().alias("malformed"))


@registered("SELECT count(*)::BIGINT AS lines, count(*) FILTER (c_custkey % 6 = 0)::BIGINT AS broken FROM customer")
def json_lines_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records written as JSON lines and scanned again; broken lines go to the rejects."""
    path, k = f"{_folder(spark)}/lines", F.col("c_custkey")
    line = F.when(k % 6 == 0, F.concat(F.lit("{broken "), k.cast("string"))).otherwise(F.to_json(F.struct(F.concat(F.lit("home/"), k.cast("string")).alias("url"), k.cast("string").alias("redfinId"))))
    table(spark, sf_dir, "customer").select(line.alias("value")).write.text(path)
    good, bad = parse_lines(read_lines(spark, path).drop("file_name"))
    return good.select(F.lit(0).alias("b")).unionByName(bad.select(F.lit(1).alias("b"))).agg(F.count("*").alias("lines"), F.sum("b").alias("broken"))


_AGREEING = "'home-' || (property_id % 97 + CASE WHEN property_id % 5 = 0 THEN 1 ELSE 0 END)"


@registered(f"""WITH e AS ({EVENTS_SQL}), o AS (SELECT property_id, 'home-' || (property_id % 97) AS address_hash, max(event_ts) AS last_updated FROM e WHERE event_id % 3 <> 2 GROUP BY 1),
n AS (SELECT property_id, {_AGREEING} AS address_hash, max(event_ts) AS last_updated FROM e WHERE event_id % 3 <> 1 GROUP BY 1),
r AS (SELECT property_id FROM o JOIN n USING (property_id) WHERE o.address_hash <> n.address_hash),
m AS (SELECT property_id, count(*) AS n_events FROM (SELECT DISTINCT property_id, event_ts, event_type, price, source, source_id FROM (SELECT * FROM e WHERE event_id % 3 <> 2 UNION ALL SELECT * FROM e WHERE event_id % 3 <> 1 AND property_id NOT IN (SELECT property_id FROM r))) GROUP BY 1)
SELECT property_id, coalesce(o.address_hash, n.address_hash) AS address_hash, CASE WHEN r.property_id IS NOT NULL THEN o.last_updated ELSE greatest(o.last_updated, n.last_updated) END AS last_updated, r.property_id IS NOT NULL AS rejected, n_events
FROM o FULL JOIN n USING (property_id) LEFT JOIN r USING (property_id) JOIN m USING (property_id)""")
def guarded_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping histories of all events; owners whose sides name different addresses are rejected and keep the first side."""
    e = events(spark, sf_dir)
    old, new = e.where("event_id % 3 <> 2"), e.where("event_id % 3 <> 1")
    owners = lambda side, shift: side.groupBy("property_id").agg(F.max("event_ts").alias("last_updated")).withColumn("address_hash", F.concat(F.lit("home-"), (F.col("property_id") % 97 + shift).cast("string")))
    kept, merged, bad = history.merge_guarded(owners(old, F.lit(0)), old, owners(new, F.when(F.col("property_id") % 5 == 0, 1).otherwise(0)), new)
    odd = bad.select(F.get_json_object("payload", "$.property_id").cast("long").alias("property_id"), F.lit(True).alias("rejected"))
    n = merged.groupBy("property_id").agg(F.count("*").alias("n_events"))
    return kept.join(odd, "property_id", "left").join(n, "property_id").select("property_id", "address_hash", "last_updated", F.coalesce("rejected", F.lit(False)).alias("rejected"), "n_events")


@registered("""WITH n AS (SELECT o_custkey AS k, count(*) AS n, sum(o_orderkey) AS told FROM orders GROUP BY 1)
SELECT c_custkey::VARCHAR AS data_source_id, c_custkey || ' Oak St, Bend, OR 97701' AS address, CASE WHEN c_custkey % 2 = 0 THEN (c_custkey % 9 + 1) || '.5 acres' END AS lot_area, 'for sale' AS status, CASE WHEN c_custkey % 3 <> 0 THEN c_custkey % 60 + 1950 END::INT AS year_built,
  c_custkey % 6 = 0 AS ready_to_build, coalesce(n, 0)::INT AS history_count, coalesce(told, 0)::DOUBLE AS told FROM customer LEFT JOIN n ON k = c_custkey""")
def nested_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages with elements in elements of the same name, markup in comments and scripts, a lot among the
    public facts, history rows, and homes that are ready to build."""
    k = F.col("c_custkey")
    row = F.concat(
        F.lit('<div class="PropertyHistoryEventRow x"><div><div class="col-4"><div>on</div><p><b>Jan</b> 5, 2024</p></div></div><div class="description-col"><div class="col-4"><div><div>Listed</div></div></div></div><div class="number price-col"><div>$'),
        F.format_number("o_orderkey", 0), F.lit("</div></div></div>"),
    )
    told = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.array_join(F.collect_list(row), "").alias("rows"))
    parts = [
        F.lit('<!-- <div class="rental-status">Sold</div> --><script>"<div class=rental-status>"</script><div data-rf-test-name="street-address" title="a > b"><div>'), k.cast("string"),
        F.lit(' Oak St</div>, <div>Bend</div>, OR 97701</div><p>WA 98033</p><div class="rental-status"><div>For</div> <div>sale</div></div><div class="keyDetails-row"><div class="valueText"><div>—</div></div><div><span class="valueType">Lot <span>Size</span></span></div></div>'),
        F.when(k % 3 != 0, F.concat(F.lit('<div class="keyDetails-row"><div class="valueText"><div>'), (k % 60 + 1950).cast("string"), F.lit('</div></div><div class="valueType">Year Built</div></div>'))).otherwise(""),
        F.when(k % 2 == 0, F.concat(F.lit('<ul><li class="entryItem"><span class="entryItemContent">Lot Size: <span><span>'), (k % 9 + 1).cast("string"), F.lit(".5</span> acres</span></span></li></ul><script>Ready to build</script>"))).otherwise(""), F.coalesce("rows", F.lit("")),
    ]
    made = table(spark, sf_dir, "customer").join(told, "c_custkey", "left").select(F.concat(F.lit("https://homes.example/OR/Bend/home/"), k.cast("string")).alias("url"), F.concat(*parts).alias("html"))
    good, _ = pages.raw_records(made.repartition("url"))  # small rows grow to pages here: dealt anew to all cores
    total = F.aggregate("history", F.lit(0.0), lambda s, e: s + F.coalesce(e["price"], F.lit(0.0)))
    return good.select("data_source_id", "address", "lot_area", "status", "year_built", "ready_to_build", "history_count", total.alias("told"))


@registered("""SELECT c_custkey, c_custkey || CASE c_custkey % 3 WHEN 0 THEN '-oak-st|apt-' || (c_custkey % 7) WHEN 1 THEN '-oak-st' ELSE '-oak-st|apt-' || (c_custkey % 5) END || '|bend|or|97701' AS address_hash FROM customer""")
def bracketed_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lots in brackets become units, unless a unit is there; other notes in brackets go."""
    k = F.col("c_custkey")
    note = F.when(k % 3 == 0, F.concat(F.lit(" (Lot #"), (k % 7).cast("string"), F.lit(")"))).when(k % 3 == 1, " (Private Lane)").otherwise(F.concat(F.lit(" Apt "), (k % 5).cast("string"), F.lit(" (HS 9)")))
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.concat(k.cast("string"), F.lit("  Oak Street"), note, F.lit(", Bend, OR 97701")).alias("text"))
    return address.standardise(rows, "text").select("c_custkey", F.col("parsed_address.address_hash").alias("address_hash"))


@registered("SELECT 'https://homes.example/home/' || c_custkey AS property_url, CASE WHEN c_custkey % 2 = 0 THEN c_custkey::VARCHAR END AS property_id, 2::BIGINT AS copies FROM customer WHERE c_custkey % 5 <> 0")
def published_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL messages sent to a stream twice, in files of 100, and read back: both copies of a message carry one id."""
    k, path = F.col("c_custkey"), f"{_folder(spark)}/urls"
    rows = table(spark, sf_dir, "customer").select(F.concat(F.lit("https://homes.example/home/"), k.cast("string")).alias("property_url"), F.lit("2024-01-01T00:00:00Z").alias("scraped_at_utc"), F.when(k % 5 != 0, "homes").otherwise(" ").alias("data_source"), F.lit("https://homes.example/city/1").alias("from_page_url"), F.when(k % 2 == 0, k).cast("string").alias("property_id"))
    for _ in range(2):
        messages.publish(rows, path, "urls", 100)
    entries = spark.read.schema("stream string, id string, fields map<string, string>").json(path)
    copies = entries.groupBy("id").agg(F.count("*").alias("copies"), F.any_value("fields").alias("fields"))
    url = messages.kind(F.col("fields")) == "PROPERTY_URL"
    return copies.where(url).select(F.col("fields")["property_url"].alias("property_url"), F.col("fields")["property_id"].alias("property_id"), "copies")
