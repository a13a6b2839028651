"""Histories, merges, records, pages, repairs, sources and streams on small tables."""

import datetime as dt
import json
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hearthline.functions import pages
from hearthline.operators import correction, goals, history, merge, metrics, query, records, repair
from hearthline.schemas import PROPERTIES, PROPERTY_EVENTS
from hearthline.sources import messages, sinks, tables
from hearthline.sources.records import file_range, parse_lines, read_lines
from hearthline.streaming import ingest

T = lambda *a: dt.datetime(*a)
EVENT = "property_id string, event_ts timestamp, event_type string, price decimal(18,2), source string, source_id string, description string"


def ev(owner, day, kind, price=None, source="mls", source_id=None, text="x"):
    return (owner, T(2024, 1, day), kind, None if price is None else Decimal(price), source, source_id, text)


def events(spark, *rows):
    return spark.createDataFrame(list(rows), EVENT)


def kinds(df, owner="p"):
    return [r.event_type for r in history.numbered(df).where(F.col("property_id") == owner).orderBy("event_no").collect()]


def test_event_equality(spark):
    base = events(spark, ev("p", 1, "Listed", 5, None, None))
    same = [ev("p", 1, "Listed", 5, None, None, "other text")]
    other = [ev("p", 2, "Listed", 5, None, None), ev("p", 1, "Sold", 5, None, None), ev("p", 1, "Listed", 6, None, None), ev("p", 1, "Listed", None, None, None), ev("p", 1, "Listed", 5, "mls", None), ev("p", 1, "Listed", 5, None, "9"), ev("q", 1, "Listed", 5, None, None)]
    assert history.only_new(base, events(spark, *same)).count() == 0
    assert history.only_new(base, events(spark, *other)).count() == len(other)


def test_history_merge(spark):
    a = events(spark, ev("p", 9, "Sold", 7), ev("p", 1, "Listed", 5), ev("p", 3, "PriceChange", 4))
    b = events(spark, ev("p", 3, "PriceChange", 4, text="new"), ev("p", 5, "PriceChange", 3), ev("p", 6, "Pending"))
    once = history.merge(a, b)
    assert kinds(once) == ["Listed", "PriceChange", "PriceChange", "Pending", "Sold"]
    assert once.where("description = 'new'").count() == 0
    again = history.merge(once, b)
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, once.collect()), key=repr)
    assert kinds(history.merge(a.limit(0), b)) == kinds(b) and history.merge(a.limit(0), b.limit(0)).count() == 0


META = "property_id string, beds int, status string, price int, last_updated timestamp, data_sources array<struct<source_id: string, source_url: string, source_name: string>>"


@pytest.mark.parametrize(
    ("old", "new", "want"),
    [
        ((3, "Active", 5, 1, [("a", "u", "n")]), (None, "Sold", None, 2, [("a", "v", "n"), ("b", "w", "m")]), (3, "Sold", None, 2, [("a", "v", "n"), ("b", "w", "m")], "merged", False)),
        ((3, "Active", 5, 2, []), (4, "Pending", 6, 1, []), (4, "Pending", 6, 1, [], "merged", True)),
        ((3, "Active", 5, 2, []), (3, "Active", 5, 1, []), (3, "Active", 5, 2, [], "unchanged", False)),
        ((3, "Active", 5, 1, [("a", "u", "n")]), (3, "Active", 5, 2, []), (3, "Active", 5, 2, [("a", "u", "n")], "merged", False)),
        (None, (3, "Active", 5, 2, [("a", "u", "n")]), (3, "Active", 5, 2, [("a", "u", "n")], "inserted", False)),
        ((3, "Active", 5, 1, []), None, (3, "Active", 5, 1, [], "kept", False)),
    ],
)
def test_metadata_merge(spark, old, new, want):
    side = lambda r: spark.createDataFrame([("p", r[0], r[1], r[2], T(2024, 1, r[3]), r[4])] if r else [], META)
    (r,) = merge.merge_metadata(side(old), side(new), kept_if_null=["beds"]).collect()
    assert (r.beds, r.status, r.price, r.last_updated.day, [tuple(s) for s in r.data_sources], r.outcome, r.late_overwrite) == want


def raw(**changes):
    record = {"url": "https://h.example/home/7", "redfinId": "7", "scrapedAt": "2024-05-20T12:00:00Z", "address": "1838 Market St, Kirkland, WA 98033", "area": "2000.0 sqft", "propertyType": "Single-family", "lotArea": "0.25 acres", "numberOfBedroom": 3, "numberOfBathroom": 2.5, "yearBuilt": 2010, "status": "for sale", "price": 750000, "readyToBuildTag": False,
              "history": [{"date": "Jan 5, 2024", "description": "Listed (Active)", "price": 800000, "source": "NWMLS", "mlsNumber": "1"}, {"date": "Feb 5, 2024", "description": "Price Changed", "price": 750000, "source": "NWMLS", "mlsNumber": "1"}, {"date": "Jan 5, 2024", "description": "Listed again", "price": 800000, "source": "nwmls", "mlsNumber": "1"}]}
    record.update(changes)
    return json.dumps({k: v for k, v in record.items() if v != "drop"})


def bad_event(**changes):
    return [{"date": "Jan 5, 2024", "description": "Listed", "price": 1, "source": "s"} | changes]


CASES = [
    (raw(), None), (raw(readyToBuildTag=True), "ReadyToBuildTagEncountered"), (raw(propertyType="Castle"), "UnknownPropertyType"), (raw(propertyType="Vacant land"), "VacantLandEncountered"),
    (raw(url=None), "InvalidPropertyDataType"), (raw(redfinId=None), "InvalidPropertyDataType"), (raw(address=""), "InvalidPropertyDataType"), (raw(scrapedAt=None), "InvalidPropertyDataType"),
    (raw(area=None), "MissingRequiredField"), (raw(yearBuilt=None), "MissingRequiredField"), (raw(status=None), "InvalidPropertyDataType"), (raw(address="nowhere"), "InvalidPropertyAddress"),
    (raw(area="2000"), "InvalidPropertyDataFormat"), (raw(area="x sqft"), "Unexpected"), (raw(area="2 miles"), "UnknownAreaUnit"), (raw(lotArea="9"), "InvalidPropertyDataFormat"), (raw(lotArea="9 miles"), "UnknownAreaUnit"),
    (raw(numberOfBedroom=None), "MissingRequiredField"), (raw(history=bad_event(date=None)), "Unexpected"), (raw(history=bad_event(description="Painted")), "Unexpected"), (raw(history=bad_event(source=None)), "Unexpected"),
    (raw(status="odd"), "UnknownPropertyStatus"), (raw(status="drop"), "UnknownPropertyStatus"), (raw(lotArea=None, price=None, history="drop"), None),
]


def test_record_checks(spark):
    lines = spark.createDataFrame([(c, i) for i, (c, _) in enumerate(CASES)] + [("", 98), ("{broken", 99)], "value string, i int")
    good, unread = parse_lines(lines)
    parsed, bad = records.parse(good)
    assert [r.error_code for r in unread.collect()] == ["InvalidPropertyDataFormat"]
    codes = {r.payload: r.error_code for r in bad.collect()}
    assert [codes.get(c) for c, _ in CASES] == [w for _, w in CASES]
    assert parsed.count() + len(codes) == len(CASES)
    first = parsed.where("size(events) = 2").first()
    assert (first.address_hash, first.status, first.price, first.property_type, first.area.unit, first.lot_area.unit) == ("1838-market-st|kirkland|wa|98033", "Active", Decimal(750000), "SingleFamily", "SquareFeet", "Acres")
    assert [(e.event_type, e.source) for e in first.events] == [("Listed", "nwmls"), ("PriceChange", "nwmls")]


def test_store_is_idempotent_and_streams_agree(spark, tmp_path):
    day2 = raw(scrapedAt="2024-05-21T12:00:00Z", price=700000, status="pending")
    fields = [{"type": "PROPERTY_RAW_DATA", "data": d, "url": "u", "redfinId": "7", "zipCode": "", "scrapedAt": "s", "spiderName": "n"} for d in (raw(), day2, raw(address="9 Oak St, Bend, OR 97701"), raw(status="odd"))]
    entries = [{"stream": "s", "id": str(i), "fields": f} for i, f in enumerate([*fields, {"type": "PROPERTY_RAW_DATA", "data": raw()}, {"type": "TEST"}])]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(map(json.dumps, entries)))
    for run in (1, 2):  # a second stream without the first's checkpoint replays everything
        ingest.ingest(ingest.message_stream(spark, str(tmp_path / "in")), str(tmp_path / "store"), str(tmp_path / f"check{run}")).awaitTermination()
        stored = tables.read(spark, str(tmp_path / "store"), "properties", PROPERTIES)
        happened = tables.read(spark, str(tmp_path / "store"), "property_events", PROPERTY_EVENTS)
        assert sorted((r.city, r.status, int(r.price)) for r in stored.collect()) == [("Bend", "Active", 750000), ("Kirkland", "Pending", 700000)]
        assert happened.count() == 4
        rejected = spark.read.parquet(str(tmp_path / "store" / "rejects"))
        assert sorted(r.error_code for r in rejected.collect()) == ["MalformedMessage", "UnknownPropertyStatus"]
    good, _ = parse_lines(spark.createDataFrame([(f["data"],) for f in fields], "value string"))
    sinks.store(spark, good, str(tmp_path / "batch"))
    batch = tables.read(spark, str(tmp_path / "batch"), "properties", PROPERTIES)
    assert sorted(map(repr, batch.collect())) == sorted(map(repr, stored.collect()))
    found = query.find(stored, query.Pattern(states=["WA"], statuses=["Pending"], price=(1, 800000), bedrooms=(3, None)), happened)
    documents = [json.loads(r.document) for r in query.as_documents(found, happened).collect()]
    assert len(documents) == 1 and [e["event_type"] for e in documents[0]["history"]] == ["Listed", "PriceChange"]
    assert "Pending" in query.summaries(found, happened).first().summary
    asked = ingest.rescan_messages(stored, ["WA", "OR"], ["Active", "Pending"], "2024-06-01")
    good_messages, none = messages.to_url_messages(asked)
    assert good_messages.count() == 2 and none.count() == 0


def test_rescan_and_corrections(spark):
    def added(*rows, seen=T(2024, 3, 1)):
        w = spark.createDataFrame([("p", seen)], "property_id string, seen_at timestamp")
        return [r.event_ts for r in correction.removals_to_add(events(spark, *rows), w).collect()]

    assert added(ev("p", 1, "Listed")) == [T(2024, 3, 1)]
    assert added(ev("p", 1, "Listed"), ev("p", 5, "ListRemoved")) == []
    assert added(ev("p", 1, "ListRemoved"), ev("p", 5, "Listed")) == [T(2024, 3, 1)]
    assert added(ev("p", 5, "ListRemoved"), ev("p", 5, "Listed")) == []
    assert added(ev("p", 1, "Sold")) == []
    assert added(ev("q", 1, "Sold")) == [T(2024, 3, 1)]
    assert added(ev("p", 1, "Sold"), ev("p", 2, "Listed"), ev("p", 9, "ListedForRent")) == [T(2024, 1, 8, 12)]
    assert added(ev("p", 2, "Listed"), ev("p", 9, "ListedForRent")) == [T(2024, 3, 1)]


def test_goals(spark):
    e = events(spark, ev("p", 1, "Listed", 9), ev("p", 2, "PriceChange", 7), ev("p", 3, "PriceChange", 8), ev("p", 4, "Sold", 9), ev("q", 1, "Listed", 5), ev("q", 2, "Sold", 4)).withColumn("event_id", F.monotonically_increasing_id())
    assert [(r.property_id, int(r.price)) for r in goals.price_drops(e).collect()] == [("p", 7)]
    assert [(r.property_id, int(r.list_price)) for r in goals.sold_over_list(e).collect()] == [("p", 8)]
    assert [r.property_id for r in goals.newly_listed(e, T(2024, 1, 1)).orderBy("property_id").collect()] == ["p", "q"]
    assert goals.missing_from_scrape(e.drop("event_id"), e.drop("event_id").where("event_type <> 'Sold'")).count() == 2


PAGE = """<html><head><meta name="twitter:text:beds" content="3"><meta content='2.5' name='twitter:text:baths'><meta name="twitter:text:sqft" content="2,000"><meta name="twitter:text:price" content="$1,250,000"></head>
<body><h1 class="full-address street-address">1838 Market St, <span>Kirkland, WA 98033</span></h1><div class="ListingStatusBannerSection x"><span>For Sale</span></div>
<div class="keyDetails-row"><span class="valueText">Single-family</span><span class="valueType">Property Type</span></div><div class="keyDetails-row"><span class="valueText">1996</span><span class="valueType">Year Built</span></div>
<div class="keyDetails-row"><span class="valueText">2.15 acres</span><span class="valueType">Lot Size</span></div><script>x = {\\"propertyHistoryInfo\\":{\\"events\\":[{\\"eventDateString\\":\\"Jan 5, 2024\\",\\"eventDescription\\":\\"Listed\\",\\"price\\":9,\\"source\\":\\"M\\",\\"sourceId\\":\\"1\\",\\"extra\\":{\\"a\\":1}},{\\"eventDate\\":1704412800000,\\"eventDescription\\":\\"Sold\\"},{\\"price\\":1}]},\\"more\\":{}}</script></body></html>"""
ROWS = """<h1 class="full-address street-address">9 Oak St, Bend, OR 97701</h1><div class="rental-status">Rental Removed</div><div class="PropertyHistoryEventRow"><div class="col-4"><p>Jan 5, 2024</p></div><div class="description-col"><div class="col-4"><div>Listed</div></div><p class="subtext">NWMLS #123</p></div><div class="price-col number">$5,000</div></div>
<div class="PropertyHistoryEventRow"><div class="col-4"><p>Jan 1, 2024</p></div><div class="description-col"><div class="col-4"><div>Sold</div></div></div><div class="price-col number">—</div></div><script>Ready to Build now</script>"""


def test_pages(spark):
    rows = [("https://h.example/WA/K/home/282664", PAGE), ("https://h.example/home/2?x", ROWS), ("https://h.example/about", PAGE), ("https://h.example/home/3", "<p>gone</p>")]
    good, bad = pages.raw_records(spark.createDataFrame(rows, "url string, html string"))
    by = {r.data_source_id: r for r in good.collect()}
    r = by["282664"]
    assert (r.address, r.area, r.property_type, r.lot_area, r.bedrooms, r.bathrooms, r.year_built, r.status, r.price, r.zip_code, r.ready_to_build) == ("1838 Market St, Kirkland, WA 98033", "2000.0 sqft", "Single-family", "2.15 acres", 3.0, 2.5, 1996, "for sale", 1250000.0, "98033", False)
    assert [(e.date, e.description, e.price, e.mlsNumber) for e in r.history] == [("Jan 5, 2024", "Listed", 9.0, "1"), ("Jan 05, 2024", "Sold", None, None)]
    r = by["2"]
    assert [(e.date, e.description, e.price, e.mlsNumber) for e in r.history] == [("Jan 5, 2024", "Listed", 5000.0, "123"), ("Jan 1, 2024", "Sold", None, None)] and r.ready_to_build and r.status == "rental removed"
    assert sorted(b.error_code for b in bad.collect()) == ["AddressNotFound", "InvalidListingUrl"]


def test_search_pages(spark):
    html = """<a href="/out/home/0">no</a><div id="DesktopBlueprintSearchPage__pageContainer"><div data-rf-test-name="mapHomeCard"><a class="b" href="/WA/x/home/1">1</a><a href='/WA/x/home/1'>1</a></div><div data-rf-test-name='mapHomeCard'><a href="https://o.example/home/2">2</a><a href="/ad">ad</a></div></div><a href="/city/page-3">3</a>"""
    df = spark.createDataFrame([("https://h.example/city/page-2", html)], "url string, html string")
    assert sorted(r.property_url for r in pages.property_links(df).collect()) == ["https://h.example/WA/x/home/1", "https://o.example/home/2"]
    r = df.select(pages.page_number(F.col("url")).alias("n"), pages.next_page(F.col("html"), F.lit(2)).alias("next"), pages.url_zip(F.lit("https://h/zipcode/98033/page-2"), F.lit(None)).alias("zip"), pages.absolute(F.lit("b"), F.lit("https://h.example/a/c")).alias("rel")).first()
    assert tuple(r) == (2, "/city/page-3", "98033", "https://h.example/a/b")


def test_repairs(spark):
    items = spark.createDataFrame([("P#1", "HISTORY#2024-01-05T10:00:00#e1", "2024-01-05T10:00:00"), ("P#1", "HISTORY#2024-07-05T10:00:00+00:00#e2", "2024-07-05T10:00:00+00:00"), ("P#2", "HISTORY#2024-07-05T10:00:00#e3", "2024-07-06T10:00:00")], "pk string, sk string, event_time string")
    plan = repair.time_zone_plan(items)
    counts, _ = repair.dry_run(plan)
    assert tuple(counts.first()) == (2, 1)
    fixed = repair.apply_time_zone_plan(items, plan)
    assert {r.event_time for r in fixed.collect()} == {"2024-01-05T18:00:00+00:00", "2024-07-05T10:00:00+00:00", "2024-07-06T17:00:00+00:00"}
    assert repair.time_zone_plan(fixed.where("pk = 'P#1'")).count() == 0
    meta = spark.createDataFrame([("1", "a", T(2024, 1, 1), "M#1"), ("1", "a", T(2024, 1, 2), "M#2"), ("2", "a", T(2024, 1, 1), "M#1"), ("2", "b", T(2024, 1, 2), "M#2"), ("3", "c", T(2024, 1, 1), "M#1")], "property_id string, address_hash string, last_updated timestamp, sk string")
    assert sorted((r.property_id, r.sk) for r in repair.keep_newest_metadata(meta).collect()) == [("1", "M#2"), ("2", "M#1"), ("2", "M#2"), ("3", "M#1")]
    keyed = spark.createDataFrame([("P#1", "M#a#2024"), ("P#2", "M#a#2024"), ("P#2", "M#a#2025"), ("P#3", "M#a")], "pk string, sk string")
    with pytest.raises(ValueError):  # P#2 has two
        repair.keys_with_time(keyed)
    history = spark.createDataFrame([("P#1", "HISTORY#2024#e1"), ("P#1", "HISTORY#2024#e2")], keyed.schema)
    assert [tuple(r) for r in repair.keys_with_time(keyed.where("pk <> 'P#2'").union(history)).collect()] == [("P#1", "M#a#2024")]
    two_keys = spark.createDataFrame([("1", "a", T(2024, 1, 1), "M#1", "P#1"), ("1", "a", T(2024, 1, 2), "M#1", "P#2")], "property_id string, address_hash string, last_updated timestamp, sk string, pk string")
    assert repair.keep_newest_metadata(two_keys).count() == 2
    assert sorted(map(tuple, repair.strip_time_from_keys(keyed).collect())) == [("P#1", "M#a"), ("P#2", "M#a#2024"), ("P#2", "M#a#2025"), ("P#3", "M#a")]


def test_sources(spark, tmp_path):
    for day in (1, 2, 3):
        (tmp_path / f"d{day}.jsonl").write_text(f'{raw(redfinId=str(day))}\n\n{raw(redfinId=None)}\n')
    lines = read_lines(spark, str(tmp_path))
    assert file_range(lines, "d1.jsonl", "d2.jsonl").select("file_name").distinct().count() == 2
    assert file_range(lines, "d2.jsonl", "d1.jsonl").count() == 0 and file_range(lines, "d0.jsonl", "d2.jsonl").count() == 0
    bad = sinks.backfill_archive(spark, str(tmp_path), "d1.jsonl", "d3.jsonl", str(tmp_path / "archive"))
    assert bad.count() == 3 and spark.read.json(str(tmp_path / "archive")).where("scrape_date = 20240520").count() == 3
    fields = "fields map<string, string>"
    urls = spark.createDataFrame([({"property_url": "u", "scraped_at_utc": "t", "data_source": "d", "from_page_url": "f"},), ({"property_url": "u", "scraped_at_utc": "", "data_source": "d", "from_page_url": "f"},), ({},)], fields)
    good, rejected = messages.url_messages(urls)
    assert (good.count(), rejected.count(), messages.publishable(urls).count()) == (1, 2, 2)
    kinds_ = spark.createDataFrame([({"type": "PROPERTY_URL"},), ({"type": "x"},), ({},)], fields).select(messages.kind(F.col("fields")).alias("k"))
    assert [r.k for r in kinds_.collect()] == ["PROPERTY_URL", "UNKNOWN", "UNKNOWN"]
    assert sorted(r.url for r in tables.seeds(spark, "https://h.example", ["98033"], ["/city/1/WA/Kirkland"]).collect()) == ["https://h.example/city/1/WA/Kirkland", "https://h.example/zipcode/98033"]
    ids = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "property_id string, seq int")
    table = spark.createDataFrame([("a",), ("b",), ("c",)], "property_id string")
    assert [[r.property_id for r in tables.resume_after(ids, table, last).collect()] for last in (None, "a", "z")] == [["a", "b", "c"], ["b", "c"], []]
    both = ingest.distinct_urls(spark.createDataFrame([("u",), ("v",)], "property_url string"), spark.createDataFrame([("u", "1")], "property_url string, property_id string"))
    assert sorted(map(tuple, both.collect()), key=repr) == [("u", "1"), ("v", None)]
    assert metrics.newest_n(spark.createDataFrame([(1, 1), (2, 2), (2, 3)], "ts int, event_id int"), 2).count() == 2


def test_a_merge_wants_one_address(spark):
    """Owners that agree are merged and get the latest time; one that does not keeps what it had."""
    who = "property_id string, address_hash string, last_updated timestamp"
    old = spark.createDataFrame([("p", "a", T(2024, 1, 1)), ("q", "b", T(2024, 1, 1)), ("r", None, T(2024, 1, 3)), ("s", "d", T(2024, 1, 1))], who)
    new = spark.createDataFrame([("p", "a", T(2024, 2, 1)), ("p", "a", T(2024, 1, 9)), ("q", "other", T(2024, 2, 1)), ("r", None, T(2024, 1, 2)), ("s", None, T(2024, 2, 1)), ("t", "e", T(2024, 2, 2)), ("u", "f", T(2024, 2, 2)), ("u", "g", T(2024, 2, 2))], who)
    mine = events(spark, ev("p", 1, "Listed", 9), ev("q", 1, "Listed", 5), ev("s", 1, "Listed", 5))
    theirs = events(spark, ev("p", 1, "Listed", 9), ev("p", 2, "Sold", 8), ev("q", 2, "Sold", 4), ev("s", 2, "Sold", 4), ev("t", 2, "Sold", 4), ev("u", 2, "Sold", 4), ev("x", 2, "Sold", 4))
    owners, merged, bad = history.merge_guarded(old, mine, new, theirs)
    assert sorted(map(tuple, owners.collect())) == [("p", "a", T(2024, 2, 1)), ("q", "b", T(2024, 1, 1)), ("r", None, T(2024, 1, 3)), ("s", "d", T(2024, 1, 1)), ("t", "e", T(2024, 2, 2))]
    assert sorted(r.property_id for r in merged.collect()) == ["p", "p", "q", "s", "t", "x"]
    assert sorted(json.loads(r.payload)["property_id"] for r in bad.collect()) == ["q", "s", "u"] and {r.error_code for r in bad.collect()} == {"AddressMismatch"}
    none = history.merge_guarded(old.limit(0), mine.limit(0), new.limit(0), theirs.limit(0))
    assert [df.count() for df in none] == [0, 0, 0]


def test_publish_and_read_back(spark, tmp_path):
    rows = spark.createDataFrame([("u1", "t", "d", "f", None), ("u2", "t", "d", "f", "7"), ("u3", "t", " ", "f", None)], "property_url string, scraped_at_utc string, data_source string, from_page_url string, property_id string")
    for _ in (1, 2):
        assert messages.publish(rows.coalesce(1), str(tmp_path / "urls"), "urls", 1).count() == 1
    assert len(list((tmp_path / "urls").glob("*.json"))) == 4
    back = spark.read.schema("stream string, id string, fields map<string, string>").json(str(tmp_path / "urls"))
    assert back.select("id").distinct().count() == 2
    good, bad = messages.url_messages(back.where(messages.kind(F.col("fields")) == "PROPERTY_URL"))
    assert sorted((r.property_url, r.property_id) for r in good.distinct().collect()) == [("u1", None), ("u2", "7")] and bad.count() == 0
    with pytest.raises(TypeError):
        messages.publishable(spark.createDataFrame([([1],)], "fields array<int>"))
    assert messages.publishable(spark.createDataFrame([({"a": None},), ({"a": "1"},)], "fields map<string, string>")).count() == 1


def test_scan_queries_are_pairs(spark):
    sources = "array<struct<source_id: string, source_url: string, source_name: string>>"
    stored = spark.createDataFrame([("1", "WA", "Active", [("1", "u1", "d")]), ("2", "WA", "Pending", [("2", "u2", "d")]), ("3", "OR", "Pending", [("3", "u3", "d")]), ("4", "OR", "Active", [("4", "u4", "d")]), ("5", "WA", "Active", []), ("6", None, None, [("6", "u6", "d")])], f"property_id string, state string, status string, data_sources {sources}")
    asked = ingest.rescan_queries(stored, [("WA", "Active"), ("OR", "Pending"), ("WA", "Active")], "2024-06-01")
    assert sorted(r.property_id for r in asked.collect()) == ["1", "3"]
    assert ingest.rescan_queries(stored, [], "2024-06-01").count() == 0
    with pytest.raises(ValueError):
        ingest.rescan_queries(stored, [("WA", "Odd")], "2024-06-01")


def test_backfills_stop_at_a_cap(spark, tmp_path):
    for day in (1, 2):
        (tmp_path / f"d{day}.jsonl").write_text("\n".join(raw(redfinId=f"{day}{k}", address=f"{day}{k} Oak St, Bend, OR 97701") for k in range(3)) + "\nbroken\n")
    bad = sinks.backfill_store(spark, str(tmp_path / "*.jsonl"), "d1.jsonl", "d2.jsonl", str(tmp_path / "store"), 4)
    assert bad.count() == 2
    stored = tables.read(spark, str(tmp_path / "store"), "properties", PROPERTIES).collect()
    assert len(stored) == 4 and sum(r.address.street.startswith("1") for r in stored) == 3
    sinks.backfill_archive(spark, str(tmp_path / "*.jsonl"), "d1.jsonl", "d2.jsonl", str(tmp_path / "archive"), 2)
    assert {r.data_source_id for r in spark.read.schema("data_source_id string").json(str(tmp_path / "archive")).collect()} <= {"10", "11", "12"}


NESTED = """<!-- <div class="ListingStatusBannerSection">Sold</div> --><script>var t = "<div class='ListingStatusBannerSection'>Pending</div>";</script>
<div data-rf-test-name="street-address" title="a > b"><div>12 Oak St</div><div>, <div>Bend</div>, OR 97701</div></div><p>not the address, WA 98033</p>
<div class="x ListingStatusBannerSection"><div><div>For</div> sale</div></div> 2 < 3 <div class="keyDetails-row"><div class="valueText"><div>7,405</div> <div>sq ft</div></div><div><span class="valueType">Lot <span>Size</span></span></div></div>
<div class="keyDetails-row"><span class="valueType">Year Built</span></div><span class="valueText">1900</span><script type='x'>READY to build</script>
<section><div class='PropertyHistoryEventRow a'><div><div class="col-4"><div>x</div><p>Jan <b>5</b>, 2024</p></div></div><div class="description-col col-4"><div class="col-4"><div><div>Listed</div> again</div></div><p class="subtext">NWMLS <i>#12</i></p></div><div class="number price-col"><div>$5,000</div></div></div><p>Feb 1, 2024</p>
<div class="PropertyHistoryEventRow"><div class="col-4"></div></div></section>"""


def test_elements_end_where_they_end(spark):
    fact = NESTED.replace("7,405", "—").replace("<div>sq ft</div>", "").replace("<section>", """<section><li class="entryItem"><span class="entryItemContent">Size: <span>9</span></span></li><li class="a entryItem"><span class="entryItemContent">Lot Size: <span><span>1.5</span> Acres</span></span></li>""")
    behind = fact.replace("Lot Size: <span><span>1.5</span> Acres</span></span>", "Lot Size: </span><span>2 acres</span>")
    rows = [("https://h.example/home/1", NESTED), ("https://h.example/home/2", fact), ("https://h.example/home/3", behind), ("https://h.example/home/4", ""), ("https://h.example/home/5", None), ("https://h.example/home/6", "<div class='ListingStatusBannerSection'>For sale<h1 class='full-address street-address'>9 Oak St, Bend, OR 97701")]
    good, bad = pages.raw_records(spark.createDataFrame(rows, "url string, html string"))
    by = {r.data_source_id: r for r in good.collect()}
    r = by["1"]
    assert (r.address, r.status, r.lot_area, r.year_built, r.ready_to_build) == ("12 Oak St, Bend, OR 97701", "for sale", "7405.0 sqft", None, True)
    assert [(e.date, e.description, e.price, e.mlsNumber) for e in r.history] == [("Jan 5, 2024", "Listed again", 5000.0, "12")]
    assert (by["2"].lot_area, by["3"].lot_area) == ("1.5 Acres", "2.0 acres")
    assert by["6"].address == "9 Oak St, Bend, OR 97701" and by["6"].status == "for sale9 oak st, bend, or 97701"
    assert sorted(b.payload[-1] for b in bad.collect()) == ["4", "5"]


def test_cards_end_with_their_container(spark):
    html = """<div id="DesktopBlueprintSearchPage__pageContainer"><div><div class="c" data-rf-test-name="mapHomeCard"><div><a href="/home/1">1</a></div><a href="/home/2">2</a></div><a href="/home/3">between</a></div><!-- <div data-rf-test-name="mapHomeCard"><a href="/home/4">4</a></div> --></div><div data-rf-test-name="mapHomeCard"><a href="/home/5">outside</a></div>"""
    df = spark.createDataFrame([("https://h.example/x", html), ("https://h.example/y", None), ("https://h.example/z", "<a href='/home/6'>no container</a>")], "url string, html string")
    assert sorted(r.property_url[-1] for r in pages.property_links(df).collect()) == ["1", "2"]
    parts = df.limit(1).select(pages.pieces(F.col("html")).alias("p")).first().p
    assert "".join(parts) == html


def test_cutting_a_page_grows_with_the_page(spark):
    """Thousands of cards and history rows on one page; a pass that copied what it had found took minutes."""
    card = '<div data-rf-test-name="mapHomeCard"><a href="/home/%d">x</a></div>'
    html = '<div id="DesktopBlueprintSearchPage__pageContainer">' + "".join(card % k for k in range(40_000)) + "</div>"
    row = '<div class="PropertyHistoryEventRow"><div class="col-4"><p>Jan 5, 2024</p></div><div class="description-col"><div class="col-4"><div>Listed</div></div></div><div class="price-col number">$%d</div></div>'
    listing = "<h1 class='full-address street-address'>9 Oak St, Bend, OR 97701</h1><div class='rental-status'>for sale</div>" + "".join(row % k for k in range(5_000))
    start = time.monotonic()
    assert pages.property_links(spark.createDataFrame([("https://h.example/x", html)], "url string, html string")).count() == 40_000
    good, _ = pages.raw_records(spark.createDataFrame([("https://h.example/home/1", listing)], "url string, html string"))
    r = good.select("history_count", F.aggregate("history", F.lit(0.0), lambda s, e: s + e["price"]).alias("told")).first()
    assert (r.history_count, r.told) == (5_000, sum(range(5_000))) and time.monotonic() - start < 60
