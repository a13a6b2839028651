"""URLs once a run, dead letters, counters."""

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from hearthline.operators import metrics
from hearthline.schemas import PROPERTIES
from hearthline.sources import sinks, tables
from hearthline.streaming import ingest, letters
from tests.test_listings import PAGE, raw

NOW = datetime(2024, 6, 1)


def message(data, number):
    return json.dumps({"stream": "s", "id": str(number), "fields": {"type": "PROPERTY_RAW_DATA", "data": data, "url": "u", "redfinId": "7", "zipCode": "", "scrapedAt": "s", "spiderName": "n"}})


def url(address, number, **changes):
    return json.dumps({"stream": "s", "id": str(number), "fields": {"type": "PROPERTY_URL", "property_url": address, "scraped_at_utc": "2024-05-20T12:00:00Z", "data_source": "d", "from_page_url": "f"} | changes})


def test_a_url_comes_once_in_a_run_and_after_a_restart(spark, tmp_path):
    (tmp_path / "in").mkdir()
    a, b = "https://h.example/WA/K/home/1", "https://h.example/WA/K/home/2"
    pages = spark.createDataFrame([(a, PAGE), (b, PAGE)], "url string, html string")
    run = lambda: ingest.pages_to_records(ingest.message_stream(spark, str(tmp_path / "in"), 1), pages, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    (tmp_path / "in" / "1.json").write_text("\n".join([url(a, 1), url(a, 2), url(a, 3, scraped_at_utc="")]))
    (tmp_path / "in" / "2.json").write_text("\n".join([url(a, 4), url(a, 5, scraped_at_utc="")]))
    run()
    (tmp_path / "in" / "3.json").write_text("\n".join([url(a, 6), url(b, 7)]))
    run()
    ids = [json.loads(r.data)["redfinId"] for r in spark.read.json(str(tmp_path / "out")).collect()]
    assert sorted(ids) == ["1", "2"]
    assert spark.read.parquet(str(tmp_path / "out-log" / "rejects")).where("error_code = 'MalformedMessage'").count() == 2  # messages that are none stay


def test_letters_wait_longer_rest_and_go_once_mended(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text("\n".join([message(raw(status="odd"), 1), message(raw(status="odd"), 2), message(raw(address="9 Oak St, Bend, OR 97701"), 3), message("{broken", 4)]))
    root = str(tmp_path / "store")
    ingest.ingest(ingest.message_stream(spark, str(tmp_path / "in")), root, str(tmp_path / "check"), now=NOW).awaitTermination()
    told = lambda: {r.error_code: (r.attempts, r.next_try, r.state) for r in letters.read(spark, root).collect()}
    first = NOW + timedelta(seconds=letters.WAIT)
    assert told() == {"UnknownPropertyStatus": (1, first, "waiting"), "InvalidPropertyDataFormat": (1, first, "waiting")}
    assert letters.retry(spark, root, NOW, "early") == 0  # not due yet
    assert letters.retry(spark, root, first, "second") == 2
    assert {v[:2] for v in told().values()} == {(2, first + timedelta(seconds=2 * letters.WAIT))}
    failed = letters.read(spark, root).select("letter_key", "fields", "error_code")
    letters.record(spark, root, failed, first, "second")  # the same delivery again does not count
    assert {v[0] for v in told().values()} == {2}
    later = NOW + timedelta(days=1)
    assert letters.retry(spark, root, later, "third") == 2
    assert {v[2] for v in told().values()} == {"resting"} and letters.retry(spark, root, later + timedelta(days=9), "fourth") == 0
    good = F.create_map(*[F.lit(x) for pair in json.loads(message(raw(), 1))["fields"].items() for x in pair])
    letters.mend(spark, root, letters.read(spark, root).where("error_code = 'UnknownPropertyStatus'").select("letter_key", good.alias("fields")))
    assert [letters.retry(spark, root, later, f"after {k}") for k in range(2)] == [1, 0]
    assert set(told()) == {"InvalidPropertyDataFormat"}
    assert sorted(r.city for r in tables.read(spark, root, "properties", PROPERTIES).collect()) == ["Bend", "Kirkland"]


def test_counters_by_the_way(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text("\n".join([message(raw(), 1), message(raw(status="odd"), 2), message(raw(area=None), 3), json.dumps({"stream": "s", "id": "9", "fields": {"type": "TEST"}}), json.dumps({"stream": "s", "id": "8", "fields": {"type": "x"}})]))
    root = str(tmp_path / "store")
    query = ingest.ingest(ingest.message_stream(spark, str(tmp_path / "in")), root, str(tmp_path / "check"), now=NOW)
    query.awaitTermination()
    scan = raw(propertyId=tables.read(spark, root, "properties", PROPERTIES).first().property_id, status="sold")
    (tmp_path / "in" / "2.json").write_text(message(scan, 5))
    ingest.ingest(ingest.message_stream(spark, str(tmp_path / "in")), root, str(tmp_path / "check"), now=NOW).awaitTermination()
    rows = {(r.stage, r.outcome): r.n for r in spark.read.schema(metrics.COUNTERS).parquet(f"{root}/counters/*").groupBy("stage", "outcome").agg(F.sum("n").alias("n")).collect()}
    assert rows == {("message", "received"): 6, ("message", "PROPERTY_RAW_DATA"): 4, ("message", "TEST"): 1, ("message", "UNKNOWN"): 1, ("listing", "received"): 3, ("listing", "passed"): 1, ("listing", "UnknownPropertyStatus"): 1, ("listing", "MissingRequiredField"): 1, ("rescan", "received"): 1, ("rescan", "passed"): 1, ("written", "properties"): 2, ("written", "property_events"): 2}
    assert [r.input_rows for r in metrics.progress(query).collect() if r.input_rows] == [5]


def test_a_retry_pairs_letters_with_their_rejects_by_key(spark, tmp_path, monkeypatch):
    """Every letter was compared with every reject before, which ended for some hundreds of them only."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text("\n".join(message(raw(status="odd", redfinId=str(k)), k) for k in range(50)))
    root, plans = str(tmp_path / "store"), []
    ingest.ingest(ingest.message_stream(spark, str(tmp_path / "in")), root, str(tmp_path / "check"), now=NOW).awaitTermination()
    stash = letters.stash
    monkeypatch.setattr(letters, "stash", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), stash(df))[1])
    assert letters.retry(spark, root, NOW + timedelta(days=1), "second") == 50
    assert len(plans) == 2 and not [p for p in plans if "NestedLoop" in p or "Cartesian" in p]
    assert {(r.attempts, r.error_code) for r in letters.read(spark, root).collect()} == {(2, "UnknownPropertyStatus")}


def test_records_without_an_id_do_not_meet_in_one_task(spark):
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        sent = spark.range(1000).select(F.col("id").cast("string").alias("record_key"), F.when(F.col("id") < 3, F.concat(F.lit("p"), "id")).alias("property_id"))
        stored = spark.createDataFrame([("p1",), ("none 7",)], "property_id string")
        left = sinks.unstored(sent, stored).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(int(r.record_key) for r in left) == [k for k in range(1000) if k != 1]
    assert len({r.task for r in left}) > 1
