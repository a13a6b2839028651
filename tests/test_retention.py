"""Retention by bins of time against a whole sort, with ties, nulls and files."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hearthline.operators import metrics

START = datetime(2024, 1, 1)


def newest(rows, n):
    """Brute force: all rows not older than the n-th newest; nulls are the oldest."""
    key = lambda r: tuple((v is not None, v if v is not None else 0) for v in (r[0] and r[0].timestamp(), r[1]))
    order = sorted(rows, key=key, reverse=True)
    if n <= 0 or n >= len(rows):
        return sorted(order[:0] if n <= 0 else order, key=repr)
    return sorted((r for r in rows if key(r) >= key(order[n - 1])), key=repr)


@pytest.fixture(params=[100_000, 40])
def sorted_at_most(request, monkeypatch):
    monkeypatch.setattr(metrics, "SORTED", request.param)
    monkeypatch.setattr(metrics, "BINS", 4)


def test_equals_a_whole_sort(spark, sorted_at_most):
    draw = random.Random(1)
    rows = [(START + timedelta(microseconds=draw.choice([5, 6, 10**6, 10**12]) * draw.randrange(9)), draw.choice([None, *range(30)])) for _ in range(300)]
    rows += [(START, k) for k in range(150)] + [(START, 7)] * 40 + [(None, k % 9) for k in range(50)]  # a crowd at one instant, rows alike
    df = spark.createDataFrame(rows, "ts timestamp, event_id long").repartition(3)
    for n in (0, 60, 340, 520, 600):
        assert sorted(map(tuple, metrics.newest_n(df, n).collect()), key=repr) == newest(rows, n), n


def test_times_of_other_types(spark, sorted_at_most):
    for shape, rows in (("ts int, event_id string", [(k % 40 - 20, str(k)) for k in range(200)]), ("ts double, event_id int", [(k / 8 - 9, k % 3) for k in range(200)]), ("ts long, event_id int", [(k << 54, k) for k in range(-200, 200)])):
        df = spark.createDataFrame(rows, shape)
        for n in (77,):
            assert sorted(map(tuple, metrics.newest_n(df, n).collect())) == sorted(sorted(rows)[-n:]), (shape, n)
    naive = spark.createDataFrame([(START + timedelta(days=k), k) for k in range(50)], "ts timestamp_ntz, event_id int")
    assert sorted(r.event_id for r in metrics.newest_n(naive, 20).collect()) == list(range(30, 50))


def test_empty(spark):
    none = spark.createDataFrame([], "ts timestamp, event_id long")
    assert metrics.newest_n(none, 3).count() == 0 and metrics.retention_cut(none, 3) is None


def test_the_cut_reaches_the_scan(spark, tmp_path):
    rows = spark.range(200_000).select(F.timestamp_micros(F.col("id") * 1_000_000).alias("ts"), F.col("id").alias("event_id"))
    rows.repartitionByRange(8, "ts").write.parquet(f"{tmp_path}/in")
    low, cut = metrics.retention_cut(spark.read.parquet(f"{tmp_path}/in"), 150_000)
    kept = metrics.newest_n(spark.read.parquet(f"{tmp_path}/in"), 150_000)
    assert cut.first()[0].event_id == 50_000 and kept.count() == 150_000
    assert "GreaterThanOrEqual(ts," in kept._jdf.queryExecution().executedPlan().toString()


def test_whole_files_go(spark, tmp_path):
    path = f"file://{tmp_path}/stream of days"
    rows = [(START + timedelta(days=k // 10, hours=k % 10), k) for k in range(100)]
    df = spark.createDataFrame(rows, "ts timestamp, event_id long")
    df.withColumn("day", F.to_date("ts")).repartition("day").write.partitionBy("day").parquet(path)
    assert metrics.drop_old_files(spark.read.parquet(path), 500) == 0
    assert metrics.drop_old_files(spark.read.parquet(path), 35) == 60  # the fourth day from the end holds the cut
    assert sorted(r.event_id for r in spark.read.parquet(path).collect()) == list(range(60, 100))
    assert metrics.drop_old_files(spark.read.parquet(path), 35) == 0
