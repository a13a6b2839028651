"""The index by id and address: against joins, on odd rows, and by what its scans read."""

import pytest
from pyspark.sql import functions as F

from hearthline.sources import lookup_index

SHAPE = "property_id string, address_hash string, price long"


def metric(df, name):
    """A metric of the one scan of a plan, once it has run."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    assert leaves.size() == 1
    return leaves.apply(0).metrics().apply(name).value()


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    root = f"file://{tmp_path_factory.mktemp('index')}"
    rows = spark.range(40_000).select(F.concat(F.lit("P"), "id").alias("property_id"), F.concat(F.lit("a"), (F.col("id") % 15_000).cast("string")).alias("address_hash"), F.col("id").alias("price"))
    lookup_index.build(rows, root, rows_a_bucket=400)  # 100 buckets
    return root, rows


def test_a_lookup_of_few_reads_the_files_of_their_buckets(spark, index):
    root, rows = index
    ids = rows.where("price % 800 = 3").select("property_id")  # 50
    some = lookup_index.candidates(spark, root, "by_id", "property_id", ids)
    buckets = ids.select(lookup_index._bucket(F.col("property_id"), 100)).distinct().count()
    whole = len(some.inputFiles())
    assert 0 < metric(some, "numFiles") <= buckets * 1.2 and whole >= 100
    assert metric(some, "numOutputRows") <= 50 * 500  # not the 40,000 rows of the table
    assert sorted(r.price for r in lookup_index.by_ids(spark, root, ids).collect()) == list(range(3, 40_000, 800))


def test_keys_that_are_not_there_are_skipped_by_bloom_filters(spark, index):
    root, _ = index
    absent = spark.range(40).select(F.concat(F.lit("P1"), "id", F.lit("x")).alias("property_id"))  # between the stored ids
    none = lookup_index.candidates(spark, root, "by_id", "property_id", absent)
    assert metric(none, "numFiles") > 0 and metric(none, "numOutputRows") <= 3 * 500
    assert lookup_index.by_ids(spark, root, absent).count() == 0


def test_addresses_give_their_smallest_id(spark, index):
    root, rows = index
    asked = rows.where("price % 3001 = 0").select("address_hash", F.col("price").alias("no"))
    first = rows.groupBy("address_hash").agg(F.min("property_id").alias("property_id"))
    want = asked.join(first, "address_hash").select("no", "property_id")
    got = lookup_index.by_addresses(spark, root, asked).select("no", "property_id")
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() == asked.count()


def test_many_keys_are_joined(spark, index):
    root, rows = index
    many = rows.where("price % 7 = 0").select("property_id")
    assert many.count() > lookup_index.FEW
    assert lookup_index.by_ids(spark, root, many).count() == many.count()


def test_odd_rows_and_versions(spark, tmp_path):
    root = f"file://{tmp_path}"
    with pytest.raises(ValueError):
        lookup_index.by_ids(spark, root, spark.createDataFrame([("P1",)], "property_id string"))
    ask = spark.createDataFrame([("P1",), (None,), ("P9",), ("P1",)], "property_id string")
    at = spark.createDataFrame([("x",), (None,), ("",)], "address_hash string")
    lookup_index.build(spark.createDataFrame([], SHAPE), root)
    assert lookup_index.by_ids(spark, root, ask).count() == 0 and lookup_index.by_addresses(spark, root, at).count() == 0
    rows = [("P1", "x", 1), ("P1", "x", 1), ("P2", None, 2), (None, "x", 3), ("P0", "", 4)]
    lookup_index.build(spark.createDataFrame(rows, SHAPE), root, rows_a_bucket=2)
    assert sorted(lookup_index.by_ids(spark, root, ask).collect()) == [("P1", "x", 1)] * 4  # asked for twice, there twice
    assert sorted(r.property_id for r in lookup_index.by_addresses(spark, root, at).collect()) == ["P0", "P1", "P1"]
    (tmp_path / "v=3" / "by_id").mkdir(parents=True)  # a build that died does not count, and the next takes its place
    assert lookup_index.by_ids(spark, root, ask).count() == 4
    assert lookup_index.build(spark.createDataFrame(rows[:1], SHAPE), root) == 3
    assert lookup_index.by_ids(spark, root, ask).count() == 2
