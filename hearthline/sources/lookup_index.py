"""Lookup tables of properties by id and by address, for readers that ask for few of many.

A version holds the properties by hash buckets of their id, and a second table address hash -> smallest id
by hash buckets of the address. Rows are sorted within their files, which carry Bloom filters of the key.
A lookup of few keys reads the buckets of these keys only, and of their files only the row groups that may
hold them; one of many keys, which would meet every bucket anyway, is a plain join. The count of buckets
is stored with the version and grows with the table, so that a bucket stays about one file in size.

Rows with a null id are not found by any lookup and are left out; those with a null address hash are found
by id alone. Rows that repeat an id are all returned. An index shows the properties as they were when it was built.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from .tables import _files

FEW = 1000  # keys up to here are named to the scan
ROWS_A_BUCKET = 1_000_000


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, path: str, key: str, buckets: int) -> None:
    """Rows of one bucket come together but for buckets beyond the advised partition size, which are split."""
    dealt = rows.withColumn("_bucket", _bucket(F.col(key), buckets)).hint("rebalance", "_bucket").sortWithinPartitions("_bucket", key)
    dealt.write.option(f"parquet.bloom.filter.enabled#{key}", "true").option(f"parquet.bloom.filter.expected.ndv#{key}", str(ROWS_A_BUCKET)).partitionBy("_bucket").parquet(path)


def _versions(spark: SparkSession, root: str) -> list[int]:
    fs, path = _files(spark, root)
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(int(n[2:]) for n in names if n.startswith("v=") and fs.exists(_files(spark, f"{root}/{n}/layout/_SUCCESS")[1]))


def build(properties: DataFrame, root: str, rows_a_bucket: int = ROWS_A_BUCKET) -> int:
    """Write the next version of the index below ``root``; readers see it once its layout is there, which comes last.
    ``properties`` has property_id, address_hash and any other columns but ``_bucket``."""
    spark = properties.sparkSession
    version = (_versions(spark, root) or [0])[-1] + 1
    path, known = f"{root}/v={version}", properties.where(F.col("property_id").isNotNull())
    fs, left = _files(spark, path)
    if fs.exists(left):  # of a build that did not end
        fs.delete(left, True)
    buckets = max(1, -(-known.count() // rows_a_bucket))
    _write(known, f"{path}/by_id", "property_id", buckets)
    addresses = spark.read.schema(known.schema).parquet(f"{path}/by_id").where("address_hash is not null").groupBy("address_hash").agg(F.min("property_id").alias("property_id"))
    _write(addresses, f"{path}/by_address", "address_hash", buckets)
    # the schema travels with the layout, as an empty table has no file that could tell it
    layout = [(buckets, known.schema.json(), addresses.schema.json())]
    spark.createDataFrame(layout, "buckets int, by_id string, by_address string").coalesce(1).write.json(f"{path}/layout")
    return version


def _open(spark: SparkSession, root: str, name: str) -> tuple[DataFrame, int]:
    versions = _versions(spark, root)
    if not versions:
        raise ValueError(f"no index at {root}")
    layout = spark.read.schema("buckets int, by_id string, by_address string").json(f"{root}/v={versions[-1]}/layout").first()
    schema = StructType.fromJson(json.loads(layout[name])).add("_bucket", IntegerType())
    return spark.read.schema(schema).parquet(f"{root}/v={versions[-1]}/{name}"), layout["buckets"]


def _any(tests: list[Column]) -> Column:
    """A balanced tree of ors: the scan takes equalities to its Bloom filters, but no longer list of values."""
    while len(tests) > 1:
        tests = [a | b for a, b in zip(tests[::2], tests[1::2])] + tests[len(tests) // 2 * 2 :]
    return tests[0]


def candidates(spark: SparkSession, root: str, name: str, key: str, asked: DataFrame) -> DataFrame:
    """The rows of an index table that can match ``asked``: for few keys by bucket and key, for many all."""
    table, buckets = _open(spark, root, name)
    keys = asked.where(F.col(key).isNotNull()).select(F.col(key).cast(table.schema[key].dataType).alias(key)).distinct()
    few = keys.select(key, _bucket(F.col(key), buckets)).limit(FEW + 1).collect()
    if len(few) > FEW:
        return table.drop("_bucket")
    if not few:
        return table.limit(0).drop("_bucket")
    here = F.col("_bucket").isin(sorted({b for _, b in few}))
    return table.where(here & _any([F.col(key) == F.lit(k) for k, _ in few])).drop("_bucket")


def by_ids(spark: SparkSession, root: str, ids: DataFrame) -> DataFrame:
    """``ids`` (with property_id) joined to the stored rows."""
    return ids.join(candidates(spark, root, "by_id", "property_id", ids), "property_id")


def by_addresses(spark: SparkSession, root: str, addresses: DataFrame) -> DataFrame:
    """``addresses`` (with address_hash) joined to the row of the smallest id at each address: first the ids, then their rows."""
    found = candidates(spark, root, "by_address", "address_hash", addresses).join(addresses.select("address_hash").distinct(), "address_hash")
    rows = candidates(spark, root, "by_id", "property_id", found).join(found, ["property_id", "address_hash"])
    return addresses.join(rows, "address_hash")
