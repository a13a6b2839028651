"""Versioned tables: a job writes version N + 1 and then moves a pointer; readers follow the pointer.

Plain Parquet has no MERGE, and a path that is being read must not be overwritten. A single table is
written whole (``write``). The store of properties and events grows by parts instead: each commit
adds the changed properties and the new events, and one manifest, which a rename puts in place, names
the parts of both tables, so that readers see both or neither. The newest row of a property counts.
Four parts of about one size become one, so that a row is rewritten a few times in all however many
batches follow, and the parts stay few.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITIONS = {"properties": ["state", "status"]}
MANIFESTS = "_manifests"
KEYS = {"properties": "property_id", "property_events": None}  # of rows with one key the newest counts; events are never changed
BUCKETS, FAN, SMALL = 16, 4, 1000


@dataclass(frozen=True)
class Snapshot:
    """One state of the store: parts by table (path, rows), and the last batch of each stream that is in it."""

    version: int = 0
    parts: dict[str, list[dict]] = field(default_factory=dict)
    done: dict[str, int] = field(default_factory=dict)


def _versions(spark: SparkSession, root: str, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    done = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(v[2:]) for v in done if v.startswith("v=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}/{v}/_SUCCESS")))


def _files(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _manifests(spark: SparkSession, root: str) -> list[int]:
    fs, path = _files(spark, f"{root}/{MANIFESTS}")
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def snapshot(spark: SparkSession, root: str, version: int | None = None) -> Snapshot:
    """The newest committed state (or an earlier one); before the first an empty one."""
    versions = _manifests(spark, root)
    if not versions:
        return Snapshot()
    row = spark.read.text(f"{root}/{MANIFESTS}/{version or versions[-1]}.json", wholetext=True).first()
    return Snapshot(**json.loads(row[0]))


def contents(spark: SparkSession, root: str, name: str, schema: str, at: Snapshot) -> DataFrame:
    """A table of the store as of a snapshot, with ``bucket`` to prune by."""
    parts = at.parts.get(name, [])
    if not parts:
        return spark.createDataFrame([], f"{schema}, bucket int")
    rows = _union([spark.read.schema(f"{schema}, _version long, bucket int").parquet(f"{root}/{p['path']}") for p in parts])
    if (key := KEYS[name]) and len(parts) > 1:
        rows = rows.groupBy(key).agg(F.max_by(F.struct("*"), "_version").alias("r")).select("r.*")
    return rows.drop("_version")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def bucket(key: str = "property_id"):
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def add_part(df: DataFrame, root: str, name: str, at: Snapshot) -> dict:
    """Write rows as a part by buckets of property_id; nobody reads it before a commit names it."""
    path = f"{name}/part-{uuid.uuid4().hex}"
    rows = df.withColumns({"bucket": bucket(), "_version": F.col("_version") if "_version" in df.columns else F.lit(at.version + 1).cast("long")})
    rows.repartition(BUCKETS, "bucket").write.partitionBy("bucket").parquet(f"{root}/{path}")
    return {"path": path, "rows": df.sparkSession.read.schema("_version long, bucket int").parquet(f"{root}/{path}").count()}


def commit(spark: SparkSession, root: str, at: Snapshot, parts: dict[str, list[dict]], done: dict[str, int] | None = None) -> Snapshot:
    """Put the next manifest in place, with ``parts`` by table in place of those of ``at``. Another writer's commit
    since ``at`` raises; what was written for this one is then not read by anybody."""
    new = Snapshot(at.version + 1, at.parts | {k: [p for p in v if p["rows"]] for k, v in parts.items()}, at.done | (done or {}))
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs, folder = _files(spark, f"{root}/{MANIFESTS}")
    fs.mkdirs(folder)
    draft, final = (jvm.org.apache.hadoop.fs.Path(folder, n) for n in (f"draft-{uuid.uuid4().hex}", f"{new.version}.json"))
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(new.__dict__).encode()))
    out.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(draft), fs.makeQualified(final), spark.sparkContext._gateway.new_array(kind, 0))
    return new


def append(spark: SparkSession, root: str, at: Snapshot, rows: dict[str, DataFrame], done: dict[str, int] | None = None) -> Snapshot:
    """Both tables' new rows in one commit."""
    parts = {name: [*at.parts.get(name, []), add_part(df, root, name, at)] for name, df in rows.items()}
    return commit(spark, root, at, parts, done)


def compact(spark: SparkSession, root: str, schemas: dict[str, str]) -> Snapshot:
    """Join parts of about one size where ``FAN`` of them have come together, until none have."""
    at = snapshot(spark, root)
    tier = lambda p: int(math.log(max(p["rows"], SMALL) / SMALL, FAN))
    for name, schema in schemas.items():
        while True:
            tiers: dict[int, list[dict]] = {}
            for p in at.parts.get(name, []):
                tiers.setdefault(tier(p), []).append(p)
            crowded = next((v for _, v in sorted(tiers.items()) if len(v) >= FAN), None)
            if not crowded:
                break
            rows = _union([spark.read.schema(f"{schema}, _version long").parquet(f"{root}/{p['path']}") for p in crowded])
            if key := KEYS[name]:
                rows = rows.groupBy(key).agg(F.max_by(F.struct("*"), "_version").alias("r")).select("r.*")
            rest = [p for p in at.parts[name] if p not in crowded]
            at = commit(spark, root, at, {name: [*rest, add_part(rows, root, name, at)]})
    return at


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete all but the newest ``keep`` manifests and the parts that none of these names; how many parts went.
    For the writer alone: parts of a commit under way are not named yet."""
    versions = _manifests(spark, root)
    named = {f"{p['path']}" for v in versions[-keep:] for parts in snapshot(spark, root, v).parts.values() for p in parts}
    gone = 0
    for v in versions[:-keep]:
        fs, path = _files(spark, f"{root}/{MANIFESTS}/{v}.json")
        fs.delete(path, False)
    for name in KEYS:
        fs, folder = _files(spark, f"{root}/{name}")
        for s in fs.listStatus(folder) if fs.exists(folder) else []:
            if s.getPath().getName().startswith("part-") and f"{name}/{s.getPath().getName()}" not in named:
                gone += fs.delete(s.getPath(), True)
    return gone


def read(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """The newest complete version; an empty table before the first."""
    if name in KEYS and (at := snapshot(spark, root)).version:
        return contents(spark, root, name, schema, at).drop("bucket")
    versions = _versions(spark, root, name)
    return spark.read.schema(schema).parquet(f"{root}/{name}/v={versions[-1]}") if versions else spark.createDataFrame([], schema)


def write(df: DataFrame, root: str, name: str) -> int:
    """Write the next version; its _SUCCESS file is the pointer, so a failed write is never read."""
    versions = _versions(df.sparkSession, root, name)
    version = versions[-1] + 1 if versions else 1
    df.write.mode("overwrite").partitionBy(*PARTITIONS.get(name, [])).parquet(f"{root}/{name}/v={version}")
    return version


def seeds(spark: SparkSession, base: str, zip_codes: list[str], cities: list[str]) -> DataFrame:
    """Search pages to start from: one a zip code and one a city path."""
    config = spark.createDataFrame([(zip_codes, cities)], "zips array<string>, cities array<string>")
    zips = config.select(F.explode("zips").alias("zip_code")).select(F.concat(F.lit(f"{base}/zipcode/"), "zip_code").alias("url"), "zip_code")
    towns = config.select(F.explode("cities").alias("city")).select(F.concat(F.lit(base), F.when(F.col("city").startswith("/"), "").otherwise("/"), "city").alias("url"), F.lit(None).cast("string").alias("zip_code"))
    return zips.unionByName(towns)


def resume_after(ids: DataFrame, table: DataFrame, last: str | None, key: str = "property_id", order: str = "seq") -> DataFrame:
    """Rows of ``table`` for the listed ids behind ``last``, in list order; an unknown ``last`` gives none."""
    if last is not None:
        place = ids.where(F.col(key) == last).agg(F.min(order).alias("_after"))  # one row
        ids = ids.join(F.broadcast(place), F.col(order) > F.col("_after")).drop("_after")
    return table.join(ids, key).orderBy(order)
