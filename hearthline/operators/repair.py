"""Repairs of item-shaped tables: plans first, then one rewrite; a dry run only shows the plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import wall_time_to_utc
from .history import newest_per_key

# Fixed value: what the sort keys of history items begin with.
HISTORY = "HISTORY#"
NAIVE = r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"


def time_zone_plan(items: DataFrame) -> DataFrame:
    """(pk, sk, new_sk, event_time, new_time, mismatch) of history rows whose key and attribute both
    hold naive Pacific times."""
    in_key = F.regexp_extract("sk", rf"#({NAIVE})(?:#|$)", 1)
    naive = items.where(F.col("sk").startswith(HISTORY) & (in_key != "") & F.col("event_time").rlike(f"^{NAIVE}$"))
    new = F.date_format(wall_time_to_utc(F.col("event_time").try_cast("timestamp_ntz").cast("timestamp")), "yyyy-MM-dd'T'HH:mm:ssXXX")
    new = F.regexp_replace(new, "Z$", "+00:00")
    return naive.select("pk", "sk", F.replace(F.col("sk"), in_key, new).alias("new_sk"), "event_time", new.alias("new_time"), (in_key != F.col("event_time")).alias("mismatch"))


def apply_time_zone_plan(items: DataFrame, plan: DataFrame) -> DataFrame:
    """All items with the planned ones rewritten, in one new version."""
    p = plan.select("pk", "sk", "new_sk", "new_time")
    both = items.join(p, ["pk", "sk"], "left")
    fixed = {"sk": F.coalesce("new_sk", "sk"), "event_time": F.coalesce("new_time", "event_time")}
    return both.select(*[fixed[c].alias(c) if c in fixed else F.col(c) for c in items.columns])


def dry_run(plan: DataFrame, shown: int = 5) -> tuple[DataFrame, DataFrame]:
    """(counts, the first planned changes)."""
    return plan.agg(F.count("*").alias("planned"), F.count_if("mismatch").alias("mismatched")), plan.orderBy("pk", "sk").limit(shown)


def capped(plan: DataFrame, most: int | None) -> DataFrame:
    return plan if most is None else plan.orderBy("pk", "sk").limit(most)


def duplicate_groups(rows: DataFrame, key: list[str], *checked: str) -> DataFrame:
    """Keys with more than one row; ``consistent`` if all rows agree in the checked columns."""
    agree = F.lit(True)
    for c in checked:
        agree = agree & (F.min(c).eqNullSafe(F.max(c)))
    return rows.groupBy(*key).agg(F.count("*").alias("copies"), agree.alias("consistent")).where("copies > 1")


def keep_newest_metadata(rows: DataFrame, key: str = "property_id", order: list[Column] | None = None) -> DataFrame:
    """One row a key, the newest; keys whose rows disagree about the address, or about ``pk`` where there is one, are left as they are."""
    odd = duplicate_groups(rows, [key], *[c for c in ("pk", "address_hash") if c in rows.columns]).where("not consistent").select(key)
    newest = newest_per_key(rows.join(odd, key, "left_anti"), key, order or [F.desc("last_updated"), F.asc("sk")])
    return newest.unionByName(rows.join(odd, key, "left_semi"))


def keys_with_time(items: DataFrame, ident: str = "pk") -> DataFrame:
    """Metadata items whose sort key has a time as its third part. A property (``ident``) with several
    metadata items raises ValueError; history items are passed over."""
    metadata = items.where(~F.coalesce(F.col("sk").startswith(HISTORY), F.lit(False)))
    if duplicate_groups(metadata, [ident]).limit(1).count():
        raise ValueError("properties have several metadata items: remove duplicates first")
    return metadata.where(F.size(F.split("sk", "#")) > 2)


def strip_time_from_keys(items: DataFrame) -> DataFrame:
    """Refuses, per key, where the shortened keys would collide."""
    short = F.regexp_replace("sk", r"^([^#]*#[^#]*)#.*$", "$1")
    marked = items.withColumn("_short", short)
    clash = marked.groupBy("pk", "_short").count().where("count > 1").select("pk", "_short")
    free = marked.join(clash, ["pk", "_short"], "left_anti").withColumn("sk", F.col("_short"))
    return free.unionByName(marked.join(clash, ["pk", "_short"], "left_semi")).select(*items.columns)
