"""Merging new observations into stored properties: metadata, sources, upsert, differences.

A new observation's non-null fields win; status, price and last_updated are always the new ones,
even null. A row is left alone only if the observation is not newer and says the same; older rows
that differ are written and flagged ``late_overwrite`` (or refused with ``newest_wins``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import event_id
from . import history

KEPT_IF_NULL = ["address", "address_hash", "area", "lot_area", "property_type", "bedrooms", "bathrooms", "year_built", "city", "zip_code", "state"]
ALWAYS_NEW = ["status", "price", "last_updated"]


def merge_sources(old: Column, new: Column) -> Column:
    """Old sources in their order, each with the newest URL given for its id; unknown ids behind them."""
    old, new = F.coalesce(old, F.array().cast("array<struct<source_id: string, source_url: string, source_name: string>>")), F.coalesce(new, F.array().cast("array<struct<source_id: string, source_url: string, source_name: string>>"))
    of = lambda x: F.filter(new, lambda n: n["source_id"] == x["source_id"])

    def with_url(x: Column) -> Column:
        return F.struct(x["source_id"].alias("source_id"), F.coalesce(F.try_element_at(of(x), F.lit(-1))["source_url"], x["source_url"]).alias("source_url"), x["source_name"].alias("source_name"))

    unknown = F.filter(new, lambda n: ~F.exists(old, lambda o: o["source_id"] == n["source_id"]))
    first = F.filter(unknown, lambda n, i: ~F.exists(F.slice(unknown, F.lit(1), i), lambda m: m["source_id"] == n["source_id"]))
    return F.concat(F.transform(old, with_url), F.transform(first, with_url))


def merge_metadata(existing: DataFrame, new: DataFrame, key: str = "property_id", kept_if_null: list[str] = KEPT_IF_NULL, always_new: list[str] = ALWAYS_NEW, sources: str | None = "data_sources", time: str = "last_updated", newest_wins: bool = False) -> DataFrame:
    """One row a key of either side, with ``outcome`` (kept, unchanged, merged, inserted) and ``late_overwrite``."""
    o, n = existing.alias("o"), new.alias("n")
    both = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    is_old, is_new = F.col(f"o.{key}").isNotNull(), F.col(f"n.{key}").isNotNull()
    merged = {c: F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")) for c in kept_if_null} | {c: F.col(f"n.{c}") for c in always_new}
    if sources:
        merged[sources] = merge_sources(F.col(f"o.{sources}"), F.col(f"n.{sources}"))
    same = F.lit(True)
    for c in merged:
        if c != time:
            same = same & merged[c].eqNullSafe(F.col(f"o.{c}"))
    newer = F.col(f"n.{time}") > F.col(f"o.{time}")
    skip = ~F.coalesce(newer, F.lit(False)) & (F.lit(True) if newest_wins else same)
    outcome = F.when(~is_new, "kept").when(~is_old, "inserted").when(skip, "unchanged").otherwise("merged")
    pick = lambda c: F.when(outcome.isin("kept", "unchanged"), F.col(f"o.{c}")).otherwise(merged[c]).alias(c)
    late = (outcome == "merged") & ~F.coalesce(newer, F.lit(False))
    return both.select(F.coalesce(F.col(f"o.{key}"), F.col(f"n.{key}")).alias(key), *[pick(c) for c in merged], outcome.alias("outcome"), late.alias("late_overwrite"))


def upsert(properties: DataFrame, events: DataFrame, new_properties: DataFrame, new_events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(properties, events) after one observation a property: stored ones are found by address, or
    by id where the address is new; ids stay. Of several with one address the smallest id is it."""
    by_address = properties.groupBy("address_hash").agg(F.min("property_id").alias("stored_id"))
    found = new_properties.join(by_address, "address_hash", "left").withColumn("_id", F.coalesce("stored_id", "property_id"))
    ids = found.select(F.col("property_id").alias("_old_id"), "_id").distinct()
    new_rows = found.drop("stored_id", "property_id").withColumnRenamed("_id", "property_id").select(*properties.columns)
    renamed = new_events.join(ids, new_events["property_id"] == ids["_old_id"]).drop("property_id", "_old_id").withColumnRenamed("_id", "property_id")
    renamed = renamed.withColumn("event_id", event_id(F.col("property_id"))).select(*events.columns)
    merged = merge_metadata(properties, new_rows)
    return merged.select(*properties.columns), events.unionByName(history.first_of_equals(history.only_new(events, renamed)))


def overwrite(table: DataFrame, rows: DataFrame, key: str = "property_id") -> DataFrame:
    return table.join(rows.select(key), key, "left_anti").unionByName(rows)


def delete(ids: DataFrame, *tables: DataFrame, key: str = "property_id") -> list[DataFrame]:
    return [t.join(ids.select(key), key, "left_anti") for t in tables]


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, old_value, new_value) of every field that differs, null-safe; rows of one side differ in all non-null fields."""
    both = old.alias("o").join(new.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"o.{c}").cast("string").alias("old_value"), F.col(f"n.{c}").cast("string").alias("new_value")) for c in fields])
    return both.select(F.coalesce(F.col(f"o.{key}"), F.col(f"n.{key}")).alias(key), F.explode(pairs).alias("d")).select(key, "d.*").where("not (old_value <=> new_value)")


def event_diff(old: DataFrame, new: DataFrame, owner: str = "property_id") -> DataFrame:
    """Events of both sides paired by their number in order, where they differ."""
    shown = lambda side, name: history.numbered(side, owner).select(owner, "event_no", F.to_json(F.struct(*history.ORDER)).alias(name))
    return shown(old, "old_event").join(shown(new, "new_event"), [owner, "event_no"], "full_outer").where("not (old_event <=> new_event)")
