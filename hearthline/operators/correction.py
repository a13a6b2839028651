"""Re-scans of known properties: history first, then status, then a correction of the history.

When a property turns out withdrawn though no removal was recorded since it was last listed, a
removal by source ``system`` is added: at the time of the scan, or 12 hours before the event after
the listing if that one is about renting. "Now" is the scan's time, so that replays agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify, values
from ..functions.keys import event_id
from . import history

# Fixed value: the description of an added removal.
NOTE = "ListRemoved (added by system correction), information maybe missing"


def lacking_removal(h: Column, seen: Column) -> Column:
    """When a removal is to be added to the sorted history ``h`` of a property that turned out withdrawn; null if none lacks.

    Searching backwards ends where both a listing and a removal were met; the oldest listing met by
    then is the one whose next event is looked at, unless it is the first event of all."""
    places = lambda kind: F.filter(F.transform(h, lambda e, i: F.when(e["event_type"] == kind, i)), lambda i: i.isNotNull())
    listed, removed = places("Listed"), places("ListRemoved")
    last_listed, last_removed = F.try_element_at(listed, F.lit(-1)), F.try_element_at(removed, F.lit(-1))
    stop = F.when(last_removed.isNull(), 0).otherwise(F.least(last_listed, last_removed))
    oldest = F.try_element_at(F.filter(listed, lambda i: i >= stop), F.lit(1))
    following = F.try_element_at(h, oldest + 2)  # places count from 0, elements from 1
    by_rent = (oldest > 0) & following["event_type"].isin("ListedForRent", "RentalRemoved")
    at = lambda i: F.try_element_at(h, i + 1)["event_ts"]
    lacks = last_listed.isNotNull() & (last_removed.isNull() | (at(last_removed) < at(last_listed)))
    return F.when(F.size(h) == 0, seen).when(lacks, F.when(by_rent, following["event_ts"] - F.expr("interval 12 hours")).otherwise(seen))


def removals_to_add(events: DataFrame, withdrawn: DataFrame, owner: str = "property_id", seen: str = "seen_at") -> DataFrame:
    """(owner, event_ts) of the removals that the histories of ``withdrawn`` (owner, seen) lack."""
    told = history.as_arrays(events.join(withdrawn.select(owner), owner, "left_semi"), owner, [c for c in history.ORDER if c in events.columns])
    rows = withdrawn.select(owner, F.col(seen).alias("_seen")).join(told, owner, "left")
    none = F.array().cast(told.schema["history"].dataType)
    rows = rows.select(owner, lacking_removal(F.coalesce("history", none), F.col("_seen")).alias("event_ts"))
    return rows.where("event_ts is not null")


def system_event(at: Column) -> Column:
    null = lambda kind: F.lit(None).cast(kind)
    return F.struct(at.alias("event_ts"), F.lit("ListRemoved").alias("event_type"), null("decimal(18,2)").alias("price"), F.lit("system").alias("source"), null("string").alias("source_id"), F.lit(NOTE).alias("description"))


def system_events(removals: DataFrame, owner: str = "property_id") -> DataFrame:
    null = lambda kind: F.lit(None).cast(kind)
    return removals.select(owner, "event_ts", F.lit("ListRemoved").alias("event_type"), null("decimal(18,2)").alias("price"), F.lit("system").alias("source"), null("string").alias("source_id"), F.lit(NOTE).alias("description"))


def rescan(properties: DataFrame, events: DataFrame, scanned: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(changed properties, events after, rejects) for ``scanned``: property_id, status_text, seen_at,
    and an ``events`` array of typed events. Price and other attributes stay; a sale clears the price."""
    mine = properties.join(scanned.select("property_id", "status_text", "seen_at"), "property_id")
    fresh = scanned.join(mine.select("property_id"), "property_id", "left_semi").select("property_id", F.explode("events").alias("e")).select("property_id", "e.*")
    fresh = fresh.withColumn("event_id", event_id(F.col("property_id"))).select(*events.columns)
    merged = history.merge(events, fresh)
    mine = mine.join(history.as_arrays(merged), "property_id", "left").withColumn("history", F.coalesce("history", F.array().cast(f"array<{_event_type(merged)}>")))
    mine = values.staged(mine, {"_s": classify.resolve_status(F.col("status_text"), F.col("history"), F.col("seen_at"))})
    bad = mine.where("_s.error is not null").select(F.col("property_id").alias("record_key"), F.lit("rescan").alias("stage"), F.col("_s.error").alias("error_code"), F.lit("no status for this banner").alias("message"), F.col("status_text").alias("payload"))
    mine = mine.where("_s.status is not null").withColumn("changed", ~F.col("_s.status").eqNullSafe(F.col("status")))
    price = F.when(F.col("changed") & (F.col("_s.status") == "Sold"), F.lit(None)).otherwise(F.col("price"))
    rows = mine.withColumns({"price": price.cast("decimal(18,2)"), "status": F.col("_s.status"), "last_updated": F.col("seen_at")})
    withdrawn = rows.where("changed and status = 'ListRemoved'").select("property_id", "seen_at")
    added = system_events(removals_to_add(merged, withdrawn))
    added = added.withColumn("event_id", event_id(F.col("property_id"))).select(*events.columns)
    return rows.select(*properties.columns), history.merge(merged, added), bad


def _event_type(events: DataFrame) -> str:
    return "struct<" + ", ".join(f"{c}: {events.schema[c].dataType.simpleString()}" for c in history.ORDER) + ">"
