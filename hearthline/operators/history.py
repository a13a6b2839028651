"""Event histories as rows: order, equality, merge, and what is new.

Two events of an owner are equal if time, type, price, source and source id agree, null with
null; id and description do not count. Their order is time, type name, price, source, source id,
description, nulls first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import EVENT_IDENTITY

ORDER = [*EVENT_IDENTITY, "description"]


def _nulls_first(columns: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns]


def numbered(events: DataFrame, owner: str = "property_id", name: str = "event_no") -> DataFrame:
    """Events with their number in chronological order."""
    return events.withColumn(name, F.row_number().over(Window.partitionBy(owner).orderBy(*_nulls_first(ORDER))))


def first_of_equals(events: DataFrame, owner: str = "property_id", prefer: list[str] | None = None, identity: list[str] = EVENT_IDENTITY) -> DataFrame:
    """One event of each set of equal ones: the smallest by ``prefer``, then by the event order."""
    order = _nulls_first([*(prefer or []), *[c for c in ORDER if c in events.columns and c not in identity]])
    w = Window.partitionBy(owner, *identity).orderBy(*order)
    return events.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def merge(existing: DataFrame, new: DataFrame, owner: str = "property_id", identity: list[str] = EVENT_IDENTITY) -> DataFrame:
    """Union of two histories without equals; what exists wins."""
    both = existing.withColumn("_origin", F.lit(0)).unionByName(new.withColumn("_origin", F.lit(1)))
    return first_of_equals(both, owner, ["_origin"], identity).drop("_origin")


def merge_guarded(owners: DataFrame, existing: DataFrame, new_owners: DataFrame, new: DataFrame, owner: str = "property_id", agree: tuple[str, ...] = ("address_hash",), time: str = "last_updated") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(owners, events, rejects): two histories made one where all rows of an owner, on both sides, say the
    same in the ``agree`` columns (null agrees with null only). Such owners get the latest ``time``. The others
    are rejected: their old rows and events stay, nothing new of them comes in. Owners may have several rows or
    be on one side only; new events of an owner without rows come in, as nothing speaks against them."""
    columns = [owner, *agree, time]
    both = owners.select(*columns, F.lit(True).alias("_old")).unionByName(new_owners.select(*columns, F.lit(False).alias("_old")))
    same = F.lit(True)
    for c in agree:
        same = same & F.min(c).eqNullSafe(F.max(c)) & F.count(c).isin(F.lit(0), F.count("*"))
    shown = [f(F.struct(*agree)).alias(n) for f, n in ((F.min, "one"), (F.max, "other"))]
    judged = both.groupBy(owner).agg(same.alias("_same"), *[F.min(c).alias(c) for c in agree], F.max(time).alias(time), *shown)
    odd = judged.where("not _same").select(owner, "one", "other")
    kept = judged.where("_same").select(*columns).unionByName(owners.select(*columns).join(odd, owner, "left_semi"))
    key = F.sha2(F.col(owner).cast("string"), 256)
    bad = odd.select(key.alias("record_key"), F.lit("merge").alias("stage"), F.lit("AddressMismatch").alias("error_code"), F.lit("both sides disagree about the owner").alias("message"), F.to_json(F.struct(owner, "one", "other")).alias("payload"))
    return kept, merge(existing, new.join(odd, owner, "left_anti"), owner), bad


def only_new(existing: DataFrame, new: DataFrame, owner: str = "property_id", identity: list[str] = EVENT_IDENTITY) -> DataFrame:
    """Events of ``new`` that ``existing`` does not hold, by null-safe equality."""
    keys = [owner, *identity]
    old = existing.select(*[F.col(c).alias(f"_{c}") for c in keys])
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return new.join(old, same, "left_anti")


def last_events(events: DataFrame, owner: str = "property_id") -> DataFrame:
    """Per owner: the last event's type and time, the one before it, and the days between them."""
    w = Window.partitionBy(owner).orderBy(*_nulls_first(ORDER))
    seen = events.withColumns({"previous_type": F.lag("event_type").over(w), "previous_ts": F.lag("event_ts").over(w), "_next": F.lead(F.lit(1)).over(w)})
    last = seen.where(F.col("_next").isNull())
    gap = (F.unix_timestamp("event_ts") - F.unix_timestamp("previous_ts")) / 86400
    return last.select(owner, F.col("event_type").alias("last_type"), F.col("event_ts").alias("last_ts"), "previous_type", "previous_ts", gap.alias("gap_days"))


def newest_per_key(rows: DataFrame, key: str | list[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def as_arrays(events: DataFrame, owner: str = "property_id", fields: list[str] = ORDER, name: str = "history") -> DataFrame:
    """One row an owner with its events as a sorted array."""
    return events.groupBy(owner).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))


def equal(a: Column, b: Column) -> Column:
    """Whether two events, as structs of one owner, are equal."""
    same = F.lit(True)
    for c in EVENT_IDENTITY:
        same = same & a[c].eqNullSafe(b[c])
    return same


def sort_and_dedupe(events: Column) -> Column:
    """The same for an array column of structs (time, type, price, source, source id, description)
    in input order: the first of equals stays. For the short arrays of one record."""

    def repeated(e: Column, i: Column) -> Column:
        earlier = F.slice(events, F.lit(1), i)
        return F.exists(earlier, lambda f: equal(e, f))

    return F.array_sort(F.filter(events, lambda e, i: ~repeated(e, i)))
