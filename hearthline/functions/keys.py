"""Keys: ids that a retry computes again, and the composite strings of item-shaped exports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EVENT_IDENTITY = ["event_ts", "event_type", "price", "source", "source_id"]


def property_id(address_hash: Column) -> Column:
    """Deterministic where the original drew a random id, so that replays change nothing."""
    return F.sha2(address_hash, 256)


def event_id(owner: Column, event: dict[str, Column] | None = None) -> Column:
    parts = [event[c] if event else F.col(c) for c in EVENT_IDENTITY]
    shown = [F.coalesce(p.cast("string"), F.lit("\0")) for p in parts]
    return F.sha2(F.concat_ws("\1", owner, *shown), 256)


def composite(*parts: Column) -> Column:
    return F.concat_ws("#", *[p.cast("string") for p in parts])


def composite_part(key: Column, number: int, parts: int) -> Column:
    """Part ``number`` (from 1) of a key with exactly ``parts`` parts; malformed keys give null."""
    split = F.split(key, "#")
    return F.when((F.size(split) == parts) & ~F.exists(split, lambda x: x == ""), F.element_at(split, number))


def location_index(state: Column, city: Column, zip_code: Column, property_type: Column) -> Column:
    return F.concat_ws("#", state, city, zip_code, property_type)


def parse_location_index(index: Column, known_types: list[str]) -> Column:
    """struct<state, city, zip_code int, property_type>; null if malformed or of an unknown type."""
    part = lambda k: composite_part(index, k, 4)
    fields = F.struct(part(1).alias("state"), part(2).alias("city"), part(3).try_cast("int").alias("zip_code"), part(4).alias("property_type"))
    return F.when(part(3).try_cast("int").isNotNull() & part(4).isin(known_types), fields)
