"""Pattern queries and lookups: filters that reach the scan, joins instead of lookups per row."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import history

PRICED = ["Listed", "ReListed", "PriceChange"]


@dataclass
class Pattern:
    """All given arguments must hold; inside one, any value does. A range is (low, high), either may be None."""

    states: list[str] = field(default_factory=list)
    statuses: list[str] = field(default_factory=list)
    cities: list[str] = field(default_factory=list)
    zip_codes: list[str] = field(default_factory=list)
    property_types: list[str] = field(default_factory=list)
    price: tuple | None = None
    bedrooms: tuple | None = None
    bathrooms: tuple | None = None
    event_types: list[str] = field(default_factory=list)
    event_time: tuple[datetime | None, datetime | None] | None = None


def within(value: Column, bounds: tuple) -> Column:
    low, high = bounds
    test = F.lit(True)
    if low is not None:
        test = test & (value >= low)
    if high is not None:
        test = test & (value <= high)
    return test


def filters(p: Pattern, names: dict[str, str] | None = None) -> Column:
    """The pattern's row filter. An unknown or zero price passes any price range."""
    col = lambda c: F.col((names or {}).get(c, c))
    test = F.lit(True)
    for values, name in ((p.states, "state"), (p.statuses, "status"), (p.cities, "city"), (p.property_types, "property_type")):
        if values:
            test = test & col(name).isin(values)
    if p.zip_codes:
        test = test & col("zip_code").try_cast("int").isin([int(z) for z in p.zip_codes])
    if p.price:
        test = test & (col("price").isNull() | (col("price") == 0) | within(col("price"), p.price))
    for bounds, name in ((p.bedrooms, "bedrooms"), (p.bathrooms, "bathrooms")):
        if bounds:
            test = test & within(col(name), bounds)
    return test


def find(properties: DataFrame, p: Pattern, events: DataFrame | None = None, names: dict[str, str] | None = None, key: str = "property_id") -> DataFrame:
    found = properties.where(filters(p, names))
    if p.event_types or p.event_time:
        wanted = F.lit(True)
        if p.event_types:
            wanted = wanted & F.col("event_type").isin(p.event_types)
        if p.event_time:
            wanted = wanted & within(F.col("event_ts"), p.event_time)
        found = found.join(events.where(wanted).select(key), key, "left_semi")
    return found


def page(rows: DataFrame, keys: list[str], limit: int, after: tuple | None = None) -> DataFrame:
    """The next ``limit`` rows in key order behind the keys ``after``: exact, and resumed without rescanning pages."""
    if after is not None:
        behind, tied = F.lit(False), F.lit(True)
        for k, v in zip(keys, after):
            behind = behind | (tied & (F.col(k) > v))
            tied = tied & (F.col(k) == v)
        rows = rows.where(behind)
    return rows.orderBy(*keys).limit(limit)


def by_ids(ids: DataFrame, properties: DataFrame, key: str = "property_id") -> DataFrame:
    return ids.join(properties, key)


def by_address(addresses: DataFrame, properties: DataFrame) -> DataFrame:
    """Rows with address_hash to properties; of several the smallest id."""
    first = history.newest_per_key(properties, "address_hash", [F.col("property_id").asc()])
    return addresses.join(first, "address_hash")


def with_history(properties: DataFrame, events: DataFrame) -> DataFrame:
    """Full read-back: sorted events, unknown beds and baths as 0; rows without an area are dropped."""
    full = properties.where("area is not null").join(history.as_arrays(events), "property_id", "left")
    return full.withColumns({"bedrooms": F.coalesce("bedrooms", F.lit(0)), "bathrooms": F.coalesce("bathrooms", F.lit(0)), "history": F.coalesce("history", F.array().cast(full.schema["history"].dataType)), "history_last_updated": F.col("last_updated")})


def as_documents(properties: DataFrame, events: DataFrame) -> DataFrame:
    """One nested JSON document a property; a price of 0 shows as null."""
    rows = with_history(properties, events).withColumn("price", F.nullif(F.col("price"), F.lit(0).cast("decimal(18,2)")))
    return rows.select("property_id", F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("document"))


def summaries(properties: DataFrame, events: DataFrame) -> DataFrame:
    line = F.transform("history", lambda e: F.concat_ws(" ", F.date_format(e["event_ts"], "yyyy-MM-dd"), e["event_type"], e["price"].cast("string")))
    head = F.format_string("%s: %s, %s, %s beds, %s baths", F.col("property_id"), F.col("address_hash"), F.col("status"), F.col("bedrooms").cast("string"), F.col("bathrooms").cast("string"))
    return with_history(properties, events).select("property_id", F.concat_ws("\n", F.array(head), line).alias("summary"))
