"""The declared search goals over event rows: price drops, new listings, sales, sales above list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import square_feet
from .query import PRICED, Pattern, find, with_history, within


def price_drops(events: DataFrame, owner: str = "property_id", types: list[str] = PRICED) -> DataFrame:
    """List prices below the one before."""
    w = Window.partitionBy(owner).orderBy("event_ts", "event_id")
    priced = events.where(F.col("event_type").isin(types) & F.col("price").isNotNull())
    return priced.withColumn("previous_price", F.lag("price").over(w)).where("price < previous_price")


def happened(rows: DataFrame, events: DataFrame, types: list[str], time: tuple, key: str = "property_id") -> DataFrame:
    """Rows with an event of the given types in a time range (pending last month, sold in a period)."""
    return rows.join(events.where(F.col("event_type").isin(types) & within(F.col("event_ts"), time)).select(key), key, "left_semi")


def newly_listed(events: DataFrame, since, owner: str = "property_id") -> DataFrame:
    last = events.where("event_type = 'Listed'").groupBy(owner).agg(F.max("event_ts").alias("listed_ts"))
    return last.where(F.col("listed_ts") >= since)


def sold_over_list(events: DataFrame, owner: str = "property_id", listed: list[str] = PRICED, sold: str = "Sold") -> DataFrame:
    """Sales above the last list price before them."""
    w = Window.partitionBy(owner).orderBy("event_ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    asked = F.last(F.when(F.col("event_type").isin(listed), F.col("price")), ignorenulls=True).over(w)
    return events.withColumn("list_price", asked).where((F.col("event_type") == sold) & (F.col("price") > F.col("list_price")))


def attributes(area: tuple | None = None, lot_area: tuple | None = None) -> Column:
    """Areas in square feet, whatever their unit."""
    test = F.lit(True)
    for bounds, name in ((area, "area"), (lot_area, "lot_area")):
        if bounds:
            test = test & within(square_feet(F.col(name)), bounds)
    return test


def matching_with_history(properties: DataFrame, events: DataFrame, p: Pattern, area: tuple | None = None, lot_area: tuple | None = None) -> DataFrame:
    return with_history(find(properties, p, events).where(attributes(area, lot_area)), events)


def missing_from_scrape(stored: DataFrame, scraped: DataFrame, owner: str = "property_id") -> DataFrame:
    """Stored events, other than the system's own, that a newer scrape of the property does not show."""
    from .history import only_new

    known = stored.where("source is null or source <> 'system'").join(scraped.select(owner).distinct(), owner, "left_semi")
    return only_new(scraped, known, owner)
