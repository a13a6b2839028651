"""Closed vocabularies: property types, event types, statuses and their order of tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import event_time, lookup

# Labels of property types on listing pages.
PROPERTY_TYPES = {
    "Townhome": "Townhome",
    "Condo": "Condo",
    "Single-family": "SingleFamily",
    "Vacant land": "VacantLand",
    "Multi-family": "MultiFamily",
    "Manufactured": "Manufactured",
    "Condo (co-op)": "Coops",
    "Single Family Residence, 24 - Floating Home/On-Water Res": "SingleFamilyOnWater",
}
# First words of event descriptions, in the order in which they are tried.
EVENT_PREFIXES = [
    ("sold", "Sold"),
    ("price changed", "PriceChange"),
    ("pending", "Pending"),
    ("relisted", "ReListed"),
    ("delisted", "DeListed"),
    ("contingent", "Contingent"),
    ("rental removed", "RentalRemoved"),
    ("listing removed", "ListRemoved"),
]
# Banner texts that say the status themselves.
STATUS_TEXTS = {
    "for sale": "Active",
    "pending": "Pending",
    "sold": "Sold",
    "off market": "ListRemoved",
    "rental removed": "RentalRemoved",
    "for rent": "ActiveForRental",
}
# Last events that mean a sold-and-off-market property was only withdrawn.
WITHDRAWN_AFTER = ["Listed", "ReListed", "DeListed", "PriceChange", "RentalRemoved", "ListRemoved", "Pending"]


def property_type(label: Column) -> Column:
    return lookup(PROPERTY_TYPES, label)


def event_type(description: Column, prefixes: list[tuple[str, str]] = EVENT_PREFIXES) -> Column:
    """By prefix; listings that mention rent anywhere are rentals; unknown text gives null."""
    text = F.lower(description)
    found = F.when(text.startswith("listed") & text.contains("rent"), "ListedForRent").when(text.startswith("listed"), "Listed")
    for prefix, name in prefixes:
        found = found.when(text.startswith(prefix), name)
    return found


def sold_date(text: Column, seen_at: Column) -> Column:
    """When a ``sold…`` banner says the sale was. "Today" is the day of the observation rather than
    of the run, so that a replay gives the same answer."""
    day = lambda back: F.to_utc_timestamp(F.date_sub(F.from_utc_timestamp(seen_at, "America/Los_Angeles"), back).cast("timestamp"), "America/Los_Angeles")
    lower = F.lower(text)
    return F.when(lower == "soldtoday", day(0)).when(lower == "soldyesterday", day(1)).otherwise(event_time(F.replace(text, F.lit("soldon"), F.lit(""))))


def resolve_status(text: Column, events: Column, seen_at: Column) -> Column:
    """struct<status, error> from the banner and the sorted ``events`` (array of structs with
    event_ts, event_type, description). The first rule that holds decides."""
    last, previous = F.try_element_at(events, F.lit(-1)), F.try_element_at(events, F.lit(-2))
    kind, days = last["event_type"], lambda a, b: F.abs(F.unix_timestamp(a) - F.unix_timestamp(b)) / 86400
    direct = lookup(STATUS_TEXTS, F.trim(F.element_at(F.split(text, "-"), 1)))
    withdrawn = text.startswith("off market— sold")
    sold, closed = text.startswith("sold"), text.startswith("closed")
    when = sold_date(text, seen_at)
    rental = lambda e: (e["event_type"] == "ListedForRent") | F.lower(e["description"]).contains("rent")
    telling = F.try_element_at(F.filter(events, lambda e: rental(e) | (e["event_type"] == "Listed")), F.lit(-1))
    status = (
        F.when(direct.isNotNull(), direct)
        .when(text.startswith("Sold"), "Sold")
        .when(withdrawn & kind.isin(WITHDRAWN_AFTER), "ListRemoved")
        .when(withdrawn & (kind == "Sold"), "Sold")
        .when(withdrawn, None)
        .when(sold & when.isNull(), None)
        .when(sold & kind.isin("Sold", "DeListed") & (days(last["event_ts"], when) <= 7), "Sold")
        .when(sold & (kind == "Pending") & (previous["event_type"] == "Sold") & (days(last["event_ts"], previous["event_ts"]) <= 2), "Sold")
        .when(sold & (kind == "RentalRemoved"), "RentalRemoved")
        .when(sold & (kind == "Listed"), "ListRemoved")
        .when(sold & (last["event_ts"] < when), "ListRemoved")
        .when(sold, "Sold")
        .when(closed & telling.isNotNull(), F.when(rental(telling), "RentalRemoved").otherwise("ListRemoved"))
    )
    error = F.when(status.isNotNull(), None).when(sold & when.isNull(), "Unexpected").otherwise("UnknownPropertyStatus")
    return F.struct(status.alias("status"), error.alias("error"))
