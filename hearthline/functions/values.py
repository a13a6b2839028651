"""Column functions for times, areas and numbers of raw records.

Naive wall times are Pacific; the session zone must be UTC. Bad text gives null, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PACIFIC = "America/Los_Angeles"
# Area units as they are written, without blanks and in lower case.
AREA_UNITS = {"sqft": "SquareFeet", "squarefeet": "SquareFeet", "acres": "Acres", "sqm2": "SquareMeter"}
# Square feet in one unit.
IN_SQUARE_FEET = {"SquareFeet": 1.0, "SquareMeter": 10.7639104167, "Acres": 43560.0}


def staged(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with columns that are computed once a row, here. Through a one-row generator the
    optimiser neither repeats them in later expressions nor pushes tests on them into itself, so
    chains of derived columns do not grow exponentially."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def lookup(values: dict[str, object], key: Column) -> Column:
    """A literal map as a column; a missing key gives null."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[key]


def blank_to_null(text: Column) -> Column:
    return F.when(F.trim(text) != "", text)


def wall_time_to_utc(naive: Column) -> Column:
    return F.to_utc_timestamp(naive, PACIFIC)


def utc_time(text: Column) -> Column:
    """ISO text to a UTC timestamp: as written if it has an offset, else Pacific wall time."""
    has_offset = text.rlike(r"([+-]\d\d:?\d\d|Z)$")
    return F.when(has_offset, text.try_cast("timestamp")).otherwise(wall_time_to_utc(text.try_cast("timestamp_ntz").cast("timestamp")))


def event_time(text: Column) -> Column:
    """A date such as ``Jan 5, 2024``, midnight Pacific, in UTC."""
    tidy = F.initcap(F.trim(text))
    return wall_time_to_utc(F.try_to_timestamp(tidy, F.lit("MMM d, yyyy")))


def area(text: Column, joined_unit: bool = False) -> Column:
    """``2000.0 sqft`` as struct<value, unit>; with ``joined_unit`` the unit may be several words."""
    parts = F.split(text, " ")
    right_size = F.size(parts) >= 2 if joined_unit else F.size(parts) == 2
    unit = F.lower(F.concat_ws("", F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))))
    units = AREA_UNITS if joined_unit else {k: v for k, v in AREA_UNITS.items() if k != "squarefeet"}
    value, name = F.try_element_at(parts, F.lit(1)).try_cast("decimal(18,4)"), lookup(units, unit)
    return F.when(right_size & value.isNotNull() & name.isNotNull(), F.struct(value.alias("value"), name.alias("unit")))


def area_error(text: Column, joined_unit: bool = False) -> Column:
    """The reject code of an area text, or null."""
    parts = F.split(text, " ")
    wrong_size = F.size(parts) < 2 if joined_unit else F.size(parts) != 2
    number = F.try_element_at(parts, F.lit(1)).try_cast("decimal(18,4)")
    return F.when(text.isNull(), None).when(wrong_size, "InvalidPropertyDataFormat").when(number.isNull(), "Unexpected").when(area(text, joined_unit).isNull(), "UnknownAreaUnit")


def square_feet(value: Column) -> Column:
    return value["value"].cast("double") * lookup(IN_SQUARE_FEET, value["unit"])


def money(text: Column) -> Column:
    """``$1,250,000`` as a decimal."""
    return F.translate(text, "$,", "").try_cast("decimal(18,2)")
