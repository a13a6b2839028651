"""Address standardisation: a fixed grammar over comma segments, as column expressions.

Statistical tagging is in ``address_tags``; the grammar covers house number and
street with suffix and directionals, units in several notations, city, state and zip code. What it
cannot read comes out null and is rejected downstream with code InvalidPropertyAddress.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .values import lookup, staged

# Abbreviations of street suffixes.
SUFFIXES = {
    "street": "St", "st": "St", "avenue": "Ave", "ave": "Ave", "boulevard": "Blvd", "blvd": "Blvd", "road": "Rd", "rd": "Rd",
    "drive": "Dr", "dr": "Dr", "lane": "Ln", "ln": "Ln", "court": "Ct", "ct": "Ct", "place": "Pl", "pl": "Pl", "terrace": "Ter",
    "ter": "Ter", "circle": "Cir", "cir": "Cir", "parkway": "Pkwy", "pkwy": "Pkwy", "way": "Way", "trail": "Trl", "trl": "Trl",
    "highway": "Hwy", "hwy": "Hwy", "driveway": "Dr", "drwy": "Dr",
}
# Abbreviations of directions.
DIRECTIONS = {
    "north": "N", "n": "N", "south": "S", "s": "S", "east": "E", "e": "E", "west": "W", "w": "W", "northeast": "NE", "ne": "NE",
    "northwest": "NW", "nw": "NW", "southeast": "SE", "se": "SE", "southwest": "SW", "sw": "SW",
}
# Words that announce a unit.
UNITS = {"apartment": "APT", "apt": "APT", "unit": "APT", "suite": "STE", "ste": "STE"}

_UNIT_WORD = "|".join(UNITS)
_LOT = r"^([^(]*)\(\s*((?i:hs|lot)[^)]*)\)([^,]*)(,.*)$"
_TAIL = r"^(.*?),?\s*\b([A-Za-z]{2}),?\s+(\d{5}(?:-\d{4})?)\s*$"
_LONE_UNIT = rf"(?i)^(?:(?:{_UNIT_WORD})\b\.?|#)\s*\S+$"
_NAMED_UNIT = rf"(?i)^(.*\S)\s+({_UNIT_WORD})\b\.?\s+#?(\S+)$"
_NUMBERED_UNIT = r"(?i)^(.*?\S)\s+(?:homesite\s*)?#\s*(\S+)$"
_BARE_UNIT = rf"(?i)^(.*\s(?:{'|'.join(SUFFIXES)})(?:\s+(?:{'|'.join(DIRECTIONS)}))?)\s+([a-z]*\d[a-z0-9]*)$"


def has_unit_word(text: Column) -> Column:
    """By substring, so words that merely contain one count as well."""
    return F.lower(text).rlike(_UNIT_WORD)


def tidy(text: Column) -> Column:
    """Lot notes in brackets become a unit behind the street, unless one is there; others are unwrapped."""
    spaced = F.trim(F.regexp_replace(text, r"\s+", " "))
    part = lambda k: F.regexp_extract(spaced, _LOT, k)
    label = F.regexp_replace(F.replace(part(2), F.lit("#"), F.lit("")), r"^(HS|Lot)", "APT")
    street = F.trim(F.regexp_replace(F.concat_ws(" ", F.trim(part(1)), F.trim(part(3))), r"\s+", " "))
    outside = F.concat(part(1), part(3), part(4))
    moved = F.concat(street, F.when(has_unit_word(outside), "").otherwise(F.concat(F.lit(" "), F.trim(label))), part(4))
    unwrapped = F.translate(F.regexp_replace(spaced, r"(?i)\s*\(\s*private lane\s*\)", ""), "()", "")
    return F.when(spaced.rlike(_LOT), moved).otherwise(unwrapped)


def _street(line: Column) -> Column:
    """Abbreviate a trailing direction, the suffix before it, and a direction behind the number."""
    words = F.split(F.trim(line), r"\s+")
    n = F.size(words)
    directed = ((n > 2) & lookup(DIRECTIONS, F.lower(F.element_at(words, -1))).isNotNull()).cast("int")

    def word(x: Column, i: Column) -> Column:
        low = F.lower(x)
        as_direction, as_suffix = F.coalesce(lookup(DIRECTIONS, low), x), F.coalesce(lookup(SUFFIXES, low), x)
        return F.when((directed == 1) & (i == n - 1), as_direction).when(i == n - 1 - directed, as_suffix).when((i == 1) & (n > 3), as_direction).otherwise(x)

    return F.array_join(F.transform(words, word), " ")


def address_hash(street: Column, unit: Column, city: Column, state: Column, zip_code: Column) -> Column:
    return F.translate(F.lower(F.concat_ws(",", street, F.when(unit != "", unit), city, state, zip_code)), " ,", "-|")


def standardise(df: DataFrame, source: str, out: str = "parsed_address") -> DataFrame:
    """Add struct column ``out``: street, unit, city, state, zip_code, address_hash; null if unreadable."""
    keep = [c for c in df.columns if c != out]
    df = staged(df.select(*keep), {"_text": tidy(F.coalesce(F.col(source), F.lit("")))})
    tail = lambda k: F.regexp_extract("_text", _TAIL, k)
    df = staged(df, {"_segments": F.filter(F.transform(F.split(tail(1), ","), lambda x: F.trim(x)), lambda x: x != ""), "_state": tail(2), "_zip": tail(3)})
    segments = F.col("_segments")
    line = F.when((F.size(segments) > 2) & F.get(segments, F.lit(0)).rlike(_LONE_UNIT), F.concat_ws(" ", F.get(segments, F.lit(1)), F.get(segments, F.lit(0)), F.array_join(F.slice(segments, 3, F.greatest(F.size(segments) - 3, F.lit(0))), " ")))
    rest = F.array_join(F.slice(segments, 1, F.greatest(F.size(segments) - 1, F.lit(0))), " ")
    df = staged(df, {"_line": F.trim(F.coalesce(line, rest)), "_city": F.try_element_at(segments, F.lit(-1))})
    named = lambda k: F.regexp_extract("_line", _NAMED_UNIT, k)
    numbered = lambda k: F.regexp_extract("_line", _NUMBERED_UNIT, k)
    bare = lambda k: F.regexp_extract("_line", _BARE_UNIT, k)
    unit = F.when(named(1) != "", F.concat_ws(" ", lookup(UNITS, F.lower(named(2))), named(3))).when(numbered(1) != "", F.concat(F.lit("APT "), numbered(2))).when(bare(1) != "", bare(2)).otherwise("")
    street = F.when(named(1) != "", named(1)).when(numbered(1) != "", numbered(1)).when(bare(1) != "", bare(1)).otherwise(F.col("_line"))
    df = staged(staged(df, {"_unit": unit, "_plain": street}), {"_street": _street(F.col("_plain"))})
    fields = [F.col(f"_{c}") for c in ("street", "unit", "city", "state", "zip")]
    whole = (F.size(segments) >= 2) & (F.col("_street") != "") & (F.col("_city") != "") & (F.col("_state") != "") & (F.col("_zip") != "")
    made = F.struct(*[f.alias(n) for f, n in zip(fields, ("street", "unit", "city", "state", "zip_code"))], address_hash(*fields).alias("address_hash"))
    return staged(df, {out: F.when(whole, made)}).select(*keep, out)
