import datetime as dt

import pytest
from pyspark.sql import functions as F

from hearthline.functions import address, classify, keys, values

# Addresses and their hashes.
HASHES = """1838 Market St, Kirkland, WA 98033 -> 1838-market-st|kirkland|wa|98033
7425 166th Ave NE c230, Redmond, WA 98052 -> 7425-166th-ave-ne|c230|redmond|wa|98052
7301 NE 175th St,Kenmore, WA 98028 -> 7301-ne-175th-st|kenmore|wa|98028
Apt 116, 6910 Old Redmond Rd, Redmond, WA, 98052 -> 6910-old-redmond-rd|apt-116|redmond|wa|98052
7301 NE 175th Street, Kenmore, WA 98028 -> 7301-ne-175th-st|kenmore|wa|98028
655 Crockett St Unit A107,Seattle, WA 98109 -> 655-crockett-st|apt-a107|seattle|wa|98109
655 Crockett St APT A107, Seattle, WA 98109 -> 655-crockett-st|apt-a107|seattle|wa|98109
6910 Old Redmond Rd #116,Redmond, WA 98052 -> 6910-old-redmond-rd|apt-116|redmond|wa|98052
1203 X Dave Road, Redmond, WA 98052 -> 1203-x-dave-rd|redmond|wa|98052
1203 X Dave Rd,Redmond, WA 98052 -> 1203-x-dave-rd|redmond|wa|98052
7988 170th Ave NE (Homesite #14),Redmond, WA 98052 -> 7988-170th-ave-ne|apt-14|redmond|wa|98052
11170 (HS #24) NE 134th Ct NE, Redmond, WA 98052 -> 11170-ne-134th-ct-ne|apt-24|redmond|wa|98052
13468 (HS #9) NE 112th Pl, Redmond, WA 98052 -> 13468-ne-112th-pl|apt-9|redmond|wa|98052
11162 (HS 23) 134th Ct NE, Redmond, WA 98052 -> 11162-134th-ct-ne|apt-23|redmond|wa|98052
7223 NE 118th (Lot #6) Ct, Kirkland, WA 98034 -> 7223-ne-118th-ct|apt-6|kirkland|wa|98034
10814 (HS 65) 120TH Ln NE Unit E, Kirkland, WA 98033 -> 10814-120th-ln-ne|apt-e|kirkland|wa|98033
8533 NE Juanita Dr (Private Lane), Kirkland, WA 98034 -> 8533-ne-juanita-dr|kirkland|wa|98034
12 Northeast Oak Avenue Northwest, Bend, OR 97701-1234 -> 12-ne-oak-ave-nw|bend|or|97701-1234"""


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_address_hashes(spark):
    cases = [tuple(line.split(" -> ")) for line in HASHES.split("\n")]
    got = address.standardise(spark.createDataFrame(cases, "a string, want string"), "a").collect()
    assert [(r.a, r.parsed_address and r.parsed_address.address_hash) for r in got] == [(r.a, r.want) for r in got]


def test_address_parts_and_unreadable(spark):
    rows = ["1838 Market St,Kirkland, WA 98033", "Apt 116, 6910 Old Redmond Rd, Redmond, WA 98052", "655 Crockett St Unit A101,Seattle, WA 98109", "6928 155th Place SE, Snohomish, WA 98296", "nowhere", "Seattle, WA 98101", "", None]
    got = {r.a: r.parsed_address for r in address.standardise(spark.createDataFrame([(r,) for r in rows], "a string"), "a").collect()}
    assert [(got[r].street, got[r].unit) for r in rows[:4]] == [("1838 Market St", ""), ("6910 Old Redmond Rd", "APT 116"), ("655 Crockett St", "APT A101"), ("6928 155th Pl SE", "")]
    assert [got[r] for r in rows[4:]] == [None] * 4


@pytest.mark.parametrize(("text", "want"), [("2024-01-15T10:30:00Z", "2024-01-15 10:30"), ("2024-01-15T10:30:00+02:00", "2024-01-15 08:30"), ("2024-01-15T10:30:00", "2024-01-15 18:30"), ("2024-07-15 10:30:00", "2024-07-15 17:30"), ("soon", None), (None, None)])
def test_utc_time(spark, text, want):
    got = one(spark, values.utc_time(F.lit(text).cast("string")))
    assert got == (want and dt.datetime.fromisoformat(want))


def test_event_time_and_area(spark):
    assert one(spark, values.event_time(F.lit("aug 5, 2025"))) == dt.datetime(2025, 8, 5, 7)
    assert one(spark, values.event_time(F.lit("soonish"))) is None
    assert tuple(one(spark, values.area(F.lit("2000.5 sqft")))) == (pytest.approx(2000.5), "SquareFeet")
    assert one(spark, values.area(F.lit("3 sq ft"), True)).unit == "SquareFeet"
    assert one(spark, values.area_error(F.lit("3 sq ft"))) == "InvalidPropertyDataFormat"
    assert one(spark, values.area_error(F.lit("x sqft"))) == "Unexpected"
    assert one(spark, values.area_error(F.lit("3 miles"))) == "UnknownAreaUnit"
    assert float(one(spark, values.money(F.lit("$1,250,000")))) == 1250000


def test_event_types(spark):
    cases = {"Listed (Active)": "Listed", "Listed for Rent": "ListedForRent", "Listed, current owner": "ListedForRent", "SOLD (MLS)": "Sold", "Price Changed": "PriceChange", "Relisted": "ReListed", "Delisted": "DeListed", "Listing Removed": "ListRemoved", "Rental Removed": "RentalRemoved", "Contingent": "Contingent", "Painted": None}
    got = spark.createDataFrame([(k,) for k in cases], "d string").select("d", classify.event_type(F.col("d")).alias("t")).collect()
    assert dict(got) == cases


DAY = dt.datetime(2024, 5, 20, 12)


def at(days):
    return DAY - dt.timedelta(days=days)


@pytest.mark.parametrize(
    ("text", "events", "want"),
    [
        ("for sale - active", [], "Active"),
        ("pending - backup", [], "Pending"),
        ("rental removed", [], "RentalRemoved"),
        ("Sold on x", [], "Sold"),
        ("off market— sold jan", [(3, "PriceChange")], "ListRemoved"),
        ("off market— sold jan", [(3, "Sold")], "Sold"),
        ("off market— sold jan", [], "UnknownPropertyStatus"),
        ("soldtoday", [(3, "Sold")], "Sold"),
        ("soldon may 1, 2024", [(300, "Sold"), (299, "Pending")], "Sold"),
        ("soldyesterday", [(90, "RentalRemoved")], "RentalRemoved"),
        ("soldon may 1, 2024", [(90, "Listed")], "ListRemoved"),
        ("soldon may 1, 2024", [(90, "PriceChange")], "ListRemoved"),
        ("soldon may 1, 2024", [(2, "PriceChange")], "Sold"),
        ("soldon may 1, 2024", [], "Sold"),
        ("soldsome day", [], "Unexpected"),
        ("closed", [(9, "Listed"), (5, "ListedForRent"), (1, "Sold")], "RentalRemoved"),
        ("closed", [(9, "ListedForRent"), (5, "Listed")], "ListRemoved"),
        ("closed", [], "UnknownPropertyStatus"),
        ("who knows", [], "UnknownPropertyStatus"),
    ],
)
def test_status_rules(spark, text, events, want):
    row = [(text, [(at(d), t, t) for d, t in events], DAY)]
    df = spark.createDataFrame(row, "s string, e array<struct<event_ts: timestamp, event_type: string, description: string>>, n timestamp")
    got = df.select(classify.resolve_status(F.col("s"), F.col("e"), F.col("n")).alias("x")).first().x
    assert (got.status or got.error) == want


def test_keys(spark):
    index = keys.location_index(F.lit("WA"), F.lit("Kirkland"), F.lit("98033"), F.lit("Condo"))
    assert one(spark, index) == "WA#Kirkland#98033#Condo"
    assert tuple(one(spark, keys.parse_location_index(index, ["Condo"]))) == ("WA", "Kirkland", 98033, "Condo")
    assert one(spark, keys.parse_location_index(index, ["Townhome"])) is None
    assert one(spark, keys.composite_part(F.lit("PROPERTY#7"), 2, 2)) == "7" and one(spark, keys.composite_part(F.lit("PROPERTY"), 2, 2)) is None
