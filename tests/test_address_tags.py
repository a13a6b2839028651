"""Tagging of addresses: decoding against all labellings, held-out addresses, and the known cases."""

import itertools
import math
import random

import pytest

from hearthline.functions import address_tags
from tests.test_functions import HASHES

STREETS = ["Oak", "Old Mill", "Crockett", "166th", "Market", "X Dave", "NE Juanita", "Lake Forest Park", "5th", "Juanita"]
CITIES = ["Bend", "Seattle", "Lake Forest Park", "Redmond", "Saint Paul", "Mill Creek"]
ENDS = [("Street", "St"), ("Ave", "Ave"), ("Blvd", "Blvd"), ("Road", "Rd"), ("Ct", "Ct"), ("Pl", "Pl"), ("Way", "Way"), ("Drive", "Dr"), ("Ln", "Ln")]
WAYS = [("NE", "NE"), ("North", "N"), ("SW", "SW"), ("East", "E")]


def made(draw):
    """(labelled pieces, address hash) of a random address."""
    def road():
        name, end = draw.choice(STREETS), draw.choice(ENDS)
        before, after = (draw.choice(WAYS) if draw.random() < 0.25 and not name.startswith("NE ") else None), (draw.choice(WAYS) if draw.random() < 0.25 else None)
        words = [(w, "direction_before") for w in [before and before[0], "NE" if name.startswith("NE ") else None] if w]
        pieces = [*words, (name.removeprefix("NE "), "name"), (end[0], "suffix")] + ([(after[0], "direction_after")] if after else [])
        return pieces, " ".join([*([before[1]] if before else []), name, end[1], *([after[1]] if after else [])])

    pieces, street = road()
    unit = ""
    if draw.random() < 0.12:
        more, other = road()
        pieces, street = [*pieces, (draw.choice(["and", "&"]), "joint"), *more], f"{street} & {other}"
    else:
        number = str(draw.randrange(1, 20000))
        pieces, street = [(number, "number"), *pieces], f"{number} {street}"
        if draw.random() < 0.5:
            value = draw.choice([str(draw.randrange(1, 400)), f"{draw.choice('ABc')}{draw.randrange(1, 99)}", "E"])
            word, short = draw.choice([("Apt", "APT"), ("Unit", "APT"), ("Suite", "STE"), ("#", "APT"), (None, "")])
            if word is None and value[:1] not in "ABc":
                word, short = "Unit", "APT"
            told = [*([(word, "unit_word")] if word else []), (value, "unit")]
            unit = f"{short} {value}".strip()
            if word and draw.random() < 0.2:
                pieces = [*told, (", " + pieces[0][0], "number"), *pieces[1:]]
            else:
                pieces += [(draw.choice(["", ", "]) + told[0][0], told[0][1]), *told[1:]]
    comma = ", " if draw.random() < 0.7 else ""
    city, state, code = draw.choice(CITIES), draw.choice(["WA", "OR", "CT"]), f"9{draw.randrange(1000, 9999)}" + draw.choice(["", "-1234"])
    pieces += [(comma + city, "city"), (comma + state, "state"), (draw.choice(["", ", "]) + code, "zip_code")]
    return pieces, ",".join(p for p in (street, unit, city, state, code) if p).lower().replace(" ", "-").replace(",", "|")


def text_of(pieces):
    return " ".join(t for t, _ in pieces).replace(" ,", ",")


@pytest.fixture(scope="module")
def model(spark):
    draw = random.Random(3)
    return address_tags.fit(spark.createDataFrame([(made(draw)[0],) for _ in range(3000)], "pieces array<struct<text: string, label: string>>"))


def test_held_out_addresses(spark, model):
    draw = random.Random(4)
    rows = [(text_of(p), want) for p, want in (made(draw) for _ in range(400))]
    got = address_tags.tag(spark.createDataFrame(rows, "text string, want string"), "text", model).collect()
    right = sum(r.tagged_address is not None and r.tagged_address.address_hash == r.want for r in got)
    wrong = [(r.text, r.tagged_address.address_hash) for r in got if r.tagged_address is not None and r.tagged_address.address_hash != r.want]
    assert right >= 0.98 * len(rows) and len(wrong) <= 0.01 * len(rows)


def test_known_addresses(spark, model):
    cases = [tuple(line.split(" -> ")) for line in HASHES.split("\n")]
    got = address_tags.tag(spark.createDataFrame(cases, "text string, want string"), "text", model).collect()
    differ = [(r.text, r.tagged_address and r.tagged_address.address_hash) for r in got if not r.tagged_address or r.tagged_address.address_hash != r.want]
    assert differ == []


def test_decoding_equals_all_labellings(spark, model):
    n, texts = len(address_tags.LABELS), ["Apt 4, Oak", "12 NE Main St", "WA 98101"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("w", address_tags.words(address_tags.F.col("text")))
    df = df.withColumn("k", address_tags.F.transform("w", lambda w: w["kind"]))
    for r in df.withColumn("d", address_tags._decode(address_tags.F.col("k"), model)).collect():
        scores = {}
        for path in itertools.product(range(n), repeat=len(r.k)):
            s = model.first[path[0]] + model.last[path[-1]] + sum(model.step[a * n + b] for a, b in itertools.pairwise(path)) + sum(model.kind[k * n + j] for k, j in zip(r.k, path))
            scores["".join(chr(97 + j) for j in path)] = s
        assert r.d.s == pytest.approx(max(scores.values())) and scores[r.d.p] == pytest.approx(r.d.s)
        assert r.d.z == pytest.approx(math.log(sum(map(math.exp, scores.values()))))


def test_rejects(spark, model):
    rows = [(None, 1), ("", 2), ("nowhere", 3), ("oak " * 5000, 4), ("Seattle, WA 98101", 5), ("# , #", 6), ("12 Oak St, Bend, OR 97701", 7), ("12 Oak St, Bend, OR 97701", 8)]
    df = spark.createDataFrame(rows, "tagged_address string, _n int")
    got = {r._n: r.out for r in address_tags.tag(df, "tagged_address", model, out="out").collect()}
    assert [got[k] for k in range(1, 7)] == [None] * 6 and got[7].street == "12 Oak St" and got[7] == got[8] and got[7].confidence > 0.5
    assert address_tags.tag(df, "tagged_address", model, least=1.1).where("tagged_address is not null").count() == 0
