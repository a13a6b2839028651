"""Address tagging: words labelled by Viterbi decoding with a small fitted table, as column expressions.

Where the grammar of ``address`` wants its commas, a hidden Markov model over kinds of words also reads addresses
without them, in other orders, and intersections of two streets. ``fit`` counts the model from labelled words with
Spark (labels x labels and kinds x labels numbers, whatever the size of the data); ``tag`` decodes with it. The
confidence is the probability of the decoded labels among all labellings of the same words; below ``least``, or
without a street, city, state and zip code, an address comes out null and is to be rejected.

Null and empty texts, and those of more than 64 words, are no addresses: null. Labels that tie: the later label of
``LABELS`` counts, from the end of the text. Columns of the caller stay; one named as the result is replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .address import DIRECTIONS, SUFFIXES, UNITS, address_hash, tidy
from .values import lookup, staged

LABELS = ["number", "direction_before", "name", "suffix", "direction_after", "joint", "unit_word", "unit", "city", "state", "zip_code"]
KINDS = ["hash", "joint", "zip", "digits", "ordinal", "direction", "suffix", "unit_word", "two_letters", "letter", "mixed", "word", "other"]
STREET = ["number", "direction_before", "name", "suffix", "direction_after", "joint"]
MOST_WORDS = 64
_WORDS = r"[,\s]*(?:#|[^\s,#]+)"


def words(text: Column) -> Column:
    """array<struct<word, kind>>: words of a text, a ``#`` by itself, and their kinds; a comma before a word is part of its kind."""
    return F.transform(F.regexp_extract_all(text, F.lit(_WORDS), F.lit(0)), lambda t: F.struct(F.regexp_replace(t, r"^[,\s]+", "").alias("word"), _kind(t).alias("kind")))


def _kind(token: Column) -> Column:
    """Place in ``KINDS``, further on by their number behind a comma."""
    low = F.lower(F.regexp_replace(token, r"^[,\s]+|\.$", ""))
    tests = {
        "hash": low == "#", "joint": low.isin("&", "and", "at"), "zip": low.rlike(r"^\d{5}(-\d{4})?$"), "digits": low.rlike(r"^\d+$"), "ordinal": low.rlike(r"^\d+(st|nd|rd|th)$"),
        "direction": low.isin(list(DIRECTIONS)), "suffix": low.isin(list(SUFFIXES)), "unit_word": low.isin(list(UNITS)), "two_letters": low.rlike("^[a-z]{2}$"), "letter": low.rlike("^[a-z]$"),
        "mixed": low.rlike(r"\d"), "word": low.rlike(r"^\p{L}"),
    }
    kind = reduce(lambda out, k: out.when(tests[k], KINDS.index(k)), tests, F.when(F.lit(False), 0)).otherwise(KINDS.index("other"))
    return kind + F.when(token.contains(","), len(KINDS)).otherwise(0)


@dataclass(frozen=True)
class Model:
    """Log probabilities: first labels, label to label (flat), last labels, and kinds by label (flat, by kind)."""

    first: list[float]
    step: list[float]
    last: list[float]
    kind: list[float]


def fit(labelled: DataFrame, pieces: str = "pieces", smoothing: float = 0.1) -> Model:
    """``pieces``: array<struct<text, label>>, an address cut into labelled pieces of one or more words each."""
    each = F.transform(pieces, lambda p: F.transform(words(p["text"]), lambda w: F.struct(w["kind"].alias("kind"), (F.array_position(F.array(*[F.lit(x) for x in LABELS]), p["label"]) - 1).cast("int").alias("label"))))
    rows = staged(labelled.select(pieces), {"_words": F.flatten(each)}).where(F.size("_words") > 0)
    ends = F.array(F.lit(len(LABELS)))
    path = F.concat(ends, F.transform("_words", lambda w: w["label"]), ends)
    pairs = F.transform(F.sequence(F.lit(1), F.size("_words") + 1), lambda i: F.struct(F.lit(0).alias("of"), F.element_at(path, i).alias("a"), F.element_at(path, i + 1).alias("b")))
    kinds = F.transform("_words", lambda w: F.struct(F.lit(1).alias("of"), w["label"].alias("a"), w["kind"].alias("b")))
    counts = {(r.of, r.a, r.b): r.n for r in rows.select(F.inline(F.concat(pairs, kinds))).groupBy("of", "a", "b").agg(F.count("*").alias("n")).collect()}
    n = len(LABELS)

    def logs(of: int, a: int, size: int) -> list[float]:
        row = [counts.get((of, a, b), 0) + smoothing for b in range(size)]
        return [math.log(x / sum(row)) for x in row]

    steps, emitted = [logs(0, a, n + 1) for a in range(n + 1)], [logs(1, a, 2 * len(KINDS)) for a in range(n)]
    return Model(steps[n][:n], [x for a in range(n) for x in steps[a][:n]], [steps[a][n] for a in range(n)], [emitted[a][k] for k in range(2 * len(KINDS)) for a in range(n)])


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, as a lambda's argument is."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _onward(reached: Column, shown: Column, letter: Column) -> Column:
    """The state of a label from the states it is reached from: the best path, and the log of the sum over all paths."""

    def state(r: Column, top: Column) -> Column:
        z = top["z"] + F.log(F.aggregate(r, F.lit(0.0), lambda total, a: total + F.exp(a["z"] - top["z"])))
        return F.struct((top["best"]["s"] + shown).alias("s"), F.concat(top["best"]["p"], letter).alias("p"), (z + shown).alias("z"))

    tops = lambda r: F.struct(F.array_max(r).alias("best"), F.array_max(F.transform(r, lambda a: a["z"])).alias("z"))
    return _let(reached, lambda r: _let(tops(r), lambda top: state(r, top)))


def _decode(cells: Column, model: Model) -> Column:
    """struct<s, p, z> for the kinds ``cells``: log probability and labels (letters from ``a`` on) of the best path, and that of all paths together."""
    n = len(LABELS)
    table = lambda v: F.array(*[F.lit(x) for x in v])
    first, step, last, kind = table(model.first), table(model.step), table(model.last), table(model.kind)
    letter = lambda j: F.get(F.array(*[F.lit(chr(97 + k)) for k in range(n)]), j)
    all_labels = F.sequence(F.lit(0), F.lit(n - 1))
    after = lambda state, log: F.transform(state, lambda a, i: F.struct((a["s"] + log(i)).alias("s"), a["p"].alias("p"), (a["z"] + log(i)).alias("z")))

    def start(j: Column) -> Column:
        log = F.get(first, j) + F.get(kind, F.get(cells, F.lit(0)) * n + j)
        return F.struct(log.alias("s"), letter(j).alias("p"), log.alias("z"))

    def onward(state: Column, cell: Column) -> Column:
        return F.transform(all_labels, lambda j: _onward(after(state, lambda i: F.get(step, i * n + j)), F.get(kind, cell * n + j), letter(j)))

    ends = F.aggregate(F.slice(cells, 2, F.size(cells)), F.transform(all_labels, start), onward)
    return _onward(after(ends, lambda i: F.get(last, i)), F.lit(0.0), F.lit(""))


def tag(df: DataFrame, source: str, model: Model, least: float = 0.5, out: str = "tagged_address") -> DataFrame:
    """Add struct column ``out``: kind (street or intersection), street, unit, city, state, zip_code, address_hash, confidence."""
    keep = [c for c in df.columns if c != out]
    df = staged(df, {"_words": words(F.regexp_replace(tidy(F.coalesce(F.col(source), F.lit(""))), r"(?i)\bhomesite\s*(?=#)", ""))})
    fits = F.size("_words").between(1, MOST_WORDS)
    df = staged(df, {"_best": F.when(fits, _decode(F.transform("_words", lambda w: w["kind"]), model))})
    labelled = F.zip_with("_words", F.split("_best.p", ""), lambda w, p: F.struct(w["word"].alias("word"), p.alias("label")))
    df = staged(df, {"_labelled": F.filter(labelled, lambda w: w["label"].isNotNull() & w["word"].isNotNull())})
    letter = lambda name: chr(97 + LABELS.index(name))
    plain = lambda w: F.lower(F.regexp_replace(w["word"], r"\.$", ""))

    def part(*names: str) -> Column:
        chosen = F.filter("_labelled", lambda w: w["label"].isin([letter(x) for x in names]))
        short = lambda w: F.when(w["label"].isin(letter("direction_before"), letter("direction_after")), lookup(DIRECTIONS, plain(w))).when(w["label"] == letter("suffix"), lookup(SUFFIXES, plain(w))).when(w["label"] == letter("unit_word"), F.coalesce(lookup(UNITS, plain(w)), F.lit("APT"))).when(w["label"] == letter("joint"), "&")
        return F.array_join(F.transform(chosen, lambda w: F.coalesce(short(w), w["word"])), " ")

    # a unit is told once, though it may be announced twice (Unit # 4)
    unit = F.regexp_replace(part("unit_word", "unit"), r"^((?:APT|STE) )+(?=(?:APT|STE) )", "")
    df = staged(df, {"_street": part(*STREET), "_unit": unit, "_city": part("city"), "_state": part("state"), "_zip": part("zip_code"), "_sure": F.exp(F.col("_best.s") - F.col("_best.z"))})
    fields = [F.col(f"_{c}") for c in ("street", "unit", "city", "state", "zip")]
    has = lambda name: F.exists("_labelled", lambda w: w["label"] == letter(name))
    kind = F.when(has("joint"), "intersection").when(has("number") & has("name"), "street")
    whole = (F.col("_sure") >= least) & kind.isNotNull() & reduce(lambda a, b: a & b, [f != "" for f in (fields[0], *fields[2:])])
    made = F.struct(kind.alias("kind"), *[f.alias(n) for f, n in zip(fields, ("street", "unit", "city", "state", "zip_code"))], address_hash(*fields).alias("address_hash"), F.col("_sure").alias("confidence"))
    return staged(df, {"_made": F.when(whole, made)}).select(*keep, F.col("_made").alias(out))
