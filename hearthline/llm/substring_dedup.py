"""Substring dedup: Rabin-Karp hashes of every fixed-length word window, counted in Spark.

A word goes if a window of ``window`` words of its document covers it and the same word
sequence also starts in a document with a smaller id. Repeated windows merge into maximal
removal intervals.

Only windows that can repeat are shuffled. Equal windows hold equal half-windows, so they
share the smallest of their half-window hashes (the minimiser). Pass one emits each run of
windows with one minimiser as one row, with a 128-bit hash of all the words that the run
spans. Spark counts runs by minimiser and drops those that stand alone. Among equal runs, all
but the first document's are removed whole; the first one stands for them. Only where a
minimiser has several different runs, pass two emits the 128-bit hashes of the windows in the
runs that stand for others, and Spark finds each window's first document. This loses no
repeated window, copies by the thousand cost one run each, and every count is pre-aggregated.

Defined results: a null text has no words; a null id neither removes nor is removed from;
rows that repeat an id are each cut by the same rule and never by one another, so nothing
ties; long texts are cut whole; an empty table gives an empty result; other columns are kept,
and a column named as one of the results raises ValueError.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw
from .support import discard, fresh_name, refuse_clashes, stash, tidy


@dataclass
class _Runs:
    """The windows of some texts and their runs: run k holds windows first[k]:last[k]."""

    words: bw.Words
    hashes: np.ndarray
    starts: np.ndarray
    text: np.ndarray
    least: np.ndarray
    first: np.ndarray
    last: np.ndarray
    window: int

    def spans(self, base: str) -> np.ndarray:
        return bw.span_hash(self.hashes, self.starts[self.first], self.starts[self.last - 1] + self.window, base)

    def windows(self, which: np.ndarray, base: str) -> np.ndarray:
        at = self.starts[which]
        return bw.span_hash(self.hashes, at, at + self.window, base)


def _runs(buffer: np.ndarray, offsets: np.ndarray, window: int) -> _Runs:
    words = bw.find_words(buffer, offsets)
    hashes, sub, none = words.hashes(), max(1, window // 2), np.zeros(0, np.int64)
    text = words.text_of()
    starts = np.flatnonzero(np.arange(len(hashes)) <= words.first[1:][text] - window)
    if not len(starts):
        return _Runs(words, hashes, none, none, none.astype(np.uint64), none, none, window)
    at = np.arange(len(hashes) - sub + 1)
    least, width, target = bw.span_hash(hashes, at, at + sub, "word"), 1, window - sub + 1
    while width * 2 <= target:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < target:
        least = np.minimum(least[: len(least) - (target - width)], least[target - width :])
    least, text = least[starts], text[starts]
    first = np.concatenate([[0], np.flatnonzero((least[1:] != least[:-1]) | (text[1:] != text[:-1])) + 1])
    return _Runs(words, hashes, starts, text, least, first, np.append(first[1:], len(starts)), window)


def _listed(runs_text: np.ndarray, values: np.ndarray, lists: pa.Array, row: int, rows: int) -> np.ndarray:
    """Which values are in the list of their text; both sorted by text."""
    hit, bounds = np.zeros(len(values), bool), np.searchsorted(runs_text, np.arange(rows + 1))
    valid = np.asarray(lists.is_valid())
    for d in range(rows):
        a, b = bounds[d], bounds[d + 1]
        if a < b and valid[row + d]:
            hit[a:b] = np.isin(values[a:b], lists[row + d].values.to_numpy(zero_copy_only=False).view(np.uint64))
    return hit


def _emit_runs(window: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for row, to, buffer, offsets in bw.chunks(batch):
                r = _runs(buffer, offsets, window)
                if len(r.first):
                    columns = (r.least[r.first], r.spans("word"), r.spans("second"))
                    yield pa.RecordBatch.from_arrays([ids.slice(row, to - row).take(pa.array(r.text[r.first])), *(pa.array(c.view(np.int64)) for c in columns)], ["id", "m", "g1", "g2"])

    return tidy(run)


def _emit_windows(window: int):
    def run(batches):
        for batch in batches:
            ids, lists = batch.column(0), batch.column(2)
            for row, to, buffer, offsets in bw.chunks(batch):
                r = _runs(buffer, offsets, window)
                if len(r.first):
                    asked = _listed(r.text[r.first], r.spans("word"), lists, row, to - row)
                    which = np.flatnonzero(np.repeat(asked, r.last - r.first))
                    columns = (r.windows(which, base).view(np.int64) for base in ("word", "second"))
                    yield pa.RecordBatch.from_arrays([ids.slice(row, to - row).take(pa.array(r.text[which])), *map(pa.array, columns)], ["id", "h1", "h2"])

    return tidy(run)


def _cut(window: int, text_name: str, at_cuts: int, added: pa.Schema):
    def run(batches):
        for batch in batches:
            cuts = batch.column(at_cuts)
            for row, to, buffer, offsets in bw.chunks(batch, text_name):
                r = _runs(buffer, offsets, window)
                hit = np.repeat(_listed(r.text[r.first], r.spans("word"), cuts, row, to - row), r.last - r.first)
                hit |= _listed(r.text, r.windows(np.arange(len(r.starts)), "word"), cuts, row, to - row)
                edge = np.zeros(len(r.hashes) + 1, np.int64)
                edge[r.starts[hit]] += 1
                edge[r.starts[hit] + window] -= 1
                gone, first = np.cumsum(edge[:-1]) > 0, r.words.first
                n, spans, kept = [], [], []
                for d in range(to - row):
                    text, own = bytes(buffer[offsets[d] : offsets[d + 1]]).split(), gone[first[d] : first[d + 1]]
                    turn = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0)) if own.any() else []
                    n.append(int(own.sum()))
                    spans.append([{"start": int(x), "end": int(y)} for x, y in zip(turn[::2], turn[1::2])])
                    kept.append(b" ".join(w for w, g in zip(text, own.tolist()) if not g) if n[-1] else b" ".join(text))
                part = batch.slice(row, to - row)
                made = [pa.array(r.words.counts, pa.int64()), pa.array(n, pa.int64()), pa.array(spans, added.field("removed_spans").type), pa.array(kept, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([c for k, c in enumerate(part.columns) if k != at_cuts] + made, schema=pa.schema([f for k, f in enumerate(part.schema) if k != at_cuts] + list(added)))

    return tidy(run)


def remove_repeated_windows(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, n_removed, removed_spans (word positions, end exclusive) and kept_text
    (kept words joined by one space)."""
    refuse_clashes(docs, ["n_words", "n_removed", "removed_spans", "kept_text"])
    id_type = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("id").isNotNull())
    runs = stash(slim.mapInArrow(_emit_runs(window), f"id {id_type}, m long, g1 long, g2 long"))
    several = runs.groupBy("m").agg(F.count("*").alias("n")).where("n > 1").select("m")
    every, runs = runs, stash(runs.join(several, "m", "left_semi"))
    discard(every)
    firsts = stash(runs.groupBy("m", "g1", "g2").agg(F.min("id").alias("lo")))
    differ = firsts.groupBy("m").agg(F.count("*").alias("n")).where("n > 1").select("m")
    asked = firsts.join(differ, "m", "left_semi").groupBy(F.col("lo").alias("id")).agg(F.collect_set("g1").alias("asked"))
    found = stash(slim.join(asked, "id").select("id", "text", "asked").mapInArrow(_emit_windows(window), f"id {id_type}, h1 long, h2 long"))
    earliest = found.groupBy("h1", "h2").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("h1", "h2", "lo")
    late_windows = found.join(earliest, ["h1", "h2"]).where("id > lo").select("id", F.col("h1").alias("cut"))
    late_runs = runs.join(firsts, ["m", "g1", "g2"]).where("id > lo").select("id", F.col("g1").alias("cut"))
    cuts_name = fresh_name(docs, "cuts")
    cuts = stash(late_windows.union(late_runs).groupBy(F.col("id").alias(fresh_name(docs, "cut_id"))).agg(F.collect_set("cut").alias(cuts_name)))
    discard(runs, firsts, found)
    joined = docs.join(cuts, docs[id_col] == cuts[cuts.columns[0]], "left").select(*[docs[c] for c in docs.columns], cuts[cuts_name])
    added = pa.schema([("n_words", pa.int64()), ("n_removed", pa.int64()), ("removed_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_text", pa.string())])
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + ["n_words long, n_removed long, removed_spans array<struct<start: long, end: long>>, kept_text string"])
    return joined.mapInArrow(_cut(window, text_col, len(docs.columns), added), ddl)


def query(spark, sf_dir: str) -> DataFrame:
    from .support import documents

    out = remove_repeated_windows(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
