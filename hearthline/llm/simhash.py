"""SimHash near-dedup with pigeonring filtering.

A fingerprint bit is set if it is set in over half of the XXH64 values (seed 42) of the
document's word shingles. Fingerprints link at ``max_bits`` (3) or fewer differing bits.

Pigeonring: lay the four 16-bit segments of a fingerprint on a ring. If two fingerprints
differ in 3 bits at most, some segment starts a chain whose first l segments differ in at
most 3 l / 4 bits for every l: none in the first, 1 in two, 2 in three. The first two bounds
are join keys (equal first segment, and an equal half of the second); the third is checked on
each candidate before the full Hamming check. Copies count once, as their distinct
fingerprint; components come from alternating large and small stars on the links between
fingerprints, each round written to the shared scratch folder.

Defined results: null or empty texts have fingerprint zero and link like any other; rows that
repeat are one fingerprint; null ids take part but never name a component unless no id does;
bits set in just half of the shingles are not set; long texts are hashed whole; an empty table
gives no rows; other columns, whatever their names, take no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw
from .support import discard, documents, fresh_name, stash, tidy


def _fingerprints(shingle: int, text_name: str, name: str):
    def run(batches):
        for batch in batches:
            out = []
            for row, to, buffer, offsets in bw.chunks(batch, text_name):
                w = bw.find_words(buffer, offsets, lower=True, compact=True)
                counts = w.counts
                n = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
                total = int(n.sum())
                which = np.repeat(np.arange(len(n)), n)
                first = np.cumsum(n) - n
                at = w.first[:-1][which] + np.arange(total) - first[which]
                last = np.minimum(at + shingle, w.first[1:][which]) - 1
                prints = np.zeros(len(n), np.uint64)
                if total:
                    h = bw.xxh64(w.buffer, w.starts[at], w.ends[last])
                    some = np.flatnonzero(n)
                    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    ones = np.add.reduceat(bits, first[some], axis=0, dtype=np.int32)
                    prints[some] = np.packbits(2 * ones > n[some][:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
                out.append(prints)
            made = pa.array(np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, name])

    return tidy(run)


def with_fingerprint(docs: DataFrame, shingle: int = 3, text_col: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the 64-bit SimHash of each whole text as a long."""
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"`{name}` long"])
    return docs.mapInArrow(_fingerprints(shingle, text_col, name), ddl)


def _segment(fp: Column, at: Column) -> Column:
    return F.call_function("shiftrightunsigned", fp, (at * 16).cast("int")).bitwiseAND(F.lit(0xFFFF))


def links(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """Pairs a < b of distinct fingerprints ``fp`` with at most ``max_bits`` differing bits."""
    if not 0 <= max_bits <= 3:
        raise ValueError("four segments carry at most 3 differing bits")
    ring = prints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("i"))
    ring = ring.select("fp", "i", _segment(F.col("fp"), F.col("i")).alias("s0"), _segment(F.col("fp"), (F.col("i") + 1) % 4).alias("s1"), _segment(F.col("fp"), (F.col("i") + 2) % 4).alias("s2"))
    ring = ring.select("*", F.explode(F.sequence(F.lit(0), F.lit(1))).alias("half"))
    ring = ring.withColumn("part", F.when(F.col("half") == 0, F.col("s1").bitwiseAND(F.lit(0xFF))).otherwise(F.call_function("shiftright", F.col("s1"), F.lit(8))))
    a = ring.select(*[F.col(c).alias(c if c in ("i", "half", "s0", "part") else f"{c}_a") for c in ring.columns])
    b = ring.select(*[F.col(c).alias(c if c in ("i", "half", "s0", "part") else f"{c}_b") for c in ring.columns])
    differ = lambda c: F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b")))
    chain2 = differ("s1")
    pairs = a.join(b.hint("merge"), ["i", "half", "s0", "part"])  # Spark does not count what an explode adds: it would broadcast eight rows a fingerprint
    pairs = pairs.where(F.col("fp_a") < F.col("fp_b"))
    pairs = pairs.where((chain2 <= 1) & (chain2 + differ("s2") <= 2) & (differ("fp") <= max_bits))
    return pairs.select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node it reaches."""
    state, edges = None, stash(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(edges.select("a", "a")).distinct()
        state = now
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y"))
        done, edges = edges, stash(small.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        discard(done)


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (long) and component_id, the smallest id reachable by links."""
    prints = stash(with_fingerprint(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), shingle, name="fp").select("id", "fp"))
    distinct = prints.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links(distinct.select("fp"), max_bits))
    classes = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    classes = stash(classes)
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = classes.join(least, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select(F.col("id").alias(id_col), F.col("fp").alias("fingerprint"), "component_id")


def _similar(shingle: int, least: float):
    """Of pairs (th, text, kept_text): the ``th`` whose word shingles have a Jaccard index of ``least`` or more."""

    def shingles(batch, column):
        out = []
        for _, _, buffer, offsets in bw.chunks(batch, column):
            w = bw.find_words(buffer, offsets, lower=True)
            hashes = w.hashes()
            for a, b in zip(w.first.tolist(), w.first[1:].tolist()):
                n = min(shingle, b - a)
                at = np.arange(a, b - n + 1) if n else np.zeros(0, np.int64)
                out.append(set(bw.span_hash(hashes, at, at + n, "word").tolist()))
        return out

    def run(batches):
        for batch in batches:
            hit = [len(x & y) >= least * len(x | y) for x, y in zip(shingles(batch, "text"), shingles(batch, "kept_text"))]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(hit, pa.bool_()))], ["th"])

    return tidy(run)


def keep_one_of_each_group(docs: DataFrame, shingle: int = 5, max_bits: int = 3, min_similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near copies, columns as given. In a component the text with the smallest id
    (rows without an id last) stays; another goes if its shingles' similarity to that one is
    ``min_similarity`` or more, so that texts that are only linked in a chain stay. Of equal texts one row
    stays, the one with the smallest id; rows that are alike in id and text are one."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    first = F.struct(F.col("id").isNull().alias("none"), "id")  # rows without an id come last
    prints = with_fingerprint(slim.withColumn("th", F.xxhash64(text)), shingle, name="fp").select("id", "th", "fp")
    texts = stash(prints.groupBy("th").agg(F.first("fp").alias("fp"), F.min(first).alias("least"), F.count("*").alias("copies")))
    roots = stash(components(links(texts.select("fp").distinct(), max_bits)))
    groups = texts.join(roots, texts["fp"] == roots["node"], "left").select("th", "least", "copies", F.coalesce("root", "fp").alias("root"))
    kept = one_of_each(docs, groups, shingle, min_similarity, id_col, text_col)
    discard(texts, roots)
    return kept


def one_of_each(docs: DataFrame, texts: DataFrame, shingle: int, min_similarity: float, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` that stay, given its distinct texts by XXH64 (th) with their smallest id (least), number
    (copies) and group (root): of each group the text with the smallest id, and those that are unlike it."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    chosen = texts.groupBy("root").agg(F.min(F.struct("least", "th")).alias("best"), F.count("*").alias("members"))
    texts = stash(texts.join(chosen, "root").select("th", F.col("least.id").alias("kept_id"), "copies", F.col("best.th").alias("kept_th"), "members"))
    pairs = texts.where("members > 1 and th <> kept_th").select("th", "kept_th")
    bodies = slim.select(F.xxhash64(text).alias("th"), "text")
    needed = pairs.select("th").union(pairs.select("kept_th")).distinct()
    bodies = stash(bodies.join(needed, "th", "left_semi").groupBy("th").agg(F.first(text).alias("text")))  # of equal texts one
    both = pairs.join(bodies.hint("merge"), "th").join(bodies.select(F.col("th").alias("kept_th"), F.col("text").alias("kept_text")).hint("merge"), "kept_th")  # texts are sized as compressed
    gone = both.select("th", "text", "kept_text").mapInArrow(_similar(shingle, min_similarity), "th long")
    keep = stash(texts.join(gone, "th", "left_anti").select("th", "kept_id", "copies"))
    discard(texts, bodies)
    names = {c: fresh_name(docs, c) for c in ("th", "kept_id", "copies")}
    keep = keep.select(*[F.col(k).alias(v) for k, v in names.items()])
    same = (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == keep[names["th"]]) & docs[id_col].eqNullSafe(keep[names["kept_id"]])
    kept = docs.join(keep, same)
    alike = kept.where(F.col(names["copies"]) > 1).dropDuplicates([id_col, names["th"]])
    return kept.where(F.col(names["copies"]) == 1).union(alike).select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(documents(spark, sf_dir))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
