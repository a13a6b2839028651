"""Packing by lexical retrieval: BM25 neighbours fill each seed document's window.

Documents are dealt to shards of about ``shard_bytes`` of text in the order of an LSH forest (MinHashes
of their words, one behind another), so that documents with common words lie in one shard whatever
the size of the corpus. A shard holds an inverted index over token ids (sharded BM25: shard
statistics suffice, as scores are compared within a shard only). A seed opens a window; unused
neighbours follow, best BM25 score first, until the window of ``length`` ids is full; the document
that runs over is cut there and its rest seeds the next window. So only a shard's last window can
be short, and it alone is padded (not at a power of two). Spark deals the shards by range; one task
holds one shard.

Every document has at least its end id. Defined results: null texts have only the end id; rows
that repeat are packed each; null ids are packed and come out null; long texts are cut into as many
windows as they need; an empty table gives no sequence; other columns take no part. Ties of score
go to the smaller row in (id, text hash) order.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw
from .support import documents, stash, text_or_empty, tidy
from .tokens import TokenCoder, default_tokenizer

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long, padding long, seed_doc_id long"
K1, B, HASHES, BYTES_A_TOKEN = 1.2, 0.75, 3, 3


class _Index:
    """Postings of one shard: for each term, its documents and BM25 impacts."""

    def __init__(self, ids: np.ndarray, bounds: np.ndarray):
        docs = len(bounds) - 1
        size = np.diff(bounds)
        doc_of = np.repeat(np.arange(docs), size)
        keys, tf = np.unique((ids.astype(np.int64) << 32) | doc_of, return_counts=True)
        term, self.doc = keys >> 32, (keys & 0xFFFFFFFF).astype(np.int64)
        self.terms, self.first = np.unique(term, return_index=True)
        self.end = np.append(self.first[1:], len(term))
        df = self.end - self.first
        idf = np.log1p((docs - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * size / max(size.mean(), 1))
        self.impact = (np.repeat(idf, df) * tf * (K1 + 1) / (tf + norm[self.doc])).astype(np.float32)
        order = np.argsort(self.doc, kind="stable")  # forward index: postings of each document
        self.slot = np.repeat(np.arange(len(self.terms)), df)[order]
        self.own = np.searchsorted(self.doc[order], np.arange(docs + 1))
        self.docs = docs

    def scores(self, doc: int) -> np.ndarray:
        slots = self.slot[self.own[doc] : self.own[doc + 1]]
        starts, sizes = self.first[slots], (self.end - self.first)[slots]
        first = np.cumsum(sizes) - sizes
        at = np.repeat(starts - first, sizes) + np.arange(int(sizes.sum()))
        return np.bincount(self.doc[at], self.impact[at], self.docs)


def _pack_shard(ids: np.ndarray, bounds: np.ndarray, length: int):
    """(document, start, length, sequence, offset, seed) of each piece."""
    index, docs, size = _Index(ids, bounds), len(bounds) - 1, np.diff(bounds)
    unused, pieces = np.ones(docs, bool), []
    sequence, room, doc, done, cursor = 0, length, None, 0, 0
    while doc is not None or cursor < docs:
        if doc is None:
            if not unused[cursor]:
                cursor += 1
                continue
            doc, done = cursor, 0
            unused[doc] = False
        seed, ranked, at = doc, None, 0
        while True:
            take = min(room, int(size[doc]) - done)
            pieces.append((doc, done, take, sequence, length - room, seed))
            room -= take
            done += take
            if done == size[doc]:
                doc = None
            if room == 0:
                sequence, room = sequence + 1, length
                break
            if ranked is None:
                score = np.where(unused, index.scores(seed), -1.0)
                ranked = np.argsort(-score, kind="stable")[: int(unused.sum())]
            while at < len(ranked) and not unused[ranked[at]]:
                at += 1
            if at == len(ranked):
                return pieces
            doc, done = int(ranked[at]), 0
            unused[doc] = False
    return pieces


def _tokenised(tokenizer: str, end_id: int):
    """From (id, text, tie): ids as little-endian values of 16 or 32 bits, their number, and the keys of an LSH
    forest: scrambled MinHashes of each text's distinct words, one behind another."""

    def run(batches):
        coder = TokenCoder.get(tokenizer)
        for batch in batches:
            for row, to, buffer, offsets in bw.chunks(batch):
                ids, bounds, w, h = coder.encode_pieces(buffer, offsets, end_id)
                wide = "<u4" if int(ids.max()) >= 1 << 16 else "<u2"
                raw, size, at = ids.astype(wide).tobytes(), int(wide[2]), bounds.tolist()
                some = np.flatnonzero(w.counts)
                keys = np.zeros((HASHES, len(w.counts)), np.uint64)
                for k in range(HASHES if len(some) else 0):
                    keys[k, some] = bw.mix(np.minimum.reduceat(bw.mix(h ^ bw.U64(k * 0x9E3779B97F4A7C15 & (2**64 - 1))), w.first[:-1][some]))
                part = batch.slice(row, to - row)
                blobs = pa.array([raw[size * a : size * b] for a, b in zip(at, at[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), part.column(3), pa.array(np.diff(bounds)), blobs, *(pa.array(x.view(np.int64)) for x in keys)], ["id", "tie", "row", "n", "ids", *(f"m{k}" for k in range(HASHES))])

    return tidy(run)


def _shard(length: int):
    def run(batches):
        from pyspark import TaskContext

        held = [b for b in batches if b.num_rows]  # one shard
        if not held:
            return
        table = pa.Table.from_batches(held).sort_by([("id", "ascending"), ("tie", "ascending")])
        keys, n = table["id"].combine_chunks(), table["n"].to_numpy()
        blobs = [b.as_buffer() for c in table["ids"].chunks for b in c]
        ids = np.concatenate([np.frombuffer(b, f"<u{len(b) // k}").astype(np.uint32) for b, k in zip(blobs, n.tolist())])
        bounds = np.concatenate([[0], np.cumsum(n)])
        del table, held, blobs
        pieces = np.array(_pack_shard(ids, bounds, length), np.int64)
        doc, start, size, sequence, offset, seed = pieces.T
        used = np.bincount(sequence, size).astype(np.int64)
        padded = np.where((used & (used - 1)) == 0, used, length)
        raw, at = ids.astype("<u4").tobytes(), (bounds[doc] + start) * 4
        crc = np.array([zlib.crc32(raw[a : a + 4 * k]) for a, k in zip(at.tolist(), size.tolist())], np.int64)
        number = (TaskContext.get().partitionId() << 32) + sequence
        columns = [keys.take(pa.array(doc)), start, size, crc, n[doc], number, offset, padded[sequence], (padded - used)[sequence], keys.take(pa.array(seed))]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length", "padding", "seed_doc_id"]
        yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns], names)

    return tidy(run)


def deal(docs: DataFrame, tokenizer: str, end_id: int, shard_bytes: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tie, row, n, ids, keys) in partitions of about ``shard_bytes`` of text, alike documents together; a hot
    group of copies is split. The ranges are those of the keys, which alone are read to find them."""
    slim = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    slim = slim.withColumn("tie", F.xxhash64("text", "id")).withColumn("row", F.monotonically_increasing_id())  # stored, for rows alike in all else
    keys = [f"m{k}" for k in range(HASHES)]
    made = stash(slim.mapInArrow(_tokenised(tokenizer, end_id), "id long, tie long, row long, n long, ids binary, " + ", ".join(f"{k} long" for k in keys)))
    tokens = made.agg(F.sum("n")).first()[0] or 0
    return made.repartitionByRange(max(1, -(-tokens * BYTES_A_TOKEN // shard_bytes)), *keys, "tie", "row")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, length: int = 4096, shard_bytes: int = 4 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece; a window's pieces share sequence_id and lie gapless from offset 0."""
    return deal(docs, tokenizer, end_id, shard_bytes, id_col, text_col).mapInArrow(_shard(length), PIECES)


def query(spark, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), default_tokenizer())
