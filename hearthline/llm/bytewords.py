"""Words, rolling hashes and XXH64 over UTF-8 buffers, vectorised inside one task.

A word is a run of bytes other than space and 0x09 to 0x0D. Texts are taken from Arrow
columns without making Python strings; long batches are cut into chunks of whole texts so
that memory stays bounded by the longest text. Words are hashed by random multipliers of
their bytes, one for each place, and spans of words by Rabin-Karp modulo 2**61 - 1: neither
has the periodic collisions of polynomials modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_random = np.random.default_rng(20240229)
_BYTE_VALUE = _random.integers(1, 2**63, 256, dtype=np.uint64)
_BASES = {"word": 0x1A7C15F39CC0605C, "second": 0x0B86659FD93D6E8F}
PRIME, _LOW61, _LOW31, _LOW30 = (1 << 61) - 1, U64((1 << 61) - 1), U64((1 << 31) - 1), U64((1 << 30) - 1)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix64's finaliser)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_places = np.zeros(0, np.uint64)


def _place_values(n: int) -> np.ndarray:
    """Odd pseudo-random multipliers of the places 0 to ``n`` - 1, extended on demand."""
    global _places
    if len(_places) < n:
        _places = mix(np.arange(1, max(n, 4096) + 1, dtype=np.uint64) * U64(0x9E3779B97F4A7C15)) | U64(1)
    return _places


def hash_bytes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes of spans that are not empty."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    every = np.arange(int(sizes.sum()))
    place = every - np.repeat(first, sizes)
    values = _BYTE_VALUE[buffer[np.repeat(starts, sizes) + place]] * _place_values(int(sizes.max()))[place]
    return mix(np.add.reduceat(values, first) + sizes.astype(np.uint64) * U64(0xC2B2AE3D27D4EB4F))


def _fold(x: np.ndarray) -> np.ndarray:
    """Any 64-bit value modulo the prime."""
    x = (x >> U64(61)) + (x & _LOW61)
    return np.where(x >= _LOW61, x - _LOW61, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime of values below it, by halves of 31 and 30 bits."""
    ah, al, bh, bl = a >> U64(31), a & _LOW31, b >> U64(31), b & _LOW31
    middle = ah * bl + al * bh
    return _fold(ah * bh * U64(2) + (middle >> U64(30)) + ((middle & _LOW30) << U64(31)) + al * bl)


class _Powers:
    """Powers of a base and of its inverse modulo the prime, extended on demand."""

    def __init__(self, base: int):
        self.bases, self.tables = (base, pow(base, -1, PRIME)), [np.ones(1, np.uint64)] * 2

    def get(self, n: int) -> list[np.ndarray]:
        while len(self.tables[0]) < n:
            held = len(self.tables[0])
            self.tables = [np.concatenate([t, _times(t, np.full(held, pow(b, held, PRIME), np.uint64))]) for t, b in zip(self.tables, self.bases)]
        return self.tables


_powers = {k: _Powers(v) for k, v in _BASES.items()}


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: str) -> np.ndarray:
    """Rabin-Karp hashes of ``values[starts:ends]`` for every span, by one prefix sum."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    n = len(values)
    up, down = _powers[base].get(n)
    terms = _times(_fold(values), up[:n])
    low, high = np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.uint64)  # halves, so that sums do not run over
    np.cumsum(terms & _LOW31, out=low[1:])
    np.cumsum(terms >> U64(31), out=high[1:])
    high = _fold(high[ends] - high[starts])
    total = _fold((high >> U64(30)) + ((high & _LOW30) << U64(31)) + (low[ends] - low[starts]))
    return mix(_times(total, down[starts]) + ((ends - starts).astype(np.uint64) << U64(40)))


@dataclass
class Words:
    """The words of some whole texts. ``first[d]:first[d+1]`` are those of text ``d``."""

    buffer: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        return hash_bytes(self.buffer, self.starts, self.ends)


def raw_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    buffer = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    return buffer[offsets[0] : offsets[-1]], offsets - offsets[0]


def find_words(buffer: np.ndarray, offsets: np.ndarray, lower: bool = False, compact: bool = False) -> Words:
    """``compact`` leaves one space after each word, so that neighbours are space-joined."""
    if lower:
        buffer = _LOWER[buffer]
    solid = ~SPACE[buffer]
    if compact:
        keep = solid.copy()
        keep[1:] |= solid[:-1]
        kept = np.zeros(len(buffer) + 1, np.int64)
        np.cumsum(keep, out=kept[1:])
        offsets, buffer, solid = kept[offsets], np.where(solid, buffer, np.uint8(0x20))[keep], solid[keep]
    n = len(buffer)
    inner = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < n)]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = solid[:-1], solid[1:]
    before[inner], after[inner - 1] = False, False
    starts, ends = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    return Words(buffer, offsets, starts, ends, np.searchsorted(starts, offsets))


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(row from, row to, bytes, offsets) of runs of whole texts of about ``limit`` bytes."""
    buffer, offsets = raw_texts(batch.column(batch.schema.get_field_index(column)))
    row, rows = 0, len(offsets) - 1
    while row < rows:
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, to, buffer[offsets[row] : offsets[to]], offsets[row : to + 1] - offsets[row]
        row = to


# Fixed values of the XXH64 definition.
_P1, _P2, _P3, _P4, _P5 = (U64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rotate(x: np.ndarray, by: int) -> np.ndarray:
    return (x << U64(by)) | (x >> U64(64 - by))


def _round(acc, lane):
    return _rotate(acc + lane * _P2, 31) * _P1


def xxh64(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of every span; spans of one length are hashed together."""
    out, sizes, s = np.zeros(len(starts), np.uint64), ends - starts, np.full(1, seed, np.uint64)
    order = np.argsort(sizes, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1) if len(order) else []:
        size = int(sizes[group[0]])
        step = max(1, (4 << 20) // max(size, 1))
        for part in (group[k : k + step] for k in range(0, len(group), step)):
            padded = -(-size // 8) * 8
            rows = np.zeros((len(part), padded), np.uint8)
            rows[:, :size] = buffer[starts[part][:, None] + np.arange(size)]
            lanes, at = rows.view("<u8").reshape(len(part), padded // 8), 0
            if size >= 32:
                acc = [np.repeat(v, len(part)) for v in (s + _P1 + _P2, s + _P2, s, s - _P1)]
                while size - at * 8 >= 32:
                    acc = [_round(a, lanes[:, at + k]) for k, a in enumerate(acc)]
                    at += 4
                h = _rotate(acc[0], 1) + _rotate(acc[1], 7) + _rotate(acc[2], 12) + _rotate(acc[3], 18)
                for a in acc:
                    h = (h ^ _round(U64(0), a)) * _P1 + _P4
            else:
                h = np.repeat(s + _P5, len(part))
            h = h + U64(size)
            while size - at * 8 >= 8:
                h = _rotate(h ^ _round(U64(0), lanes[:, at]), 27) * _P1 + _P4
                at += 1
            byte = at * 8
            if size - byte >= 4:
                h = _rotate(h ^ (rows[:, byte : byte + 4].copy().view("<u4")[:, 0].astype(np.uint64) * _P1), 23) * _P2 + _P3
                byte += 4
            for k in range(byte, size):
                h = _rotate(h ^ (rows[:, k].astype(np.uint64) * _P5), 11) * _P1
            h = (h ^ (h >> U64(33))) * _P2
            h = (h ^ (h >> U64(29))) * _P3
            out[part] = h ^ (h >> U64(32))
    return out
