"""Adaptive context-mixing range coder for token ids.

Ids are cut into blocks of ``BLOCK`` that are coded independently, each with freshly reset
models; a group of blocks is coded side by side, one numpy lane a block. For each id, two
adaptive tables (hashed by the last two ids, and by the last id) predict one id with a
confidence, and learned hit rates per confidence set how much of the coding interval goes to
the order-2 prediction, to the order-1 prediction, and to the order-0 distribution of the
group, which covers every id. The interval then narrows a carry-less 64-bit range coder.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 1024
_TOTAL, _ZERO = 28, 24  # bits of the mixed and of the order-0 distribution
_SLOTS1, _SLOTS2, _LEVELS, _FULL = 256, 512, 8, 1 << _TOTAL
_LOW48 = np.uint64((1 << 48) - 1)
_MOVES = np.array([(k >> 1) - k for k in range(_LEVELS)] + [1] * (_LEVELS - 1) + [0], np.int32)  # of a confidence, by misses and by hits
U = np.uint64


class _Mixer:
    """The models of all lanes, those of order 2 and of order 1 as two rows of each array. A table cell holds a predicted
    id times 8 plus its confidence. Numbers of 32 bits do: only the low bits of hashes count, and shares end at 2**_TOTAL."""

    def __init__(self, lanes: int):
        lane, tables = np.arange(lanes), np.arange(2)[:, None]
        self.cells = np.zeros(lanes * (_SLOTS1 + _SLOTS2), np.int32)
        start = (np.arange(_LEVELS) * 6000 + 2000).astype(np.int32)
        start[0] = 0
        self.rates = np.tile(start, 2 * lanes)
        self.one, self.two = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
        self.base, self.base_rate = np.stack([lane * _SLOTS2, lanes * _SLOTS2 + lane * _SLOTS1]), (tables * lanes + lane) * _LEVELS

    def predict(self, n: int):
        """Predictions and the ends of their intervals, for the first ``n`` lanes."""
        one, two, slot = self.one[:n] * 40503, self.two[:n], np.empty((2, n), np.int32)
        np.bitwise_and(one + two * 60493 + (two >> 5), _SLOTS2 - 1, out=slot[0])
        np.bitwise_and(one, _SLOTS1 - 1, out=slot[1])
        self.at = self.base[:, :n] + slot
        self.v = self.cells.take(self.at, mode="clip")
        self.k, self.p = self.v & 7, self.v >> 3
        self.r = self.base_rate[:, :n] + self.k
        self.q = self.rates.take(self.r, mode="clip")
        self.known = self.k > 0
        a = self.q[0] << (_TOTAL - 16)
        w = self.q[1] * ((self.p[1] != self.p[0]) | ~self.known[0])
        b = a + ((_FULL - a >> 16) * w)
        np.minimum(b, (15 << _TOTAL) // 16, out=b)
        np.minimum(a, b, out=a)
        return a, b

    def learn(self, n: int, ids: np.ndarray, hit: np.ndarray) -> None:
        """``hit``: where the predictions are the ids."""
        rates = hit * np.int32(63000)
        rates -= self.q
        rates >>= 4
        rates += self.q
        rates *= self.known
        self.rates[self.r] = rates
        moved = _MOVES.take(self.k + hit * np.int32(_LEVELS))
        moved += self.v
        np.copyto(moved, ids * 8 + 1, where=~hit & (self.k <= 1))
        self.cells[self.at] = moved
        self.two[:n] = self.one[:n]
        self.one[:n] = ids


def _order_zero(counts: np.ndarray) -> np.ndarray:
    """Cumulative shares of the present ids, each at least 1, that end at 2**_ZERO."""
    room = (1 << _ZERO) - len(counts)
    total = np.concatenate([[0], np.cumsum(counts)])
    return total * room // max(int(total[-1]), 1) + np.arange(len(total))


_STEP = 5  # bits of an order-0 share within one cell of the finder


class _Finder:
    """The id that holds a value of the order-0 distribution: a table of cells, then a short search."""

    def __init__(self, cum: np.ndarray):
        self.cum = cum
        self.cells = np.searchsorted(cum, np.arange(0, 1 << _ZERO, 1 << _STEP), "right").astype(np.int32) - 1

    def __call__(self, x: np.ndarray) -> np.ndarray:
        s = self.cells.take(x >> _STEP, mode="clip").astype(np.int64)
        up = self.cum.take(s + 1, mode="clip") <= x
        s += up
        if up.any():
            rest = np.flatnonzero(up)
            rest = rest[self.cum[s[rest] + 1] <= x[rest]]
            if len(rest):
                s[rest] = np.searchsorted(self.cum, x[rest], "right") - 1
        return s


def _lanes(n: int) -> tuple[int, np.ndarray]:
    blocks = -(-n // BLOCK)
    sizes = np.full(blocks, BLOCK)
    if blocks:
        sizes[-1] = n - BLOCK * (blocks - 1)
    return blocks, sizes


def _ranked(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(present ids, the rank of each id among them, their counts)."""
    if not len(ids) or int(ids.max()) >= 1 << 24:
        return np.unique(ids, return_inverse=True, return_counts=True)
    counts = np.bincount(ids)
    present = np.flatnonzero(counts)
    rank = np.zeros(len(counts), np.int32)
    rank[present] = np.arange(len(present))
    return present.astype(ids.dtype), rank[ids], counts[present]


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes], list[int]]:
    """(present ids, their counts, each block's bytes, each block's CRC-32)."""
    present, symbols, counts = _ranked(ids)
    lanes, sizes = _lanes(len(ids))
    if not lanes:
        return present, counts, [], []
    cum = _order_zero(counts)
    padded = np.zeros(lanes * BLOCK, np.int32)
    padded[: len(ids)] = symbols
    grid = np.ascontiguousarray(padded.reshape(lanes, BLOCK).T)
    mixer = _Mixer(lanes)
    low, span = np.zeros(lanes, U), np.full(lanes, 2**64 - 1, U)
    out = np.zeros((lanes, 2 * BLOCK + 8), np.uint16)
    flat, first = out.reshape(-1), np.arange(lanes) * out.shape[1]
    at = first.copy()

    def put(who, words):
        place = at[who]
        flat[place] = words
        at[who] = place + 1

    for t in range(int(sizes[0])):
        n = lanes if t < sizes[-1] else lanes - 1
        s = grid[t, :n]
        a, b = mixer.predict(n)
        hit = mixer.p == s
        hit2, hit1 = hit[0] & mixer.known[0] & (a > 0), hit[1] & mixer.known[1] & (b > a)
        start, end = _interval(cum, s, a, b, hit2, hit1)
        _narrow(low[:n], span[:n], span[:n] >> U(_TOTAL), start, end)
        _settle(low, span, n, put)
        mixer.learn(n, s, hit)
    for _ in range(4):
        put(np.arange(lanes), (low >> U(48)).astype(np.uint16))
        low = low << U(16)
    used = at - first
    edges = [ids[k * BLOCK : (k + 1) * BLOCK] for k in range(lanes)]
    return present, counts, [out[k, : used[k]].astype("<u2").tobytes() for k in range(lanes)], [zlib.crc32(e.astype("<u4").tobytes()) for e in edges]


def _interval(cum: np.ndarray, ids: np.ndarray, a: np.ndarray, b: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the interval of each id starts and ends: up to ``a`` for hits of order 2, from there to ``b`` for those of order
    1, behind them by order 0."""
    tail = (_FULL - b).astype(np.int64)
    start, end = ((cum.take(i, mode="clip") * tail >> _ZERO).astype(np.int32) + b for i in (ids, ids + 1))
    for here, first, last in ((hit1, a, b), (hit2, 0, a)):
        np.copyto(start, first, where=here)
        np.copyto(end, last, where=here)
    return start, end


def _narrow(low: np.ndarray, span: np.ndarray, r: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
    low += r * start.astype(U)
    np.multiply(r, (end - start).astype(U), out=span)


def _settle(low, span, n, moved) -> None:
    """Move out the top 16 bits wherever they are settled or the range gets too narrow."""
    lo, sp = low[:n], span[:n]
    same = (lo ^ (lo + sp)) <= _LOW48
    who = np.flatnonzero(same | (sp <= _LOW48))
    same, lo, sp = same[who], lo[who], sp[who]
    while len(who):
        if not same.all():
            sp = np.where(same, sp, (U(0) - lo) & _LOW48)
        moved(who, (lo >> U(48)).astype(np.uint16))
        lo, sp = lo << U(16), sp << U(16)
        low[who], span[who] = lo, sp
        same = (lo ^ (lo + sp)) <= _LOW48
        again = np.flatnonzero(same | (sp <= _LOW48))
        who, same, lo, sp = who[again], same[again], lo[again], sp[again]


def decode(present: np.ndarray, counts: np.ndarray, blocks: list[bytes], checks: list[int], n_ids: int) -> np.ndarray:
    """The ids again; a block whose CRC-32 differs raises ValueError."""
    lanes, sizes = _lanes(n_ids)
    if not lanes:
        return np.zeros(0, np.uint32)
    cum = _order_zero(counts)
    find = _Finder(cum)
    words = np.zeros((lanes, max(len(b) for b in blocks) // 2 + 4), np.uint16)
    for k, block in enumerate(blocks):
        words[k, : len(block) // 2] = np.frombuffer(block, "<u2")
    code = np.zeros(lanes, U)
    for k in range(4):
        code = (code << U(16)) | words[:, k]
    flat, at = words.reshape(-1), np.arange(lanes) * words.shape[1] + 4
    mixer = _Mixer(lanes)
    low, span = np.zeros(lanes, U), np.full(lanes, 2**64 - 1, U)
    grid = np.zeros((BLOCK, lanes), np.int32)

    def take(who, _):
        place = at[who]
        code[who] = (code[who] << U(16)) | flat.take(place, mode="clip")  # a damaged block may run into the next
        at[who] = place + 1

    for t in range(int(sizes[0])):
        n = lanes if t < sizes[-1] else lanes - 1
        a, b = mixer.predict(n)
        r = span[:n] >> U(_TOTAL)
        v = np.minimum((code[:n] - low[:n]) // r, U(_FULL - 1)).astype(np.int32)
        share = ((np.maximum(v - b, 0) + 1).astype(np.int64) << _ZERO) - 1
        s = find(np.minimum(share // (_FULL - b).astype(np.int64), (1 << _ZERO) - 1)).astype(np.int32)
        hit2 = v < a
        hit1 = (v < b) & ~hit2
        for here, p in ((hit1, mixer.p[1]), (hit2, mixer.p[0])):
            np.copyto(s, p, where=here)
        start, end = _interval(cum, s, a, b, hit2, hit1)
        _narrow(low[:n], span[:n], r, start, end)
        _settle(low, span, n, take)
        grid[t, :n] = s
        mixer.learn(n, s, mixer.p == s)
    ids = present[grid.T.reshape(-1)[:n_ids]].astype(np.uint32)
    for k, check in enumerate(checks):
        if zlib.crc32(ids[k * BLOCK : (k + 1) * BLOCK].astype("<u4").tobytes()) != check:
            raise ValueError(f"block {k} is damaged")
    return ids
