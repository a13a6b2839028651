"""Hierarchical Pitman-Yor bigram model: training, and scores of every document.

Restaurants: each context (the word before) has one; all share the root, whose base is uniform
over the known words and one unknown. A word's probability in context u is
  (c - d t) / (theta + C) + (theta + d T) / (theta + C) * P_root(word)
with its customers c and tables t, the restaurant's C and T; the root is alike, its customers
being the tables of the contexts. Table counts are sampled by Gibbs, the contexts' and the root's in
turn. With S the generalised Stirling numbers and G(theta / d + T) a Gamma variable of the restaurant,
given which its words are independent, t has probabilities in proportion to S(c, t) (d x G)^t;
S is taken from a table up to ``TABLE`` customers and from an integral beyond. For a context x is the
word's probability in the root's measure, which is drawn whole, so that contexts are independent given it: a word's weight
is a Gamma(c - d t) variable plus an inverse Gaussian one, the share of the tables to come (this is what tilted
stable variables are at the root's discount of 1/2). The root's G is drawn given the weights: its square
is a Gamma variable. Scores average the predictive probabilities above over the samples, each with its own
seating of contexts and root.

On Spark: (1) documents become blocks of about ``BLOCK_WORDS`` tokens (word hashes, counted as
indices into the block's vocabulary) in a table; (2) blocks send their vocabularies, packed, to
vocabulary shards, which count words and answer; (3) blocks send their pairs of words to
context shards, each of which stores the customers of its restaurants; (4) in each sweep context shards draw their tables
and send them, by word, to the vocabulary shards, which seat the root and answer with its weights; (5) blocks
send their tokens, packed, to context shards, those of every ``PASSES``-th shard in one pass, which
answer with sums of log probabilities by document; (6) blocks add these up. Nothing is capped or sampled away, all
messages grow with the corpus and none meets another's documents. The tokens of a context with
more than ``HOT`` customers are dealt over several shards by word; its T is added up with the root, its G the same in all of them.

A sweep draws the table count of each pair over the seatings of all of its customers, however
many these are. Words are told apart by 64-bit hashes.

Defined results: null texts have just the end token; null ids have the remainder of an empty
text and come out null; rows that repeat count as often as they occur; long texts are one block;
nothing ties; an empty table gives no rows; other columns take no part.
"""

from __future__ import annotations

import functools
import zlib
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw
from .support import discard, documents, give_back, pack, stash, tidy, unpack

BLOCK_WORDS, SHARD_WORDS, HOT, PASSES = 1_500_000, 1_500_000, 200_000, 2
THETA, DISCOUNT, ROOT_THETA, ROOT_DISCOUNT = 1.0, 0.85, 1.0, 0.5
BURN_IN, SAMPLES = 4, 2
TABLE, NODES, ALONE, POINTS = 1024, 17, 30, 50
END = bw.mix(np.array([20240301], np.uint64))[0]
MESSAGE = "shard int, kind string, part long, data binary"
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _small(x: np.ndarray) -> np.ndarray:
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 256 else np.uint16 if top < 65536 else np.uint32)


@functools.lru_cache
def _stirling(discount: float) -> np.ndarray:
    """Logs of the generalised Stirling numbers S(c, t), c and t up to ``TABLE``, by their recursion."""
    out = np.full((TABLE + 1, TABLE + 1), -np.inf)
    out[1, 1] = 0.0
    for c in range(1, TABLE):
        out[c + 1, 1] = np.log(c - discount) + out[c, 1]
        t = np.arange(2, c + 1)
        out[c + 1, 2 : c + 1] = np.logaddexp(out[c, 1:c], np.log(c - discount * t) + out[c, 2 : c + 1])
        out[c + 1, c + 1] = 0.0
    return out


def _tables_at(eps: np.ndarray, c: np.ndarray, d: float) -> np.ndarray:
    """The number of tables whose saddle point lies at 1 - ``eps``."""
    return (c + 1) * -np.expm1(d * np.log(eps)) * eps ** (1 - d) / (d * (1 - eps))


def _bisect(low, shape) -> np.ndarray:
    """Where ``low``, of the log of eps, turns from true to false."""
    a, b = np.full(shape, -700.0), np.full(shape, -1e-12)
    for _ in range(40):
        mid = (a + b) / 2
        is_low = low(np.exp(mid))
        a, b = np.where(is_low, mid, a), np.where(is_low, b, mid)
    return np.exp(a)


def log_sums(c: np.ndarray, t: np.ndarray, d: float) -> np.ndarray:
    """Log of [z^c] (1 - (1 - z)^d)^t, which is S(c, t) d^t t! / c!, for large ``c`` and any real t from 1 to c.

    Cauchy's integral over the parabola 1 - z = eps (1 + iu)^2 through the saddle, by the trapezoid
    rule; where nearly all customers sit alone, the power series of the base's power."""
    eps = np.maximum(_bisect(lambda e: _tables_at(e, c, d) < t, c.shape), 1 / c)
    e = eps**d
    curve = (c + 1) / (1 - eps) ** 2 + t * (d * (1 - d) * e / (1 - e) - (d * e / (1 - e)) ** 2) / eps**2
    width = 1 / (2 * eps * np.sqrt(np.maximum(curve, 1e-300)))
    step = np.minimum(np.minimum(width / 2.5, 0.15), (eps**-0.5 - 1) / 4)
    side = np.log1p(1j * step[..., None] * np.arange(POINTS))
    w = np.log(eps)[..., None] + 2 * side
    f = t[..., None] * np.log(-np.expm1(d * w)) - (c + 1)[..., None] * np.log(-np.expm1(w)) + side
    top = f[..., 0].real
    sums = np.exp(f - top[..., None]).real
    with np.errstate(invalid="ignore", divide="ignore"):
        out = np.log(step * eps / np.pi * (2 * sums.sum(-1) - sums[..., 0])) + top
    near = np.flatnonzero((c - t).ravel() <= ALONE)
    if len(near):
        n, m, power = c.ravel()[near], (c - t).ravel()[near], t.ravel()[near]
        k = np.arange(1, ALONE + 1)
        ratio = np.cumprod((k - d) / (k + 1))  # of the base's coefficients to its first
        b = [np.ones(len(near))]
        for j in range(1, ALONE + 1):
            b.append(sum((i * power - j + i) * ratio[i - 1] / power**i * b[j - i] for i in range(1, j + 1)) / j)
        whole = np.array([np.interp(x, np.arange(ALONE + 1), np.log([r[q] for r in b])) for q, x in enumerate(m)])
        out.ravel()[near] = whole + m * np.log(power) + power * np.log(d)
    return out


def _draw_large(c: np.ndarray, heat: np.ndarray, d: float, rng) -> np.ndarray:
    """As ``draw_tables`` for any customers, from ``log_sums`` at Chebyshev points about the mode."""
    slope = lambda e: np.log(-np.expm1(d * np.log(e))) + np.log(heat) - np.log(_tables_at(e, c, d))
    eps = np.clip(_bisect(lambda e: slope(e) > 0, c.shape), 1e-300, 1 - 1e-9)
    mode, near = _tables_at(eps, c, d), eps * 0.999
    sd = np.sqrt(np.abs((mode - _tables_at(near, c, d)) / (slope(near) - slope(eps))))
    mode, reach = np.clip(mode, 1, c), 10 * sd + 20
    out, left = np.zeros(len(c), np.int64), np.arange(len(c))
    points = np.polynomial.chebyshev.chebpts1(NODES)
    fit = np.linalg.inv(np.polynomial.chebyshev.chebvander(points, NODES - 1)).T
    while len(left):
        again = []
        for some in np.array_split(left, 1 + len(left) // 200):
            lo, hi = np.maximum(np.floor(mode[some] - reach[some]), 1), np.minimum(np.ceil(mode[some] + reach[some]), c[some])
            end = np.maximum(np.minimum(hi, c[some] - ALONE), lo + 1)  # the series beyond it is for whole numbers
            t = lo[:, None] + (points + 1) / 2 * (end - lo)[:, None]
            smooth = (log_sums(np.repeat(c[some][:, None], NODES, 1), t, d) - np.log(t)) @ fit
            for k, coefficients, a, b, e in zip(some, smooth, lo, hi, end):
                x = np.arange(a, b + 1)
                log_x = np.log(x)
                logs = np.polynomial.chebyshev.chebval(2 * (x - a) / (e - a) - 1, coefficients) + log_x
                rest = x > c[k] - ALONE
                if rest.any():
                    logs[rest] = log_sums(np.full(rest.sum(), c[k]), x[rest], d)
                logs += x * np.log(heat[k]) - np.cumsum(log_x)
                logs -= logs.max()
                if (a > 1 and logs[0] > -30) or (b < c[k] and logs[-1] > -30):
                    reach[k] *= 2
                    again.append(k)
                    continue
                sums = np.cumsum(np.exp(logs))
                out[k] = a + np.searchsorted(sums, rng.random() * sums[-1])
        left = np.array(again, np.int64)
    return out


def draw_tables(customers: np.ndarray, heat: np.ndarray, discount: float, rng) -> np.ndarray:
    """Table counts drawn with probabilities in proportion to S(c, t) (discount heat)^t, one for each dish."""
    t = np.ones(len(customers), np.int64)
    stirling, top = _stirling(discount), 2
    while top <= TABLE:
        every = np.flatnonzero((customers > top // 2) & (customers <= top))
        k = np.arange(1, top + 1)
        for some in np.array_split(every, 1 + len(every) * top // 300_000):
            logs = stirling[customers[some], 1 : top + 1] + k * np.log(discount * heat[some])[:, None]
            sums = np.cumsum(np.exp(logs - logs.max(1, keepdims=True, initial=-np.inf)), axis=1)
            t[some] += (sums < (rng.random(len(some)) * sums[:, -1])[:, None]).sum(1)
        top *= 2
    large = np.flatnonzero(customers > TABLE)
    if len(large):
        t[large] = _draw_large(customers[large].astype(float), heat[large], discount, rng)
    return t


def seat(customers: np.ndarray, restaurant: np.ndarray, base: np.ndarray, theta: float, discount: float, scale: np.ndarray, rng, burn_in: int = BURN_IN, samples: int = SAMPLES) -> tuple[np.ndarray, np.ndarray]:
    """Gibbs sampling of table counts at one level, its base held; the mean tables of each dish and of each restaurant.

    A dish is (restaurant, word) with ``customers`` > 0 and the parent's probability ``base``.
    Given a Gamma variable of each restaurant the dishes are independent, and a sweep draws every
    table count from its distribution over all seatings of all customers. ``scale``: how many
    equal parts of each restaurant there are, of which this is one."""
    tables = (customers > 0).astype(np.int64)
    count = lambda: np.bincount(restaurant, tables, len(scale))
    many = np.flatnonzero(customers > 1)  # a lone customer has a table of its own, always
    mean_t, mean_house = np.zeros(len(customers)), np.zeros(len(scale))
    for sweep in range(burn_in + samples):
        heat = rng.standard_gamma(theta / discount + scale * count())
        tables[many] = draw_tables(customers[many], heat[restaurant[many]] * base[many], discount, rng)
        if sweep >= burn_in:
            mean_t += tables
            mean_house += count()
    return mean_t / samples, mean_house / samples


def _blocks(block_words: int):
    def run(batches):
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        ids, missing, held, sizes, tokens, total = [], [], [], [], [], 0

        def flush():
            nonlocal ids, missing, held, sizes, tokens, total, seq
            vocabulary, index = np.unique(np.concatenate(tokens), return_inverse=True)
            blob = pack(np.array(ids, np.int64), np.array(missing, bool), np.array(held, bool), np.concatenate(sizes), vocabulary, _small(index))
            row, seq = (part << 24) + seq, seq + 1
            out = pa.RecordBatch.from_arrays([pa.array([row], pa.int64()), pa.array([total], pa.int64()), pa.array([len(vocabulary)], pa.int64()), pa.array([blob], pa.binary())], ["block", "words", "vocabulary", "data"])
            ids, missing, held, sizes, tokens, total = [], [], [], [], [], 0
            return out

        for batch in batches:
            keys = batch.column(0)
            numbers, none = keys.fill_null(0).to_pylist(), keys.is_null().to_pylist()
            for row, to, buffer, offsets in bw.chunks(batch):
                w = bw.find_words(buffer, offsets, lower=True)
                tokens.append(np.insert(w.hashes(), w.first[1:], END))
                sizes.append(w.counts + 1)
                ids += numbers[row:to]
                missing += none[row:to]
                held += [zlib.crc32(b"" if m else str(i).encode()) % 7 == 2 for i, m in zip(numbers[row:to], none[row:to])]
                total += len(tokens[-1])
                if total >= block_words:
                    yield flush()
        if ids:
            yield flush()

    return tidy(run)


def _open(blob: bytes):
    """ids, which are missing, held out, sizes, vocabulary, tokens, contexts, training token?"""
    ids, missing, held, sizes, vocabulary, tokens = unpack(blob)
    tokens = tokens.astype(np.int64)
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.cumsum(sizes) - sizes] = np.searchsorted(vocabulary, END)
    return ids, missing, held, sizes, vocabulary, tokens, before, np.repeat(~held, sizes)


def _shard_edges(keys: np.ndarray, shards: int) -> np.ndarray:
    """Sorted hashes are cut into ``shards`` equal ranges."""
    return np.searchsorted(keys, np.array([(k << 64) // shards for k in range(shards)], np.uint64)).tolist() + [len(keys)]


def _vocabularies(shards: int):
    def run(batches):
        for batch in batches:
            for block, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                _, _, _, _, vocabulary, tokens, _, train = _open(blob)
                count = np.bincount(tokens[train], minlength=len(vocabulary))
                edges = _shard_edges(vocabulary, shards)
                blobs = [pack(vocabulary[a:b], _small(count[a:b])) for a, b in zip(edges, edges[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(range(shards), pa.int32()), pa.array([block] * shards, pa.int64()), pa.array(blobs, pa.binary())], ["shard", "block", "data"])

    return tidy(run)


def _counts(key: Any, frame: pd.DataFrame) -> pd.DataFrame:
    """Counts of a shard's words; an answer to each block, totals on the first row."""
    frame = frame.sort_values("block")
    parts = [unpack(b) for b in frame["data"]]
    words, index = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    count = np.bincount(index, np.concatenate([p[1] for p in parts]).astype(float), len(words)).astype(np.int64)
    ends = np.cumsum([len(p[0]) for p in parts])
    blobs = [pack(_small(count[index[e - len(p[0]) : e]])) for p, e in zip(parts, ends)]
    first = np.arange(len(frame)) == 0
    return pd.DataFrame({"block": frame["block"].to_numpy(), "shard": int(key[0]), "data": blobs, "n": np.where(first, count.sum(), 0), "v": np.where(first, np.count_nonzero(count), 0)})


def _counted(key: Any, blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """A block and the counts of its vocabulary."""
    count = np.concatenate([unpack(b)[0].astype(np.int64) for b in answers.sort_values("shard")["data"]])
    return pd.DataFrame({"block": [int(key[0])], "data": [blocks["data"].iloc[0]], "counts": [pack(_small(count))]})


def _gaps(words: np.ndarray) -> np.ndarray:
    return np.diff(words, prepend=np.zeros(1, np.uint64))


def _places(gaps: np.ndarray) -> np.ndarray:
    return np.cumsum(gaps, dtype=np.uint64)


def _dealt(vocabulary: np.ndarray, count: np.ndarray, tokens: np.ndarray, before: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The context shard of each token, and over how many shards each context is dealt by word."""
    cuts = 1 + count // HOT
    shard = (bw.mix(vocabulary) % bw.U64(shards)).astype(np.int64)[before]
    hot = np.flatnonzero((cuts > 1)[before])
    part = vocabulary[tokens[hot]] % cuts[before[hot]].astype(np.uint64)
    shard[hot] = bw.mix(vocabulary[before[hot]] + part * bw.U64(0x9E3779B97F4A7C15)) % bw.U64(shards)
    return shard, cuts


def _starts(keys: np.ndarray) -> np.ndarray:
    """Where the runs of sorted keys begin."""
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)


def _runs(keys: np.ndarray, size: int):
    """From sorted keys (shard * size + context) * size + word, of each shard: its part of the keys, where each pair
    begins there, the contexts, their pairs, the words, and the word of each pair."""
    begins = _starts(keys)
    pairs, word = np.divmod(keys[begins], size)
    shard, context = np.divmod(pairs, size)
    edges = np.append(_starts(shard), len(shard))
    ends = np.append(begins, len(keys))
    for a, b in zip(edges, edges[1:]):
        at = _starts(context[a:b])
        words, w = np.unique(word[a:b], return_inverse=True)
        yield int(shard[a]), slice(ends[a], ends[b]), begins[a:b] - ends[a], context[a:b][at], np.diff(np.append(at, b - a)), words, w


def _pairs(shards: int):
    """The pairs of each block, with their training customers, to the shards of their contexts."""

    def run(batches):
        for batch in batches:
            for block, blob, counts in zip(*(batch.column(k).to_pylist() for k in range(3))):
                _, _, _, _, vocabulary, tokens, before, train = _open(blob)
                count = unpack(counts)[0].astype(np.int64)
                shard, cuts = _dealt(vocabulary, count, tokens, before, shards)
                size, to, blobs = len(vocabulary), [], []
                keys = np.sort(((shard * size + before) * size + tokens) * 2 + train)
                for s, own, first, contexts, pairs, words, w in _runs(keys >> 1, size):
                    to.append(s)
                    customers = np.add.reduceat(keys[own] & 1, first)
                    blobs.append(pack(vocabulary[contexts], count[contexts], cuts[contexts], _small(pairs), _gaps(vocabulary[words]), _small(w), _small(customers)))
                yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array([block] * len(to), pa.int64()), pa.array(blobs, pa.binary())], ["shard", "block", "data"])

    return tidy(run)


def _restaurants(key: Any, frame: pd.DataFrame) -> pd.DataFrame:
    """The contexts of a shard, its words, and the customers of each dish, in order of context and word."""
    own = [unpack(d) for d in frame.sort_values("block")["data"]]
    contexts, at_u, u = np.unique(np.concatenate([m[0] for m in own]), return_index=True, return_inverse=True)
    size, cuts = (np.concatenate([m[k] for m in own])[at_u] for k in (1, 2))
    words, w = np.unique(np.concatenate([_places(m[4]) for m in own]), return_inverse=True)
    pairs, from_u, from_w = [], 0, 0
    for m in own:
        pairs.append(np.repeat(u[from_u : from_u + len(m[0])], m[3]) * len(words) + w[from_w : from_w + len(m[4])][m[5]])
        from_u, from_w = from_u + len(m[0]), from_w + len(m[4])
    dishes, index = np.unique(np.concatenate(pairs), return_inverse=True)
    customers = np.bincount(index, np.concatenate([m[6] for m in own]).astype(float)).astype(np.int64)
    held = np.bincount(dishes // len(words), minlength=len(contexts))
    blob = pack(contexts, _small(size), _small(cuts), _small(held), _gaps(words), _small(dishes % len(words)), _small(customers))
    give_back()
    return pd.DataFrame({"shard": [int(key[0])], "kind": ["state"], "part": [0], "data": [blob]})


def _of_kind(frame: pd.DataFrame, kind: str) -> list[tuple[np.ndarray, ...]]:
    return [unpack(d) for d in frame[frame["kind"] == kind].sort_values("part")["data"]]


def _laid(frame: pd.DataFrame):
    """Contexts, their sizes, the hot ones, words; of each dish its context, word and customers."""
    ((contexts, size, cuts, held, gaps, w, customers),) = _of_kind(frame, "state")
    return contexts, size.astype(np.int64), np.flatnonzero(cuts > 1), _places(gaps), np.repeat(np.arange(len(contexts)), held), w.astype(np.int64), customers.astype(np.int64)


def _sweep(shards: int, sweep: int, weight: float, sampled: bool):
    """Seat the contexts of a shard again, given the root (first: one table a dish), and send the root its customers."""

    def run(key: Any, frame: pd.DataFrame) -> pd.DataFrame:
        contexts, _, hot, words, home, w, customers = _laid(frame)
        tables = (customers > 0).astype(np.int64)
        if sweep:
            answers, ((house, *_),) = _of_kind(frame, "answer"), _of_kind(frame, "own")
            base, house = np.concatenate([a[0] for a in answers]) / weight, house.astype(float)
            house[hot] = np.concatenate([a[1] for a in answers])
            rng = np.random.default_rng([int(key[0]), sweep])
            heat = rng.standard_gamma(THETA / DISCOUNT + house)
            for k in hot:  # the same in each of its shards
                heat[k] = np.random.default_rng([int(contexts[k]), sweep]).standard_gamma(THETA / DISCOUNT + house[k])
            many = np.flatnonzero(customers > 1)
            tables[many] = draw_tables(customers[many], heat[home[many]] * base[w[many]], DISCOUNT, rng)
        house = np.bincount(home, tables, len(contexts)).astype(np.int64)
        seats = np.bincount(w, tables, len(words)).astype(np.int64)
        at, at_hot = _shard_edges(words, shards), _shard_edges(contexts[hot], shards)
        rows = [(int(key[0]), "own", 0, pack(_small(house), _small(tables if sampled else tables[:0])))]
        for s, (a, b, c, d) in enumerate(zip(at, at[1:], at_hot, at_hot[1:])):
            if b > a or d > c:
                rows.append((s, "root", int(key[0]), pack(_gaps(words[a:b]), _small(seats[a:b]), contexts[hot[c:d]], house[hot[c:d]])))
        give_back()
        return pd.DataFrame(rows, columns=["shard", "kind", "part", "data"])

    return run


def draw_root(customers: np.ndarray, mass: float, words: int, rng) -> tuple[np.ndarray, np.ndarray]:
    """Tables of the root's dishes, all with customers, and their weights: unnormalised probabilities of its measure."""
    share = mass / (words + 1)
    tables = draw_tables(customers, np.full(len(customers), share), ROOT_DISCOUNT, rng)
    return tables, rng.standard_gamma(customers - ROOT_DISCOUNT * tables) + rng.wald(share / 2, share * share / 2, len(customers))


def draw_mass(mass: float, words: int, weight: float, inverse: float, rng) -> tuple[float, float]:
    """The whole weight of the root, the unknown word's drawn and added, and its next mass; ``inverse``: the sum of 1 / weight."""
    share = mass / (words + 1)
    unknown = rng.wald(share / 2, share * share / 2)
    rate = (inverse + 1 / unknown) / (2 * (words + 1)) ** 2
    return weight + unknown, float(np.sqrt(rng.standard_gamma((words + 1 + ROOT_THETA / ROOT_DISCOUNT) / 2) / rate))


def _root(sweep: int, mass: float, words_known: int, sampled: bool):
    """Seat a shard of the root with the tables of all contexts; an answer to each context shard, totals on the first row."""

    def run(key: Any, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("part")
        parts = [unpack(b) for b in frame["data"]]
        words, index = np.unique(np.concatenate([_places(p[0]) for p in parts]), return_inverse=True)
        customers = np.bincount(index, np.concatenate([p[1] for p in parts]).astype(float), len(words)).astype(np.int64)
        hot, at_hot = np.unique(np.concatenate([p[2] for p in parts]), return_inverse=True)
        house = np.bincount(at_hot, np.concatenate([p[3] for p in parts]).astype(float), len(hot))
        known = np.flatnonzero(customers)
        tables, weights = np.zeros(len(words)), np.zeros(len(words))
        tables[known], weights[known] = draw_root(customers[known], mass, words_known, np.random.default_rng([int(key[0]), sweep, 1]))
        rows, at, to = [], 0, 0
        for part, p in zip(frame["part"], parts):
            own, own_hot = index[at : at + len(p[0])], at_hot[to : to + len(p[2])]
            at, to = at + len(p[0]), to + len(p[2])
            rows.append((part, "answer", int(key[0]), pack(weights[own].astype(np.float32), house[own_hot])))
            if sampled:
                rows.append((part, "seated", int(key[0]), pack(_small(customers[own]), _small(tables[own].astype(np.int64)), house[own_hot])))
        first = np.arange(len(rows)) == 0
        totals = {"k": float(customers.sum()), "t": float(tables.sum()), "weight": float(weights.sum()), "inverse": float((1 / weights[known]).sum())}
        give_back()
        return pd.DataFrame(rows, columns=["shard", "kind", "part", "data"]).assign(**{c: np.where(first, x, 0) for c, x in totals.items()})

    return run


def _messages(shards: int, n: int, v: int, part_of: int):
    """The tokens of each block, by document, to the shards of their contexts."""

    def run(batches):
        for batch in batches:
            for block, blob, counts in zip(*(batch.column(k).to_pylist() for k in range(3))):
                ids, missing, held, sizes, vocabulary, tokens, before, _ = _open(blob)
                count = unpack(counts)[0].astype(np.int64)
                ends = np.cumsum(sizes)
                total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[np.concatenate([[0], ends])])
                rows = []
                if block % shards % PASSES == part_of:
                    base = total(np.log10((count[tokens] + 1) / (n + v + 1)))
                    rows.append((block % shards, "documents", pack(ids, missing, held, sizes, total(count[tokens] > 0), base)))
                shard = _dealt(vocabulary, count, tokens, before, shards)[0]
                some = np.flatnonzero(shard % PASSES == part_of)
                keys, size = (shard[some] * len(vocabulary) + before[some]) * len(vocabulary) + tokens[some], len(vocabulary)
                order = np.argsort(keys, kind="stable")
                doc = np.repeat(np.arange(len(ids)), sizes)[some[order]]
                for s, own, first, contexts, pairs, words, w in _runs(keys[order], size):
                    repeats = np.diff(np.append(first, own.stop - own.start))
                    rows.append((s, "tokens", pack(vocabulary[contexts], _small(pairs), _gaps(vocabulary[words]), _small(w), _small(repeats), _small(doc[own]))))
                to, kinds, blobs = zip(*rows) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(kinds, pa.string()), pa.array([block] * len(to), pa.int64()), pa.array(blobs, pa.binary())], ["shard", "kind", "part", "data"])

    return tidy(run)


def _scores(totals: list[dict], v: int):
    """Sums of log10 probabilities by block and document, from the sampled seatings of a shard and of the root."""

    def run(key: Any, frame: pd.DataFrame) -> pd.DataFrame:
        facts = frame[frame["kind"] == "documents"]
        rows = list(zip(facts["part"], facts["kind"], facts["data"]))
        if (frame["kind"] == "tokens").any():
            contexts, size, hot, words, home, w, customers = _laid(frame)
            p = np.zeros(len(customers))
            for s, total in enumerate(totals):
                answers, ((house, tables),) = _of_kind(frame, f"seated{s}"), _of_kind(frame, f"own{s}")
                seated, house = np.concatenate([a[0] - ROOT_DISCOUNT * a[1] for a in answers]), house.astype(float)
                house[hot] = np.concatenate([a[2] for a in answers])
                root = (seated + (ROOT_THETA + ROOT_DISCOUNT * total["t"]) / (v + 1)) / (ROOT_THETA + total["k"])
                p += customers - DISCOUNT * tables + (THETA + DISCOUNT * house[home]) * root[w]
            logs, dishes = np.log10(p / len(totals) / (THETA + size[home])), home * len(words) + w
            sent = frame[frame["kind"] == "tokens"].sort_values("part")
            for block, blob in zip(sent["part"], sent["data"]):
                own, pairs, gaps, at, repeats, doc = unpack(blob)
                keys = np.repeat(np.searchsorted(contexts, own), pairs) * len(words) + np.searchsorted(words, _places(gaps))[at]
                rows.append((block, "scores", pack(np.bincount(doc.astype(np.int64), np.repeat(logs[np.searchsorted(dishes, keys)], repeats)))))
        give_back()
        return pd.DataFrame(rows, columns=["block", "kind", "data"])

    return run


def _sums(n: int):
    def run(key: Any, frame: pd.DataFrame) -> pd.DataFrame:
        (facts,) = [unpack(d) for k, d in zip(frame["kind"], frame["data"]) if k == "documents"]
        ids, missing, held, sizes, known, base = facts
        score = np.zeros(len(ids))
        for d in sorted(d for k, d in zip(frame["kind"], frame["data"]) if k == "scores"):
            (part,) = unpack(d)
            score[: len(part)] += part
        keys = pd.array(ids, dtype="Int64")
        keys[missing] = pd.NA
        return pd.DataFrame({"doc_id": keys, "held_out": held, "n_tokens": sizes, "n_known": known, "train_tokens": n, "base_score": base, "score": score})

    return run


def _sample(state: DataFrame, root_shards: int, v: int) -> tuple[list[DataFrame], list[dict]]:
    """Sweeps of all contexts and of the root in turn: the sampled seatings, and the root's totals in each sample."""
    rng = np.random.default_rng(0)
    mass, weight, before, kept, totals = float(rng.standard_gamma(ROOT_THETA / ROOT_DISCOUNT + v)), 1.0, [], [], []
    sums = ["k", "t", "weight", "inverse"]
    for sweep in range(BURN_IN + SAMPLES + 1):  # the first only seats the root
        sampled = sweep > BURN_IN
        known = functools.reduce(DataFrame.union, [state, *(t.select(*state.columns).where("kind in ('own', 'answer')") for t in before)])
        seats = stash(known.groupBy("shard").applyInPandas(_sweep(root_shards, sweep, weight, sampled), MESSAGE))
        root = seats.where("kind = 'root'").groupBy("shard").applyInPandas(_root(sweep, mass, v, sampled), f"{MESSAGE}, {', '.join(f'{c} double' for c in sums)}")
        root = stash(root)
        total = root.agg(*[F.sum(c).alias(c) for c in sums]).first().asDict()
        weight, mass = draw_mass(mass, v, total["weight"], total["inverse"], rng)
        discard(*before)
        before = [seats, root]
        if sampled:  # kept without the messages beside them
            for table, kind in ((seats, "own"), (root, "seated")):
                kept.append(stash(table.where(F.col("kind") == kind).select("shard", F.lit(f"{kind}{len(totals)}").alias("kind"), "part", "data")))
            totals.append(total)
    discard(*before)
    return kept, totals


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Train on the documents that are not held out and score all of them."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    blocks = stash(slim.mapInArrow(_blocks(block_words), "block long, words long, vocabulary long, data binary"))
    words, vocabulary = blocks.agg(F.sum("words"), F.sum("vocabulary")).first()
    if not words:
        return docs.sparkSession.createDataFrame([], RESULT)
    root_shards, shards = max(1, -(-vocabulary // 300_000)), max(1, -(-words // shard_words))
    sent = blocks.select("block", "data").mapInArrow(_vocabularies(root_shards), "shard int, block long, data binary")
    answers = stash(sent.groupBy("shard").applyInPandas(_counts, "block long, shard int, data binary, n long, v long"))
    n, v = answers.agg(F.sum("n"), F.sum("v")).first()
    counted = blocks.select("block", "data").groupBy("block").cogroup(answers.select("block", "shard", "data").groupBy("block"))
    counted = stash(counted.applyInPandas(_counted, "block long, data binary, counts binary"))
    discard(blocks, answers)
    state = stash(counted.mapInArrow(_pairs(shards), "shard int, block long, data binary").groupBy("shard").applyInPandas(_restaurants, MESSAGE))
    kept, totals = _sample(state, root_shards, v)
    sums = []
    for part_of in range(PASSES):  # the messages of a part of the shards at a time, so that less lies on disk at once
        sent = counted.mapInArrow(_messages(shards, n, v, part_of), MESSAGE)
        known = functools.reduce(DataFrame.union, [state, *kept]).where(F.col("shard") % PASSES == part_of)
        sums.append(stash(sent.union(known).groupBy("shard").applyInPandas(_scores(totals, v), "block long, kind string, data binary")))
    discard(counted, state, *kept)
    return functools.reduce(DataFrame.union, sums).groupBy("block").applyInPandas(_sums(n), RESULT)


def perplexity(scored: DataFrame) -> DataFrame:
    """Perplexity per token of held-out and training documents, of the model and of the base."""
    power = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scored.groupBy("held_out").agg(power("score").alias("perplexity"), power("base_score").alias("base_perplexity"))


def query(spark, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir))
