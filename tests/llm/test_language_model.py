import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np

from hearthline.llm import language_model as lm


def tokens(text):
    lower = (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).decode()
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + [None]


def held(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2


def test_base_equals_brute_force(docs, no_docs):
    rows = [(r.doc_id, tokens(r.text)) for r in docs.collect()]
    counts = Counter(t for i, ts in rows if not held(i) for t in ts)
    n, v = sum(counts.values()), len(counts)
    want = sorted(((i, held(i), len(ts), sum(t in counts for t in ts), n) for i, ts in rows), key=repr)
    for size in (10**6, 300):
        got = lm.score_documents(docs, block_words=size, shard_words=size).collect()
        assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got), key=repr) == want
        base = sorted(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts) for _, ts in rows)
        assert np.allclose(sorted(r.base_score for r in got), base)
        assert all(r.score < 0 for r in got)
    assert lm.score_documents(no_docs).count() == 0


def test_held_out_beats_the_base(spark):
    scored = lm.score_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    for r in lm.perplexity(scored).collect():
        assert r.perplexity < r.base_perplexity


def exact_tables(customers, base, theta, d):
    """Mean tables of one restaurant by enumerating all seatings of each dish."""

    def partitions(c):
        out = Counter()
        for z in itertools.product(range(c), repeat=c):
            if all(z[k] <= max(z[:k], default=-1) + 1 for k in range(c)):
                sizes = Counter(z).values()
                out[len(sizes)] += math.prod(math.prod(j - d for j in range(1, s)) for s in sizes)
        return out

    weight = total = 0.0
    for ts in itertools.product(*[partitions(c).items() for c in customers]):
        t = sum(k for k, _ in ts)
        w = math.prod(theta + d * k for k in range(1, t)) * math.prod(x * b**k for (k, x), b in zip(ts, base))
        weight, total = weight + w, total + w * t
    return total / weight


def test_seating_matches_enumeration():
    customers, base = np.array([4, 3, 1]), np.array([0.3, 0.2, 0.05])
    want = exact_tables(customers.tolist(), base.tolist(), 1.0, 0.5)
    tables, house = lm.seat(customers, np.zeros(3, np.int64), base, 1.0, 0.5, np.ones(1), np.random.default_rng(1), 100, 8000)
    assert abs(house[0] - want) < 0.1 and abs(tables.sum() - house[0]) < 1e-6 and tables[2] == 1


def log_stirling(top, d):
    """Rows S(c, 1..c), in logs, of c = 1 to ``top``."""
    rows = [np.zeros(1)]
    for c in range(1, top):
        old = rows[-1]
        stay = old + np.log(c - d * np.arange(1, c + 1))
        rows.append(np.append(np.logaddexp(np.append(-np.inf, old[:-1]), stay), 0.0))
    return rows


def full_sweep_tables(c, p, theta, d, sweeps, rng):
    """Mean tables of a restaurant with one dish; every customer is seated again in each sweep."""
    at, size, seen = [0] * c, {0: c}, 0
    for sweep in range(sweeps):
        for k in range(c):
            size[at[k]] -= 1
            if not size[at[k]]:
                del size[at[k]]
            opens = (theta + d * len(size)) * p
            x = rng.random() * (opens + c - 1 - d * len(size))
            at[k] = next(j for j in itertools.count() if j not in size)
            for j, n in size.items():
                x -= n - d
                if x < 0:
                    at[k] = j
                    break
            size[at[k]] = size.get(at[k], 0) + 1
        seen += len(size) * (sweep >= sweeps // 5)
    return seen / (sweeps - sweeps // 5)


def test_large_pairs_are_seated_whole():
    """The sweeps that scoring makes, from one table a pair, against full sweeps and the exact mean."""
    theta, d, p, houses = 1.0, 0.85, 0.6, 400
    for c in (300, 1500):
        t = np.arange(1, c + 1)
        logs = log_stirling(c, d)[-1] + t * math.log(p) + np.cumsum(np.log(theta + d * (t - 1)))
        weight = np.exp(logs - logs.max())
        want = (weight * t).sum() / weight.sum()
        got = lm.seat(np.full(houses, c), np.arange(houses), np.full(houses, p), theta, d, np.ones(houses), np.random.default_rng(c))[0].mean()
        assert abs(got - want) < 0.2 * want
        long = lm.seat(np.full(20, c), np.arange(20), np.full(20, p), theta, d, np.ones(20), np.random.default_rng(c), 20, 100)[0].mean()
        assert abs(long - want) < 0.1 * want
        if c == 300:
            assert abs(full_sweep_tables(c, p, theta, d, 400, np.random.default_rng(5)) - want) < 0.2 * want


def test_large_table_counts_follow_the_stirling_numbers():
    c = np.array([300.0, 1500.0])
    for d in (0.5, 0.85):
        rows = log_stirling(1500, d)
        for n in c:
            t = np.arange(1.0, n + 1)
            logs = lm.log_sums(np.full(len(t), n), t, d) - t * math.log(d) - np.cumsum(np.log(t)) + math.lgamma(n + 1)
            assert np.allclose(logs, rows[int(n) - 1], atol=1e-6)
        for heat in (0.5, 40.0, 2000.0, 1e6):
            t = np.arange(1, 1501)
            logs = rows[-1] + t * math.log(d * heat)
            weight = np.exp(logs - logs.max()) / np.exp(logs - logs.max()).sum()
            mean, drawn = (weight * t).sum(), lm.draw_tables(np.full(150, 1500), np.full(150, heat), d, np.random.default_rng(2))
            assert abs(drawn.mean() - mean) < 0.05 + 5 * math.sqrt((weight * (t - mean) ** 2).sum() / 150)


def exact_root(pairs, words):
    """Mean customers of the root, in all and of the first word, and their tables, by enumerating all table counts of both levels."""
    theta, d, theta0, d0 = lm.THETA, lm.DISCOUNT, lm.ROOT_THETA, lm.ROOT_DISCOUNT
    contexts, root = log_stirling(max(pairs.values()), d), log_stirling(sum(pairs.values()), d0)
    keys, total, out = list(pairs), 0.0, np.zeros(3)
    for ts in itertools.product(*[range(1, pairs[k] + 1) for k in keys]):
        logs = sum(contexts[pairs[k] - 1][t - 1] for k, t in zip(keys, ts))
        for u in {u for u, _ in keys}:
            logs += sum(math.log(theta + d * k) for k in range(1, sum(t for (v, _), t in zip(keys, ts) if u == v)))
        c = [sum(t for (_, x), t in zip(keys, ts) if x == w) for w in range(words)]
        logs -= sum(math.log(theta0 + k) for k in range(1, sum(c)))
        for t0 in itertools.product(*[range(1, k + 1) for k in c]):
            more = sum(root[k - 1][t - 1] - t * math.log(words + 1) for k, t in zip(c, t0)) + sum(math.log(theta0 + d0 * k) for k in range(1, sum(t0)))
            weight = math.exp(logs + more)
            total += weight
            out += weight * np.array([sum(c), c[0], sum(t0)])
    return out / total


def test_both_levels_match_enumeration():
    pairs = {(0, 0): 6, (0, 1): 1, (1, 0): 3, (1, 2): 4, (2, 1): 2}
    want = exact_root(pairs, 3)
    home, w, c = (np.array(x) for x in ([u for u, _ in pairs], [w for _, w in pairs], list(pairs.values())))
    rng, tables, mass, seen, sweeps = np.random.default_rng(3), np.ones(len(pairs), np.int64), 5.0, np.zeros(3), 30_000
    for sweep in range(sweeps):
        customers = np.bincount(w, tables).astype(np.int64)
        root, weights = lm.draw_root(customers, mass, 3, rng)
        seen += [customers.sum(), customers[0], root.sum()]
        weight, mass = lm.draw_mass(mass, 3, weights.sum(), (1 / weights).sum(), rng)
        heat = rng.standard_gamma(lm.THETA / lm.DISCOUNT + np.bincount(home, tables))
        tables = lm.draw_tables(c, heat[home] * weights[w] / weight, lm.DISCOUNT, rng)
    assert np.allclose(seen / sweeps, want, rtol=0.02), (seen / sweeps, want)


def test_scores_do_not_depend_on_blocks(spark):
    """The root's customers are the tables of whole contexts, however the documents are cut."""
    docs = spark.createDataFrame([(i, " ".join(["x"] * 40 + [f"w{i % 7}", "x", "y"] * 5)) for i in range(60)], "doc_id long, text string")
    scores = [{r.doc_id: r.score for r in lm.score_documents(docs.coalesce(1), block_words=size).collect()} for size in (10**6, 300)]
    assert all(abs(scores[0][i] - scores[1][i]) < 1e-3 for i in scores[0])


def test_contexts_over_several_shards(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(f"a{i % 5} the b{(i * k) % 11} the c{k}" for k in range(20))) for i in range(60)], "doc_id long, text string").coalesce(1)
    whole = sum(r.score for r in lm.score_documents(docs, shard_words=400).collect())
    monkeypatch.setattr(lm, "HOT", 200)
    dealt = sum(r.score for r in lm.score_documents(docs, shard_words=400).collect())
    assert abs(dealt - whole) < 0.03 * abs(whole)
