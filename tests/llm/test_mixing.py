import math
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from hearthline.llm import mixing


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def weights(shares, alpha):
    powers = [p**alpha for p in shares]
    return [x / sum(powers) for x in powers]


@pytest.mark.parametrize(("entropy", "repeats"), [(0.97, None), (None, 1.2)])
def test_weights_meet_their_target(spark, entropy, repeats):
    counts = {"a": 600, "b": 300, "c": 80, "d": 20, "none": 0}
    got = mixing.source_weights(spark.createDataFrame(list(counts.items()), "source string, tokens long"), 1.0, entropy, repeats).collect()
    assert sorted(r.source for r in got) == ["a", "b", "c", "d"]
    w = {r.source: r.weight for r in got}
    assert abs(sum(w.values()) - 1) < 1e-9 and abs(sum(r.budget for r in got) - 1000) <= 4
    if entropy:
        assert abs(-sum(x * math.log(x) for x in w.values()) - entropy * math.log(4)) < 1e-9
    else:
        assert abs(max(w[s] * 1000 / counts[s] for s in w) - repeats) < 1e-9
    shares = [0.6, 0.3, 0.08, 0.02]
    alpha = math.log(w["a"] / w["d"]) / math.log(30)
    assert all(abs(x - y) < 1e-9 for x, y in zip(weights(shares, alpha), (w[s] for s in "abcd")))


def test_budgets_are_kept(docs):
    out = mixing.mix(docs, entropy_share=0.95, blocks=4)
    assert out.columns == [*docs.columns, "mix"]
    rows, longest = out.collect(), defaultdict(int)
    tokens = Counter()
    for r in docs.collect():
        tokens[r.source or ""] += words(r.text)
        longest[r.source or ""] = max(longest[r.source or ""], words(r.text))
    budget = {r.source: r.budget for r in mixing.source_weights(docs.sparkSession.createDataFrame(list(tokens.items()), "source string, tokens long"), entropy_share=0.95).collect()}
    taken, epochs = Counter(), defaultdict(Counter)
    for r in rows:
        assert r.mix.n_tokens == words(r.text) and r.mix.source == (r.source or "")
        taken[r.mix.source] += r.mix.n_tokens
        epochs[r.mix.source][r.mix.epoch] += r.mix.n_tokens
    for source, b in budget.items():
        assert b - longest[source] - 1 <= taken[source] <= b
        last = max(epochs[source])
        assert all(n == tokens[source] for e, n in epochs[source].items() if e < last)


def test_empty(no_docs):
    assert mixing.mix(no_docs, max_repeats=2.0).count() == 0


def test_query_equals_plain_sql(spark):
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    want = sorted(con.execute(mixing.ORACLE).fetchall())
    got = sorted(tuple(r) for r in mixing.query(spark, "/root/testdata/sf0.001").collect())
    assert got == want and want
