from collections import defaultdict

from pyspark.sql import functions as F

from hearthline.llm.substring_dedup import remove_repeated_windows


def brute(rows, window):
    first = defaultdict(lambda: float("inf"))
    words = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in words:
        for k in range(len(w) - window + 1):
            if i is not None:
                first[tuple(w[k : k + window])] = min(first[tuple(w[k : k + window])], i)
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone |= set(range(k, k + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=repr)


def test_equals_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for window in (50, 7, 1):
        got = remove_repeated_windows(docs, window)
        assert set(docs.columns) <= set(got.columns)
        assert sorted(map(tuple, got.select("doc_id", "n_words", "n_removed", "kept_text").collect()), key=repr) == brute(rows, window)
        assert got.where(F.expr("aggregate(removed_spans, 0L, (s, x) -> s + x.end - x.start) <> n_removed")).count() == 0


def test_empty_table(no_docs):
    assert remove_repeated_windows(no_docs).count() == 0
