import random
import re
import zlib
from collections import Counter

import numpy as np

from hearthline.llm import spelling

A_Z = {c: c + 32 for c in range(65, 91)}


def counts(rows, min_letters=6, min_count=5):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(A_Z)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= min_letters and n >= min_count}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(words, ratio=5):
    near = {w: [v for v in words if one_apart(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= ratio * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def crowd(seed=4, letters="abé"):
    """Words with many near words, chains of forms, ties, capitals and other marks."""
    rng = random.Random(seed)
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(5, 9))) for _ in range(150)]
    texts = []
    for k, w in enumerate(words):
        texts += [f"{w} {w.upper() if k % 2 else w}1{w}-{w}\n{w}"] * rng.choice([1, 1, 2, 6, 40])
    rng.shuffle(texts)
    chain = ["kettles"] * 1000 + ["kettlez"] * 180 + ["kettlzz"] * 30 + ["kttlzz"] * 5
    return [(k % 90 if k % 50 else None, t) for k, t in enumerate(texts)] + [(7, " ".join(chain)), (8, None), (9, ""), (10, "ÀÉ×" * 4 + " ÀÉ×ÀÉ×ÀÉ×ÀÉ× " * 6), (11, ("q" * 5000 + " ") * 5 + ("q" * 4999 + "r ") * 30)]


def test_equals_brute_force(spark):
    rows = crowd()
    rows += rows[:40]  # rows that repeat count again
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, word string").repartition(3)
    got, words = rows_of(spelling.variants(table)), counts(rows)
    assert got == brute(words) and len(got) > 100
    by = {r[0]: r for r in got}
    assert by["kttlzz"][2] == "kettles" and by["q" * 5000][1] == "q" * 4999 + "r"


def test_cut_keys_lose_no_pair(spark, monkeypatch):
    """Keys with more words than a block holds are cut; the answer is the same."""
    rows = crowd(9)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    words = spelling.vocabulary(table)
    whole = sorted(map(tuple, spelling.near_words(words).collect()))
    monkeypatch.setattr(spelling, "BLOCK_LETTERS", 1)  # 64 words a block
    many = [(f"{a}{b}{c}tail{d}", 5 + k) for k, (a, b, c, d) in enumerate((a, b, c, d) for a in "xyz" for b in "abcd" for c in "abcde" for d in "ghijk")]
    assert sorted(map(tuple, spelling.near_words(words).collect())) == whole
    crowded = spark.createDataFrame(many, "word string, n long")
    assert spelling._blocks(crowded).select("block").distinct().count() > 3
    got = {r.word: (r.n_near, r.best) for r in spelling.near_words(crowded).collect()}
    counted = dict(many)
    for w, (n_near, best) in got.items():
        near = [v for v in counted if one_apart(w, v)]
        assert n_near == len(near) and best == min(near, key=lambda v: (-counted[v], v))
    assert len(got) == len(many)


def test_bitsets_against_edit_distance():
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("ab") for _ in range(n)) for n in (7, 8) for _ in range(150)})
    codes, sizes = spelling._codes(words)
    index = spelling.PositionIndex(codes, sizes, 7)
    for m in (7, 8):
        asked = np.flatnonzero(sizes == m)
        hits = np.unpackbits(index.one_error(codes[asked, :m]).view(np.uint8), axis=1, bitorder="little")[:, : len(words)].astype(bool)
        for q, hit in zip(asked, hits):
            assert [words[k] for k in np.flatnonzero(hit)] == [w for w in words if one_apart(w, words[q])]


def test_driver_table_and_no_rows(spark, no_docs):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert rows_of(spelling.query(spark, "/root/testdata/sf0.001")) == brute(counts([(r.doc_id, r.text) for r in table.collect()]))
    assert spelling.variants(no_docs).count() == 0
