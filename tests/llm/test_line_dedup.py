import random

import duckdb
import pytest

from hearthline.llm import line_dedup

BLANKS = " \t\r\x0b\x0c"


def close(a, b):
    """Within one edit."""
    if abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def brute(rows, least):
    """rows: distinct (id or None, text). Which lines of each stay."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = [], {}
    for i, text in order:
        kept = []
        for raw in (text or "").split("\n"):
            line = raw.strip(BLANKS)
            if line:
                if any(line == s or (min(len(line), len(s)) >= least and close(line, s)) for s in seen):
                    seen.append(line)
                    continue
                seen.append(line)
            kept.append(raw)
        out[i] = "\n".join(kept)
    return out


def edited(rng, line):
    k = rng.randrange(len(line) + 1)
    return rng.choice([line[:k] + "q" + line[k:], line[:k] + line[k + 1 :], line[:k] + "z" + line[k + 1 :], line + "é", line[1:]])


def make(rng):
    bases = ["".join(rng.choice("abcdé ß") for _ in range(rng.choice([12, 13, 14, 40, 150, 700]))).strip() + "x" for _ in range(12)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(0, 6)):
            line = rng.choice(bases)
            for _ in range(rng.randrange(0, 3)):
                line = edited(rng, line)
            lines.append(rng.choice(["", " ", "\t"]) + line + rng.choice(["", "\r"]))
        lines += rng.choice([[], [""], ["short"], ["", "short", "short"], ["1.", "2."]])
        rows.append((i, "\n".join(lines)))
    return rows + [(100, None), (101, ""), (None, bases[0]), (102, "ab" * 4000), (103, "ab" * 3999 + "a")]


def test_equals_brute_force(spark):
    for seed in (1, 2):
        rows = make(random.Random(seed))
        random.Random(seed).shuffle(rows)
        docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, h1 string, outsides int").repartition(3)
        got = {r.doc_id: r.kept_text for r in line_dedup.dedup_lines(docs).collect()}
        assert got == brute(rows, 12)


def test_rows_that_repeat_and_empty(spark, docs, no_docs):
    out = line_dedup.dedup_lines(docs).collect()
    assert len(out) == docs.count()
    by = {}
    for r in out:
        assert r.n_lines == len((r.text or "").split("\n"))
        by.setdefault((r.doc_id, r.text), set()).add(r.kept_text)
    assert all(len(v) == 1 for v in by.values())
    assert line_dedup.dedup_lines(no_docs).count() == 0


def test_a_callers_column_is_never_overwritten(docs):
    with pytest.raises(ValueError, match="n_lines"):
        line_dedup.dedup_lines(docs.withColumn("N_lines", docs.id))


def test_texts_meet_lines_by_shuffle_alike(spark, docs, monkeypatch):
    small = docs.where("length(text) < 2000")
    want = sorted(map(str, line_dedup.dedup_lines(small).collect()))
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(line_dedup, "HOT", 1)
    assert sorted(map(str, line_dedup.dedup_lines(small).collect())) == want


def test_query_equals_plain_sql(spark):
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    want = sorted(con.execute(line_dedup.ORACLE).fetchall())
    assert sorted(tuple(r) for r in line_dedup.query(spark, "/root/testdata/sf0.001").collect()) == want


def test_exploded_variants_are_not_broadcast(docs, monkeypatch):
    """Spark sizes a line's variants as one row: their join must not become a broadcast."""
    plans, stash = {}, line_dedup.stash

    def seen(df, *rest):
        plans[tuple(df.columns)] = df._jdf.queryExecution().sparkPlan().toString()
        return stash(df, *rest)

    monkeypatch.setattr(line_dedup, "stash", seen)
    assert line_dedup.dedup_lines(docs).count() == docs.count()
    assert "Broadcast" not in plans["key", "role", "h1", "h2"]
