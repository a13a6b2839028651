import random
from collections import Counter

import duckdb
from pyspark.sql import functions as F

import corpus_pipeline
from hearthline.llm import mixing, quality
from hearthline.llm.support import stash
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_lsh_forest import brute as brute_near
from tests.llm.test_quality import brute as brute_quality
from tests.llm.test_simhash import shingles_of, survivors
from tests.llm.test_token_files import plain_ids

SF = "/root/testdata/sf0.001"


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def near_survivors(texts):
    """texts: (id, text). What stays of the components at 0.8 over all pairs: the smallest id, and texts that are unlike it."""
    own = {t: i for i, t in texts}
    numbered = sorted(own.items(), key=lambda x: (x[1] is None, x[1] or 0))
    place = {k: t for k, (t, _) in enumerate(numbered)}
    out = []
    for row in brute_near([(k, t) for k, t in place.items()], size=5)[0]:
        k, _, c, _ = row
        a, b = (set(shingles_of(place[x], 5)) for x in (k, c))
        if k == c or not len(a & b) >= 0.8 * len(a | b):
            out.append((own[place[k]], place[k]))
    return sorted(out, key=repr)


def test_near_copies_are_found(spark):
    """300 words, three of them changed: nearly all such pairs are at 0.8 or more, and one of each goes."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8)))
    rows = []
    for k in range(200):
        base = [word() for _ in range(300)]
        near = list(base)
        for at in rng.sample(range(300), 3):
            near[at] = word()
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(near))]
    table = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, table, SF).collect()}
    sets = [set(shingles_of(t, 5)) for _, t in rows]
    pairs = [k for k in range(0, 400, 2) if len(sets[k] & sets[k + 1]) >= 0.8 * len(sets[k] | sets[k + 1])]
    found = sum(k + 1 not in kept for k in pairs)
    assert len(pairs) > 190 and found >= 0.99 * len(pairs) and all(k in kept for k in range(0, 400, 2)), (found, len(pairs))


def test_each_stage_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    verdicts, given = {r.doc_id: r for r in quality.assess(docs, min_words=1).collect()}, rows(docs)
    outputs, now = [], docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, SF).write.parquet(str(tmp_path / str(k)))
        now = spark.read.parquet(str(tmp_path / str(k)))
        outputs.append(now)
        if k < 4:
            assert now.columns == docs.columns
    good = rows(outputs[0])
    assert set(good) == {i for i, v in verdicts.items() if v.kept}
    assert not any(brute_quality(given[i].text)[-1] for i in good if verdicts[i].n_words >= 50)
    cut, want = rows(outputs[1]), brute_lines([(i, r.text) for i, r in good.items()], 12)
    assert {i: r.text for i, r in cut.items()} == {i: t for i, t in want.items() if t.split() or t == good[i].text}
    one = rows(outputs[2])
    assert sorted(((i, r.text or "") for i, r in one.items()), key=repr) == near_survivors(survivors([(i, r.text) for i, r in cut.items()]))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/2/*.parquet'")
    mixed = Counter(r.doc_id for r in outputs[3].collect())
    assert mixed == Counter(r[0] for r in con.execute(mixing.ORACLE).fetchall())
    pieces = outputs[4].collect()
    placed = Counter()
    for p in pieces:
        placed[p.doc_id] += p.length
    assert placed == {i: n * len(plain_ids(one[i].text, 2)) for i, n in mixed.items()}


def test_stages_take_odd_tables(spark, docs, no_docs):
    """Null, empty and very long texts, rows that repeat, clashing columns of the caller's, and no rows at all."""
    clash = {c: F.lit("theirs") for c in ("n_words", "kept", "n_lines", "kept_text", "mix", "lang_", "th", "fp", "spread")}
    for table in (docs, no_docs):
        now = table.withColumns(clash)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stash(stage(spark, now, SF))
            assert now.columns == [*table.columns, *clash] and dict(now.dtypes)["kept"] == "string"
            assert now.where("kept <> 'theirs'").count() == 0
        corpus_pipeline.STAGES[-1][1](spark, now, SF).collect()


def test_run_packs_what_the_stages_leave(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 0
