import random
from pathlib import Path

from hearthline.llm import lsh_forest
from hearthline.llm.support import scratch_dir
from tests.llm.test_simhash import shingles_of


def sets_of(rows, size=4):
    return [frozenset(shingles_of(t, size)) for _, t in rows]


def brute(rows, similarity=80, size=4):
    """(id, n_shingles, component_id, kept) by comparing all pairs of distinct sets that share a shingle."""
    sets = sets_of(rows, size)
    classes = sorted({s for s in sets if s}, key=lambda s: sorted(s))
    number = {s: k for k, s in enumerate(classes)}
    parent = list(range(len(classes)))

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    links, holders = set(), {}
    for k, s in enumerate(classes):
        near = set()
        for g in s:
            near.update(holders.get(g, ()))
            holders.setdefault(g, []).append(k)
        for j in near:
            both = len(s & classes[j])
            if 100 * both >= similarity * (len(s) + len(classes[j]) - both):
                links.add((j, k))
                parent[find(j)] = find(k)
    least, first = {}, {}
    for k, ((i, _), s) in enumerate(zip(rows, sets)):
        if s:
            c = find(number[s])
            first.setdefault(c, k)
            if i is not None:
                least[c] = min(least.get(c, i), i)
    out = []
    for k, ((i, _), s) in enumerate(zip(rows, sets)):
        c = least.get(find(number[s])) if s else i
        out.append((i, len(s), c, not s or (k == first[find(number[s])] if c is None else i == c)))
    return out, links, classes


def crowds(seed=3, groups=12, size=60, words=150):
    """Groups of near copies, from a word changed to a third of the words, and unlike texts that share half of theirs."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7)))
    shared, rows = [word() for _ in range(words // 2)], []
    for g in range(groups):
        base = [word() for _ in range(words)]
        for k in range(size):
            t = list(base)
            for _ in range(rng.randrange(0, 1 + g)):
                t[rng.randrange(words)] = word()
            rows.append((len(rows), " ".join(t)))
    rows += [(10_000 + k, " ".join(shared + [word() for _ in range(words // 2)])) for k in range(300)]
    rng.shuffle(rows)
    return rows


def answers(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def test_equals_brute_force(spark, docs, no_docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert answers(lsh_forest.near_duplicates(docs)) == sorted(brute(rows)[0], key=repr)
    assert lsh_forest.near_duplicates(no_docs).count() == 0


def test_crowds_equal_brute_force(spark):
    rows = crowds() + [(None, "only null ids here"), (None, "only null ids here"), (None, "Only NULL ids here"), (None, " ")]
    table = spark.createDataFrame([(i, t, "theirs", 1, True) for i, t in rows], "doc_id long, text string, key string, n int, kept boolean").coalesce(1)
    want, links, _ = brute(rows)
    assert len(links) > 3000
    got = answers(lsh_forest.near_duplicates(table))
    assert got == sorted(want, key=repr)
    assert sum(r[3] for r in got if r[1] == 1) == 1  # of null ids one row stays


def test_candidates_recall(spark):
    """Of all pairs of unlike sets at 0.8 or more, in regions that are not crowded, nearly all are neighbours in some tree."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = []
    for k in range(1000):
        base = [word() for _ in range(120)]
        near = list(base)
        for at in rng.sample(range(5, 115, 5), 2 + k % 2):
            near[at] = word()
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(near))]
    table = spark.createDataFrame(rows, "id long, text string")
    wide = table.mapInArrow(lsh_forest._describe(4), "id long, rid long, n long, key binary, signature binary, hashes binary").cache()
    classes = wide.select("rid", "n", "signature").selectExpr("*", "rid as component")
    found = lsh_forest.candidates(classes, range(lsh_forest.TREES), 0.8, False)
    ids = {r.rid: r.id for r in wide.select("rid", "id").collect()}
    got = {tuple(sorted((ids[r.a], ids[r.b]))) for r in found.collect()}
    sets = sets_of(rows)
    pairs = [(a, a + 1) for a in range(0, len(rows), 2)]
    alike = [len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in pairs]
    recall = sum(p in got for p in pairs) / len(pairs)
    assert 0.8 <= min(alike) < 0.82 and max(alike) < 0.88 and recall >= 0.998, recall


def test_parts_meet_at_their_edges(spark, monkeypatch):
    rows = crowds(5, 4, 40)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    want = answers(lsh_forest.near_duplicates(table))
    monkeypatch.setattr(lsh_forest, "PART_ROWS", 300)
    assert answers(lsh_forest.near_duplicates(table.repartition(7))) == want == sorted(brute(rows)[0], key=repr)


def test_long_text_and_columns_of_any_type(spark):
    long = " ".join(str(k) for k in range(200_000))
    table = spark.createDataFrame([("b", long), ("a", long + " end"), ("c", "x y"), ("d", None)], "name string, body string")
    got = {r.name: (r.n_shingles, r.component_id, r.kept) for r in lsh_forest.near_duplicates(table, id_col="name", text_col="body").collect()}
    assert got == {"b": (199_997, "a", False), "a": (199_998, "a", True), "c": (1, "c", True), "d": (0, "d", True)}


def test_sets_are_not_left_behind(spark, docs):
    """Shingle sets are larger than the texts: no scratch table holds them in the end, nor the signatures."""
    folder = Path(scratch_dir(spark).removeprefix("file://"))
    before = set(folder.glob("table-*"))
    assert lsh_forest.near_duplicates(docs).count() == docs.count()
    left = [spark.read.parquet(f"file://{t}").columns for t in set(folder.glob("table-*")) - before]
    assert left and not [c for c in left if {"hashes", "signature"} & set(c)]


def star(words=300, changes=8, near=900, seed=11):
    """A text and near copies of it at 0.805 that are unlike each other (0.65): each is linked to the one text alone."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(words)]
    rows = [(0, " ".join(base))]
    for k in range(near):
        t = list(base)
        for at in rng.sample(range(4, words - 4, 4), changes):
            t[at] = word()
        rows.append((k + 1, " ".join(t)))
    return rows


def test_near_copies_in_a_crowd_are_found(spark, monkeypatch):
    """Far more near copies of one text than there are neighbours in all trees, in one block of a crowd or in many."""
    rows = star()
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want, links, _ = brute(rows)
    assert len(links) == 900 and {r[2] for r in want} == {0}
    assert answers(lsh_forest.near_duplicates(table)) == sorted(want, key=repr)
    monkeypatch.setattr(lsh_forest, "BLOCK_HASHES", 50 * lsh_forest.ROW_HASHES)
    assert answers(lsh_forest.near_duplicates(table)) == sorted(want, key=repr)
