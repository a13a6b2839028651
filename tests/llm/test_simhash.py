import random

import xxhash

from hearthline.llm import simhash


def shingles_of(text, size):
    lower = (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))
    words = lower.split()
    return [b" ".join(words[k : k + size]) for k in range(max(len(words) - size + 1, 1))] if words else []


def fingerprint(text, size=3):
    shingles = shingles_of(text, size)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(items):
    """items: (id, fingerprint) -> component by id, over all pairs."""
    parent = list(range(len(items)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(items)):
        for b in range(a):
            if (items[a][1] ^ items[b][1]).bit_count() <= 3:
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(items):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [(i, fp, least.get(find(k))) for k, (i, fp) in enumerate(items)]


def test_equals_brute_force(docs):
    items = [(r.doc_id, fingerprint(r.text)) for r in docs.collect()]
    got = [(r.doc_id, r.fingerprint % 2**64, r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(got, key=repr) == sorted(grouped(items), key=repr)


def test_pigeonring_loses_no_pair(spark):
    rng = random.Random(3)
    prints = {rng.getrandbits(64) for _ in range(40)}
    for p in list(prints):
        for _ in range(6):
            q = p
            for b in rng.sample(range(64), rng.randrange(1, 5)):
                q ^= 1 << b
            prints.add(q)
    signed = {p - 2**64 if p >= 2**63 else p for p in prints}
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) % 2**64).bit_count() <= 3}
    assert want == {tuple(r) for r in simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()}


def test_chains_collapse(spark):
    edges = spark.createDataFrame([(k + 1, k) for k in range(40)] + [(100, 101)], "a long, b long")
    assert dict(simhash.components(edges).collect()) == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


def survivors(rows, size=5):
    """rows: (id, text). What stays, by comparing all fingerprints, then similarity to the first text of each component."""
    texts = {}
    for i, t in rows:
        texts.setdefault(t or "", []).append((i is None, i or 0, i))
    items = [(t, fingerprint(t, size)) for t in texts]
    numbered = [(k, fp) for k, (_, fp) in enumerate(items)]
    groups = {}
    for (k, _, c), (t, _) in zip(grouped(numbered), items):
        groups.setdefault(c, []).append(t)
    out = []
    for own in groups.values():
        kept = min(own, key=lambda t: min(texts[t]))
        for t in own:
            a, b = set(shingles_of(t, size)), set(shingles_of(kept, size))
            if t == kept or not len(a & b) >= 0.8 * len(a | b):
                out.append((min(texts[t])[2], t))
    return sorted(out, key=repr)


def test_one_of_each_group_stays(spark, docs, no_docs):
    kept = simhash.keep_one_of_each_group(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(((r.doc_id, r.text or "") for r in kept.collect()), key=repr) == survivors(rows)
    words = [f"w{k}" for k in range(300)]
    near = " ".join(words[:150] + ["other"] + words[151:])
    more = [(None, " ".join(words))] * 3 + [(7, near), (7, "another text of the same id"), (9, near), (8, "x y z"), (8, "x y z"), (None, "x y z")]
    table = spark.createDataFrame([(i, t, 1, 2) for i, t in more], "doc_id long, text string, th int, fp int")
    got = sorted(((r.doc_id, r.text) for r in simhash.keep_one_of_each_group(table).collect()), key=repr)
    assert got == survivors(more) and len(got) in (3, 4)
    assert simhash.keep_one_of_each_group(no_docs).count() == 0
    assert simhash.near_duplicates(no_docs).count() == 0


def test_exploded_fingerprints_are_not_broadcast(spark):
    """Spark sizes eight rows a fingerprint as one: the join of the ring must not become a broadcast."""
    prints = spark.range(2000).selectExpr("id * 7919 as fp")
    assert "Broadcast" not in simhash.links(prints)._jdf.queryExecution().sparkPlan().toString()
