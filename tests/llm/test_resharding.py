import itertools
import math
import os
import random
import uuid
import zlib

from pyspark.sql import functions as F

from hearthline.llm import resharding
from hearthline.llm.support import scratch_dir


def test_flow_is_cheapest():
    rng = random.Random(4)
    for _ in range(20):
        supply = [rng.randrange(0, 9) for _ in range(3)]
        capacity = resharding.even_capacities(sum(supply), 3)
        flow = resharding.cheapest_flow(supply, capacity, lambda i, j: int(i != j))
        assert [sum(v for (i, _), v in flow.items() if i == k) for k in range(3)] == supply
        assert all(sum(v for (_, j), v in flow.items() if j == k) <= capacity[k] for k in range(3))
        # No other flow keeps more in place: what a shard keeps is bounded by both its sides.
        assert sum(v for (i, j), v in flow.items() if i == j) == sum(map(min, supply, capacity))


def test_flow_with_distances_beats_every_assignment():
    supply, capacity, cost = [1, 1, 1], [1, 1, 1], [[4, 1, 3], [2, 0, 5], [3, 2, 2]]
    flow = resharding.cheapest_flow(supply, capacity, lambda i, j: cost[i][j])
    assert sum(cost[i][j] * v for (i, j), v in flow.items()) == min(sum(cost[i][p[i]] for i in range(3)) for p in itertools.permutations(range(3)))


def reshard(spark, docs, shards, **kw):
    path = f"{scratch_dir(spark)}/reshard-{uuid.uuid4().hex}"
    return resharding.reshard(docs, shards, path, **kw), path


def test_laws(spark, docs, no_docs):
    docs = docs.withColumn("slot", F.lit("theirs")).withColumn("old_shard", F.when(F.col("source") != "src4", F.pmod(F.hash("source"), F.lit(5))))
    out, path = reshard(spark, docs, 6, cells=4)
    plan = out.collect()
    assert len(plan) == docs.count()
    by = {}
    for r in plan:
        by.setdefault(r["shard"], []).append(r)
    total, largest = sum(r["size"] for r in plan), max(r["size"] for r in plan)
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 6) <= largest
    supply = [sum(r["size"] for r in plan if r["old_shard"] == i) for i in range(5)]
    surplus = sum(max(0, s - total / 6) for s in supply)
    assert abs(sum(r["size"] for r in plan if r["old_shard"] != r["shard"]) - surplus) <= 5 * largest
    back = spark.read.parquet(path)
    assert set(docs.columns) <= set(back.columns) and back.where("slot = 'theirs'").count() == back.count()
    assert reshard(spark, no_docs.withColumn("old_shard", F.lit(0)), 6)[0].count() == 0


def brute_places(rows, cells, flow):
    """Every row's shard: old shards' rows in order, cut by the flow."""
    rows = sorted(rows, key=lambda r: (r["old_shard"], -math.floor(math.log2(r["size"]) * 4), r["tag"] % cells, r["tag"]))
    out, at = [], {}
    for r in rows:
        i = r["old_shard"]
        middle = at.get(i, 0) + r["size"] // 2
        at[i] = at.get(i, 0) + r["size"]
        own = [s for s in resharding._stretches(flow) if s[0] == i and s[2] <= middle]
        out.append((r["tag"], own[-1][1]))
    return sorted(out)


def test_places_match_a_plain_walk(spark):
    rng = random.Random(9)
    rows = [{"old_shard": 0 if k % 3 else k % 4, "size": rng.choice([1, 2, 7, 60, 900, 3000]), "tag": rng.randrange(-(2**63), 2**63)} for k in range(500)]
    table = spark.createDataFrame([(r["old_shard"], r["size"], r["tag"]) for r in rows], "old_shard int, size long, tag long")
    cuts, touched = resharding.find_cuts(table, 5, cells=3)
    got = sorted((r["tag"], r["shard"]) for r in resharding.place_rows(table, cuts, 3).collect())
    supply = [sum(r["size"] for r in rows if r["old_shard"] == i) for i in range(4)]
    flow = resharding.cheapest_flow(supply, resharding.even_capacities(sum(supply), 5), lambda i, j: int(i != j))
    assert got == brute_places(rows, 3, flow) and touched == [0, 1, 2, 3, 4]


def test_only_affected_shards_are_rewritten(spark):
    docs = spark.createDataFrame([(k, "x" * 99, k % 3) for k in range(90)] + [(k, "x" * 99, 3) for k in range(90, 120)], "doc_id long, text string, old_shard int")
    out, path = reshard(spark, docs.where("doc_id < 90 or doc_id >= 100"), 4)
    assert {r["shard"] for r in spark.read.parquet(path).select("shard").distinct().collect()} == {0, 1, 2, 3}
    out, path = reshard(spark, docs, 4)
    assert out.where("old_shard <> shard").count() == 0 and out.count() == 120
    assert not os.path.exists(path.removeprefix("file:"))


def test_query_columns(spark):
    out = resharding.query(spark, "/root/testdata/sf0.001").collect()
    assert {r["shard"] for r in out} == set(range(16)) and all(r["grown_shard"] is None for r in out)
    text = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert all((r["size"], r["text_crc32"]) == (len(text[r["doc_id"]]) + 1, zlib.crc32(text[r["doc_id"]])) for r in out)
    sizes = [sum(r["size"] for r in out if r["shard"] == k) for k in range(16)]
    assert max(sizes) - min(sizes) <= max(r["size"] for r in out)


def test_rows_without_or_with_repeated_ids_are_rewritten_once(spark):
    texts = [(None if k % 3 else k % 5, f"text {k} " * (k % 7)) for k in range(150)] + [(4, "same")] * 6 + [(None, None)] * 4
    docs = spark.createDataFrame([(i, t, int(k % 10 == 0)) for k, (i, t) in enumerate(texts)], "doc_id long, text string, old_shard int")
    path = f"{scratch_dir(spark)}/reshard-whole-{id(docs)}"
    out = resharding.reshard(docs, 3, path).collect()
    want = sorted(((i, len(t or "") + 1, zlib.crc32((t or "").encode())) for i, t in texts), key=repr)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in out), key=repr) == want
    back = spark.read.parquet(path)
    assert sorted(((r.doc_id, r.text) for r in back.collect()), key=repr) == sorted(texts, key=repr)
    for k in range(3):
        assert sorted(r.slot for r in out if r.shard == k) == list(range(sum(r.shard == k for r in out)))


def test_rows_alike_are_spread(spark):
    """Two thousand rows without an id and with one text, of different other columns, fill all shards evenly."""
    docs = spark.createDataFrame([(None, "the same text", 0, k) for k in range(2000)] + [(k, "x" * (k % 50), k % 3, k) for k in range(200)], "doc_id long, text string, old_shard int, rid int").repartition(5)
    path = f"{scratch_dir(spark)}/reshard-alike-{id(docs)}"
    out = resharding.reshard(docs, 16, path).collect()
    sizes = [sum(r["size"] for r in out if r.shard == k) for k in range(16)]
    assert len(out) == 2200 and max(sizes) - min(sizes) <= 50
    for k in range(16):
        assert sorted(r.slot for r in out if r.shard == k) == list(range(sum(r.shard == k for r in out)))
    back = spark.read.parquet(path)
    assert sorted(r.rid for r in back.where("text = 'the same text'").collect()) == list(range(2000))
