"""Minimum-cost-flow resharding.

Old shards hold a number of bytes each; new shards have capacities. The cheapest flow from
old to new, where only moved bytes cost, is solved over the shards (a few hundred at most, so
on the driver); Spark then realises it. An old shard's documents have an order, large ones
first (size class, cell, tag: a hash of id and text), which the flow cuts into stretches, what
stays first; a document goes where its middle lies. So cuts fall among small documents, and new
shards come out equal but for about one small document a cut. Cuts are found from the bytes of
(old shard, class, cell) blocks and then, in the block of each cut alone, from its rows' tags.
The cuts are a row for each pair of shards; every document is placed by comparing with them.

Shards whose content changes are then written anew: texts are shuffled once, to buckets of their
new shard, which number their rows. The result is read from the written files.

Defined results: null texts have no bytes (size 1); rows that repeat or have no id each take a
slot, and rows alike in id and text are placed each on its own; a null old shard counts as the first;
long texts are documents like others; of equal tags the order is of no account; an empty table
gives no rows; other columns, whatever their names, are rewritten as they are.
"""

from __future__ import annotations

import uuid
from collections import deque

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .support import discard, documents, fresh_name, scratch_dir, shuffles_let_go, stash, text_or_empty


def cheapest_flow(supply: list[int], capacity: list[int], cost) -> dict[tuple[int, int], int]:
    """Successive shortest paths on supply -> shard -> shard -> capacity; {(old, new): bytes}."""
    if sum(supply) > sum(capacity):
        raise ValueError("the new shards are too small")
    m, n = len(supply), len(capacity)
    source, sink = m + n, m + n + 1
    graph: list[list[int]] = [[] for _ in range(m + n + 2)]
    to, room, price = [], [], []

    def edge(a: int, b: int, r: int, c: int) -> None:
        for x, y, rr, cc in ((a, b, r, c), (b, a, 0, -c)):
            graph[x].append(len(to))
            to.append(y)
            room.append(rr)
            price.append(cc)

    for i, s in enumerate(supply):
        edge(source, i, s, 0)
    for j, c in enumerate(capacity):
        edge(m + j, sink, c, 0)
    between = {}
    for i in range(m):
        for j in range(n):
            between[i, j] = len(to)
            edge(i, m + j, min(supply[i], capacity[j]), cost(i, j))
    while True:
        best, by, queue, queued = {source: 0}, {}, deque([source]), {source}
        while queue:
            x = queue.popleft()
            queued.discard(x)
            for e in graph[x]:
                if room[e] and best[x] + price[e] < best.get(to[e], float("inf")):
                    best[to[e]], by[to[e]] = best[x] + price[e], e
                    if to[e] not in queued:
                        queue.append(to[e])
                        queued.add(to[e])
        if sink not in best:
            return {k: room[e ^ 1] for k, e in between.items() if room[e ^ 1]}
        path, x = [], sink
        while x != source:
            path.append(by[x])
            x = to[by[x] ^ 1]
        push = min(room[e] for e in path)
        for e in path:
            room[e] -= push
            room[e ^ 1] += push


def even_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


FIRST_TAG, BUCKET_BYTES, BUCKETS = -(1 << 63), 128 << 20, 4096


def _stretches(flow: dict[tuple[int, int], int]) -> list[tuple[int, int, int]]:
    """(old shard, new shard, bytes before): an old shard's bytes in turn, what stays first."""
    out, at = [], {}
    for i, j in sorted(flow, key=lambda k: (k[0], k[0] != k[1], k[1])):
        out.append((i, j, at.get(i, 0)))
        at[i] = at.get(i, 0) + flow[i, j]
    return out


def _facts(id_col: str, text_col: str) -> list:
    text = text_or_empty(text_col)
    return [(F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(F.col(id_col), text).alias("tag")]


def _place(cells: int):
    """Where a document stands in its old shard: large ones first, then by cell and tag."""
    return F.struct((-F.floor(F.log2("size") * 4)).cast("int").alias("class"), F.pmod("tag", F.lit(cells)).cast("int").alias("cell"), F.col("tag").alias("tag"))


def _part_twins(rows: DataFrame, twins: DataFrame) -> DataFrame:
    """``rows`` (old_shard, tag, rid and others; stored, so that ``rid`` stays) where those alike in old shard
    and tag, which ``twins`` names, have a tag of their own, from their number among them. The numbers of a set
    of twins are always 0 to its size less one, so two tables of the same documents get the same tags. They are
    counted by the partition that ``rid`` names: no task holds all twins of a set."""
    keys = ["old_shard", "tag"]
    mine = rows.join(twins, keys, "left_semi").withColumn("part", F.shiftright("rid", 33))
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition of the input
    starts = mine.groupBy(*keys, "part").count().withColumn("start", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    number = F.col("start") + F.row_number().over(Window.partitionBy(*keys, "part").orderBy("rid"))
    parted = mine.join(starts, [*keys, "part"]).withColumn("tag", F.xxhash64("tag", number))
    return rows.join(twins, keys, "left_anti").unionByName(parted.select(*rows.columns))


def find_cuts(rows: DataFrame, shards: int, capacities: list[int] | None = None, cells: int = 64) -> tuple[DataFrame, list[int]]:
    """For ``rows`` (old_shard, size, tag): a row (old_shard, shard, lo, hi) for each stretch, its ends as
    places, ``hi`` exclusive and null at the end; and the shards whose content changes."""
    spark, keys = rows.sparkSession, ["old_shard", "class", "cell"]
    placed = rows.select("old_shard", "size", _place(cells).alias("p")).select("old_shard", "size", "p.*")
    blocks = stash(placed.groupBy(*keys).agg(F.sum("size").alias("bytes")))
    old = {r["old_shard"]: r["n"] for r in blocks.groupBy("old_shard").agg(F.sum("bytes").alias("n")).collect()}  # a row a shard
    supply = [old.get(i, 0) for i in range(max([*old, -1]) + 1)]
    flow = cheapest_flow(supply, capacities or even_capacities(sum(supply), shards), lambda i, j: int(i != j))
    starts = spark.createDataFrame(_stretches(flow), "old_shard int, shard int, start long")
    row_of_blocks = Window.partitionBy("old_shard").orderBy("class", "cell").rowsBetween(Window.unboundedPreceding, 0)
    edges = blocks.withColumn("end", F.sum("bytes").over(row_of_blocks)).join(F.broadcast(starts), "old_shard")
    edges = stash(edges.where("start < end and start >= end - bytes").select(*keys, "shard", (F.col("start") - F.col("end") + F.col("bytes")).alias("need")))
    inside = Window.partitionBy(*keys, "shard").orderBy("tag").rowsBetween(Window.unboundedPreceding, 0)
    cut = placed.join(F.broadcast(edges.where("need > 0")), keys).withColumn("upto", F.sum("size").over(inside))  # the blocks of a cut, one a pair of shards
    tags = cut.where("upto - size + floor(size / 2) >= need").groupBy(*keys, "shard").agg(F.min("tag").alias("first"))
    tag = F.when(F.col("need") == 0, F.lit(FIRST_TAG)).otherwise(F.coalesce("first", F.lit((1 << 63) - 1)))
    los = edges.join(tags, [*keys, "shard"], "left").select("old_shard", "shard", F.struct("class", "cell", tag.alias("tag")).alias("lo"))
    order = {(i, j): k for k, (i, j, _) in enumerate(_stretches(flow))}
    rank = spark.createDataFrame([(*k, v) for k, v in order.items()], "old_shard int, shard int, k int")
    los = los.join(F.broadcast(rank), ["old_shard", "shard"])
    cuts = stash(los.withColumn("hi", F.lead("lo").over(Window.partitionBy("old_shard").orderBy("k"))).drop("k"))
    discard(blocks, edges)
    return cuts, sorted({x for i, j in flow if i != j for x in (i, j)})


def place_rows(rows: DataFrame, cuts: DataFrame, cells: int = 64) -> DataFrame:
    """``rows`` (old_shard, size, tag and others) with ``shard``. The cuts have a row for each pair of shards."""
    ends = cuts.select(F.col("old_shard").alias("from_shard"), "shard", "lo", "hi")
    place = _place(cells)
    here = (F.col("old_shard") == F.col("from_shard")) & (place >= F.col("lo")) & (F.col("hi").isNull() | (place < F.col("hi")))
    return rows.join(F.broadcast(ends), here).drop("from_shard", "lo", "hi")


def reshard(docs: DataFrame, shards: int, path: str, old_col: str = "old_shard", id_col: str = "doc_id", text_col: str = "text", cells: int = 64) -> DataFrame:
    """Rewrite below ``path`` the shards of ``docs`` that change, with all their columns; returns (id, size,
    text_crc32, shard, slot, old_shard), one row per row of ``docs``, read from the written files, and
    from the old shards where these stay as they are."""
    facts = _facts(id_col, text_col)
    old_shard = F.coalesce(F.col(old_col), F.lit(0)).cast("int").alias("old_shard")
    rid = F.monotonically_increasing_id().alias("rid")
    narrow = stash(docs.select(F.col(id_col).alias("id"), old_shard, *facts, rid))
    twins = stash(narrow.groupBy("old_shard", "tag").count().where("count > 1").drop("count"))
    with_twins = not twins.isEmpty()
    if with_twins:
        narrow = stash(_part_twins(narrow, twins))
    cuts, touched = find_cuts(narrow, shards, cells=cells)
    total = narrow.agg(F.sum("size")).first()[0] or 0
    buckets = min(BUCKETS, max(1, -(-total // (shards * BUCKET_BYTES))))
    bucket = F.pmod(F.xxhash64("tag"), F.lit(buckets)).cast("int").alias("bucket")
    placed = place_rows(narrow, cuts, cells)
    counts = placed.groupBy("shard", bucket).count()
    order = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # of at most BUCKETS rows
    firsts = stash(counts.select("shard", "bucket", F.coalesce(F.sum("count").over(order), F.lit(0)).alias("first")))
    number = Window.partitionBy("shard", "bucket").orderBy("tag")
    slot = (F.col("first") + F.row_number().over(number) - 1).cast("long")
    numbered = lambda df: df.withColumn("bucket", bucket).join(F.broadcast(firsts), ["shard", "bucket"]).withColumn("slot", slot)
    columns = ["id", "size", "text_crc32", "shard", "slot", "old_shard"]
    same = numbered(placed.where(~F.col("shard").isin(touched))).select(*columns)
    if not touched:
        return same.withColumnRenamed("id", id_col)
    names = {c: fresh_name(docs, c) for c in ("shard", "slot", "from_shard")}
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), old_shard, *facts).drop("text_crc32")
    if with_twins:  # only these are stored, as their numbers must not change between two readings
        among = stash(whole.join(twins, ["old_shard", "tag"], "left_semi").select("*", rid))
        whole = whole.join(twins, ["old_shard", "tag"], "left_anti").unionByName(_part_twins(among, twins).drop("rid"))
    moving = numbered(place_rows(whole, cuts, cells).where(F.col("shard").isin(touched)))
    moving = moving.select("row.*", *[F.col(k).alias(v) for k, v in (("old_shard", names["from_shard"]), ("slot", names["slot"]), ("shard", names["shard"]))])
    with shuffles_let_go(docs.sparkSession):
        moving.write.option("compression", "zstd").partitionBy(names["shard"]).parquet(path)
    written = docs.sparkSession.read.schema(moving.schema).parquet(path)
    back = written.select(F.col(id_col).alias("id"), *facts[:2], F.col(names["shard"]).alias("shard"), F.col(names["slot"]).alias("slot"), F.col(names["from_shard"]).alias("old_shard"))
    return same.union(back.select(*columns)).withColumnRenamed("id", id_col)


def query(spark, sf_dir: str) -> DataFrame:
    """Documents lie in 16 old shards by a hash of their source, most of them in the hot one's."""
    docs = documents(spark, sf_dir).withColumn("old_shard", F.pmod(F.xxhash64("source"), F.lit(16)).cast("int"))
    out = reshard(docs, 16, f"{scratch_dir(spark)}/shards-{uuid.uuid4().hex}")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard")
