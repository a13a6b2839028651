"""MinHash near-dedup by an LSH forest.

A document's set holds the 64-bit hashes of its word shingles. Documents with one set are one
class, and only classes are compared. A class has a signature of 128 min-hashes. Each tree of the
forest sorts the signatures by the same values in another order (turned by eight values a tree);
a class's candidates are the neighbours with the longest common prefixes, down to ``MIN_DEPTH``
values. How deep a region is searched follows from how crowded it is: ``WINDOW`` neighbours on
either side reach down to the least depth where signatures are sparse and stop at longer common
prefixes where they are dense.

Spark range-partitions and sorts each tree; tasks scan their part in order, and what their edges
hold is compared across parts in a second, small pass. A candidate is passed on if sizes and
signatures allow the wanted similarity, and whole sets then confirm each link. The first two rounds
search half of the trees each and ask only for the likeliest candidates that connect what a task
sees, so that a crowd of near copies is joined by as many links as it has members. The last two
rounds search the trees again, for all candidates between what is still apart: what a first round
left out, because other candidates seemed to connect it, is lost nowhere. Components come from
alternating large and small stars.

Where more than ``WINDOW`` classes share the top ``MIN_DEPTH`` values of a tree, the neighbours are not
all of them. Such crowds that are still in several components are then compared whole: cut into
blocks, each with each in tasks of their own, which hold the whole sets and confirm on the spot.
Blocks of one component are not compared, so a crowd that the rounds joined costs next to nothing.

At a Jaccard index of 0.8 two classes share three values at the top of one of 16 trees with a
probability of 0.99999; signatures that estimate less than 0.65 are no candidates (0.00001 of the
pairs at 0.8). The recall against all pairs is measured by the tests.

Defined results: null and empty texts, and texts without words, have empty sets and link with
nothing; shorter texts are one shingle; long texts are whole; rows that repeat are one class and
each gets its row; null ids take part, name a component only if no id in it is not null, and of
such a component the first row read is kept; ties cannot occur, as links need no order; an empty
table gives no rows; other columns, whatever their names, take no part.
"""

from __future__ import annotations

import contextlib
import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bytewords as bw
from .simhash import components, one_of_each
from .support import discard, documents, fresh_name, give_back, stash, tidy

VALUES, TREES = 128, 16
ROUNDS = [(0, True), (1, True), (0, False), (1, False)]  # even or odd trees; whether candidates that connect suffice
TURN = VALUES // TREES
MIN_DEPTH, WINDOW = 3, 24
SURE = 0.9  # signatures alike in so many values: such pairs link, near enough to certain
PART_ROWS = 40_000  # rows of a tree's part
BLOCK_HASHES, ROW_HASHES = 1 << 19, 1 << 9  # of a crowd's block (4 MB), each row counted as so many at least
FEW = 2_000_000  # ids that a broadcast may hold: 16 MB
SETS_A_BATCH = 256

_random = np.random.default_rng(12)
_FLIPS = _random.integers(0, 2**63, VALUES, dtype=np.uint64)
_FACTORS = _random.integers(0, 2**63, VALUES, dtype=np.uint64) | np.uint64(1)


@contextlib.contextmanager
def _batches_of(spark, rows: int):
    """Jobs run inside hand Python so many rows at a time: rows with whole sets are large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _shingle_sets(buffer: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, end to end, and where each text's begin."""
    w = bw.find_words(buffer, offsets, lower=True)
    counts = w.counts
    n = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    which = np.repeat(np.arange(len(n)), n)
    at = w.first[:-1][which] + np.arange(int(n.sum())) - (np.cumsum(n) - n)[which]
    hashes = bw.span_hash(w.hashes(), at, np.minimum(at + shingle, w.first[1:][which]), "word")
    order = np.lexsort((hashes, which))
    hashes, which = hashes[order], which[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (which[1:] != which[:-1])
    return hashes[new], np.searchsorted(which[new], np.arange(len(n) + 1))


def _signatures(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """16-bit min-hashes of the sets that are not empty, one row each, big end first so that bytes sort."""
    out = np.zeros((len(first) - 1, VALUES), ">u2")
    some = np.flatnonzero(np.diff(first))
    if len(some):
        for k in range(VALUES):
            least = np.minimum.reduceat((hashes ^ _FLIPS[k]) * _FACTORS[k], first[:-1][some])
            out[some, k] = (bw.mix(least) >> np.uint64(48)).astype(">u2")
    return out


def _describe(shingle: int):
    def run(batches):
        rid, seen = TaskContext.get().partitionId() << 40, set()
        for batch in batches:
            ids = batch.column(0)
            for row, to, buffer, offsets in bw.chunks(batch, "text"):
                hashes, first = _shingle_sets(buffer, offsets, shingle)
                signatures = _signatures(hashes, first)
                sizes = np.diff(first)
                keys, sets, marks = [], [], []
                for k in range(to - row):
                    own = hashes[first[k] : first[k + 1]].tobytes()
                    key = hashlib.blake2b(own, digest_size=16).digest() if own else None
                    new = bool(own) and key not in seen
                    if new:
                        seen.add(key)
                    keys.append(key)
                    sets.append(own if new else None)
                    marks.append(signatures[k].tobytes() if new else None)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(row, to - row), pa.array(np.arange(rid, rid + to - row)), pa.array(sizes), pa.array(keys, pa.binary()), pa.array(marks, pa.binary()), pa.array(sets, pa.binary())],
                    ["id", "rid", "n", "key", "signature", "hashes"],
                )
                rid += to - row

    return tidy(run)


def _allowed(similarity: float) -> float:
    """The least share of equal values that a pair at ``similarity`` has, but for about one in 100,000."""
    return similarity - 4.25 * (similarity * (1 - similarity) / VALUES) ** 0.5


class _Scan:
    """Sorted rows of one tree after another; ``add`` returns candidates among new rows and the last ones before them."""

    def __init__(self, similarity: float, connect: bool):
        self.similarity, self.connect, self.allowed, self.held = similarity, connect, _allowed(similarity), None

    def add(self, rows: dict[str, np.ndarray], own_from: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """``own_from``: pairs whose later row is before that place are not wanted."""
        if self.held is not None:
            own_from += len(self.held["rid"])
            rows = {k: np.concatenate([self.held[k], v]) for k, v in rows.items()}
        n, sig = len(rows["rid"]), rows["sig"]
        label = np.arange(n)  # rows that candidates connect
        top = sig[:, :MIN_DEPTH]
        found, unsure = [], []
        for step in range(1, min(WINDOW, n - 1) + 1):
            later = np.arange(max(step, own_from), n)
            a, b = later - step, later
            ok = (rows["tree"][a] == rows["tree"][b]) & (rows["component"][a] != rows["component"][b]) & (top[a] == top[b]).all(1)
            low, high = np.minimum(rows["n"][a], rows["n"][b]), np.maximum(rows["n"][a], rows["n"][b])
            ok &= (low >= self.similarity * high - 1e-9) & (label[a] != label[b])
            a, b = a[ok], b[ok]
            alike = np.concatenate([(sig[a[k : k + 4096]] == sig[b[k : k + 4096]]).mean(1) for k in range(0, len(a), 4096)]) if len(a) else np.zeros(0)
            sure = (alike >= SURE) & self.connect
            if sure.any():
                took = self._join(label, a[sure], b[sure])
                found.append((a[sure][took], b[sure][took]))
            rest = (alike >= self.allowed) & ~sure
            if self.connect:
                unsure.append((a[rest], b[rest], alike[rest]))
            else:
                found.append((a[rest], b[rest]))
        if unsure:  # the likeliest first
            a, b, alike = (np.concatenate([u[k] for u in unsure]) for k in range(3))
            order = np.argsort(-alike, kind="stable")
            took = self._join(label, a[order], b[order])
            found.append((a[order][took], b[order][took]))
        a, b = (np.concatenate([p[k] for p in found] or [np.zeros(0, int)]) for k in (0, 1))
        self.held = {k: v[-WINDOW:] for k, v in rows.items()}
        return rows["rid"][a], rows["rid"][b]

    @staticmethod
    def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[int]:
        """Joins the rows' labels in place; which of the pairs it took."""
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := root.get(x, x)) != x:
                root[x] = x = root.get(up, up)
            return x

        took = []
        for k, (x, y) in enumerate(zip(label[a].tolist(), label[b].tolist())):
            x, y = find(x), find(y)
            if x != y:
                root[max(x, y)] = min(x, y)
                took.append(k)
        if root:
            names, where = np.unique(label, return_inverse=True)
            label[:] = np.array([find(x) for x in names.tolist()])[where]
        return took


def _columns(batch: pa.RecordBatch | pa.Table) -> dict[str, np.ndarray]:
    out = {k: batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in ("tree", "rid", "n", "component")}
    buffer, _ = bw.raw_texts(batch.column(batch.schema.get_field_index("signature")))
    return out | {"sig": buffer.view(np.uint16).reshape(len(out["rid"]), VALUES)}


_FOUND = ["a", "b", "edge", "late", "place", "tree", "rid", "n", "component", "signature"]
_FOUND_DDL = "a long, b long, edge int, late boolean, place int, tree int, rid long, n long, component long, signature binary"


def _found(**given: pa.Array) -> pa.RecordBatch:
    size = len(next(iter(given.values())))
    kinds = dict(a=pa.int64(), b=pa.int64(), edge=pa.int32(), late=pa.bool_(), place=pa.int32(), tree=pa.int32(), rid=pa.int64(), n=pa.int64(), component=pa.int64(), signature=pa.binary())
    return pa.RecordBatch.from_arrays([given[k].cast(kinds[k]) if k in given else pa.nulls(size, kinds[k]) for k in _FOUND], _FOUND)


def _edge(table: pa.Table, part: int, late: bool) -> pa.RecordBatch:
    table = table.combine_chunks()
    size = table.num_rows
    columns = {k: pa.concat_arrays(table.column(k).chunks) for k in ("tree", "rid", "n", "component", "signature")}
    return _found(edge=pa.array([part] * size), late=pa.array([late] * size), place=pa.array(np.arange(size)), **columns)


def _neighbours(similarity: float, connect: bool):
    """Candidates of a sorted part, and the rows at its edges: the first ones (``late``, edge = part) and the last (edge = part + 1)."""

    def run(batches):
        part, scan, head, tail = TaskContext.get().partitionId(), _Scan(similarity, connect), None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = scan.add(_columns(batch))
            yield _found(a=pa.array(np.minimum(a, b)), b=pa.array(np.maximum(a, b)))
            table = pa.Table.from_batches([batch])
            if head is None or head.num_rows < WINDOW:
                head = pa.concat_tables([*([] if head is None else [head]), table.slice(0, WINDOW - (0 if head is None else head.num_rows))])
            tail = pa.concat_tables([*([] if tail is None else [tail]), table])
            tail = tail.slice(max(0, tail.num_rows - WINDOW)).combine_chunks()
        if head is not None:
            yield _edge(head, part, True)
            yield _edge(tail, part + 1, False)

    return tidy(run)


def _across(similarity: float, connect: bool):
    """Candidates between the last rows of a part and the first of the next."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("late", "ascending"), ("place", "ascending")]).combine_chunks()
        early = table.num_rows - int(np.count_nonzero(table.column("late").to_numpy(zero_copy_only=False)))
        a, b = _Scan(similarity, connect).add(_columns(table), early) if 0 < early < table.num_rows else (np.zeros(0, np.int64),) * 2
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def candidates(classes: DataFrame, trees: range, similarity: float, connect: bool) -> DataFrame:
    """Pairs a < b of rids whose signatures are neighbours in one of the trees, of classes (rid, n, component,
    signature) in different components; with ``connect`` only the likeliest that connect what a task sees."""
    parts = max(1, -(-classes.count() * len(trees) // PART_ROWS))
    turned = F.transform(F.array(*map(F.lit, trees)), lambda t: F.struct(t.alias("tree"), F.concat(F.substring("signature", t * 2 * TURN + 1, F.lit(2 * VALUES)), F.substring("signature", F.lit(1), t * 2 * TURN)).alias("signature")))
    rows = classes.select("rid", "n", "component", F.explode(turned).alias("t")).select("rid", "n", "component", "t.*")
    order = ["tree", "signature", "rid"]
    found = stash(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("tree", "rid", "n", "component", "signature").mapInArrow(_neighbours(similarity, connect), _FOUND_DDL))
    across = found.where("edge is not null").groupBy("edge").applyInArrow(_across(similarity, connect), "a long, b long")
    pairs = stash(found.where("a is not null").select("a", "b").union(across).distinct())
    discard(found)
    return pairs


def _confirm(similarity: float):
    def run(batches):
        for batch in batches:
            sides = []
            for name in ("hashes_a", "hashes_b"):
                buffer, offsets = bw.raw_texts(batch.column(batch.schema.get_field_index(name)))
                sides.append((buffer, offsets))
            hit = []
            for k in range(batch.num_rows):
                x, y = (np.frombuffer(buffer[offsets[k] : offsets[k + 1]].tobytes(), np.uint64) for buffer, offsets in sides)
                both = len(np.intersect1d(x, y, assume_unique=True))
                hit.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))

    return tidy(run)


def _sets(shingle: int):
    """The key and the set of each text, once a task."""

    def run(batches):
        seen = set()
        for batch in batches:
            for _, _, buffer, offsets in bw.chunks(batch, "text"):
                hashes, first = _shingle_sets(buffer, offsets, shingle)
                sets = [hashes[x:y].tobytes() for x, y in zip(first.tolist(), first[1:].tolist())]
                new = {k: own for own in sets if own and (k := hashlib.blake2b(own, digest_size=16).digest()) not in seen}
                seen |= new.keys()
                yield pa.RecordBatch.from_arrays([pa.array(new.keys(), pa.binary()), pa.array(new.values(), pa.binary())], ["key", "hashes"])

    return tidy(run)


def _sets_of(rids: DataFrame, rows: DataFrame, slim: DataFrame, shingle: int) -> DataFrame:
    """(rid, hashes) of distinct ``rids``. rows: (rid, key, th), th being the XXH64 of the text in ``slim``; the sets
    are larger than the texts, so they are made again for the texts of candidates rather than kept for all."""
    needed = stash(rids.join(rows.select("rid", "key", "th"), "rid"))
    hashed = needed.select("th").distinct()
    hashed = F.broadcast(hashed) if needed.count() <= FEW else hashed  # else both sides are shuffled
    with _batches_of(rids.sparkSession, SETS_A_BATCH):
        texts = slim.withColumn("th", F.xxhash64("text")).join(hashed, "th", "left_semi").select("text")
        made = texts.mapInArrow(_sets(shingle), "key binary, hashes binary").groupBy("key").agg(F.first("hashes").alias("hashes"))
        sets = stash(made.join(needed.select("rid", "key"), "key").select("rid", "hashes"))
    discard(needed)
    return sets


def confirmed(pairs: DataFrame, rows: DataFrame, slim: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs whose whole sets are alike enough."""
    sets = _sets_of(pairs.select(F.explode(F.array("a", "b")).alias("rid")).distinct(), rows, slim, shingle)
    with _batches_of(pairs.sparkSession, SETS_A_BATCH):
        a, b = (sets.select(F.col("rid").alias(s), F.col("hashes").alias(f"hashes_{s}")) for s in "ab")
        out = stash(pairs.join(a, "a").join(b, "b").select("a", "b", "hashes_a", "hashes_b").mapInArrow(_confirm(similarity), "a long, b long"))
    discard(sets)
    return out


def _crowd(similarity: float):
    """Confirmed links between two blocks of a crowd, or inside one, as many as join what they connect."""
    allowed = _allowed(similarity)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        tree, i, j = key[0].as_py(), key[2].as_py(), key[3].as_py()
        table = table.combine_chunks()
        rid, n, component, block = (table.column(k).to_numpy() for k in ("rid", "n", "component", "block"))
        sig = bw.raw_texts(table.column("signature"))[0].view(np.uint16).reshape(len(rid), VALUES)
        buffer, offsets = bw.raw_texts(table.column("hashes"))
        sets = [buffer[x:y].view(np.uint64) for x, y in zip(offsets.tolist(), offsets[1:].tolist())]
        tops = [sig[:, (t * TURN + np.arange(MIN_DEPTH)) % VALUES] for t in range(tree)]
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        label, root = np.unique(component, return_inverse=True)[1].tolist(), {}

        def find(x: int) -> int:
            while (up := root.get(x, x)) != x:
                root[x] = x = root.get(up, up)
            return x

        pairs = []
        for x in left.tolist():
            y = right[right > x] if i == j else right
            y = y[component[y] != component[x]]
            y = y[np.minimum(n[y], n[x]) >= similarity * np.maximum(n[y], n[x]) - 1e-9]
            alike = (sig[y] == sig[x]).mean(1) if len(y) else np.zeros(0)
            y, alike = y[alike >= allowed], alike[alike >= allowed]
            for top in tops:  # what shares an earlier tree's top is compared there
                again = (top[y] == top[x]).all(1)
                y, alike = y[~again], alike[~again]
            pairs.append((np.full(len(y), x), y, alike))
        a, b, alike = (np.concatenate([p[k] for p in pairs] or [np.zeros(0, int)]) for k in range(3))
        order = np.argsort(-alike, kind="stable")
        took = []
        for x, y in zip(a[order].tolist(), b[order].tolist()):
            u, v = find(label[x]), find(label[y])
            if u != v:
                both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if both >= similarity * (len(sets[x]) + len(sets[y]) - both) - 1e-9:
                    root[max(u, v)] = min(u, v)
                    took.append((x, y))
        ends = rid[np.array(took, int).reshape(-1, 2)]
        give_back()
        return pa.table({"a": ends.min(1), "b": ends.max(1)})

    return run


def crowded(classes: DataFrame, rows: DataFrame, slim: DataFrame, shingle: int, similarity: float) -> DataFrame | None:
    """Confirmed links, as many as connect, in the crowds that classes (rid, n, component, signature) of several
    components make: more than ``WINDOW`` neighbours with one top of a tree. None if there are no such crowds."""
    tops = F.transform(F.array(*map(F.lit, range(TREES))), lambda t: F.struct(t.alias("tree"), F.substring("signature", t * 2 * TURN + 1, F.lit(2 * MIN_DEPTH)).alias("top")))
    tops = classes.select("rid", "n", "component", F.explode(tops).alias("t")).select("t.*", "rid", "n", "component")
    where = ["tree", "top"]
    crowds = tops.groupBy(*where).agg(F.count("*").alias("many"), F.min("component").alias("low"), F.max("component").alias("high"))
    crowds = stash(crowds.where((F.col("many") > WINDOW + 1) & (F.col("low") < F.col("high"))).select(*where))
    if crowds.isEmpty():
        discard(crowds)
        return None
    filled = F.sum(F.greatest("n", F.lit(ROW_HASHES))).over(Window.partitionBy(*where).orderBy("component", "rid"))
    members = stash(tops.join(crowds, where).withColumn("block", F.floor((filled - 1) / BLOCK_HASHES)))
    blocks = stash(members.groupBy(*where, "block").agg(F.min("component").alias("low"), F.max("component").alias("high")))
    i, j = (blocks.select(*where, F.col("block").alias(s), F.col("low").alias(f"low_{s}"), F.col("high").alias(f"high_{s}")) for s in "ij")
    meet = i.join(j, where).where((F.col("i") <= F.col("j")) & (F.least("low_i", "low_j") < F.greatest("high_i", "high_j")))
    meet = stash(meet.select(*where, "i", "j"))
    sides = meet.select(*where, "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    asked = stash(members.join(sides.hint("merge"), [*where, "block"]).drop("n", "component"))
    sets = _sets_of(asked.select("rid").distinct(), rows, slim, shingle)
    with _batches_of(classes.sparkSession, SETS_A_BATCH):
        whole = asked.hint("merge").join(classes, "rid").join(sets, "rid")  # asked is sized as compressed
        found = stash(whole.groupBy(*where, "i", "j").applyInArrow(_crowd(similarity), "a long, b long"))
    discard(crowds, members, blocks, meet, asked, sets)
    return found


def near_duplicates(docs: DataFrame, shingle: int = 4, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (the smallest id reachable by links) and kept."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = slim.schema["id"].dataType.simpleString()
    made = slim.select(F.struct("id", F.xxhash64("text").alias("th")).alias("id"), "text")
    made = made.mapInArrow(_describe(shingle), f"id struct<id: {kind}, th: bigint>, rid long, n long, key binary, signature binary, hashes binary")
    rows = stash(made.select("id.id", "id.th", "rid", "n", "key", "signature"))
    keys = rows.where("key is not null").groupBy("key").agg(F.min("rid").alias("rid"), F.min("id").alias("least"))
    keys = stash(keys)  # the first row of a class in the table is the first in its task, which holds the signature
    classes = stash(rows.select("rid", "n", "signature").join(keys.select("rid"), "rid"))
    links, roots = [], None

    def parted() -> DataFrame:
        if roots is None:
            return classes.withColumn("component", F.col("rid"))
        return classes.join(roots.withColumnRenamed("node", "rid"), "rid", "left").select("rid", "n", "signature", F.coalesce("root", "rid").alias("component"))

    for first, connect in ROUNDS:
        pairs = candidates(parted(), range(first, TREES, 2), similarity, connect)
        links.append(confirmed(pairs, rows, slim, shingle, similarity))
        discard(pairs, *([] if roots is None else [roots]))
        roots = stash(components(functools.reduce(DataFrame.union, links)))
    more = crowded(parted(), rows, slim, shingle, similarity)
    if more is not None:
        links.append(more)
        discard(roots)
        roots = stash(components(functools.reduce(DataFrame.union, links)))
    whole, rows = rows, stash(rows.select("id", "rid", "n", "key"))  # what follows needs no signatures
    discard(whole, classes, *links)
    own = keys.join(roots.withColumnRenamed("node", "rid"), "rid", "left").select("key", "rid", "least", F.coalesce("root", "rid").alias("root"))
    named = own.groupBy("root").agg(F.min("least").alias("component_id"), F.min("rid").alias("first"))
    named = own.join(named, "root").select("key", "component_id", "first")
    linked = rows.where("key is not null").select("id", "rid", "n", "key").join(named, "key").select("id", "n", "component_id", F.when(F.col("component_id").isNull(), F.col("rid") == F.col("first")).otherwise(F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))).alias("kept"))
    alone = rows.where("key is null").select("id", "n", F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    out = linked.union(alone)
    return out.select(F.col("id").alias(fresh_name(out.drop("id"), id_col)), F.col("n").alias("n_shingles"), "component_id", "kept")


def keep_one_of_each_group(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near copies, columns as given. In a component the text with the smallest id (rows
    without an id last) stays, and those that are less similar to it than ``similarity``, as they are only linked in
    a chain; of equal texts one row stays. Texts without words are no group but for their copies."""
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    linked = near_duplicates(slim, shingle, similarity, "th").groupBy("th").agg(F.min("component_id").alias("root"))
    texts = slim.groupBy("th").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("least"), F.count("*").alias("copies"))
    groups = stash(texts.join(linked, "th").select("th", "least", "copies", "root"))
    kept = one_of_each(docs, groups, shingle, similarity, id_col, text_col)
    discard(groups)
    return kept


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
