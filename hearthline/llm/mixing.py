"""Mixing sources to target weights, with DataFrame functions only.

A source's weight is its token share to the power alpha, normalised; alpha in [0, 1] is
bisected to the largest value whose entropy reaches a target, or the smallest whose most
repeated source stays within a limit. The weights are realised under a token budget: a
source's documents lie in ``blocks`` hash blocks; each epoch permutes the blocks and the
documents inside each; whole epochs come first and the last is cut where the budget ends. The
cut is found from block totals, so only the one block of a source in which it falls is ordered
by a window; every other row is decided by a join with the small table of blocks.

Read in the order of (epoch, block_rank, order_key) per source. Budgets are kept to within
the document at the cut, which is left out.

Defined results: a null source is the source ''; documents without words belong to whole
epochs and to blocks that lie before the cut; rows that repeat count as rows and share an
order key; ties of key are ordered by id and length; sources without words have weight 0; long
texts are counted whole; an empty table gives no rows; other columns are kept, and a column
named mix raises ValueError.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .support import documents, refuse_clashes, stash

STEPS = 60


def _key(*parts: Column | str) -> Column:
    """60 bits of MD5 of the parts joined by '/', as a long; plain SQL elsewhere gives the same."""
    joined = F.concat_ws("/", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("long")


def _weights(shares: Column, alpha: Column) -> Column:
    powers = F.transform(shares, lambda p: F.exp(alpha * F.ln(p)))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda s, y: s + y))


def source_weights(counts: DataFrame, budget_share: float = 1.0, entropy_share: float | None = None, max_repeats: float | None = None) -> DataFrame:
    """From (source, tokens): source, tokens, weight, budget (tokens), one row a source with words.

    ``entropy_share`` is a share of the entropy of equal weights; give it or ``max_repeats``."""
    if (entropy_share is None) == (max_repeats is None):
        raise ValueError("give entropy_share or max_repeats")
    one = counts.where("tokens > 0").agg(F.array_sort(F.collect_list(F.struct("source", "tokens"))).alias("all")).where("size(all) > 0")
    one = one.withColumn("total", F.aggregate("all", F.lit(0).cast("long"), lambda s, x: s + x["tokens"]))
    one = one.withColumn("shares", F.transform("all", lambda x: x["tokens"] / F.col("total")))
    low, high = (lambda a: F.struct(a["lo"].alias("lo"), a["mid"].alias("hi"))), (lambda a: F.struct(a["mid"].alias("lo"), a["hi"].alias("hi")))
    shares = F.col("shares")

    def fits(alpha: Column) -> Column:
        w = _weights(shares, alpha)
        if entropy_share is not None:
            return -F.aggregate(w, F.lit(0.0), lambda s, x: s + x * F.ln(x)) >= entropy_share * F.ln(F.size(shares))
        return F.array_max(F.zip_with(w, shares, lambda x, p: x * budget_share / p)) <= max_repeats

    def step(a: Column, _: Column) -> Column:
        mid = F.struct(a["lo"].alias("lo"), a["hi"].alias("hi"), ((a["lo"] + a["hi"]) / 2).alias("mid"))
        good, bad = (high, low) if entropy_share is not None else (low, high)
        return F.when(fits(mid["mid"]), good(mid)).otherwise(bad(mid))

    steps = F.sequence(F.lit(1), F.lit(STEPS))
    found = F.aggregate(steps, F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi")), step)
    alpha = F.when(fits(F.lit(1.0)), 1.0).otherwise(found["lo"]) if entropy_share is not None else F.when(fits(F.lit(0.0)), 0.0).otherwise(found["hi"])
    one = one.withColumn("alpha", alpha).withColumn("weights", _weights(shares, F.col("alpha")))
    rows = one.select("total", "alpha", F.explode(F.arrays_zip("all", "weights")).alias("x"))
    budget = F.floor(F.col("x.weights") * F.col("total") * budget_share + 0.5).cast("long")
    return rows.select(F.col("x.all.source").alias("source"), F.col("x.all.tokens").alias("tokens"), F.col("x.weights").alias("weight"), budget.alias("budget"))


def mix(docs: DataFrame, budget_share: float = 1.0, entropy_share: float | None = None, max_repeats: float | None = None, blocks: int = 256, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The chosen rows of ``docs``, once for each epoch that holds them, with struct column
    ``mix``: source, n_tokens, epoch, block_rank, order_key."""
    refuse_clashes(docs, ["mix"])
    words = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    source, ident = F.coalesce(F.col(source_col).cast("string"), F.lit("")), F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    tagged = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), words.alias("n"), source.alias("src"), ident.alias("ident")).withColumn("blk", F.pmod(_key(seed, F.col("ident")), F.lit(blocks)).cast("int"))
    totals = stash(tagged.groupBy("src", "blk").agg(F.sum("n").alias("tokens")))
    weights = stash(source_weights(totals.groupBy(F.col("src").alias("source")).agg(F.sum("tokens").alias("tokens")), budget_share, entropy_share, max_repeats))
    budgets = weights.select(F.col("source").alias("src"), F.floor(F.col("budget") / F.col("tokens")).cast("int").alias("whole"), (F.col("budget") % F.col("tokens")).alias("rest"))
    epochs = totals.join(budgets, "src").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole"))))
    order = Window.partitionBy("src", "epoch").orderBy(_key(seed, F.col("src"), F.col("epoch"), F.col("blk")), "blk")
    epochs = epochs.withColumn("block_rank", F.row_number().over(order)).withColumn("end", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    room = F.when(F.col("epoch") < F.col("whole"), F.col("tokens")).otherwise(F.col("rest") - F.col("end") + F.col("tokens"))
    plan = stash(epochs.withColumn("room", room).where("room > 0 or epoch < whole").withColumn("cut", F.col("room") < F.col("tokens")).select("src", "blk", "epoch", "block_rank", "room", "cut"))
    joined = tagged.join(plan, ["src", "blk"]).withColumn("key", _key(seed, F.col("epoch"), F.col("ident")))
    inside = Window.partitionBy("src", "blk", "epoch").orderBy("key", "ident", "n").rowsBetween(Window.unboundedPreceding, 0)
    cut = joined.where("cut").withColumn("end", F.sum("n").over(inside)).where("end <= room").drop("end")
    about = F.struct(F.col("src").alias("source"), F.col("n").alias("n_tokens"), "epoch", "block_rank", F.col("key").alias("order_key"))
    return joined.where("not cut").unionByName(cut).select("row.*", about.alias("mix"))


def query(spark, sf_dir: str) -> DataFrame:
    out = mix(documents(spark, sf_dir).select("doc_id", "text", "source"), entropy_share=0.95)
    return out.select("doc_id", "mix.*")


ORACLE = r"""
WITH RECURSIVE tagged AS (
  SELECT doc_id, coalesce(source, '') AS src, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n,
         (('0x' || substr(md5('mix/' || doc_id), 1, 15))::BIGINT % 256) AS blk
  FROM documents),
totals AS (SELECT src, blk, sum(n)::BIGINT AS tokens FROM tagged GROUP BY ALL),
counts AS (SELECT src, sum(tokens)::BIGINT AS tokens FROM totals GROUP BY src HAVING sum(tokens) > 0),
shares AS (SELECT src, tokens, tokens / (SELECT sum(tokens) FROM counts) AS p FROM counts),
bisect AS (
  SELECT 0 AS step, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
  UNION ALL
  SELECT step + 1, CASE WHEN ok THEN (lo + hi) / 2 ELSE lo END, CASE WHEN ok THEN hi ELSE (lo + hi) / 2 END
  FROM (SELECT *, (SELECT -sum(w * ln(w)) FROM (SELECT pow_p / sum(pow_p) OVER () AS w FROM (SELECT exp((lo + hi) / 2 * ln(p)) AS pow_p FROM shares))) >= 0.95 * ln((SELECT count(*) FROM shares)) AS ok FROM bisect WHERE step < 60)),
natural_ok AS (SELECT -sum(p * ln(p)) >= 0.95 * ln(count(*)) AS ok FROM shares),
alpha AS (SELECT CASE WHEN (SELECT ok FROM natural_ok) THEN 1.0 ELSE lo END AS a FROM bisect WHERE step = 60),
budgets AS (
  SELECT src, tokens, floor(x / sum(x) OVER () * sum(tokens) OVER () + 0.5)::BIGINT AS budget
  FROM (SELECT src, tokens, exp((SELECT a FROM alpha) * ln(p)) AS x FROM shares)),
epochs AS (
  SELECT t.src, t.blk, t.tokens, budget // b.tokens AS whole, budget % b.tokens AS rest, unnest(range(0, budget // b.tokens + 1)) AS epoch
  FROM totals t JOIN budgets b ON t.src = b.src),
ranked AS (
  SELECT *, row_number() OVER w AS block_rank, sum(tokens) OVER (w ROWS UNBOUNDED PRECEDING) AS upto
  FROM epochs WINDOW w AS (PARTITION BY src, epoch ORDER BY ('0x' || substr(md5('mix/' || src || '/' || epoch || '/' || blk), 1, 15))::BIGINT, blk)),
plan AS (
  SELECT *, CASE WHEN epoch < whole THEN tokens ELSE rest - upto + tokens END AS room FROM ranked),
joined AS (
  SELECT t.doc_id, t.src, t.n, p.epoch, p.block_rank, p.room, p.tokens, ('0x' || substr(md5('mix/' || p.epoch || '/' || t.doc_id), 1, 15))::BIGINT AS key, t.blk
  FROM tagged t JOIN plan p ON t.src = p.src AND t.blk = p.blk WHERE p.room > 0 OR p.epoch < p.whole)
SELECT doc_id, src AS source, n::BIGINT AS n_tokens, epoch::INT AS epoch, block_rank::INT AS block_rank, key AS order_key
FROM (SELECT *, sum(n) OVER (PARTITION BY src, blk, epoch ORDER BY key, doc_id::VARCHAR ROWS UNBOUNDED PRECEDING) AS upto FROM joined)
WHERE room >= tokens OR upto <= room
"""
