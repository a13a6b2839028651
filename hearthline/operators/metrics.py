"""Counters of jobs as aggregates, and message retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, TimestampNTZType, TimestampType

from ..streaming.scratch import discard, stash

COUNTERS = "stage string, outcome string, n long"


class Counters:
    """Counters of a job by stage and outcome. Frames are observed while they are written for other ends, so that counting reads nothing twice."""

    def __init__(self):
        self._seen: list[tuple[str, Observation]] = []
        self._added: dict[tuple[str, str], int] = {}

    def observe(self, df: DataFrame, stage: str, codes: list[str], code: str = "error_code") -> DataFrame:
        """``df``, counted when it is next written: all rows, those without a code, and those of each code."""
        watch = Observation()
        self._seen.append((stage, watch))
        other = F.col(code).isNotNull() & ~F.col(code).isin(codes)
        return df.observe(watch, F.count("*").alias("received"), F.count_if(F.col(code).isNull()).alias("passed"), *[F.count_if(F.col(code) == c).alias(c) for c in codes], F.count_if(other).alias("other"))

    def add(self, stage: str, outcome: str, n: int) -> None:
        self._added[stage, outcome] = self._added.get((stage, outcome), 0) + n

    def rows(self) -> list[tuple[str, str, int]]:
        """Counters that are not zero, once the observed frames have been written."""
        out = dict(self._added)
        for stage, watch in self._seen:
            for outcome, n in watch.get.items():
                out[stage, outcome] = out.get((stage, outcome), 0) + n
        return [(*k, n) for k, n in sorted(out.items()) if n]

    def write(self, spark: SparkSession, path: str) -> None:
        """One small table a batch; a batch that runs again writes over its own."""
        spark.createDataFrame(self.rows(), COUNTERS).coalesce(1).write.mode("overwrite").parquet(path)


def progress(query) -> DataFrame | None:
    """(batch_id, input_rows, seconds) of the recent batches of a streaming query, as far as it keeps them."""
    rows = [(p["batchId"], p["numInputRows"], p["durationMs"].get("triggerExecution", 0) / 1000) for p in query.recentProgress]
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(rows, "batch_id long, input_rows long, seconds double") if spark else None


def outcome_counts(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("n"))


def ingestion_counts(received: DataFrame, parsed: DataFrame, rejected: DataFrame) -> DataFrame:
    """(outcome, from_rescan, n): received and processed messages, and failed ones by stage."""
    rescan = F.col("property_id").isNotNull()
    parts = [
        received.select(F.lit("received").alias("outcome"), rescan.alias("from_rescan")),
        parsed.join(received.select("record_key", rescan.alias("from_rescan")), "record_key").select(F.lit("processed").alias("outcome"), "from_rescan"),
        rejected.join(received.select("record_key", rescan.alias("from_rescan")), "record_key", "left").select(F.concat(F.lit("failed: "), "stage").alias("outcome"), F.coalesce("from_rescan", F.lit(False)).alias("from_rescan")),
    ]
    return outcome_counts(parts[0].unionByName(parts[1]).unionByName(parts[2]), "outcome", "from_rescan")


def newest_n(messages: DataFrame, n: int, time: str = "ts", ident: str = "event_id", by: list[str] | None = None) -> DataFrame:
    """The newest ``n`` messages (of each stream in ``by``). Over the whole table nothing is sorted as a whole:
    ``retention_cut`` finds the oldest message that stays. Null times are the oldest, null ids the oldest of a time;
    rows alike in time and id with the cut all stay."""
    if by:
        w = Window.partitionBy(*by).orderBy(F.desc(time), F.desc(ident))
        return messages.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")
    if n <= 0:
        return messages.limit(0)
    if (found := retention_cut(messages, n, time, ident)) is None:
        return messages
    low, cut = found
    newer = messages if low is None else messages.where(low)
    return newer.join(F.broadcast(cut), F.struct(time, ident) >= F.col("_cut")).drop("_cut")


BINS, SORTED = 1 << 16, 100_000


def retention_cut(messages: DataFrame, n: int, time: str = "ts", ident: str = "event_id") -> tuple[Column | None, DataFrame] | None:
    """Where the newest ``n`` of ``messages`` end: a test on ``time`` that reaches the scan (None if all times must be
    read) and one row ``_cut`` (time, id). None if all messages stay.

    Messages are counted by bins of time, at most 65,537 of them, and a suffix sum finds the bin at the cut; that bin is
    cut into finer ones until it holds 100,000 messages or one instant. Only it is sorted, by ranges where it is large.
    """
    at, bound, exact = _instants(messages.schema[time].dataType, F.col(time))
    keys = messages.select(time, ident)
    total, dated, lo, hi = keys.agg(F.count("*"), F.count(time), F.min(at), F.max(at)).first()
    if n >= total:
        return None
    low = None
    if n > dated:
        group, rest, rows = keys.where(F.col(time).isNull()), n - dated, total - dated
    else:
        rest, rows = n, dated
        inside = lambda: keys.where((F.col(time) >= bound(lo)) & ((F.col(time) <= bound(hi)) if exact else (at <= hi)))
        while rows > SORTED and hi > lo:
            width = max(0, (hi - lo).bit_length() - BINS.bit_length() + 1)  # in bits
            counts = inside().groupBy(F.shiftright(at, width).alias("bin")).agg(F.count("*").alias("n"))
            upto = F.sum("n").over(Window.orderBy(F.desc("bin")))
            bin_, rows, sum_ = counts.withColumn("upto", upto).where(F.col("upto") >= rest).orderBy("upto").first()
            rest -= sum_ - rows
            lo, hi = max(lo, bin_ << width), min(hi, ((bin_ + 1) << width) - 1)
        group, low = inside(), F.col(time) >= bound(lo)
    oldest = F.min(F.struct(time, ident)).alias("_cut")
    if rest == rows:
        return low, group.agg(oldest)
    if rows <= SORTED:
        return low, group.orderBy(F.desc(time), F.desc(ident)).limit(rest).agg(oldest)
    # One instant with many messages: distinct ids are dealt by ranges, and only the range at the cut is sorted.
    ids = group.groupBy(time, ident).agg(F.count("*").alias("_c")).repartitionByRange(F.desc(time), F.desc(ident))
    dealt = stash(ids.withColumn("_range", F.spark_partition_id()))
    sums = dealt.groupBy("_range").agg(F.sum("_c").alias("n")).withColumn("upto", F.sum("n").over(Window.orderBy("_range")))
    range_, n_range, sum_ = sums.where(F.col("upto") >= rest).orderBy("_range").first()
    upto = F.sum("_c").over(Window.partitionBy("_range").orderBy(F.desc(time), F.desc(ident)))
    last = dealt.where(F.col("_range") == range_).withColumn("upto", upto).where(F.col("upto") >= rest - (sum_ - n_range))
    cut = stash(last.agg(F.max(F.struct(time, ident)).alias("_cut")))  # the newest that reaches the sum
    discard(dealt)
    return low, cut


def _instants(kind, time: Column):
    """A time column as whole numbers in its order, the way back for a literal, and whether that is exact."""
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(time.cast("timestamp")), lambda v: F.timestamp_micros(F.lit(v)).cast(kind), True
    whole = isinstance(kind, IntegralType)
    return (time if whole else F.floor(time)).cast("long"), lambda v: F.lit(v), whole


def files_below(messages: DataFrame, n: int, time: str = "ts", ident: str = "event_id") -> DataFrame:
    """(path, n_rows) of the files of ``messages`` (as read) whose messages are all older than the newest ``n``."""
    found = retention_cut(messages, n, time, ident) if n > 0 else None
    spans = messages.select(F.col("_metadata.file_path").alias("path"), F.struct(time, ident).alias("_key")).groupBy("path").agg(F.max("_key").alias("_newest"), F.count("*").alias("n_rows"))
    if n > 0:
        spans = spans.limit(0) if found is None else spans.join(F.broadcast(found[1]), F.col("_newest") < F.col("_cut"))
    return spans.select("path", "n_rows")


def drop_old_files(messages: DataFrame, n: int, time: str = "ts", ident: str = "event_id") -> int:
    """Trim a stream's files to about its newest ``n`` messages: whole files below the cut are deleted, none is written
    anew, as a stream would read it again. How many messages went; what stays holds the newest ``n``."""
    spark, gone = messages.sparkSession, 0
    for path, rows in files_below(messages, n, time, ident).toLocalIterator():
        file = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(path))
        gone += rows if file.getFileSystem(spark._jsc.hadoopConfiguration()).delete(file, False) else 0
    return gone
