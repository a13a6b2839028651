"""Dead letters: messages that failed, with the count of their deliveries, tried again with back-off.

A letter is keyed by what names its reject. Each failed delivery adds to its attempts and doubles the wait;
after ``MOST`` attempts it rests until somebody mends it. A mended letter starts anew and is gone once it
has been stored. A batch that runs again after a crash does not count twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import messages, sinks, tables
from .scratch import discard, stash

LETTERS = "letter_key string, fields map<string, string>, attempts int, next_try timestamp, error_code string, state string, delivery string"
MOST, WAIT = 3, 600  # deliveries, and seconds before the second one


def read(spark: SparkSession, root: str) -> DataFrame:
    return tables.read(spark, root, "dead_letters", LETTERS)


def _names(fields: Column) -> Column:
    """What a reject of this message may be named by."""
    return F.array_distinct(F.array(F.sha2(fields["data"], 256), F.sha2(F.to_json(fields), 256)))


def of_rejects(sent: DataFrame, rejected: DataFrame) -> DataFrame:
    """(letter_key, fields, error_code) of the messages (fields) that the rejects come from; equal messages are one letter."""
    named = sent.select("fields", F.explode(_names(F.col("fields"))).alias("letter_key")).where("letter_key is not null")
    failed = rejected.groupBy(F.col("record_key").alias("letter_key")).agg(F.min("error_code").alias("error_code"))
    return named.join(failed, "letter_key").groupBy("letter_key", "error_code").agg(F.any_value("fields").alias("fields")).select("letter_key", "fields", "error_code")


def record(spark: SparkSession, root: str, failed: DataFrame, now, delivery: str) -> None:
    """Count one more failed delivery of each letter of ``failed``; ``delivery`` names the batch."""
    old, new = read(spark, root).alias("o"), failed.alias("n")
    both = old.join(new, F.col("o.letter_key") == F.col("n.letter_key"), "full_outer")
    again = F.col("n.letter_key").isNotNull() & ~F.coalesce(F.col("o.delivery") == delivery, F.lit(False))
    attempts = F.coalesce(F.col("o.attempts"), F.lit(0)) + again.cast("int")
    wait = F.make_dt_interval(secs=WAIT * F.pow(F.lit(2), attempts - 1))
    pick = lambda yes, no: F.when(again, yes).otherwise(no)
    tables.write(
        both.select(
            F.coalesce("o.letter_key", "n.letter_key").alias("letter_key"), pick(F.col("n.fields"), F.col("o.fields")).alias("fields"), attempts.alias("attempts"),
            pick(F.lit(now).cast("timestamp") + wait, F.col("o.next_try")).alias("next_try"), pick(F.col("n.error_code"), F.col("o.error_code")).alias("error_code"),
            pick(F.when(attempts >= MOST, "resting").otherwise("waiting"), F.col("o.state")).alias("state"), pick(F.lit(delivery), F.col("o.delivery")).alias("delivery"),
        ),
        root, "dead_letters",
    )


def mend(spark: SparkSession, root: str, fixes: DataFrame) -> None:
    """Put ``fixes`` (letter_key, fields) in place of the letters' messages; they are due at once."""
    all_, f = read(spark, root).alias("o"), fixes.alias("f")
    both = all_.join(f, F.col("o.letter_key") == F.col("f.letter_key"), "left")
    mended = F.col("f.letter_key").isNotNull()
    new = {"fields": F.col("f.fields"), "attempts": F.lit(0), "next_try": F.timestamp_seconds(F.lit(0)), "state": F.lit("waiting"), "delivery": F.lit(None).cast("string")}
    tables.write(both.select(*[F.when(mended, new[c]).otherwise(F.col(f"o.{c}")).alias(c) if c in new else F.col(f"o.{c}") for c in all_.columns]), root, "dead_letters")


def retry(spark: SparkSession, root: str, now, delivery: str) -> int:
    """Deliver the letters that are due; how many. Those that pass are gone, the others wait longer or rest."""
    due = stash(read(spark, root).where((F.col("state") == "waiting") & (F.col("next_try") <= F.lit(now).cast("timestamp"))).select("letter_key", "fields").repartition("letter_key"))
    n = due.count()  # few bytes, much work: dealt to all cores
    if n:
        raw, bad = messages.raw_messages(due.select("fields"))
        rejected = bad.unionByName(sinks.store(spark, raw, root))
        failed = of_rejects(due.select("fields"), rejected).withColumnRenamed("letter_key", "_key")
        told = due.select("letter_key", "fields", F.explode(_names(F.col("fields"))).alias("_key"))
        failed = told.join(failed.drop("fields"), "_key").groupBy("letter_key").agg(F.any_value("fields").alias("fields"), F.min("error_code").alias("error_code"))
        failed = stash(failed)
        gone = due.select("letter_key").join(failed, "letter_key", "left_anti")
        tables.write(read(spark, root).join(gone, "letter_key", "left_anti"), root, "dead_letters")
        record(spark, root, failed, now, delivery)
        discard(failed)
    discard(due)
    return n
