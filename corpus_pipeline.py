"""The training-data pipeline over ``documents``: rules and perplexity, line dedup, near-duplicate
removal, mixing, packing. Each stage works on what the one before it left.

Stages but the last return the columns of ``documents``; line dedup rewrites text and n_chars and
lets go of documents of which no line stays; mixing may return a document more than once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.llm import line_dedup, lsh_forest, mixing, packing, quality, simhash
from hearthline.llm.support import documents, stash
from hearthline.llm.tokens import default_tokenizer


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = {c: f"doc_{k}" for k, c in enumerate(docs.columns)}  # no column of the caller's can clash
    judged = quality.assess(docs.withColumnsRenamed(own), own["lang"], own["text"], min_words=1)
    return judged.where("kept").select(*[F.col(v).alias(c) for c, v in own.items()])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = {c: f"doc_{k}" for k, c in enumerate(docs.columns)}
    cut = line_dedup.dedup_lines(docs.withColumnsRenamed(own), id_col=own["doc_id"], text_col=own["text"])
    cut = cut.where("n_removed = 0 or kept_text rlike '[^\\\\x20\\\\x09-\\\\x0D]'")
    changed = F.col("n_removed") > 0  # texts without a removed line stay as they are, null ones too
    new = {"text": F.when(changed, F.col("kept_text")).otherwise(F.col(own["text"])), "n_chars": F.when(changed, F.char_length("kept_text").cast("long")).otherwise(F.col(own["n_chars"]))}
    return cut.select(*[new.get(c, F.col(v)).alias(c) for c, v in own.items()])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fingerprints first, which take copies and the nearest of near copies out of the way; texts of a similarity of
    0.8 or more differ in more bits than their chains of segments can find, so a MinHash forest finds the others."""
    return lsh_forest.keep_one_of_each_group(stash(simhash.keep_one_of_each_group(docs)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = {c: f"doc_{k}" for k, c in enumerate(docs.columns)}
    mixed = mixing.mix(docs.withColumnsRenamed(own), entropy_share=0.95, id_col=own["doc_id"], text_col=own["text"], source_col=own["source"])
    return mixed.select(*[F.col(v).alias(c) for c, v in own.items()])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, default_tokenizer())


STAGES = [
    ("quality rules", keep_good),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing to target weights", mix_sources),
    ("packing", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
