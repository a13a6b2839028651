"""Scratch tables, row packing and small helpers shared by the operators."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import pickle
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TRIM_THRESHOLD, _TOP_PAD, _MMAP_THRESHOLD = -1, -2, -3  # names of glibc's mallopt
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names, with its scheme; a temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = f"file://{tempfile.mkdtemp(prefix='hearthline-')}"
        spark.sparkContext.setCheckpointDir(named)
    if "://" not in named:  # without a scheme, or the short form that Hadoop writes for file:///
        path = spark._jvm.org.apache.hadoop.fs.Path(named)
        uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri()
        named = f"{uri.getScheme()}://{uri.getAuthority() or ''}{uri.getPath()}"
    return named.rstrip("/")


@contextlib.contextmanager
def shuffles_let_go(spark: SparkSession):
    """Queries run inside give their shuffle files back as they end."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def stash(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to a table in the shared scratch folder and read it back.

    Cuts the lineage with data that survives a lost executor, and keeps costly stages from
    running twice; the shuffle files of what led here go at once."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/table-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    with shuffles_let_go(spark):
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stash`` made, once nothing to come reads them."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def give_back() -> None:
    """Return freed memory to the system: Python workers live on between stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def hold_buffers() -> None:
    """Let this worker's freed buffers of up to 4 MB serve the next arrays, 32 MB of them at most until ``give_back``: as
    it is, the C library hands them to the system at once, and loops over small arrays page them in again and again."""
    try:
        mallopt = ctypes.CDLL("libc.so.6").mallopt
        for name, size in ((_MMAP_THRESHOLD, 4 << 20), (_TRIM_THRESHOLD, 32 << 20), (_TOP_PAD, 8 << 20)):
            mallopt(name, size)
    except (OSError, AttributeError):  # not glibc
        pass


def tidy(batches_to_batches):
    """A function for mapInArrow that gives memory back at the end of each task."""

    @functools.wraps(batches_to_batches)
    def run(batches):
        yield from batches_to_batches(batches)
        give_back()

    return run


def _planes(a: np.ndarray) -> bytes:
    rows, out = a.view(np.uint8).reshape(len(a), a.dtype.itemsize), np.empty((a.dtype.itemsize, len(a)), np.uint8)
    for k in range(len(out)):  # by plane: numpy copies transposed bytes one by one
        out[k] = rows[:, k]
    return out.tobytes()


def _from_planes(kind: str, n: int, raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(-1, n) if n else np.zeros((np.dtype(kind).itemsize, 0), np.uint8)
    rows = np.empty((n, len(planes)), np.uint8)
    for k, plane in enumerate(planes):
        rows[:, k] = plane
    return rows.reshape(-1).view(kind)


def pack(*arrays: np.ndarray) -> bytes:
    """One-dimensional arrays as one compressed binary value, byte planes apart."""
    planes = [(a.dtype.str, len(a), _planes(np.ascontiguousarray(a))) for a in arrays]
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(planes, protocol=5))


def unpack(blob: bytes) -> tuple[np.ndarray, ...]:
    return tuple(_from_planes(*p) for p in pickle.loads(zstandard.ZstdDecompressor().decompress(blob)))


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, whatever extra columns it carries."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name = f"_{name}"
    return name


def refuse_clashes(df: DataFrame, names: list[str]) -> None:
    """A column of the caller is never overwritten: one that is named as a result is an error."""
    clash = sorted({c.lower() for c in df.columns} & set(names))
    if clash:
        raise ValueError(f"columns that the operator adds are there already: {', '.join(clash)}")
