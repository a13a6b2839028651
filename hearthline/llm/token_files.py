"""Token files: texts as ids in a compressed, checksummed binary format.

``write`` sorts documents by id, tokenises them and writes files of about ``FILE_IDS`` ids,
whole documents each, through the file system of the target folder; a file holds its documents' ids, lengths and
the blocks of :mod:`range_coder`. Every task attempt names its files anew and the manifest
lists those of the attempts that Spark accepted, so lost executors and repeated attempts
leave at most files that nothing refers to. ``read`` lists documents from the files.

Defined results: null texts have only the end id; rows without an id come first; rows that
repeat an id all appear, ordered by their text's hash (ties are equal texts); long texts are
written whole; an empty table writes no file; other columns take no part.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw
from . import range_coder
from .support import documents, hold_buffers, scratch_dir, stash, tidy
from .tokens import TokenCoder, default_tokenizer

MAGIC, FILE_IDS = b"HLTOKEN2", 8192 * range_coder.BLOCK  # the more blocks are coded side by side, the less each costs
MANIFEST = "part int, seq int, path string, n_ids long, n_docs long, n_bytes long"


_HEADER = "<IIQQQ"  # sizes of the packed and of the unpacked columns, ids, blocks, documents


def file_bytes(ids: np.ndarray, doc_ids: np.ndarray, no_id: np.ndarray, lengths: np.ndarray) -> bytes:
    """One file: magic, CRC-32 of the header, header, then the blocks. The header has its counts, then,
    compressed, little-endian columns: the number of distinct ids, these, their counts, sizes and
    checksums of the blocks, document ids, which have none, and lengths."""
    present, counts, blocks, checks = range_coder.encode(ids)
    columns = (np.array([len(present)], "<u8"), present.astype("<u4"), counts.astype("<u8"), np.array([len(b) for b in blocks], "<u4"), np.array(checks, "<u4"), doc_ids.astype("<i8"), no_id.astype("u1"), lengths.astype("<u8"))
    raw = b"".join(c.tobytes() for c in columns)
    packed = zlib.compress(raw, 1)
    header = struct.pack(_HEADER, len(packed), len(raw), len(ids), len(blocks), len(doc_ids)) + packed
    return MAGIC + struct.pack("<I", zlib.crc32(header)) + header + b"".join(blocks)


def file_contents(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, document ids, which have none, how many ids of each document are here)."""
    start = len(MAGIC) + 4
    body = start + struct.calcsize(_HEADER)
    if len(data) < body or data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a token file")
    packed, size, n, blocks, docs = struct.unpack_from(_HEADER, data, start)
    if zlib.crc32(data[start : body + packed]) != struct.unpack_from("<I", data, len(MAGIC))[0]:
        raise ValueError("the header is damaged")
    raw, at, columns = zlib.decompress(data[body : body + packed], bufsize=size), 8, []
    distinct = int(np.frombuffer(raw, "<u8", 1)[0])
    for kind, count in (("<u4", distinct), ("<u8", distinct), ("<u4", blocks), ("<u4", blocks), ("<i8", docs), ("u1", docs), ("<u8", docs)):
        columns.append(np.frombuffer(raw, kind, count, at))
        at += columns[-1].nbytes
    present, counts, sizes, checks, doc_ids, no_id, lengths = columns
    ends = body + packed + np.cumsum(sizes.astype(np.int64))
    pieces = [data[e - s : e] for e, s in zip(ends.tolist(), sizes.tolist())]
    return range_coder.decode(present, counts.astype(np.int64), pieces, checks.tolist(), n), doc_ids.astype(np.int64), no_id.astype(bool), lengths.astype(np.int64)


def _writer(folder: str, tokenizer: str, end_id: int):
    def run(batches):
        from pyarrow import fs
        from pyspark import TaskContext

        hold_buffers()
        store, root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        coder, part, name, seq = TokenCoder.get(tokenizer), TaskContext.get().partitionId(), uuid.uuid4().hex, 0
        ids, docs, held = [], [], 0

        def flush():
            nonlocal ids, docs, held, seq
            data = file_bytes(np.concatenate(ids), *(np.array([d[k] for d in docs], t) for k, t in enumerate((np.int64, bool, np.int64))))
            path = f"{root.rstrip('/')}/part-{part:05d}-{seq:05d}-{name}.tok"
            with store.open_output_stream(path) as out:
                out.write(data)
            row = (part, seq, path.rsplit("/", 1)[1], held, len(docs), len(data))
            ids, docs, held, seq = [], [], 0, seq + 1
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()))], ["part", "seq", "path", "n_ids", "n_docs", "n_bytes"])

        for batch in batches:
            keys = batch.column(0)
            numbers, missing = np.asarray(keys.fill_null(0)), np.asarray(keys.is_null())
            for row, to, buffer, offsets in bw.chunks(batch):
                got, bounds = coder.encode_texts(buffer, offsets, end_id)
                ids.append(got)
                docs += zip(numbers[row:to].tolist(), missing[row:to].tolist(), np.diff(bounds).tolist())
                held += len(got)
                if held >= FILE_IDS:
                    yield flush()
        if held:
            yield flush()

    return tidy(run)


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files and return their manifest, with ``start``: the ids of all files before."""
    spark = docs.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    tie = F.xxhash64("text")
    ordered = slim.repartitionByRange(F.col("id").asc_nulls_first(), tie).sortWithinPartitions(F.col("id").asc_nulls_first(), tie)
    manifest = stash(ordered.mapInArrow(_writer(folder, tokenizer, end_id), MANIFEST))
    rows, start = [], 0
    for r in sorted(manifest.collect(), key=lambda r: (r["part"], r["seq"])):  # one short row a file
        rows.append((*r, start))
        start += r["n_ids"]
    return spark.createDataFrame(rows, f"{MANIFEST}, start long")


@tidy
def _reader(batches):
    hold_buffers()
    for batch in batches:
        for content, start in zip(batch.column(0), batch.column(1).to_pylist()):
            ids, docs, no_id, lengths = file_contents(content.as_buffer().to_pybytes())
            at = np.cumsum(lengths) - lengths
            raw = [ids[a : a + n].astype("<u4").tobytes() for a, n in zip(at.tolist(), lengths.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(docs, mask=no_id), pa.array(start + at), pa.array(lengths), pa.array(raw, pa.binary())], ["doc_id", "start", "n_ids", "ids"])


def read(spark, folder: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_ids, ids as little-endian unsigned 32-bit values) of every document in the files."""
    names = manifest.select("path", "start")
    if not names.head(1):
        return spark.createDataFrame([], "doc_id long, start long, n_ids long, ids binary")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("path"), "content")
    return files.join(names, "path").select("content", "start").mapInArrow(_reader, "doc_id long, start long, n_ids long, ids binary")


def query(spark, sf_dir: str) -> DataFrame:
    folder = f"{scratch_dir(spark)}/tokens-{uuid.uuid4().hex}"
    held = read(spark, folder, write(documents(spark, sf_dir), folder, default_tokenizer(), end_id=1))
    return held.select("doc_id", "start", F.col("n_ids").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
