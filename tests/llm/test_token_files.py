import gc
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hearthline.llm import bytewords, packing, range_coder, token_files
from hearthline.llm.support import scratch_dir
from hearthline.llm.tokens import TokenCoder, default_tokenizer


def plain_ids(text, end):
    return Tokenizer.from_file(default_tokenizer()).encode(text or "", add_special_tokens=False).ids + [end]


def test_ids_equal_the_library(texts):
    odd = ["It's a <b>tést</b>! ΑΣ İx ﬁ é x y\x1cz 12345 don't", "ab,.;cd _x_ 'tis ... !?", "ŉ ſ ª º µ Æ × ÷ ß ẞ Ŀ", "a\x00b <|endoftext|> c", "é ́e"]
    sample = [t or "" for t in texts] + odd
    batch = pa.RecordBatch.from_pydict({"text": sample})
    row = 0
    for a, b, buffer, offsets in bytewords.chunks(batch, limit=5000):
        ids, bounds = TokenCoder.get(default_tokenizer()).encode_texts(buffer, offsets, 1)
        for k in range(b - a):
            assert ids[bounds[k] : bounds[k + 1]].tolist() == plain_ids(sample[row], 1), sample[row]
            row += 1


def test_words_are_cut_at_marks_and_known_by_their_bytes():
    """Words with marks behind them are their letters and the marks, each known once; ids are the library's for words of
    all lengths around those of the compared numbers, and where marks stand by special tokens and contractions."""
    stems = [f"{'abcdefghijklmnopqrstuvwxyz'[k % 26] * (1 + k // 26)}q" for k in range(260)]
    texts = [" ".join(s + m for s in stems) for m in ("", "$$$", "***", "&&", "--")]
    texts += ["don't$'s dog's( x'-re cats'&s a<|endoftext|>b= c<|startoftext|> <|end", "É×È Àß÷ ÀÉÿ ñ$ ÉCOLE$ ÷ × Ĳ", "aaaaaaaaaaaaaaaab aaaaaaaaaaaaaaaac aaaaaaaab aaaaaaaac " * 3]
    texts += [f"ab{chr(c)}cd EF{chr(c)}{chr(c)}'s {chr(c)}g" for c in range(33, 127)]
    coder, at = TokenCoder(default_tokenizer()), 0
    for a, b, buffer, offsets in bytewords.chunks(pa.RecordBatch.from_pydict({"text": texts[:5]})):
        coder.encode_texts(buffer, offsets, 1)
    assert len(coder.young.keys) == len(stems) + 4
    for a, b, buffer, offsets in bytewords.chunks(pa.RecordBatch.from_pydict({"text": texts}), limit=300):
        ids, bounds = coder.encode_texts(buffer, offsets, 1)
        for k in range(b - a):
            assert ids[bounds[k] : bounds[k + 1]].tolist() == plain_ids(texts[at], 1), texts[at]
            at += 1


@pytest.mark.parametrize("n", [0, 1, 4096, 4097, 9000])
def test_coder_round_trip_and_damage(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.4, n) % 49408).astype(np.uint32)
    ids[n // 2 :] = ids[: n - n // 2]
    present, counts, blocks, checks = range_coder.encode(ids)
    assert (range_coder.decode(present, counts, blocks, checks, n) == ids).all()
    if n > 1:
        blocks[0] = bytes([blocks[0][0] ^ 255]) + blocks[0][1:]
        with pytest.raises(ValueError):
            range_coder.decode(present, counts, blocks, checks, n)


def test_new_words_leave_nothing_to_the_garbage_collector():
    """Tens of thousands of new words are encoded without a walk of Python's collector over what was made for them."""
    texts = [" ".join(f"{a}{b}{c}{d}" for b in "abcdefghijklmnopqrst" for c in "abcdefghijklmnopqrst" for d in "abcdefghijklmnopqrst") for a in "zyxwv"]
    coder, walks, count = TokenCoder(default_tokenizer()), [], lambda phase, info: walks.append(phase)
    (chunk,) = bytewords.chunks(pa.RecordBatch.from_pydict({"text": texts}))
    gc.collect()
    gc.callbacks.append(count)
    try:
        ids, bounds = coder.encode_texts(*chunk[2:], 1)
    finally:
        gc.callbacks.remove(count)
    assert walks.count("start") <= 3 and len(coder.young.keys) == 40000
    assert ids[bounds[0] : bounds[1]].tolist() == plain_ids(texts[0], 1)


@pytest.mark.parametrize(("n", "size", "crc"), [(1, 8, 1696784233), (5000, 4808, 2670054118), (300000, 294226, 2085395724)])
def test_coded_bytes_stay_as_they_are(n, size, crc):
    """Files written before can be read: the bytes of the blocks are those of the format."""
    at = np.arange(n, dtype=np.uint64)
    mixed = bytewords.mix(at) % np.uint64(1000)
    ids = np.where(at % 7 < 4, at % 97, mixed * mixed // np.uint64(23)).astype(np.uint32)
    present, counts, blocks, checks = range_coder.encode(ids)
    assert (sum(map(len, blocks)), zlib.crc32(b"".join(blocks))) == (size, crc)
    assert (range_coder.decode(present, counts, blocks, checks, n) == ids).all()


def test_files_hold_all_documents_in_order(spark, docs, no_docs):
    folder = f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
    got = sorted(token_files.read(spark, folder, token_files.write(docs, folder, default_tokenizer(), 1)).collect(), key=lambda r: r.start)
    assert sorted(((r.doc_id, list(np.frombuffer(r.ids, "<u4"))) for r in got), key=repr) == sorted(((r.doc_id, plain_ids(r.text, 1)) for r in docs.collect()), key=repr)
    order = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert order == sorted(order)
    assert [r.start for r in got] == (np.cumsum([r.n_ids for r in got]) - [r.n_ids for r in got]).tolist()
    empty = f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
    assert token_files.read(spark, empty, token_files.write(no_docs, empty, default_tokenizer(), 1)).count() == 0


def test_packing_places_each_id_once(docs, no_docs):
    for length, shard_bytes in ((4096, 8 << 20), (64, 3000)):
        pieces = packing.pack(docs, default_tokenizer(), 2, length, shard_bytes).collect()
        rows = [(r.doc_id, plain_ids(r.text, 2)) for r in docs.collect()]
        assert sum(p.length for p in pieces) == sum(len(i) for _, i in rows)
        single = {d: i for d, i in rows if sum(d == e for e, _ in rows) == 1}
        for d, ids in single.items():
            at = 0
            for p in sorted((p for p in pieces if p.doc_id == d), key=lambda p: p.start):
                assert (p.start, p.doc_tokens) == (at, len(ids))
                at += p.length
                assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : at], "<u4").tobytes())
            assert at == len(ids)
        by = {}
        for p in pieces:
            by.setdefault(p.sequence_id, []).append(p)
        short = 0
        for own in by.values():
            at = 0
            for p in sorted(own, key=lambda p: p.offset):
                assert p.offset == at
                at += p.length
            assert 0 < at <= length
            short += at < length
        assert short <= len({s >> 32 for s in by})
    assert packing.pack(no_docs, default_tokenizer()).count() == 0


def test_neighbours_share_windows(spark):
    rows = [(k, " ".join(f"{'abcdefgh'[k % 8] * 3}{j}" for j in range(20))) for k in range(64)]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), default_tokenizer(), 2, 512).collect()
    same = [p.doc_id % 8 == p.seed_doc_id % 8 for p in pieces if p.doc_id != p.seed_doc_id]
    assert sum(same) > 0.5 * len(same)


def test_rows_alike_are_dealt_to_many_shards(spark):
    """Of 4000 rows without an id and with one text, and 400 others, no shard gets over twice the mean."""
    rows = [(None, "one text that all of them have")] * 4000 + [(k, f"text {k} of its own") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    dealt = packing.deal(docs, default_tokenizer(), 2, 14000)
    sizes = [r["n"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 4400 and dealt.rdd.getNumPartitions() >= 8
    assert max(sizes) <= 2 * 4400 / dealt.rdd.getNumPartitions()
