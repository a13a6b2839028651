"""Spelling variant grouping with a bit-sliced position index.

Spark counts the words: maximal letter runs of every text, lower-cased in A-Z, a code point deleted
in the one run of 199 that a checksum of its id and letters picks. Words with enough letters and
occurrences form the vocabulary. Two words are near if they differ by exactly one inserted, deleted
or replaced code point; a word's form is its nearest frequent spelling, its root the last of the forms.

One error leaves the first or the last half of a word as it was, so near words meet under one key
(side, length of the shorter word, that half's letters). Keys of one length are dealt into blocks of
bounded size. In a block, an index holds a bitset over the block's words for every (position,
letter); a batch of queries runs down its letters and updates, 64 words at a time, the set of words
without an error so far and the sets with one error by replacement, insertion (letter read one
position on) and deletion (one position back). A key with more words than a block is cut: its words
are spread over blocks and asked for in each of them, so that no pair is lost.

Defined results: null and empty texts have no words; null ids count as empty text before the colon;
runs of any length are whole, ties of the largest count go to the smallest word in code-point order;
rows that repeat count each time; an empty table gives no rows; a word without near words has n_near
0 and itself as root; other columns, whatever their names, take no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .support import discard, documents, stash, text_or_empty

LETTERS = "A-Za-zÀ-ÿ"
DELETE_ONE_IN = 199
BLOCK, BLOCK_LETTERS = 4096, 1 << 22  # words of a block, and letters: long words come in smaller blocks
QUERIES = 256


def _lower_ascii(run: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.lower(run) == run, run).otherwise(F.translate(run, upper, upper.lower()))


def vocabulary(docs: DataFrame, min_letters: int = 6, min_count: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all words of at least ``min_letters`` code points that occur ``min_count`` times or more."""
    slim = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), text_or_empty(text_col).alias("text"))
    runs = slim.select("id", F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{min_letters},}}"), F.lit(0))).alias("run"))
    runs = runs.select("id", _lower_ascii(F.col("run")).alias("run"))
    runs = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    words = runs.select(F.when(F.col("h") % DELETE_ONE_IN == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.char_length("word") >= min_letters).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _halves(words: DataFrame) -> DataFrame:
    """Each word under its keys: as the shorter word of a pair (or one of two equally long ones) and as the longer one."""
    size, shorter = F.char_length("word"), F.col("shorter")
    keyed = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("shorter"))
    keyed = keyed.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
    head, tail = (shorter / 2).cast("int"), shorter - (shorter / 2).cast("int")
    half = F.when(F.col("side") == 0, F.substring("word", F.lit(1), head)).otherwise(F.substring("word", size - tail + 1, tail))
    return keyed.select("word", "n", "shorter", "side", half.alias("half"))


def _blocks(words: DataFrame) -> DataFrame:
    """(block, shorter, word, n, side, half, asks, answers): who is looked for and who is found in each block."""
    keyed = _halves(words)
    room = F.greatest(F.lit(64), F.least(F.lit(BLOCK), (F.lit(BLOCK_LETTERS) / F.col("shorter")).cast("int")))
    keys = keyed.groupBy("shorter", "side", "half").agg(F.count("*").alias("k")).where("k > 1")
    keys = keys.withColumn("parts", F.ceil(F.col("k") / room).cast("int"))
    rows = keys.groupBy("shorter").agg(F.sum("k").alias("rows")).select("shorter", F.ceil(F.col("rows") / room).alias("blocks"))
    rows = keyed.join(keys.join(rows, "shorter"), ["shorter", "side", "half"])
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    rows = rows.withColumn("own", own).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    # the parts of a cut key are blocks of their own; keys that fit share blocks
    block = F.when(F.col("parts") > 1, F.xxhash64("side", "half", "part")).otherwise(F.pmod(F.xxhash64("side", "half"), F.col("blocks")))
    return rows.select("shorter", block.alias("block"), "word", "n", "side", "half", (F.col("own") == F.col("part")).alias("answers"))


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points by word and position (0 beyond the end), and lengths."""
    sizes = np.array([len(w) for w in words])
    out = np.zeros((len(words), int(sizes.max())), np.uint32)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out, sizes


def _bits(rows: np.ndarray) -> np.ndarray:
    """Booleans as rows of 64-bit words."""
    rows = np.pad(rows, [(0, 0), (0, -rows.shape[1] % 64)])
    return np.packbits(rows, axis=1, bitorder="little").view(np.uint64)


class PositionIndex:
    """A bitset over the words for every position and letter, for words of lengths ``shorter`` and one more."""

    def __init__(self, codes: np.ndarray, sizes: np.ndarray, shorter: int):
        self.shorter, self.letters, self.sets = shorter, [], []
        for p in range(shorter + 1):
            column = codes[:, p] if p < codes.shape[1] else np.zeros(len(codes), np.uint32)
            letters = np.unique(column[column > 0])
            self.letters.append(letters)
            self.sets.append(np.vstack([_bits(column == letters[:, None]), _bits(np.zeros((1, len(codes)), bool))]))  # the last: no word
        self.used = [_bits((sizes > p)[None, :])[0] for p in range(shorter + 1)]
        self.long = {m: _bits((sizes == m)[None, :])[0] for m in (shorter, shorter + 1)}

    def with_letter(self, p: int, letter: np.ndarray) -> np.ndarray:
        if not 0 <= p <= self.shorter:
            return self.sets[0][np.full(len(letter), -1)]
        at = np.searchsorted(self.letters[p], letter)
        found = at < len(self.letters[p])
        found[found] = self.letters[p][at[found]] == letter[found]
        return self.sets[p][np.where(found, at, -1)]

    def one_error(self, queries: np.ndarray) -> np.ndarray:
        """Bitsets of the words at exactly one error from each query; the queries are equally long."""
        m = queries.shape[1]
        zero = np.repeat((self.long[self.shorter] | self.long[self.shorter + 1])[None, :], len(queries), 0)
        replaced, inserted, deleted = np.zeros_like(zero), np.zeros_like(zero), np.zeros_like(zero)
        for i in range(m):
            here = self.with_letter(i, queries[:, i])
            replaced = (replaced & here) | (zero & ~here & self.used[i])
            inserted = (inserted | zero) & self.with_letter(i + 1, queries[:, i])
            deleted = (deleted & self.with_letter(i - 1, queries[:, i])) | zero
            zero = zero & here
        none = np.zeros_like(self.long[self.shorter])
        return (replaced & self.long.get(m, none)) | ((inserted | zero) & self.long.get(m + 1, none)) | (deleted & self.long.get(m - 1, none))


def _near(table: pa.Table) -> pa.Table:
    """Of one block: for each word that is asked for, how many words are near and the best of them."""
    shorter = table.column("shorter")[0].as_py()
    words, n = table.column("word").to_pylist(), table.column("n").to_numpy()
    halves = dict.fromkeys(zip(table.column("side").to_pylist(), table.column("half").to_pylist()))
    number = {h: k for k, h in enumerate(halves)}
    key = np.array([number[h] for h in zip(table.column("side").to_pylist(), table.column("half").to_pylist())])
    side = table.column("side").to_numpy()
    answers = np.flatnonzero(table.column("answers").to_numpy(zero_copy_only=False))
    codes, sizes = _codes(words)
    out = {"word": [], "near": [], "best": [], "best_n": []}
    if len(answers):
        index = PositionIndex(codes[answers], sizes[answers], shorter)
        head = shorter // 2
        for m in (shorter, shorter + 1):
            asked = np.flatnonzero(sizes == m)
            for part in (asked[k : k + QUERIES] for k in range(0, len(asked), QUERIES)):
                q, a = np.nonzero(np.unpackbits(index.one_error(codes[part, :m]).view(np.uint8), axis=1, bitorder="little"))
                q, a = part[q], answers[a]
                # a pair counts under one key: with its own shorter length, and by its tails only if its heads differ
                ok = (key[q] == key[a]) & (np.minimum(sizes[q], sizes[a]) == shorter)
                ok &= (side[q] == 0) | (codes[q, :head] != codes[a, :head]).any(1)
                q, a = q[ok], a[ok]
                for row in np.split(np.arange(len(q)), np.flatnonzero(np.diff(q)) + 1) if len(q) else []:
                    near = a[row]
                    best = min(near[n[near] == n[near].max()].tolist(), key=lambda k: words[k])
                    for name, value in (("word", words[q[row[0]]]), ("near", len(near)), ("best", words[best]), ("best_n", int(n[best]))):
                        out[name].append(value)
    return pa.table(out, pa.schema([("word", pa.string()), ("near", pa.int64()), ("best", pa.string()), ("best_n", pa.int64())]))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best, best_n): words of ``words`` (word, n) that have near words, and the most frequent of those."""
    found = _blocks(words).groupBy("shorter", "block").applyInArrow(_near, "word string, near long, best string, best_n long")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select("word", "n_near", F.col("b.word").alias("best"), (-F.col("b.minus")).alias("best_n"))


def variants(docs: DataFrame, min_letters: int = 6, min_count: int = 5, ratio: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary."""
    words = stash(vocabulary(docs, min_letters, min_count, id_col, text_col))
    joined = words.join(near_words(words), "word", "left")
    is_form = F.col("best_n") >= ratio * F.col("n")
    out = stash(joined.select("word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best_n")).alias("form_n")))
    roots = stash(out.where("form is not null").select("word", F.col("form").alias("root")))
    while True:  # each round doubles the steps: a form is ``ratio`` times as frequent, so few rounds end it
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stash(roots.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        done = moved.where("moved").isEmpty()
        discard(roots)
        roots = moved.select("word", "root")
        roots.scratch_path = moved.scratch_path
        if done:
            break
    discard(words)
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark, sf_dir: str) -> DataFrame:
    return variants(documents(spark, sf_dir))
