"""Quality rules and an n-gram perplexity band.

Rules: a document fails with fewer than ``min_words`` words, or when over half its words lie
in three-word windows found twice or more in it.

Model: modified Kneser-Ney over characters, one of order ``ORDER`` for each language. A symbol is
a code point (16 bits; those beyond are folded into the private-use range), all white space
one, so an n-gram is a number and its context and its suffix are parts of it. Spark counts the
n-grams of all documents, the continuations of the shorter ones and the discounts of each
language and order, and joins them to probabilities. The model has seen the text that it scores,
so each n-gram is scored as if its own occurrence had not been counted (leaving one out).

The n-grams' hashes and log probabilities become sorted arrays, looked up by binary search. Of
them ``PART`` (48 MB) at a time are broadcast; a larger model takes a pass over the documents for
each part. Order, counts and results do not depend on its size.

Verdict: per language, the median and the median absolute deviation of the log perplexity of
all documents that pass the rules, from a histogram of all of them; a document is rejected
outside median -/+ ``width`` deviations (at least ``least_band``), widened by ``slack`` over
the root of its length in characters: short texts vary more.

Defined results: null texts have no words and fail; null languages are one language of their
own; empty texts have log perplexity 0 and fail; long texts are scored whole; a perplexity on
the band's edge is kept; nothing depends on ids, so repeated rows get equal verdicts; an empty
table gives no rows; other columns are kept, and a column named as one of the measures raises
ValueError.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw
from .support import discard, documents, give_back, refuse_clashes, stash, tidy

ORDER, BITS, PART = 4, 16, 4_000_000
STEP = 0.001  # width of a histogram cell of log perplexity
MEASURES = [("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"), ("n_repeat_words", "long")]
# The characters that count as symbols.
SYMBOL_CHARS = b"#*$%&|<>"
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOL_CHARS)] = True
BLANK, PRIVATE, PRIVATE_SIZE = 0x20, 0xE000, 0x1900


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[offsets])


def _grams(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each character, blanks before the text, and the characters' offsets."""
    points = np.frombuffer(buffer.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    letters = np.zeros(len(buffer) + 1, np.int64)
    np.cumsum((buffer & 0xC0) != 0x80, out=letters[1:])
    offsets = letters[offsets]
    points = np.where(points < 1 << BITS, points, PRIVATE + points % PRIVATE_SIZE)
    sym = np.where((points <= 0x20) & bw.SPACE[np.minimum(points, 255)], BLANK, points).astype(np.uint64)
    out = sym.copy()
    for back in range(1, ORDER):
        before = np.full(len(sym), BLANK, np.uint64)
        before[back:] = sym[: max(0, len(sym) - back)]
        for k in range(back):
            at = offsets[:-1] + k
            before[at[at < offsets[1:]]] = BLANK
        out |= before << np.uint64(BITS * back)
    return out, offsets


def _languages(batch: pa.RecordBatch, lang_col: str) -> tuple[list[str], np.ndarray]:
    """The languages of a batch and the number of each row's."""
    column = pc.fill_null(batch.column(batch.schema.get_field_index(lang_col)).cast(pa.string()), "")
    coded = column.dictionary_encode()
    return coded.dictionary.to_pylist(), np.asarray(coded.indices)


def _count(batches):
    for batch in batches:
        names, lang = _languages(batch, "lang")
        seen: dict[int, list] = {}
        for row, to, buffer, offsets in bw.chunks(batch):
            grams, offsets = _grams(buffer, offsets)
            each = np.repeat(lang[row:to], np.diff(offsets))
            for k in set(lang[row:to].tolist()):
                own = np.sort(grams[each == k])
                first = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, np.int64)
                seen.setdefault(k, []).append((own[first], np.diff(np.append(first, len(own)))))
        for k, parts in seen.items():
            keys, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            counts = np.bincount(inverse, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([names[k]] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(counts)], ["lang", "gram", "n"])


def _low(gram: str, symbols: int) -> Column:
    return F.col(gram).bitwiseAND(F.lit((1 << (BITS * symbols)) - 1))


def _context(gram: str) -> Column:
    return F.call_function("shiftrightunsigned", F.col(gram), F.lit(BITS))


def _discounts(counts: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3) of modified Kneser-Ney from the counts of counts of each language."""
    many = lambda k: F.count(F.when(F.col("n") == k, 1)).alias(f"n{k}")
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    d = []
    for k in (1, 2, 3):
        raw = F.when(F.col(f"n{k}") > 0, k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")).otherwise(k / 2)
        bounded = F.least(F.greatest(raw, F.lit(0.05)), F.lit(k - 0.05))
        d.append(F.when((F.col("n1") > 0) & (F.col("n2") > 0), bounded).otherwise(0.5).alias(f"d{k}"))
    return counts.groupBy("lang").agg(*[many(k) for k in (1, 2, 3, 4)]).select("lang", *d)


def _discount(n: Column) -> Column:
    return F.when(n <= 0, 0.0).when(n == 1, F.col("d1")).when(n == 2, F.col("d2")).otherwise(F.col("d3"))


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, gram, n, p, left_out) of every n-gram of full order: its probability, and that without one occurrence."""
    slim = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"), F.col(text_col).alias("text"))
    counts = stash(slim.mapInArrow(tidy(_count), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    levels = [counts]
    for k in range(ORDER - 1, 0, -1):  # how many symbols were seen before each shorter n-gram
        levels.insert(0, levels[0].groupBy("lang", _low("gram", k).alias("gram")).agg(F.count("*").alias("n")))
    shorter = None
    for k, level in enumerate(levels):
        rows = level.join(_discounts(level), "lang")
        rows = rows.withColumn("d", _discount(F.col("n"))).withColumn("context", _context("gram"))
        totals = rows.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.sum("d").alias("cut"))
        rows = rows.join(totals, ["lang", "context"])
        if shorter is None:
            rows = rows.withColumn("lower", F.lit(1.0 / (1 << BITS)))
        else:
            rows = rows.withColumn("suffix", _low("gram", k)).join(shorter, ["lang", "suffix"])
        rows = rows.withColumn("p", (F.col("n") - F.col("d") + F.col("cut") * F.col("lower")) / F.col("total"))
        if k < ORDER - 1:
            shorter = stash(rows.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("lower")))
    less, rest = F.col("n") - 1, F.col("total") - 1
    cut = F.greatest(F.col("cut") - F.col("d") + _discount(less), F.lit(0.0))
    left_out = F.when(rest > 0, (less - _discount(less) + cut * F.col("lower")) / F.greatest(rest, F.lit(1))).otherwise(F.col("lower"))
    model = stash(rows.select("lang", "gram", "n", "p", left_out.alias("left_out")))
    discard(counts, shorter)
    return model


def _arrays(model: DataFrame):
    """Parts of the model in turn, as sorted hashes and their natural logs."""
    keys = model.select(F.xxhash64("lang", "gram").alias("key"), F.ln("left_out").cast("float").alias("log"))
    parts = max(1, -(-model.count() // PART))
    for k in range(parts):
        table = keys.where(F.pmod(F.shiftright("key", 8), F.lit(parts)) == k).toArrow()  # at most about PART rows of 12 bytes
        key, log = table["key"].to_numpy().view(np.uint64), table["log"].to_numpy()
        order = np.argsort(key)
        yield key[order], log[order]


def _text_measures(buffer: np.ndarray, offsets: np.ndarray) -> tuple:
    words, solid = bw.find_words(buffer, offsets), ~bw.SPACE[buffer]
    return words.counts, _sums(solid & ((buffer & 0xC0) != 0x80), offsets), _sums(_IS_SYMBOL[buffer], offsets), _line_copies(buffer, offsets), _repeated_words(words)


def _log_sums(part: tuple, buffer: np.ndarray, offsets: np.ndarray, names: list[str], lang: np.ndarray) -> tuple:
    """Of each text the summed logs of those n-grams that ``part`` of the model has, and its length."""
    grams, offsets = _grams(buffer, offsets)
    logs, each = np.zeros(len(grams)), np.repeat(lang, np.diff(offsets))
    for k in set(lang.tolist()):
        inside = each == k
        own, inverse = np.unique(grams[inside], return_inverse=True)
        name = np.frombuffer(names[k].encode(), np.uint8)
        seed = int(bw.xxh64(name, np.zeros(1, np.int64), np.array([len(name)]))[0])
        starts = np.arange(len(own)) * 8
        keys = bw.xxh64(own.view(np.uint8), starts, starts + 8, seed) if len(own) else own
        at = np.minimum(np.searchsorted(part[0], keys), max(len(part[0]) - 1, 0))
        found = part[0][at] == keys if len(part[0]) else np.zeros(len(keys), bool)
        logs[inside] = np.where(found, part[1][at] if len(part[0]) else 0.0, 0.0)[inverse]
    total = np.zeros(len(logs) + 1)
    np.cumsum(logs, out=total[1:])
    return np.diff(total[offsets]), np.diff(offsets)


def _measure(shared, text_col: str, lang_col: str, first: bool):
    def run(batches):
        for batch in batches:
            names, lang = _languages(batch, lang_col)
            out = []
            for row, to, buffer, offsets in bw.chunks(batch, text_col):
                out.append((_text_measures(buffer, offsets) if first else ()) + _log_sums(shared.value, buffer, offsets, names, lang[row:to]))
            columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0)] * (7 if first else 2)
            kinds = [pa.int64()] * (len(columns) - 2) + [pa.float64(), pa.int64()]
            made = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
            if not first:  # add to the sums of the parts before
                made = [pc.add(batch.column(batch.num_columns - 2), made[0])]
            kept = batch.columns if first else batch.columns[:-2]
            tail = [] if first else [batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, *made, *tail], names=[*batch.schema.names, *([n for n, _ in MEASURES] + ["log_sum", "n_letters"] if first else [])])

    return tidy(run)


def _line_copies(buffer: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text, counted per text."""
    breaks = np.flatnonzero(buffer == 10)
    begins = np.zeros(len(buffer) + 1, bool)
    begins[offsets[:-1]], begins[breaks + 1] = True, True
    starts = np.flatnonzero(begins[:-1])
    text = np.searchsorted(offsets, starts, "right") - 1
    ends = np.append(breaks, len(buffer))[np.searchsorted(breaks, starts)]
    ends = np.minimum(ends, offsets[text + 1])
    solid = np.zeros(len(buffer) + 1, np.int64)
    np.cumsum(~bw.SPACE[buffer], out=solid[1:])
    real = solid[ends] > solid[starts]
    text, starts, ends = text[real], starts[real], ends[real]
    keys = bw.hash_bytes(buffer, starts, ends) ^ bw.mix(text.astype(np.uint64) + np.uint64(1))
    _, at = np.unique(keys, return_index=True)
    docs = len(offsets) - 1
    return np.bincount(text, minlength=docs) - np.bincount(text[at], minlength=docs)


def _repeated_words(words: bw.Words) -> np.ndarray:
    """Words in three-word windows that occur twice or more in their text."""
    hashes, text, docs = words.hashes(), words.text_of(), len(words.counts)
    if len(hashes) < 3:
        return np.zeros(docs, np.int64)
    at = np.flatnonzero(text[2:] == text[:-2])
    keys = bw.mix(bw.mix(bw.mix(hashes[at]) + hashes[at + 1]) + hashes[at + 2]) ^ bw.mix(text[at].astype(np.uint64) + np.uint64(1))
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    mark = np.zeros(len(hashes), bool)
    twice = at[counts[inverse] > 1]
    for k in range(3):
        mark[twice + k] = True
    return np.bincount(text[mark], minlength=docs)


def bands(measured: DataFrame, lang: Column, width: float, least_band: float) -> DataFrame:
    """(lang, mid, spread) of log perplexity, from a histogram of every passing document."""
    cells = measured.where("not base_failed").groupBy(lang.alias("band_lang"), (F.round(F.col("log_perplexity") / STEP) * STEP).alias("value")).count()
    mids = cells.groupBy("band_lang").agg(F.percentile("value", 0.5, F.col("count")).alias("mid"))
    away = cells.join(mids, "band_lang").withColumn("away", F.abs(F.col("value") - F.col("mid")))
    spread = F.greatest(F.percentile("away", 0.5, F.col("count")) * width * 1.4826, F.lit(least_band))
    return away.groupBy("band_lang").agg(F.first("mid").alias("mid"), spread.alias("spread"))


def assess(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_words: int = 50, max_repeat_percent: int = 50, width: float = 6.0, least_band: float = 0.1, slack: float = 0.5, with_text: bool = True) -> DataFrame:
    """``docs`` with the measures, log_perplexity, base_failed and kept; without the text unless ``with_text``."""
    refuse_clashes(docs, [n for n, _ in MEASURES] + ["log_sum", "n_letters", "log_perplexity", "base_failed", "kept", "band_lang", "mid", "spread"])
    model, before = train(docs, lang_col, text_col), None
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"{n} {k}" for n, k in MEASURES] + ["log_sum double", "n_letters long"])
    for part in _arrays(model):
        shared = docs.sparkSession.sparkContext.broadcast(part)
        scored = (docs if before is None else before).mapInArrow(_measure(shared, text_col, lang_col, before is None), schema)
        if before is not None:
            done, before = before, stash(scored)
            discard(done)
        else:
            before = stash(scored if with_text or model.count() > PART else scored.drop(text_col))
        shared.destroy()
    part = shared = None
    give_back()  # the driver's own copies of the model
    discard(model)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    perplexity = F.when(F.col("n_letters") > 0, -F.col("log_sum") / F.col("n_letters")).otherwise(0.0)
    measured = before.withColumn("log_perplexity", perplexity).withColumn("base_failed", failed)
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(""))
    limits = stash(bands(measured, lang, width, least_band))  # a row a language
    room = F.col("spread") + slack / F.sqrt(F.greatest("n_letters", F.lit(1)))
    judged = measured.join(limits, lang == F.col("band_lang"), "left")
    kept = ~F.col("base_failed") & F.coalesce(F.abs(F.col("log_perplexity") - F.col("mid")) <= room, F.lit(False))
    out = judged.withColumn("kept", kept).drop("log_sum", "n_letters", "band_lang", "mid", "spread")
    return out if with_text else out.drop(text_col)


def query(spark, sf_dir: str) -> DataFrame:
    out = assess(documents(spark, sf_dir).select("doc_id", "lang", "text"), with_text=False)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lang", "log_perplexity")
