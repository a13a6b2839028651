r"""Line dedup by a deletion-neighbourhood join, with DataFrame functions only.

A line (blanks at its ends stripped) of ``min_chars`` characters or more goes if an earlier
line, by (document id, line number), equals it; one of ``near_chars`` or more, also if one is
within one edit of it. Shorter lines (numerals, bullets, initials) are within one edit of each
other without being copies. All is judged on the input. Lines within one edit share a deletion
variant: equal lengths share the line without the character at one place; otherwise the longer
without one character is the shorter.

All variants of all lines would be as many rows as characters. So, for a pair whose longer
line has R characters, the line is laid out in chunks fixed by R alone: the one edit lies in
some chunk, and all before (from the left) and all behind (from the right) are equal. One pass
over the texts writes each line's place, hashes and the hashes of all outside each chunk; a
first join finds those that two different lines share. Only there are the variants of the chunk
emitted, as hashed keys with the outside's hash, and joined. Pairs are then verified by edit
distance and the earliest line of each key is kept.

Equal lines count once throughout, as their first occurrence; a key's lines differ in one
character at one place, so its group is bounded by the alphabet, not by the data. Counts are
pre-aggregated; lines with more than 1/``HOT`` of all occurrences, of which there are fewer than
``HOT``, meet their occurrences by broadcast.

Defined results: null and empty texts have one empty line, and empty lines stay; documents
without an id come before all others; rows that repeat id and text are one document and keep
the same lines; no two lines tie, as their places differ; long texts and lines are laid out in
more chunks; an empty table gives an empty result; other columns are kept, and a column named
as one of the results raises ValueError.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .support import discard, documents, fresh_name, refuse_clashes, stash

BLANKS = " \t\r\x0b\x0c"
CHUNK, HOT = 512, 2000
BROADCAST_BYTES = 64 << 20


def _cell(line: Column, n: Column, r: Column, c: Column, m: Column) -> Column:
    """Chunk ``c`` of ``m`` of the layout for ``r`` characters, and the hash of all outside it."""
    before = F.floor(c * r / m).cast("int")
    behind = (r - F.floor((c + 1) * r / m)).cast("int")
    outside = F.xxhash64(r, c, F.substring(line, F.lit(1), before), F.substring(line, n - behind + 1, behind))
    return F.struct(r.alias("r"), before.alias("before"), behind.alias("behind"), outside.alias("outside"))


def _cells(line: Column, n: Column) -> Column:
    """All chunks of a line as the longer or equal one (r = n) and as the shorter one (r = n + 1)."""
    few = F.array(*[_cell(line, n, (n + k).cast("int"), F.lit(c), F.lit(2)) for k in (0, 1) for c in (0, 1)])
    m = lambda r: F.greatest(F.lit(2), F.least(F.ceil(r / CHUNK), F.ceil(F.sqrt(r)))).cast("int")
    many = F.flatten(F.transform(F.array(n, n + 1), lambda r: F.transform(F.sequence(F.lit(0), m(r) - 1), lambda c: _cell(line, n, r, c, m(r)))))
    return F.when(n + 1 <= 2 * CHUNK, few).otherwise(many)


def _differ(*columns: str) -> Column:
    test = F.lit(False)
    for c in columns:
        test = test | (F.min(c) != F.max(c))
    return test


def _suspects(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """Each distinct line that shares all outside a chunk with another: h1, h2, first place, line, n, those outsides."""
    cells = lines.select("h1", "h2", F.explode("outsides").alias("outside"))
    shared = cells.groupBy("outside").agg(_differ("h1", "h2").alias("many")).where("many").select("outside")
    near = cells.join(shared.hint("merge"), "outside").groupBy("h1", "h2").agg(F.collect_set("outside").alias("outsides"))
    firsts = lines.where(F.size("outsides") > 0).groupBy("h1", "h2").agg(F.min("at").alias("first"))
    asked = stash(near.join(firsts, ["h1", "h2"]))
    by_doc = asked.groupBy("first.id", "first.th").agg(F.collect_list(F.struct("h1", "h2", "first", "outsides")).alias("asked"))
    size = asked.agg(F.sum(F.size("outsides") * 8 + 80)).first()[0] or 0
    by_doc = F.broadcast(by_doc) if size <= BROADCAST_BYTES else by_doc  # else the texts are shuffled to meet them
    texts = docs.select(F.col("id").alias("doc"), F.xxhash64("text").alias("hash"), "text")
    met = texts.join(by_doc, F.col("doc").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("th"))).withColumn("all", F.split("text", "\n")).select("all", F.explode("asked").alias("x"))
    found = met.select("x.*", F.btrim(F.get("all", F.col("x.first.pos")), F.lit(BLANKS)).alias("line"))
    out = stash(found.groupBy("h1", "h2").agg(F.first("line").alias("line"), F.first("first").alias("first"), F.first("outsides").alias("outsides")).withColumn("n", F.char_length("line")))
    discard(asked)
    return out


def _near_lines(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(h1, h2, keeper): for each distinct line with an earlier line within one edit, the first such occurrence."""
    suspects = _suspects(docs, lines)
    laid = suspects.select("h1", "h2", "line", "n", "outsides", F.explode(_cells(F.col("line"), F.col("n"))).alias("x")).where(F.array_contains("outsides", F.col("x.outside"))).select("h1", "h2", "line", "n", "x.*")
    laid = laid.select("h1", "h2", "r", "n", "outside", F.expr("substring(line, before + 1, n - before - behind)").alias("chunk"))
    short = laid.where("n = r - 1").select(F.xxhash64("outside", F.lit("longer"), "chunk").alias("key"), F.lit("short").alias("role"), "h1", "h2")
    gaps = laid.where("n = r").withColumn("i", F.explode(F.sequence(F.lit(1), F.char_length("chunk")))).withColumn("rest", F.expr("concat(substring(chunk, 1, i - 1), substring(chunk, i + 1))"))
    roles = F.explode(F.array(F.struct(F.xxhash64("outside", F.lit("equal"), "i", "rest").alias("key"), F.lit("equal").alias("role")), F.struct(F.xxhash64("outside", F.lit("longer"), "rest").alias("key"), F.lit("long").alias("role"))))
    variants = short.union(gaps.select(roles.alias("v"), "h1", "h2").select("v.key", "v.role", "h1", "h2"))
    meeting = variants.groupBy("key").agg(_differ("h1", "h2").alias("many")).where("many").select("key")
    met = stash(variants.join(meeting.hint("merge"), "key").distinct())  # variants are sized as if nothing were exploded, and would be broadcast
    meeting = met.join(suspects.select("h1", "h2", "first"), ["h1", "h2"])
    least = meeting.groupBy("key").agg(F.min("first").alias("least"), F.min(F.when(F.col("role") == "short", F.col("first"))).alias("short"), F.min(F.when(F.col("role") == "long", F.col("first"))).alias("long"))
    keeper = F.when(F.col("role") == "equal", F.col("least")).when(F.col("role") == "long", F.col("short")).otherwise(F.col("long"))
    pairs = meeting.join(least, "key").select("h1", "h2", "first", keeper.alias("keeper")).where("keeper < first").distinct()
    kept = suspects.select(F.col("first").alias("keeper"), F.col("line").alias("kept_line"))
    verified = pairs.join(suspects.select("h1", "h2", "line"), ["h1", "h2"]).join(kept, "keeper").where(F.levenshtein("line", "kept_line", 1) >= 0)
    out = stash(verified.groupBy("h1", "h2").agg(F.min("keeper").alias("keeper")))
    discard(met, suspects)
    return out


def dedup_lines(docs: DataFrame, min_chars: int = 1, near_chars: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with n_lines, n_removed and kept_text (the lines that stay, as they were)."""
    refuse_clashes(docs, ["n_lines", "n_removed", "kept_text"])
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    split = slim.select("id", F.xxhash64("text").alias("th"), F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    lines = split.select(F.struct("id", "th", "pos").alias("at"), F.btrim("raw", F.lit(BLANKS)).alias("line")).withColumn("n", F.char_length("line")).where(F.col("n") >= max(1, min_chars))
    cells = F.when(F.col("n") >= near_chars, F.transform(_cells(F.col("line"), F.col("n")), lambda x: x["outside"])).otherwise(F.array().cast("array<bigint>"))
    lines = stash(lines.select("at", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), cells.alias("outsides")))
    near = _near_lines(slim, lines)
    places = lines.select("at", "h1", "h2")
    firsts = places.groupBy("h1", "h2").agg(F.min("at").alias("first"), F.count("*").alias("copies")).join(near, ["h1", "h2"], "left")
    firsts = stash(firsts.where("copies > 1 or keeper is not null"))
    many = places.count() // HOT + 1
    hot = firsts.where(F.col("copies") > many).select("h1", "h2", F.struct("first", "keeper").alias("found"))  # fewer than HOT rows
    met = places.join(F.broadcast(hot), ["h1", "h2"], "left")
    rest = met.where("found is null").drop("found").join(firsts.where(F.col("copies") <= many), ["h1", "h2"])
    gone = met.where("found is not null").select("at", "found.*").union(rest.select("at", "first", "keeper")).where("keeper is not null or at > first")
    names = [fresh_name(docs, c) for c in ("gone_id", "gone_th", "gone")]
    gone = stash(gone.groupBy(F.col("at.id").alias(names[0]), F.col("at.th").alias(names[1])).agg(F.collect_set("at.pos").alias(names[2])))
    discard(lines, near, firsts)
    joined = docs.join(gone, docs[id_col].eqNullSafe(gone[names[0]]) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == gone[names[1]]), "left")
    every = F.split(text, "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col(names[2]))
    kept = F.when(F.col(names[2]).isNull(), text).otherwise(F.array_join(F.transform(left, lambda p: F.get(every, p)), "\n"))
    return joined.select(*[docs[c] for c in docs.columns], F.size(every).alias("n_lines"), F.coalesce(F.size(names[2]), F.lit(0)).alias("n_removed"), kept.alias("kept_text")).withColumn("n_removed", F.greatest("n_removed", F.lit(0)))


def query(spark, sf_dir: str) -> DataFrame:
    out = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH split AS (
  SELECT doc_id, raw, pos FROM (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS raw, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS pos FROM documents)),
lines AS (SELECT doc_id, pos, doc_id * 1000000 + pos AS place, raw, trim(raw, concat(' ', chr(9), chr(13), chr(11), chr(12))) AS line FROM split),
d AS (SELECT line, length(line) AS n, min(place) AS first FROM lines WHERE length(line) >= 1 GROUP BY line),
variants AS (
  SELECT line, n, first, i, md5(left(line, (i - 1)::INT) || substr(line, (i + 1)::INT)) AS v
  FROM (SELECT line, n, first, unnest(range(1, n + 1)) AS i FROM d WHERE n >= 12)),
equal_length AS (SELECT line, min(least_first) AS keeper FROM (SELECT line, min(first) OVER (PARTITION BY n, i, v) AS least_first FROM variants) GROUP BY line),
longer AS (SELECT v.line AS long_line, v.first AS long_first, d.line AS short_line, d.first AS short_first FROM variants v JOIN d ON md5(d.line) = v.v AND d.n >= 12),
keepers AS (
  SELECT line, min(keeper) AS keeper FROM (
    SELECT line, keeper FROM equal_length
    UNION ALL SELECT long_line, short_first FROM longer
    UNION ALL SELECT short_line, long_first FROM longer)
  GROUP BY line),
judged AS (
  SELECT l.doc_id, l.pos, l.raw, coalesce(l.place > least(d.first, k.keeper), false) AS gone
  FROM lines l LEFT JOIN d ON l.line = d.line LEFT JOIN keepers k ON d.line = k.line)
SELECT doc_id, count(*)::INT AS n_lines, count(*) FILTER (gone)::INT AS n_removed,
       sha256(coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
