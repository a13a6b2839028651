import re
from collections import Counter

import numpy as np
import pytest

from hearthline.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    times = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def test_measures_equal_brute_force(docs, no_docs):
    for r in quality.assess(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(r.text), r
        assert not (r.kept and r.base_failed)
    assert quality.assess(no_docs).count() == 0


def symbols(text):
    points = (ord(c) if ord(c) < 1 << 16 else 0xE000 + ord(c) % 0x1900 for c in text or "")
    return [32] * 3 + [32 if p == 32 or 9 <= p <= 13 else p for p in points]


def grams_of(text):
    sym = symbols(text)
    return [tuple(sym[k - 3 : k + 1]) for k in range(3, len(sym))]


def brute_model(texts):
    """Modified Kneser-Ney by dictionaries: for each full n-gram its probability, and that without one occurrence."""
    levels = {4: Counter(g for t in texts for g in grams_of(t))}
    for k in (3, 2, 1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    p = {0: {(): 1 / 65536}}
    for k in (1, 2, 3, 4):
        n = Counter(levels[k].values())
        d = [0, 0.5, 0.5, 0.5]
        if n[1] and n[2]:
            y = n[1] / (n[1] + 2 * n[2])
            d = [0, *(min(max(j - (j + 1) * y * n[j + 1] / n[j] if n[j] else j / 2, 0.05), j - 0.05) for j in (1, 2, 3))]
        total, cut = Counter(), Counter()
        for g, c in levels[k].items():
            total[g[:-1]] += c
            cut[g[:-1]] += d[min(c, 3)]
        p[k] = {g: (c - d[min(c, 3)] + cut[g[:-1]] * p[k - 1][g[1:]]) / total[g[:-1]] for g, c in levels[k].items()}
    left = {}
    for g, c in levels[4].items():
        lower, rest = p[3][g[1:]], total[g[:-1]] - 1
        less = cut[g[:-1]] - d[min(c, 3)] + d[min(c - 1, 3)]
        left[g] = (c - 1 - d[min(c - 1, 3)] + max(less, 0) * lower) / rest if rest else lower
    return p[4], left


NON_LATIN = ["Привет мир, это обычный текст", "漢字かな交じり文の例です。", "emoji \U0001f600 and \U00010348 gothic", "نص عربي قصير", None, ""]


def test_probabilities_and_verdicts_equal_brute_force(spark, docs):
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()] + [(900 + k, t, "xx") for k, t in enumerate(NON_LATIN)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    by = {lang: brute_model([t for _, t, x in rows if (x or "") == lang]) for lang in {x or "" for *_, x in rows}}
    got = {(r.lang, tuple((r.gram >> s) & 0xFFFF for s in (48, 32, 16, 0))): (r.n, r.p, r.left_out) for r in quality.train(table).collect()}
    assert len(got) == sum(len(p) for p, _ in by.values())
    for (lang, g), (_, p, left) in got.items():
        assert np.isclose(p, by[lang][0][g], rtol=1e-9) and np.isclose(left, by[lang][1][g], rtol=1e-9)
    out = quality.assess(table).collect()
    want = {}
    for r in out:
        logs = [np.log(by[r.lang or ""][1][g]) for g in grams_of(r.text)]
        assert np.isclose(r.log_perplexity, -np.mean(logs) if logs else 0, rtol=1e-5, atol=1e-6), r
        want.setdefault(r.lang or "", []).append(r)
    for own in want.values():
        cells = [round(r.log_perplexity / 0.001) * 0.001 for r in own if not r.base_failed]
        mid = np.median(cells) if cells else 0
        spread = max(6 * 1.4826 * np.median(np.abs(np.array(cells) - mid)), 0.1) if cells else 0
        for r in own:
            room = spread + 0.5 / max(len(r.text or ""), 1) ** 0.5
            if abs(abs(r.log_perplexity - mid) - room) > 0.002:
                assert r.kept == (not r.base_failed and abs(r.log_perplexity - mid) <= room), r


def test_a_model_in_parts_scores_alike(docs, monkeypatch):
    whole = sorted((str(r.doc_id), r.text or "", round(r.log_perplexity, 6), r.kept) for r in quality.assess(docs).collect())
    monkeypatch.setattr(quality, "PART", 1500)
    assert sorted((str(r.doc_id), r.text or "", round(r.log_perplexity, 6), r.kept) for r in quality.assess(docs).collect()) == whole


def test_a_callers_column_is_never_overwritten(docs):
    with pytest.raises(ValueError, match="kept"):
        quality.assess(docs.withColumn("Kept", docs.id))


def test_odd_text_is_rejected_and_prose_kept(spark):
    import random

    rng = random.Random(5)
    vocabulary = ["".join(rng.choice(["ta", "ne", "ri", "so", "mu", "ke"]) for _ in range(rng.randrange(1, 4))) for _ in range(500)]
    prose = [(k, " ".join(rng.choice(vocabulary) for _ in range(200)), "en") for k in range(200)]
    odd = [(900, " ".join("".join(rng.choice("qxzwvkj#%0123") for _ in range(6)) for _ in range(200)), "en")]
    got = {r.doc_id: r.kept for r in quality.assess(spark.createDataFrame(prose + odd, "doc_id long, text string, lang string")).collect()}
    assert not got[900] and sum(not got[k] for k in range(200)) == 0
