"""Phrase collocations against counts of every n-gram, one by one."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from corpusloom.llm import phrases

SCHEMA = "doc_id bigint, text string, lang string, n string, phrase bigint"


def brute(rows, words=3, least=10, inside=50, top=2000):
    counts, totals = {}, Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            of = counts.setdefault(lang, Counter())
            of.update(tuple(w[i : i + k]) for k in range(1, words + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, of in counts.items():
        candidates = {p: a for p, a in of.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) and 100 * b >= inside * a for q, b in candidates.items()):
                continue
            score, k = min((1000000 * a * a // (of[p[:k]] * of[p[k:]]), k) for k in range(1, len(p)))
            found.append((score, a, " ".join(p), of[p[:k]], of[p[k:]]))
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i + 1, p, a, left, right, totals[lang], score) for i, (score, a, p, left, right) in enumerate(found[:top])]
    return sorted(out)


def run(spark, rows, **more):
    found = phrases.collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), **more)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in found.collect())


def made(n, seed, vocabulary=12):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["New", "York", "ÄÖ", "äö", "a b", "x\x1fy"]
    joints = [" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "!", "\x0b", " ; "]
    rows = [(i, "".join(rng.choice(words) + rng.choice(joints) for _ in range(rng.randint(0, 60))), rng.choice(["en", "de", None, "und", "x\ny"]), "c", 1) for i in range(n)]
    rows += [(n + i, "The same very text, over and over again", "en", "c", 1) for i in range(40)]
    return rows + [(-1, None, "en", None, None), (-2, "", None, None, None), (-3, " \t\n.,", "zz", None, None), (-4, "long " * 5000, "en", None, None), (-4, "long " * 5000, "en", None, None)]


@pytest.mark.parametrize("shard", [1 << 21, 50])
def test_collocations(spark, monkeypatch, shard):
    monkeypatch.setattr(phrases, "SHARD_WORDS", shard)
    monkeypatch.setattr(phrases, "EMIT_ROWS", 64)
    rows = made(150, 3)
    assert run(spark, rows) == brute(rows)


def test_a_full_bitmap_changes_nothing(spark, monkeypatch):
    """Chance marks let n-grams through that are counted and then dropped."""
    rows = made(80, 9, vocabulary=6)
    for bits in (64, 256):
        monkeypatch.setattr(phrases, "BITS", bits)
        assert run(spark, rows, least=6) == brute(rows, least=6)


def test_runs_that_are_left():
    ids = np.array([1, 2, 3, 4, 0, 5, 6, 7, 8, 9, 1, 0, 2, 3])
    marked = np.array([1, 1, 0, 1, 0, 1, 1, 0, 1, 1, 0, 0, 1, 0], bool)
    left = phrases.reduced(ids, marked, 3).tolist()
    assert left == [1, 2, 3, 0, 5, 6, 7, 8, 9, 1]  # 5 6 7 and 8 9 1 touch, so no end between them
    assert phrases.reduced(ids[:2], marked[:2], 3).tolist() == [] and phrases.reduced(ids, np.zeros(14, bool), 3).tolist() == []


def test_longer_phrases_and_few_rows(spark):
    rows = made(60, 4, vocabulary=3)
    for more in ({"words": 5, "least": 4, "top": 7}, {"words": 2, "least": 1}, {"words": 4, "least": 3, "inside": 80}):
        assert run(spark, rows, **more) == brute(rows, **more)
    assert run(spark, [], least=1) == [] and run(spark, [(1, None, None, None, None)], least=1) == []


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 8])
def test_suffix_array_and_intervals(n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, 4, 400).astype(np.int32)
    key = lambda i: tuple(ids[i : i + n].tolist())
    order = phrases.suffix_array(ids, n)
    assert [key(i) for i in order] == sorted(map(key, range(len(ids))))
    want = Counter(k for i in range(len(ids)) for size in range(1, n + 1) if 0 not in (k := tuple(ids[i : i + size].tolist())) and len(k) == size)
    got = {tuple(ids[i : i + k].tolist()): int(c) for k, at, size in phrases.ngram_counts(ids, n) for i, c in zip(at, size, strict=True)}
    assert got == want
    assert [(k, len(at)) for k, at, _ in phrases.ngram_counts(ids[:0], 2)] == [(1, 0), (2, 0)]


def test_scores_are_exact(spark, monkeypatch):
    """Products beyond 64 bits: counts of a thousand million."""
    table = spark.sql("SELECT 'en\\n' AS phrase, 9000000000000L AS n UNION ALL SELECT 'en\\na', 3000000000007L UNION ALL SELECT 'en\\nb', 3000000000011L UNION ALL SELECT 'en\\na b', 2999999999999L")
    monkeypatch.setattr(phrases, "counted", lambda *a: table)
    (row,) = phrases.collocations(table, words=2).collect()
    assert row.score == 10**6 * 2999999999999**2 // (3000000000007 * 3000000000011) and row.a == 2999999999999
