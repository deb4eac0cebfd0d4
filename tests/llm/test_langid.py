"""Language models against Kneser-Ney's formulas, and languages on held-out texts."""

import math
import random
from collections import Counter, defaultdict
from functools import lru_cache
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import catalog, langid

SF = "/root/testdata/sf0.01"


def plain_model(found, order):
    """Probability of a character behind others, by recursion."""
    levels = {order: Counter()}
    for w in found:
        whole = "\x02" * (order - 1) + w + "\x03"
        levels[order].update(whole[i : i + order] for i in range(len(w) + 1))
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    discount, total, kinds = {}, {}, {}
    for k, of in levels.items():
        n1, n2 = sum(n == 1 for n in of.values()), sum(n == 2 for n in of.values())
        discount[k] = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        total[k], kinds[k] = defaultdict(int), defaultdict(int)
        for g, n in of.items():
            total[k][g[:-1]] += n
            kinds[k][g[:-1]] += 1
    base = 1 / (len(levels[1]) + 1)

    @lru_cache(maxsize=None)
    def p(gram):
        k = len(gram)
        if not k:
            return base
        context = gram[:-1]
        if not total[k][context]:
            return p(gram[1:])
        return max(levels[k][gram] - discount[k], 0) / total[k][context] + discount[k] * kinds[k][context] / total[k][context] * p(gram[1:])

    return p, levels[1]


@pytest.mark.parametrize("order", [2, 3, 5])
def test_model_is_kneser_ney(order, monkeypatch):
    rng = random.Random(order)
    found = ["".join(rng.choice("abcdé𝕏") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    p, known = plain_model(found, order)
    counts = Counter(("\x02" * (order - 1) + w + "\x03")[i : i + order] for w in found for i in range(len(w) + 1))
    model = langid.kneser_ney(list(counts), list(counts.values()), order)
    tried = found[:40] + ["zzz", "abzq", "aaaaaaaaaaaa", "é", "𝕏𝕏"]
    windows, of = langid.word_windows(tried, order)
    got = np.bincount(of, model.scores(windows), len(tried))
    for w, score in zip(tried, got, strict=True):
        whole = "\x02" * (order - 1) + w + "\x03"
        assert score == pytest.approx(sum(math.log(p(whole[i : i + order])) for i in range(len(w) + 1)), abs=1e-9)
    # the chances of all characters behind a context and of the unseen one are one
    for context in ("\x02" * (order - 1), "a" * (order - 1), "q" * (order - 1)):
        each = langid.as_codes([context + c for c in [*known, "q"]])
        assert np.exp(model.scores(each)).sum() == pytest.approx(1)


def test_words_look_up_each_gram_once(monkeypatch):
    model = langid.Model(["a"], [langid.kneser_ney(["\x02\x02\x02\x02a", "\x02\x02\x02ab"], [2, 1])], np.zeros((1, 2)), (0.0, 1.0, 0.0))
    plain, rows = langid.CharModel.scores, []
    monkeypatch.setattr(langid.CharModel, "scores", lambda self, windows: rows.append(len(windows)) or plain(self, windows))
    found = ["abc", "abd", "é", "abc"]
    windows, of = langid.word_windows(found)
    want = np.bincount(of, -plain(model.models[0], windows), len(found))
    assert model.word_scores(found)[:, 0].tolist() == want.tolist()
    assert rows == [len(np.unique(windows, axis=0))] and rows[0] < len(windows)


def test_words_are_of_letters():
    assert langid.words("Ab1c_D½e  ÉÀ 中文! x²") == ["ab", "c", "d", "e", "éà", "中文", "x"]
    assert langid.words(None) == langid.words("") == langid.words("12 ½ _ ²!") == []


def languages(n, seed):
    rng = random.Random(seed)
    kinds = {"aa": "ka ki ko ta to mi na".split(), "bb": "str eng ung ich ach ein".split(), "c.c": "ção ões lha mento e o".split()}
    rows = []
    for i in range(n):
        lang = rng.choice(list(kinds))
        rows.append((i, " ".join("".join(rng.choice(kinds[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(3, 60))), lang, "x", 1.0))
    return rows


SCHEMA = "doc_id bigint, text string, lang string, lang_pred string, score double"


def test_unusual_rows(spark):
    rows = languages(300, 1)
    odd = [(-1, None, "aa", "x", 1.0), (-2, "", None, "x", 1.0), (-3, "12 34 !", "bb", "x", 1.0), (None, "kakitomi", None, None, None), (-4, "strengung ein " * 20000, None, "x", 1.0), (-5, "漢字", None, "x", 1.0), (-5, "漢字", None, "x", 1.0)]
    docs = spark.createDataFrame(rows + odd, SCHEMA).repartition(5)
    model = langid.fit(docs, F.col("doc_id") % 2 == 0)
    assert model.langs == ["aa", "bb", "c.c"]
    found = langid.predict(docs, model)
    assert found.columns == ["doc_id", "lang", "lang_pred", "score", "lang_pred_", "score_", "cross_entropy", "rejected"]
    got = found.collect()
    by_id = defaultdict(list)
    for r in got:
        by_id[r.doc_id].append(r)
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score_ <= 1 for r in got)
    assert all(by_id[i][0].lang_pred_ == lang for i, _, lang, *_ in rows)
    assert all(tuple(by_id[i][0])[4:] == ("und", 0.0, None, False) for i in (-1, -2, -3))
    assert by_id[None][0].lang_pred_ == "aa" and by_id[-4][0].lang_pred_ == "bb" and by_id[-4][0].score_ > 0.9
    assert by_id[-5][0] == by_id[-5][1] and by_id[-5][0].rejected and by_id[-5][0].score_ < 0.6 and not by_id[-4][0].rejected


def test_little_to_learn_from(spark):
    docs = spark.createDataFrame(languages(40, 2), SCHEMA)
    for learn, langs in ((F.lit(False), []), (F.col("lang") == "aa", ["aa"])):
        model = langid.fit(docs, learn)
        assert model.langs == langs
        assert {r[0] for r in langid.predict(docs, model).select("lang_pred_").collect()} == set(langs or ["und"])
    assert langid.fit(docs.limit(0), F.lit(True)).langs == [] and langid.predict(docs.limit(0), langid.fit(docs, F.lit(True))).count() == 0
    numbers = docs.withColumn("text", F.lit("1 2 3"))
    assert langid.fit(numbers, F.lit(True)).langs == []


def test_texts_are_drawn_alike_at_every_order_of_rows(spark):
    docs = spark.createDataFrame(languages(400, 3) * 2, SCHEMA)
    one, two = (langid.fit(d, F.lit(True), sample=90) for d in (docs.repartition(7), docs.orderBy(F.desc("text"))))
    assert one.langs == two.langs and one.curve == pytest.approx(two.curve)
    assert all(np.array_equal(a, b) for m, o in zip(one.models, two.models, strict=True) for a, b in zip(m.hashes, o.hashes, strict=True))
    assert all(np.allclose(a, b) for m, o in zip(one.models, two.models, strict=True) for a, b in zip(m.chances, o.chances, strict=True))


@pytest.mark.skipif(not Path(SF).exists(), reason="needs the test tables")
def test_held_out_accuracy(spark):
    import zlib

    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    found = catalog.op13_language_id(spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    held = [r for r in found if r.held_out]
    right = [r.lang_pred == truth[r.doc_id] for r in held]
    assert len(found) == len(truth) and sum(right) >= 0.99 * len(held) and sum(r.score for r in held) >= 0.95 * len(held)
