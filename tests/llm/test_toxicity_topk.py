"""Toxicity on held-out labels, the ordinal fit's gradient, and exact top-k against all scores."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import topk, toxicity


def made(n, seed):
    rng = random.Random(seed)
    clean, bad = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)], ["vile", "nasty", "grossly", "foulish"]
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.2
        words = rng.choices(clean, k=rng.randrange(20, 200))
        if toxic:
            for _ in range(rng.randrange(2, 8)):
                words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((i, " ".join(words), "x"))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_labels(spark):
    rows, labels = made(1500, 1)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _x string")
    told = spark.createDataFrame(labels[:1000] + [(0, None), (None, 1), (9999, 1)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, told)
    assert (np.diff(model.thresholds) > 0).all()
    found = toxicity.score(docs, model)
    assert found.columns[:3] == ["doc_id", "text", "_x"]
    got = {r.doc_id: (r._toxic >= 0.5, r._severity) for r in found.collect()}
    truth = dict(labels)
    held = range(1000, 1500)
    assert sum(got[i][0] == bool(truth[i]) for i in held) >= 495
    assert np.mean([got[i][1] for i in held if truth[i]]) > 1 > np.mean([got[i][1] for i in held if not truth[i]])
    again = toxicity.fit(docs.repartition(7), told)
    assert again.index == model.index and np.allclose(again.weights, model.weights)


def test_sample_is_bounded_and_edges_are_defined(spark):
    rows, labels = made(400, 2)
    docs = spark.createDataFrame(rows + [(1, None, "x"), (None, None, "y"), (5000, "", "z"), (5001, "vile " * 200_000, "z")], "doc_id bigint, text string, toxic string")
    told = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.fit(docs, told, sample=200)
    found = toxicity.score(docs, model)
    assert found.count() == len(rows) + 4 and found.where("_severity IS NULL OR isnan(_severity)").count() == 0
    assert found.where("text IS NULL OR text = ''").select("_severity").distinct().count() == 1
    assert toxicity.score(docs.limit(0), model).count() == 0
    for part in (told.limit(0), told.where("toxic = 1"), told.where("toxic = 0")):
        assert toxicity.score(docs, toxicity.fit(docs, part)).agg(F.max("_severity")).first()[0] == 0


def test_one_text_of_each_id_is_learnt(spark, monkeypatch):
    """An id with many texts counts once, so the driver gets no more rows than the sample has ids."""
    rows, labels = made(300, 3)
    rows += [(7, f"other text {i} of one id " + "word " * (i % 9), "x") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _x string").repartition(5)
    seen = []
    monkeypatch.setattr(toxicity, "fit_ordinal", lambda r, at, v, grade, n, **k: seen.append(len(grade)) or (np.zeros(n), np.arange(3.0)))
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"), sample=250)
    assert model.index and seen and seen[0] <= 250


def test_scores_by_plain_recomputation(spark):
    """Every severity from the model's weights and each text's terms, counted one by one."""
    import math
    import re

    rows, labels = made(400, 5)
    rows += [(9000, None, "x"), (9001, "", "x"), (9002, "VILE vile vileness 123 nasty_word", "x"), (9003, "nasty " * 3000, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _x string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    got = {r.doc_id: (r._severity, r._toxic) for r in toxicity.score(docs, model).collect()}
    for i, text, _ in rows:
        counts = {}
        for w in re.findall(r"[^\W\d_]+", (text or "").lower()):
            for t in [w + "$"] + [w[:n] for n in range(3, 7) if len(w) >= n]:
                counts[t] = counts.get(t, 0) + 1
        z = sum(math.log(1 + n) * model.weights[model.index[t]] for t, n in counts.items() if t in model.index)
        p = [1 / (1 + math.exp(min(50, max(-50, t - z)))) for t in model.thresholds]
        assert got[i] == pytest.approx((sum(p), p[0]), abs=1e-9)


def test_gradient_is_that_of_the_likelihood(monkeypatch):
    """The fit ends where no small change of a weight or threshold raises the penalised likelihood."""
    rng = np.random.default_rng(2)
    n, d = 500, 3
    x = rng.random((n, d))
    grade = ((x @ [4.0, -3, 1] + rng.logistic(size=n))[:, None] > np.array([0.0, 1.0, 2.0])).sum(1)
    w, t = toxicity.fit_ordinal(np.repeat(np.arange(n), d), np.tile(np.arange(d), n), x.ravel(), grade, d, ridge=1e-3)
    scale = x.std(0) + 0.05

    def loss(w, t):
        above = 1 / (1 + np.exp(-((x @ w)[:, None] - t)))
        s = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], 1)
        return -np.log(s[np.arange(n), grade] - s[np.arange(n), grade + 1]).mean() + 1e-3 / 2 * ((w * scale) ** 2).sum()

    best = loss(w, t)
    for step in (0.02, -0.02):
        assert all(loss(w + step * np.eye(d)[i], t) > best for i in range(d)) and all(loss(w, t + step * np.eye(3)[i]) > best for i in range(3))


@pytest.mark.parametrize("missing", [(), (2,), (1, 2), (3,), (0,)])
def test_other_roundings_give_the_same_model(missing):
    """Inputs that differ as other machines' roundings do give the model to 1e-6, and its gradient is zero; grades may be missing."""
    rng = np.random.default_rng(6)
    n, d = 800, 60
    x = np.log1p(rng.poisson(0.3, (n, d)))
    grade = ((x @ rng.normal(size=d) * 3 + rng.logistic(size=n))[:, None] > np.array([0.0, 1.0, 2.0])).sum(1)
    grade[np.isin(grade, missing)] = 3 if 0 in missing else 0
    rows, at = np.nonzero(x)
    w, t = toxicity.fit_ordinal(rows, at, x[rows, at], grade, d)
    assert np.isfinite(w).all() and (np.diff(t) > 0).all()
    for size in (1e-15, 1e-13, 1e-11):
        w2, t2 = toxicity.fit_ordinal(rows, at, x[rows, at] * (1 + size * rng.normal(size=len(at))), grade, d)
        assert np.abs(w - w2).max() < 1e-6 and np.abs(t - t2).max() < 1e-6 * max(1, np.abs(t).max())
    order = rng.permutation(len(at))
    w2, t2 = toxicity.fit_ordinal(rows[order], at[order], x[rows, at][order], grade, d)
    assert np.abs(w - w2).max() < 1e-6 and np.abs(t - t2).max() < 1e-6 * max(1, np.abs(t).max())


def test_few_labels_are_learnt_from(spark):
    """With 60 labelled texts, terms of a few of them count, and what clean texts have doesn't."""
    rng = np.random.default_rng(7)
    plain = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(60):
        text = list(rng.choice(plain, 40)) + ([["vile"], ["nasty"], ["foul", "foul"]][i // 5 % 3] if i % 5 == 0 else [])
        rows.append((i, " ".join(text), int(i % 5 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int"))
    toxic = {r.doc_id for r in toxicity.score(docs, model).where("_toxic >= 0.5").collect()}
    assert toxic == {r[0] for r in rows if r[2]}


def test_ordinal_fit_recovers_thresholds():
    rng = np.random.default_rng(0)
    n, d = 4000, 6
    x = (rng.random((n, d)) < 0.5) * 1.0
    z = x @ np.array([3.0, -2, 1, 0, 0, 0]) + rng.logistic(size=n)
    grade = (z[:, None] > np.array([0.0, 1.5, 3.0])).sum(1)
    at = np.tile(np.arange(d), n)
    w, t = toxicity.fit_ordinal(np.repeat(np.arange(n), d), at, x.ravel(), grade, d, ridge=1e-6)
    assert np.allclose(w, [3, -2, 1, 0, 0, 0], atol=0.35) and np.allclose(t, [0, 1.5, 3], atol=0.35)


def brute_top(rows, k, wanted):
    usable = {i: [int(x) for x in np.floor(64 * np.array(v, np.float64))] for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for q in sorted(i for i in usable if wanted(i)):
        scores = sorted((-sum(a * b for a, b in zip(usable[q], v, strict=False)), i) for i, v in usable.items() if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return out


@pytest.mark.parametrize("scale", [1, 1e7, 1e30])
@pytest.mark.parametrize("group_rows", [64, 16_384])
def test_top_k(spark, monkeypatch, scale, group_rows):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    monkeypatch.setattr(topk, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(topk, "PACK_ROWS", 4)
    monkeypatch.setattr(topk, "PACKS_TOGETHER", 2)
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(size=5) * (scale if i % 3 else 1)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(50)]  # ties
    rows += [(2000, None), (2020, [1.0, None, 2.0]), (2040, [float("nan")] * 5), (2060, [float("inf"), 1.0]), (2080, [1.0, 2.0]), (2100, []), (None, [1.0] * 5)]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<float>, score int").repartition(5)
    found = topk.top_k(table, F.col("id") % 20 == 0, 7)
    want = [(q, r, v, max(-topk.LONGEST, min(topk.LONGEST, s))) for q, r, v, s in brute_top(rows, 7, lambda i: i % 20 == 0)]
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect()) == want


def test_repeated_rows_of_vectors(spark):
    """Every row with a query's id is a query, its candidates all rows of other ids, each row by itself."""
    rows = [(0, [1.0]), (0, [-1.0]), (1, [2.0]), (1, [2.0]), (2, [3.0])]
    found = topk.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), F.col("id") == 0, 2).collect()
    up, down = 64 * 64, -64 * 64
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found) == [(0, 1, 1, 2 * down), (0, 1, 2, 3 * up), (0, 2, 1, 2 * down), (0, 2, 1, 2 * up)]


def test_sort_keys():
    rng = np.random.default_rng(1)
    numbers = [0, 1, -1, 9, 10, -9, -10, 10**40, -(10**40), 10**40 + 1] + [int(x) * 10 ** int(e) for x, e in zip(rng.integers(-999, 999, 50), rng.integers(0, 60, 50), strict=True)]
    assert sorted(numbers) == sorted(numbers, key=topk.sort_key)


def test_known_scores_stop_a_search():
    rng = np.random.default_rng(4)
    docs = [(np.arange(20) + 20 * b, np.rint(rng.normal(size=(20, 8)) * 100)) for b in range(30)]
    q = np.rint(rng.normal(size=(5, 8)) * 100)
    at, _, score, all_blocks = topk.search_blocks(docs, np.full(5, -1), q, 3)
    kth = [min(s for a, s in zip(at.tolist(), score, strict=True) if a == i) for i in range(5)]
    again = topk.search_blocks(docs, np.full(5, -1), q, 3, kth)
    assert (again[0].tolist(), again[2]) == (at.tolist(), score) and again[3] <= all_blocks
    none = topk.search_blocks(docs, np.full(5, -1), q, 3, [10**9] * 5)
    assert not len(none[0]) and none[3] == 0


def test_blocks_are_pruned():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 8)) * 100
    docs = [(np.arange(20) + 20 * b, np.rint(c + rng.normal(size=(20, 8))).astype(np.int64)) for b, c in enumerate(centres)]
    q = np.rint(centres[:5]).astype(np.int64)
    at, doc, score, scored = topk.search_blocks(docs, np.full(5, -1), q, 10)
    assert len(at) == 50 and scored < 5 * 30 / 2


def test_few_rows(spark):
    table = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(table, F.col("id") % 20 == 0).collect()] == [(0, 1, 1, 64 * 128)]
    assert topk.top_k(table.limit(0), F.lit(True)).count() == 0 and topk.top_k(table, F.lit(False)).count() == 0
    assert topk.top_k(table.limit(1), F.lit(True)).count() == 0
