"""Toxicity by cumulative-link ordinal regression on sparse text features.

Grades are ordered: 0 for texts labelled clean, 1 to 3 for the lower, middle and upper third of the toxic texts by how
many of their words carry a selected term. One weight vector serves all thresholds:
``P(grade > k) = logistic(w x - t_k)`` with ``t_0 < t_1 < t_2``; the expected severity is the sum of the three.

Terms are lower-cased words (marked by a final ``$``) and their beginnings of 3 to 6 letters. Those count that occur
in at least ``MIN_TOXIC`` toxic texts of the sample and stand ``min_z`` standard errors above their share in clean
texts, the ``MAX_TERMS`` strongest. A term of ``SHARE`` of n toxic texts and no clean one stands about the root of
``SHARE * n`` above, so with few labels that suffices (4 at least, below which chance words pass; 6 from 450 toxic texts on). A
term's feature is the logarithm of its count.

The fit is a strictly convex problem, solved until its gradient is zero but for rounding: machines agree on the model. The
fewer texts, the stronger the penalty on weights.

The model is fitted on at most ``sample`` labelled texts: those of ids drawn by hash, one text of each id. Of texts with the
same smallest shingle hash (copies, and most near copies) one counts, else the chance words of a copied text look telling. Term counts
are summed by the executors, and only the selected terms' features of the sample come to the driver. Scoring covers
every row and whole texts, one pass without a shuffle.

Defined results: a null or empty text has no words and scores as such; several labels of one id count as their
largest, null labels and labels without a text not at all; rows with one id share the label, are scored each by itself, and
that whose text has the smallest hash stands for the id in the fit; texts of any length are read whole; without any toxic (or any clean) label nothing is learnt and every severity is 0; an empty table gives an empty
result. Only the named columns are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.columns import free
from corpusloom.llm.batches import bounded, emit
from corpusloom.llm.jaccard import shingles
from corpusloom.session import spread, written

#: Bounds of the model, and of the words that a task remembers.
SAMPLE, MAX_TERMS, MIN_TOXIC, WORDS_KEPT = 20_000, 4096, 3, 100_000
SHARE, LEAST_Z, MOST_Z = 0.08, 4.0, 6.0
RIDGE = 2e-4
GRADES = 3
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> Counter:
    """How often each lower-cased word occurs."""
    return Counter(_WORD.findall((text or "").lower()))


def terms(word: str) -> list[str]:
    """The word and its beginnings."""
    return [word + "$", *(word[:n] for n in (3, 4, 5, 6) if len(word) >= n)]


def min_z(n_toxic: int) -> float:
    """Standard errors that a term has to stand above its share in clean texts."""
    return min(MOST_Z, max(LEAST_Z, (SHARE * n_toxic) ** 0.5))


@dataclass
class Model:
    """Selected terms, the scale of their features, shared weights and ordered thresholds."""

    index: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray
    known: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def __getstate__(self):
        return {**self.__dict__, "known": {}}

    def hits(self, counts: Counter) -> tuple[dict[int, int], int]:
        """Count of each selected term, and of words with a selected term."""
        found: dict[int, int] = {}
        hit = 0
        known = self.known
        for word, n in counts.items():
            at = known.get(word)
            if at is None:
                at = tuple(self.index[t] for t in terms(word) if t in self.index)
                if len(known) >= WORDS_KEPT:
                    known.clear()
                known[word] = at
            if at:
                hit += n
                for i in at:
                    found[i] = found.get(i, 0) + n
        return found, hit

    def severity(self, text: str | None) -> tuple[float, ...]:
        """P(grade > k) for every threshold."""
        if not self.index:
            return (0.0,) * GRADES
        at, values = features(self.hits(words(text))[0])
        z = float(self.weights[at] @ values) - self.thresholds
        return tuple((1 / (1 + np.exp(-np.clip(z, -50, 50)))).tolist())


def features(found: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Positions and values of a text's features."""
    at = np.array(sorted(found), np.int64)
    return at, np.log1p(np.array([found[i] for i in at.tolist()], np.float64))


def fit_ordinal(rows: np.ndarray, at: np.ndarray, values: np.ndarray, grade: np.ndarray, n_features: int, steps: int = 100, ridge: float = RIDGE) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of the cumulative-link model over sparse features, by Newton steps until the gradient is zero but
    for rounding (at most ``steps`` of them).

    With ``u = z - t[grade - 1]`` and ``l = z - t[grade]`` the likelihood of a grade is ``s(u) * s(-l) * (1 - exp(l - u))``, ``s``
    being the logistic function; so the penalised loss is strictly convex and has one minimum, whatever machine looks for it.
    A grade that no text has weighs ``1e-6`` of all texts and thresholds have a slight ridge, which keep them apart and finite.
    """
    n, k = len(grade), GRADES
    spread = np.sqrt(np.maximum(np.bincount(at, values**2, n_features) / n - (np.bincount(at, values, n_features) / n) ** 2, 0)) + 0.05
    values = values / spread[at]
    with_upper, with_lower = grade > 0, grade < k
    upper, lower = np.maximum(grade - 1, 0), np.minimum(grade, k - 1)
    share = np.maximum(np.bincount(grade, minlength=k + 1)[1:k] / n, 1e-6)
    penalty = np.concatenate([np.full(n_features, ridge), np.full(k, 1e-5)])

    def summed(per_text: np.ndarray, weights: np.ndarray, t_upper: np.ndarray, t_lower: np.ndarray, gaps: np.ndarray) -> np.ndarray:
        thresholds = -(np.bincount(upper, t_upper, k) + np.bincount(lower, t_lower, k)) / n
        thresholds[1:] += gaps
        thresholds[:-1] -= gaps
        return np.concatenate([np.bincount(at, values * per_text[rows], n_features) / n, thresholds]) + penalty * weights

    def applied(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z = np.bincount(rows, values * p[:n_features][at], n)
        return z - p[n_features:][upper], z - p[n_features:][lower]

    def loss(p: np.ndarray) -> float:
        gaps = np.diff(p[n_features:])
        if (gaps <= 0).any():
            return np.inf
        u, v = applied(p)
        return float((np.logaddexp(0, -u) * with_upper + np.logaddexp(0, v) * with_lower).mean() - (share * np.log(-np.expm1(-gaps))).sum() + (penalty * p**2).sum() / 2)

    def logistic(x: np.ndarray) -> np.ndarray:
        return np.exp(-np.logaddexp(0, -x))

    over = (grade[:, None] > np.arange(k)).mean(0)
    base = np.clip(over, 1 / (2 * n), 1 - 1 / (2 * n))
    first = -np.log(base / (1 - base))
    p = np.concatenate([np.zeros(n_features), first[0] + np.concatenate([[0], np.cumsum(np.maximum(np.diff(first), 1e-2))])])
    now = loss(p)
    for _ in range(steps):
        u, v = applied(p)
        gaps = np.diff(p[n_features:])
        pull_u, pull_v = -logistic(-u) * with_upper, logistic(v) * with_lower
        gradient = summed(pull_u + pull_v, p, pull_u, pull_v, -share / np.expm1(gaps))
        size = np.sqrt(gradient @ gradient)
        if size < 1e-12:
            break
        curve_u, curve_v = logistic(u) * logistic(-u) * with_upper, logistic(v) * logistic(-v) * with_lower
        curve_gap = share / (4 * np.sinh(np.minimum(gaps, 600) / 2) ** 2)

        def bent(d: np.ndarray, curve_u=curve_u, curve_v=curve_v, curve_gap=curve_gap) -> np.ndarray:
            du, dv = applied(d)
            du, dv = curve_u * du, curve_v * dv
            return summed(du + dv, d, du, dv, curve_gap * np.diff(d[n_features:]))

        diagonal = np.concatenate([np.bincount(at, values**2 * (curve_u + curve_v)[rows], n_features) / n, (np.bincount(upper, curve_u, k) + np.bincount(lower, curve_v, k)) / n + np.append(curve_gap, 0) + np.append(0, curve_gap)]) + penalty
        # conjugate gradients for the step
        step, left = np.zeros_like(p), -gradient
        scaled = left / diagonal
        way, product = scaled, left @ scaled
        for _ in range(4 * len(p)):
            turned = bent(way)
            far = product / (way @ turned)
            step, left = step + far * way, left - far * turned
            if np.sqrt(left @ left) <= min(1e-3, size) * size:
                break
            scaled = left / diagonal
            product, earlier = left @ scaled, product
            way = scaled + product / earlier * way
        slope, length = gradient @ step, 1.0
        while (then := loss(p + length * step)) > now + 1e-4 * length * slope + 1e-14 * abs(now) and length > 1e-12:
            length /= 2
        p, now = p + length * step, then
    return p[:n_features] / spread, p[n_features:]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` of the labelled texts."""
    bounded(docs.sparkSession)
    told = labels.groupBy(F.col(f"`{id_col}`").alias("id")).agg(F.max((F.col(f"`{label_col}`") > 0).cast("int")).alias("toxic")).where("id IS NOT NULL AND toxic IS NOT NULL")
    plain = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    # ids in the order of a hash: the same ids at every run; the bound keeps the broadcast small
    ids = plain.select("id").distinct().join(told, "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(sample)
    drawn = told.join(F.broadcast(ids), "id")

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = [int(h[0]) >> 1 if len(h := shingles(text.as_py())) else 0 for text in batch.column(0)]
            yield pa.record_batch([*batch.columns, pa.array(least, pa.int64())], names=["text", "toxic", "id", "sketch"])

    found = spread(plain).join(F.broadcast(drawn), "id").select("text", "toxic", F.col("id").cast("string").alias("id"))
    sketched = found.mapInArrow(sketch, "text string, toxic int, id string, sketch bigint")
    # one text of each id, so that the bound on ids is one on texts
    sketched = sketched.groupBy("id").agg(F.min_by(F.struct("text", "toxic", "sketch"), F.struct(F.xxhash64("text"), "text")).alias("s")).select("s.*", "id")
    texts = written(sketched.groupBy("sketch").agg(F.min_by(F.struct("text", "toxic"), F.struct(-F.col("toxic"), "id", "text")).alias("s"), F.min("id").alias("id")).select("s.text", "s.toxic", "id"), "toxicity-sample")
    sizes = dict(texts.groupBy("toxic").count().collect())
    none = Model({}, np.zeros(0), np.arange(GRADES, dtype=float))
    if not sizes.get(0) or not sizes.get(1):
        return none
    n1, n0 = sizes[1], sizes[0]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("term", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])
        for batch in batches:
            found: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found[toxic].update({t for w in words(text) for t in terms(w)})
            yield from emit(((t, found[1][t], found[0][t]) for t in {**found[0], **found[1]}), schema)

    z = "(toxic / {n1} - clean / {n0}) / sqrt((toxic + clean) / {n} * (1 - (toxic + clean) / {n}) * (1 / {n1} + 1 / {n0}) + 1e-12)".format(n1=n1, n0=n0, n=n1 + n0)
    counted = texts.select("text", "toxic").mapInArrow(count, "term string, toxic bigint, clean bigint").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    best = counted.where(F.col("toxic") >= MIN_TOXIC).withColumn("z", F.expr(z)).where(F.col("z") >= min_z(n1)).orderBy(F.desc("z"), "term").limit(MAX_TERMS).select("term").collect()
    if not best:
        return none
    model = Model({r.term: i for i, r in enumerate(best)}, np.zeros(0), np.zeros(0))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.string()), ("toxic", pa.int64()), ("at", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("hit", pa.int64())])

        def rows():
            for batch in batches:
                for key, text, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    found, hit = model.hits(words(text))
                    yield key, toxic, list(found), list(found.values()), hit

        yield from emit(rows(), schema)

    described = texts.select("id", "text", "toxic").mapInArrow(describe, "id string, toxic bigint, at array<bigint>, n array<bigint>, hit bigint")
    sampled = sorted(described.collect(), key=lambda r: (r.id, r.hit, sorted(r.at)))
    hit = np.array([r.hit for r in sampled])
    toxic = np.array([r.toxic for r in sampled])
    thirds = np.quantile(hit[toxic == 1], [1 / 3, 2 / 3])
    grade = np.where(toxic == 1, 1 + (hit > thirds[0]) + (hit > thirds[1]), 0)
    each = [features(dict(zip(r.at, r.n, strict=True))) for r in sampled]
    rows = np.repeat(np.arange(len(each)), [len(a) for a, _ in each])
    model.weights, model.thresholds = fit_ordinal(rows, np.concatenate([a for a, _ in each]), np.concatenate([v for _, v in each]), grade, len(best), ridge=RIDGE + 0.4 / len(grade))
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_severity`` (expected grade, 0 to 3) and ``_toxic`` (probability of any grade over 0) as the last two
    columns, with more underscores if the names are taken."""
    bounded(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_TERMS terms
    added = free(docs, "_severity", "_toxic")
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # mapInArrow takes no dots in names
    names, types = [*plain.columns, *added], [to_arrow_type(f.dataType) for f in docs.schema]
    at = docs.columns.index(text_col)
    schema = T.StructType([*plain.schema.fields, *(T.StructField(c, T.DoubleType()) for c in added)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = replace(shared.value, known={})  # the words remembered go with the task
        for batch in batches:
            p = [known.severity(text.as_py()) for text in batch.column(at)]
            columns = [c if c.type == t else c.cast(t) for c, t in zip(batch.columns, types, strict=True)]
            yield pa.record_batch([*columns, pa.array([sum(x) for x in p], pa.float64()), pa.array([x[0] for x in p], pa.float64())], names=names)

    return spread(plain).mapInArrow(run, schema).toDF(*docs.columns, *added)
