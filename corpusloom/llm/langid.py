"""Language identification by interpolated Kneser-Ney models of characters.

Texts are lower-cased words of letters. A language's model gives the probability of a word's letters and of its end, each after up
to ``ORDER - 1`` characters before it in the word. The longest n-grams are discounted counts, shorter ones count the characters
they were seen behind; each order is interpolated with the next shorter one, the last with equal chances for all characters. The
models' n-grams are 64-bit hashes in sorted arrays, one for each language and order, beside their log probabilities, and so are
contexts beside the logs of the weight that they leave to shorter ones. A word is looked up once in a task; a text's cross-entropy is the sum over
its words, divided by its characters (ends of words count), and the language with the lowest one is told, the first by name of ties.

The models are fitted on at most ``SAMPLE`` distinct texts, shared out evenly among the languages, drawn by the texts' hashes: the
n-grams' counts are made by the executors, and of each language the ``GRAMS / languages`` commonest of the longest n-grams come to the
driver. Of more than ``LANGS`` languages the commonest are learnt. A fourth of the drawn texts is left out of the counts and
calibrates: by it a logistic curve turns the margin to the second language, a text's size taken into account, into the chance that
the language is right. A text is ``rejected``, and its chance halved, if its cross-entropy lies farther over the language's median
than ``ACCEPTED`` of that language's calibrating texts do and a half more, distances being weighed by the root of the characters (of
``EVEN`` at the most, as longer texts differ by what they are about).
Prediction covers every row and whole texts in one pass without a shuffle.

Defined results: a text without a letter (null and empty ones too) is ``und`` with score 0, not rejected; without any learnt language
every text is; with one, it is told for all texts with letters; texts of any length are read whole; equal texts get equal rows;
null ids and repeated rows are kept; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.columns import free, named
from corpusloom.llm.batches import bounded, emit
from corpusloom.session import spread, written

#: Characters of an n-gram, texts that the models are fitted on, n-grams of all models of the longest order, languages.
ORDER, SAMPLE, GRAMS, LANGS = 5, 8000, 1_000_000, 250
#: Share of a language's own texts that aren't rejected, characters that weigh a distance, words that a task remembers, and scores at a time.
ACCEPTED, EVEN, WORDS_KEPT, WORDS_SCORED = 0.999, 200, 300_000, 1 << 14

_WORD = re.compile(r"[^\W\d_]+")
#: Characters before and behind a word; no letters.
_BEFORE, _BEHIND = "\x02", "\x03"


def words(text: str | None) -> list[str]:
    """The lower-cased words of letters."""
    found = _WORD.findall((text or "").lower())
    if all(map(str.isalpha, found)):
        return found
    return [w for f in found for w in "".join(c if c.isalpha() else " " for c in f).split()]


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of characters."""
    h = np.full(len(codes), 0x9E3779B97F4A7C15, np.uint64)
    for k in range(codes.shape[1]):
        h = (h ^ (codes[:, k].astype(np.uint64) + np.uint64(1))) * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(29)
    h *= np.uint64(0x165667B19E3779F9)
    return h ^ (h >> np.uint64(32))


def look_up(known: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each hash is in the sorted array, and where."""
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    return known[at] == h, at


def as_codes(grams: list[str]) -> np.ndarray:
    """Equally long strings as rows of code points."""
    return np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(grams), -1)


@dataclass
class CharModel:
    """One language: by order n-grams' sorted hashes and log probabilities, contexts' sorted hashes and log weights of what is
    shorter; and the log probability of an unseen character."""

    hashes: list[np.ndarray]
    chances: list[np.ndarray]
    contexts: list[np.ndarray]
    weights: list[np.ndarray]
    unseen: float

    def scores(self, windows: np.ndarray) -> np.ndarray:
        """Log probability of the last character of each row after the others."""
        out = np.full(len(windows), self.unseen)
        order = windows.shape[1]
        for k in range(1, order + 1):
            if k > 1:
                found, at = look_up(self.contexts[k - 1], gram_hashes(windows[:, order - k : order - 1]))
                out = out + np.where(found, self.weights[k - 1][at], 0)
            found, at = look_up(self.hashes[k - 1], gram_hashes(windows[:, order - k :]))
            out = np.where(found, self.chances[k - 1][at], out)
        return out


def kneser_ney(grams: list[str], counts: list[int], order: int = ORDER) -> CharModel:
    """The interpolated model of n-grams of the longest order and their counts. A discount is ``n1 / (n1 + 2 n2)`` of its order."""
    now, n = as_codes(grams), np.array(counts, np.float64)
    levels = []  # from the longest order down: rows of codes, counts
    for k in range(order, 0, -1):
        levels.append((now, n))
        if k > 1:  # the next shorter n-grams count the characters that they were seen behind
            now, n = np.unique(now[:, 1:], axis=0, return_counts=True)
            n = n.astype(np.float64)
    levels.reverse()
    # one more for what was never seen
    shorter, base = np.zeros(0), 1 / (len(levels[0][0]) + 1)
    model = CharModel([], [], [], [], 0.0)
    for k, (codes, n) in enumerate(levels, 1):
        n1, n2 = float((n == 1).sum()), float((n == 2).sum())
        discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        context, of = np.unique(codes[:, :-1], axis=0, return_inverse=True) if k > 1 else (codes[:1, :0], np.zeros(len(codes), np.int64))
        of = of.reshape(-1)
        total = np.bincount(of, n)
        left = discount * np.bincount(of) / total
        p = (n - discount) / total[of] + left[of] * (shorter[look_up(model.hashes[-1], gram_hashes(codes[:, 1:]))[1]] if k > 1 else base)
        if k == 1:
            model.unseen = float(np.log(left[0] * base))
        for h, value, by, beside in ((gram_hashes(codes), p, model.hashes, model.chances), (gram_hashes(context), left, model.contexts, model.weights)):
            place = np.argsort(h)
            by.append(h[place])
            beside.append(np.log(value[place]))
        shorter = np.exp(model.chances[-1])
    return model


def word_windows(found: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """For each character of the words and each end: the ``order`` characters up to it; and the number of its word."""
    padded = "".join(_BEFORE * (order - 1) + w + _BEHIND for w in found)
    codes = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(w) + 1 for w in found], np.int64)
    of = np.repeat(np.arange(len(found)), sizes)
    ends = np.arange(sizes.sum()) + (of + 1) * (order - 1)
    return codes[ends[:, None] + np.arange(1 - order, 1)], of


@dataclass
class Model:
    """The languages in order of name, their models, and what calibrates them."""

    langs: list[str]
    models: list[CharModel]
    usual: np.ndarray  # median by language of texts' cross-entropies, and the farthest over it, times the root of the characters
    curve: tuple[float, float, float]  # chance that a language is right: constant, by the margin, by the log of the characters

    def word_scores(self, found: list[str]) -> np.ndarray:
        """Cross-entropies of words by language, in nats, and their characters in the last column."""
        out = np.zeros((len(found), len(self.models) + 1))
        if found:
            windows, of = word_windows(found)
            # words share most of their n-grams: each is looked up once
            _, first, at = np.unique(gram_hashes(windows), return_index=True, return_inverse=True)
            windows = windows[first]
            for j, m in enumerate(self.models):
                out[:, j] = np.bincount(of, -m.scores(windows)[at], len(found))
            out[:, -1] = np.bincount(of, minlength=len(found))
        return out

    def judged(self, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For texts' sums of word scores: number of the best language, its cross-entropy for a character, the margin and the number of characters."""
        n = sums[:, -1]
        each = sums[:, :-1] / np.maximum(n, 1)[:, None]
        best = each.argmin(1)
        lowest = each[np.arange(len(each)), best]
        second = np.partition(each, 1, axis=1)[:, 1] if each.shape[1] > 1 else lowest + 10
        return best, lowest, second - lowest, n

    def told(self, sums: np.ndarray) -> Iterator[tuple[str, float, float | None, bool]]:
        """Language, chance that it is right, cross-entropy and whether it is rejected."""
        if not self.langs:
            yield from (("und", 0.0, None, False) for _ in sums)
            return
        best, lowest, margin, n = self.judged(sums)
        a, b, c = self.curve
        chance = 1 / (1 + np.exp(-np.clip(a + b * margin * np.sqrt(n) + c * np.log1p(n), -30, 30)))
        over = (lowest - self.usual[best, 0]) * np.sqrt(np.minimum(n, EVEN)) > self.usual[best, 1]
        chance = np.where(over, chance / 2, chance)
        for i, size in enumerate(n.tolist()):
            yield (self.langs[best[i]], float(chance[i]), float(lowest[i]), bool(over[i])) if size else ("und", 0.0, None, False)


def logistic_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic regression by Newton steps, the first column being the constant."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), gradient)
        w = w - np.clip(step, -5, 5)
        if np.abs(gradient).max() < 1e-9:
            break
    return w


def fit(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` texts of the rows where ``learn`` holds and the language isn't null."""
    bounded(docs.sparkSession)
    plain = docs.where(learn).select(named(text_col).cast("string").alias("text"), named(lang_col).cast("string").alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL").withColumn("h", F.xxhash64("text"))
    langs = sorted(r.lang for r in plain.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(min(LANGS, sample)).collect())
    none = Model([], [], np.zeros((0, 2)), (0.0, 0.0, 0.0))
    if not langs:
        return none
    # each language's texts of the smallest hashes, one of each: hashes are ranked, texts stay where they are
    ranked = plain.select("lang", "h").where(F.col("lang").isin(langs)).distinct().withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("rank") <= sample // len(langs))
    texts = plain.join(F.broadcast(ranked.select("lang", "h")), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))
    texts = written(texts, "langid-sample")
    calibrates = F.pmod(F.xxhash64("h"), F.lit(4)) == 0

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())])
        for batch in batches:
            found: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found[lang].update(words(text))
            for lang, of in found.items():
                out: Counter = Counter()
                for w, n in of.items():
                    whole = _BEFORE * (ORDER - 1) + w + _BEHIND
                    for i in range(len(w) + 1):
                        out[whole[i : i + ORDER]] += n
                yield from emit(((lang, g, n) for g, n in out.items()), schema)

    counted = texts.where(~calibrates).select("lang", "text").mapInArrow(grams, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    common = counted.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("rank") <= GRAMS // len(langs))
    by_lang: dict[str, tuple[list[str], list[int]]] = {}
    for r in common.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("gram", "n"))).alias("all")).toLocalIterator():  # at most GRAMS n-grams
        by_lang[r.lang] = ([x.gram for x in r["all"]], [x.n for x in r["all"]])
    langs = sorted(by_lang)
    if not langs:
        return none
    model = Model(langs, [kneser_ney(*by_lang[x]) for x in langs], np.tile([0.0, np.inf], (len(langs), 1)), (0.0, 1.0, 0.0))
    told = [(r.lang, r.sums) for r in _summed(texts.where(calibrates & F.col("lang").isin(langs)), model, "text", ["lang"]).select("lang", "sums").collect() if r.sums[-1]]
    told.sort()
    if told:
        sums, truth = np.array([s for _, s in told]), np.array([langs.index(x) for x, _ in told])
        best, lowest, margin, n = model.judged(sums)
        right = (best == truth).astype(float)
        model.curve = tuple(logistic_curve(np.stack([np.ones(len(n)), margin * np.sqrt(n), np.log1p(n)], 1), right).tolist())
        for j in range(len(langs)):
            of = (truth == j) & (right == 1)
            of = of if of.sum() > 1 else np.ones(len(told), bool)
            middle = np.median(lowest[of])
            model.usual[j] = middle, 1.5 * np.quantile((lowest[of] - middle) * np.sqrt(np.minimum(n[of], EVEN)), ACCEPTED) + 1e-3
    return model


def _summed(docs: DataFrame, model: Model, text_col: str, more: list[str]) -> DataFrame:
    """``more`` and each text's sums of word scores."""
    plain = docs.select(*[named(c).alias(f"c{i}") for i, c in enumerate(more)], named(text_col).cast("string").alias("text"))
    kinds = plain.schema.fields[:-1]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most GRAMS n-grams of the longest order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, sums in _scored(batches, shared.value):
            yield pa.record_batch([*columns, pa.array(sums.tolist(), pa.list_(pa.float64()))], names=[*[f.name for f in kinds], "sums"])

    return plain.mapInArrow(run, T.StructType([*kinds, T.StructField("sums", T.ArrayType(T.DoubleType()))])).toDF(*more, "sums")


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[tuple[list[pa.Array], np.ndarray]]:
    """Each batch's columns before the last, and the sums of word scores of its last column's texts; words are scored once."""
    numbers: defaultdict[str, int] = defaultdict(count().__next__)
    scores = np.zeros((0, len(model.models) + 1))
    for batch in batches:
        if len(numbers) > WORDS_KEPT:
            numbers, scores = defaultdict(count().__next__), scores[:0]
        found = [np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)) for w in (words(text.as_py()) for text in batch.columns[-1])]
        if len(numbers) > len(scores):
            new = list(numbers)[len(scores) :]
            scores = np.concatenate([scores, *(model.word_scores(new[i : i + WORDS_SCORED]) for i in range(0, len(new), WORDS_SCORED))])
        yield batch.columns[:-1], np.array([scores[at].sum(0) for at in found]).reshape(len(found), -1)


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with ``lang_pred``, ``score``, ``cross_entropy`` (nats a character) and ``rejected`` as last columns
    (with more underscores if names are taken)."""
    bounded(docs.sparkSession)
    rest = [c for c in docs.columns if c != text_col]
    added = free(docs.select(*[named(c) for c in rest]), "lang_pred", "score", "cross_entropy", "rejected")
    plain = docs.select(*[named(c).alias(f"c{i}") for i, c in enumerate(rest)], named(text_col).cast("string").alias("text"))
    kinds = plain.schema.fields[:-1]
    schema = T.StructType([*kinds, T.StructField("p0", T.StringType()), T.StructField("p1", T.DoubleType()), T.StructField("p2", T.DoubleType()), T.StructField("p3", T.BooleanType())])
    types = [pa.string(), pa.float64(), pa.float64(), pa.bool_()]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, sums in _scored(batches, shared.value):
            told = list(zip(*shared.value.told(sums), strict=True)) or [[]] * 4
            kept = [c if c.type == (t := to_arrow_type(f.dataType)) else c.cast(t) for c, f in zip(columns, kinds, strict=True)]
            yield pa.record_batch([*kept, *(pa.array(list(v), t) for v, t in zip(told, types, strict=True))], names=[f.name for f in schema])

    return spread(plain).mapInArrow(run, schema).toDF(*rest, *added)
