"""SentencePiece against the library and plain recursion, and length histograms against plain counting."""

import random
from functools import lru_cache

import pytest
import sentencepiece
from pyspark.sql import functions as F

from corpusloom.llm import lengths, pieces
from corpusloom.llm.catalog import PIECES_PATH, RANKS_PATH


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    alphabet = "abcet  ▁\nthe éß日本語 \x00\tA.,1"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(3000)]
    return made + [" " * n for n in range(40)] + ["x" + " " * n + "the" for n in range(20)] + ["", "a" * 3000, "the quick " * 2000, "▁▁a", "𝒳 emoji 😀"]


def test_ids_equal_the_library(texts):
    known = pieces.Vocabulary.load(PIECES_PATH)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES_PATH)
    encoder = pieces.Encoder(known)
    for at in range(0, len(texts), 100):
        part = texts[at : at + 100]
        ids, offsets = encoder.encode(part)
        assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == library.encode(part)
        assert pieces.decode_ids(known, ids, offsets) == [t.replace("▁", " ") for t in part]


def test_unigram_is_viterbi():
    rng = random.Random(2)
    words = {"".join(rng.choices("ab▁", k=rng.randrange(1, 4))).replace("▁", "a") for _ in range(12)} | {"▁", "▁a", "▁ab"}
    listed = [("<unk>", 0.0, pieces.UNKNOWN), *((w, -rng.random() * 5 - 1, pieces.NORMAL) for w in sorted(words))]
    known = pieces.Vocabulary(listed, pieces.UNIGRAM)

    @lru_cache
    def best(word):
        if not word:
            return 0.0
        return max([known.unknown_score + best(word[1:])] + [s + best(word[len(p) :]) for p, s, k in listed if k == pieces.NORMAL and word.startswith(p)])

    marked = sorted({"▁" + "".join(rng.choices("abc", k=rng.randrange(0, 9))) for _ in range(300)})
    for word, ids in zip(marked, known.forward(marked), strict=True):
        total = sum(known.unknown_score if i == 0 else known.scores[i] for i in ids)
        assert total == pytest.approx(best(word))


def test_states_are_shared(monkeypatch):
    known = pieces.Vocabulary.load(PIECES_PATH)
    words = sorted({"▁" + "shared" * 5 + c for c in "abcdefghij"})
    seen = []
    extend = pieces.Vocabulary._extend_merged
    monkeypatch.setattr(pieces.Vocabulary, "_extend_merged", lambda self, word, last, *rest: seen.append(len(word) + 1 - len(last)) or extend(self, word, last, *rest))
    list(known.forward(words))
    assert seen == [len(words[0])] + [1] * 9  # only the characters behind the common prefix


def test_tables(spark, texts):
    rows = [(1, None, 1), (1, "the cat", 2), (1, "the cat", 2), (None, "x", 3), (2, "", 4), (3, "long " * 100_000, 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids int").repartition(3)
    found = pieces.encode(docs, PIECES_PATH, decoded=True)
    apart = pieces.decode(pieces.encode(docs, PIECES_PATH), PIECES_PATH)
    key = lambda d: sorted((r.id is None, r.id or 0, r.ids, r.text) for r in d.collect())
    assert key(found) == key(apart) and [k[3] for k in key(found)] == sorted(["", "the cat", "the cat"]) + ["", "long " * 100_000, "x"]
    assert pieces.encode(docs.limit(0), PIECES_PATH).count() == 0
    nulls = spark.createDataFrame([(1, None)], "id bigint, ids array<int>")
    assert pieces.decode(nulls, PIECES_PATH).first().text == ""


def test_length_histogram(spark, texts):
    rows = [(t, 1, 2, "x") for t in [*texts, *[None] * 3, "long text " * 150_000]]
    docs = spark.createDataFrame(rows, "text string, length int, n_docs int, `a.b` string").repartition(4)
    known = lengths.encoding(RANKS_PATH)
    sizes = sorted(len(known.encode_ordinary(r[0] or "")) for r in rows)
    histogram = lengths.length_histogram(docs, RANKS_PATH)
    table = lengths.limits(histogram).cache()
    assert [r.length for r in table.orderBy("length").collect()] == sorted(set(sizes))
    for r in table.collect():
        assert r.n_docs == sizes.count(r.length) and r.docs_upto == sum(s <= r.length for s in sizes)
        assert r.tokens_over == sum(s for s in sizes if s > r.length) and r.truncated_total == sum(min(s, r.length) for s in sizes)
    for limit in (0, 1, 7, 100, 10**6):
        assert histogram.agg(lengths.truncated_total(limit)).first()[0] == sum(min(s, limit) for s in sizes)
    for q in (0.01, 0.5, 0.9, 1.0):
        want = next(s for i, s in enumerate(sizes) if sum(x <= s for x in sizes) / len(sizes) >= q)
        assert lengths.quantile(table, q).first().length == want
    empty = lengths.limits(lengths.length_histogram(docs.limit(0), RANKS_PATH))
    assert empty.count() == 0 and lengths.quantile(empty, 0.5).first().length is None
    assert histogram.limit(0).agg(lengths.truncated_total(5).alias("t")).select(F.col("t")).first().t == 0
