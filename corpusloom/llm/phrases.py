"""Phrase collocations: n-grams counted by word-id suffix arrays, scored by the least of their cuts.

Texts are lower-cased (A-Z), split at ``.,;:!?`` and line ends into pieces, and pieces at spaces and tabs into words. A task
gathers its texts into shards of about ``SHARD_WORDS`` words for each language. In a shard, words get ids, and numpy sorts all
suffixes by their first words, doubling the prefix until it is as long as the longest n-gram; neighbours' common prefixes (LCP) then
cut the array into intervals, whose sizes are the counts of the n-grams they share. Shards' counts meet by n-gram in one
aggregation, and what isn't frequent goes there: no part of a frequent n-gram is rarer than the n-gram itself.

Words and pairs are counted first. For longer n-grams, level by level, the frequent n-grams one word shorter are marked in a bitmap
of ``BITS`` bits by their hashes, and of a shard only the runs of words stay in which every such part is marked: no other place can
start a frequent n-gram. A chance mark costs work and changes no count; the bitmap has the same size whatever the input.

A candidate is a frequent phrase of two words at least. Cut behind its first words it has ``l`` and ``r``, the counts of both
parts, and the score ``floor(1000000 * a * a / (l * r))``; its lowest cut counts. Candidates that stand inside a longer one of
at least ``INSIDE`` percent of their count are dropped. Numbers are decimals of 38 digits, exact for counts up to 10^15.

Defined results: null and empty texts have no words; null languages count as ``und``; repeated rows count each; ties of cuts go
to the earlier cut, ties of phrases to the bytes' order; texts of any length are read whole (one longer than a shard is a shard of
its own); an empty table gives an empty result. Only text and language are read, so other columns may have any names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.batches import bounded
from corpusloom.session import spread, written

#: Words of a phrase at the most, its least count, share of a longer one that drops it, and rows for each language.
WORDS, LEAST, INSIDE, TOP = 3, 10, 50, 2000
#: Words of a shard, rows of a batch that a task emits, and bits that mark frequent n-grams (16 MB).
SHARD_WORDS, EMIT_ROWS, BITS = 1 << 21, 1 << 16, 1 << 27

#: A byte that no UTF-8 text has stands for the end of a piece.
_END = b"\xff"
_FOLD = bytes.maketrans(bytes(range(65, 91)) + b"\t.,;:!?\n\x0b\x0c\r", bytes(range(97, 123)) + b" " + b"\n" * 10)


def tokens(text: bytes) -> list[bytes]:
    """The words of a text, with a mark behind every piece."""
    return (text.translate(_FOLD).replace(b"\n", b" " + _END + b" ") + b" " + _END).split()


def suffix_array(ids: np.ndarray, n: int) -> np.ndarray:
    """Positions in the order of their first ``n`` ids, by prefix doubling; what lies behind the end comes first."""
    ranks = {1: ids.astype(np.int64) + 1}
    done, order = 1, np.argsort(ranks[1], kind="stable")
    while done < n:
        more = min(done, n - done)
        if more not in ranks:
            ranks[more] = ranks[1] if more == 1 else _ranked(ids, more)
        behind = np.zeros(len(ids), np.int64)
        behind[: max(0, len(ids) - done)] = ranks[more][done:]
        key = ranks[done] * (ranks[more].max(initial=0) + 1) + behind
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        rank = np.empty(len(ids), np.int64)
        rank[order] = np.cumsum(np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]]))
        done += more
        ranks[done] = rank
    return order


def _ranked(ids: np.ndarray, n: int) -> np.ndarray:
    order = suffix_array(ids, n)
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.cumsum(np.concatenate([[True], common_prefixes(ids, order, n)[1:] < n]))
    return rank


def common_prefixes(ids: np.ndarray, order: np.ndarray, n: int) -> np.ndarray:
    """How many first ids each suffix shares with the one before it in order, ``n`` at the most."""
    padded = np.concatenate([ids, np.full(n, -1, ids.dtype)])
    same, out = np.ones(len(order), bool), np.zeros(len(order), np.int64)
    same[:1] = False
    for k in range(n):
        here = padded[order + k]
        same[1:] &= here[1:] == here[:-1]
        out += same
    return out


def ngram_counts(ids: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For every length up to ``n`` a position and the count of each distinct n-gram that holds no id 0 (the end of a piece)."""
    order = suffix_array(ids, n)
    order = order[ids[order] != 0]
    shared = common_prefixes(ids, order, n)
    padded = np.concatenate([ids, np.zeros(n, ids.dtype)])
    whole = np.ones(len(order), bool)
    for k in range(1, n + 1):
        whole &= padded[order + k - 1] != 0
        first = np.flatnonzero(shared < k)  # the intervals of suffixes that share k ids
        size = np.diff(np.append(first, len(order)))
        kept = whole[first]
        yield k, order[first[kept]], size[kept]


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words; 0 for the end of a piece."""
    return np.fromiter((0 if w == _END else xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))


def marks(lang: bytes, hashes: np.ndarray, n: int, bits: int) -> np.ndarray:
    """The bit, of so many, of the ``n`` words from every place on; places too near to the end are left out."""
    h = np.full(max(0, len(hashes) - n + 1), xxhash.xxh64_intdigest(lang), np.uint64)
    for k in range(n):
        h = (h ^ hashes[k : k + len(h)]) * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(31)
    return (h % np.uint64(bits)).astype(np.int64)


def reduced(ids: np.ndarray, marked: np.ndarray, n: int) -> np.ndarray:
    """The runs of ids that lie in n-grams whose parts of ``n - 1`` ids are both marked, by place; an end behind each run."""
    size = max(0, len(ids) - n + 1)
    start = marked[:size] & marked[1 : size + 1]
    for k in range(n):
        start &= ids[k : k + size] != 0
    kept = np.zeros(len(ids), bool)
    for k in range(n):
        kept[k : k + size] |= start
    at = np.flatnonzero(kept)
    return np.insert(ids[at], np.flatnonzero(np.diff(at) > 1) + 1, 0) if len(at) else ids[:0]


def _shard(lang: bytes, ids: np.ndarray, words: list[bytes], lengths: range) -> Iterator[pa.RecordBatch]:
    """The counts of a shard's n-grams of these lengths as (language and phrase, n), and beside single words the number of all
    under the empty phrase."""
    vocabulary = pa.array(words, pa.binary())
    first_words = pc.binary_join_element_wise(pa.scalar(lang, pa.binary()), vocabulary, pa.scalar(b"\n", pa.binary()))
    as_text = pc.CastOptions(pa.string(), allow_invalid_utf8=True)
    if 1 in lengths:
        yield pa.record_batch([pa.array([lang + b"\n"], pa.binary()).cast(options=as_text), pa.array([int((ids != 0).sum())], pa.int64())], names=["phrase", "n"])
    for k, at, size in ngram_counts(ids, lengths[-1]):
        for i in range(0, len(at) if k in lengths else 0, EMIT_ROWS):
            part = at[i : i + EMIT_ROWS]
            parts = [first_words.take(pa.array(ids[part]))] + [vocabulary.take(pa.array(ids[part + j])) for j in range(1, k)]
            joined = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary())) if k > 1 else parts[0]
            yield pa.record_batch([joined.cast(options=as_text), pa.array(size[i : i + EMIT_ROWS], pa.int64())], names=["phrase", "n"])


def counted(docs: DataFrame, text_col: str, lang_col: str, lengths: range, frequent: DataFrame | None = None) -> DataFrame:
    """``phrase`` (language, a line end, the words) and its number of occurrences ``n`` for n-grams of these lengths; beside single
    words the empty phrase has all words. With ``frequent`` (n-grams one word shorter than the single length) only n-grams whose
    parts are among them are sure to be counted in full."""
    spark = docs.sparkSession
    bounded(spark)
    plain = docs.select(F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"), F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).cast("binary").alias("lang")).where("text IS NOT NULL")
    many = BITS
    bitmap = None if frequent is None else spark.sparkContext.broadcast(_bitmap(frequent, lengths[0] - 1))  # BITS bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list[np.ndarray]] = defaultdict(list)
        ids: dict[bytes, defaultdict[bytes, int]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang in list(held):
                known, all_ids = list(ids.pop(lang)), np.concatenate(held.pop(lang))
                if bitmap is not None:
                    at = marks(lang, word_hashes(known)[all_ids], lengths[0] - 1, many)
                    marked = bitmap.value[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1
                    all_ids = reduced(all_ids, np.append(marked, np.zeros(len(all_ids) - len(marked), bool)), lengths[0])
                if len(all_ids):
                    yield from _shard(lang, all_ids, known, lengths)

        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found = tokens(text.as_py())
                if lang not in ids:
                    ids[lang] = defaultdict(count().__next__, {})
                    ids[lang][_END]  # noqa: B018  the end of a piece is id 0
                held[lang].append(np.fromiter(map(ids[lang].__getitem__, found), np.int32, len(found)))
                size += len(found)
                if size >= SHARD_WORDS:
                    yield from flush()
                    size = 0
        yield from flush()

    # a shard has each n-gram once, so summing up within its task would gain little: rows go to their sums at once
    return spread(plain).mapInArrow(run, "phrase string, n bigint").repartition("phrase").groupBy("phrase").agg(F.sum("n").alias("n"))


def _bitmap(frequent: DataFrame, n: int) -> np.ndarray:
    """The bits of all n-grams, as bytes. At most ``BITS / 64`` rows come to the driver."""

    many = BITS

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [phrase.rpartition(b"\n") for phrase in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array([int(marks(lang, word_hashes(words.split(b" ")), n, many)[0]) for lang, _, words in split], pa.int64())], names=["bit"])

    words = F.split(F.substring_index("phrase", "\n", -1), " ")
    of = frequent.where(~F.col("phrase").endswith("\n") & (F.size(words) == n))
    each = of.select(F.col("phrase").cast("binary").alias("phrase")).mapInArrow(bits, "bit bigint")
    told = each.groupBy(F.expr("bit div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits")).toArrow()
    out = np.zeros(BITS // 64, "<i8")
    out[told.column("word").to_numpy()] = told.column("bits").to_numpy()
    return out.view(np.uint8)


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", words: int = WORDS, least: int = LEAST, inside: int = INSIDE, top: int = TOP) -> DataFrame:
    """The best phrases of every language: ``lang rank phrase a l r n score``."""
    kept = (F.col("n") >= least) | F.col("phrase").endswith("\n")
    frequent = written(counted(docs, text_col, lang_col, range(1, min(words, 2) + 1)).where(kept), "phrases")
    for n in range(3, words + 1):
        longer = counted(docs, text_col, lang_col, range(n, n + 1), frequent).where(kept)
        frequent = frequent.unionByName(written(longer, "phrases"))
    lang = F.expr("left(phrase, length(phrase) - length(substring_index(phrase, '\\n', -1)) - 1)")
    split = frequent.select("phrase", F.col("n").alias("a"), lang.alias("lang"), F.substring_index("phrase", "\n", -1).alias("text"))
    totals = split.where("text = ''").select(F.col("lang").alias("of"), F.col("a").alias("n"))
    candidates = split.withColumn("words", F.split("text", " ")).where(F.size("words") > 1)

    def part(first, size):
        return F.concat("lang", F.lit("\n"), F.array_join(F.slice("words", first, size), " "))

    cuts = candidates.select("phrase", "a", "lang", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select("phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.size("words") - F.col("k")).alias("right"))
    of = frequent.withColumnsRenamed({"phrase": "part", "n": "count"})
    cuts = cuts.join(of.withColumnsRenamed({"part": "left", "count": "l"}), "left").join(of.withColumnsRenamed({"part": "right", "count": "r"}), "right")
    whole = {c: f"CAST({c} AS DECIMAL(15, 0))" for c in "alr"}
    score = F.expr(f"CAST(CAST(1000000 AS DECIMAL(7, 0)) * ({whole['a']} * {whole['a']}) AS DECIMAL(38, 0)) div CAST({whole['l']} * {whole['r']} AS DECIMAL(31, 0))")
    lowest = cuts.groupBy("phrase").agg(F.min(F.struct(score.alias("score"), "k", "l", "r", "a")).alias("cut"))

    # words from i on, j of them, for every shorter phrase of at least two words inside a candidate
    longer = candidates.where(F.size("words") > 2)
    places = F.expr("flatten(transform(sequence(2, size(words) - 1), j -> transform(sequence(1, size(words) - j + 1), i -> concat(lang, '\\n', array_join(slice(words, i, j), ' ')))))")
    held = longer.select("a", F.explode(F.array_distinct(places)).alias("phrase")).groupBy("phrase").agg(F.max("a").alias("longest"))
    kept = lowest.join(held, "phrase", "left").where(f"longest IS NULL OR 100 * longest < {int(inside)} * cut.a")
    told = kept.select(lang.alias("lang"), F.substring_index("phrase", "\n", -1).alias("phrase"), "cut.a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = told.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    best = ranked.join(totals, F.col("lang") == F.col("of"))
    return best.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
