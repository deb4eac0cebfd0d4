"""Near duplicates by banded MinHash, as documents (bands joined without a test, or with one) and as instructions."""

from __future__ import annotations

import hashlib
import itertools
import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.operators.graph import components
from corpusloom.operators.joins import small
from corpusloom.session import bounded, spread, written

#: Hashes of a signature.
HASHES = 128
#: Signatures of a block, of which pairs are compared in one task; rounds of the greedy order before components, and a component's
#: open rows that one round then decides in order. Grams whose digests a worker remembers, 1 KB each.
BLOCK, ROUNDS, FRONT, GRAMS_KEPT = 512, 3, 16_384, 1 << 15
#: Shingles whose values are made at a time, which stay in a core's cache; bytes of words that are hashed at a time.
VALUES, HASHED = 128, 1 << 20
#: How much less often than asked signatures may agree before the texts are compared.
SLACK = 0.15
#: Rows whose sketches are compared at a time; tasks of so many rows are compared together, larger ones each by itself.
ROWS_AT_ONCE, FEW = 1 << 16, 24
_rng = np.random.Generator(np.random.PCG64(7))
_MUL = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)
#: A number for each byte; which bytes are ``\s`` in Spark's patterns (no byte of a longer character is).
_BYTES = np.random.Generator(np.random.PCG64(9)).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def word_shingles(text: Column, k: int = 5) -> Column:
    """The distinct runs of k lower-cased words; all words, if there are fewer."""
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")
    # the one-element array binds the words, which are then computed once
    runs = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: F.array_join(F.slice(w, i, k), " "))
    return F.array_distinct(F.transform(F.array(words), lambda w: F.when(F.size(w) >= k, runs(w)).otherwise(w))[0])


def char_grams(text: Column, k: int = 3) -> Column:
    """The distinct runs of k characters of the lower-cased text with single spaces; the text, if it has fewer."""
    plain = F.regexp_replace(F.lower(F.regexp_replace(text, r"^\s+|\s+$", "")), r"\s+", " ")
    runs = lambda p: F.transform(F.sequence(F.lit(1), F.char_length(p) - (k - 1)), lambda i: F.substring(p, i, F.lit(k)))
    return F.array_distinct(F.transform(F.array(plain), lambda p: F.when(F.char_length(p) >= k, runs(p)).otherwise(F.array(p)))[0])


def _gram_list(text: str | None, k: int = 3) -> set[str]:
    plain = " ".join((text or "").lower().split())
    return {plain[i : i + k] for i in range(max(1, len(plain) - k + 1))}


def _least(text: str | None) -> np.ndarray:
    """HASHES values of a text's word shingles; a text without words has the largest ones."""
    least, words = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64), (text or "").lower().split()
    raw = " ".join(words).encode()
    # a shingle is a part of the joined words, from where one begins to where another ends
    ends = np.cumsum([len(w.encode()) + 1 for w in words]).tolist() if not raw.isascii() else list(itertools.accumulate(len(w) + 1 for w in words))
    runs = zip([0, *ends], ends[4:], strict=False) if len(words) >= 5 else zip([0, *ends], ends, strict=False)
    x = np.frombuffer(b"".join([hashlib.blake2b(g, digest_size=8).digest() for g in {raw[i : j - 1] for i, j in runs}]), "<u8")
    values = np.empty((min(len(x), VALUES), HASHES), np.uint64)
    for at in range(0, len(x), VALUES):
        part = x[at : at + VALUES, None]
        now = np.multiply(part, _MUL, out=values[: len(part)])
        np.add(now, _ADD, out=now)
        np.minimum(least, now.min(0), out=least)
    return least


@F.pandas_udf(T.ArrayType(T.LongType()))
def minhash(texts: pd.Series) -> pd.Series:
    """HASHES values of every text's word shingles; a text without words has the largest ones."""
    return texts.map(lambda text: _least(text).view(np.int64))


@F.pandas_udf(T.BinaryType())
def minhash_signature(texts: pd.Series) -> pd.Series:
    """The same as bytes, eight of each value."""
    return texts.map(lambda text: _least(text).astype(">u8").tobytes())


@lru_cache(maxsize=1 << 14)
def _digests(gram: str) -> tuple[bytes, ...]:
    raw = gram.encode()
    return tuple(hashlib.md5(raw + i.to_bytes(4, "big")).digest() for i in range(HASHES))


@F.pandas_udf(T.ArrayType(T.StringType()))
def md5_minhash(texts: pd.Series) -> pd.Series:
    """HASHES values of every text's character grams: for each number the smallest MD5 of a gram and the number, as hex
    digits, whose order is that of the numbers."""
    return texts.map(lambda text: [min(x).hex() for x in zip(*map(_digests, _gram_list(text)), strict=True)])


class _GramTable:
    """The first eight bytes of every gram's digests as rows of numbers; each distinct gram of a worker is digested once."""

    def __init__(self) -> None:
        self.at: dict[str, int] = {}
        self.rows = np.zeros((1024, HASHES), np.uint64)

    def least(self, grams: set[str]) -> np.ndarray:
        if len(self.at) + len(grams) > GRAMS_KEPT:
            self.at = {}
        for g in grams:
            if g not in self.at:
                if len(self.at) == len(self.rows):
                    self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
                raw = g.encode()
                digests = b"".join(hashlib.md5(raw + i.to_bytes(4, "big")).digest()[:8] for i in range(HASHES))
                self.rows[len(self.at)] = np.frombuffer(digests, ">u8")
                self.at[g] = len(self.at)
        at = np.fromiter((self.at[g] for g in grams), np.int64, len(grams))
        out = self.rows[at[:1024]].min(0)
        for i in range(1024, len(at), 1024):
            np.minimum(out, self.rows[at[i : i + 1024]].min(0), out=out)
        return out


@lru_cache(maxsize=1)
def _gram_table() -> _GramTable:
    """The worker's own, which its tasks share."""
    return _GramTable()


@F.pandas_udf(T.BinaryType())
def md5_signature(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The first eight bytes of each value of ``md5_minhash``, one behind the other."""
    table = _gram_table()
    for batch in texts:
        yield batch.map(lambda text: table.least(_gram_list(text)).astype(">u8").tobytes())


def bands(signature: Column, n_bands: int, rows: int) -> Column:
    """The keys of a signature's bands."""
    return F.transform(F.sequence(F.lit(0), F.lit(n_bands - 1)), lambda b: F.md5(F.array_join(F.slice(signature.cast("array<string>"), b * rows + 1, rows), ",")))


def agreement(a: Column, b: Column) -> Column:
    """The share of places where two signatures agree."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x) / F.size(a)


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays as sets; 1 if both are empty."""
    return F.when(F.size(F.array_union(a, b)) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def document_signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, the MinHash signature ``sig`` of every document and its digest ``h``; written, for one or more forms of clusters."""
    bounded(docs.sparkSession)
    signed = spread(docs.select(id_col, text_col)).select(F.col(id_col).alias("id"), minhash_signature(F.col(text_col)).alias("sig"))
    return written(signed.withColumn("h", F.md5("sig")), "neardup-signatures")


def document_clusters(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_bands: int = 9, rows: int = 13, verify: float | None = None, signed: DataFrame | None = None, links: DataFrame | None = None) -> DataFrame:
    """Every document's ``cluster`` (its smallest id) by bands that it shares.

    Without ``verify`` all documents of a band are one cluster, tied to its smallest id, so ties don't outnumber documents. Nine
    bands of 13 rows are the compatible form: two documents of similarity s share one with the probability 1 - (1 - s^13)^9,
    which is 0.40 at 0.8, 0.93 at 0.9 and 0.9999 at 0.97. With 32 bands of 4 rows that is 0.9999999 at 0.8.
    With ``verify``, documents are tied whose shingle sets are at least so similar: equal signatures are one, and of the others all pairs
    of a band are compared, dealt out as pairs of blocks. Where signatures agree at most ``SLACK`` less often than asked (four standard
    errors of 128 hashes at 0.8), the texts are compared exactly (as by ``exact_pairs``). ``signed`` are the documents' ``document_signatures``
    and ``links`` their ``exact_pairs`` at ``verify``, where they are there already: an exact comparison of some gives those links
    whose ends are among them.
    """
    signed = document_signatures(docs, id_col, text_col) if signed is None else signed
    if verify is not None:
        sets = written(_signature_sets(signed), "neardup-sets")
        near = components(_band_ties(sets, None, n_bands, rows, max(0.0, verify - SLACK)), "neardup-candidates")
        near = written(near.select(F.col("node").alias("id")), "neardup-near")
        if links is None:
            some = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(small(near), "id", "left_semi")
            ties = _set_pairs(_shingle_sets(some, "id", "text"), verify).select(F.col("i").alias("u"), F.col("j").alias("v"))
        else:
            u, v = small(near.withColumnRenamed("id", "u")), small(near.withColumnRenamed("id", "v"))
            ties = links.select(F.col("i").alias("u"), F.col("j").alias("v")).join(u, "u", "left_semi").join(v, "v", "left_semi").select("u", "v")
        found = sets.select("h", F.col("id").alias("rep")).join(components(ties, "neardup-clusters"), F.col("rep") == F.col("node"), "left")
        return signed.select("id", "h").join(found, "h", "left").select("id", F.coalesce("root", "rep", "id").alias("cluster"))
    keyed = signed.select("id", F.posexplode(_band_keys(n_bands, rows)).alias("band", "key")).withColumn("key", F.md5("key"))
    firsts = keyed.groupBy("band", "key").agg(F.min("id").alias("v"))
    ties = keyed.join(firsts, ["band", "key"]).where("id <> v").select(F.col("id").alias("u"), "v").distinct()
    found = components(ties, "neardup-clusters")
    return docs.select(F.col(id_col).alias("id")).join(found, F.col("id") == F.col("node"), "left").select("id", F.coalesce("root", "id").alias("cluster"))


def cluster_sizes(clusters: DataFrame) -> DataFrame:
    """How many clusters of two and more have each size, and how many documents they lose."""
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("size")).where("size > 1")
    return sizes.groupBy("size").agg(F.count("*").alias("n_clusters"), F.sum(F.col("size") - 1).alias("removed"))


def cluster_recall(pairs: DataFrame, clusters: DataFrame) -> DataFrame:
    """How many pairs (``i``, ``j``) there are, ``n_links``, and the share of them within clusters, ``recall`` (null without pairs)."""
    told = clusters.select("id", "cluster")
    both = pairs.join(told.withColumnsRenamed({"id": "i", "cluster": "a"}), "i").join(told.withColumnsRenamed({"id": "j", "cluster": "b"}), "j")
    return both.agg(F.count("*").alias("n_links"), F.avg((F.col("a") == F.col("b")).cast("int")).alias("recall"))


def _band_keys(n_bands: int, rows: int) -> Column:
    """The bands of a signature ``sig`` of bytes, each as its bytes."""
    return F.transform(F.sequence(F.lit(0), F.lit(n_bands - 1)), lambda b: F.substring("sig", b * (8 * rows) + 1, F.lit(8 * rows)))


def _signature_sets(signed: DataFrame) -> DataFrame:
    """One row (``h``, ``id``, ``sig``) of every signature, with its smallest id."""
    return signed.where("id IS NOT NULL").groupBy("h").agg(F.min("id").alias("id"), F.first("sig").alias("sig"))


def _agreeing(threshold: float) -> int:
    """In how many places signatures agree at least that are as similar as the threshold."""
    return next((n for n in range(HASHES + 1) if n / HASHES >= threshold), HASHES + 1)


def _key_places(n_bands: int, rows: int, threshold: float) -> list[np.ndarray]:
    """The places of each key of a signature: those of its bands, or of longer keys that bring the same similar rows together.

    Similar rows differ in ``away`` places at most. If there are more bands, each such pair shares one, so any keys do that every
    such pair shares one of: of ``away // 2 + 1`` parts of the places, one has a single different place or none, and of its three blocks
    two agree whole. At 0.8 that are 39 keys of six places and more; strangers, which 32 bands of 4 bring together by the
    square of their number, then share one about a tenth as often.
    """
    away, places = max(0, HASHES - _agreeing(threshold)), np.arange(HASHES)
    split = [places[b * rows : (b + 1) * rows] for b in range(n_bands)]
    longer = [np.concatenate(two) for part in np.array_split(places, away // 2 + 1) for two in itertools.combinations(np.array_split(part, 3), 2)]
    return longer if away < len(split) and min(map(len, longer)) > rows else split


def _with_keys(rows: DataFrame, places: list[np.ndarray]) -> DataFrame:
    """``id``, ``stays``, ``key`` (a hash) for every key of a row, and its sketch ``s0`` to ``s3``: two bits of each value."""
    kind = rows.schema["id"].dataType.simpleString()

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, HASHES, 8)
            folded = np.bitwise_xor.reduce(raw, axis=2)
            sketch = [np.packbits(folded >> bit & 1, axis=1).view(np.int64) for bit in (0, 1)]
            mixed = raw.view(np.uint64)[:, :, 0] * _MUL
            mixed = np.stack([mixed[:, at].sum(1) + _ADD[i] for i, at in enumerate(places)], 1)
            mixed = (mixed ^ (mixed >> np.uint64(31))) * _MUL[0]
            mixed ^= mixed >> np.uint64(32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(raw) + 1) * len(places), pa.int32()), pa.array(mixed.view(np.int64).ravel()))
            words = [pa.array(np.ascontiguousarray(sketch[i // 2][:, i % 2])) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists, *words], ["id", "stays", "keys", "s0", "s1", "s2", "s3"])

    made = rows.select("id", "stays", "sig").mapInArrow(keys, f"id {kind}, stays boolean, keys array<bigint>, s0 bigint, s1 bigint, s2 bigint, s3 bigint")
    # written, as Spark shuffles what a Python step makes anew for each use; the same holds where one use alone drops null keys
    return written(made, "neardup-keys").select("id", "stays", F.explode("keys").alias("key"), "s0", "s1", "s2", "s3").where("key IS NOT NULL")


def _band_tasks(sets: DataFrame, status: DataFrame | None, n_bands: int, rows: int, threshold: float) -> DataFrame:
    """The rows of every key (``_key_places``) that holds alike ones, one of them open (``status``: ``id``, ``stays``; all are without
    it), with the task (``key``, ``a`` <= ``b``) of every pair of blocks that they stand in; sorted by task and id.

    Alike rows share many keys, and often the same rows do: of keys with the same rows, told by their number, first id and two
    64-bit sums of marks, one makes tasks, so what meets often is sent and compared once. Keys are hashes; a strange row that one
    brought would be compared, too. Signatures move to rows only whose sketch is as near as alike ones are to that of another row of
    their task: agreement by parts of values is never less than that of values.
    """
    bounded(sets.sparkSession)
    given = sets.withColumn("stays", F.lit(False)) if status is None else sets.join(status, "id")
    sketch = ["s0", "s1", "s2", "s3"]
    keyed = _with_keys(given, _key_places(n_bands, rows, threshold)).repartition("key")
    mark = F.xxhash64("id", *sketch)
    # both sides need the same columns, so Spark shuffles them once
    held = [F.count("*").alias("members"), F.count_if(~F.col("stays")).alias("open"), F.min("id").alias("first"), F.bit_xor(mark).alias("x"), F.bit_xor(F.xxhash64(mark, F.lit(1))).alias("y")]
    shared = keyed.groupBy("key").agg(*held).where("members > 1 AND open > 0").groupBy("members", "first", "x", "y").agg(F.min("key").alias("key"))
    dealt = (
        keyed.join(shared.select("key", F.expr(f"cast(ceil(members / {BLOCK}) as int)").alias("blocks")), "key")
        .withColumn("block", F.pmod(F.xxhash64(mark, F.lit(7)), "blocks").cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select("key", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "id", "stays", "block", *sketch)
    )

    def by_task(rows: DataFrame) -> DataFrame:
        return rows.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b", "id")

    away = HASHES - _agreeing(threshold)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _whole_tasks(batches):
            yield from part.select(list(range(6))).filter(pa.array(_near(part, away))).to_batches()

    some = by_task(dealt).mapInArrow(near, f"key bigint, a int, b int, id {sets.schema['id'].dataType.simpleString()}, stays boolean, block int")
    return by_task(some.join(sets.select("id", "sig"), "id").select("key", "a", "b", "id", "stays", "block", "sig"))


def _whole_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of whole tasks, some ``ROWS_AT_ONCE`` at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= ROWS_AT_ONCE:
            part = pa.Table.from_batches(held)
            key, a, b = (part.column(i).to_numpy() for i in range(3))
            done = part.num_rows - int(np.count_nonzero((key == key[-1]) & (a == a[-1]) & (b == b[-1])))
            if done:
                yield part.slice(0, done)
            held = part.slice(done).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _near(part: pa.Table, away: int) -> np.ndarray:
    """Which rows' sketches differ in ``away`` places at most from that of another row of their task; pairs of kept rows, and within a
    block in a task of two, don't count."""
    key, a, b, stays, block = (part.column(i).to_numpy() for i in (0, 1, 2, 4, 5))
    sketch, n = [part.column(i).to_numpy().view(np.uint64) for i in range(6, 10)], len(key)
    near = np.zeros(n, bool)
    if not n:
        return near
    begins = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    sizes = np.diff(begins, append=n)
    two = a != b

    def meet(i, j) -> np.ndarray:
        """Whether rows ``i`` and ``j`` (places, or a place and a range) are compared and near."""
        apart = np.bitwise_count((sketch[0][i] ^ sketch[0][j]) | (sketch[2][i] ^ sketch[2][j])) + np.bitwise_count((sketch[1][i] ^ sketch[1][j]) | (sketch[3][i] ^ sketch[3][j]))
        return (apart <= away) & ~(stays[i] & stays[j]) & (~two[i] | (block[i] != block[j]))

    behind = np.where(np.repeat(sizes, sizes) <= FEW, np.repeat(begins + sizes, sizes) - np.arange(n) - 1, 0)
    for step in range(1, FEW):
        i = np.flatnonzero(behind >= step)
        if not len(i):
            break
        i = i[meet(i, i + step)]
        near[i] = near[i + step] = True
    for begin, size in zip(begins[sizes > FEW].tolist(), sizes[sizes > FEW].tolist(), strict=True):
        for i in range(begin, begin + size - 1):
            # of rows that are told of already, only the others' partners are sought
            j = np.arange(i + 1, begin + size)[~near[i + 1 : begin + size]] if near[i] else slice(i + 1, begin + size)
            found = meet(i, j)
            if found.any():
                near[i] = True
                near[j] |= found
    return near


class _Group:
    """The rows of a task in the order of ids: ``sig``, ``stays``, and which of them are compared and alike."""

    def __init__(self, group: list[tuple], threshold: float) -> None:
        self.sig = np.frombuffer(b"".join(r[6] for r in group), np.uint64).reshape(len(group), -1)
        self.stays, self.block = np.array([r[4] for r in group]), np.array([r[5] for r in group])
        self.two, self.least = group[0][1] != group[0][2], _agreeing(threshold)

    def alike(self, i: int, js: np.ndarray) -> np.ndarray:
        """Those of ``js`` that row ``i`` is alike; pairs within a block in a task of two don't count."""
        js = js[self.block[js] != self.block[i]] if self.two else js
        return js[np.count_nonzero(self.sig[js] == self.sig[i], axis=1) >= self.least]


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Runs of rows with equal first columns."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[-1][:keys] != row[:keys]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _each_run(ready: DataFrame, keys: int, work: Callable[[list[tuple]], list[tuple]], ddl: str, kinds: list) -> DataFrame:
    """What ``work`` gives for every run of rows with equal first columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        names = [x.split()[0] for x in ddl.split(",")]
        pack = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)
        for group in _runs(batches, keys):
            out += work(group)
            if len(out) >= 1000:
                yield pack()
                out = []
        if out:
            yield pack()

    return ready.mapInArrow(run, ddl)


def _band_ties(sets: DataFrame, status: DataFrame | None, n_bands: int, rows: int, threshold: float) -> DataFrame:
    """``u``, ``v``: ties that span the groups of alike rows of every task. Only they leave a task, never its pairs."""

    def work(group: list[tuple]) -> list[tuple]:
        rows, root, out = _Group(group, threshold), np.full(len(group), -1), []
        for i in range(len(group)):
            if root[i] >= 0:
                continue
            root[i], front = i, [i]
            while front:
                found = rows.alike(front.pop(), np.flatnonzero(root < 0))
                root[found] = i
                front += found.tolist()
                out += [(group[j][3], group[i][3]) for j in found.tolist()]
        return out

    kind = sets.schema["id"].dataType
    return _each_run(_band_tasks(sets, status, n_bands, rows, threshold), 3, work, f"u {kind.simpleString()}, v {kind.simpleString()}", [to_arrow_type(kind)] * 2).distinct()


def greedy_survivors(rows: DataFrame, id_col: str, text_col: str, threshold: float = 0.8, n_bands: int = 32, band_rows: int = 4) -> DataFrame:
    """The ids that stay if, in the order of ids, a row goes when an earlier row that stays is as similar as the threshold.

    Similar rows share a band, and their signatures agree. Of equal signatures the first id stands for all: what takes it
    takes the others, else it takes them itself. Rows without an id stay.
    """
    bounded(rows.sparkSession)
    signed = written(rows.select(F.col(id_col).alias("id"), md5_signature(F.col(text_col)).alias("sig")).withColumn("h", F.md5("sig")), "greedy-signatures")
    kept = first_independent(_signature_sets(signed), threshold, n_bands, band_rows)
    return signed.where("id IS NULL").select("id").union(signed.select("id").join(kept, "id", "left_semi"))


def first_independent(sets: DataFrame, threshold: float = 0.8, n_bands: int = 32, band_rows: int = 4) -> DataFrame:
    """The ids of the rows (``id``, ``sig``: 8 bytes for each value) that stay in the order of ids: of the graph of similar rows the
    maximal independent set that comes first.

    Rounds to the end. In each one, open rows are compared with the open rows and with those that stay since the last round, in
    tasks of block pairs of their keys, which tell one line for a row at most: a row without an open similar row before it stays, one
    whose first such row stays goes, as does one that is like a row which stays. Rows without any similar row are done with the first
    round. In whatever order ids were given, all but few rows are decided so in a number of rounds that grows with the logarithm of
    their number; what has been sorted into chains is not. So after ``ROUNDS`` rounds, each connected component's first ``FRONT`` open rows are also decided in order in one task, as
    nothing before them is open: a chain of n rows ends in n / ``FRONT`` rounds, and no task gets a component.
    """
    sets = written(sets.select("id", "sig"), "greedy-sets")
    kind = sets.schema["id"].dataType
    name, arrow = kind.simpleString(), to_arrow_type(kind)

    def first(group: list[tuple]) -> list[tuple]:
        rows, n = _Group(group, threshold), len(group)
        least, gone, linked, is_open = np.full(n, -1), np.zeros(n, bool), np.zeros(n, bool), ~rows.stays
        for i in range(n - 1):
            # what a row before has told already isn't asked again: a group of alike rows takes a step for each row, not for each pair
            sought = ~gone if rows.stays[i] else (least < 0) if linked[i] else np.ones(n, bool)
            found = rows.alike(i, i + 1 + np.flatnonzero((sought & is_open)[i + 1 :]))
            if len(found):
                linked[i] = linked[found] = True
                if rows.stays[i]:
                    gone[found] = True
                else:
                    least[found] = np.where(least[found] < 0, i, least[found])
        return [(group[i][3], group[least[i]][3] if least[i] >= 0 else None, bool(gone[i])) for i in np.flatnonzero(linked & is_open).tolist()]

    def front(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = None
        for batch in batches:
            told = []
            for r, i, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r != root:
                    root, kept, size, shared = r, np.zeros((16, HASHES), np.uint64), 0, defaultdict(list)
                sig = np.frombuffer(data, np.uint64)
                keys = [(b, sig[b * band_rows : (b + 1) * band_rows].tobytes()) for b in range(n_bands)]
                near = np.unique(np.concatenate([np.array(shared[k], np.int64) for k in keys if k in shared] or [np.zeros(0, np.int64)]))
                stays = not len(near) or not (np.count_nonzero(kept[near] == sig, axis=1) / HASHES >= threshold).any()
                if stays:
                    if size == len(kept):
                        kept = np.concatenate([kept, np.zeros_like(kept)])
                    kept[size] = sig
                    for k in keys:
                        shared[k].append(size)
                    size += 1
                told.append((i, stays))
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in told], arrow), pa.array([s for _, s in told], pa.bool_())], ["id", "stays"])

    open_rows, status = sets.select("id"), None
    stayed: list[DataFrame] = []
    roots = None
    for round_ in itertools.count():
        told = _each_run(_band_tasks(sets, status, n_bands, band_rows, threshold), 3, first, f"id {name}, first {name}, gone boolean", [arrow, arrow, pa.bool_()])
        told = written(told.groupBy("id").agg(F.min("first").alias("first"), F.max("gone").alias("gone")), "greedy-told")
        # rows without an open similar row before them stay; what they are first to goes
        bound = told.where("gone OR first IS NOT NULL")
        now = written(open_rows.join(bound.select("id"), "id", "left_anti"), "greedy-stays")
        stayed.append(now)
        left = written(bound.where("NOT gone").join(bound.select(F.col("id").alias("first")), "first", "left_semi").select("id"), "greedy-open")
        # what isn't told of has no similar row, so none of those that are open is like it
        fresh = now.join(told.select("id"), "id", "left_semi")
        if round_ >= ROUNDS and not left.isEmpty():
            if roots is None:
                status = left.withColumn("stays", F.lit(False))
                roots = written(components(_band_ties(sets, status, n_bands, band_rows, threshold), "greedy-components").select("root", F.col("node").alias("id")), "greedy-roots")
            # rows that are like one that stays since this round go first, so that the fronts know all that came before them
            status = written(fresh.withColumn("stays", F.lit(True)).union(left.withColumn("stays", F.lit(False))), "greedy-status")
            lost = _each_run(_band_tasks(sets, status, n_bands, band_rows, threshold), 3, first, f"id {name}, first {name}, gone boolean", [arrow, arrow, pa.bool_()]).where("gone").select("id").distinct()
            left = written(left.join(lost, "id", "left_anti"), "greedy-open")
            ranked = left.join(roots, "id").withColumn("place", F.row_number().over(Window.partitionBy("root").orderBy("id"))).where(F.col("place") <= FRONT)
            ready = ranked.select("root", "id").join(sets, "id").select("root", "id", "sig").repartition("root").sortWithinPartitions("root", "id")
            solved = written(ready.mapInArrow(front, f"id {name}, stays boolean"), "greedy-fronts")
            left = written(left.join(solved.select("id"), "id", "left_anti"), "greedy-open")
            fresh = solved.where("stays").select("id")
            stayed.append(fresh)
        if left.isEmpty():
            break
        if not round_:  # all that comes is among rows with a similar one
            sets = written(sets.join(small(told.select("id")), "id", "left_semi"), "greedy-sets")
        open_rows = left
        status = open_rows.withColumn("stays", F.lit(False)).union(fresh.withColumn("stays", F.lit(True)))
        if len(stayed) > 16:
            stayed = [written(reduce(DataFrame.union, stayed), "greedy-stays")]
    return reduce(DataFrame.union, stayed)


def _word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of the texts, and how many words each one has.

    A word's hash is the sum of its bytes' numbers, each times one that its place gives, mixed.
    """
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data if data is not None else b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inside = np.concatenate([~_SPACE[raw], [False]])
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = offsets[:-1]
    begins[firsts] = inside[firsts]  # no word goes on from text to text
    at = np.flatnonzero(begins)
    counts = np.diff(np.searchsorted(at, offsets))
    ends = inside[:-1] & (~inside[1:] | begins[1:])
    sizes = np.flatnonzero(ends) + 1 - at
    out, upto, done = np.empty(len(at), np.uint64), np.cumsum(sizes), 0
    while done < len(at):
        last = max(done + 1, int(np.searchsorted(upto, (upto[done - 1] if done else 0) + HASHED, "right")))
        size = sizes[done:last]
        starts = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(starts, size)
        by_place = np.arange(1, int(size.max()) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        by_place = (by_place ^ (by_place >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        by_place = (by_place ^ (by_place >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        by_place = (by_place ^ (by_place >> np.uint64(31))) | np.uint64(1)
        sums = np.add.reduceat(_BYTES[raw[place + np.repeat(at[done:last], size)]] * by_place[place], starts)
        sums = (sums ^ (sums >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
        out[done:last] = sums ^ (sums >> np.uint64(32))
        done = last
    return out, counts


def _shingle_sets(docs: DataFrame, id_col: str, text_col: str, threshold: float | None = None, k: int = 5) -> DataFrame:
    """``id``, ``g`` (the sorted hashes of a text's word shingles, made of its words' hashes, so no shingle is put together as
    a text), their number ``n`` and ``h``, a digest of all of them. With a threshold ``g`` has only the first ones, ``_begin(n)``."""
    plain = docs.select(F.col(id_col).alias("id"), F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text"))
    bounded(docs.sparkSession)
    kind = plain.schema["id"].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("h", T.BinaryType()), T.StructField("n", T.IntegerType()), T.StructField("g", T.ArrayType(T.LongType(), False))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = _word_hashes(batch.columns[1])
            runs = sum(words[j : max(0, len(words) - k + 1) + j] * _MUL[j] for j in range(k))
            runs = (runs ^ (runs >> np.uint64(32))) * _MUL[k]
            digests, sizes, sets, at = [], [], [np.zeros(0, np.int64)], 0
            for n in counts.tolist():
                x = np.sort(runs[at : at + n - k + 1] if n >= k else words[at : at + n])
                at += n
                x = x[np.concatenate([[True], x[1:] != x[:-1]])].view(np.int64) if len(x) else x.view(np.int64)
                digests.append(hashlib.md5(x.tobytes()).digest())
                sizes.append(len(x))
                sets.append(x if threshold is None else x[: _begin(len(x), threshold)])
            g = pa.ListArray.from_arrays(pa.array(np.cumsum([len(x) for x in sets]), pa.int32()), pa.array(np.concatenate(sets)))
            yield pa.RecordBatch.from_arrays([batch.columns[0], pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()), g], ["id", "h", "n", "g"])

    return plain.mapInArrow(cut, schema)


def _tenth(n: int) -> int:
    return max(1, n // 10)


def _begin(n: int, threshold: float) -> int:
    return n - math.ceil(n * threshold) + _tenth(n)


def _with_partners(rows: DataFrame, threshold: float) -> DataFrame:
    """The ids of the sets (``rows``, of each its first shingles) that can be as similar as the threshold to another one; of a few
    others too, but it lacks none.

    In one order of shingles, here that of their hashes, two such sets have the first ``m`` shingles that they share within
    their first ``n - ceil(threshold * n) + m``, for any ``m`` up to ``ceil(threshold * n)``. ``m`` is a tenth of a set's size; a
    partner has ``ceil(threshold * n)`` shingles at least, so a set needs a tenth of that number which stand in another
    beginning too. Beginnings move once, and a frequent shingle brings no pairs.
    """
    needs = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * threshold) / 10))
    filled = rows.where("id IS NOT NULL AND n > 0")
    begins = filled.select("id", F.explode("g").alias("s")).repartition("s")
    # both sides need the same columns of the beginnings, so Spark shuffles them once
    shared = begins.groupBy("s").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first <> last").select("s")
    met = begins.join(shared.hint("shuffle_hash"), "s").groupBy("id").agg(F.count("*").alias("met"))
    return written(filled.select("id", needs.alias("needs")).join(met, "id").where("met >= needs").select("id").distinct(), "exact-partners")


def _exact_pairs(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """``exact_pairs`` of documents whose sets' beginnings are ``rows``."""
    some = docs.join(small(_with_partners(rows, threshold).withColumnRenamed("id", id_col)), id_col, "left_semi")
    return _set_pairs(_shingle_sets(some, id_col, text_col), threshold)


def _set_pairs(shingled: DataFrame, threshold: float) -> DataFrame:
    """``exact_pairs`` of documents' whole sets, without leaving any out first."""
    sets = written(shingled.groupBy("h").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("g").alias("g")).select("id", "n", "g"), "exact-sets")
    each = sets.select("id", F.explode("g").alias("s")).repartition("s")
    # both sides need the same columns, so Spark shuffles them once; a shingle of two sets has two ids
    common = each.groupBy("s").agg(F.count("*").alias("df"), F.min("id").alias("first"), F.max("id").alias("last")).where("first <> last").select("s", "df")
    rare = each.join(common.hint("shuffle_hash"), "s").join(sets.select("id", "n"), "id")
    # shingles of a single set come before all others in the order, and tie nothing
    place = F.row_number().over(Window.partitionBy("id").orderBy("df", "s")) + F.col("n") - F.count("*").over(Window.partitionBy("id"))
    begins = written(rare.withColumn("place", place).where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * threshold) + 1).select("id", "n", "s"), "exact-prefixes")
    left, right = begins.withColumnsRenamed({"id": "i", "n": "ni"}), begins.withColumnsRenamed({"id": "j", "n": "nj"})
    near = left.join(right, "s").where((F.col("i") < F.col("j")) & (F.least("ni", "nj") >= F.greatest("ni", "nj") * threshold)).select("i", "j").distinct()
    told = near.join(sets.select(F.col("id").alias("i"), F.col("g").alias("gi")), "i").join(sets.select(F.col("id").alias("j"), F.col("g").alias("gj")), "j")
    # sets have each shingle once, so their sizes and what they share tell the union; the one-element array binds it
    shared = F.array(F.size(F.array_intersect("gi", "gj")))
    similarity = F.transform(shared, lambda n: n / (F.size("gi") + F.size("gj") - n))[0]
    return told.select("i", "j", similarity.alias("similarity")).where(F.col("similarity") >= threshold)


def exact_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """``i``, ``j`` and ``similarity`` of all pairs of different shingle sets that are as similar as the threshold, each set
    told by its smallest id; ``exact_members`` has the documents of the sets.

    Sets without a possible partner go first (``_with_partners``). Prefix filter for the others: in one order of shingles, the
    rarest first, two such sets share one of their first ``n - ceil(threshold * n) + 1`` shingles. So only the beginnings are
    joined, and a frequent shingle, which stands in no beginning of a set of some size, ties nothing.
    """
    docs = spread(docs.select(id_col, text_col))
    return _exact_pairs(docs, written(_shingle_sets(docs, id_col, text_col, threshold), "exact-begins"), id_col, text_col, threshold)


def exact_members(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """One row for every document: ``id``, the ``representative`` of its shingle set (the smallest id, as ``exact_pairs`` tells
    it), ``class_id`` (the smallest id of all that links tie together) and ``n_links`` (other documents as similar as the
    threshold, copies included). Null and blank texts have no shingles and are alike among themselves only."""
    docs = spread(docs.select(id_col, text_col))
    rows = written(_shingle_sets(docs, id_col, text_col, threshold), "exact-begins")
    sets = rows.groupBy("h").agg(F.min("id").alias("representative"), F.count("*").alias("docs"))
    pairs = written(_exact_pairs(docs, rows, id_col, text_col, threshold).select(F.col("i").alias("u"), F.col("j").alias("v")), "exact-links")
    other = sets.select(F.col("representative").alias("v"), "docs")
    links = pairs.union(pairs.select("v", "u")).join(other, "v").groupBy("u").agg(F.sum("docs").alias("links"))
    told = sets.join(links, F.col("representative") == F.col("u"), "left").join(components(pairs, "exact-classes"), F.col("representative") == F.col("node"), "left")
    told = told.select("h", "representative", F.coalesce("root", "representative").alias("class_id"), (F.col("docs") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return rows.select("id", "h").join(told, "h").select("id", "representative", "class_id", "n_links")
