"""N-gram Jaccard join: all pairs of documents whose sets of word shingles are alike, as classes and link counts.

Shingles are runs of five lower-cased words (the set of words, if a text has fewer). Documents with equal sets form one
set, which stands for all of them, so copies of any number cost one row. For the rest:

1. MinHash LSH forest. A set has ``TREES`` signatures of ``DEPTH`` values; the sorted order of a tree's signatures is its
   trie, a run of rows with a common prefix one of its branches. Every set's prefixes are shortened from ``DEPTH`` until a
   set as little alike as its own size and the threshold allow shares one with it in some tree with the target recall (a
   set of 7 shingles is alike at 6/7 or not at all, so its prefixes stay longer); sets too small to be alike to any other
   stand in no tree. No branch is shorter than the shortest prefix, so each of those is a unit of work.
2. In a unit, the sorted signatures are walked from the longest common prefixes to shorter ones: at every length the rows
   of a branch that aren't tied yet are compared, and tied if their sizes allow the threshold and their whole signatures
   agree nearly as often as it asks (five standard errors below). A branch that is tied as a whole is not looked into
   again. Only ties that span a unit's groups leave the task, so they never outnumber the members. Their connected
   components hold every link.
3. Exact verification. The sets of a component are read once, and all their pairs are counted by an incidence product
   over their shingles. What leaves the task are link counts for each set and the links that span its groups.
4. Classes are the components of the verified links.

Branches and components of many sets are cut into blocks by hash, and pairs of blocks are dealt out as tasks of bounded
size. Neither pairs nor components ever meet in one place.

Defined results: null, empty and blank texts have no shingles and are alike among themselves only; equal texts are
linked; repeated rows are documents of their own, linked as copies; null ids are kept (a class's id is the smallest id
that isn't null); an empty table gives an empty result; long texts are taken whole. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.columns import all_columns, free, named
from corpusloom.llm.batches import bounded, emit
from corpusloom.operators.graph import components
from corpusloom.session import spread, written

#: Words of a shingle, similarity of a link, trees, values of a signature, and recall at the similarity.
WORDS, THRESHOLD, TREES, DEPTH, RECALL = 5, 0.8, 24, 8, 0.99999
#: Rows (ids and hashes) that go to the texts by broadcast; more of them meet the texts in a shuffle.
FEW_ROWS = 200_000
#: Sets and shingles of a block, columns of an incidence product, words that a task remembers.
BLOCK_SETS, BLOCK_SHINGLES, COLUMNS, WORDS_KEPT = 256, 1 << 20, 4096, 200_000

_U64 = np.uint64
_K = (_U64(0x9E3779B97F4A7C15), _U64(0xC2B2AE3D27D4EB4F), _U64(0x165667B19E3779F9))
_rng = np.random.Generator(np.random.PCG64(20240501))
_XOR = _rng.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint32)
_MUL = _rng.integers(0, 1 << 31, TREES * DEPTH, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_known: dict[str, int] = {}


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U64(31))) * _K[1]
    return h ^ (h >> _U64(29))


def shingles(text: str | None) -> np.ndarray:
    """The sorted 64-bit hashes of a text's distinct shingles."""
    words = (text or "").lower().split()
    if len(_known) > WORDS_KEPT:
        _known.clear()
    for w in words:
        if w not in _known:
            _known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "replace"))
    h = np.fromiter((_known[w] for w in words), np.uint64, len(words))
    if len(h) < WORDS:
        return np.unique(_mix(h * _K[2]))
    out = _mix(h[: len(h) - WORDS + 1])
    for i in range(1, WORDS):
        out = _mix(out * _K[0] + h[i : len(h) - WORDS + 1 + i])
    return np.unique(out)


def signature(hashes: np.ndarray) -> np.ndarray:
    """TREES x DEPTH values of 16 bits: each the smallest of its own hash over the set, hashed again."""
    least = np.full(TREES * DEPTH, 0xFFFFFFFF, np.uint32)
    x = (hashes ^ (hashes >> _U64(32))).astype(np.uint32)
    for at in range(0, len(x), 1024):
        np.minimum(least, ((x[at : at + 1024, None] ^ _XOR) * _MUL).min(0), out=least)
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(">u2")


def prefix_depth(threshold: float = THRESHOLD, recall: float = RECALL, trees: int = TREES, depth: int = DEPTH) -> int:
    """Shorten the prefix until sets at the threshold share one in some tree with the recall."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def least_alike(n: int, threshold: float = THRESHOLD) -> float | None:
    """The smallest similarity from the threshold up that a set of ``n`` elements can have with another one."""
    found = (i / (n + m - i) for m in range(max(1, ceil(n * threshold)), int(n / threshold) + 1) for i in range(ceil((n + m) * threshold / (1 + threshold) - 1e-9), min(n, m) + 1) if i < max(n, m))
    return min((x for x in found if x >= threshold - 1e-12), default=None)


@lru_cache(maxsize=1 << 16)
def own_depth(n: int, threshold: float, recall: float) -> int:
    """The prefix of a set of ``n`` elements; with many elements its similarities lie so dense that the threshold decides."""
    alike = least_alike(n, threshold) if n <= 200 else threshold
    return DEPTH if alike is None else prefix_depth(alike, recall)


def document_sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every row's ``id``, ``key`` (a hash of the text), ``set`` (a 128-bit hash of its shingles), their number ``n`` and the
    signature ``sig``."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    plain = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))
    kind = plain.schema["id"].dataType
    schema = pa.schema([("id", to_arrow_type(kind)), ("key", pa.int64()), ("set", pa.binary()), ("n", pa.int64()), ("sig", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for i, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                    h = shingles(text.as_py())
                    yield i, key, xxhash.xxh128_digest(h.tobytes()), len(h), signature(h).tobytes()

        yield from emit(rows(), schema, lambda r: 500)
        _known.clear()

    return spread(plain).mapInArrow(run, f"id {kind.simpleString()}, key bigint, set binary, n bigint, sig binary")


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Runs of rows with equal first ``keys`` columns; equal neighbours count once."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[-1][:keys] != row[:keys]:
                yield held
                held = []
            if not held or held[-1] != row:
                held.append(row)
    if held:
        yield held


def _forest(alike: np.ndarray) -> np.ndarray:
    """The component (its first member) of each row of a symmetric matrix."""
    n = len(alike)
    root = np.full(n, -1)
    for i in range(n):
        if root[i] < 0:
            root[i], front = i, np.array([i])
            while len(front):
                front = np.flatnonzero(alike[front].any(0) & (root < 0))
                root[front] = i
    return root


def _deal(rows: DataFrame, blocks: str) -> DataFrame:
    """Rows with the pair of blocks ``a`` <= ``b`` of each task that needs them: a row's own ``block`` with all others."""
    return (
        rows.withColumn("block", F.expr(f"cast(pmod(xxhash64(set, 7), {blocks}) as int)"))
        .withColumn("other", F.explode(F.expr(f"sequence(0, cast({blocks} as int) - 1)")))
        .withColumn("a", F.least("block", "other"))
        .withColumn("b", F.greatest("block", "other"))
        .drop("other")
    )


def branch_ties(values: np.ndarray, sig: np.ndarray, n: np.ndarray, depths: np.ndarray, side: np.ndarray | None, threshold: float, least: int) -> np.ndarray:
    """The group (its first member's place) of each row of a unit, which is sorted by the tree's ``values``: from the longest
    common prefixes to the shortest, rows are compared that first share a branch there and aren't tied yet. Rows of one
    ``side`` aren't compared: they have a task of their own."""
    k = len(n)
    root = np.arange(k)
    # the common prefix of neighbours; that of any two rows is the least between them
    common = np.cumprod(values[1:] == values[:-1], axis=1).sum(1) if k > 1 else np.zeros(0, int)
    inner = np.arange(k)  # the branch of the longer prefix: rows of one were compared there
    for d in sorted({c for c in common.tolist() if c >= depths.min()}, reverse=True):
        branch = np.concatenate([[0], np.cumsum(common < d)])
        ends = np.searchsorted(branch, branch, "right")
        for i in np.flatnonzero(ends - np.arange(k) > 1).tolist():
            js = np.arange(i + 1, ends[i])
            js = js[(inner[js] != inner[i]) & (root[js] != root[i]) & (depths[js] <= d)] if depths[i] <= d else js[:0]
            if side is not None and len(js):
                js = js[side[js] != side[i]]
            if len(js):
                js = js[np.minimum(n[js], n[i]) >= threshold * np.maximum(n[js], n[i])]
            if len(js):
                js = js[np.count_nonzero(sig[js] == sig[i], axis=1) >= least]
            if len(js):
                tied = np.unique(np.append(root[js], root[i]))
                root[np.isin(root, tied)] = tied[0]
        inner = branch
    return root


def candidate_ties(sets: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``u`` and ``v``: ties that span the groups of likely links in every branch of the forest."""
    depth = prefix_depth(threshold, recall)
    least = int(TREES * DEPTH * threshold - 5 * sqrt(TREES * DEPTH * threshold * (1 - threshold)))
    branch = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.substring("sig", t * (2 * DEPTH) + 1, F.lit(2 * depth)))
    # a set of fewer elements differs from any other by more than the threshold allows
    slim = sets.where(F.col("n") >= threshold / (1 - threshold) - 1e-9 if threshold < 1 else F.lit(False)).select("set", F.posexplode(branch).alias("tree", "prefix"))
    shared = slim.groupBy("tree", "prefix").agg(F.count("*").alias("members")).where("members > 1")
    members = slim.join(shared, ["tree", "prefix"]).join(sets.select("set", "n", "sig"), "set")
    dealt = _deal(members.withColumn("blocks", F.expr(f"ceil(members / {BLOCK_SETS})")), "blocks")
    values = F.substring("sig", F.col("tree") * (2 * DEPTH) + 1, F.lit(2 * DEPTH))
    ready = dealt.select("tree", "prefix", "a", "b", "set", "block", "n", "sig").repartition("tree", "prefix", "a", "b").sortWithinPartitions("tree", "prefix", "a", "b", values, "set")
    schema = pa.schema([("u", pa.binary()), ("v", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for group in _groups(batches, 4):
                if len(group) < 2:
                    continue
                n = np.array([r[6] for r in group], np.float64)
                sig = np.frombuffer(b"".join(r[7] for r in group), ">u2").astype(np.uint16).reshape(len(group), -1)
                depths = np.array([own_depth(r[6], threshold, recall) for r in group])
                tree = group[0][0]
                side = None if group[0][2] == group[0][3] else np.array([r[5] for r in group])
                root = branch_ties(sig[:, tree * DEPTH : (tree + 1) * DEPTH], sig, n, depths, side, threshold, least)
                for i, r in enumerate(root.tolist()):
                    if r != i:
                        yield group[i][4], group[r][4]

        yield from emit(rows(), schema)

    return ready.mapInArrow(run, "u binary, v binary").distinct()


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each left set with each right set, by incidence products over runs of columns."""
    out = np.zeros((len(left), len(right)), np.float64)
    if len(left) * len(right) <= 4:
        for i, x in enumerate(left):
            for j, y in enumerate(right):
                out[i, j] = len(np.intersect1d(x, y, assume_unique=True))
        return out
    sizes = [len(x) for x in (*left, *right)]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    values, column = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    both = np.zeros((len(values), 2), bool)
    both[column[owner < len(left)], 0] = True
    both[column[owner >= len(left)], 1] = True
    use = both.all(1)  # only what stands on both sides can be shared
    number = np.cumsum(use) - 1
    keep = use[column]
    owner, column = owner[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for at in range(0, int(use.sum()), COLUMNS):
        a, b = np.searchsorted(column, [at, at + COLUMNS])
        x = np.zeros((len(sizes), min(COLUMNS, int(use.sum()) - at)), np.float32)
        x[owner[a:b], column[a:b] - at] = 1
        out += x[: len(left)] @ x[len(left) :].T
    return out


def verified(docs: DataFrame, sets: DataFrame, members: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """Exact links within components (``node``, ``root``): rows with ``set`` and its number of linked documents ``links``,
    and rows with ``set`` and ``other`` that span its linked groups; ``closed`` where the component was seen as a whole."""
    known = members.join(sets.select(F.col("set").alias("node"), "key", "rep", "n", "docs"), "node")
    totals = known.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    needed = written(known.join(totals, "root").select("key", "rep", F.col("node").alias("set"), "root", "docs", "blocks"), "jaccard-needed")
    needed = F.broadcast(needed) if needed.count() <= FEW_ROWS else needed
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("k"), text.alias("text"))
    fetched = texts.join(needed, (F.col("k") == F.col("key")) & F.col("id").eqNullSafe(F.col("rep"))).select("root", "set", "docs", "blocks", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("root", pa.binary()), ("set", pa.binary()), ("docs", pa.int64()), ("blocks", pa.int64()), ("shingles", pa.binary())])

        def rows():
            for batch in batches:
                for root, name, docs, blocks, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    data = shingles(text).tobytes()
                    if xxhash.xxh128_digest(data) == name:  # another text may have the key's hash
                        yield root, name, docs, blocks, data

        yield from emit(rows(), schema, lambda r: len(r[4]))
        _known.clear()

    dealt = _deal(fetched.mapInArrow(cut, "root binary, set binary, docs bigint, blocks bigint, shingles binary"), "blocks")
    ready = dealt.select("root", "a", "b", "set", "block", "docs", "blocks", "shingles").repartition("root", "a", "b").sortWithinPartitions("root", "a", "b", "set")
    schema = pa.schema([("set", pa.binary()), ("other", pa.binary()), ("links", pa.int64()), ("closed", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for group in _groups(batches, 3):
                names, docs = [r[3] for r in group], np.array([r[5] for r in group], np.float64)
                side, inside = np.array([r[4] for r in group]), group[0][1] == group[0][2]
                data = [np.frombuffer(r[7], np.uint64) for r in group]
                n = np.array([len(x) for x in data], np.float64)
                left = np.arange(len(group)) if inside else np.flatnonzero(side == group[0][1])
                right = left if inside else np.flatnonzero(side == group[0][2])
                shared = intersections([data[i] for i in left], [data[i] for i in right])
                union = n[left][:, None] + n[right] - shared
                linked = shared / np.maximum(union, 1) >= threshold
                alike = np.zeros((len(group), len(group)), bool)
                alike[np.ix_(left, right)] = linked
                np.fill_diagonal(alike, False)
                alike |= alike.T
                root, links, closed = _forest(alike), alike @ docs, group[0][6] == 1
                for i, r in enumerate(root.tolist()):
                    if closed or links[i]:
                        yield names[i], names[r] if closed or r != i else None, int(links[i]), closed

        yield from emit(rows(), schema)

    return ready.mapInArrow(run, "set binary, other binary, links bigint, closed boolean")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row for every row: ``id``, ``key`` (hash of its text), ``class_id`` (the smallest id of its class), ``class_set`` (the
    class's name), ``class_docs`` (rows of the class) and ``n_links`` (other rows that it is linked with)."""
    bounded(docs.sparkSession)
    rows = written(document_sets(docs, id_col, text_col), "jaccard-rows")
    sets = rows.groupBy("set").agg(F.min("id").alias("rep"), F.min(F.struct(F.col("id").isNull().alias("x"), "id", "key"))["key"].alias("key"), F.count("*").alias("docs"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    sets = written(sets, "jaccard-sets")
    members = written(components(candidate_ties(sets, threshold, recall), "jaccard-ties"), "jaccard-members")
    found = written(verified(docs, sets, members, id_col, text_col, threshold), "jaccard-links")

    links = found.groupBy("set").agg(F.sum("links").alias("links"))
    closed = found.where("closed").select(F.col("set").alias("node"), F.col("other").alias("root"))
    spread = found.where("NOT closed AND other IS NOT NULL").select(F.col("set").alias("u"), F.col("other").alias("v"))
    labels = closed if spread.isEmpty() else closed.union(components(spread, "jaccard-classes"))

    # only sets with copies or links differ from a class of their own
    slim = sets.select("set", "rep", "docs")
    special = slim.join(labels.withColumnRenamed("node", "set"), "set", "left").join(links, "set", "left").where("docs > 1 OR links > 0").withColumn("root", F.coalesce("root", "set"))
    special = written(special.select("set", "root", "rep", "docs", (F.col("docs") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "jaccard-special")
    classes = special.groupBy("root").agg(F.min("rep").alias("class_id"), F.sum("docs").alias("class_docs"))
    told = special.select("set", "root", "n_links").join(classes, "root")
    return rows.select("id", "key", "set").join(told, "set", "left").select(
        "id",
        "key",
        F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("root", "set").alias("class_set"),
        F.coalesce("class_docs", F.lit(1)).alias("class_docs"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def one_of_each(docs: DataFrame, duplicates: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay if every class keeps one: that with the smallest id (nulls last).

    Where few rows go or repeat, they are taken out where the texts lie, and no text moves; else the rows that stay meet the
    texts in one shuffle.
    """
    stay = duplicates.groupBy("class_set").agg(F.min(F.struct(F.col("id").isNull().alias("x"), "id", "key")).alias("s")).select(F.col("s.id").alias("id"), F.col("s.key").alias("key")).distinct()
    rows = duplicates.groupBy("id", "key").agg(F.count("*").alias("n"))
    same = F.col("r.id").eqNullSafe(F.col("s.id")) & (F.col("r.key") == F.col("s.key"))
    told = rows.alias("r").join(stay.alias("s"), same, "left").select("r.id", "r.key", "r.n", F.col("s.key").isNotNull().alias("stays"))
    special = written(told.where("NOT stays OR n > 1"), "jaccard-special-rows")
    key = F.xxhash64(F.coalesce(named(text_col).cast("string"), F.lit("")))
    k, h, other_id, other_key, other_hash = free(docs, "_k", "_h", "_other_id", "_other_key", "_other_h")
    texts = docs.withColumn(k, key).withColumn(h, F.xxhash64(named(id_col), k))

    def meeting(found: DataFrame) -> tuple[DataFrame, Column]:
        """The rows under names of their own, and the condition of being a row of ``docs``: one hash of id and key deals the
        texts out, for the join and for the repeated rows alike; the rest are conditions."""
        found = found.select(F.col("id").alias(other_id), F.col("key").alias(other_key), F.xxhash64("id", "key").alias(other_hash))
        same_id = F.coalesce(named(id_col) == F.col(other_id), named(id_col).isNull() & F.col(other_id).isNull())
        return found, (F.col(h) == F.col(other_hash)) & same_id & F.coalesce(F.col(k) == F.col(other_key), F.lit(False))

    if special.count() <= FEW_ROWS:
        taken, is_one = meeting(special)
        plain = texts.join(F.broadcast(taken), is_one, "left_anti")
        repeated, is_one = meeting(special.where("stays"))
        kept = plain.unionByName(texts.join(F.broadcast(repeated), is_one, "left_semi").dropDuplicates([h, id_col, k]))
    else:
        left, is_one = meeting(stay)
        kept = texts.join(left, is_one, "left_semi").dropDuplicates([h, id_col, k])
    return kept.select(*all_columns(docs))
