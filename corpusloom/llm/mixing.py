"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree, in DataFrame operations only.

1. Sizes are words. Sources share the total by weight; no source's target exceeds ``cap`` times its size, and what is
   over is shared again by weight among the others until none is above.
2. A source's documents are dealt by hash into blocks of about ``block_words`` words, so a document's block follows from
   its own row and its source's. Only id, source, size and a hash of each document are kept; texts are read again at the end.
3. A target needs a number of block draws. An epoch draws every block once in an order of its own (a swap-or-not
   permutation of the block numbers, evaluated for each block by itself); the last epoch stops where the target is
   met: blocks before that go whole, and the documents of the block in which it falls by the order of their hashes, the
   last one cut. Draws are disjoint within an epoch, and no document is drawn more than ``cap`` times.
4. The output shards' shares come from a binary tree: each node passes half of its draws to either child, and how many
   of each source is one exact multivariate-hypergeometric sample (inverse distribution function over the sources'
   conditional hypergeometric laws). A leaf's quotas are ranges of each source's draw order.
5. ``mixed`` sends every text to its shard, in one exchange, and orders each shard by hash.

Nothing grows with the input in one task: sources are numbered by ranges, the water level is found by sums over all sources,
where a source's last epoch stops by sums over runs of its blocks, and a node of the tree holds its sources in groups of
``GROUP``. Everything that is random is a hash of the seed, so reruns agree, on any number of machines (of rows
that repeat both id and text, another one may take the last words where the table lies in other partitions).

Defined results: null and empty texts have size 0 and are never drawn; a null source is a source of its own, the last
in order; null ids are drawn like others; repeated rows (equal id and text) are documents of their own that share a block,
and where the target falls among them each gives its part of the words still wanted, rounded by the row's place in the
table, so the total may miss the target by a few words; an empty table gives an empty plan; sources whose documents are all
empty have the target 0; a text of any length stands in one block, which is then larger. Columns of the input that are not
named are not read by the plan, and carried ones may have any names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.columns import all_columns
from corpusloom.session import written

#: Words as the contract has them, and one word with the white space behind it.
WORD = r"[^\x20\x09-\x0D]+"
WORD_AND_SPACE = r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"
#: Rounds of the permutation, sources whose quotas stand in one array, and sources up to which one task numbers them.
ROUNDS, GROUP, FEW_SOURCES = 32, 256, 10_000
#: Words of a shard and of a part of one, if the number of shards follows from the input, and the least and most shards.
SHARD_WORDS, PART_WORDS, LEAST_SHARDS, MOST_SHARDS = 1 << 22, 1 << 22, 8, 4096
#: Ends of ranges (8 bytes each, one for each source and shard) up to which the sources' table is broadcast; a larger one is
#: joined by shuffle, where Spark splits the hot sources.
BROADCAST_ENDS = 2_000_000


def words(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def source_targets(sizes: DataFrame, weights: Sequence[float], cap: float, sources: int) -> DataFrame:
    """``sizes`` (``source``, ``source_size``) with ``number`` in source order, ``weight`` and ``target``.

    The level is what is left of the total over the weights left; sources whose share at that level is beyond their cap are
    capped, and the level is taken again among the others until none is above. A round is one sum by weight.
    """
    order = F.col("source").asc_nulls_last()
    if sources <= FEW_SOURCES:
        numbered = sizes.withColumn("number", F.row_number().over(Window.orderBy(order)).cast("bigint") - 1)
    else:  # by ranges: how many come before a range, and the place in it
        ranges = written(sizes.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "mix-order")
        earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        bases = ranges.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
        placed = ranges.withColumn("number", F.row_number().over(Window.partitionBy("part").orderBy(order))).join(F.broadcast(bases), "part")
        numbered = placed.withColumn("number", F.col("base") + F.col("number") - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("kind") + 1).cast("int"))
    numbered = numbered.withColumn("kind", F.pmod("number", F.lit(len(weights))).cast("int")).withColumn("weight", weight)
    told = written(numbered.select("source", "source_size", "number", "kind", "weight"), "mix-order")

    total, level, before = None, 0.0, -1.0
    while level != before:  # the level only rises, and stays when no further source is capped
        capped = F.col("source_size") * float(cap) <= F.col("weight") * level
        sums = told.groupBy("kind").agg(F.sum("source_size").alias("words"), F.sum(F.when(capped, F.col("source_size"))).alias("full"), F.count_if(~capped).alias("left")).orderBy("kind").collect()  # a row for each weight
        total = sum(r.words for r in sums)
        left = sum(weights[r.kind] * r.left for r in sums)
        before, level = level, (total - cap * sum(r.full or 0 for r in sums)) / left if left and total else level
    most = F.col("source_size") * float(cap)
    return told.drop("kind").withColumn("target", F.least(most, F.col("weight") * level))


def permuted(block: str, n: str, number: str, epoch: str, seed: int) -> str:
    """SQL of a block's place in the permutation of ``n`` blocks: in every round, a block and its mirror image around
    a random point change places if a hash of the pair says so, which permutes them whatever the hash is."""
    point = f"pmod(xxhash64({seed}, {number}, {epoch}, r), {n})"
    swap = f"transform(array(pmod({point} - x, {n})), y -> if((xxhash64({seed}, {number}, {epoch}, r, greatest(x, y)) & 1) = 1, y, x))[0]"
    return f"aggregate(sequence(0, {ROUNDS - 1}), {block}, (x, r) -> {swap})"


def _block(seed: int) -> str:
    return f"pmod(xxhash64(key, {seed}), greatest(blocks, 1L))"


def draw_counts(targets: DataFrame, docs: DataFrame, block_words: int, seed: int, few: bool) -> DataFrame:
    """``targets`` with the block draws of every source (``blocks``, whole ``epochs``, ``draws``) and where its last epoch stops:
    at the place ``stop`` in it, at the key ``stop_key`` in that block, after ``some`` words of that key's ``same`` rows.
    ``docs`` has every document's ``source``, ``key`` and ``size``."""
    counted = targets.selectExpr("*", "cast(floor(target + 0.5) as bigint) as quota", f"cast(ceil(source_size / {block_words}) as bigint) as blocks")
    counted = counted.selectExpr("*", "if(source_size = 0, 0L, quota div greatest(source_size, 1L)) as epochs").selectExpr("*", "quota - epochs * source_size as rest")
    open_ones = counted.where("rest > 0").select(F.col("source").alias("s"), "number", "blocks", "epochs", "rest")
    open_ones = F.broadcast(open_ones) if few else open_ones
    dealt = docs.where("size > 0").join(open_ones, F.col("source").eqNullSafe(F.col("s"))).withColumn("block", F.expr(_block(seed)))
    sums = dealt.groupBy("number", "blocks", "epochs", "rest", "block").agg(F.sum("size").alias("words"))
    sums = sums.withColumn("place", F.expr(permuted("block", "blocks", "number", "epochs", seed))).withColumn("run", F.expr("place div cast(ceil(sqrt(blocks)) as bigint)"))
    sums = written(sums, "mix-blocks")

    def stop(rows: DataFrame, order: str) -> DataFrame:
        """Of every source the row in which the running sum of ``words`` reaches ``rest``, with what is ``wanted`` of it."""
        upto = F.sum("words").over(Window.partitionBy("number").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
        return rows.withColumn("upto", upto).where("upto >= rest AND upto - words < rest").withColumn("wanted", F.expr("rest - (upto - words)")).drop("upto")

    run = stop(sums.groupBy("number", "rest", "run").agg(F.sum("words").alias("words")), "run").select("number", "run", F.col("wanted").alias("rest"))
    place = stop(sums.drop("rest").join(run, ["number", "run"]), "place").select("number", "place", F.col("block").alias("stop_block"), F.col("wanted").alias("rest"))
    place = written(place, "mix-blocks")
    near = dealt.drop("rest").join(F.broadcast(place) if few else place, "number").where("block = stop_block")
    keys = near.groupBy("number", "rest", "place", "key").agg(F.sum("size").alias("words"), F.count("*").alias("same"))
    stops = stop(keys, "key").select("number", F.col("place").alias("stop"), F.col("key").alias("stop_key"), F.col("wanted").alias("some"), "same")
    return counted.join(stops, "number", "left").withColumn("draws", F.expr("epochs * blocks + coalesce(stop + 1, 0L)")).drop("quota", "rest")


def _hypergeometric(u: str, pop: str, good: str, draws: str) -> str:
    """SQL of a hypergeometric sample: how many of ``draws`` from ``pop`` are among ``good``, by the inverse
    distribution function over twelve standard deviations around the mean (outside lies less than 1e-30)."""
    low, high = f"greatest(0L, {draws} - ({pop} - {good}))", f"least({good}, {draws})"
    mean = f"({draws} * ({good} / greatest({pop}, 1L)))"
    spread = f"(12 * sqrt(greatest(0D, {mean} * (1 - {good} / greatest({pop}, 1L)) * ({pop} - {draws}) / greatest({pop} - 1, 1L))) + 12)"
    first, end = f"greatest({low}, cast(floor({mean} - {spread}) as bigint))", f"least({high}, cast(ceil({mean} + {spread}) as bigint))"
    ratio = f"(cast({good} - x as double) * ({draws} - x)) / (cast(x + 1 as double) * ({pop} - {good} - {draws} + x + 1))"
    mass = f"aggregate(sequence(r.a, r.b), named_struct('w', 1D, 's', 0D), (v, x) -> named_struct('w', v.w * {ratio}, 's', v.s + v.w)).s"
    below = f"aggregate(sequence(r.a, r.b), named_struct('w', 1D, 's', 0D, 'c', 0L), (v, x) -> named_struct('w', v.w * {ratio}, 's', v.s + v.w, 'c', v.c + if(v.s + v.w < {u} * m, 1L, 0L))).c"
    sampled = f"transform(array({mass}), m -> least(r.b, r.a + {below}))[0]"
    return f"transform(array(named_struct('a', {first}, 'b', {end})), r -> if(r.a >= r.b, r.a, {sampled}))[0]"


def _sample(q: str, draw: str, u: str) -> str:
    """SQL of one multivariate-hypergeometric sample: how many of ``draw`` draws fall to each entry of the array ``q``."""
    zipped = f"zip_with({q}, sequence(0, size({q}) - 1), (k, i) -> named_struct('k', k, 'i', i))"
    start = f"named_struct('pop', aggregate({q}, 0L, (a, k) -> a + k), 'draw', {draw}, 'out', cast(array() as array<bigint>))"
    step = f"(t, g) -> transform(array({_hypergeometric(u, 't.pop', 'g.k', 't.draw')}), h -> named_struct('pop', t.pop - g.k, 'draw', t.draw - h, 'out', concat(t.out, array(h))))[0]"
    return f"if(size({q}) = 0, {q}, aggregate({zipped}, {start}, {step}).out)"


def shard_quotas(counts: DataFrame, shards: int, seed: int, sources: int) -> DataFrame:
    """``number`` and ``cuts``: where each shard's range of the source's draws ends, in the order of shards. Of ``sources``
    sources, ``counts`` has ``number`` (from 0, without gaps) and ``draws``.

    A row of the tree is one node's group of ``GROUP`` sources with their quotas in an array. A level splits every node: first
    its half among the groups by their sums, then a group's part among its sources, which together is one sample over all.
    """
    levels = (shards - 1).bit_length()
    if 1 << levels != shards:
        raise ValueError("the number of shards must be a power of two")
    sorted_draws = F.transform(F.array_sort(F.collect_list(F.struct("number", "draws"))), lambda x: x["draws"])  # GROUP at the most
    node = counts.groupBy(F.expr(f"number div {GROUP}").alias("grp")).agg(sorted_draws.alias("q")).select(F.lit(0).cast("bigint").alias("node"), "grp", "q")
    for level in range(levels):
        u = f"(shiftrightunsigned(xxhash64({seed}, {level}, node, %s), 11) * {2.0**-53!r}D)"
        if sources <= GROUP:
            node = node.withColumn("draw", F.expr("aggregate(q, 0L, (a, k) -> a + k) div 2"))
        else:  # one row for each node and group; a node's row of sums is as long as there are groups
            node = written(node, "mix-tree")
            sums = node.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("grp", F.expr("aggregate(q, 0L, (a, k) -> a + k)").alias("k")))).alias("g"))
            sums = sums.selectExpr("node", "transform(g, x -> x.grp) as grps", "transform(g, x -> x.k) as ks").selectExpr("node", "grps", f"{_sample('ks', 'aggregate(ks, 0L, (a, k) -> a + k) div 2', u % '-1L, g.i')} as parts")
            node = node.join(sums.selectExpr("node", "inline(arrays_zip(grps, parts))").toDF("node", "grp", "draw"), ["node", "grp"])
        node = (
            node.selectExpr("node", "grp", "q", f"{_sample('q', 'draw', u % 'grp, g.i')} as l")
            .selectExpr("grp", "explode(array(named_struct('node', node * 2, 'q', l), named_struct('node', node * 2 + 1, 'q', zip_with(q, l, (a, b) -> a - b)))) as c")
            .select("c.node", "grp", "c.q")
        )
        if level == 6:  # from here on there are rows enough for many tasks
            node = node.repartition("node", "grp")
    upto = Window.partitionBy("number").orderBy("node").rowsBetween(Window.unboundedPreceding, 0)
    each = node.select("node", "grp", F.posexplode("q").alias("i", "draws")).withColumn("number", F.expr(f"grp * {GROUP} + i")).withColumn("cut", F.sum("draws").over(upto))
    return each.groupBy("number").agg(F.transform(F.array_sort(F.collect_list(F.struct("node", "cut"))), lambda x: x["cut"]).alias("cuts"))


@dataclass
class Mix:
    """The sources' table of a mix (its rows say for every document what is taken of it), its shards, the parts of each, and
    whether the table is small enough for a broadcast."""

    sources: DataFrame
    shards: int
    parts: int
    few: bool
    seed: int


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> tuple[Column, Column, Column]:
    column = lambda name: F.col("`" + name.replace("`", "``") + "`")
    text = column(text_col).cast("string")
    return column(source_col).cast("string"), F.xxhash64(F.lit(seed), column(id_col), text), text


def plan_sources(docs: DataFrame, weights: Sequence[float], cap: int, block_words: int, shards: int | None, seed: int) -> Mix:
    """The mix of ``docs`` (``source``, ``key`` and ``size`` of every document)."""
    sizes = written(docs.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sizes")
    n, total = sizes.agg(F.count("*"), F.coalesce(F.sum("source_size"), F.lit(0))).first()
    if shards is None:
        shards = min(MOST_SHARDS, max(LEAST_SHARDS, 1 << max(0, -(-total // SHARD_WORDS) - 1).bit_length()))
    few = n * shards <= BROADCAST_ENDS
    counts = written(draw_counts(source_targets(sizes, weights, cap, n), docs, block_words, seed, few), "mix-counts")
    sources = written(counts.join(shard_quotas(counts, shards, seed, n), "number"), "mix-sources")
    return Mix(sources, shards, max(1, -(-total // (shards * PART_WORDS))), few, seed)


def _taken(mix: Mix, rows: DataFrame, size: str) -> DataFrame:
    """``rows`` (``source``, ``key``) with their source's ``source_size`` and ``target``, and ``pieces``; ``size`` is SQL of a
    number of words that is at least 1 where the row has any, or of the size itself."""
    levels = (mix.shards - 1).bit_length()
    known = mix.sources.withColumnRenamed("source", "s")
    joined = rows.join(F.broadcast(known) if mix.few else known, F.col("source").eqNullSafe(F.col("s")))
    u = f"shiftrightunsigned(xxhash64(key, {mix.seed}, monotonically_increasing_id()), 11) * {2.0**-53!r}D"
    part = f"if(same = 1, some, cast(floor(some / same + {u}) as bigint))"
    # what the last epoch takes: whole rows before the stop (null stands for the whole), a part at it, nothing behind it
    last = "case when p < stop or p = stop and key < stop_key then cast(null as bigint) when p = stop and key = stop_key then part else 0L end"
    # the shard whose range of draws holds this one, by halving
    shard = f"aggregate(sequence(1, {levels}), 0, (a, l) -> if(cuts[a + cast(power(2, {levels} - l) as int) - 1] <= d, a + cast(power(2, {levels} - l) as int), a))" if levels else "0"
    of = f"named_struct('epoch', cast(e as int), 'draw', e * blocks + p, 'words', if(e < epochs, cast(null as bigint), {last}))"
    at = permuted("block", "blocks", "number", "e", mix.seed)
    epochs = "sequence(0L, epochs - if(stop is null, 1L, 0L))"
    drawn = f"if({size} > 0 and draws > 0, transform({epochs}, e -> transform(array({at}), p -> {of})[0]), array())"
    kept = f"transform(filter({drawn}, x -> x.words is null or x.words > 0), x -> transform(array(x.draw), d -> named_struct('shard', {shard}, 'epoch', x.epoch, 'words', x.words, 'place', xxhash64({mix.seed}, d, key)))[0])"
    return joined.withColumn("part", F.expr(part)).withColumn("block", F.expr(_block(mix.seed))).selectExpr(*[f"`{c}`" for c in rows.columns], "source_size", "target", f"{kept} as pieces")


def plan_mix(
    docs: DataFrame,
    carry: Sequence[str] = ("doc_id",),
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    cap: int = 3,
    block_words: int = 1 << 14,
    shards: int | None = None,
    seed: int = 17,
) -> DataFrame:
    """One row for every row of ``docs``: the columns of ``carry`` (slim ones; ``mixed`` gives whole rows) under their names in
    the struct ``row``, ``size``, ``source``, ``source_size``, ``target``, and ``pieces``: what the mix takes of it, each time with
    the ``shard``, the ``epoch``, the number of ``words`` (the first ones) and the ``place`` in the shard."""
    source, key, text = _keyed(docs, id_col, text_col, source_col, seed)
    row = F.struct(*[F.col("`" + c.replace("`", "``") + "`").alias(c) for c in carry])
    sized = written(docs.select(row.alias("row"), source.alias("source"), key.alias("key"), words(text).alias("size")), "mix-documents")
    mix = plan_sources(sized, weights, cap, block_words, shards, seed)
    told = _taken(mix, sized, "size")
    return told.selectExpr("row", "size", "source", "source_size", "target", "transform(pieces, x -> named_struct('shard', x.shard, 'epoch', x.epoch, 'words', least(size, coalesce(x.words, size)), 'place', x.place)) as pieces")


def taken_words() -> Column:
    """Words that the mix takes of a planned row, repeats counted."""
    return F.aggregate("pieces", F.lit(0).cast("bigint"), lambda a, x: a + x["words"])


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    cap: int = 3,
    block_words: int = 1 << 14,
    shards: int | None = None,
    seed: int = 17,
) -> DataFrame:
    """The mix itself: a row of ``docs`` for each time it is taken, in the struct ``row``, with its ``shard``; where a text isn't
    taken whole, ``text_col`` has its first words. A shard is one partition or, if large, as many as it has parts, each in the
    order of its hash. Texts move once; a table of too many sources for a broadcast moves them once more, to their sources."""
    source, key, text = _keyed(docs, id_col, text_col, source_col, seed)
    mix = plan_sources(written(docs.select(source.alias("source"), key.alias("key"), words(text).alias("size")), "mix-documents"), weights, cap, block_words, shards, seed)
    whole = docs.select(F.struct(*[c.alias(n) for c, n in zip(all_columns(docs), docs.columns, strict=True)]).alias("row"), source.alias("source"), key.alias("key"), F.coalesce(text.rlike(WORD).cast("int"), F.lit(0)).alias("any"))
    each = _taken(mix, whole, "any").select("row", "key", F.explode("pieces").alias("piece"))
    text = F.col(f"row.`{text_col}`").cast("string")
    first = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD_AND_SPACE), F.lit(0)), 1, F.col("piece.words").cast("int")), "")
    cut = F.when(F.col("piece.words").isNull(), text).otherwise(first)
    row = F.struct(*[cut.alias(c) if c == text_col else F.col("row.`" + c.replace("`", "``") + "`").alias(c) for c in docs.columns])
    part = F.pmod(F.xxhash64("key", "piece.place", F.monotonically_increasing_id()), F.lit(mix.parts))  # equal rows in all parts
    dealt = each.select(row.alias("row"), F.col("piece.shard").alias("shard"), part.cast("int").alias("part"), F.col("piece.place").alias("place"))
    return dealt.repartitionById(mix.shards * mix.parts, F.col("shard") * mix.parts + F.col("part")).sortWithinPartitions("shard", "place").select("shard", "row")
