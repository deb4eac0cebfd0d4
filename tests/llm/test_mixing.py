"""Mixing: targets, exact draws, disjointness, trees, reruns and edge cases, against plain recomputation."""

import random
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import mixing

SCHEMA = "doc_id bigint, text string, source string, pieces int"


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """Reshare what is over until no source is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        if not free:
            return fixed
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: cap * sizes[s] for s in over}


def corpus(spark, seed=1, n=300):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["b", "a", None, "é", "Z", "tiny"] if i % 50 == 0 else ["b", "a", "a", "a", None, "é", "Z"])
        text = rng.choice([None, "", " \t\n"]) if rng.random() < 0.05 else " ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(1, 60)))
        rows.append((i if i % 40 else None, text, source, 7))
    rows += [(500, "same words here", "a", 7)] * 5 + [(501, " ".join(["long"] * 30_000), "b", 7)]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(5)


def sizes_of(rows):
    sizes = {}
    for _, text, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    return sizes


@pytest.mark.parametrize("block_words,shards,joined", [(64, 16, False), (64, 16, True), (16384, 4, False), (64, 1, False), (64, None, False)])
def test_targets_draws_and_reruns(spark, monkeypatch, block_words, shards, joined):
    if joined:  # a table of too many sources for a broadcast
        monkeypatch.setattr(mixing, "BROADCAST_ENDS", 0)
    rows, docs = corpus(spark)
    plan = mixing.plan_mix(docs, block_words=block_words, shards=shards).withColumn("taken", mixing.taken_words())
    found = plan.collect()
    assert len(found) == len(rows)
    sizes = sizes_of(rows)
    want, taken, places = brute_targets(sizes), {}, {}
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        drawn = [p.epoch for p in r.pieces]
        assert len(set(drawn)) == len(drawn) <= 3  # no word twice in an epoch
        assert all(0 <= p.shard < (shards or mixing.LEAST_SHARDS) and 0 < p.words <= r.size for p in r.pieces)
        assert sum(p.words < r.size for p in r.pieces) <= 1
        for p in r.pieces:
            places[p.shard] = places.get(p.shard, 0) + 1
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    cut = [(r.source, r.row.doc_id) for r in found for p in r.pieces if p.words < r.size]
    assert len(cut) <= len(sizes) + 4  # one document of each source is cut, or one of equal ones each
    if shards == 16:
        assert len(places) == shards
    again = mixing.plan_mix(docs.repartition(3), block_words=block_words, shards=shards).withColumn("taken", mixing.taken_words())
    key = lambda d: sorted(map(str, d.select("row", "size", "taken", "pieces").collect()))
    assert key(plan) == key(again)


def test_draws_are_the_blocks_permuted(spark):
    """Every epoch draws every block of a source once, and the last one the first blocks of its order."""
    rows, docs = corpus(spark, 3)
    sized = docs.select(F.col("source"), F.xxhash64(F.lit(17), "doc_id", "text").alias("key"), mixing.words(F.col("text")).alias("size"))
    mix = mixing.plan_sources(sized, (5, 2, 1), 3, 64, 8, 17)
    known = {r.source: r for r in mix.sources.collect()}
    for s, r in known.items():
        assert r.blocks == -(-r.source_size // 64) and r.cuts[-1] == r.draws == r.epochs * r.blocks + (0 if r.stop is None else r.stop + 1)
    drawn = sized.where("size > 0").join(mix.sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    drawn = drawn.withColumn("block", F.expr(mixing._block(17))).withColumn("place", F.expr(mixing.permuted("block", "blocks", "number", "epochs", 17)))
    sums = {}
    for r in drawn.collect():
        at = sums.setdefault(r.source, {"before": 0, "stop": 0})
        at["before"] += r.size if r.stop is not None and (r.place < r.stop or r.place == r.stop and r.key < r.stop_key) else 0
        at["stop"] += r.size if r.stop is not None and r.place == r.stop and r.key == r.stop_key else 0
    for s, r in known.items():
        if r.stop is not None:  # the running sum reaches what the last epoch has to give inside the key where it stops
            rest = int(r.target + 0.5) - r.epochs * r.source_size
            assert sums[s]["before"] + r.some == rest and 0 < r.some <= sums[s]["stop"]


def test_repeated_rows_where_the_target_falls(spark):
    rows = [(1, "one two three four", "a", 7)] * 400 + [(2, " ".join("w" for _ in range(4000)), "b", 7)]
    plan = mixing.plan_mix(spark.createDataFrame(rows, SCHEMA).repartition(7), shards=2).withColumn("taken", mixing.taken_words())
    want = brute_targets(sizes_of(rows))
    got = {r.source: r.t for r in plan.groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    assert abs(got["b"] - want["b"]) <= 1 and abs(got["a"] - want["a"]) <= 40


def test_many_sources(spark, monkeypatch):
    """Groups of sources, and targets by the contract's own words."""
    monkeypatch.setattr(mixing, "GROUP", 16)
    monkeypatch.setattr(mixing, "FEW_SOURCES", 10)
    rows = [(i, " ".join(["w"] * (1 + i % 37)), f"host{i % 301:03d}", 7) for i in range(1500)]
    plan = mixing.plan_mix(spark.createDataFrame(rows, SCHEMA).repartition(4), block_words=4, shards=8).withColumn("taken", mixing.taken_words())
    want, got = brute_targets(sizes_of(rows)), {}
    for r in plan.collect():
        assert r.target == pytest.approx(want[r.source])
        got[r.source] = got.get(r.source, 0) + r.taken
    assert all(abs(got[s] - want[s]) <= 1 for s in want)


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 64, 1000):
        at = spark.range(n).selectExpr(mixing.permuted("id", f"{n}L", "3", "1L", 9) + " AS p").distinct().agg(F.count("*"), F.min("p"), F.max("p")).first()
        assert tuple(at) == (n, 0, n - 1)


def test_hypergeometric_law(spark):
    u = "((id + 0.5D) / 20000)"
    found = spark.range(20000).selectExpr(mixing._hypergeometric(u, "50L", "20L", "25L") + " AS h").groupBy("h").count().collect()
    from math import comb

    for r in found:
        assert r["count"] / 20000 == pytest.approx(comb(20, r.h) * comb(30, 25 - r.h) / comb(50, 25), abs=2e-4)


@pytest.mark.parametrize("group", [256, 2])
def test_tree_keeps_quotas(spark, monkeypatch, group):
    monkeypatch.setattr(mixing, "GROUP", group)
    counts = spark.createDataFrame([(0, 1000), (1, 0), (2, 37), (3, 5)], "number bigint, draws bigint")
    cuts = {r.number: r.cuts for r in mixing.shard_quotas(counts, 8, 1, 4).collect()}
    assert [cuts[i][-1] for i in range(4)] == [1000, 0, 37, 5]
    each = [sum(c[j] - (c[j - 1] if j else 0) for c in cuts.values()) for j in range(8)]
    assert max(each) - min(each) <= 1 and sum(each) == 1042


def test_the_tree_samples_by_the_law(spark, monkeypatch):
    """How many of a source's draws fall to the first half, over many seeds, in one group and in several."""
    from math import comb

    counts = spark.createDataFrame([(0, 6), (1, 3), (2, 7)], "number bigint, draws bigint").cache()
    for group in (256, 1):
        monkeypatch.setattr(mixing, "GROUP", group)
        halves = [next(r.cuts[0] for r in mixing.shard_quotas(counts, 2, seed, 3).collect() if r.number == 0) for seed in range(30)]
        mean = sum(h * comb(6, h) * comb(10, 8 - h) / comb(16, 8) for h in range(7))
        assert abs(sum(halves) / 30 - mean) < 0.6 and 0 <= min(halves) < max(halves) <= 6


@pytest.mark.parametrize("parts", [1, 3])
def test_mix_has_the_words(spark, monkeypatch, parts):
    rows, docs = corpus(spark, 2, 80)
    monkeypatch.setattr(mixing, "PART_WORDS", 1 << 22 if parts == 1 else 2900)
    clashing = docs.withColumns({c: F.lit(1) for c in ("row", "key", "shard", "place", "size", "a.b", "s", "number", "piece")})
    plan = mixing.plan_mix(docs, block_words=16, shards=4)
    out = mixing.mixed(clashing, block_words=16, shards=4)
    assert [f.name for f in out.schema["row"].dataType.fields] == clashing.columns
    want = plan.select("source", mixing.taken_words().alias("t")).groupBy("source").agg(F.sum("t").alias("t"))
    got = out.select("row.source", mixing.words(F.col("row.text")).alias("t")).groupBy("source").agg(F.sum("t").alias("t"))
    assert {r.source: r.t for r in got.collect()} == {r.source: r.t for r in want.collect() if r.t}
    each = plan.select("row.doc_id", F.explode("pieces").alias("p")).select("doc_id", "p.shard", "p.words").collect()
    found = out.select("row.doc_id", "shard", mixing.words(F.col("row.text")).alias("words")).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.shard, r.words)
    assert sorted(map(key, found)) == sorted(map(key, each))
    texts = {r[0]: r[1] for r in rows}
    assert all(r.row.doc_id is None or texts[r.row.doc_id].startswith(r.row.text) for r in out.collect())
    where = out.withColumn("at", F.spark_partition_id()).groupBy("at").agg(F.countDistinct("shard").alias("n")).collect()
    assert all(r.n == 1 for r in where) and (parts == 1 and len(where) == 4 or len(where) > 4)


def test_texts_move_once(spark):
    plan = mixing.mixed(corpus(spark, 2, 80)[1].coalesce(1))._jdf.queryExecution().executedPlan().toString()
    # the exchange to the shards, and in the plan of the fixture its own
    assert plan.count("Exchange ") - plan.count("BroadcastExchange") <= 2


def test_empty_and_blank_tables(spark):
    assert mixing.plan_mix(spark.createDataFrame([], SCHEMA)).count() == 0
    blank = mixing.plan_mix(spark.createDataFrame([(1, None, None, 1), (2, "", "a", 1)], SCHEMA)).withColumn("taken", mixing.taken_words()).collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0)] * 2
