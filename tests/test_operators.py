"""Relational operators, samples, near duplicates, chunks and replay."""

import random
import re
from itertools import dropwhile

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import automaton, records
from corpusloom.operators import graph, joins, neardup, order, replay, retrieval, sampling, stats, vector_index
from corpusloom.operators.graph import components
from corpusloom.plans import pipelines
from corpusloom.sources import rest


def ids(df, column="id"):
    return sorted(r[0] for r in df.select(column).collect())


def test_budget(spark):
    rows = spark.createDataFrame([(i, 5) for i in range(3)], "id bigint, t int")
    for limit, n in ((0, 3), (None, 3), (5, 1), (6, 2), (10, 2), (11, 3), (99, 3)):
        assert len(ids(order.budget_cut(rows, F.col("t"), limit, "id"))) == n
    rng = random.Random(1)
    data = [(i, rng.choice([None, 1, 2, 3])) for i in range(500)] + [(None, 7)]
    found = order.running_sum(spark.createDataFrame(data, "id bigint, t int").repartition(7), F.col("t"), "id").collect()
    total, want = 7, {None: 7}
    for i, t in data[:-1]:
        total += t or 0
        want[i] = total
    assert {r.id: r.running for r in found} == want


def test_every_nth_counts_rejected(spark):
    rows = spark.range(100).withColumn("ok", F.col("id") % 20 != 9)
    assert ids(order.every_nth(rows, 10, "id", F.col("ok"))) == [19 + 20 * k - 0 for k in range(0)] + [i for i in range(9, 100, 10) if i % 20 != 9]


def test_keep_first(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, ""), (4, ""), (5, None), (6, None)], "id int, k string")
    assert ids(order.keep_first(rows, ["k"], ["id"])) == [1, 3, 5, 6]
    assert ids(order.keep_first(rows, ["k"], ["id"], "keep")) == [1, 3, 4, 5, 6]


def test_cascade_and_merge(spark):
    rows = spark.createDataFrame([(1, "D1", "t"), (2, "x", "t1"), (3, "D1", "t1"), (4, "", ""), (5, None, "no")], "id int, d string, t string")
    known = spark.createDataFrame([("d1", "t1"), ("", "")], "d string, t string")
    found = joins.cascade_reasons(rows, known, [("doi", F.lower("d"), F.col("d")), ("title", F.col("t"), F.col("t"))])
    assert {r.id: r.reason for r in found.collect()} == {1: "doi", 2: "title", 3: "doi", 4: None, 5: None}
    more = spark.createDataFrame([(10, "a"), (11, "b"), (12, "b"), (13, ""), (14, "")], "id int, k string")
    merged = joins.append_new(spark.createDataFrame([(1, "a")], "id int, k string"), more, "k", "id")
    assert ids(merged) == [1, 11, 13, 14]
    assert ids(joins.unseen(rows.select("id", "d"), spark.createDataFrame([("x",), (None,)], "k string"), F.col("d"), F.col("k"))) == [1, 3, 4, 5]


def test_nearest_known(spark):
    rng = random.Random(2)
    p, q = [[(i, rng.random(), rng.random()) for i in range(n)] for n in (60, 40)]
    found = joins.nearest_known(spark.createDataFrame(p, "id int, x double, y double"), spark.createDataFrame(q, "k int, x double, y double"), ["x", "y"], 0.1, "id", "k")
    want = {i: min((k for k, u, v in q if abs(u - x) < 0.1 and abs(v - y) < 0.1), default=None) for i, x, y in p}
    assert {r.id: r.known_k for r in found.collect()} == want


@pytest.mark.parametrize("cell_rows", [4096, 5])
@pytest.mark.parametrize("columns", [["x"], ["x", "y"], ["x", "y", "z"]])
def test_nearest_known_in_crowded_cells(spark, monkeypatch, columns, cell_rows):
    """Nine tenths share the first column, many points are the same, some lack a coordinate."""
    monkeypatch.setattr(joins, "CELL_ROWS", cell_rows)
    rng = random.Random(6)
    made = lambda n: [(i, 1.0 if rng.random() < 0.9 else rng.random() * 3 - 1, rng.choice([0.5, None, float("nan"), rng.random() * 2 - 1, -0.2]), rng.choice([0.1, 0.3, -0.3])) for i in range(n)]
    p, q = made(150), made(90)
    at = [{"x": 1, "y": 2, "z": 3}[c] for c in columns]
    found = joins.nearest_known(spark.createDataFrame(p, "id int, x double, y double, z double"), spark.createDataFrame(q, "k int, x double, y double, z double"), columns, 0.25, "id", "k")
    ok = lambda a, b: all(a[i] is not None and b[i] is not None and abs(a[i] - b[i]) < 0.25 for i in at)
    assert {r.id: r.known_k for r in found.collect()} == {a[0]: min((b[0] for b in q if ok(a, b)), default=None) for a in p}
    assert found.columns == ["id", "x", "y", "z", "known_k", "known_x", "known_y", "known_z"]


@pytest.mark.parametrize("cell_rows", [4096, 5])
def test_nearest_known_neither_sorts_nor_gathers_matches(spark, monkeypatch, cell_rows):
    """What points meet is many times what they are: it is brought down by hash, so a task holds a row for a point."""
    monkeypatch.setattr(joins, "CELL_ROWS", cell_rows)
    p = spark.range(2000).select("id", (F.col("id") % 7 / 5.0).alias("x"))
    q = spark.range(300).select(F.format_string("k%03d", F.lit(299) - F.col("id")).alias("k"), (F.col("id") / 1000.0).alias("x"), F.lit("v").alias("v"))
    found = joins.nearest_known(p, q, ["x"], 0.5, "id", "k")
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    assert {(r.id % 7, r.known_k, r.known_v) for r in found.collect()} == {(i, "k000", "v") if i < 4 else (i, None, None) for i in range(7)}


@pytest.mark.parametrize("cell_rows", [4096, 2])
def test_nearest_known_at_odd_values(spark, monkeypatch, cell_rows):
    """A reach that rounding stretches over three cells, infinite and huge coordinates, equal orders and orders that are null."""
    monkeypatch.setattr(joins, "CELL_ROWS", cell_rows)
    odd, inf = 0.49999999999999994, float("inf")
    at = lambda p, q: {r.id: (r.known_k, r.known_v) for r in joins.nearest_known(spark.createDataFrame(p, "id int, x double"), spark.createDataFrame(q, "k int, x double, v string"), ["x"], 0.5, "id", "k").collect()}
    assert at([(1, odd), (2, 0.3)], [(5, 0.3, "a"), (4, odd, "b"), (9, 7.0, "c")]) == {1: (4, "b"), 2: (4, "b")}
    assert at([(1, odd)], [(5, 0.3, "a"), (6, 8.0, "b"), (7, 9.0, "c")]) == {1: (5, "a")}
    assert at([(1, 0.3)], [(5, odd, "a"), (6, 8.0, "b"), (7, 9.0, "c")]) == {1: (5, "a")}
    huge = [(1, inf, "a"), (2, -inf, "b"), (3, 1e300, "c"), (4, -1e300, "d"), (5, 2.0**53, "e")]
    assert at([(i, x) for i, x, _ in huge], huge) == {1: (None, None), 2: (None, None), 3: (3, "c"), 4: (4, "d"), 5: (5, "e")}
    assert at([(1, 1.0), (2, 5.0)], [(None, 1.0, "a"), (8, 1.1, "c"), (8, 1.2, "b"), (None, 5.0, "d")]) == {1: (8, "c"), 2: (None, "d")}


def test_statistics(spark):
    for n in (1, 2, 4, 5):
        row = stats.index_quantiles(spark.range(n).withColumn("g", F.lit("x")), ["g"], "id", [25, 50, 75, 95]).first()
        assert (row.n, row.q25, row.q50, row.q75, row.q95) == (n, n * 25 // 100, n // 2, n * 75 // 100, n * 95 // 100)
    rows = spark.createDataFrame([(1, True, False), (2, False, True), (3, True, True)], "id int, a boolean, b boolean")
    assert tuple(stats.changes(rows, "a", "b").first()) == (3, 1, 1, 1)
    assert [tuple(r) for r in stats.accuracy(rows.limit(0), "a", "id").collect()] == [("(all)", 0, 0, 0.0)]
    seen = spark.createDataFrame([(1, "b"), (2, "a"), (3, "a"), (4, "b"), (5, "c")], "at int, g string")
    assert [r.g for r in stats.top_groups(seen, "g", 2).collect()] == ["a", "b"] and [r.g for r in stats.top_groups(seen, "g", 2, "at").collect()] == ["b", "a"]
    assert sorted((r.g or "", r.is_total, r.pages, r.chars) for r in stats.totals(seen, "g", "at").collect()) == [("", 1, 5, 15), ("a", 0, 2, 5), ("b", 0, 2, 5), ("c", 0, 1, 5)]


@pytest.mark.parametrize("few", [0, 1_000_000])
def test_quantiles_of_hot_groups(spark, monkeypatch, few):
    """A group with most rows, frequent values, nulls as groups, and names that clash; cut into ranges or not."""
    monkeypatch.setattr(stats, "FEW_VALUES", few)
    rng = random.Random(4)
    rows = [(rng.choice(["a", "a", "a", None, "b"]), rng.choice([7, 7, rng.randrange(-50, 50), rng.randrange(10**6)]), 1) for _ in range(3000)] + [("c", None, 1), ("d", 5, 1)]
    table = spark.createDataFrame(rows, "g string, v bigint, _n int").repartition(5)
    for found in (stats.index_quantiles(table, ["g"], "v", [0, 25, 50, 95]), stats.index_quantiles(table.withColumn("v", F.col("v").cast("string")), ["g"], "v", [50]).limit(0)):
        for r in found.collect():
            values = sorted(v for g, v, _ in rows if g == r.g and v is not None)
            assert (r.n, r.q0, r.q25, r.q50, r.q95) == (len(values), *(values[len(values) * q // 100] for q in (0, 25, 50, 95)))
    told = {r.g: r for r in stats.percentiles(table, ["g"], "v", {"m": 0.5, "p": 0.9, "top": 1.0}).collect()}
    assert set(told) == {"a", "b", "d", None}
    for g, r in told.items():
        values = [v for x, v, _ in rows if x == g and v is not None]
        assert (r.m, r.p, r.top) == pytest.approx((np.median(values), np.percentile(values, 90), max(values)))
    whole = stats.percentiles(table, [], "v", {"m": 0.25}).first()
    assert whole.m == pytest.approx(np.percentile([v for _, v, _ in rows if v is not None], 25))


def test_running_sums_within_groups_and_of_frequent_values(spark):
    rng = random.Random(6)
    rows = [(rng.choice("aab"), rng.choice([3, 3, 3, 5, rng.randrange(100), None]), i, rng.randrange(5)) for i in range(2000)]
    table = spark.createDataFrame(rows, "g string, o int, i int, _value int").repartition(6)
    for groups in ((), ("g",)):
        found = {r.i: r.running for r in order.running_sum(table, F.col("_value"), "o", ("i",), groups=groups).collect()}
        totals, want = {}, {}
        for g, o, i, v in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
            key = g if groups else ""
            want[i] = totals[key] = totals.get(key, 0) + v
        assert found == want
    assert order.running_sum(table, F.lit(1), "o", ("i",)).columns == [*table.columns, "running"]


def test_quotas_of_large_groups(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") < 4000, "big").when(F.col("id") < 4500, "mid").otherwise("none").alias("g"), F.lit(1).alias("_rank"))
    quotas = spark.createDataFrame([("big", 20), ("mid", 10_000), ("absent", 5), ("zero", 0)], "g string, quota int")
    want = sampling.sample_quotas(rows, quotas, "g", "id", 3)
    assert want.columns == rows.columns and want.count() == 520
    assert ids(sampling.sample_quotas(rows, quotas, "g", "id", 3, large=100)) == ids(want)
    alike = rows.withColumn("id", F.lit(5))  # equal keys draw alike, above the bound or below it
    assert sampling.sample_quotas(alike, quotas, "g", "id", 3, large=100).count() == 520


def test_samples(spark):
    rows = spark.range(1000).withColumn("g", F.col("id") % 3)
    assert sampling.sample_n(rows, ["g"], "id", 5, 1).groupBy("g").count().where("count <> 5").count() == 0
    assert ids(sampling.sample_n(rows, [], "id", 10, 1)) == ids(sampling.sample_n(rows.repartition(9), [], "id", 10, 1))
    split = sampling.hash_split(rows, "id", 0.3, 1).groupBy("split").count().collect()
    assert sum(r["count"] for r in split) == 1000 and 230 < next(r["count"] for r in split if r.split == "val") < 370
    assert [r.id for r in sampling.shuffled(rows, "id", 1).collect()] != list(range(1000))
    with pytest.raises(ValueError):
        sampling.budgeted_mix(rows, rows, 1.0)


def test_mix_ledger(spark):
    text = lambda n: " ".join("w" * n)
    domain = spark.createDataFrame([(i, text(10)) for i in range(30)] + [(99, ""), (98, None)], "doc_id bigint, text string")
    general = spark.createDataFrame([(100 + i, text(7)) for i in range(50)], "doc_id bigint, text string")
    mix = sampling.budgeted_mix(domain, general, 0.25)
    told = {r.part: r.t for r in mix.groupBy("part").agg(F.sum("tokens").alias("t")).collect()}
    assert told["domain"] == 390 and 130 <= told["general"] < 130 + 9
    assert sampling.budgeted_mix(domain, general, 0).where("part = 'general'").count() == 0


@pytest.mark.parametrize("least_hot", [500, 2])
def test_components(spark, monkeypatch, least_hot):
    monkeypatch.setattr(graph, "LEAST_HOT", least_hot)  # at 2 the star's centre is joined by broadcast
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 3), (5, 6), (7, 7)] + [(100 + i, 101 + i) for i in range(60)] + [(200, 200 + i) for i in range(1, 50)], "u bigint, v bigint")
    found = {r.node: r.root for r in components(edges).collect()}
    assert [found[i] for i in (1, 2, 3, 9, 5, 6)] == [1, 1, 1, 1, 5, 5] and 7 not in found
    assert {found[100 + i] for i in range(61)} == {100} and {found[200 + i] for i in range(50)} == {200}
    assert components(edges.limit(0)).count() == 0


def test_chains_become_stars_of_ranges(spark, monkeypatch):
    monkeypatch.setattr(graph, "TIED", 1000)
    steps, keep = [], graph.written
    monkeypatch.setattr(graph, "written", lambda df, label: steps.append(label) or keep(df, label))
    edges = spark.range(10, 20000).selectExpr("id AS u", "id - 10 AS v")
    found = components(edges)
    assert found.count() == 20000 and found.where("root <> node % 10").count() == 0
    assert len(steps) <= 16  # doubling alone takes 25, and more for longer chains


def test_document_clusters(spark):
    rng = random.Random(1)
    base = [f"w{rng.randrange(500)}" for _ in range(200)]
    rows = [(1, " ".join(base)), (2, " ".join(base)), (3, " ".join([*base[:-1], "x"])), (4, " ".join(rng.choices("abcdefgh", k=90))), (5, ""), (6, None), (7, "a b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.id: r.cluster for r in neardup.document_clusters(docs).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 5, 7: 7}
    sure = {r.id: r.cluster for r in neardup.document_clusters(docs, n_bands=32, rows=4, verify=0.8).collect()}
    assert sure == found
    assert {r["size"]: (r.n_clusters, r.removed) for r in neardup.cluster_sizes(neardup.document_clusters(docs)).collect()} == {3: (1, 2), 2: (1, 1)}
    pairs = {(r.i, r.j): r.similarity for r in neardup.exact_pairs(docs).collect()}
    assert list(pairs) == [(1, 3)] and pairs[1, 3] == pytest.approx(195 / 197)


def test_verified_clusters_behind_a_stranger(spark):
    rng = random.Random(9)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    text = words(120)
    rows = [(i, " ".join([*text, *words(70)])) for i in range(800)]  # strangers: alike by less than the threshold
    rows += [(1000, " ".join(text)), (1001, " ".join(text)), (1002, " ".join([*text[:-1], "x"]))]
    found = {r.id: r.cluster for r in neardup.document_clusters(spark.createDataFrame(rows, "doc_id bigint, text string"), n_bands=32, rows=4, verify=0.8).collect()}
    assert found == {i: 1000 if i >= 1000 else i for i, _ in rows}


def test_near_duplicates_with_texts_as_ids(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(200)]
    rows = [("b", " ".join(base)), ("a", " ".join([*base[:-1], "x"])), ("c", "something else is said here"), (None, " ".join(base))]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    for found in (neardup.document_clusters(docs), neardup.document_clusters(docs, n_bands=32, rows=4, verify=0.8)):
        assert {r.id: r.cluster for r in found.collect() if r.id} == {"a": "a", "b": "a", "c": "c"}
    assert sorted(r.id or "" for r in neardup.greedy_survivors(docs, "doc_id", "text").collect()) == ["", "a", "c"]


def test_greedy_order(spark):
    rows = [(1, "What is the boiling point of water at sea level?"), (2, "What is the boiling point of water at sea level ?"), (3, "Name three rivers in Europe and their lengths."), (4, "what is the boiling point of water at sea level?")]
    assert ids(neardup.greedy_survivors(spark.createDataFrame(rows, "id bigint, text string"), "id", "text")) == [1, 3]


@pytest.mark.parametrize("rounds", [0, 3])
def test_greedy_order_takes_hot_bands_whole(spark, monkeypatch, rounds):
    monkeypatch.setattr(neardup, "BLOCK", 50)
    monkeypatch.setattr(neardup, "ROUNDS", rounds)
    rng = random.Random(5)
    base = "".join(rng.choices("abcdefghij", k=300))
    texts = ["Say the same again, please."] * 120 + [base + str(i) for i in range(130)]
    for _ in range(40):  # chains: every text is a small change of the one before
        base = base[5:] + "".join(rng.choices("abcdefghij", k=5))
        texts.append(base)
    rows = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    sig = {r.id: np.array(r.s) for r in rows.select("id", neardup.md5_minhash("text").alias("s")).collect()}
    want: list[int] = []
    for i in range(len(texts)):  # at 0.8 of 128 values, one of 32 bands agrees whole
        if all((sig[i] == sig[j]).mean() < 0.8 for j in want):
            want.append(i)
    found = ids(neardup.greedy_survivors(rows, "id", "text"))
    assert found == want and 3 < len(want) < 60


def test_signatures_are_the_digests(spark):
    texts = [("What is the boiling point? " * 3,), ("",), ("日本 é",), (None,)]
    found = spark.createDataFrame(texts, "text string").select(neardup.md5_signature("text").alias("s"), neardup.md5_minhash("text").alias("m")).collect()
    assert all(bytes(r.s) == b"".join(bytes.fromhex(x)[:8] for x in r.m) for r in found)


@pytest.mark.parametrize("step,front", [(19, 40), (7, 1000), (13, 7)])
def test_chains_settle_in_fronts(spark, monkeypatch, step, front):
    """Long chains, each row like its next ones only, against the plain loop; no task of the fronts gets a whole component."""
    monkeypatch.setattr(neardup, "ROUNDS", 1)
    monkeypatch.setattr(neardup, "FRONT", front)
    chains, n = 3, 70
    rows = [(c * 1000 + i, np.array([((step * i + p) // 128) * 10 + c for p in range(128)], ">u8").tobytes()) for c in range(chains) for i in range(n)]
    want = []
    for i, sig in rows:
        if all(sum(sig[8 * p : 8 * p + 8] == other[8 * p : 8 * p + 8] for p in range(128)) / 128 < 0.8 for _, other in want):
            want.append((i, sig))
    random.Random(1).shuffle(rows)
    found = neardup.first_independent(spark.createDataFrame(rows, "id bigint, sig binary").repartition(4))
    assert ids(found) == [i for i, _ in want] and chains * 3 < len(want) < chains * n * 0.6


def test_exact_pairs_find_all(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(900)}" for _ in range(60)]
    rows = []
    for i in range(80):
        words = list(base)
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(60)] = f"n{rng.randrange(999)}"
        rows.append((i, " ".join(words)))
    sets = {}
    for i, t in rows:
        w = t.split()
        sets.setdefault(frozenset(" ".join(w[k : k + 5]) for k in range(56)), i)
    want = {(min(a, b), max(a, b)) for x, a in sets.items() for y, b in sets.items() if a != b and len(x & y) / len(x | y) >= 0.8}
    assert {(r.i, r.j) for r in neardup.exact_pairs(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()} == want


def test_signatures_need_bounded_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    docs = spark.createDataFrame([(1, "one two three four five six"), (2, "ä b"), (3, None)], "doc_id bigint, text string")
    told = {r.id: r.sig for r in neardup.document_signatures(docs).collect()}
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000
    plain = {r.doc_id: r.m for r in docs.select("doc_id", neardup.minhash("text").alias("m")).collect()}
    assert {i: [int.from_bytes(sig[at : at + 8], "big", signed=True) for at in range(0, 1024, 8)] for i, sig in told.items()} == plain


def test_workers_get_bounded_batches(spark, tmp_path):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(4)], "vec_id bigint, embedding array<double>")
    path = str(tmp_path / "index")
    vector_index.write_index(vectors, path)
    for work in (
        lambda: automaton.lexicon_hits(spark.createDataFrame([("a b",)], "t string"), "t", automaton.Automaton({"x": ["a"]})),
        lambda: retrieval.top_k(vectors, vectors, 1),
        lambda: vector_index.search_index(vectors, spark, path, 1),
    ):
        spark.conf.set(name, "10000")
        assert work().count() and int(spark.conf.get(name)) <= 1000


def test_exact_pairs_leave_out_sets_without_partners(spark, monkeypatch):
    rng = random.Random(5)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    line, texts = words(30), []
    for i in range(60):  # strangers with one line in common, and each tenth with a near copy whose change moves about
        texts.append([*words(100), *line])
        if i % 10 == 0:
            texts.append([*texts[-1][: i + 20], "x", *texts[-1][i + 21 :]])
    written_rows = {}
    keep = neardup.written
    monkeypatch.setattr(neardup, "written", lambda df, label: written_rows.setdefault(label, keep(df, label)))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    pairs = {(r.i, r.j) for r in neardup.exact_pairs(docs).collect()}
    assert pairs == {(11 * i, 11 * i + 1) for i in range(6)}
    assert {r.id for r in written_rows["exact-sets"].collect()} == {i for pair in pairs for i in pair}  # no set of a stranger moves


def near_texts(n: int) -> list[tuple[int, str]]:
    """Strangers, each third with a near copy."""
    rng, out = random.Random(11), []
    for i in range(n):
        words = [f"w{rng.randrange(10**6)}" for _ in range(80)]
        out.append(" ".join(words))
        if i % 3 == 0:
            out.append(" ".join([*words[:-1], "x"]))
    return list(enumerate(out))


def test_verified_clusters_compare_sets_once(spark, monkeypatch):
    labels = []
    keep = neardup.written
    monkeypatch.setattr(neardup, "written", lambda df, label: labels.append(label) or keep(df, label))
    docs = spark.createDataFrame([*near_texts(20), (99, None), (100, " "), (None, "a")], "doc_id bigint, text string")
    links = keep(neardup.exact_pairs(docs), "links")
    labels.clear()
    clusters = lambda **more: {(r.id, r.cluster) for r in neardup.document_clusters(docs, n_bands=32, rows=4, verify=0.8, **more).collect()}
    found = clusters()
    assert "exact-sets" in labels and "exact-partners" not in labels  # candidates have partners: none are looked for
    labels.clear()
    assert clusters(links=links) == found and sum(i != c for i, c in found if i != 100) == 7
    assert not {"exact-sets", "exact-prefixes"} & set(labels)  # links that are known are not sought again


def test_bands_of_the_same_rows_make_one_task(spark):
    sig = lambda *parts: np.concatenate([np.full(n, x, ">u8") for n, x in parts]).tobytes()
    rows = [(1, sig((128, 1))), (2, sig((120, 1), (8, 2))), (3, sig((60, 3), (60, 1), (8, 2))), (4, sig((128, 4)))]
    sets = spark.createDataFrame(rows, "id bigint, sig binary")

    def groups(threshold):
        found = {}
        for r in neardup._band_tasks(sets, sets.select("id", F.lit(False).alias("stays")), 32, 4, threshold).collect():
            found.setdefault((r.key, r.a, r.b), []).append(r.id)
            assert r.sig == dict(rows)[r.id]
        return sorted(found.values())

    assert groups(0.4) == [[1, 2], [1, 2, 3], [2, 3]]  # of 15 + 15 + 2 bands
    assert groups(0.8) == [[1, 2], [1, 2]]  # rows that aren't alike lend no signature


@pytest.mark.parametrize("threshold", [0.76, 0.8, 0.9, 1.0])
def test_keys_bring_all_similar_rows_together(threshold):
    places, rng, away = neardup._key_places(32, 4, threshold), np.random.default_rng(1), neardup.HASHES - neardup._agreeing(threshold)
    assert min(map(len, places)) > 4  # longer than the bands, and none is missed
    parts = np.array_split(np.arange(neardup.HASHES), away // 2 + 1)
    hard = [np.concatenate([rng.choice(part, min(2, away), False) for part in parts])[:away] for _ in range(200)]
    for differ in [*hard, *(rng.choice(neardup.HASHES, away, False) for _ in range(200))]:
        assert any(not np.isin(at, differ).any() for at in places)
    assert [at.tolist() for at in neardup._key_places(32, 4, 0.6)] == [[4 * b + i for i in range(4)] for b in range(32)]  # more may differ than bands are there


def test_strangers_of_a_band_share_no_key(spark):
    rng = np.random.default_rng(2)
    sig = rng.integers(0, 1 << 62, (300, neardup.HASHES))
    sig[:, 8:12] = 7  # one band of 32 is the same, which made 44,850 pairs
    sig[1] = np.where(np.arange(neardup.HASHES) < 20, sig[1], sig[0])
    rows = spark.createDataFrame([(i, False, x.astype(">u8").tobytes()) for i, x in enumerate(sig)], "id bigint, stays boolean, sig binary")
    met = neardup._with_keys(rows, neardup._key_places(32, 4, 0.8)).groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("last")).where("n > 1").collect()
    assert met and {(r.n, r["last"]) for r in met} == {(2, 1)}


@pytest.mark.parametrize("few,once", [(24, 1 << 16), (3, 40)])
def test_near_sketches_are_those_of_a_plain_loop(monkeypatch, few, once):
    monkeypatch.setattr(neardup, "FEW", few)
    monkeypatch.setattr(neardup, "ROWS_AT_ONCE", once)
    rng, rows = np.random.default_rng(4), []
    for task, size in enumerate([1, 2, 2, 3, 5, 30, 60, 1, 7, 40]):
        base = rng.integers(-(1 << 63), 1 << 63, (3, 4))
        for i in range(size):
            sketch = base[rng.integers(3)] ^ (1 << rng.integers(0, 62, 4)) * (rng.random(4) < 0.7)
            rows.append((task, 0, task % 2, i, bool(rng.random() < 0.4), int(rng.integers(2)) if task % 2 else 0, *map(int, sketch)))

    def alike(x, y, away):
        apart = sum(bin(((x[6 + w] ^ y[6 + w]) | (x[8 + w] ^ y[8 + w])) & (1 << 64) - 1).count("1") for w in (0, 1))
        return x is not y and x[0] == y[0] and apart <= away and not (x[4] and y[4]) and (x[1] == x[2] or x[5] != y[5])

    names = ["key", "a", "b", "id", "stays", "block", "s0", "s1", "s2", "s3"]
    batches = pa.Table.from_pylist([dict(zip(names, r, strict=True)) for r in rows]).to_batches(max_chunksize=7)
    for away in (2, 4):
        parts = list(neardup._whole_tasks(batches))
        assert len(parts) > 1 or once > len(rows)
        assert [near for part in parts for near in neardup._near(part, away).tolist()] == [any(alike(x, y, away) for y in rows) for x in rows]


@pytest.mark.parametrize("threshold", [0.6, 0.9])
def test_greedy_order_at_other_thresholds(spark, monkeypatch, threshold):
    """Against the plain loop; rows without a similar one are in the first round only."""
    asked = []
    keep = neardup.written
    monkeypatch.setattr(neardup, "written", lambda df, label: (out := keep(df, label), label == "neardup-keys" and asked.append(out.count()))[0])
    rng = np.random.default_rng(6)
    sig = rng.integers(0, 1 << 62, (120, neardup.HASHES))
    for i in range(1, 60):  # near to one before it, by more and less than the threshold
        other = sig[rng.integers(i)]
        sig[i] = np.where(rng.random(neardup.HASHES) < rng.choice([0.05, 0.12, 0.3, 0.45]), sig[i], other)
    bands = sig.reshape(120, 32, 4)
    want: list[int] = []
    for i in range(120):
        if all((sig[i] == sig[j]).mean() < threshold or not (bands[i] == bands[j]).all(1).any() for j in want):
            want.append(i)
    rows = spark.createDataFrame([(i, x.astype(">u8").tobytes()) for i, x in enumerate(sig)], "id bigint, sig binary").repartition(3)
    assert ids(neardup.first_independent(rows, threshold)) == want and 70 < len(want) < 115
    assert asked[0] == 120 and len(asked) > 1 and max(asked[1:]) <= 60


def test_instructions_said_often_are_spread(spark):
    long = "What is said here is long enough. " * 4
    rows = [(i, f" SAME words as ever, {'again' if i % 2 else 'AGAIN'}\n", long, "fact") for i in range(400, 0, -1)]
    rows += [(500, "x", long, "fact"), (501, "X ", long, None), (None, "same words as ever, again", long, "fact"), (502, None, long, "fact"), (500, "Something else is asked for.", "short", "x"), (1, "Something else is asked for.", long, "x")]
    pairs = spark.createDataFrame(rows, "id bigint, instruction string, output string, type string").repartition(4, "instruction")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        told = pipelines.instruction_set(pairs, "id", ["the re"], None)
        assert told.columns == ["id", "instruction", "output", "type", "reason"]
        found = told.withColumn("part", F.spark_partition_id()).collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    often = [r for r in found if r.id is not None and r.id <= 400 and r.instruction.lower().startswith(" same")]
    assert {r.id for r in often if r.reason is None} == {1} and sum(r.reason == "duplicate" for r in often) == 399
    assert len({r.part for r in often}) == 4  # in one place, as long as instructions were joined
    rest = sorted(((r.id, r.instruction, r.reason) for r in found if r not in often), key=str)
    assert rest == sorted([(500, "x", "instruction_too_short"), (501, "X ", "duplicate"), (None, "same words as ever, again", None), (500, "Something else is asked for.", "duplicate"), (1, "Something else is asked for.", None)], key=str)


@pytest.mark.parametrize("hashed", [1 << 20, 5])
def test_word_hashes_tell_words(spark, monkeypatch, hashed):
    monkeypatch.setattr(neardup, "HASHED", hashed)
    texts = ["", "a b", " ab\x0b ba\t", "é e\u0301 \x1c\xa0", "", "abcdefghijklmnop a", "\n", "ab"]
    want = [re.findall("[^ \t-\r]+", t) for t in texts]
    got, counts = neardup._word_hashes(pa.array(["zz", *texts]).slice(1))
    assert counts.tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    assert len(set(got.tolist())) == len(set(flat)) == len(set(zip(flat, got.tolist(), strict=True)))


def test_exact_members_tell_all_documents(spark):
    base = [f"w{i}" for i in range(100)]
    near = " ".join([*base, "x"])
    rows = [(1, " ".join(base)), (2, near), (3, near.upper()), (4, "lone  copy"), (5, "Lone copy"), (6, None), (7, " "), (8, "else")]
    found = {r.id: (r.representative, r.class_id, r.n_links) for r in neardup.exact_members(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found == {1: (1, 1, 2), 2: (2, 1, 2), 3: (2, 1, 2), 4: (4, 4, 1), 5: (4, 4, 1), 6: (6, 6, 1), 7: (6, 6, 1), 8: (8, 8, 0)}


# the chunks of a text by a plain loop


def plain_tokens(text: str) -> int:
    """Words times 1.3, rounded down."""
    return int(len(text.split()) * 1.3)


def plain_field(text: str, start: str, ends: tuple[str, ...]) -> str:
    """What follows a field's name and the white space behind it, up to a later line that begins with one of the ends; empty if
    the text has no such field. (An empty field so has the next one's name in it.)"""
    _, name, rest = text.partition(start)
    if not name:
        return ""
    rest = rest.lstrip()
    stops = [at for at in (rest.find(f"\n{end}") for end in ends) if at >= 0]
    return rest[: min(stops)].strip() if stops else rest.strip()


def plain_parts(text: str, compat: bool = True) -> tuple[str, str, str]:
    """Title, abstract and body. A text without a title line is all body. ``compat`` gives a text with an abstract but no
    ``Full Text:`` no body; else its body is what follows the abstract's first paragraph."""
    if not text.startswith("Title:"):
        return "", "", text.strip()
    title = text.removeprefix("Title:").lstrip().split("\n", 1)[0].strip()
    found = {name: plain_field(text, *limits) for name, limits in retrieval.FIELDS.items()}
    if found["body"] or found["abstract"] and compat:
        return title, found["abstract"], found["body"]
    if found["abstract"]:
        head, _, rest = found["abstract"].partition("\n\n")
        return title, head, rest.strip()
    heads = tuple(f"{name}:" for name in retrieval.HEAD_LINES)
    return title, "", "\n".join(dropwhile(lambda line: line.startswith(heads), text.split("\n"))).strip()


class PlainPack:
    """Collects pieces up to the chunk's size; what it hands out, it keeps the tail of."""

    def __init__(self, glue: str):
        self.glue, self.held, self.size = glue, [], 0

    def full(self, more: int) -> bool:
        return bool(self.held) and self.size + more > retrieval.CHUNK

    def take(self) -> str:
        text, tail, size = self.glue.join(self.held), [], 0
        for piece in reversed(self.held):
            if size + plain_tokens(piece) > retrieval.OVERLAP:
                break
            tail.append(piece)
            size += plain_tokens(piece)
        self.held, self.size = tail[::-1], size
        return text

    def add(self, piece: str) -> None:
        self.held.append(piece)
        self.size += plain_tokens(piece)


def plain_chunks(text: str, compat: bool = True) :
    """Kind and text of every chunk: the abstract, then packed paragraphs; long paragraphs are packed by sentences, and
    their rest goes on as the only paragraph held."""
    title, abstract, body = plain_parts(text, compat)
    prefix = f"Title: {title}\n" if title else ""
    if plain_tokens(abstract) > retrieval.ABSTRACT:
        yield "abstract", f"{prefix}Abstract: {abstract}"
    pack = PlainPack("\n\n")
    for paragraph in filter(None, (p.strip() for p in re.split(r"\n\s*\n", body))):
        if plain_tokens(paragraph) <= retrieval.CHUNK:
            if pack.full(plain_tokens(paragraph)):
                yield "fulltext", prefix + pack.take()
            pack.add(paragraph)
            continue
        if pack.held:
            yield "fulltext", prefix + pack.take()
        inner = PlainPack(" ")
        for sentence in re.split(r"(?<=[.!?])\s+", paragraph):
            if inner.full(plain_tokens(sentence)):
                yield "fulltext", prefix + inner.take()
            inner.add(sentence)
        if inner.held:
            pack.held, pack.size = [" ".join(inner.held)], inner.size
    if pack.held:
        yield "fulltext", prefix + pack.glue.join(pack.held)


def chunk_texts(spark, texts, compat=True):
    """Kinds and texts of each text's chunks."""
    found = retrieval.chunk_documents(spark.createDataFrame(list(enumerate(texts)), "id bigint, text string"), "id", compat=compat).collect()
    out = [[] for _ in texts]
    for r in sorted(found, key=lambda r: (r.id, r.chunk_no)):
        assert r.chunk_no == len(out[r.id])
        out[r.id].append((r.chunk_type, r.text))
    return out


@pytest.mark.parametrize("compat", [True, False])
def test_chunks(spark, compat, monkeypatch):
    words = lambda n, end="": " ".join(["w"] * n) + end
    three, small, long = "\n\n".join([words(230)] * 3), "\n\n".join([words(90)] * 6), " ".join([words(50, ".")] * 10)
    texts = ["", None, " \n ", "short", three, small, long, "Title: T\nAuthors: A\nbody", f"Title: T\nAbstract: {words(30)}\n\nMethods\nmore", "Title:\nAbstract: \n\nFull Text: x", "Title: only", "Title: T\nKeywords: k\nYear: 1"]
    texts += [f"Title: T\nAbstract:\n{words(n)}\nFull Text:\nbody" for n in (23, 24)]
    rng = random.Random(9)
    for _ in range(60):
        paragraphs = ["".join(rng.choice(["w ", "word ", "a. ", "b! ", "é\xa0", "x?\n", "\x1f", "日本 "]) for _ in range(rng.choice([3, 60, 200, 700]))) for _ in range(rng.randint(1, 8))]
        body = rng.choice(["\n\n", "\n \t\n", "\n"]).join(paragraphs)
        texts.append(rng.choice(["", "Title: A title \nAuthors: x\n", "Title:x\nAbstract: An abstract. " + words(rng.choice([5, 40])) + "\n\n"]) + rng.choice(["", "Full Text: ", "Keywords: a\nFull Text:\n"]) + body)
    got = chunk_texts(spark, texts, compat)
    assert got == [list(plain_chunks(t or "", compat)) for t in texts]
    if compat:
        assert [[t.count("w") for _, t in got[i]] for i in (4, 5, 6)] == [[230, 230, 230], [360, 270], [350, 200]]


def test_top_k(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(60)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    found = retrieval.top_k(table.where("vec_id < 5"), table, 3)
    m = np.array([v for _, v in rows])
    for q in range(5):
        s = m @ m[q]
        s[q] = -np.inf
        assert [r.vec_id for r in found.where(F.col("query_id") == q).orderBy("rank").collect()] == np.argsort(-s)[:3].tolist()


@pytest.mark.parametrize("small", [False, True])
def test_top_k_in_passes(spark, monkeypatch, small):
    """Nulls, short vectors and repeated rows; and queries that don't fit one pass."""
    if small:
        monkeypatch.setattr(retrieval, "QUERY_BLOCK", 3)
        monkeypatch.setattr(retrieval, "PASS_BYTES", 300)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(40)] + [(50, None), (51, [1.0, None]), (52, [float("nan")] * 4), (None, [1.0] * 4), (53, [2.0]), (7, [0.5] * 4)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    usable = [(i, np.pad(np.array(v), (0, 4 - len(v)))) for i, v in rows if i is not None and v is not None and all(x is not None and x == x for x in v)]
    for cosine in (False, True):
        unit = [(i, v / np.linalg.norm(v) if cosine else v) for i, v in usable]
        found = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in retrieval.top_k(table.where("vec_id < 20 AND vec_id <> 7 OR vec_id > 50"), table, 4, cosine=cosine).collect()}
        for q, x in unit:
            if q < 20 and q != 7 or q > 50:
                want = sorted((-float(x @ v), i) for i, v in unit if i != q)[:4]
                assert [found[q, n + 1][0] for n in range(4)] == [i for _, i in want]
    assert retrieval.top_k(table.limit(0), table, 3).count() == 0


def test_document_parts():
    p = retrieval.parts
    assert p("no title\nx") == ("", "", "no title\nx")
    assert p("Title:  T\nYear: 1\n\nAbstract:\nabs\nmore\nKeywords: k\nFull Text:\nbody\n\nend ") == ("T", "abs\nmore", "body\n\nend")
    assert p("Title: T\nAbstract: abs\n\nsec\n\nthird") == ("T", "abs\n\nsec\n\nthird", "")
    assert p("Title: T\nAbstract: abs\n\nsec\n\nthird", compat=False) == ("T", "abs", "sec\n\nthird")
    assert p("Title: T\nAuthors: A\nVenue: V\nrest\nYear: 3") == ("T", "", "rest\nYear: 3")
    assert p("Title: T") == ("T", "", "")
    assert p("Title: T\nAbstract:\nFull Text:\nbody") == ("T", "Full Text:\nbody", "body")


def test_replay(spark):
    grid = replay.simplex_grid(spark).orderBy("idx").collect()
    assert len(grid) == 66 and all(abs(r.a + r.b + r.c - 2) < 1e-9 for r in grid)
    x = np.array([[r.a, r.b, r.c] for r in grid])
    y = replay.mixture_features(x) @ np.array([20.0, 30, 25, 40, 10, 30])
    assert np.allclose(replay.mixture_features(x) @ replay.mixture_fit(x, y, 1e-9), y)
    runs = spark.createDataFrame([(m, r) for m in ("model", "random") for r in range(6)], "method string, repeat bigint")
    found = replay.replay(runs, x, y, rounds=8).toPandas()
    for _, g in found.groupby(["method", "repeat"]):
        assert (g.sort_values("round").best.diff().dropna() >= 0).all()
    first, last = found[found["round"] == 0], found[found["round"] == 8]
    assert first.groupby("repeat").best.nunique().eq(1).all()
    assert last[last.method == "model"].best.mean() >= last[last.method == "random"].best.mean()
    steps = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 5.0), ("b", 0, 9.0), ("c", 0, 1.0)], "g string, r int, best double")
    assert {r.g: r.rounds for r in replay.rounds_to(steps, ["g"], "r", "best", F.lit(5)).collect()} == {"a": 1, "b": 0, "c": 1}


def test_articles(spark):
    body = "Some sentence [1,2] here .. " * 30
    xml = f"""<r><article><front><journal-meta><journal-title>J</journal-title></journal-meta><article-meta><article-id pub-id-type="pmc">7</article-id>
    <article-title>A <i>b</i><graphic/>c</article-title><abstract><sec><title>Aim</title><p>x</p></sec></abstract><kwd>k</kwd></article-meta></front>
    <body><sec><title>Funding</title><p>no</p><sec><title>In</title><p>no</p></sec></sec><sec><title>Out</title><p>{body}</p><sec><title>In</title><p>yes</p></sec></sec></body>
    <fig><label>F1</label><caption><p>a long caption</p></caption></fig><fig><caption><p>tiny</p></caption></fig></article></r>"""
    found = records.parse_article(xml)
    assert found["pmcid"] == "PMC7" and found["title"] == "A bc" and found["abstract"] == "Aim: x" and found["journal"] == "J"
    assert [s["title"] for s in found["sections"]] == ["In", "Out"] and "[1,2]" not in found["full_text"]
    assert found["figure_captions"] == ["F1: a long caption"]
    assert records.parse_article("<broken") is None and records.parse_article("<r/>") is None


def test_ranges_and_service(spark):
    each_day = lambda s, e: 40 * (int(e[:4]) - int(s[:4]) + (1 if s[5:7] != e[5:7] and (s[5:], e[5:]) == ("01-01", "12-31") else 0.5))
    found = rest.spans(lambda s, e: int(each_day(s, e)), 2000, 2007, most=90)
    assert [(s.start[:4], s.end[:4]) for s in found] == [("2000", "2001"), ("2002", "2003"), ("2004", "2005"), ("2006", "2007")]
    from datetime import date, timedelta

    days = {date(2000, 1, 1) + timedelta(days=i): 1 + (i % 7 == 0) * 5 for i in range(800)}
    many = lambda s, e: sum(n for d, n in days.items() if date.fromisoformat(s) <= d <= date.fromisoformat(e))
    found = rest.spans(many, 1999, 2003, most=9)  # no result is lost, however far ranges have to be halved
    assert sum(s.count for s in found) == sum(days.values()) and all(s.count <= 9 for s in found)
    assert all(a.end < b.start for a, b in zip(found, found[1:], strict=False))
    with pytest.raises(ValueError):
        rest.spans(many, 1999, 2003, most=5)
    halves = rest.spans(lambda s, e: 100 if (s[5:], e[5:]) == ("01-01", "12-31") else 60, 2000, 2000, most=60)
    assert [(s.start, s.end) for s in halves] == [("2000-01-01", "2000-06-30"), ("2000-07-01", "2000-12-31")]
    assert rest.spans(lambda s, e: 0, 2000, 2001) == []
    tries = []
    assert rest.retried(lambda: tries.append(1) or (1 / 0 if len(tries) < 3 else 5), wait=0) == 5

    class Service:
        def count(self, query, start, end):
            return 7

        def page(self, query, start, end, offset, size):
            return [{"id": offset + i} for i in range(size)]

    assert ids(rest.fetch(spark, Service(), "q", 2000, 2001, "id bigint", page_size=3)) == list(range(7))
    wanted, done = spark.createDataFrame([(f"p{i}",) for i in range(6)] + [("p1",)], "k string"), spark.createDataFrame([("p0",), ("p5",)], "id string")
    got = rest.downloaded(wanted, lambda k: None if k == "p3" else k.encode() * 2, "k", done, tasks=2, per_second=200)
    assert sorted((r.id, bytes(r.content)) for r in got.collect()) == [("p1", b"p1p1"), ("p2", b"p2p2"), ("p4", b"p4p4")]
    assert ids(rest.probed([lambda: spark.range(0), lambda: spark.range(2), lambda: 1 / 0])) == [0, 1] and rest.probed([lambda: spark.range(0)]).count() == 0
    known = rest.looked_up(spark.createDataFrame([("a",), ("b",)], "k string"), lambda keys: [{"v": 1} if k == "a" else None for k in keys], "k", "k string, v bigint")
    assert [tuple(r) for r in known.collect()] == [("a", 1)]


def test_order_of_any_type(spark, monkeypatch):
    """Strings, structs, times, arrays, bytes and decimals order rows as numbers do; frequent keys are cut by their ties."""
    import random

    monkeypatch.setattr(order, "DRAWN", 8)
    rng = random.Random(4)
    names = ["b", "ä", "a" * 2000, "", None, "日本", "B"]
    data = [(i, "hot" if i % 3 == 0 else rng.choice(names), rng.choice([None, 1, 2, 3]), i % 4) for i in range(900)]
    table = spark.createDataFrame(data, "i bigint, s string, _range int, g int").repartition(6)
    kinds = {
        "s": lambda r: (r[1] is not None, (r[1] or "").encode()),
        "struct(_range, s)": lambda r: (r[2] is not None, r[2] or 0, r[1] is not None, (r[1] or "").encode()),
        "timestamp_seconds(_range * 1000)": lambda r: (r[2] is not None, r[2] or 0),
        "array(s, cast(g as string))": lambda r: (r[1] is not None, (r[1] or "").encode(), str(r[3])),
        "encode(s, 'UTF-8')": lambda r: (r[1] is not None, (r[1] or "").encode()),
        "date_add(date'2024-01-01', _range)": lambda r: (r[2] is not None, r[2] or 0),
        "_range = 2": lambda r: (r[2] is not None, r[2] == 2),
    }
    for text, key in kinds.items():
        for groups in ((), ("g",)):
            want, sums = {}, {}
            for r in sorted(data, key=lambda r: (key(r), r[0])):
                group = r[3] if groups else 0
                want[r[0]] = sums[group] = sums.get(group, 0) + (r[2] or 0)
            found = order.running_sum(table.withColumn("o", F.expr(text)), F.col("_range"), "o", ("i",), groups=groups)
            assert {r.i: r.running for r in found.collect()} == want, (text, groups)
    ranked, many = order.sampled_range(table, ["s", "i"], 16)
    sizes = [r["count"] for r in table.groupBy(ranked.alias("r")).count().collect()]
    assert many > 10 and max(sizes) < 4 * 900 / many  # a third of the rows has one string


def test_order_by_strings_needs_no_window_over_all(spark, tmp_path):
    from corpusloom.plans.catalog import queries

    spark.range(500).selectExpr("id AS doc_id", "concat('s', id % 3) AS source", "repeat('word ', 90) AS text").write.parquet(str(tmp_path / "documents.parquet"))
    found = queries()["token_budget_by_source"](spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" in plan
    empty = spark.createDataFrame([], "k string, v int")
    assert order.running_sum(empty, F.col("v"), "k").count() == 0 and order.every_nth(empty, 2, "k").count() == 0
    assert order.budget_cut(spark.createDataFrame([("b", 5), ("a", 5), (None, 5)], "k string, v int"), F.col("v"), 6, "k").orderBy("k").collect() == [(None, 5), ("a", 5)]


@pytest.mark.parametrize("cosine", [False, True])
def test_stored_index_is_exact_and_skips_blocks(spark, tmp_path, monkeypatch, cosine):
    """Clustered vectors: the same as the search over all rows, most blocks unseen; ties, copies, and vectors that take no part."""
    from corpusloom.operators import vector_index

    monkeypatch.setattr(vector_index, "BLOCK_ROWS", 8)
    monkeypatch.setattr(vector_index, "CHUNK_QUERIES", 7)
    monkeypatch.setattr(vector_index, "MEANS", 40)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(25, 6)) * 30
    rows = [(int(i), [float(x) for x in centres[i % 25] + rng.normal(size=6)]) for i in range(500)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)] + [(2000, None), (2020, [1.0, None]), (2040, [float("nan")] * 6), (None, [1.0] * 6), (2060, [1.0, 2.0]), (2080, [0.0] * 6)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    vector_index.write_index(table, str(tmp_path / "index"), cosine=cosine)
    told: dict = {}
    queries = table.where("vec_id % 20 = 0")
    found = vector_index.search_index(queries, spark, str(tmp_path / "index"), 5, cosine=cosine, told=told)
    key = lambda d: sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in d.collect())
    assert key(found) == key(retrieval.top_k(queries, table, 5, cosine=cosine))
    assert spark.read.parquet(str(tmp_path / "index")).agg(F.max("members")).first()[0] < 40 and 0 < told["scored"] < 0.4 * told["pairs"]
    empty = table.limit(0)
    vector_index.write_index(empty, str(tmp_path / "none"))
    assert vector_index.search_index(queries, spark, str(tmp_path / "none"), 5).count() == 0 and vector_index.search_index(empty, spark, str(tmp_path / "index"), 5).count() == 0


def test_general_mix_in_one_order(spark, tmp_path):
    """A failing source is told, both sinks hold the same rows in the drawn order, and reruns give the same order."""
    from corpusloom.plans import pipelines

    chat = lambda k: [{"role": "user", "content": f"Please tell me about number {k}, at length."}, {"role": "assistant", "content": f"Number {k} is a number, and there is more to say about it than fits."}]
    chats = spark.createDataFrame([(i, chat(i)) for i in range(60)], "id bigint, messages array<struct<role: string, content: string>>")

    def broken():
        return chats.withColumn("messages", F.raise_error(F.lit("gone")).cast("array<struct<role: string, content: string>>"))

    orders = []
    for run in ("a", "b"):
        told = pipelines.general_mix({"x": (lambda: chats.where("id < 30"), 10), "broken": (broken, 5), "y": (lambda: chats.where("id >= 30"), 50)}, "id", 3, str(tmp_path / run))
        assert {(r.source, r.quota, r.n, r.error is None) for r in told.collect()} == {("x", 10, 10, True), ("broken", 5, 0, False), ("y", 50, 30, True)}
        full = spark.read.json(str(tmp_path / run / "full"))
        assert sorted(r.place for r in full.collect()) == list(range(1, 41)) and spark.read.json(str(tmp_path / run / "train")).columns == ["input", "instruction", "output"]
        orders.append([r.id for r in full.orderBy("place").collect()])
    assert orders[0] == orders[1] != sorted(orders[0])
    with pytest.raises(ValueError, match="no source"):
        pipelines.general_mix({"broken": (broken, 5)}, "id", 3, str(tmp_path / "c"))


def test_weights_of_rows(spark):
    rows = spark.createDataFrame([(1, "äb", [1, 2], None, b"xyz"), (None, None, None, None, None)], "`a.b` int, s string, l array<int>, m map<string,int>, b binary")
    sizes = [r[0] for r in rows.select(joins.row_bytes(rows)).collect()]
    assert sizes[0] > sizes[1] >= 16 and sizes[0] >= 8 + 8 + 3 + 5 + 3
    hint = lambda d: "broadcast" in d._jdf.queryExecution().logical().toString().lower()
    assert hint(joins.small(rows)) and not hint(joins.small(spark.range(10).selectExpr("repeat('x', 10000000) AS s")))
