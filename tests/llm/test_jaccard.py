"""The n-gram Jaccard join against all pairs."""

import random
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest

from corpusloom.llm import jaccard

SCHEMA = "doc_id bigint, text string, class_id string"


def brute(rows):
    sets = []
    for _, text, _ in rows:
        w = (text or "").lower().split()
        sets.append(frozenset(" ".join(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset(w))
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a == b or (a | b and len(a & b) / len(a | b) >= 0.8):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    ids = defaultdict(list)
    for i in range(len(rows)):
        ids[find(i)].append(rows[i][0])
    return [(r[0], min((x for x in ids[find(i)] if x is not None), default=None), len(ids[find(i)]), links[i]) for i, r in enumerate(rows)]


def corpus(seed, n, near):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 120))), "x") for i in range(n)]
    base = rng.choices(words, k=150)
    for i in range(near):  # similar in many degrees around the threshold
        copy = list(base)
        for _ in range(rng.randrange(0, 6)):
            copy[rng.randrange(150)] = f"n{rng.randrange(10**6)}"
        rows.append((1000 + i, " ".join(copy), None))
    rows += [(2000, None, None), (2001, "", None), (2002, " \n", None), (None, rows[5][1], None), (7, rows[7][1], None), (2003, "one two", None), (2004, "TWO one", None), (None, None, None)]
    rows.append((2005, " ".join(f"l{i}" for i in range(40_000)), None))
    rows.append((2006, rows[-1][1] + " end", None))
    return rows


@pytest.mark.parametrize("blocks", [256, 20])
def test_all_pairs(spark, monkeypatch, blocks):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", blocks)  # small blocks: hot branches and components are split
    rows = corpus(3, 120, 90)
    found = jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(6)).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r.id, r.class_id, r.class_docs, r.n_links) for r in found), key=key) == sorted(brute(rows), key=key)


@pytest.mark.parametrize("few", [200_000, 0])
def test_one_of_each_stays(spark, monkeypatch, few):
    """By broadcast of the few rows that go, or by a shuffle; repeated rows, null ids and clashing names among them."""
    monkeypatch.setattr(jaccard, "FEW_ROWS", few)
    rows = corpus(4, 60, 30) + [(3000, "once more the same words here", None)] * 4 + [(None, "no id but a text of its own", None)] * 3
    docs = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("class_id", "_k").repartition(4)
    kept = jaccard.one_of_each(docs, jaccard.near_duplicates(docs))
    assert kept.columns == docs.columns
    told = brute(rows)
    classes = defaultdict(list)
    for r, (i, c, n, _) in zip(rows, told, strict=True):
        classes[c, n, frozenset(jaccard.shingles(r[1]).tolist()) if c is None else c].append((i is None, i or 0, r[1]))
    found = sorted(((r.doc_id is None, r.doc_id or 0) for r in kept.collect()))
    assert found == sorted(min(c[:2] for c in members) for members in classes.values())
    assert kept.where("doc_id = 3000").count() == 1


def test_only_copies_and_empty_tables(spark):
    docs = spark.createDataFrame([(i, "the same text of six words", "y") for i in range(50)], SCHEMA)
    assert {(r.class_id, r.class_docs, r.n_links) for r in jaccard.near_duplicates(docs).collect()} == {(0, 50, 49)}
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0


def test_prefix_and_recall():
    assert jaccard.prefix_depth() == 4 and jaccard.prefix_depth(recall=0.98) > 4
    rng, hits = np.random.default_rng(0), 0
    for _ in range(300):
        common, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (160, 20, 20))
        x, y = (jaccard.signature(np.unique(np.concatenate([common, s]))).reshape(jaccard.TREES, -1) for s in (a, b))
        hits += (x[:, :4] == y[:, :4]).all(1).any()
    assert hits == 300


def test_own_depths():
    """By trying all pairs of sizes and intersections; a longer prefix needs no more than its own similarity's recall."""
    for n in range(1, 60):
        found = [i / (n + m - i) for m in range(1, 100) for i in range(0, min(n, m) + 1) if not i == n == m and i / (n + m - i) >= 0.8]
        least = jaccard.least_alike(n)
        assert (least is None) == (not found) and (least is None or abs(least - min(found)) < 1e-12)
        depth = jaccard.own_depth(n, 0.8, 0.99999)
        assert least is None or depth == 1 or 1 - (1 - least**depth) ** jaccard.TREES >= 0.99999 or depth == jaccard.prefix_depth()
    assert jaccard.least_alike(3) is None and jaccard.own_depth(7, 0.8, 0.99999) > jaccard.prefix_depth()


def test_branches_against_all_pairs():
    """What the walk ties is what comparing all pairs of a unit ties that share a prefix long enough for both."""
    rng = np.random.default_rng(5)
    for case in range(40):
        k = int(rng.integers(2, 40))
        base = rng.integers(0, 3, (4, jaccard.DEPTH)).astype(np.uint16)
        values = base[rng.integers(0, 4, k)]
        values[:, :2] = 1
        sig = rng.integers(0, 2, (k, 30)).astype(np.uint16)
        order = np.lexsort(values.T[::-1])
        values, sig = values[order], sig[order]
        n, depths = rng.integers(8, 12, k).astype(float), rng.integers(2, 6, k)
        side = rng.integers(0, 2, k) if case % 2 else None
        want = list(range(k))
        for i in range(k):
            for j in range(i):
                same = 0
                while same < jaccard.DEPTH and values[i, same] == values[j, same]:
                    same += 1
                ok = same >= max(depths[i], depths[j]) and min(n[i], n[j]) >= 0.8 * max(n[i], n[j]) and (sig[i] == sig[j]).sum() >= 18
                if ok and (side is None or side[i] != side[j]):
                    old, new = want[i], want[j]
                    want = [new if x == old else x for x in want]
        got = jaccard.branch_ties(values, sig, n, depths, side, 0.8, 18).tolist()
        assert [want.index(x) for x in want] == [got.index(x) for x in got] and all(r <= i for i, r in enumerate(got))


SF = "/root/testdata/sf0.1"


@pytest.mark.skipif(not Path(SF).exists(), reason="needs the test tables")
def test_recall_on_a_table(spark):
    """Every link of the table's 10,000 texts, by all pairs that share any shingle."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {r.id: r.n_links for r in jaccard.near_duplicates(docs).collect()}
    sets = {r.doc_id: frozenset(jaccard.shingles(r.text).tolist()) for r in docs.collect()}
    by_set = defaultdict(list)
    for i, s in sets.items():
        by_set[s].append(i)
    stands, pairs = defaultdict(list), set()
    kinds = list(by_set)
    for k, s in enumerate(kinds):
        for x in s:
            stands[x].append(k)
    for ks in stands.values():
        if len(ks) > 1:
            for a in range(len(ks)):
                for b in range(a):
                    x, y = kinds[ks[a]], kinds[ks[b]]
                    if min(len(x), len(y)) >= 0.8 * max(len(x), len(y)):
                        pairs.add((ks[b], ks[a]))
    links = {i: len(by_set[s]) - 1 for i, s in sets.items()}
    for a, b in pairs:
        x, y = kinds[a], kinds[b]
        if len(x & y) >= 0.8 * len(x | y):
            for i in by_set[x]:
                links[i] += len(by_set[y])
            for i in by_set[y]:
                links[i] += len(by_set[x])
    lost, total = sum(links[i] - found[i] for i in links), sum(links.values())
    print(f"links found: {total - lost} of {total}")
    assert total > 90 and all(found[i] <= links[i] for i in links) and lost <= total // 100


def test_intersections():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, n).astype(np.uint64)) for n in (0, 1, 50, 200, 400)]
    got = jaccard.intersections(sets, sets)
    assert got.tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
