"""Late session merging against the sessions of all events so far, found anew after every batch."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import sessions

SCHEMA = "user bigint, t bigint, batch bigint, v bigint, start_s string"
COLUMNS = "user batch start_s end_s n_events n_new n_retracted h_sum retracted_batch retracted_start_s".split()


def brute(rows, gap):
    by_user, out = defaultdict(list), []
    for user, t, batch, v, _ in rows:
        if t is not None and batch is not None:
            by_user[user].append((t, batch, v or 0))
    for user, events in by_user.items():
        found = []
        for batch in sorted({e[1] for e in events}):
            groups = []
            for e in sorted(e for e in events if e[1] <= batch):
                if groups and e[0] - groups[-1][-1][0] <= gap:
                    groups[-1].append(e)
                else:
                    groups.append([e])
            for g in groups:
                new = sum(e[1] == batch for e in g)
                if new:
                    gone = [v for v in found if v[8] is None and g[0][0] <= v[2] and v[3] <= g[-1][0]]
                    for v in gone:
                        v[8:] = [batch, g[0][0]]
                    found.append([user, batch, g[0][0], g[-1][0], len(g), new, len(gone), sum(e[2] for e in g), None, None])
        out += found
    return sorted(map(tuple, out), key=str)


def run(spark, rows, gap):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = sessions.session_versions(df, F.col("user"), F.col("t"), F.col("batch"), F.col("v"), gap)
    assert found.columns == COLUMNS
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("gap,stretch", [(600, 1024), (7, 2), (0, 3), (1, 1), (50, 4)])
def test_versions_equal_sessions_found_anew(spark, monkeypatch, gap, stretch):
    monkeypatch.setattr(sessions, "STRETCH", stretch)
    rng = random.Random(gap)
    rows = [(rng.choice([1, 2, 3, None]), rng.randint(-40, 60) * max(1, gap // 3) + rng.randint(0, 5), rng.randint(-2, 6), rng.choice([None, 1, 5, 2**40]), "x") for _ in range(220)]
    rows += [(9, 0, b, 1, "x") for b in (1, 1, 2, 2, 3)]  # repeated rows
    rows += [(8, None, 1, 1, "x"), (8, 1, None, 1, "x")]
    rows += [(7, (gap + 1) * i * 2, 1, i, "x") for i in range(30)] + [(7, (gap + 1) * (2 * i + 1), 2 + i % 3, i, "x") for i in range(29)]
    assert run(spark, rows, gap) == brute(rows, gap)


def test_one_user_with_most_events(spark):
    """Many events of a user become one row for each cell and batch before they are shuffled."""
    rng = random.Random(5)
    rows = [(1, rng.randint(0, 5000), rng.randint(0, 3), 1, "x") for _ in range(3000)] + [(u, u, 0, 1, "x") for u in range(2, 40)]
    assert run(spark, rows, 20) == brute(rows, 20)


def test_mergers_count_all_that_they_retract(spark):
    rows = [(1, 0, 0, 1, ""), (1, 1000, 0, 2, ""), (1, 2000, 0, 4, ""), (1, 500, 1, 8, ""), (1, 1500, 1, 16, ""), (1, 9000, 1, 32, ""), (1, 9100, 2, 64, "")]
    found = run(spark, rows, 600)
    assert (1, 1, 0, 2000, 5, 2, 3, 31, None, None) in found and (1, 2, 9000, 9100, 2, 1, 1, 96, None, None) in found
    assert (1, 0, 1000, 1000, 1, 1, 0, 2, 1, 0) in found and len(found) == 6


def test_no_events(spark):
    assert run(spark, [], 600) == []
    with pytest.raises(ValueError):
        run(spark, [], -1)
