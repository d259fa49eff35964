"""Hard negatives against brute force."""

import math

import numpy as np

from canton.llm import negatives as N

SCHEMA = "vec_id long, embedding array<double>, label int, row string, score int, team int"


def brute(rows, every=100):
    fit = [
        (i, [math.floor(256 * x) for x in v], label)
        for i, v, label in rows
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    clip = lambda x: max(-(2**63), min(2**63 - 1, x))
    out = []
    for a, av, al in fit:
        if a % every:
            continue
        scored = [(-clip(sum(x * y for x, y in zip(av, v))), i, label) for i, v, label in fit if len(v) == len(av)]
        positives = sorted((s, i) for s, i, label in scored if label == al and i != a)[:5]
        for p, pid in positives:
            found = sorted((s, i) for s, i, label in scored if label != al and 80 * -p <= 100 * -s <= 100 * -p)[:5]
            out += [(a, pid, r + 1, i, -p, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


def got(spark, rows, schema=SCHEMA, **options):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], schema)
    return sorted(tuple(r) for r in N.hard_negatives(df.repartition(5), **options).collect())


def test_equals_brute_force(spark, monkeypatch):
    for name, value in (("GROUP", 40), ("CHUNK", 64), ("SLOT", 150), ("ROWS", 20)):
        monkeypatch.setattr(N, name, value)
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=11) + 0.4], int(rng.integers(4))) for i in range(700)]
    rows += [(1000 + i, rows[0][1], i % 4) for i in range(60)]  # ties
    rows += [(2000, None, 1), (2100, [1.0, None], 1), (2200, [float("nan")] * 11, 1), (2300, rows[1][1], None)]
    rows += [(None, rows[1][1], 1), (100, rows[5][1], 2), (100, rows[100][1], rows[100][2])]  # repeated ids
    rows += [(2400, [0.5, -1.0], 0), (2401, [0.5, -0.75], 0), (2402, [0.4, -0.8], 1), (2500, [], 3), (2501, [], 3), (2502, [], 1)]
    expected = brute(rows)
    assert len(expected) > 60
    assert got(spark, rows) == expected


def test_scores_beyond_machine_integers(spark):
    big = [(0, [1e15, 1.0], 0), (1, [1e15, 0.0], 0), (2, [1e15, -1.0], 1), (3, [9e14, 0.0], 1), (4, [-1e15, 0.0], 1)]
    small = [(100, [3e6, -2e6], 0), (101, [2e6, -2e6], 0), (102, [2e6, -1.9e6], 1), (103, [-1.0, 0.0], 1)]
    for rows in (big, small, big + small):
        assert got(spark, rows) == brute(rows)


def test_empty(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, [1.0], 1)]) == []


def test_tables_and_planes_give_products():
    rng = np.random.default_rng(5)
    for low, high, dims in ((-5, 6, 1), (-300, 300, 13), (0, 2, 16), (-1, 0, 8), (-(2**20), 2**20, 9)):
        a, c = rng.integers(low, high + 1, (7, dims)), rng.integers(low, high + 1, (33, dims))
        tables = N.subset_sums(a)
        assert tables.shape[1] == 256
        assert (N.scores(tables, N.planes(c)) == c @ a.T).all()


def test_relabelled(spark):
    df = spark.createDataFrame([(7, [1.0], 9, ""), (8, [1.0], 9, ""), (14, [1.0], None, "")], "vec_id long, embedding array<float>, label int, x string")
    assert [r["label"] for r in N.relabelled(df).orderBy("vec_id").collect()] == [0, 9, None]
