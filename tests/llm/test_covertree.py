"""Near-duplicate vectors against brute force."""

import math

import numpy as np
import pytest

from canton.llm import covertree as C

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, part string"


def brute(rows, similarity):
    """Links of each row position, and each row's component as the least id reached."""
    unit = []
    for i, v, label in rows:
        ok = i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        x = np.array(v, np.float32).astype(float) if ok else None
        unit.append(x / np.linalg.norm(x) if ok else None)
    near = [
        [
            j for j, (_, _, label) in enumerate(rows)
            if j != i and unit[i] is not None and unit[j] is not None and label == rows[i][2]
            and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= similarity
        ]
        for i in range(len(rows))
    ]
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = set(near[todo.pop()]) - seen
            seen |= new
            todo += new
        least = min((rows[j][0] for j in seen), key=lambda x: -1 if x is None else x)
        out.append((vec_id, len(near[i]), least, vec_id == least))
    return sorted(out, key=repr)


@pytest.mark.parametrize("pivots", [64, 2])
def test_equals_brute_force(spark, monkeypatch, pivots):
    monkeypatch.setattr(C, "PAGE", 60)
    monkeypatch.setattr(C, "ALL_PIVOTS", pivots)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(9, 6))
    rows = [(i, [float(x) for x in centres[i % 9] + rng.normal(scale=0.12, size=6)], i % 2) for i in range(500)]
    rows += [(500 + i, [float(x) for x in rng.normal(size=6)], i % 3) for i in range(200)]
    rows += [(1000 - i, rows[3][1], 1) for i in range(40)]  # equal vectors
    rows += [(1100 + i, [2.0 * x for x in rows[4][1]], 0) for i in range(5)]  # the same direction
    # One id twice, in unlike rows; odd vectors.
    rows += [(3, rows[7][1], 1), (6, rows[8][1], 2), (2000, None, 1), (2001, [1.0, None], 1), (2002, [float("nan")] * 6, 1)]
    rows += [(2003, [float("inf")] * 6, 1), (2004, [0.0] * 6, 1), (2005, [], 1), (2006, rows[1][1], None), (None, rows[1][1], 1)]
    rows += [(2007, [1.0, 0.0], 1), (2008, [1.0, 0.01], 1), (2009, [1e-30, 0.0], 1), (2010, [3e38, 1e35], 1)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got = [tuple(r) for r in C.near_vectors(df.repartition(4)).collect()]
    assert sorted(got, key=repr) == brute(rows, 0.98)


def test_empty_and_single(spark):
    assert C.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    one = spark.createDataFrame([(7, [1.0], 1, "", "")], SCHEMA)
    assert [tuple(r) for r in C.near_vectors(one).collect()] == [(7, 0, 7, True)]


def test_tree_is_nested_and_covers():
    rng = np.random.default_rng(2)
    points = rng.normal(size=(700, 5))
    points /= np.linalg.norm(points, axis=1)[:, None]
    tree = C.CoverTree(points)
    assert sorted(tree.order) == list(range(700))
    for i in range(len(tree.centre)):
        members = tree.order[tree.start[i] : tree.stop[i]]
        d = C._distance(points[members], points[tree.centre[i]][None])[:, 0]
        assert tree.centre[i] in members and d.max() <= tree.radius[i] + 1e-7
        children = tree.below(i)
        if tree.count[i]:
            assert tree.centre[i] in tree.centre[children]
            assert (2 * tree.radius[children] <= 2 * tree.radius[i]).all()
            assert sorted(np.concatenate([tree.order[tree.start[c] : tree.stop[c]] for c in children])) == sorted(members)
            net = C._distance(points[tree.centre[children]], points[tree.centre[children]])
            reach = 2.0 ** (math.ceil(math.log2(tree.radius[i])) - 1)
            assert (net[np.triu_indices(len(children), 1)] > reach - 1e-7).all()


def test_traversal_prunes_and_takes_groups_whole():
    """Groups apart are pruned by their radii, a tight group is linked without its pairs."""
    rng = np.random.default_rng(6)
    centres = np.eye(40)
    points = np.repeat(centres, 25, axis=0) + rng.normal(scale=0.002, size=(1000, 40))
    points /= np.linalg.norm(points, axis=1)[:, None]
    tree, one = C.CoverTree(points), np.ones(1000, np.int64)
    links, computed = C.dual_traversal(tree, one, tree, one, 0.98)
    assert (links.counts[0] == 24).all()
    assert computed < 1000 * 1000 / 100
    assert sum(len(x) for x, _ in links.ties) <= 2 * 1000
    other = C.CoverTree(points[::-1].copy())
    links, computed = C.dual_traversal(tree, one, other, 3 * one, 0.98)
    assert (links.counts[0] == 75).all() and (links.counts[1] == 25).all()
    assert computed < 1000 * 1000 / 100
