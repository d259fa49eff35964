"""Top-k search and SpotSigs fingerprints against brute force."""

import hashlib
import math

import numpy as np
import pytest

from canton.llm import mtree, spotsigs


def brute_top(rows, k, every=100):
    vectors = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            vectors.append((i, [math.floor(1024 * float(np.float32(x))) for x in v]))
    out, asked = [], {}
    for i, v in vectors:
        if i % every == 0:
            asked[i] = min(asked.get(i, v), v)
    for q, qv in asked.items():
        scored = [
            (-sum(a * b for a, b in zip(qv, v)), i) for i, v in vectors if i != q and len(v) == len(qv)
        ]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(mtree, "PAGE", 90)
    monkeypatch.setattr(mtree, "SEEDS", 40)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    rows = [(i, [float(x) for x in centres[i % 6] + rng.normal(scale=0.2, size=8)]) for i in range(900)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]  # ties
    rows += [(2000, None), (2100, [1.0, None] * 4), (2200, [float("nan")] * 8), (2300, [float("inf")] * 8)]
    rows += [(2400, [1.0, 2.0]), (2401, [1.0, 0.5]), (None, rows[1][1]), (100, rows[5][1]), (7, rows[7][1]), (2500, [])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = sorted(tuple(r) for r in mtree.exact_top_k(df.repartition(5)).collect())
    assert got == brute_top(rows, 10)


def test_top_k_small_and_empty(spark):
    schema = "vec_id long, embedding array<float>"
    assert mtree.exact_top_k(spark.createDataFrame([], schema)).count() == 0
    rows = [(0, [1e12, 1.0]), (1, [2e12, 0.0]), (2, [0.5, -3.0])]
    got = sorted(tuple(r) for r in mtree.exact_top_k(spark.createDataFrame(rows, schema)).collect())
    assert [g[2] for g in got] == [1, 2] and got[0][3] == 2**63 - 1


def test_top_k_driver_gets_bounded_rows(spark, monkeypatch):
    """Neither every partition's first rows nor the blocks of queries with their pages go to the driver."""
    monkeypatch.setattr(mtree, "PAGE", 20)
    monkeypatch.setattr(mtree, "SEEDS", 30)
    rng = np.random.default_rng(9)
    rows = [(i // 2 if i % 3 else 50, [float(x) for x in rng.normal(size=4)]) for i in range(600)]
    schema = "vec_id long, embedding array<float>"
    df = spark.createDataFrame(rows, schema).repartition(24)
    plans, collect = [], type(df).collect

    def watched(self):
        out = collect(self)
        plans.append((self._jdf.queryExecution().executedPlan().toString(), len(out)))
        return out

    monkeypatch.setattr(type(df), "collect", watched)
    result = mtree.exact_top_k(df)
    assert not any("TakeOrderedAndProject" in plan or "CollectLimit" in plan for plan, _ in plans)
    assert sorted(n for _, n in plans)[-1] <= 1 << mtree.BUCKET_BITS and 30 in [n for _, n in plans]
    assert sorted(tuple(r) for r in result.collect()) == brute_top(rows, 10)
    assert "BroadcastExchange" not in plans[-1][0] and "SortMergeJoin" in plans[-1][0]


def test_tree_leaves_out_computations():
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(4000, 4)) * 1000).astype(np.int64)
    top = float((vectors.astype(float) ** 2).sum(axis=1).max())
    tree = mtree.Tree(np.arange(4000), vectors, top)
    computed, products = [], mtree.products
    try:
        mtree.products = lambda v, q, exact: computed.append(len(v)) or products(v, q, exact)
        (got,) = tree.search(vectors[5:6], np.array([5]), 10, np.array([-np.inf]))
    finally:
        mtree.products = products
    scores = vectors @ vectors[5]
    want = sorted((-int(s), i) for i, s in enumerate(scores) if i != 5)[:10]
    assert got == [(-s, i) for s, i in want] and sum(computed) < 2000


def follow(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for at, (i, t) in enumerate(order):
        t, n = t or "", order[(at + 1) % len(order)][1] or ""
        half = len(t) // 2
        e = t[: len(t) - half] + n[:half]
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), t, e, n))
    return out


@pytest.mark.parametrize("partitions", [1, 7])
def test_edited_fingerprints(spark, sf_dir, partitions):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows = [(3 * i + 1, t) for i, t in rows]
    rows += [(2, ""), (5, None), (8, "the of and"), (11, "é" * 100_000), (14, "É Same. words here"), (17, "É Same. words here")]
    rows += [(20, "x"), (20, "x"), (None, "without an id"), (None, None)]
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, fingerprint string")
    got = spotsigs.edited_fingerprints(df.repartition(partitions)).collect()
    one = lambda t: spotsigs.spot_sets(spotsigs.pa.array([t], spotsigs.pa.large_string()))[0]

    def jaccard(s, t):
        a, b = set(one(s).tolist()), set(one(t).tolist())
        return len(a & b) / len(a | b) if a | b else 1.0

    want = [
        (i, n, sha, spotsigs.told(one(t)), spotsigs.told(one(e)), jaccard(t, e), jaccard(t, after))
        for i, n, sha, t, e, after in follow(rows)
    ]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
    assert spotsigs.edited_fingerprints(df.limit(0)).count() == 0


def test_signatures_follow_anchors():
    def one(text):
        return set(spotsigs.spot_sets(spotsigs.pa.array([text]))[0].tolist())

    base = one("Ships sail; the old harbour of grey stones and tall masts")
    assert len(base) == 4 and one("THE old harbour")  < base | one("the old harbour")
    assert base & one("elsewhere the OLD, harbour") and one("") == set() and len(one("the of")) == 1


def test_texts_without_anchors_use_all_words():
    column = spotsigs.pa.array([
        "alpha beta gamma delta epsilon zeta", "alpha beta one two three four", "omega beta gamma delta epsilon zeta",
        "the sea", "alpha", "alpha beta", "",
    ])
    sets = spotsigs.spot_sets(column)
    assert [len(s) for s in sets] == [6, 6, 6, 2, 1, 2, 0]
    assert spotsigs.likeness(sets[0], sets[1]) == 1 / 11 and spotsigs.likeness(sets[0], sets[2]) == 5 / 7
    assert all((spotsigs.spot_sets(column[i : i + 1])[0] == s).all() for i, s in enumerate(sets))


def test_near_pairs_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(60):
        base = rng.choice(500, size=rng.integers(1, 40), replace=False)
        rows.append((i, sorted(base.tolist())))
        if i % 3 == 0:
            other = set(base.tolist()) ^ {int(rng.integers(500))}
            rows.append((100 + i, sorted(other)))
        if i % 5 == 0:
            rows.append((200 + i, sorted(base.tolist())))
    df = spark.createDataFrame(rows + [(999, [])], "doc_id long, signatures array<long>")
    reps = {}
    for i, s in rows:
        if s:
            reps[tuple(s)] = min(i, reps.get(tuple(s), i))
    want = set()
    for s, i in reps.items():
        for t, j in reps.items():
            if i < j and len(set(s) & set(t)) >= 0.8 * len(set(s) | set(t)):
                want.add((i, j))
    got = {tuple(sorted((r.a, r.b))) for r in spotsigs.near_pairs(df).collect()}
    assert got == want and want
