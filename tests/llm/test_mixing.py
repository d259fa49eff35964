"""Raking and sampling against a brute-force version."""

import numpy as np
import pytest

from canton.llm import mixing


def brute_rake(mass, targets, sweeps=500):
    mass = mass / mass.sum()
    for _ in range(sweeps):
        for axis, goal in enumerate(targets):
            now = mass.sum(axis=tuple(a for a in range(mass.ndim) if a != axis), keepdims=True)
            shape = [1] * mass.ndim
            shape[axis] = -1
            mass = mass * np.divide(goal.reshape(shape), now, out=np.zeros_like(now), where=now > 0)
    return mass


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(4)
    n = rng.integers(0, 3000, (5, 4, 3))
    n[0] *= 20
    n[1, 2, :] = 0
    return n


def frame(spark, n):
    rows = [(f"=s{i}", f"=l{j}", f"={k}", int(n[i, j, k])) for i, j, k in np.ndindex(n.shape)]
    return spark.createDataFrame(rows, "source string, lang string, topic string, n_tokens long")


def test_raking_equals_brute_force(spark, table):
    goals = [np.array([0.1, 0.3, 0.2, 0.2, 0.2]), np.array([0.4, 0.3, 0.2, 0.1]), np.array([0.5, 0.25, 0.25])]
    names = [[f"=s{i}" for i in range(5)], [f"=l{i}" for i in range(4)], [f"={i}" for i in range(3)]]
    targets = {
        m: spark.createDataFrame(list(zip(v, g.tolist())) + [("=absent", 1.0)], "value string, share double")
        for m, v, g in zip(mixing.MARGINS, names, goals)
    }
    got = mixing.rake(frame(spark, table), targets).collect()
    want = brute_rake(table.astype(float), goals)
    for r in got:
        i, j, k = (names[d].index(r[m]) for d, m in enumerate(mixing.MARGINS))
        assert r["mass"] == pytest.approx(want[i, j, k], abs=1e-5)


@pytest.mark.parametrize("budget", [0.1, 0.5, 0.95])
def test_probabilities_meet_the_budget(spark, table, budget):
    cells = frame(spark, table)
    targets = {m: mixing.tempered(cells, m) for m in mixing.MARGINS}
    got = mixing.probabilities(mixing.rake(cells, targets), budget).collect()
    expected = sum(r["n_tokens"] * r["probability"] for r in got)
    assert expected == pytest.approx(budget * table.sum(), rel=1e-6)
    assert all(0 <= r["probability"] <= 1 for r in got)
    # Below 1, probabilities are in proportion to the weights.
    ratios = [r["probability"] / r["weight"] for r in got if r["weight"] and r["probability"] < 1]
    assert max(ratios) == pytest.approx(min(ratios), rel=1e-9)


def test_sample_of_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mixing.sample_mix(docs).collect()
    words = {r.doc_id: len((r.text or "").split()) for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in rows} == words
    total = sum(words.values())
    assert sum(r.n_tokens * r.probability for r in rows) == pytest.approx(0.5 * total, rel=1e-6)
    for margin in mixing.MARGINS:
        seen, raked = {}, {}
        for r in rows:
            seen[r[margin]] = seen.get(r[margin], 0) + r.n_tokens
            raked[r[margin]] = raked.get(r[margin], 0) + r.n_tokens * r.weight
        lifted = {v: n**0.7 for v, n in seen.items() if n}
        for v, x in lifted.items():
            # A small, sparse table may end before all margins hold; the last one does.
            close = 1e-5 if margin == "topic" else 2e-2
            assert raked[v] / total == pytest.approx(x / sum(lifted.values()), abs=close)
    chosen = {r.doc_id for r in rows if r.sampled}
    assert {r.doc_id for r in mixing.keep_sampled(docs).collect()} == chosen and chosen


def test_edges(spark):
    rows = [(1, "a b c", "s", None, 3), (None, None, None, "en", 3), (2, "", "s", "en", 1), (3, "w " * 90_000, "s", "en", 2)]
    rows += [(4, "twice", "t", "de", 5)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, topic int")
    got = mixing.sample_mix(docs)
    assert got.count() == 6 and mixing.sample_mix(docs.limit(0)).count() == 0
    assert len({r.sampled for r in got.where("doc_id = 4").collect()}) == 1
    kept = mixing.keep_sampled(docs, budget=1.0)
    assert kept.columns == docs.columns and kept.count() == 6
    goal = {"lang": spark.createDataFrame([("en", 3.0), ("de", 1.0)], "value string, share double")}
    rows = mixing.sample_mix(docs, goal).collect()
    assert {r.probability for r in rows if r.doc_id == 1} == {0.0}


def subjects(spark, rows):
    """The topics of the texts that begin with each word, as sample_mix gives them."""
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    topic = {r.doc_id: r.topic for r in mixing.sample_mix(docs.repartition(5)).collect()}
    seen = {}
    for i, text, _, _ in rows:
        seen.setdefault(text.split()[-1], set()).add(topic[i])
    return seen


def test_topics_are_learned_beside_a_text_of_many_copies(spark):
    sea, bread = "harbour sail mast deck anchor tide", "oven flour dough crust yeast loaf"
    texts = [f"{sea} n{i} ship" for i in range(30)] + [f"{bread} n{i} bake" for i in range(30)]
    hashed = spark.createDataFrame([(t,) for t in texts], "text string").selectExpr("text", "xxhash64(text) AS h")
    copied = min((r.h, r.text) for r in hashed.collect())[1]
    rows = [(i, t, "s", "en") for i, t in enumerate(texts + [copied] * 2_100)]
    seen = subjects(spark, rows)
    assert not seen["ship"] & seen["bake"]


def test_topics_are_learned_from_whole_texts(spark):
    start = "same " * 5_000
    tails = ["harbour sail mast deck tide ship " * 2_000, "oven flour dough crust loaf bake " * 2_000]
    rows = [(i, f"{start}n{i} {tails[i % 2]}", "s", "en") for i in range(20)]
    seen = subjects(spark, rows)
    assert not seen["ship"] & seen["bake"]


def test_language_means_are_those_of_all_rows(spark):
    rng = np.random.default_rng(7)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 400, 12)), "s", "en") for i in range(2_500)]
    rows += [(9_000 + i, f"rare words {i} " + "a " * 300, "s", "xx") for i in range(3)] + [(9_100, "none", "s", None), (9_101, " ", "s", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    models = [mixing.fit_topics(mixing.stored(mixing.bagged(docs.repartition(n)), "bags")) for n in (1, 6)]
    for lang in ("en", "xx", None):
        texts = [t for _, t, _, x in rows if x == lang and t.strip()]
        bags = np.log1p(mixing._bags(mixing.pa.array(texts))[0])
        want = (bags / np.linalg.norm(bags, axis=1, keepdims=True)).mean(axis=0)
        assert np.allclose(models[0].means[lang], want, atol=1e-7)
        assert (models[0].means[lang] == models[1].means[lang]).all()
    assert np.allclose(models[0].centres, models[1].centres, atol=1e-7)
