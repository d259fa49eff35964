"""Sparse feature vectors against the wide path."""

import numpy as np
import pytest
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from canton.operators.sparse import (
    feature_dictionary, ml_vectors, scaled_entries, sparse_scores, sparse_vectors, with_vectors,
)
from canton.plans.experiment import ablation, comparison, metrics_document, vector_ablation
from canton.plans.features import election_features, election_rows
from canton.session import stored_table


def frame(spark, n=160, missing=0.2):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(n, 4)) * [1, 20, 0.1, 3] + [0, 5, 1, -2]
    y = (x[:, 0] + x[:, 1] / 20 + rng.normal(size=n) > 0.3).astype(int)
    gone = rng.random((n, 4)) < missing
    rows = [(i, int(y[i]), *[None if gone[i, j] else float(x[i, j]) for j in range(4)], 7.0) for i in range(n)]
    return spark.createDataFrame(rows, "id long, y int, a double, b double, c double, d double, e double")


def long(df, names):
    cells = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("value")) for n in names])
    return df.select("id", F.inline(cells)).where("value IS NOT NULL")


def test_vector_experiments_equal_wide_ones(spark, rows, tmp_path):
    df = stored_table(frame(spark), "toy")
    names = ["a", "b", "c", "d", "e"]
    wide = ablation(df, {"all": names, "some": ["a", "c", "e"]}, "y", "id")
    thin = vector_ablation(df, long(df, names), {"all": None, "some": F.col("feature").isin("a", "c", "e")}, "y", "id")
    for w, v in zip(wide, thin):
        assert v.features_count == len(w.features) and v.bias == pytest.approx(w.model.bias, abs=1e-7)
        got = {r.feature: r.coefficient for r in v.coefficients.collect()}
        assert got == pytest.approx(dict(zip(w.features, w.model.weights)), abs=1e-7)
        assert [r.feature for r in v.importance.collect()][:2] == [r.feature for r in w.importance.collect()][:2]
        a, b = rows(w.predictions), rows(v.predictions)
        assert [r[:3] for r in a] == [r[:3] for r in b]
        assert [r[3] for r in b] == pytest.approx([r[3] for r in a], abs=1e-7)
        assert metrics_document(w).collect() == metrics_document(v).collect()
    assert rows(comparison(wide)) == rows(comparison(thin))
    thin[0].save(str(tmp_path))
    assert spark.read.json(f"{tmp_path}/all/metrics").first().features_count == 5


def test_names_stay_data(spark):
    """20,000 features: no column per name, one plan size, one row per name."""
    rows = spark.range(200_000).selectExpr(
        "id % 400 AS id", "concat('f', (id * 7919) % 20000) AS feature", "CAST(id % 13 AS DOUBLE) AS value"
    ).dropDuplicates(["id", "feature"])
    labels = spark.range(400).selectExpr("id", "CAST(id % 2 AS INT) AS y")
    (run,) = vector_ablation(labels, rows, {"all": None}, "y", "id")
    assert run.features_count == 20_000 and run.coefficients.count() == 20_000
    assert run.predictions.count() == 80


def test_dictionary_entries_and_vectors(spark, rows):
    data = [(1, "b", 4.0, True), (2, "b", 8.0, True), (3, "b", 60.0, False), (1, "a", 5.0, True), (2, "c", None, True), (3, "d", 2.0, False), (4, None, 1.0, True)]
    df = stored_table(spark.createDataFrame(data, "id long, feature string, value double, train boolean"), "rows")
    d = feature_dictionary(df, F.col("train"))
    assert rows(d) == [("a", 0, 1, 5.0, 1.0), ("b", 1, 2, 6.0, 2.0), ("c", 2, 0, 0.0, 1.0), ("d", 3, 0, 0.0, 1.0)]
    entries = stored_table(scaled_entries(df, d, "id"), "entries")
    vectors = with_vectors(spark.range(1, 6), sparse_vectors(entries, "id"), "id")
    got = {r.id: (r["indices"], r["values"]) for r in vectors.collect()}
    assert got == {1: ([0, 1], [0.0, -1.0]), 2: ([1], [1.0]), 3: ([1, 3], [27.0, 2.0]), 4: ([], []), 5: ([], [])}
    ml = {r.id: r.features for r in ml_vectors(vectors, 4, "id").collect()}
    assert ml[3] == SparseVector(4, [1, 3], [27.0, 2.0]) and ml[5] == SparseVector(4, [], [])
    weights = spark.createDataFrame([(1, 0.5), (3, 10.0)], "index int, weight double")
    assert rows(sparse_scores(entries, weights, "id", "s")) == [(1, -0.5), (2, 0.5), (3, 33.5)]
    empty = df.where("false")
    assert feature_dictionary(empty).count() == 0


def test_long_rows_are_the_wide_cells(spark):
    facts = spark.createDataFrame(
        [(c, e, n, "10", str(p), *["5"] * 10) for c in ("69-001", "69-002") for e in ("2017_T1", "2022_T1") for n, p in (("Le Pen", 40.5), ("MACRON", "x" if c == "69-002" else 59.5))],
        "id_commune string, election string, nom string, voix string, pct_voix_exprimes string, inscrits string, abstentions string, "
        "votants string, blancs string, nuls string, exprimes string, pct_abs_ins string, pct_vot_ins string, pct_blancs_ins string, pct_nuls_ins string",
    )
    wide = election_features(facts).collect()
    thin = {(r.id_commune, r.feature): r.value for r in election_rows(facts).collect()}
    cells = {(r.id_commune, c): r[c] for r in wide for c in r.asDict() if c != "id_commune"}
    assert thin == cells and thin[("69-002", "share_macron_2017_t1")] == 0.0
