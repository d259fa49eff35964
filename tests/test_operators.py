import hashlib
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from canton.operators.aggregates import (
    class_balance, common_rows, duel_label, first_and_sum, keep_first, keep_latest, key_drift,
    null_report, profile, vanished_rows, vote_totals, winner_per_group,
)
from canton.operators.dimensions import lookup_key, numbered, require_key, surrogate_key
from canton.operators.metrics import classification_metrics, majority_class
from canton.operators.quality import (
    QualityError, Rule, ceiling_check, enforce, fill_median, fill_unknown, median_value,
    reference_check, run_checks, unique_check, within_percent,
)
from canton.operators.scaling import Scaler, impute_scale
from canton.operators.shaping import filter_area, pivot_sum, slot_count, unpivot_slots
from canton.operators.split import stratified_split
from canton.sources import literal_table


def frame(spark, schema, data):
    return spark.createDataFrame(data, schema)


def test_unpivot(spark, rows):
    df = frame(spark, "k string, n_1 string, v_1 int, n_2 string, v_2 int, v_3 int", [("a", "x", 1, "y", 2, 9)])
    assert slot_count(df.columns, ["n", "v"]) == 2
    assert rows(unpivot_slots(df, ["k"], {"n": "name", "v": "votes"})) == [("a", "x", 1), ("a", "y", 2)]
    with pytest.raises(ValueError):
        unpivot_slots(df, ["k"], ["zzz"])


def test_pivot(spark, rows):
    df = frame(
        spark, "k string, c string, v double",
        [("a", "X y", 1.0), ("a", "X y", 2.0), ("b", "Z", None), (None, "Z", 5.0)],
    )
    out = pivot_sum(df, ["k"], "c", "v")
    assert out.columns == ["k", "x_y", "z"]
    assert rows(out) == [("a", 3.0, None), ("b", None, None)]
    assert rows(pivot_sum(df, ["k"], "c", "v", blank_as_zero=True)) == [("a", 3.0, None), ("b", None, 0.0)]


def test_filter_area(spark, rows):
    df = frame(spark, "d string", [("69",), (" 69",), ("069",), ("6",), ("Code",), (None,)])
    assert rows(filter_area(df, "d", "69")) == [("69",)] * 3
    assert rows(filter_area(df, "d", "69", conform=False)) == [("69",)]


def test_totals_leave_out_incomplete_keys(spark, rows):
    df = frame(spark, "k string, v int", [("a", 1), ("a", 2), (None, 3), ("b", None)])
    assert rows(vote_totals(df, ["k"], ["v"])) == [("a", 3), ("b", None)]


def test_first_is_first_non_null_in_order(spark, rows):
    df = frame(spark, "k string, o int, c string, v int", [("a", 3, "z", 1), ("a", 1, None, 2), ("a", 2, "y", 3)])
    for parts in (1, 5):
        out = first_and_sum(df.repartition(parts), ["k"], ["c"], ["v"], "o")
        assert rows(out) == [("a", "y", 6)]
    assert rows(keep_first(df, ["k"], "o")) == [("a", 1, None, 2)]
    assert rows(keep_latest(df, ["k"], ["o"])) == [("a", 3, "z", 1)]


def test_winner(spark, rows):
    df = frame(spark, "k string, n string, v int", [("a", "x", 5), ("a", "y", 5), ("b", "x", None), ("b", "y", 1), ("c", "z", 9)])
    assert rows(winner_per_group(df, ["k"], "n", "v")) == [("a", "y", 5), ("b", "y", 1), ("c", "z", 9)]
    tie = F.col("n") == "x"
    assert rows(winner_per_group(df, ["k"], "n", "v", tie, ["x", "y"])) == [("a", "x", 5), ("b", "y", 1)]


def test_duel(spark, rows):
    df = frame(
        spark, "k string, n string, v int",
        [("win", "M", 3), ("win", "L", 2), ("tie", "M", 2), ("tie", "L", 2), ("only", "M", 0), ("lose", "L", 1), ("none", "Z", 9)],
    )
    assert rows(duel_label(df, ["k"], "n", "v", "M", "L", "y")) == [("lose", 0), ("only", 1), ("tie", 0), ("win", 1)]


def test_null_report_and_profile(spark, rows):
    df = frame(spark, "a int, b string, c int", [(1, None, 1), (None, None, 1), (2, "x", 1)])
    assert [tuple(r) for r in null_report(df).collect()] == [("b", 2), ("a", 1)]
    assert rows(profile(df, ["a", "c"])) == [(3, "a", 2), (3, "c", 1)]
    assert rows(profile(df, ["a", "c"], approximate=True)) == [(3, "a", 2), (3, "c", 1)]
    assert rows(class_balance(df, "c")) == [(1, 3)]


def test_key_drift(spark, rows):
    a = frame(spark, "k int, x int", [(1, 0), (1, 0), (2, 0), (None, 0)])
    b = frame(spark, "k int", [(2,), (3,), (None,)])
    assert rows(key_drift(a, b, ["k"])) == [(1, "only_first"), (2, "both"), (3, "only_second"), (None, "both")]
    assert rows(common_rows(a, b, ["k"])) == [(2, 0)]
    assert rows(vanished_rows(a, b, ["k"])) == [(1, 0), (1, 0), (None, 0)]


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_numbering_is_dense_and_follows_the_keys(spark, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        names = [f"n{i % 7}-{i}" for i in range(500)]
        df = frame(spark, "k string", [(n,) for n in names] + [(None,)]).repartition(parts + 1)
        out = {r.number: r.k for r in numbered(df, ["k"], "number").collect()}
        assert out == dict(enumerate([None, *sorted(names)], 1))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_surrogate_key_and_lookup(spark, rows):
    fact = frame(spark, "n string, p string, v int", [("b", None, 1), ("a", "x", 2), ("b", None, 3)])
    dim = surrogate_key(fact, ["n", "p"], "id", "CAND_")
    assert rows(dim) == [("CAND_001", "a", "x"), ("CAND_002", "b", None)]
    assert rows(lookup_key(fact, dim, ["n", "p"])) == [
        ("a", "x", 2, "CAND_001"), ("b", None, 1, "CAND_002"), ("b", None, 3, "CAND_002")
    ]
    assert rows(lookup_key(fact, dim, ["n", "p"], null_safe=False), "id") == [("CAND_001",), (None,), (None,)]


def test_unknown_key_fails(spark):
    fact = frame(spark, "id int", [(1,), (2,)])
    dim = frame(spark, "id int, label string", [(1, "a")])
    with pytest.raises(Exception, match="unknown id"):
        require_key(fact, dim, ["id"], "label").collect()


@pytest.mark.parametrize("n0, n1", [(300, 9), (5, 5), (1, 40), (0, 3)])
def test_split_equals_brute_force(spark, n0, n1):
    data = [(i, 0) for i in range(n0)] + [(10_000 + i, 1) for i in range(n1)] + [(-1, None)]
    expected = set()
    for y in (0, 1):
        ids = sorted((i for i, c in data if c == y), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
        expected |= set(ids[: max(1, round(len(ids) * 0.8))] if ids else [])
    df = frame(spark, "id int, y int", data)
    for parts in (1, 6):
        train, test = stratified_split(df.repartition(parts), "y", "id")
        got, rest = {r.id for r in train.collect()}, {r.id for r in test.collect()}
        assert got == expected and not got & rest and len(got | rest) == n0 + n1


def test_scaling_uses_training_statistics(spark):
    train = frame(spark, "a double, b double, c int", [(1.0, None, 5), (3.0, None, 5), (None, None, 5)])
    test = frame(spark, "a double, b double, c int", [(None, 4.0, 6)])
    scaler = Scaler.fit(train, ["a", "b", "c"])
    assert scaler.means == (2.0, 0.0, 5.0) and scaler.deviations == (1.0, 1.0, 1.0)
    scaled, other = impute_scale(train, test, columns=["a", "b", "c"])
    assert sorted(tuple(r) for r in scaled.collect()) == [(-1.0, 0.0, 0.0), (0.0, 0.0, 0.0), (1.0, 0.0, 0.0)]
    assert tuple(other.first()) == (0.0, 4.0, 1.0)


def confusion(spark, tp, tn, fp, fn):
    data = [(1, 1)] * tp + [(0, 0)] * tn + [(0, 1)] * fp + [(1, 0)] * fn
    return frame(spark, "y int, p int", data)


def test_metrics_reproduce_published_scores(spark):
    """Confusion counts and scores published for the two feature sets."""
    for counts, published in (
        ((41, 9, 1, 3), (0.9259259259259259, 0.9159090909090909, 0.9761904761904762, 0.9318181818181818, 0.9534883720930233)),
        ((41, 8, 2, 3), (0.9074074074074074, 0.865909090909091, 0.9534883720930233, 0.9318181818181818, 0.942528735632184)),
        ((44, 0, 10, 0), (0.8148148148148148, 0.5, 0.8148148148148148, 1.0, 0.8979591836734693)),
    ):
        m = classification_metrics(confusion(spark, *counts), "y", "p").first()
        assert (m.accuracy, m.balanced_accuracy, m.precision, m.recall, m.f1) == pytest.approx(published, abs=1e-15)
        assert (m.tp, m.tn, m.fp, m.fn) == counts


def test_metrics_without_rows_are_zero(spark):
    m = classification_metrics(confusion(spark, 0, 0, 0, 0), "y", "p").first()
    assert set(m) == {0}


def test_majority(spark):
    assert majority_class(confusion(spark, 1, 1, 0, 0), "y") == 0
    assert majority_class(confusion(spark, 2, 1, 0, 0), "y") == 1


def test_quality_report(spark, rows):
    df = frame(spark, "k int, pct double, v int, top int", [(1, 50.0, 5, 9), (1, 101.0, 5, 9), (2, None, 1, 9)])
    dim = frame(spark, "k int", [(1,)])
    report = run_checks(
        df, [within_percent("pct"), Rule("big", F.col("v") > 4, critical=False)],
        unique_check(df, ["k"], "unique"), reference_check(df, dim, ["k"], "known"),
        ceiling_check(df, ["k"], "v", "top", "ceiling"),
    )
    assert rows(report) == [
        ("big", False, 3, 2), ("ceiling", True, 2, 1), ("known", True, 3, 1),
        ("pct_in_0_100", True, 3, 1), ("unique", True, 3, 1),
    ]
    with pytest.raises(QualityError, match="pct_in_0_100: 1 of 3"):
        enforce(report)
    assert enforce(report.where("NOT critical")).count() == 1


@pytest.mark.parametrize("size", [1, 2, 7, 1000, 20_001])
def test_median_is_exact(spark, size):
    values = [float(v) for v in np.random.default_rng(size).integers(0, size * 3 + 1, size)]
    df = literal_table(spark, ["v"], [(v,) for v in values]).repartition(5)
    assert median_value(df, "v") == statistics.median(values)


def test_median_with_a_hot_value(spark):
    values = [1.0] * 400 + [2.0] * 300 + [5.0] * 200
    df = literal_table(spark, ["v"], [(v,) for v in values])
    assert median_value(df, "v") == 2.0


def test_null_policy(spark, rows):
    df = frame(spark, "n string, p double", [(None, 4.0), ("X", None), ("Y", 8.0)])
    assert rows(fill_median(fill_unknown(df, {"n": "DVR"}), "p")) == [("DVR", 4.0), ("X", 6.0), ("Y", 8.0)]
    empty = df.where("p > 100")
    assert median_value(empty, "p") is None


def test_split_with_many_classes(spark):
    df = spark.range(60_000).selectExpr("id", "id % 20000 AS y")
    train, test = stratified_split(df, "y", "id")
    assert (train.count(), test.count()) == (40_000, 20_000)


def test_median_of_a_continuous_column(spark):
    df = spark.range(60_001).selectExpr("rand(3) * 1000 AS v")
    values = sorted(r[0] for r in df.collect())
    for accuracy in (100, 10_000):
        assert median_value(df, "v", accuracy) == values[30_000]
    even = df.limit(60_000)
    values = sorted(r[0] for r in even.collect())
    assert median_value(even, "v", 100) == (values[29_999] + values[30_000]) / 2
