import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from canton import functions as C


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [(" 7 ", "7"), ("\t7\r\n", "7"), (" 7 ", "7"), ("a b", "a b"), ("   ", ""), (None, None)],
)
def test_strip(spark, text, expected):
    assert one(spark, C.strip(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize("text, width, expected", [("7", 3, "007"), ("12345", 3, "12345"), ("", 2, "00"), (None, 2, None)])
def test_zfill_pads_and_never_cuts(spark, text, width, expected):
    assert one(spark, C.zfill(F.lit(text).cast("string"), width)) == expected


def test_decimal_suffix(spark):
    assert one(spark, C.drop_decimal_suffix(F.lit("12.0"))) == "12"
    assert one(spark, C.drop_decimal_suffix(F.lit("10.05"))) == "10.05"
    assert one(spark, C.drop_decimal_suffix(F.lit("10.05"), anywhere=True)) == "105"
    assert one(spark, C.lstrip_zeros(F.lit("0069"))) == "69"


@pytest.mark.parametrize(
    "text, expected",
    [
        ("69-1", "69-001"), ("69-001", "69-001"), ("69-1.0", "69-001"), (" 1 - 23 ", "01-023"),
        ("69001", "69001"), (" x ", "x"), ("69-1-2", "69-1-2"), ("2A-4", "2A-004"), (None, None),
    ],
)
def test_commune_id(spark, text, expected):
    assert one(spark, C.commune_id(F.lit(text).cast("string"))) == expected


def test_insee_and_labels(spark):
    assert one(spark, C.insee_commune_id(F.lit("1004"))) == "01-004"
    assert one(spark, C.election_label(F.lit(2022), F.lit(1))) == "2022_T1"
    assert one(spark, C.numbered_id(F.lit(12), "SEC_")) == "SEC_012"
    assert one(spark, C.numbered_id(F.lit(12345), "SEC_")) == "SEC_12345"
    assert one(spark, C.composite_key(F.lit("a"), F.lit(None).cast("string"))) is None


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Violences physiques (hors cadre)", "violences_physiques_hors_cadre"),
        ("  LE PEN ", "le_pen"),
        ("Vols d'accessoires / véhicules", "vols_d_accessoires_vehicules"),
        ("__É-è--ç__", "e_e_c"),
        ("", ""),
    ],
)
def test_slugify(spark, text, expected):
    assert one(spark, C.slugify(F.lit(text))) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("1.5", 1.5), (" 12.0\t", 12.0), (" 3 ", 3.0), ("-1e3", -1000.0), ("", None), ("abc", None),
        ("1d", None), ("2.5F", None), ("0x1p3", None), ("inf", math.inf), ("-Infinity", -math.inf),
        ("nan", None), (None, None), ("1,5", None),
    ],
)
def test_to_double(spark, text, expected):
    assert one(spark, C.to_double(F.lit(text).cast("string"))) == expected


def test_number_defaults(spark):
    assert one(spark, C.to_double(F.lit(""), 0.0)) == 0.0
    assert one(spark, C.to_double(F.lit("x"), 0.0)) == 0.0
    assert one(spark, C.to_double(F.lit(None).cast("double"), 0.0)) == 0.0
    assert one(spark, C.to_double(F.lit("nan"), 0.0)) is None  # known to be missing
    assert one(spark, C.to_long(F.lit("1.9"))) == 1
    assert one(spark, C.to_long(F.lit("-1.9"))) == -1
    assert one(spark, C.to_long(F.lit("9007199254740993"))) == 9007199254740993
    assert one(spark, C.to_long(F.lit("1e30"), 7)) == 7
    assert one(spark, C.to_long(F.lit("99999999999999999999"), 7)) == 7
    assert one(spark, C.to_long(F.lit(" 12,9 "), decimal_comma=True)) == 12
    assert one(spark, C.to_long(F.lit("12,9"))) is None
    assert one(spark, C.to_long(F.lit(3).cast("int"))) == 3
    assert one(spark, C.to_long(F.lit("x"), 7)) == 7
    assert one(spark, C.to_long(F.lit(2.9))) == 2
    assert one(spark, C.to_long(F.lit(5).cast("long"))) == 5
    assert one(spark, C.to_double(C.decimal_point(F.lit("1,5")))) == 1.5


@pytest.mark.parametrize(
    "text, expected",
    [("12", 12), ("007", 7), (" 12\t", 12), ("+5", 5), ("-5", -5), ("-0", 0), ("12.0", 12), ("12,", 12),
     ("9007199254740993", 9007199254740993), (None, None), *[(t, "fails") for t in ("12.7", "", "x", "1e3", "\x0012", "99999999999999999999")]],
)
def test_count_or_fail(spark, text, expected):
    value = C.count_or_fail(F.lit(text).cast("string"))
    if expected != "fails":
        assert one(spark, value) == expected
    else:
        with pytest.raises(Exception, match="no whole number"):
            one(spark, value)


@pytest.mark.parametrize("text", ["0", "9", "10", "99999", "1234567", "12345678", "-5", "007", " 7", "7,0", "\x007", "7\x7f", "1e3"])
def test_count_with_its_number_at_hand(spark, text):
    rows = spark.createDataFrame([(text,)], "t string").select("t", C.plain_number(F.col("t")).alias("n"))
    if text.strip(" -,.0123456789"):
        with pytest.raises(Exception, match="no whole number"):
            rows.select(C.count_or_fail(F.col("t"), F.col("n"))).collect()
    else:
        assert rows.select(C.count_or_fail(F.col("t"), F.col("n"))).first()[0] == int(text.split(",")[0])


def test_strict_cast_raises(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, F.lit("12x").cast("long"))


@pytest.mark.parametrize("x", [0.125, 2.675, 12.345, 0.375, 1.005, -0.125, 99.995])
def test_half_even_equals_numpy(spark, x):
    assert one(spark, C.half_even(F.lit(x))) == np.round(x, 2)


def test_whole_rounds_half_to_even(spark):
    assert [one(spark, C.whole(F.lit(x))) for x in (0.5, 1.5, 2.5, -0.5)] == [0, 2, 2, 0]
    assert one(spark, C.truncated(F.lit(-2.9))) == -2


def test_percentages(spark):
    def p(a, b, guard=False):
        return one(spark, C.pct(F.lit(a), F.lit(b), guard))

    assert p(1, 3) == 33.33
    assert p(1, 0) is None and p(0, 0) is None
    assert p(1, 0, True) == 0.0 and p(1, -1, True) == 0.0 and p(1, 8, True) == 12.5
    assert one(spark, C.pct(F.lit(1), F.lit(None).cast("int"), True)) == 0.0
    assert one(spark, C.per_mille(F.lit(5), F.lit(0))) == 0.0
    assert one(spark, C.per_mille(F.lit(5), F.lit(1000))) == 5.0
    assert one(spark, C.per_mille(F.lit(5), F.lit(None).cast("int"))) is None


def test_times(spark):
    assert one(spark, C.year_of(F.lit("2021"))) == 2021
    assert one(spark, C.year_of(F.lit("2022-03-04"))) == 2022
    assert one(spark, C.year_of(F.lit("soon"))) is None
    assert one(spark, C.timestamp_or_null(F.lit("2022-13-04"))) is None


def test_vectors(spark):
    assert one(spark, C.sigmoid(F.lit(0.0))) == 0.5
    assert one(spark, C.sigmoid(F.lit(1e9))) == one(spark, C.sigmoid(F.lit(50.0)))
    assert one(spark, C.sigmoid(F.lit(-1e9))) == 1 / (1 + math.exp(50))
    a, b = F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(3.0), F.lit(4.0))
    assert one(spark, C.dot(a, b)) == 11.0
    n = 301
    df = spark.range(1).select(*[F.lit(float(i)).alias(f"c{i}") for i in range(n)])
    total = C.weighted_sum([f"c{i}" for i in range(n)], [1.0] * n)
    assert df.select(total).first()[0] == n * (n - 1) / 2
    assert df.select(C.weighted_sum(["c2"], [-1.5e-7])).first()[0] == -3e-7
    assert one(spark, C.above_threshold(F.lit(0.5))) == 1
    assert one(spark, C.contains_any(F.lit("Code DEPT"), ["dept"]))
