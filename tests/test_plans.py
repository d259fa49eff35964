import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from canton.operators.dimensions import members
from canton.operators.quality import unique_check
from canton.operators.shaping import filter_area, slot_columns
from canton.plans import layouts as L
from canton.plans.experiment import LogitModel, ablation, comparison, fit_logit, metrics_document
from canton.plans.features import (
    assemble, commune_labels, election_features, labelled_facts, safety_features,
)
from canton.plans.safety import conform_safety, wide_safety
from canton.operators.dimensions import lookup_key, surrogate_key
from canton.operators.quality import run_checks
from canton.plans.experiment import run_experiment
from canton.operators.scaling import Scaler
from canton.session import stored_table
from canton.plans.stars import build_safety_star, build_star
from canton.plans.votes import (
    ballot_totals, candidate_votes, commune_totals, enrich, numeric_columns, readable_counts, silver_votes, stations_to_communes, versus,
)
from canton.sources import file_order, literal_table, read_delimited, read_wide_votes

SLOTS = 2
COLUMNS = slot_columns(L.STATION_FIELDS, L.CANDIDATE_FIELDS, SLOTS)


def station(dept, commune, label, bureau, counts, *candidates):
    """One source line: counts are inscrits, abstentions, votants, blancs, nuls, exprimés."""
    ins, abst, vot, blancs, nuls, exp = map(str, counts)
    common = [dept, "Rhône", "1", "c", commune, label, bureau, ins, abst, "", vot, "", blancs, "", "", nuls, "", "", exp, "", ""]
    slots = []
    for i, (sex, name, first, votes) in enumerate(candidates, 1):
        slots += [str(i), sex, name, first, str(votes), "", ""]
    return common + slots


def pair(a, b):
    return ("F", " LE PEN", "Marine", a), ("M", "MACRON", "Emmanuel ", b)


LINES = [
    COLUMNS,
    station("69", "1", "Affoux", "1", (100, 20, 80, 5, 5, 70), *pair(30, 40)),
    station(" 69", "1", "Affoux", "2", (50, 10, 40, 0, 0, 40), *pair(25, 15)),
    station("069", "2", "Saint-Cœur €", "1", (30, 30, 0, 0, 0, 0), *pair(0, 0)),
    station("01", "1", "Ailleurs", "1", (9, 0, 9, 0, 0, 9), *pair(9, 0)),
]


@pytest.fixture
def votes_file(tmp_path):
    path = tmp_path / "votes.txt"
    path.write_bytes("\n".join(";".join(line) for line in LINES).encode("cp1252"))
    return str(path)


@pytest.fixture
def bronze(spark, votes_file):
    wide = read_wide_votes(spark, votes_file, L.STATION_FIELDS, L.CANDIDATE_FIELDS, SLOTS, header=False)
    return filter_area(wide, "Code du département", "69")


@pytest.fixture
def reference(spark, tmp_path):
    """Byte-order mark, swapped name headers and a repeated row."""
    path = tmp_path / "ref.csv"
    path.write_text("﻿Nom,Prénom,nuance\nMarine,LE PEN,RN\nMarine, LE PEN ,XX\n")
    return read_delimited(spark, str(path), sep=",")


ON = {"nom": "Prénom", "prenom": "Nom"}


def test_bronze_to_silver(spark, bronze, reference, rows):
    out = silver_votes(bronze, reference, "votes.txt", (2017, 1), "2024-01-01T00:00:00", on=ON)
    assert tuple(out.columns) == L.SILVER_VOTES
    got = {(r.code_commune, r.nom): r for r in out.collect()}
    assert set(got) == {("001", "LE PEN"), ("001", "MACRON"), ("002", "LE PEN"), ("002", "MACRON")}
    a = got["001", "MACRON"]
    assert (a.code_departement, a.inscrits, a.votants, a.exprimes, a.voix) == ("69", 150, 120, 110, 55)
    assert (a.pct_vot_ins, a.pct_exprimes_vot, a.pct_voix_exprimes, a.pct_voix_ins) == (80.0, 91.67, 50.0, 36.67)
    assert (a.annee_election, a.tour, a.prenom, a.nuance, a.numero_panneau) == (2017, 1, "Emmanuel", None, 2)
    b = got["002", "LE PEN"]
    assert b.nuance == "RN" and b.libelle_commune == "Saint-Cœur €"
    assert (b.pct_vot_ins, b.pct_blancs_vot, b.pct_voix_exprimes, b.pct_voix_ins) == (0.0, 0.0, 0.0, 0.0)


def test_strict_counts_fail_on_text(spark, bronze, reference):
    bad = bronze.withColumn("Inscrits", F.lit("12,5"))
    with pytest.raises(Exception, match="no whole number: 12,5"):
        silver_votes(bad, reference, "x", (2017, 1), on=ON).collect()
    oops = bronze.withColumn("Voix_2", F.lit("oops"))
    with pytest.raises(Exception, match="no whole number: oops"):
        silver_votes(oops, reference, "x", (2017, 1), on=ON).collect()
    comma = bronze.withColumn("Inscrits", F.lit("12,0"))
    got = silver_votes(comma, reference, "x", (2017, 1), on=ON).select("inscrits").collect()
    assert {r[0] for r in got} <= {12, 24}
    coerced = silver_votes(oops, reference, "x", (2017, 1), on=ON, strict=False)
    assert coerced.where("numero_panneau = 2 AND voix IS NOT NULL").count() == 0
    found = run_checks(oops, readable_counts(oops)).where("failed > 0").collect()
    assert [(r.check_name, r.failed) for r in found] == [("Voix_2_readable", oops.count())]


def test_reference_keeps_the_first_row(spark, rows):
    df = literal_table(spark, ["nom", "v"], [(" a", 1), ("b", 2)])
    ref = literal_table(spark, ["key", "n", "tag"], [("a ", 2, "late"), ("a", 1, "early")])
    assert rows(enrich(df, ref, {"nom": "key"}, "n"), "nom", "tag") == [("a", "early"), ("b", None)]


def test_stations_to_communes(spark, votes_file, rows):
    wide = read_delimited(spark, votes_file, COLUMNS, encoding="cp1252", header=False)
    df = filter_area(wide.withColumn("at", file_order()), "Code du département", "69")
    comma = df.withColumn("Voix_1", F.concat("Voix_1", F.lit(",0")))
    out = {r["Libellé de la commune"]: r for r in stations_to_communes(comma, "at").collect()}
    a = out["Affoux"]
    assert (a["Inscrits"], a["Voix_1"], a["Voix_2"], a["Nom_1"], a["Code du département"]) == (150, 55, 55, " LE PEN", "69")
    assert (a["% Abs/Ins"], a["% Exp/Vot"], a["% Voix/Exp_1"]) == (20.0, 91.67, 50.0)
    assert out["Saint-Cœur €"]["% Exp/Vot"] is None
    again = stations_to_communes(comma.repartition(7), "at")
    assert rows(again.select("Inscrits", "Voix_1")) == rows(literal_table(spark, ["i", "v"], [(150, 55), (30, 0)]))


def test_homonyms_stay_apart_unless_grouped_by_name(spark, bronze):
    same = bronze.withColumn("Libellé de la commune", F.lit("Saint-Loup"))
    order = F.col("`Code du b.vote`")
    assert stations_to_communes(same, order).count() == 2
    assert stations_to_communes(same, order, ("Libellé de la commune",)).count() == 1


def test_numeric_columns_and_versus(spark, rows):
    df = literal_table(spark, ["% Abs", "Nom", "Voix_1"], [("1,5", "x", "abc"), ("2", "y", " 3 ")])
    assert rows(numeric_columns(df, ["%", "Voix"])) == [(1.5, "x", None), (2.0, "y", 3.0)]
    two = literal_table(spark, ["a", "b"], [(1, 3), (1, 0)])
    assert rows(versus(two, "a", "b", "r"), "r") == [(0.33,), (None,)]


def silver_rows(spark):
    """Three elections, a commune that changed its label, three candidates."""
    out = []
    for year, tour in ((2017, 1), (2022, 1), (2022, 2)):
        for code, label in (("001", "Belleville" if year == 2017 else "Belleville-en-B."), ("002", "Loup")):
            for i, (name, sex, party, votes) in enumerate(
                (("MACRON", "M", "REM", 60 if code == "001" else 40), ("LE PEN", "F", None, 40)), 1
            ):
                out.append(
                    ("69", "Rhône", code, label, year, tour, 120, 10, 110, 5, 5, 100)
                    + (8.33, 91.67, 4.17, 4.55, 4.17, 4.55, 83.33, 90.91)
                    + (i, sex, name, "P", votes, 50.0, float(votes), party, "src", "t")
                )
    types = {"libelle": "string", "code": "string", "pct": "double"}
    texts = ("sexe", "nom", "prenom", "nuance", "source_dataset", "date_refresh")
    schema = ", ".join(
        f"{c} " + ("string" if c in texts else types.get(c.split("_")[0], "bigint")) for c in L.SILVER_VOTES
    )
    return spark.createDataFrame(out, schema)


def test_vote_star(spark, rows, tmp_path):
    star = build_star(silver_rows(spark), "t0")
    assert rows(star.dim_election, "id_election") == [("2017_T1",), ("2022_T1",), ("2022_T2",)]
    assert rows(star.dim_commune, "id_commune", "libelle_commune") == [("69-001", "Belleville-en-B."), ("69-002", "Loup")]
    assert star.commune_history.count() == 3
    assert rows(star.dim_candidat, "id_candidat", "nom") == [("CAND_001", "LE PEN"), ("CAND_002", "MACRON")]
    facts = star.fact_resultats
    assert facts.count() == 12 and facts.where("id_candidat IS NULL").count() == 0
    assert facts.columns == ["id_commune", "id_election", "id_candidat", *L.VOTE_MEASURES, "date_integration_gold"]
    assert unique_check(star.dim_commune, ["id_commune"], "u").first().failed == 0
    star.save(str(tmp_path))
    back = spark.read.parquet(f"{tmp_path}/fact_resultats")
    assert back.count() == 12 and members(back, ["id_election"]).count() == 3


def safety_bronze(spark):
    columns = [*L.SAFETY_FIELDS]
    columns[0] = " CODGEO_2025 "
    base = dict(zip(L.SAFETY_FIELDS, ["69001", "2021", "Vols d'accessoires", "Infraction", "3", "1.5", "diff",
                                      "1000", "2020-01-01", "400", "bad", "", "x", "2024-05-01 10:00:00", "2024-05-02"]))
    changes = [
        {}, {"annee": "2022-06-01", "taux_pour_mille": ""}, {"CODGEO_2025": "1004", "taux_pour_mille": "ndiff"},
        {"annee": "2019"}, {"indicateur": "Usage de stupéfiants (AFD)", "unite_de_compte": "Mis en cause", "taux_pour_mille": "0.25"},
    ]
    data = [tuple({**base, **c}.values()) for c in changes]
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in columns))


def test_safety_silver_and_star(spark, rows):
    silver = conform_safety(safety_bronze(spark))
    assert tuple(silver.columns) == L.SILVER_SAFETY
    assert rows(silver, "code_departement", "code_commune", "annee", "taux_pour_mille") == [
        ("01", "004", 2021, None), ("69", "001", 2019, 1.5), ("69", "001", 2021, 0.25),
        ("69", "001", 2021, 1.5), ("69", "001", 2022, None),
    ]
    first = silver.where("annee = 2019").first()
    assert first.insee_log_millesime is None and first.insee_pop_millesime.year == 2020
    assert first.complement_info_nombre is None and first.nombre == 3.0
    wide = wide_safety(silver)
    assert wide.columns[5:] == ["usage_de_stupéfiants_(afd)", "vols_d_accessoires"]
    assert rows(wide.where("annee > 2019"), "code_commune", "annee", *[f"`{c}`" for c in wide.columns[5:]]) == [
        ("001", 2021, 0.25, 1.5), ("001", 2022, None, 0.0), ("004", 2021, None, 0.0)
    ]
    star = build_safety_star(silver)
    assert rows(star.dim_indicateur_securite, "id_indicateur_securite", "indicateur") == [
        ("SEC_001", "Usage de stupéfiants (AFD)"), ("SEC_002", "Vols d'accessoires")
    ]
    assert tuple(star.fact_securite.columns) == L.FACT_SAFETY and star.fact_securite.count() == 5
    features = safety_features(star.fact_securite, star.dim_indicateur_securite)
    got = {r.id_commune: r for r in features.collect()}
    row = got["69-001"]
    assert row.sec_rate_usage_de_stupefiants_afd_2021 == 0.25
    assert row.sec_rate_vols_d_accessoires_2022 == 0.0  # present but blank
    assert row.sec_rate_usage_de_stupefiants_afd_2022 is None  # absent
    assert (row.insee_pop_2021, row.insee_log_2022) == (1000.0, 400.0)
    assert set(got) == {"69-001", "01-004"}


def test_election_features_and_assembly(spark, rows):
    star = build_star(silver_rows(spark))
    short = star.fact_resultats.withColumn("id_commune", F.regexp_replace("id_commune", "-0+", "-"))
    facts = labelled_facts(short, star.dim_election, star.dim_candidat)
    features = election_features(facts, exclude=["2022_T2"])
    assert len(features.columns) == 1 + 2 * (10 + 2)
    targets = commune_labels(facts, "2022_T2", "MACRON", "LE PEN", "y")
    assert rows(targets) == [("69-001", 1), ("69-002", 0)]
    data = assemble(targets, features.where("id_commune = '69-001'"))
    assert data.columns[2:] == sorted(data.columns[2:])
    assert rows(data, "id_commune", "share_le_pen_2017_t1", "inscrits_2022_t1") == [
        ("69-001", 40.0, 120.0), ("69-002", None, None)
    ]
    only_2017 = election_features(facts, exclude=["2022_T2", "2022_T1"])
    assert len(only_2017.columns) == 1 + 12


def test_unknown_election_fails(spark):
    star = build_star(silver_rows(spark))
    known = star.dim_election.where("tour = 1")
    with pytest.raises(Exception, match="unknown id_election"):
        labelled_facts(star.fact_resultats, known, star.dim_candidat).collect()


def toy(n=120, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    x = (x - x.mean(0)) / x.std(0)
    y = (x @ [1.5, -1.0, 0.0] + rng.normal(size=n) > 0.3).astype(int)
    return x, y


def descend(x, y, epochs, lr=0.05, l2=0.001):
    w, b = np.zeros(x.shape[1]), 0.0
    for _ in range(epochs):
        e = 1 / (1 + np.exp(-np.clip(x @ w + b, -50, 50))) - y
        w, b = w - lr * (e @ x / len(y) + l2 * w), b - lr * e.mean()
    return w, b


def toy_frame(spark):
    x, y = toy()
    return spark.createDataFrame(
        [(i, int(t), *map(float, r)) for i, (r, t) in enumerate(zip(x, y))],
        "id int, y int, a double, b double, c double",
    )


def test_descent_follows_the_brute_force_steps(spark):
    df = toy_frame(spark).repartition(4)
    model = fit_logit(df, ["a", "b", "c"], "y", solver="descent", epochs=4)
    w, b = descend(*toy(), epochs=4)
    assert model.weights == pytest.approx(tuple(w), abs=1e-12) and model.bias == pytest.approx(b, abs=1e-12)


def test_mllib_reaches_the_optimum_of_the_same_objective(spark):
    model = fit_logit(toy_frame(spark), ["a", "b", "c"], "y")
    w, b = descend(*toy(), epochs=60_000)
    assert model.weights == pytest.approx(tuple(w), abs=2e-3) and model.bias == pytest.approx(b, abs=2e-3)
    with pytest.raises(ValueError):
        fit_logit(toy_frame(spark), ["a"], "y", solver="other")


def test_model_scores_and_importance(spark):
    model = LogitModel(("a", "b"), (0.5, -2.0), 1.0)
    df = literal_table(spark, ["a", "b"], [(2.0, 1.0), (0.0, 0.0), (0.0, 1.0)])
    got = [tuple(r)[2:] for r in model.predict(df).collect()]
    assert [c for _, c in got] == [1, 1, 0]
    assert got[1][0] == pytest.approx(1 / (1 + np.exp(-1)))
    assert [tuple(r) for r in model.importance(spark).collect()] == [("b", -2.0, 2.0), ("a", 0.5, 0.5)]


def test_ablation_and_its_files(spark, tmp_path, rows):
    sets = {"all": ["a", "b", "c"], "weak": ["c"]}
    runs = ablation(toy_frame(spark).persist(), sets, "y", "id")
    table = {r.experiment: r for r in comparison(runs).collect()}
    assert table["all"].features_count == 3 and table["all"].accuracy > table["weak"].accuracy
    assert rows(runs[0].predictions, "id") == rows(runs[1].predictions, "id")  # same split
    doc = metrics_document(runs[0]).first()
    assert doc.dataset_rows == 120 and doc.baseline_metrics.balanced_accuracy == 0.5
    assert doc.model_metrics.tp + doc.model_metrics.tn + doc.model_metrics.fp + doc.model_metrics.fn == 24
    runs[0].save(str(tmp_path))
    saved = read_delimited(spark, f"{tmp_path}/all/feature_importance", sep=",")
    assert saved.columns == ["feature", "coefficient", "abs_coefficient"] and saved.count() == 3
    assert spark.read.json(f"{tmp_path}/all/metrics").first().features_count == 3
    assert read_delimited(spark, f"{tmp_path}/all/test_predictions", sep=",").count() == 24


def test_small_dimension_leaves_the_facts_where_they_are(spark):
    """The dimension derives from the facts and would be estimated at their size."""
    facts = spark.range(40_000).selectExpr("id", "concat('k', id % 7) AS k")
    dim = stored_table(surrogate_key(facts, ["k"], "id_k", "K"), "dim")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        out = lookup_key(facts, dim, ["k"])
        assert out.where("id_k IS NULL").count() == 0
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_odd_feature_names(spark):
    """Dots and backticks in names come from data; a statistic may be infinite."""
    names = ["a.b", "c`d"]
    rows = [(i, i % 2, float(i), float(i % 3)) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, y int, `a.b` double, `c``d` double")
    run = run_experiment("odd", df, names, "y", "id")
    assert run.predictions.where("predicted_proba IS NULL").count() == 0 and run.features == tuple(names)
    scaler = Scaler(("a.b",), (0.0,), (float("inf"),))
    assert {r[0] for r in scaler.transform(df).select("`a.b`").collect()} == {0.0}


def test_silver_reads_the_stations_once(spark, bronze, reference, rows):
    silver = silver_votes(bronze, reference, "x", (2017, 1), on=ON)
    plan = silver._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("relation [code du département") == 1


def test_ballots_equal_candidates_beside_totals(spark, bronze, rows):
    """Ballots that change between stations, blank slots and their odd votes."""
    other = bronze.where("`Code du b.vote` = '2'").withColumns(
        {"Nom_1": F.lit("AUTRE"), "N°Panneau_2": F.lit(None).cast("string"), "Voix_2": F.lit("not counted")}
    )
    both = bronze.unionByName(other).unionByName(bronze.withColumn("Code de la commune", F.lit(None).cast("string")))
    keys, names = dict(L.AREA_FIELDS), list(L.AREA_FIELDS.values())
    items, totals = candidate_votes(both, keys), commune_totals(both, keys)
    want = items.join(totals, names).select(*names, *L.COUNTS, "numero_panneau", "sexe", "nom", "prenom", "voix")
    assert rows(ballot_totals(both, keys).select(*want.columns)) == rows(want)
    assert {r["nom"] for r in want.collect()} == {" LE PEN", "MACRON", "AUTRE"}


def test_counts_are_read_by_compiled_code(spark, bronze):
    """A function over array elements would be interpreted, station by station."""
    plan = ballot_totals(bronze, dict(L.AREA_FIELDS))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan


def test_counts_of_a_ballot_leave_the_stage_compiled(spark):
    """The JVM interprets a generated method of more than 8,000 bytes."""
    import __spark_entry__ as contract

    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = contract.queries()["silver_votes"](spark, "/root/testdata/sf0.001")
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8_000


def test_a_ballot_is_one_grouping_key(spark, bronze):
    """Its candidates are not hashed and compared one by one for every station."""
    keys = dict(L.AREA_FIELDS)
    plan = ballot_totals(bronze, keys)._jdf.queryExecution().executedPlan().toString()
    dealt = [found.split(", ") for found in re.findall(r"hashpartitioning\(([^)]*), \d+\)", plan)]
    assert dealt and max(map(len, dealt)) == len(keys) + 1


def test_stations_are_joined_without_sorts(spark):
    from canton.workload.votes import station_rows

    plan = station_rows(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in plan
