"""From landed files to the compared experiments."""

import random

import pytest
from pyspark.sql import functions as F

from canton.operators.quality import QualityError
from canton.operators.shaping import slot_columns
from canton.plans import layouts as L
from canton.plans.medallion import (
    VoteSource, bronze_reference, bronze_votes, build_model, build_safety, build_votes,
)
from canton.sources import export_csv, read_delimited, read_table
from canton.workload.files import pack_workbook

NAMES = [("F", "LE PEN", "Marine"), ("M", "MACRON", "Emmanuel"), ("F", "JOLY", "Eva")]
COMMUNES = 30


def lines(slots, seed, too_many=False):
    rng = random.Random(seed)
    out = []
    for code in range(1, COMMUNES + 1):
        for bureau in (1, 2):
            votes = [rng.randint(10, 60) for _ in range(slots)]
            exp = sum(votes) - (50 if too_many else 0)
            row = ["69", "Rhône", "1", "c", str(code), f"Commune {code}", str(bureau), exp + 40, 30, "",
                   exp + 10, "", 6, "", "", 4, "", "", exp, "", ""]
            for i in range(slots):
                row += [i + 1, *NAMES[i], votes[i], "0,1", "0,1"]
            out.append([str(v) for v in row])
        out.append(["01", *out[-1][1:]])
    return out


def as_text(rows, header):
    return "\n".join(";".join(r) for r in [header, *rows]).encode("cp1252")


@pytest.fixture
def landed(tmp_path):
    first = list(L.CANDIDATE_FIELDS)
    (tmp_path / "17t1.txt").write_bytes(as_text(lines(3, 1), [*L.STATION_FIELDS, *first]))
    (tmp_path / "17t2.txt").write_bytes(as_text(lines(2, 2), slot_columns(L.STATION_FIELDS, first, 2)))
    (tmp_path / "22t1.xlsx").write_bytes(
        pack_workbook([[*L.STATION_FIELDS, *first, *[None] * 14], *[[v or None for v in r] for r in lines(3, 3)]])
    )
    (tmp_path / "22t2.xlsx").write_bytes(
        pack_workbook([[*L.STATION_FIELDS, *first, *first], *[[v or None for v in r] for r in lines(2, 4)]])
    )
    (tmp_path / "ref.csv").write_text("﻿Nom,Prénom,nuance\nMarine,LE PEN,RN\nEmmanuel,MACRON,REM\n")
    return tmp_path


def sources(landed):
    return [
        VoteSource(f"{landed}/17t1.txt", "u1", 2017, 1, slots=3),
        VoteSource(f"{landed}/17t2.txt", "u2", 2017, 2, slots=2, header=False, by_commune=True),
        VoteSource(f"{landed}/22t1.xlsx", "u3", 2022, 1, kind="workbook"),
        VoteSource(f"{landed}/22t2.xlsx", "u4", 2022, 2, kind="workbook"),
    ]


def safety_file(spark, path):
    header = list(L.SAFETY_FIELDS)
    data = [
        (str(69000 + c), str(y), ind, "Infraction", "1", f"{c % 7}.5", "diff", str(1000 + c), "2020", str(c), "2020",
         None, None, "2024-05-01 10:00:00", "2024-05-02")
        for c in range(1, COMMUNES) for y in (2020, 2021, 2022) for ind in ("Vols d'été", "Usage")
    ]
    export_csv(spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in header)), path)


def test_whole_flow(spark, landed, rows):
    out = f"{landed}/out"
    reference = read_delimited(spark, f"{landed}/ref.csv", sep=",")
    on = {"nom": "Prénom", "prenom": "Nom"}
    star = build_votes(spark, sources(landed), reference, on, "69", out, "2024-01-01T00:00:00")
    assert star.fact_resultats.count() == COMMUNES * (3 + 2 + 3 + 2)
    assert rows(star.dim_candidat, "nom", "nuance") == [("JOLY", None), ("LE PEN", "RN"), ("MACRON", "REM")]
    assert star.dim_commune.count() == COMMUNES
    report = spark.read.json(f"{out}/quality/votes")
    assert report.agg(F.sum("failed")).first()[0] == 0

    for name in ("2017_T1", "2017_T2", "2022_T1", "2022_T2"):
        bronze = read_table(spark, f"{out}/bronze/votes/{name}")
        assert {r[0] for r in bronze.select("Code du département").distinct().collect()} == {"69"}
        assert bronze.count() == COMMUNES * (1 if name == "2017_T2" else 2)
        assert bronze.where("source_file_name IS NULL").count() == 0
    names = {r[0] for r in read_table(spark, f"{out}/bronze/votes/2022_T1").select("source_file_name").distinct().collect()}
    assert names == {"22t1.xlsx"}

    safety_file(spark, f"{landed}/safety.csv")
    safety = build_safety(spark, f"{landed}/safety.csv", out)
    assert safety.fact_securite.count() == (COMMUNES - 1) * 6
    runs = build_model(star, safety, out)
    assert [len(r.features) for r in runs] == [3 * 10 + 8 + 8, 2 * 10 + 5 + 8]
    assert runs[0].dataset.count() == COMMUNES
    compared = {r.experiment: r.features_count for r in spark.read.json(f"{out}/model/comparison").collect()}
    assert compared == {"with_2022_t1": 46, "without_2022_t1": 33}


def test_too_many_votes_stop_the_run(spark, landed):
    header = slot_columns(L.STATION_FIELDS, L.CANDIDATE_FIELDS, 2)
    (landed / "bad.txt").write_bytes(as_text(lines(2, 5, too_many=True), header))
    source = VoteSource(f"{landed}/bad.txt", "u", 2017, 2, slots=2)
    reference = read_delimited(spark, f"{landed}/ref.csv", sep=",")
    with pytest.raises(QualityError, match="voix_le_exprimes"):
        build_votes(spark, [source], reference, {"nom": "Prénom", "prenom": "Nom"}, "69", f"{landed}/out2")
    assert spark.read.json(f"{landed}/out2/quality/votes").count() > 5


def test_reference_bronze(spark, landed, rows):
    path = landed / "communes.csv"
    path.write_text("dep_code , nom\n69,Affoux\n01,Ars\n")
    df = bronze_reference(spark, str(path), "u", "dep_code", "69", "t")
    assert rows(df) == [("69", "Affoux", "u", "t", "communes.csv")]


def test_bronze_keeps_every_station(spark, landed):
    df = bronze_votes(spark, sources(landed)[0], "69")
    assert df.count() == COMMUNES * 2 and "source_order" not in df.columns
