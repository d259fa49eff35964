"""Idempotent reloads and checks in the writing pass."""

import os

from pyspark.sql import functions as F

from canton.operators.quality import checked_write, merged_reports, not_negative, row_checks, within_percent
from canton.sources.ledger import Ledger
from canton.sources.sinks import read_table, write_table


def put(folder, name, lines):
    (folder / name).write_text("\n".join(["a,b", *lines]) + "\n")
    # File times of one test may fall into one clock tick.
    put.clock = getattr(put, "clock", 1_700_000_000) + 10
    os.utime(folder / name, (put.clock, put.clock))


def test_reload_leaves_each_file_once(spark, tmp_path, rows):
    landed = tmp_path / "in"
    landed.mkdir()
    ledger = Ledger(str(tmp_path / "out"))
    asked = []

    def read(paths):
        asked.append(sorted(p.rpartition("/")[2] for p in paths))
        return spark.read.schema("a string, b int").option("header", True).csv(paths)

    put(landed, "x.csv", ["1,10", "1,10", "2,20"])
    put(landed, "007", ["7,70"])  # a unit that looks like a number
    assert ledger.load(spark, f"{landed}/*", read) == 2
    first = [("1", 10, "x.csv"), ("1", 10, "x.csv"), ("2", 20, "x.csv"), ("7", 70, "007")]
    assert rows(ledger.table(spark)) == sorted(first, key=repr)
    assert ledger.load(spark, f"{landed}/*", read) == 0 and rows(ledger.table(spark)) == sorted(first, key=repr)
    put(landed, "x.csv", ["2,21"])
    put(landed, "y.csv", [])
    assert ledger.load(spark, f"{landed}/*", read) == 2
    assert rows(ledger.table(spark)) == [("2", 21, "x.csv"), ("7", 70, "007")]
    put(landed, "x.csv", [])  # a corrected file without rows takes its rows away
    assert ledger.load(spark, f"{landed}/*", read) == 1
    assert rows(ledger.table(spark)) == [("7", 70, "007")]
    assert asked == [["007", "x.csv"], ["x.csv", "y.csv"], ["x.csv"]]
    entries = {r.unit: (r.n_files, r.n_rows, r.load_no) for r in ledger.loaded(spark).collect()}
    assert entries == {"007": (1, 1, 1), "y.csv": (1, 0, 2), "x.csv": (1, 0, 3)}


def test_a_run_that_stopped_before_the_ledger_repeats_itself(spark, tmp_path, rows, monkeypatch):
    landed = tmp_path / "in"
    landed.mkdir()
    put(landed, "x.csv", ["1,10"])
    ledger = Ledger(str(tmp_path / "out"))
    read = lambda paths: spark.read.schema("a string, b int").option("header", True).csv(paths)
    with monkeypatch.context() as m:
        m.setattr(Ledger, "_entries", lambda self, spark: (_ for _ in ()).throw(RuntimeError("stopped")) if (tmp_path / "out/rows").exists() else spark.createDataFrame([], "unit string, fingerprint string, n_files long, n_bytes long, n_rows long, load_no long"))
        try:
            ledger.load(spark, f"{landed}/*", read)
        except RuntimeError:
            pass
    assert (tmp_path / "out/rows").exists() and not (tmp_path / "out/ledger").exists()
    assert ledger.load(spark, f"{landed}/*", read) == 1
    assert rows(ledger.table(spark)) == [("1", 10, "x.csv")]


def test_checks_are_counted_while_writing(spark, tmp_path, rows):
    df = spark.range(1000).selectExpr("id", "CAST(id % 130 AS DOUBLE) AS p", "id - 5 AS n", "id % 3 AS k")
    rules = [within_percent("p"), not_negative("n")]
    want = rows(row_checks(df, rules))
    report = checked_write(df, str(tmp_path / "t"), rules, partition_by=["k"], sort_by=["id"])
    assert rows(report) == want and rows(read_table(spark, str(tmp_path / "t")), "id") == rows(df, "id")
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "Range" not in plan  # the rows are not read again
    halves = [checked_write(df.where(c), str(tmp_path / f"h{i}"), rules) for i, c in enumerate(("id < 300", "id >= 300"))]
    assert rows(merged_reports(*halves)) == want
    empty = checked_write(df.where("false"), str(tmp_path / "e"), rules)
    assert [r[2:] for r in rows(empty)] == [(0, 0), (0, 0)]
    assert [f.dataType for f in report.schema] == [f.dataType for f in row_checks(df, rules).schema]


def test_metrics_and_present_partitions(spark, tmp_path, rows):
    df = spark.range(10).selectExpr("id", "id % 2 AS k")
    path = str(tmp_path / "t")
    assert write_table(df, path, ["k"], metrics={"top": F.max("id")}) == {"top": 9}
    assert write_table(df.where("k = 1").withColumn("id", F.col("id") + 100), path, ["k"], only_present=True) == {}
    assert [r[0] for r in rows(read_table(spark, path), "id")] == sorted([0, 2, 4, 6, 8, 101, 103, 105, 107, 109], key=lambda x: repr((x,)))
