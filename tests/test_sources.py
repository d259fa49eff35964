import zipfile
from pathlib import Path
from io import BytesIO

import pytest
from pyspark.sql.types import StructType
from pyspark.sql import functions as F

from canton.operators.shaping import (
    check_arity, clean_name, find_column, matching_columns, rename_positional, repair_slot_header,
    slot_columns, stripped_names,
)
from canton.plans import layouts as L
from canton.sources import (
    export_csv, export_json, file_order, literal_table, read_delimited, read_table,
    read_wide_votes, read_workbooks, sniff_delimiter, with_audit, write_table,
)
from canton.workload.files import pack_workbook


def test_delimited_keeps_text_and_drops_bom(spark, tmp_path, rows):
    file = tmp_path / "a.csv"
    file.write_bytes("﻿code;nom\n069;\"Saint;Loup\"\n 7 ;\n".encode("utf-8"))
    df = read_delimited(spark, str(file))
    assert df.columns == ["code", "nom"]
    assert rows(df) == [(" 7 ", None), ("069", "Saint;Loup")]


def test_cp1252_is_exact(spark, tmp_path, rows):
    every = "".join(bytes([b]).decode("cp1252", "ignore") for b in range(0x20, 0x100) if b != 0x22)
    file = tmp_path / "a.txt"
    file.write_bytes(f"x;é€œ\n1;{every.replace(';', '')}\n".encode("cp1252"))
    df = read_delimited(spark, str(file), encoding="cp1252")
    assert df.columns == ["x", "é€œ"]
    assert df.first()[1] == every.replace(";", "")


def test_missing_spellings(spark, tmp_path, rows):
    file = tmp_path / "a.csv"
    file.write_text("a;b\nNA;1\nx;nan\n")
    assert rows(read_delimited(spark, str(file), missing=("NA", "nan"))) == [("x", None), (None, "1")]


def test_wide_votes_with_short_lines_and_header_as_data(spark, tmp_path, rows):
    file = tmp_path / "a.txt"
    file.write_bytes("dep;n°\n69;10;A;1;B;2\n01;20;A;3\n".encode("cp1252"))
    names = ["dep", "n"], ["nom", "voix"], 2
    df = read_wide_votes(spark, str(file), *names)
    assert df.columns == ["dep", "n", "nom_1", "voix_1", "nom_2", "voix_2"]
    assert rows(df) == [("01", "20", "A", "3", None, None), ("69", "10", "A", "1", "B", "2")]
    assert read_wide_votes(spark, str(file), *names, header=False).count() == 3


@pytest.mark.parametrize("sep", [";", ",", "\t", "|"])
def test_sniff(spark, tmp_path, sep):
    file = tmp_path / "a.csv"
    file.write_text("\n".join(sep.join(r) for r in (["a", "b", "c"], ["1", "x", "2"], ["3", "y", "4"])))
    assert sniff_delimiter(spark, str(file)) == sep


def test_sniff_prefers_the_even_separator(spark, tmp_path):
    file = tmp_path / "a.csv"
    file.write_text("code,label\nEXG,Extrême; gauche; dure\nCOM,Communiste\n")
    assert sniff_delimiter(spark, str(file)) == ","
    file = tmp_path / "b.csv"
    file.write_text("nothing\nhere\n")
    with pytest.raises(ValueError):
        sniff_delimiter(spark, str(file))


def test_sniff_reads_every_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x;y\n1;2\n")
    (tmp_path / "b.csv").write_text("x,y\n1,2\n")
    with pytest.raises(ValueError, match="different separators"):
        sniff_delimiter(spark, f"{tmp_path}/*.csv")


def test_typed_read(spark, tmp_path):
    file = tmp_path / "a.csv"
    file.write_text("k;n\n01;5\n02;\n")
    schema = "k string, n int"
    typed = read_delimited(spark, str(file), StructType.fromDDL(schema))
    assert [tuple(r) for r in typed.collect()] == [("01", 5), ("02", None)]
    file.write_text("k;n\n01;five\n")
    with pytest.raises(Exception, match="MALFORMED|CAST|five"):
        read_delimited(spark, str(file), StructType.fromDDL(schema)).collect()


def test_glob_audit_and_order(spark, tmp_path, rows):
    (tmp_path / "2017-t1.csv").write_text("k\na\nb\n")
    (tmp_path / "2017-t2.csv").write_text("k\nc\n")
    df = read_delimited(spark, f"{tmp_path}/*-t*.csv", ["k"])
    audited = with_audit(df, "https://example.org/x", "2024-01-01")
    assert rows(audited) == [
        ("a", "https://example.org/x", "2024-01-01", "2017-t1.csv"),
        ("b", "https://example.org/x", "2024-01-01", "2017-t1.csv"),
        ("c", "https://example.org/x", "2024-01-01", "2017-t2.csv"),
    ]
    ordered = df.select("k", file_order().alias("o")).orderBy("o")
    assert [r.k for r in ordered.collect()] == ["a", "b", "c"]
    stamped = with_audit(df, "u").select("ingestion_timestamp").first()[0]
    assert len(stamped) == 26 and stamped[10] == "T"


def test_dictionary_pair(spark, tmp_path, rows):
    """Comma file in, the same rows plus three audit columns out."""
    file = tmp_path / "dictionnaire.csv"
    file.write_text(" Nuance ,Libellé\nEXG,Extrême gauche\nCOM,Communiste\n")
    df = stripped_names(read_delimited(spark, str(file), sep=sniff_delimiter(spark, str(file))))
    export_csv(with_audit(df, "u", "t", F.lit("dictionnaire.csv")), f"{tmp_path}/bronze")
    back = read_delimited(spark, f"{tmp_path}/bronze")
    assert back.columns == ["Nuance", "Libellé", "extraction_source_url", "ingestion_timestamp", "source_file_name"]
    assert rows(back.select("Nuance", "source_file_name")) == [("COM", "dictionnaire.csv"), ("EXG", "dictionnaire.csv")]


def test_table_and_exports(spark, tmp_path, rows):
    df = literal_table(spark, ["y", "k", "v"], [(2017, " a;", 1.5), (2022, 'q"', None)])
    write_table(df, f"{tmp_path}/t", partition_by=["y"], sort_by=["k"])
    assert rows(read_table(spark, f"{tmp_path}/t").where("y = 2017"), "k") == [(" a;",)]
    export_csv(df, f"{tmp_path}/c", sep=",", columns=["k", "v"])
    assert rows(read_delimited(spark, f"{tmp_path}/c", sep=",")) == [(" a;", "1.5"), ('q"', None)]
    export_json(df, f"{tmp_path}/j")
    text = "".join(r.value for r in spark.read.text(f"{tmp_path}/j").collect())
    assert '"v":null' in text


SHARED = """<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">
<si><t>Code</t></si><si><r><t>Vo</t></r><r><t>ix</t></r><rPh><t>no</t></rPh></si><si><t>a &amp; b</t></si></sst>"""
SHEET = """<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>
<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="D1" t="s"><v>1</v></c></row>
<row r="2"><c r="A2"><v>69</v></c><c r="D2" t="s"><v>2</v></c></row>
<row r="3"/>
<row r="5"><c r="B5" t="str"><f>1+1</f><v>2</v></c></row></sheetData></worksheet>"""


def test_workbook_with_shared_strings_and_gaps(spark, tmp_path, rows):
    plain = zipfile.ZipFile(BytesIO(pack_workbook([["x"]])))
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as book:
        for name in ("xl/workbook.xml", "xl/_rels/workbook.xml.rels"):
            book.writestr(name, plain.read(name))
        book.writestr("xl/sharedStrings.xml", SHARED)
        book.writestr("xl/worksheets/sheet1.xml", SHEET)
    df = read_workbooks(spark, str(tmp_path / "a.xlsx"))
    assert df.columns == ["Code", "Voix", "Unnamed: 2", "Voix.1"]
    assert rows(df) == [("69", None, None, "a & b"), (None, "2", None, None)]


def test_workbooks_must_share_their_header(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(pack_workbook([["x"], ["1"]]))
    (tmp_path / "b.xlsx").write_bytes(pack_workbook([["y"], ["2"]]))
    with pytest.raises(ValueError):
        read_workbooks(spark, f"{tmp_path}/*.xlsx")
    assert read_workbooks(spark, f"{tmp_path}/*.xlsx", ["v"]).count() == 2


def test_slot_headers():
    fields = ["N°Panneau", "Nom", "Voix"]
    assert slot_columns(["a"], fields, 2) == [
        "a", "N°Panneau_1", "Nom_1", "Voix_1", "N°Panneau_2", "Nom_2", "Voix_2"
    ]
    blank = ["a", "N°Panneau", "Nom", "Voix", "Unnamed: 4", "Unnamed: 5", "Unnamed: 6", "rest"]
    assert repair_slot_header(blank, fields) == [*slot_columns(["a"], fields, 2), "rest"]
    repeated = ["a", "N°Panneau", "Nom", "Voix", "N°Panneau.1", "Nom.1", "Voix.1"]
    assert repair_slot_header(repeated, fields) == slot_columns(["a"], fields, 2)
    assert repair_slot_header(["a", "b"], fields) == ["a", "b"]
    assert len(L.SILVER_VOTES) == 30 and len(L.VOTE_MEASURES) == 17 and len(L.SILVER_SAFETY) == 18
    assert len(slot_columns(L.STATION_FIELDS, L.CANDIDATE_FIELDS, 11)) == 21 + 77


def test_name_helpers(spark):
    df = literal_table(spark, [" Code Dept ", "% Voix", "Voix_1", "x"], [("1", "2", "3", "4")])
    assert stripped_names(df).columns[0] == "Code Dept"
    assert find_column(df, ["département", "dept"]) == " Code Dept "
    with pytest.raises(ValueError):
        find_column(df, ["commune"])
    assert matching_columns(df, ["%", "Voix"]) == ["% Voix", "Voix_1"]
    assert rename_positional(df, {"x": "y", "nope": "z"}).columns[-1] == "y"
    assert clean_name(" Vols d'arme-x ") == "vols_d_arme_x"
    with pytest.raises(ValueError):
        check_arity(df, ["a"])


def test_station_text_is_written_compressed(spark):
    import __spark_entry__ as contract
    from canton.session import shared_dir

    base = Path(shared_dir(spark).removeprefix("file:"))
    before = set(base.glob("wide-votes-*"))
    contract.queries()["wide_file_roundtrip"](spark, "/root/testdata/sf0.001")
    (written,) = set(base.glob("wide-votes-*")) - before
    parts = [f.name for f in written.iterdir() if f.name.startswith("part-")]
    assert parts and all(name.endswith(".csv.gz") for name in parts)
