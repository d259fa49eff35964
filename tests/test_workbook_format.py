"""Workbooks as a data source."""

import io
import json
import zipfile

import pytest

from canton.sources.workbook_format import list_files, register_workbooks
from canton.workload.files import pack_workbook

_NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"


@pytest.fixture
def books(spark, tmp_path):
    register_workbooks(spark)
    (tmp_path / "a").mkdir()
    (tmp_path / "a/1.xlsx").write_bytes(pack_workbook([["Code", "Nom", None], ["1", "x", "5"], [None, None, None], ["2", None, "6"]]))
    (tmp_path / "a/2.xlsx").write_bytes(pack_workbook([["Nom", "Code", None], ["y", "3", None]]))
    (tmp_path / "a/notes.txt").write_text("no workbook")
    return tmp_path


def two_sheets(path):
    one = zipfile.ZipFile(path.parent / "a/1.xlsx")
    with zipfile.ZipFile(path, "w") as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{_NS}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
            '<sheets><sheet name="T1" sheetId="1" r:id="r1"/><sheet name="T2" sheetId="2" r:id="r2"/></sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="r1" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Target="/xl/worksheets/sheet2.xml"/></Relationships>',
        )
        sheet = one.read("xl/worksheets/sheet1.xml").decode()
        book.writestr("xl/worksheets/sheet1.xml", sheet)
        book.writestr("xl/worksheets/sheet2.xml", sheet.replace(">x<", ">z<"))


def test_glob_header_and_places(spark, books, rows):
    df = spark.read.format("workbook").load(f"{books}/*/*.xlsx")
    assert df.columns == ["Code", "Nom", "Unnamed: 2", "path", "sheet", "sheet_row"]
    assert df.rdd.getNumPartitions() == 2
    got = rows(df.select("Code", "Nom", "`Unnamed: 2`", "sheet", "sheet_row"))
    assert got == [("1", "x", "5", "data", 2), ("2", None, "6", "data", 4), ("3", "y", None, "data", 2)]


def test_chosen_columns_and_given_schema(spark, books, rows):
    df = spark.read.format("workbook").option("select", json.dumps(["Nom", "sheet_row"])).load(f"file://{books}/a/*.xlsx")
    assert df.columns == ["Nom", "sheet_row"] and rows(df) == [("x", 2), ("y", 2), (None, 4)]
    given = spark.read.format("workbook").schema("Code string").load(f"{books}/a/1.xlsx")
    assert rows(given) == [("1",), ("2",)]
    named = spark.read.format("workbook").option("columns", '["a", "b", "c"]').load(f"{books}/a/1.xlsx")
    assert rows(named.select("a", "c")) == [("1", "5"), ("2", "6")]
    plain = spark.read.format("workbook").option("header", "false").load(f"{books}/a/1.xlsx")
    assert rows(plain.select("_c0", "_c1")) == [("1", "x"), ("2", None), ("Code", "Nom")]


def test_sheets_are_partitions(spark, books, rows):
    two_sheets(books / "two.xlsx")
    df = spark.read.format("workbook").option("sheet", "*").load(f"{books}/two.xlsx")
    assert df.rdd.getNumPartitions() == 2
    assert rows(df.select("sheet", "Nom").where("sheet_row = 2")) == [("T1", "x"), ("T2", "z")]
    one = spark.read.format("workbook").option("sheet", "T2").load(f"{books}/two.xlsx")
    assert rows(one.select("Nom").where("sheet_row = 2")) == [("z",)]


def test_faults_are_told(spark, books):
    (books / "a/3.xlsx").write_bytes(pack_workbook([["Other"], ["1"]]))
    with pytest.raises(Exception, match="header lacks"):
        spark.read.format("workbook").load(f"{books}/a/*.xlsx").collect()
    (books / "wide.xlsx").write_bytes(pack_workbook([["a"], ["1", "2"]]))
    with pytest.raises(Exception, match="wider than"):
        spark.read.format("workbook").option("columns", '["a"]').load(f"{books}/wide.xlsx").collect()
    with pytest.raises(Exception, match="no workbook"):
        spark.read.format("workbook").load(f"{books}/none/*.xlsx")
    with pytest.raises(Exception, match="no column"):
        spark.read.format("workbook").option("select", '["q"]').load(f"{books}/wide.xlsx")


def test_list_files(books):
    assert [p.rpartition("/")[2] for _, p in list_files(f"{books}/a/?.xlsx")] == ["1.xlsx", "2.xlsx"]
    assert len(list_files(f"{books}/a")) == 3


def test_sheets_are_read_without_a_tree(monkeypatch):
    """Prefixed tags, split and phonetic text, empty values, cells without a place, entities."""
    from canton.sources import workbooks

    def no_tree(*_):
        raise AssertionError("a node for every cell")

    book = io.BytesIO(pack_workbook([["x"]]))
    out = io.BytesIO()
    sheet = (
        '<x:worksheet xmlns:x="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><x:sheetData><x:row r="3">'
        '<x:c r="B3" t="inlineStr"><x:is><x:r><x:rPr><x:b/></x:rPr><x:t>A &amp;</x:t></x:r> <x:r><x:t> B</x:t></x:r>'
        '<x:rPh sb="0" eb="1"><x:t>no</x:t></x:rPh></x:is></x:c> <x:c><x:f>1+1</x:f><x:v>2</x:v></x:c><x:c r="AA3"><x:v/></x:c></x:row>'
        '<x:row><x:c t="inlineStr"><x:is/></x:c><x:c t="str"><x:v><![CDATA[</row>]]></x:v></x:c></x:row></x:sheetData>'
        "<x:extLst><x:c><x:v>9</x:v></x:c><x:t>9</x:t></x:extLst></x:worksheet>"
    )
    with zipfile.ZipFile(book) as old, zipfile.ZipFile(out, "w") as new:
        for name in old.namelist():
            new.writestr(name, sheet if "sheet1" in name else old.read(name))
    monkeypatch.setattr(workbooks.ElementTree, "iterparse", no_tree)
    got = list(workbooks.sheet_rows(out.getvalue()))
    assert got == [(3, [None, "A & B", "2", *[None] * 24]), (4, ["", "</row>"])]
