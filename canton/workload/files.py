"""Files written from the given tables and read back."""

from __future__ import annotations

import io
import json
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from canton.functions import to_double, to_long, timestamp_or_null
from canton.operators.metrics import METRICS, classification_metrics
from canton.operators.shaping import check_arity, repair_slot_header, stripped_names, unpivot_slots
from canton.plans import layouts as L
from canton.plans.votes import commune_totals, numeric_columns
from canton.session import scratch_path, stored_table
from canton.sources import (
    export_csv, export_json, read_delimited, read_table, read_wide_votes, read_workbooks, sniff_delimiter,
    with_audit, workbook_table, write_table,
)
from canton.sources.workbook_format import open_system, register_workbooks
from canton.workload.registry import query, sql_pct, table
from canton.workload.votes import SILVER_SQL, SLOTS, station_rows


@query(
    "csv_roundtrip",
    """
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag || ' "' || l_linestatus || ';" ' AS flags,
           l_shipdate, nullif(l_linestatus, 'F') AS open_status, 'https://example.org/lines' AS extraction_source_url
    FROM lineitem
    """,
)
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lines-csv")
    flags = F.concat("l_returnflag", F.lit(' "'), "l_linestatus", F.lit(';" '))
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", flags.alias("flags"),
        "l_shipdate", F.nullif("l_linestatus", F.lit("F")).alias("open_status"),
    )
    export_csv(lines, path)
    text = with_audit(read_delimited(spark, path), "https://example.org/lines", "2024-01-01")
    return text.select(
        to_long(F.col("l_orderkey")).alias("l_orderkey"),
        F.col("l_linenumber").cast("int").alias("l_linenumber"),
        to_double(F.col("l_quantity")).alias("l_quantity"),
        to_double(F.col("l_extendedprice")).alias("l_extendedprice"),
        "flags",
        timestamp_or_null(F.col("l_shipdate")).cast("timestamp_ntz").alias("l_shipdate"),
        "open_status",
        "extraction_source_url",
    )


@query(
    "wide_file_roundtrip",
    f"""
    WITH {SILVER_SQL}
    SELECT DISTINCT '€ ' || libelle_commune || ' œuvre' AS libelle_commune, inscrits, votants, exprimes, pct_vot_ins, pct_blancs_vot
    FROM (SELECT libelle_commune, CAST(sum(inscrits) AS BIGINT) AS inscrits, CAST(sum(votants) AS BIGINT) AS votants,
                 CAST(sum(exprimes) AS BIGINT) AS exprimes,
                 {sql_pct('sum(votants)', 'sum(inscrits)')} AS pct_vot_ins,
                 {sql_pct('sum(blancs)', 'sum(votants)', True)} AS pct_blancs_vot
          FROM totals GROUP BY code_commune, libelle_commune)
    """,
)
def wide_file_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations in the source layout as cp1252 text, header names missing."""
    fields = list(L.SLOT_FIELDS)
    common = ["Code du département", "Libellé du département", "Code de la commune",
              "Libellé de la commune", "Code du b.vote", *L.COUNT_FIELDS]
    label = F.concat(F.lit("€ "), F.col("`Libellé de la commune`"), F.lit(" œuvre"))
    bronze = station_rows(spark, sf_dir).withColumn("Libellé de la commune", label)
    slots = [f"{f}_{k}" for k in range(1, SLOTS + 1) for f in fields]
    # The text writer knows ISO-8859-1 only; these two letters have their
    # cp1252 bytes at the code points below.
    encoded = bronze.select(
        *[F.translate(F.col(f"`{c}`"), "€œ", "\x80\x9c").alias(f"c{i}") for i, c in enumerate([*common, *slots])]
    )
    path = scratch_path(spark, "wide-votes")
    # Most of the wide text repeats; a compressed part is one task's, read by one task.
    encoded.write.options(sep=";", header=True, encoding="ISO-8859-1", compression="gzip").csv(path)
    wide = read_wide_votes(spark, path, common, fields, SLOTS)
    area = {k: v for k, v in L.AREA_FIELDS.items() if "commune" in v}
    return commune_totals(wide, area).select(
        "libelle_commune", "inscrits", "votants", "exprimes", "pct_vot_ins", "pct_blancs_vot"
    )


@query(
    "sniffed_read",
    "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer",
)
def sniffed_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "customers")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias(" c_custkey "), F.col("c_name").alias("c_name "), "c_acctbal",
        F.concat("c_mktsegment", F.lit("; x")).alias("c_mktsegment"),
    )
    export_csv(customers, path, sep=",")
    text = stripped_names(read_delimited(spark, path, sep=sniff_delimiter(spark, path)))
    return text.select(
        to_long(F.col("c_custkey")).alias("c_custkey"),
        "c_name",
        to_double(F.col("c_acctbal")).alias("c_acctbal"),
        F.substring_index("c_mktsegment", ";", 1).alias("c_mktsegment"),
    )


@query(
    "union_years",
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS n_orders,
           CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents, min(o_orderkey) AS first_key
    FROM orders GROUP BY ALL
    """,
)
def union_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text folder per year, read back by one glob with one schema."""
    path = scratch_path(spark, "orders-by-year")
    orders = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("y"), "o_orderkey", F.year("o_orderdate").alias("order_year"),
        F.rint(F.col("o_totalprice") * 100).cast("long").alias("cents"),
    )
    orders.write.partitionBy("y").options(sep=";", header=True).csv(path)
    text = read_delimited(spark, f"{path}/y=*", ["o_orderkey", "order_year", "cents"])
    return text.groupBy(F.col("order_year").cast("int").alias("order_year")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(to_long(F.col("cents"))).alias("cents"),
        F.min(to_long(F.col("o_orderkey"))).alias("first_key"),
    )


@query(
    "partitioned_table",
    "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F'",
)
def partitioned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table partitioned by area; the equality filter prunes folders."""
    path = scratch_path(spark, "orders")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    write_table(orders, path, partition_by=["o_orderstatus"], sort_by=["o_orderkey"])
    return read_table(spark, path).where(F.col("o_orderstatus") == "F")


@query(
    "json_export",
    """
    SELECT part, tp, tn, fp, fn, CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS accuracy FROM (
      SELECT lang AS part, count(*) FILTER (WHERE quality = 1 AND toxic = 0) AS tp, count(*) FILTER (WHERE quality = 0 AND toxic = 1) AS tn,
             count(*) FILTER (WHERE quality = 0 AND toxic = 0) AS fp, count(*) FILTER (WHERE quality = 1 AND toxic = 1) AS fn
      FROM labels JOIN documents USING (doc_id) GROUP BY lang)
    """,
)
def json_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested metrics written as JSON lines and read with their schema."""
    rows = table(spark, sf_dir, "labels").join(
        table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("part")), "doc_id"
    )
    rows = rows.withColumn("predicted", 1 - F.col("toxic"))
    scores = classification_metrics(rows, "quality", "predicted", by=("part",))
    nested = scores.select("part", F.struct(*METRICS).alias("model_metrics"))
    path = scratch_path(spark, "metrics")
    export_json(nested, path)
    read = spark.read.schema(nested.schema).json(path)
    return read.select("part", *[f"model_metrics.{m}" for m in ("tp", "tn", "fp", "fn", "accuracy")])


# ---- workbooks -------------------------------------------------------------

_SHEET_ROWS = 2_000
_RELS = (
    '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
    '<Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>'
)
_BOOK = (
    '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
    'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
    '<sheets><sheet name="data" sheetId="1" r:id="r1"/></sheets></workbook>'
)


def _letters(index: int) -> str:
    out = ""
    index += 1
    while index:
        index, rest = divmod(index - 1, 26)
        out = chr(65 + rest) + out
    return out


def pack_workbook(rows: list[list[str | None]]) -> bytes:
    """A minimal workbook with one sheet of inline texts."""
    sheet = ['<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>']
    letters = [_letters(i) for i in range(max(map(len, rows), default=0))]
    for number, row in enumerate(rows, 1):
        cells = "".join(
            f'<c r="{letters[i]}{number}" t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>'
            for i, v in enumerate(row)
            if v is not None
        )
        sheet.append(f'<row r="{number}">{cells}</row>')
    sheet.append("</sheetData></worksheet>")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr("xl/workbook.xml", _BOOK)
        book.writestr("xl/_rels/workbook.xml.rels", _RELS)
        book.writestr("xl/worksheets/sheet1.xml", "".join(sheet))
    return out.getvalue()


def pack_sheets(df: DataFrame, header: list[str | None], book: str) -> DataFrame:
    """(path, content) workbooks with the rows of each value of ``book``."""
    columns = [c for c in df.columns if c != book]

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        cells = pdf[columns].astype(object)
        rows = cells.where(cells.notna(), None).values.tolist()
        return pd.DataFrame({"path": [str(pdf[book].iloc[0])], "content": [pack_workbook([header, *rows])]})

    return df.groupBy(book).applyInPandas(pack, "path string, content binary")


_SLOT_HEADER = ["N°Panneau", "Sexe", "Nom", "Prénom", "Voix"]


@query(
    "workbook_rows",
    """
    SELECT order_no, slot, candidate, votes FROM (
      SELECT l_orderkey AS order_no, CAST(l_linenumber AS BIGINT) AS slot, 'C' || l_linenumber AS candidate, sum(l_quantity) AS votes
      FROM lineitem GROUP BY ALL
      UNION ALL
      SELECT o.k, s.slot, 'C' || s.slot, NULL FROM (SELECT DISTINCT l_orderkey AS k FROM lineitem) o, (VALUES (1), (2), (3), (4), (5), (6), (7)) s(slot)
      WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.k AND l.l_linenumber = s.slot))
    """,
)
def workbook_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbooks with seven slots of which all but the first have blank headers.

    Orders are spread over workbooks of bounded size, so more data means more
    workbooks; the header is repaired and the slots are unpivoted.
    """
    def voix(k: int):
        return F.sum(F.when(F.col("l_linenumber") == k, F.col("l_quantity"))).cast("string")

    fields = {}
    for k in range(1, SLOTS + 1):
        fields |= {
            f"panel_{k}": F.lit(str(k)), f"sex_{k}": F.lit("F"), f"name_{k}": F.lit(f"C{k}"),
            f"first_{k}": F.lit("P & Q"), f"votes_{k}": voix(k),
        }
    wide = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        *[c.alias(n) for n, c in fields.items()]
    )
    wide = wide.select(
        F.floor(F.col("l_orderkey") / _SHEET_ROWS).alias("book"),
        F.col("l_orderkey").cast("string").alias("code"),
        *fields,
    )
    header = ["Code", *_SLOT_HEADER, *[None] * (len(_SLOT_HEADER) * (SLOTS - 1))]
    books = pack_sheets(wide, header, "book")
    rows = workbook_table(books, [h or f"Unnamed: {i}" for i, h in enumerate(header)])
    named = check_arity(rows, repair_slot_header(rows.columns, _SLOT_HEADER))
    named = numeric_columns(named, ["Code", "Voix"])
    long = unpivot_slots(named, ["Code"], {"N°Panneau": "slot", "Nom": "candidate", "Voix": "votes"})
    return long.select(
        F.col("Code").cast("long").alias("order_no"), to_long(F.col("slot")).alias("slot"),
        "candidate", "votes",
    )


_BUYERS_SQL = """
    SELECT CAST(o_custkey % 4 AS VARCHAR) AS book, CAST(o_custkey AS BIGINT) AS buyer, count(*) AS n_orders,
           CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS spent
    FROM orders GROUP BY ALL
"""


def _buyers_of(rows: DataFrame) -> DataFrame:
    long = rows.select(
        F.element_at(F.split("path", "/"), -2).alias("book"),
        to_long(F.col("Acheteur")).alias("buyer"),
        to_long(F.col("Prix")).alias("price"),
    )
    return long.groupBy("book", "buyer").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("price").alias("spent"))


def _order_books(spark: SparkSession, sf_dir: str) -> str:
    """A glob of workbook files with all orders, some thousand rows each."""
    rows = table(spark, sf_dir, "orders").select(
        F.concat_ws("/", F.col("o_custkey") % 4, F.floor(F.col("o_orderkey") / (4 * _SHEET_ROWS))).alias("book"),
        F.col("o_orderkey").cast("string").alias("order"),
        F.col("o_custkey").cast("string").alias("buyer"),
        F.floor("o_totalprice").cast("string").alias("price"),
    )
    folder = scratch_path(spark, "workbooks")
    books = pack_sheets(rows, ["N° ordre", "Acheteur", "Prix"], "book")
    stored_table(books.mapInPandas(_file_writer(folder), "path string"), "workbook-paths")
    return f"{folder}/*/*.xlsx"


@query("workbook_glob", _BUYERS_SQL)
def workbook_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbook files read by format and glob with the header of the first; only the chosen columns are decoded."""
    register_workbooks(spark)
    chosen = json.dumps(["Acheteur", "Prix", "path"])
    return _buyers_of(spark.read.format("workbook").option("select", chosen).load(_order_books(spark, sf_dir)))


@query("workbook_discovery", _BUYERS_SQL)
def workbook_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files through Spark's own file reader, with a shared header row."""
    return _buyers_of(read_workbooks(spark, _order_books(spark, sf_dir), keep_path=True))


def _file_writer(folder: str):
    """Write packed workbooks under ``folder`` as book/part.xlsx, from the tasks."""

    def write(batches):
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                fs, base = open_system(folder)
                target = f"{base}/{path}.xlsx"
                fs.create_dir(target.rpartition("/")[0], recursive=True)
                with fs.open_output_stream(target) as out:
                    out.write(content)
            yield pd.DataFrame({"path": batch["path"]})

    return write
