"""Spreadsheet sources.

Spark lists the workbooks and spreads them over tasks, one task per workbook;
a sheet is bounded by its format (2^20 rows). The decoder only streams the
cells of the first sheet out of the zip container.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence
from functools import lru_cache
from xml.etree import ElementTree
from xml.parsers import expat

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from canton.session import stored_table

CELL_SCHEMA = "path string, sheet_row bigint, cells array<string>"
_BATCH_ROWS = 10_000


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _text(node) -> str:
    """Text of a rich or plain string item, without phonetic hints."""
    parts = []
    for child in node:
        name = _local(child.tag)
        if name == "t":
            parts.append(child.text or "")
        elif name == "r":
            parts.append(_text(child))
    return "".join(parts)


@lru_cache(maxsize=None)
def _letters_index(letters: str) -> int:
    index = 0
    for letter in letters:
        index = index * 26 + ord(letter) - 64
    return index - 1


def sheet_parts(book: zipfile.ZipFile) -> dict[str, str]:
    """The zip entry of each sheet, in the order of the workbook."""
    links = {
        r.attrib["Id"]: r.attrib["Target"]
        for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    }
    parts = {}
    for node in ElementTree.fromstring(book.read("xl/workbook.xml")).iter():
        if _local(node.tag) == "sheet":
            link = next(v for k, v in node.attrib.items() if _local(k) == "id")
            target = links[link]
            parts[node.attrib.get("name", "")] = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    if not parts:
        raise ValueError("workbook without sheets")
    return parts


def sheet_rows(content: bytes | io.IOBase, sheet: str | None = None) -> Iterator[tuple[int, list[str | None]]]:
    """(row number, cells) of one sheet, the first by default."""
    with zipfile.ZipFile(io.BytesIO(content) if isinstance(content, bytes) else content) as book:
        parts = sheet_parts(book)
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            with book.open("xl/sharedStrings.xml") as part:
                for _, node in ElementTree.iterparse(part):
                    if _local(node.tag) == "si":
                        shared.append(_text(node))
                        node.clear()
        with book.open(parts[sheet] if sheet is not None else next(iter(parts.values()))) as part:
            yield from _rows(part, shared)


def _rows(part: io.IOBase, shared: Sequence[str]) -> Iterator[tuple[int, list[str | None]]]:
    """The rows of a sheet, straight from the parser's events: no node is built for a cell."""
    parser, done, names = expat.ParserCreate(), [], {}
    parser.buffer_text = True
    number, at, kind, phonetic = 0, 0, None, False
    cells: list[str | None] | None = None
    text: list[str] | None = None

    def start(tag: str, attributes: dict[str, str]) -> None:
        nonlocal number, at, kind, phonetic, cells, text
        name = names.get(tag) or names.setdefault(tag, tag.rpartition(":")[2])
        if name == "row":
            number, cells = int(attributes.get("r", number + 1)), []
        elif cells is None:
            return
        elif name == "c":
            place, kind = attributes.get("r"), attributes.get("t")
            at = len(cells) if place is None else _letters_index(place.rstrip("0123456789"))
            cells.extend([None] * (at + 1 - len(cells)))
        elif name == "is":
            text = []
        elif name == "v":
            text = []
            parser.CharacterDataHandler = text.append
        elif name == "t":
            if text is not None and not phonetic:
                parser.CharacterDataHandler = text.append
        elif name == "rPh":
            phonetic = True

    def end(tag: str) -> None:
        nonlocal phonetic, cells, text
        name = names[tag]
        if name == "t":
            parser.CharacterDataHandler = None
        elif name == "rPh":
            phonetic = False
        elif cells is None:
            return
        elif name == "is":
            cells[at], text = "".join(text), None
        elif name == "v":
            parser.CharacterDataHandler = None
            if text:
                value = "".join(text)
                cells[at] = shared[int(value)] if kind == "s" else value
            text = None
        elif name == "row":
            done.append((number, cells))
            cells = None

    parser.StartElementHandler, parser.EndElementHandler = start, end
    while chunk := part.read(1 << 16):
        parser.Parse(chunk)
        yield from done
        done.clear()
    parser.Parse(b"", True)
    yield from done


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            rows: list[tuple] = []
            for number, cells in sheet_rows(content):
                rows.append((path, number, cells))
                if len(rows) == _BATCH_ROWS:
                    yield pd.DataFrame(rows, columns=["path", "sheet_row", "cells"])
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=["path", "sheet_row", "cells"])


def workbook_cells(files: DataFrame) -> DataFrame:
    """(path, content) rows to (path, sheet_row, cells) rows."""
    return files.select("path", "content").mapInPandas(_decode, CELL_SCHEMA)


def header_names(cells: Sequence[str | None]) -> list[str]:
    """Blank headers become ``Unnamed: i``, repeated ones get ``.1``, ``.2``."""
    seen: dict[str, int] = {}
    names = []
    for i, cell in enumerate(cells):
        base = f"Unnamed: {i}" if cell is None or cell == "" else cell
        count = seen.get(base, 0)
        seen[base] = count + 1
        names.append(base if count == 0 else f"{base}.{count}")
    return names


def workbook_table(
    files: DataFrame, columns: Sequence[str] | None = None, keep_path: bool = False
) -> DataFrame:
    """All-text rows below the header row of each (path, content) workbook.

    Without ``columns`` the names are taken from the header row, which all
    workbooks must share, and the widest row tells how many unnamed columns
    follow. The cells are stored for that, so each workbook is decoded once.
    """
    cells = workbook_cells(files)
    if columns is None:
        cells = stored_table(cells, "cells")
        header = F.when(F.col("sheet_row") == 1, F.col("cells"))
        first, last, width = cells.agg(
            F.min(header), F.max(header), F.max(F.size("cells"))
        ).first()
        if first is None or first != last:
            raise ValueError("the workbooks do not share one header row")
        columns = header_names([*first, *[None] * (width - len(first))])
    body = cells.where(
        (F.col("sheet_row") > 1) & F.exists("cells", lambda c: c.isNotNull())
    )
    return body.select(
        *(["path", "sheet_row"] if keep_path else []),
        *[F.get("cells", F.lit(i)).alias(name) for i, name in enumerate(columns)],
    )


def read_workbooks(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] | None = None,
    keep_path: bool = False,
) -> DataFrame:
    """First sheet of one workbook, a glob or a list, as all-text rows."""
    files = spark.read.format("binaryFile").load(path)
    return workbook_table(files, columns, keep_path)
