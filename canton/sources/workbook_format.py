"""Workbooks as a data source: ``spark.read.format("workbook")``.

One input partition per file and sheet. Files are opened through Arrow's file
systems by the executors, so local, HDFS and object store paths work where the
cluster's Python has the driver for them; ``read_workbooks`` goes through
Spark's own readers instead.
"""

from __future__ import annotations

import fnmatch
import json
import posixpath
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructField, StructType

from canton.sources.workbooks import header_names, sheet_parts, sheet_rows

FORMAT = "workbook"
BATCH_ROWS = 10_000

#: Columns beside the cells' own: where a row stands.
PLACE = (("path", StringType()), ("sheet", StringType()), ("sheet_row", LongType()))


def open_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path inside it. Signs of a glob are no part of a URI."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    cut = min((path.find(c) for c in "*?[" if c in path), default=len(path))
    cut = path.rfind("/", 0, cut) if cut < len(path) else cut
    fs, base = pafs.FileSystem.from_uri(path[:cut])
    return fs, base + path[cut:]


def list_files(path: str) -> list[tuple[pafs.FileSystem, str]]:
    """The files of a path, a folder or a glob over file names and folders, sorted."""
    fs, inner = open_system(path)
    fixed = inner
    while any(c in fixed for c in "*?["):
        fixed = posixpath.dirname(fixed)
    if fixed == inner and fs.get_file_info(inner).type == pafs.FileType.File:
        return [(fs, inner)]
    pattern = inner if fixed != inner else f"{inner.rstrip('/')}/*"
    found = fs.get_file_info(pafs.FileSelector(fixed, recursive=True, allow_not_found=True))
    depth = pattern.count("/")
    names = sorted(
        f.path for f in found
        if f.type == pafs.FileType.File and fnmatch.fnmatchcase(f.path, pattern) and f.path.count("/") == depth
        and not posixpath.basename(f.path).startswith(("_", "."))
    )
    if not names:
        raise ValueError(f"no workbook at {path}")
    return [(fs, n) for n in names]


@dataclass
class SheetPartition(InputPartition):
    path: str
    sheet: str


class WorkbookReader(DataSourceReader):
    """Options: ``header`` (true), ``sheet`` (a name, ``*`` for all; first by default),
    ``columns`` (a JSON list of names, by position), ``select`` (a JSON list of the
    columns to decode)."""

    def __init__(self, schema: StructType, options):
        self.names = schema.fieldNames()
        self.options = dict(options)
        self.header = self.options.get("header", "true").lower() == "true"
        self.columns = json.loads(self.options["columns"]) if "columns" in self.options else None

    def partitions(self) -> Sequence[InputPartition]:
        wanted, out = self.options.get("sheet"), []
        for fs, path in list_files(self.options["path"]):
            if wanted is None:
                out.append(SheetPartition(path, ""))
                continue
            with fs.open_input_file(path) as file, zipfile.ZipFile(file) as book:
                out += [SheetPartition(path, s) for s in sheet_parts(book) if wanted in ("*", s)]
        return out

    def read(self, partition: SheetPartition) -> Iterator[pa.RecordBatch]:
        fs, _ = open_system(self.options["path"])
        schema = pa.schema([(n, pa.int64() if n == "sheet_row" else pa.string()) for n in self.names])
        with fs.open_input_file(partition.path) as file:
            with zipfile.ZipFile(file) as book:
                sheet = partition.sheet or next(iter(sheet_parts(book)))
            file.seek(0)
            names, place = self.columns, {"path": partition.path, "sheet": sheet}
            held: list[tuple] = []
            for number, cells in sheet_rows(file, sheet):
                if self.header and number == 1:
                    if names is None:
                        names = self._checked(header_names(cells), partition)
                    continue
                if all(c is None for c in cells):
                    continue
                if names is None:
                    names = [f"_c{i}" for i in range(len(self.names))]
                # Who asks for all columns must not lose one; who chose some has chosen.
                if set(names) <= set(self.names) and any(c is not None for c in cells[len(names) :]):
                    raise ValueError(f"{partition.path}: row {number} is wider than the {len(names)} columns")
                held.append((number, cells))
                if len(held) == BATCH_ROWS:
                    yield self._batch(held, names, place, schema)
                    held = []
            if held:
                yield self._batch(held, names, place, schema)

    def _checked(self, header: list[str], partition: SheetPartition) -> list[str]:
        asked = [n for n in self.names if n not in dict(PLACE)]
        # Unnamed columns may follow those that this file's header names.
        names = header + [f"Unnamed: {i}" for i in range(len(header), len(asked))]
        if missing := [n for n in asked if n not in names]:
            raise ValueError(f"{partition.path}: the header lacks {missing}")
        return names

    def _batch(self, rows: list[tuple], names: list[str], place: dict[str, str], schema: pa.Schema) -> pa.RecordBatch:
        at = {n: i for i, n in enumerate(names)}
        columns = []
        for field in schema:
            if field.name == "sheet_row":
                values = [number for number, _ in rows]
            elif field.name in at:
                i = at[field.name]
                values = [cells[i] if i < len(cells) else None for _, cells in rows]
            else:
                values = [place[field.name]] * len(rows)
            columns.append(pa.array(values, field.type))
        return pa.RecordBatch.from_arrays(columns, schema=schema)


class WorkbookSource(DataSource):
    """All-text rows below the header of workbooks, with ``path``, ``sheet`` and ``sheet_row``.

    Without a schema or ``columns`` the first file is read for its header and
    its widest row; every other file must have these columns, in any order,
    and none wider. ``select`` (or a given schema) leaves columns undecoded.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        columns = self._columns()
        names = [n for n, _ in PLACE]
        chosen = json.loads(self.options["select"]) if "select" in self.options else [*columns, *names]
        if unknown := [c for c in chosen if c not in columns and c not in names]:
            raise ValueError(f"no column {unknown}")
        return StructType([StructField(c, dict(PLACE).get(c, StringType())) for c in chosen])

    def _columns(self) -> list[str]:
        if "columns" in self.options:
            return json.loads(self.options["columns"])
        fs, path = list_files(self.options["path"])[0]
        head, width = None, 0
        with fs.open_input_file(path) as file:
            sheet = self.options.get("sheet")
            for _, cells in sheet_rows(file, None if sheet in (None, "*") else sheet):
                head = cells if head is None else head
                width = max(width, len(cells))
        if self.options.get("header", "true").lower() != "true":
            return [f"_c{i}" for i in range(width)]
        return header_names([*(head or []), *[None] * (width - len(head or []))])

    def reader(self, schema: StructType) -> DataSourceReader:
        return WorkbookReader(schema, self.options)


def register_workbooks(spark: SparkSession) -> None:
    """Make the format known to a session; doing so again changes nothing."""
    spark.dataSource.register(WorkbookSource)
