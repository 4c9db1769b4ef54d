"""Workbook sheets (xlsx) as tall rows, and their typed projection.

A book is listed once, with its sheets and their sizes.  The unit of work is a run of
sheets of one book, up to ``TASK_BYTES`` of compressed XML: a task opens the book once and
parses its shared strings once.  Sheets and columns that are not asked for are not
opened and not kept.  Sheets, which the file format itself bounds to 1,048,576 rows, are
parsed as a stream and leave the task in Arrow batches.
"""

from __future__ import annotations

import collections
import re
import zipfile
from collections.abc import Iterator, Sequence
from typing import BinaryIO
from xml.etree import ElementTree as ET

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .archives import task_count
from .files import list_files
from .remote import open_read

# Spreadsheet XML namespaces, and the day spreadsheet date serials
# count from with their shape.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
PKG = "{http://schemas.openxmlformats.org/package/2006/relationships}"
SERIAL_EPOCH = "1899-12-30"
SERIAL_REGEX = r"^\d{1,7}(\.\d+)?$"

SHEET_DATA, ROW, CELL, VALUE, TEXT = (f"{MAIN}{tag}" for tag in ("sheetData", "row", "c", "v", "t"))

ROWS_PER_BATCH = 5000
BLOCK_BYTES = 64 << 10
TASK_BYTES = 8 << 20  # compressed sheet XML grows about tenfold


SHEET_SCHEMA = "path string, sheet string, part string, packed_bytes long, run int"


def _sheet_parts(z: zipfile.ZipFile) -> dict[str, str]:
    rels = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels")).iter(f"{PKG}Relationship")}
    book = ET.fromstring(z.read("xl/workbook.xml"))
    return {s.get("name"): "xl/" + rels[s.get(f"{REL}id")].removeprefix("/xl/") for s in book.iter(f"{MAIN}sheet")}


def list_sheets(
    spark: SparkSession, path: str, glob: str = "*.xlsx", sheets: Sequence[str] | None = None, task_bytes: int = TASK_BYTES
) -> DataFrame:
    """(path, sheet, part, packed_bytes, run) of the sheets asked for; every book is opened once.

    ``run`` numbers the runs of sheets that are read together.
    """
    asked = None if sheets is None else frozenset(sheets)

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                with open_read(path) as f, zipfile.ZipFile(f) as z:
                    found = [(s, p, z.getinfo(p).compress_size) for s, p in _sheet_parts(z).items() if asked is None or s in asked]
                runs, held = [], 0
                for _, _, size in found:
                    new = not runs or held + size > task_bytes
                    runs.append(runs[-1] + new if runs else 0)
                    held = size if new else held + size
                out = pd.DataFrame(found, columns=["sheet", "part", "packed_bytes"])
                yield out.assign(path=path, run=runs)[["path", "sheet", "part", "packed_bytes", "run"]]

    return list_files(spark, path, glob).select("path").mapInPandas(listed, SHEET_SCHEMA)


def _column_index(ref: str) -> int:
    n = 0
    for ch in re.match(r"[A-Z]+", ref).group():
        n = n * 26 + ord(ch) - 64
    return n - 1


def _shared_strings(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    root = ET.fromstring(z.read("xl/sharedStrings.xml"))
    return ["".join(t.text or "" for t in si.iter(f"{MAIN}t")) for si in root.iter(f"{MAIN}si")]


def _row_elements(stream: BinaryIO) -> Iterator[ET.Element]:
    """The complete rows of a sheet's XML; the tree is built block by block, without a step in Python per element."""
    parser, data = ET.XMLPullParser(("start",)), None
    ended = False
    while not ended:
        block = stream.read(BLOCK_BYTES)
        ended = not block
        if ended:
            parser.close()
        else:
            parser.feed(block)
        for _, el in parser.read_events():
            if data is None and el.tag == SHEET_DATA:
                data = el
                break
        collections.deque(parser.read_events(), maxlen=0)
        if data is None:
            continue
        # The last row may go on in the next block.
        complete = len(data) if ended else len(data) - 1
        for el in data[: max(complete, 0)]:
            if el.tag == ROW:
                yield el
        # Rows read are dropped from the tree, so a long sheet does not grow it.
        del data[: max(complete, 0)]


def _rows(z: zipfile.ZipFile, part: str, shared: list[str]) -> Iterator[list[str | None]]:
    places: dict[str, int] = {}
    with z.open(part) as stream:
        for el in _row_elements(stream):
            cells: dict[int, str | None] = {}
            for pos, c in enumerate(el.iter(CELL)):
                ref, kind = c.get("r"), c.get("t")
                at = pos
                if ref:
                    name = ref.rstrip("0123456789")
                    if name not in places:
                        places[name] = _column_index(name)
                    at = places[name]
                if kind == "inlineStr":
                    cells[at] = "".join([t.text or "" for t in c.iter(TEXT)])
                    continue
                v = c.find(VALUE)
                if v is not None and v.text is not None:
                    cells[at] = shared[int(v.text)] if kind == "s" else v.text
            yield [cells.get(i) for i in range(max(cells) + 1)] if cells else []


def _distinct_names(header: list[str | None]) -> list[str | None]:
    """Header names, with the repeated ones numbered: ``Pay``, ``Pay (2)``."""
    seen: dict[str, int] = {}
    out = []
    for name in header:
        if name:
            seen[name] = seen.get(name, 0) + 1
            name = name if seen[name] == 1 else f"{name} ({seen[name]})"
        out.append(name)
    return out


TALL = pa.schema(
    [("path", pa.string()), ("sheet", pa.string()), ("row_no", pa.int64()), ("cells", pa.map_(pa.string(), pa.string()))]
)


def _batch(path: str, sheet: str, numbers: list[int], ends: list[int], names: list[str], values: list[str]) -> pa.RecordBatch:
    """Rows ``numbers``; the cells of each end at its place of ``ends`` in ``names`` and ``values``."""
    n = len(numbers)
    cells = pa.MapArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.array(names, pa.string()), pa.array(values, pa.string()))
    return pa.RecordBatch.from_arrays([pa.array([path] * n), pa.array([sheet] * n), pa.array(numbers, pa.int64()), cells], schema=TALL)


def _sheet_batches(z: zipfile.ZipFile, path: str, sheet: str, part: str, shared: list[str], kept) -> Iterator[pa.RecordBatch]:
    rows = _rows(z, part, shared)
    header = [h if h and (kept is None or h in kept) else None for h in _distinct_names(next(rows, []))]
    whole = all(header)
    numbers: list[int] = []
    ends: list[int] = []
    names: list[str] = []
    values: list[str] = []
    for n, row in enumerate(rows, start=1):
        numbers.append(n)
        if whole and len(row) == len(header) and None not in row:
            names.extend(header)
            values.extend(row)
        else:
            for h, v in zip(header, row, strict=False):
                if h and v is not None:
                    names.append(h)
                    values.append(v)
        ends.append(len(names))
        if len(numbers) >= ROWS_PER_BATCH:
            yield _batch(path, sheet, numbers, ends, names, values)
            numbers, ends, names, values = [], [], [], []
    if numbers:
        yield _batch(path, sheet, numbers, ends, names, values)


def read_workbooks(
    spark: SparkSession,
    path: str,
    glob: str = "*.xlsx",
    sheets: Sequence[str] | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """(company, file_name, sheet, row_no, cells): first row is the header.

    ``company`` is the folder above the workbook; ``cells`` maps header to text.
    Sheets that are not asked for are never opened, other columns are not kept.
    """
    kept = None if columns is None else frozenset(columns)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by book and run; a book stays open while they are its own.
        open_path, book, shared, file = None, None, [], None
        for batch in batches:
            for row in batch.to_pylist():
                if row["path"] != open_path:
                    if file:
                        file.close()
                    open_path, file = row["path"], open_read(row["path"])
                    book = zipfile.ZipFile(file)
                    shared = _shared_strings(book)
                yield from _sheet_batches(book, open_path, row["sheet"], row["part"], shared, kept)
        if file:
            file.close()

    tasks = task_count(spark, path, glob, TASK_BYTES)
    runs = list_sheets(spark, path, glob, sheets).repartition(tasks, "path", "run").sortWithinPartitions("path", "run", "part")
    tall = runs.select("path", "sheet", "part").mapInArrow(
        read, "path string, sheet string, row_no long, cells map<string,string>"
    )
    parts = F.split("path", "/")
    return tall.select(
        F.element_at(parts, -2).alias("company"), F.element_at(parts, -1).alias("file_name"), "sheet", "row_no", "cells"
    )


def typed_cell(text: Column, data_type: T.DataType) -> Column:
    """Text to the declared type, null when it does not fit.

    A bare number in a date column is a day serial, never a year.
    """
    if isinstance(data_type, T.DateType):
        is_serial = text.rlike(SERIAL_REGEX)
        serial = F.floor(F.when(is_serial, text).try_cast("double")).cast("int")
        return F.when(is_serial, F.date_add(F.lit(SERIAL_EPOCH).cast("date"), serial)).otherwise(text.try_cast("date"))
    return text.try_cast(data_type)


def project_sheet(tall: DataFrame, sheet: str, schema: T.StructType) -> DataFrame:
    """Typed rows of one sheet, with the company they came from."""
    cols = [typed_cell(F.col("cells")[f.name], f.dataType).alias(f.name) for f in schema.fields]
    return tall.where(F.col("sheet") == sheet).select(*cols, F.col("company").alias("Company"))


def load_sheet(spark: SparkSession, path: str, sheet: str, schema: T.StructType) -> DataFrame:
    """Typed rows of one sheet of all workbooks below ``path``."""
    return project_sheet(read_workbooks(spark, path, sheets=[sheet]), sheet, schema)


def stage_sheets(spark: SparkSession, path: str, target: str, schemas: dict[str, T.StructType]) -> None:
    """Read the sheets of ``schemas`` of all workbooks once and store their rows by sheet below ``target``."""
    columns = {f.name for schema in schemas.values() for f in schema.fields}
    tall = read_workbooks(spark, path, sheets=list(schemas), columns=sorted(columns))
    tall.write.mode("overwrite").partitionBy("sheet").parquet(target)


def load_staged(spark: SparkSession, target: str, sheet: str, schema: T.StructType) -> DataFrame:
    """Typed rows of one staged sheet; only its partition is read."""
    stored = "company string, file_name string, row_no long, cells map<string,string>, sheet string"
    return project_sheet(spark.read.schema(stored).parquet(target), sheet, schema)
