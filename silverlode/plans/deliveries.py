"""Deliveries that queries and tests read: packed from frames, one bounded file per group."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame

from silverlode.sources.remote import write_stream
from silverlode.sources.workbooks import MAIN, PKG, REL


def write_archives(members: DataFrame, target: str) -> DataFrame:
    """Pack (archive, path, content) rows into one ZIP per archive; archives must be small.

    Returns (archive, archive_path, member_count).  Used to stage deliveries.
    """

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        name, buf = pdf["archive"].iloc[0], io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
            for path, content in sorted(zip(pdf["path"], pdf["content"], strict=True)):
                z.writestr(zipfile.ZipInfo(path), content)
        buf.seek(0)
        write_stream(f"{target}/{name}", buf)
        return pd.DataFrame({"archive": [name], "archive_path": [f"{target}/{name}"], "member_count": [len(pdf)]})

    return members.groupBy("archive").applyInPandas(pack, "archive string, archive_path string, member_count long")


def write_files(rows: DataFrame, target: str) -> DataFrame:
    """Write (path, content) rows as files below ``target``; returns (path)."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                write_stream(f"{target}/{path}", io.BytesIO(content))
            yield batch[["path"]]

    return rows.select("path", "content").mapInPandas(write, "path string")


def _letters(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def workbook_bytes(sheets: dict[str, list[list]]) -> bytes:
    """A minimal workbook holding ``sheets``: name -> rows, the first one the header."""
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    main, rel, pkg = MAIN[1:-1], REL[1:-1], PKG[1:-1]
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        refs, rels = [], []
        for n, (name, rows) in enumerate(sheets.items(), start=1):
            refs.append(f'<sheet name="{escape(name)}" sheetId="{n}" r:id="rId{n}"/>')
            rels.append(f'<Relationship Id="rId{n}" Type="{rel}/worksheet" Target="worksheets/sheet{n}.xml"/>')
            body = []
            letters = [_letters(i) for i in range(max(map(len, rows), default=0))]
            for r, row in enumerate(rows, start=1):
                cells = []
                for i, v in enumerate(row):
                    if isinstance(v, (int, float)):
                        cells.append(f'<c r="{letters[i]}{r}"><v>{v}</v></c>')
                    elif v is not None:
                        cells.append(f'<c r="{letters[i]}{r}" t="inlineStr"><is><t>{escape(str(v))}</t></is></c>')
                body.append(f'<row r="{r}">{"".join(cells)}</row>')
            z.writestr(f"xl/worksheets/sheet{n}.xml", f'{head}<worksheet xmlns="{main}"><sheetData>{"".join(body)}</sheetData></worksheet>')
        z.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{"".join(refs)}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="{pkg}">{"".join(rels)}</Relationships>')
    return buf.getvalue()


def write_workbooks(rows: DataFrame, target: str) -> DataFrame:
    """Stage workbooks from (company, file_name, sheet, row_no, cells array) rows.

    Each (company, file_name) group must fit one workbook.
    """

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        company, name = pdf["company"].iloc[0], pdf["file_name"].iloc[0]
        sheets = {s: [list(c) for c in g.sort_values("row_no")["cells"]] for s, g in pdf.groupby("sheet")}
        write_stream(f"{target}/{company}/{name}", io.BytesIO(workbook_bytes(sheets)))
        return pd.DataFrame({"company": [company], "file_name": [name], "sheets": [len(sheets)]})

    return rows.groupBy("company", "file_name").applyInPandas(pack, "company string, file_name string, sheets long")
