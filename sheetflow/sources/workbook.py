"""Workbooks as a grid of cells, many files per job."""

from __future__ import annotations

import io
import os
import re
import uuid
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetflow.operators.grid import header_names, promote_header

CELLS = "file string, sheet string, row int, col int, value string"
MERGES = "file string, sheet string, min_row int, min_col int, max_row int, max_col int"

# Number formats that show a date or time.
DATE_FORMATS = {*range(14, 23), *range(45, 48)}

_REF = re.compile(r"([A-Z]+)(\d+)")


def _column(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + ord(ch) - 64
    return n


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _tree(book: zipfile.ZipFile, name: str):
    return ElementTree.fromstring(book.read(name)) if name in book.namelist() else None


def _sheet_part(book: zipfile.ZipFile, sheet) -> tuple[str, str]:
    """(sheet name, part name) for a name, a 0-based index, or the first sheet."""
    targets = {r.get("Id"): r.get("Target") for r in _tree(book, "xl/_rels/workbook.xml.rels")}
    sheets = []
    for node in _tree(book, "xl/workbook.xml").iter():
        if _local(node.tag) == "sheet":
            link = next(v for k, v in node.attrib.items() if _local(k) == "id")
            target = targets[link]
            sheets.append((node.get("name"), target.lstrip("/") if target.startswith("/") else f"xl/{target}"))
    if isinstance(sheet, str):
        found = [s for s in sheets if s[0] == sheet]
        if not found:
            raise ValueError(f"no sheet {sheet!r}; there are {[s[0] for s in sheets]}")
        return found[0]
    return sheets[sheet or 0]


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    root = _tree(book, "xl/styles.xml")
    if root is None:
        return set()
    custom = {
        int(n.get("numFmtId")): re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", n.get("formatCode", ""))
        for n in root.iter()
        if _local(n.tag) == "numFmt"
    }
    dates = DATE_FORMATS | {k for k, code in custom.items() if re.search("[ymdhs]", code, re.I)}
    styles = next((n for n in root if _local(n.tag) == "cellXfs"), [])
    return {i for i, xf in enumerate(styles) if int(xf.get("numFmtId", 0)) in dates}


def _number(text: str, is_date: bool) -> str:
    if is_date:
        moment = datetime(1899, 12, 30) + timedelta(days=float(text))
        return str(moment + timedelta(microseconds=500) - timedelta(microseconds=(moment.microsecond + 500) % 1000))
    number = float(text)
    return str(int(number)) if number.is_integer() and abs(number) < 1e15 else repr(number)


def _scan(content: bytes, sheet, rows, with_merges: bool = False) -> tuple[str, list[tuple[int, int, str]], list[tuple[int, int, int, int]]]:
    """Sheet name, cells within the row range, and merged ranges."""
    low, high = rows or (1, 1 << 30)
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        name, part = _sheet_part(book, sheet)
        strings_root = _tree(book, "xl/sharedStrings.xml")
        strings = [
            "".join(t.text or "" for t in item.iter() if _local(t.tag) == "t") for item in (strings_root if strings_root is not None else [])
        ]
        dates = _date_styles(book)
        cells, merges, row = [], [], 0
        for event, node in ElementTree.iterparse(book.open(part), ("start", "end")):
            tag = _local(node.tag)
            if event == "start":
                if tag == "row":
                    row, column = int(node.get("r") or row + 1), 0
                    if row > high and not with_merges:
                        break
                continue
            if tag == "c":
                ref = _REF.match(node.get("r") or "")
                column = _column(ref.group(1)) if ref else column + 1
                if low <= row <= high:
                    kind = node.get("t", "n")
                    text = "".join(n.text or "" for n in node.iter() if _local(n.tag) in ("v", "t"))
                    if text and kind == "s":
                        text = strings[int(text)]
                    elif text and kind == "b":
                        text = "True" if text == "1" else "False"
                    elif text and kind == "n":
                        text = _number(text, int(node.get("s") or 0) in dates)
                    if text:
                        cells.append((row, column, text))
            elif tag == "row":
                node.clear()
            elif tag == "mergeCell":
                ends = _REF.findall(node.get("ref"))
                (c1, r1), (c2, r2) = ends[0], ends[-1]
                merges.append((int(r1), _column(c1), int(r2), _column(c2)))
    return name, cells, merges


def decode_cells(files: DataFrame, sheet: str | int | None = None, rows: tuple[int, int] | None = None) -> DataFrame:
    """Cells of workbooks given as (path, content); one small file per row."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                name, cells, _ = _scan(content, sheet, rows)
                out = pd.DataFrame(cells, columns=["row", "col", "value"])
                yield out.assign(file=path, sheet=name)[["file", "sheet", "row", "col", "value"]]

    return files.select("path", "content").mapInPandas(decode, CELLS)


def decode_merges(files: DataFrame, sheet: str | int | None = None) -> DataFrame:
    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                name, _, merges = _scan(content, sheet, (1, 0), with_merges=True)
                out = pd.DataFrame(merges, columns=["min_row", "min_col", "max_row", "max_col"])
                yield out.assign(file=path, sheet=name)[["file", "sheet", "min_row", "min_col", "max_row", "max_col"]]

    return files.select("path", "content").mapInPandas(decode, MERGES)


def _files(spark: SparkSession, glob: str) -> DataFrame:
    return spark.read.format("binaryFile").load(glob)


def read_xlsx_cells(spark: SparkSession, glob: str, sheet: str | int | None = None, rows: tuple[int, int] | None = None) -> DataFrame:
    """(file, sheet, row, col, value) of one sheet per workbook; blanks left out."""
    return decode_cells(_files(spark, glob), sheet, rows)


def read_xlsx_merges(spark: SparkSession, glob: str, sheet: str | int | None = None) -> DataFrame:
    return decode_merges(_files(spark, glob), sheet)


def read_sheet(files: DataFrame, sheet: str | int | None = None, header_row: int = 1) -> DataFrame:
    """Workbooks as one table with named columns; the header is read on its own."""
    names = header_names(decode_cells(files, sheet, (header_row, header_row)), header_row)
    return promote_header(decode_cells(files, sheet, (header_row + 1, 1 << 30)), header_row, names)


# -- writing ------------------------------------------------------------------

# The parts of a minimal workbook.
_PARTS = {
    "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
    "_rels/.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
}
_BOOK = '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="{name}" sheetId="1" r:id="rId1"/></sheets></workbook>'
_SHEET = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{rows}</sheetData>{merges}</worksheet>'


def encode_workbook(rows: list[list], name: str = "Sheet1", merges: list[str] = ()) -> bytes:
    """One-sheet workbook; None leaves a cell out, numbers stay numbers."""
    lines = []
    for row in rows:
        cells = []
        for value in row:
            if value is None or value != value:
                cells.append("<c/>")
            elif isinstance(value, (int, float)) and not isinstance(value, bool):
                cells.append(f"<c><v>{value!r}</v></c>")
            else:
                cells.append(f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>')
        lines.append(f"<row>{''.join(cells)}</row>")
    joined = "".join(f'<mergeCell ref="{m}"/>' for m in merges)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for part, text in _PARTS.items():
            book.writestr(part, text)
        book.writestr("xl/workbook.xml", _BOOK.format(name=escape(name)))
        merged = f"<mergeCells>{joined}</mergeCells>" if joined else ""
        book.writestr("xl/worksheets/sheet1.xml", _SHEET.format(rows="".join(lines), merges=merged))
    return out.getvalue()


def to_workbooks(df: DataFrame, row: str, rows_per_file: int = 100_000, sheet: str = "Sheet1") -> DataFrame:
    """(path, content): the rows as workbooks, cut by ranges of the row number.

    Each workbook holds a fixed range of row numbers, so no task grows with the
    table. The first line of each workbook is the header.
    """
    names = [c for c in df.columns if c != row]

    def encode(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(row)
        lines = part[names].astype(object).where(part[names].notna(), None).values.tolist()
        file = f"part-{part['_book'].iloc[0]:08d}.xlsx"
        return pd.DataFrame({"path": [file], "content": [encode_workbook([names, *lines], sheet)]})

    book = F.floor(F.col(row) / rows_per_file).cast("long")
    return df.withColumn("_book", book).groupBy("_book").applyInPandas(encode, "path string, content binary")


def save_workbooks(books: DataFrame, folder: str) -> int:
    """Write (path, content) workbooks into a folder; gives their number.

    The tasks write, so the folder must be a mount that every executor has. A
    file appears under its name only when it is complete.
    """

    def save(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(folder, exist_ok=True)
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                target = os.path.join(folder, os.path.basename(path))
                part = f"{target}.{uuid.uuid4().hex}.part"
                with open(part, "wb") as out:
                    out.write(content)
                os.replace(part, target)
            yield batch[["path"]]

    return books.select("path", "content").mapInPandas(save, "path string").distinct().count()
