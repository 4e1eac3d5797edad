"""Read ``.xlsx`` workbooks as Spark tables, one per sheet.

Spark lists the workbooks and hands them to tasks; a task unzips its workbooks
and streams their rows out as arrays of text. Headers, types and casts are then
ordinary DataFrame work. A sheet holds at most 1,048,576 rows by its format, so a
workbook fits a task however many there are.
"""

from __future__ import annotations

import io
import posixpath
import re
import sys
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from itertools import islice
from xml.etree import ElementTree

import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# Send the functions below to the tasks, so that workers need no copy of them.
register_pickle_by_value(sys.modules[__name__])

CELL_SCHEMA = (
    "path string, sheet string, row_no bigint, cells array<string>, kinds array<string>"
)
BATCH_ROWS = 10_000

# Fixed values of the workbook format: namespaces, built-in date formats, epoch.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}
EPOCH = datetime(1899, 12, 30)

# Kinds of cells, as the workbook stores them.
TEXT, NUMBER, BOOLEAN, DAY, MOMENT = "text", "number", "boolean", "day", "moment"


def read_workbook_cells(
    spark: SparkSession, uri: str, sheet: str | None = None
) -> DataFrame:
    """Every row of every sheet (or of one) of the workbooks at ``uri``.

    Columns: path, sheet, row number as in the workbook, cells as text, and what
    each cell was stored as. Blank cells are null in both arrays.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.xlsx")
        .option("recursiveFileLookup", "true")
        .load(uri)
    )
    return workbook_cells(files, sheet)


def workbook_cells(files: DataFrame, sheet: str | None = None) -> DataFrame:
    """The rows of workbooks given as columns ``path`` and ``content``."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                yield from _batches(path, content, sheet)

    return files.select("path", "content").mapInPandas(decode, CELL_SCHEMA)


def workbook_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """One table per sheet of one workbook.

    The first row names the columns. A column of numbers, booleans or dates gets
    such a type, every other is text; this takes one pass over the cells, of which
    the driver sees one row per column.
    """
    return {
        sheet: sheet_table(read_workbook_cells(spark, path, sheet), columns)
        for sheet, columns in sheet_columns(read_workbook_cells(spark, path)).items()
    }


def sheet_table(cells: DataFrame, columns: list[tuple[int, str, str]]) -> DataFrame:
    """The rows below the header as typed columns; blank rows are left out."""
    values = [F.get("cells", F.lit(position)) for position, _, _ in columns]
    typed = [
        value.try_cast(dtype).alias(name)
        for value, (_, name, dtype) in zip(values, columns, strict=True)
    ]
    filled = (F.col("row_no") > 1) & F.coalesce(*values).isNotNull()
    return cells.where(filled).select(*typed)


def sheet_columns(cells: DataFrame) -> dict[str, list[tuple[int, str, str]]]:
    """(position, name, type) of each column of each sheet."""
    zipped = F.posexplode(F.arrays_zip("cells", "kinds")).alias("pos", "entry")
    entries = cells.select("sheet", "row_no", zipped).select(
        "sheet", "pos", "row_no", "entry.cells", "entry.kinds"
    )
    header, body = F.col("row_no") == 1, F.col("row_no") > 1

    def every(condition: Column) -> Column:
        return F.bool_and(F.when(body & F.col("kinds").isNotNull(), condition))

    profile = (
        entries.groupBy("sheet", "pos")
        .agg(
            F.max(F.when(header, F.col("cells"))).alias("header"),
            every(F.col("cells").try_cast("bigint").isNotNull()).alias("whole"),
            every(F.col("kinds") == NUMBER).alias(NUMBER),
            every(F.col("kinds") == BOOLEAN).alias(BOOLEAN),
            every(F.col("kinds") == DAY).alias(DAY),
            every(F.col("kinds").isin(DAY, MOMENT)).alias(MOMENT),
        )
        .orderBy("sheet", "pos")
        .collect()
    )
    sheets: dict[str, list[tuple[int, str, str]]] = {}
    for row in profile:
        columns = sheets.setdefault(row["sheet"], [])
        used = {name for _, name, _ in columns}
        name = row["header"] or f"_c{row['pos']}"
        if name in used:
            name = f"{name}{row['pos']}"
        columns.append((row["pos"], name, _column_type(row)))
    return sheets


def _column_type(row: Row) -> str:
    if row[NUMBER]:
        return "bigint" if row["whole"] else "double"
    if row[BOOLEAN]:
        return "boolean"
    if row[MOMENT]:
        return "date" if row[DAY] else "timestamp"
    return "string"


def _batches(path: str, content: bytes, sheet: str | None) -> Iterator[pd.DataFrame]:
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        strings = _shared_strings(book)
        date_styles = _date_styles(book)
        for name, part in _sheet_parts(book):
            if sheet is not None and name != sheet:
                continue
            rows = _rows(book, part, strings, date_styles)
            while batch := list(islice(rows, BATCH_ROWS)):
                frame = pd.DataFrame(batch, columns=["row_no", "cells", "kinds"])
                yield frame.assign(path=path, sheet=name)


def _parse(book: zipfile.ZipFile, part: str) -> ElementTree.Element | None:
    if part not in book.namelist():
        return None
    with book.open(part) as stream:
        return ElementTree.parse(stream).getroot()


def _sheet_parts(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(sheet name, archive member) in workbook order."""
    links = _parse(book, "xl/_rels/workbook.xml.rels")
    targets = {link.get("Id"): link.get("Target") for link in links}
    sheets = _parse(book, "xl/workbook.xml").iter(MAIN + "sheet")
    return [
        (s.get("name"), posixpath.normpath(posixpath.join("/xl", target)).lstrip("/"))
        for s in sheets
        if (target := targets.get(s.get(RELATION)))
    ]


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    root = _parse(book, "xl/sharedStrings.xml")
    if root is None:
        return []
    return ["".join(t.text or "" for t in si.iter(MAIN + "t")) for si in root]


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles that show a number as a date."""
    root = _parse(book, "xl/styles.xml")
    if root is None:
        return set()
    formats = set(DATE_FORMATS)
    for custom in root.iter(MAIN + "numFmt"):
        shown = re.sub(r'"[^"]*"|\[[^\]]*\]', "", custom.get("formatCode", ""))
        if re.search(r"[ymdhs]", shown, re.IGNORECASE):
            formats.add(int(custom.get("numFmtId")))
    styles = root.find(MAIN + "cellXfs")
    if styles is None:
        return set()
    return {i for i, xf in enumerate(styles) if int(xf.get("numFmtId", 0)) in formats}


def _rows(
    book: zipfile.ZipFile, part: str, strings: list[str], date_styles: set[int]
) -> Iterator[tuple[int, list[str | None], list[str | None]]]:
    number = 0
    with book.open(part) as stream:
        for _, element in ElementTree.iterparse(stream):
            if element.tag != MAIN + "row":
                continue
            number = int(element.get("r", number + 1))
            cells: list[tuple[str | None, str | None]] = []
            for cell in element.iter(MAIN + "c"):
                position = _position(cell.get("r"), len(cells))
                cells.extend([(None, None)] * (position - len(cells)))
                text, kind = _content(cell, strings, date_styles)
                cells.append((text, kind) if text else (None, None))
            yield number, [t for t, _ in cells], [k for _, k in cells]
            element.clear()


def _position(reference: str | None, following: int) -> int:
    """Zero-based column of a cell reference such as ``AB12``."""
    if not reference:
        return following
    position = 0
    for letter in reference.rstrip("0123456789"):
        position = position * 26 + ord(letter) - ord("A") + 1
    return position - 1


def _content(
    cell: ElementTree.Element, strings: list[str], date_styles: set[int]
) -> tuple[str | None, str]:
    """Text and kind of a cell; errors and blanks have no text."""
    stored_as = cell.get("t", "n")
    if stored_as == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(MAIN + "t")), TEXT
    value = cell.findtext(MAIN + "v")
    if not value or stored_as == "e":
        return None, TEXT
    if stored_as == "s":
        return strings[int(value)], TEXT
    if stored_as == "b":
        return ("true" if value == "1" else "false"), BOOLEAN
    if stored_as != "n":
        return value, TEXT
    if int(cell.get("s", 0)) not in date_styles:
        return value, NUMBER
    moment = EPOCH + timedelta(seconds=round(float(value) * 86_400))
    if float(value).is_integer():
        return moment.date().isoformat(), DAY
    return moment.isoformat(sep=" "), MOMENT
