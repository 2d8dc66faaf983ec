"""XLSX workbooks, read as strings by one task per workbook.

A sheet holds at most 1,048,576 rows by its format, so a workbook is a bounded
unit of work and a folder of them is read in parallel.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from itertools import chain, islice
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crateflow.contracts import ROW_SEQ
from crateflow.plans.spread import spread_join
from crateflow.session import stored

_ROWS_PER_BATCH = 5_000
_CELLS = "path string, row_no long, cells array<string>"
# Row number of the header in the stored cells.
_HEADER = 0
# Built-in number formats that show a date or a time.
_DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}
_EPOCH = datetime(1899, 12, 30)
_EPOCH_1904 = datetime(1904, 1, 1)


def scan_workbooks(
    spark: SparkSession,
    path: str | list[str],
    row_seq: bool = False,
    required: tuple[str, ...] = (),
) -> DataFrame:
    """First sheet of every workbook under ``path``: header row, then string rows."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return decode_workbooks(files, row_seq, required)


def decode_workbooks(
    files: DataFrame, row_seq: bool = False, required: tuple[str, ...] = ()
) -> DataFrame:
    """Turn ``path, content`` rows into one string table.

    The columns are those of all workbooks, in order of first appearance; a
    workbook without one of them has NULL there. A ``required`` column that some
    workbooks have and others lack fails the read. Each workbook is decoded once,
    to a stored table of its cells; names and rows are both read from that.
    """
    cells = stored(files.mapInPandas(_decode, _CELLS), "workbook-cells")
    headers = cells.where(F.col("row_no") == _HEADER).select("path", F.col("cells").alias("header"))
    # only the distinct names come to the driver, however many workbooks there are
    places = headers.select("path", F.posexplode("header").alias("at", "name"))
    firsts = places.groupBy("name").agg(
        F.min(F.struct("path", "at")).alias("first"), F.count("*").alias("books")
    )
    found = firsts.orderBy("first").collect()
    names = [row["name"] for row in found]
    if not names:
        raise ValueError("no workbook with a header row found")
    most = max(row["books"] for row in found)
    torn = [row["name"] for row in found if row["name"] in required and row["books"] < most]
    if torn:
        raise ValueError(f"not in every workbook: {', '.join(torn)}")
    rows = cells.where(F.col("row_no") > _HEADER)
    orders = headers.select("header").distinct().limit(2).collect()
    # with one header for all workbooks a name has one place and nothing is joined
    if len(orders) == 1:
        at = {name: F.lit(i) for i, name in enumerate(orders[0]["header"])}
    else:
        order = F.array(*[F.array_position("header", F.lit(name)).cast("int") for name in names])
        rows = spread_join(rows, headers.select("path", order.alias("_order")), ["path"])
        # a place of 0 means that the workbook lacks the name
        at = {name: F.nullif(F.col("_order")[i], F.lit(0)) - 1 for i, name in enumerate(names)}
    columns = [F.get("cells", at[name]).alias(name) for name in names]
    if row_seq:
        # rows of one workbook in sheet order, workbooks apart by their path
        place = F.shiftleft(F.xxhash64("path").bitwiseAND((1 << 41) - 1), 21) + F.col("row_no")
        columns.append(place.alias(ROW_SEQ))
    return rows.select(*columns)


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Column names of each workbook, then its rows, in the order of the sheet."""
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            rows = _sheet_rows(content)
            numbered = enumerate(chain([_header(next(rows, []))], rows), start=_HEADER)
            while chunk := list(islice(numbered, _ROWS_PER_BATCH)):
                table = [(path, n, cells) for n, cells in chunk]
                yield pd.DataFrame(table, columns=["path", "row_no", "cells"])


def _header(cells: list[str | None]) -> list[str]:
    """Column names; an empty or repeated one gets its position."""
    names: list[str] = []
    for i, cell in enumerate(cells, start=1):
        name = cell or f"column_{i}"
        names.append(f"{name}_{i}" if name in names else name)
    return names


def _sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """Rows of the first sheet that hold at least one value."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = _shared_strings(book)
        date_styles = _date_styles(book)
        sheet, epoch = _first_sheet(book)
        with book.open(sheet) as stream:
            for _, node in ElementTree.iterparse(stream):
                if _tag(node) != "row":
                    continue
                cells: list[str | None] = []
                for i, cell in enumerate(child for child in node if _tag(child) == "c"):
                    column = _column_index(cell.get("r"), i)
                    cells += [None] * (column + 1 - len(cells))
                    cells[column] = _cell_text(cell, shared, date_styles, epoch)
                node.clear()
                if any(value is not None for value in cells):
                    yield cells


def _tag(node: ElementTree.Element) -> str:
    return node.tag.rpartition("}")[2]


def _text(node: ElementTree.Element) -> str:
    """Text of a string item: plain or in runs, phonetic hints left out."""
    parts = []
    for child in node:
        if _tag(child) == "t":
            parts.append(child.text or "")
        elif _tag(child) == "r":
            parts += [t.text or "" for t in child if _tag(t) == "t"]
    return "".join(parts)


def _root(book: zipfile.ZipFile, name: str) -> ElementTree.Element | None:
    return ElementTree.fromstring(book.read(name)) if name in book.namelist() else None


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    root = _root(book, "xl/sharedStrings.xml")
    return [] if root is None else [_text(item) for item in root if _tag(item) == "si"]


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Positions of the cell styles that show their number as a date."""
    root = _root(book, "xl/styles.xml")
    if root is None:
        return set()
    dates = set(_DATE_FORMATS)
    for node in root.iter():
        if _tag(node) == "numFmt":
            # quoted text and [colour] parts are not date letters
            code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", node.get("formatCode", ""))
            if re.search(r"[dmyhs]", code, re.IGNORECASE):
                dates.add(int(node.get("numFmtId")))
    formats = next((node for node in root if _tag(node) == "cellXfs"), [])
    return {i for i, xf in enumerate(formats) if int(xf.get("numFmtId", 0)) in dates}


def _first_sheet(book: zipfile.ZipFile) -> tuple[str, datetime]:
    root = _root(book, "xl/workbook.xml")
    epoch = _EPOCH
    for node in root.iter():
        if _tag(node) == "workbookPr" and node.get("date1904") in ("1", "true"):
            epoch = _EPOCH_1904
    sheet = next(node for node in root.iter() if _tag(node) == "sheet")
    link = next(value for name, value in sheet.attrib.items() if name.endswith("}id"))
    for relation in _root(book, "xl/_rels/workbook.xml.rels"):
        if relation.get("Id") == link:
            target = relation.get("Target")
            return (target[1:] if target.startswith("/") else f"xl/{target}"), epoch
    raise ValueError("the first sheet has no part in the workbook")


def _column_index(reference: str | None, fallback: int) -> int:
    if not reference:
        return fallback
    index = 0
    for letter in re.match(r"[A-Z]+", reference)[0]:
        index = index * 26 + ord(letter) - ord("A") + 1
    return index - 1


def _cell_text(
    cell: ElementTree.Element, shared: list[str], date_styles: set[int], epoch: datetime
) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return next((_text(child) for child in cell if _tag(child) == "is"), None)
    raw = next((child.text for child in cell if _tag(child) == "v"), None)
    if raw is None or kind == "e":
        return None
    if kind == "s":
        return shared[int(raw)]
    if kind == "b":
        return "true" if raw == "1" else "false"
    if kind != "n":
        return raw
    number = float(raw)
    if int(cell.get("s", 0)) in date_styles:
        moment = epoch + timedelta(seconds=round(number * 86_400))
        return moment.date().isoformat() if number.is_integer() else moment.isoformat(" ")
    return str(int(number)) if number.is_integer() and abs(number) < 1e15 else repr(number)
