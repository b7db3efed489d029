"""Expense workbooks: ``<month name>_<year>.xlsx`` files read in parallel, one task record per file."""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections import deque
from collections.abc import Iterable, Iterator
from datetime import datetime
from itertools import islice
from xml.etree import ElementTree

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from cargolake.functions.expenses import SHEET_HEADERS, TOTAL_MARKER
from cargolake.functions.text import base_name, stem
from cargolake.operators.cleaning import drop_all_null, drop_marker_rows
from cargolake.schemas import EXPENSE_SHEET, conform, stamp

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINKED = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
HEADERS = list(SHEET_HEADERS)
FRAME_ROWS = 10_000
# Without these a row says nothing.
REQUIRED = ("Дата", "Сумма, руб.")
DECODED = ", ".join(f"`{h}` string" for h in ["path", *HEADERS, "other_columns", "read_error"])


def _text(node: ElementTree.Element) -> str:
    """Text of a cell or shared string; phonetic hints are not part of it."""
    runs = [*node.findall(f"{MAIN}t"), *node.findall(f"{MAIN}r/{MAIN}t")]
    return "".join(t.text or "" for t in runs)


def _shared_texts(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    with book.open("xl/sharedStrings.xml") as stream:
        return [_text(e) for _, e in ElementTree.iterparse(stream) if e.tag == f"{MAIN}si"]


def _first_sheet(book: zipfile.ZipFile) -> str:
    """The archive path of the first sheet, by way of the workbook's links."""
    first = ElementTree.fromstring(book.read("xl/workbook.xml")).find(f"{MAIN}sheets/{MAIN}sheet")
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in links if r.get("Id") == first.get(LINKED))
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _cells(row: ElementTree.Element, shared: list[str]) -> dict[str, str]:
    """Column letters -> text of the filled cells of a row."""
    cells = {}
    for place, c in enumerate(row.findall(f"{MAIN}c")):
        column = re.match("[A-Z]+", c.get("r") or "")
        value, inline = c.find(f"{MAIN}v"), c.find(f"{MAIN}is")
        if c.get("t") == "s" and value is not None:
            text = shared[int(value.text)]
        elif inline is not None:
            text = _text(inline)
        else:
            text = None if value is None else value.text
        if text:
            cells[column.group() if column else f"#{place}"] = text
    return cells


def _require(headers: Iterable[str]) -> None:
    missing = [h for h in REQUIRED if h not in headers]
    if missing:
        raise ValueError(f"no column {', '.join(missing)}")


def _rows(content: bytes) -> Iterator[tuple]:
    """The rows of the first sheet under the known headers, and all other columns of a row as one JSON text.

    Blanks around and inside a header do not matter. A missing column is all
    NULL; a sheet without the required ones is an error, raised at its end if it has no header at all. The sheet is
    parsed as a stream, so it costs its shared texts and one row at a time. A sheet has at most 1,048,576 rows.
    """
    place = None
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = _shared_texts(book)
        with book.open(_first_sheet(book)) as stream:
            sheet = None
            for event, e in ElementTree.iterparse(stream, events=("start", "end")):
                if e.tag == f"{MAIN}sheetData":
                    sheet = e
                elif event == "end" and e.tag == f"{MAIN}row":
                    cells = _cells(e, shared)
                    if place is None:
                        place = {" ".join(name.split()): column for column, name in cells.items()}
                        others = {name: column for name, column in place.items() if name not in HEADERS}
                        _require(place)
                    else:
                        more = {name: cells[column] for name, column in others.items() if column in cells}
                        known = tuple(cells.get(place.get(h)) for h in HEADERS)
                        yield (*known, json.dumps(more, ensure_ascii=False, sort_keys=True) if more else None)
                    sheet.clear()
    _require(place or {})


def _decode_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Frames of bounded length; a damaged file gives its error and none of its rows.

    A sheet is read twice: once to its end, so that damage anywhere is known
    before the first row leaves, and once more for its rows, a frame at a time.
    """
    names = ["path", *HEADERS, "other_columns", "read_error"]
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            try:
                deque(_rows(content), maxlen=0)
                rows, error = _rows(content), None
            except Exception as e:  # any damage to one file must not stop the others
                rows, error = iter([(None,) * (len(HEADERS) + 1)]), repr(e)
            while part := [(path, *row, error) for row in islice(rows, FRAME_ROWS)]:
                yield pd.DataFrame(part, columns=names, dtype=object)


def scan_workbooks(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of all workbooks, and one row with ``read_error`` per file that cannot be read.

    Spark packs the files into tasks by size, so the bytes one task holds are
    bounded by spark.sql.files.maxPartitionBytes or by its largest file; of the
    rows it holds a frame.
    """
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(folder)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], DECODED)
        raise
    return files.select("path", "content").mapInPandas(_decode_all, DECODED)


def expense_rows(decoded: DataFrame, run_ts: datetime) -> DataFrame:
    """Expense rows of the decoded workbooks, without total rows and empty rows."""
    rows = decoded.where("read_error IS NULL")
    rows = drop_all_null(drop_marker_rows(rows, "Номер документа", TOTAL_MARKER), HEADERS)
    file = base_name(F.col("path"))
    return conform(
        rows.withColumns(
            {"source_file": file, "source_month": stem(file), "load_date": stamp(run_ts)}
        ),
        EXPENSE_SHEET,
    )


def book_errors(decoded: DataFrame) -> DataFrame:
    """The files that were left out, and why."""
    bad = decoded.where("read_error IS NOT NULL")
    return bad.select(base_name(F.col("path")).alias("source_file"), "read_error")


def read_expense_books(spark: SparkSession, folder: str, run_ts: datetime) -> DataFrame:
    """Expense rows of every readable workbook."""
    return expense_rows(scan_workbooks(spark, folder), run_ts)


def unreadable_books(spark: SparkSession, folder: str) -> DataFrame:
    """The workbooks that ``read_expense_books`` leaves out, and why."""
    return book_errors(scan_workbooks(spark, folder))
