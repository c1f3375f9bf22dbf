"""Spreadsheet files (.xlsx) as raw text rows.

Spark lists and distributes the files and a small helper walks one sheet inside
a task, so the work grows with the number of files. The format itself limits a
sheet to 1,048,576 rows; the helper streams them and hands over short batches.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

BATCH_ROWS = 5_000

# XML namespaces of the format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def read_workbooks(spark: SparkSession, path: str, sheet: str, columns: dict[str, str],
                   lenient: bool = False) -> DataFrame:
    """Rows of ``sheet`` in every workbook under ``path``, all cells as text.

    ``columns`` maps output names to the headings in the sheet's first filled
    row. ``_path`` and ``_row`` say where a row stands. A file without the sheet
    and a sheet without a heading fail the read; if ``lenient``, the one gives no
    rows and the other NULL.
    """
    names, headings = list(columns), list(columns.values())
    schema = ", ".join(["_path string", "_row bigint", *[f"`{name}` string" for name in names]])

    def parse(files: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in files:
            for path, content in zip(pdf["path"], pdf["content"]):
                batch = []
                for number, cells in sheet_records(content, sheet, headings, lenient):
                    batch.append((path, number, *cells))
                    if len(batch) == BATCH_ROWS:
                        yield pd.DataFrame(batch, columns=["_path", "_row", *names])
                        batch = []
                if batch:
                    yield pd.DataFrame(batch, columns=["_path", "_row", *names])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path)
    return files.select("path", "content").mapInPandas(parse, schema)


def sheet_records(content: bytes, sheet: str, headings: Sequence[str],
                  lenient: bool = False) -> Iterator[tuple[int, list[str | None]]]:
    """Row number and the cells under ``headings`` for each filled row below them."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        member = _sheet_member(book, sheet)
        if member is None:
            if not lenient:
                raise ValueError(f"no sheet {sheet!r}")
            return
        shared = _shared_strings(book)
        places: dict[str, int] | None = None
        with book.open(member) as stream:
            for number, cells in _rows(stream, shared):
                if not any(value.strip() for value in cells.values()):
                    continue
                if places is None:
                    places = {value.strip(): column for column, value in cells.items()}
                    missing = [heading for heading in headings if heading not in places]
                    if missing and not lenient:
                        raise ValueError(f"sheet {sheet!r} has no headings {missing}")
                    continue
                yield number, [cells.get(places.get(heading, -1)) for heading in headings]


def _sheet_member(book: zipfile.ZipFile, sheet: str) -> str | None:
    for node in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{MAIN}sheet"):
        if node.get("name") == sheet:
            for link in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")):
                if link.get("Id") == node.get(RELATION):
                    target = link.get("Target")
                    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    return None


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    strings = []
    with book.open("xl/sharedStrings.xml") as stream:
        for _, node in ElementTree.iterparse(stream):
            if node.tag == f"{MAIN}si":
                strings.append(_text(node))
                node.clear()
    return strings


def _rows(stream, shared: list[str]) -> Iterator[tuple[int, dict[int, str]]]:
    number = 0
    for _, node in ElementTree.iterparse(stream):
        if node.tag != f"{MAIN}row":
            continue
        number = int(node.get("r", number + 1))
        cells: dict[int, str] = {}
        column = 0
        for cell in node.iter(f"{MAIN}c"):
            column = _column(cell.get("r")) if cell.get("r") else column + 1
            value = _value(cell, shared)
            if value is not None:
                cells[column] = value
        yield number, cells
        node.clear()


def _value(cell, shared: list[str]) -> str | None:
    if cell.get("t") == "inlineStr":
        return _text(cell)
    value = cell.find(f"{MAIN}v")
    if value is None or value.text is None:
        return None
    return shared[int(value.text)] if cell.get("t") == "s" else value.text


def _text(node) -> str:
    """All text runs of a string, without its phonetic hints."""
    hints = {run for hint in node.iter(f"{MAIN}rPh") for run in hint.iter(f"{MAIN}t")}
    return "".join(run.text or "" for run in node.iter(f"{MAIN}t") if run not in hints)


def _column(reference: str) -> int:
    number = 0
    for letter in re.match("[A-Z]+", reference).group():
        number = number * 26 + ord(letter) - ord("A") + 1
    return number
