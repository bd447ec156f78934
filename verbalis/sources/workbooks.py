"""Spreadsheet files as tables: Spark lists and ships the workbooks, each task unpacks its own."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as St

ROWS_PER_BATCH = 2_000
ESCAPE = re.compile(r"_x([0-9A-Fa-f]{4})_")


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _text(node) -> str:
    """Text of a string cell: the runs of rich text joined, phonetic hints left out."""
    parts = []
    for child in node:
        name = _local(child.tag)
        if name == "t":
            parts.append(child.text or "")
        elif name == "r":
            parts.extend(t.text or "" for t in child if _local(t.tag) == "t")
    return ESCAPE.sub(lambda m: chr(int(m.group(1), 16)), "".join(parts))


def _column(reference: str) -> int:
    number = 0
    for letter in reference:
        if not letter.isalpha():
            break
        number = number * 26 + ord(letter.upper()) - 64
    return number - 1


def _first_sheet(book: zipfile.ZipFile) -> str:
    """The part of the first sheet in the order of the workbook, or the lowest numbered one if the order is not given."""
    names = set(book.namelist())
    if {"xl/workbook.xml", "xl/_rels/workbook.xml.rels"} <= names:
        links = {r.get("Id"): r.get("Target", "") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        for node in ElementTree.fromstring(book.read("xl/workbook.xml")).iter():
            if _local(node.tag) == "sheet":
                link = next((v for k, v in node.attrib.items() if _local(k) == "id"), None)
                target = links.get(link, "")
                part = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
                if part in names:
                    return part
    sheets = [n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)]
    return min(sheets, key=lambda n: int(re.sub(r"\D", "", n)))


def sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """Rows of the first sheet as strings, read as a stream."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = book.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            with book.open("xl/sharedStrings.xml") as part:
                for _, node in ElementTree.iterparse(part):
                    if _local(node.tag) == "si":
                        shared.append(_text(node))
                        node.clear()
        with book.open(_first_sheet(book)) as part:
            for _, node in ElementTree.iterparse(part):
                if _local(node.tag) != "row":
                    continue
                row: list[str | None] = []
                for i, cell in enumerate(node):
                    at = _column(cell.get("r", "")) if cell.get("r") else i
                    row.extend([None] * (at + 1 - len(row)))
                    kind = cell.get("t")
                    value = next((c.text for c in cell if _local(c.tag) == "v"), None)
                    if kind == "inlineStr":
                        inline = next((c for c in cell if _local(c.tag) == "is"), None)
                        row[at] = None if inline is None else _text(inline)
                    elif kind == "s" and value is not None:
                        row[at] = shared[int(value)]
                    else:
                        row[at] = value
                yield row
                node.clear()


def parse_workbooks(files: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of many workbooks (column ``content``) as string columns. The first row of each names its columns."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = sheet_rows(content)
                header = next(rows, [])
                missing = [c for c in columns if c not in header]
                if missing:
                    raise ValueError(f"workbook has no column {missing[0]!r}")
                places = [header.index(c) for c in columns]
                chunk = []
                for row in rows:
                    chunk.append([row[p] if p < len(row) else None for p in places])
                    if len(chunk) == ROWS_PER_BATCH:
                        yield pd.DataFrame(chunk, columns=columns)
                        chunk = []
                if chunk:
                    yield pd.DataFrame(chunk, columns=columns)

    schema = St.StructType([St.StructField(c, St.StringType()) for c in columns])
    return files.select("content").mapInPandas(unpack, schema)


def read_workbooks(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """One xlsx file or a folder of them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path)
    return parse_workbooks(files, columns)
