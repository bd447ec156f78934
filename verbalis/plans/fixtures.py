"""Workbooks made from table rows, to have something for the spreadsheet source to read."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd

CONTROL = re.compile("[\x00-\x08\x0b-\x1f￾￿]")
SHEET = "<worksheet xmlns='http://schemas.openxmlformats.org/spreadsheetml/2006/main'><sheetData>{}</sheetData></worksheet>"


def _encoded(value: str) -> str:
    guarded = re.sub(r"_(?=x[0-9A-Fa-f]{4}_)", "_x005F_", value)
    return escape(CONTROL.sub(lambda m: f"_x{ord(m.group()):04X}_", guarded))


def workbook(columns: list[str], rows) -> bytes:
    """One sheet with a header row and inline strings."""
    lines = []
    for row in [columns, *rows]:
        cells = "".join(f"<c t='inlineStr'><is><t xml:space='preserve'>{_encoded(str(v))}</t></is></c>" for v in row)
        lines.append(f"<row>{cells}</row>")
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr("xl/worksheets/sheet1.xml", SHEET.format("".join(lines)))
    return data.getvalue()


def pack_workbooks(columns: list[str]):
    """One workbook per Arrow batch."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"content": [workbook(columns, batch[columns].itertuples(index=False))]})

    return pack
