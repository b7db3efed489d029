"""Raw files for the tests: workbooks and telemetry logs, built with the standard library."""

from __future__ import annotations

import json
import zipfile
from pathlib import Path
from xml.sax.saxutils import escape

from cargolake.functions.expenses import SHEET_HEADERS

HEADERS = list(SHEET_HEADERS)
NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def workbook(path: Path, rows: list[list], headers: list[str] = HEADERS, inline: bool = False) -> None:
    """One sheet; texts as shared or inline strings, numbers as numbers, None as a missing cell."""
    shared: list[str] = []

    def cell(r: int, c: int, value) -> str:
        ref = f"{chr(65 + c)}{r}"
        if value is None:
            return ""
        if isinstance(value, (int, float)):
            return f'<c r="{ref}"><v>{value}</v></c>'
        if inline:
            return f'<c r="{ref}" t="inlineStr"><is><t>{escape(value)}</t></is></c>'
        if value not in shared:
            shared.append(value)
        return f'<c r="{ref}" t="s"><v>{shared.index(value)}</v></c>'

    lines = [headers, *rows]
    body = "".join(
        f'<row r="{i}">' + "".join(cell(i, c, v) for c, v in enumerate(line)) + "</row>"
        for i, line in enumerate(lines, start=1)
    )
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {NS} xmlns:r="{REL}"><sheets><sheet name="S" sheetId="1" r:id="rId7"/></sheets></workbook>')
        z.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            f'<Relationship Id="rId7" Type="{REL}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        )
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {NS}><sheetData>{body}</sheetData></worksheet>")
        if not inline:
            # every text as two runs with a phonetic hint, which is not part of the text
            items = "".join(
                f"<si><r><t xml:space=\"preserve\">{escape(s[:1])}</t></r><r><t xml:space=\"preserve\">{escape(s[1:])}</t></r><rPh><t>x</t></rPh></si>"
                for s in shared
            )
            z.writestr("xl/sharedStrings.xml", f"<sst {NS}>{items}</sst>")


def point(ts, spd=10.0, car="А1", **other) -> dict:
    # The field names of a telemetry point.
    return {
        "ts": ts, "loc": {"lat": 55.7, "lon": 37.6}, "spd": spd, "h": 5, "acc": {"lon": 0.1, "lat": 0.2},
        "eng": {"rpm": 900, "thr": 10, "tmp": 80}, "flags": {"abs": True, "belt": True, "doors": 0, "car_id": car},
        "gps": {"sat": 8, "hdop": 1.0}, **other,
    }


def log(path: Path, lines: list) -> None:
    """A telemetry log; strings go in as they are."""
    path.parent.mkdir(parents=True, exist_ok=True)
    text = "\n".join(x if isinstance(x, str) else json.dumps(x, ensure_ascii=False) for x in lines)
    path.write_text(text + "\n", encoding="utf-8")
