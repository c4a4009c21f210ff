"""Excel workbooks, by named tables or whole sheets, with the standard library: small look-up and report tables, on the driver."""

from __future__ import annotations

import math
import re
import zipfile
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
ERRORS = ("#N/A", "#NAME?", "#NULL!", "#NUM!", "#REF!", "#VALUE!")


class TableNotFound(Exception):
    pass


def _column(ref: str) -> int:
    n = 0
    for ch in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(ch) - 64
    return n


def _letters(n: int) -> str:
    out = ""
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def _shared(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    return ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS)]


def _cells(z: zipfile.ZipFile, name: str, shared: list[str]) -> dict[tuple[int, int], object]:
    """{(row, column), from 1: value} of one sheet's file; error cells are NaN, #DIV/0! is infinite, empty cells are ""."""
    cells = {}
    for c in ET.fromstring(z.read(name)).iter(f"{{{_NS['m']}}}c"):
        kind, v, inline = c.get("t"), c.find("m:v", _NS), c.find("m:is", _NS)
        text = "".join(t.text or "" for t in inline.iter(f"{{{_NS['m']}}}t")) if inline is not None else (v.text if v is not None else None)
        if kind == "s":
            value = shared[int(text)]
        elif kind == "e":
            value = math.inf if text == "#DIV/0!" else math.nan
        elif kind in ("str", "inlineStr"):
            value = text or ""
        else:
            value = float(text) if text else ""
        ref = c.get("r")
        cells[int(re.search(r"\d+", ref)[0]), _column(ref)] = value
    return cells


def _block(cells: dict, rows: tuple[int, int], cols: tuple[int, int]) -> list[list]:
    return [[cells.get((r, c), "") for c in range(cols[0], cols[1] + 1)] for r in range(rows[0], rows[1] + 1)]


def tables(path: str) -> dict[str, list[list]]:
    """{table: rows with the header first}"""
    out = {}
    with zipfile.ZipFile(path) as z:
        shared = _shared(z)
        for name in [n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)]:
            cells = _cells(z, name, shared)
            rels = name.replace("worksheets/", "worksheets/_rels/") + ".rels"
            for target in ([r.get("Target") for r in ET.fromstring(z.read(rels)) if r.get("Type").endswith("/table")] if rels in z.namelist() else []):
                table = ET.fromstring(z.read("xl/" + target.removeprefix("../").removeprefix("/xl/")))
                a, b = table.get("ref").split(":")
                out[table.get("displayName")] = _block(cells, tuple(int(re.search(r"\d+", x)[0]) for x in (a, b)), (_column(a), _column(b)))
    return out


def sheets(path: str) -> dict[str, list[list]]:
    """{sheet: rows from its first to its last used cell}, in the workbook's order."""
    out = {}
    with zipfile.ZipFile(path) as z:
        shared = _shared(z)
        files = {r.get("Id"): r.get("Target").removeprefix("/xl/") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ET.fromstring(z.read("xl/workbook.xml")).iter(f"{{{_NS['m']}}}sheet"):
            cells = _cells(z, "xl/" + files[sheet.get(_REL)], shared)
            rows, cols = [r for r, _ in cells], [c for _, c in cells]
            out[sheet.get("name")] = _block(cells, (min(rows), max(rows)), (min(cols), max(cols))) if cells else []
    return out


def _frame(spark: SparkSession, found: list[list]) -> DataFrame:
    """Rows with the header first; columns of numbers are doubles, others strings."""
    head, *rows = found
    numeric = [all(isinstance(r[i], float) or r[i] == "" for r in rows) and any(isinstance(r[i], float) for r in rows) for i in range(len(head))]
    data = [tuple((None if v == "" else v) if numeric[i] else ("" if v == "" else str(v)) for i, v in enumerate(r)) for r in rows]
    return spark.createDataFrame(data, ", ".join(f"`{h}` {'double' if n else 'string'}" for h, n in zip(head, numeric, strict=True)))


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One named table; TableNotFound if it isn't there."""
    found = tables(path)
    if table not in found:
        raise TableNotFound(table)
    return _frame(spark, found[table])


def read_sheet(spark: SparkSession, path: str, sheet: str | None = None, skip: int = 0) -> DataFrame:
    """One sheet (the first, if none is named), its header after `skip` used rows; TableNotFound if it isn't there or has no header."""
    found = sheets(path)
    rows = (found.get(sheet, []) if sheet else next(iter(found.values()), []))[skip:]
    if not rows:
        raise TableNotFound(sheet or "a first sheet")
    return _frame(spark, rows)


def write_tables(path: str, frames: dict[str, DataFrame]) -> None:
    """A sheet with one named table per frame; NaN and null are empty, infinite values the greatest double."""
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        sheets = list(enumerate(frames.items(), 1))
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/><Override PartName="/xl/tables/table{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.table+xml"/>' for i, _ in sheets)
        z.writestr("[Content_Types].xml", f'<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{kinds}</Types>')
        office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        z.writestr("_rels/.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{_NS["m"]}" xmlns:r="{office}"><sheets>' + "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="r{i}"/>' for i, (n, _) in sheets) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="r{i}" Type="{office}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i, _ in sheets) + "</Relationships>")
        for i, (name, df) in sheets:
            rows = [df.columns, *[list(r) for r in df.toLocalIterator()]]

            def cell(r: int, c: int, v: object) -> str:
                ref = f"{_letters(c)}{r}"
                if v is None or isinstance(v, float) and math.isnan(v):
                    return ""
                if isinstance(v, (int, float)) and not isinstance(v, bool):
                    v = math.copysign(1.7976931348623157e308, v) if isinstance(v, float) and math.isinf(v) else v
                    return f'<c r="{ref}"><v>{v!r}</v></c>'
                return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'

            body = "".join(f'<row r="{r}">' + "".join(cell(r, c, v) for c, v in enumerate(row, 1)) + "</row>" for r, row in enumerate(rows, 1))
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{_NS["m"]}" xmlns:r="{office}"><sheetData>{body}</sheetData><tableParts count="1"><tablePart r:id="t1"/></tableParts></worksheet>')
            z.writestr(f"xl/worksheets/_rels/sheet{i}.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="t1" Type="{office}/table" Target="../tables/table{i}.xml"/></Relationships>')
            ref = f"A1:{_letters(len(df.columns))}{max(2, len(rows))}"
            z.writestr(f"xl/tables/table{i}.xml", f'<table xmlns="{_NS["m"]}" id="{i}" name="{escape(name)}" displayName="{escape(name)}" ref="{ref}"><autoFilter ref="{ref}"/><tableColumns count="{len(df.columns)}">' + "".join(f'<tableColumn id="{k}" name="{escape(c)}"/>' for k, c in enumerate(df.columns, 1)) + "</tableColumns></table>")
