"""Small .xlsx files for the checks and tests of the reader."""

from __future__ import annotations

import datetime as dt
import io
import zipfile
from collections.abc import Iterable, Iterator
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
_NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def _letters(n: int) -> str:
    out = ""
    while n:
        n, rest = divmod(n - 1, 26)
        out = chr(65 + rest) + out
    return out


def _cell(ref: str, value, shared: dict[str, int]) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (dt.datetime, dt.date)):
        at = value if isinstance(value, dt.datetime) else dt.datetime.combine(value, dt.time())
        days = (at - dt.datetime(1899, 12, 30)) / dt.timedelta(days=1)
        return f'<c r="{ref}" s="1"><v>{days!r}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{ref}"><v>{value!r}</v></c>'
    if len(value) % 2:
        return f'<c r="{ref}" t="inlineStr"><is><t>{escape(value)}</t></is></c>'
    return f'<c r="{ref}" t="s"><v>{shared.setdefault(value, len(shared))}</v></c>'


def _workbook(sheets: dict[str, Iterable[str]], shared: Iterable[str]) -> bytes:
    """A workbook from the rows of its sheets as XML and the shared texts."""
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as z:
        for i, rows in enumerate(sheets.values(), 1):
            z.writestr(f"xl/worksheets/sheet{i}.xml", f"{_HEAD}<worksheet {_NS}><sheetData>{''.join(rows)}</sheetData></worksheet>")
        names = "".join(f'<sheet name={quoteattr(n)} sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'{_HEAD}<workbook {_NS} xmlns:r="{_REL}"><sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{i}" Type="{_REL}/worksheet" Target="worksheets/sheet{i}.xml"/>'
                        for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'{_HEAD}<Relationships xmlns='
                   f'"http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        z.writestr("xl/styles.xml", f'{_HEAD}<styleSheet {_NS}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        texts = "".join(f"<si><t xml:space=\"preserve\">{escape(t)}</t></si>" for t in shared)
        z.writestr("xl/sharedStrings.xml", f"{_HEAD}<sst {_NS}>{texts}</sst>")
    return buffer.getvalue()


def _rows(rows: list[list], shared: dict[str, int]) -> Iterator[str]:
    for n, row in enumerate(rows, 1):
        yield f'<row r="{n}">' + "".join(_cell(f"{_letters(c)}{n}", v, shared) for c, v in enumerate(row, 1)) + "</row>"


def workbook_bytes(sheets: dict[str, list[list]]) -> bytes:
    """A workbook with the given rows per sheet; None cells are left out."""
    shared: dict[str, int] = {}
    body = {name: list(_rows(rows, shared)) for name, rows in sheets.items()}
    return _workbook(body, shared)


def _cells(letters: str, values: pa.Array, at: pa.Array, shared: dict[str, int]) -> pa.Array:
    """The cells of a column of dates, numbers or texts at the given row numbers, written as ``_cell`` does."""
    join, begin = pc.binary_join_element_wise, f'<c r="{letters}'
    if pa.types.is_date(values.type):
        days = pc.cast(pc.add(pc.cast(values, pa.int32()), 25569), pa.string())
        cells = join(begin, at, '" s="1"><v>', days, "</v></c>", "")
    elif not pa.types.is_string(values.type):
        cells = join(begin, at, '"><v>', pc.cast(values, pa.string()), "</v></c>", "")
    else:
        odd = pc.equal(pc.bit_wise_and(pc.utf8_length(values), 1), 1)
        even = pc.if_else(odd, None, values).dictionary_encode()
        numbers = pa.array([str(shared.setdefault(t, len(shared))) for t in even.dictionary.to_pylist()], pa.string())
        text = values
        for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            text = pc.replace_substring(text, plain, entity)
        cells = pc.if_else(odd, join(begin, at, '" t="inlineStr"><is><t>', text, "</t></is></c>", ""),
                           join(begin, at, '" t="s"><v>', pc.take(numbers, even.indices), "</v></c>", ""))
    return pc.fill_null(cells, "")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId()
    for i, batch in enumerate(b for b in batches if b.num_rows):
        shared: dict[str, int] = {}
        head = list(_rows([["Title"], [], batch.schema.names], shared))
        at = pc.cast(pa.array(range(len(head) + 1, len(head) + 1 + batch.num_rows)), pa.string())
        cells = [_cells(_letters(n), column, at, shared) for n, column in enumerate(batch.columns, 1)]
        body = pc.binary_join_element_wise('<row r="', at, '">', *cells, "</row>", "")
        content = _workbook({"Cover": _rows([["Daily report"]], shared), "Sales_2024": head + body.to_pylist()}, shared)
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"file:/in/store_pack_{task}-{i}.xlsx"]), pa.array([content], pa.binary())],
            names=["path", "content"])


def pack(sales: DataFrame) -> DataFrame:
    """(path, content): one workbook per Arrow batch of sales, so a file's size is bounded; the columns are written whole."""
    return sales.mapInArrow(_pack, "path string, content binary")
