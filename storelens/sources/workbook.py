"""Reading .xlsx workbooks inside tasks.

One workbook is one record. A sheet has at most about a million rows, is read as a stream and
handed on in chunks, so a task's memory is bounded by a file, not by the number of files.
"""

from __future__ import annotations

import datetime as dt
import gc
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame

from ..functions.joins import join_dimension

CHUNK_ROWS = 5000
READ_BYTES = 1 << 16
KNOWN_CELLS = 100_000  # cells of a sheet kept with their values

# XML namespaces, and the built-in number formats that show dates.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
ROW, C, V, T = (f"{MAIN[1:]}{name}" for name in ("row", "c", "v", "t"))  # as the sheet parser names them
# Rows as most programs write them: a row with its number, cells with their place first. A ``>``, an entity or a control
# character in a text is left to the parser.
PLAIN_ROW = re.compile(r'<row r="([1-9][0-9]*)"(?: spans="[0-9: ]*")?>')
PLAIN_CELL = re.compile(  # what follows the place
    r'(?: s="([0-9]+)")?(?: t="([a-zA-Z]+)")?(?:/>|>(?:<v>([^<>&\x00-\x1f]*)</v>'
    r'|<is><t(?: xml:space="preserve")?>([^<>&\x00-\x1f]*)</t></is>)?</c>)')
PLAIN_HEAD = re.compile(rb'(?:<\?xml version="1.0"(?: encoding="(?:UTF|utf)-8")?(?: standalone="yes")?\?>\s*)?'
                        rb'<worksheet xmlns="%s"[^!]*<sheetData>' % re.escape(MAIN[1:-1].encode()))
DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])

CELL_TYPE = pa.struct([("kind", pa.string()), ("text", pa.string())])
ROW_SCHEMA = pa.schema([
    ("path", pa.string()), ("store_id", pa.string()), ("sheet_type", pa.string()), ("sheet", pa.string()),
    ("row_no", pa.int64()), ("cells", pa.map_(pa.string(), CELL_TYPE)), ("error", pa.string())])
ROW_DDL = ("path string, store_id string, sheet_type string, sheet string, row_no bigint, "
           "cells map<string,struct<kind:string,text:string>>, error string")


class Workbook:
    """The parts of a workbook that carry cell values."""

    def __init__(self, content: bytes):
        self.zip = zipfile.ZipFile(io.BytesIO(content))
        links = {r.get("Id"): r.get("Target") for r in self._xml("xl/_rels/workbook.xml.rels")}
        book = self._xml("xl/workbook.xml")
        props = book.find(f"{MAIN}workbookPr")
        self.epoch = (dt.datetime(1904, 1, 1) if props is not None and props.get("date1904") in ("1", "true")
                      else dt.datetime(1899, 12, 30))
        self.sheets = {}
        for s in book.iter(f"{MAIN}sheet"):
            target = links[s.get(RELATION_ID)]
            self.sheets[s.get("name")] = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        self._texts: list[str] | None = None
        self._date_styles: set[int] | None = None

    def _xml(self, name: str) -> ElementTree.Element:
        return ElementTree.fromstring(self.zip.read(name))

    def texts(self) -> list[str]:
        if self._texts is None:
            self._texts = []
            if "xl/sharedStrings.xml" in self.zip.namelist():
                for item in self._xml("xl/sharedStrings.xml").iter(f"{MAIN}si"):
                    self._texts.append("".join(t.text or "" for t in item.iter(f"{MAIN}t")))
        return self._texts

    def date_styles(self) -> set[int]:
        if self._date_styles is None:
            self._date_styles = set()
            if "xl/styles.xml" in self.zip.namelist():
                styles = self._xml("xl/styles.xml")
                dates = set(DATE_FORMATS)
                for f in styles.iter(f"{MAIN}numFmt"):
                    code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode", ""))
                    if re.search(r"[ymdhs]", code, re.IGNORECASE):
                        dates.add(int(f.get("numFmtId")))
                formats = styles.find(f"{MAIN}cellXfs")
                for i, xf in enumerate(formats if formats is not None else ()):
                    if int(xf.get("numFmtId", 0)) in dates:
                        self._date_styles.add(i)
        return self._date_styles

    def cell(self, kind: str, style: str, value: str) -> tuple[str, str] | None:
        """Kind and text of a cell with its value as written."""
        if not value or kind == "e":
            return None
        if kind == "s":
            return "s", self.texts()[int(value)]
        if kind == "str":
            return "s", value
        if kind == "b":
            return "b", "true" if value == "1" else "false"
        if kind == "d":
            return "d", value
        number = float(value)
        if int(style) in self.date_styles():
            at = self.epoch + dt.timedelta(microseconds=round(number * 86_400_000_000))
            return "d", at.isoformat(sep=" ", timespec="microseconds" if at.microsecond else "seconds")
        return "n", str(int(number)) if number.is_integer() and abs(number) < 1e15 else repr(number)

    def rows(self, sheet: str) -> Iterator[dict[int, tuple[str, str] | None]]:
        """Rows from the first on, empty ones included, as column number to cell.

        Runs of plainly written rows are taken apart by two patterns; the first row of another form and all after it go
        through the XML parser, as do the beginning and the end of the sheet. No tree is built.
        """
        found = _Rows(self)
        with self.zip.open(self.sheets[sheet]) as stream:
            pending = b""
            while data := stream.read(READ_BYTES):
                pending = found.read(pending + data)
                yield from found.taken()
            found.parse(pending)
            found.parse(b"", True)
            yield from found.taken()


class _Rows:
    """The rows of a sheet that is read piece by piece."""

    def __init__(self, book: Workbook):
        self.book, self.ready, self.broken = book, [], None
        self.plain, self.begun = True, False
        self.expected, self.column, self.cells = 1, 0, {}
        self.attributes, self.value, self.inline, self.text = {}, None, "", ""
        self.columns: dict[str, int] = {}
        self.known: dict[object, tuple | None] = {}  # by what is written
        self.parser = expat.ParserCreate(namespace_separator="}")
        self.parser.buffer_text = True
        self.parser.StartElementHandler, self.parser.EndElementHandler = self._start, self._end
        self.parser.CharacterDataHandler = self._characters

    def taken(self) -> Iterator[dict]:
        """The rows read since the last call, then the error that ended them."""
        yield from self.ready
        self.ready.clear()
        if self.broken:
            raise self.broken

    def parse(self, data: bytes, last: bool = False) -> None:
        try:
            if not self.broken:
                self.parser.Parse(data, last)
        except expat.ExpatError as e:
            self.broken = ElementTree.ParseError(str(e))

    def read(self, data: bytes) -> bytes:
        """Read whole rows; what follows the last one is handed back."""
        if self.plain and not self.begun:
            at = data.find(b"<row")
            if at < 0:
                return data
            self.begun, self.plain = True, PLAIN_HEAD.fullmatch(data, 0, at) is not None
            self.parse(data[:at])
            data = data[at:]
        if self.plain:
            end = data.rfind(b"</row>") + 6
            if end < 6:
                return data
            data = self._plain(data[:end]) + data[end:]
            if self.plain:
                return data
        self.parse(data)
        return b""

    def _plain(self, block: bytes) -> bytes:
        """Take plain rows apart; what is left from the first row of another form on."""
        try:
            rows = block.decode().split("</row>")
        except UnicodeDecodeError:
            self.plain = False
            return block
        for i, row in enumerate(rows[:-1]):
            cells = self._plain_row(row)
            if cells is None:
                self.plain = False
                return "</row>".join(rows[i:]).encode()
            self.cells = cells
            self._finish()
        return b""

    def _plain_row(self, row: str) -> dict | None:
        """The cells of a row of the plain form, none for a row of another form."""
        begin, *written = row.split('<c r="')
        found = PLAIN_ROW.fullmatch(begin)
        if found is None:
            return None
        number, cells, known, columns = found[1], {}, self.known, self.columns
        digits = len(number)
        for one in written:
            place, _, rest = one.partition('"')
            column = columns.get(place[:-digits]) or self._column(place[:-digits])
            if not column or place[-digits:] != number:
                return None
            if rest in known:
                cells[column] = known[rest]
                continue
            found = PLAIN_CELL.fullmatch(rest)
            if found is None:
                return None
            cells[column] = self._know(rest, *found.groups())
        self._begin(number)
        return cells

    def _begin(self, at: str | None) -> None:
        for _ in range(self.expected, int(at or self.expected)):
            self._finish()
        self.cells, self.column = {}, 0

    def _finish(self) -> None:
        self.ready.append(self.cells)
        self.cells = {}
        self.expected += 1

    def _column(self, letters: str) -> int:
        """The column's number, 0 where no letters name it."""
        if re.fullmatch(r"[A-Z]+", letters):
            self.columns[letters] = column_number(letters)
        return self.columns.get(letters, 0)

    def _know(self, key, style: str | None, kind: str | None, value: str | None, inline: str | None) -> tuple | None:
        """The cell of what is written, kept for the next one written so."""
        if len(self.known) >= KNOWN_CELLS:
            self.known.clear()
        self.known[key] = cell = (("s", inline or "") if kind == "inlineStr"
                                  else self.book.cell(kind or "n", style or "0", value or ""))
        return cell

    def _start(self, name: str, attributes: dict) -> None:
        if name == C:
            self.attributes, self.value, self.inline = attributes, None, ""
        elif name == V or name == T:
            self.text = ""
        elif name == ROW:
            self._begin(attributes.get("r"))

    def _end(self, name: str) -> None:
        if name == V:
            self.value = self.text if self.value is None else self.value
        elif name == T:
            self.inline += self.text
        elif name == C:
            get = self.attributes.get
            key = get("s"), get("t"), self.value, self.inline
            self.column = self._column(re.match(r"[A-Z]*", get("r", ""))[0]) or self.column + 1
            self.cells[self.column] = self.known[key] if key in self.known else self._know(key, *key)
        elif name == ROW:
            self._finish()

    def _characters(self, data: str) -> None:
        self.text += data


def column_number(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + ord(ch) - 64
    return n


def _table(book: Workbook, sheet: str, skip_rows: int, header_row: int) -> Iterator[list]:
    """The header's names, then the cells under them of each row that has any value."""
    header: dict[int, str] | None = None
    for i, cells in enumerate(book.rows(sheet)):
        if i < skip_rows + header_row:
            continue
        if header is None:
            header = {n: cell[1] for n, cell in cells.items() if cell and cell[1] != ""}
            names = {name: n for n, name in header.items()}  # the last column of a name
            yield list(names)
        elif any([cells.get(n) for n in header]):
            yield [cells.get(n) for n in names.values()]
    if header is None:
        yield []


def table_rows(book: Workbook, sheet: str, skip_rows: int, header_row: int) -> Iterator[dict[str, tuple | None]]:
    """The header (all values null) and then each row that has any value, by column name."""
    rows = _table(book, sheet, skip_rows, header_row)
    names = next(rows)
    yield dict.fromkeys(names)
    for cells in rows:
        yield dict(zip(names, cells))


def _batch(key: tuple, first: int, rows: int, names: list[str], cells: list[tuple | None]) -> pa.RecordBatch:
    """``rows`` rows from number ``first`` on, their cells one after the other."""
    parts = [pa.array([c and c[i] for c in cells], pa.string()) for i in (0, 1)]
    values = pa.StructArray.from_arrays(parts, fields=list(CELL_TYPE), mask=pa.array([c is None for c in cells], pa.bool_()))
    offsets = pa.array(range(0, len(cells) + 1, len(names)) if names else [0] * (rows + 1), pa.int32())
    maps = pa.MapArray.from_arrays(offsets, pa.array(names * rows, pa.string()), values)
    arrays = [*[pa.repeat(pa.scalar(k, pa.string()), rows) for k in key],
              pa.array(range(first, first + rows), pa.int64()), maps, pa.nulls(rows, pa.string())]
    return pa.RecordBatch.from_arrays(arrays, schema=ROW_SCHEMA)


def _batches(book: Workbook, key: tuple, skip_rows: int, header_row: int) -> Iterator[pa.RecordBatch]:
    rows = _table(book, key[-1], skip_rows, header_row)
    names = next(rows)
    cells, first, n = [None] * len(names), 0, 1  # the header is row 0, without values
    try:
        for row in rows:
            if n == CHUNK_ROWS:
                yield _batch(key, first, n, names, cells)
                cells, first, n = [], first + n, 0
            cells += row
            n += 1
    except Exception:
        yield _batch(key, first, n, names, cells)  # the rows before the error
        raise
    yield _batch(key, first, n, names, cells)


def _sheet_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths, names, errors = [], [], []
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            try:
                found, error = list(Workbook(content.as_py()).sheets), None
            except Exception as e:
                found, error = [None], f"{type(e).__name__}: {e}"
            for name in found or [None]:
                paths.append(path)
                names.append(name)
                errors.append(error)
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), pa.array(names, pa.string()), pa.array(errors, pa.string())],
            names=["path", "sheet", "error"])


def sheet_names(files: DataFrame) -> DataFrame:
    """(path, sheet, error) of files with (path, content)."""
    return files.select("path", "content").mapInArrow(_sheet_names, "path string, sheet string, error string")


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    limits = gc.get_threshold()
    gc.set_threshold(200_000, *limits[1:])  # cells are many small objects that refer to nothing: look for cycles rarely
    try:
        for batch in batches:
            columns = {n: batch.column(n) for n in batch.schema.names}
            for i in range(batch.num_rows):
                at = {n: columns[n][i].as_py() for n in ("path", "store_id", "sheet_type", "sheet", "skip_rows", "header_row")}
                key = (at["path"], at["store_id"], at["sheet_type"], at["sheet"])
                try:
                    yield from _batches(Workbook(columns["content"][i].as_py()), key, at["skip_rows"], at["header_row"])
                except Exception as e:
                    error = dict(zip(ROW_SCHEMA.names, (*key, -1, None, f"{type(e).__name__}: {e}")))
                    yield pa.RecordBatch.from_pylist([error], ROW_SCHEMA)
    finally:
        gc.set_threshold(*limits)


def decode(files: DataFrame, picks: DataFrame) -> DataFrame:
    """Sheet rows of the picked sheets: row 0 is the header; row -1 carries a decoding error."""
    chosen = picks.where("sheet is not null").select(
        "path", "store_id", "sheet_type", "sheet", "skip_rows", "header_row")
    # the contents stay where they are read as long as the picks are few enough to be sent there
    return join_dimension(files.select("path", "content"), chosen, ["path"], "inner").mapInArrow(_decode, ROW_DDL)
