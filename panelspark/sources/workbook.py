"""Yearly sales workbooks (xlsx) as one frame.

Files come through Spark's binaryFile reader, so any file system that Spark reads will do; they
are read in parallel by the executors and a lost task re-reads just its files. The driver sees the
file names only.
"""

from __future__ import annotations

import functools
import io
import itertools
import os
import re
import zipfile
from xml.etree import ElementTree

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from panelspark.config import SALES_HEADERS
from panelspark.schemas import SALES

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_ROW, _CELL, _VALUE, _TEXT = (f"{_NS}{tag}" for tag in ("row", "c", "v", "t"))
_LETTERS = re.compile("[A-Z]+")
_HEAD_BYTES, _BLOCK_BYTES = 1 << 20, 1 << 16
_DATA_START, _DATA_END, _ROW_END = "<sheetData>", "</sheetData></worksheet>", "</row>"
_ROW_START = re.compile(r'<row((?: [\w:.-]+="[^"<]*")*)>')
_ROW_NUMBER = re.compile(r' r="([^"]*)"')
# Column letters, kind, value and inline text of a cell without anything else in it.
_PLAIN_CELL = re.compile(
    r'<c(?: r="([A-Z]+)\d+")?(?: s="\d+")?(?: t="(\w+)")?(?:/>|>'
    r'(?:<v>([^<]*)</v>|<is><t(?: xml:space="preserve")?>([^<]*)</t></is>)?</c>)'
)
HEADER_ROWS_SKIPPED = 2
ROWS_PER_BATCH = 10_000
_ORDINAL_STRIDE = 1 << 32  # file position in the high half, row in the low half


def read_workbooks(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all workbooks that a path or glob matches; no match raises AnalysisException.

    `row_ordinal` orders rows by file name, then by place in the sheet.
    """
    files = spark.read.format("binaryFile").load(path)
    names = sorted(r["path"] for r in files.select("path").collect())
    index = {name: i for i, name in enumerate(names)}

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield from workbook_batches(io.BytesIO(content.as_py()), index[name])

    return files.select("path", "content").mapInArrow(run, SALES)


def workbook_batches(file, index: int, schema: T.StructType = SALES):
    """Typed rows of a workbook's first sheet in batches, by the names in its header row; only the
    columns of `schema` are converted."""
    rows = sheet_rows(file)
    for _ in range(HEADER_ROWS_SKIPPED):
        next(rows, None)
    header = number_repeats(next(rows, []))
    place = {SALES_HEADERS[h]: i for i, h in enumerate(header) if h in SALES_HEADERS}
    arrow = to_arrow_schema(schema)
    numbered = enumerate(rows, index * _ORDINAL_STRIDE)
    filled = ((n, cells) for n, cells in numbered if cells.count(None) < len(cells))
    while chunk := list(itertools.islice(filled, ROWS_PER_BATCH)):
        ordinals, lines = zip(*chunk)
        columns = [
            pa.array(ordinals) if f.name == "row_ordinal"
            else _typed(_texts(lines, place.get(f.name)), f.dataType)
            for f in schema
        ]
        yield pa.RecordBatch.from_arrays(
            [c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow
        )


def _texts(lines, i: int | None) -> pa.Array:
    if i is None:
        return pa.nulls(len(lines), pa.string())
    return pa.array([c[i] if i < len(c) else None for c in lines], pa.string())


def _typed(texts: pa.Array, kind: T.DataType) -> pa.Array:
    """Texts of cells to the column's type; a non-numeric token in a number column is missing."""
    if isinstance(kind, T.StringType):
        return texts
    try:
        numbers = texts.cast(pa.float64())
    except pa.ArrowInvalid:
        numbers = pa.array([_number(t) for t in texts.to_pylist()], pa.float64())
    missing = pa.scalar(None, pa.float64())
    numbers = pc.if_else(pc.is_nan(numbers), missing, numbers)
    if isinstance(kind, T.DoubleType):
        return numbers
    whole = pc.if_else(pc.less(pc.abs(numbers), 2.0**63), numbers, missing)
    return pc.trunc(whole).cast(pa.int64())


def _number(text: str | None) -> float | None:
    try:
        return None if text is None else float(text)
    except ValueError:
        return None


def number_repeats(header) -> list[str]:
    """Repeated header names get .1, .2, ... in order of appearance."""
    seen: dict[str, int] = {}
    names = []
    for h in header:
        h = "" if h is None else h.strip()
        n = seen.get(h, 0)
        seen[h] = n + 1
        names.append(f"{h}.{n}" if n else h)
    return names


def sheet_rows(file):
    """Rows of the first sheet as lists of text, None for an empty cell."""
    with zipfile.ZipFile(file) as book:
        shared = _shared_strings(book)
        with book.open(_first_sheet(book)) as sheet:
            expected = 1
            for number, cells in _numbered_cells(sheet, shared):
                number = expected if number is None else int(number)
                for _ in range(expected, number):
                    yield []
                yield cells
                expected = number + 1


def _numbered_cells(sheet, shared):
    """(number or None, cells) of each row. Rows of plain cells are cut by a pattern, which takes a
    third of a parser's time; any other row, and what cannot be cut into rows, is parsed."""
    blocks = iter(lambda: sheet.read(_BLOCK_BYTES), b"")
    head, start, rest = sheet.read(_HEAD_BYTES).partition(_DATA_START.encode())
    head += start
    if not start or not _is_plain(head):
        yield from _parsed(itertools.chain([head + rest], blocks), shared)
        return
    pending = b""
    for block in itertools.chain([rest], blocks):
        pending += block
        if b"<!" in pending or b"<?" in pending or len(pending) > 2 * _HEAD_BYTES:
            yield from _parsed(itertools.chain([head + pending], blocks), shared)
            return
        rows, end, pending = pending.rpartition(_ROW_END.encode())
        for row in rows.decode().split(_ROW_END) if end else ():
            found = _plain_row(row, shared)
            if found is None:
                text = f"{row}{_ROW_END}{_DATA_END}"
                yield from _parsed([head, text.encode()], shared)
            else:
                yield found
    yield from _parsed([head + pending], shared)


def _is_plain(head: bytes) -> bool:
    """Whether unprefixed names are those of a sheet, in UTF-8."""
    encoding = re.search(rb"""encoding=["']([^"']*)""", head)
    if encoding and encoding.group(1).lower() != b"utf-8":
        return False
    try:
        root = ElementTree.fromstring(head + _DATA_END.encode())
    except ElementTree.ParseError:
        return False
    return root.find(f"{_NS}sheetData") is not None


def _plain_row(row: str, shared):
    start = _ROW_START.match(row)
    if start is None or "xmlns" in start.group() or "&" in row or "\r" in row:
        return None
    parts = _PLAIN_CELL.split(row[start.end():])
    if any(parts[::5]):
        return None
    cells: list = []
    for column, kind, value, text in zip(*(parts[i::5] for i in range(1, 5))):
        if column:
            cells.extend([None] * (_column(column) - len(cells)))
        if kind == "inlineStr":
            cells.append(text or "")
        elif not value:
            cells.append(None)
        else:
            cells.append(shared[int(value)] if kind == "s" else value)
    number = _ROW_NUMBER.search(start.group(1))
    return number and number.group(1), cells


def _parsed(blocks, shared):
    """(number or None, cells) of the rows in the text of a sheet."""
    parser = ElementTree.XMLPullParser()
    for block in itertools.chain(blocks, [None]):
        if block is None:
            parser.close()
        else:
            parser.feed(block)
        for _, row in parser.read_events():
            if row.tag == _ROW:
                yield row.get("r"), _row_cells(row, shared)
                row.clear()


def _first_sheet(book: zipfile.ZipFile) -> str:
    sheets = [n for n in book.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)]
    return min(sheets, key=lambda n: int(re.findall(r"\d+", os.path.basename(n))[0]))


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    with book.open("xl/sharedStrings.xml") as f:
        items = ElementTree.parse(f).getroot().iter(f"{_NS}si")
        return ["".join(t.text or "" for t in si.iter(_TEXT)) for si in items]


def _row_cells(row, shared) -> list:
    cells: list = []
    for cell in row.iter(_CELL):
        reference = cell.get("r")
        if reference:
            cells.extend([None] * (_column_index(reference) - len(cells)))
        cells.append(_cell_text(cell, shared))
    return cells


@functools.cache
def _column(letters: str) -> int:
    index = 0
    for letter in letters:
        index = index * 26 + ord(letter) - ord("A") + 1
    return index - 1


def _column_index(reference: str) -> int:
    return _column(_LETTERS.match(reference).group())


def _cell_text(cell, shared):
    kind = cell.get("t")
    if kind == "inlineStr":
        return "".join([t.text or "" for t in cell.iter(_TEXT)])
    value = cell.find(_VALUE)
    if value is None or value.text is None:
        return None
    return shared[int(value.text)] if kind == "s" else value.text
