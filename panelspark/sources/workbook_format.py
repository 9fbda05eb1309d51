"""Sales workbooks as a Spark data source: `spark.read.format("sales_workbook")` and its writer.

    spark.dataSource.register(WorkbookFormat)
    sales = spark.read.format("sales_workbook").load("/landing/sales")           # a folder or glob
    sales.write.format("sales_workbook").mode("append").save("/landing/sales")

Every file is a partition. A schema given to the reader prunes the columns: cells of others are not
converted. The writer makes workbooks of one year and at most `ROWS_PER_WORKBOOK` rows each, under
names that readers pass over until all tasks are done; the names of a job sort by year, then in the
order of the rows written. Files are reached through Arrow's file systems (local and the usual
stores); `workbook.read_workbooks` reads from anything that Spark reads.
"""

from __future__ import annotations

import fnmatch
import io
import os
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from panelspark.config import SALES_HEADERS
from panelspark.schemas import SALES
from panelspark.sources.workbook import HEADER_ROWS_SKIPPED, number_repeats, workbook_batches

FORMAT = "sales_workbook"
PREFIX = "Sales_Ult_Cust_"
HIDDEN = "_"
ROWS_PER_WORKBOOK = 100_000  # a reader's task; spreadsheet programs take ten times as many


def _system(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path)


def workbook_files(path: str) -> list[str]:
    """The workbooks of a folder, or those that a glob in the last part of the path matches."""
    system, at = _system(path)
    folder, pattern = (at, "*.xlsx")
    if any(c in os.path.basename(at) for c in "*?["):
        folder, pattern = os.path.split(at)
    elif at.endswith(".xlsx"):
        return [at]
    found = system.get_file_info(fs.FileSelector(folder))
    return sorted(f.path for f in found if f.is_file and not f.base_name.startswith((HIDDEN, "."))
                  and fnmatch.fnmatch(f.base_name, pattern))


class WorkbookFormat(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return SALES

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return WorkbookReader(self.options["path"], schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError(f"{FORMAT} only appends")
        return WorkbookWriter(self.options["path"], schema)


@dataclass
class File(InputPartition):
    path: str
    index: int


class WorkbookReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType):
        self.path, self.wanted = path, schema
        unknown = [f.name for f in schema if f.name not in SALES.names]
        if unknown:
            raise ValueError(f"{FORMAT} has no columns {unknown}")

    def partitions(self) -> list[File]:
        files = workbook_files(self.path)
        if not files:
            raise FileNotFoundError(f"no workbook at {self.path}")
        return [File(path, i) for i, path in enumerate(files)]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        system, _ = _system(self.path)
        with system.open_input_file(partition.path) as f:
            yield from workbook_batches(io.BufferedReader(f), partition.index, self.wanted)


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]  # hidden name, final name


_NS = "http://schemas.openxmlformats.org"
_PARTS = {
    "[Content_Types].xml":
        f'<Types xmlns="{_NS}/package/2006/content-types">'
        '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        '<Override PartName="/xl/workbook.xml" ContentType='
        '"application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
        '<Override PartName="/xl/worksheets/sheet1.xml" ContentType='
        '"application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
    "_rels/.rels":
        f'<Relationships xmlns="{_NS}/package/2006/relationships"><Relationship Id="rId1" Type='
        f'"{_NS}/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/>'
        '</Relationships>',
    "xl/_rels/workbook.xml.rels":
        f'<Relationships xmlns="{_NS}/package/2006/relationships"><Relationship Id="rId1" Type='
        f'"{_NS}/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/>'
        '</Relationships>',
    "xl/workbook.xml":
        f'<workbook xmlns="{_NS}/spreadsheetml/2006/main"'
        f' xmlns:r="{_NS}/officeDocument/2006/relationships">'
        '<sheets><sheet name="Sales" sheetId="1" r:id="rId1"/></sheets></workbook>',
}


def header_cells() -> list[str]:
    """Header names in sheet order, repeats without their number; the columns of a group that the
    schema lacks are there, empty."""
    plain, groups = [], {}
    for name in SALES_HEADERS:
        base, _, number = name.partition(".")
        if f"{base}.1" in SALES_HEADERS or number:
            groups.setdefault(int(number or 0), []).append(base)
        else:
            plain.append(base)
    bases = groups[0]
    return plain + bases * (max(groups) + 1)


def _cells(column: pa.Array | None):
    """The cells of a column as text, or of one that is not there."""
    if column is None:
        return "<c/>"
    texts, start, end = column.cast(pa.string()), "<c><v>", "</v></c>"
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        for mark, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            texts = pc.replace_substring(texts, mark, escaped)
        start, end = '<c t="inlineStr"><is><t xml:space="preserve">', "</t></is></c>"
    return pc.coalesce(pc.binary_join_element_wise(start, texts, end, ""), "<c/>")


def sheet_lines(columns: list[pa.Array | None]) -> list[str]:
    """The columns of a sheet as the text of its rows."""
    return pc.binary_join_element_wise("<row>", *map(_cells, columns), "</row>", "").to_pylist()


class WorkbookSheet:
    """A workbook that is written some rows at a time, to a stream that cannot go back."""

    def __init__(self, stream):
        self.stream = stream
        self.book = zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED)
        for name, content in _PARTS.items():
            self.book.writestr(name, content)
        self.sheet = self.book.open("xl/worksheets/sheet1.xml", "w", force_zip64=True)
        self.sheet.write(f'<worksheet xmlns="{_NS}/spreadsheetml/2006/main"><sheetData>'.encode())
        self._put(sheet_lines([pa.array(["Sales to ultimate customers"] * HEADER_ROWS_SKIPPED)]))
        self._put(sheet_lines([pa.array([name]) for name in header_cells()]))
        self.rows = 0

    def _put(self, lines: list[str]) -> None:
        self.sheet.write("".join(lines).encode())

    def write(self, lines: list[str]) -> None:
        self._put(lines)
        self.rows += len(lines)

    def close(self) -> None:
        self.sheet.write(b"</sheetData></worksheet>")
        self.sheet.close()
        self.book.close()
        self.stream.close()


def _by_year(batch: pa.RecordBatch) -> Iterator[tuple]:
    years = batch["report_year"]
    for year in years.unique():
        same = pc.equal(years, year) if year.is_valid else pc.is_null(years)
        yield year.as_py(), batch.filter(same)


class WorkbookWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: T.StructType):
        self.path, self.names = path, schema.names
        if "report_year" not in self.names:
            raise ValueError("a workbook row needs its report_year")
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """The task's rows, in workbooks of one year. At most one workbook is open per year, and none
        holds its rows in memory."""
        system, folder = _system(self.path)
        system.create_dir(folder, recursive=True)
        place, task = f"{TaskContext.get().partitionId():06}", uuid.uuid4().hex
        sheets, files = {}, []
        for batch in iterator:
            for year, rows in _by_year(batch):
                lines = sheet_lines([None if c is None else rows[c] for c in self._columns()])
                while lines:
                    if year not in sheets:
                        number = f"{len(files):06}"
                        final = f"{folder}/{PREFIX}{year}_{self.job}_{place}_{number}.xlsx"
                        hidden = f"{folder}/{HIDDEN}{self.job}_{task}_{number}.xlsx"
                        stream = system.open_output_stream(hidden, compression=None)
                        sheets[year] = WorkbookSheet(stream)
                        files.append((hidden, final))
                    room = ROWS_PER_WORKBOOK - sheets[year].rows
                    sheets[year].write(lines[:room])
                    lines = lines[room:]
                    if sheets[year].rows == ROWS_PER_WORKBOOK:
                        sheets.pop(year).close()
        for sheet in sheets.values():
            sheet.close()
        return Written(files)

    def _columns(self) -> list[str | None]:
        """The schema's column under each header cell."""
        of = {h: SALES_HEADERS.get(h) for h in number_repeats(header_cells())}
        return [c if c in self.names else None for c in of.values()]

    def commit(self, messages: list[Written | None]) -> None:
        """Shows the files of the tasks that counted; what retried tasks left stays hidden and goes."""
        system, folder = _system(self.path)
        for message in messages:
            for hidden, final in message.files if message else ():
                system.move(hidden, final)
        self._clean(system, folder)

    def abort(self, messages: list[Written | None]) -> None:
        self._clean(*_system(self.path))

    def _clean(self, system: fs.FileSystem, folder: str) -> None:
        selector = fs.FileSelector(folder, allow_not_found=True)
        for f in system.get_file_info(selector):
            if f.base_name.startswith(f"{HIDDEN}{self.job}"):
                system.delete_file(f.path)
