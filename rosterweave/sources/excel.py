"""SC10, SC11: spreadsheets (.xlsx) as tables, read in tasks: a file is a zip of XML, which is parsed as a stream; no library for it is needed.

A task holds one file's bytes and its shared strings; rows leave it in batches. Values are text as stored: numbers as written in the file, booleans as
True and False, errors and formulas by their last value. A file that is no spreadsheet is an error that names it.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterweave.functions.text import trim
from rosterweave.shipping import ship

_BATCH = 10_000
#: Headers that are no names.
HEADERS = ("companyname", "company_name", "company name")


def _name(tag: str) -> str:
    return tag.rpartition("}")[2]


def _elements(book: zipfile.ZipFile, path: str, wanted: str) -> Iterator[ElementTree.Element]:
    """The elements of that name, one after the other; each leaves the tree after use."""
    above: list[ElementTree.Element] = []
    with book.open(path) as stream:
        for event, element in ElementTree.iterparse(stream, ("start", "end")):
            if event == "start":
                above.append(element)
                continue
            above.pop()
            if _name(element.tag) == wanted:
                yield element
                if above:
                    above[-1].remove(element)


def _spelled(element: ElementTree.Element) -> str:
    """The text of a string, without the readings (rPh) that stand above it."""
    if _name(element.tag) == "rPh":
        return ""
    return (element.text or "" if _name(element.tag) == "t" else "") + "".join(map(_spelled, element))


def _column(ref: str) -> int:
    out = 0
    for letter in re.match("[A-Z]*", ref.upper())[0]:
        out = 26 * out + ord(letter) - 64
    return out


def cells(content: bytes) -> Iterator[tuple[int, str, bool, int, int, str]]:
    """sheet's place, its name, whether it is the one shown first, row and column from 1, value; cells without a value are left out."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        there = set(book.namelist())
        shared = [_spelled(e) for e in _elements(book, "xl/sharedStrings.xml", "si")] if "xl/sharedStrings.xml" in there else []
        targets = {e.get("Id"): e.get("Target", "") for e in _elements(book, "xl/_rels/workbook.xml.rels", "Relationship")}
        first = next((int(e.get("activeTab") or 0) for e in _elements(book, "xl/workbook.xml", "workbookView")), 0)
        sheets = [(e.get("name") or "", next((v for k, v in e.attrib.items() if _name(k) == "id"), "")) for e in _elements(book, "xl/workbook.xml", "sheet")]
        for place, (title, link) in enumerate(sheets):
            target = targets.get(link, "")
            path = target.lstrip("/") if target.startswith("/") else posixpath.normpath(f"xl/{target}")
            if path not in there:
                continue
            row = 0
            for element in _elements(book, path, "row"):
                row, column = int(element.get("r") or row + 1), 0
                for cell in element:
                    column = _column(cell.get("r") or "") or column + 1
                    kind, value = cell.get("t", "n"), next((c.text or "" for c in cell if _name(c.tag) == "v"), "")
                    if kind == "s":
                        value = shared[int(value)] if value else ""
                    elif kind == "inlineStr":
                        value = _spelled(cell)
                    elif kind == "b":
                        value = "True" if value == "1" else "False"
                    if value:
                        yield place, title, place == first, row, column, value


def excel_table(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, sheet, title, active, row, col, value: the cells of spreadsheets, wherever Spark can read them; a task a file."""
    ship(spark)
    names = ["file", "sheet", "title", "active", "row", "col", "value"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                try:
                    for cell in cells(content.as_py()):
                        rows.append((path, *cell))
                        if len(rows) == _BATCH:
                            yield _record_batch(rows)
                            rows = []
                except (zipfile.BadZipFile, ElementTree.ParseError, KeyError) as e:
                    raise ValueError(f"{path} is no spreadsheet: {e}") from e
                if rows:
                    yield _record_batch(rows)

    def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.string(), pa.int32(), pa.string(), pa.bool_(), pa.int32(), pa.int32(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.mapInArrow(run, "file string, sheet int, title string, active boolean, row int, col int, value string")


def excel_cells(spark: SparkSession, paths: str | list[str], headers: tuple[str, ...] = HEADERS) -> DataFrame:
    """SC10: every cell of every sheet is a name, each once by its lower case, as its first cell spells it. company_name and where it stands (file, sheet, row, col)."""
    names = excel_table(spark, paths).withColumn("company_name", trim("value")).withColumn("key", F.lower("company_name"))
    at = F.struct("file", "sheet", "row", "col")
    fine = (F.col("company_name") != "") & ~F.col("key").isin(*headers)
    return names.filter(fine).groupBy("key").agg(F.min(F.struct(at.alias("at"), "company_name")).alias("first")).select("first.company_name", "first.at.*")


def excel_rows(spark: SparkSession, paths: str | list[str], website: int = 0, email: int = 3, after: int = 1) -> DataFrame:
    """SC11: two columns (from 0) of the sheet shown first, below `after` rows: website, email, file, row. Rows without a website are left out, a scheme is added."""
    cut = excel_table(spark, paths).filter(F.col("active") & (F.col("row") > after) & F.col("col").isin(website + 1, email + 1))
    pick = lambda n: F.coalesce(F.max(F.when(F.col("col") == n + 1, trim("value"))), F.lit(""))
    rows = cut.groupBy("file", "row").agg(pick(website).alias("site"), pick(email).alias("email")).filter("site <> ''")
    return rows.select(F.when(F.startswith("site", F.lit("http")), F.col("site")).otherwise(F.concat(F.lit("https://"), "site")).alias("website"), "email", "file", "row")
