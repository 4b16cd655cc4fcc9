"""Rows of workbooks (XLSX) and of text files inside ZIP archives.

Spark lists the files and reads their bytes, whatever the store; a task opens an archive from its bytes, and streams sheets and
members, so that besides the archive it holds the shared strings and one batch of rows.  Spark's own limit of 2 GB a file holds.
"""

from __future__ import annotations

import csv
import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree.ElementTree import iterparse, parse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = 2048
# Number formats of the standard that show dates or times.
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
TEXT_MEMBERS = (".txt", ".csv")
ENCODINGS = ("utf-8-sig", "cp949")


class Workbook:
    """The parts of a workbook that its sheets refer to."""

    def __init__(self, content: bytes):
        self.zip = zipfile.ZipFile(io.BytesIO(content))
        names = set(self.zip.namelist())
        book = self._tree("xl/workbook.xml")
        targets = {r.get("Id"): r.get("Target") for r in self._tree("xl/_rels/workbook.xml.rels")}
        self.sheets = [(s.get("name"), self._place(targets[next(v for k, v in s.attrib.items() if k.endswith("}id"))])) for s in book.iter() if _tag(s) == "sheet"]
        view = next((v for v in book.iter() if _tag(v) == "workbookView"), None)
        self.active = int(view.get("activeTab", "0")) if view is not None else 0
        base = next((p for p in book.iter() if _tag(p) == "workbookPr"), None)
        self.epoch = dt.datetime(1904, 1, 1) if base is not None and base.get("date1904") in ("1", "true") else dt.datetime(1899, 12, 30)
        self.strings = list(self._strings()) if "xl/sharedStrings.xml" in names else []
        self.dates = self._dates() if "xl/styles.xml" in names else []

    def _tree(self, name: str):
        with self.zip.open(name) as f:
            return parse(f).getroot()

    @staticmethod
    def _place(target: str) -> str:
        return target.lstrip("/") if target.startswith("/") else f"xl/{target}"

    def _strings(self) -> Iterator[str]:
        with self.zip.open("xl/sharedStrings.xml") as f:
            for _, e in iterparse(f):
                if _tag(e) == "si":
                    yield _text(e)
                    e.clear()

    def _dates(self) -> list[bool]:
        """Whether each cell format shows a date."""
        root = self._tree("xl/styles.xml")
        own = {int(f.get("numFmtId")): re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode", "")) for f in root.iter() if _tag(f) == "numFmt"}
        formats = next((c for c in root if _tag(c) == "cellXfs"), [])
        ids = [int(x.get("numFmtId", "0")) for x in formats]
        return [bool(re.search("[ymdhs]", own[i], re.I)) if i in own else i in DATE_FORMATS for i in ids]

    def value(self, cell) -> str | None:
        """A cell as text: dates and times in ISO form, booleans as TRUE or FALSE, whole numbers without a point; empty cells and errors are null."""
        kind, said = cell.get("t", "n"), next((c.text for c in cell if _tag(c) == "v"), None)
        if kind == "inlineStr":
            return _text(cell)
        if said is None or kind == "e":
            return None
        if kind == "s":
            return self.strings[int(said)]
        if kind == "b":
            return "TRUE" if said == "1" else "FALSE"
        if kind in ("str", "d"):
            return said
        style = int(cell.get("s", "0"))
        if style < len(self.dates) and self.dates[style]:
            number = float(said)
            at = self.epoch + dt.timedelta(seconds=round(number * 86400))
            return at.strftime("%H:%M:%S") if 0 <= number < 1 else at.date().isoformat() if at.time() == dt.time() else at.isoformat(" ")
        number = float(said)
        return str(int(number)) if number.is_integer() and abs(number) < 2**53 else said

    def rows(self, sheet: str) -> Iterator[tuple[int, dict[int, str | None]]]:
        """(row number, values by column from 0) of the rows that are written in a sheet."""
        with self.zip.open(sheet) as f:
            before = 0
            for _, e in iterparse(f):
                if _tag(e) != "row":
                    continue
                before = int(e.get("r", before + 1))
                cells, column = {}, -1
                for c in e:
                    if _tag(c) == "c":
                        column = _column(c.get("r")) if c.get("r") else column + 1
                        cells[column] = self.value(c)
                yield before, cells
                e.clear()


def _tag(e) -> str:
    return e.tag.rpartition("}")[2]


def _text(e) -> str:
    """The text of all runs, without phonetic guides."""
    return "".join("".join(t.text or "" for t in part.iter() if _tag(t) == "t") if _tag(part) == "r" else (part.text or "") if _tag(part) == "t" else _text(part) if _tag(part) == "is" else "" for part in e)


def _column(reference: str) -> int:
    n = 0
    for c in reference:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _parsed(files: DataFrame, each, schema: str) -> DataFrame:
    """Rows of each(path, content), in batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("path", pa.string()), ("member", pa.string()), ("row", pa.int64()), ("values", pa.map_(pa.string(), pa.string()))])
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                held = []
                for member, row, values in each(path.as_py(), content.as_py()):
                    held.append((path.as_py(), member, row, list(values.items())))
                    if len(held) >= BATCH:
                        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds.types, strict=True)], schema=kinds)
                        held = []
                if held:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds.types, strict=True)], schema=kinds)

    return files.mapInArrow(run, schema)


_SCHEMA = "path string, member string, row long, values map<string,string>"


def _headers(values: list[str | None], path: str) -> list[str]:
    names = ["" if v is None else v.strip() for v in values]
    if not names or not all(names) or len(names) != len(set(names)):
        raise ValueError(f"{path}: headers must be filled and distinct: {names}")
    return names


def read_workbooks(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """(path, member, row, values) of one sheet of each workbook (the active one unless named): values by header, null where a cell is empty.

    Row numbers are the sheet's, the header in its first.  Headers must be filled and distinct; a cell beyond them, or a workbook that can't be
    read, fails the job with its name.  Workbooks of different headers go into one result.
    """

    def each(file: str, content: bytes):
        try:
            book = Workbook(content)
            named = dict(book.sheets)
            name = sheet if sheet is not None else book.sheets[book.active][0]
            rows = book.rows(named[name])
            at, first = next(rows, (0, {}))
            width = max(first, default=-1) + 1 if at == 1 else 0
            headers = _headers([first.get(i) for i in range(width)], file)
            for number, cells in rows:
                if any(i >= width and v is not None for i, v in cells.items()):
                    raise ValueError(f"row {number} is wider than the header")
                yield name, number, {h: cells.get(i) for i, h in enumerate(headers)}
        except (zipfile.BadZipFile, KeyError, IndexError, StopIteration, SyntaxError) as e:
            raise ValueError(f"unable to read workbook {file}: {e!r}") from e

    return _parsed(_files(spark, path), each, _SCHEMA)


def read_text_archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, member, row, values) of delimited text with a header, plain or as the first text or CSV member of a ZIP archive.

    UTF-8 (with or without a mark) or else CP949; tabs if the first line has one, else commas.  Rows count from 1 after the header.
    """

    def each(file: str, content: bytes):
        member = ""
        if zipfile.is_zipfile(io.BytesIO(content)):
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                fit = [n for n in archive.namelist() if n.lower().endswith(TEXT_MEMBERS)]
                if not fit:
                    raise ValueError(f"{file} holds no text or CSV member")
                member, content = fit[0], archive.read(fit[0])
        for encoding in ENCODINGS:
            try:
                text = content.decode(encoding)
                break
            except UnicodeDecodeError:
                continue
        else:
            raise ValueError(f"{file} is neither UTF-8 nor CP949")
        rows = csv.reader(io.StringIO(text, newline=""), delimiter="\t" if "\t" in text.partition("\n")[0] else ",")
        headers = _headers(next(rows, []), file)
        for n, values in enumerate((v for v in rows if v), 1):
            yield member, n, {h: values[i] if i < len(values) else None for i, h in enumerate(headers)}

    return _parsed(_files(spark, path), each, _SCHEMA)


def legal_districts(spark: SparkSession, path: str, prefix: str = "26") -> DataFrame:
    """(code, name) of the active districts of a legal-district file, plain or zipped; columns are found by their names' letters and digits."""
    from tessera.sources.files import place_codes

    rows = read_text_archives(spark, path)
    key = lambda k: F.regexp_replace(F.lower(k), r"[^\p{L}\p{N}]", "")
    named = F.map_from_entries(F.transform(F.map_entries("values"), lambda e: F.struct(key(e["key"]).alias("key"), e["value"].alias("value"))))
    pick = lambda *names: F.coalesce(*[F.element_at("m", n) for n in names])
    flat = rows.select(named.alias("m")).select(pick("법정동코드", "legaldongcode", "code").alias("code"), pick("법정동명", "legaldongname", "name").alias("name"), pick("폐지여부", "status", "closed").alias("closed"))
    return place_codes(flat, "code", "name", "closed", prefix)
