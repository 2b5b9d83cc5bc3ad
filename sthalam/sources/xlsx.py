"""Spreadsheets (xlsx) as a Spark data source, read with the standard library."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships"}


def cell_text(value: str | None, kind: str | None, shared: list[str]) -> str:
    """A cell as text: shared strings looked up, whole numbers without a point, nothing for an empty cell."""
    if value is None:
        return ""
    if kind == "s":
        return shared[int(value)]
    if kind == "b":
        return "TRUE" if value == "1" else "FALSE"
    if kind in (None, "n") and re.fullmatch(r"-?\d+\.0*", value):
        return value.split(".")[0]
    return value


def _column(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def sheet_rows(path: str, sheet: str | None = None) -> Iterator[list[str]]:
    """The rows of a sheet, the first one if none is named; gaps in a row are empty texts."""
    with zipfile.ZipFile(path) as z:
        names = z.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS)]
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        links = {x.get("Id"): x.get("Target") for x in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        sheets = [(s.get("name"), links[s.get(f"{{{_NS['r']}}}id")]) for s in book.find("m:sheets", _NS)]
        chosen = next((t for n, t in sheets if sheet in (None, "", n)), None)
        if chosen is None:
            raise ValueError(f"no sheet {sheet!r}; there are {[n for n, _ in sheets]}")
        with z.open("xl/" + chosen.lstrip("/").removeprefix("xl/")) as f:
            for _, el in ElementTree.iterparse(f):
                if el.tag != f"{{{_NS['m']}}}row":
                    continue
                row: list[str] = []
                for c in el.findall("m:c", _NS):
                    at = _column(c.get("r")) if c.get("r") else len(row)
                    row += [""] * (at - len(row))
                    inline = c.find("m:is", _NS)
                    text = "".join(t.text or "" for t in inline.iter(f"{{{_NS['m']}}}t")) if inline is not None else cell_text(getattr(c.find("m:v", _NS), "text", None), c.get("t"), shared)
                    row.append(text)
                yield row
                el.clear()


class XlsxReader(DataSourceReader):
    def __init__(self, path: str, sheet: str | None, schema: StructType):
        self.path, self.sheet, self.n = path, sheet, len(schema.fields)

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]  # a sheet is one compressed file, read from its beginning

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        rows = sheet_rows(self.path, self.sheet)
        next(rows, None)
        for row in rows:
            if any(x.strip() for x in row):
                yield tuple((row + [""] * self.n)[: self.n])


class XlsxSource(DataSource):
    """spark.read.format("xlsx").option("path", ...).option("sheet", ...): every column a string named by the header row."""

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def schema(self) -> StructType:
        header = next(sheet_rows(self.options["path"], self.options.get("sheet")), [])
        names = [h.strip() or f"column_{i + 1}" for i, h in enumerate(header)]
        return StructType([StructField(n, StringType()) for n in names])

    def reader(self, schema: StructType) -> DataSourceReader:
        return XlsxReader(self.options["path"], self.options.get("sheet"), schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(XlsxSource)


def column_named(columns: list[str], wanted: str, required: bool = False) -> str | None:
    """The column of that name whatever its case and outer blanks; an error where a required one isn't there."""
    found = next((c for c in columns if c.strip().lower() == wanted.strip().lower()), None)
    if found is None and required:
        raise ValueError(f"no column {wanted!r}; there are {columns}")
    return found
