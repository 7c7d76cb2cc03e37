"""Workbooks by the standard library: rows are streamed to a sheet, and read back as strings, on executors."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from itertools import islice
from typing import IO
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_BAD = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f]")


def letters(n: int) -> str:
    """The name of column n, from 0."""
    out = ""
    n += 1
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


# Column widths, and the header's colours and number formats of summaries.
def width(column: str) -> int:
    return 46 if re.search(r"name|address|note", column, re.I) else 26 if re.search(r"type|tier|verdict|population|source", column, re.I) else 15


def _cell(ref: str, v, style: int = 0) -> str:
    if v is None or v != v or v == "":
        return ""
    if isinstance(v, bool) or not isinstance(v, (int, float)):
        return f'<c r="{ref}" t="inlineStr" s="{style}"><is><t xml:space="preserve">{escape(_BAD.sub("", str(v)))}</t></is></c>'
    return f'<c r="{ref}" s="{style}"><v>{v!r}</v></c>'


def _style(v, column: int) -> int:
    """2 for shares, 3 for whole numbers, in summary tables."""
    if isinstance(v, float) and 0 <= v <= 1 and column:
        return 2
    return 3 if isinstance(v, int) and not isinstance(v, bool) else 0


_STYLES = """<?xml version="1.0" encoding="UTF-8"?><styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><numFmts count="2"><numFmt numFmtId="164" formatCode="0.0%"/><numFmt numFmtId="165" formatCode="#,##0"/></numFmts><fonts count="2"><font/><font><b/><color rgb="FFFFFFFF"/></font></fonts><fills count="3"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill><fill><patternFill patternType="solid"><fgColor rgb="FF1F3864"/></patternFill></fill></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="4"><xf/><xf fontId="1" fillId="2" applyFont="1" applyFill="1"/><xf numFmtId="164" applyNumberFormat="1"/><xf numFmtId="165" applyNumberFormat="1"/></cellXfs></styleSheet>"""


class Workbook:
    """Sheets are written one after the other, row by row."""

    def __init__(self, path: str):
        self.zip = zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED)
        self.titles: list[str] = []

    def sheet(self, title: str, columns: Sequence[str], rows: Iterable[Sequence], summary: bool = False) -> None:
        """A table: header band, frozen first row, filter; summary tables show shares as per cent."""
        self.titles.append(re.sub(r"[\[\]:*?/\\]", "_", title)[:31])
        with self.zip.open(f"xl/worksheets/sheet{len(self.titles)}.xml", "w") as f:
            put = lambda s: f.write(s.encode())
            put(f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{_NS[1:-1]}"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews><cols>')
            put("".join(f'<col min="{i + 1}" max="{i + 1}" width="{width(c)}" customWidth="1"/>' for i, c in enumerate(columns)) + "</cols><sheetData>")
            put('<row r="1">' + "".join(_cell(f"{letters(i)}1", c, 1) for i, c in enumerate(columns)) + "</row>")
            n = 1
            for row in rows:
                n += 1
                put(f'<row r="{n}">' + "".join(_cell(f"{letters(i)}{n}", v, _style(v, i) if summary else 0) for i, v in enumerate(row)) + "</row>")
            put(f'</sheetData><autoFilter ref="A1:{letters(max(0, len(columns) - 1))}{n}"/></worksheet>')

    def table(self, title: str, df: DataFrame, summary: bool = False) -> None:
        """A DataFrame, streamed a partition at a time."""
        flat = [c for c, k in df.dtypes if not k.startswith(("array", "struct", "map"))]
        self.sheet(title, flat, (tuple(r) for r in df.select(*flat).toLocalIterator()), summary)

    def close(self) -> None:
        sheets = "".join(f'<sheet name="{escape(t)}" sheetId="{i}" r:id="rId{i}"/>' for i, t in enumerate(self.titles, 1))
        kind = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        head = '<?xml version="1.0" encoding="UTF-8"?>'
        self.zip.writestr("xl/styles.xml", _STYLES)
        self.zip.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{_NS[1:-1]}" xmlns:r="{kind}"><sheets>{sheets}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{i}" Type="{kind}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(self.titles) + 1))
        package = "http://schemas.openxmlformats.org/package/2006"
        self.zip.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="{package}/relationships">{links}<Relationship Id="rId0" Type="{kind}/styles" Target="styles.xml"/></Relationships>')
        self.zip.writestr("_rels/.rels", f'{head}<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{kind}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        main = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{main}.worksheet+xml"/>' for i in range(1, len(self.titles) + 1))
        self.zip.writestr("[Content_Types].xml", f'{head}<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{main}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{main}.styles+xml"/>{parts}</Types>')
        self.zip.close()


def rows_of(book: str | IO[bytes], sheet: int = 1) -> Iterator[list[str | None]]:
    """The cells of a sheet as strings, a row at a time."""
    with zipfile.ZipFile(book) as z:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(_NS + "t")) for si in ElementTree.parse(z.open("xl/sharedStrings.xml")).getroot()]
        for _, row in ElementTree.iterparse(z.open(f"xl/worksheets/sheet{sheet}.xml")):
            if row.tag != _NS + "row":
                continue
            out: list[str | None] = []
            for c in row:
                at = 0
                for ch in re.match(r"[A-Z]+", c.get("r"))[0]:
                    at = at * 26 + ord(ch) - 64
                out += [None] * (at - len(out))
                value = c.find(_NS + "v")
                text = "".join(t.text or "" for t in c.iter(_NS + "t")) if c.get("t") == "inlineStr" else value.text if value is not None else None
                out[at - 1] = shared[int(text)] if c.get("t") == "s" and text else text
            yield out
            row.clear()


def read(spark: SparkSession, path: str) -> DataFrame:
    """The first sheets of the workbooks at a path of any of Spark's stores, as strings, under the first one's header.

    A workbook is parsed by the task that reads it, row by row; only the header comes to the driver.
    """
    books = spark.read.format("binaryFile").load(path)

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[str(c or f"column{i}") for i, c in enumerate(next(rows_of(io.BytesIO(x.as_py())), []))] for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.string()))], ["path", "head"])

    first = books.select("path", "content").mapInArrow(heads, "path string, head array<string>").orderBy("path").first()
    head = first["head"] if first else []

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.column(0):
                own = rows_of(io.BytesIO(x.as_py()))
                next(own, None)
                while part := list(islice(own, 4096)):
                    cells = zip(*((r + [None] * len(head))[: len(head)] for r in part))
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cells], [f"c{i}" for i in range(len(head))])

    return books.select("content").mapInArrow(rows, ", ".join(f"c{i} string" for i in range(len(head)))).toDF(*head)
