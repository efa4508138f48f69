"""Excel workbooks (``.xlsx``): the first sheet of each as rows of text cells.

A sheet holds at most 1,048,576 rows by its format, so one workbook fits one task; workbooks are
spread over tasks.  Sheet XML is streamed, never held whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import convert as cv
from ..operators import infer

CELLS = "path string, row_no bigint, kinds array<string>, texts array<string>"
# Built-in number formats that show dates or times.
DATE_FORMATS = frozenset([14, 15, 16, 17, 22, 27, 28, 29, 30, 31, 36, 50, 51, 52, 53, 54, 57, 58])
ROWS_PER_BATCH = 5000


def _column_number(reference: str) -> int:
    number = 0
    for letter in reference:
        if not letter.isalpha():
            break
        number = number * 26 + ord(letter.upper()) - ord("A") + 1
    return number - 1


def sheet_rows(content: bytes) -> Iterator[tuple[int, list[str], list[str | None]]]:
    """Rows of the first sheet: (row number, cell kinds, cell texts).  Kinds are n (number),
    d (date), b (boolean), s (text) and '' for no cell."""
    import datetime
    import io
    import re
    import zipfile
    from xml.etree import ElementTree as ET

    def local(tag: str) -> str:
        return tag.rsplit("}", 1)[-1]

    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = set(book.namelist())

        def tree(name: str):
            return ET.fromstring(book.read(name)) if name in names else None

        workbook, links = tree("xl/workbook.xml"), tree("xl/_rels/workbook.xml.rels")
        sheet = "xl/worksheets/sheet1.xml"
        epoch = datetime.datetime(1899, 12, 30)
        if workbook is not None:
            sheets = [e for e in workbook.iter() if local(e.tag) == "sheet"]
            wanted = next(
                (v for k, v in sheets[0].attrib.items() if local(k) == "id"), None
            ) if sheets else None
            for link in links if links is not None else ():
                if link.get("Id") == wanted:
                    target = link.get("Target", "").lstrip("/")
                    sheet = target if target.startswith("xl/") else "xl/" + target
            for e in workbook.iter():
                if local(e.tag) == "workbookPr" and e.get("date1904") in ("1", "true"):
                    epoch = datetime.datetime(1904, 1, 1)

        shared: list[str] = []
        if "xl/sharedStrings.xml" in names:
            with book.open("xl/sharedStrings.xml") as stream:
                for _, e in ET.iterparse(stream):
                    if local(e.tag) == "si":
                        shared.append("".join(t.text or "" for t in e.iter() if local(t.tag) == "t"))
                        e.clear()

        date_styles: set[int] = set()
        styles = tree("xl/styles.xml")
        if styles is not None:
            custom = {
                int(e.get("numFmtId")): e.get("formatCode", "")
                for e in styles.iter()
                if local(e.tag) == "numFmt"
            }
            formats = next((e for e in styles if local(e.tag) == "cellXfs"), ())
            for i, e in enumerate(formats):
                code = int(e.get("numFmtId", 0))
                shown = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", custom.get(code, "")).lower()
                if code in DATE_FORMATS or "y" in shown or "d" in shown:
                    date_styles.add(i)

        def shown(kind: str, style: str | None, value: str) -> tuple[str, str | None]:
            if kind == "s":
                return "s", shared[int(value)]
            if kind == "b":
                return "b", "true" if value == "1" else "false"
            if kind in ("str", "e"):
                return "s", value
            if kind == "d":
                return "d", value
            if int(0 if style is None else style) in date_styles:
                moment = epoch + datetime.timedelta(days=float(value))
                moment = (moment + datetime.timedelta(microseconds=500)).replace(microsecond=0)
                whole = moment.time() == datetime.time()
                return "d", moment.date().isoformat() if whole else moment.isoformat(" ")
            return "n", value

        yield from _streamed_rows(book, sheet, shown)


def _streamed_rows(book, sheet: str, shown) -> Iterator[tuple[int, list[str], list[str | None]]]:
    """Rows of a sheet as its XML goes by; ``shown`` gives kind and text of a cell with a value, by the
    cell's type, style and value."""
    from xml.parsers import expat

    done: list[tuple[int, list[str], list[str | None]]] = []
    depth, row_no, row_at, cell_at = 0, 0, 0, 0
    kinds: list[str] = []
    texts: list[str | None] = []
    kind, style, value, inline, told = "n", None, None, [], []
    names: dict[str, str] = {}

    def start(tag, attributes):
        nonlocal depth, row_no, row_at, cell_at, kinds, texts, kind, style, value, inline
        depth += 1
        name = names.get(tag) or names.setdefault(tag, tag.rsplit("}", 1)[-1])
        # The text of an element is what comes before its first child.
        parser.CharacterDataHandler = None
        if cell_at:
            if name == "t" or (name == "v" and value is None and depth == cell_at + 1):
                told.clear()
                parser.CharacterDataHandler = told.append
        elif name == "c":
            if row_at and depth == row_at + 1:
                reference = attributes.get("r")
                at = _column_number(reference) if reference else len(texts)
                while len(texts) < at:
                    kinds.append("")
                    texts.append(None)
                cell_at, kind, style = depth, attributes.get("t", "n"), attributes.get("s")
                value, inline = None, []
        elif name == "row" and not row_at:
            row_no, row_at = int(attributes.get("r", row_no + 1)), depth
            kinds, texts = [], []

    def end(tag):
        nonlocal depth, row_at, cell_at, value
        if cell_at:
            name = names[tag]
            if name == "t":
                inline.append("".join(told))
                told.clear()
            elif name == "v" and value is None and depth == cell_at + 1:
                # A value without any text is none, but no later one takes its place.
                value = "".join(told) or False
                told.clear()
            elif depth == cell_at:
                cell_at = 0
                if kind == "inlineStr":
                    found = "s", "".join(inline)
                else:
                    found = shown(kind, style, value) if value else ("", None)
                kinds.append(found[0])
                texts.append(found[1])
        elif depth == row_at:
            done.append((row_no, kinds, texts))
            row_at = 0
        depth -= 1
        parser.CharacterDataHandler = None

    parser = expat.ParserCreate(None, "}")
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler = start, end
    with book.open(sheet) as stream:
        while chunk := stream.read(1 << 16):
            parser.Parse(chunk)
            yield from done
            done.clear()
        parser.Parse(b"", True)
        yield from done


def workbook_cells(spark: SparkSession, paths: list[str]) -> DataFrame:
    """First sheets of workbooks as (path, row_no, kinds, texts)."""
    files = spark.read.format("binaryFile").load(paths).select("path", "content")

    def run(batches: Iterable) -> Iterator:
        from itertools import islice

        import pyarrow as pa

        strings = pa.list_(pa.string())
        for batch in batches:
            for path, content in zip(*batch.columns):
                rows = sheet_rows(content.as_py())
                while some := list(islice(rows, ROWS_PER_BATCH)):
                    numbers, kinds, texts = zip(*some)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([path.as_py()] * len(some), pa.string()),
                            pa.array(numbers, pa.int64()),
                            pa.array(kinds, strings),
                            pa.array(texts, strings),
                        ],
                        names=["path", "row_no", "kinds", "texts"],
                    )

    return files.mapInArrow(run, CELLS)


def workbook_headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row per workbook: the number of its first row and the names in it, or else the ``fault`` for
    which it cannot be read.  Every workbook is read to its end, so that later readings do not fail."""
    files = spark.read.format("binaryFile").load(paths).select("path", "content")

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        def header(path: str, content: bytes) -> dict:
            first = None
            try:
                for row_no, _, texts in sheet_rows(content):
                    if first is None or row_no < first[0]:
                        first = row_no, texts
            except Exception as error:  # noqa: BLE001 - reported
                return {"path": path, "fault": f"{type(error).__name__}: {error}"}
            if first is None:
                return {"path": path, "fault": "the first sheet is empty"}
            names = [t or f"column{i}" for i, t in enumerate(first[1])]
            return {"path": path, "row_no": first[0], "names": names}

        schema = pa.schema(
            [("path", pa.string()), ("row_no", pa.int64()), ("names", pa.list_(pa.string())), ("fault", pa.string())]
        )
        for batch in batches:
            for path, content in zip(*batch.columns):
                yield pa.RecordBatch.from_pylist([header(path.as_py(), content.as_py())], schema=schema)

    return files.mapInArrow(run, "path string, row_no bigint, names array<string>, fault string")


def workbook_texts(cells: DataFrame, names: Sequence[str], header_row: int) -> DataFrame:
    """Cleaned text columns, the cell kinds as ``_k0``, ... and the file in ``_path``."""
    body = cells.where(F.col("row_no") > header_row)
    # Only what is no cell has no kind.
    filled = body.where(F.array_max("kinds") != "")
    return filled.select(
        *[cv.clean_text(F.get("texts", F.lit(i))).alias(n) for i, n in enumerate(names)],
        *[F.get("kinds", F.lit(i)).alias(f"_k{i}") for i in range(len(names))],
        F.col("path").alias("_path"),
    )


# What a column of one kind of cells becomes, besides what inference makes of text.
WORKBOOK_TESTS = {
    **infer.GERMAN_TESTS,
    "number": cv.plain_double,
    "boolean": cv.plain_boolean,
    "timestamp": lambda c: F.coalesce(cv.iso_timestamp(c), cv.iso_date(c).cast("timestamp_ntz")),
    "date": cv.iso_date,
}


def workbook_verdicts(texts: DataFrame, names: Sequence[str], all_text: bool) -> DataFrame:
    """A column of number cells is DOUBLE, of date cells DATE or TIMESTAMP, of boolean cells
    BOOLEAN; any mixture is text that type inference looks at."""
    kinds = [
        F.array(
            *[F.count_if(F.col(f"_k{i}") == kind) for kind in "nbd"],
            F.count_if((F.col(f"_k{i}") == "d") & (F.length(F.col(f"`{n}`")) > 10)),
        ).alias(f"k{i}")
        for i, n in enumerate(names)
    ]
    counts = infer.inference_counts(texts, names, by=["_path"], extra=kinds)

    def settled(i: int) -> Column:
        present, kind = F.col(f"c{i}")[0], F.col(f"k{i}")
        by_kind = (
            F.when(F.lit(all_text) | (present == 0), F.lit(None).cast("string"))
            .when(kind[0] == present, "number")
            .when(kind[1] == present, "boolean")
            .when((kind[2] == present) & (kind[3] > 0), "timestamp")
            .when(kind[2] == present, "date")
        )
        return F.coalesce(by_kind, infer.verdict(F.col(f"c{i}"), infer.GERMAN_TESTS))

    return counts.select(
        "_path", "row_count", F.array(*[settled(i) for i in range(len(names))]).alias("verdicts")
    )
