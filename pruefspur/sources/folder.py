"""Folder import: every file of a type in a folder becomes a table.

All text files of the folder are profiled in one scan.  Files whose header, separator and charset
agree share one inference job; the tables themselves are lazy.
"""

from __future__ import annotations

import csv
import json
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import hadoop
from ..functions import charset as cs
from ..functions import convert as cv
from ..functions.names import dedupe_names, normalised, snake_case, table_of_file
from ..operators import infer
from ..operators.report import (
    CHARSET_REPORT,
    FILE_REPORT,
    TRAVERSAL,
    ImportResult,
    report_frame,
    short_message,
    side_by_side,
)
from ..operators.union import stacked
from . import lines as ln
from .audit import _free_name, path_has_traversal
from .records import records, split_starts
from .workbook import (
    WORKBOOK_TESTS,
    workbook_cells,
    workbook_headers,
    workbook_texts,
    workbook_verdicts,
)

# The extensions each file type takes.  Any other type takes its own extension.
TYPE_EXTENSIONS = {
    "csv": ("csv", "txt"),
    "parquet": ("parquet",),
    # The old binary .xls is listed so that it is reported; it cannot be read.
    "xlsx": ("xlsx", "xls"),
    "excel": ("xlsx", "xls"),
    "json": ("json", "jsonl"),
    "tsv": ("tsv",),
}
SEPARATORS = (";", ",", "\t", "|")
# Option names of other readers and what they are called here.
OPTION_NAMES = {"delimiter": "sep", "delim": "sep", "nullstr": "nullValue", "charset": "encoding"}
#: What delimited text takes; any other option is refused, so that none is passed over in silence.
TEXT_OPTIONS = (
    "all_varchar", "drop_bad_rows", "encoding", "header", "nullValue", "quote", "sep", "skip"
)
#: No text has these characters, so a line read with them is one field.
NO_SEPARATOR, NO_QUOTE = "\ufffe", "\uffff"


def extension(name: str) -> str:
    return name.rsplit(".", 1)[1].lower() if "." in name else ""


def matching_files(spark: SparkSession, folder: str, file_type: str) -> list[hadoop.StoredFile]:
    """Visible regular files of a type, directly in the folder, by name."""
    wanted = TYPE_EXTENSIONS.get(file_type.lower(), (file_type.lower(),))
    return [
        f
        for f in hadoop.list_files(spark, folder)
        if not f.is_dir and not f.name.startswith(".") and extension(f.name) in wanted
    ]


@dataclass(frozen=True)
class TextShape:
    """How the files of one group are read."""

    names: tuple[str, ...]
    sep: str
    charset: str
    multiline: bool
    skip: int
    header: bool
    quote: str = '"'
    null_value: str = ""
    drop_bad_rows: bool = False


def likeliest_separator(header: str, widths: Iterable[tuple[int, int, int]]) -> str:
    """The separator with most places in lines of a file that hold it as often as the header line does,
    so that a comma within numbers does not pass for one that parts more columns.  ``widths`` are
    (number of the separator, bin of the count, lines)."""
    lines = {(sep, at): n for sep, at, n in widths}

    def score(sep: str) -> tuple[int, int]:
        count = len(next(csv.reader([header], delimiter=sep), [])) - 1
        if count < 1:
            return (0, 0)
        shared = ln.PLAIN_COUNTS + count % ln.SHARED_COUNTS
        found = lines.get((SEPARATORS.index(sep), count if count < ln.PLAIN_COUNTS else shared), 0)
        return (found * count, count)

    best = max(SEPARATORS, key=score)
    return best if score(best) > (0, 0) else ","


def header_names(first: str, sep: str, quote: str) -> list[str]:
    """Names of a header line; a repeated or missing one is called after its position."""
    fields = next(csv.reader([first], delimiter=sep, quotechar=quote or '"'), [])
    return [f if f else f"column{i}" for i, f in enumerate(fields)]


def _file_lines(spark: SparkSession, paths: list[str], shape: TextShape) -> DataFrame:
    """The lines of files of one shape behind their headers, as ``path`` and text."""
    if shape.multiline or shape.skip or cs.is_wide(shape.charset):
        scanned = ln.text_lines(spark, paths, shape.charset).select("path", "block", "more", "value")
        skip = shape.skip + int(shape.header)
        if shape.multiline:
            body = records(scanned, split_starts(scanned, shape.sep, skip), shape.sep, skip)
        else:
            body = ln.drop_head(scanned, skip)
        text = cs.decoded(F.col("value").cast("binary"), shape.charset)
        return body.select("path", text.alias("value"))
    # The reader of delimited text passes over a header line by itself, without any Python.
    utf8 = cs.is_utf8(shape.charset)
    read = spark.read.schema("value string").csv(
        paths, header=shape.header, enforceSchema=True, sep=NO_SEPARATOR, quote=NO_QUOTE,
        escape=NO_QUOTE, encoding="UTF-8" if utf8 else "ISO-8859-1",
    )
    value = F.col("value") if utf8 else cs.decoded(F.encode("value", "ISO-8859-1"), shape.charset)
    return read.select(F.col("_metadata.file_path").alias("path"), value.alias("value"))


def read_text_files(spark: SparkSession, paths: list[str], shape: TextShape) -> DataFrame:
    """Files of one shape as cleaned text columns, with the file in ``_path`` and whether a row has
    fields beyond the header's in ``_long_row``."""
    width = len(shape.names)
    lines = ln.without_blank_lines(_file_lines(spark, paths, shape), width)
    options = {"quote": shape.quote, "escape": shape.quote or NO_QUOTE, "nullValue": shape.null_value}
    rows = lines.select(
        "path",
        ln.split_fields(F.col("value"), width, shape.sep, options).alias("f"),
        ln.surplus(F.col("value"), width, shape.sep, shape.quote).alias("long_row"),
    )
    names = ln.raw_names(width)
    return rows.select(
        *[cv.clean_text(F.col(f"f.{r}")).alias(n) for r, n in zip(names, shape.names)],
        F.col("path").alias("_path"),
        F.col("long_row").alias("_long_row"),
    )


Tests = dict[str, Callable[[Column], Column]]


@dataclass(frozen=True, eq=False)
class Shape:
    """Files that are read alike.  ``read`` gives cleaned columns and the file in ``_path``;
    ``measure`` gives row count and verdicts, one row per file."""

    names: tuple[str, ...]
    tests: Tests
    read: Callable[[list[str]], DataFrame]
    measure: Callable[[DataFrame], DataFrame]
    drop_bad_rows: bool = False
    charset: str = ""

    def typed(self, paths: list[str], verdicts: tuple[str | None, ...]) -> DataFrame:
        frame = self.read(paths)
        if self.drop_bad_rows:
            frame = frame.where(~F.col("_long_row"))
        frame = frame.select(*[f"`{n}`" for n in self.names], "_path")
        return infer.convert_columns(frame, dict(zip(self.names, verdicts)), self.tests)


@dataclass(frozen=True)
class Loaded:
    shape: Shape
    place: str
    row_count: int = 0
    verdicts: tuple[str | None, ...] = ()
    long_rows: int = 0

    @property
    def notes(self) -> list[str]:
        if not self.long_rows:
            return []
        if self.shape.drop_bad_rows:
            return [f"{self.long_rows} rows with more fields than the header were dropped"]
        return [f"{self.long_rows} rows have more fields than the header, which were cut"]

    def build(self) -> DataFrame:
        return self.shape.typed([self.place], self.verdicts).drop("_path")


Outcome = dict[str, Loaded | Exception]


def _verdicts(
    frame: DataFrame, names: Sequence[str], tests: Tests, drop_bad_rows: bool = False
) -> DataFrame:
    """Row count and verdicts per file; columns that are not text have none.  Rows that will be dropped
    count as ``long_rows`` only."""
    text = [n for n in infer.text_columns(frame) if n in names]
    long_row = F.col("_long_row") if "_long_row" in frame.columns else F.lit(False)
    if drop_bad_rows:
        kept = [F.when(~long_row, F.col(f"`{n}`")).alias(n) if n in text else F.col(f"`{n}`") for n in names]
        frame = frame.select(*kept, "_path", "_long_row")
    counts = infer.inference_counts(
        frame, text, tests, by=["_path"], extra=[F.count_if(long_row).alias("long_rows")]
    )
    found = {n: infer.verdict(F.col(f"c{i}"), tests) for i, n in enumerate(text)}
    none = F.lit(None).cast("string")
    rows = F.col("row_count") - F.col("long_rows") if drop_bad_rows else F.col("row_count")
    return counts.select(
        "_path",
        rows.alias("row_count"),
        F.array(*[found.get(n, none) for n in names]).alias("verdicts"),
        "long_rows",
    )


def _measured(spark: SparkSession, groups: dict[Shape, list[hadoop.StoredFile]]) -> Outcome:
    """Verdicts of all files, one job per shape."""

    def task(shape: Shape, group: list[hadoop.StoredFile]) -> Callable[[], dict]:
        def run() -> dict:
            frame = shape.read([hadoop.literal(f.path) for f in group])
            found = shape.measure(frame).withColumn("_path", ln.plain_path(F.col("_path")))
            return {r["_path"]: r for r in found.collect()}

        return run

    results = side_by_side(spark, [task(shape, group) for shape, group in groups.items()])
    outcome: Outcome = {}
    for (shape, group), result in zip(groups.items(), results):
        for f in group:
            if isinstance(result, Exception):
                outcome[f.path] = result
                continue
            row = result.get(f.path)
            place = hadoop.literal(f.path)
            outcome[f.path] = (
                Loaded(
                    shape, place, row["row_count"], tuple(row["verdicts"]),
                    row.asDict().get("long_rows", 0),
                )
                if row
                else Loaded(shape, place)
            )
    return outcome


#: Lines of a file's start among which the header is looked for, blank ones included.
HEADER_REACH = 20

SHAPE = (
    "path string, names array<string>, sep string, charset string, multiline boolean, "
    "skipped int, lines bigint"
)


def text_shapes(
    spark: SparkSession, paths: list[str], file_type: str, options: dict
) -> DataFrame:
    """One row per file with a header: how it is to be read, and ``shape_id``."""
    skip = int(options.get("skip", 0))
    header = str(options.get("header", True)).lower() == "true"
    quote = options.get("quote", '"')
    heads = ln.profiles(
        spark, paths, HEADER_REACH + skip, skip + 1, seps=SEPARATORS, charset=options.get("encoding")
    )

    def run(frames: Iterable) -> Iterator:
        import pandas as pd

        def shape(row) -> tuple | None:
            # Blank lines before the header are passed over with the lines to skip.
            filled = [i for i, line in enumerate(row.head) if i >= skip and line.strip()]
            if not filled:
                return None
            skipped, head = filled[0], list(row.head)[filled[0] :]
            widths = [(w["sep"], w["bin"], w["n"]) for w in ([] if row.widths is None else row.widths)]
            sep = options.get("sep") or (
                "\t" if file_type == "tsv" else likeliest_separator(head[0], widths)
            )
            names = header_names(head[0], sep, quote)
            if not header:
                names = [f"column{i}" for i in range(len(names))]
            multiline = bool(row.odd_quotes) and bool(quote)
            return (row.path, names, sep, row.charset, multiline, skipped, row.lines)

        columns = ["path", "names", "sep", "charset", "multiline", "skipped", "lines"]
        for frame in frames:
            found = [s for s in map(shape, frame.itertuples(index=False)) if s]
            yield pd.DataFrame(found, columns=columns)

    known = heads.select("path", "head", "charset", "odd_quotes", "lines", "widths")
    shapes = known.mapInPandas(run, SHAPE)
    named = shapes.withColumn("_plain", F.transform("names", snake_case))
    return named.withColumn("names", dedupe_names(F.col("_plain"))).select(
        "*", F.xxhash64("names", "sep", "charset", "multiline", "skipped").alias("shape_id")
    )


def _text_tables(
    spark: SparkSession, files: list[hadoop.StoredFile], file_type: str, options: dict
) -> Outcome:
    """Delimited text.  Only names, shapes and verdicts reach the driver."""
    header = str(options.get("header", True)).lower() == "true"
    quote = options.get("quote", '"')
    null_value = options.get("nullValue", "")
    sniffing = str(options.get("all_varchar", False)).lower() != "true"
    tests = infer.PLAIN_TESTS if sniffing else infer.GERMAN_TESTS
    drop_bad_rows = str(options.get("drop_bad_rows", False)).lower() == "true"
    places = [hadoop.literal(f.path) for f in files]
    found = hadoop.reliable(text_shapes(spark, places, file_type, options))
    texts = {
        r["shape_id"]: TextShape(
            tuple(r["names"]), r["sep"], r["charset"], r["multiline"], r["skipped"], header,
            quote, null_value, drop_bad_rows,
        )
        for r in found.dropDuplicates(["shape_id"]).collect()
    }
    shape_of = {r[0]: r[1] for r in found.select("path", "shape_id").collect()}
    groups: dict[int, list[hadoop.StoredFile]] = defaultdict(list)
    outcome: Outcome = {}
    for f in files:
        if f.path in shape_of:
            groups[shape_of[f.path]].append(f)
        else:
            outcome[f.path] = ValueError("file has no header line")

    shaped = {
        Shape(
            text.names,
            tests,
            partial(read_text_files, spark, shape=text),
            partial(_verdicts, names=text.names, tests=tests, drop_bad_rows=drop_bad_rows),
            drop_bad_rows,
            text.charset,
        ): groups[i]
        for i, text in texts.items()
    }
    return outcome | _measured(spark, shaped)


def _first_keys(head: list[bytes]) -> list[str] | None:
    """Keys of the first line where that is a whole JSON object, else None."""
    for raw in head:
        text = bytes(raw).decode("utf-8", "replace").strip()
        if text:
            try:
                first = json.loads(text)
            except ValueError:
                return None
            return list(first) if isinstance(first, dict) else None
    return []


def _columnar_tables(
    spark: SparkSession, files: list[hadoop.StoredFile], file_type: str, options: dict
) -> Outcome:
    """Parquet and JSON: the reader knows the types, text columns are cleaned and inferred."""
    keys: dict[str, list[str] | None] = {}
    if file_type != "parquet":
        heads = ln.profile(ln.text_lines(spark, [hadoop.literal(f.path) for f in files]), 1, 1)
        keys = {r["path"]: _first_keys(r["head"]) for r in heads.collect()}
    tests: Tests = dict(infer.GERMAN_TESTS)
    if file_type != "parquet":
        tests["timestamp"] = cv.iso_timestamp

    def reader(multiline: bool):
        if file_type == "parquet":
            return spark.read.options(**options).format("parquet")
        return spark.read.options(multiLine=multiline, **options).format("json")

    def schema_of(f: hadoop.StoredFile) -> Callable[[], tuple]:
        def run() -> tuple:
            first = keys.get(f.path, [])
            fields = reader(first is None).load(hadoop.literal(f.path)).schema.fields
            # The JSON reader sorts names; the file's own order reads better.
            at = {k: i for i, k in enumerate(first or ())}
            fields = sorted(fields, key=lambda c: at.get(c.name, len(at)))
            return first is None, T.StructType(fields).json()

        return run

    def read(paths: list[str], schema: T.StructType, names: list[str], multiline: bool):
        loaded = reader(multiline).schema(schema).load(paths)
        named = loaded.select(
            *[F.col(f"`{c}`").alias(n) for c, n in zip(schema.names, names)],
            F.col("_metadata.file_path").alias("_path"),
        )
        return infer.clean_columns(named)

    outcome: Outcome = {}
    groups: dict[tuple, list[hadoop.StoredFile]] = defaultdict(list)
    for f, found in zip(files, side_by_side(spark, [schema_of(f) for f in files])):
        if isinstance(found, Exception):
            outcome[f.path] = found
        else:
            groups[found].append(f)
    shaped = {}
    for (multiline, text), group in groups.items():
        schema = T.StructType.fromJson(json.loads(text))
        names = normalised(spark, schema.names)
        shape = Shape(
            tuple(names),
            tests,
            partial(read, schema=schema, names=names, multiline=multiline),
            partial(_verdicts, names=names, tests=tests),
        )
        shaped[shape] = group
    return outcome | _measured(spark, shaped)


def _workbook_tables(
    spark: SparkSession, files: list[hadoop.StoredFile], options: dict
) -> Outcome:
    """Workbooks, grouped by the names in their first row."""
    all_text = str(options.get("all_varchar", False)).lower() == "true"

    def headers(some: list[hadoop.StoredFile]) -> Callable[[], list[Row]]:
        """The headers of workbooks, in their order."""

        def run() -> list[Row]:
            read = workbook_headers(spark, [hadoop.literal(f.path) for f in some])
            told = {r["path"]: r for r in read.collect()}
            return [told[f.path] for f in some]

        return run

    try:
        found = headers(files)()
    except Exception:  # noqa: BLE001 - one workbook that cannot be read at all must not stop the others
        alone = side_by_side(spark, [headers([f]) for f in files])
        found = [one if isinstance(one, Exception) else one[0] for one in alone]
    outcome: Outcome = {}
    groups: dict[tuple, list[hadoop.StoredFile]] = defaultdict(list)
    for f, row in zip(files, found, strict=True):
        if isinstance(row, Exception):
            outcome[f.path] = row
        elif row["fault"] is not None:
            outcome[f.path] = ValueError(row["fault"])
        else:
            groups[row["row_no"], tuple(row["names"])].append(f)

    def read(paths: list[str], names: list[str], header_row: int) -> DataFrame:
        return workbook_texts(workbook_cells(spark, paths), names, header_row)

    shaped = {}
    for (header_row, given), group in groups.items():
        names = normalised(spark, list(given))
        shape = Shape(
            tuple(names),
            WORKBOOK_TESTS,
            partial(read, names=names, header_row=header_row),
            partial(workbook_verdicts, names=names, all_text=all_text),
        )
        shaped[shape] = group
    return outcome | _measured(spark, shaped)


class FolderResult(ImportResult):
    """Adds ``combined``: all tables as one frame, columns matched by name, with ``_file_name``.
    Files that are read and typed alike are one scan."""

    def __init__(self, spark, builders, report, loaded: list[Loaded], charsets=None):
        super().__init__(spark, builders, report, charsets=charsets)
        self._loaded = loaded

    @property
    def combined(self) -> DataFrame:
        alike: dict[tuple, list[str]] = defaultdict(list)
        for one in self._loaded:
            alike[(one.shape, one.verdicts)].append(one.place)
        frames = [shape.typed(places, verdicts) for (shape, verdicts), places in alike.items()]
        name = F.regexp_extract(ln.plain_path(F.col("_path")), "([^/]*)$", 1)
        named = [f.withColumn("_path", name).withColumnRenamed("_path", "_file_name") for f in frames]
        return stacked(named)


def import_folder(
    spark: SparkSession, path: str, file_type: str = "csv", **options
) -> FolderResult:
    """Import all files of a type in a folder, one table per file.

    Types: csv (.csv, .txt), tsv, parquet, json (.json, .jsonl), jsonl, xlsx or excel; any other
    type matches that extension and is read as CSV.  Options are reader options, such as
    ``delimiter=";"``, ``all_varchar=True``, ``skip=2``, ``header=False`` or ``encoding``.  The separator
    of delimited text is that of most lines.  Fields beyond the header's are cut and counted, and
    ``drop_bad_rows`` drops such rows; an option that delimited text does not take is refused.
    """
    kind = file_type.lower()
    options = {OPTION_NAMES.get(k, k): v for k, v in options.items()}

    def only(name: str, status: str) -> ImportResult:
        rows = [(name, "", 0, 0, status)]
        return FolderResult(spark, {}, report_frame(spark, rows, FILE_REPORT), [])

    if path_has_traversal(path):
        return only("(security)", TRAVERSAL)
    delimited = kind not in ("parquet", "json", "jsonl", "xlsx", "excel")
    unknown = sorted(set(options) - set(TEXT_OPTIONS)) if delimited else []
    if unknown:
        known = ", ".join(TEXT_OPTIONS)
        return only("(options)", f"Unknown options: {', '.join(unknown)}. Known: {known}")
    if options.get("encoding"):
        try:
            cs.readable(options["encoding"])
        except (LookupError, ValueError) as error:
            return only("(options)", short_message(error))
    files = matching_files(spark, path.replace("\\", "/"), kind)
    if not files:
        return only("(no files)", f"No matching files found for type: {file_type}")
    try:
        if kind in ("parquet", "json", "jsonl"):
            loaded = _columnar_tables(spark, files, kind, options)
        elif kind in ("xlsx", "excel"):
            loaded = _workbook_tables(spark, files, options)
        else:
            loaded = _text_tables(spark, files, kind, options)
    except Exception as error:  # noqa: BLE001 - reported
        loaded = {f.path: error for f in files}

    stems = spark.createDataFrame([(f.name,) for f in files], "name string")
    tables = {r[0]: r[1] for r in stems.select("name", table_of_file(F.col("name"))).collect()}
    taken: set[str] = set()
    builders, report, kept, charsets = {}, [], [], []
    for f in files:
        result = loaded[f.path]
        table = tables[f.name]
        if isinstance(result, Exception):
            report.append((table, f.name, 0, 0, f"Load failed: {short_message(result)}"))
            continue
        name = _free_name(table, taken)
        status = "OK" if name == table else f"OK (several files are called '{table}')"
        if result.notes:
            shared = [] if name == table else [f"several files are called '{table}'"]
            status = "Warning: " + "; ".join(result.notes + shared)
        if result.shape.charset:
            charsets.append((name, result.shape.charset))
        builders[name] = result.build
        kept.append(result)
        report.append((name, f.name, result.row_count, len(result.shape.names), status))
    told = report_frame(spark, charsets, CHARSET_REPORT)
    return FolderResult(spark, builders, report_frame(spark, report, FILE_REPORT), kept, told)
