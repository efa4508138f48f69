"""DATEV booking batches: ``EXTF_Buchungsstapel*.csv`` files to typed tables.

Line 1 of a file gives the year, line 2 the column names, the rest is data.  One scan profiles
all files (head lines, counts, charset).  Files that share columns, year and charset are then
read as one frame, so header values are constants of that frame and no join is needed.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import hadoop
from ..functions import charset as cs
from ..functions import convert as cv
from ..functions.names import batch_column, dedupe_names
from ..operators.report import (
    BATCH_REPORT,
    REJECT_REPORT,
    TRAVERSAL,
    ImportResult,
    report_frame,
    short_message,
    side_by_side,
)
from ..operators.union import stacked
from . import lines as ln
from .audit import path_has_traversal
from .records import Starts, records, split_starts

# Fixed values of the file format.
FILE_PREFIX = "EXTF_Buchungsstapel"
FILE_SUFFIX = ".csv"
HEADER_LINES = 2
PERIOD_START_FIELD = 14
COLUMN_TYPES = {
    "belegdatum": "date",
    "umsatz_ohne_soll_haben_kz": "decimal(18,2)",
    "basis_umsatz": "decimal(18,2)",
    "kurs": "decimal(18,6)",
}

_SEMICOLON_OUTSIDE_QUOTES = r';(?=(?:[^"]*"[^"]*")*[^"]*$)'


def header_fields(line: Column) -> Column:
    """A header line as an array of its fields, unquoted and trimmed."""

    def unquoted(field: Column) -> Column:
        inner = F.regexp_replace(F.trim(field, F.lit(" \t\r")), '^"(.*)"$', "$1")
        return F.trim(F.replace(inner, F.lit('""'), F.lit('"')), F.lit(" \t\r"))

    return F.transform(F.split(line, _SEMICOLON_OUTSIDE_QUOTES), unquoted)


def header_year(line: Column) -> Column:
    """Year of the period start, NULL where the line does not give one."""
    period = F.get(header_fields(line), PERIOD_START_FIELD)
    return F.regexp_extract(period, r"^(\d{4})", 1).try_cast("int")


def header_columns(line: Column) -> Column:
    """Column names from line 2; an unnamed column is called by its position."""
    fields = header_fields(line)
    named = F.transform(
        fields,
        lambda f, i: F.coalesce(
            F.nullif(batch_column(f), F.lit("")), F.concat(F.lit("column_"), (i + 1).cast("string"))
        ),
    )
    return F.when(F.length(line) > 0, named)


def booking_value(name: str, raw: Column, year: Column | int) -> Column:
    kind = COLUMN_TYPES.get(name)
    if kind == "date":
        return cv.voucher_date(raw, year)
    if kind == "decimal(18,2)":
        return cv.booking_decimal(raw, 18, 2)
    if kind == "decimal(18,6)":
        return cv.booking_decimal(raw, 18, 6)
    return raw


def batch_profile(spark: SparkSession, paths: list[str], charset: str | None) -> DataFrame:
    """One row per file: path, year, columns, data rows, charset."""
    heads = ln.profiles(spark, paths, HEADER_LINES, HEADER_LINES, cs.BOOKING_CHARSETS, charset=charset)
    lines = heads.withColumns({"line1": F.get("head", F.lit(0)), "line2": F.get("head", F.lit(1))})
    named = lines.withColumn("_names", header_columns(F.col("line2")))
    columns = named.withColumn("columns", dedupe_names(F.col("_names")))
    # Blank lines are no rows, save in one-column files.
    rows = F.col("lines") - HEADER_LINES
    rows = F.when(F.size("columns") > 1, rows - F.col("blank_lines")).otherwise(rows)
    return columns.select(
        "path",
        header_year(F.col("line1")).alias("year"),
        "columns",
        F.greatest(rows, F.lit(0)).alias("row_count"),
        "charset",
        "odd_quotes",
    )


def booking_starts(spark: SparkSession, paths: list[str], charset: str) -> Starts:
    """Which splits of the files start inside quotes, and which files end with a quote open."""
    return split_starts(ln.text_lines(spark, paths, charset), ";", HEADER_LINES)


def booking_frame(
    spark: SparkSession, paths: list[str], columns: list[str], year: int, charset: str,
    spans: bool = False, starts: Starts | None = None, raw: bool = False,
) -> DataFrame:
    """Rows of files that share columns, year and charset; ``raw`` adds the text of the typed
    columns as ``_raw_<name>``, and ``_long_row`` for rows with surplus fields.  With ``spans`` a
    quoted field may hold line breaks; ``starts`` are those of the same files, if known."""
    body = ln.text_lines(spark, paths, charset)
    if spans:
        starts = booking_starts(spark, paths, charset) if starts is None else starts
        joined = records(body, starts, ";", HEADER_LINES)
        body = joined.withColumn("file_name", F.substring_index("path", "/", -1))
    else:
        body = ln.drop_head(body, HEADER_LINES)
    body = ln.without_blank_lines(body, len(columns))
    text = F.col("value")
    if not (cs.is_utf8(charset) or cs.is_wide(charset)):
        text = cs.decoded(text.cast("binary"), charset)
    fields = body.select(
        ln.split_fields(text, len(columns)).alias("fields"),
        ln.plain_path(F.col("file_name")).alias("file_name"),
        ln.surplus(text, len(columns)).alias("long_row"),
    )
    cells = {n: F.col(f"fields.{r}") for n, r in zip(columns, ln.raw_names(len(columns)))}
    shown = [booking_value(n, c, year).alias(n) for n, c in cells.items()]
    extra = [c.alias(f"_raw_{n}") for n, c in cells.items() if raw and n in COLUMN_TYPES]
    extra += [F.col("long_row").alias("_long_row")] if raw else []
    # A column of the file that is itself called file_name keeps its place.
    tail = "file_name" if "file_name" not in cells else "source_file_name"
    return fields.select(*shown, *extra, F.col("file_name").alias(tail))


class BookingResult(ImportResult):
    """Adds ``combined``: all batches as one frame, columns matched by name."""

    def __init__(self, spark, tables, report, groups: list[tuple], rejects=None):
        super().__init__(spark, tables, report, rejects)
        self._groups = groups

    @property
    def combined(self) -> DataFrame:
        return stacked([booking_frame(self.spark, *group) for group in self._groups])

    def reject_counts(self) -> DataFrame:
        """Values per file and column that were present but did not convert."""
        counted = [
            batch_faults(self.spark, *group).select("file_name", F.inline("counts"))
            for group in self._groups
            if set(group[1]) & set(COLUMN_TYPES)
        ]
        if not counted:
            return self.spark.createDataFrame(
                [], "file_name string, column_name string, rejected bigint"
            )
        return reduce(DataFrame.unionByName, counted)


def batch_faults(
    spark: SparkSession, paths: list[str], columns: list[str], year: int, charset: str,
    spans: bool = False, starts: Starts | None = None,
) -> DataFrame:
    """Per file of a group: its rows, those with surplus fields, and in ``counts`` the values per typed
    column that were present but did not convert.  One scan; counts are combined before the shuffle."""
    frame = booking_frame(spark, paths, columns, year, charset, spans, starts, raw=True)
    rejected = [
        F.struct(
            F.lit(n).alias("column_name"),
            F.count_if(cv.rejected(F.col(f"_raw_{n}"), F.col(n), blank_ok=True)).alias("rejected"),
        )
        for n in columns
        if n in COLUMN_TYPES
    ]
    counts = F.array(*rejected).cast("array<struct<column_name: string, rejected: bigint>>")
    return frame.groupBy(F.col(frame.columns[-1]).alias("file_name")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("_long_row").alias("long_rows"), counts.alias("counts")
    )


def batch_files(spark: SparkSession, folder: str) -> list[hadoop.StoredFile]:
    return [
        f
        for f in hadoop.list_files(spark, folder)
        if not f.is_dir
        and f.name.startswith(FILE_PREFIX)
        and f.name.lower().endswith(FILE_SUFFIX)
    ]


def read_booking_batches(
    spark: SparkSession, path: str, charset: str | None = None, on_error: str = "null"
) -> BookingResult:
    """Import every booking batch of a folder: a table per file, and all of them ``combined``.

    Dates take their year from the start of the batch period, so a period crossing the turn of
    the year gives its later months the earlier year.  Values that do not convert become NULL and
    surplus fields are cut; both are in the status, and ``on_error="fail"`` refuses such a file.
    Line breaks within quotes are read where a file has open quotes, which takes another scan of
    it; in a file that ends with a quote open, quotes are taken not to span lines, and it says so.
    """

    def only(name: str, status: str) -> BookingResult:
        return BookingResult(
            spark, {}, report_frame(spark, [(name, "", 0, status)], BATCH_REPORT), []
        )

    if path_has_traversal(path):
        return only("(security)", TRAVERSAL)
    files = batch_files(spark, path.replace("\\", "/"))
    if not files:
        return only(
            "(no files)", f"No Buchungsstapel files found (expected {FILE_PREFIX}*.csv)"
        )
    try:
        paths = [hadoop.literal(f.path) for f in files]
        profile = hadoop.reliable(batch_profile(spark, paths, charset))
        layouts = {
            r["id"]: r["columns"]
            for r in profile.select(F.xxhash64("columns").alias("id"), "columns")
            .distinct()
            .collect()
        }
        known = {
            r["path"]: r
            for r in profile.select(
                "path", "year", F.xxhash64("columns").alias("id"), "row_count", "charset",
                "odd_quotes", F.col("columns").isNotNull().alias("named"),
            ).collect()
        }
    except Exception as error:  # noqa: BLE001 - reported
        return only("(import)", f"Load failed: {short_message(error)}")

    groups: dict[tuple, list[hadoop.StoredFile]] = defaultdict(list)
    builders: dict[str, Callable[[], DataFrame]] = {}
    report, rejects = [], []
    for f in files:
        row = known.get(f.path)
        if row is None or row["year"] is None:
            status = "Failed to parse header (could not extract year from Datum-von field)"
            report.append((_table(f), f.name, 0, status))
        elif not row["named"]:
            report.append((_table(f), f.name, 0, "Failed to parse column names from row 2"))
        else:
            groups[(row["id"], row["year"], row["charset"], row["odd_quotes"] > 0)].append(f)

    def group(key: tuple, members: list[hadoop.StoredFile]) -> tuple:
        return [hadoop.literal(f.path) for f in members], layouts[key[0]], *key[1:]

    def faults(key: tuple) -> Callable[[], tuple[dict, set, Starts | None]]:
        """What was seen in the files of a group, the names of those that end with a quote open, and
        where the splits start inside quotes."""

        def run() -> tuple[dict, set, Starts | None]:
            given = group(key, groups[key])
            paths, _, _, charset, spans = given
            starts = booking_starts(spark, paths, charset) if spans else None
            name = ln.plain_path(F.element_at(F.split("path", "/"), -1)).alias("name")
            left_open = starts.plain_paths.select(name).collect() if spans else []
            seen = batch_faults(spark, *given, starts=starts).collect()
            return {r["file_name"]: r for r in seen}, {r["name"] for r in left_open}, starts

        return run

    kept = []
    for key, found in zip(groups, side_by_side(spark, [faults(k) for k in groups])):
        usable = []
        for f in groups[key]:
            if isinstance(found, Exception):
                report.append((_table(f), f.name, 0, f"Load failed: {short_message(found)}"))
                continue
            row, seen = known[f.path], found[0].get(f.name)
            count = row["row_count"]
            if row["odd_quotes"]:
                count = seen["rows"] if seen else 0
            bad = [c for c in seen["counts"] if c["rejected"]] if seen else []
            rejects += [(_table(f), c["column_name"], c["rejected"]) for c in bad]
            notes = []
            if bad:
                named = ", ".join(f"{c['column_name']}: {c['rejected']}" for c in bad)
                notes.append(f"values that do not convert became NULL ({named})")
            if seen and seen["long_rows"]:
                notes.append(f"{seen['long_rows']} rows have more fields than declared, which were cut")
            if notes and on_error == "fail":
                report.append((_table(f), f.name, 0, "Load failed: " + "; ".join(notes)))
                continue
            if f.name in found[1]:
                notes.append(f"{row['odd_quotes']} lines with an open quote")
            status = "Warning: " + "; ".join(notes) if notes else "OK"
            report.append((_table(f), f.name, count, status))
            builders[_table(f)] = _builder(spark, *group(key, [f]))
            usable.append(f)
        if usable:
            # A scan of fewer files may split them elsewhere.
            starts = found[2] if len(usable) == len(groups[key]) else None
            kept.append((*group(key, usable), starts))
    return BookingResult(
        spark,
        builders,
        report_frame(spark, sorted(report, key=lambda r: r[1]), BATCH_REPORT),
        kept,
        report_frame(spark, rejects, REJECT_REPORT),
    )


def _table(file: hadoop.StoredFile) -> str:
    return file.name[: -len(FILE_SUFFIX)]


def _builder(spark, *group) -> Callable[[], DataFrame]:
    return lambda: booking_frame(spark, *group)
