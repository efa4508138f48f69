"""Audit-export import: an index plus headerless delimited files to typed tables."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import hadoop
from ..functions import charset as cs
from ..functions import convert as cv
from ..operators import checks
from ..operators.report import (
    CHARSET_REPORT,
    IMPORT_REPORT,
    REJECT_REPORT,
    TRAVERSAL,
    ImportResult,
    report_frame,
    short_message,
    side_by_side,
)
from . import lines as ln
from .index_catalog import AUDIT, LAYOUTS, IndexLayout, index_catalog
from .records import Starts, records, split_starts


#: Bytes of a file's start that tell a wide charset.
FIRST_BYTES = 512


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    kind: str
    type: str
    precision: int = 0
    is_primary_key: bool = False
    description: str = ""


@dataclass(frozen=True)
class TableSpec:
    """One table of an export: where its data lies and how to read it."""

    name: str
    paths: tuple[str, ...]
    columns: tuple[ColumnSpec, ...]
    decimal: str = ","
    grouping: str = "."
    skip: int = 0
    sep: str = ";"
    strict_dates: bool = False
    is_utf8: bool = False
    place: str = ""

    @property
    def keys(self) -> list[str]:
        return [c.name for c in self.columns if c.is_primary_key]

    @property
    def schema(self) -> T.StructType:
        fields = [
            T.StructField(
                c.name,
                T.DataType.fromDDL(c.type),
                True,
                {"primary_key": c.is_primary_key, "description": c.description},
            )
            for c in self.columns
        ]
        return T.StructType(fields)


def table_spec(row: Row, place: str, layout: IndexLayout, name: str | None = None) -> TableSpec:
    """Table description from a catalog row and the place of its data, if it is a file of its own."""
    columns = tuple(
        ColumnSpec(c["name"], c["kind"], c["type"], c["precision"], c["is_primary_key"],
                   c["description"])
        for c in row["columns"]
    )
    return TableSpec(
        name=name or row["table_name"],
        paths=(hadoop.literal(place),) if place else (),
        place=place,
        columns=columns,
        decimal=row["decimal_symbol"],
        grouping=row["digit_grouping"],
        skip=row["skip_lines"] + (1 if layout.has_header else 0),
        sep=layout.delimiter,
        strict_dates=layout.strict_dates,
        is_utf8=row["is_utf8"],
    )


def typed(raw: Column, column: ColumnSpec, spec: TableSpec) -> Column:
    """The declared type of a column from its raw text."""
    if column.type.startswith("decimal"):
        p, s = re.findall(r"\d+", column.type)
        return cv.to_decimal(raw, int(p), int(s), spec.decimal, spec.grouping)
    if column.type == "bigint":
        return cv.to_integer(raw, spec.grouping)
    if column.type == "date":
        return cv.to_date(raw)
    return cv.clean_text(raw)


def raw_lines(
    spark: SparkSession, spec: TableSpec, charset: str | None = None, cuts: ln.Cuts | None = None
) -> DataFrame:
    """The lines of a table after those to skip, undecoded unless the charset is a wide one."""
    scanned = ln.text_lines(spark, list(spec.paths), charset, cuts)
    return ln.drop_head(scanned.select("path", "block", "more", "value"), spec.skip)


def raw_fields(
    spark: SparkSession, spec: TableSpec, charset: str | None, starts: Starts | None = None,
    cuts: ln.Cuts | None = None,
) -> DataFrame:
    """The rows of a table as a struct ``fields`` of text, with the raw ``value`` and whether it is
    a ``long_row``.

    ``charset`` None leaves bytes as they are, which is enough for counting.  ``starts`` makes
    lines within quotes part of one record; ``cuts`` are those of a wide charset, if known.
    """
    width = len(spec.columns)
    rows = raw_lines(spark, spec, charset, cuts)
    if starts is not None:
        rows = records(rows, starts, spec.sep)
    rows = ln.without_blank_lines(rows, width)
    text = F.col("value")
    if charset is not None and not (cs.is_utf8(charset) or cs.is_wide(charset)):
        text = cs.decoded(text.cast("binary"), charset)
    return rows.select(
        ln.split_fields(text, width, spec.sep).alias("fields"),
        ln.surplus(text, width, spec.sep).alias("long_row"),
        "value",
    )


def typed_frame(
    fields: DataFrame, spec: TableSpec, whole_rows_only: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """The declared columns, converted and cleaned in one projection, after any to ``keep``."""
    if whole_rows_only:
        fields = ln.only_whole_rows(fields)
    columns = []
    for field, column, raw in zip(spec.schema, spec.columns, ln.raw_names(len(spec.columns))):
        value = typed(F.col(f"fields.{raw}"), column, spec)
        columns.append(value.alias(column.name, metadata=field.metadata))
    return fields.select(*keep, *columns)


def check_frame(
    fields: DataFrame,
    spec: TableSpec,
    line_checks: tuple[Column, Column] | None = None,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Counts about a table, from one scan without a shuffle of its rows; one row, or one per
    value of ``by``.  ``line_checks`` are two flags per line: valid UTF-8, odd quotes."""
    names = ln.raw_names(len(spec.columns))
    values = [typed(F.col(f"fields.{n}"), c, spec) for n, c in zip(names, spec.columns)]
    utf8, odd = line_checks or (F.lit(True), F.lit(False))
    prepared = fields.select(
        *by,
        *[F.col(f"fields.{n}").alias(f"r{i}") for i, n in enumerate(names)],
        *[v.alias(f"t{i}") for i, v in enumerate(values)],
        "long_row",
        utf8.alias("utf8"),
        odd.alias("odd"),
    )
    rejects = {
        f"x{i}": cv.rejected(F.col(f"r{i}"), F.col(f"t{i}"), blank_ok=c.type == "date")
        for i, c in enumerate(spec.columns)
        if c.type != "string"
    }
    return prepared.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(
            checks.any_beyond_first([F.col(f"t{i}") for i in range(len(names))])
        ).alias("filled"),
        F.count_if("long_row").alias("long_rows"),
        F.coalesce(F.bool_and("utf8"), F.lit(True)).alias("utf8"),
        F.count_if("odd").alias("odd_quotes"),
        *checks.reject_counts(rejects),
    )


def judged(counts: DataFrame, spec: TableSpec, on_error: str) -> DataFrame:
    """Adds ``status`` and ``usable`` to counts that also hold ``utf8``, ``odd_quotes``,
    ``null_keys`` and ``surplus_rows``."""
    strict = [
        (c.name, F.col(f"x{i}"))
        for i, c in enumerate(spec.columns)
        if c.type != "string" and (c.type != "date" or spec.strict_dates)
    ]
    bad = checks.listed(strict) if strict else F.lit("")
    key_faults = F.col("null_keys") + F.col("surplus_rows")
    notes = F.concat_ws(
        "; ",
        F.when(bad != "", F.concat(F.lit("values that do not convert became NULL ("), bad, F.lit(")"))),
        F.when(
            key_faults > 0,
            F.concat(
                F.lit("primary key: "),
                F.col("null_keys").cast("string"),
                F.lit(" rows with NULL, "),
                F.col("surplus_rows").cast("string"),
                F.lit(" repeated rows"),
            ),
        ),
        F.when(
            F.col("long_rows") > 0,
            F.concat(
                F.col("long_rows").cast("string"),
                F.lit(" rows have more fields than declared, which were cut"),
            ),
        ),
        F.when(
            F.col("odd_quotes") > 0,
            F.concat(
                F.col("odd_quotes").cast("string"),
                F.lit(" lines with an open quote, read each for itself"),
            ),
        ),
        F.when(F.lit(spec.is_utf8) & ~F.col("utf8"), "index declares UTF-8, data is not"),
    )
    fail = F.lit(on_error == "fail")
    status = (
        F.when(
            fail & (bad != ""),
            F.concat(F.lit("Load failed: values that do not convert ("), bad, F.lit(")")),
        )
        .when(fail & (key_faults > 0), "Load failed: NULL or repeated primary keys")
        .when(fail & (F.col("long_rows") > 0), "Load failed: rows with more fields than declared")
        .when(F.col("row_count") == 0, "Empty")
        .when(
            F.lit(len(spec.columns) > 1) & (F.col("filled") == 0),
            checks.DELIMITER_WARNING.format(sep=spec.sep),
        )
        .when(notes != "", F.concat(F.lit("Warning: "), notes))
        .otherwise("OK")
    )
    usable = (F.col("row_count") > 0) & ~(
        fail & ((bad != "") | (key_faults > 0) | (F.col("long_rows") > 0))
    )
    return counts.select("*", status.alias("status"), usable.alias("usable"))


@dataclass(frozen=True)
class Checked:
    row_count: int
    status: str
    charset: str
    rejects: tuple[tuple[str, int], ...] = ()
    usable: bool = True
    starts: Starts | None = None
    cuts: ln.Cuts | None = None


def check_table(
    spark: SparkSession,
    spec: TableSpec,
    charset: str | None,
    on_error: str,
    check_keys: bool,
    multiline: bool | None,
    drop_bad_rows: bool = False,
) -> Checked:
    """Counts about the rows that will be loaded.

    One scan says whether the table is UTF-8 and whether quotes span lines.  Where the answer is
    not what that scan took for granted, the counts are taken again from the rows as they will be.
    The first bytes of the data tell a wide charset; which other one it is, all of its lines that are not
    UTF-8 say.
    """
    if charset is not None:
        cs.readable(charset)  # refuses what cannot be decoded before anything is read
    else:
        charset = cs.wide_order(hadoop.first_bytes(spark, spec.place, FIRST_BYTES))
    cuts = ln.Cuts(spark, list(spec.paths), charset) if cs.is_wide(charset) else None
    starts = split_starts(raw_lines(spark, spec, charset, cuts), spec.sep) if multiline else None
    line = F.col("value")
    flags = (ln.valid_utf8(line), ln.odd_quotes(line))

    def counted(read_as: str | None) -> dict:
        fields = raw_fields(spark, spec, read_as, starts, cuts)
        if not drop_bad_rows:
            return check_frame(fields, spec, flags).head().asDict()
        got = check_frame(ln.only_whole_rows(fields), spec, flags).head().asDict()
        return got | {"dropped": fields.where("long_row").count()}

    found = counted(charset)
    chosen = charset or "utf-8"
    if not (charset or found["utf8"]):
        chosen = ln.charset_of(raw_lines(spark, spec), cs.EXPORT_CHARSETS).head()["charset"]
    spans = multiline is None and found["odd_quotes"] > 0
    if spans:
        starts = split_starts(raw_lines(spark, spec, chosen, cuts), spec.sep)
    if spans or not (charset or cs.is_utf8(chosen)):
        found = counted(chosen)
    dropped = found.pop("dropped", 0)
    found |= {"null_keys": 0, "surplus_rows": 0}
    if check_keys and spec.keys and found["row_count"]:
        table = typed_frame(raw_fields(spark, spec, chosen, starts, cuts), spec, drop_bad_rows)
        keys = checks.key_check(table, spec.keys).head()
        found |= {"null_keys": keys["null_keys"], "surplus_rows": keys["surplus_rows"]}
    verdict = judged(spark.createDataFrame([Row(**found)]), spec, on_error).head()
    rejects = tuple(
        (c.name, found[f"x{i}"]) for i, c in enumerate(spec.columns) if found.get(f"x{i}")
    )
    rows = found["row_count"] if verdict["usable"] else 0
    status = verdict["status"]
    if dropped:
        note = f"{dropped} rows with more fields than declared were dropped"
        status = f"Warning: {note}" if status == "OK" else f"{status}; {note}"
    return Checked(rows, status, chosen, rejects, verdict["usable"], starts, cuts)


def path_has_traversal(path: str) -> bool:
    return ".." in path.replace("\\", "/").split("/")


def _free_name(name: str, taken: set[str]) -> str:
    number, free = 1, name
    while free in taken:
        number += 1
        free = f"{name}_{number}"
    taken.add(free)
    return free


def import_export_layout(
    spark: SparkSession,
    path: str,
    layout: IndexLayout = AUDIT,
    *,
    on_error: str = "null",
    charset: str | None = None,
    multiline: bool | None = None,
    check_keys: bool = True,
    drop_bad_rows: bool = False,
) -> ImportResult:
    """Import every table that the index of an export folder describes.

    ``on_error="fail"`` refuses a table with values that do not convert or with bad keys; the
    default keeps it, turns such values into NULL and reports them.  ``charset`` skips the choice
    of one, which ``ImportResult.charsets`` tells.  Line breaks within quotes are read
    where the file has any, which takes one more scan; ``multiline`` True or False settles it
    beforehand.  ``drop_bad_rows`` drops and counts rows with more fields than declared.
    """
    if path_has_traversal(path):
        return _only_status(spark, "(security)", TRAVERSAL)
    folder = path.replace("\\", "/").rstrip("/")
    index_path = hadoop.join(folder, layout.index_file)
    try:
        if not hadoop.exists(spark, index_path):
            raise FileNotFoundError(f"no {layout.index_file} at '{index_path}'")
        catalog = index_catalog(spark, hadoop.literal(index_path), layout).collect()
    except Exception as error:  # noqa: BLE001 - reported
        return _only_status(spark, "(schema)", f"Parse error: {short_message(error)}")
    faults = [r["error"] for r in catalog if r["error"]]
    if faults:
        return _only_status(spark, "(schema)", f"Parse error: {faults[0]}")

    def prepare(row: Row, name: str) -> Callable[[], Checked | str]:
        def run() -> Checked | str:
            if not row["columns"]:
                return "Create failed: no columns declared"
            if any(not c["name"] for c in row["columns"]):
                return "Create failed: a column has no name"
            if path_has_traversal(row["url"]):
                return f"Path traversal in table URL: {row['url']}"
            data = hadoop.join(folder, row["url"].replace("\\", "/"))
            if not row["url"] or not hadoop.exists(spark, data):
                return f"Load failed: no data file '{row['url']}'"
            spec = specs[name] = table_spec(row, data, layout, name)
            return check_table(
                spark, spec, charset, on_error, check_keys, multiline, drop_bad_rows
            )

        return run

    rows = [r for r in catalog if r["table_no"] is not None]
    rows.sort(key=lambda r: r["table_no"])
    specs: dict[str, TableSpec] = {}
    taken: set[str] = set()
    names = [_free_name(r["table_name"], taken) for r in rows]
    outcomes = side_by_side(spark, [prepare(r, n) for r, n in zip(rows, names)])

    builders: dict[str, Callable[[], DataFrame]] = {}
    report, rejects, charsets = [], [], []
    for name, outcome in zip(names, outcomes):
        if isinstance(outcome, Checked):
            report.append((name, outcome.row_count, outcome.status))
            charsets.append((name, outcome.charset))
            rejects += [(name, column, n) for column, n in outcome.rejects]
            if outcome.usable:
                builders[name] = _builder(spark, specs[name], outcome, drop_bad_rows)
        elif isinstance(outcome, str):
            report.append((name, 0, outcome))
        else:
            report.append((name, 0, f"Load failed: {short_message(outcome)}"))
    return ImportResult(
        spark,
        builders,
        report_frame(spark, report, IMPORT_REPORT),
        report_frame(spark, rejects, REJECT_REPORT),
        report_frame(spark, charsets, CHARSET_REPORT),
    )


def _builder(spark, spec, checked: Checked, drop_bad_rows: bool) -> Callable[[], DataFrame]:
    return lambda: typed_frame(
        raw_fields(spark, spec, checked.charset, checked.starts, checked.cuts), spec, drop_bad_rows
    )


def _only_status(spark: SparkSession, name: str, status: str) -> ImportResult:
    return ImportResult(spark, {}, report_frame(spark, [(name, 0, status)], IMPORT_REPORT))


def import_export(
    spark: SparkSession, path: str, column_source: str = "Name", **options
) -> ImportResult:
    """Import an audit export.  ``column_source`` names the element the column names come from,
    ``Name`` or ``Description``; an empty one falls back to ``Name``."""
    return import_export_layout(spark, path, AUDIT.with_names_from(column_source), **options)


def import_datev_export(spark: SparkSession, path: str, **options) -> ImportResult:
    """Import an audit export written by DATEV software: names come from ``Name``."""
    return import_export(spark, path, "Name", **options)


def import_index(
    spark: SparkSession, path: str, layout: str | IndexLayout = "audit", **options
) -> ImportResult:
    """Import by a registered layout (``audit``, ``generic``) or one of your own."""
    if isinstance(layout, str):
        if layout not in LAYOUTS:
            known = ", ".join(sorted(LAYOUTS))
            return _only_status(
                spark, "(parser)", f"Parser type '{layout}' not found. Available: {known}"
            )
        layout = LAYOUTS[layout]
    return import_export_layout(spark, path, layout, **options)
