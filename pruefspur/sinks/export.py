"""Audit export: any flat DataFrame to ``index.xml`` plus a ``;``-delimited data file."""

from __future__ import annotations

import uuid
import xml.etree.ElementTree as ET

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import hadoop
from ..functions import convert as cv
from ..operators.report import EXPORT_REPORT, TRAVERSAL, report_frame, short_message
from ..sources.audit import path_has_traversal

CSV_OPTIONS = {
    "sep": ";",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def export_kind(field: T.StructField, double_scale: int = 2) -> tuple[str, int]:
    """Type element and accuracy of a column."""
    kind = field.dataType
    if isinstance(kind, T.DecimalType):
        return "Numeric", kind.scale
    if isinstance(kind, T.IntegralType):
        return "Numeric", 0
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return "Numeric", double_scale
    if isinstance(kind, T.DateType):
        return "Date", 0
    text_like = (T.StringType, T.CharType, T.VarcharType, T.BooleanType, T.TimestampType,
                 T.TimestampNTZType, T.NullType)
    if isinstance(kind, text_like):
        return "AlphaNumeric", 0
    raise TypeError(f"column '{field.name}' of type {kind.simpleString()} cannot be exported")


def _is_key(field: T.StructField) -> bool:
    return bool((field.metadata or {}).get("primary_key"))


def export_order(schema: T.StructType) -> list[T.StructField]:
    """Columns in file order: an index lists primary keys first."""
    return sorted(schema.fields, key=lambda f: not _is_key(f))


def export_column(field: T.StructField, double_scale: int = 2) -> Column:
    """The text form of a column."""
    c = F.col(f"`{field.name}`")
    kind, _ = export_kind(field, double_scale)
    if kind == "Date":
        return cv.export_date(c)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return cv.export_decimal(c, double_scale)
    if isinstance(field.dataType, T.DecimalType):
        return cv.export_decimal(c)
    if kind == "Numeric":
        return cv.export_integer(c)
    return cv.export_text(c)


def _beyond_decimal(c: Column, scale: int) -> Column:
    """True for floating-point values that have no decimal text: nan, inf, too large."""
    return F.isnan(c) | (F.abs(c) >= F.lit(10.0 ** (38 - scale)))


def export_rows(df: DataFrame, double_scale: int = 2) -> DataFrame:
    """Every column in its exported text form, in file order."""
    return df.select(
        *[export_column(f, double_scale).alias(f.name) for f in export_order(df.schema)]
    )


def index_xml(tables: dict[str, T.StructType], media_name: str, double_scale: int = 2) -> str:
    """The index describing exported tables by name."""

    def add(parent: ET.Element, tag: str, text: str | None = None) -> ET.Element:
        child = ET.SubElement(parent, tag)
        child.text = text
        return child

    root = ET.Element("DataSet")
    media = add(root, "Media")
    add(media, "Name", media_name)
    for name, schema in tables.items():
        table = add(media, "Table")
        for tag, text in (
            ("Name", name),
            ("Description", name),
            ("URL", f"{name}.txt"),
            ("UTF8", None),
            ("DecimalSymbol", ","),
            ("DigitGroupingSymbol", "."),
        ):
            add(table, tag, text)
        add(add(table, "Range"), "From", "1")
        body = add(table, "VariableLength")
        for field in export_order(schema):
            column = add(body, "VariablePrimaryKey" if _is_key(field) else "VariableColumn")
            add(column, "Name", field.name)
            description = (field.metadata or {}).get("description")
            if description:
                add(column, "Description", description)
            kind, accuracy = export_kind(field, double_scale)
            element = add(column, kind)
            digits = getattr(field.dataType, "precision", 0)
            if accuracy > 0:
                add(element, "Accuracy", str(accuracy))
                if digits > 18:
                    # Without a length a reader takes 18 digits.
                    add(column, "MaxLength", str(digits))
    ET.indent(root, "  ")
    return '<?xml version="1.0" encoding="UTF-8"?>\n' + ET.tostring(root, encoding="unicode") + "\n"


def export_table(
    df: DataFrame,
    path: str,
    name: str,
    *,
    single_file: bool = True,
    double_scale: int = 2,
) -> DataFrame:
    """Write ``<path>/<name>.txt`` and ``<path>/index.xml``; the result is the report.

    Rows are written in parallel parts.  With ``single_file`` they become one file ``<name>.txt``,
    whatever their size: the file system joins them in place where it can, tasks write them to their
    places where it is mounted, and otherwise they are streamed one after the other.  Without it ``<name>.txt`` is a folder of parts, which every
    import here reads as one table, and the status says so.
    """
    spark = df.sparkSession

    def report(rows: int, status: str, where: str = path) -> DataFrame:
        return report_frame(spark, [(name, where, rows, status)], EXPORT_REPORT)

    if path_has_traversal(path) or path_has_traversal(name) or "/" in name:
        return report(0, TRAVERSAL)
    if not df.columns:
        return report(0, "Table has no columns")
    try:
        index = index_xml({name: df.schema}, name, double_scale)
        folder = hadoop.qualified(spark, hadoop.make_dirs(spark, path.replace("\\", "/")))
        target = hadoop.join(folder, f"{name}.txt")
        lost = [
            F.count_if(_beyond_decimal(F.col(f"`{f.name}`"), double_scale)).alias(f"lost{i}")
            for i, f in enumerate(df.schema.fields)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        ]
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *lost)
        # Parts are written where they may stay, so that a large table is never moved.
        hadoop.delete(spark, target)
        export_rows(counted, double_scale).write.csv(target, **CSV_OPTIONS)
        parts = [f for f in hadoop.list_files(spark, target) if f.name.startswith("part-")]
        joined = hadoop.join(folder, f"_joined-{uuid.uuid4().hex[:12]}")
        if single_file:
            places = [p.path for p in parts]
            if not hadoop.concatenate(spark, places, joined):
                hadoop.join_parts(spark, parts, joined)
            hadoop.replace_by_rename(spark, joined, target)
        hadoop.write_bytes(spark, hadoop.join(folder, "index.xml"), index.encode())
    except Exception as error:  # noqa: BLE001 - reported
        return report(0, f"Export failed: {short_message(error)}")
    counts = dict(seen.get)
    rows = counts.pop("rows")
    dropped = sum(counts.values())
    notes = []
    if dropped:
        notes.append(f"{dropped} values are not finite numbers and became empty")
    status = "Warning: " + "; ".join(notes) if notes else "OK"
    return report(rows, status if single_file else f"{status} (a folder of parts)", folder)
