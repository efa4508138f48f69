"""Index files (``index.xml``) to a catalog: one row per index and table.

The whole catalog is one Spark job over any number of indexes: bytes -> ``from_xml`` with an
explicit schema -> one row per table, its columns as an array.  Column names are normalised and
numbered inside the row, so nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import charset as cs
from ..functions.names import dedupe_names, snake_case

# Type words of the formats and the type class each stands for.
TYPE_WORDS = {
    "AlphaNumeric": "text",
    "VARCHAR": "text",
    "STRING": "text",
    "Numeric": "number",
    "NUMBER": "number",
    "INTEGER": "number",
    "Date": "date",
    "DATE": "date",
}


@dataclass(frozen=True)
class IndexLayout:
    """Where an index keeps its tables and columns.  The defaults are the audit export layout."""

    index_file: str = "index.xml"
    root: str = "DataSet/Media"
    table_element: str = "Table"
    column_parent: str = "VariableLength"
    column_element: str = "VariableColumn"
    primary_key_element: str = "VariablePrimaryKey"
    table_name: str = "Name"
    table_url: str = "URL"
    table_description: str = "Description"
    column_name: str = "Name"
    column_description: str = "Description"
    type_field: str = ""
    precision_field: str = ""
    type_words: dict[str, str] = field(default_factory=lambda: dict(TYPE_WORDS))
    delimiter: str = ";"
    has_header: bool = False
    decimal_symbol: str = ","
    digit_grouping: str = "."
    use_max_length: bool = True
    strict_dates: bool = False

    def with_names_from(self, element: str) -> "IndexLayout":
        return replace(self, column_name=element)


AUDIT = IndexLayout()
# The two layouts of the pluggable index import.  Both give decimals a precision of 18 and treat
# impossible dates as rejects; "generic" keeps its columns directly below the table element.
LAYOUTS: dict[str, IndexLayout] = {
    "audit": replace(AUDIT, use_max_length=False, strict_dates=True),
    "generic": replace(AUDIT, use_max_length=False, strict_dates=True, column_parent=""),
}

COLUMN_TYPE = (
    "struct<name:string,source_name:string,description:string,kind:string,precision:int,"
    "max_length:int,is_primary_key:boolean,type:string>"
)


def _struct(fields: dict[str, str]) -> str:
    return "struct<" + ",".join(f"`{k}`:{v}" for k, v in fields.items()) + ">"


def xml_schema(layout: IndexLayout) -> str:
    """DDL schema for ``from_xml``, generated from the layout."""
    column = {
        "Name": "string",
        layout.column_name: "string",
        layout.column_description: "string",
        "MaxLength": "string",
    }
    for extra in (layout.type_field, layout.precision_field):
        if extra:
            column[extra] = "string"
    column |= {"AlphaNumeric": "string", "Numeric": "struct<Accuracy:string>", "Date": "string"}
    columns = {
        layout.primary_key_element: f"array<{_struct(column)}>",
        layout.column_element: f"array<{_struct(column)}>",
    }
    table = {
        layout.table_url: "string",
        layout.table_name: "string",
        layout.table_description: "string",
        "UTF8": "string",
        "DecimalSymbol": "string",
        "DigitGroupingSymbol": "string",
        "Range": "struct<From:string>",
    }
    table |= {layout.column_parent: _struct(columns)} if layout.column_parent else columns
    body = {"Name": "string", layout.table_element: f"array<{_struct(table)}>"}
    for segment in reversed(layout.root.split("/")[1:]):
        body = {segment: f"array<{_struct(body)}>"}
    body["_broken"] = "string"
    return ", ".join(f"`{k}` {v}" for k, v in body.items())


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _leading_int(c: Column) -> Column:
    """The integer a text starts with, NULL for none."""
    return F.regexp_extract(c, r"^\s*([+-]?\d+)", 1).try_cast("int")


def _is_bad_int(c: Column) -> Column:
    return (_text(c) != "") & _leading_int(c).isNull()


def _kind(c: Column, layout: IndexLayout) -> Column:
    kind = (
        F.when(c["AlphaNumeric"].isNotNull(), "text")
        .when(c["Numeric"].isNotNull(), "number")
        .when(c["Date"].isNotNull(), "date")
    )
    if layout.type_field:
        for word, meaning in layout.type_words.items():
            kind = kind.when(c[layout.type_field] == word, meaning)
    return kind.otherwise("text")


def _accuracy(c: Column, layout: IndexLayout) -> Column:
    text = c["Numeric"]["Accuracy"]
    if layout.precision_field:
        declared = (
            c["AlphaNumeric"].isNotNull() | c["Numeric"].isNotNull() | c["Date"].isNotNull()
        )
        text = F.when(~declared, c[layout.precision_field]).otherwise(text)
    return text


def _described(layout: IndexLayout, is_key: bool):
    def describe(c: Column) -> Column:
        source = F.coalesce(F.nullif(c[layout.column_name], F.lit("")), _text(c["Name"]))
        kind = _kind(c, layout)
        accuracy = _accuracy(c, layout)
        precision = F.when(kind == "number", F.coalesce(_leading_int(accuracy), F.lit(0)))
        max_length = F.coalesce(_leading_int(c["MaxLength"]), F.lit(0))
        return F.struct(
            snake_case(source).alias("name"),
            source.alias("source_name"),
            _text(c[layout.column_description]).alias("description"),
            kind.alias("kind"),
            F.coalesce(precision, F.lit(0)).alias("precision"),
            max_length.alias("max_length"),
            F.lit(is_key).alias("is_primary_key"),
            (_is_bad_int(accuracy) | _is_bad_int(c["MaxLength"])).alias("bad"),
        )

    return describe


def column_type(kind: Column, precision: Column, max_length: Column) -> Column:
    """Spark type of a declared column.  A number with an accuracy s is DECIMAL(p, s), where p is
    the declared length or 18, at least s + 1 and at most 38."""
    wanted = F.when(max_length > 0, max_length).otherwise(F.lit(18))
    wide = F.least(F.when(wanted <= precision, precision + 1).otherwise(wanted), F.lit(38))
    decimal = F.concat(
        F.lit("decimal("), wide.cast("string"), F.lit(","), precision.cast("string"), F.lit(")")
    )
    return (
        F.when((kind == "number") & (precision > 0), decimal)
        .when(kind == "number", "bigint")
        .when(kind == "date", "date")
        .otherwise("string")
    )


def _symbol(c: Column, default: str) -> Column:
    return F.coalesce(F.nullif(F.substring(c, 1, 1), F.lit("")), F.lit(default))


def index_text(content: Column) -> Column:
    """Bytes of an index to text: UTF-16 by its mark, else UTF-8, else windows-1252."""
    mark = F.hex(F.substring(content, 1, 2))
    text = (
        F.when(mark.isin("FFFE", "FEFF"), F.decode(content, "UTF-16"))
        .when(F.is_valid_utf8(content), content.cast("string"))
        .otherwise(cs.decoded(content, cs.EXPORT_FALLBACK))
    )
    return F.regexp_replace(text, "^﻿", "")


def parse_indexes(indexes: DataFrame, layout: IndexLayout = AUDIT) -> DataFrame:
    """Catalog of a frame with the columns ``index_path`` and ``index_xml`` (text).

    Other columns are kept.  An index that cannot be used gives one row whose ``error`` says why
    and whose ``table_no`` is NULL.
    """
    kept = [F.col(c) for c in indexes.columns if c != "index_xml"]
    first, *inner = layout.root.split("/")
    opening = rf"(?s)^(\s|<\?.*?\?>|<!--.*?-->|<![^>]*>)*<{first}[\s/>]"
    parsed = indexes.select(
        *kept,
        F.col("index_xml").rlike(opening).alias("_rooted"),
        F.from_xml("index_xml", xml_schema(layout), {"columnNameOfCorruptRecord": "_broken"}).alias(
            "_doc"
        ),
    )
    body = F.col("_doc")
    missing = F.when(F.col("_doc._broken").isNotNull(), "not well-formed XML").when(
        ~F.col("_rooted"), f"missing {first} element"
    )
    for segment in inner:
        body = F.get(body[segment], 0)
        missing = missing.when(body.isNull(), f"missing {segment} element")
    located = parsed.select(
        *kept,
        missing.alias("error"),
        F.when(missing.isNull(), body["Name"]).alias("media_name"),
        F.when(missing.isNull(), body[layout.table_element]).alias("_tables"),
    )
    tables = located.select(*kept, "error", "media_name", F.posexplode_outer("_tables"))
    home = F.col("col")[layout.column_parent] if layout.column_parent else F.col("col")
    described = tables.select(
        *kept,
        "error",
        "media_name",
        F.col("pos").alias("table_no"),
        "col",
        F.concat(
            F.transform(
                F.coalesce(home[layout.primary_key_element], F.array()), _described(layout, True)
            ),
            F.transform(
                F.coalesce(home[layout.column_element], F.array()), _described(layout, False)
            ),
        ).alias("_columns"),
    )
    named = described.withColumn("_raw_names", F.col("_columns.name")).withColumn(
        "_names", dedupe_names(F.col("_raw_names"))
    )
    start = F.col("col.Range.From")
    bad = F.exists("_columns", lambda c: c["bad"]) | _is_bad_int(start)

    def finished(c: Column, name: Column) -> Column:
        length = c["max_length"] if layout.use_max_length else F.lit(0)
        return F.struct(
            name.alias("name"),
            c["source_name"].alias("source_name"),
            c["description"].alias("description"),
            c["kind"].alias("kind"),
            c["precision"].alias("precision"),
            c["max_length"].alias("max_length"),
            c["is_primary_key"].alias("is_primary_key"),
            column_type(c["kind"], c["precision"], length).alias("type"),
        )

    table = F.col("col")
    present = F.col("table_no").isNotNull()
    return named.select(
        *kept,
        F.coalesce("error", F.when(bad, "a length, accuracy or range is not a number")).alias(
            "error"
        ),
        _text(F.col("media_name")).alias("media_name"),
        "table_no",
        F.when(present, _text(table[layout.table_name])).alias("table_name"),
        F.when(present, _text(table[layout.table_url])).alias("url"),
        F.when(present, _text(table[layout.table_description])).alias("description"),
        table["UTF8"].isNotNull().alias("is_utf8"),
        _symbol(table["DecimalSymbol"], layout.decimal_symbol).alias("decimal_symbol"),
        _symbol(table["DigitGroupingSymbol"], layout.digit_grouping).alias("digit_grouping"),
        F.greatest(F.coalesce(_leading_int(start), F.lit(1)) - 1, F.lit(0)).alias("skip_lines"),
        F.zip_with("_columns", "_names", finished).cast(f"array<{COLUMN_TYPE}>").alias("columns"),
    )


def index_catalog(
    spark: SparkSession, paths: str | list[str], layout: IndexLayout = AUDIT
) -> DataFrame:
    """Catalog of the index files at the given paths or globs."""
    files = spark.read.format("binaryFile").load(paths)
    texts = files.select(F.col("path").alias("index_path"), index_text(F.col("content")).alias("index_xml"))
    return parse_indexes(texts, layout)


def has_traversal(path: Column) -> Column:
    """True where a path has a ``..`` component."""
    return F.regexp_replace(path, r"\\", "/").rlike(r"(^|/)\.\.(/|$)")
