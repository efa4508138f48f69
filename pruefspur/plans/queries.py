"""The registered queries.

Each takes a session and a folder of parquet tables.  The text an operator works on is derived
from whole tables, and the result is what the operator made of it.  Money is returned as DOUBLE
and dates as text, so that engines compare without regard to their own decimal and date objects.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import hadoop
from ..functions import convert as cv
from ..functions import names as nm
from ..operators import checks, infer
from ..operators.report import IMPORT_REPORT, ImportResult, SaveFailed, report_frame, side_by_side
from ..sinks.export import export_rows as exported_rows
from ..sinks.export import export_table
from ..sources import audit, lines
from ..sources.archive import import_archives
from ..sources.booking import read_booking_batches
from ..sources.folder import import_folder
from ..sources.index_catalog import (
    IndexLayout,
    has_traversal,
    index_catalog,
    parse_indexes,
)
from . import fixtures as fx

PARTS = 4


def spread(df: DataFrame, *by: str) -> DataFrame:
    """At least a few tasks; a scan of many files keeps its own."""
    return df if df.rdd.getNumPartitions() >= PARTS else df.repartition(PARTS, *by)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def german(c: Column, digits: int = 2) -> Column:
    """Number as German text: 1.234,56."""
    return F.translate(F.format_number(c, digits), ",.", ".,")


def money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def day(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def as_union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- value conversion ---------------------------------------------------------------------


def de_decimal(spark: SparkSession, sf: str) -> DataFrame:
    """German decimals in seven spellings, two of them not numbers."""
    text = german(F.col("l_extendedprice"))
    form = F.col("l_linenumber") % 7
    raw = (
        F.when(form == 1, text)
        .when(form == 2, F.replace(text, F.lit("."), F.lit("")))
        .when(form == 3, F.concat(F.lit("+"), text))
        .when(form == 4, F.concat(F.lit("  "), text, F.lit(" ")))
        .when(form == 5, F.concat(text, F.lit("e1")))
        .when(form == 6, F.lit(""))
        .otherwise(F.concat(F.lit("-"), text))
    )
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", money(cv.to_decimal(raw, 18, 2)).alias("amount")
    )


def de_integer(spark: SparkSession, sf: str) -> DataFrame:
    """Grouped integers; every fifth customer's text is a decimal and refused."""
    text = german(F.col("o_orderkey"), 0)
    raw = (
        F.when(F.col("o_custkey") % 5 == 0, F.concat(text, F.lit(",6")))
        .when(F.col("o_custkey") % 5 == 1, F.concat(F.lit(" -"), text, F.lit(" ")))
        .otherwise(text)
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", cv.to_integer(raw).alias("number")
    )


def _order_date_text() -> Column:
    date = F.col("o_orderdate")
    return (
        F.when(F.col("o_custkey") % 5 == 0, F.date_format(date, "d.M.yyyy"))
        .when(F.col("o_custkey") % 5 == 1, F.date_format(date, "'  'dd.MM.yyyy' '"))
        .when(F.col("o_custkey") % 5 == 2, F.date_format(date, "'32'.MM.yyyy"))
        .when(F.col("o_custkey") % 5 == 3, F.lit("  "))
        .otherwise(F.date_format(date, "dd.MM.yyyy"))
    )


def de_date(spark: SparkSession, sf: str) -> DataFrame:
    """German dates; impossible and blank ones become NULL."""
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", day(cv.to_date(_order_date_text())).alias("order_date")
    )


def de_date_strict(spark: SparkSession, sf: str) -> DataFrame:
    """Which dates a strict import would refuse: present, but not a date."""
    raw = _order_date_text()
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", cv.rejected(raw, cv.to_date(raw), blank_ok=True).alias("refused")
    )


def declared_symbols(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers in the symbols their table declares: 1,234.56 and 1'234.56."""
    english = F.format_number("l_extendedprice", 2)
    swiss = F.replace(english, F.lit(","), F.lit("'"))
    whole = F.format_number("l_orderkey", 0)
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        money(cv.to_decimal(english, 18, 2, ".", ",")).alias("english_price"),
        money(cv.to_decimal(swiss, 18, 2, ".", "'")).alias("swiss_price"),
        cv.to_integer(whole, ",").alias("english_key"),
    )


def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    """Control characters removed from whole texts, outer spaces trimmed."""
    dirty = F.concat(
        F.lit(" \u00a0\u0007"), F.replace("text", F.lit("e"), F.lit("\u0085e\u0001")), F.lit("\t ")
    )
    return table(spark, sf, "documents").select("doc_id", cv.clean_text(dirty).alias("text"))


def booking_amount(spark: SparkSession, sf: str) -> DataFrame:
    """Booking amounts: trimmed, blank is NULL."""
    raw = F.when(F.col("o_custkey") % 3 == 0, F.lit("  ")).otherwise(
        F.concat(F.lit(" "), german(F.col("o_totalprice")))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", money(cv.booking_decimal(raw, 18, 2)).alias("amount")
    )


def booking_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Exchange rates with six decimals."""
    raw = F.concat(german(F.col("l_quantity") / 64, 6), F.lit(" "))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", money(cv.booking_decimal(raw, 18, 6)).alias("rate")
    )


def booking_date(spark: SparkSession, sf: str) -> DataFrame:
    """Voucher dates DDMM and DMM with the year of the header; every fifth is impossible."""
    raw = F.when(F.col("o_custkey") % 5 == 0, "3113").otherwise(
        F.date_format("o_orderdate", "dMM")
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", day(cv.voucher_date(raw, F.year("o_orderdate"))).alias("voucher_date")
    )


# --- names --------------------------------------------------------------------------------


def normalise_names(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts as column names, by both rules."""
    return table(spark, sf, "documents").select(
        "doc_id",
        nm.snake_case(F.col("text")).alias("snake_name"),
        nm.batch_column(F.col("text")).alias("batch_name"),
    )


def file_names(spark: SparkSession, sf: str) -> DataFrame:
    """Table names and archive prefixes from page addresses."""
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id",
        nm.table_of_file(url).alias("table_name"),
        nm.file_stem(url).alias("stem"),
        nm.archive_prefix(F.concat(url, F.lit(".ZIP"))).alias("prefix"),
    )


def dedupe_names(spark: SparkSession, sf: str) -> DataFrame:
    """The lines of every document taken as names of one table, repeats numbered."""
    named = table(spark, sf, "documents").select("doc_id", F.split("text", "\n").alias("names"))
    return named.select(
        "doc_id", F.posexplode(nm.dedupe_names(F.col("names"))).alias("pos", "name")
    )


# --- catalog ------------------------------------------------------------------------------

_CATALOG_XML = """<?xml version="1.0" encoding="UTF-8"?>
<DataSet><Version>1.0</Version><Media><Name>{status}</Name>
<Table><URL>orders_{key}.txt</URL><Name>Orders{key}</Name><Description>Status {status}</Description>
{utf8}<DecimalSymbol>,</DecimalSymbol><DigitGroupingSymbol>.</DigitGroupingSymbol>
<Range><From>{first}</From></Range>
<VariableLength><VariablePrimaryKey><Name>OrderKey</Name><Description>Auftrag Nr.</Description>
<Numeric/></VariablePrimaryKey>
<VariableColumn><Name>TotalPrice</Name><Numeric><Accuracy>{accuracy}</Accuracy></Numeric>
<MaxLength>{length}</MaxLength></VariableColumn>
<VariableColumn><Name>OrderDATE</Name><Date/></VariableColumn>
<VariableColumn><Name>Größe</Name><Description></Description><AlphaNumeric/></VariableColumn>
<VariableColumn><Name>OrderKey</Name></VariableColumn></VariableLength></Table></Media></DataSet>"""


def _filled(template: str, values: dict[str, Column]) -> Column:
    text = F.lit(template)
    for name, value in values.items():
        text = F.replace(text, F.lit("{" + name + "}"), value.cast("string"))
    return text


def catalog_of_orders(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    xml = _filled(
        _CATALOG_XML,
        {
            "key": key,
            "status": F.col("o_orderstatus"),
            "utf8": F.when(F.col("o_custkey") % 2 == 0, "<UTF8/>").otherwise(""),
            "first": key % 4,
            "accuracy": key % 5,
            "length": F.col("o_custkey") % 45,
        },
    )
    indexes = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("index_key"), xml.alias("index_xml")
    )
    names = IndexLayout().with_names_from("Description")
    return parse_indexes(indexes, names)


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    """One index per order, parsed to one row per column."""
    # The outer form keeps the optimizer from computing the columns a second time in a filter.
    return catalog_of_orders(spark, sf).select(
        "index_key",
        "media_name",
        "table_name",
        "url",
        "is_utf8",
        "skip_lines",
        F.posexplode_outer("columns").alias("pos", "c"),
    ).select(
        "index_key",
        "media_name",
        "table_name",
        "url",
        "is_utf8",
        "skip_lines",
        "pos",
        F.col("c.name").alias("name"),
        F.col("c.type").alias("type"),
        F.col("c.is_primary_key").alias("is_primary_key"),
    )


def url_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses that would leave the export folder."""
    url = (
        F.when(F.col("page_id") % 4 == 0, F.concat(F.lit("..\\"), F.col("url")))
        .when(F.col("page_id") % 4 == 1, F.concat(F.col("url"), F.lit("/..")))
        .when(F.col("page_id") % 4 == 2, F.concat(F.col("url"), F.lit("/..x/a..b")))
        .otherwise(F.col("url"))
    )
    return table(spark, sf, "pages").select("page_id", has_traversal(url).alias("refused"))


# --- inference ----------------------------------------------------------------------------


def infer_types(spark: SparkSession, sf: str) -> DataFrame:
    """All-text columns get the types their values allow."""
    text = table(spark, sf, "orders").select(
        F.concat(F.lit(" "), F.col("o_orderkey")).alias("order_key"),
        german(F.col("o_totalprice")).alias("total_price"),
        F.date_format("o_orderdate", "d.M.yyyy").alias("german_day"),
        F.date_format("o_orderdate", "yyyy/M/d").alias("iso_day"),
        F.when(F.col("o_custkey") % 2 == 0, "").otherwise(F.col("o_custkey").cast("string")).alias(
            "half_key"
        ),
        F.when(F.col("o_orderkey") == 0, "n/a").otherwise(german(F.col("o_totalprice"))).alias(
            "mixed"
        ),
        F.lit("").alias("blank"),
    )
    typed = infer.infer_types(text)
    return typed.withColumns({"german_day": day("german_day"), "iso_day": day("iso_day")})


# --- export -------------------------------------------------------------------------------


def export_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in their exported text form."""
    return exported_rows(
        table(spark, sf, "orders").select(
            "o_orderkey",
            "o_orderstatus",
            F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
            (F.col("o_totalprice") / -3).alias("third"),
            F.col("o_orderdate").cast("date").alias("order_day"),
            "o_orderdate",
            (F.col("o_custkey") % 2 == 0).alias("even"),
        )
    )


def _flat_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    return {n: table(spark, sf, n) for n in names}


def export_index(spark: SparkSession, sf: str) -> DataFrame:
    """Every flat table exported in both forms, and the indexes read back with the rows reported."""
    root = hadoop.fresh_folder(spark, "export-index")

    def exported(df: DataFrame, form: str, name: str) -> Callable[[], DataFrame]:
        place = f"{root}/{form}/{name}"
        return lambda: export_table(df, place, name, single_file=form == "file").withColumn("form", F.lit(form))

    # Side by side, so that the last tasks of one export and the joining of its parts leave no cores idle.
    tables = _flat_tables(spark, sf).items()
    reports = side_by_side(spark, [exported(df, form, n) for form in ("parts", "file") for n, df in tables])
    for failed in (r for r in reports if isinstance(r, Exception)):
        raise failed
    columns = index_catalog(spark, f"{root}/*/*/index.xml").select(
        F.regexp_extract("index_path", "/([a-z]+)/[^/]+/index.xml$", 1).alias("form"),
        "table_name",
        F.posexplode("columns").alias("pos", "c"),
    )
    return (
        as_union(reports)
        .join(columns, ["form", "table_name"])
        .select(
            "form",
            "table_name",
            "row_count",
            "status",
            "pos",
            F.col("c.name").alias("name"),
            F.col("c.type").alias("type"),
        )
    )


def _lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


def export_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Lineitem exported and imported again, with its types."""
    folder = hadoop.fresh_folder(spark, "roundtrip")
    export_table(_lineitem(spark, sf), folder, "lineitem").collect()
    back = audit.import_export(spark, folder).tables["lineitem"]
    amounts = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return back.withColumns({**{c: money(c) for c in amounts}, "l_shipdate": day("l_shipdate")})


def export_single(spark: SparkSession, sf: str) -> DataFrame:
    """Orders exported as one file: its lines, of the only data file of the export."""
    folder = hadoop.fresh_folder(spark, "single")
    orders = table(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    export_table(spread(orders, "o_orderkey"), folder, "orders", single_file=True).collect()
    return spark.read.text(f"{folder}/*.txt").withColumn("file", F.col("_metadata.file_name"))


# --- audit import -------------------------------------------------------------------------


def _keyed(df: DataFrame, key: str, description: str) -> DataFrame:
    return df.withColumn(
        key, F.col(key).alias(key, metadata={"primary_key": True, "description": description})
    )


def _staged_shop(spark: SparkSession, sf: str) -> str:
    customer = _keyed(table(spark, sf, "customer"), "c_custkey", "Kunden Nr.")
    orders = table(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    return fx.stage_export(
        spark,
        "shop",
        {"Nation": table(spark, sf, "nation"), "Kunden": customer,
         "Aufträge": _keyed(orders, "o_orderkey", "Auftrag")},
    )


def import_export_dir(spark: SparkSession, sf: str) -> DataFrame:
    """An export of three tables imported with described names, and queried with a join."""
    tables = audit.import_export(spark, _staged_shop(spark, sf), "Description").tables
    return (
        tables["Aufträge"]
        .join(tables["Kunden"], F.col("o_custkey") == F.col("kunden_nr"))
        .join(tables["Nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name", "o_orderstatus")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            money(F.sum("o_totalprice")).alias("total"),
            day(F.max("o_orderdate")).alias("last_day"),
            F.countDistinct("auftrag").alias("keys"),
        )
    )


def import_datev_dir(spark: SparkSession, sf: str) -> DataFrame:
    """The same export with names from the Name element."""
    kunden = audit.import_datev_export(spark, _staged_shop(spark, sf)).tables["Kunden"]
    return kunden.withColumn("c_acctbal", money("c_acctbal"))


def saved_tables(spark: SparkSession, sf: str) -> DataFrame:
    """All tables of an export saved to the catalog, and saved once more from an export in which one
    cannot be built: the tables of the first time stay."""
    folder = hadoop.fresh_folder(spark, "saved")
    database = folder.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"create database {database} location '{folder}'")
    audit.import_datev_export(spark, _staged_shop(spark, sf)).save(database)

    def broken() -> DataFrame:
        return spark.read.parquet(f"{folder}/absent")

    again = {n: (lambda n=n: table(spark, sf, n)) for n in ("nation", "customer")}
    renamed = {"Nation": again["nation"], "Kunden": again["customer"], "Aufträge": broken}
    try:
        ImportResult(spark, renamed, report_frame(spark, [], IMPORT_REPORT)).save(database)
        refused = ""
    except SaveFailed as error:
        refused = error.table
    # Names of columns and types of the export tell its tables from the second ones.
    shown = {
        "nation": ("n_nationkey", "n_name"),
        "kunden": ("c_custkey", "c_acctbal"),
        "auftrage": ("o_orderkey", "o_orderdate"),
    }
    # Views of the session are listed too.
    found = spark.sql(f"show tables in {database}").where(~F.col("isTemporary")).count()
    return as_union(
        [
            spark.table(f"{database}.{name}").select(
                F.lit(name).alias("table_name"),
                F.col(key).cast("bigint").alias("key"),
                F.col(value).cast("string").alias("value"),
                F.lit(found).cast("bigint").alias("tables"),
                F.lit(refused).alias("refused"),
            )
            for name, (key, value) in shown.items()
        ]
    )


_CUSTOM_LAYOUT = IndexLayout(
    index_file="schema.xml",
    root="Schema/Tables",
    table_element="Tab",
    column_parent="",
    column_element="Field",
    primary_key_element="Key",
    table_name="Label",
    table_url="File",
    table_description="Note",
    column_name="Label",
    column_description="Note",
    type_field="Kind",
    precision_field="Digits",
    delimiter="|",
    has_header=True,
    use_max_length=False,
    strict_dates=True,
)
_CUSTOM_INDEX = """<Schema><Tables><Tab><Label>Parts</Label><File>parts</File>
<DecimalSymbol>.</DecimalSymbol><DigitGroupingSymbol>,</DigitGroupingSymbol>
<Key><Label>PartKey</Label><Kind>INTEGER</Kind></Key>
<Field><Label>PartName</Label><Kind>VARCHAR</Kind></Field>
<Field><Label>RetailPrice</Label><Kind>NUMBER</Kind><Digits>2</Digits></Field>
</Tab></Tables></Schema>"""


def import_xml_layout(spark: SparkSession, sf: str) -> DataFrame:
    """A layout of one's own: other elements, another delimiter, English numbers, headers."""
    folder = hadoop.fresh_folder(spark, "layout")
    hadoop.make_dirs(spark, f"{folder}/parts")
    rows = table(spark, sf, "part").select(
        F.lit("part").alias("stem"),
        F.lit("key|name|price\n").alias("head"),
        fx.joined(
            [F.col("p_partkey"), F.col("p_name"), F.format_number("p_retailprice", 2)], "|"
        ).alias("line"),
    )
    fx.write_lines(spread(rows, "line"), f"{folder}/parts", "txt")
    hadoop.write_bytes(spark, f"{folder}/schema.xml", _CUSTOM_INDEX.encode())
    parts = audit.import_index(spark, folder, _CUSTOM_LAYOUT).tables["Parts"]
    return parts.withColumn("retail_price", money("retail_price"))


def charset_pick(spark: SparkSession, sf: str) -> DataFrame:
    """One table in windows-1252 and one in UTF-8, both read right without being told."""
    customer = table(spark, sf, "customer")
    folder = hadoop.fresh_folder(spark, "charset")
    name = F.concat("c_name", F.lit(" Müller & Söhne €"))
    for part, charset in (("western", "windows-1252"), ("unicode", "utf-8")):
        rows = customer.select(
            F.lit("kunden").alias("stem"),
            F.lit("").alias("head"),
            fx.joined([F.col("c_custkey"), name], ";").alias("line"),
        )
        hadoop.make_dirs(spark, f"{folder}/{part}.txt")
        fx.write_lines(spread(rows, "line"), f"{folder}/{part}.txt", "txt", charset)
    schema = T.StructType().add("CustKey", T.LongType()).add("CustName", T.StringType())
    index = fx.index_xml({"western": schema, "unicode": schema}, "charset")
    hadoop.write_bytes(spark, f"{folder}/index.xml", index.encode())
    tables = audit.import_export(spark, folder).tables
    return as_union([t.withColumn("origin", F.lit(n)) for n, t in tables.items()])


#: A name as files in each charset may hold it.
CHARSET_SAMPLES = {
    "windows-1252": "Müller & Söhne – „Größe“ 5 €",
    "iso-8859-15": "Müller & Söhne 5 € Œuvre",
    "cp850": "Müller Ñandú Ávila São Größe",
    "cp437": "Länge ≥ 5 √ ≤ Größe ≈",
    "windows-1250": "Łódź Müller Kraków żółw",
    "utf-8": "Łódź Größe ≥ 5 €",
}


def _charset_export(spark: SparkSession, sf: str, samples: dict[str, str]) -> str:
    """An audit export with a table per charset, called after it; wide files start with their mark."""
    customer = table(spark, sf, "customer")
    folder = hadoop.fresh_folder(spark, "charsets")
    schema = T.StructType().add("CustKey", T.LongType()).add("CustName", T.StringType())
    names = {c: c.replace("-", "_") for c in samples}
    for charset, sample in samples.items():
        rows = customer.select(
            F.lit("kunden").alias("stem"),
            F.lit("\ufeff" if charset.startswith("utf-16") else "").alias("head"),
            fx.joined([F.col("c_custkey"), F.concat_ws(" ", "c_name", F.lit(sample))], ";").alias("line"),
        )
        hadoop.make_dirs(spark, f"{folder}/{names[charset]}.txt")
        fx.write_lines(spread(rows, "line"), f"{folder}/{names[charset]}.txt", "txt", charset)
    index = fx.index_xml({n: schema for n in names.values()}, "charsets")
    hadoop.write_bytes(spark, f"{folder}/index.xml", index.encode())
    return folder


def _with_charsets(result) -> DataFrame:
    tables = [t.withColumn("table_name", F.lit(n)) for n, t in result.tables.items()]
    return as_union(tables).join(F.broadcast(result.charsets), "table_name")


def charset_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Files in five charsets that are not UTF-8 and one that is, each named and read right."""
    return _with_charsets(audit.import_export(spark, _charset_export(spark, sf, CHARSET_SAMPLES)))


def wide_charsets(spark: SparkSession, sf: str) -> DataFrame:
    """UTF-16 files of both byte orders in many splits; some names hold two characters whose halves
    look like the end of a line."""
    odd = "Größe 5 € \u0a12\u0100\u0a01 \u2500"
    folder = _charset_export(spark, sf, {"utf-16-le": odd, "utf-16-be": odd})
    small = spark.newSession()
    small.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    small.conf.set("spark.sql.files.openCostInBytes", "0")
    return _with_charsets(audit.import_export(small, folder))


def folder_separators(spark: SparkSession, sf: str) -> DataFrame:
    """Files whose first lines fit a comma better than the separator of the rest, and rows with more
    fields than the header: the report tells of them."""
    folder = hadoop.fresh_folder(spark, "separators")
    orders = table(spark, sf, "orders")
    key = F.col("o_orderkey").cast("string")
    misleading = "".join(f"{i};0;A, B;surplus\n" for i in range(-30, 0))
    line = F.when(F.col("o_orderkey") % 4 == 0, F.concat_ws(";", key, "o_custkey", F.lit("x"), F.lit("more")))
    line = line.otherwise(F.concat_ws(";", key, "o_custkey", "o_orderpriority"))
    rows = orders.select(
        F.lit("orders").alias("stem"), F.lit("OrderKey;CustKey;Rank, Text\n" + misleading).alias("head"), line.alias("line")
    )
    fx.write_lines(spread(rows, "line"), folder, "csv")
    result = import_folder(spark, folder, "csv")
    noted = F.regexp_extract("status", r"^Warning: (\d+) rows have more fields", 1).cast("bigint")
    lines_ = F.sum(F.col("row_count") - 30).alias("row_count")
    told = result.report.agg(lines_, F.sum(noted - 30).alias("surplus_rows")).head()
    return result.combined.drop("_file_name").where("order_key >= 0").select(
        "*", *[F.lit(told[c]).alias(c) for c in ("row_count", "surplus_rows")]
    )


def folder_bad_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows with more fields than the header dropped on request, and an option that is refused."""
    folder = hadoop.fresh_folder(spark, "bad-rows")
    key = F.col("c_custkey")
    line = F.concat_ws("|", key.cast("string"), "c_name", F.when(key % 3 == 0, F.lit("x|y")))
    rows = table(spark, sf, "customer").select(
        F.lit("customer").alias("stem"), F.lit("Key|Name|Note\n").alias("head"), line.alias("line")
    )
    fx.write_lines(spread(rows, "line"), folder, "dat")
    kept = import_folder(spark, folder, "dat", drop_bad_rows=True)
    refused = import_folder(spark, folder, "dat", ignore_all="yes").report.head()
    return kept.combined.select("key", "name", F.lit(refused["table_name"]).alias("refused"))


def skip_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Two header lines per data file, passed over because the range starts at line 3."""
    folder = hadoop.fresh_folder(spark, "skip")
    hadoop.make_dirs(spark, f"{folder}/orders.txt")
    rows = table(spark, sf, "orders").select(
        F.lit("part").alias("stem"),
        # The header reads like data, so only its position gives it away.
        F.lit("0;1,00\n1;2,00\n").alias("head"),
        fx.joined([F.col("o_orderkey"), german(F.col("o_totalprice"))], ";").alias("line"),
    )
    fx.write_lines(spread(rows, "line"), f"{folder}/orders.txt", "txt")
    schema = T.StructType().add("OrderKey", T.LongType()).add("Price", T.DoubleType())
    index = fx.index_xml({"orders": schema}, "skip").replace("<From>1<", "<From>3<")
    hadoop.write_bytes(spark, f"{folder}/index.xml", index.encode())
    orders = audit.import_export(spark, folder).tables["orders"]
    return orders.withColumn("price", money("price"))


def ragged_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Short rows are padded, long rows cut or dropped, quotes and empty fields understood."""
    name = F.concat(F.lit('"'), F.col("c_name"), F.lit('; ""x"""'))
    form = F.col("c_custkey") % 4
    key = F.col("c_custkey").cast("string")
    line = (
        F.when(form == 0, key)
        .when(form == 1, F.concat_ws(";", key, name))
        .when(form == 2, F.concat_ws(";", key, name, F.lit('""'), F.lit("more")))
        .otherwise(F.concat_ws(";", key, name, F.col("c_mktsegment"), F.lit("")))
    )
    split = table(spark, sf, "customer").select(
        lines.split_fields(line, 3).alias("fields"), lines.surplus(line, 3).alias("long_row")
    )
    kept = lines.only_whole_rows(split).select("fields.*")
    every = split.select("fields.*")
    shape = [F.col("_f0").cast("bigint").alias("key"), F.col("_f1").alias("name"),
             F.col("_f2").alias("segment")]
    return as_union(
        [every.select(F.lit("all").alias("rows"), *shape),
         kept.select(F.lit("whole").alias("rows"), *shape)]
    )


# --- checks and reports -------------------------------------------------------------------


def delimiter_check(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows split at the right and at the wrong character."""
    items = table(spark, sf, "lineitem")
    cells = [F.col(c) for c in ("l_orderkey", "l_partkey", "l_returnflag")]
    outcome = []
    for sep in (";", "|"):
        split = items.select(lines.split_fields(fx.joined(cells, sep), 3).alias("f"))
        columns = split.select(*[F.col(f"f.{n}") for n in lines.raw_names(3)])
        outcome.append(
            checks.delimiter_check(columns).withColumn("separator", F.lit(sep))
        )
    return as_union(outcome)


def pk_check(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that repeat or are NULL, over a near-unique, a unique and a heavily repeated key."""
    items = table(spark, sf, "lineitem").withColumn(
        "l_suppkey", F.when(F.col("l_suppkey") % 10 != 0, F.col("l_suppkey"))
    )
    cases = {
        "line": checks.key_check(items, ["l_orderkey", "l_linenumber"]),
        "supplier": checks.key_check(items, ["l_suppkey"]),
        "order": checks.key_check(table(spark, sf, "orders"), ["o_orderkey"]),
        "flag": checks.key_check(items, ["l_returnflag", "l_linestatus"]),
    }
    return as_union([df.withColumn("key_name", F.lit(n)) for n, df in cases.items()])


def reject_count(spark: SparkSession, sf: str) -> DataFrame:
    """Values per return flag that were present but are not what their column declares."""
    broken = F.col("l_linenumber") == 3
    number = F.when(broken, F.lit("12,6")).otherwise(F.col("l_orderkey").cast("string"))
    price = F.when(F.col("l_linenumber") == 4, F.lit(" ")).otherwise(german(F.col("l_extendedprice")))
    date = F.when(broken, F.lit("30.02.2024")).otherwise(F.date_format("l_shipdate", "dd.MM.yyyy"))
    narrow = german(F.col("l_extendedprice"))
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_returnflag")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(cv.rejected(number, cv.to_integer(number))).alias("bad_integer"),
            F.count_if(cv.rejected(price, cv.to_decimal(price, 18, 2))).alias("bad_decimal"),
            F.count_if(cv.rejected(date, cv.to_date(date), blank_ok=True)).alias("bad_date"),
            F.count_if(cv.rejected(narrow, cv.to_decimal(narrow, 6, 2))).alias("too_wide"),
        )
    )


def import_report(spark: SparkSession, sf: str) -> DataFrame:
    """The report of an import with good, empty, missing, forbidden and broken tables."""
    orders = table(spark, sf, "orders")
    bad = orders.select(
        _number_or_text().alias("OrderKey"), F.col("o_orderstatus").alias("Status")
    )
    tables = {
        "Nation": table(spark, sf, "nation"),
        "Auftrag": orders,
        "Position": _keyed(_lineitem(spark, sf), "l_orderkey", ""),
        "Leer": orders.select("o_orderkey", "o_custkey").where(F.col("o_orderkey") < 0),
        "Kaputt": bad,
    }
    folder = fx.stage_export(spark, "report", tables)
    schemas = {n: df.schema for n, df in tables.items()}
    schemas["Kaputt"] = T.StructType().add("OrderKey", T.LongType()).add("Status", T.StringType())
    schemas["Fehlt"] = schemas["Nation"]
    schemas["../Oben"] = schemas["Nation"]
    index = fx.index_xml(schemas, "report")
    hadoop.write_bytes(spark, f"{folder}/index.xml", index.encode())
    return audit.import_export(spark, folder).report


def _number_or_text() -> Column:
    key = F.col("o_orderkey").cast("string")
    return F.when(F.col("o_custkey") % 7 == 0, F.concat(F.lit("Nr "), key)).otherwise(key)


# --- folders ------------------------------------------------------------------------------


def _order_texts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("OrderKey"),
        german(F.col("o_totalprice")).alias("Total Price"),
        F.date_format("o_orderdate", "dd.MM.yyyy").alias("OrderDate"),
        F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit('; "x" ')).alias("Priorität"),
    )


def _order_result(result) -> DataFrame:
    return result.combined.drop("_file_name").withColumn("order_date", day("order_date"))


def import_folder_csv(spark: SparkSession, sf: str) -> DataFrame:
    """CSV files with headers: separator found, names normalised, types inferred."""
    folder = hadoop.fresh_folder(spark, "csv")
    texts = spread(_order_texts(spark, sf), "OrderKey")
    texts.write.mode("append").csv(
        folder, sep=";", header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return _order_result(import_folder(spark, folder))


def import_folder_tsv(spark: SparkSession, sf: str) -> DataFrame:
    """Tab-separated files."""
    folder = hadoop.fresh_folder(spark, "tsv")
    texts = _order_texts(spark, sf)
    rows = texts.select(
        F.lit("Auf Trag").alias("stem"),
        F.lit("\t".join(texts.columns) + "\n").alias("head"),
        fx.joined([F.col(f"`{c}`") for c in texts.columns], "\t").alias("line"),
    )
    fx.write_lines(spread(rows, "line"), folder, "tsv")
    return _order_result(import_folder(spark, folder, "tsv"))


def import_folder_parquet(spark: SparkSession, sf: str) -> DataFrame:
    """Parquet files whose text columns are cleaned and typed."""
    folder = hadoop.fresh_folder(spark, "parquet")
    texts = spread(_order_texts(spark, sf), "OrderKey")
    texts.write.mode("append").parquet(folder)
    return _order_result(import_folder(spark, folder, "parquet"))


def import_folder_json(spark: SparkSession, sf: str) -> DataFrame:
    """JSON lines."""
    folder = hadoop.fresh_folder(spark, "json")
    texts = spread(_order_texts(spark, sf), "OrderKey")
    texts.write.mode("append").json(folder)
    return _order_result(import_folder(spark, folder, "json"))


def import_folder_xlsx(spark: SparkSession, sf: str) -> DataFrame:
    """Workbooks: number cells, and text cells that inference types."""
    folder = hadoop.fresh_folder(spark, "xlsx")
    texts = _order_texts(spark, sf).withColumn("OrderKey", F.col("OrderKey").cast("double"))
    fx.write_workbooks(spread(texts, "OrderKey"), folder)
    return _order_result(import_folder(spark, folder, "xlsx"))


def import_folder_other(spark: SparkSession, sf: str) -> DataFrame:
    """Files of a type that has no reader of its own are told by that extension and read as text; files of
    other types beside them are not."""
    folder = hadoop.fresh_folder(spark, "other")
    for df, suffix in ((_order_texts(spark, sf), "dat"), (table(spark, sf, "nation"), "csv")):
        rows = df.select(
            F.lit("Auf Trag").alias("stem"),
            F.lit("\t".join(df.columns) + "\n").alias("head"),
            fx.joined([F.col(f"`{c}`") for c in df.columns], "\t").alias("line"),
        )
        fx.write_lines(spread(rows, "line"), folder, suffix)
    return _order_result(import_folder(spark, folder, "dat"))


def folder_options(spark: SparkSession, sf: str) -> DataFrame:
    """Reader options: another delimiter, lines to skip, no type detection."""
    folder = hadoop.fresh_folder(spark, "options")
    rows = table(spark, sf, "customer").select(
        F.lit("Kunden").alias("stem"),
        F.lit("Stand heute\n\nKey|Name|Balance|Flag\n").alias("head"),
        fx.joined(
            [F.col("c_custkey"), F.col("c_name"), german(F.col("c_acctbal")), F.lit("true")], "|"
        ).alias("line"),
    )
    fx.write_lines(spread(rows, "line"), folder, "csv")
    result = import_folder(spark, folder, delimiter="|", skip=2, all_varchar=True)
    return result.combined.drop("_file_name")


# --- batches ------------------------------------------------------------------------------

_BATCH_HEAD = (
    '"EXTF";700;21;"Buchungsstapel";13;20240101000000000;;"RE";"";"";1001;1;{year}0101;4;'
    '{year}0101;{year}1231;"Stapel {year}";"";1;0;0;"EUR"\n'
    "Umsatz (ohne Soll/Haben-Kz);Soll/Haben-Kennzeichen;Kurs;Basis-Umsatz;Konto;Belegdatum;"
    "Buchungstext\n"
)


def staged_batches(spark: SparkSession, sf: str, note: Column | None = None) -> str:
    """Orders as booking batches, a file per year and task, in windows-1250; ``note`` is another text
    of the bookings, as it stands in the file."""
    folder = hadoop.fresh_folder(spark, "batch")
    year = F.year("o_orderdate").cast("string")
    priority = F.concat(F.lit('"Größe ""'), F.col("o_orderpriority"), F.lit('"""'))
    cells = [
        german(F.col("o_totalprice")),
        F.when(F.col("o_orderstatus") == "F", '"S"').otherwise('"H"'),
        german(F.col("o_custkey") / 64, 6),
        F.when(F.col("o_custkey") % 2 == 0, german(F.col("o_totalprice") / 3)),
        F.col("o_orderkey"),
        F.date_format("o_orderdate", "dMM"),
        priority if note is None else note,
    ]
    rows = table(spark, sf, "orders").select(
        F.concat(F.lit("EXTF_Buchungsstapel_"), year).alias("stem"),
        F.replace(F.lit(_BATCH_HEAD), F.lit("{year}"), year).alias("head"),
        fx.joined(cells, ";").alias("line"),
    )
    fx.write_lines(spread(rows, "line"), folder, "csv", "windows-1250")
    return folder


def quoted_lines_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Batches with line breaks, separators and quotes within quoted texts, beside what the report says
    of their year."""
    lines_ = F.concat(F.lit('"Größe\n""'), F.col("o_orderpriority"), F.lit('"";\n\n1;2"'))
    note = F.when(F.col("o_orderkey") % 3 == 0, lines_).otherwise(F.lit('5" Rohr'))
    result = read_booking_batches(spark, staged_batches(spark, sf, note))
    year = F.regexp_extract("file_name", r"^EXTF_Buchungsstapel_(\d{4})-\d+\.csv$", 1).alias("file_year")
    said = result.report.groupBy(year).agg(
        F.sum("row_count").alias("row_count"), F.array_join(F.collect_set("status"), "|").alias("status")
    )
    return result.combined.select(
        money("umsatz_ohne_soll_haben_kz").alias("amount"),
        F.col("konto").alias("account"),
        day("belegdatum").alias("voucher_date"),
        F.col("buchungstext").alias("note"),
        year,
    ).join(said, "file_year")


def booking_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Booking batches of several years as one frame."""
    result = read_booking_batches(spark, staged_batches(spark, sf))
    return result.combined.select(
        money("umsatz_ohne_soll_haben_kz").alias("amount"),
        "soll_haben_kennzeichen",
        money("kurs").alias("rate"),
        money("basis_umsatz").alias("base_amount"),
        F.col("konto").alias("account"),
        day("belegdatum").alias("voucher_date"),
        F.col("buchungstext").alias("note"),
        F.regexp_extract("file_name", r"^EXTF_Buchungsstapel_(\d{4})-\d+\.csv$", 1).alias(
            "file_year"
        ),
    )


def booking_report(spark: SparkSession, sf: str) -> DataFrame:
    """The report of the batches, by year."""
    report = read_booking_batches(spark, staged_batches(spark, sf)).report
    return report.groupBy(
        F.regexp_extract("file_name", r"_(\d{4})-", 1).alias("file_year"), "status"
    ).agg(F.sum("row_count").alias("row_count"))


def staged_archives(spark: SparkSession, sf: str, parts: int = 12) -> str:
    """Orders as zipped exports, one archive per task."""
    folder = hadoop.fresh_folder(spark, "zips")
    orders = table(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    orders = _keyed(orders, "o_orderkey", "")
    text = exported_rows(orders)
    line = fx.joined([F.col(c) for c in text.columns], ";").alias("line")
    index = fx.index_xml({"orders": orders.schema}, "orders")
    rows = text.select(line)
    if rows.rdd.getNumPartitions() < parts:
        rows = rows.repartition(parts, "line")
    fx.write_zips(rows, folder, index, "orders.txt")
    return folder


def archive_batch(spark: SparkSession, sf: str) -> DataFrame:
    """All archives' orders as one frame."""
    result = import_archives(spark, staged_archives(spark, sf))
    orders = result.combined("orders")
    return orders.drop("_source_zip").withColumns(
        {"o_totalprice": money("o_totalprice"), "o_orderdate": day("o_orderdate")}
    )


def archive_report(spark: SparkSession, sf: str) -> DataFrame:
    """What the archive import reports, summed over archives."""
    report = import_archives(spark, staged_archives(spark, sf)).report
    prefixed = F.col("table_name") == F.concat(
        nm.archive_prefix(F.col("source_zip")), F.lit("_orders")
    )
    return report.groupBy("status").agg(
        F.sum("row_count").alias("row_count"), F.bool_and(prefixed).alias("prefixed")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "de_decimal": de_decimal,
    "de_integer": de_integer,
    "de_date": de_date,
    "de_date_strict": de_date_strict,
    "declared_symbols": declared_symbols,
    "clean_text": clean_text,
    "booking_amount": booking_amount,
    "booking_rate": booking_rate,
    "booking_date": booking_date,
    "normalise_names": normalise_names,
    "file_names": file_names,
    "dedupe_names": dedupe_names,
    "index_catalog": catalog,
    "url_guard": url_guard,
    "infer_types": infer_types,
    "export_rows": export_rows,
    "export_index": export_index,
    "export_roundtrip": export_roundtrip,
    "export_single": export_single,
    "import_export_dir": import_export_dir,
    "import_datev_dir": import_datev_dir,
    "saved_tables": saved_tables,
    "import_xml_layout": import_xml_layout,
    "charset_pick": charset_pick,
    "charset_candidates": charset_candidates,
    "wide_charsets": wide_charsets,
    "folder_separators": folder_separators,
    "folder_bad_rows": folder_bad_rows,
    "skip_lines": skip_lines,
    "ragged_rows": ragged_rows,
    "delimiter_check": delimiter_check,
    "pk_check": pk_check,
    "reject_count": reject_count,
    "import_report": import_report,
    "import_folder_csv": import_folder_csv,
    "import_folder_tsv": import_folder_tsv,
    "import_folder_parquet": import_folder_parquet,
    "import_folder_json": import_folder_json,
    "import_folder_xlsx": import_folder_xlsx,
    "import_folder_other": import_folder_other,
    "folder_options": folder_options,
    "booking_batch": booking_batch,
    "booking_report": booking_report,
    "quoted_lines_batch": quoted_lines_batch,
    "archive_batch": archive_batch,
    "archive_report": archive_report,
}
