import pytest

from helpers import column, index, table
from pruefspur.sources.index_catalog import AUDIT, index_catalog, parse_indexes


def parsed(spark, xml, layout=AUDIT):
    df = spark.createDataFrame([(1, xml)], "id int, index_xml string")
    return parse_indexes(df, layout).orderBy("table_no").collect()


@pytest.mark.parametrize(
    "accuracy, length, expected",
    [
        (2, 20, "decimal(20,2)"),
        (2, None, "decimal(18,2)"),
        (2, 2, "decimal(3,2)"),
        (4, 50, "decimal(38,4)"),
        (0, 10, "bigint"),
        (None, None, "bigint"),
        ("", 10, "bigint"),
    ],
)
def test_number_types(spark, accuracy, length, expected):
    row = parsed(spark, index(table("T", [column("A", "Numeric", accuracy, length)])))[0]
    assert row["columns"][0]["type"] == expected


def test_other_types_and_defaults(spark):
    xml = index(table("T", [column("A"), column("B", "Date"), column("C", None)]))
    row = parsed(spark, xml)[0]
    assert [c["type"] for c in row["columns"]] == ["string", "date", "string"]
    assert (row["decimal_symbol"], row["digit_grouping"], row["skip_lines"]) == (",", ".", 0)
    assert (row["is_utf8"], row["url"], row["media_name"]) == (False, "T.txt", "Test")


def test_table_settings(spark):
    extra = (
        "<UTF8/><DecimalSymbol>.x</DecimalSymbol><DigitGroupingSymbol>,</DigitGroupingSymbol>"
    )
    row = parsed(spark, index(table("T", [column("A")], extra=extra, first=4)))[0]
    assert (row["decimal_symbol"], row["digit_grouping"]) == (".", ",")
    assert (row["skip_lines"], row["is_utf8"]) == (3, True)
    assert parsed(spark, index(table("T", [column("A")], first=0)))[0]["skip_lines"] == 0


def test_keys_come_first_and_names_are_numbered(spark):
    columns = [column("X"), column("Nr"), column("Nr", key=True), column("nr")]
    row = parsed(spark, index(table("T", columns)))[0]
    assert [c["name"] for c in row["columns"]] == ["nr", "x", "nr_2", "nr_3"]
    assert [c["is_primary_key"] for c in row["columns"]] == [True, False, False, False]


def test_names_from_descriptions_fall_back(spark):
    columns = [column("A", description="Konto Nr."), column("B", description=""), column("C")]
    row = parsed(spark, index(table("T", columns)), AUDIT.with_names_from("Description"))[0]
    assert [c["name"] for c in row["columns"]] == ["konto_nr", "b", "c"]


@pytest.mark.parametrize(
    "xml, message",
    [
        ("<DataSet><Version/></DataSet>", "missing Media element"),
        ("<Other><Media/></Other>", "missing DataSet element"),
        ("<DataSet><Media><Table>", "not well-formed XML"),
        ("", "not well-formed XML"),
        (index(table("T", [column("A", "Numeric", "x")])), "not a number"),
    ],
)
def test_unusable_indexes(spark, xml, message):
    assert message in parsed(spark, xml)[0]["error"]


def test_comments_and_escapes(spark):
    xml = "<!-- a --><DataSet><Media><Table><Name>A &amp; B</Name></Table></Media></DataSet>"
    row = parsed(spark, xml)[0]
    assert (row["error"], row["table_name"], row["columns"]) == (None, "A & B", [])


@pytest.mark.parametrize("charset", ["utf-8", "utf-8-sig", "windows-1252", "utf-16"])
def test_index_charsets(spark, tmp_path, charset):
    text = index(table("Größe", [column("A")])).replace(' encoding="UTF-8"', "")
    (tmp_path / "index.xml").write_bytes(text.encode(charset))
    row = index_catalog(spark, str(tmp_path / "index.xml")).head()
    assert row["table_name"] == "Größe"
