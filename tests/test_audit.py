import datetime
import decimal

import pytest

from helpers import (
    BUCHUNGEN,
    BUCHUNGEN_TEXT,
    KUNDEN,
    KUNDEN_TEXT,
    column,
    rows,
    status,
    table,
    write_export,
)
from pruefspur.operators.report import IMPORT_REPORT, ImportResult, SaveFailed, report_frame
from pruefspur import IndexLayout, import_datev_export, import_export, import_index

D = decimal.Decimal
day = datetime.date


@pytest.fixture
def sample(tmp_path):
    return write_export(
        tmp_path / "sample",
        [table("Kunden", KUNDEN, "kunden.txt"), table("Buchungen", BUCHUNGEN, "buchungen.txt")],
        {"kunden.txt": KUNDEN_TEXT, "buchungen.txt": BUCHUNGEN_TEXT},
    )


def test_sample_export(spark, sample):
    result = import_export(spark, sample)
    assert rows(result.report) == [("Kunden", 3, "OK"), ("Buchungen", 3, "OK")]
    kunden = result.tables["Kunden"]
    assert kunden.dtypes == [
        ("nr", "string"),
        ("name", "string"),
        ("saldo", "decimal(20,2)"),
        ("erstell_datum", "date"),
        ("anzahl", "bigint"),
    ]
    assert rows(kunden, "nr") == [
        ("D17", "Nördlich Werft AG", D("9871.03"), day(2021, 11, 7), 8),
        ("D18", "Ohm & Söhne OHG", D("-44.12"), day(2022, 4, 30), 31),
        ("D19", "Straßenbau Jäger", D("0.00"), day(2020, 2, 29), 0),
    ]
    assert rows(result.tables["Buchungen"], "lfd_nr") == [
        (1, "4000", D("12040.90"), day(2024, 6, 1)),
        (2, "8000", D("-7.05"), day(2024, 6, 15)),
        (3, "4000", D("618.00"), day(2024, 6, 30)),
    ]
    result.create_views()
    assert spark.sql("select sum(saldo) from Kunden").head()[0] == D("9826.91")


def test_names_from_descriptions(spark, sample):
    tables = import_export(spark, sample, "Description").tables
    assert tables["Kunden"].columns[:2] == ["kundennummer", "kundenname"]
    assert tables["Buchungen"].columns[0] == "lfd_nr"


def test_datev_and_registered_layouts(spark, sample):
    assert rows(import_datev_export(spark, sample).report)[0] == ("Kunden", 3, "OK")
    plain = import_index(spark, sample).tables["Kunden"]
    # The declared length is not used by this way in.
    assert dict(plain.dtypes)["saldo"] == "decimal(18,2)"
    unknown = import_index(spark, sample, "other").report.head()
    assert unknown["table_name"] == "(parser)"
    assert "Available: audit, generic" in unknown["status"]


def test_saved_tables(spark, sample, tmp_path):
    spark.sql(f"create database if not exists saved location '{tmp_path}/saved'")
    import_export(spark, sample).save("saved")
    assert spark.table("saved.Kunden").count() == 3
    names = lambda: {r["tableName"] for r in spark.sql("show tables in saved").collect()}
    before = names()

    def result(**tables):
        return ImportResult(spark, tables, report_frame(spark, [], IMPORT_REPORT))

    broken = lambda: spark.read.parquet(f"{tmp_path}/absent")
    late = lambda: spark.range(1).selectExpr("raise_error('late') as x")
    for fault in (broken, late):
        with pytest.raises(SaveFailed, match="zuletzt"):
            result(Kunden=lambda: spark.range(9), zuletzt=fault).save("saved")
        assert names() == before and spark.table("saved.kunden").count() == 3
    # A table that cannot take its place: those before it go back.
    refused = result(Kunden=lambda: spark.range(9), neu=lambda: spark.range(1))
    rename, refused._rename = refused._rename, None

    def once_refused(source, target):
        if target.endswith("`neu`"):
            raise ValueError("no place")
        rename(source, target)

    refused._rename = once_refused
    with pytest.raises(SaveFailed, match="neu"):
        refused.save("saved")
    assert names() == before and spark.table("saved.kunden").count() == 3
    odd = {"Kunden": lambda: spark.range(9), "Straße Nr.": lambda: spark.range(1), "--": lambda: spark.range(2)}
    result(**odd, strasse_nr=lambda: spark.range(4)).save("saved")
    assert names() == before | {"strasse_nr", "strasse_nr_2", "unnamed"}
    assert spark.table("saved.kunden").count() == 9 and spark.table("saved.strasse_nr_2").count() == 4
    spark.sql("drop database saved cascade")


def test_traversal_is_refused(spark, tmp_path):
    for path in ("../../etc/passwd", "a/../b", "..\\x", ".."):
        row = import_export(spark, path).report.head()
        assert row["table_name"] == "(security)" and "Path traversal" in row["status"]
    folder = write_export(tmp_path / "e", [table("T", [column("A")], "../x.txt")], {})
    assert "Path traversal" in status(import_export(spark, folder), "T")[1]


def test_invalid_dates_become_null(spark, tmp_path):
    columns = [column("Nr", key=True), column("Datum", "Date"), column("Wert", "Numeric", 2)]
    text = "A1;15.03.2024;100,00\nA2;32.13.2024;200,00\nA3;00.00.0000;300,00\nA4;;400,00\n" \
        "A5;01.01.2025;500,00\n"
    folder = write_export(tmp_path / "d", [table("DatumTest", columns)], {"DatumTest.txt": text})
    result = import_export(spark, folder)
    assert rows(result.report) == [("DatumTest", 5, "OK")]
    assert [r[1] for r in rows(result.tables["DatumTest"], "nr")] == [
        day(2024, 3, 15), None, None, None, day(2025, 1, 1),
    ]
    assert rows(result.rejects) == [("DatumTest", "datum", 2)]
    # The pluggable import is strict about dates.
    strict = import_index(spark, folder)
    assert "datum: 2" in status(strict, "DatumTest")[1]
    refused = import_index(spark, folder, on_error="fail")
    assert status(refused, "DatumTest")[0] == 0 and not refused.tables


def test_wrong_delimiter_is_noticed(spark, tmp_path):
    columns = [column("Nr"), column("Name"), column("Wert")]
    folder = write_export(
        tmp_path / "w", [table("T", columns)], {"T.txt": "K1|Mueller|100\nK2|Schmidt|200\n"}
    )
    result = import_export(spark, folder)
    count, text = status(result, "T")
    assert count == 2 and "delimiter may be wrong" in text
    assert rows(result.tables["T"], "nr") == [("K1|Mueller|100", None, None),
                                             ("K2|Schmidt|200", None, None)]


@pytest.mark.parametrize("skip", [0, 1, 2])
@pytest.mark.parametrize("charset", ["utf-8", "windows-1252"])
def test_charsets_and_skipped_lines_over_splits(spark, small_splits, tmp_path, charset, skip):
    text = "".join(f"{i};Größe {i} €\r\n" for i in range(3000))
    head = "0;Größe\r\n" * skip
    folder = write_export(
        tmp_path / "r",
        [table("T", [column("Nr", "Numeric"), column("Name")], first=skip + 1)],
        {"T.txt": (head + text).encode(charset)},
    )
    result = import_export(spark, folder)
    assert status(result, "T") == (3000, "OK")
    data = result.tables["T"]
    assert data.rdd.getNumPartitions() > 5
    assert rows(data, "nr") == [(i, f"Größe {i} €") for i in range(3000)]


def test_charset_can_be_given(spark, tmp_path):
    folder = write_export(
        tmp_path / "c", [table("T", [column("A"), column("B")])], {"T.txt": "x;Größe\n".encode("cp850")}
    )
    assert rows(import_export(spark, folder, charset="cp850").tables["T"]) == [("x", "Größe")]


def test_utf8_flag_that_does_not_hold(spark, tmp_path):
    folder = write_export(
        tmp_path / "u",
        [table("T", [column("A"), column("B")], extra="<UTF8/>")],
        {"T.txt": "x;Größe\n".encode("latin-1")},
    )
    result = import_export(spark, folder)
    assert "UTF-8" in status(result, "T")[1]
    assert rows(result.tables["T"]) == [("x", "Größe")]


def test_ragged_and_quoted_rows(spark, tmp_path):
    text = 'a\nb;c\n;;\n"x;y";"q""r";""\n5" Rohr;7" y;z\n\nl;m;n;more\n'
    folder = write_export(
        tmp_path / "q", [table("T", [column("A"), column("B"), column("C")])], {"T.txt": text}
    )
    expected = {
        ("a", None, None),
        ("b", "c", None),
        (None, None, None),
        ("x;y", 'q"r', None),
        ('5" Rohr', '7" y', "z"),
        ("l", "m", "n"),
    }
    assert set(rows(import_export(spark, folder).tables["T"])) == expected
    whole = import_export(spark, folder, drop_bad_rows=True).tables["T"]
    assert set(rows(whole)) == expected - {("l", "m", "n")}


def test_line_breaks_within_quotes(spark, tmp_path):
    text = '1;"a\nb"\n2;c\n'
    folder = write_export(
        tmp_path / "m", [table("T", [column("A", "Numeric"), column("B")])], {"T.txt": text}
    )
    assert "open quote" in status(import_export(spark, folder, multiline=False), "T")[1]
    for settled in (None, True):
        result = import_export(spark, folder, multiline=settled)
        assert status(result, "T") == (2, "OK")
        assert rows(result.tables["T"], "a") == [(1, "ab"), (2, "c")]


def test_multiline_with_charset_and_skip(spark, tmp_path):
    text = 'h;h\n1;"Grö\nße"\n2;c\n'.encode("windows-1252")
    folder = write_export(
        tmp_path / "m",
        [table("T", [column("A", "Numeric"), column("B")], first=2)],
        {"T.txt": text},
    )
    result = import_export(spark, folder, multiline=True)
    assert rows(result.tables["T"], "a") == [(1, "Größe"), (2, "c")]


def test_bad_numbers(spark, tmp_path):
    columns = [column("A", "Numeric"), column("B", "Numeric", 2, 4)]
    text = "12,6;1,00\n7; \n8;123,45\n9;99,99\n"
    folder = write_export(tmp_path / "b", [table("T", columns)], {"T.txt": text})
    result = import_export(spark, folder)
    assert status(result, "T") == (
        4, "Warning: values that do not convert became NULL (a: 1, b: 2)"
    )
    assert rows(result.tables["T"]) == [
        (None, D("1.00")), (7, None), (8, None), (9, D("99.99"))
    ]
    refused = import_export(spark, folder, on_error="fail")
    assert status(refused, "T")[1].startswith("Load failed") and "T" not in refused.tables


def test_declared_symbols(spark, tmp_path):
    extra = "<DecimalSymbol>.</DecimalSymbol><DigitGroupingSymbol>,</DigitGroupingSymbol>"
    folder = write_export(
        tmp_path / "s",
        [table("T", [column("A", "Numeric", 2), column("B", "Numeric")], extra=extra)],
        {"T.txt": "1,234.50;1,000\n"},
    )
    assert rows(import_export(spark, folder).tables["T"]) == [(D("1234.50"), 1000)]


def test_keys(spark, tmp_path):
    columns = [column("Nr", "Numeric", key=True), column("T")]
    folder = write_export(
        tmp_path / "k", [table("T", columns)], {"T.txt": "1;a\n1;b\n;c\n;d\n2;e\n"}
    )
    result = import_export(spark, folder)
    assert status(result, "T") == (
        5, "Warning: primary key: 2 rows with NULL, 1 repeated rows"
    )
    assert result.tables["T"].count() == 5
    assert status(import_export(spark, folder, check_keys=False), "T") == (5, "OK")
    assert "primary keys" in status(import_export(spark, folder, on_error="fail"), "T")[1]


def test_tables_that_cannot_load_do_not_stop_others(spark, tmp_path):
    tables = [
        table("Fehlt", [column("A")]),
        table("Leer", [column("A"), column("B")]),
        table("Ohne", []),
        table("Gut", [column("A"), column("B")]),
        table("Gut", [column("A"), column("B")], "Gut.txt"),
    ]
    folder = write_export(tmp_path / "x", tables, {"Leer.txt": "", "Gut.txt": "a;b\n",
                                                  "Ohne.txt": "a\n"})
    result = import_export(spark, folder)
    assert rows(result.report) == [
        ("Fehlt", 0, "Load failed: no data file 'Fehlt.txt'"),
        ("Leer", 0, "Empty"),
        ("Ohne", 0, "Create failed: no columns declared"),
        ("Gut", 1, "OK"),
        ("Gut_2", 1, "OK"),
    ]
    assert list(result.tables) == ["Gut", "Gut_2"]


def test_unusable_index(spark, tmp_path):
    missing = import_export(spark, str(tmp_path)).report.head()
    assert missing["table_name"] == "(schema)" and "Parse error" in missing["status"]
    (tmp_path / "index.xml").write_text("<DataSet><Media>")
    assert "well-formed" in import_export(spark, str(tmp_path)).report.head()["status"]


def test_data_file_names_are_taken_literally(spark, tmp_path):
    folder = write_export(
        tmp_path / "g", [table("T", [column("A"), column("B")], "a[1]*ü.txt")],
        {"a[1]*ü.txt": "x;y\n"},
    )
    assert rows(import_export(spark, folder).tables["T"]) == [("x", "y")]


def test_a_layout_of_ones_own(spark, tmp_path):
    (tmp_path / "cols.xml").write_text(
        "<Schema><Tab><Label>Teile</Label><File>t.dat</File>"
        "<Field><Label>TeilNr</Label><Kind>INTEGER</Kind></Field>"
        "<Field><Label>Preis</Label><Kind>NUMBER</Kind><Digits>2</Digits></Field>"
        "<Field><Label>Seit</Label><Kind>DATE</Kind></Field></Tab></Schema>"
    )
    (tmp_path / "t.dat").write_text("nr|preis|seit\n7|1.234,50|01.02.2024\n")
    layout = IndexLayout(
        index_file="cols.xml", root="Schema", table_element="Tab", column_parent="",
        column_element="Field", table_name="Label", table_url="File", column_name="Label",
        type_field="Kind", precision_field="Digits", delimiter="|", has_header=True,
    )
    result = import_index(spark, str(tmp_path), layout)
    assert rows(result.tables["Teile"]) == [(7, D("1234.50"), day(2024, 2, 1))]


def test_generic_layout_has_columns_below_the_table(spark, tmp_path):
    (tmp_path / "index.xml").write_text(
        "<DataSet><Media><Table><Name>T</Name><URL>t.txt</URL>"
        "<VariableColumn><Name>AbC</Name><Numeric><Accuracy>1</Accuracy></Numeric>"
        "<MaxLength>5</MaxLength></VariableColumn></Table></Media></DataSet>"
    )
    (tmp_path / "t.txt").write_text("1,5\n")
    data = import_index(spark, str(tmp_path), "generic").tables["T"]
    assert data.dtypes == [("ab_c", "decimal(18,1)")] and rows(data) == [(D("1.5"),)]


def test_byte_order_mark(spark, tmp_path):
    text = "7;Größe\n8;x\n".encode("utf-8-sig")
    folder = write_export(
        tmp_path / "b", [table("T", [column("A", "Numeric"), column("B")])], {"T.txt": text}
    )
    assert rows(import_export(spark, folder).tables["T"], "a") == [(7, "Größe"), (8, "x")]


def test_multi_byte_charsets_are_refused(spark, tmp_path):
    folder = write_export(
        tmp_path / "b", [table("T", [column("A"), column("B")])], {"T.txt": "a;b\n"}
    )
    result = import_export(spark, folder, charset="utf-16")
    assert "single-byte" in status(result, "T")[1] and not result.tables


def test_forms_of_line_ends(spark, tmp_path):
    folder = write_export(
        tmp_path / "l",
        [table("T", [column("A"), column("B")])],
        {"T.txt": b"a;b\r\nc;d\ne;f\rg;h"},
    )
    assert rows(import_export(spark, folder).tables["T"], "a") == [
        ("a", "b"), ("c", "d"), ("e", "f"), ("g", "h")
    ]
