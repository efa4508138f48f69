import threading
import datetime
import decimal
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from helpers import rows
from pruefspur import export_table, import_export
from pruefspur.plans import queries
from pruefspur.sinks import export

D = decimal.Decimal
day = datetime.date


@pytest.fixture
def mixed(spark):
    return spark.createDataFrame(
        [
            (1, 5, D("1.50"), 1.005, day(2024, 3, 1), True, datetime.datetime(2024, 1, 2, 3, 4, 5), "a;b"),
            (2, None, D("-0.01"), 1e10, None, False, None, 'q"x"'),
            (3, -7, D("12345678901234567890.12"), None, day(1999, 12, 31), None, None, " sp "),
            (4, 0, None, -0.5, None, None, None, None),
            (5, 1, None, 0.0, None, None, None, ""),
        ],
        "id bigint, n int, d decimal(22,2), f double, dt date, b boolean, ts timestamp_ntz, t string",
    )


def test_files_and_report(spark, mixed, tmp_path):
    folder = str(tmp_path / "new" / "deep")
    row = export_table(mixed, folder, "Misch").head()
    assert (row["table_name"], row["row_count"], row["status"]) == ("Misch", 5, "OK")
    lines = sorted((tmp_path / "new/deep/Misch.txt").read_text().splitlines())
    assert lines == [
        '1;5;1,50;1,01;01.03.2024;true;2024-01-02 03:04:05;"a;b"',
        '2;;-0,01;10000000000,00;;false;;"q""x"""',
        "3;-7;12345678901234567890,12;;31.12.1999;;; sp ",
        "4;0;;-0,50;;;;",
        '5;1;;0,00;;;;""',
    ]
    media = ET.parse(tmp_path / "new/deep/index.xml").getroot().find("Media")
    table = media.find("Table")
    assert [table.findtext(t) for t in ("Name", "URL", "DecimalSymbol", "DigitGroupingSymbol")] == [
        "Misch", "Misch.txt", ",", ".",
    ]
    assert table.find("UTF8") is not None and table.findtext("Range/From") == "1"
    kinds = [
        (c.findtext("Name"), next(e.tag for e in c if e.tag not in ("Name", "MaxLength")),
         c.findtext("Numeric/Accuracy"))
        for c in table.find("VariableLength")
    ]
    assert kinds == [
        ("id", "Numeric", None), ("n", "Numeric", None), ("d", "Numeric", "2"),
        ("f", "Numeric", "2"), ("dt", "Date", None), ("b", "AlphaNumeric", None),
        ("ts", "AlphaNumeric", None), ("t", "AlphaNumeric", None),
    ]


@pytest.mark.parametrize("single", [True, False])
def test_round_trip(spark, mixed, tmp_path, single):
    folder = str(tmp_path)
    for _ in range(2):  # the second export replaces the first
        export_table(mixed.repartition(3), folder, "T", single_file=single).collect()
    assert (tmp_path / "T.txt").is_dir() == (single is False)
    back = import_export(spark, folder).tables["T"]
    expected = mixed.select(
        "id",
        F.col("n").cast("bigint"),
        "d",
        F.col("f").cast("decimal(18,2)"),
        "dt",
        F.col("b").cast("string"),
        F.col("ts").cast("string"),
        # Empty text comes back as NULL, outer spaces are trimmed.
        F.nullif(F.trim("t"), F.lit("")).alias("t"),
    )
    assert rows(back, "id") == rows(expected, "id")


def test_the_parameter_alone_decides_on_parts(spark, tmp_path):
    for single, name in ((True, "one"), (False, "parts")):
        report = export_table(spark.range(1000).repartition(4), str(tmp_path / name), "big", single_file=single)
        assert report.head()["status"] == ("OK" if single else "OK (a folder of parts)")
        assert (tmp_path / name / "big.txt").is_dir() == (not single)
        assert import_export(spark, str(tmp_path / name)).tables["big"].count() == 1000


def test_keys_survive_and_come_first(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "t string, nr int")
    df = df.withColumn("nr", F.col("nr").alias("nr", metadata={"primary_key": True}))
    export_table(df, str(tmp_path), "K").collect()
    back = import_export(spark, str(tmp_path)).tables["K"]
    assert back.columns == ["nr", "t"] and rows(back, "nr") == [(1, "a"), (2, "b")]
    assert back.schema["nr"].metadata["primary_key"] is True
    # An imported table exports with its key again.
    export_table(back, str(tmp_path / "again"), "K").collect()
    assert "<VariablePrimaryKey>" in (tmp_path / "again/index.xml").read_text()


def test_empty_table(spark, tmp_path):
    row = export_table(spark.range(0), str(tmp_path), "E").head()
    assert (row["row_count"], row["status"]) == (0, "OK")
    assert (tmp_path / "E.txt").read_text() == ""


def test_refusals(spark, tmp_path):
    nested = spark.range(1).select(F.array("id").alias("a"))
    row = export_table(nested, str(tmp_path), "N").head()
    assert row["status"].startswith("Export failed") and "cannot be exported" in row["status"]
    assert "Path traversal" in export_table(spark.range(1), str(tmp_path) + "/../x", "N").head()[3]
    assert "Path traversal" in export_table(spark.range(1), str(tmp_path), "../N").head()[3]


def test_floats_without_decimal_text_are_reported(spark, tmp_path):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (1e40,), (1.0,)], "f double")
    row = export_table(df, str(tmp_path), "F").head()
    assert row["status"].startswith("Warning: 3 values")


def test_more_decimals_on_request(spark, tmp_path):
    df = spark.createDataFrame([(0.12345,)], "f double")
    export_table(df, str(tmp_path), "F", double_scale=4).collect()
    assert (tmp_path / "F.txt").read_text() == "0,1235\n"
    assert rows(import_export(spark, str(tmp_path)).tables["F"]) == [(D("0.1235"),)]


def test_tables_of_the_index_are_exported_side_by_side(spark, tmp_path, monkeypatch):
    """Two exports meet, which they cannot one after the other."""
    meeting = threading.Barrier(2, timeout=30)

    def export(df, path, name, **options):
        meeting.wait()
        return export_table(df, path, name, **options)

    tables = {n: spark.range(3).withColumnRenamed("id", n) for n in ("one", "two")}
    monkeypatch.setattr(queries, "export_table", export)
    monkeypatch.setattr(queries, "_flat_tables", lambda *_: tables)
    found = queries.export_index(spark, "").select("form", "name", "row_count", "status").collect()
    assert sorted(map(tuple, found)) == [
        ("file", "one", 3, "OK"), ("file", "two", 3, "OK"),
        ("parts", "one", 3, "OK (a folder of parts)"), ("parts", "two", 3, "OK (a folder of parts)"),
    ]
