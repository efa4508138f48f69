import datetime
import decimal
import re

import pytest
from pyspark.sql import functions as F

from pruefspur.functions import charset as cs
from pruefspur.functions import convert as cv

D = decimal.Decimal


def apply(spark, values, convert, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    found = df.select("i", convert(F.col("v")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in found]


def test_german_decimals(spark):
    cases = {
        "1.234,56": D("1234.56"),
        "-567,89": D("-567.89"),
        "0,00": D("0.00"),
        "+1,5": D("1.50"),
        " 7 ": D("7.00"),
        ",5": D("0.50"),
        "5,": D("5.00"),
        "1.005": D("1005.00"),
        "1,005": D("1.01"),
        "-1,005": D("-1.01"),
        "1e3": None,
        "1_000": None,
        "1,2,3": None,
        "abc": None,
        "1E3": None,
        "1d": None,
        "NaN": None,
        "Infinity": None,
        "1_0": None,
        "0x10": None,
        "": None,
        " ": None,
        "--5": None,
        "٣": None,
        "12345678901234567,00": None,
        None: None,
    }
    got = apply(spark, list(cases), lambda c: cv.to_decimal(c, 18, 2))
    assert got == list(cases.values())


def test_german_integers(spark):
    cases = {
        "1.234": 1234,
        " -7 ": -7,
        "+5": 5,
        "12,6": None,
        "1e3": None,
        "0x1F": None,
        "1_000": None,
        "12.": 12,
        "٣": None,
        "1L": None,
        "- 5": None,
        "\t8\n": 8,
        "9223372036854775807": 9223372036854775807,
        "9223372036854775808": None,
        "": None,
        None: None,
    }
    assert apply(spark, list(cases), cv.to_integer) == list(cases.values())


def test_german_dates(spark):
    day = datetime.date
    cases = {
        "15.03.2024": day(2024, 3, 15),
        "1.3.2024": day(2024, 3, 1),
        "  15.03.2024 ": day(2024, 3, 15),
        "29.02.2024": day(2024, 2, 29),
        "29.02.2023": None,
        "31.04.2024": None,
        "32.13.2024": None,
        "00.00.0000": None,
        "001.03.2024": None,
        "01.03.24": None,
        "01.03.12024": None,
        "15.03.2024 10:00": None,
        "2024-03-15": None,
        "": None,
        "  ": None,
        None: None,
    }
    assert apply(spark, list(cases), cv.to_date) == list(cases.values())


def test_iso_dates(spark):
    day = datetime.date
    cases = {
        "2024-03-15": day(2024, 3, 15),
        "2024/3/5": day(2024, 3, 5),
        "2024-3/5": None,
        "20240315": None,
        "2024-02-30": None,
    }
    assert apply(spark, list(cases), cv.iso_date) == list(cases.values())


def test_declared_symbols(spark):
    assert apply(spark, ["1,234.5"], lambda c: cv.to_decimal(c, 18, 2, ".", ",")) == [D("1234.50")]
    assert apply(spark, ["1'234.5"], lambda c: cv.to_decimal(c, 18, 2, ".", "'")) == [D("1234.50")]
    assert apply(spark, ["1 234,5"], lambda c: cv.to_decimal(c, 18, 2, ",", " ")) == [D("1234.50")]
    assert apply(spark, ["1.234"], lambda c: cv.to_decimal(c, 18, 2, ".", "")) == [D("1.23")]
    assert apply(spark, ["1,234"], lambda c: cv.to_integer(c, ",")) == [1234]
    assert apply(spark, ["1’234·5", "1e3"], lambda c: cv.to_decimal(c, 18, 2, "·", "’")) == [
        D("1234.50"), None,
    ]
    assert apply(spark, ["1^2"], lambda c: cv.to_decimal(c, 18, 2, "^", "]")) == [D("1.20")]


def test_cleaning_removes_every_control_character(spark):
    cases = {
        "a\x07b\x00c": "abc",
        "\x85 Größe ": "Größe",
        "\t x \n": "x",
        "  ": "",
        "a  b": "a  b",
        None: None,
    }
    assert apply(spark, list(cases), cv.clean_text) == list(cases.values())


def test_voucher_dates(spark):
    day = datetime.date
    cases = {
        "103": day(2024, 3, 1),
        "2001": day(2024, 1, 20),
        " 3112 ": day(2024, 12, 31),
        "2902": day(2024, 2, 29),
        "3113": None,
        "01": None,
        "x01": None,
        "": None,
        None: None,
    }
    got = apply(spark, list(cases), lambda c: cv.voucher_date(c, 2024))
    assert got == list(cases.values())


def test_rejects_count_only_present_values(spark):
    flag = apply(spark, ["x", "", " ", "1", None], lambda c: cv.rejected(c, cv.to_integer(c)))
    assert flag == [True, True, True, False, False]
    flag = apply(spark, ["x", "", " "], lambda c: cv.rejected(c, cv.to_date(c), blank_ok=True))
    assert flag == [True, False, False]


def test_export_text(spark):
    got = apply(spark, [1.005, 1e10, -0.125, None], lambda c: cv.export_decimal(c, 2), "double")
    assert got == ["1,01", "10000000000,00", "-0,13", None]
    got = apply(spark, [D("-1234.50")], cv.export_decimal, "decimal(18,2)")
    assert got == ["-1234,50"]
    assert apply(spark, [datetime.date(2024, 3, 1)], cv.export_date, "date") == ["01.03.2024"]


@pytest.mark.parametrize(
    "charset", ["windows-1252", "windows-1250", "iso-8859-1", "iso-8859-15", "cp850", "cp437"]
)
def test_every_byte_decodes(spark, charset):
    known = bytes(b for b in range(256) if _decodes(b, charset))
    df = spark.createDataFrame([(bytearray(known),)], "b binary")
    assert df.select(cs.decoded(F.col("b"), charset)).head()[0] == known.decode(charset)


def _decodes(code, charset):
    try:
        bytes([code]).decode(charset)
    except UnicodeDecodeError:
        return False
    return True


def test_usual_dates_are_read_without_a_formatter(spark):
    """The short way gives what the formatter gives, and leaves to it what it cannot tell."""
    texts = [f"{d:02}.{m:02}.{y}" for d in range(33) for m in range(14) for y in ("1582", "1599", "1600", "2023", "2024")]
    texts += ["1.2.2024", " 01.02.2024 ", "01.02.2024\n", "01.02.2024x", "01.02.24", "٠١.٠٢.٢٠٢٤", "1T.02.2024", "", None]
    read = spark.createDataFrame([(x,) for x in texts], "t string").select("t", cv.to_date("t").alias("got"))
    for text, got in read.collect():
        found = re.fullmatch(r"[ ]*([0-9]{1,2})\.([0-9]{1,2})\.([0-9]{4})[ ]*", text or "")
        try:
            wanted = datetime.date(int(found[3]), int(found[2]), int(found[1])) if found else None
        except ValueError:
            wanted = None
        assert got == wanted
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert "concat_ws(-" in plan
