import datetime
import decimal

import pytest

from helpers import rows
from pruefspur import read_booking_batches

D = decimal.Decimal
day = datetime.date

NAMES = (
    "Umsatz (ohne Soll/Haben-Kz);Soll/Haben-Kennzeichen;Kurs;Basis-Umsatz;Konto;Belegdatum;"
    '"Buchungstext"'
)


def head(year):
    fields = ['"EXTF"', "700", "21", '"Buchungsstapel; x"', "13", "2024", "", '"RE"', '""', '""',
              "1001", "1", f"{year}0101", "4", f' "{year}0101" ', f"{year}1231"]
    return ";".join(fields)


def write(folder, name, lines, charset="windows-1250", end="\r\n"):
    (folder / name).write_bytes(end.join([*lines, ""]).encode(charset))


def test_batches(spark, tmp_path):
    write(tmp_path, "EXTF_Buchungsstapel_23 +ä.csv", [
        head(2023), NAMES,
        '1.234,56;"S";1,123456;;4400;103;"Müller; ""X"""',
        "",
        ' 5,00 ;"H";;9,99;4400;3112;Größe',
        "1,0;;;;;3113;bad",
    ])
    write(tmp_path, "EXTF_Buchungsstapel_24.CSV", [head(2024), NAMES, "1,5;S;1,1;;4400;2902;Ü€"],
          "utf-8")
    write(tmp_path, "EXTF_Buchungsstapel_bad.csv", ["a;b", "c;d", "1;2"])
    write(tmp_path, "EXTF_Buchungsstapel_one.csv", [head(2024)])
    (tmp_path / "EXTF_Buchungsstapel_none.csv").write_bytes(b"")
    write(tmp_path, "Other.csv", [head(2024), NAMES, "1;2"])
    result = read_booking_batches(spark, str(tmp_path))
    no_header = "Failed to parse header (could not extract year from Datum-von field)"
    assert sorted(rows(result.report)) == [
        ("EXTF_Buchungsstapel_23 +ä", "EXTF_Buchungsstapel_23 +ä.csv", 3,
         "Warning: values that do not convert became NULL (belegdatum: 1)"),
        ("EXTF_Buchungsstapel_24", "EXTF_Buchungsstapel_24.CSV", 1, "OK"),
        ("EXTF_Buchungsstapel_bad", "EXTF_Buchungsstapel_bad.csv", 0, no_header),
        ("EXTF_Buchungsstapel_none", "EXTF_Buchungsstapel_none.csv", 0, no_header),
        ("EXTF_Buchungsstapel_one", "EXTF_Buchungsstapel_one.csv", 0,
         "Failed to parse column names from row 2"),
    ]
    first = result.tables["EXTF_Buchungsstapel_23 +ä"]
    assert first.dtypes == [
        ("umsatz_ohne_soll_haben_kz", "decimal(18,2)"),
        ("soll_haben_kennzeichen", "string"),
        ("kurs", "decimal(18,6)"),
        ("basis_umsatz", "decimal(18,2)"),
        ("konto", "string"),
        ("belegdatum", "date"),
        ("buchungstext", "string"),
        ("file_name", "string"),
    ]
    name = "EXTF_Buchungsstapel_23 +ä.csv"
    assert rows(first) == [
        (D("1234.56"), "S", D("1.123456"), None, "4400", day(2023, 3, 1), 'Müller; "X"', name),
        (D("5.00"), "H", None, D("9.99"), "4400", day(2023, 12, 31), "Größe", name),
        (D("1.00"), None, None, None, None, None, "bad", name),
    ]
    assert result.combined.count() == 4
    assert [r["buchungstext"] for r in result.tables["EXTF_Buchungsstapel_24"].collect()] == ["Ü€"]
    rejected = {(r[0], r[1]): r[2] for r in rows(result.reject_counts())}
    assert rejected[(name, "belegdatum")] == 1 and sum(rejected.values()) == 1
    assert rows(result.rejects) == [("EXTF_Buchungsstapel_23 +ä", "belegdatum", 1)]


def test_faults_are_told_and_refused(spark, tmp_path):
    write(tmp_path, "EXTF_Buchungsstapel_a.csv", [head(2024), "Konto;Kurs", "1;2,5;;LOST", "2;abc"])
    write(tmp_path, "EXTF_Buchungsstapel_b.csv", [head(2024), "Konto;Kurs", "3;1,5;"])
    told = read_booking_batches(spark, str(tmp_path))
    notes = (
        "values that do not convert became NULL (kurs: 1); "
        "1 rows have more fields than declared, which were cut"
    )
    assert [r[2:] for r in rows(told.report)] == [(2, f"Warning: {notes}"), (1, "OK")]
    refused = read_booking_batches(spark, str(tmp_path), on_error="fail")
    assert [r[2:] for r in rows(refused.report)] == [(0, f"Load failed: {notes}"), (1, "OK")]
    assert list(refused.tables) == ["EXTF_Buchungsstapel_b"] and refused.combined.count() == 1


def test_layouts_are_matched_by_name(spark, tmp_path):
    write(tmp_path, "EXTF_Buchungsstapel_a.csv", [head(2024), "Konto;Kurs", "1;2,5"])
    write(tmp_path, "EXTF_Buchungsstapel_b.csv", [head(2025), "Belegdatum;Konto;;Konto", "103;7;x;8"])
    combined = read_booking_batches(spark, str(tmp_path)).combined
    assert set(combined.columns) == {
        "konto", "kurs", "belegdatum", "column_3", "konto_2", "file_name"
    }
    found = {r["konto"]: r for r in combined.collect()}
    assert found["1"]["kurs"] == D("2.5") and found["7"]["belegdatum"] == day(2025, 3, 1)
    assert (found["7"]["column_3"], found["7"]["konto_2"]) == ("x", "8")


@pytest.mark.parametrize("charset", [None, "cp850"])
def test_many_splits(spark, small_splits, tmp_path, charset):
    used = charset or "windows-1250"
    for i in range(3):
        lines = [f"{n},5;S;;;{i};103;Größe" for n in range(1500)]
        write(tmp_path, f"EXTF_Buchungsstapel_{i}.csv", [head(2020 + i), NAMES, *lines], used)
    result = read_booking_batches(spark, str(tmp_path), charset)
    assert [r[2] for r in rows(result.report)] == [1500] * 3
    combined = result.combined
    assert combined.rdd.getNumPartitions() > 10
    sums = combined.groupBy("konto", "belegdatum", "buchungstext").sum(
        "umsatz_ohne_soll_haben_kz"
    )
    total = D(sum(range(1500))) + D("0.5") * 1500
    assert sorted(rows(sums)) == [
        (str(i), day(2020 + i, 3, 1), "Größe", total) for i in range(3)
    ]


@pytest.mark.parametrize("charset", ["windows-1250", "utf-8", "utf-16-le"])
def test_quoted_line_breaks(spark, small_splits, tmp_path, charset):
    """Also where a split begins inside quotes, and beside files that have none or leave one open."""
    long_text = "".join(f"Zeile {i};Größe\r\n\r\n" for i in range(700))
    body = [f'{n},5;S;;;1;103;"Müller {n}\r\n""B""; x"' if n % 4 else f"{n},5;S;;;1;103;5\" Rohr" for n in range(600)]
    write(tmp_path, "EXTF_Buchungsstapel_a.csv", [head(2024), NAMES, *body, f'1;S;;;2;103;"{long_text}"', "", '2;S;;;3;103;"ü"'], charset)
    write(tmp_path, "EXTF_Buchungsstapel_b.csv", [head(2024), NAMES, *["1,0;S;;;4;103;ü"] * 200], charset)
    write(tmp_path, "EXTF_Buchungsstapel_c.csv", [head(2024), NAMES, '1,0;S;;;5;103;"offen', "2,0;S;;;5;103;zu"], charset)
    result = read_booking_batches(spark, str(tmp_path), charset)
    assert [r[2:] for r in rows(result.report)] == [(602, "OK"), (200, "OK"), (2, "Warning: 1 lines with an open quote")]
    table = result.tables["EXTF_Buchungsstapel_a"]
    notes = {(r["konto"], r["umsatz_ohne_soll_haben_kz"]): r["buchungstext"] for r in table.collect()}
    assert len(notes) == 602 and table.count() == 602
    for n in range(600):
        assert notes[("1", D(f"{n}.50"))].replace("\r", "") == (f'Müller {n}\n"B"; x' if n % 4 else '5" Rohr')
    assert notes[("2", D("1.00"))].replace("\r", "") == long_text.replace("\r", "")
    assert notes[("3", D("2.00"))] == "ü"
    assert result.combined.count() == 804 and {r["file_name"] for r in result.combined.collect()} == {
        f"EXTF_Buchungsstapel_{x}.csv" for x in "abc"
    }


def test_no_files(spark, tmp_path):
    row = read_booking_batches(spark, str(tmp_path)).report.head()
    assert row["table_name"] == "(no files)" and "EXTF_Buchungsstapel*.csv" in row["status"]
    assert read_booking_batches(spark, "../x").report.head()["table_name"] == "(security)"
