"""Rows with more fields than declared are told of, and refused where errors fail."""

from helpers import column, status, table, write_export

from pruefspur import import_export


def export(folder):
    columns = [column("a"), column("b")]
    return write_export(folder, [table("T", columns)], {"T.txt": "1;2\n3;4;LOST\n5;6\n"})


def test_surplus_fields_are_in_the_report(spark, tmp_path):
    result = import_export(spark, export(tmp_path / "x"))
    assert status(result, "T") == (3, "Warning: 1 rows have more fields than declared, which were cut")
    assert result.tables["T"].count() == 3


def test_surplus_fields_fail_a_strict_import(spark, tmp_path):
    result = import_export(spark, export(tmp_path / "x"), on_error="fail")
    assert status(result, "T") == (0, "Load failed: rows with more fields than declared")


def test_surplus_behind_an_empty_field_counts(spark, tmp_path):
    columns = [column("a"), column("b")]
    text = "1;2\n3;4;;LOST\n5;6;\n7;\"x;y\"\n8;9;\"\";\"z;z\"\n"
    text += '9;"a; ""b""";"";""\n10;"a; ""b""";"";more\n'
    folder = write_export(tmp_path / "x", [table("T", columns)], {"T.txt": text})
    result = import_export(spark, folder)
    assert status(result, "T") == (7, "Warning: 3 rows have more fields than declared, which were cut")
    whole = import_export(spark, folder, drop_bad_rows=True)
    note = "Warning: 3 rows with more fields than declared were dropped"
    assert status(whole, "T") == (4, note)
    assert sorted(r[0] for r in whole.tables["T"].collect()) == ["1", "5", "7", "9"]


def test_a_line_of_very_many_fields_is_one_long_row(spark, tmp_path):
    columns = [column("a"), column("b")]
    text = "1;2\n3;\"4;\"\"5\"" + ";x" * 50_000 + "\n5;6\n"
    folder = write_export(tmp_path / "x", [table("T", columns)], {"T.txt": text})
    result = import_export(spark, folder)
    assert status(result, "T") == (3, "Warning: 1 rows have more fields than declared, which were cut")
    assert sorted(map(tuple, result.tables["T"].collect())) == [("1", "2"), ("3", '4;"5'), ("5", "6")]


def test_line_breaks_in_quotes_are_read_by_default(spark, tmp_path):
    columns = [column("a"), column("b")]
    folder = write_export(tmp_path / "x", [table("T", columns)], {"T.txt": '1;"x\ny"\n2;z\n'})
    result = import_export(spark, folder)
    assert status(result, "T") == (2, "OK")
    assert sorted(map(tuple, result.tables["T"].collect())) == [("1", "xy"), ("2", "z")]
