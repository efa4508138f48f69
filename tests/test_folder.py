import datetime
import zipfile

import pytest

from helpers import rows
from pruefspur import import_folder, infer_types
from pruefspur.sources import lines as ln
from pruefspur.sources.folder import SEPARATORS, likeliest_separator

day = datetime.date
moment = datetime.datetime


def report(result):
    return {r["file_name"]: tuple(r)[0:1] + tuple(r)[2:] for r in result.report.collect()}


def test_csv_folder(spark, tmp_path):
    body = (
        "Kunden Nr;Betrag EUR;Datum;Name;Leer;Flag;Punkt;Wann\n"
        "1;1.234,56;15.03.2024; Größe ;;true;1.5;2024-01-01 10:00:00\n"
        "2;-0,5;1.4.2024;x\x07y;;false;2;2024-01-02 10:00:00\n"
    )
    (tmp_path / "Sales-Data.csv").write_text(body, encoding="utf-8")
    (tmp_path / "Western.txt").write_bytes(body.replace("x\x07y", "€").encode("windows-1252"))
    (tmp_path / "sales data.txt").write_text('a,b\n"x\ny",2\n')
    (tmp_path / "Empty.csv").write_text("")
    (tmp_path / "Header.csv").write_text("a;b\n")
    (tmp_path / ".hidden.csv").write_text("a\n1\n")
    (tmp_path / "other.tsv").write_text("a\tb\n1\t2024-01-01\n")
    (tmp_path / "sub.csv").mkdir()
    result = import_folder(spark, str(tmp_path))
    assert report(result) == {
        "Empty.csv": ("empty", 0, 0, "Load failed: file has no header line"),
        "Header.csv": ("header", 0, 2, "OK"),
        "Sales-Data.csv": ("sales_data", 2, 8, "OK"),
        "Western.txt": ("western", 2, 8, "OK"),
        "sales data.txt": ("sales_data_2", 1, 2, "OK (several files are called 'sales_data')"),
    }
    sales = result.tables["sales_data"]
    assert sales.dtypes == [
        ("kunden_nr", "bigint"), ("betrag_eur", "double"), ("datum", "date"), ("name", "string"),
        ("leer", "string"), ("flag", "boolean"), ("punkt", "double"), ("wann", "timestamp_ntz"),
    ]
    assert rows(sales, "kunden_nr") == [
        (1, 1234.56, day(2024, 3, 15), "Größe", None, True, 1.5, moment(2024, 1, 1, 10)),
        (2, -0.5, day(2024, 4, 1), "xy", None, False, 2.0, moment(2024, 1, 2, 10)),
    ]
    assert [r["name"] for r in result.tables["western"].collect()] == ["Größe", "€"]
    assert rows(result.tables["sales_data_2"]) == [("xy", 2)]
    assert rows(import_folder(spark, str(tmp_path), "tsv").tables["other"]) == [
        (1, day(2024, 1, 1))
    ]


def test_files_of_one_shape_are_typed_each_by_itself(spark, small_splits, tmp_path):
    (tmp_path / "a.csv").write_text("x;y\n" + "".join(f"{i};{i},5\n" for i in range(2000)))
    (tmp_path / "b.csv").write_text("x;y\n" + "".join(f"k{i};01.02.2024\n" for i in range(2000)))
    tables = import_folder(spark, str(tmp_path)).tables
    assert tables["a"].dtypes == [("x", "bigint"), ("y", "double")]
    assert tables["b"].dtypes == [("x", "string"), ("y", "date")]
    assert tables["a"].agg({"x": "sum"}).head()[0] == sum(range(2000))
    assert tables["b"].count() == 2000


def test_options(spark, tmp_path):
    (tmp_path / "o.csv").write_text("Stand\n\nA|B b\n1.5|true\n2|x\n")
    table = import_folder(spark, str(tmp_path), "csv", delimiter="|", skip=2).tables["o"]
    assert table.dtypes == [("a", "double"), ("b_b", "string")]
    assert rows(table, "a") == [(1.5, "true"), (2.0, "x")]
    text = import_folder(spark, str(tmp_path), delimiter="|", skip=2, all_varchar=True).tables["o"]
    # Without detection a point groups digits.
    assert rows(text, "a") == [(2.0, "x"), (15.0, "true")]
    bare = import_folder(spark, str(tmp_path), delimiter="|", skip=3, header=False).tables["o"]
    assert bare.columns == ["column0", "column1"] and bare.count() == 2


def test_header_names(spark, tmp_path):
    (tmp_path / "h.csv").write_text('Nr;;Nr;"A;b"\n1;2;3;4\n')
    assert import_folder(spark, str(tmp_path)).tables["h"].columns == ["nr", "column1", "nr_2", "a_b"]


def test_json(spark, tmp_path):
    (tmp_path / "lines.json").write_text(
        '{"ZahlX": 1, "Anlage": "15.03.2024", "t": "a\\u0007b"}\n{"ZahlX": 2, "Anlage": "1.4.2024"}\n'
    )
    (tmp_path / "array.json").write_text('[{"a": 1,\n"b": {"c": 2}}, {"a": 2}]')
    (tmp_path / "l.jsonl").write_text('{"a": "2024-01-01 10:00:00"}\n')
    tables = import_folder(spark, str(tmp_path), "json").tables
    assert sorted(tables) == ["array", "l", "lines"]
    assert tables["lines"].columns == ["zahl_x", "anlage", "t"]
    assert rows(tables["lines"], "zahl_x") == [(1, day(2024, 3, 15), "ab"), (2, day(2024, 4, 1), None)]
    assert [r["a"] for r in tables["array"].collect()] == [1, 2]
    assert rows(tables["l"]) == [(moment(2024, 1, 1, 10),)]
    assert list(import_folder(spark, str(tmp_path), "jsonl").tables) == ["l"]


def test_parquet(spark, tmp_path):
    df = spark.createDataFrame([("1,5", " 007 ", "x\x01 ", 3)], "GermanNum string, `Int Col` string, t string, n int")
    df.coalesce(1).write.parquet(str(tmp_path / "w"))
    part = next((tmp_path / "w").glob("*.parquet"))
    part.rename(tmp_path / "Daten 1.parquet")
    table = import_folder(spark, str(tmp_path), "PARQUET").tables["daten_1"]
    assert table.dtypes == [("german_num", "double"), ("int_col", "bigint"), ("t", "string"), ("n", "int")]
    assert rows(table) == [(1.5, 7, "x", 3)]


def workbook(path, sheet, shared=(), formats=(0,)):
    with zipfile.ZipFile(path, "w") as book:
        book.writestr(
            "xl/workbook.xml",
            '<workbook xmlns:r="r"><sheets><sheet name="S" r:id="rId7"/><sheet name="T" r:id="x"/>'
            "</sheets></workbook>",
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships><Relationship Id="rId7" Target="worksheets/a.xml"/></Relationships>',
        )
        items = "".join(f"<si><r><t>{t[:1]}</t></r><r><t>{t[1:]}</t></r></si>" for t in shared)
        book.writestr("xl/sharedStrings.xml", f"<sst>{items}</sst>")
        styles = "".join(f'<xf numFmtId="{f}"/>' for f in formats)
        book.writestr("xl/styles.xml", f"<styleSheet><cellXfs>{styles}</cellXfs></styleSheet>")
        book.writestr("xl/worksheets/a.xml", f"<worksheet><sheetData>{sheet}</sheetData></worksheet>")


def test_workbooks(spark, tmp_path):
    sheet = (
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c>'
        '<c r="C1" t="inlineStr"><is><t>Datum</t></is></c><c r="D1" t="str"><v>Misch</v></c>'
        '<c r="E1" t="str"><v>Wahr</v></c><c r="F1" t="str"><v>Text Zahl</v></c></row>'
        '<row r="2"><c r="A2"><v>5</v></c><c r="B2"><v>1.5</v></c><c r="C2" s="1"><v>45366</v></c>'
        '<c r="D2"><v>7</v></c><c r="E2" t="b"><v>1</v></c><c r="F2" t="str"><v>1.000,5</v></c></row>'
        '<row r="4"><c r="A4"><v>6</v></c><c r="C4" s="1"><v>45367</v></c>'
        '<c r="D4" t="s"><v>2</v></c><c r="E4" t="b"><v>0</v></c></row>'
    )
    workbook(tmp_path / "Buch 1.xlsx", sheet, ["Konto Nr", "Betrag", "Summen"], (0, 14))
    (tmp_path / "alt.xls").write_bytes(b"binary")
    result = import_folder(spark, str(tmp_path), "excel")
    assert report(result)["Buch 1.xlsx"] == ("buch_1", 2, 6, "OK")
    assert report(result)["alt.xls"][3].startswith("Load failed")
    assert rows(result.tables["buch_1"], "konto_nr") == [
        (5.0, 1.5, day(2024, 3, 15), "7", True, 1000.5),
        (6.0, None, day(2024, 3, 16), "Summen", False, None),
    ]


def test_moments_in_workbooks(spark, tmp_path):
    sheet = (
        '<row><c t="str"><v>t</v></c></row><row><c s="0"><v>45366.5</v></c></row>'
        '<row><c s="0"><v>45367</v></c></row>'
    )
    workbook(tmp_path / "m.xlsx", sheet, formats=(22,))
    table = import_folder(spark, str(tmp_path), "xlsx").tables["m"]
    assert rows(table, "t") == [(moment(2024, 3, 15, 12),), (moment(2024, 3, 16),)]


def test_other_types_and_nothing_found(spark, tmp_path):
    (tmp_path / "odd.dat").write_text("a;b\n1;2\n")
    assert rows(import_folder(spark, str(tmp_path), "dat").tables["odd"]) == [(1, 2)]
    row = import_folder(spark, str(tmp_path), "csv").report.head()
    assert tuple(row) == ("(no files)", "", 0, 0, "No matching files found for type: csv")
    assert import_folder(spark, "a/../b").report.head()["table_name"] == "(security)"


@pytest.mark.parametrize(
    "values, kind",
    [
        (["1", " 2 ", None, ""], "bigint"),
        (["007", "+5"], "bigint"),
        (["1.234", "2"], "double"),
        (["1,5", "2"], "double"),
        (["15.03.2024", "1.1.2024", ""], "date"),
        (["2024-03-15", "2024/1/5"], "date"),
        (["2024-03-15", "15.03.2024"], "string"),
        (["1e3"], "string"),
        (["12.7x"], "string"),
        (["nan"], "string"),
        (["inf", "1"], "string"),
        (["", None, "  "], "string"),
        (["99999999999999999999"], "double"),
    ],
)
def test_inference(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert infer_types(df).dtypes == [("v", kind)]


def test_separators(spark, tmp_path):
    texts = {
        ";": "a;b,c;d\n1;2,5;3\n",
        ",": "a,b\n1,2\n",
        "\t": "a\tb\n1\t2\n",
        "|": 'a|b,c\n' + "1,1|2;2;2,3\n" * 3 + '";;;"|",,,"\n' * 9,
        "": "a\n1\n",
    }
    for i, text in enumerate(texts.values()):
        (tmp_path / f"{i}.csv").write_text(text)
    found = ln.profiles(spark, [str(tmp_path)], 1, 1, seps=SEPARATORS).collect()
    got = {r["path"].rsplit("/", 1)[1]: likeliest_separator(r["head"][0], [tuple(w) for w in r["widths"]]) for r in found}
    assert got == {f"{i}.csv": sep or "," for i, sep in enumerate(texts)}


def test_first_lines_may_mislead(spark, small_splits, tmp_path):
    head = "Nr;Wert;Ort, Land\n" + "1;2;A, B;zu viel\n" * 25
    (tmp_path / "m.csv").write_text(head + "".join(f"{i};3,5;Bonn\n" for i in range(2000)))
    result = import_folder(spark, str(tmp_path))
    assert report(result)["m.csv"] == (
        "m", 2025, 3, "Warning: 25 rows have more fields than the header, which were cut"
    )
    assert result.tables["m"].dtypes == [("nr", "bigint"), ("wert", "double"), ("ort_land", "string")]
    kept = import_folder(spark, str(tmp_path), drop_bad_rows=True)
    assert report(kept)["m.csv"][1:] == (
        2000, 3, "Warning: 25 rows with more fields than the header were dropped"
    )
    assert kept.tables["m"].count() == 2000


def test_overwide_lines_are_cut(spark, tmp_path):
    (tmp_path / "w.csv").write_text("a;b\n1;2\n" + ";".join(["7"] * 30_000) + "\n3;4\n")
    result = import_folder(spark, str(tmp_path))
    assert rows(result.tables["w"], "a") == [(1, 2), (3, 4), (7, 7)]
    assert "1 rows have more fields" in report(result)["w.csv"][3]


def test_unknown_options_are_refused(spark, tmp_path):
    (tmp_path / "o.csv").write_text("a;b\n1;2\n")
    refused = import_folder(spark, str(tmp_path), skp=1).report.head()
    assert refused["table_name"] == "(options)" and "skp" in refused["status"]
    refused = import_folder(spark, str(tmp_path), encoding="shift_jis").report.head()
    assert refused["table_name"] == "(options)" and "single-byte" in refused["status"]


@pytest.mark.parametrize("charset", ["utf-16", "utf-16-le", "utf-16-be", "cp850", "windows-1250"])
def test_charsets_of_files(spark, small_splits, tmp_path, charset):
    text = "Nr;Name\r\n" + "".join(f"{i};Müller Ñandú Größe\r\n" if charset == "cp850" else f"{i};Łódź żółw Größe\r\n" for i in range(3000))
    (tmp_path / "c.csv").write_bytes(text.encode(charset))
    (tmp_path / "u.csv").write_text("Nr;Name\n1;Größe\n", encoding="utf-8")
    result = import_folder(spark, str(tmp_path))
    known = {r["table_name"]: r["charset"] for r in result.charsets.collect()}
    assert known == {"c": "utf-16-le" if charset == "utf-16" else charset, "u": "utf-8"}
    want = "Müller Ñandú Größe" if charset == "cp850" else "Łódź żółw Größe"
    assert sorted(rows(result.tables["c"])) == [(i, want) for i in range(3000)]
    assert rows(result.tables["u"]) == [(1, "Größe")]


@pytest.mark.parametrize("charset", ["utf-16-le", "utf-16-be"])
def test_lines_of_wide_charsets(spark, small_splits, tmp_path, charset):
    """Characters whose halves look like a line end do not end a line."""
    texts = [f"{i} ਓĀ ਁ─ਂ\u0100" if i % 7 == 3 else f"{i} ü" for i in range(4000)]
    (tmp_path / "w.txt").write_bytes(("\ufeff" + "\n".join(texts)).encode(charset))
    lines = ln.text_lines(spark, [str(tmp_path)], charset)
    assert lines.rdd.getNumPartitions() > 5
    assert sorted(r["value"] for r in lines.collect()) == sorted(texts)


def test_small_splits_of_wide_charsets_share_tasks(spark, small_splits, tmp_path):
    texts = [f"{i} \u0a13\u0100 \u0a01\u2500" for i in range(20000)]
    (tmp_path / "w.txt").write_bytes("\n".join(texts).encode("utf-16-le"))
    lines = ln.text_lines(spark, [str(tmp_path)], "utf-16-le")
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert lines.select("block").distinct().count() > 50 > lines.rdd.getNumPartitions()
    assert plan.count("FileScan text") == 1
    assert sorted(r["value"] for r in lines.collect()) == sorted(texts)


@pytest.mark.parametrize("size", [4096, 1 << 20])
def test_half_a_character_at_the_end(spark, small_splits, tmp_path, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    texts = [f"{i} ü" for i in range(3000)]
    (tmp_path / "w.txt").write_bytes("\n".join(texts).encode("utf-16-le") + b"x")
    lines = ln.text_lines(spark, [str(tmp_path)], "utf-16-le")
    assert sorted(r["value"] for r in lines.collect()) == sorted(texts)


def test_headers_of_workbooks_are_one_job(spark, tmp_path):
    """However many workbooks; one that breaks off is reported and the others are read."""
    for i in range(7):
        rows_ = f'<row><c t="inlineStr"><is><t>Nr</t></is></c></row><row><c><v>{i}</v></c></row>'
        end = "" if i == 6 else "</sheetData></worksheet>"
        with zipfile.ZipFile(tmp_path / f"b{i}.xlsx", "w") as book:
            book.writestr("xl/worksheets/sheet1.xml", f"<worksheet><sheetData>{rows_}{end}")
    spark.sparkContext.setJobGroup("workbooks", "")
    try:
        result = import_folder(spark, str(tmp_path), "xlsx")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    told = {r["file_name"]: r["status"] for r in result.report.collect()}
    assert told.pop("b6.xlsx").startswith("Load failed: ExpatError") and set(told.values()) == {"OK"}
    assert sorted(r["nr"] for r in result.combined.collect()) == list(range(6))
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("workbooks")) < 7


def test_combined(spark, tmp_path):
    (tmp_path / "a 1.csv").write_text("x;y\n1;2,5\n")
    (tmp_path / "b.csv").write_text("x;y\n2;3,5\n")
    (tmp_path / "c.csv").write_text("y;z\nn/a;7\n")
    combined = import_folder(spark, str(tmp_path)).combined
    assert {(r["_file_name"], r["x"], str(r["y"]), r["z"]) for r in combined.collect()} == {
        ("a 1.csv", 1, "2.5", None), ("b.csv", 2, "3.5", None), ("c.csv", None, "n/a", 7),
    }
