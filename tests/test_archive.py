import decimal
import zipfile

import pytest
from pyspark.sql import functions as F

from helpers import (
    BUCHUNGEN,
    BUCHUNGEN_TEXT,
    KUNDEN,
    KUNDEN_TEXT,
    column,
    index,
    rows,
    table,
)
from pruefspur import import_archives
from pruefspur.sources import archive

SAMPLE = index(table("Kunden", KUNDEN), table("Buchungen", BUCHUNGEN))


def pack(path, entries):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        for name, content in entries.items():
            book.writestr(name, content)


def sample(prefix="", charset="utf-8"):
    return {
        f"{prefix}Kunden.txt": KUNDEN_TEXT.encode(charset),
        f"{prefix}index.xml": SAMPLE,
        f"{prefix}Buchungen.txt": BUCHUNGEN_TEXT,
    }


def test_batch(spark, tmp_path):
    pack(tmp_path / "Export 2024.zip", sample())
    pack(tmp_path / "Export 2023.ZIP", sample("a/b/", "windows-1252"))
    pack(tmp_path / "Export-2024.zip", sample())
    pack(tmp_path / "slip.zip", {**sample(), "../x": "1"})
    pack(tmp_path / "dots.zip", {**sample(), "a..b.txt": "1"})
    pack(tmp_path / "none.zip", {"a.txt": "1"})
    pack(tmp_path / "broken.zip", {"index.xml": "<DataSet><Media>"})
    pack(tmp_path / "gone.zip", {"index.xml": SAMPLE, "Kunden.txt": KUNDEN_TEXT})
    (tmp_path / "corrupt.zip").write_bytes(b"no zip")
    (tmp_path / "other.txt").write_text("x")
    result = import_archives(spark, str(tmp_path))
    report = {(r["source_zip"], r["table_name"]): (r["row_count"], r["status"])
              for r in result.report.collect()}
    ok = (3, "OK")
    assert report == {
        ("Export 2024.zip", "Export_2024_Kunden"): ok,
        ("Export 2024.zip", "Export_2024_Buchungen"): ok,
        ("Export 2023.ZIP", "Export_2023_Kunden"): ok,
        ("Export 2023.ZIP", "Export_2023_Buchungen"): ok,
        ("Export-2024.zip", "Export_2024_Kunden_2"): ok,
        ("Export-2024.zip", "Export_2024_Buchungen_2"): ok,
        ("dots.zip", "dots_Kunden"): ok,
        ("dots.zip", "dots_Buchungen"): ok,
        ("gone.zip", "gone_Kunden"): ok,
        ("gone.zip", "gone_Buchungen"): (0, "Load failed: no data file 'Buchungen.txt'"),
        ("slip.zip", "(extract)"): (
            0, "Extraction failed: Zip Slip detected: path contains '..': ../x"),
        ("corrupt.zip", "(extract)"): (0, "Extraction failed: File is not a zip file"),
        ("none.zip", "none_(schema)"): (0, "Parse error: no index.xml in archive"),
        ("broken.zip", "broken_(schema)"): (0, "Parse error: not well-formed XML"),
    }
    assert len(result.tables) == 9
    old = result.tables["Export_2023_Kunden"]
    assert dict(old.dtypes)["saldo"] == "decimal(20,2)"
    assert [r["name"] for r in old.orderBy("nr").collect()] == [
        "Nördlich Werft AG", "Ohm & Söhne OHG", "Straßenbau Jäger",
    ]
    combined = result.combined("Kunden")
    assert combined.count() == 15
    assert combined.select("_source_zip").distinct().count() == 5
    assert combined.agg(F.sum("saldo")).head()[0] == decimal.Decimal("9826.91") * 5
    with pytest.raises(KeyError):
        result.combined("Other")


@pytest.mark.parametrize("chunk", [7, 1000, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("large", [False, True])
def test_streams_of_any_shape(spark, tmp_path, monkeypatch, chunk, end, large):
    monkeypatch.setattr(archive, "CHUNK", chunk)
    if large:
        monkeypatch.setattr(archive, "LARGE_ENTRY", 10)
    columns = [column("Nr", "Numeric", key=True), column("T")]
    lines = [f"{i};Größe €{'x' * (i % 40)}" for i in range(300)]
    for name, charset in (("w", "windows-1252"), ("u", "utf-8"), ("s", "utf-8-sig")):
        text = end.join(["Kopf;1", "Kopf;2", *lines[:100], "", *lines[100:]])
        pack(tmp_path / f"{name}.zip", {
            "index.xml": index(table("T", columns, first=3)), "T.txt": text.encode(charset),
        })
    result = import_archives(spark, str(tmp_path))
    assert sorted(r[:3] for r in rows(result.report)) == [
        (f"{n}_T", 300, "OK") for n in "suw"
    ]
    for name in "suw":
        found = [";".join(map(str, r)) for r in rows(result.tables[f"{name}_T"], "nr")]
        assert found == lines


def test_checks(spark, tmp_path):
    columns = [column("Nr", "Numeric", key=True), column("W", "Numeric", 2), column("D", "Date")]
    xml = index(table("T", columns))
    pack(tmp_path / "a.zip", {"index.xml": xml, "T.txt": "1;1,0;x\n1;2,0;\n;x;01.01.2024\n"})
    pack(tmp_path / "b.zip", {"index.xml": xml, "T.txt": "1;1,0;\n2;2,0;\n"})
    pack(tmp_path / "c.zip", {"index.xml": xml, "T.txt": ""})
    pack(tmp_path / "d.zip", {"index.xml": xml, "T.txt": "1|2|3\n"})
    result = import_archives(spark, str(tmp_path))
    found = {r["table_name"]: (r["row_count"], r["status"]) for r in result.report.collect()}
    assert found["a_T"] == (
        3,
        "Warning: values that do not convert became NULL (w: 1); "
        "primary key: 1 rows with NULL, 1 repeated rows",
    )
    assert found["b_T"] == (2, "OK") and found["c_T"] == (0, "Empty")
    assert "delimiter may be wrong" in found["d_T"][1]
    assert sorted(rows(result.rejects)) == [("a_T", "d", 1), ("a_T", "w", 1), ("d_T", "nr", 1)]
    strict = import_archives(spark, str(tmp_path), on_error="fail")
    kept = {r["table_name"]: r["status"] for r in strict.report.collect()}
    assert kept["a_T"].startswith("Load failed") and kept["b_T"] == "OK"
    assert list(strict.tables) == ["b_T"]


def test_nothing_to_read(spark, tmp_path):
    assert import_archives(spark, str(tmp_path)).report.count() == 0
    assert import_archives(spark, str(tmp_path / "no")).report.head()["table_name"] == "(listing)"
    assert import_archives(spark, "x/../y").report.head()["table_name"] == "(security)"
