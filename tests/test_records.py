import csv
import io
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import column, rows, status, table, write_export
from pruefspur import import_export, import_folder
from pruefspur.sources import lines as ln
from pruefspur.sources.records import _line_states, ends_inside, records, split_starts


@pytest.mark.parametrize(
    "line, inside, expected",
    [
        (b"a;b", False, False), (b'"a;b', False, True), (b'"a";b', False, False),
        (b'a;"b', False, True), (b'5" x;b', False, False), (b'5" x;"b', False, True),
        (b'a""', True, True), (b'a"', True, False), (b'a";"b', True, True), (b"", True, True),
        (b"", False, False), (b'"', False, True), (b'"', True, False), (b'""', False, False),
        (b'"""', False, True), (b'x"y;"', True, True), (b'a;', False, False),
    ],
)
def test_states(line, inside, expected):
    assert ends_inside(line, inside, b";") is expected


def joined(spark, folder):
    frame = ln.text_lines(spark, [folder])
    found = records(frame, split_starts(frame, ";"), ";")
    return frame.rdd.getNumPartitions(), found.select(F.col("value")).collect()


@pytest.mark.parametrize("seed", range(4))
def test_against_one_pass_reading(spark, small_splits, tmp_path, seed):
    random.seed(seed)
    expected = []
    for f in range(3):
        text = io.StringIO()
        writer = csv.writer(text, delimiter=";", lineterminator="\n")
        for n in range(600):
            # Long records span several splits; stretches without quotes lie between.
            breaks = random.choice([0, 0, 0, 1, 2, 5, 30 if n % 97 == 0 else 0, 400 if n == 300 else 0])
            words = [random.choice(["x", 'q"q', "a;b", "", "größe"]) * random.randint(0, 20)
                     for _ in range(breaks + 1)]
            cells = [f, n, "\n".join(words), random.choice(["", "end", 'e"'])]
            writer.writerow(cells)
            expected.append(tuple(str(c) for c in cells))
        (tmp_path / f"f{f}.txt").write_text(text.getvalue(), encoding="utf-8")
    parts, found = joined(spark, str(tmp_path))
    assert parts > 10
    got = [tuple(next(csv.reader(io.StringIO(r["value"], newline=""), delimiter=";"))) for r in found]
    assert sorted(got) == sorted(expected)


def test_crossing_records_are_kept_and_not_scanned_again(spark, small_splits, tmp_path):
    (tmp_path / "f.txt").write_text('1;"a\nb"\n' * 2000)
    frame = ln.text_lines(spark, [str(tmp_path)])
    starts = split_starts(frame, ";")
    found = records(frame, starts, ";")
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan text") == 1
    assert [r["value"] for r in found.collect()] == ['1;"a\nb"'] * 2000
    assert records(frame, starts, ";").count() == 2000


@pytest.mark.parametrize("sep", [b";", b"\t", b"]", b"\xa7", b"::"])
def test_states_of_many_lines(sep):
    random.seed(5)
    parts = [b'"', b'"', sep, b"a", b"\xff", b"\r", b"\n", "ü".encode()]
    lines = [b"".join(random.choices(parts, k=random.randint(0, 9))) for _ in range(3000)]
    outside, inside = _line_states(pa.array(lines, pa.binary()), sep)
    assert outside.tolist() == [ends_inside(line, False, sep) for line in lines]
    assert inside.tolist() == [ends_inside(line, True, sep) for line in lines]


def test_a_quote_left_open_does_not_swallow_the_file(spark, small_splits, tmp_path):
    text = "".join(f"{i};a\n" for i in range(1000)) + '5;"open\n' + "".join(
        f"{i};b\n" for i in range(1000)
    )
    (tmp_path / "f.txt").write_text(text)
    _, found = joined(spark, str(tmp_path))
    assert sorted(r["value"] for r in found) == sorted(text.splitlines())


def test_import_over_splits(spark, small_splits, tmp_path):
    text = "".join(f'{i};"Größe {i}\r\n€ ""{"x" * (i % 60)}"\r\n' for i in range(1000))
    folder = write_export(
        tmp_path / "e",
        [table("T", [column("Nr", "Numeric", key=True), column("Text")], first=2)],
        {"T.txt": ('0;"head"\r\n' + text).encode("windows-1252")},
    )
    result = import_export(spark, folder, multiline=True)
    assert status(result, "T") == (1000, "OK")
    assert result.tables["T"].rdd.getNumPartitions() > 5
    assert rows(result.tables["T"], "nr") == [
        (i, f'Größe {i}€ "{"x" * (i % 60)}') for i in range(1000)
    ]


def test_folder_over_splits(spark, small_splits, tmp_path):
    body = "".join(f'{i};"a\nb {i}";{i},5\n' for i in range(1000))
    (tmp_path / "a.csv").write_text("Nr;Text;Wert\n" + body)
    (tmp_path / "b.csv").write_text("Nr;Text;Wert\n1;2;3\n")
    data = import_folder(spark, str(tmp_path)).tables["a"]
    assert data.dtypes == [("nr", "bigint"), ("text", "string"), ("wert", "double")]
    assert rows(data, "nr") == [(i, f"ab {i}", i + 0.5) for i in range(1000)]


def test_other_splits_than_at_the_check_are_noticed(spark, small_splits, tmp_path):
    (tmp_path / "f.txt").write_text('1;"a\nb"\n' * 2000)
    frame = ln.text_lines(spark, [str(tmp_path)])
    starts = split_starts(frame, ";")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    with pytest.raises(Exception, match="split differently"):
        records(ln.text_lines(spark, [str(tmp_path)]), starts, ";").count()
