import pytest
from pyspark.sql import functions as F

from helpers import rows
from pruefspur.sources import lines as ln


@pytest.mark.parametrize("head", [1, 3])
def test_heads_over_many_files_and_splits(spark, small_splits, tmp_path, head):
    for i in range(7):
        count = [0, 1, 2, 3, 50, 800, 3000][i]
        (tmp_path / f"f {i}.txt").write_text("".join(f"{i};{n}\n" for n in range(count)))
    frame = ln.text_lines(spark, [str(tmp_path)])
    assert frame.rdd.getNumPartitions() > 5
    kept = ln.drop_head(frame, head).select(F.split("value", ";").alias("p"))
    found = {(int(r["p"][0]), int(r["p"][1])) for r in kept.collect()}
    expected = {
        (i, n) for i, c in enumerate([0, 1, 2, 3, 50, 800, 3000]) for n in range(head, c)
    }
    assert found == expected and kept.count() == len(expected)


def test_profile(spark, small_splits, tmp_path):
    (tmp_path / "a+b ü.txt").write_bytes(
        ('h1\nh2;"x"\n\n' + "".join(f'{n};"\n' for n in range(2000))).encode()
    )
    (tmp_path / "l.txt").write_bytes(b"x\n" * 3000 + "ü\n".encode("latin-1"))
    found = {
        r["path"].rsplit("/", 1)[1]: r
        for r in ln.profile(ln.text_lines(spark, [str(tmp_path)]), 2).collect()
    }
    a, b = found["a+b ü.txt"], found["l.txt"]
    assert [bytes(h) for h in a["head"]] == [b"h1", b'h2;"x"']
    assert (a["lines"], a["utf8"], a["odd_quotes"], a["blank_lines"]) == (2003, True, 2000, 1)
    assert (b["lines"], b["utf8"], b["odd_quotes"], b["blank_lines"]) == (3001, False, 0, 0)


def test_fields(spark):
    text = ["a;b;c", "", "a", ";;", "a;b;c;d", 'x;"";"y""z"', ' a ; b', "a\\;b;c", "#a;b"]
    df = spark.createDataFrame([(t,) for t in text], "v string")
    got = rows(df.select(ln.split_fields(F.col("v"), 3).alias("f")).select("f.*"))
    assert got == [
        ("a", "b", "c", None), (None,) * 4, ("a", None, None, None), (None,) * 4,
        ("a", "b", "c", "d"), ("x", None, 'y"z', None), (" a ", " b", None, None),
        ("a\\", "b", "c", None), ("#a", "b", None, None),
    ]


def test_a_head_that_leaves_the_first_split_is_refused(spark, small_splits, tmp_path):
    (tmp_path / "f.txt").write_text(("x" * 5000 + "\n") * 4)
    frame = ln.text_lines(spark, [str(tmp_path)])
    assert ln.drop_head(frame, 1).count() == 3
    with pytest.raises(Exception, match="beyond its first split"):
        ln.drop_head(frame, 2).count()
    with pytest.raises(Exception, match="beyond its first split"):
        ln.profile(frame, 2, 2).collect()
    assert ln.profile(frame, 2, 1).head()["lines"] == 4
