"""The masks of type inference against the tests themselves, on values of many shapes."""

import itertools
import random

from pyspark.sql import functions as F

from pruefspur.operators import infer

SHAPES = [
    "", " ", "0", "007", "+5", "-12", "- 5", "1.5", "1,5", "1.234,56", "-.5", ",5", "1e5", "1E-3", "1d", "5f",
    "15.03.2024", "1.4.2024", "32.13.2024", "00.00.0000", "1.2.24", "2024-01-31", "2024/1/3", "2024-1/3",
    "2024-01-01 10:00", "2024-01-01T10:00:00.5", "10:00", "true", "T", "f", "False", "tr", "t1", "1t", "nan", "inf",
    "999999999999999999", "9999999999999999999", "-9223372036854775808", "99999999999999999999", "1 234", "٣", "1_000",
    "..", "--", "+-5", "5-", "1,2,3", "1.2.3.4", "e5", ".", ",", "-", "+", "abc", "ä", "0x1F", "1/2/2024", "12:30:45",
]
OUTER = ["", " ", "\t", " ", "\x00", "\x01", " ", "\n", "\x85"]


def values():
    rng = random.Random(4)
    found = [a + s + b for s, a, b in itertools.product(SHAPES, OUTER, OUTER)]
    found += ["".join(rng.choice("0123456789.,-+eE:/ tfT") for _ in range(rng.randint(1, 12))) for _ in range(4000)]
    return found


def test_masks_say_what_the_tests_say(spark):
    df = spark.createDataFrame([(v,) for v in values()], "v string").repartition(4)
    for tests in (infer.GERMAN_TESTS, infer.PLAIN_TESTS):
        body = F.trim("v", F.lit(infer._OUTER))
        shape = F.translate(body, "0123456789", "")
        want = F.lit(0)
        for i, test in enumerate(tests.values()):
            want = want + F.when(test(F.col("v")).isNotNull(), 1 << i).otherwise(0)
        present = F.trim("v", F.lit(infer.cv.SPACES)) != ""
        judged = df.where(present).select("v", infer.passed_tests(F.col("v"), body, shape, tests).alias("got"), want.alias("want"))
        assert judged.where("got <> want").collect() == []


def test_columns_are_judged_by_all_values(spark):
    rows = [("1", "1,5", "x", None, " "), ("2", "7", "1", None, ""), (None, "1.000,25", "2", None, None)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string")
    counts = infer.inference_counts(df, by=()).head()
    assert [counts[f"c{i}"][0] for i in range(5)] == [2, 3, 3, 0, 0]
    assert [infer.decide(counts[f"c{i}"], infer.GERMAN_TESTS) for i in range(5)] == ["integer", "german_number", None, None, None]
