"""Type inference over text columns: one aggregate for all columns and tests, one projection.

A column takes the first type that every present value (not NULL, not blank) converts to.  A
column without present values stays text.

Which types a value converts to is a mask of one bit per test, and a column's mask is the bitwise
AND of its values'.  What a value's characters are besides digits (its shape) rules most tests out, or
says that they hold, so that hardly any conversion is tried.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import convert as cv

# Tests in order of preference.  The German date stands before the German number, because without
# its dots 15.03.2024 would also read as a number.
GERMAN_TESTS: dict[str, Callable[[Column], Column]] = {
    "integer": lambda c: cv.to_integer(c, ""),
    "german_date": cv.to_date,
    "iso_date": cv.iso_date,
    "german_number": cv.german_double,
}
# What a reader that detects types itself would have settled before; applies to text formats.
PLAIN_TESTS: dict[str, Callable[[Column], Column]] = {
    "boolean": cv.plain_boolean,
    "integer": lambda c: cv.to_integer(c, ""),
    "plain_number": cv.plain_double,
    "german_date": cv.to_date,
    "iso_date": cv.iso_date,
    "timestamp": cv.iso_timestamp,
    "german_number": cv.german_double,
}


# What any test may trim: control characters and spaces.
_OUTER = "".join(map(chr, [*range(0x20), *range(0x7F, 0xA0)])) + cv.SPACES
#: Digits that surely fit a BIGINT.
_SAFE_DIGITS = 18


def _only(shape: Column, characters: str) -> Column:
    """Whether a shape has none but some characters."""
    return F.translate(shape, characters, "") == ""


# Per test: whether a value of this shape may pass.  A test without an entry is tried on every value.
_MAY_PASS: dict[str, Callable[[Column], Column]] = {
    "boolean": lambda shape: F.lower(shape).isin("t", "f", "true", "false"),
    "integer": lambda shape: shape.isin("", "+", "-"),
    "plain_number": lambda shape: _only(shape, "+-.eE"),
    # Its points are taken out before spaces are, so they may stand between.
    "german_number": lambda shape: _only(shape, "+-.," + _OUTER),
    "german_date": lambda shape: shape == "..",
    "iso_date": lambda shape: shape.isin("--", "//"),
    "timestamp": lambda shape: F.contains(shape, F.lit(":")),
}
# Tests that every run of a few digits passes.
_ALL_DIGITS = ("integer", "plain_number", "german_number")


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "char", "varchar")]


def _bare(value: Column) -> Column:
    """Whether a value begins and ends with a visible ASCII character, so that nothing is to be trimmed."""
    ends = [F.ascii(value), F.ascii(F.right(value, F.lit(1)))]
    return F.coalesce(ends[0].between(0x21, 0x7E) & ends[1].between(0x21, 0x7E), F.lit(False))


def passed_tests(
    value: Column, body: Column, shape: Column, tests: dict[str, Callable[[Column], Column]]
) -> Column:
    """A mask with bit i set where a value passes test i.  ``body`` is the value without what surrounds
    it, ``shape`` what is left of that without its digits."""
    mask = F.lit(0)
    digits = 0
    for i, (name, test) in enumerate(tests.items()):
        may = _MAY_PASS[name](shape) if name in _MAY_PASS else F.lit(True)
        mask = mask + F.when(may & test(value).isNotNull(), 1 << i).otherwise(0)
        digits += (1 << i) * (name in _ALL_DIGITS)
    # What the tests make of surrounding spaces differs, so bare digits only.
    few = (shape == "") & F.length(body).between(1, _SAFE_DIGITS) & (F.length(value) == F.length(body))
    return F.when(few, F.lit(digits)).otherwise(mask)


def inference_counts(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    tests: dict[str, Callable[[Column], Column]] | None = None,
    by: Sequence[str] = (),
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Per column an array of the present values and the mask of the tests all of them passed, named by
    column position (``c0``, ...), plus ``row_count`` and any extra aggregates."""
    columns = text_columns(df) if columns is None else columns
    tests = GERMAN_TESTS if tests is None else tests
    value = {i: F.col(f"`{name}`") for i, name in enumerate(columns)}
    # Each step stands in a projection of its own, so that it is evaluated once.
    df = df.select("*", *[_bare(c).alias(f"_f{i}") for i, c in value.items()])
    bodies = {i: F.when(F.col(f"_f{i}"), c).otherwise(F.trim(c, F.lit(_OUTER))) for i, c in value.items()}
    df = df.select("*", *[b.alias(f"_b{i}") for i, b in bodies.items()])
    df = df.select("*", *[F.translate(f"_b{i}", "0123456789", "").alias(f"_s{i}") for i in value])
    masks = []
    for i, c in value.items():
        present = F.col(f"_f{i}") | (c.isNotNull() & (cv.trim_spaces(c) != ""))
        mask = passed_tests(c, F.col(f"_b{i}"), F.col(f"_s{i}"), tests)
        masks.append(F.when(present, mask).alias(f"_m{i}"))
    df = df.select("*", *masks)
    found = [
        F.array(F.count(f"_m{i}"), F.coalesce(F.bit_and(f"_m{i}"), F.lit(0)).cast("bigint")).alias(f"c{i}")
        for i in value
    ]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"), *found, *extra)


def verdict(counts: Column, tests: dict) -> Column:
    """Name of the first test that all present values passed, as an expression."""
    found = F.when(counts[0] == 0, F.lit(None).cast("string"))
    for i, name in enumerate(tests):
        found = found.when(counts[1].bitwiseAND(1 << i) != 0, name)
    return found


def decide(counts: Sequence[int], tests: dict) -> str | None:
    """Name of the first test that all present values passed."""
    present, mask = counts
    if not present:
        return None
    return next((name for i, name in enumerate(tests) if mask >> i & 1), None)


def convert_columns(
    df: DataFrame, verdicts: dict[str, str | None], tests: dict[str, Callable[[Column], Column]]
) -> DataFrame:
    """One projection with every decided column converted."""
    chosen = []
    for name in df.columns:
        c = F.col(f"`{name}`")
        verdict = verdicts.get(name)
        chosen.append(tests[verdict](c).alias(name) if verdict else c)
    return df.select(*chosen)


def infer_types(
    df: DataFrame, tests: dict[str, Callable[[Column], Column]] | None = None
) -> DataFrame:
    """Convert the text columns of a frame to the types their values allow."""
    tests = GERMAN_TESTS if tests is None else tests
    columns = text_columns(df)
    if not columns:
        return df
    row = inference_counts(df, columns, tests).head()
    verdicts = {name: decide(row[f"c{i}"], tests) for i, name in enumerate(columns)}
    return convert_columns(df, verdicts, tests)


def clean_columns(df: DataFrame) -> DataFrame:
    """Clean every text column."""
    text = set(text_columns(df))
    return df.select(
        *[
            cv.clean_text(F.col(f"`{c}`")).alias(c) if c in text else F.col(f"`{c}`")
            for c in df.columns
        ]
    )
