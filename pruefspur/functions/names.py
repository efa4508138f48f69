"""Name normalisation as Column expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_FOLD_FROM = string.ascii_uppercase + "ÄÖÜäöü"
_FOLD_TO = string.ascii_lowercase + "aouaou"
# A word ends before a capital, and an acronym before its last one (EUCountry -> eu_country).
_WORD_END = "([a-zäöüß])(?=[A-ZÄÖÜ])|([A-ZÄÖÜ])(?=[A-Z][a-z])"


def _underscored(c: Column, drop: str) -> Column:
    return F.trim(F.regexp_replace(c, drop, "_"), F.lit("_"))


def snake_case(c: Column) -> Column:
    """``EUCountryRegionCode`` -> ``eu_country_region_code``, ``Straße Nr.`` -> ``strasse_nr``."""
    words = F.regexp_replace(c, _WORD_END, "$1$2_")
    folded = F.replace(F.translate(words, _FOLD_FROM, _FOLD_TO), F.lit("ß"), F.lit("ss"))
    return _underscored(folded, "[^a-z0-9]+")


def batch_column(c: Column) -> Column:
    """Column name of a booking batch: lower case, every other run of characters is one ``_``."""
    lower = F.translate(c, string.ascii_uppercase, string.ascii_lowercase)
    return _underscored(lower, "[^a-z0-9]+")


def file_stem(c: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(c, r"\.[^.]*$", "")


def table_of_file(c: Column) -> Column:
    return snake_case(file_stem(c))


def archive_prefix(c: Column) -> Column:
    """Table prefix from an archive name: ``Export 2024.zip`` -> ``Export_2024``."""
    return _underscored(F.regexp_replace(c, r"(?i)\.zip$", ""), "[^A-Za-z0-9]+")


def _given(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also where ``use`` builds a lambda on it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def dedupe_names(names: Column) -> Column:
    """Number repeated names of an array in order: x, x, x -> x, x_2, x_3.

    A number whose result is itself a name of the array is passed over, so the outcome is free
    of duplicates.  Works within one row; no shuffle.  The names are sorted once, and each run of
    equal ones is numbered by itself.
    """

    def spell(run: Column, distinct: Column) -> Column:
        name = F.get(run, F.lit(0))["name"]
        taken = F.size(F.filter(distinct, lambda n: F.startswith(n, F.concat(name, F.lit("_")))))
        numbers = F.sequence(F.lit(2), F.size(run) + taken + 1)
        numbered = F.transform(numbers, lambda k: F.concat(name, F.lit("_"), k.cast("string")))
        free = F.when(F.size(run) > 1, F.array_except(numbered, distinct)).otherwise(F.array(name))
        return _given(
            free,
            lambda ready: F.transform(
                run,
                lambda x, k: F.struct(
                    x["pos"].alias("pos"),
                    F.when(k == 0, x["name"]).otherwise(F.get(ready, k - 1)).alias("name"),
                ),
            ),
        )

    def number(placed: Column) -> Column:
        distinct = F.array_distinct(F.transform(placed, lambda x: x["name"]))
        begins = F.filter(
            F.transform(
                placed,
                lambda x, k: F.when(
                    (k == 0) | ~F.get(placed, k - 1)["name"].eqNullSafe(x["name"]), k
                ),
            ),
            lambda k: k.isNotNull(),
        )

        def runs(distinct: Column, begins: Column) -> Column:
            def one(start: Column, i: Column) -> Column:
                stop = F.coalesce(F.get(begins, i + 1), F.size(placed))
                return _given(
                    F.slice(placed, start + 1, stop - start), lambda run: spell(run, distinct)
                )

            spelled = F.flatten(F.transform(begins, one))
            return F.transform(F.array_sort(spelled), lambda x: x["name"])

        return _given(distinct, lambda d: _given(begins, lambda b: runs(d, b)))

    placed = F.array_sort(
        F.transform(names, lambda n, i: F.struct(n.alias("name"), i.alias("pos")))
    )
    unique = F.size(F.array_distinct(names)) == F.size(names)
    return F.when(unique, names).otherwise(_given(placed, number))


def normalised(spark: SparkSession, names: list[str], rule=snake_case) -> list[str]:
    """Normalise and number the column names of one schema (driver metadata, no job)."""
    if not names:
        return []
    one = spark.createDataFrame([(list(names),)], "names array<string>")
    return one.select(dedupe_names(F.transform("names", rule)).alias("n")).head()[0]
