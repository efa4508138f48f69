import pytest
from pyspark.sql import functions as F

from pruefspur.functions import names as nm


def one(spark, value, rule):
    return spark.createDataFrame([(value,)], "v string").select(rule(F.col("v"))).head()[0]


@pytest.mark.parametrize(
    "name, expected",
    [
        ("EUCountryRegionCode", "eu_country_region_code"),
        ("EU-Laender-/Regionscode", "eu_laender_regionscode"),
        ("ErstellDatum", "erstell_datum"),
        ("Straße Nr.", "strasse_nr"),
        ("ÄnderungÜber", "anderung_uber"),
        ("Größe", "grosse"),
        ("MwSt%", "mw_st"),
        ("VAT2Code", "vat2code"),
        ("__x__", "x"),
        ("café", "caf"),
        ("ABC", "abc"),
        ("ABc", "a_bc"),
        ("KKg", "k_g"),
        ("", ""),
    ],
)
def test_snake_case(spark, name, expected):
    assert one(spark, name, nm.snake_case) == expected


@pytest.mark.parametrize(
    "name, expected",
    [
        ("Umsatz (ohne Soll/Haben-Kz)", "umsatz_ohne_soll_haben_kz"),
        ("Basis-Umsatz", "basis_umsatz"),
        ("Beleginfo - Art 1", "beleginfo_art_1"),
        ("Prüfung", "pr_fung"),
    ],
)
def test_batch_columns(spark, name, expected):
    assert one(spark, name, nm.batch_column) == expected


def test_files_and_archives(spark):
    assert one(spark, "Sales-Data.2024.csv", nm.table_of_file) == "sales_data_2024"
    assert one(spark, "Export 2024.zip", nm.archive_prefix) == "Export_2024"
    assert one(spark, "__a--b .ZIP", nm.archive_prefix) == "a_b"


def test_numbering(spark):
    assert nm.normalised(spark, ["x", "X", "x"]) == ["x", "x_2", "x_3"]
    # A number already in use as a name is passed over.
    assert nm.normalised(spark, ["x", "x", "x 2", "x"]) == ["x", "x_3", "x_2", "x_4"]
    assert nm.normalised(spark, []) == []


def test_numbering_against_brute_force(spark):
    import random

    random.seed(7)
    for _ in range(20):
        names = [random.choice(["a", "b", "a_2", "a_3", "b_2"]) for _ in range(12)]
        got = nm.normalised(spark, names)
        assert len(set(got)) == len(got)
        firsts = {n: names.index(n) for n in names}
        for name, at in firsts.items():
            assert got[at] == name
        assert all(g == n or g.startswith(n + "_") for g, n in zip(got, names))
