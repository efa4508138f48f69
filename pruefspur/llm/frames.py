"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words as runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> str:
    """A column's name as it is written in an expression, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row.  The optimizer copies a projected expression
    into every later use, also into the body of a lambda; it does not copy one through a
    generator, so each value passes through a generator of one element."""
    for name, value in columns.items():
        df = df.select("*", F.explode(F.array(value)).alias(name))
    return df


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """The input row as one struct ``_in`` beside the named columns, so that an input column never
    clashes with one of the operator."""
    return df.select(
        (F.struct("*") if df.columns else F.struct()).alias("_in"),
        *[c.alias(n) for n, c in columns.items()],
    )


def constant_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few fixed rows as a frame that lives in the plan."""
    names = [f.strip().split(" ") for f in schema.split(",")]
    structs = [
        F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(r, names, strict=True)])
        for r in rows
    ]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*structs)))


def sha256_hex(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)
