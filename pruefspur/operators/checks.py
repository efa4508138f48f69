"""Validation as aggregates: one pass per table for everything that needs no shuffle."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DELIMITER_WARNING = (
    "Warning: all non-first columns are NULL - delimiter may be wrong (expected '{sep}')"
)


def any_beyond_first(columns: list[Column]) -> Column:
    """True where some column other than the first holds a value."""
    found = F.lit(False)
    for c in columns[1:]:
        found = found | c.isNotNull()
    return found


def delimiter_check(df: DataFrame, sep: str = ";") -> DataFrame:
    """Row count and whether the file looks as if it were split at the wrong character."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(any_beyond_first(columns)).alias("filled"),
    ).select(
        "row_count",
        F.when(
            (F.col("row_count") > 0) & (F.col("filled") == 0) & F.lit(len(columns) > 1),
            DELIMITER_WARNING.format(sep=sep),
        )
        .otherwise("OK")
        .alias("status"),
    )


def key_check(df: DataFrame, keys: list[str], by: list[str] | None = None) -> DataFrame:
    """Rows with a NULL in the key, distinct keys that repeat, and rows beyond the first of each;
    one row, or one per value of ``by``.

    Counts per key are combined before the shuffle, so a hot key costs one row per task.
    """
    groups = [F.col(f"`{c}`") for c in by or []]
    columns = [F.col(f"`{k}`") for k in keys]
    some_null = F.lit(False)
    for c in columns:
        some_null = some_null | c.isNull()
    per_key = df.groupBy(*groups, *columns).agg(F.count(F.lit(1)).alias("_n"))
    repeated = ~some_null & (F.col("_n") > 1)
    return per_key.groupBy(*groups).agg(
        F.coalesce(F.sum(F.when(some_null, F.col("_n"))), F.lit(0)).alias("null_keys"),
        F.count_if(repeated).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("_n") - 1)), F.lit(0)).alias("surplus_rows"),
    )


def reject_counts(rejects: dict[str, Column]) -> list[Column]:
    return [F.count_if(flag).alias(name) for name, flag in rejects.items()]


def listed(counts: Iterable[tuple[str, Column]]) -> Column:
    """The counts above zero as text, ``name: n, name: n``; empty text for none."""
    return F.concat_ws(
        ", ", *[F.when(n > 0, F.concat(F.lit(f"{name}: "), n.cast("string"))) for name, n in counts]
    )
