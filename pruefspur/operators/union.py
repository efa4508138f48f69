"""Frames stacked by column name."""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stacked(frames: list[DataFrame]) -> DataFrame:
    """All rows of the frames; a column a frame lacks is NULL.  Numbers of different types widen,
    any other mixture of types becomes text."""
    kinds: dict[str, set[T.DataType]] = defaultdict(set)
    for frame in frames:
        for field in frame.schema.fields:
            kinds[field.name].add(field.dataType)
    as_text = {
        name
        for name, types in kinds.items()
        if len(types) > 1 and not all(isinstance(t, T.NumericType) for t in types)
    }

    def aligned(frame: DataFrame) -> DataFrame:
        columns = [F.col(f"`{c}`") for c in frame.columns]
        return frame.select(
            *[
                c.cast("string").alias(n) if n in as_text else c
                for c, n in zip(columns, frame.columns)
            ]
        )

    if as_text:
        frames = [aligned(f) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
