"""Importance resampling towards a target distribution of hashed n-grams.

Separators are collapsed to single spaces, and an overlapped regular expression then gives the span
of every n-gram as it stands, words and blanks included, whose bytes a CRC sends to a bucket.  The
buckets of the documents and of the target texts give each bucket a gain, a document's gains add up
to its weight, and Gumbel noise from a hash of its id turns the highest scores into a draw without
replacement.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..hadoop import fresh_folder

#: Bytes between words once A-Z are lower-cased; every byte of a character beyond ASCII belongs to a word.
SEPARATORS = regex.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LONGEST, BUCKETS, PERCENT, LEAST_WORDS, SEED = 1, 10_000, 10, 20, 2024
#: Spans of a text counted before they go to the buckets: a bound on a task's memory.
_SPANS_AT_ONCE = 200_000
_FEATURES = "_row bigint, _id {id}, n_words bigint, n_features bigint, buckets array<int>, times array<bigint>"


def _patterns(longest: int) -> list[regex.Pattern]:
    """One pattern per length.  The lookarounds hold both ends at a word's border."""
    return [regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % k) for k in range(longest)]


def _collapsed(text: str | None) -> bytes:
    # Lower-casing bytes changes A-Z alone.
    return SEPARATORS.sub(b" ", (text or "").encode("utf-8", "replace").lower()).strip(b" ")


def features_of(text: str | None, patterns: list[regex.Pattern], buckets: int) -> tuple[int, np.ndarray]:
    """Words of a text, and how often its n-grams fall into each bucket."""
    line = _collapsed(text)
    counts = np.zeros(buckets, np.int64)
    words = 0
    for k, pattern in enumerate(patterns):
        spans = (m.group() for m in pattern.finditer(line, overlapped=True))
        while part := Counter(islice(spans, _SPANS_AT_ONCE)):
            times = np.fromiter(part.values(), np.int64, len(part))
            np.add.at(counts, np.fromiter((crc32(g) for g in part), np.int64, len(part)) % buckets, times)
            if k == 0:
                words += int(times.sum())
    return words, counts


def _counted(longest: int, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = _patterns(longest)
        for batch in batches:
            words, totals, at, times, ends = [], [], [], [], [0]
            for text in batch.column(2):
                n, counts = features_of(text.as_py(), patterns, buckets)
                some = np.flatnonzero(counts)
                words.append(n)
                totals.append(int(counts.sum()))
                at.append(some.astype(np.int32))
                times.append(counts[some])
                ends.append(ends[-1] + len(some))
            offsets = pa.array(ends, pa.int32())
            joined = lambda parts, kind: pa.ListArray.from_arrays(
                offsets, pa.array(np.concatenate(parts) if parts else [], kind)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(words, pa.int64()),
                    pa.array(totals, pa.int64()),
                    joined(at, pa.int32()),
                    joined(times, pa.int64()),
                ],
                names=["_row", "_id", "n_words", "n_features", "buckets", "times"],
            )

    return run


def features(texts: DataFrame, id_col: str, text_col: str, longest: int, buckets: int) -> DataFrame:
    """A numbered row per input row with its words, its n-grams and its buckets (ascending) with
    their counts."""
    work = texts.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(f"`{id_col}`").alias("_id"),
        F.col(f"`{text_col}`").cast("string").alias("_text"),
    )
    return work.mapInArrow(_counted(longest, buckets), _FEATURES.format(id=dict(work.dtypes)["_id"]))


def histogram(counted: DataFrame, buckets: int) -> np.ndarray:
    """How many n-grams of all rows fall into each bucket: one row per bucket comes to the driver."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            np.add.at(total, batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy())
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    found = counted.select("buckets", "times").mapInArrow(summed, "bucket bigint, n bigint")
    table = found.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[table["bucket"].to_numpy()] = table["n"].to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole thousandths of the logarithm of how much likelier a bucket is in the target; each bucket
    counts once more on both sides."""
    m = len(source)
    s_all, t_all = int(source.sum()) + m, int(target.sum()) + m
    return np.array(
        [
            math.floor(1000 * math.log(float((int(t) + 1) * s_all) / float((int(s) + 1) * t_all)))
            for s, t in zip(source, target, strict=True)
        ],
        np.int64,
    )


def _weighed(gain: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, times = batch.column(4), batch.column(5)
            ends = at.offsets.to_numpy().astype(np.int64)
            upto = np.concatenate([[0], np.cumsum(gain[at.flatten().to_numpy()] * times.flatten().to_numpy())])
            ends = ends - ends[0]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(upto[ends[1:]] - upto[ends[:-1]])],
                names=[*batch.schema.names[:4], "weight"],
            )

    return run


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text: str = "text",
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Every row's id, ``n_features``, ``weight``, ``score`` and ``rank`` (1, 2, 3 ... among the drawn,
    else null).

    Drawn are ``percent`` of the rows with ``least_words`` words, those of the highest scores; ties go
    to the smaller id, a null id last, then to the row that is read first.  A null or empty text has
    no features and the weight 0, and is not drawn.  A null id is hashed as an empty one.  Repeated
    rows are rows of their own, each counts.  Without target texts all buckets have the same chance
    there.  Other columns are not read.  An empty table gives an empty result.

    The features are written once; from then on only they are read.  The driver holds two counts per
    bucket and one count per partition of the ranking, which is dealt by ranges of the score.
    """
    spark = docs.sparkSession
    folder = fresh_folder(spark, "resample")
    features(docs, id_col, text_col, longest, buckets).write.parquet(f"{folder}/features")
    counted = spark.read.parquet(f"{folder}/features")
    wanted = features(target, target_text, target_text, longest, buckets)
    gain = gains(histogram(counted, buckets), histogram(wanted, buckets))
    kind = dict(counted.dtypes)["_id"]
    weighed = counted.mapInArrow(
        _weighed(gain), f"_row bigint, _id {kind}, n_words bigint, n_features bigint, weight bigint"
    )
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((drawn + 0.5) / F.lit(4294967296.0)))).cast("bigint")
    scored = weighed.withColumn("score", F.col("weight") + noise)
    # Ranges of the order, each sorted by one task; a row's number names its range and its place.
    order = [F.col("score").desc(), F.col("_id").asc_nulls_last(), F.col("_row").asc()]
    able = scored.filter(F.col("n_words") >= least_words)
    dealt = able.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.withColumn("_at", F.monotonically_increasing_id()).write.parquet(f"{folder}/ranked")
    ranked = spark.read.parquet(f"{folder}/ranked").withColumn("_range", F.shiftright("_at", 33).cast("int"))
    sizes = {r["_range"]: r["n"] for r in ranked.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = sum(sizes.values()) * percent // 100
    before, at = {}, 0
    for part in sorted(sizes):
        before[part] = at
        at += sizes[part]
    offsets = spark.createDataFrame(list(before.items()) or [(0, 0)], "_range int, _before bigint")
    place = F.col("_at").bitwiseAND((1 << 33) - 1) + F.col("_before") + 1
    ranked = ranked.join(F.broadcast(offsets), "_range").withColumn("rank", F.when(place <= places, place))
    rest = scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("bigint"))
    wanted_columns = [F.col("_id").alias(id_col), "n_features", "weight", "score", "rank"]
    return ranked.select(*wanted_columns).unionByName(rest.select(*wanted_columns))
