"""N-gram Jaccard join in size-banded tiles, with bitmap signatures before exact intersection.

Sets that reach the threshold share a shingle among the few that come first in a common order (of a
set of n, one more than it may lack).  The order puts shingles of crowded places of a fixed-size
count sketch last, so that common passages are hardly ever what two sets meet at.  The sets of a
shingle are cut to tiles by bands of their sizes, and only tiles of the same or the next band meet, a
bounded number of rows each.  Where two rows meet, the bits in which their signatures differ bound
the overlap from above; what may still reach the threshold is decided by intersecting sorted arrays.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..hadoop import fresh_folder, reliable
from .components import components
from .kernels import U, mix, shingle_sets, spans_of

#: Words of a shingle; a pair links when 100 * intersection >= PERCENT * union.
SHINGLE, PERCENT = 3, 90
#: Places of the sketch that orders shingles.  The place is the low bits of a shingle's hash.
PLACE_BITS = 16
#: Bits of a signature: the parity of how many shingles fall on each.
BITS = 1024
#: Bits that are enough to tell unlike sets of fewer shingles than ``NARROW_BELOW`` apart, so that no more
#: are moved where sets of such sizes meet.
NARROW, NARROW_BELOW = 256, 512
#: Texts (16 bytes of keys each) up to which the keys of those wanted go to every task; more of them
#: are joined by a shuffle.
BROADCAST_KEYS = 500_000
#: Shingles from which a set also has a wide signature, of about a bit per shingle: the narrow one's bits are
#: hit so often then that unlike sets no longer differ by enough of them.
WIDE_FROM = 2048
#: Rows of one cell, size band and side that meet in one tile.
TILE = 1024
_TEXT_BYTES_AT_ONCE = 1 << 24


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many sets of a task's texts have a shingle in each place of the sketch."""
    total = np.zeros(1 << PLACE_BITS, np.int64)
    for batch in batches:
        for shingles in _sets(batch.column(0)):
            total += np.bincount((shingles & U((1 << PLACE_BITS) - 1)).astype(np.int64), minlength=len(total))
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["place", "n"])


def _sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The shingle sets of a column of texts, a bounded number of bytes at once."""
    sizes = [len(t.as_buffer() or b"") + 1 for t in texts]
    for a, b in spans_of(sizes, _TEXT_BYTES_AT_ONCE):
        yield from shingle_sets(texts.slice(a, b - a).to_pylist(), SHINGLE)


def order_of_places(counts: np.ndarray) -> np.ndarray:
    """The rank of each place, the emptiest first."""
    rank = np.empty(len(counts), np.uint64)
    rank[np.argsort(counts, kind="stable")] = np.arange(len(counts), dtype=np.uint64)
    return rank


def prefix(shingles: np.ndarray, rank: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The first shingles of a set in the common order, as many as leave no room for the threshold
    without one of them.  The order's number is made of all bits of the hash, so it is one to one."""
    n = len(shingles)
    keys = rank[(shingles & U((1 << PLACE_BITS) - 1)).astype(np.int64)] << U(64 - PLACE_BITS) | shingles >> U(PLACE_BITS)
    size = n - -(-percent * n // 100) + 1
    return np.sort(np.partition(keys, size - 1)[:size])


def parity(shingles: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The signature of a set.  One of half the bits is the exclusive or of its halves."""
    bit = (mix(shingles ^ U(0x3C3C3C3C)) & U(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(bit, minlength=bits) & 1).astype(np.uint8)).view(np.int64)


def wide_parity(shingles: np.ndarray) -> np.ndarray | None:
    """The signature of a large set, as many bits as the highest power of two in its size."""
    return parity(shingles, 1 << (len(shingles).bit_length() - 1)) if len(shingles) >= WIDE_FROM else None


def _signed(rank: np.ndarray, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, prints, signatures, wides, firsts, ends = [], [], [], [], [], [0]
            for s in _sets(batch.column(4)):
                sizes.append(len(s))
                prints += [mix(s ^ U(k)).sum(dtype=np.uint64) for k in (0x1111, 0x2222)]
                signatures.append(parity(s))
                wides.append(wide_parity(s))
                firsts.append(prefix(s, rank, percent) if len(s) else s)
                ends.append(ends[-1] + len(firsts[-1]))
            n, width = len(sizes), BITS // 64
            both = np.array(prints, np.uint64).view(np.int64).reshape(n, 2)
            lists = lambda at, rows: pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:4],
                    pa.array(sizes, pa.int64()),
                    pa.array(both[:, 0].copy()),
                    pa.array(both[:, 1].copy()),
                    lists(np.arange(n + 1) * width, np.concatenate([np.empty(0, np.int64), *signatures])),
                    pa.array(wides, pa.list_(pa.int64())),
                    lists(ends, np.concatenate([np.empty(0, np.uint64), *firsts]).view(np.int64)),
                ],
                names=[*batch.schema.names[:4], "n", "p1", "p2", "bits", "wide", "prefix"],
            )

    return run


def _verified(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The pairs whose sets reach the threshold, by intersecting sorted arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right, kept = batch.column(2), batch.column(3), []
            sizes = [1 + len(x.as_buffer() or b"") + len(y.as_buffer() or b"") for x, y in zip(left, right, strict=True)]
            for at, stop in spans_of(sizes, _TEXT_BYTES_AT_ONCE):
                some = slice(at, stop)
                texts = list(dict.fromkeys(left[some].to_pylist() + right[some].to_pylist()))
                sets = dict(zip(texts, shingle_sets(texts, SHINGLE), strict=True))
                for i in range(at, stop):
                    a, b = sets[left[i].as_py()], sets[right[i].as_py()]
                    common = len(np.intersect1d(a, b, assume_unique=True))
                    if 100 * common >= percent * (len(a) + len(b) - common):
                        kept.append(i)
            rows = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows)], names=["a", "b"])

    return run


def _sizes_fit(percent: int) -> Column:
    return (100 * F.col("na") >= percent * F.col("nb")) & (100 * F.col("nb") >= percent * F.col("na"))


def _may_link(percent: int) -> Column:
    """Whether sizes ``na`` and ``nb`` and the signatures allow the threshold.  A shingle that one of two
    sets lacks changes one bit, so the overlap is at most half of what the sizes are more than the
    bits that differ."""
    differing = F.lit(0)
    for i in range(BITS // 64):
        # Both are folded alike, so what one is short of, the other is too.
        both = F.get("qa", F.lit(i)).bitwiseXOR(F.get("qb", F.lit(i)))
        differing = differing + F.coalesce(F.bit_count(both), F.lit(0))
    return _sizes_fit(percent) & _room(differing, percent)


def _room(differing: Column, percent: int) -> Column:
    """Whether so many differing bits leave enough overlap for the threshold."""
    both = F.col("na") + F.col("nb")
    return (100 + percent) * (both - differing) >= 2 * percent * both


def finer(pairs: DataFrame, nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs that wide signatures allow too; a pair without two of them stays."""
    wide = nodes.filter(F.col("wide").isNotNull())
    side = lambda x: wide.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("wide").alias(f"w{x}"))
    met = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    half = lambda w: (F.size(w) / 2).cast("int")
    folded = lambda w: F.zip_with(
        F.slice(w, F.lit(1), half(w)), F.slice(w, half(w) + 1, half(w)), lambda x, y: x.bitwiseXOR(y)
    )
    # Sizes that the threshold allows lie less than two powers of two apart.
    longer = lambda w, v: F.when(F.size(w) > F.size(v), folded(w)).otherwise(w)
    a, b = F.col("wa"), F.col("wb")
    ones = F.zip_with(longer(a, b), longer(b, a), lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("bigint"))
    differing = F.aggregate(ones, F.lit(0).cast("bigint"), lambda n, x: n + F.coalesce(x, F.lit(0)))
    judged = (a.isNull() | b.isNull()) | _room(differing, percent)
    return met.filter(judged).select("a", "b")


def _links(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs of nodes that hold on their full sets; only their texts are moved."""
    pairs = reliable(finer(pairs, nodes, percent))
    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    # A node's text is found by its content, which is the same in every scan.
    of = reliable(nodes.select("node", "t1", "t2").join(needed, "node"))
    keys = of.select("t1", "t2")
    keys = F.broadcast(keys) if of.count() <= BROADCAST_KEYS else keys
    found = texts.join(keys, ["t1", "t2"], "left_semi").dropDuplicates(["t1", "t2"])
    full = reliable(of.join(found, ["t1", "t2"]).select("node", "_text"))
    side = lambda x: full.select(F.col("node").alias(x), F.col("_text").alias(f"t{x}"))
    moved = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ta", "tb")
    return moved.mapInArrow(_verified(percent), "a bigint, b bigint")


def _side(rows: DataFrame, x: str, *more: str) -> DataFrame:
    return rows.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"q{x}"), *more)


def _step(percent: int) -> float:
    return max(math.log(100 / percent), 0.01) * (1 + 1e-6)


def _band(percent: int) -> Column:
    """The size band of a set of ``n`` shingles.  Bands are a little wider than the threshold's ratio, so
    that rounding puts no partners two bands apart."""
    return F.floor(F.log(F.col("n")) / _step(percent)).cast("int")


def _narrowed(band: Column, percent: int) -> Column:
    """``bits``, folded where sets of a band meet that are small enough."""
    words, parts = NARROW // 64, BITS // NARROW
    fold = [reduce(Column.bitwiseXOR, [F.get("bits", F.lit(i + words * p)) for p in range(parts)]) for i in range(words)]
    return F.when(band < int(math.log(NARROW_BELOW) / _step(percent)), F.array(*fold)).otherwise(F.col("bits"))


def met(nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Cell, node and n of the nodes that may have a partner in a cell: another node of their own size
    band or of one beside it.  A cell is summed up as its number of nodes and a bit per band, so that the
    many chance meetings of unlike sizes end here.  (Bands 64 apart share a bit, which only keeps more.)"""
    # Nearly every cell has one node, so the rows are moved once for both the sums and the join with them.
    cells = nodes.select("node", "n", F.explode("prefix").alias("cell")).repartition(F.col("cell"))
    cells = cells.withColumn("band", _band(percent))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("band", F.lit(64)).cast("int"))
    bands = cells.groupBy("cell").agg(F.count("node").alias("size"), F.bit_or(bit).alias("bands"))
    repeated = F.bit_count("bands") < F.col("size")
    beside = F.shiftleft("bands", 1).bitwiseOR(F.shiftrightunsigned("bands", 63))
    shared = bands.filter((F.col("size") > 1) & (repeated | (F.col("bands").bitwiseAND(beside) != 0)))
    has = lambda by: F.getbit(F.col("bands"), F.pmod(F.col("band") + by, F.lit(64)).cast("int")) == 1
    return cells.join(shared, "cell").filter(repeated | has(1) | has(63)).select("cell", "node", "n")


def led(members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs of nodes with leaders of their cells that the sizes allow, a few per node: the leader that
    most cells have in common, and in about eight of a node's cells one drawn for that cell.
    ``members`` has cell, node and n."""
    crowd = members.groupBy("node").agg(F.count(F.lit(1)).alias("cells"))
    rows = members.join(crowd, "node")
    # What was copied shares more of its shingles than an edited copy does, so it leads most of its cells.
    leaders = rows.groupBy("cell").agg(
        F.max(F.struct("cells", F.xxhash64("node").alias("h"), "node", "n")).alias("top"),
        F.min(F.struct(F.lit(0).cast("bigint").alias("cells"), F.xxhash64("node", "cell").alias("h"), "node", "n")).alias("drawn"),
    )
    here = rows.join(leaders, "cell")
    few = F.pmod(F.xxhash64("cell", "node"), F.greatest(F.floor(F.col("cells") / 8), F.lit(1))) == 0
    met = here.select("node", F.col("n").alias("na"), F.explode(F.array("top", F.when(few, F.col("drawn")))).alias("leader"))
    met = met.withColumn("nb", F.col("leader.n")).filter((F.col("leader.node") != F.col("node")) & _sizes_fit(percent))
    pair = F.least("node", "leader.node").alias("a"), F.greatest("node", "leader.node").alias("b")
    return met.select(*pair).distinct()


def tiled(rows: DataFrame, signs: DataFrame, percent: int = PERCENT, tile: int = TILE) -> DataFrame:
    """Pairs of nodes of different components that share a cell and may link.  ``rows`` has cell, node,
    n and component, ``signs`` each node's bits.

    Partners' sizes lie in one band or in two neighbouring ones.  A cell's rows of a band are dealt to
    parts of about ``tile`` rows, and any two parts that must meet are one join key."""
    rows = rows.withColumn("band", _band(percent))
    size = F.count(F.lit(1))
    parts = rows.groupBy("cell", "band").agg(
        F.ceil(size / tile).cast("int").alias("parts"), (size == 1).alias("alone"), F.min("n").alias("low"), F.max("n").alias("high")
    )
    near = lambda by, name, end: parts.select(
        "cell", (F.col("band") - by).alias("band"), F.col("parts").alias(name), F.col(end).alias(f"{name}_{end}")
    )
    spread = parts.join(near(1, "above", "low"), ["cell", "band"], "left").join(near(-1, "below", "high"), ["cell", "band"], "left")
    rows = rows.join(spread.drop("low", "high"), ["cell", "band"])
    # What stands alone in its band does not meet it, nor a band beside it of which all sizes are too unlike.
    rows = rows.withColumns(
        {
            "own": F.when(~F.col("alone"), F.col("parts")),
            "above": F.when(100 * F.col("n") >= percent * F.col("above_low"), F.col("above")),
            "below": F.when(100 * F.col("below_high") >= percent * F.col("n"), F.col("below")),
        }
    )
    rows = rows.filter(F.coalesce("own", "above", "below").isNotNull()).join(signs.select("node", "bits"), "node")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("node", "cell"), F.col("parts")).cast("int"))

    def meeting(beside: str) -> DataFrame:
        """A row for each part of the own band, and for each of the band beside it."""
        own = F.struct(F.lit(0).alias("by"), F.col("own").alias("n"))
        other = F.struct(F.lit(1).alias("by"), F.col(beside).alias("n"))
        met = rows.withColumn("_beside", F.explode(F.array(own, other))).filter("_beside.n > 0")
        return met.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_beside.n") - 1))).withColumn("by", F.col("_beside.by"))

    left = meeting("above").withColumn("key", F.xxhash64("cell", F.col("band") + F.col("by"), "by", "part", "_other"))
    right = meeting("below").withColumn("key", F.xxhash64("cell", "band", "by", "_other", "part"))
    # The band of the right side, which both know, settles how many bits are compared.
    left = left.withColumn("bits", _narrowed(F.col("band") + F.col("by"), percent))
    right = right.withColumn("bits", _narrowed(F.col("band"), percent))
    left = _side(left, "a", "key", F.col("by").alias("bya"), F.col("component").alias("ca"))
    right = _side(right, "b", "key", F.col("by").alias("byb"), F.col("component").alias("cb"))
    # Within a band each pair meets twice; one order of them is enough.
    once = (F.col("bya") == F.col("byb")) & ((F.col("bya") == 1) | (F.col("a") < F.col("b")))
    met = left.join(right, "key").filter(once & (F.col("ca") != F.col("cb")) & _may_link(percent))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, tile: int = TILE
) -> DataFrame:
    """Per row the id, ``n_shingles`` and ``component_id``, the smallest id reachable by links.

    Shingles are three words of the text with A-Z lower-cased; a text of fewer words has its whole
    sequence as its only one; a null or empty text and one without words have none and are tied to
    nothing.  Rows are documents of their own, also where they repeat; equal sets are tied.  Ids are
    of any type with an order; a null id counts as none, so a group without another has a null
    component.  Other columns are not read.  An empty table gives an empty result.

    No link is lost: the order of shingles only settles which of them sets meet at.  Nothing but
    the sketch of 65,536 counts and numbers of rows comes to the driver.
    """
    spark = docs.sparkSession
    text = F.col(f"`{text_col}`").cast("string")
    numbered = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(f"`{id_col}`").alias("_id"),
        F.xxhash64(text).alias("t1"),
        F.xxhash64(F.lit(1), text).alias("t2"),
        text.alias("_text"),
    )
    sketch = numbered.select("_text").mapInArrow(_counted, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << PLACE_BITS, np.int64)
    counts[sketch["place"].to_numpy()] = sketch["n"].to_numpy()

    folder = fresh_folder(spark, "jaccard")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    kind = dict(numbered.dtypes)["_id"]
    made = f"_row bigint, _id {kind}, t1 bigint, t2 bigint, n bigint, p1 bigint, p2 bigint, bits array<bigint>, wide array<bigint>, prefix array<bigint>"
    signed = written(numbered.mapInArrow(_signed(order_of_places(counts), percent), made), "signed")
    same = ["p1", "p2", "n"]
    alike = signed.filter(F.col("n") > 0).groupBy(same).agg(F.min("_row").alias("node"), F.min("_id").alias("first"))
    nodes = signed.join(alike.select(F.col("node").alias("_row")), "_row").withColumnRenamed("_row", "node")
    nodes = written(nodes.select("node", "n", "t1", "t2", "bits", "wide", "prefix"), "nodes")
    texts = numbered.select("t1", "t2", "_text").filter(F.col("_text").isNotNull())

    members = written(met(nodes, percent), "members")
    signs = nodes.select("node", "n", "bits")
    pairs = led(members, percent).join(_side(signs, "a"), "a").join(_side(signs, "b"), "b").filter(_may_link(percent))
    links = reliable(_links(written(pairs.select("a", "b"), "led"), nodes, texts, percent))

    tied = components(links)
    here = members.join(tied, "node", "left").select("cell", "node", "n", F.coalesce("component", "node").alias("component"))
    mixed = here.groupBy("cell").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_ = written(here.join(mixed.filter("low < high").select("cell"), "cell"), "open")
    more = _links(written(tiled(open_, signs, percent, tile), "tiled"), nodes, texts, percent)
    tied = components(links.unionByName(more))

    alike = alike.join(tied, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = alike.groupBy("component").agg(F.min("first").alias("component_id"))
    known = alike.join(lowest, "component").select(*same, "component_id")
    found = signed.select("_id", *same).join(known, same, "left")
    return found.select(
        F.col("_id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("_id")).alias("component_id"),
    )
