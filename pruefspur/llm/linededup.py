"""Near-duplicate lines by a segment-partition edit join.

Two lines within ``EDITS`` edits share one of ``EDITS + 1`` segments of the shorter one, shifted by no
more than the edits allow.  Every line indexes its own segments under its length, and probes, for
every length up to ``EDITS`` shorter, the substrings that such a segment could be.  What meets is
compared by a banded bit-parallel edit distance on the lines' texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..hadoop import reliable
from .components import components
from .frames import WORD, once, packed
from .kernels import U, _powers, mix, spans_of

EDITS = 2
#: Code points of a line from which on edits link it: two edits in a shorter one mean little.
LEAST_CHARS = 24
#: Line keys sent to every task (16 bytes each); more of them are joined by a shuffle.
BROADCAST_KEYS = 500_000
#: Bits of a line's signature: one bit per class of characters, the parity of how often it has them.
#: An edit changes two of them at most.
CLASSES = 32
#: What a line without a word is made of.
SPACES = " \t\n\x0b\x0c\r"
_CHARS_AT_ONCE = 1 << 20
#: Hash value and signature bit of a character; characters beyond the table share its entries by
#: their low bits, which only adds candidates.
_VALUES = mix(np.arange(1, (1 << 16) + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
_BITS = (U(1) << (_VALUES >> U(59))).astype(np.uint32)
_STEP = U(0x8CB92BA72F3D8DD7)
_INVERSE = U(pow(int(_STEP), -1, 1 << 64))


def segments(length: int, edits: int = EDITS) -> list[tuple[int, int]]:
    """First place and size of each segment of a line; the longer ones last."""
    parts = edits + 1
    short, longer = divmod(length, parts)
    out, at = [], 0
    for i in range(parts):
        size = short + (i >= parts - longer)
        out.append((at, size))
        at += size
    return out


def probes(length: int, shorter: int, edits: int = EDITS) -> Iterator[tuple[int, int, int]]:
    """Segment number, place and size of the substrings of a line that a segment of a line with
    ``shorter`` characters less can be: with i segments before it, the left part has at most i edits
    to spend, and the right part what the other segments leave.

    Of lines of one length both probe.  Within two edits, a segment stands further left in the other line
    only where a character goes before it and one comes after it.  Then the same segment of the other
    line stands further right in this one, or the last segment is at its place in both; so the places
    further left are left out."""
    for i, (at, size) in enumerate(segments(length - shorter, edits)):
        low = at if not shorter and edits <= 2 else max(at - i, at + shorter - (edits - i), 0)
        high = min(at + i, at + shorter + (edits - i), length - size)
        for place in range(low, high + 1):
            yield i, place, size


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that lines probe with: key, line, whether the key is the line's own index key too,
    signature.  Lines that repeat within a batch are taken once."""
    for batch in batches:
        once = dict(zip(batch.column(1).to_pylist(), batch.column(0).to_pylist(), strict=True))
        ids, texts = np.array(list(once.values()), np.int64), list(once)
        for a, b in spans_of([len(t) + 1 for t in texts], _CHARS_AT_ONCE):
            yield _key_rows(ids[a:b], texts[a:b])


@lru_cache(maxsize=4096)
def _wanted(length: int, index: bool) -> np.ndarray:
    """Per key of a line of this length: indexed length, segment, place, size, whether it is its own."""
    rows = [
        (length - d, i, at, size, d == 0 and at == segments(length)[i][0])
        for d in range(min(EDITS, length - 1) + 1)
        for i, at, size in probes(length, d)
    ]
    return np.array([r for r in rows if r[4] or not index], np.int64)


def _key_rows(ids: np.ndarray, texts: list[str], index: bool = False) -> pa.RecordBatch:
    sizes = np.array([len(t) for t in texts], np.int64)
    chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32) & np.uint32(0xFFFF)
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    rolled = np.empty(len(chars) + 1, np.uint64)
    rolled[0] = 0
    np.cumsum(_VALUES[chars] * _powers(_STEP, len(chars)), dtype=np.uint64, out=rolled[1:])
    inverse = _powers(_INVERSE, len(chars))
    signature = np.bitwise_xor.reduceat(_BITS[chars], begins).view(np.int32)

    keys, owners, own = [], [], []
    lengths, which = np.unique(sizes, return_inverse=True)
    specs = [_wanted(int(n), index) for n in lengths]
    widths = np.array([len(x) for x in specs])
    # All but the shortest lines have equally many keys, so this is one turn as a rule.
    for width in np.unique(widths):
        numbered = np.cumsum(widths == width) - 1
        table = np.stack([x for x in specs if len(x) == width])
        rows = np.flatnonzero(widths[which] == width)
        spec = table[numbered[which[rows]]]
        at = begins[rows][:, None] + spec[:, :, 2]
        span = (rolled[at + spec[:, :, 3]] - rolled[at]) * inverse[at]
        salt = (spec[:, :, 0] * 64 + spec[:, :, 1]).astype(np.uint64) * U(0xD1B54A32D192ED03)
        keys.append(mix(mix(span) ^ salt).reshape(-1))
        owners.append(np.repeat(rows, width))
        own.append(spec[:, :, 4].astype(bool).reshape(-1))
    key, owner = np.concatenate(keys), np.concatenate(owners)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(key.view(np.int64)),
            pa.array(ids[owner]),
            pa.array(np.concatenate(own)),
            pa.array(signature[owner]),
        ],
        names=["key", "line", "own", "signature"],
    )


_WORD_BITS = 64
_FULL = (1 << _WORD_BITS) - 1


def _band_distance(a: str, b: str, edits: int) -> int:
    """Edit distance along a diagonal band, exact up to ``edits``; ``a`` has at least that many
    characters and ``b`` no fewer than ``a``.

    One word holds the vertical differences of a column; its last bit lies ``edits`` rows below the
    diagonal.  Each character of ``b`` moves the word one row down.  The distance is followed along
    the band's lower edge to the last row, and then along that row."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << i
    rise, fall = _FULL & ~((1 << (_WORD_BITS - edits - 1)) - 1), 0
    distance = edits
    edge, row = 1 << (_WORD_BITS - 1), 1 << (_WORD_BITS - 2)
    first = edits + 1 - _WORD_BITS
    for j, ch in enumerate(b):
        same = where.get(ch, 0)
        same = (same >> (first + j) if first + j >= 0 else same << -(first + j)) & _FULL
        diagonal = ((((same & rise) + rise) ^ rise) | same | fall) & _FULL
        right_rise = (fall | ~(diagonal | rise)) & _FULL
        right_fall = diagonal & rise
        if j < len(a) - edits:
            distance += not diagonal & edge
        else:
            distance += bool(right_rise & row) - bool(right_fall & row)
            row >>= 1
        rise = (right_fall | ~((diagonal >> 1) | right_rise)) & _FULL
        fall = (diagonal >> 1) & right_rise
    return distance


def within(a: str, b: str, edits: int = EDITS) -> bool:
    """Whether two texts are within an edit distance.  Equal ends are cut off first."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > edits:
        return False
    start, stop = 0, len(a)
    while start < stop and a[start] == b[start]:
        start += 1
    back = 0
    while back < stop - start and a[-1 - back] == b[-1 - back]:
        back += 1
    a, b = a[start : len(a) - back], b[start : len(b) - back]
    if len(b) <= edits:
        return True
    if len(a) <= edits:
        # A few characters at most: the plain recurrence.
        last = list(range(len(a) + 1))
        for j, y in enumerate(b, 1):
            now = [j]
            for i, x in enumerate(a, 1):
                now.append(min(last[i - 1] + (x != y), last[i] + 1, now[-1] + 1))
            last = now
        return last[-1] <= edits
    return _band_distance(a, b, edits) <= edits


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
        kept = pa.array([i for i, (x, y) in enumerate(texts) if x != y and within(x, y)], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(kept), batch.column(1).take(kept)], names=["a", "b"]
        )


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Lines with a word: the document as id and hash of its text, the line's number, text and hashes."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # Hashed before the lines are cut: beside the generator, each line would hash its whole text.
    texts = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_text_hash"), text.alias("_text"))
    lines = texts.select("_id", "_text_hash", F.posexplode(F.split("_text", "\n")).alias("_no", "_line"))
    lines = lines.filter(F.ltrim("_line", F.lit(SPACES)) != "")
    return lines.withColumn("_key", F.xxhash64("_line")).withColumn("_key2", F.xxhash64(F.lit(1), "_line"))


def line_links(lines: DataFrame) -> DataFrame:
    """Pairs of line keys ``(a, b)`` whose texts differ by 1 to ``EDITS`` edits.

    Keys of one line only, as most are, go first.  The rows of the others are joined as they are; the
    signatures are compared within the join, so that only pairs that may be near come out of it.  Nothing
    is capped: a substring of very many lines is a large join cell, which the engine splits.
    """
    long_ = lines.filter(F.length("_line") >= LEAST_CHARS).select("_key", "_line")
    # Never null, so that no side of a join filters for itself, and both sides come from one shuffle.
    schema = "key bigint not null, line bigint not null, own boolean not null, signature int not null"
    # One column less to move: the signature, with ``own`` as the lowest bit.
    mark = F.shiftleft(F.col("signature").cast("bigint"), 1).bitwiseOR(F.col("own").cast("bigint")).alias("mark")
    own, signature = (F.col("mark").bitwiseAND(1) == 1).alias("own"), F.shiftright("mark", 1).cast("int").alias("signature")
    keyed = long_.mapInArrow(_keys, schema).select("key", "line", mark).repartition(F.col("key"))
    keyed = keyed.select("key", "line", own, signature)
    # Figures of fixed width, and a look-up of each row in what they leave: the rows are moved once, and not
    # sorted.
    cells = keyed.groupBy("key").agg(F.min("line").alias("low"), F.max("line").alias("high"), F.max("own").alias("own"))
    cells = cells.filter((F.col("low") < F.col("high")) & F.col("own")).select("key")
    # Repeats of a line are one node of the join.
    shared = reliable(keyed.join(cells.hint("shuffle_hash"), "key", "left_semi").distinct())
    index = shared.filter("own").select("key", F.col("line").alias("a"), F.col("signature").alias("sa"))
    probe = shared.select("key", F.col("line").alias("b"), F.col("signature").alias("sb"), "own")
    near = F.bit_count(F.col("sa").bitwiseXOR(F.col("sb"))) <= 2 * EDITS
    # Two index rows meet twice; one order of them is enough.
    met = index.join(probe, "key").filter((F.col("a") != F.col("b")) & (~F.col("own") | (F.col("a") < F.col("b"))) & near)
    pairs = reliable(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    needed = pairs.select(F.explode(F.array("a", "b")).alias("_key")).distinct()
    size = needed.count()
    texts = long_.join(F.broadcast(needed) if size <= BROADCAST_KEYS else needed, "_key", "left_semi")
    texts = reliable(texts.dropDuplicates(["_key", "_line"]))
    side = lambda x: texts.select(F.col("_key").alias(x), F.col("_line").alias(f"t{x}"))
    full = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ta", "tb")
    return full.mapInArrow(_verified, "a bigint, b bigint").distinct()


def classify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_equal: int = LEAST_CHARS
) -> DataFrame:
    """A row per line with a word: ``_id``, ``_text_hash``, ``_no`` (its number in the text), ``first``
    (id, text hash and number of the first line of its class), ``copies`` (equal lines, itself
    included), ``links`` (different lines within the edits).

    A class is what chains of links and equal lines tie together.  Lines under ``LEAST_CHARS`` code
    points have no links.  Equal lines are one class from ``least_equal`` code points on, with 0 at
    every length; each shorter one is its own class.  Lines without a word have no row.  A null or
    empty text has no lines.  Rows that repeat an id and a text are one document.  A null id comes
    first in order.  Other columns are not read.
    """
    lines = _lines(docs, id_col, text_col)
    links = reliable(line_links(lines))
    degree = links.select(F.explode(F.array("a", "b")).alias("_key")).groupBy("_key").agg(F.count(F.lit(1)).alias("links"))
    tied = reliable(components(links).select(F.col("node").alias("_key"), F.col("component").alias("class")).join(degree, "_key"))
    sent = F.broadcast if tied.count() <= BROADCAST_KEYS else lambda df: df
    # The texts are cut and hashed once for all that follows.
    here = reliable(
        lines.select(
            F.struct("_id", "_text_hash", "_no").alias("at"), "_key", "_key2", (F.length("_line") >= least_equal).alias("compared")
        )
    )
    compared = here.filter("compared")
    lowest = compared.select("at", "_key").join(sent(tied), "_key").groupBy("class").agg(F.min("at").alias("lowest"))
    linked = tied.join(lowest, "class").select("_key", "lowest", "links")
    equal = compared.groupBy("_key", "_key2").agg(F.min("at").alias("lone"), F.count(F.lit(1)).alias("copies"))
    classes = equal.join(sent(linked), "_key", "left").select(
        "_key", "_key2", F.coalesce("lowest", "lone").alias("first"), "copies", F.coalesce("links", F.lit(0)).alias("links")
    )
    known = compared.join(classes, ["_key", "_key2"]).select("at", "first", "copies", "links")
    if least_equal <= 0:
        return known.select("at.*", "first", "copies", "links")
    short = here.filter(~F.col("compared")).select(
        "at", F.col("at").alias("first"), F.lit(1).cast("bigint").alias("copies"), F.lit(0).cast("bigint").alias("links")
    )
    return known.unionByName(short).select("at.*", "first", "copies", "links")


def _is_first():
    at = F.struct("_id", "_text_hash", "_no")
    return at.eqNullSafe(F.col("first"))


def report(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_equal: int = LEAST_CHARS
) -> DataFrame:
    """``classify`` with plain columns: the line, its class as document and line, and whether it stays."""
    return classify(docs, id_col, text_col, least_equal).select(
        F.col("_id").alias(id_col),
        F.col("_no").cast("bigint").alias("line_no"),
        F.col("first._id").alias("class_doc_id"),
        F.col("first._no").cast("bigint").alias("class_line_no"),
        "copies",
        "links",
        _is_first().alias("kept"),
    )


def filtered(docs: DataFrame, least_equal: int = LEAST_CHARS) -> DataFrame:
    """The documents without lines that an earlier line repeats, with all their columns; ``n_chars`` is
    counted anew where it is there.  A document of which no word is left is dropped: each of its
    lines stands elsewhere.  A document that had no word before stays as it is."""
    lines = classify(docs, least_equal=least_equal)
    gone = lines.filter(~_is_first()).groupBy("_id", "_text_hash").agg(F.collect_set("_no").alias("_gone"))
    work = packed(docs, _doc=F.col("doc_id"), _text=F.col("text"), _hash=F.xxhash64(F.coalesce("text", F.lit(""))))
    met = work.join(gone, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_text_hash")), "left")
    met = once(met, _parts=F.when(F.col("_gone").isNotNull(), F.split("_text", "\n")))
    left = F.array_except(F.sequence(F.lit(0), F.size("_parts") - 1), F.col("_gone"))
    met = once(met, _left=F.when(F.col("_gone").isNotNull(), F.array_sort(left)))
    text = F.array_join(F.transform("_left", lambda i: F.get("_parts", i)), "\n")
    met = met.withColumn("_new", F.when(F.col("_gone").isNotNull(), text).otherwise(F.col("_text")))
    met = met.filter(F.col("_gone").isNull() | F.col("_new").rlike(WORD))
    fresh = {"text": F.col("_new"), "n_chars": F.length("_new").cast("bigint")}
    return met.select(
        *[
            F.when(F.col("_gone").isNull(), F.col(f"_in.`{c}`")).otherwise(fresh[c]).alias(c) if c in fresh else F.col(f"_in.`{c}`")
            for c in docs.columns
        ]
    )
