"""Near-duplicate documents: SuperMinHash signatures, banding, verification, union-find.

Documents with equal shingle sets are one node.  Nodes that share a band of their signatures are
candidates; a candidate becomes a link only when the full sets say so.  A group of n copies would
make n * n candidates, of which most tell nothing: two nodes that are tied already need not be
compared.  So a band cell first compares its nodes with a leader that it draws among them; only
nodes still in different components of a cell are then compared with all of the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..hadoop import reliable
from .components import components
from .frames import packed, quoted
from .kernels import U, mix, shingle_sets, spans_of, super_minhash

#: A pair links when 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Signature length, and rows of a band: at a similarity of 0.75 all 32 bands miss with 5e-6.
SLOTS, ROWS = 128, 4
BANDS = SLOTS // ROWS
#: Bands whose cells have leaders in the first pass.
FIRST_BANDS = 16
#: A candidate is verified when at most this many of the 128 four-bit digests of its slots differ.
#: At a similarity of 0.75, 30 of them do on average with a deviation under 4.8, so 57 is over 5.5
#: deviations away: under 1e-7 of the links.
DIFFERENT = 57
#: Bits of a set's parity sketch.  An element that only one of two sets has changes one bit of the
#: difference of their sketches, so the bits that differ are never more than such elements: what this
#: filter drops is no link, without any chance of error.
PARITY = 1024
#: Shingles whose signatures are computed at once.
AT_ONCE = 150_000
DIGESTS = SLOTS * 4 // 64


def _parity(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``PARITY`` bits per set, as signed words."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    bit = (mix(np.concatenate(sets) ^ U(0x5A5A5A5A)) & U(PARITY - 1)).astype(np.int64)
    odd = np.bincount(owner * PARITY + bit, minlength=len(sets) * PARITY).astype(np.uint8) & 1
    return np.packbits(odd.reshape(len(sets), PARITY), axis=1).view(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = list(shingle_sets(batch.column(1).to_pylist()))
        sizes = np.array([len(s) for s in sets], np.int64)
        prints = np.array([[mix(s).sum(dtype=np.uint64), mix(s ^ U(0xA5A5A5A5)).sum(dtype=np.uint64)] for s in sets], np.uint64).reshape(-1, 2)
        for a, b in spans_of((sizes + 64).tolist(), AT_ONCE):
            made = mix(super_minhash(sets[a:b], SLOTS))
            bands = made.reshape(b - a, BANDS, ROWS)
            keys = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * U(0x2545F4914F6CDD1D)
            for r in range(ROWS):
                keys = mix(keys ^ bands[:, :, r])
            digit = (made & U(15)).reshape(b - a, DIGESTS, 16) << (np.arange(16, dtype=np.uint64) * U(4))
            digests = np.bitwise_or.reduce(digit, axis=2)
            lists = lambda x, n: pa.ListArray.from_arrays(
                np.arange(0, n * len(x) + 1, n, dtype=np.int32), pa.array(x.reshape(-1).view(np.int64))
            )
            signed = prints[a:b].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(a, b - a),
                    pa.array(sizes[a:b]),
                    pa.array(signed[:, 0].copy()),
                    pa.array(signed[:, 1].copy()),
                    lists(np.ascontiguousarray(keys), BANDS),
                    lists(np.ascontiguousarray(digests), DIGESTS),
                    lists(_parity(sets[a:b]), PARITY // 64),
                ],
                names=["doc_id", "n_shingles", "p1", "p2", "bands", "digests", "parity"],
            )


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ta, tb = batch.column(2), batch.column(3)
        kept = []
        for at, stop in spans_of([1 + len(a.as_buffer() or b"") + len(b.as_buffer() or b"") for a, b in zip(ta, tb, strict=True)], 1 << 24):
            texts = list(dict.fromkeys(ta.slice(at, stop - at).to_pylist() + tb.slice(at, stop - at).to_pylist()))
            sets = dict(zip(texts, shingle_sets(texts), strict=True))
            for i in range(at, stop):
                a, b = sets[ta[i].as_py()], sets[tb[i].as_py()]
                common = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * common >= PERCENT * (len(a) + len(b) - common) and common:
                    kept.append(i)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept, pa.int64())), batch.column(1).take(pa.array(kept, pa.int64()))], names=["a", "b"])


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs that hold on full sets.  Only candidates' texts are moved."""
    needed = pairs.select(F.col("a").alias("_id")).unionByName(pairs.select(F.col("b").alias("_id"))).distinct()
    texts = texts.join(needed, "_id", "left_semi")
    side = lambda x: texts.select(F.col("_id").alias(x), F.col("_text").alias(f"t{x}"))
    full = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ta", "tb")
    return full.mapInArrow(_verified, "a bigint, b bigint").distinct()


def _likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs that the sizes of their sets and their signatures' digests allow to be links."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("digests").alias(f"d{x}"), F.col("parity").alias(f"q{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").filter(_allowed()).select("a", "b")


def _allowed():
    ones = F.lit(0x1111111111111111).cast("bigint")
    differing = F.lit(0)
    for i in range(DIGESTS):
        x = F.col("da")[i].bitwiseXOR(F.col("db")[i])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        differing = differing + F.bit_count(x.bitwiseAND(ones))
    sizes = (100 * F.col("na") >= PERCENT * F.col("nb")) & (100 * F.col("nb") >= PERCENT * F.col("na"))
    odd = F.lit(0)
    for i in range(PARITY // 64):
        odd = odd + F.bit_count(F.col("qa")[i].bitwiseXOR(F.col("qb")[i]))
    # With a similarity of p percent, (100 - p) / (100 + p) of both sizes is what only one set has.
    apart = (100 + PERCENT) * odd <= (100 - PERCENT) * (F.col("na") + F.col("nb"))
    return sizes & apart & (differing <= DIFFERENT)


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the id, ``n_shingles`` (long), ``component_id`` (the smallest id it is tied to)
    and ``kept`` (whether that is its own).

    Shingles are five lower-cased words.  A null or empty text has no shingles and is linked with
    nothing; a text of fewer words has its whole sequence.  Ids are whole numbers; rows that share one are
    one document, linked where any of its texts is.  A null id, or one that is no whole number, is tied to
    nothing, null in the result and kept, its component null.  Other columns are not read.  An empty table gives an empty result.  Nothing
    but counts comes to the driver.
    """
    texts = docs.select(F.col(id_col).try_cast("bigint").alias("_id"), F.col(text_col).alias("_text"))
    signed = reliable(
        texts.mapInArrow(
            _signatures,
            "doc_id bigint, n_shingles bigint, p1 bigint, p2 bigint, bands array<bigint>, digests array<bigint>, parity array<bigint>",
        )
    )
    usable = signed.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    same = ["p1", "p2", "n_shingles"]
    alike = usable.groupBy(same).agg(F.min("doc_id").alias("node"))
    first = alike.select("node", F.col("p1").alias("q1"), F.col("p2").alias("q2"))
    nodes = reliable(
        usable.join(first, (F.col("node") == F.col("doc_id")) & (F.col("q1") == F.col("p1")) & (F.col("q2") == F.col("p2")))
        .dropDuplicates(["node", "p1", "p2"])
        .select("node", F.col("n_shingles").alias("n"), "digests", "parity", "bands")
    )
    texts = texts.filter(F.col("_id").isNotNull() & F.col("_text").isNotNull())
    cells = nodes.select("node", F.posexplode("bands").alias("band", "cell"))
    # A node drawn by a hash of node and cell, so that a group's cells have different leaders.
    drawn = F.min_by("node", F.xxhash64("node", "cell")).alias("leader")
    crowded = cells.groupBy("cell").agg(F.min("node").alias("first"), F.max("node").alias("last"), drawn)
    crowded = crowded.filter(F.col("first") < F.col("last")).select("cell", "leader")
    members = reliable(cells.join(crowded, "cell").select("cell", "band", "leader", "node"))

    # Cells of the first bands: every node with its cell's leader.
    found = members.filter((F.col("band") < FIRST_BANDS) & (F.col("leader") != F.col("node")))
    pair = found.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    links = reliable(_links(reliable(_likely(pair, nodes)), texts))
    tied = components(links)
    # All cells in which nodes of several components are left: every node with every one of another.
    here = members.join(tied, "node", "left").select("cell", "node", F.coalesce("component", "node").alias("component"))
    mixed = here.groupBy("cell").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = mixed.filter(F.col("low") < F.col("high")).select("cell")
    signs = nodes.select("node", "n", "digests", "parity")
    open_ = reliable(here.join(mixed, "cell", "left_semi").join(signs, "node"))
    side = lambda x: open_.select(
        "cell",
        F.col("node").alias(x),
        F.col("n").alias(f"n{x}"),
        F.col("digests").alias(f"d{x}"),
        F.col("parity").alias(f"q{x}"),
        F.col("component").alias(f"c{x}"),
    )
    apart = (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb"))
    pairs = side("a").join(side("b"), "cell").filter(apart & _allowed()).select("a", "b").distinct()
    tied = reliable(components(links.unionByName(_links(reliable(pairs), texts))))

    alike = alike.join(tied, "node", "left").select(*same, F.coalesce("component", "node").alias("component"))
    result = signed.select("doc_id", *same).join(alike, same, "left")
    return result.select(
        F.col("doc_id").alias(id_col),
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component", "doc_id"), F.lit(True)).alias("kept"),
    )


def filtered(docs: DataFrame) -> DataFrame:
    """One document of each group, with all its columns; documents without an id (or with one that is
    no whole number) stay."""
    dropped = group(docs).filter(~F.col("kept")).select("doc_id").distinct()
    work = packed(docs, doc_id=F.col("doc_id").try_cast("bigint")).join(dropped, "doc_id", "left_anti")
    return work.select(*[F.col(f"_in.{quoted(c)}") for c in docs.columns])
