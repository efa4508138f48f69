"""Benchmark decontamination with spaced seeds.

A seed is a few words at the fixed places of a mask; the words at its ignored places may differ.
With the mask 11011 every overlap has a seed, wherever its substitutions stand: words that no seed
fits lie in runs of four at most, of which no two neighbours have two words each, and so many
substitutions no overlap has (the tests go through all patterns).  Test and training hashes are
joined, and along the diagonal of a hit the words of both are compared at every window whose stretch
can hold the hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import once, packed

#: Words of a window.
SPAN = 12
#: The places of a seed that are hashed, of ``SEED`` words in a row.
MASK = (0, 1, 3, 4)
SEED = MASK[-1] + 1
#: Words compared to the left and to the right of a window.
REACH = 12
#: Seeds that hit one after the other are looked at from the first one, and from each whose place in the
#: item is a multiple of this.
STEP = 16
#: The windows looked at from a seed: from the one whose stretch ends with the seed to the last one
#: whose stretch begins before the next seed that is looked at.
FIRST, LAST = SEED - SPAN - REACH, REACH + STEP - 1
#: A window is an overlap when it has at most this many substituted words,
SUBSTITUTED = 1
#: or when the compared stretch has at least this many words of which this share (percent) agree.
STRETCH, SHARE = 20, 80
#: Seeds sent to every task at once.  A seed row is under 2 kB, so this bounds a broadcast to tens
#: of megabytes; a larger benchmark goes through in several blocks, each against all documents.
BLOCK = 20_000


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _key(at: Column) -> Column:
    return F.xxhash64(*[F.get("_hashes", at + k) for k in MASK])


def _before_seed(at: Column) -> Column:
    """The words which, if they agree too, make the seed before this one hit; null for the first."""
    new = [k - 1 for k in MASK if k - 1 not in MASK]
    return F.when(at > 0, F.xxhash64(*[F.get("_hashes", at + k) for k in new]))


def _hashed(df: DataFrame) -> DataFrame:
    df = once(df, _words=_words(F.col("_text"))).drop("_text")
    return once(df, _hashes=F.transform("_words", lambda w: F.xxhash64(w)))


def seeds(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The seeds of the items, with the item's words around each.  Items under ``SPAN`` words have
    none: they are too short to tell a leak from common speech."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("_text"))
    df = _hashed(items).filter(F.size("_hashes") >= SPAN)
    df = df.select("*", F.explode(F.sequence(F.lit(0), F.size("_hashes") - SEED)).alias("_pos"))
    before = F.least(F.col("_pos"), F.lit(REACH - FIRST))
    return df.select(
        _key(F.col("_pos")).alias("_key"),
        "item",
        F.col("_pos").alias("item_pos"),
        _before_seed(F.col("_pos")).alias("_last"),
        before.alias("before"),
        F.slice("_words", F.col("_pos") - before + 1, before + LAST + SPAN + REACH).alias("around"),
    )


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    item_col: str = "item_id",
    item_text: str = "text",
    text_col: str = "text",
    carry: dict[str, Column] | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """A row per input row, with the carried columns, and in ``leaks`` its verified overlaps: item,
    place in the item and in the document, and the agreeing words.

    A null or empty text, and one under ``SPAN`` words, has none.  Null or repeated items count as
    items.  An empty benchmark finds nothing.  Repeated documents are judged each for itself.  The
    documents are read once per block of seeds and are not shuffled before the hits are verified.
    """
    known = seeds(benchmark, item_col, item_text)
    blocks = max(1, -(-known.count() // block))
    return _overlaps(docs, known, blocks, text_col, carry)


def _overlaps(docs, known, blocks, text_col, carry) -> DataFrame:
    work = docs.select(F.struct(*[c.alias(n) for n, c in (carry or {}).items()]).alias("_in"), F.monotonically_increasing_id().alias("_row"), F.col(text_col).alias("_text"))
    found = None
    for b in range(blocks):
        part = known if blocks == 1 else known.filter(F.pmod(F.xxhash64("item", "item_pos"), F.lit(blocks)) == b)
        hits = _hits(work, part, anchors=b == 0)
        found = hits if found is None else found.unionByName(hits)
    return found.groupBy("_row").agg(
        F.first("_in", ignorenulls=True).alias("_in"),
        F.collect_set("leak").alias("leaks"),
    )


#: The key of a document's own row; such a row is told from a hit by its place.
ANCHOR = 0


def _hits(work: DataFrame, part: DataFrame, anchors: bool) -> DataFrame:
    """Verified hits, and with ``anchors`` one row per document that has no leak in it."""
    last = F.when(F.size("_hashes") >= SPAN, F.size("_hashes") - SEED).otherwise(-1)
    df = _hashed(work)
    if anchors:
        # Place -1 stands for the document itself.  An inner join drops what hit nothing before any
        # row with its words is written out.
        df = df.select("*", F.explode(F.sequence(F.lit(-1), last)).alias("_pos"))
        key = F.when(F.col("_pos") < 0, F.lit(ANCHOR).cast("bigint")).otherwise(_key(F.col("_pos")))
        own = part.sparkSession.range(1, numPartitions=1).select(F.lit(ANCHOR).cast("bigint").alias("_key"))
        part = part.withColumn("_own", F.lit(False)).unionByName(
            own.withColumn("_own", F.lit(True)), allowMissingColumns=True
        )
    else:
        df = df.filter(last >= 0).select("*", F.explode(F.sequence(F.lit(0), last)).alias("_pos"))
        key = _key(F.col("_pos"))
        part = part.withColumn("_own", F.lit(False))
    df = df.select("*", F.explode(F.array(key)).alias("_key"))
    part = part.withColumnRenamed("_key", "_seed")
    here = F.col("_pos") >= 0
    head = (
        (F.col("_pos") == 0)
        | F.col("_last").isNull()
        | (F.col("_last") != _before_seed(F.col("_pos")))
        | (F.col("item_pos") % STEP == 0)
    )
    joined = df.join(
        F.broadcast(part), (F.col("_key") == F.col("_seed")) & ((here & ~F.col("_own") & head) | (~here & F.col("_own")))
    )
    start = F.greatest(F.col("_pos") - F.col("before"), F.lit(0))
    # Where the document begins later than the item, the item's words before that have no partner.
    skip = F.col("before") - (F.col("_pos") - start)
    theirs = F.slice("around", skip + 1, F.greatest(F.size("around") - skip, F.lit(0)))
    ours = F.slice("_words", start + 1, F.size("around"))
    agree = lambda xs: F.size(F.filter(xs, lambda x: x))
    hits = joined.select(
        "_row",
        F.when(F.col("_own"), F.col("_in")).alias("_in"),
        "_own",
        "item",
        "item_pos",
        F.col("_pos").alias("doc_pos"),
        (F.col("before") - skip).alias("_left"),
        theirs.alias("_theirs"),
        ours.alias("_ours"),
    )
    # The generator keeps the lambda out of the join's own condition, where it would end code
    # generation and every seed would be written out with its document's words.
    pairs = F.arrays_zip(F.col("_theirs").alias("a"), F.col("_ours").alias("b"))
    same = F.transform(pairs, lambda p: F.coalesce(p["a"] == p["b"], F.lit(False)))
    compared = F.least(F.size("_theirs"), F.size("_ours"))
    hits = once(hits, _same=F.when(~F.col("_own"), F.slice(same, F.lit(1), compared)))
    first = F.greatest(F.col("_left") + FIRST, F.lit(0))
    last = F.least(F.col("_left") + LAST, F.size("_same") - SPAN)

    def window(at: Column) -> Column:
        before = F.least(at, F.lit(REACH))
        stretch = F.slice("_same", at - before + 1, before + SPAN + REACH)
        return F.struct(
            (at - F.col("_left")).alias("by"),
            agree(F.slice("_same", at + 1, F.lit(SPAN))).alias("inside"),
            agree(stretch).alias("total"),
            F.size(stretch).alias("n"),
        )

    places = F.when(last >= first, F.sequence(first, last))
    hits = once(hits, _windows=F.when(~F.col("_own"), F.transform(places, window)))
    overlap = lambda w: (w["inside"] >= SPAN - SUBSTITUTED) | ((w["n"] >= STRETCH) & (100 * w["total"] >= SHARE * w["n"]))
    leaks = F.transform(
        F.filter("_windows", overlap),
        lambda w: F.struct(
            F.col("item"),
            (F.col("item_pos") + w["by"]).alias("item_pos"),
            (F.col("doc_pos") + w["by"]).alias("doc_pos"),
            w["total"].alias("agree"),
        ),
    )
    hits = once(hits, _leaks=leaks)
    return hits.filter(F.col("_own") | (F.size("_leaks") > 0)).select("_row", "_in", F.explode_outer("_leaks").alias("leak"))


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """Per document: whether it is contaminated, the overlapped items, and the first place."""
    found = overlaps(docs, benchmark, carry={"id": F.col(id_col)}, block=block)
    return found.select(
        F.col("_in.id").alias(id_col),
        (F.size("leaks") > 0).alias("contaminated"),
        F.sort_array(F.array_distinct(F.transform("leaks", lambda x: x["item"]))).alias("items"),
        F.array_min(F.transform("leaks", lambda x: x["doc_pos"])).cast("bigint").alias("first_word"),
        F.size("leaks").cast("bigint").alias("n_hits"),
    )


def filtered(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """The documents without an overlap, with all their columns."""
    row = packed(docs, _text=F.col("text"))
    found = overlaps(row, benchmark, text_col="_text", carry={"row": F.col("_in")}, block=block)
    return found.filter(F.size("leaks") == 0).select("_in.row.*")
