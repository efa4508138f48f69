"""Mixing sources to target weights by Pfair scheduling.

A source's documents are cut to blocks.  In a phase, block j (from 0) of a source with the share w
may not run before slot floor(j / w) and must have run by slot ceil((j + 1) / w); taking the released
block with the earliest deadline in each slot keeps all deadlines.  The shares are exact fractions
and the slots are counted through the whole phase, so at any point of it a source is less than one
block from its share.  When a source runs out, a phase of the sources left begins; they share on by
their weights.  No document is left out or repeated.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction
from itertools import islice
from math import gcd, isfinite, lcm

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..hadoop import fresh_folder
from .frames import packed, quoted

#: Documents of a block.
BLOCK = 16
#: Documents numbered together: the pieces of a source are about this large.
RANKED = 2_000
#: Pieces of all sources up to which their offsets (40 bytes each) go to every task.
OFFSETS = 100_000
#: Blocks of a source whose slots are one row of the timetable.
RUN = 256
#: Slots (8 bytes each) up to which the timetable goes to every task; a longer one is written in parts
#: of this many and joined by a shuffle.
HELD_SLOTS = 1 << 20


def whole(weights: Mapping[str, float]) -> list[int]:
    """The weights, as their decimals stand, in the smallest whole numbers."""
    exact = [Fraction(str(w)) for w in weights.values()]
    scale = lcm(*[w.denominator for w in exact])
    parts = [int(w * scale) for w in exact]
    return [a // gcd(*parts) for a in parts]


def turns(parts: Sequence[int]) -> Iterator[int]:
    """Without end, the place in ``parts`` of the source that has the next slot: earliest deadline
    first among the released, in whole numbers."""
    total = sum(parts)
    ready = [(-(-total // a), s, 1) for s, a in enumerate(parts)]
    heapq.heapify(ready)
    # Per slot the blocks that are released with it.
    later: dict[int, list[tuple[int, int, int]]] = {}
    slot = 0
    while True:
        for job in later.pop(slot, ()):
            heapq.heappush(ready, job)
        _, s, j = heapq.heappop(ready)
        yield s
        slot += 1
        a = parts[s]
        job = (-(-(j + 1) * total // a), s, j + 1)
        release = j * total // a
        if release <= slot:
            heapq.heappush(ready, job)
        else:
            later.setdefault(release, []).append(job)


def schedule(counts: Mapping[str, int]) -> list[str]:
    """Each source as often as its count, by ``turns``."""
    given = {s: a for s, a in counts.items() if a}
    names = list(given)
    return [names[s] for s in islice(turns(list(given.values())), sum(given.values()))]


@dataclass(frozen=True)
class Phase:
    """Slots shared by the same sources: the first one, the sources, which of them has each slot,
    each source's blocks in the phase, and its first one."""

    first_slot: int
    names: tuple[str, ...]
    order: array
    counts: Mapping[str, int]
    first_block: Mapping[str, int]


def phases(blocks: Mapping[str, int], weights: Mapping[str, float]) -> list[Phase]:
    """Phases until every block has its slot.  A phase ends where the next slot is due to a source
    that has no block left; what lies beyond the last slot at which all shares are whole, where
    there is one, begins a phase of its own, in which the order goes on as it would."""
    made, slot = [], 0
    done = dict.fromkeys(blocks, 0)
    while left := {s: n - done[s] for s, n in sorted(blocks.items()) if n > done[s]}:
        # Sources without a weight wait for all others and then share equally.
        names = tuple(s for s in left if weights[s] > 0) or tuple(left)
        rest = [left[s] for s in names]
        order = array("H" if len(names) <= 1 << 16 else "L")
        parts = whole({s: weights[s] or 1 for s in names})
        for s in islice(turns(parts), sum(rest)):
            if not rest[s]:
                break
            rest[s] -= 1
            order.append(s)
        if len(order) > sum(parts):
            for s in order[len(order) - len(order) % sum(parts) :]:
                rest[s] += 1
            del order[len(order) - len(order) % sum(parts) :]
        counts = {s: left[s] - n for s, n in zip(names, rest, strict=True)}
        made.append(Phase(slot, names, order, counts, dict(done)))
        slot += len(order)
        for s, a in counts.items():
            done[s] += a
    return made


def tempered(counts: Mapping[str, int], power: float = 0.5) -> dict[str, float]:
    """Weights between the sources' own sizes (1) and equal ones (0)."""
    return {s: n**power for s, n in counts.items()}


def _runs(plan: list[Phase]) -> Iterator[tuple[str, int, list[int]]]:
    """Source, number of the run, and the slots of its ``RUN`` blocks; a source's last run is shorter."""
    open_: dict[str, tuple[int, list[int]]] = {}
    for p in plan:
        for at, k in enumerate(p.order, p.first_slot):
            name = p.names[k]
            run, slots = open_.setdefault(name, (0, []))
            slots.append(at)
            if len(slots) == RUN:
                yield name, run, slots
                open_[name] = (run + 1, [])
    for name, (run, slots) in open_.items():
        if slots:
            yield name, run, slots


def _timetable(spark: SparkSession, plan: list[Phase], held: int) -> DataFrame:
    """``_runs`` as a frame: up to ``held`` slots for every task, more of them written in parts."""
    kind = "_name string, _run bigint, _slots array<bigint>"
    runs = _runs(plan)
    if sum(len(p.order) for p in plan) <= held:
        return F.broadcast(spark.createDataFrame(list(runs), kind))
    folder, parts = fresh_folder(spark, "mix"), []
    while rows := list(islice(runs, max(1, held // RUN))):
        parts.append(f"{folder}/{len(parts)}")
        spark.createDataFrame(rows, kind).write.parquet(parts[-1])
    return spark.read.schema(kind).parquet(*parts)


def mix(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    source_col: str = "source",
    id_col: str = "doc_id",
    block: int = BLOCK,
    held: int = HELD_SLOTS,
) -> DataFrame:
    """All documents with their columns and ``mix_slot`` (the block's place in the mix) and
    ``mix_position`` (the document's; unique, with gaps only behind a source's short last block).

    ``weights`` maps sources to target weights; a source it lacks gets the smallest of them above 0, and
    sources of weight 0 follow when all others have run out.  A weight below 0, or not a finite number,
    is a ValueError.  Without weights they are the square roots of the sources' sizes.  A null source is the source
    ``""``.  Documents of a source are taken in the order of a hash of the id, ties by the id itself and then
    by a hash of all columns; repeated rows are documents of their own.  An empty table gives an empty mix.
    The driver holds the sources and two bytes per block (four and more beyond 65,536 sources), never
    rows.
    """
    spark = docs.sparkSession
    name = F.coalesce(F.col(source_col).cast("string"), F.lit(""))
    plain = [quoted(c) for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    tie = F.xxhash64(*plain)
    # Rows without an id would all have one hash and end in one task.
    work = packed(
        docs,
        _name=name,
        _id=F.col(id_col),
        _hash=F.when(F.col(id_col).isNull(), tie).otherwise(F.xxhash64(F.col(id_col).cast("string"))),
        _tie=tie,
    )
    sizes = work.groupBy("_name").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {r["_name"]: r["n"] for r in sizes}
    if not counts:
        return docs.withColumn("mix_slot", F.lit(0).cast("bigint")).withColumn("mix_position", F.lit(0).cast("bigint"))
    goal = dict(weights) if weights else tempered(counts)
    if not all(isfinite(w) and w >= 0 for w in goal.values()):
        raise ValueError("weights are finite numbers from 0 on")
    least = min((w for w in goal.values() if w > 0), default=1)
    goal = {s: goal.get(s, least) for s in counts}
    blocks = {s: -(-n // block) for s, n in counts.items()}
    plan = phases(blocks, goal)
    # A source is numbered in pieces by its hash, and the pieces' sizes are summed up: no task sorts
    # a whole source.
    pieces = max(1, -(-max(counts.values()) // RANKED))
    piece = F.shiftright(F.shiftrightunsigned("_hash", 32) * F.lit(pieces).cast("bigint"), 32)
    work = work.withColumn("_piece", piece)
    before = Window.partitionBy("_name").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        work.groupBy("_name", "_piece")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_name", "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    by = Window.partitionBy("_name", "_piece").orderBy("_hash", "_id", "_tie")
    ranked = work.withColumn("_rank", F.row_number().over(by) - 1).join(
        F.broadcast(offsets) if pieces * len(counts) <= OFFSETS else offsets, ["_name", "_piece"]
    )
    ranked = ranked.withColumn("_rank", (F.col("_rank") + F.col("_offset")).cast("bigint"))
    number = F.floor(F.col("_rank") / block)
    ranked = ranked.withColumn("_run", F.floor(number / RUN).cast("bigint")).withColumn("_turn", (number % RUN).cast("int"))
    placed = ranked.join(_timetable(spark, plan, held), ["_name", "_run"])
    slot = F.get("_slots", F.col("_turn"))
    own = [F.col(f"_in.{quoted(c)}") for c in docs.columns if c.lower() not in ("mix_slot", "mix_position")]
    return placed.withColumn("_slot", slot.cast("bigint")).select(
        *own,
        F.col("_slot").alias("mix_slot"),
        (F.col("_slot") * block + F.col("_rank") % block).cast("bigint").alias("mix_position"),
    )
