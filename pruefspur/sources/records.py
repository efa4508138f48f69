"""Records with line breaks inside quotes, put together without giving up splits.

Whether a split starts inside a quoted field depends on every split before it, so this takes two
steps.  First each task says for its splits in which state they end, once for a start outside and
once for a start inside quotes; chaining those small rows gives the true start of every split.
Then each task joins the lines of its splits to records.  Only a record that crosses a split
boundary is shuffled, as its pieces; those records are put together once and kept.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import hadoop
from .lines import _runs, joined_lines, without_head

# The starts are broadcast, one small row per split; this many splits are 250 TB.
MAX_SPLITS = 2_000_000
WHOLE, HEAD, MIDDLE, TAIL = range(4)


def ends_inside(line: bytes, inside: bool, sep: bytes) -> bool:
    """Whether a quoted field is still open at the end of a line.  A quote opens a field only as
    its first character; within quotes a doubled quote is text."""
    at = 0
    while True:
        if inside:
            quote = line.find(b'"', at)
            if quote < 0:
                return True
            at = quote + 1
            if line[at : at + 1] == b'"':
                at += 1
                continue
            inside = False
        elif line[at : at + 1] == b'"':
            inside, at = True, at + 1
            continue
        next_sep = line.find(sep, at)
        if next_sep < 0:
            return False
        at = next_sep + 1


def _line_states(values, sep: bytes):
    """``ends_inside`` of an Arrow array of lines, once for a start outside and once for one inside quotes."""
    import numpy as np
    import pyarrow.compute as pc

    outside, inside = np.zeros(len(values), bool), np.ones(len(values), bool)
    quoted = pc.match_substring(values, '"').to_numpy(zero_copy_only=False)
    if not quoted.any():
        return outside, inside
    some = values.filter(quoted)
    if len(sep) == 1 and sep != b'"':
        s = rf"\x{{{sep[0]:02x}}}"
        text, end = r'(?:[^"]|"")*', rf'"(?:[^"{s}][^{s}]*)?'
        later = rf'(?:(?:"{text}{end}|[^"{s}][^{s}]*)?{s})*"{text}\z'
        tests = rf"\A{later}", rf"\A{text}(?:\z|{end}{s}{later})"
        found = [pc.match_substring_regex(some, t).to_numpy(zero_copy_only=False) for t in tests]
    else:
        texts = some.to_pylist()
        found = [[ends_inside(t, start, sep) for t in texts] for start in (False, True)]
    outside[quoted], inside[quoted] = found
    return outside, inside


def _states_after(outside, inside, start: bool):
    """The state after each of consecutive lines: that of the last one that settled it, flipped as often
    as later lines flip it."""
    import numpy as np

    settles = outside == inside
    last = np.maximum.accumulate(np.where(settles, np.arange(len(settles)), -1))
    flips = np.cumsum(outside & ~inside)
    settled = last >= 0
    flipped = flips - np.where(settled, flips[last], 0)
    return np.where(settled, outside[last], start) ^ (flipped % 2 == 1)


def _as_bytes(lines: DataFrame) -> DataFrame:
    return lines.select("path", "block", "more", F.col("value").cast("binary").alias("value"))


class Starts:
    """``frame``: per split, whether it starts inside quotes; ``plain`` marks files that end with a quote
    open, in which quotes are taken not to span lines.  The records that cross splits are found once,
    when they are first asked for."""

    def __init__(self, frame: DataFrame):
        self.frame = frame
        self.splits, crossed = frame.agg(
            F.count(F.lit(1)), F.count_if(F.col("inside") & ~F.col("plain"))
        ).head()
        self.crossed = crossed > 0
        self._crossing: DataFrame | None = None

    @property
    def plain_paths(self) -> DataFrame:
        return self.frame.where("plain").select("path").distinct()

    def crossing(self, pieces: DataFrame) -> DataFrame:
        """Records of more than one split, from their pieces."""
        if self._crossing is None:
            # Within a split the rest of an earlier record comes before the start of the next.
            order = Window.partitionBy("path").orderBy("block", "is_head")
            headed = pieces.withColumn("is_head", F.col("kind") == HEAD)
            numbered = headed.withColumn("record", F.count_if("is_head").over(order))
            listed = F.array_sort(F.collect_list(F.struct("block", "is_head", "value")))
            joined = numbered.groupBy("path", "record").agg(
                F.array_join(F.transform(listed, lambda p: p["value"]), "\n").alias("value")
            )
            self._crossing = hadoop.reliable(joined.select("path", "value"))
        return self._crossing


def split_starts(lines: DataFrame, sep: str, skip: int = 0) -> Starts:
    """The starts of the splits of a line frame behind the first ``skip`` lines of every file."""
    mark = sep.encode()

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        schema = pa.schema(
            [
                ("path", pa.string()),
                ("block", pa.int64()),
                ("from_outside", pa.bool_()),
                ("from_inside", pa.bool_()),
            ]
        )

        def row(key, outside, inside):
            arrays = [pa.array([bool(v) if f.name[:4] == "from" else v], f.type) for v, f in zip((*key, outside, inside), schema)]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        current, outside, inside = None, False, True
        for batch in without_head(batches, skip):
            for path, block, _, start, stop in _runs(batch):
                if (path, block) != current:
                    if current is not None:
                        yield row(current, outside, inside)
                    current, outside, inside = (path, block), False, True
                states = _line_states(batch.column("value").slice(start, stop - start), mark)
                outside, inside = (_states_after(*states, s)[-1] for s in (outside, inside))
        if current is not None:
            yield row(current, outside, inside)

    states = _as_bytes(lines).mapInArrow(
        run, "path string, block bigint, from_outside boolean, from_inside boolean"
    )
    # A split either settles the state, keeps it or flips it.  The state after a split is that of
    # the last one that settled it, flipped as often as later splits flip.
    order = Window.partitionBy("path").orderBy("block")
    settles = F.col("from_outside") == F.col("from_inside")
    flips = F.sum(F.when(~settles & F.col("from_outside"), 1).otherwise(0)).over(order)
    counted = states.withColumn("flips", flips)
    anchor = F.when(settles, (F.col("from_outside").cast("int") + F.col("flips")) % 2)
    anchored = counted.withColumn("anchor", F.last(anchor, ignorenulls=True).over(order))
    after = (F.coalesce("anchor", F.lit(0)) + F.col("flips")) % 2 == 1
    whole_file = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = anchored.withColumn("after", after)
    starts = placed.select(
        "path",
        "block",
        F.coalesce(F.lag("after").over(order), F.lit(False)).alias("inside"),
        F.last("after").over(whole_file).alias("plain"),
    )
    return Starts(hadoop.reliable(starts))


def records(lines: DataFrame, starts: Starts, sep: str, skip: int = 0) -> DataFrame:
    """Records of a line frame as (path, value), given the starts of its splits."""
    if starts.splits > MAX_SPLITS:
        raise ValueError(
            "too many splits to join quoted lines; raise spark.sql.files.maxPartitionBytes"
        )
    mark = sep.encode()

    def run(batches: Iterable, pieces: bool) -> Iterator:
        """The records within splits, or the pieces of the others."""
        import numpy as np
        import pyarrow as pa

        names = ["path", "block", "kind", "value"]
        current, inside, lead, pending = None, False, False, []

        def rows(kind: int, values):
            n = len(values)
            values = values if isinstance(values, pa.Array) else pa.array(values, pa.binary())
            columns = [
                pa.array([current[0]] * n, pa.string()),
                pa.array([current[1]] * n, pa.int64()),
                pa.array([kind] * n, pa.int32()),
                values.cast(pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in without_head(batches, skip):
            starts_inside, plain = batch.column("inside"), batch.column("plain")
            for path, block, _, start, stop in _runs(batch):
                if (path, block) != current:
                    if inside and pieces:
                        yield rows(MIDDLE if lead else HEAD, [b"\n".join(pending)])
                    current, pending = (path, block), []
                    inside = starts_inside[start].as_py()
                    if inside is None:
                        raise ValueError(f"{path} is split differently than when it was checked")
                    lone_lines = plain[start].as_py()
                    inside = inside and not lone_lines
                    lead = inside
                values = batch.column("value").slice(start, stop - start)
                if lone_lines:
                    if not pieces:
                        yield rows(WHOLE, values)
                    continue
                after = _states_after(*_line_states(values, mark), inside)
                first, last, whole = joined_lines(values, np.append(inside, after[:-1]), after, b"\n", not pieces)
                inside = bool(after[-1])
                if first:
                    pending += values.slice(0, first).to_pylist()
                    if first < len(values) or not inside:
                        if lead == pieces:
                            yield rows(TAIL if lead else WHOLE, [b"\n".join(pending)])
                        pending, lead = [], False
                if whole is not None and len(whole):
                    yield rows(WHOLE, whole)
                if last < len(values):
                    pending = values.slice(last).to_pylist()
        if inside and pieces:
            yield rows(MIDDLE if lead else HEAD, [b"\n".join(pending)])

    placed = _as_bytes(lines).join(F.broadcast(starts.frame), ["path", "block"], "left")

    def parts(pieces: bool) -> DataFrame:
        found = placed.mapInArrow(
            lambda batches: run(batches, pieces), "path string, block bigint, kind int, value binary"
        )
        return found.withColumn("value", F.col("value").cast("string"))

    whole = parts(False).select("path", "value")
    return whole.unionByName(starts.crossing(parts(True))) if starts.crossed else whole
