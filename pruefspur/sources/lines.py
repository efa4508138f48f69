"""Line frames: text files as one row per line, with the raw bytes kept.

A line frame has the columns ``path``, ``block`` (byte offset of the split the line came from),
``more`` (whether the file goes on after that split) and ``value`` (the raw line; its bytes are
untouched).  Scans stay splittable.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import hadoop
from ..functions import charset as cs

QUOTED = {"quote": '"', "escape": '"'}


def plain_path(encoded: Column) -> Column:
    """File metadata columns come percent-encoded; this gives the path as listed."""
    decoded = F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(encoded, F.lit("%")), decoded).otherwise(encoded)


#: Bytes of splits that one task reads at least, where splits are set to be small.
LEAST_TASK_BYTES = 16 << 20


def text_lines(
    spark: SparkSession, paths: list[str], charset: str | None = None, cuts: Cuts | None = None
) -> DataFrame:
    """Lines with their bytes untouched; those of a wide charset are split where it ends lines, and
    come as text.  ``cuts`` are those of the same files, if known."""
    if not cs.is_wide(charset):
        return _scanned(spark, paths, None)
    cuts = Cuts(spark, paths, charset) if cuts is None else cuts
    raw = cuts.whole_characters()
    # Half a character at the end of a file is none.
    even = F.substring(F.col("value"), F.lit(1), F.octet_length("value") - F.octet_length("value") % 2)
    return raw.withColumn("value", cs.wide_text(even, charset))


def _scanned(spark: SparkSession, paths: list[str], line_end: str | None) -> DataFrame:
    return spark.read.options(**({"lineSep": line_end} if line_end else {})).text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        continues().alias("more"),
        F.col("_metadata.file_name").alias("file_name"),
        "value",
    )


def _fewer_tasks(lines: DataFrame) -> DataFrame:
    """A scan of very many small splits in tasks that read several of them, one after the other."""
    spark = lines.sparkSession
    splits = lines.rdd.getNumPartitions()
    bound = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")
    )
    least = max(-(-splits * bound // LEAST_TASK_BYTES), 2 * spark.sparkContext.defaultParallelism)
    return lines.coalesce(least) if least < splits else lines


_LINE, _HEAD, _REST = range(3)


class Cuts:
    """Where lines of a wide charset were cut inside a character, found once for several readings.

    Two characters may meet so that a line seems to end between their halves.  A cut leaves an odd piece,
    and the next odd piece ends the line.  So a split begins inside a line where the splits before it hold
    an odd number of odd pieces: one small row per split says so to every task.  Only lines that cross a
    split are shuffled; they count to the split they end in.
    """

    def __init__(self, spark: SparkSession, paths: list[str], charset: str):
        self._line_end = "\n\0" if cs.canonical(charset) == "utf-16-le" else "\0\n"
        lines = _scanned(spark, paths, self._line_end)
        self._raw = _fewer_tasks(lines.withColumn("value", F.col("value").cast("binary")))
        order = Window.partitionBy("path").orderBy("block")
        odd = F.count_if(F.octet_length("value") % 2 == 1).alias("odd")
        before = F.sum("odd").over(order.rowsBetween(Window.unboundedPreceding, -1))
        counted = self._raw.groupBy("path", "block").agg(odd)
        self._starts = hadoop.reliable(
            counted.select("path", "block", "odd", (F.coalesce(before, F.lit(0)) % 2 == 1).alias("inside"))
        )
        goes_on = F.col("inside") | (F.col("odd") % 2 == 1)
        self._cut, self._crossed = self._starts.agg(F.count_if(F.col("odd") > 0) > 0, F.count_if(goes_on) > 0).head()
        self._crossing = hadoop.reliable(self._put_together()) if self._crossed else None

    def whole_characters(self) -> DataFrame:
        """The lines as they are, each in one piece."""
        if not self._cut:
            return self._raw
        whole = self._parts(False).select(*self._raw.columns)
        return whole.unionByName(self._crossing) if self._crossed else whole

    def _parts(self, pieces: bool) -> DataFrame:
        """The lines within splits, or the pieces of the others."""
        columns = self._raw.columns
        names = [*columns, "kind"]
        line_end = self._line_end.encode()

        def run(batches: Iterable) -> Iterator:
            import numpy as np
            import pyarrow as pa
            import pyarrow.compute as pc

            def rows(place, values, kind):
                n = len(values)
                values = values if isinstance(values, pa.Array) else pa.array(values, pa.binary())
                fixed = place.take(pa.array(np.zeros(n, np.int64))).columns[:4]
                kinds = pa.array([kind] * n, pa.int32())
                return pa.RecordBatch.from_arrays([*fixed, values.cast(pa.binary()), kinds], names=names)

            current, place, pending, lead, inside = None, None, [], False, False
            for batch in batches:
                starts_inside, lines = batch.column("inside"), batch.select(columns)
                for path, block, _, start, stop in _runs(batch):
                    if (path, block) != current:
                        if inside and pieces:
                            yield rows(place, [line_end.join(pending)], _REST if lead else _HEAD)
                        current, pending, place = (path, block), [], lines.slice(start, 1)
                        lead = inside = starts_inside[start].as_py()
                    values = lines.column("value").slice(start, stop - start)
                    odd = pc.binary_length(values).to_numpy(zero_copy_only=False) % 2 == 1
                    after = (np.cumsum(odd) + inside) % 2 == 1
                    first, last, whole = joined_lines(values, np.append(inside, after[:-1]), after, line_end, not pieces)
                    inside = bool(after[-1])
                    if first:
                        pending += values.slice(0, first).to_pylist()
                        if first < len(values) or not inside:
                            if lead == pieces:
                                yield rows(place, [line_end.join(pending)], _REST if lead else _LINE)
                            pending, lead = [], False
                    if whole is not None and len(whole):
                        yield rows(place, whole, _LINE)
                    if last < len(values):
                        pending = values.slice(last).to_pylist()
            # A line cut at the very end of a file has no other piece.
            if inside and pieces:
                yield rows(place, [line_end.join(pending)], _REST if lead else _HEAD)

        kinds = ", ".join(f"{n} {t}" for n, t in self._raw.dtypes)
        placed = self._raw.join(F.broadcast(self._starts.drop("odd")), ["path", "block"])
        return placed.select(*columns, "inside").mapInArrow(run, f"{kinds}, kind int")

    def _put_together(self) -> DataFrame:
        columns, line_end = self._raw.columns, self._line_end.encode()
        pieces = self._parts(True).withColumn("first", F.col("kind") == _HEAD)
        # Within a split the rest of an earlier line comes before the head of the next.
        order = Window.partitionBy("path").orderBy("block", "first")
        numbered = pieces.withColumn("line", F.count_if("first").over(order))
        listed = F.array_sort(F.collect_list(F.struct("block", "first", "value")))
        joined = F.reduce(
            listed,
            F.lit(None).cast("binary"),
            lambda text, p: F.when(text.isNull(), p["value"]).otherwise(F.concat(text, F.lit(line_end), p["value"])),
        )
        crossing = numbered.groupBy("path", "line").agg(
            F.max("block").alias("block"), F.max("more").alias("more"), F.max("file_name").alias("file_name"), joined.alias("value")
        )
        return crossing.select(*columns)


def _all_bytes(values):
    """The bytes of an Arrow array of lines, as they lie one after the other."""
    import numpy as np
    import pyarrow as pa

    filled = values.drop_null().cast(pa.binary())
    if not len(filled):
        return b""
    _, offsets, data = filled.buffers()
    ends = np.frombuffer(offsets, np.int32)[filled.offset : filled.offset + len(filled) + 1]
    return memoryview(data)[int(ends[0]) : int(ends[-1])] if data is not None else b""


def charset_scores(values, charsets: Sequence[str]) -> list[int]:
    """How well each charset fits an Arrow array of raw lines: a histogram of their bytes, weighed."""
    import numpy as np

    seen = np.bincount(np.frombuffer(_all_bytes(values), np.uint8), minlength=256)[128:]
    return [int(seen @ np.array(cs.byte_weights(c))) for c in charsets]


def charset_of(lines: DataFrame, charsets: tuple[str, ...]) -> DataFrame:
    """The likeliest charset of all lines that are not UTF-8, in one row; each task sums up its own."""
    odd = lines.select(F.col("value").cast("binary").alias("value")).where(~F.is_valid_utf8("value"))

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        total = [0] * len(charsets)
        for batch in batches:
            total = [a + b for a, b in zip(total, charset_scores(batch.column(0), charsets))]
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.int64()))], names=["scores"])

    scored = odd.mapInArrow(run, "scores array<bigint>")
    summed = F.array(*[F.sum(F.get("scores", F.lit(i))) for i in range(len(charsets))])
    return scored.agg(summed.alias("scores")).select(cs.likeliest(F.col("scores"), charsets).alias("charset"))


def continues() -> Column:
    """Whether the file of a row goes on after the row's split."""
    split_end = F.col("_metadata.file_block_start") + F.col("_metadata.file_block_length")
    return split_end < F.col("_metadata.file_size")


def _short_head(path: str, count: int) -> ValueError:
    return ValueError(
        f"the first {count} lines of {path} reach beyond its first split; "
        "raise spark.sql.files.maxPartitionBytes"
    )


def _runs(batch):
    """Row ranges of a batch that stem from one split, as (path, block, more, start, stop)."""
    import numpy as np

    path = batch.column("path").dictionary_encode()
    block = batch.column("block").to_numpy(zero_copy_only=False)
    code = path.indices.to_numpy(zero_copy_only=False)
    cut = np.flatnonzero((np.diff(code) != 0) | (np.diff(block) != 0)) + 1
    bounds = [0, *cut.tolist(), batch.num_rows]
    names = path.dictionary
    more = batch.column("more")
    for start, stop in zip(bounds, bounds[1:]):
        if stop > start:
            place = names[int(code[start])].as_py()
            yield place, int(block[start]), more[start].as_py(), start, stop


def without_head(batches: Iterable, count: int) -> Iterator:
    """The batches of a task without the first ``count`` lines of every file."""
    import numpy as np
    import pyarrow as pa

    current, left, open_end = None, 0, False
    for batch in batches:
        keep = np.ones(batch.num_rows, dtype=bool)
        for path, block, more, start, stop in _runs(batch) if count > 0 else ():
            if (path, block) != current:
                if left and open_end:
                    raise _short_head(current[0], count)
                current, left = (path, block), count if block == 0 else 0
                open_end = more
            dropped = min(left, stop - start)
            keep[start : start + dropped] = False
            left -= dropped
        yield batch if keep.all() else batch.filter(pa.array(keep))
    if left and open_end:
        raise _short_head(current[0], count)


def joined_lines(values, before, after, glue: bytes, whole: bool = True):
    """Consecutive lines put together, given whether each goes on from the line before it and whether it
    goes on in the next: the number of lines that belong to what began earlier, the place from which on
    lines belong to what ends later, and (if ``whole``) what lies between, an array of joined lines."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    n = len(values)
    firsts = np.flatnonzero(~before)
    if not len(firsts):
        return n, n, None
    first, last = int(firsts[0]), int(firsts[-1]) if after[-1] else n
    if not whole:
        return first, last, None
    ends = np.append(firsts[firsts < last], last) - first
    between = values.slice(first, last - first)
    if len(ends) - 1 < last - first:
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), between.cast(pa.binary()))
        between = pc.binary_join(lists, glue)
    return first, last, between


def drop_head(lines: DataFrame, count: int) -> DataFrame:
    """Drop the first ``count`` lines of every file.

    A task reads each of its splits in order, so the head of a file is the start of the run of
    rows with block 0.  Rows pass through as Arrow batches; there is no join and no second scan.
    A head that does not end within the first split (128 MB by default) is an error.
    """
    if count <= 0:
        return lines

    def run(batches: Iterable) -> Iterator:
        yield from without_head(batches, count)

    if "value" not in lines.columns:
        return lines.mapInArrow(run, lines.schema)
    # Raw lines need not be valid text, so they travel as bytes.
    as_bytes = lines.withColumn("value", F.col("value").cast("binary"))
    kept = as_bytes.mapInArrow(run, as_bytes.schema)
    return kept.withColumn("value", F.col("value").cast("string"))


def odd_quotes(value: Column) -> Column:
    """True where a line holds an odd number of quotes: a quoted line break or a stray quote."""
    return (F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))) % 2 == 1


def valid_utf8(value: Column) -> Column:
    return F.is_valid_utf8(value.cast("binary"))


#: Separator counts that have a bin of their own, and bins that the higher ones share.
PLAIN_COUNTS, SHARED_COUNTS = 192, 64


def count_bin(n: Column) -> Column:
    """The bin of a line's number of separators."""
    return F.when(n < PLAIN_COUNTS, n).otherwise(PLAIN_COUNTS + n % SHARED_COUNTS).cast("int")


def outside_quotes(value: Column) -> Column:
    """A line without its quoted parts."""
    return F.when(F.contains(value, F.lit('"')), F.regexp_replace(value, '"[^"]*+("|$)', "")).otherwise(value)


def profile(
    lines: DataFrame,
    head: int,
    required: int = 0,
    charsets: tuple[str, ...] = cs.EXPORT_CHARSETS,
    seps: tuple[str, ...] = (),
) -> DataFrame:
    """One row per file in a single scan: its first lines, the number of lines, of blank lines and
    of lines with an odd number of quotes, whether every line is valid UTF-8, the ``charset`` its
    bytes point to, and in ``widths`` how many lines have how many of each separator outside quotes
    (separator, bin of the count, lines).

    Each task emits one row per split; only those are shuffled.  Of the head, ``required`` lines
    must lie within the first split of a file.
    """
    utf8 = valid_utf8(F.col("value"))
    bare = outside_quotes(F.col("value"))
    flagged = lines.select(
        "path",
        "block",
        "more",
        # Only first splits can hold a head, and only bytes that are not UTF-8 are weighed.
        F.when((F.col("block") == 0) | ~utf8, F.col("value").cast("binary")).alias("value"),
        utf8.alias("utf8"),
        odd_quotes(F.col("value")).alias("odd"),
        (F.length("value") == 0).alias("blank"),
        *[count_bin(separators(bare, s)).alias(f"n{i}") for i, s in enumerate(seps)],
    )

    def run(batches: Iterable) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        width = pa.struct([("sep", pa.int32()), ("bin", pa.int32()), ("n", pa.int64())])
        schema = pa.schema(
            [
                ("path", pa.string()),
                ("head", pa.list_(pa.binary())),
                ("lines", pa.int64()),
                ("utf8", pa.bool_()),
                ("odd", pa.int64()),
                ("blank", pa.int64()),
                ("scores", pa.list_(pa.int64())),
                ("widths", pa.list_(width)),
            ]
        )

        def row(s):
            bins = s.pop("bins")
            s["widths"] = [
                {"sep": int(i), "bin": int(b), "n": int(bins[i, b])} for i, b in zip(*np.nonzero(bins))
            ]
            return pa.RecordBatch.from_pylist([s], schema=schema)

        current, state, open_head = None, None, False

        def finished():
            if open_head and len(state["head"]) < required:
                raise _short_head(current[0], required)
            return row(state)

        for batch in batches:
            for path, block, more, start, stop in _runs(batch):
                if (path, block) != current:
                    if state is not None:
                        yield finished()
                    current, open_head = (path, block), block == 0 and more
                    state = dict(
                        path=path, head=[], lines=0, utf8=True, odd=0, blank=0,
                        scores=[0] * len(charsets),
                        bins=np.zeros((len(seps), PLAIN_COUNTS + SHARED_COUNTS), np.int64),
                    )
                part = batch.slice(start, stop - start)
                if block == 0 and len(state["head"]) < head:
                    wanted = part.column("value").slice(0, head - len(state["head"]))
                    state["head"] += wanted.to_pylist()
                state["lines"] += part.num_rows
                if not pc.all(part.column("utf8")).as_py():
                    state["utf8"] = False
                    odd = part.column("value").filter(pc.invert(part.column("utf8")))
                    added = charset_scores(odd, charsets)
                    state["scores"] = [a + b for a, b in zip(state["scores"], added)]
                for i in range(len(seps)):
                    state["bins"][i] += np.bincount(
                        part.column(f"n{i}").to_numpy(zero_copy_only=False),
                        minlength=state["bins"].shape[1],
                    )
                for flag in ("odd", "blank"):
                    state[flag] += pc.sum(part.column(flag).cast(pa.int64())).as_py() or 0
        if state is not None:
            yield finished()

    partial = flagged.mapInArrow(
        run,
        "path string, head array<binary>, lines bigint, utf8 boolean, odd bigint, blank bigint, "
        "scores array<bigint>, widths array<struct<sep: int, bin: int, n: bigint>>",
    )
    if seps:
        partial = hadoop.reliable(partial)  # a row per split, summed up twice
    per_file = partial.groupBy("path").agg(
        F.max("head").alias("head"),
        F.sum("lines").alias("lines"),
        F.bool_and("utf8").alias("utf8"),
        F.sum("odd").alias("odd_quotes"),
        F.sum("blank").alias("blank_lines"),
        F.array(*[F.sum(F.get("scores", F.lit(i))) for i in range(len(charsets))]).alias("_scores"),
    )
    if seps:
        bins = partial.select("path", F.inline("widths")).groupBy("path", "sep", "bin")
        # As many as there are bins, whatever the size of the file.
        listed = F.collect_list(F.struct("sep", "bin", "n")).alias("widths")
        widths = bins.agg(F.sum("n").alias("n")).groupBy("path").agg(listed)
        per_file = per_file.join(widths, "path", "left")
    told = F.when(F.col("utf8"), "utf-8").otherwise(cs.likeliest(F.col("_scores"), charsets))
    return per_file.withColumns({"path": plain_path(F.col("path")), "charset": told}).drop("_scores")


def profiles(
    spark: SparkSession,
    paths: list[str],
    head: int,
    required: int = 0,
    charsets: tuple[str, ...] = cs.EXPORT_CHARSETS,
    seps: tuple[str, ...] = (),
    charset: str | None = None,
) -> DataFrame:
    """``profile`` of files in any charset, with their heads as text.  Files of a wide charset show in
    their first bytes; only they are read once more, by the lines that they really have."""

    def texts(found: DataFrame, known: str | None) -> DataFrame:
        named = found.withColumn("charset", F.lit(known)) if known else found
        read = "utf-8" if cs.is_wide(known) else None
        line = lambda raw: cs.chosen_text(raw, F.lit(read) if read else F.col("charset"), charsets)
        if known and not cs.is_wide(known):
            line = lambda raw: cs.decoded(raw, known)
        return named.withColumn("head", F.transform("head", line))

    def of(names: list[str], wide: str | None) -> DataFrame:
        return profile(text_lines(spark, names, wide), head, required, charsets, seps)

    if charset:
        return texts(of(paths, charset), charset)
    found = hadoop.reliable(of(paths, None))

    def orders(frames: Iterable) -> Iterator:
        for frame in frames:
            told = [cs.wide_order(bytes(h[0])) if len(h) else None for h in frame["head"]]
            yield frame.assign(wide=told)[["path", "wide"]]

    wide = found.select("path", "head").mapInPandas(orders, "path string, wide string")
    marked = {r["path"]: r["wide"] for r in wide.where("wide is not null").collect()}
    result = texts(found if not marked else found.where(~F.col("path").isin(*marked)), None)
    for order in cs.WIDE:
        own = [hadoop.literal(p) for p, o in marked.items() if o == order]
        if own:
            result = result.unionByName(texts(of(own, order), order))
    return result


def raw_names(width: int) -> list[str]:
    return [f"_f{i}" for i in range(width)]


#: Fields beyond the declared ones up to which a line is parsed as it is.
SPARE_FIELDS = 1000


def split_fields(
    value: Column, width: int, sep: str = ";", options: dict[str, str] | None = None
) -> Column:
    """A line as a struct of ``width`` text fields and one spare.

    Short lines are padded with NULL, empty and ``""`` fields are NULL, spaces are kept.  The
    spare is not NULL where the first field beyond the declared ones holds something; see
    ``surplus`` for all of them.  A line of very many fields is cut behind the declared ones before
    it is parsed, so that no line can exceed the parser's bound.
    """
    schema = ", ".join(f"{n} string" for n in [*raw_names(width), "_spare"])
    most = width + SPARE_FIELDS
    quote = (options or QUOTED)["quote"]
    return F.from_csv(
        F.when(separators(value, sep) < most, value).otherwise(_cut(value, width, sep, quote)),
        schema,
        {"sep": sep, **(QUOTED if options is None else options), "maxColumns": str(most + 1)},
    )


def separators(value: Column, sep: str) -> Column:
    return F.length(value) - F.length(F.replace(value, F.lit(sep), F.lit("")))


def _cut(value: Column, width: int, sep: str, quote: str = '"') -> Column:
    """The first ``width`` fields of a line and their separators."""
    mark = re.escape(sep)
    if not quote:
        return F.regexp_extract(value, rf"(?s)^(?:[^{mark}]*+{mark}){{{width}}}", 0)
    q = re.escape(quote)
    field = rf"(?:{q}[^{q}]*+(?:{q}{q}[^{q}]*+)*+{q}[^{mark}]*+|[^{mark}]*+)"
    return F.regexp_extract(value, rf"(?s)^(?:{field}{mark}){{{width}}}", 0)


def surplus(value: Column, width: int, sep: str = ";", quote: str = '"') -> Column:
    """True where a line holds something in a field beyond the declared ones.  Separators at its
    end with nothing behind them are no surplus."""
    mark, bare = re.escape(sep), value
    if quote:
        # Fields that are a pair of quotes are emptied; other doubled quotes become a letter, which
        # leaves the quotes that open and close a field, and no separators between them.
        q = re.escape(quote)
        bare = F.regexp_replace(value, f"(^|{mark}){q}{q}(?={mark}|$)", "$1")
        bare = F.regexp_replace(F.replace(bare, F.lit(quote * 2), F.lit("q")), f"{q}[^{q}]*+{q}", "x")
    fields = F.split(bare, mark)
    beyond = F.slice(fields, F.lit(width + 1), F.greatest(F.size(fields) - width, F.lit(0)))
    filled = F.exists(beyond, lambda f: F.rtrim(f, F.lit("\r")) != "")
    return F.when(separators(value, sep) >= width, filled).otherwise(F.lit(False))


def without_blank_lines(lines: DataFrame, width: int) -> DataFrame:
    """Blank lines carry no row, save in one-column data where they are a NULL value."""
    return lines.where(F.length("value") > 0) if width > 1 else lines


def only_whole_rows(fields: DataFrame) -> DataFrame:
    """Drop the rows that had more fields than declared (opt-in, last resort)."""
    return fields.where(~F.col("long_row"))
