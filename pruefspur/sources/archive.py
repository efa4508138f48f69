"""Batches of zipped audit exports.

Archives are read by position, so neither an archive nor an entry is ever held whole: one task
reads the directory of each archive, and each data entry is inflated as a stream by its own task.
All entries with the same column layout form one frame, whatever archive they are in.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import hadoop
from ..functions import charset as cs
from ..functions.names import archive_prefix
from ..operators import checks
from ..operators.report import (
    ARCHIVE_REPORT,
    TRAVERSAL,
    ImportResult,
    Tables,
    report_frame,
    short_message,
    side_by_side,
)
from ..operators.union import stacked
from . import lines as ln
from .audit import TableSpec, check_frame, judged, path_has_traversal, table_spec, typed_frame
from .index_catalog import AUDIT, IndexLayout, has_traversal, index_text, parse_indexes

CHUNK = 1 << 20
# Entries beyond this size have their text spread over tasks before it is parsed.
LARGE_ENTRY = 128 << 20
TASK_BYTES = 64 << 20

DIRECTORY = (
    "archive string, error string, entries array<struct<name:string,size:bigint>>, "
    "index_entry string, index_content binary"
)
# Names with a leading underscore cannot meet a normalised column name.
KEY = ("_archive", "_table")
CHUNKS = "_archive string, _table string, _chunk int, _utf8 boolean, text string"
REJECTED = "array<struct<column_name:string,rejected:bigint>>"


def open_stored(path: str):
    """A seekable stream of a stored file: local paths directly, others through Arrow."""
    scheme, _, rest = path.partition(":")
    if not rest or scheme == "file":
        return open("/" + rest.lstrip("/") if rest else path, "rb")
    from pyarrow import fs

    store, place = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return store.open_input_file(place)


def _entry_name(name: str) -> str:
    return name.replace("\\", "/").rstrip("/")


def directories(spark: SparkSession, path: str, opener: Callable = open_stored) -> DataFrame:
    """One row per archive: its entries and its index, or why it cannot be used.

    One entry that would leave the target folder condemns the whole archive.
    """
    zips = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.[zZ][iI][pP]").load(path)
    ).select("path")

    def run(batches: Iterable) -> Iterator:
        import zipfile

        import pyarrow as pa

        schema = pa.schema(
            [
                ("archive", pa.string()),
                ("error", pa.string()),
                ("entries", pa.list_(pa.struct([("name", pa.string()), ("size", pa.int64())]))),
                ("index_entry", pa.string()),
                ("index_content", pa.binary()),
            ]
        )

        def look(place: str) -> dict:
            row = {"archive": place, "error": None, "entries": [], "index_entry": None}
            try:
                with opener(place) as stream, zipfile.ZipFile(stream) as book:
                    infos = [i for i in book.infolist() if not i.is_dir()]
                    names = [_entry_name(i.filename) for i in infos]
                    for name in names:
                        if ".." in name.split("/"):
                            raise ValueError(f"Zip Slip detected: path contains '..': {name}")
                        if name.startswith("/"):
                            raise ValueError(f"Zip entry has absolute path: {name}")
                    row["entries"] = [
                        {"name": n, "size": i.file_size} for n, i in zip(names, infos)
                    ]
                    for name, info in zip(names, infos):
                        if name == "index.xml" or name.endswith("/index.xml"):
                            row["index_entry"] = name
                            row["index_content"] = book.read(info)
                            break
            except Exception as error:  # noqa: BLE001 - reported per archive
                row["entries"] = []
                row["error"] = str(error) or type(error).__name__
            return row

        for batch in batches:
            for place in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pylist([look(place)], schema=schema)

    return zips.mapInArrow(run, DIRECTORY)


def _zip_name(archive: Column) -> Column:
    return F.regexp_extract(archive, r"([^/]*)$", 1)


def archive_catalog(found: DataFrame, layout: IndexLayout) -> DataFrame:
    """One row per archive and table: final table name, entry, layout; or a status."""
    opened = found.select(
        "archive",
        "error",
        "entries",
        "index_entry",
        F.coalesce(index_text(F.col("index_content")), F.lit("")).alias("index_xml"),
    ).withColumnRenamed("error", "extract_error")
    tables = parse_indexes(opened, layout)
    base = F.regexp_extract("index_entry", r"^(.*/)", 1)
    wanted = F.concat(base, F.replace("url", F.lit("\\"), F.lit("/")))
    place = F.get(F.filter("entries", lambda e: e["name"] == wanted), 0)
    extract = F.col("extract_error")
    status = (
        F.when(extract.isNotNull(), F.concat(F.lit("Extraction failed: "), extract))
        .when(F.col("index_entry").isNull(), "Parse error: no index.xml in archive")
        .when(F.col("error").isNotNull(), F.concat(F.lit("Parse error: "), F.col("error")))
        .when(F.col("table_no").isNull(), "Parse error: index names no table")
        .when(F.size("columns") == 0, "Create failed: no columns declared")
        .when(F.exists("columns", lambda c: c["name"] == ""), "Create failed: a column has no name")
        .when(
            has_traversal(F.col("url")),
            F.concat(F.lit("Path traversal in table URL: "), F.col("url")),
        )
        .when(
            place.isNull(), F.concat(F.lit("Load failed: no data file '"), F.col("url"), F.lit("'"))
        )
    )
    zip_name = _zip_name(F.col("archive"))
    plain = F.when(extract.isNotNull(), "(extract)").otherwise(
        F.concat(
            archive_prefix(zip_name),
            F.lit("_"),
            F.when(
                F.col("table_no").isNull() | F.col("error").isNotNull(), "(schema)"
            ).otherwise(F.col("table_name")),
        )
    )
    rows = tables.select(
        "archive",
        zip_name.alias("source_zip"),
        plain.alias("plain_name"),
        F.col("table_name").alias("source_table"),
        F.coalesce("table_no", F.lit(0)).alias("table_no"),
        status.alias("status"),
        F.when(status.isNull(), place["name"]).alias("entry"),
        F.when(status.isNull(), place["size"]).alias("size"),
        "skip_lines",
        "decimal_symbol",
        "digit_grouping",
        "is_utf8",
        "columns",
    )
    # An index that cannot be used fails once, not once per table.
    faulty = F.col("plain_name").endswith("(schema)") & (F.col("table_no") > 0)
    same_name = Window.partitionBy("plain_name").orderBy("archive", "table_no")
    number = F.row_number().over(same_name)
    return rows.where(~faulty).select(
        "*",
        F.when((number == 1) | F.col("status").isNotNull(), F.col("plain_name"))
        .otherwise(F.concat(F.col("plain_name"), F.lit("_"), number.cast("string")))
        .alias("table_name"),
        F.xxhash64("columns", "decimal_symbol", "digit_grouping", "is_utf8").alias("layout_id"),
    )


def inflate(targets: DataFrame, charset: str | None, opener: Callable) -> DataFrame:
    """Entries as chunks of whole lines, decoded, without their skipped lines.

    The charset is settled before text is given out: the entry is first streamed through a UTF-8
    check, then decoded as UTF-8 or as the fallback.
    """
    fallback = cs.EXPORT_FALLBACK

    def blocks(stream) -> Iterator[bytes]:
        while data := stream.read(CHUNK):
            yield data

    def chosen(book, info) -> str:
        import codecs

        check = codecs.getincrementaldecoder("utf-8")()
        try:
            with book.open(info) as stream:
                for data in blocks(stream):
                    check.decode(data)
                check.decode(b"", True)
        except UnicodeDecodeError:
            return fallback
        return "utf-8"

    def texts(book, info, name: str, skip: int) -> Iterator[str]:
        import codecs

        decoder = codecs.getincrementaldecoder("utf-8-sig" if name == "utf-8" else name)("replace")
        rest, left = "", skip
        with book.open(info) as stream:
            for data in itertools.chain(blocks(stream), [None]):
                rest += decoder.decode(data or b"", data is None)
                # The last line may go on, and a trailing CR may be half of a CR LF.
                cut = (
                    len(rest)
                    if data is None
                    else max(rest.rfind("\n"), rest.rfind("\r", 0, max(len(rest) - 1, 0))) + 1
                )
                whole, rest = rest[:cut], rest[cut:]
                if not whole:
                    continue
                whole = whole.replace("\r\n", "\n").replace("\r", "\n").removesuffix("\n")
                more = True
                while left and more:
                    _, more, whole = whole.partition("\n")
                    left -= 1
                if more:
                    yield whole

    def run(batches: Iterable) -> Iterator:
        import zipfile

        import pyarrow as pa

        schema = pa.schema(
            [
                ("_archive", pa.string()),
                ("_table", pa.string()),
                ("_chunk", pa.int32()),
                ("_utf8", pa.bool_()),
                ("text", pa.string()),
            ]
        )
        for batch in batches:
            for target in batch.to_pylist():
                with opener(target["archive"]) as stream, zipfile.ZipFile(stream) as book:
                    info = next(
                        i for i in book.infolist() if _entry_name(i.filename) == target["entry"]
                    )
                    name = charset or chosen(book, info)
                    for no, text in enumerate(texts(book, info, name, target["skip_lines"])):
                        columns = [target["archive"], target["table_name"], no, name == "utf-8", text]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([v], f.type) for v, f in zip(columns, schema)], schema=schema
                        )

    return targets.select("archive", "table_name", "entry", "skip_lines").mapInArrow(run, CHUNKS)


class ArchiveResult(ImportResult):
    """Tables by prefixed name, and ``combined(name)``: the tables of that name of all archives
    as one frame."""

    def __init__(self, spark, report, rejects, catalog, layouts, layout, charset, opener):
        super().__init__(spark, {}, report, rejects)
        self._usable = catalog.where("usable")
        self._layouts = layouts
        self._layout = layout
        self._charset = charset
        self._opener = opener
        self._listed: Tables | None = None

    @property
    def tables(self) -> Tables:
        if self._listed is None:
            rows = self._usable.select("table_name", "layout_id").collect()
            self._listed = Tables(
                {r["table_name"]: self._builder(r["table_name"], r["layout_id"]) for r in rows}
            )
        return self._listed

    def _typed(self, targets: DataFrame, layout_id: int, tasks: int | None = None, keep=()):
        row = self._layouts[layout_id]
        fields = entry_fields(targets, row, self._charset, self._opener, tasks)
        spec = table_spec(row, "", self._layout)
        if keep:
            fields = fields.withColumns(keep)
        return typed_frame(fields, spec, keep=tuple(keep))

    def _builder(self, name: str, layout_id: int) -> Callable[[], DataFrame]:
        return lambda: self._typed(
            self._usable.where(F.col("table_name") == name), layout_id, tasks=1
        )

    def combined(self, source_table: str) -> DataFrame:
        """All archives' tables of one name in the index, with ``_source_zip``; different layouts
        are matched by column name."""
        chosen = self._usable.where(F.col("source_table") == source_table)
        ids = sorted(r[0] for r in chosen.select("layout_id").distinct().collect())
        if not ids:
            raise KeyError(source_table)
        keep = {"_source_zip": _zip_name(F.col("_archive"))}
        frames = [self._typed(chosen.where(F.col("layout_id") == i), i, keep=keep) for i in ids]
        return stacked(frames)


def entry_fields(
    targets: DataFrame, row: Row, charset: str | None, opener: Callable, tasks: int | None = None
) -> DataFrame:
    """Data lines of entries of one layout as (_archive, _table, _utf8, value, fields).

    Small entries are parsed by the task that inflates them.  The text of a large one is spread
    over tasks first, because inflating cannot be split but parsing can.
    """
    width = len(row["columns"])
    cores = targets.sparkSession.sparkContext.defaultParallelism
    if tasks is None:
        tasks = min(row["entries"], max(2 * cores, row["small_bytes"] // TASK_BYTES + 1))
    small = targets.where(F.col("size") <= LARGE_ENTRY).repartition(max(1, tasks))
    chunks = inflate(small, charset, opener)
    if row["large_entries"]:
        large = targets.where(F.col("size") > LARGE_ENTRY).repartition(row["large_entries"])
        spread = inflate(large, charset, opener).repartition(
            max(cores, row["large_bytes"] // TASK_BYTES + 1), *KEY, "_chunk"
        )
        chunks = chunks.unionByName(spread)
    lines = chunks.select(*KEY, "_utf8", F.explode(F.split("text", "\n")).alias("value"))
    body = ln.without_blank_lines(lines, width)
    line = F.col("value")
    return body.withColumns(
        {"fields": ln.split_fields(line, width), "long_row": ln.surplus(line, width)}
    )


def import_archives(
    spark: SparkSession,
    path: str,
    *,
    column_source: str = "Name",
    on_error: str = "null",
    charset: str | None = None,
    check_keys: bool = True,
    opener: Callable = open_stored,
) -> ArchiveResult | ImportResult:
    """Import every zipped audit export below a folder or glob.

    Tables are called ``<archive>_<table>``.  An archive that cannot be read is reported and does
    not stop the others.  ``opener`` maps a path to a seekable binary stream on the executors.
    """
    layout = AUDIT.with_names_from(column_source)

    def only(name: str, status: str) -> ImportResult:
        return ImportResult(spark, {}, report_frame(spark, [(name, 0, status, "")], ARCHIVE_REPORT))

    if path_has_traversal(path):
        return only("(security)", TRAVERSAL)
    try:
        found = directories(spark, path, opener)
        catalog = hadoop.reliable(archive_catalog(found, layout))
    except Exception as error:  # noqa: BLE001 - reported
        return only("(listing)", f"Failed to list files: {short_message(error)}")

    loadable = catalog.where(F.col("status").isNull())
    is_large = F.col("size") > LARGE_ENTRY
    layouts = {
        r["layout_id"]: r
        for r in loadable.groupBy("layout_id")
        .agg(
            F.any_value("columns").alias("columns"),
            F.any_value("decimal_symbol").alias("decimal_symbol"),
            F.any_value("digit_grouping").alias("digit_grouping"),
            F.any_value("is_utf8").alias("is_utf8"),
            F.lit("").alias("table_name"),
            F.lit(0).alias("skip_lines"),
            F.count(F.lit(1)).alias("entries"),
            F.coalesce(F.sum(F.when(~is_large, F.col("size"))), F.lit(0)).alias("small_bytes"),
            F.coalesce(F.sum(F.when(is_large, F.col("size"))), F.lit(0)).alias("large_bytes"),
            F.count_if(is_large).alias("large_entries"),
        )
        .collect()
    }

    def measure(layout_id: int, row: Row) -> Callable[[], DataFrame]:
        def run() -> DataFrame:
            spec = table_spec(row, "", layout)
            targets = loadable.where(F.col("layout_id") == layout_id)
            fields = entry_fields(targets, row, charset, opener)
            flags = (F.col("_utf8"), ln.odd_quotes(F.col("value")))
            counts = check_frame(fields, spec, flags, by=KEY)
            if check_keys and spec.keys:
                keyed = typed_frame(fields, spec, keep=KEY).select(
                    *KEY, *[F.col(f"`{k}`") for k in spec.keys]
                )
                faults = checks.key_check(keyed, spec.keys, list(KEY))
                counts = counts.join(faults, list(KEY), "left")
            else:
                counts = counts.withColumns({"null_keys": F.lit(0), "surplus_rows": F.lit(0)})
            return hadoop.reliable(_outcome(judged(counts, spec, on_error), spec))

        return run

    pairs = list(layouts.items())
    measured = side_by_side(spark, [measure(i, r) for i, r in pairs])
    outcomes, failures = [], {}
    for (layout_id, _), result in zip(pairs, measured):
        if isinstance(result, Exception):
            failures[layout_id] = f"Load failed: {short_message(result)}"
        else:
            outcomes.append(result)
    schema = (
        "archive string, table_name string, row_count bigint, load_status string, usable boolean, "
        f"rejected {REJECTED}"
    )
    checked = reduce(DataFrame.unionByName, outcomes, spark.createDataFrame([], schema))
    failed = spark.createDataFrame(
        list(failures.items()), "layout_id bigint, failure string"
    )
    judged_catalog = hadoop.reliable(
        catalog.join(checked, ["archive", "table_name"], "left")
        .join(F.broadcast(failed), "layout_id", "left")
        .select(
            *[c for c in catalog.columns if c != "status"],
            F.coalesce("status", "failure", "load_status", F.lit("Empty")).alias("status"),
            F.coalesce("row_count", F.lit(0)).alias("row_count"),
            F.coalesce("usable", F.lit(False)).alias("usable"),
            "rejected",
        )
    )
    report = judged_catalog.select(
        "table_name",
        F.when(F.col("usable"), F.col("row_count")).otherwise(F.lit(0)).alias("row_count"),
        "status",
        "source_zip",
    )
    rejects = judged_catalog.select("table_name", F.inline("rejected"))
    return ArchiveResult(
        spark, report, rejects, judged_catalog, layouts, layout, charset, opener
    )


def _outcome(verdict: DataFrame, spec: TableSpec) -> DataFrame:
    rejected = [
        F.struct(F.lit(c.name).alias("column_name"), F.col(f"x{i}").alias("rejected"))
        for i, c in enumerate(spec.columns)
        if c.type != "string"
    ]
    counted = F.array(*rejected) if rejected else F.array()
    return verdict.select(
        F.col("_archive").alias("archive"),
        F.col("_table").alias("table_name"),
        "row_count",
        F.col("status").alias("load_status"),
        "usable",
        F.filter(counted.cast(REJECTED), lambda r: r["rejected"] > 0).alias("rejected"),
    )
