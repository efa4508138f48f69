"""Import results: tables on demand plus a report with one row per table."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import normalised, snake_case

IMPORT_REPORT = "table_name string, row_count bigint, status string"
FILE_REPORT = (
    "table_name string, file_name string, row_count bigint, column_count int, status string"
)
BATCH_REPORT = "table_name string, file_name string, row_count bigint, status string"
ARCHIVE_REPORT = "table_name string, row_count bigint, status string, source_zip string"
EXPORT_REPORT = "table_name string, file_path string, row_count bigint, status string"
CHARSET_REPORT = "table_name string, charset string"
REJECT_REPORT = "table_name string, column_name string, rejected bigint"

TRAVERSAL = "Path traversal detected: path contains '..' components"


class Tables(Mapping):
    """Table name -> DataFrame, each built when it is first asked for."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


class ImportResult:
    """What an import gives: ``tables`` (lazy), ``report``, ``rejects`` and ``charsets`` (what text tables
    were read as)."""

    def __init__(
        self,
        spark: SparkSession,
        tables: dict[str, Callable[[], DataFrame]],
        report: DataFrame,
        rejects: DataFrame | None = None,
        charsets: DataFrame | None = None,
    ):
        self.spark = spark
        self._tables = Tables(tables)
        self.report = report
        self.rejects = (
            rejects if rejects is not None else spark.createDataFrame([], REJECT_REPORT)
        )
        self.charsets = (
            charsets if charsets is not None else spark.createDataFrame([], CHARSET_REPORT)
        )

    @property
    def tables(self) -> Tables:
        return self._tables

    def create_views(self) -> "ImportResult":
        """A temp view per table, replacing views of the same name."""
        for name in self.tables:
            self.tables[name].createOrReplaceTempView("`" + name.replace("`", "``") + "`")
        return self

    def save(self, database: str | None = None, fmt: str = "parquet") -> "ImportResult":
        """Write every table into the catalog, replacing tables of the same name; all or none.

        Each table is first written whole under a name of its own.  Only when all are there do they
        take their places; if one cannot be written, or cannot take its place, the catalog is left
        with the tables it had, and the error is raised as ``SaveFailed`` with the table's name.
        Names that catalogs refuse (other characters than A-Z, digits and ``_``) are normalised like
        column names, and numbered where they collide.
        """
        mark = uuid.uuid4().hex[:8]
        names = list(self.tables)
        plain = dict(zip(names, normalised(self.spark, names, _catalog_name), strict=True))

        def called(name: str, form: str = "") -> str:
            return (f"`{database}`." if database else "") + f"`{plain[name]}{form}`"

        new = {n: called(n, f"__new_{mark}") for n in names}
        old = {n: called(n, f"__old_{mark}") for n in names}
        results = side_by_side(
            self.spark,
            [
                lambda n=n: self.tables[n].write.format(fmt).mode("overwrite").saveAsTable(new[n])
                for n in names
            ],
        )
        steps: list[tuple[str, str]] = []
        try:
            for n, result in zip(names, results, strict=True):
                if isinstance(result, Exception):
                    raise SaveFailed(n) from result
            for n in names:
                moves = [(called(n), old[n])] if self.spark.catalog.tableExists(called(n)) else []
                for move in [*moves, (new[n], called(n))]:
                    try:
                        self._rename(*move)
                    except Exception as error:
                        raise SaveFailed(n) from error
                    steps.append(move)
        except SaveFailed:
            for source, target in reversed(steps):
                self._rename(target, source)
            for n in names:
                self.spark.sql(f"drop table if exists {new[n]}")
            raise
        for n in names:
            self.spark.sql(f"drop table if exists {old[n]}")
        return self

    def _rename(self, source: str, target: str) -> None:
        self.spark.sql(f"alter table {source} rename to {target}")


def _catalog_name(name: Column) -> Column:
    plain = F.when(name.rlike("^[A-Za-z0-9_]+$"), F.lower(name)).otherwise(snake_case(name))
    return F.coalesce(F.nullif(plain, F.lit("")), F.lit("unnamed"))


class SaveFailed(Exception):
    """A table that could not be saved; no table was replaced."""

    def __init__(self, table: str):
        super().__init__(f"table {table} could not be saved, and no table was replaced")
        self.table = table


def side_by_side(spark: SparkSession, tasks: list[Callable]) -> list:
    """Run independent jobs concurrently; results in order.  An exception becomes the result, so
    that one failing table does not stop the others."""

    def guarded(task: Callable):
        try:
            return task()
        except Exception as error:  # noqa: BLE001 - reported per table
            return error

    if len(tasks) <= 1:
        return [guarded(t) for t in tasks]
    with ThreadPoolExecutor(max_workers=min(8, len(tasks))) as pool:
        run = inheritable_thread_target(spark)(guarded)
        return list(pool.map(run, tasks))


MESSAGE_CHARS = 160


def short_message(error: Exception) -> str:
    """The first line of a message, without its end where that could be a row of the data."""
    lines = [line for line in str(error).splitlines() if line.strip()]
    if not lines:
        return type(error).__name__
    return lines[0] if len(lines[0]) <= MESSAGE_CHARS else lines[0][:MESSAGE_CHARS] + "..."


def report_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)
