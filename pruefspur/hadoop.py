"""Small metadata operations on the cluster's file system, through Hadoop's FileSystem."""

from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class StoredFile:
    path: str
    name: str
    size: int
    is_dir: bool


def _resolve(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def literal(path: str) -> str:
    """A path that Spark's readers take as it stands, with no globbing."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def join(folder: str, name: str) -> str:
    return folder.replace("\\", "/").rstrip("/") + "/" + name


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _resolve(spark, path)
    return fs.exists(p)


def list_files(spark: SparkSession, folder: str) -> list[StoredFile]:
    """Direct children of a folder, by name; an absent folder is empty."""
    fs, p = _resolve(spark, folder)
    if not fs.exists(p):
        return []
    found = [
        StoredFile(s.getPath().toString(), s.getPath().getName(), s.getLen(), s.isDirectory())
        for s in fs.listStatus(p)
    ]
    return sorted(found, key=lambda f: f.name)


def make_dirs(spark: SparkSession, path: str) -> str:
    fs, p = _resolve(spark, path)
    fs.mkdirs(p)
    return path


def qualified(spark: SparkSession, path: str) -> str:
    fs, p = _resolve(spark, path)
    return fs.makeQualified(p).toString()


def first_bytes(spark: SparkSession, path: str, count: int) -> bytes:
    """The first bytes of a file, or of the first file of a folder that has any."""
    fs, p = _resolve(spark, path)
    if fs.getFileStatus(p).isDirectory():
        files = (f for f in list_files(spark, path) if not f.is_dir and f.size and f.name[0] not in "._")
        first = next(files, None)
        return first_bytes(spark, first.path, count) if first else b""
    stream = fs.open(p)
    try:
        return bytes(stream.readNBytes(count))
    finally:
        stream.close()


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    fs, p = _resolve(spark, path)
    out = fs.create(p, True)
    try:
        out.write(data)
    finally:
        out.close()


def replace_by_rename(spark: SparkSession, source: str, target: str) -> None:
    """Put a finished output where an older one may stand."""
    fs, src = _resolve(spark, source)
    _, dst = _resolve(spark, target)
    if fs.exists(dst):
        fs.delete(dst, True)
    if not fs.rename(src, dst):
        raise OSError(f"could not move {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _resolve(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def _written_at(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copy each part to its place in the target.  A task that runs again writes the same bytes to
    the same place."""
    for batch in batches:
        for source, target, offset in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            with open(source, "rb") as part, open(target, "r+b") as out:
                out.seek(offset)
                shutil.copyfileobj(part, out, 1 << 23)
        yield batch.select([2])


def _join_in_tasks(spark: SparkSession, parts: list[StoredFile], target: str) -> None:
    """One file on a mounted file system: the sums of the parts' sizes say where each begins, and
    tasks write them there side by side."""
    local = lambda path: _resolve(spark, path)[1].toUri().getPath()
    place = local(target)
    offsets = list(accumulate((p.size for p in parts), initial=0))
    with open(place, "wb") as out:
        out.truncate(offsets[-1])
    rows = [(local(p.path), place, at) for p, at in zip(parts, offsets, strict=False) if p.size]
    if not rows:
        return
    tasks = spark.createDataFrame(rows, "source string, target string, at bigint").repartition(len(rows), "source")
    tasks.mapInArrow(_written_at, "at bigint").write.format("noop").mode("overwrite").save()


def join_parts(spark: SparkSession, parts: list[StoredFile], target: str) -> None:
    """The parts, in order, as one new file: written by tasks where the file system is mounted, and
    elsewhere streamed through the driver, a buffer at a time."""
    fs, out_path = _resolve(spark, target)
    if fs.getUri().getScheme() == "file":
        return _join_in_tasks(spark, parts, target)
    conf = spark._jsc.hadoopConfiguration()
    out = fs.create(out_path, True)
    try:
        for part in parts:
            stream = fs.open(_resolve(spark, part.path)[1])
            spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, conf, False)
            stream.close()
    finally:
        out.close()


def concatenate(spark: SparkSession, parts: list[str], target: str) -> bool:
    """Make one file of parts without moving data, where the file system can; the first part
    becomes the target.  False, with the parts untouched, where it cannot."""
    fs, first = _resolve(spark, parts[0])
    others = [_resolve(spark, p)[1] for p in parts[1:]]
    jvm_paths = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(others))
    for i, p in enumerate(others):
        jvm_paths[i] = p
    try:
        fs.concat(first, jvm_paths)
    except Exception:  # noqa: BLE001 - not supported by most file systems
        return False
    replace_by_rename(spark, parts[0], target)
    return True


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a temporary one only where the
    setting is absent, as on a single machine under test."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = "file://" + tempfile.gettempdir()
    return root.rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    return make_dirs(spark, f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}")


def reliable(df):
    """Cut lineage through a reliable checkpoint."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession) + "/checkpoints")
    return df.checkpoint()
