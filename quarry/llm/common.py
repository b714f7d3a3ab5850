"""Shared helpers: intermediate tables, archive files and Arrow slices."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import checkpoint_dir

_OPEN: dict[str, SparkSession] = {}


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _sweep() -> None:
    for path, spark in list(_OPEN.items()):
        with contextlib.suppress(Exception):
            _delete(spark, path)


class Scratch:
    """Intermediate tables of one call, under the shared checkpoint folder.

    Tables that the returned DataFrame still reads stay until the driver ends
    (they are deleted at exit); ``drop`` removes one that is no longer read.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/quarry-llm/{name}-{uuid.uuid4().hex}"
        _OPEN[self.root] = spark

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and read it back: lineage ends in files that
        every executor can read again."""
        path = self.path(name)
        df.write.mode("overwrite").parquet(path)
        # Spark deletes the shuffle files of a finished plan once the driver's
        # heap is collected, which may come late; large jobs need the disk.
        for _ in range(2):
            self.spark.sparkContext._jvm.System.gc()
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            _delete(self.spark, self.path(name))


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with a null text as the empty one; other columns go."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def whole_rows(docs: DataFrame, name: str = "row") -> DataFrame:
    """``docs`` as one struct column, so that no name of a stage can meet one
    of its columns; ``select("row.*")`` gives them back."""
    return docs.select(F.struct("*").alias(name))


def arrow_slices(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut a record batch into runs of rows of about ``max_bytes`` of one
    string or binary column (or field, ``struct.field``), so that what is derived
    from a run stays small however long the rows are. A single longer row is a run
    of its own."""
    n = batch.num_rows
    if not n:
        return
    sizes = pc.fill_null(pc.binary_length(column_of(batch, column)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i in range(n):
        if i > start and total + sizes[i] > max_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(sizes[i])
    yield batch.slice(start, n - start)


def releasing(run: Callable) -> Callable:
    """``run`` over a task's batches, and then what its arrays held goes back to the
    system: a worker lives on through later stages, whose memory it would take."""
    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(AttributeError, OSError):  # no such call beside glibc
                ctypes.CDLL(None).malloc_trim(0)
    return wrapped


def column_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    """A column, or a field of a struct column without null structs."""
    name, _, field = column.partition(".")
    values = batch.column(name)
    return values.field(field) if field else values


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder that driver and executors share."""
    if "://" not in uri and not uri.startswith("file:"):
        uri = "file://" + uri
    elif uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri)


@contextlib.contextmanager
def atomic_file(uri: str):
    """A stream whose file appears under its name only when it is whole, so
    that a task that is run again (lost executor, speculation) replaces it."""
    fs, path = open_fs(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(part, compression=None) as out:
        yield out
    fs.move(part, path)
