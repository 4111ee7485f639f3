"""Shared folders and materialisation."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


class Folder:
    """A folder on whatever file system its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, name: str = ""):
        path = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return path.getFileSystem(self._conf), path

    def exists(self, name: str = "") -> bool:
        fs, path = self._at(name)
        return fs.exists(path)

    def names(self) -> list[str]:
        fs, path = self._at()
        if not fs.exists(path):
            return []
        return sorted(status.getPath().getName() for status in fs.listStatus(path))

    def delete(self, name: str = "") -> None:
        fs, path = self._at(name)
        fs.delete(path, True)

    def touch(self, name: str) -> None:
        self.write_text(name, "")

    def write_text(self, name: str, text: str) -> None:
        """A small file, such as a manifest."""
        fs, path = self._at(name)
        stream = fs.create(path, True)
        if text:
            stream.write(bytearray(text.encode()))
        stream.close()

    def read_text(self, name: str) -> str:
        fs, path = self._at(name)
        stream = fs.open(path)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def rename(self, target: str) -> None:
        fs, path = self._at()
        if not fs.rename(path, self._jvm.org.apache.hadoop.fs.Path(target)):
            raise OSError(f"could not rename {self.path} to {target}")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in ``spark.checkpoint.dir``.

    A machine-local folder is created only for a local session without one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="daymatrix-")
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
    raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")


_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh, not yet existing path below the shared or the scratch folder."""
    parent = _scratch.get() or f"{shared_folder(spark)}/daymatrix"
    return f"{parent}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Keep what is materialised inside the block in one folder, removed at its
    end.  Results must be stored by then."""
    path = new_folder(spark, "run")
    token = _scratch.set(path)
    try:
        yield path
    finally:
        _scratch.reset(token)
        Folder(spark, path).delete()


# Rows of a selection or lookup that may be sent to every executor.
MAX_BROADCAST_ROWS = 100_000


def is_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether a frame has at most ``max_rows`` rows; counts no further."""
    return df.limit(max_rows + 1).count() <= max_rows


# Rows that one task aggregates, some 100 MB of memory.
ROWS_PER_TASK = 250_000


def tasks_for(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Number of tasks that share the rows of a written table, so that what one of them
    holds does not grow with the table.  Only its footers are read."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows_per_task))


def held(df: DataFrame, name: str = "held", max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """A small table, such as a list of days, computed once.

    Up to ``max_rows`` rows it becomes a local table, which costs later plans no job; a
    larger one is written to the shared folder instead.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return materialize(df, name)
    return df.sparkSession.createDataFrame(rows, df.schema)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Used where one aggregate over the raw facts feeds several branches: the
    facts are scanned once, each branch reads only the columns it needs, and a
    lost executor costs a re-read of this table instead of the whole history.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
