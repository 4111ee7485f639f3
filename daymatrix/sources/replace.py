"""Replacing a Parquet folder whose path others read, with recovery.

A file system has no call that exchanges two folders.  The new rows are therefore written
beside the old ones, and one small file, the switch, says that they count from now on.  Two
renames then put them in place.  Who is stopped before the switch has changed nothing; who is
stopped after it leaves renames that the next reader makes (:func:`settle`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daymatrix.session import Folder


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Columns a folder is partitioned by, read off its folder names."""
    columns, folder = [], Folder(spark, path)
    while level := [n for n in folder.names() if "=" in n and not n.startswith((".", "_"))]:
        columns.append(level[0].split("=", 1)[0])
        folder = Folder(spark, f"{folder.path}/{level[0]}")
    return columns


def _places(path: str) -> tuple[str, str]:
    """Parent and name of a folder; its helpers lie beside it under hidden names."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return parent or ".", name


def replace_dataset(df: DataFrame, path: str, backup: str | None) -> None:
    """Replace a Parquet folder by ``df``, which may read it; partitions are kept.  The
    old rows go to ``backup``, a path in the same folder, or are deleted."""
    spark = df.sparkSession
    settle(spark, path)
    parent, name = _places(path)
    df.write.mode("overwrite").partitionBy(*partition_columns(spark, path)).parquet(f"{parent}/.{name}.new")
    old = _places(backup)[1] if backup else f".{name}.old"
    Folder(spark, parent).write_text(f".{name}.switch", old)
    settle(spark, path)


def settle(spark: SparkSession, path: str) -> None:
    """Finish a replacement whose switch was set, remove what one without it left.

    May be called again after it was itself stopped.
    """
    parent, name = _places(path)
    folder = Folder(spark, parent)
    switch, fresh = f".{name}.switch", f".{name}.new"
    if not folder.exists(switch):
        return  # an unfinished copy is written over by the next replacement
    old = folder.read_text(switch)
    if folder.exists(fresh):
        if folder.exists(name):
            Folder(spark, f"{parent}/{name}").rename(f"{parent}/{old}")
        Folder(spark, f"{parent}/{fresh}").rename(f"{parent}/{name}")
    if old == f".{name}.old":
        folder.delete(old)
    folder.delete(switch)
