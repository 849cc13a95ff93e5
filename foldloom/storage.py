"""Shared folders for intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from foldloom.session import local_scratch


def shared_folder(spark: SparkSession) -> str | None:
    """The folder that the cluster names in ``spark.checkpoint.dir``, if any."""
    return spark.conf.get("spark.checkpoint.dir", None) or None


def new_folder(spark: SparkSession) -> str:
    """A fresh folder every executor can reach. A session on one machine that names none gets one of its own."""
    shared = shared_folder(spark) or local_scratch(spark)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{shared.rstrip('/')}/foldloom-{uuid.uuid4().hex}"


def stage(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a table once and read it back, so that later jobs neither recompute its lineage
    nor depend on the executors that made it, and read only the columns they use."""
    path = (folder or new_folder(df.sparkSession)) + f"/rows-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder in whatever store it is, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark._jsc.hadoopConfiguration()), path


@contextmanager
def replacement(spark: SparkSession, folder: str) -> Iterator[str]:
    """A sibling to write to, which takes the place of ``folder`` by rename when the block ends well.

    After an error the old folder is as it was. Both hidden names are fixed, so what a run that was killed has left is put right by the
    next one: between the two renames the old folder is still there under its hidden name. On a store without a rename of folders the swap takes
    as long as a copy. Two runs must not replace one folder at the same time.
    """
    parent, name = folder.rstrip("/").rsplit("/", 1)
    new, old = f"{parent}/.new.{name}", f"{parent}/.old.{name}"
    files, path = _file_system(spark, folder)

    def move(source: str, target: str) -> None:
        if not files.rename(path(source), path(target)):
            raise OSError(f"cannot rename {source} to {target}")

    if files.exists(path(old)):
        if files.exists(path(folder)):
            drop_folder(spark, old)
        else:
            move(old, folder)
    drop_folder(spark, new)
    try:
        yield new
        there = files.exists(path(folder))
        if there:
            move(folder, old)
        try:
            move(new, folder)
        except Exception:
            if there:
                move(old, folder)
            raise
    except BaseException:
        drop_folder(spark, new)
        raise
    drop_folder(spark, old)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A fresh shared folder that is gone when the block ends, also after an error."""
    folder = new_folder(spark)
    try:
        yield folder
    finally:
        drop_folder(spark, folder)
