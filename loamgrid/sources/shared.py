"""Intermediate tables in the folder that the whole cluster shares, and how long they live."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. One of our own is made only in local mode."""
    if path := spark.conf.get("spark.checkpoint.dir", None):
        return path
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir has to name a folder that the whole cluster shares")
    spark.conf.set("spark.checkpoint.dir", path := tempfile.mkdtemp(prefix="cut-"))
    return path


#: Folders that were written here and nothing has deleted yet, in order.
_folders: list[str] = []


def new_folder(spark: SparkSession, name: str = "cut") -> str:
    """A path in the shared folder that drop_cuts() or scratch() deletes."""
    _folders.append(path := f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return path


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """df written to the shared folder and read again: later stages don't recompute it when executors are lost.

    The folder stays until drop_cuts(), or until the scratch() ends in which it was made."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _folder_of(df: DataFrame, among: list[str]) -> set[str]:
    read = {f.rsplit("/", 1)[0].rsplit("/", 1)[-1] for f in df.inputFiles()}
    return {f for f in among if f.rsplit("/", 1)[-1] in read}


def drop_cuts(spark: SparkSession) -> None:
    """Delete all that cut() has written: for callers, once they have written their results."""
    _delete(spark, _folders)
    _folders.clear()


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Deletes, at its end, what was written inside it, but for the tables that were put into the list."""
    begin, kept = len(_folders), []
    try:
        yield kept
    finally:
        made = _folders[begin:]
        stay = set().union(*(_folder_of(df, made) for df in kept))
        _delete(spark, [f for f in made if f not in stay])
        _folders[begin:] = [f for f in made if f in stay]
