"""What the text operators share: tables, cuts of the lineage, words, and batched Arrow functions."""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the words of the contracts: space and \x09-\x0D.
BLANKS = " \t\n\x0b\x0c\r"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
WORD_PATTERN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = {ord(a): b for a, b in zip(UPPER, LOWER, strict=True)}

#: Code points on which Python's and the tokenizer library's Unicode tables agree: printable ASCII and the Latin letters
#: and signs up to U+017F, without U+0130, whose lower case is two code points.
UNSAFE = re.compile("[^\t\n\r -~¡-įı-ſ]")
#: Letters and numbers among these.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ſ"
NUMBERS = "0-9²³¹¼-¾"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. A folder of our own is made only in local mode."""
    if path := spark.conf.get("spark.checkpoint.dir", None):
        return path
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir has to name a folder that the whole cluster shares")
    spark.conf.set("spark.checkpoint.dir", path := tempfile.mkdtemp(prefix="cut-"))
    return path


#: Folders that cut() has written and nothing has deleted yet, in order.
_folders: list[str] = []


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """df written to the shared folder and read again: later stages don't recompute it when executors are lost.

    The folder stays until drop_cuts(), or until the scratch() ends in which it was made."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _folders.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


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
    """Deletes, at its end, what cut() has written inside it, but for the tables that were put into the list."""
    begin, kept = len(_folders), []
    try:
        yield kept
    finally:
        made = _folders[begin:]
        stay = set().union(*(_folder_of(df, made) for df in kept))
        _delete(spark, [f for f in made if f not in stay])
        _folders[begin:] = [f for f in made if f in stay]


#: What workers forget when a partition is done: functions that clear a module's caches.
caches: list[Callable[[], None]] = []


def give_back() -> None:
    """Caches and freed memory go back to the system: workers are used again by later stages, and so is the driver."""
    for clear in caches:
        clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library frees by itself
        ctypes.CDLL("libc.so.6").malloc_trim(0)


#: Most rows and bytes of a batch between Spark and a worker.
BATCH_ROWS, BATCH_BYTES = 2048, 8 << 20


def in_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """df.mapInArrow(run, schema) by small batches, with the worker's memory given back after each partition."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(whole, schema)


def free_name(df: DataFrame, name: str) -> str:
    """name, or name with underscores in front, such that df has no such column (upper and lower case are the same)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_column(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 2048, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows and at most most_bytes, or of one row that alone has more."""
    for batch in batches:
        if not batch.num_rows:
            continue
        if batch.nbytes <= most_bytes and batch.num_rows <= rows:
            yield batch
            continue
        at, n = 0, batch.num_rows
        while at < n:
            step = min(rows, n - at)
            while step > 1 and batch.slice(at, step).nbytes > most_bytes:
                step = (step + 1) // 2
            yield batch.slice(at, step)
            at += step
