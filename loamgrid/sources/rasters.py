"""Raster files (TIFF: one band of bytes, in strips, plain or deflated) as a Spark data source that reads windows.

A file is a row for its pixels when it is read, and a row (name, width, height, data) when it is written. The reader has a
partition for a number of runs of strips, so a window, given as options or by filters on the rows, opens only the strips that it
meets. Files lie in a folder that driver and executors share; the writer renames them when the job commits.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

PLAIN, DEFLATE = 1, 8
#: Tags of the format: fixed values.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, OFFSETS, SAMPLES, ROWS, COUNTS = 256, 257, 258, 259, 262, 273, 277, 278, 279
SHORT, LONG = 3, 4
#: Pixels of a partition, what opening a file counts as, and pixels of a batch of rows.
PARTITION, OPENING, BATCH = 1 << 20, 1 << 12, 1 << 16


def local(path: str) -> str:
    """A path of the file system that all machines have mounted; other stores have no files to seek in."""
    url = urlparse(path)
    if url.scheme not in ("", "file"):
        raise ValueError(f"not a mounted folder: {path}")
    return url.path


def encode(data: bytes, width: int, height: int, rows_per_strip: int, compression: int) -> bytes:
    """A whole file: header, strips, then the directory."""
    strips = [data[a * width : min(a + rows_per_strip, height) * width] for a in range(0, height, rows_per_strip)]
    if compression == DEFLATE:
        strips = [zlib.compress(s) for s in strips]
    sizes = [len(s) for s in strips]
    starts = [8 + sum(sizes[:k]) for k in range(len(sizes))]
    body = b"".join(strips)
    tables = 8 + len(body)
    lists = struct.pack(f"<{2 * len(strips)}I", *starts, *sizes)
    single = len(strips) == 1
    tags = [
        (WIDTH, LONG, 1, width), (HEIGHT, LONG, 1, height), (BITS, SHORT, 1, 8), (COMPRESSION, SHORT, 1, compression), (PHOTOMETRIC, SHORT, 1, 1), (OFFSETS, LONG, len(strips), starts[0] if single else tables),
        (SAMPLES, SHORT, 1, 1), (ROWS, LONG, 1, rows_per_strip), (COUNTS, LONG, len(strips), sizes[0] if single else tables + 4 * len(strips)),
    ]
    directory = struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", *t) for t in tags) + struct.pack("<I", 0)
    return struct.pack("<2sHI", b"II", 42, tables + len(lists)) + body + lists + directory


@dataclass(frozen=True)
class Layout:
    width: int
    height: int
    compression: int
    rows: int
    starts: tuple[int, ...]
    sizes: tuple[int, ...]


def layout(path: str) -> Layout:
    """What the header and the directory say; no strip is read."""
    with open(path, "rb") as f:
        order = {b"II": "<", b"MM": ">"}.get(f.read(2))
        if order is None or struct.unpack(f"{order}H", f.read(2))[0] != 42:
            raise ValueError(f"not a TIFF: {path}")
        f.seek(struct.unpack(f"{order}I", f.read(4))[0])
        raw = [f.read(12) for _ in range(struct.unpack(f"{order}H", f.read(2))[0])]
        found = {}
        for r in raw:
            tag, kind, n = struct.unpack(f"{order}HHI", r[:8])
            if kind not in (SHORT, LONG):
                continue
            code, size = ("H", 2) if kind == SHORT else ("I", 4)
            data = r[8 : 8 + n * size]
            if n * size > 4:
                f.seek(struct.unpack(f"{order}I", r[8:])[0])
                data = f.read(n * size)
            found[tag] = struct.unpack(f"{order}{n}{code}", data)
    one = lambda tag, default=None: found.get(tag, (default,))[0]
    if one(BITS, 1) != 8 or one(SAMPLES, 1) != 1 or one(COMPRESSION, PLAIN) not in (PLAIN, DEFLATE):
        raise ValueError(f"not one band of bytes, plain or deflated: {path}")
    return Layout(one(WIDTH), one(HEIGHT), one(COMPRESSION, PLAIN), one(ROWS, one(HEIGHT)), found[OFFSETS], found[COUNTS])


@dataclass
class Strips(InputPartition):
    """Runs of strips (path, first, last) of one or more files; first and last count them all."""

    runs: list[tuple[str, int, int]]

    @property
    def first(self) -> int:
        return 0

    @property
    def last(self) -> int:
        return sum(b - a for _, a, b in self.runs)


class Reader(DataSourceReader):
    def __init__(self, path: str, options: dict):
        self.path, self.options = local(path), options
        self.rows = [int(options.get("r0", 0)), int(options.get("r1", 1 << 31))]
        self.columns = [int(options.get("c0", 0)), int(options.get("c1", 1 << 31))]

    def partitions(self) -> list[Strips]:
        """Small files share a partition: as many of them as cost, with their opening, PARTITION pixels."""
        out, most, room = [], int(self.options.get("strips", 16)), 0
        for name in sorted(n for n in os.listdir(self.path) if n.lower().endswith((".tif", ".tiff"))):
            of = layout(path := f"{self.path}/{name}")
            first, last = self.rows[0] // of.rows, min(-(-min(self.rows[1], of.height) // of.rows), len(of.starts))
            for a in range(max(0, first), last, most):
                b = min(a + most, last)
                cost = OPENING + (b - a) * of.rows * of.width
                if room < cost:
                    out.append(Strips([]))
                    room = PARTITION
                out[-1].runs.append((path, a, b))
                room -= cost
        return out

    def read(self, partition: Strips | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no strip is wanted
            return
        grids, n = [], 0
        for run in partition.runs:
            for grid in self._grids(*run):
                grids.append(grid)
                n += len(grid[3])
                if n >= BATCH:
                    yield self._batch(grids)
                    grids, n = [], 0
        if n:
            yield self._batch(grids)

    def _grids(self, path: str, first: int, last: int) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
        """name, r, c, value of the window's part of each strip."""
        of = layout(path)
        with open(path, "rb") as f:
            for k in range(first, last):
                f.seek(of.starts[k])
                data = f.read(of.sizes[k])
                grid = np.frombuffer(zlib.decompress(data) if of.compression == DEFLATE else data, np.uint8).reshape(-1, of.width)
                r, c = np.arange(k * of.rows, k * of.rows + len(grid)), np.arange(of.width)
                keep = (r >= self.rows[0]) & (r < self.rows[1]), (c >= self.columns[0]) & (c < self.columns[1])
                grid, r, c = grid[keep[0]][:, keep[1]], r[keep[0]], c[keep[1]]
                yield os.path.basename(path), np.repeat(r, len(c)), np.tile(c, len(r)), grid.ravel()

    @staticmethod
    def _batch(grids: list[tuple[str, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        names = pa.array([g[0] for g in grids], pa.string()).take(pa.array(np.repeat(np.arange(len(grids)), [len(g[3]) for g in grids])))
        r, c, value = (pa.array(np.concatenate([g[k] for g in grids]), pa.int32()) for k in (1, 2, 3))
        return pa.RecordBatch.from_pydict({"name": names, "r": r, "c": c, "value": value})


class PushedReader(Reader):
    """For sessions that push filters to Python sources; Spark refuses such a reader in others."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Bounds of rows and columns narrow the window; Spark still applies all filters."""
        for f in filters:
            if isinstance(f, (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) and f.attribute in (("r",), ("c",)):
                window, step = (self.rows, self.columns)[f.attribute == ("c",)], isinstance(f, (GreaterThan, LessThanOrEqual))
                if isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    window[0] = max(window[0], f.value + step)
                else:
                    window[1] = min(window[1], f.value + step)
            yield f


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class Writer(DataSourceWriter):
    def __init__(self, path: str, options: dict):
        self.path, self.rows, self.compression = local(path), int(options.get("rows", 16)), DEFLATE if options.get("compression") == "deflate" else PLAIN

    def write(self, rows) -> Written:
        from pyspark import TaskContext

        os.makedirs(self.path, exist_ok=True)
        names, attempt = [], TaskContext.get().taskAttemptId()
        for row in rows:
            if len(row.data) != row.width * row.height:
                raise ValueError(f"{row.name}: {len(row.data)} bytes are not {row.width} x {row.height} pixels")
            names.append(f"{row.name}.{attempt}.part")
            with open(f"{self.path}/{names[-1]}", "wb") as f:
                f.write(encode(bytes(row.data), row.width, row.height, self.rows, self.compression))
        return Written(names)

    def commit(self, messages) -> None:
        for name in (n for m in messages if m for n in m.names):
            os.replace(f"{self.path}/{name}", f"{self.path}/{name.rsplit('.', 2)[0]}")

    def abort(self, messages) -> None:
        for name in (n for m in messages if m for n in m.names):
            if os.path.exists(f"{self.path}/{name}"):
                os.remove(f"{self.path}/{name}")


class RasterFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rasters"

    def schema(self) -> str:
        return "name string, r int, c int, value int"

    def reader(self, schema) -> Reader:
        return (PushedReader if self.options.get("push") == "true" else Reader)(self.options["path"], self.options)

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options["path"], self.options)


def write_rasters(df: DataFrame, path: str, rows_per_strip: int = 16, deflate: bool = True) -> None:
    """df(name, width, height, data: a byte for each pixel, row by row) as files of these names."""
    df.sparkSession.dataSource.register(RasterFiles)
    out = df.select("name", "width", "height", "data").write.format("rasters").mode("append").option("rows", rows_per_strip)
    out.option("compression", "deflate" if deflate else "none").save(path)


def read_rasters(spark: SparkSession, path: str, window: tuple[int, int, int, int] | None = None) -> DataFrame:
    """name, r, c, value of the pixels of all files of a folder; window: rows from, to and columns from, to, the ends left out."""
    spark.dataSource.register(RasterFiles)
    reader = spark.read.format("rasters").option("push", spark.conf.get("spark.sql.python.filterPushdown.enabled", "false"))
    for k, v in zip(("r0", "r1", "c0", "c1"), window or (), strict=False):
        reader = reader.option(k, v)
    return reader.load(path)
