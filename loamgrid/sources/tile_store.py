"""A store of boxes (tiles, features) clustered along a Morton curve, so that a reader's box skips files.

Rows are range-partitioned and sorted by the Morton code of their box's lower left cell. A manifest has the least and the
greatest code of each file. A reader's box becomes a few ranges of codes; only files that meet one of them are opened, and
within these the codes' statistics skip row groups.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.boxes import box, intersects

#: Bits of a cell's column and of its row.
BITS = 24
#: Ranges that a box becomes at most; with fewer, cells outside of the box are in them too.
MOST_RANGES = 32


def _spread(x: Column) -> Column:
    """The bits of x with a zero bit before each."""
    for shift in (16, 8, 4, 2, 1):
        mask = sum(((1 << shift) - 1) << (2 * shift * k) for k in range(64 // (2 * shift)))
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return x


def morton(column: Column, row: Column) -> Column:
    """The code of a cell: its column's and row's bits in turns, the row's first. Both from 0 to 2 ** BITS - 1."""
    return _spread(column.cast("long")).bitwiseOR(F.shiftleft(_spread(row.cast("long")), 1))


def ranges(x0: int, y0: int, x1: int, y1: int, most: int = MOST_RANGES) -> list[tuple[int, int]]:
    """Codes, as ranges with both ends, of the cells from (x0, y0) to (x1, y1): by dividing the whole into quarters until
    they are inside, or until there are `most` of them; ranges that follow each other are one."""
    found, todo = [], [(0, 0, 0, BITS)]
    while todo:
        code, x, y, bits = todo.pop(0)
        size = 1 << bits
        if x > x1 or y > y1 or x + size <= x0 or y + size <= y0:
            continue
        whole = x0 <= x and y0 <= y and x + size - 1 <= x1 and y + size - 1 <= y1
        if whole or not bits or len(found) + len(todo) >= most:
            found.append((code << 2 * bits, ((code + 1) << 2 * bits) - 1))
        else:
            todo += [(4 * code + k, x + (k & 1) * size // 2, y + (k >> 1) * size // 2, bits - 1) for k in range(4)]
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and out[-1][1] + 1 >= a:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


@dataclass(frozen=True)
class Layout:
    """Cells' size, where cell 0, 0 begins, and the widest and highest box of a store."""

    cell: float
    x0: float
    y0: float
    width: float
    height: float

    def cell_of(self, x: float, y: float) -> tuple[int, int]:
        clip = lambda v: min(max(int(v // self.cell), 0), (1 << BITS) - 1)
        return clip(x - self.x0), clip(y - self.y0)


def write_store(df: DataFrame, path: str, cell: float, files: int) -> None:
    """df(x0, y0, x1, y1, ...) as a store of about so many files. Rows whose box has a null are left out."""
    whole = df.where(" AND ".join(f"{k} IS NOT NULL" for k in ("x0", "y0", "x1", "y1")))
    low = whole.agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max(F.col("x1") - F.col("x0")).alias("width"), F.max(F.col("y1") - F.col("y0")).alias("height")).select(*(F.coalesce(F.col(k).cast("double"), F.lit(0.0)).alias(k) for k in ("x0", "y0", "width", "height")), F.lit(float(cell)).alias("cell"))
    at = low.first()
    cell_of = lambda k, start: F.least(F.floor((F.col(k) - start) / float(cell)), F.lit((1 << BITS) - 1))
    coded = whole.withColumn("_code", morton(cell_of("x0", at.x0), cell_of("y0", at.y0)))
    coded.repartitionByRange(files, "_code").sortWithinPartitions("_code").write.mode("overwrite").parquet(path)
    low.write.mode("overwrite").parquet(f"{path}/_layout")
    by_file = df.sparkSession.read.schema(coded.schema).parquet(path).groupBy(F.input_file_name().alias("file")).agg(F.min("_code").alias("low"), F.max("_code").alias("high"))
    by_file.write.mode("overwrite").parquet(f"{path}/_manifest")


def read_store(spark: SparkSession, path: str, within: tuple[float, float, float, float] | None = None) -> DataFrame:
    """The rows of a store whose boxes meet `within` (touching counts); only files that can have some are opened."""
    manifest = spark.read.parquet(f"{path}/_manifest")
    if within is None:
        return spark.read.parquet(path).drop("_code")
    layout = Layout(**spark.read.parquet(f"{path}/_layout").first().asDict())
    # a box is stored by its lower left corner, which may lie its whole size before the one asked for
    low, high = layout.cell_of(within[0] - layout.width, within[1] - layout.height), layout.cell_of(within[2], within[3])
    wanted = ranges(*low, *high)
    meets = lambda a, b: " OR ".join(f"({a} <= {y} AND {b} >= {x})" for x, y in wanted)
    files = [r.file for r in manifest.where(meets("low", "high")).select("file").collect()]
    rows = spark.read.parquet(*files) if files else spark.read.schema(spark.read.parquet(path).schema).parquet(path).limit(0)
    return rows.where(meets("_code", "_code")).where(intersects(box(), tuple(map(F.lit, within)))).drop("_code")
