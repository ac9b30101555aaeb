"""Vector code compression: product codes of four bytes, with exact integer codebooks and annular norm pruning.

A vector's components become integers, and its four parts are coded by the nearest of 256 entries each. Entries are sorted
by norm. A part's first candidate is the entry nearest to it in norm; by the triangle inequality no entry outside the
annulus | |c| - |x| | <= distance so far can be nearer, so the interval of entries that a binary search finds is all that
is evaluated, borders included (an entry at the border may tie and have the lower index).

A round is one scan: each task sums its parts up by entry, Spark sums the tasks' rows, and the driver holds only codebooks
(at most 256 entries of one vector's length). Nothing of the vectors is shuffled until the sums by label.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, in_arrow, scratch, slices

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Largest magnitude of a scaled component for which 64-bit sums of squares are exact for up to 4096 components.
MOST = 1 << 24
#: Of tables of labels up to this many rows (16 bytes each) a copy goes to every executor; larger ones are shuffled.
MOST_LABELS = 262_144
#: Part vectors in one block: those of similar norm share an annulus.
BLOCK = 128


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def part_bounds(dim: int, parts: int) -> list[int]:
    """Where parts begin and end: equal ones, or the first ones longer by one where dim isn't a multiple."""
    return [0, *np.cumsum([dim // parts + (k < dim % parts) for k in range(parts)]).tolist()]


class Codebook:
    """Entries (integers, in order of index) of one part, searched by norm."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        norms = np.sqrt((entries.astype(np.float64) ** 2).sum(1))
        self.order = np.argsort(norms, kind="stable")
        self.norms, self.sorted = norms[self.order], entries[self.order]
        self.squares = (self.sorted**2).sum(1)
        #: products of smaller integers are exact in floating point and so can be matrix products
        self.small = bool(entries.size == 0 or np.abs(entries).max() < 1 << 20)
        self.evaluated = 0

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry to each row of x; ties go to the lower index."""
        index, distance = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        if not len(x):
            return index, distance
        squares = (x**2).sum(1)
        norms = np.sqrt(squares.astype(np.float64))
        at = np.minimum(np.searchsorted(self.norms, norms), len(self.norms) - 1)
        at -= (at > 0) & (np.abs(self.norms[at - 1] - norms) < np.abs(self.norms[at] - norms))
        best = np.sqrt(((x - self.sorted[at]) ** 2).sum(1).astype(np.float64))
        slack = 1e-6 * (1 + norms)
        low = np.searchsorted(self.norms, norms - best - slack, "left")
        high = np.searchsorted(self.norms, norms + best + slack, "right")
        small = self.small and np.abs(x).max() < 1 << 20
        by_norm = np.argsort(norms, kind="stable")
        for begin in range(0, len(x), BLOCK):
            rows = by_norm[begin : begin + BLOCK]
            a, b = int(low[rows].min()), int(high[rows].max())
            if small:
                inner = (x[rows].astype(np.float64) @ self.sorted[a:b].astype(np.float64).T).astype(np.int64)
            else:
                inner = x[rows] @ self.sorted[a:b].T
            found = squares[rows, None] + self.squares[a:b] - 2 * inner
            self.evaluated += found.size
            least = found.min(1)
            index[rows] = np.where(found == least[:, None], self.order[a:b], len(self.order)).min(1)
            distance[rows] = least
        return index, distance


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The scaled components, floors of them: products with a power of two are exact."""
    values = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.floor(values * SCALE)
    if scaled.size and np.abs(scaled).max() > MOST:
        raise ValueError(f"components beyond {MOST // SCALE} in magnitude have squared errors that 64 bits can't hold")
    return scaled.astype(np.int64).reshape(len(column), dim)


def _sums(books: list[np.ndarray], dim: int):
    """A row for each part and entry that a task has used: how many vectors, and their componentwise sums."""
    bounds = part_bounds(dim, len(books))

    def run(batches):
        at = [Codebook(b) for b in books]
        total, count = np.zeros((ENTRIES, dim), np.int64), np.zeros((len(books), ENTRIES), np.int64)
        for batch in slices(batches):
            x = _matrix(batch.column(0), dim)
            for part, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                index, _ = at[part].nearest(x[:, a:b])
                np.add.at(total[:, a:b], index, x[:, a:b])
                count[part] += np.bincount(index, minlength=ENTRIES)
        for part, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
            used = np.flatnonzero(count[part])
            yield pa.RecordBatch.from_pydict({"part": pa.array(np.full(len(used), part, np.int32)), "entry": pa.array(used.astype(np.int32)), "n": pa.array(count[part][used]), "sums": pa.array(total[used, a:b].tolist(), pa.list_(pa.int64()))})

    return run


def _coded(books: list[np.ndarray], dim: int):
    bounds = part_bounds(dim, len(books))

    def run(batches):
        at = [Codebook(b) for b in books]
        for batch in slices(batches):
            x, codes, error = _matrix(batch.column(2), dim), [], np.zeros(batch.num_rows, np.int64)
            for part, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                index, distance = at[part].nearest(x[:, a:b])
                codes.append(index)
                error += distance
            code = [bytes(c).hex() for c in np.stack(codes, 1).astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code), pa.array(error)], names=["vec_id", "label", "code", "error"])

    return run


def kept_vectors(vectors: DataFrame) -> tuple[DataFrame, int]:
    """vec_id, label and vector of the rows that have a code, and the length of their vectors.

    The length is that of the usable vector with the smallest id; no other length can be coded with it."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.where(usable(F.col("vector")) & (F.size("vector") > 0))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select(F.size("vector").alias("dim")).limit(1).collect()
    dim = first[0].dim if first else 0
    return rows.where(F.size("vector") == dim), dim


def learn(rows: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks, a matrix of integers for each part: at most `entries` entries each, whatever the number of rows."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select("vector").limit(min(entries, ENTRIES)).toArrow()
    if not first.num_rows:
        return []
    x, bounds = _matrix(first.column(0).combine_chunks(), dim), part_bounds(dim, parts)
    books = [x[:, a:b].copy() for a, b in zip(bounds, bounds[1:], strict=False)]
    for _ in range(rounds):
        sums = in_arrow(rows.select("vector"), _sums(books, dim), "part int, entry int, n long, sums array<long>")
        long = sums.select("part", "entry", "n", F.posexplode("sums").alias("at", "s")).groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        for r in long.collect():  # entries times the vector's length
            books[r.part][r.entry, r["at"]] = r.s // r.n
    return books


def codebook_digest(books: list[np.ndarray]) -> str:
    """Of all entries' components as decimal integers by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def encode(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """vec_id, label, code (two hex digits for each part) and error of each usable vector; the codebooks.

    vectors(vec_id, embedding, label, ...): rows whose vector is null, empty or holds a null or a number that isn't finite
    are dropped, as are vectors of another length than that of the smallest id. Null ids come after all others and keep
    their rows; rows of one id are told apart by their vectors, and equal rows each have their row. An empty table gives
    an empty one and no codebook. A component beyond 2 ** 14 in magnitude is refused, its squares leave 64 bits. Other
    columns aren't read.
    """
    if parts < 1 or not 0 < entries <= ENTRIES:
        raise ValueError("parts are one or more, entries 1 to 256")
    rows, dim = kept_vectors(vectors)
    books = learn(rows, dim, parts, entries, rounds)
    if not books:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), books
    return in_arrow(rows.select("vec_id", "label", "vector"), _coded(books, dim), "vec_id long, label long, code string, error long"), books


def decode(codes: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """codes(code, ...) with the column vector: the entries that the code names, scaled back."""
    hexes = F.transform(F.sequence(F.lit(0), F.lit(len(books) - 1)), lambda k: F.conv(F.substring("code", 2 * k + 1, F.lit(2)), 16, 10).cast("int"))
    scaled = [F.lit((b / SCALE).tolist()).cast("array<array<double>>") for b in books]
    return codes.withColumn("vector", F.concat(*(F.element_at(s, hexes[k] + 1) for k, s in enumerate(scaled))))


def code_report(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error (error summed over equal labels, nulls together) and codebooks_sha256."""
    with scratch(vectors.sparkSession) as kept:
        coded, books = encode(vectors)
        kept.append(coded := cut(coded, "codes"))
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    of = sums.select(F.col("label").alias("of_label"), "label_error")
    if of.count() <= MOST_LABELS:
        of = F.broadcast(of)
    joined = coded.join(of, F.col("label").eqNullSafe(F.col("of_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256"))
