"""MinHash near-duplicates with sequential Bayesian verification.

1. A scan makes each text's set of distinct word shingles (64-bit hashes), the set's 128-bit digest, BANDS band keys and
   a signature of CHECKS 16-bit values. Texts with equal sets become one class: exact copies go no further.
2. Classes that share a band key are candidates. In each bucket the classes are compared with two leaders, the first and
   the last, so that a bucket of n gives 2n pairs; links make components. A bucket that lies in one component is done:
   pairs within a component change no result. In the others, the classes outside of the bucket's largest component are
   queries against the bucket's classes; where that would take very many comparisons, its classes meet those that share a
   shingle of their prefixes (rare shingles first), an exact filter. They meet in blocks inside of one task, first by
   signatures, then those that signatures leave by their texts, each pair in its first common bucket; only links leave a
   task: no pair becomes a row, however large a group is, and components that a link has joined need no more pairs.
   Nothing is capped.
3. A pair is compared by batches of BATCH signature values. With m of n equal and a uniform prior, its similarity has a
   Beta(m + 1, n - m + 1) posterior; the pair is pruned as soon as the probability of reaching the threshold is below
   MISS. Survivors are verified exactly on the full sets of their texts.

A pair of the threshold's similarity shares no band with a chance of (1 - 0.8 ** ROWS) ** BANDS, about 5e-6. Rows of a hot
key (a bucket, a leader) are joined with tables of one row a key that are written first, so that both sides are plain
exchanges which the adaptive skew join can split.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, in_arrow, scratch, slices, text_column
from .components import connected_components

BANDS, ROWS, CHECKS, BATCH, MISS = 40, 6, 128, 16, 1e-7
#: Classes of a block, and shingles of their texts (about 8 bytes each as sets, 6 as texts).
BLOCK, BLOCK_SHINGLES = 4096, 1 << 20
_MIX, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_rng = np.random.default_rng(20240607)
_A = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of so many words, A-Z in lower case; fewer words: the whole as one.

    bytes.lower() and bytes.split() are those of ASCII alone: A-Z, and space with \\x09-\\x0D."""
    found = text.encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    n = min(words, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        out = (out ^ (out >> np.uint64(29))) * _MIX + h[k : len(h) - n + 1 + k]
    out = (out ^ (out >> np.uint64(32))) * _MIX2
    return np.unique(out ^ (out >> np.uint64(29)))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over the set (not empty)."""
    low = np.full(len(_A), np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(shingles), 1024):
        v = shingles[a : a + 1024, None] * _A
        v += _B
        np.minimum(low, (v >> np.uint64(32)).min(0), out=low)
    return low.astype(np.uint32)


SIGNED = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64())), ("sig", pa.binary())])
SIGNED_DDL = "doc_id long, h long, n_shingles long, digest binary, bands array<long>, sig binary"


def _signed(words: int):
    band = np.arange(BANDS, dtype=np.uint64) * _MIX2

    def run(batches):
        for batch in slices(batches):
            sizes, digests, bands, sigs = [], [], [], []
            for text in batch.column(2).to_pylist():
                s = shingle_set(text, words)
                sizes.append(len(s))
                if not len(s):
                    digests.append(None), bands.append(None), sigs.append(None)
                    continue
                digests.append(xxhash.xxh3_128_digest(s.tobytes()))
                sig = signature(s)
                key = band.copy()
                for col in sig.reshape(BANDS, ROWS).T:
                    key = (key ^ (key >> np.uint64(31))) * _MIX + col
                bands.append(((key ^ (key >> np.uint64(29))) * _MIX2).view(np.int64))
                sigs.append(sig[:CHECKS].astype(np.uint16).tobytes())
            made = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.binary())]
            yield pa.RecordBatch.from_arrays(made, schema=SIGNED)

    return run


def least_matches(threshold: float, miss: float = MISS) -> list[tuple[int, int]]:
    """(n, m): after n values a pair with fewer than m equal ones is pruned. With a uniform prior the posterior chance
    of a similarity of threshold or more is that of at most m successes of n + 1 trials at the threshold."""
    out = []
    for n in range(BATCH, CHECKS + 1, BATCH):
        chance, m = 0.0, 0
        while m <= n:
            chance += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if chance >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def _surviving(threshold: float):
    schema = pa.schema([("x", pa.int64()), ("y", pa.int64())])
    bounds = least_matches(threshold)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, CHECKS) for k in (2, 3))
            left, equal = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for n, m in bounds:
                part = slice(n - BATCH, n)
                equal[left] += (a[left, part] == b[left, part]).sum(1)
                left = left[equal[left] >= m]
            yield pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(left)) for k in (0, 1)], schema=schema)

    return run


def _verified(words: int, percent: int):
    """Of rows in order of y: the pairs with 100 * intersection >= percent * union on full sets."""
    schema = pa.schema([("x", pa.int64()), ("y", pa.int64())])

    def run(batches):
        last, own = None, None
        for batch in slices(batches):
            ok = []
            for y, tx, ty in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                if y != last:
                    last, own = y, shingle_set(ty, words)
                other = shingle_set(tx, words)
                both = np.concatenate([own, other])
                both.sort(kind="stable")
                same = int((both[1:] == both[:-1]).sum())
                ok.append(100 * same >= percent * (len(both) - same))
            keep = pa.array(np.flatnonzero(ok))
            yield pa.RecordBatch.from_arrays([batch.column(k).take(keep) for k in (0, 1)], schema=schema)

    return run


class _Block:
    """Classes of one unit: signatures and band keys as matrices, and sets made when a pair first needs them."""

    #: Values of the sets that are kept for further pairs.
    MOST_KEPT = 4 << 20

    def __init__(self, rows: list[tuple], words: int):
        self.words = words
        self.cids, self.roots = (np.asarray([r[k] for r in rows], np.int64) for k in (0, 1))
        self.sigs = np.frombuffer(b"".join(r[2] for r in rows), np.uint16).reshape(-1, CHECKS)
        self.bands = np.frombuffer(b"".join(r[3] for r in rows), np.int64).reshape(-1, BANDS)
        self.texts = [r[4] for r in rows] if rows and len(rows[0]) > 4 else []
        self.sets: dict[int, np.ndarray] = {}
        self.kept = 0

    def set_of(self, k: int) -> np.ndarray:
        if k not in self.sets:
            made = shingle_set(self.texts[k], self.words)
            if self.kept + len(made) > self.MOST_KEPT:
                self.sets.clear()
                self.kept = 0
            self.sets[k] = made
            self.kept += len(made)
        return self.sets[k]


def _survivors(queries: _Block, q: int, members: _Block, band: int, left: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """Those of the members `left` that signatures don't prune, and whose first common bucket with the query is this one:
    each pair is compared in one bucket only."""
    equal = np.zeros(len(left), np.int64)
    for n, m in bounds:
        part = slice(n - BATCH, n)
        equal += (members.sigs[left, part] == queries.sigs[q, part]).sum(1)
        left, equal = left[equal >= m], equal[equal >= m]
    return left[(members.bands[left, :band] != queries.bands[q, :band]).all(1)]


def _wanted(queries: _Block, members: _Block, band: int, bounds: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Which queries and which members are in a pair of different components that signatures leave."""
    asked, wanted = np.zeros(len(queries.cids), bool), np.zeros(len(members.cids), bool)
    for q in range(len(queries.cids)):
        left = _survivors(queries, q, members, band, np.flatnonzero(members.roots != queries.roots[q]), bounds)
        asked[q] = len(left)
        wanted[left] = True
    return asked, wanted


def _block_links(queries: _Block, members: _Block, band: int, bounds: list[tuple[int, int]], percent: int) -> list[tuple[int, int]]:
    """Pairs of components that are linked. Components that links have joined already need no further pair."""
    out: list[tuple[int, int]] = []
    over: dict[int, int] = {}

    def top(root: int) -> int:
        while root in over:
            root = over[root]
        return root

    for q in range(len(queries.cids)):
        mine = top(int(queries.roots[q]))
        names, at = np.unique(members.roots, return_inverse=True)
        other = np.asarray([top(r) != mine for r in names.tolist()], bool)[at] if len(names) else np.zeros(0, bool)
        left = _survivors(queries, q, members, band, np.flatnonzero(other), bounds)
        own = queries.set_of(q) if len(left) else None
        for k in left.tolist():
            theirs = top(int(members.roots[k]))
            if theirs == mine:
                continue
            other_set = members.set_of(k)
            place = np.minimum(np.searchsorted(own, other_set), len(own) - 1)
            same = int((own[place] == other_set).sum())
            if 100 * same >= percent * (len(own) + len(other_set) - same):
                over[max(mine, theirs)] = mine = min(mine, theirs)
                out.append((int(queries.roots[q]), int(members.roots[k])))
    return out


def _values(column: pa.Array) -> list:
    """Python values; band keys as bytes."""
    if pa.types.is_list(column.type):
        return [row.tobytes() for row in column.flatten().to_numpy().reshape(len(column), BANDS)]
    return column.to_pylist()


def _units(work):
    """work(queries, members, unit) for each unit of rows (key, band, qb, mb, query, ...), in order of key, band, qb and mb.
    query: 0 for a member, 1 for a query, 2 for both."""

    def run(batches):
        unit, rows = None, [[], []]
        for batch in slices(batches):
            columns = [_values(c) for c in batch.columns]
            for key, band, qb, mb, query, *row in zip(*columns, strict=True):
                if (key, band, qb, mb) != unit:
                    if unit is not None and rows[0] and rows[1]:
                        yield work(rows[1], rows[0], unit)
                    unit, rows = (key, band, qb, mb), [[], []]
                for which in (0, 1) if query == 2 else (query,):
                    rows[which].append(tuple(row))
        if unit is not None and rows[0] and rows[1]:
            yield work(rows[1], rows[0], unit)

    return run


UNIT_DDL = "key long, band int, qb int, mb int, query int"


def _sieve(words: int, bounds: list[tuple[int, int]]):
    """The rows (unit, cid, root, sig, bands) that are in a pair which signatures leave."""
    schema = pa.schema([("key", pa.int64()), ("band", pa.int32()), ("qb", pa.int32()), ("mb", pa.int32()), ("query", pa.int32()), ("cid", pa.int64()), ("root", pa.int64())])

    def work(asked: list[tuple], members: list[tuple], unit: tuple) -> pa.RecordBatch:
        queries, all_ = _Block(asked, words), _Block(members, words)
        found = _wanted(queries, all_, unit[1], bounds)
        asks, held = (dict(zip(b.cids[some].tolist(), b.roots[some].tolist(), strict=True)) for b, some in zip((queries, all_), found, strict=True))
        rows = [(*unit, 2 if cid in asks and cid in held else int(cid in asks), cid, root) for cid, root in (held | asks).items()]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    return _units(work)


def _in_blocks(words: int, percent: int, bounds: list[tuple[int, int]]):
    """Rows (unit, cid, root, sig, bands, text): components that are linked."""
    schema = pa.schema([("x", pa.int64()), ("y", pa.int64())])

    def work(asked: list[tuple], members: list[tuple], unit: tuple) -> pa.RecordBatch:
        found = _block_links(_Block(asked, words), _Block(members, words), unit[1], bounds, percent)
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], schema=schema)

    return _units(work)


#: A bucket of more comparisons than this is divided by prefixes. Classes and shingles of the sample that orders shingles.
MOST_COMPARISONS, SAMPLE_CLASSES, MOST_COMMON = 1 << 23, 2000, 1 << 16


def prefix(shingles: np.ndarray, percent: int, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first n - ceil(percent * n / 100) + 1 of a set's n shingles, those that aren't common before those that are.

    Two sets whose similarity reaches percent have a shingle of their prefixes in common, whatever the order is, if it is
    the same for all. common: sorted hashes, with the rank of each among them."""
    at = np.minimum(np.searchsorted(common, shingles), max(0, len(common) - 1))
    is_common = common[at] == shingles if len(common) else np.zeros(len(shingles), bool)
    late = shingles[is_common]
    late = late[np.argsort(rank[at[is_common]], kind="stable")] if len(late) else late
    least = -(-percent * len(shingles) // 100)
    return np.concatenate([shingles[~is_common], late])[: len(shingles) - least + 1]


def _shingles(words: int):
    def run(batches):
        for batch in slices(batches):
            found = [shingle_set(t, words).view(np.int64) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"key": pa.array(np.concatenate(found))})

    return run


def _prefixes(words: int, percent: int, common):
    def run(batches):
        hashes, rank = common.value
        for batch in slices(batches):
            found = [prefix(shingle_set(t, words), percent, hashes, rank).view(np.int64) for t in batch.column(3).to_pylist()]
            each = np.repeat(np.arange(batch.num_rows), [len(f) for f in found])
            # texts stay behind
            rows = [batch.column(k).take(pa.array(each)) for k in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), *rows], names=["key", "cid", "root", "n_shingles"])

    return run


def _by_prefix(crowded: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The classes of crowded buckets, crowded(cid, root, n_shingles), placed by the shingles of their prefixes.

    Texts of one template are alike in what is common and differ in what is rare, so rare shingles are first in order and
    few classes meet. What is common is learnt from a bounded sample; it decides how many meet, never which links there are."""
    spark = crowded.sparkSession
    full = cut(crowded.join(texts, "cid").select("cid", "root", "n_shingles", "text"), "crowded")
    every = max(1, full.count() // SAMPLE_CLASSES)
    sample = in_arrow(full.where(F.pmod(F.xxhash64("cid"), F.lit(every)) == 0).select("text"), _shingles(words), "key long")
    top = sample.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "key").limit(MOST_COMMON).select("key").toArrow().column("key").to_numpy()
    hashes = top.view(np.uint64)[::-1]  # the most frequent last
    by = np.argsort(hashes)
    found = in_arrow(full, _prefixes(words, percent, spark.sparkContext.broadcast((hashes[by], by))), "key long, cid long, root long, n_shingles long")
    placed = cut(found, "prefixes")
    met = cut(placed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "met")
    return placed.join(met, "key").select("key", F.lit(0).alias("band"), "cid", "n_shingles", "root")


def _in_units(placed: DataFrame, most: int | None) -> tuple[DataFrame, DataFrame]:
    """placed(key, band, cid, n_shingles, root): the classes of keys of several components, in blocks of members and
    queries; and the classes of keys with more than `most` comparisons, which have no blocks."""
    placed = cut(placed, "placed")
    by_root = placed.groupBy("key", "root").agg(F.count("*").alias("n"))
    mains = cut(by_root.groupBy("key").agg(F.count("*").alias("roots"), F.max_by("root", F.struct("n", "root")).alias("main")).where("roots > 1").select("key", "main"), "mains")
    part = cut(placed.join(mains, "key").select("key", "band", "cid", "root", "n_shingles", (F.col("root") != F.col("main")).cast("int").alias("query")), "part")
    many = lambda own: F.ceil(F.greatest(F.sum(own) / BLOCK, F.sum(own * F.col("n_shingles")) / BLOCK_SHINGLES)).cast("int")
    sizes = cut(part.groupBy("key").agg(many(F.lit(1)).alias("nb"), many(F.col("query")).alias("nq"), (F.count("*") * F.sum("query")).alias("work")), "blocks")
    all_ = part.join(sizes, "key")
    dealt = all_ if most is None else all_.where(F.col("work") <= most)
    block = lambda n: F.pmod(F.xxhash64("cid"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    single = (F.col("nb") == 1) & (F.col("nq") == 1)
    # in one block a query is a row, which is a member as well
    whole = dealt.where(single).select("key", "band", F.lit(0).alias("qb"), F.lit(0).alias("mb"), (2 * F.col("query")).alias("query"), "cid", "root")
    dealt = dealt.where(~single)
    own = dealt.select("key", "band", every("nq").alias("qb"), block("nb").alias("mb"), F.lit(0).alias("query"), "cid", "root")
    asked = dealt.where("query = 1").select("key", "band", block("nq").alias("qb"), every("nb").alias("mb"), F.lit(1).alias("query"), "cid", "root")
    crowded = all_.where(F.lit(False) if most is None else F.col("work") > most).select("cid", "root", "n_shingles").distinct()
    return whole.unionByName(own).unionByName(asked), crowded


def _rest_links(members: DataFrame, roots: DataFrame, classes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs of roots of components that are linked, among components that a bucket has in common.

    Work is dealt by bucket: a query meets the classes of its own buckets only. In a bucket of two classes the leaders'
    comparison was complete. The classes of buckets with more than MOST_COMPARISONS comparisons meet by their prefixes
    instead, exactly. Blocks hold at most about BLOCK classes and BLOCK_SHINGLES shingles. Signatures come first; texts move
    only for classes that are in a pair which signatures leave."""
    bounds = least_matches(percent / 100)
    placed = members.where("n > 2").join(roots.withColumnRenamed("node", "cid"), "cid", "left").select("key", "band", "cid", "n_shingles", F.coalesce("root", "cid").alias("root"))
    rows, crowded = _in_units(placed, MOST_COMPARISONS)
    crowded = cut(crowded, "crowded")
    if crowded.limit(1).count():
        rows = rows.unionByName(_in_units(_by_prefix(crowded, texts, words, percent), None)[0])

    def in_units(rows: DataFrame) -> DataFrame:
        return rows.repartition("key", "qb", "mb").sortWithinPartitions("key", "band", "qb", "mb")

    signed = rows.join(classes.select("cid", "sig", "bands"), "cid").select("key", "band", "qb", "mb", "query", "cid", "root", "sig", "bands")
    wanted = cut(in_arrow(in_units(signed), _sieve(words, bounds), f"{UNIT_DDL}, cid long, root long"), "wanted")
    full = wanted.join(classes.select("cid", "sig", "bands"), "cid").join(texts, "cid").select("key", "band", "qb", "mb", "query", "cid", "root", "sig", "bands", "text")
    return cut(in_arrow(in_units(full), _in_blocks(words, percent, bounds), "x long, y long"), "more")


def _links(pairs: DataFrame, classes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (x, y) of classes that the signatures leave and the full sets confirm."""
    sigs = classes.select("cid", "sig")
    both = pairs.join(sigs.select(F.col("cid").alias("x"), F.col("sig").alias("sx")), "x").join(sigs.select(F.col("cid").alias("y"), F.col("sig").alias("sy")), "y")
    left = cut(in_arrow(both.select("x", "y", "sx", "sy"), _surviving(percent / 100), "x long, y long"), "pairs")
    tx, ty = texts.select(F.col("cid").alias("x"), F.col("text").alias("tx")), texts.select(F.col("cid").alias("y"), F.col("text").alias("ty"))
    rows = left.join(tx, "x").join(ty, "y").select("x", "y", "tx", "ty").sortWithinPartitions("y")
    return cut(in_arrow(rows, _verified(words, percent), "x long, y long"), "links")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, h (hash of the text), n_shingles, component_id, kept: a row for each row of docs(doc_id, text, ...).

    Texts are linked if 100 * intersection >= percent * union of their sets of shingles of so many words; a text with
    fewer words has the whole as its one shingle; a null, empty or blank text has none and is linked with nothing.
    component_id is the smallest doc_id that links reach, itself included; kept: doc_id = component_id. Rows with one
    doc_id are the same document: all with the smallest one stay. Null ids come after all others, and such a row stays
    only if its component has no id at all. Texts may be of any length. An empty table gives an empty one; other columns
    aren't read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text")).select("doc_id", F.xxhash64("text").alias("h"), "text")
    with scratch(docs.sparkSession) as kept:
        rows = cut(in_arrow(docs, _signed(words), SIGNED_DDL), "signed")
        kept.append(rows)
        found = _components(docs, rows, words, percent)
        kept.append(found)
    out = rows.select("doc_id", "h", "n_shingles", "digest").join(found, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "h", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _components(docs: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame:
    """digest, component_id of each class of equal sets."""
    firsts = [F.first(c).alias(c) for c in ("n_shingles", "bands", "sig")]
    classes = rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("least"), F.min_by(F.struct("doc_id", "h"), F.struct(F.col("doc_id").isNull(), "doc_id", "h")).alias("rep"), *firsts)
    classes = cut(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    members = classes.select("cid", "n_shingles", F.posexplode("bands").alias("band", "key"))
    buckets = cut(members.groupBy("key").agg(F.count("*").alias("n"), F.min("cid").alias("first"), F.max("cid").alias("last")).where("n > 1"), "buckets")
    members = cut(members.join(buckets, "key"), "members")
    needed = members.select("cid").distinct().join(classes.select("cid", "rep"), "cid")
    same = docs["doc_id"].eqNullSafe(F.col("rep.doc_id")) & (docs["h"] == F.col("rep.h"))
    texts = cut(docs.join(needed, same).groupBy("cid").agg(F.first("text").alias("text")), "texts")
    # a star in each bucket, from the first and from the last class
    star = members.where("cid <> first").select(F.col("cid").alias("x"), F.col("first").alias("y")).unionByName(members.where("cid <> last").select(F.col("cid").alias("x"), F.col("last").alias("y")))
    star = cut(star.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct(), "star")
    links = _links(star, classes, texts, words, percent)
    roots = cut(connected_components(links.toDF("u", "v")), "roots")
    more = _rest_links(members, roots, classes, texts, words, percent)
    over = connected_components(more.toDF("u", "v")).select(F.col("node").alias("root"), F.col("root").alias("over"))
    roots = roots.join(over, "root", "left").select("node", F.coalesce("over", "root").alias("root")).unionByName(over.join(roots, over["root"] == roots["node"], "left_anti").select(F.col("root").alias("node"), F.col("over").alias("root")))
    # names of components: the smallest id among their classes
    named = classes.select("cid", "digest", "least").join(roots.withColumnRenamed("node", "cid"), "cid", "left").select("digest", "least", F.coalesce("root", "cid").alias("root"))
    names = cut(named.groupBy("root").agg(F.min("least").alias("component_id")), "names")
    return cut(named.join(names, "root").select("digest", "component_id"), "found")


def near_duplicate_report(docs: DataFrame, words: int = 2, percent: int = 80) -> DataFrame:
    return near_duplicates(docs, words, percent).select("doc_id", "n_shingles", "component_id", "kept")
