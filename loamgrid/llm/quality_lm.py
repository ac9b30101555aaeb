"""Quality by the perplexity of an interpolated modified Kneser-Ney model trained on trusted text.

The n-grams are of ORDER code points, each for itself: the model grows with what the trusted text holds, in any script. Each
task counts its own n-grams and sums are sharded by n-gram. The lower orders' continuation counts, the contexts' totals,
the discounted shares and the weights of the lower order are tables sharded by n-gram or context; nothing sends them whole
to anywhere.

The distinct n-grams of all documents join these tables, order by order, which gives each one its log-probability. The
HEAVY most frequent of them go to the executors (a table of a fixed bound), where a scan sums them for each document. All
other n-grams leave that scan as rows (document, n-gram, how often), join their log-probabilities by n-gram, and are summed
for each document. Whether an n-gram is heavy decides where it is looked up, never what it counts.

A language's threshold comes from quantiles of its documents' scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, in_arrow, scratch, slices

ORDER = 4
#: N-grams whose log-probabilities go to every executor (12 bytes each).
HEAVY = 1 << 17
#: Distinct n-grams that a task sums up before it hands them on, and bytes of text that it works on at once (times 80 in arrays).
MOST_HELD, SLICE = 1 << 17, 1 << 20
#: Ids of trusted documents that are broadcast (16 bytes each); more are joined by a shuffle.
MOST_IDS = 1 << 21
#: A document is kept up to the median plus so many times the distance from the median to the upper quartile.
FENCE = 8.0
#: Least distance, in nats a symbol, and symbols at the language's median that each score is averaged with.
LEAST_SPREAD, PRIOR = 0.02, 100.0


def _discounts(counts: DataFrame) -> list[float]:
    """Modified Kneser-Ney's three discounts from the numbers of n-grams with counts of 1 to 4."""
    have = {r.n: r.k for r in counts.where("n <= 4").groupBy("n").agg(F.count("*").alias("k")).collect()}
    n1, n2, n3, n4 = (have.get(k, 0) for k in (1, 2, 3, 4))
    if not n1 or not n2:
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    out = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.0]
    return [min(max(d, 0.05), k - 0.05) for k, d in enumerate(out, 1)]


def distinct_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct n-grams of code points as rows of ORDER numbers (0 stands before a text, U+FFFD for U+0000), the row of
    the n-gram that ends at each symbol, and where each text begins."""
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    begins = np.cumsum(sizes) - sizes
    s = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    s = np.where(s == 0, np.uint32(0xFFFD), s)
    seen = np.zeros(0x110000, bool)
    seen[s] = True
    points = np.append(0, np.flatnonzero(seen)).astype(np.uint32)
    place_of = np.zeros(0x110000, np.uint64)
    place_of[points] = np.arange(len(points), dtype=np.uint64)
    ids, place = place_of[s], np.arange(len(s)) - np.repeat(begins, sizes)
    bits = np.uint64(int(len(points)).bit_length())

    def before(k: int) -> np.ndarray:
        back = np.zeros_like(ids)
        back[k:] = ids[: len(ids) - k]
        back[place < k] = 0
        return back

    firsts, lasts = before(3) << bits | before(2), before(1) << bits | ids
    half = np.uint64(2) * bits
    if half <= 32:
        both, heads, tails = firsts << half | lasts, None, None
    else:  # more than 65,535 different code points: number the halves
        heads, a = np.unique(firsts, return_inverse=True)
        tails, b = np.unique(lasts, return_inverse=True)
        half = np.uint64(32)
        both = a.astype(np.uint64) << half | b.astype(np.uint64)
    found = np.unique(both)
    row = np.searchsorted(found, both)
    hi, lo = found >> half, found & ((np.uint64(1) << half) - np.uint64(1))
    if heads is not None:
        hi, lo = heads[hi.astype(np.int64)], tails[lo.astype(np.int64)]
    mask = (np.uint64(1) << bits) - np.uint64(1)
    return np.stack([points[(k & mask).astype(np.int64)] for k in (hi >> bits, hi, lo >> bits, lo)], axis=1), row, begins


def _hashes(rows: np.ndarray) -> np.ndarray:
    """64-bit hashes of rows of code points."""
    h = np.full(len(rows), 0x2545F4914F6CDD1D, np.uint64)
    for k in range(rows.shape[1]):
        h = (h ^ rows[:, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return h


def _strings(rows: np.ndarray) -> list[str]:
    return np.ascontiguousarray(rows, np.uint32).view(f"<U{ORDER}").ravel().tolist() if len(rows) else []


def _count_grams(batches):
    """gram, n: of all the task's texts together, as far as MOST_HELD distinct ones go."""
    held, counts = np.zeros((0, ORDER), np.uint32), np.zeros(0, np.int64)

    def out():
        for a in range(0, len(held), 1 << 16):
            yield pa.RecordBatch.from_pydict({"gram": pa.array(_strings(held[a : a + (1 << 16)]), pa.string()), "n": pa.array(counts[a : a + (1 << 16)])})

    for batch in slices(batches, most_bytes=SLICE):
        rows, row, _ = distinct_grams([t or "" for t in batch.column(0).to_pylist()])
        if not len(rows):
            continue
        both = np.concatenate([held, rows])
        n = np.concatenate([counts, np.bincount(row, minlength=len(rows))])
        as_one = both.view(f"V{4 * ORDER}").ravel()
        _, first, inverse = np.unique(as_one, return_index=True, return_inverse=True)
        held, counts = both[first], np.bincount(inverse, n, len(first)).astype(np.int64)
        if len(held) > MOST_HELD:
            yield from out()
            held, counts = held[:0], counts[:0]
    yield from out()


def counted(texts: DataFrame) -> DataFrame:
    """gram, n of texts(text): the n-gram that ends at each code point, \\0 standing before the text."""
    return in_arrow(texts, _count_grams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def train(texts: DataFrame) -> dict[int, tuple[DataFrame, DataFrame]]:
    """For each order the tables (gram, share), the discounted shares of n-grams after their contexts, and (context,
    weight), the lower order's weights. texts(text): all trusted text."""
    counts = cut(counted(texts), "grams")
    model: dict[int, tuple[DataFrame, DataFrame]] = {}
    for order in range(ORDER, 0, -1):
        d1, d2, d3 = _discounts(counts)
        discount = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        own = counts.withColumn("context", F.substring("gram", 1, order - 1)).withColumn("d", discount)
        sums = cut(own.groupBy("context").agg(F.sum("n").alias("total"), F.sum("d").alias("given")), "contexts")
        shares = cut(own.join(sums, "context").select("gram", ((F.col("n") - F.col("d")) / F.col("total")).alias("share")), "shares")
        model[order] = (shares, sums.select("context", (F.col("given") / F.col("total")).alias("weight")))
        if order > 1:
            # continuation counts: before how many symbols' n-grams the shorter one stands
            counts = cut(counts.groupBy(F.substring("gram", 2, order - 1).alias("gram")).agg(F.count("*").alias("n")), "grams")
    return model


def log_probabilities(model: dict[int, tuple[DataFrame, DataFrame]], grams: DataFrame) -> DataFrame:
    """grams(gram, ...), each n-gram once, with log_p: the natural logarithm of its last symbol's probability after the
    others. A join for each table of counts, sharded by n-gram or context."""
    # all symbols seen, and one for the others, are equally likely below the first order
    out = grams.withColumn("p", F.lit(1 / (model[1][0].count() + 1)))
    for order in range(1, ORDER + 1):
        shares, weights = model[order]
        part = F.substring("gram", ORDER - order + 1, order)
        out = out.withColumn("part", part).withColumn("context", F.substring("part", 1, order - 1))
        out = out.join(shares.withColumnRenamed("gram", "part"), "part", "left").join(weights, "context", "left")
        out = out.withColumn("p", F.coalesce("weight", F.lit(1.0)) * F.col("p") + F.coalesce("share", F.lit(0.0))).drop("part", "context", "share", "weight")
    return out.withColumn("log_p", F.log("p")).drop("p")


def _sums(heavy):
    """A row for each document with the sum over its heavy n-grams, and one for each other distinct n-gram in it."""
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("lang", pa.string()), ("n_symbols", pa.int64()), ("nats", pa.float64()), ("gram", pa.string()), ("n", pa.int64())])

    def run(batches):
        keys, values = heavy.value
        for batch in slices(batches, most_bytes=SLICE):
            texts = [t or "" for t in batch.column(3).to_pylist()]
            rows, row, begins = distinct_grams(texts)
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            h = _hashes(rows)
            at = np.minimum(np.searchsorted(keys, h), max(0, len(keys) - 1))
            known = keys[at] == h if len(keys) else np.zeros(len(h), bool)
            log_p = np.where(known, values[at] if len(keys) else 0.0, 0.0)
            sums = np.append(np.cumsum(log_p[row], dtype=np.float64), 0.0)
            nats = np.where(sizes > 0, np.where(begins > 0, sums[begins - 1], 0.0) - sums[begins + sizes - 1], 0.0)
            none = pa.nulls(len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(sizes), pa.array(nats), none.cast(pa.string()), none.cast(pa.int64())], schema=schema)
            light = np.flatnonzero(~known[row])
            if len(light):
                doc = np.repeat(np.arange(len(texts)), sizes)[light]
                pairs, n = np.unique(doc * len(rows) + row[light], return_counts=True)
                doc, gram = pa.array(pairs // len(rows)), _strings(rows[pairs % len(rows)])
                nothing = pa.nulls(len(pairs))
                yield pa.RecordBatch.from_arrays([*(batch.column(k).take(doc) for k in (0, 1, 2)), nothing.cast(pa.int64()), nothing.cast(pa.float64()), pa.array(gram, pa.string()), pa.array(n)], schema=schema)

    return run


def perplexities(docs: DataFrame, model: dict[int, tuple[DataFrame, DataFrame]], heavy: int = HEAVY) -> DataFrame:
    """doc_id, lang, n_symbols, nats: the length and the negative log-likelihood of each whole text."""
    spark = docs.sparkSession
    # rows with equal ids, languages and texts have equal sums, so they may share one
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("h"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    every = cut(log_probabilities(model, cut(counted(texts.select("text")), "seen")), "log-p")
    top = every.orderBy(F.desc("n"), "gram").limit(heavy).toPandas()
    h = _hashes(np.frombuffer("".join(top.gram).encode("utf-32-le"), np.uint32).reshape(-1, ORDER))
    order = np.argsort(h)
    table = spark.sparkContext.broadcast((h[order], top.log_p.to_numpy(np.float32)[order]))
    rows = cut(in_arrow(texts, _sums(table), "doc_id long, h long, lang string, n_symbols long, nats double, gram string, n long"), "sums")
    light = rows.where("gram IS NOT NULL").join(every.select("gram", "log_p"), "gram").select("doc_id", "h", "lang", F.lit(None).cast("long").alias("n_symbols"), (-F.col("n") * F.col("log_p")).alias("nats"), F.lit(0).alias("base"))
    own = rows.where("gram IS NULL").select("doc_id", "h", "lang", "n_symbols", "nats", F.lit(1).alias("base"))
    sums = own.unionByName(light).groupBy("doc_id", "h", "lang").agg(F.max("n_symbols").alias("n_symbols"), F.sum("nats").alias("nats"), F.sum("base").alias("copies"))
    return sums.select("doc_id", "lang", "n_symbols", (F.col("nats") / F.col("copies")).alias("nats"), F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("col")


def classify(docs: DataFrame, trusted: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """doc_id, lang, n_symbols, perplexity, threshold, kept: a row for each row of docs(doc_id, text, lang, ...).

    trusted(doc_id): the documents to learn from; ids that are null or in no document teach nothing. perplexity is a
    symbol's; kept: the perplexity, averaged with PRIOR symbols at the language's median so that short texts aren't
    judged by a few symbols, is at most the language's threshold. A null or empty text has perplexity null and isn't kept.
    A null language is a language like others; ties with a threshold are kept; equal rows have equal results. Without
    trusted text all symbols are equally likely and every text with a symbol is kept. Texts may be of any length. An empty
    table gives an empty one. Other columns aren't read.
    """
    with scratch(docs.sparkSession) as stays:
        teach = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text")).where("text <> ''")
        ids = cut(trusted.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("id")).distinct(), "trusted")
        few = ids.count() <= MOST_IDS
        scored = cut(perplexities(docs, train(teach.join(F.broadcast(ids) if few else ids, "id", "left_semi").select("text")), heavy), "scored")
        rate = F.col("nats") / F.col("n_symbols")
        by_lang = scored.where("n_symbols > 0").groupBy(F.col("lang").alias("lang_")).agg(F.percentile_approx(rate, F.array(F.lit(0.5), F.lit(0.75)), 10_000).alias("q"))
        q = cut(by_lang.select("lang_", F.col("q")[0].alias("median"), (F.col("q")[0] + FENCE * F.greatest(F.col("q")[1] - F.col("q")[0], F.lit(LEAST_SPREAD))).alias("most")), "thresholds")
        stays += [scored, q]
    joined = scored.join(q, F.col("lang").eqNullSafe(F.col("lang_")), "left")
    shrunk = (F.col("nats") + PRIOR * F.col("median")) / (F.col("n_symbols") + PRIOR)
    kept = F.coalesce((F.col("n_symbols") > 0) & (shrunk <= F.col("most")), F.lit(False))
    return joined.select("doc_id", "lang", "n_symbols", F.when(F.col("n_symbols") > 0, F.exp(rate)).alias("perplexity"), F.exp("most").alias("threshold"), kept.alias("kept"))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """classify() with the documents that labels(doc_id, quality) marks 1 as trusted, and none marks 0."""
    judged = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return classify(docs, judged.where("quality = 1").select("doc_id"))
