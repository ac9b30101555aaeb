"""URL filters: host and path rules, and for URLs without a rule a character language-model ratio.

Two smoothed variable-order Markov models, of accepted and of rejected URLs, learn from all URLs that a rule judges. A
character's probability interpolates the contexts of 0 to ORDER characters, each by how many different characters were
seen after it (Witten-Bell); a context never seen passes the shorter one's on, so the order varies. Contexts and n-grams
are known by 64-bit hashes. Counts stay tables sharded by n-gram and by context; the distinct n-grams of all URLs join
them order by order, each with the probability of the n-gram that is shorter by one character. The most frequent n-grams'
likelihood ratios (a fixed number) go to all tasks, all others are joined to the URLs that have them, and only sums return.
The mean difference of log-likelihoods per character is compared with a threshold calibrated on judged URLs that were held
out from a model of the others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, cut, free_name, in_arrow, scratch, slices

ORDER = 5
#: Bytes of URLs that are worked on together: arrays take over a hundred bytes for each.
MOST_BYTES = 1 << 18
#: Of the judged URLs one in so many, by a hash, calibrates a model that has learnt from the others.
HELD = 5
#: Bins of the calibration's histogram, over differences of -RANGE to RANGE a character.
BINS, RANGE = 4001, 4.0
#: N-grams whose likelihood ratios go to every task (24 bytes each).
MOST_FREQUENT = 131_072
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def host_of(url: Column) -> Column:
    after = F.substring_index(F.substring_index(F.substring_index(_after(url), "/", 1), "?", 1), "#", 1)
    return F.when(_whole(url), F.translate(after, UPPER, LOWER)).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.regexp_extract(_after(url), r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(_whole(url), rest).otherwise(F.lit(""))


def _whole(url: Column) -> Column:
    return F.coalesce(F.instr(url, "://") > 0, F.lit(False))


def _after(url: Column) -> Column:
    return url.substr(F.instr(url, "://") + 3, F.length(url))


def with_rules(df: DataFrame, rules: list[tuple[str, bool]]) -> DataFrame:
    """df(host, path) with rule (the longest that fits, else null) and allowed (by it). rules: host and path as one, and
    whether it allows; of rules of one length the first in order of text wins. A list of settings: few by nature."""
    rule, allowed = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for text, allows in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        host, slash, path = text.partition("/")
        host = host.translate(str.maketrans(UPPER, LOWER))
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit(f".{host}"))) & F.startswith(F.col("path"), F.lit(slash + path))
        rule, allowed = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(allows)).otherwise(allowed)
    return df.withColumns({"rule": rule, "allowed": allowed})


def hashes(urls: list[str], coding: str = "utf-8") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each byte of all URLs, by order: the hash of its context and that of the context with the byte; where each URL
    begins, with one more byte 0 at its end."""
    coded = [u.encode(coding) + b"\0" for u in urls]
    sizes = np.fromiter(map(len, coded), np.int64, len(coded))
    begins = np.cumsum(sizes) - sizes
    s = np.frombuffer(b"".join(coded), np.uint8).astype(np.uint64) + np.uint64(1)
    place = np.arange(len(s)) - np.repeat(begins, sizes)
    h = np.zeros(len(s), np.uint64)
    contexts, grams = np.empty((ORDER + 1, len(s)), np.int64), np.empty((ORDER + 1, len(s)), np.int64)
    for order in range(ORDER + 1):
        if order:
            back = np.zeros_like(s)
            back[order:] = s[:-order]
            back[place < order] = 0
            h = (h + back) * _K1
            h ^= h >> np.uint64(29)
        seed = (h + np.uint64(order)) * _K2
        contexts[order] = seed.view(np.int64)
        gram = (seed ^ s) * _K1
        gram = (gram ^ (gram >> np.uint64(31))) * _K2
        grams[order] = gram.view(np.int64)
    return contexts, grams, begins


def _blocks(urls: list[str]):
    """Hashes of contexts and n-grams by order, and the number of the URL of each byte, for some MOST_BYTES at a time; a URL
    that is longer comes in stretches, which begin with the ORDER bytes before them."""
    base = 0
    for (part,) in _stretches(urls):
        if len(part) == 1 and len(part[0]) > MOST_BYTES:
            for contexts, grams in _parts(part[0]):
                yield contexts, grams, np.full(contexts.shape[1], base)
        elif part:
            contexts, grams, begins = hashes(part)
            yield contexts, grams, base + np.repeat(np.arange(len(part)), np.diff(np.append(begins, contexts.shape[1])))
        base += len(part)


def _parts(url: str):
    data = url.encode()
    for a in range(0, len(data) + 1, MOST_BYTES):
        before = min(a, ORDER)
        contexts, grams, _ = hashes([data[a - before : a + MOST_BYTES].decode("latin-1")], "latin-1")
        own = slice(before, None if a + MOST_BYTES > len(data) else -1)  # the byte 0 stands behind the last stretch alone
        yield contexts[:, own], grams[:, own]


def _counted(batches):
    """n of each (label, context, gram), and learnt: how many of these are of URLs that aren't held out."""
    for batch in slices(batches, most_bytes=MOST_BYTES):
        urls, labels, held = (c.to_pylist() for c in batch.columns)
        labels, held = np.asarray(labels, np.int64), np.asarray(held, bool)
        for contexts, grams, url in _blocks(urls):
            label, out = labels[url], held[url]
            for k in (0, 1):
                # a gram's hash has its context's in it
                own = label == k
                found, first, at, n = np.unique(grams[:, own].ravel(), return_index=True, return_inverse=True, return_counts=True)
                learnt = np.bincount(at, np.tile(~out[own], ORDER + 1), len(found)).astype(np.int64)
                context = contexts[:, own].ravel()[first]
                yield pa.RecordBatch.from_pydict({"label": pa.array(np.full(len(found), k)), "context": pa.array(context), "gram": pa.array(found), "n": pa.array(n.astype(np.int64)), "learnt": pa.array(learnt)})


def _stretches(urls: list, *others: list):
    """Lists of URLs with their other columns, of about MOST_BYTES characters together; a longer URL comes alone."""
    begin, total = 0, 0
    for k, u in enumerate(urls):
        if k > begin and total + len(u or "") > MOST_BYTES:
            yield urls[begin:k], *(x[begin:k] for x in others)
            begin, total = k, 0
        total += len(u or "")
    yield urls[begin:], *(x[begin:] for x in others)


def _sorted(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    at = np.argsort(keys)
    return keys[at], *(v[at].astype(np.float32) for v in values)


def _places(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where in the sorted keys, at least one, each wanted one is, and whether it is there."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Ratio:
    """The models as local tables, for URLs that are scored outside of Spark; they hold every n-gram that was seen, so this is
    for rule sets that judge few URLs. For each of the two models: sorted hashes of n-grams with counts, of contexts with totals and distinct followers."""

    def __init__(self):
        none = np.zeros(0, np.int64), np.zeros(0, np.float32)
        self.grams = [none, none]
        self.contexts = [(*none, none[1])] * 2
        self.threshold = 0.0

    def differences(self, urls: list[str]) -> np.ndarray:
        """Mean log-likelihood a byte as accepted, less that as rejected."""
        return np.concatenate([self._differences(part) for (part,) in _stretches(urls)])

    def _differences(self, urls: list[str]) -> np.ndarray:
        if len(urls) == 1 and len(urls[0]) > MOST_BYTES:
            return np.array([self._long(urls[0])])
        contexts, grams, begins = hashes(urls)
        if not len(begins):
            return np.zeros(0)
        sizes = np.diff(np.append(begins, contexts.shape[1]))
        return np.add.reduceat(self._logs(contexts, grams), begins) / sizes

    def _long(self, url: str) -> float:
        """A URL longer than MOST_BYTES, in stretches that begin with the ORDER bytes before them."""
        total = sum(float(self._logs(contexts, grams).sum()) for contexts, grams in _parts(url))
        return total / (len(url.encode()) + 1)

    def _logs(self, contexts: np.ndarray, grams: np.ndarray) -> np.ndarray:
        logs = []
        for k in (1, 0):
            p = np.full(contexts.shape[1], 1 / 257)
            (gram, count), (context, total, followers) = self.grams[k], self.contexts[k]
            for c, g in zip(contexts, grams, strict=True):
                if not len(context):
                    break
                at, known = _places(context, c)
                t = np.where(known, followers[at], 0)
                by, seen = _places(gram, g)
                p = np.where(known, (np.where(seen, count[by], 0) + t * p) / np.maximum(np.where(known, total[at], 0) + t, 1), p)
            logs.append(np.log(p))
        return logs[0] - logs[1]


def is_held(url: Column) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(HELD)) == 0


def counted(judged: DataFrame) -> DataFrame:
    """label, context, gram, n, learnt of judged(url, allowed): all URLs with a rule's verdict."""
    rows = judged.where("url IS NOT NULL").select("url", F.col("allowed").cast("int").alias("label"), is_held(F.col("url")).alias("held"))
    return cut(in_arrow(rows, _counted, "label long, context long, gram long, n long, learnt long").groupBy("label", "context", "gram").agg(F.sum("n").alias("n"), F.sum("learnt").alias("learnt")), "contexts")


def fit(judged: DataFrame) -> Ratio:
    """judged(url, allowed): all URLs with a rule's verdict."""
    return _tables(counted(judged), "n")


def _tables(counts: DataFrame, of: str) -> Ratio:
    ratio = Ratio()
    for k in (0, 1):
        own = counts.where((F.col("label") == k) & (F.col(of) > 0)).select("context", "gram", F.col(of).alias("n"))
        grams = own.select("gram", "n").toPandas()
        contexts = own.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("followers")).toPandas()
        ratio.grams[k] = _sorted(grams.gram.to_numpy(np.int64), grams.n.to_numpy())
        ratio.contexts[k] = _sorted(contexts.context.to_numpy(np.int64), contexts.total.to_numpy(), contexts.followers.to_numpy())
    return ratio


def _scored(df: DataFrame, ratio: Ratio) -> DataFrame:
    """df with the column difference."""
    shared = df.sparkSession.sparkContext.broadcast(ratio)
    at = df.columns.index("url")

    def run(batches):
        for batch in slices(batches):
            made = shared.value.differences([u or "" for u in batch.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.float64())], names=[*batch.schema.names, "difference"])

    return in_arrow(df, run, df.withColumn("difference", F.lit(0.0)).schema)


def calibrate(ratio: Ratio, judged: DataFrame) -> float:
    """threshold() of judged(url, allowed), scored by local tables."""
    return threshold(_scored(judged.where("url IS NOT NULL").select("url", "allowed"), ratio))


def threshold(rows: DataFrame) -> float:
    """The difference that parts accepted and rejected URLs with the least mean error rate: the middle of the best
    stretch of a histogram over all of rows(allowed, difference). 0 if all have one verdict."""
    place = F.least(F.greatest(F.round((F.col("difference") + RANGE) / (2 * RANGE) * (BINS - 1)), F.lit(0)), F.lit(BINS - 1)).cast("int")
    n = np.zeros((2, BINS))
    for r in rows.groupBy("allowed", place.alias("bin")).agg(F.count("*").alias("n")).collect():
        n[int(r.allowed), r.bin] = r.n
    if not n.sum(1).all():
        return 0.0
    error = np.cumsum(n[1]) / n[1].sum() + 1 - np.cumsum(n[0]) / n[0].sum()  # with the bin itself rejected
    best = np.flatnonzero(error <= error.min() + 1e-12)
    return float((best[len(best) // 2] + 0.5) / (BINS - 1) * 2 * RANGE - RANGE)


#: The four models: accepted and rejected URLs, of all that rules judge and of those that aren't held out.
MODELS = [(1, "n"), (0, "n"), (1, "learnt"), (0, "learnt")]


def _distinct_grams(batches):
    """Each n-gram of some URLs once, by order, with its context and the n-gram shorter by its first character; n: how often."""
    for batch in slices(batches, most_bytes=MOST_BYTES):
        for contexts, grams, _ in _blocks(batch.column(0).to_pylist()):
            for k in range(ORDER + 1):
                found, first, n = np.unique(grams[k], return_index=True, return_counts=True)
                parent = grams[k - 1][first] if k else np.zeros(len(found), np.int64)
                yield pa.RecordBatch.from_pydict({"place": pa.array(np.full(len(found), k, np.int32)), "gram": pa.array(found), "context": pa.array(contexts[k][first]), "parent": pa.array(parent), "n": pa.array(n.astype(np.int64))})


def ratios(urls: DataFrame, counts: DataFrame) -> DataFrame:
    """gram, n, d_n, d_learnt: for each n-gram of the highest order in urls(url) how often it is there, and the log-likelihood
    of its last character as accepted, less that as rejected, by the models of all judged URLs and of those not held out.

    No context and no n-gram is a hot key: an n-gram has at most 257 that are longer by one character."""
    of = lambda label, n: F.when((F.col("label") == label) & (F.col(n) > 0), F.col(n))
    by_gram = cut(counts.groupBy("gram").agg(*(F.sum(of(*m)).alias(f"c{i}") for i, m in enumerate(MODELS))), "grams")
    by_context = cut(counts.groupBy("context").agg(*(F.sum(of(*m)).alias(f"t{i}") for i, m in enumerate(MODELS)), *(F.count(of(*m)).alias(f"f{i}") for i, m in enumerate(MODELS))), "totals")
    rows = in_arrow(urls.select("url"), _distinct_grams, "place int, gram long, context long, parent long, n long")
    every = cut(rows.groupBy("place", "gram", "context", "parent").agg(F.sum("n").alias("n")), "distinct")
    shorter = None
    for k in range(ORDER + 1):
        own = every.where(F.col("place") == k).select("gram", "context", "parent", "n").join(by_gram, "gram", "left").join(by_context, "context", "left")
        if shorter is None:
            own = own.withColumns({f"p{i}": F.lit(1 / 257) for i in range(4)})
        else:
            own = own.join(shorter.drop("n").withColumnRenamed("gram", "parent"), "parent")
        p = {}
        for i in range(4):
            count, total, followers, before = F.coalesce(f"c{i}", F.lit(0)), F.coalesce(f"t{i}", F.lit(0)), F.coalesce(f"f{i}", F.lit(0)), F.col(f"p{i}")
            p[f"q{i}"] = F.when(followers > 0, (count + followers * before) / F.greatest(total + followers, F.lit(1))).otherwise(before)
        shorter = cut(own.select("gram", "n", *(e.alias(c.replace("q", "p")) for c, e in p.items())), "shorter")
    return shorter.select("gram", "n", (F.log("p0") - F.log("p1")).alias("d_n"), (F.log("p2") - F.log("p3")).alias("d_learnt"))


def _summed(frequent):
    """Of rows (k1, k2, url): one with the sums over frequent n-grams and the URL's length, and one for each other n-gram."""
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("gram", pa.int64()), ("times", pa.int64()), ("d_n", pa.float64()), ("d_learnt", pa.float64())])

    def run(batches):
        known, d_n, d_learnt = frequent.value
        for batch in slices(batches, most_bytes=MOST_BYTES):
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            size, sums = np.zeros(len(k1), np.int64), np.zeros((2, len(k1)))
            for _, grams, url in _blocks(batch.column(2).to_pylist()):
                at, seen = _places(known, grams[ORDER]) if len(known) else (np.zeros(len(url), int), np.zeros(len(url), bool))
                size += np.bincount(url, minlength=len(k1))
                for total, d in zip(sums, (d_n, d_learnt), strict=True):
                    total += np.bincount(url[seen], d[at[seen]], len(k1))
                pair, times = np.unique(np.stack([url[~seen], grams[ORDER][~seen]]), axis=1, return_counts=True)
                u = pair[0]
                yield pa.RecordBatch.from_arrays([pa.array(k1[u]), pa.array(k2[u]), pa.array(pair[1]), pa.array(times.astype(np.int64)), pa.nulls(len(u), pa.float64()), pa.nulls(len(u), pa.float64())], schema=schema)
            yield pa.RecordBatch.from_arrays([pa.array(k1), pa.array(k2), pa.nulls(len(k1), pa.int64()), pa.array(size), pa.array(sums[0]), pa.array(sums[1])], schema=schema)

    return run


def differences(urls: DataFrame, counts: DataFrame) -> DataFrame:
    """k1, k2, d_n, d_learnt of urls(k1, k2, url), distinct ones: the mean difference a byte by both pairs of models."""
    values = ratios(urls, counts)
    top = values.orderBy(F.desc("n"), "gram").limit(MOST_FREQUENT).select("gram", "d_n", "d_learnt").toArrow()
    known, d_n, d_learnt = (top.column(c).to_numpy() for c in ("gram", "d_n", "d_learnt"))
    by = np.argsort(known)
    frequent = urls.sparkSession.sparkContext.broadcast((known[by], d_n[by], d_learnt[by]))
    rows = cut(in_arrow(urls.select("k1", "k2", "url"), _summed(frequent), "k1 long, k2 long, gram long, times long, d_n double, d_learnt double"), "summed")
    whole = rows.where("gram IS NULL").select("k1", "k2", F.col("times").alias("size"), "d_n", "d_learnt")
    rest = rows.where("gram IS NOT NULL").select("k1", "k2", "gram", "times").join(values.select("gram", "d_n", "d_learnt"), "gram")
    more = rest.select("k1", "k2", F.lit(0).cast("long").alias("size"), (F.col("times") * F.col("d_n")).alias("d_n"), (F.col("times") * F.col("d_learnt")).alias("d_learnt"))
    sums = whole.unionByName(more).groupBy("k1", "k2").agg(F.sum("size").alias("size"), F.sum("d_n").alias("d_n"), F.sum("d_learnt").alias("d_learnt"))
    return sums.select("k1", "k2", (F.col("d_n") / F.col("size")).alias("d_n"), (F.col("d_learnt") / F.col("size")).alias("d_learnt"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, bool]]) -> DataFrame:
    """pages(url, ...) with host, path, rule, verdict ("allow" or "block") and difference.

    A null url, or one without "://", has an empty host and path and so no rule; a null url is judged as an empty text.
    Every row is judged; equal URLs alike; a difference at the threshold is allowed. If rules accept or reject no URL at
    all there is nothing to compare and URLs without a rule are allowed. URLs may be of any length. An empty table gives
    an empty one. Columns of these names are replaced; all others stay.
    """
    clean = pages.drop("host", "path", "rule", "verdict", "difference", "allowed")
    url = F.col("url").cast("string")
    ruled = with_rules(clean.withColumns({"host": host_of(url), "path": path_of(url)}), rules)
    judged = ruled.where("allowed IS NOT NULL").select(url.alias("url"), "allowed")
    text = F.coalesce(url, F.lit(""))
    k1, k2 = free_name(ruled, "k1"), free_name(ruled, "k2")
    keyed = ruled.withColumns({k1: F.xxhash64(text), k2: F.xxhash64(F.lit(1), text)})
    with scratch(pages.sparkSession) as kept:
        counts = counted(judged)
        both = counts.select("label").distinct().count() == 2
        distinct = cut(keyed.select(F.col(k1).alias("k1"), F.col(k2).alias("k2"), text.alias("url")).groupBy("k1", "k2").agg(F.first("url").alias("url")), "urls")
        found = cut(differences(distinct, counts), "differences").withColumnsRenamed({"k1": k1, "k2": k2})
        kept.append(found)
        at = 0.0
        if both:
            held = keyed.where(F.col("allowed").isNotNull() & url.isNotNull() & is_held(url)).select(k1, k2, "allowed").join(found, [k1, k2])
            at = threshold(held.select("allowed", F.col("d_learnt").alias("difference")))
    scored = keyed.join(found.select(k1, k2, F.col("d_n").alias("difference")), [k1, k2])
    allowed = F.coalesce(F.col("allowed"), (F.col("difference") >= at) if both else F.lit(True))
    return scored.withColumn("verdict", F.when(allowed, "allow").otherwise("block")).select(*clean.columns, "host", "path", "rule", "difference", "verdict")


def url_report(pages: DataFrame, rules: list[tuple[str, bool]]) -> DataFrame:
    return judge_urls(pages.select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict", "difference")
