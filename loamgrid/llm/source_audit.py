"""Source divergence audit: how far the sources of a language are from each other and from it, term by term.

Each partition counts its documents' terms in byte tries, one for each language, with a counter for each source at every
leaf. Tries are cut at common prefixes and each range of prefixes is merged by one task; leaves of too few documents go.
What is left is traversed in order of UTF-8: a task sums the distances of all pairs of sources up over its leaves, and
keeps the best candidates of each source, of equal ones the first in order.

Where tries are cut comes from a bounded sample of terms; it decides which task merges a leaf, never what is counted. A
term of a large share of all rows is one leaf in each trie. All numbers are integers and exact.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .byte_tries import Trie, merged, strings
from .common import cut, in_arrow, scratch, slices

LEAST_DOCS, TOP, PRIOR, UNIT = 30, 50, 5, 1_000_000_000
#: Bytes of text that a task counts at once, and leaves that it merges at once.
FLUSH, FOLD = 16 << 20, 1_000_000
#: Text that one range of prefixes stands for, at most so many ranges, and terms in the sample that places them.
RANGE_BYTES, MOST_RANGES, SAMPLE_DOCS, SAMPLE_TERMS = 8 << 20, 8192, 2000, 65_536
#: Sources of all languages whose totals are sent out at once (24 bytes each).
MOST_GROUPS = 1 << 20
#: A-Z in lower case; every ASCII character that is no letter becomes a space; bytes of other code points stay.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _words(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all terms one behind the other, their lengths and where each begins in text."""
    flat = np.frombuffer(text.translate(TERM_BYTES), np.uint8)
    inside = flat != 32
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    return flat[inside], edge[1::2] - edge[::2], edge[::2]


def _counted(texts: list[bytes], groups: np.ndarray) -> Trie:
    """The trie of texts of one language."""
    data, lengths, begins = _words(b" ".join(texts))
    doc = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), begins, "right")
    coded = strings(data, lengths).dictionary_encode()
    code, size = coded.indices.to_numpy().astype(np.int64), max(1, len(coded.dictionary))
    each, n = np.unique(doc * size + code, return_counts=True)
    return Trie.of(coded.dictionary, each % size, np.ones(len(each), np.int64), each % size, groups[each // size], n)


def _long(text: bytes, group: int) -> Trie:
    """The trie of one text, counted in stretches that end between terms."""
    tries, at = [], 0
    while at < len(text):
        end = min(at + FLUSH, len(text))
        while end < len(text) and TERM_BYTES[text[end]] != 32:
            end += 1
        tries.append(_counted([text[at:end]], np.array([group])))
        at = end
    trie = merged(tries)
    trie.docs[:] = 1
    return trie


def _tries(texts: list[bytes], langs: np.ndarray, groups: np.ndarray) -> list[tuple[int, Trie]]:
    """A trie for each language."""
    out = []
    for lang in np.unique(langs):
        rows = np.flatnonzero(langs == lang)
        short = [i for i in rows if len(texts[i]) <= FLUSH]
        tries = [_counted([texts[i] for i in short], groups[short])] if short else []
        tries += [_long(texts[i], groups[i]) for i in rows if len(texts[i]) > FLUSH]
        out.append((int(lang), merged(tries)))
    return out


def _buffered(batches):
    """texts, languages and groups of some FLUSH bytes at a time."""
    texts, langs, groups, held = [], [], [], 0
    for batch in slices(batches):
        for i, text in enumerate(batch.column(2).to_pylist()):
            texts.append(text.encode())
            held += len(texts[-1])
            langs.append(batch.column(0)[i].as_py())
            groups.append(batch.column(1)[i].as_py())
            if held >= FLUSH:
                yield texts, np.array(langs), np.array(groups)
                texts, langs, groups, held = [], [], [], 0
    if texts:
        yield texts, np.array(langs), np.array(groups)


PACKED = ["depths", "lengths", "labels", "docs", "sizes", "names", "groups", "n"]
SUBTRIE = pa.schema([("lang", pa.int64()), ("part", pa.int32()), *((c, pa.binary()) for c in PACKED)])


def _subtries(cuts: dict[int, list[bytes]]):
    """A row for each language and range of prefixes that a flush has leaves of."""

    def run(batches):
        for buffered in _buffered(batches):
            for lang, trie in _tries(*buffered):
                at = cuts.get(lang, [])
                # where the cuts lie among the leaves: they are few, the leaves are sorted
                low = [0]
                for c in at:
                    a, b = low[-1], len(trie)
                    while a < b:
                        mid = (a + b) // 2
                        a, b = (mid + 1, b) if trie.terms[mid].as_py() < c else (a, mid)
                    low.append(a)
                rows = [{"lang": lang, "part": part} | trie.part(a, b).packed() for part, (a, b) in enumerate(zip(low, [*low[1:], len(trie)], strict=True)) if a < b]
                for r in rows:  # one at a time: a row may be large
                    yield pa.RecordBatch.from_pylist([r], schema=SUBTRIE)

    return run


KEPT = pa.schema([("lang", pa.int64()), ("term", pa.string()), ("groups", pa.list_(pa.int64())), ("n", pa.list_(pa.int64()))])


def _leaves(lang: int, trie: Trie) -> pa.RecordBatch:
    offsets = pa.array(np.concatenate([[0], np.cumsum(trie.sizes)]).astype(np.int32))
    lists = (pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (trie.groups, trie.n))
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(trie), lang)), trie.terms.cast(pa.large_string()).cast(pa.string()), *lists], schema=KEPT)


def _merged(least_docs: int):
    """Subtries in order of language and range to the leaves of at least so many documents, in order of UTF-8."""

    def run(batches):
        key, held, size = None, [], 0

        def done():
            trie = merged(held)
            trie = trie.where(trie.docs >= least_docs)
            for at in range(0, len(trie), 20_000):
                yield _leaves(key[0], trie.part(at, min(len(trie), at + 20_000)))

        for batch in batches:
            for row in batch.to_pylist():
                if (row["lang"], row["part"]) != key:
                    if held:
                        yield from done()
                    key, held, size = (row["lang"], row["part"]), [], 0
                held.append(Trie.unpacked(row))
                size += len(held[-1])
                if size > FOLD and len(held) > 1:
                    held = [merged(held)]
                    size = len(held[0]) // 2  # so that folding stays rare where leaves are really different
        if held:
            yield from done()

    return run


def _cuts(rows: DataFrame, n_ranges: int, sample_docs: int) -> dict[int, list[bytes]]:
    """For each language the terms before which tries are cut, from the terms of a sample of documents."""

    def run(batches):
        for texts, langs, groups in _buffered(batches):
            for lang, trie in _tries(texts, langs, groups):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(trie), lang)), trie.terms.cast(pa.binary())], names=["lang", "term"])

    every = max(1, rows.count() // max(1, sample_docs))
    sample = in_arrow(rows.where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0), run, "lang long, term binary").distinct()
    terms = defaultdict(list)
    found = sample.orderBy(F.xxhash64("lang", "term")).limit(SAMPLE_TERMS).collect()
    for r in found:
        terms[r.lang].append(bytes(r.term))
    step = max(1, len(found) // n_ranges)
    return {lang: sorted(x)[step::step] for lang, x in terms.items()}


def count_terms(docs: DataFrame, least_docs: int = LEAST_DOCS, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """lang, term, groups, n: each language's terms in at least so many of its documents, with the sources that have it.

    docs(lang, group, text): lang and group as 64-bit numbers, text without nulls. Terms are maximal runs of ASCII letters
    and of all other code points from U+0080 on, A-Z in lower case."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long")).alias("size")).collect()[0]["size"] or 0
    cuts = _cuts(docs, int(min(MOST_RANGES, max(32, size // RANGE_BYTES))), sample_docs)
    subtries = in_arrow(docs, _subtries(cuts), "lang long, part int, depths binary, lengths binary, labels binary, docs binary, sizes binary, names binary, groups binary, n binary")
    ranged = subtries.repartition("lang", "part").sortWithinPartitions("lang", "part")
    return in_arrow(ranged, _merged(least_docs), "lang long, term string, groups array<long>, n array<long>")


def shares(count: np.ndarray, total: np.ndarray | int, terms: int) -> np.ndarray:
    """1 + floor(UNIT * (count + PRIOR) / (total + PRIOR * terms)), exact for totals up to 9 * 10 ** 15."""
    whole = np.asarray(total, np.int64) + PRIOR * terms
    rest, out = np.asarray(count, np.int64) + PRIOR, np.zeros(np.broadcast_shapes(np.shape(count), np.shape(total)), np.int64)
    for _ in range(3):  # three decimal digits at a time stay below 2 ** 63
        out, rest = out * 1000 + rest * 1000 // whole, rest * 1000 % whole
    return out + 1


FOUND = pa.schema([("lang", pa.int64()), ("group", pa.int64()), ("other", pa.int64()), ("term", pa.string()), ("value", pa.int64())])


class _Language:
    """Sums of pairs and best candidates of one language, leaf by leaf."""

    def __init__(self, groups: np.ndarray, totals: np.ndarray, terms: int, top: int):
        by = np.argsort(groups)
        self.groups, self.totals, self.terms, self.top = groups[by], totals[by], terms, top
        self.pairs = np.zeros((len(by), len(by)), np.int64)
        self.best: list[tuple[np.ndarray, list]] = [(np.zeros(0, np.int64), [])] * len(by)
        #: leaves at once, so that a block has some million numbers
        self.block = max(16, 2_000_000 // max(1, len(by)))

    def add(self, terms: list[str], sizes: np.ndarray, groups: np.ndarray, n: np.ndarray) -> None:
        ends = np.cumsum(sizes)
        for a in range(0, len(terms), self.block):
            b = min(len(terms), a + self.block)
            count = np.zeros((b - a, len(self.groups)), np.int64)
            at = slice(int(ends[a] - sizes[a]), int(ends[b - 1]))
            count[np.repeat(np.arange(b - a), sizes[a:b]), np.searchsorted(self.groups, groups[at])] = n[at]
            p, q = shares(count, self.totals, self.terms), shares(count.sum(1), int(self.totals.sum()), self.terms)
            for g in range(len(self.groups)):
                self.pairs[g] += np.abs(p - p[:, g : g + 1]).sum(0)
                rows = np.flatnonzero((count[:, g] > 0) & (p[:, g] > q))
                value, names = self.best[g]
                value, names = np.concatenate([value, p[rows, g] - q[rows]]), names + [terms[a + i] for i in rows]
                if len(names) > self.top:
                    # stable: leaves come in order of UTF-8, so of equal values the first stay
                    first = np.sort(np.argsort(-value, kind="stable")[: self.top])
                    value, names = value[first], [names[i] for i in first]
                self.best[g] = value, names

    def rows(self, lang: int):
        size = len(self.groups)
        for g in range(size):
            value, names = self.best[g]
            k = size + len(names)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(k, lang)), pa.array(np.full(k, self.groups[g])), pa.array([*self.groups.tolist(), *[None] * len(names)], pa.int64()),
                pa.array([None] * size + names, pa.string()), pa.array(np.concatenate([self.pairs[g], value])),
            ], schema=FOUND)


def _traversed(totals, top: int):
    """totals: of each language its groups, their numbers of occurrences and its number of terms."""

    def run(batches):
        known: dict[int, _Language] = {}
        for batch in slices(batches, 20_000, 64 << 20):
            langs = batch.column(0).to_numpy()
            for lang in np.unique(langs).tolist():
                if lang not in totals.value:
                    continue
                rows = batch.filter(pa.array(langs == lang))
                if lang not in known:
                    known[lang] = _Language(*totals.value[lang], top)
                groups, n = rows.column(2), rows.column(3)
                known[lang].add(rows.column(1).to_pylist(), np.asarray(pa.compute.list_value_length(groups)), pa.compute.list_flatten(groups).to_numpy(), pa.compute.list_flatten(n).to_numpy())
        for lang, found in known.items():
            yield from found.rows(lang)

    return run


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: of each source the other sources of its language (part `pair`) and the terms
    that it has more of than the language (part `term`, only ranks to `top`).

    docs(text, lang, source, ...): nulls in any of the three are ''. Each row is a document, repeated ones too. A text
    without terms counts nothing, its source is there with all others of its language. An empty table gives an empty one.
    Of equal values the item that is first in UTF-8 has the lower rank. Other columns aren't read. Texts may be of any
    length.
    """
    spark = docs.sparkSession
    lang, source, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "source", "text"))
    rows = docs.select(lang.alias("lang"), source.alias("source"), text.alias("text"))
    rows = rows.select("lang", "source", F.xxhash64("lang").alias("lang_key"), F.xxhash64("lang", "source").alias("group"), "text")
    with scratch(spark) as kept:
        groups = cut(rows.select("lang", "source", "lang_key", "group").distinct(), "groups")
        leaves = cut(count_terms(rows.select(F.col("lang_key").alias("lang"), "group", "text"), least_docs), "leaves")
        terms = leaves.groupBy(F.col("lang").alias("lang_key")).agg(F.count("*").alias("terms"))
        counts = leaves.select(F.explode(F.arrays_zip("groups", "n")).alias("c")).groupBy(F.col("c.groups").alias("group")).agg(F.sum("c.n").alias("total"))
        of = groups.select("lang_key", "group").join(counts, "group", "left").join(terms, "lang_key")
        # the result has a row for each pair of a language's sources, so these totals are about its square root; beyond the
        # bound languages are taken in turns
        turns = -(-max(1, groups.count()) // MOST_GROUPS)
        found = []
        for turn in range(turns):
            mine = of.where(F.pmod("lang_key", F.lit(turns)) == turn)
            packed = {r.lang_key: (np.array([x["group"] for x in r.of]), np.array([x["total"] or 0 for x in r.of]), r.terms) for r in mine.groupBy("lang_key").agg(F.collect_list(F.struct("group", "total")).alias("of"), F.max("terms").alias("terms")).collect()}
            sorted_leaves = leaves.where(F.pmod("lang", F.lit(turns)) == turn).sortWithinPartitions("lang", "term")
            found.append(in_arrow(sorted_leaves, _traversed(spark.sparkContext.broadcast(packed), top), "lang long, group long, other long, term string, value long"))
        every = found[0]
        for more in found[1:]:
            every = every.unionByName(more)
        every = cut(every, "traversed")
        kept += [groups, every]
    pairs = every.where("other IS NOT NULL").groupBy("group", "other").agg(F.sum("value").alias("value"))
    a, b = groups.select("lang_key", "lang", "source", "group"), groups.select("lang_key", F.col("source").alias("item"), F.col("group").alias("other"))
    base = a.join(b, "lang_key").where("group <> other").join(pairs, ["group", "other"], "left")
    pair = base.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    term = every.where("term IS NOT NULL").join(a.select("group", F.col("lang").alias("name"), "source"), "group").select(F.col("name").alias("lang"), "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = [x.withColumn("rank", F.row_number().over(best)) for x in (pair, term)]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= top))
