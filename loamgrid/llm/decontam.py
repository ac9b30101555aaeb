"""Benchmark decontamination: rare n-gram seeds join documents to test items, Smith-Waterman alignment scores the hits.

The test items are the stated query set: blocks of at most BLOCK_CHARS characters of them go to every executor, and each
block meets all documents in one scan without an exchange, so a passage in a third of all documents is no hot key. The
size of the items is measured first and gives the number of blocks.

A first scan counts in how many documents each n-gram of the items occurs. An item's seeds are its n-grams that aren't
much more frequent than the median of the item's own: common phrases are no seeds, but a passage that leaked into very
many documents keeps its seeds. A second scan looks seeds up, gathers hits that lie near one diagonal, and aligns the
item with the document's words there.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, slices

GRAM, BLOCK_CHARS = 3, 8 << 20
#: A seed's document frequency is at most this many times the median of its item's n-grams, plus the second value.
RARE_TIMES, RARE_PLUS = 4, 10
#: Seeds that a document and an item share near one diagonal before they are aligned (all of an item that has fewer), and
#: the diagonals' slack in words.
LEAST_SEEDS, SLACK = 2, 8
#: Hits that are looked at together; a text with more is searched for a few items, or in stretches, at a time.
MOST_HITS = 1 << 18
MATCH, MISMATCH, GAP = 2, -1, -1
#: An item is contained from this share of its own alignment score on.
LEAST_SCORE = 0.4
WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


class Items:
    """A block of test items: words by number, items as numbers, n-grams in order with where they occur."""

    def __init__(self, rows: list[tuple[int | None, str]]):
        self.ids, self.words, self.short = [], [], defaultdict(list)
        self.vocab: dict[str, int] = {}
        grams, items, places = [], [], []
        for item_id, text in rows:
            words = words_of(text)
            if len(words) < GRAM:  # no n-gram to find it by: only a document that is just that
                if words:
                    self.short[tuple(words)].append(item_id)
                continue
            coded = np.asarray([self.vocab.setdefault(w, len(self.vocab) + 1) for w in words], np.int64)
            grams.append(self.grams(coded)[1])
            items.append(np.full(len(grams[-1]), len(self.ids)))
            places.append(np.arange(len(grams[-1])))
            self.ids.append(item_id), self.words.append(coded)
        self.gram, self.item, self.place = (np.concatenate(x or [np.zeros(0, np.int64)]) for x in (grams, items, places))
        self._order(np.argsort(self.gram, kind="stable"))
        self.distinct = np.unique(self.gram)
        self.needed = np.minimum(LEAST_SEEDS, np.bincount(self.item, minlength=len(self.ids)))

    def _order(self, order: np.ndarray) -> None:
        self.gram, self.item, self.place = self.gram[order], self.item[order], self.place[order]

    @staticmethod
    def grams(coded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and codes of the n-grams without an unknown word (0). Words' numbers are below 2 ** 21."""
        known = coded > 0
        whole = known[: len(coded) - GRAM + 1].copy()
        code = coded[: len(whole)].copy()
        for k in range(1, GRAM):
            whole &= known[k : len(whole) + k]
            code = (code << 21) | coded[k : len(whole) + k]
        at = np.flatnonzero(whole)
        return at, code[at]

    def code(self, words: list[str]) -> np.ndarray:
        get = self.vocab.get
        return np.fromiter((get(w, 0) for w in words), np.int64, len(words))

    def keep_rare(self, docs_with: dict[int, int]) -> None:
        """docs_with: in how many documents each n-gram is."""
        n = np.asarray([docs_with.get(g, 0) for g in self.gram.tolist()], np.int64)
        if len(n):
            self._order(np.flatnonzero(n <= RARE_TIMES * self._medians(n)[self.item] + RARE_PLUS))
        seeds = np.bincount(self.item, minlength=len(self.ids))
        self.needed = np.minimum(LEAST_SEEDS, seeds)

    def _medians(self, n: np.ndarray) -> np.ndarray:
        order = np.lexsort((n, self.item))
        begin = np.searchsorted(self.item[order], np.arange(len(self.ids)))
        size = np.bincount(self.item, minlength=len(self.ids))
        return n[order][begin + size // 2]

    def matches(self, text: str | None) -> list[tuple[int | None, float, int, int]]:
        """(item_id, score, first word, word after the last): the best place of each item that the text contains, the first
        of equally good ones."""
        words = words_of(text)
        out = [(i, 1.0, 0, len(words)) for i in self.short.get(tuple(words), ())] if self.short and len(words) < GRAM else []
        if len(words) < GRAM or not len(self.gram):
            return out
        coded = self.code(words)
        at, code = self.grams(coded)
        best: dict[int, tuple[float, int, int]] = {}
        for entries, begin, end in self._portions(at, code, len(words)):
            self._search(coded[begin:end], begin, entries, best)
        return out + [(self.ids[k], *found) for k, found in best.items()]

    def _portions(self, at: np.ndarray, code: np.ndarray, n_words: int) -> list[tuple[np.ndarray | None, int, int]]:
        """What to search together: (entries of the index or None for all, first word, word after the last). One portion,
        unless the text repeats n-grams of so many items that it has more than MOST_HITS hits."""
        lo = np.searchsorted(self.gram, code)
        hits = int((np.searchsorted(self.gram, code, side="right") - lo).sum())
        if hits <= MOST_HITS:
            return [(None, 0, n_words)] if hits else []
        seen, times = np.unique(code, return_counts=True)
        place = np.minimum(np.searchsorted(seen, self.gram), len(seen) - 1)
        each = np.bincount(self.item, np.where(seen[place] == self.gram, times[place], 0), len(self.ids))
        found = np.flatnonzero(each)
        out, group, total = [], [], 0
        for k in found.tolist():
            if group and total + each[k] > MOST_HITS:
                out.append((np.flatnonzero(np.isin(self.item, group)), 0, n_words))
                group, total = [], 0
            if each[k] > MOST_HITS:
                # one item: stretches that overlap by more than any alignment's words
                over = 4 * len(self.words[k]) + 2 * SLACK
                step = max(over, int(n_words * MOST_HITS / each[k]))
                own = np.flatnonzero(self.item == k)
                out += [(own, a, min(n_words, a + step + over)) for a in range(0, n_words, step)]
            else:
                group.append(k)
                total += each[k]
        if group:
            out.append((np.flatnonzero(np.isin(self.item, group)), 0, n_words))
        return out

    def _search(self, coded: np.ndarray, begin_at: int, entries: np.ndarray | None, best: dict[int, tuple[float, int, int]]) -> None:
        gram, items, places = (x if entries is None else x[entries] for x in (self.gram, self.item, self.place))
        at, code = self.grams(coded)
        lo = np.searchsorted(gram, code)
        n = np.searchsorted(gram, code, side="right") - lo
        if not n.sum():
            return
        hit = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        item, diagonal = items[hit], np.repeat(at, n) - places[hit]
        order = np.lexsort((diagonal, item))
        item, diagonal = item[order], diagonal[order]
        new = np.flatnonzero(np.r_[True, (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] > SLACK)])
        for a, b in zip(new, np.append(new[1:], len(item)), strict=True):
            k = int(item[a])
            if b - a < self.needed[k]:
                continue
            begin = max(0, int(diagonal[a]) - SLACK)
            end = min(len(coded), int(diagonal[b - 1]) + len(self.words[k]) + SLACK)
            if best.get(k, (0.0,))[0] == 1.0:
                continue
            score, first, last = align(self.words[k], coded[begin:end])
            share = score / (MATCH * len(self.words[k]))
            if share >= LEAST_SCORE and share > best.get(k, (0.0,))[0]:
                best[k] = (share, begin_at + begin + first, begin_at + begin + last)


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman: the best local score, and where in text the alignment begins and ends. A row at a time; gaps in
    the row follow from a running maximum."""
    n = len(text) + 1
    steps = -GAP * np.arange(n)
    above, origin = np.zeros(n, np.int64), np.arange(n)
    best, first, last = 0, 0, 0
    for word in item:
        row, start = np.zeros(n, np.int64), np.arange(n)
        row[1:] = above[:-1] + np.where(text == word, MATCH, MISMATCH)
        start[1:] = origin[:-1]
        gap = above + GAP
        take = gap > row
        row, start = np.where(take, gap, row), np.where(take, origin, start)
        zero = row <= 0
        row[zero], start[zero] = 0, np.arange(n)[zero]
        raised = row + steps
        top = np.maximum.accumulate(raised)
        source = np.maximum.accumulate(np.where(raised == top, np.arange(n), 0))
        row, start = top - steps, start[source]
        at = int(row.argmax())
        if row[at] > best:
            best, first, last = int(row[at]), int(start[at]), at
        above, origin = row, start
    return best, first, last


def _frequencies(shared):
    def run(batches):
        items = shared.value
        n = np.zeros(len(items.distinct), np.int64)
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                code = np.unique(items.grams(items.code(words_of(text)))[1])
                if len(code) and len(n):
                    at = np.minimum(np.searchsorted(items.distinct, code), len(n) - 1)
                    n[at[items.distinct[at] == code]] += 1
        found = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"gram": pa.array(items.distinct[found], pa.int64()), "n": pa.array(n[found])})

    return run


def item_blocks(docs: DataFrame, benchmark: DataFrame, most_chars: int = BLOCK_CHARS) -> list:
    """Broadcast blocks of the items, with the seeds that are rare in docs."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // most_chars))
    out = []
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        block = Items(sorted(((r.item_id, r.text) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1])))
        counted = in_arrow(docs.select(F.col("text").cast("string").alias("text")), _frequencies(spark.sparkContext.broadcast(block)), "gram long, n long")
        block.keep_rare({r.gram: r.n for r in counted.groupBy("gram").agg(F.sum("n").alias("n")).collect()})
        out.append(spark.sparkContext.broadcast(block))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score (share of the item's own alignment score), first_word, end_word: a row for each row of docs
    and test item that it contains, at its best place.

    docs(doc_id, text, ...), benchmark(item_id, text, ...). Words are runs of letters and digits in lower case. Null and
    empty texts contain nothing; items without words are in nothing, items of fewer than GRAM words, which have no n-gram,
    only in documents that are just that. Null ids stay null. Of equally good places the first counts. Equal rows have a
    row each; equal items are found each. Texts and items may be of any length. Empty tables give an empty one. Other
    columns aren't read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int64()), ("end_word", pa.int64())])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def search(shared):
        def run(batches):
            items = shared.value
            for batch in slices(batches):
                rows = [(d, *m) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for m in items.matches(t)]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

        return run

    out = None
    for block in item_blocks(docs, benchmark):
        found = in_arrow(texts, search(block), "doc_id long, item_id long, score double, first_word long, end_word long")
        out = found if out is None else out.unionByName(found)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs whose text contains no test item, with all their columns; see contaminated()."""
    at = docs.columns.index("text")

    def clean(shared):
        def run(batches):
            items = shared.value
            for batch in slices(batches):
                keep = [not items.matches(t) for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(keep))

        return run

    out = docs
    for block in item_blocks(docs, benchmark):
        out = in_arrow(out, clean(block), docs.schema)
    return out
