"""Near-duplicates and leaks against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamgrid.llm import decontam, near_dedup
from loamgrid.llm.components import connected_components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute(rows, n):
    """doc_id -> (size, component) by comparing all pairs; rows with a null id last."""
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * i >= 80 * (len(sets[a]) + len(sets[b]) - i):
                root[find(a)] = find(b)
    least = {}
    for k, (d, _) in enumerate(rows):
        if d is not None:
            least[find(k)] = min(d, least.get(find(k), d))
    return sorted((-1 if d is None else d, len(sets[k]), d if not sets[k] else least.get(find(k))) for k, (d, _) in enumerate(rows))


def got(df, n):
    rows = near_dedup.near_duplicates(df, n).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, r.component_id) for r in rows)


@pytest.mark.parametrize("n", [2, 5])
def test_awkward_rows(awkward, n):
    key = lambda x: (x[0], x[1], -1 if x[2] is None else x[2])
    assert sorted(got(awkward, n), key=key) == sorted(brute([(r.doc_id, r.text) for r in awkward.collect()], n), key=key)


def noisy_group(size, length, seed=3, noise=(0.0, 0.15)):
    """Copies of one text with words replaced at different rates: many pairs lie on both sides of the threshold."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(length)]
    return [" ".join(f"n{rng.randrange(10**6)}" if rng.random() < rate else w for w in base) for rate in (rng.uniform(*noise) for _ in range(size))]


def test_large_noisy_group_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    texts = noisy_group(120, 80) + noisy_group(10, 60, 5) + ["exact copy of a text that has some words"] * 30 + [f"alone {k} with its own words {k} {k + 1}" for k in range(20)]
    rows = list(enumerate(texts))
    assert got(spark.createDataFrame(rows, "doc_id long, text string"), 2) == brute(rows, 2)


def test_nothing(nothing):
    assert near_dedup.near_duplicates(nothing).count() == 0


def test_bounds_keep_likely_pairs():
    from math import comb

    for n, m in near_dedup.least_matches(0.8):
        below = sum(comb(n + 1, k) * 0.8**k * 0.2 ** (n + 1 - k) for k in range(m))
        assert below < near_dedup.MISS
        assert m < 0.8 * n


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 470)] + [(500, k) for k in range(501, 560)] + [(7, 7), (None, 3)]
    root = {}

    def find(a):
        root.setdefault(a, a)
        while root[a] != a:
            a = root[a]
        return a

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {k: find(k) for k in list(root)}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


ITEM = "the quick brown fox jumps over the lazy dog while seven wizards box with jugs of liquor near a quiet river bank"


def test_alignment_equals_full_matrix():
    rng = np.random.default_rng(2)
    for _ in range(40):
        a, b = rng.integers(1, 6, rng.integers(1, 12)), rng.integers(1, 6, rng.integers(1, 15))
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        score, first, last = decontam.align(a, b)
        assert score == h.max()
        if score:
            assert 0 <= first < last <= len(b) and decontam.align(a, b[first:last])[0] == score


def test_leaks(spark):
    words = ITEM.split()
    edited = [w if k % 6 else f"other{k}" for k, w in enumerate(words)]
    docs = [(1, f"before {ITEM.upper()}! after"), (2, "text " + " ".join(edited) + " end"), (3, " ".join(words[:6])), (4, "nothing in common with that at all"), (5, None), (6, ""), (7, "x " * 5000 + ITEM), (None, ITEM), (8, "short one"), (9, "a short one here")]
    docs += [(100 + k, f"{ITEM} {k}") for k in range(60)]
    bench = spark.createDataFrame([(1, ITEM), (2, ITEM), (3, "short one"), (4, None), (5, "..."), (None, "words that no document of these has anywhere")], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = decontam.contaminated(df, bench).collect()
    found = {(r.doc_id, r.item_id) for r in rows}
    assert found == {(d, i) for d in [1, 2, 7, None, *range(100, 160)] for i in (1, 2)} | {(8, 3)}
    first = next(r for r in rows if r.doc_id == 7)
    assert (first.first_word, first.end_word, first.score) == (5000, 5000 + len(words), 1.0)
    clean = decontam.decontaminate(df, bench)
    assert {r.doc_id for r in clean.collect()} == {3, 4, 5, 6, 9} and clean.columns == df.columns


def test_leaks_in_blocks_and_of_nothing(spark, awkward, nothing):
    bench = spark.createDataFrame([(k, ITEM.replace("fox", f"fox{k}")) for k in range(9)], "item_id long, text string")
    df = spark.createDataFrame([(1, ITEM)], "doc_id long, text string")
    shares = [{(r.item_id, r.score) for r in decontam.contaminated(df, bench).collect()}]
    blocks = decontam.item_blocks(df, bench, most_chars=200)
    assert len(blocks) > 3 and sum(len(b.value.ids) for b in blocks) == 9 == len(shares[0])
    assert decontam.contaminated(nothing, bench).count() == 0
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contaminated(awkward, empty).count() == 0
    assert decontam.decontaminate(awkward, empty).count() == awkward.count()
    assert decontam.decontaminate(awkward.withColumn("item_id", F.lit(1)), bench).columns == [*awkward.columns, "item_id"]


SF = "/root/testdata/sf0.01"


def test_whole_table_equals_brute_force(spark):
    """All pairs of the 1,000 documents of sf0.01, exact and near copies among them, by an inverted index of shingles."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    sets = {d: shingles(t, 2) for d, t in rows}
    where = {}
    for d, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(d)
    root = {d: d for d in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for d, s in sets.items():
        common = {}
        for x in s:
            for e in where[x]:
                if e < d:
                    common[e] = common.get(e, 0) + 1
        for e, n in common.items():
            if 100 * n >= 80 * (len(s) + len(sets[e]) - n):
                a, b = sorted((find(d), find(e)))
                root[b] = a
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicate_report(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    assert got == {d: (len(s), find(d), find(d) == d) for d, s in sets.items()}


def test_a_chain_of_false_candidates_is_compared_in_its_buckets_only(monkeypatch):
    """20,000 classes of which each shares a bucket with the next: a component of candidates, but no pair beyond buckets."""
    compared = []
    full = near_dedup._survivors
    monkeypatch.setattr(near_dedup, "_survivors", lambda q, k, m, band, left, bounds: compared.append(len(left)) or full(q, k, m, band, left, bounds))
    rng = np.random.default_rng(1)
    n = 20_000
    sigs = rng.integers(0, 1 << 16, (n, near_dedup.CHECKS)).astype(np.uint16)
    bands = rng.integers(1, 1 << 62, (n, near_dedup.BANDS))
    work = near_dedup._units(lambda asked, members, unit: near_dedup._wanted(near_dedup._Block(asked, 5), near_dedup._Block(members, 5), unit[1], near_dedup.least_matches(0.8)))
    import pyarrow as pa

    # buckets of three neighbours, as _rest_links deals them: all are members, those outside of the main component queries
    rows = [(b, 0, 0, 0, q, k, k, sigs[k].tobytes(), bands[k].tolist()) for b in range(0, n - 2, 2) for q, own in ((0, range(b, b + 3)), (1, range(b + 1, b + 3))) for k in own]
    batch = pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate([pa.int64(), *[pa.int32()] * 4, pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())])], names=list("abcdefghi"))
    assert sum(1 for _ in work(iter([batch]))) == n // 2 - 1
    assert sum(compared) <= 3 * n


def test_each_pair_is_compared_in_its_first_common_bucket():
    sig = np.arange(near_dedup.CHECKS, dtype=np.uint16).tobytes()
    bands = np.arange(near_dedup.BANDS)
    other = bands.copy()
    other[3] = -1
    block = lambda b: near_dedup._Block([(1, 1, sig, b.tobytes())], 5)
    found = [len(near_dedup._survivors(block(bands), 0, block(other), band, np.arange(1), near_dedup.least_matches(0.8))) for band in range(6)]
    assert found == [1, 0, 0, 0, 0, 0]


def test_search_finds_what_alignment_of_all_pairs_finds(spark):
    """Documents and items of sf0.001, every pair aligned: seeds lose none with a score of a half or more."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()
    found = {(r.doc_id, r.item_id): r.score for r in decontam.contaminated(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")).collect()}
    vocab = {}
    code = lambda text: np.asarray([vocab.setdefault(w, len(vocab) + 1) for w in decontam.words_of(text)], np.int64)
    coded = {d.doc_id: code(d.text) for d in docs}
    seen = 0
    for i in items:
        words = code(i.text)
        if len(words) < decontam.GRAM:
            continue
        for d, text in coded.items():
            if np.isin(words, text).mean() < 0.5:
                continue
            share = decontam.align(words, text)[0] / (decontam.MATCH * len(words))
            if share >= 0.5:
                seen += 1
                assert found[d, i.item_id] == pytest.approx(share)
            elif share < decontam.LEAST_SCORE:
                assert (d, i.item_id) not in found
    assert seen > 0


def test_short_items_are_found_inside_documents(spark):
    bench = spark.createDataFrame([(1, "three odd words"), (2, "four quite odd words"), (None, "an item without any id")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "here are Three odd, words in a text"), (2, "and four quite odd words, too"), (3, "three words odd"), (4, "an item without any id"), (5, "four quite odd things")], "doc_id long, text string")
    found = {(r.doc_id, r.item_id, r.score) for r in decontam.contaminated(docs, bench).collect()}
    assert found == {(1, 1, 1.0), (2, 2, 1.0), (4, None, 1.0)}


def test_repetitive_texts_are_searched_in_portions(monkeypatch):
    phrase = "one phrase that very many of the items share"
    rows = [(k, f"{phrase} and then item {k} ends") for k in range(400)]
    items = decontam.Items(rows)
    text = " ".join([phrase] * 2000 + ["and then item 7 ends"])
    monkeypatch.setattr(decontam, "MOST_HITS", 1 << 62)
    small = " ".join([phrase] * 20 + ["and then item 7 ends"])
    want = sorted(items.matches(small))
    monkeypatch.setattr(decontam, "MOST_HITS", 500)
    assert [m[:2] for m in sorted(items.matches(small))] == [m[:2] for m in want]
    monkeypatch.setattr(decontam, "MOST_HITS", 1 << 18)
    sizes = []
    search = decontam.Items._search
    monkeypatch.setattr(decontam.Items, "_search", lambda self, coded, at, entries, best: sizes.append(len(coded)) or (search(self, coded, at, entries, best) if len(sizes) < 3 else None))
    items.matches(text)
    assert len(sizes) > 5  # 18,020 words, in portions


# crowded buckets


def template_texts(n, seed=1, shared=120, own=40):
    """Texts of one template, which is about three quarters of each: similarities of about 0.6."""
    rng = random.Random(seed)
    template = [f"t{k}" for k in range(shared)]
    return [" ".join(template + [f"o{rng.randrange(10**9)}" for _ in range(own)]) for _ in range(n)]


def test_prefixes_of_similar_sets_meet():
    rng = np.random.default_rng(4)
    common = np.sort(rng.integers(0, 1 << 60, 50).astype(np.uint64))
    rank = rng.permutation(50)
    met = 0
    for _ in range(300):
        n = int(rng.integers(1, 60))
        base = np.unique(np.concatenate([rng.choice(common, n), rng.integers(0, 1 << 60, n).astype(np.uint64)]))
        other = np.unique(np.where(rng.random(len(base)) < rng.uniform(0, 0.2), rng.integers(0, 1 << 60, len(base)).astype(np.uint64), base))
        same = len(np.intersect1d(base, other))
        a, b = (near_dedup.prefix(s, 80, common, rank) for s in (base, other))
        assert set(a.tolist()) <= set(base.tolist()) and len(a) == len(base) - -(-80 * len(base) // 100) + 1
        if 100 * same >= 80 * (len(base) + len(other) - same):
            assert set(a.tolist()) & set(b.tolist())
            met += 1
    assert met > 50


@pytest.mark.parametrize("texts", [noisy_group(90, 120, seed=8), template_texts(60) + noisy_group(40, 160, seed=9), noisy_group(60, 30, noise=(0.05, 0.1))], ids=["noisy", "template", "short"])
def test_crowded_buckets_equal_brute_force(spark, monkeypatch, texts):
    monkeypatch.setattr(near_dedup, "MOST_COMPARISONS", 1)
    rows = list(enumerate(texts))
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 5) == brute(rows, 5)


def test_rows_compared_grow_with_texts_of_one_template(spark, monkeypatch):
    """Twice the texts of one template bring at most 2.2 times the rows to the comparison by signatures."""
    inner, seen = near_dedup._sieve, []

    def watched(words, bounds):
        run, count = inner(words, bounds), seen[-1]

        def counted(batches):
            def each():
                for batch in batches:
                    count.add(batch.num_rows)
                    yield batch

            yield from run(each())

        return counted

    monkeypatch.setattr(near_dedup, "_sieve", watched)
    for n in (750, 1500, 3000):
        seen.append(spark.sparkContext.accumulator(0))
        docs = spark.createDataFrame(list(enumerate(template_texts(n))), "doc_id long, text string").repartition(4)
        assert near_dedup.near_duplicates(docs).where("kept").count() == n
    rows = [max(1000, c.value) for c in seen]
    assert rows[1] <= 2.2 * rows[0] and rows[2] <= 2.2 * rows[1]
