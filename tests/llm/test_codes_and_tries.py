"""Vector codes, the source audit and chunk reuse against brute force, the library and SQL."""

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from loamgrid.llm import byte_tries, chunk_codec, queries, source_audit, vector_codes
from loamgrid.llm.queries import tokenizer

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name, tables", [("op11_vector_codes", ["embeddings"]), ("op12_source_audit", ["documents"])])
def test_equals_sql(spark, name, tables):
    db = duckdb.connect()
    for t in tables:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = queries.queries()[name](spark, SF), db.execute(queries.oracle_sql()[name])
    cols = sorted(got.columns)
    names = [d[0] for d in want.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(tuple(r[i] for i in at) for r in want.fetchall())


# vector codes


@pytest.mark.parametrize("seed", range(6))
def test_annulus_finds_the_first_of_all_nearest(seed):
    rng = np.random.default_rng(seed)
    size, dim, top = [(256, 16, 300), (1, 3, 5), (40, 1, 4), (256, 4, 2), (30, 5, 1 << 22), (7, 2, 0)][seed]
    entries, x = rng.integers(-top, top + 1, (size, dim)), rng.integers(-top, top + 1, (500, dim))
    x[:20] = entries[rng.integers(0, size, 20)]
    index, distance = vector_codes.Codebook(entries).nearest(x)
    every = ((x[:, None, :] - entries) ** 2).sum(2)
    assert index.tolist() == every.argmin(1).tolist() and distance.tolist() == every.min(1).tolist()


def test_annulus_leaves_entries_out():
    rng = np.random.default_rng(1)
    entries = np.arange(1, 257)[:, None] * np.array([[100, 0]])
    book = vector_codes.Codebook(entries)
    book.nearest(entries[rng.integers(0, 256, 2000)] + rng.integers(-3, 4, (2000, 2)))
    assert book.evaluated < 2000 * 256 / 8


def codes_by_loops(rows, parts, entries, rounds):
    kept = sorted((r for r in rows if r[1] is not None and len(r[1]) == 6 and all(v is not None and np.isfinite(v) for v in r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ints = [[int(np.floor(v * 1024)) for v in r[1]] for r in kept]
    width = 6 // parts
    books = [[v[p * width : p * width + width] for v in ints[:entries]] for p in range(parts)]

    def nearest(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v[p * width : p * width + width], e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        at = [[nearest(p, v)[1] for v in ints] for p in range(parts)]
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [v[p * width : p * width + width] for v, i in zip(ints, at[p], strict=True) if i == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    out = []
    for r, v in zip(kept, ints, strict=True):
        found = [nearest(p, v) for p in range(parts)]
        out.append((r[0], r[2], "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    return out, ",".join(str(c) for b in books for e in b for c in e)


def awkward_vectors():
    rng = np.random.default_rng(4)
    rows = [(k, rng.normal(0, 1, 6).round(3).tolist(), k % 3 if k % 5 else None) for k in range(60)]
    rows += [(5, rows[5][1], 2), (5, rows[7][1], None), (None, rows[9][1], 1), (None, rows[9][1], 1)]  # equal rows, one id twice, no id
    return rows + [(70, None, 1), (71, [0.0] * 5 + [None], 1), (72, [0.0] * 5 + [float("nan")], 1), (73, [float("-inf")] + [0.0] * 5, 1), (74, [], 1), (75, [1.0, 2.0], 1)]


DDL = "vec_id long, embedding array<double>, label int, code string, error string, vector int, dim int"


def test_codes_equal_loops(spark):
    rows = awkward_vectors()
    table = spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], DDL).repartition(3)
    got, books = vector_codes.encode(table, parts=2, entries=9, rounds=3)
    want, digest = codes_by_loops(rows, 2, 9, 3)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert vector_codes.codebook_digest(books) == hashlib.sha256(digest.encode()).hexdigest()
    back = vector_codes.decode(got, books).collect()
    for r in back:
        assert len(r.vector) == 6
    by_label = Counter()
    report = vector_codes.code_report(table).collect()
    for r, label in ((r, label) for r in report for label in [next(w[2] for w in rows if w[0] == r.vec_id)] if r.vec_id not in (None, 5)):
        by_label.setdefault(label, r.label_error)
        assert by_label[label] == r.label_error
    assert len(report) == 64 and sum(by_label.values()) == sum(r.error for r in report)


def test_codes_of_nothing_and_of_few(spark):
    empty = spark.createDataFrame([], DDL)
    assert vector_codes.code_report(empty).count() == 0
    few = spark.createDataFrame([(1, [0.5, 0.25, 0.0, 1.0], None), (2, [0.5, 0.25, 0.0, 1.0], None)], "vec_id long, embedding array<float>, label int")
    assert [(r.code, r.error, r.label_error) for r in vector_codes.code_report(few).collect()] == [("00000000", 0, 0)] * 2


# tries and the source audit


def trie_of(counts):
    """counts: (term, group) -> (docs, n)."""
    terms = [t for t, _ in counts]
    array = byte_tries.strings(np.frombuffer(b"".join(terms), np.uint8), np.array([len(t) for t in terms], np.int64))
    at = np.arange(len(terms))
    return byte_tries.Trie.of(array, at, np.array([d for d, _ in counts.values()], np.int64), at, np.array([g for _, g in counts], np.int64), np.array([n for _, n in counts.values()], np.int64))


def content(trie):
    out, at = {}, 0
    for term, docs, size in zip(trie.terms.to_pylist(), trie.docs.tolist(), trie.sizes.tolist(), strict=True):
        for k in range(at, at + size):
            out[term, int(trie.groups[k])] = (docs, int(trie.n[k]))
        at += size
    return out


@pytest.mark.parametrize("seed", range(4))
def test_tries_round_trip_and_merge(seed):
    rng = random.Random(seed)
    make = lambda: bytes(rng.choice(b"ab\xc3\xa9\xff") for _ in range(rng.choice([1, 2, 5, 300])))
    tries, total, docs = [], Counter(), Counter()
    for _ in range(3):
        counts = {(make(), rng.randrange(-3, 4)): (1, rng.randrange(1, 1 << 34)) for _ in range(rng.choice([1, 40]))}
        tries.append(trie_of(counts))
        for (t, g), (d, n) in counts.items():
            total[t, g] += n
            docs[t] += d
        terms = tries[-1].terms.to_pylist()
        assert terms == sorted(set(terms))
        back = byte_tries.Trie.unpacked(tries[-1].packed())
        assert content(back) == content(tries[-1]) and back.terms.to_pylist() == terms
        cut = len(terms) // 2
        halves = [byte_tries.Trie.unpacked(tries[-1].part(a, b).packed()) for a, b in ((0, cut), (cut, len(terms)))]
        assert content(byte_tries.merged(halves)) == content(tries[-1])
    assert content(byte_tries.merged(tries)) == {(t, g): (docs[t], n) for (t, g), n in total.items()}


def audit_by_loops(rows, least, top):
    import re

    term = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        found = term.findall(lower(text))
        groups[lang].add(source)
        docs[lang].update(set(found))
        counts[lang, source].update(found)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        p = lambda c, total: 1 + 1_000_000_000 * (c + 5) // (total + 5 * len(kept))
        total = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        share = {s: {t: p(counts[lang, s][t], total[s]) for t in kept} for s in sources}
        q = {t: p(sum(counts[lang, s][t] for s in sources), sum(total.values())) for t in kept}
        for s in sources:
            parts = {"pair": [(sum(abs(share[s][t] - share[o][t]) for t in kept), o) for o in sources - {s}], "term": [(share[s][t] - q[t], t) for t in kept if counts[lang, s][t] and share[s][t] > q[t]]}
            for part, found in parts.items():
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (v, item) in enumerate(ranked) if part == "pair" or k < top]
    return sorted(out)


def awkward_sources():
    rng = random.Random(2)
    words = ["the", "The", "é", "ÉT", "中文", "áb", "x1y", "don't", "\U0001f600", "zz", "q" * 300, "q" * 299 + "r", "Ω"]
    rows = [(" ".join(rng.choice(words[rng.randrange(6) :]) for _ in range(rng.randrange(30))), rng.choice(["en", "de", None]), rng.choice(["a", "b", "é", None])) for _ in range(120)]
    return rows + [(None, "en", "empty"), ("", "fr", "alone"), ("123 !", "fr", "digits"), (None, None, None), ("the " * 50_000, "en", "long"), *[("the same", "en", "a")] * 7]


def test_audit_equals_loops(spark, monkeypatch):
    rows = awkward_sources()
    table = spark.createDataFrame([(*r, 1, "t", 2) for r in rows], "text string, lang string, source string, term int, part string, group int").repartition(3)
    want = audit_by_loops(rows, 4, 3)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, source_audit.divergence(table, 4, 3).select(columns).collect())) == want
    # one language at a time, a range for each few terms
    monkeypatch.setattr(source_audit, "MOST_GROUPS", 3)
    monkeypatch.setattr(source_audit, "RANGE_BYTES", 1)
    assert sorted(map(tuple, source_audit.divergence(table, 4, 3).select(columns).collect())) == want


def test_long_texts_count_as_one_document(monkeypatch):
    monkeypatch.setattr(source_audit, "FLUSH", 64)
    text = "one two three " * 40 + "x" * 200 + " one"
    trie = source_audit._long(text.encode(), 7)
    assert content(trie) == {(b"one", 7): (1, 41), (b"two", 7): (1, 40), (b"three", 7): (1, 40), (b"x" * 200, 7): (1, 1)}


def test_tries_are_folded(monkeypatch):
    monkeypatch.setattr(source_audit, "FOLD", 1)
    import pyarrow as pa

    tries = [source_audit._counted([b"a b c", b"b c"], np.array([1, 2])) for _ in range(5)]
    rows = pa.RecordBatch.from_pylist([{"lang": 0, "part": k % 2} | t.packed() for k, t in sorted(enumerate(tries), key=lambda x: x[0] % 2)], schema=source_audit.SUBTRIE)
    out = [r for b in source_audit._merged(2)([rows]) for r in b.to_pylist()]
    assert [(r["term"], dict(zip(r["groups"], r["n"], strict=True))) for r in out] == [("a", {1: 3}), ("b", {1: 3, 2: 3}), ("c", {1: 3, 2: 3}), ("a", {1: 2}), ("b", {1: 2, 2: 2}), ("c", {1: 2, 2: 2})]


@pytest.mark.parametrize("total", [1, 10**6, 10**9 + 7, 8 * 10**15])
def test_shares_are_exact(total):
    rng = random.Random(total)
    counts = [rng.randrange(total + 1) for _ in range(200)] + [0, total]
    assert source_audit.shares(np.array(counts), total, 77).tolist() == [1 + 10**9 * (c + 5) // (total + 5 * 77) for c in counts]


def test_audit_of_nothing(nothing):
    assert source_audit.divergence(nothing).count() == 0


# chunks

PARTS = ["a", "b", "Z", "'s", "'ll", "é", "é", "́", " ", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", "Σ", "İ", "1", "23", ",", "<|endoftext|>", "<|", "漢", "👩‍👧", "한", " ", "x" * 70]


def random_text(rng, n):
    return "".join(rng.choice(PARTS) for _ in range(n))


@pytest.mark.parametrize("seed", range(5))
def test_joins_of_any_cuts_are_repaired(seed):
    rng, path = random.Random(seed), tokenizer("word_bpe_49k.json")
    lib, codec = Tokenizer.from_file(path), chunk_codec.codec(path)
    for _ in range(200):
        text = random_text(rng, rng.randrange(60))
        data, want = text.encode(), lib.encode(text, add_special_tokens=False).ids
        cuts = sorted({chunk_codec._at_character(data, rng.randint(0, len(data))) for _ in range(rng.randrange(6))} | {0, len(data)})
        joiner = chunk_codec.Joiner(codec)
        for a, b in zip(cuts, cuts[1:], strict=False):
            head, inner, tail = chunk_codec.edges(data[a:b])
            joiner.text(data[a:b]) if rng.random() < 0.5 else joiner.chunk(head, b"", tail, codec.encode(inner))
        assert np.frombuffer(joiner.done(), "<i4").tolist() == want
        assert codec.decode(want) == lib.decode(want, skip_special_tokens=False)


def test_chunks_depend_on_content_only():
    rng = random.Random(1)
    shared = random_text(rng, 6000).encode()
    texts = [shared, random_text(rng, 400).encode() + b" " + shared, shared + b"!", b"", b"short", b"a" * 20_000, "é".encode() * 9000]
    ends = chunk_codec.chunk_ends(texts)
    for text, of in zip(texts, ends, strict=True):
        assert (of[-1] if of else 0) == len(text) and of == sorted(set(of))
        sizes = np.diff([0, *of])
        assert all(s >= chunk_codec.LEAST for s in sizes[:-1]) and all(s <= chunk_codec.MOST + 4 for s in sizes)
        for a, b in zip([0, *of], of, strict=False):
            text[a:b].decode()
    assert [ends[i] for i in range(2)] == [chunk_codec.chunk_ends([t])[0] for t in texts[:2]]
    chunks = [{t[a:b] for a, b in zip([0, *e], e, strict=False)} for t, e in zip(texts, ends, strict=True)]
    assert len(chunks[0] & chunks[1]) >= 0.8 * len(chunks[0]) and len(chunks[0] & chunks[2]) >= len(chunks[0]) - 1


def test_codec_equals_library(spark, awkward, monkeypatch):
    rng, path = random.Random(7), tokenizer("word_bpe_49k.json")
    monkeypatch.setattr(chunk_codec, "SHARES", 1)
    shared = [random_text(rng, 900) for _ in range(3)]
    texts = [random_text(rng, rng.randrange(300)) + rng.choice(shared) + random_text(rng, rng.randrange(300)) for _ in range(30)]
    texts += [shared[0], shared[0] + shared[1], shared[0] * 3, "", None, random_text(rng, 2000), texts[0], texts[0]]
    docs = awkward.unionByName(spark.createDataFrame([(None if k == 3 else 100 + k % 36, t) for k, t in enumerate(texts)], "doc_id long, text string"), allowMissingColumns=True).repartition(4)
    lib, want = Tokenizer.from_file(path), Counter()
    for r in docs.collect():
        ids = lib.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert Counter(map(tuple, chunk_codec.codec_report(docs, path).collect())) == want


def test_each_shared_chunk_is_encoded_once(spark, monkeypatch):
    """Of 60 documents that share most of their text hardly more than one document's text is encoded for the shared part."""
    rng = random.Random(3)
    shared = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(2000))
    docs = spark.createDataFrame([(k, f"{k} own words {k}\n{shared}\nend {k}") for k in range(60)], "doc_id long, text string").repartition(4)
    sizes = []
    inner = chunk_codec._chunk_codes

    def watched(path, hot, each):
        run = inner(path, hot, each)

        def counted(batches):
            for batch in batches:
                sizes_of.add(sum(len(t) for t in batch.column(2).to_pylist()))
                yield from run([batch])

        return counted

    sizes_of = spark.sparkContext.accumulator(0)
    monkeypatch.setattr(chunk_codec, "_chunk_codes", watched)
    rows = chunk_codec.encode(docs, tokenizer("word_bpe_49k.json")).collect()
    lib = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.ids == lib.encode(texts[r.doc_id], add_special_tokens=False).ids for r in rows) and len(rows) == 60
    assert 0.5 * len(shared) < sizes_of.value < 1.2 * len(shared) and not sizes


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="pre-tokens"):
        chunk_codec.Codec(tokenizer("byte_bpe_50k.json"))


def test_codec_of_nothing(nothing):
    assert chunk_codec.codec_report(nothing, tokenizer("word_bpe_49k.json")).count() == 0
