"""Token counts and packing against the library itself."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from loamgrid.llm import packing, token_counts
from loamgrid.llm.queries import tokenizer

from .conftest import awkward_rows

TEXTS = [r[1] for r in awkward_rows()] + ["a<|startoftext|>b<|endoftext|>", "don't WE'LL 1234 ½ ²", "ß ẞ ΑΣ Σ", "a\u0301\u00e1 \u2028 \u00a0 \x1c \x85", "  lead", "trail  ", "tab\tx", "\r\nx\r", "a\n b", "naïve—dash “quotes” …", "\U0001f600 emoji", "𝔘𝔫𝔦", "Ǆ ǅ ŉ ſ"]


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_encoder_equals_library(text):
    path = tokenizer("byte_bpe_50k.json")
    want = Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids
    assert np.frombuffer(packing.encoder(path).encode(text or ""), "<u4").tolist() == want


def test_counts_equal_library(spark, awkward):
    path = tokenizer("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    docs = awkward.unionByName(spark.createDataFrame([(100 + k, t) for k, t in enumerate(TEXTS)], "doc_id long, text string"), allowMissingColumns=True)
    for heavy in (0, 5, 1000):
        got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(docs, path, limit=20, heavy=heavy).collect())
        want = sorted((r.doc_id or -1, len((r.text or "").encode()), n := len(lib.encode(r.text or "", add_special_tokens=False).ids), n > 20) for r in docs.collect())
        assert got == want


def test_counts_of_nothing(nothing):
    assert token_counts.count_tokens(nothing, tokenizer("word_bpe_49k.json")).count() == 0


def check_packing(rows, size):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in by.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def test_packing_round_trip(awkward):
    path = tokenizer("byte_bpe_50k.json")
    lib, size = Tokenizer.from_file(path), 64
    rows = packing.pack(awkward, path, size).collect()
    want = []
    for r in awkward.collect():
        ids = np.asarray([*lib.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        at = packing.cut_points(len(ids), size)
        want += [(-1 if r.doc_id is None else r.doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(at, at[1:], strict=False))]
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    n = check_packing(rows, size)
    assert n <= -(-sum(r.length for r in rows) // size) + 2


def test_packing_nothing(nothing):
    assert packing.pack(nothing, tokenizer("byte_bpe_50k.json")).count() == 0


def test_cut_points():
    assert packing.cut_points(5, 8) == [0, 5] and packing.cut_points(8, 8) == [0, 8] and packing.cut_points(19, 8) == [0, 3, 11, 19]


def best_fit(lengths, size):
    """Sequences of decreasing best fit, one document at a time."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
        gaps.append((min(fit) if fit else size) - n)
    return len(gaps)


@pytest.mark.parametrize("seed", range(3))
def test_rounds_need_hardly_more_sequences_than_best_fit_of_single_documents(spark, seed):
    rng = np.random.default_rng(seed)
    lengths = [rng.integers(1, 41, 300), np.minimum(40, 1 + rng.geometric(0.12, 300)), np.repeat([27, 13, 9], 70)][seed].tolist()
    pieces = spark.createDataFrame(list(enumerate(lengths)), "id long, length long").repartition(3)
    rows = packing.sequences(pieces, 40).collect()
    assert sorted((r.id, r.length) for r in rows) == list(enumerate(lengths))
    by = {}
    for r in rows:
        by[r.sequence_id] = by.get(r.sequence_id, 0) + r.length
    assert max(by.values()) <= 40
    assert len(by) <= 1.03 * best_fit(lengths, 40) + 1


@pytest.mark.parametrize("seed", range(4))
def test_a_round_places_as_many_as_can_be_and_the_largest(spark, monkeypatch, seed):
    """Against a maximum found by taking pieces one by one, largest first, if there is still a slot for each of them."""
    rng = np.random.default_rng(seed)
    pieces, slots = rng.integers(1, 12, [40, 25, 60, 5][seed]).tolist(), rng.integers(1, 12, [30, 40, 7, 0][seed]).tolist()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found, won, tokens = packing._matched(spark.createDataFrame(list(enumerate(pieces)), "id long, size long"), spark.createDataFrame(list(enumerate(slots)), "id long, size long"))
        rows = found.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    place = {r.place: r.size for r in rows if r.kind == 0}
    assert len(place) == len(slots) and tokens == sum(pieces)
    winners = [(r.size, place[r.place]) for r in rows if r.kind == 1 and r.place is not None]
    assert len(winners) == won and all(a <= b for a, b in winners) and len({r.place for r in rows if r.kind == 1 and r.place is not None}) == won
    chosen = []
    for n in sorted(pieces, reverse=True):
        tried = sorted([*chosen, n], reverse=True)
        if all(k < len(slots) and a <= b for k, (a, b) in enumerate(zip(tried, sorted(slots, reverse=True), strict=False))) and len(tried) <= len(slots):
            chosen = tried
    assert sorted((a for a, _ in winners), reverse=True) == chosen
