"""Byte-pair encoding and decoding with content-defined chunk reuse.

A rolling hash cuts texts into chunks whose ends depend on the bytes just before them only, so passages that documents
share have the same chunks wherever they stand. Chunks that occur more than once are encoded once, by one task, and their
ids go to all documents that hold them; all other chunks are encoded where they are read.

Chunks end anywhere, also inside words. Where two meet, the ids at the end of the one and at the start of the other don't
hold; the text from the last blank before the join to the first blank behind it is encoded again, over as many chunks as
that takes. This tokenizer drops blanks and neither merges nor normalises across them, so at a blank the ids before and
behind agree with those of the whole text exactly, and the repair may stop there.

Only hashes of chunks are counted at first. Those that occur again are marked in a Bloom filter of a bounded size; a wrong
mark makes a chunk that occurs once travel, and changes nothing else. So a text is shuffled only if it holds such a chunk,
and then its own stretches once.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UNSAFE, cut, in_arrow, scratch, slices, text_column
from .token_counts import PRE_TOKENS as SAFE_PRE_TOKENS

#: Bytes that the rolling hash sees, least and most bytes of a chunk, and how rare an end is beyond the least.
WINDOW, LEAST, MOST, RARE = 32, 128, 4096, 512
#: Bits of the Bloom filter for each marked chunk, and at most (32 MB).
BITS_EACH, MOST_BITS = 16, 1 << 28
#: Of the chunks that occur again one in so many occurrences is a task's share; what occurs more often is dealt to several.
SHARES = 2048
#: Pre-tokens of either generation of a worker's memory, and the longest that it remembers.
MOST_KNOWN, LONGEST_KNOWN = 300_000, 64
#: Pre-tokens of word_bpe_49k.json, as its file has them; a fixed value of that tokenizer.
PRE_TOKENS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_MULTIPLIER = 0x9E3779B1
#: A number for each byte value: the multiplicative hash of its square.
_OF_BYTE = (np.arange(1, 257, dtype=np.uint64) ** 2 * 0x9E3779B97F4A7C15 >> np.uint64(32)).astype(np.uint32)


#: They stay blanks in any normal form.
ASCII_BLANKS = re.compile("[\t-\r ]+")


class _Memory(dict):
    """What make(key) gives. Once full it is the older generation, of which only what is asked for again stays."""

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, key):
        value = self.older.pop(key, None)
        if value is None:
            value = self.make(key)
            if len(key) > LONGEST_KNOWN:
                return value
        if len(self) >= MOST_KNOWN:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Codec:
    """A tokenizer that drops blanks: ids of words, and texts of ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        pre = json.loads(self.tokenizer.to_str())["pre_tokenizer"] or {}
        first = (pre.get("pretokenizers") or [pre])[0]
        added = self.tokenizer.get_added_tokens_decoder()
        blank = any(t.lstrip or t.rstrip or t.single_word or not t.content or t.content.split() != [t.content] for t in added.values())
        if blank or (first.get("type"), first.get("behavior"), first.get("invert"), (first.get("pattern") or {}).get("Regex")) != ("Split", "Removed", True, PRE_TOKENS):
            raise ValueError("only tokenizers whose pre-tokens are those of word_bpe_49k.json are known to be cut at blanks")
        self.added = re.compile("|".join(re.escape(t.content) for t in added.values()) or r"(?!)")
        # the byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for code points from 256 on
        other = iter(range(256, 512))
        self.alphabet = {b: chr(b) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174 else chr(next(other)) for b in range(256)}
        self.known = _Memory(self._pre_token)
        self.pieces: list[str | None] | None = None

    def _pre_token(self, token: str) -> bytes:
        coded = token if token.isascii() else "".join(map(self.alphabet.__getitem__, token.encode()))
        return array("i", [t.id for t in self.tokenizer.model.tokenize(coded)]).tobytes()

    def encode(self, data: bytes) -> bytes:
        """Ids of a text as 32-bit numbers. Texts of code points on which Python's and the library's tables agree are split
        into pre-tokens here; in others, words between ASCII blanks that have more go to the library whole."""
        text, known = data.decode(), self.known.__getitem__
        if not UNSAFE.search(text) and ("<" not in text or not self.added.search(text)):
            return b"".join(map(known, SAFE_PRE_TOKENS.findall(text.lower())))
        out = []
        for word in ASCII_BLANKS.split(text):
            if UNSAFE.search(word) or "<" in word and self.added.search(word):
                out.append(array("i", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes())
            else:
                out += map(known, SAFE_PRE_TOKENS.findall(word.lower()))
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        """As the library does, special tokens included; ids that the tokenizer doesn't have are left out."""
        if self.tokenizer.decoder is not None:
            return self.tokenizer.decode(ids, skip_special_tokens=False)
        if self.pieces is None:
            self.pieces = [self.tokenizer.id_to_token(i) for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]
        try:
            return " ".join(map(self.pieces.__getitem__, ids))
        except (IndexError, TypeError):
            return " ".join(p for i in ids if 0 <= i < len(self.pieces) and (p := self.pieces[i]) is not None)


_loaded: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _loaded:
        _loaded[path] = Codec(path)
    return _loaded[path]


def chunk_ends(texts: list[bytes]) -> list[list[int]]:
    """For each text the ends of its chunks, the last at its length; a text without bytes has none."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    rolled, step, factor = _OF_BYTE[data], 1, _MULTIPLIER
    while step < WINDOW:  # the hash of 2n bytes from those of n bytes
        rolled[step:] += rolled[:-step] * np.uint32(factor & 0xFFFFFFFF)  # the right side is made before any is added
        step, factor = 2 * step, factor * factor
    after = np.flatnonzero(rolled >> 16 & np.uint32(RARE - 1) == 0) + 1
    starts = np.cumsum([0, *map(len, texts)])
    of = np.searchsorted(starts, after, "left") - 1
    inside = after - starts[of] >= LEAST  # so that no window reaches into the text before
    after, of = after[inside], of[inside]
    bounds = np.searchsorted(of, np.arange(len(texts) + 1))
    out = []
    for i, text in enumerate(texts):
        ends, last, size = [], 0, len(text)
        for end in [*(after[bounds[i] : bounds[i + 1]] - starts[i]).tolist(), size]:
            while end - last > MOST:
                ends.append(last := _at_character(text, last + MOST))
            if end - last >= LEAST or end == size > last:
                end = _at_character(text, end)
                if end > last:
                    ends.append(last := end)
        out.append(ends)
    return out


def _at_character(text: bytes, at: int) -> int:
    """The next place where a character begins."""
    while at < len(text) and text[at] & 0xC0 == 0x80:
        at += 1
    return at


def _digests(texts: list[bytes]) -> tuple[list[list[tuple[int, int]]], np.ndarray]:
    """Begins and ends of chunks for each text, and a row of two 64-bit hashes for each chunk of all texts."""
    spans = [list(zip([0, *ends], ends, strict=False)) for ends in chunk_ends(texts)]
    found = b"".join(hashlib.blake2b(t[a:b], digest_size=16).digest() for t, of in zip(texts, spans, strict=True) for a, b in of)
    return spans, np.frombuffer(found, "<i8").reshape(-1, 2)


def _encoded_texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def _counted(batches):
    for batch in slices(batches):
        seen = Counter(map(tuple, _digests(_encoded_texts(batch, 0))[1].tolist()))
        yield pa.RecordBatch.from_pydict({"h1": pa.array([k[0] for k in seen], pa.int64()), "h2": pa.array([k[1] for k in seen], pa.int64()), "n": pa.array(list(seen.values()), pa.int64())})


class _Marks:
    """A Bloom filter of two bits a chunk."""

    def __init__(self, bits: int, at: np.ndarray, words: np.ndarray):
        self.bits, self.words = bits, np.zeros(bits // 64, np.int64)
        self.words[at] = words

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & (self.bits - 1)
        return (self.words[at >> 6] >> (at & 63) & 1).all(axis=1)


def _marks(shared: DataFrame, n: int) -> _Marks:
    bits = 1 << 16
    while bits < min(MOST_BITS, BITS_EACH * n):
        bits *= 2
    places = shared.select(F.explode(F.array("h1", "h2")).alias("h")).select(F.col("h").bitwiseAND(bits - 1).alias("p"))
    words = places.groupBy(F.shiftright("p", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, CAST(p & 63 AS INT)))").alias("word")).toArrow()
    return _Marks(bits, words.column("at").to_numpy(), words.column("word").to_numpy())


def _texts(batches, marks: _Marks):
    """Batches with, for each row, its text, chunks, their hashes and whether they are marked."""
    for batch in slices(batches):
        texts = _encoded_texts(batch, 2)
        spans, hashes = _digests(texts)
        marked, at, rows = marks(hashes), 0, []
        for text, of in zip(texts, spans, strict=True):
            rows.append((text, of, hashes[at : at + len(of)], marked[at : at + len(of)]))
            at += len(of)
        yield batch, rows


IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])


def _id_rows(doc_ids, ids: list[bytes]) -> pa.RecordBatch:
    offsets = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), "<i4")))], schema=IDS)


def _alone(path: str, marks):
    """Ids of the texts without a marked chunk."""

    def run(batches):
        for batch, rows in _texts(batches, marks.value):
            mine = [i for i, r in enumerate(rows) if not r[3].any()]
            if mine:
                yield _id_rows(batch.column(0).take(pa.array(mine)), [codec(path).encode(rows[i][0]) for i in mine])

    return run


OWN = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("pos", pa.int32()), ("copies", pa.int64()), ("text", pa.binary())])
REFS = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("pos", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("part", pa.int32()), ("text", pa.binary())])


def _own(marks):
    """Of texts with marked chunks: their other stretches, and at place -1 how many such rows the task has."""

    def run(batches):
        seen: Counter = Counter()
        for batch, rows in _texts(batches, marks.value):
            out = []
            for doc_id, h, (text, spans, _, marked) in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), rows, strict=True):
                if not marked.any():
                    continue
                seen[doc_id, h] += 1
                if seen[doc_id, h] > 1:
                    continue
                for pos in np.flatnonzero(~marked & np.concatenate([[True], marked[:-1]])).tolist():
                    end = pos
                    while end < len(spans) and not marked[end]:
                        end += 1
                    out.append((doc_id, h, pos, None, text[spans[pos][0] : spans[end - 1][1]]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), OWN, strict=True)], schema=OWN)
        keys = list(seen)
        for at in range(0, len(keys), 65536):
            some = keys[at : at + 65536]
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in some], pa.int64()), pa.array([k[1] for k in some], pa.int64()), pa.array([-1] * len(some), pa.int32()), pa.array([seen[k] for k in some], pa.int64()), pa.nulls(len(some), pa.binary())], schema=OWN)

    return run


def _refs(marks, hot, each: int):
    """The marked chunks of texts; the first of each in a task comes with its text."""

    def run(batches):
        seen, sent = set(), set()
        for batch, rows in _texts(batches, marks.value):
            out = []
            for doc_id, h, (text, spans, hashes, marked) in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), rows, strict=True):
                if not marked.any() or (doc_id, h) in seen:
                    continue
                seen.add((doc_id, h))
                for pos in np.flatnonzero(marked).tolist():
                    key = h1, h2 = tuple(hashes[pos].tolist())
                    a, b = spans[pos]
                    part = (h + pos) % -(-hot[key] // each) if key in hot else 0
                    out.append((doc_id, h, pos, h1, h2, part, None if key in sent else text[a:b]))
                    sent.add(key)
                if len(sent) > 1_000_000:
                    sent.clear()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), REFS, strict=True)], schema=REFS)

    return run


CODES = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("part", pa.int32()), ("head", pa.binary()), ("ids", pa.binary()), ("tail", pa.binary())])


def edges(text: bytes) -> tuple[bytes, bytes, bytes | None]:
    """A chunk's text before its first blank, between its first and last blank, and behind the last; without any blank all
    is before it, and what is behind is None."""
    inner = text.translate(_BLANKS)
    first = inner.find(b" ")
    if first < 0:
        return text, b"", None
    last = inner.rfind(b" ")
    return text[:first], text[first:last], text[last + 1 :]


#: ASCII blanks as spaces.
_BLANKS = bytes(32 if c in b"\t\n\x0b\x0c\r" else c for c in range(256))


def _chunk_codes(path: str, hot, each: int):
    """Each distinct chunk's ids between its first and last blank, and what is outside as text; once for each part."""

    def run(batches):
        for batch in slices(batches):
            found = [edges(t) for t in batch.column(2).to_pylist()]
            ids = [codec(path).encode(f[1]) for f in found]
            out = [(h1, h2, part, f[0], i, f[2]) for h1, h2, f, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), found, ids, strict=True) for part in range(-(-hot.get((h1, h2), 1) // each))]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), CODES, strict=True)], schema=CODES)

    return run


class Joiner:
    """Puts the ids of one text together, from stretches of text and from encoded chunks."""

    def __init__(self, of: Codec):
        self.codec, self.ids, self.open = of, [], []

    def text(self, text: bytes) -> None:
        self.chunk(*edges(text))

    def chunk(self, head: bytes, inner: bytes, tail: bytes | None, ids: bytes | None = None) -> None:
        """inner: what is between its first and last blank, or ids of that."""
        self.open.append(head)
        if tail is not None:
            # the join is repaired: both sides end at blanks now
            self.ids.append(self.codec.encode(b"".join(self.open)))
            self.ids.append(self.codec.encode(inner) if ids is None else ids)
            self.open = [tail]

    def done(self) -> bytes:
        self.ids.append(self.codec.encode(b"".join(self.open)))
        out, self.ids, self.open = b"".join(self.ids), [], []
        return out


def _joined(path: str):
    """Rows in order of document and place to the ids of each document, as often as it was there."""

    def run(batches):
        joiner, key, place, copies = Joiner(codec(path)), None, -1, 0
        doc_ids, ids, size = [], [], 0

        def close():
            nonlocal size
            made = joiner.done()
            for _ in range(copies):
                doc_ids.append(key[0])
                ids.append(made)
                size += len(made)
                if size > 4 << 20:
                    yield _id_rows(doc_ids, ids)
                    doc_ids.clear(), ids.clear()
                    size = 0

        for batch in slices(batches):
            for doc_id, h, pos, n, text, head, inner, tail in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (doc_id, h) != key:
                    if key is not None:
                        yield from close()
                    key, place, copies = (doc_id, h), -1, 0
                if pos < 0:
                    copies += n
                elif pos > place:  # each task that has a row of the document has sent its pieces: the first are enough
                    place = pos
                    joiner.text(text) if text is not None else joiner.chunk(head, b"", tail, inner)
        if key is not None:
            yield from close()
        if ids:
            yield _id_rows(doc_ids, ids)

    return run


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids of each row's text, as the library gives them without added tokens.

    docs(doc_id, text, ...): a null text is empty and has no ids; a null doc_id stays null; each of several equal rows has
    its row; an empty table gives an empty one; other columns aren't read. Texts may be of any length. Strings of special
    tokens inside texts are those tokens. path: a tokenizers .json file with the pre-tokens of word_bpe_49k.json; others
    are refused.
    """
    codec(path)
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text")).select("doc_id", F.xxhash64("text").alias("h"), "text")
    with scratch(spark) as kept:
        counts = in_arrow(rows.select("text"), _counted, "h1 long, h2 long, n long").groupBy("h1", "h2").agg(F.sum("n").alias("n"))
        shared = cut(counts.where("n > 1"), "shared")
        total = shared.agg(F.count("*").alias("n"), F.sum("n").alias("all")).collect()[0]
        each = max(64, (total["all"] or 0) // SHARES)
        hot = {(r.h1, r.h2): r.n for r in shared.where(F.col("n") > each).collect()}  # SHARES at most
        marks = spark.sparkContext.broadcast(_marks(shared, total.n))
        alone = in_arrow(rows, _alone(path, marks), "doc_id long, ids array<int>")
        if not total.n:
            return alone
        refs = cut(in_arrow(rows, _refs(marks, hot, each), "doc_id long, h long, pos int, h1 long, h2 long, part int, text binary"), "refs")
        texts = refs.where("text IS NOT NULL").groupBy("h1", "h2").agg(F.first("text").alias("text"))
        codes = cut(in_arrow(texts, _chunk_codes(path, hot, each), "h1 long, h2 long, part int, head binary, ids binary, tail binary"), "codes")
        kept += [refs, codes]
    copied = refs.select("doc_id", "h", "pos", "h1", "h2", "part").join(codes, ["h1", "h2", "part"]).select("doc_id", "h", "pos", F.lit(None).cast("long").alias("copies"), F.lit(None).cast("binary").alias("text"), "head", "ids", "tail")
    own = in_arrow(rows, _own(marks), "doc_id long, h long, pos int, copies long, text binary").select("*", *(F.lit(None).cast("binary").alias(c) for c in ("head", "ids", "tail")))
    pieces = own.unionByName(copied).repartition("doc_id", "h").sortWithinPartitions("doc_id", "h", "pos")
    return alone.unionByName(in_arrow(pieces, _joined(path), "doc_id long, ids array<int>"))


def _decoded(path: str):
    def run(batches):
        for batch in slices(batches, 512):
            ids = batch.column(1)
            flat, ends = pc.list_flatten(ids).to_pylist(), np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(ids), 0))).tolist()
            texts = [codec(path).decode(flat[a:b]) for a, b in zip([0, *ends], ends, strict=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

    return run


def decode(coded: DataFrame, path: str) -> DataFrame:
    """coded(doc_id, ids) with the text that the library decodes ids to, special tokens included; null ids are none."""
    return in_arrow(coded.select("doc_id", "ids"), _decoded(path), "doc_id long, ids array<int>, decoded string")


def codec_report(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of decimal ids joined by one space) and decoded_sha256 (of the decoded text)."""
    back = decode(encode(docs, path), path)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
