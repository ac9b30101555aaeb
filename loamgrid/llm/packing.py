"""Best-fit packing of documents into sequences, in bulk-synchronous rounds.

Pieces of documents are packed by classes of length, the longest first. In a round the class's pieces that are left and the
gaps of all open sequences are range-sorted by size together, and a sweep over each range finds for every piece how many
gaps have room for it (its successors). Conflicts are resolved by rank: a closed form of ranks and of a running minimum
gives every winner a gap of its own, and the largest pieces win. The gaps are updated, and the round is repeated. Where it
has found gaps for a small share of its pieces only, new sequences open, as many as the pieces left need at least. A sweep
needs of the other ranges only one row of sums each, so a size of a large share of all rows is spread over many ranges.

No round moves texts or ids of tokens: the first scan tokenizes each text and gives lengths and checksums of its pieces.
Rounds are some twenty for any number of rows.
"""

from __future__ import annotations

import functools
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LETTERS, NUMBERS, UNSAFE, cut, in_arrow, scratch, slices, text_column

#: Entries of a worker's caches (each about 200 bytes).
MOST_CACHED = 600_000
#: Pre-tokens of byte_bpe_50k.json; a fixed value of that tokenizer, for the safe code points.
PRE_TOKENS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^\\s{LETTERS}{NUMBERS}]+|\\s+(?!\\S)|\\s+")
#: Where white space isn't a single space or line break between other characters, pre-tokens can span it.
ODD = ("  ", " \n", "\n ", "\n\n", "\t", "\r")


class _Cache(dict):
    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        if len(self) >= MOST_CACHED:
            self.clear()
        self[key] = out = self.make(key)
        return out


class Encoder:
    """Texts to ids as little-endian unsigned 32-bit numbers, equal to the library's, by way of cached words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        # the byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for code points from 256 on
        same = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = iter(range(256, 512))
        self.alphabet = {b: chr(b) if b in same else chr(next(other)) for b in range(256)}
        self.pre = _Cache(self._pre)
        self.spaced = _Cache(lambda word: self._words(f" {word}"))
        self.first = _Cache(self._words)
        self.line = self._pre("\n")

    def _pre(self, token: str) -> bytes:
        coded = "".join(map(self.alphabet.__getitem__, token.encode()))
        return b"".join(t.id.to_bytes(4, "little") for t in self.model.tokenize(coded))

    def _words(self, text: str) -> bytes:
        return b"".join(map(self.pre.__getitem__, PRE_TOKENS.findall(text)))

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        if UNSAFE.search(text):
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if text[0] in " \n" or text[-1] in " \n" or any(x in text for x in ODD):
            return self._words(text)
        out, spaced = [], self.spaced.__getitem__
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            out.append(self.first[first])
            out += map(spaced, rest)
            out.append(self.line)
        out.pop()
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        if self.added_pattern and "<" in text:
            return b"".join(self.added[part].to_bytes(4, "little") if part in self.added else self._plain(part) for part in self.added_pattern.split(text))
        return self._plain(text)


_loaded: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def cut_points(n: int, size: int) -> list[int]:
    """Where n ids are cut: pieces of size, only the first may be shorter."""
    return [0, *range(n % size or size, n + 1, size)]


def _pieces(path: str, size: int, end: int):
    def run(batches):
        encode, last = encoder(path).encode, end.to_bytes(4, "little")
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = encode(text) + last
                at = cut_points(len(ids) // 4, size)
                rows += ((doc_id, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(at, at[1:], strict=False)))
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), PIECES, strict=True)], schema=PIECES)

    return run


#: Lengths are taken by classes: those above size / 2, then above size / 4, then all others.
CLASSES = (2, 4)
#: New sequences open when a round has found gaps for at most this share of its pieces.
OPEN_AT = 0.25
#: Sorted before all prefixes.
_TOP = 1 << 60


def _swept(batches):
    """A sweep over one range of slots and pieces, largest sizes first, slots before pieces of their size: for a slot its
    rank in the range, for a piece its rank, how many slots have room for it less its rank, and the least such difference of
    the pieces before it in the range. Only counts are carried along. A last row of kind 2 sums the range up: tokens of its
    pieces, and in the last three columns the pieces, the least difference and the slots."""
    from pyspark import TaskContext

    names = ["part", "size", "kind", "id", "rank", "excess", "before"]
    part, pieces, slots, least, tokens = TaskContext.get().partitionId(), 0, 0, _TOP, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        kind = batch.column(1).to_numpy()
        is_piece = kind == 1
        own = np.cumsum(is_piece) + pieces
        room = np.cumsum(~is_piece) + slots
        excess = np.where(is_piece, room - own, _TOP)
        upto = np.minimum.accumulate(np.minimum(excess, least))
        before = np.concatenate([[least], upto[:-1]])
        pieces, slots, least, tokens = int(own[-1]), int(room[-1]), int(upto[-1]), tokens + int(batch.column(0).to_numpy()[is_piece].sum())
        rank = np.where(is_piece, own, room)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(kind), part, np.int32)), *batch.columns, pa.array(rank, pa.int64()), pa.array(excess, pa.int64()), pa.array(before, pa.int64())], names=names)
    if pieces or slots:
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((part, tokens, 2, 0, pieces, least, slots), (pa.int32(), pa.int64(), pa.int32(), *[pa.int64()] * 4), strict=True)], names=names)


def _matched(pieces: DataFrame, slots: DataFrame) -> tuple[DataFrame, int, int]:
    """pieces(id, size) to slots(id, size), one piece a slot: a table (kind, id, size, place) where pieces and slots of one
    place belong together, and place is null for a piece without a slot; how many pieces have one; tokens of all pieces.

    Pieces and slots are range-sorted by size and swept. A piece's successors are the slots with room for it; they are
    the first ones in order. A piece that has more pieces before it than slots left loses; the others get the slots by
    their rank among the winners, moved up as far towards smaller slots as all of them allow. So the winners are as many
    as can be, and the largest pieces among them."""
    rows = slots.select("size", F.lit(0).alias("kind"), "id").unionByName(pieces.select("size", F.lit(1).alias("kind"), "id"))
    ranged = rows.repartitionByRange(F.desc("size"), "kind", "id").sortWithinPartitions(F.desc("size"), "kind", "id")
    swept = cut(in_arrow(ranged, _swept, "part int, size long, kind int, id long, rank long, excess long, before long"), "swept")
    # a row for each range: what lies before it, and the least excess there
    parts = sorted(swept.where("kind = 2").select("part", F.col("size").alias("tokens"), F.col("rank").alias("pieces"), F.col("excess").alias("least"), F.col("before").alias("slots")).collect(), key=lambda r: r.part)
    starts, pieces_before, slots_before, least = [], 0, 0, 0
    for r in parts:
        starts.append((r.part, pieces_before, slots_before, least))
        least = min(least, slots_before - pieces_before + r.least)
        pieces_before, slots_before = pieces_before + r.pieces, slots_before + r.slots
    spread = min((s - p + r.least for (_, p, s, _), r in zip(starts, parts, strict=True)), default=0)
    # by range: three numbers each, as literals
    of_part: dict[int, tuple] = {r[0]: r[1:] for r in starts}
    d, s, m = (F.element_at(F.lit([of_part.get(part, (0, 0, 0))[k] for part in range(max(of_part, default=0) + 1)]).cast("array<long>"), F.col("part") + 1) for k in range(3))
    # all winners' ranks may move up by what the tightest of them has to spare
    up = max(0, spread) if spread < _TOP // 2 else 0
    known = swept.where("kind < 2").select("*", d.alias("d"), s.alias("s"), m.alias("m"))
    tightest = F.least(F.col("m"), F.lit(0), F.col("s") - F.col("d") + F.col("before"))
    wins = F.col("s") - F.col("d") + F.col("excess") >= tightest
    place = F.when(F.col("kind") == 0, F.col("s") + F.col("rank")).when(wins, F.col("d") + F.col("rank") + tightest + up)
    return known.select("kind", "id", "size", place.alias("place")), pieces_before + least, sum(r.tokens for r in parts)


def sequences(pieces: DataFrame, size: int) -> DataFrame:
    """pieces(id, length): id, length, sequence_id and turn, the order in which a sequence took its pieces."""
    spark = pieces.sparkSession
    group = F.lit(0)
    for part in CLASSES:
        group = group + (F.col("length") * part <= size).cast("int")
    totals = pieces.groupBy(group.alias("class")).agg(F.count("*").alias("n"), F.sum("length").alias("tokens"), F.max("length").alias("longest"), F.min("length").alias("shortest")).orderBy("class").collect()
    nothing = spark.createDataFrame([], "id long, size long")
    gaps, took, opened = nothing, [], 0

    def new_ones(n: int, tokens: int, shortest: int) -> DataFrame:
        nonlocal opened
        first, opened = opened, opened + max(-(-tokens // size), -(-n // (size // shortest)))
        return spark.range(first, opened).select("id", F.lit(size).cast("long").alias("size"))

    for group in totals:
        left, n = pieces.where(F.col("length").between(group.shortest, group.longest)).select("id", F.col("length").alias("size")), group.n
        if not opened:
            gaps = new_ones(n, group.tokens, group.shortest)
        while n:
            # a large gap has room for several pieces of the class at once; the last slot has what is over
            many = F.greatest(F.lit(1), F.floor(F.col("size") / group.longest)).cast("int")
            slots = gaps.where(F.col("size") >= group.shortest).select("id", "size", many.alias("of"), F.posexplode(F.sequence(F.lit(1), many)).alias("k", "no"))
            slots = slots.select("id", F.when(F.col("no") < F.col("of"), F.lit(group.longest).cast("long")).otherwise(F.col("size") - F.col("k") * group.longest).alias("size"))
            found, won, tokens = _matched(left, slots)
            rest, few = n - won, won <= OPEN_AT * n
            if not won:
                gaps = gaps.unionByName(new_ones(n, tokens, group.shortest))
                continue
            pairs = found.where("kind = 1 AND place IS NOT NULL").select("place", F.struct("id", F.col("size").alias("length")).alias("piece")).join(found.where("kind = 0").select("place", "id"), "place")
            # a sequence has `size` pieces at most
            flows = gaps.withColumn("piece", F.lit(None).cast("struct<id: bigint, length: bigint>")).unionByName(pairs.select("id", (-F.col("piece.length")).alias("size"), "piece"))
            after = cut(flows.groupBy("id").agg(F.sum("size").alias("size"), F.collect_list("piece").alias("taken")), "gaps")
            took.append(after.where(F.size("taken") > 0).select(F.col("id").alias("sequence_id"), F.inline("taken"), F.lit(len(took)).alias("turn")))
            gaps, left, n = after.where("size > 0").select("id", "size"), found.where("kind = 1 AND place IS NULL").select("id", "size"), rest
            if rest and few:  # the pieces left are the smaller ones, so their tokens are at most their share by number
                gaps = gaps.unionByName(new_ones(rest, tokens * rest // (rest + won), group.shortest))
    return functools.reduce(DataFrame.unionByName, took) if took else spark.createDataFrame([], "sequence_id long, id long, length long, turn int")


def tokenized_pieces(docs: DataFrame, path: str, size: int = 2048, end: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each row's ids with end behind them, cut to at most size ids."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    return in_arrow(texts, _pieces(path, size, end), "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, path: str, size: int = 2048, end: int = 0) -> DataFrame:
    """Each piece of each document with its sequence_id and its offset there; sequences have no holes.

    docs(doc_id, text, ...): a null text is empty and so has the id end alone; a null doc_id stays null; each of several
    equal rows is packed by itself; an empty table gives no piece; other columns aren't read. Only documents of more
    than size ids are cut, into pieces of size of which the first may be shorter. Texts may be of any length. Pieces of
    one length are taken in the order in which the scan numbered them.
    """
    with scratch(docs.sparkSession) as kept:
        pieces = cut(tokenized_pieces(docs, path, size, end).withColumn("id", F.monotonically_increasing_id()), "pieces")
        placed = cut(sequences(pieces.select("id", "length"), size), "sequences")
        kept += [pieces, placed]
    # a sequence has `size` pieces at most
    inside = Window.partitionBy("sequence_id").orderBy("turn", F.desc("length"), "id")
    offsets = placed.select("id", "sequence_id", (F.sum("length").over(inside) - F.col("length")).alias("offset"))
    return pieces.join(offsets, "id").drop("id")
