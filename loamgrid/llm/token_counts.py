"""Token counts: a piece count for each distinct pre-token, joined to the pre-token frequencies of the documents.

A byte-pair tokenizer never merges across its pre-tokens, so a document's token count is the sum over its pre-tokens of
frequency times piece count. No token id of a document is ever made.

The frequent pre-tokens of the corpus (at most HEAVY of them, found in a sample of documents) are counted once and sent
to all executors; that table has a fixed bound. All others go to the partition of their hash, one row for each document
and distinct pre-token, are sorted, counted once each, and only sums return. The sample decides where a pre-token is
counted, never what the count is. So no pre-token of a large share of all rows meets in one task.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LETTERS, NUMBERS, UNSAFE, in_arrow, slices, text_column

#: Most pre-tokens whose counts go to every executor (about 10 MB), and documents in the sample that finds them.
HEAVY, SAMPLE_DOCS = 200_000, 20_000
#: Pre-tokens of word_bpe_49k.json; a fixed value of that tokenizer, for lower-cased text of the safe code points.
PRE_TOKENS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\\s{LETTERS}{NUMBERS}]+")


class PreTokens:
    """Splits texts as the library does, and counts the pieces of pre-tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None

    def split(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens, and the number of added tokens (their strings in a text are tokens by the library's default)."""
        found = 0
        if self.added and "<" in text and self.added.search(text):
            parts = self.added.split(text)
            found = len(parts) - 1
        else:
            parts = [text]
        out: list[str] = []
        for part in parts:
            if UNSAFE.search(part):
                normal = self.tokenizer.normalizer.normalize_str(part)
                out += [f"\0{normal[a:b]}" for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]
            else:
                out += PRE_TOKENS.findall(part.lower())
        return out, found

    def pieces(self, tokens: list[str]) -> np.ndarray:
        """\\0 in front: already normalised text of any code points; the library may only split it, never join it."""
        made = self.tokenizer.encode_batch_fast([t.removeprefix("\0") for t in tokens], add_special_tokens=False)
        return np.fromiter(map(len, made), np.int64, len(tokens))


_loaded: dict[str, PreTokens] = {}


def pre_tokens(path: str) -> PreTokens:
    if path not in _loaded:
        _loaded[path] = PreTokens(path)
    return _loaded[path]


def _sampled(path: str):
    def run(batches):
        seen: Counter = Counter()
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                seen.update(pre_tokens(path).split(text)[0])
            if len(seen) > 500_000:
                yield pa.RecordBatch.from_pydict({"pre": list(seen), "n": list(seen.values())})
                seen = Counter()
        yield pa.RecordBatch.from_pydict({"pre": list(seen), "n": list(seen.values())}, schema=pa.schema([("pre", pa.string()), ("n", pa.int64())]))

    return run


def _split(path: str, heavy):
    """A row for each document with the sum over heavy pre-tokens, and one for each other distinct pre-token in it."""
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("n_bytes", pa.int64()), ("n", pa.int64()), ("pre", pa.string())])

    def run(batches):
        known, split = heavy.value.get, pre_tokens(path).split
        for batch in slices(batches):
            ids, hs, sizes, ns, pres = [], [], [], [], []
            for doc_id, h, size, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens, total = split(text)
                counts = list(map(known, tokens, repeat(0)))
                total += sum(counts)
                ids.append(doc_id), hs.append(h), sizes.append(size), ns.append(total), pres.append(None)
                if 0 in counts:
                    light = Counter(t for t, n in zip(tokens, counts, strict=True) if not n)
                    ids += [doc_id] * len(light)
                    hs += [h] * len(light)
                    sizes += repeat(None, len(light))
                    ns += light.values()
                    pres += light
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((ids, hs, sizes, ns, pres), schema, strict=True)], schema=schema)

    return run


def _count(path: str):
    """Of rows in order of pre-tokens: frequency times the pieces; the pre-token's pieces are counted once."""
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("n_bytes", pa.int64()), ("n", pa.int64()), ("base", pa.int64())])

    def run(batches):
        last, last_n = None, 0
        for batch in slices(batches, 65536, 1 << 30):
            pre = batch.column(4).dictionary_encode()
            base = np.asarray(pa.compute.is_null(batch.column(4)).to_numpy(zero_copy_only=False), np.int64)
            words = pre.dictionary.to_pylist()
            table = np.zeros(len(words) + 1, np.int64)
            skip = 1 if words and words[0] == last else 0
            if words:
                table[: len(words)] = np.concatenate([[last_n][:skip], pre_tokens(path).pieces(words[skip:])])
                last, last_n = words[-1], int(table[len(words) - 1])
            at = pre.indices.fill_null(len(words)).to_numpy()
            n = batch.column(3).to_numpy() * np.where(base, 1, table[at])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(n), pa.array(base)], schema=schema)

    return run


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, heavy: int = HEAVY, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit): a row for each row of docs(doc_id, text, ...).

    path: a tokenizers .json file whose normaliser and pre-tokens are those of word_bpe_49k.json. Nulls: a null text is
    empty and has no token; a null doc_id stays null. Repeated rows each have their row. An empty table gives an empty
    one. Other columns aren't read. Texts may be of any length; a batch holds one whole text at least.
    """
    spark = docs.sparkSession
    # a row's key: equal ids with equal texts have equal counts, so they may share one
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text")).select("doc_id", F.xxhash64("text").alias("h"), F.octet_length("text").cast("long").alias("n_bytes"), "text")
    every = max(1, docs.count() // max(1, sample_docs))
    sample = docs.where(F.pmod(F.xxhash64("doc_id", "h"), F.lit(every)) == 0).select("text")
    top = in_arrow(sample, _sampled(path), "pre string, n long").groupBy("pre").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pre").limit(heavy)
    words = [r.pre for r in top.select("pre").collect()]
    known = dict(zip(words, pre_tokens(path).pieces(words).tolist(), strict=True))
    rows = in_arrow(docs, _split(path, spark.sparkContext.broadcast(known)), "doc_id long, h long, n_bytes long, n long, pre string")
    # documents' own rows have no pre-token: they are dealt by their key
    dealt = rows.repartition(F.when(F.col("pre").isNull(), F.xxhash64("doc_id", "h")).otherwise(F.xxhash64("pre")))
    counted = in_arrow(dealt.sortWithinPartitions("pre"), _count(path), "doc_id long, h long, n_bytes long, n long, base long")
    sums = counted.groupBy("doc_id", "h").agg(F.sum("n").alias("n"), F.sum("base").alias("copies"), F.max("n_bytes").alias("n_bytes"))
    each = sums.select("doc_id", "n_bytes", F.expr("n div copies").alias("n_tokens"), F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return each.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
