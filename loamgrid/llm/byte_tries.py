"""Radix tries over bytes, kept as arrays in pre-order, with counters of sources at their leaves.

A trie is the list of its leaves in order of their bytes: for each the depth at which its path leaves that of the leaf
before it, and the label from there on. That is the radix trie's pre-order with its inner nodes left implicit; it can be
cut into ranges of prefixes, and tries are merged leaf by leaf. A leaf has a number of documents and a run of counters
(source, occurrences).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Deepest shared prefix that is noted; deeper ones are part of the label.
DEEPEST = 255


def strings(data: np.ndarray, lengths: np.ndarray) -> pa.LargeBinaryArray:
    """Binary values that lie one behind the other in data."""
    offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def parts_of(values: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of values(without nulls)."""
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)
    return data, offsets


def runs(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ..., n - 1 for each n of lengths."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - lengths, lengths)


@dataclass
class Trie:
    """Leaves in order of their bytes; docs of each; sizes: how many counters each has, which are in groups and n."""

    terms: pa.LargeBinaryArray
    docs: np.ndarray
    sizes: np.ndarray
    groups: np.ndarray
    n: np.ndarray

    def __len__(self) -> int:
        return len(self.terms)

    @classmethod
    def of(cls, terms: pa.LargeBinaryArray, leaf: np.ndarray, docs: np.ndarray, counter_leaf: np.ndarray, groups: np.ndarray, n: np.ndarray) -> Trie:
        """Of terms in any order, equal ones included: numbers of documents of terms[leaf], counters of terms[counter_leaf].
        Counters of one term and group are summed up."""
        coded = terms.dictionary_encode()
        order = pc.array_sort_indices(coded.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        rank = rank[coded.indices.to_numpy()]
        total = np.zeros(len(order), np.int64)
        np.add.at(total, rank[leaf], docs)
        names, group = np.unique(groups, return_inverse=True)
        key = rank[counter_leaf] * max(1, len(names)) + group
        by = np.argsort(key, kind="stable")
        key, n = key[by], n[by]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        sums = np.add.reduceat(n, first) if len(key) else n
        key = key[first]
        sizes = np.bincount(key // max(1, len(names)), minlength=len(order)) if len(key) else np.zeros(len(order), np.int64)
        return cls(coded.dictionary.take(pa.array(order)), total, sizes, names[key % max(1, len(names))], sums)

    def part(self, begin: int, end: int) -> Trie:
        a, b = int(self.sizes[:begin].sum()), int(self.sizes[:end].sum())
        return Trie(self.terms.slice(begin, end - begin), self.docs[begin:end], self.sizes[begin:end], self.groups[a:b], self.n[a:b])

    def where(self, keep: np.ndarray) -> Trie:
        counters = np.repeat(keep, self.sizes)
        return Trie(self.terms.filter(pa.array(keep)), self.docs[keep], self.sizes[keep], self.groups[counters], self.n[counters])

    def depths(self) -> np.ndarray:
        """For each leaf how many bytes it shares with the leaf before it, at most DEEPEST."""
        data, offsets = parts_of(self.terms)
        length = np.minimum(np.diff(offsets), DEEPEST)
        shared = np.zeros(len(self), np.int64)
        rows = np.arange(1, len(self))
        depth = 0
        while len(rows):
            rows = rows[(length[rows] > depth) & (length[rows - 1] > depth)]
            rows = rows[data[offsets[rows] + depth] == data[offsets[rows - 1] + depth]]
            depth += 1
            shared[rows] = depth
        return shared

    def packed(self) -> dict:
        """The pre-order as a row: depths, labels and counters as bytes."""
        data, offsets = parts_of(self.terms)
        depth = self.depths()
        label = np.diff(offsets) - depth
        at = np.repeat(offsets[:-1] + depth, label) + runs(label)
        names, group = np.unique(self.groups, return_inverse=True)
        small = (np.uint16, np.uint32)[len(names) > 65535]
        return {
            "depths": depth.astype(np.uint8).tobytes(), "lengths": label.astype(np.uint32).tobytes(), "labels": data[at].tobytes(), "docs": self.docs.astype(np.uint32).tobytes(), "sizes": self.sizes.astype(np.uint32).tobytes(),
            "names": names.astype(np.int64).tobytes(), "groups": group.astype(small).tobytes(), "n": self.n.astype(np.uint32 if not len(self.n) or self.n.max() < 1 << 32 else np.uint64).tobytes(),
        }

    @classmethod
    def unpacked(cls, row: dict) -> Trie:
        depth, label = np.frombuffer(row["depths"], np.uint8).astype(np.int64), np.frombuffer(row["lengths"], np.uint32).astype(np.int64)
        length = depth + label
        offsets = np.concatenate([[0], np.cumsum(length)])
        data = np.empty(int(offsets[-1]), np.uint8)
        data[np.repeat(offsets[:-1] + depth, label) + runs(label)] = np.frombuffer(row["labels"], np.uint8)
        index = np.arange(len(depth))
        for k in range(int(depth.max()) if len(depth) else 0):
            rows = np.flatnonzero(depth > k)
            # the last leaf before whose own label has the byte at this depth
            source = np.maximum.accumulate(np.where(depth <= k, index, 0))[rows]
            data[offsets[rows] + k] = data[offsets[source] + k]
        names, sizes = np.frombuffer(row["names"], np.int64), np.frombuffer(row["sizes"], np.uint32).astype(np.int64)
        counters = int(sizes.sum())
        group = np.frombuffer(row["groups"], np.uint16 if len(names) <= 65535 else np.uint32).astype(np.int64)
        n = np.frombuffer(row["n"], np.uint32 if len(row["n"]) == 4 * counters else np.uint64).astype(np.int64)
        return cls(strings(data, length), np.frombuffer(row["docs"], np.uint32).astype(np.int64), sizes, names[group], n)


def merged(tries: list[Trie]) -> Trie:
    """One trie with the sums of all."""
    if len(tries) == 1:
        return tries[0]
    terms = pa.concat_arrays([t.terms for t in tries])
    leaf = np.arange(len(terms))
    return Trie.of(terms, leaf, np.concatenate([t.docs for t in tries]), np.repeat(leaf, np.concatenate([t.sizes for t in tries])), np.concatenate([t.groups for t in tries]), np.concatenate([t.n for t in tries]))
