"""Tables of distinct chunks: each distinct chunk of a task's texts is turned into
token ids once, and the texts' ids are joined back from the table by position."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

Encode = Callable[[list[str]], list[list[int]]]


class Ragged:
    """Rows of ids of any length, in one flat array that grows."""

    def __init__(self):
        self.ids = np.empty(1 << 16, np.int32)
        self.starts = np.empty(1 << 12, np.int64)
        self.lengths = np.empty(1 << 12, np.int64)
        self.used = self.n = 0

    def append(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        m = self.n + len(lengths)
        while len(self.ids) < self.used + len(flat):
            self.ids = np.concatenate((self.ids, np.empty_like(self.ids)))
        while len(self.starts) < m:
            self.starts = np.concatenate((self.starts, np.empty_like(self.starts)))
            self.lengths = np.concatenate((self.lengths, np.empty_like(self.lengths)))
        self.ids[self.used : self.used + len(flat)] = flat
        self.lengths[self.n : m] = lengths
        self.starts[self.n : m] = self.used + np.cumsum(lengths) - lengths
        self.used, self.n = self.used + len(flat), m

    def cut(self, n: int) -> None:
        """Forget all but the first ``n`` rows."""
        if n < self.n:
            self.used, self.n = int(self.starts[n]), n

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the rows one after another, length of each row)"""
        lengths = self.lengths[rows]
        ends = np.cumsum(lengths)
        kind = np.int32 if self.used < 1 << 31 and not (len(ends) and ends[-1] >> 31) else np.int64
        at = np.arange(ends[-1] if len(ends) else 0, dtype=kind)
        at += np.repeat((self.starts[rows] - (ends - lengths)).astype(kind), lengths)
        return self.ids[at], lengths


class ChunkTable:
    """chunk -> row of ids. It remembers the first ``most`` chunks, among them all
    frequent ones; later ones are encoded when they come, which bounds memory."""

    def __init__(self, encode: Encode, most: int = 1 << 19):
        self.encode, self.most = encode, most
        self.rows: dict[str, int] = {}
        self.ragged = Ragged()

    def rows_of(self, distinct: pa.Array) -> np.ndarray:
        """Rows of distinct chunks, valid until the next call."""
        self.ragged.cut(len(self.rows))
        chunks = distinct.to_pylist()
        row = self.rows.get
        found = [row(c, -1) for c in chunks]
        missing = [c for c, r in zip(chunks, found) if r < 0]
        rows = np.array(found, np.int64)
        if missing:
            lists = self.encode(missing)
            lengths = np.fromiter(map(len, lists), np.int64, len(lists))
            flat = np.fromiter((i for ids in lists for i in ids), np.int32, int(lengths.sum()))
            n = self.ragged.n
            self.ragged.append(flat, lengths)
            rows[rows < 0] = np.arange(n, n + len(missing))
            self.rows.update(zip(missing[: max(0, self.most - n)], range(n, n + len(missing))))
        return rows

    def join(self, chunks: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """Lists of chunks -> (all ids in order, number of ids of each list)."""
        coded = chunks.flatten().dictionary_encode()
        rows = self.rows_of(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        ids, lengths = self.ragged.take(rows)
        return ids, per_list(chunks, lengths)


def per_list(chunks: pa.ListArray, lengths: np.ndarray) -> np.ndarray:
    """Sums of the chunks' lengths by list."""
    upto = np.concatenate(([0], np.cumsum(lengths)))
    sizes = pc.list_value_length(chunks).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.diff(upto[np.concatenate(([0], np.cumsum(sizes)))])


def portions(texts: pa.Array, most: int = 16 << 20) -> Iterator[pa.Array]:
    """Consecutive texts of about ``most`` bytes together (a longer one alone), which
    bounds what is held at once."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    first = held = 0
    for k, n in enumerate(sizes.tolist()):
        if held and held + n > most:
            yield texts.slice(first, k - first)
            first, held = k, 0
        held += n
    if first < len(texts):
        yield texts.slice(first)


def cut(ids: np.ndarray, counts: np.ndarray) -> Iterator[np.ndarray]:
    at = 0
    for n in counts.tolist():
        yield ids[at : at + n]
        at += n
