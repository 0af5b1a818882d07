"""Token ids as files: Re-Pair grammar compression with random access.

Texts are encoded, an end id closes each document, and the ids are written in
ascending id order of the documents. A file is a row of segments, each compressed by
its own grammar: round by round the frequent pairs of adjacent symbols are replaced
by new symbols (nonterminals). A segment stores the rules, the expansion length of
each, the remaining symbols and, for every 256th of them, how many ids lie before it,
so any range of ids is decoded from the symbols around it.

Segment (little-endian): magic ``RPG1``; u32 first nonterminal, symbol width in
bytes; u64 numbers of documents, ids, rules, symbols; per document i64 id, u8 1 where
the id is null, u64 ids; per rule u32 left, u32 right, u64 expansion length; u64 index;
symbols. File: segments, then u64 offset of each, u64 their number, ``RPGF``.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeful.llm.chunks import ChunkTable, Ragged, cut, per_list, portions
from wakeful.llm.common import cut_lineage, text_of
from wakeful.llm.files import create, open_random, read_at, shared_folder

MAGIC, FOOT = b"RPG1", b"RPGF"
HEAD = struct.Struct("<4sIIQQQQ")
EVERY = 256
SEGMENT_IDS = 1 << 20
LEAST_USES = 8
ROUNDS = 4
PAIRS_A_ROUND = 4000


# -- encoding ---------------------------------------------------------------------

# Letters and closing marks: the tokenizer splits the two before it merges.
PLAIN = "^(?P<letters>[a-zA-ZÀ-ÖØ-öø-ÿ]+)(?P<marks>[.,;:!?]*)$"


SMALL = re.compile("[a-zß-öø-ÿ]+")


def byte_marks() -> dict[int, int]:
    """Byte -> the character that stands for it in a byte-level vocabulary: itself if
    it can be printed, else the next one from 256 on."""
    printed = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printed]
    return {b: b for b in printed} | {b: 256 + i for i, b in enumerate(others)}


BYTE_MARKS = byte_marks()


class WordEncoder:
    """A tokenizer that drops white space and merges within words only: a text's ids
    are those of its words in order. Each distinct word of a portion of texts is looked
    up once; words of letters and closing marks share the ids of their lower-case
    letters, and each distinct one of those is encoded once by a task."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.merge = self.library.model.tokenize
        self.table = ChunkTable(self._encode)

    def _encode(self, words: list[str]) -> list[list[int]]:
        """Lower-case letters are one word to every step before the merges, so they go
        to the merges at once, spelled in the characters that stand for bytes."""
        plain = [SMALL.fullmatch(w) is not None for w in words]
        rest = [w for w, p in zip(words, plain) if not p]
        others = iter(self.library.encode_batch_fast(rest, add_special_tokens=False))
        return [
            [t.id for t in self.merge(w if w.isascii() else w.encode().decode("latin-1").translate(BYTE_MARKS))] if p else next(others).ids
            for w, p in zip(words, plain)
        ]

    def _of_words(self, words: pa.Array) -> Ragged:
        """The ids of distinct words."""
        parts = pc.extract_regex(words, PLAIN)
        letters = pc.utf8_lower(parts.field("letters")).fill_null("")
        letters = pc.if_else(parts.is_valid(), letters, words)
        marks = pc.if_else(parts.is_valid(), parts.field("marks"), "")
        coded = pa.concat_arrays([letters, marks]).dictionary_encode()
        rows = self.table.rows_of(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        ids, lengths = self.table.ragged.take(rows.reshape(2, -1).T.ravel())
        out = Ragged()
        out.append(ids, lengths.reshape(-1, 2).sum(axis=1))
        return out

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        for part in portions(texts):
            words = pc.ascii_split_whitespace(part)
            coded = words.flatten().dictionary_encode()
            ids, lengths = self._of_words(coded.dictionary).take(coded.indices.to_numpy(zero_copy_only=False))
            yield from cut(ids, per_list(words, lengths))


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


# -- Re-Pair ----------------------------------------------------------------------


@dataclass
class Grammar:
    first: int  # first nonterminal; smaller symbols are ids
    rules: np.ndarray  # (n, 2): rule k makes symbol first + k
    lengths: np.ndarray  # expansion length of each rule
    symbols: np.ndarray


def _pairs(symbols: np.ndarray, top: int) -> np.ndarray:
    """Adjacent symbols as one number each: 32 bits while symbols take 16."""
    if top <= 1 << 16:
        narrow = symbols.astype(np.uint32)
        return narrow[:-1] << np.uint32(16) | narrow[1:]
    return symbols[:-1].astype(np.uint64) << np.uint64(32) | symbols[1:].astype(np.uint64)


def _slot(pairs: np.ndarray) -> np.ndarray:
    if pairs.dtype == np.uint32:
        return (pairs * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return (pairs * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)


def repair(ids: np.ndarray, least: int = LEAST_USES, rounds: int = ROUNDS) -> Grammar:
    """Replace frequent pairs round by round: in a round the pairs with at least 1/64
    of the most frequent one's count (and ``least``; the ``PAIRS_A_ROUND`` most
    frequent of them) get a nonterminal each; of overlapping occurrences the left one
    is replaced."""
    symbols = ids.astype(np.int64)
    first = int(symbols.max()) + 1 if len(symbols) else 0
    rules = np.empty((0, 2), np.int64)
    lengths = np.empty(0, np.int64)
    for _ in range(rounds):
        if len(symbols) < 2:
            break
        pairs = _pairs(symbols, first + len(rules))
        ordered = np.sort(pairs)
        starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        counts = np.diff(np.concatenate((starts, [len(ordered)])))
        often = counts >= max(least, int(counts.max()) // 64)
        if not often.any():
            break
        found, uses = ordered[starts[often]], counts[often]
        if len(found) > PAIRS_A_ROUND:
            most = np.sort(np.argsort(-uses, kind="stable")[:PAIRS_A_ROUND])
            found, uses = found[most], uses[most]
        # one slot holds one pair, the most frequent of those that fall there; the
        # others wait for a later round
        slots = np.zeros(1 << 16, np.int64)
        by_use = np.argsort(uses, kind="stable")
        slots[_slot(found[by_use])] = by_use
        at = slots[_slot(pairs)]
        hits = np.flatnonzero(found[at] == pairs)
        at = at[hits]
        run = np.flatnonzero(np.concatenate(([True], np.diff(hits) != 1)))  # runs of overlapping occurrences
        place = np.arange(len(hits)) - np.repeat(run, np.diff(np.concatenate((run, [len(hits)]))))
        hits, at = hits[place % 2 == 0], at[place % 2 == 0]
        used = np.flatnonzero(np.bincount(at, minlength=len(found)))
        rank = np.zeros(len(found), np.int64)
        rank[used] = np.arange(len(used))
        half = np.array(4 * found.itemsize, found.dtype)
        new = np.stack((found[used] >> half, found[used] & ((np.array(1, found.dtype) << half) - np.array(1, found.dtype))), axis=1).astype(np.int64)
        sizes = np.concatenate((np.ones(first, np.int64), lengths))
        lengths = np.concatenate((lengths, sizes[new[:, 0]] + sizes[new[:, 1]]))
        symbols[hits] = first + len(rules) + rank[at]
        stay = np.ones(len(symbols), bool)
        stay[hits + 1] = False
        symbols = symbols[stay]
        rules = np.concatenate((rules, new))
    return Grammar(first, rules, lengths, symbols)


def expand(symbols: np.ndarray, first: int, rules: np.ndarray) -> np.ndarray:
    """The ids that symbols stand for, one level of rules after the other."""
    while True:
        open_ = symbols >= first
        if not open_.any():
            return symbols
        out = np.repeat(symbols, open_ + 1)
        at = np.flatnonzero(open_)
        pair = rules[symbols[at] - first]
        at = at + np.arange(len(at))
        out[at], out[at + 1] = pair[:, 0], pair[:, 1]
        symbols = out


def expansions(first: int, rules: np.ndarray, lengths: np.ndarray) -> Ragged:
    """The ids of every symbol: the alphabet, then each rule's expansion."""
    table = Ragged()
    table.append(np.arange(first), np.ones(first, np.int64))
    table.append(expand(first + np.arange(len(rules)), first, rules), lengths)
    return table


# -- files ------------------------------------------------------------------------


def _packed(symbols: np.ndarray, width: int) -> bytes:
    return symbols.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].tobytes()


def _unpacked(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 4), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<u4").ravel().astype(np.int64)


def segment(names: list[int | None], parts: list[np.ndarray]) -> bytes:
    """Documents' ids as one segment."""
    ids = np.concatenate(parts) if parts else np.empty(0, np.int32)
    g = repair(ids)
    top = g.first + len(g.rules)
    width = 2 if top <= 1 << 16 else 3 if top <= 1 << 24 else 4
    sizes = np.concatenate((np.ones(g.first, np.int64), g.lengths))[g.symbols] if len(g.symbols) else np.empty(0, np.int64)
    index = (np.cumsum(sizes) - sizes)[::EVERY]
    return b"".join(
        (
            HEAD.pack(MAGIC, g.first, width, len(names), len(ids), len(g.rules), len(g.symbols)),
            np.array([n or 0 for n in names], "<i8").tobytes(),
            np.array([n is None for n in names], np.uint8).tobytes(),
            np.array([len(p) for p in parts], "<u8").tobytes(),
            g.rules.astype("<u4").tobytes(),
            g.lengths.astype("<u8").tobytes(),
            index.astype("<u8").tobytes(),
            _packed(g.symbols, width),
        )
    )


class SegmentReader:
    """Range reads of one segment: the tables when opened, symbols as asked for."""

    def __init__(self, file, offset: int):
        magic, self.first, self.width, docs, self.n_ids, rules, self.n_symbols = HEAD.unpack(read_at(file, offset, HEAD.size))
        if magic != MAGIC:
            raise ValueError("no segment here")
        self.file, at = file, offset + HEAD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            size = n * np.dtype(kind).itemsize
            data = np.frombuffer(read_at(file, at, size), kind)
            at += size
            return data

        names, missing = take("<i8", docs), take("u1", docs)
        self.names = [None if m else n for n, m in zip(names.tolist(), missing.tolist())]
        self.counts = take("<u8", docs).astype(np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        self.rules = take("<u4", 2 * rules).astype(np.int64).reshape(-1, 2)
        self.lengths = take("<u8", rules).astype(np.int64)
        self.index = take("<u8", -(-self.n_symbols // EVERY)).astype(np.int64)
        self.at = at

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` to ``stop`` of the segment: only the index blocks
        that hold them are read and only the symbols that reach into them expanded."""
        if stop <= start:
            return np.empty(0, np.int64)
        low = int(np.searchsorted(self.index, start, "right")) - 1
        high = int(np.searchsorted(self.index, stop, "left"))
        a, b = low * EVERY, min(high * EVERY, self.n_symbols)
        symbols = _unpacked(read_at(self.file, self.at + a * self.width, (b - a) * self.width), self.width)
        sizes = np.ones(len(symbols), np.int64)
        rule = symbols >= self.first
        sizes[rule] = self.lengths[symbols[rule] - self.first]
        ends = self.index[low] + np.cumsum(sizes)
        i, j = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left")
        before = ends[i] - sizes[i]
        if j - i < 1 << 12:
            out = expand(symbols[i : j + 1], self.first, self.rules)
        else:
            out, _ = expansions(self.first, self.rules, self.lengths).take(symbols[i : j + 1])
        return out[start - before : stop - before]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k] + self.counts[k]))


# -- the operator -----------------------------------------------------------------


def write_ids(docs: DataFrame, model: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, close each document with ``end_id``, write. Returns the manifest, a row
    per segment: ``part``, ``seq`` (their order is the order of the ids), ``path``,
    ``offset``, ``n_docs``, ``n_ids``.

    Ids of documents are whole numbers; documents are dealt to files by ranges of
    them. Null ids come first; rows with equal ids stay together in a file. Null and
    empty texts are the end id alone. A task holds one segment at a time."""
    folder = shared_folder(docs.sparkSession, "token-ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = encoder(model), TaskContext.get().partitionId()
        end = np.array([end_id], np.int32)
        uri = out = None
        rows: list[tuple] = []
        names: list[int | None] = []
        parts: list[np.ndarray] = []
        held = at = 0

        def flush():
            nonlocal uri, out, names, parts, held, at
            if out is None:
                uri, out = create(folder, f"part-{part:05d}", ".rpg")
            data = segment(names, parts)
            out.write(data)
            rows.append((part, len(rows), uri, at, len(names), held))
            at += len(data)
            names, parts, held = [], [], 0

        for batch in batches:
            for name, ids in zip(batch.column(0).to_pylist(), own.encode(batch.column(1))):
                names.append(name)
                parts.append(np.concatenate((ids, end)))
                held += len(parts[-1])
                if held >= SEGMENT_IDS:
                    flush()
        if names:
            flush()
        if out is not None:
            out.write(np.array([r[3] for r in rows], "<u8").tobytes() + struct.pack("<Q", len(rows)) + FOOT)
            out.close()
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), MANIFEST.types)]
            yield pa.RecordBatch.from_arrays(columns, MANIFEST.names)

    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", F.crc32(F.encode("text", "UTF-8")))
    )
    return cut_lineage(
        ordered.mapInArrow(run, "part int, seq int, path string, offset long, n_docs long, n_ids long"), "token-manifest"
    )


MANIFEST = pa.schema(
    [("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("offset", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]
)


def with_starts(manifest: DataFrame) -> DataFrame:
    """``start``: ids before each segment. Running sums within files, then over the
    files' totals (a row per file)."""
    files = manifest.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    within = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    return manifest.join(files.select("part", before.alias("before")), "part").withColumn("start", F.col("before") + within)


def read_ids(manifest: DataFrame, digest: bool = False) -> DataFrame:
    """(``doc_id``, ``start``, ``n_tokens``, ``ids``) of every document, read back from
    the files segment by segment; ``start`` counts the ids of all documents before it.
    With ``digest``, ``ids_crc32`` (of the ids as little-endian u32) in place of
    ``ids``."""
    last = ("ids_crc32", pa.int64(), "long") if digest else ("ids", pa.list_(pa.int64()), "array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_random(row["path"]) as file:
                    found = SegmentReader(file, row["offset"])
                    ids = found.ids(0, found.n_ids)
                cuts = [ids[s : s + n] for s, n in zip(found.starts.tolist(), found.counts.tolist())]
                values = [zlib.crc32(c.astype("<u4", copy=False).tobytes()) for c in cuts] if digest else cuts
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.names, pa.int64()), pa.array(row["start"] + found.starts), pa.array(found.counts), pa.array(values, last[1])],
                    ["doc_id", "start", "n_tokens", last[0]],
                )

    placed = with_starts(manifest).select("path", "offset", "start")
    tasks = max(1, min(manifest.count(), 20_000))
    return placed.repartition(tasks).mapInArrow(run, f"doc_id long, start long, n_tokens long, {last[0]} {last[2]}")
