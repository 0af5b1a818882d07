"""Cross-tokenizer alignment with inverted pair bitmaps.

Two tokenizers, A (byte-level) and B (pieces), cut the same bytes differently. A token
of A and one of B are linked where their byte ranges overlap; cuts that both share part
a text into groups.

Texts are read in blocks of whole documents. Neither tokenizer's tokens cross a single
blank between two visible characters, so a block is a list of marked chunks; each
distinct chunk is encoded and aligned once, and documents add up what their chunks
have. The block's inverted index holds, for each linked id pair, the compressed bitmap
of the block's documents that have it and, over the bitmap's set bits, bit planes of
the number of further links of the pair in that document. The bitmaps of a block's
parts are OR-merged; popcounts give documents, planes give links. Blocks hold disjoint
documents, so the popcounts of a pair add up over blocks: a grouped sum, in which a
pair has at most one row for each block, however common it is. The sums go back to the
blocks, and the block's postings turn them into the documents' scores.
"""

from __future__ import annotations

import hashlib
import io
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeful.llm.chunks import portions
from wakeful.llm.common import cut_lineage, text_of
from wakeful.llm.files import create, open_random, read_at, shared_folder
from wakeful.llm.grammar import BYTE_MARKS
from wakeful.llm.pieces import MARK

BLOCK_BYTES = 4 << 20  # texts of a block, together (a longer document is one alone)
BLOCK_DOCS = 1 << 16
PART_BYTES = 1 << 20  # texts whose bitmaps are made at once
AT_ONCE = 1 << 13  # chunks
DENSE = 16  # a bitmap's documents go as bits where more than one in so many has the pair
LOW = 17  # bits of an id of B in a pair

# A single blank that starts a chunk: no white space on either side of it.
CUT = re.compile(r"(?<=\S) (?=\S)")


# -- both tokenizers --------------------------------------------------------------


class TwoTokenizers:
    """Ids and byte lengths of both tokenizers' tokens for chunks of text."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as spec
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        back = {mark: byte for byte, mark in BYTE_MARKS.items()}
        entries = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            plain = all(ord(c) in back for c in entry)
            self.bytes_a[i] = bytes(back[ord(c)] for c in entry) if plain else entry.encode()
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(MARK, " ").encode())
        with open(path_b, "rb") as f:
            model = spec.ModelProto.FromString(f.read())
        # as for the pieces operator: no piece crosses from a character to a marker
        self.by_chunk = (
            model.normalizer_spec.name == "identity"
            and not model.normalizer_spec.precompiled_charsmap
            and model.normalizer_spec.add_dummy_prefix
            and not model.normalizer_spec.remove_extra_whitespaces
            and not any(re.search(f"[^{MARK}]{MARK}", p.piece) for p in model.pieces)
        )

    def chunks(self, text: str) -> list[str]:
        """The chunks of blank + text, each without its first blank."""
        if not text:
            return []
        if not self.by_chunk or MARK in text:
            return [text]
        return CUT.split(text)

    def encode(self, chunks: list[str]):
        """(ids, byte lengths, tokens of each chunk) by A, the same by B, and whether
        both give the chunk's bytes back."""
        marked = [" " + c for c in chunks]
        a, b = [], []
        for at in range(0, len(chunks), AT_ONCE):  # the library's results are large objects
            a += [e.ids for e in self.a.encode_batch_fast(marked[at : at + AT_ONCE], add_special_tokens=False)]
            b += self.b.encode(chunks[at : at + AT_ONCE], num_threads=1)
        a, b = _flat(a, self.bytes_a), _flat(b, self.bytes_b)
        want = [m.encode() for m in marked]
        return a, b, self._spelled(a, self.bytes_a, want) & self._spelled(b, self.bytes_b, want)

    def _spelled(self, found, spelled: list[bytes], want: list[bytes]) -> np.ndarray:
        """Whether the tokens of each chunk spell it."""
        ids, sizes, n = found
        upto = np.concatenate(([0], np.cumsum(sizes)))
        bounds = np.concatenate(([0], np.cumsum(n)))
        long = np.fromiter(map(len, want), np.int64, len(want))
        listed = b"".join(map(spelled.__getitem__, ids.tolist()))
        if (np.diff(upto[bounds]) == long).all() and listed == b"".join(want):
            return np.ones(len(want), bool)
        at = upto[bounds].tolist()
        return np.fromiter((listed[s:e] == w for s, e, w in zip(at[:-1], at[1:], want)), bool, len(want))


def _flat(lists: list[list[int]], spelled: list[bytes]):
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    ids = np.fromiter(chain.from_iterable(lists), np.int64, int(n.sum()))
    sizes = np.fromiter(map(len, spelled), np.int64, len(spelled))
    return ids, sizes[ids], n


@lru_cache(maxsize=2)
def tokenizers(path_a: str, path_b: str) -> TwoTokenizers:
    return TwoTokenizers(path_a, path_b)


# -- alignment of chunks ----------------------------------------------------------


@dataclass
class Aligned:
    """What each chunk has: numbers of tokens, groups and links, its linked pairs one
    after the other, and its groups as text."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    pairs: np.ndarray
    groups: list[str]
    whole: np.ndarray


def align(both: TwoTokenizers, chunks: list[str]) -> Aligned:
    """Link the tokens of every chunk. The chunks lie one after the other on one line
    of bytes; since both tokenizers end a token where a chunk ends, no link crosses."""
    (a, size_a, n_a), (b, size_b, n_b), whole = both.encode(chunks)
    if not whole.all():  # texts that don't come back have no tokens
        a, size_a = a[np.repeat(whole, n_a)], size_a[np.repeat(whole, n_a)]
        b, size_b = b[np.repeat(whole, n_b)], size_b[np.repeat(whole, n_b)]
        n_a, n_b = np.where(whole, n_a, 0), np.where(whole, n_b, 0)
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    first = np.searchsorted(end_b, end_a - size_a, "right")  # first token of B that ends behind A's start
    last = np.searchsorted(end_b - size_b, end_a, "left")
    count = last - first
    starts = np.cumsum(count) - count
    other = np.arange(int(count.sum())) + np.repeat(first - starts, count)
    pairs = np.repeat(a, count) << LOW | b[other]
    closes_a, closes_b = np.isin(end_a, end_b), np.isin(end_b, end_a)
    in_a, in_b = np.concatenate(([0], np.cumsum(n_a))), np.concatenate(([0], np.cumsum(n_b)))

    def per_chunk(values, bounds):
        upto = np.concatenate(([0], np.cumsum(values)))
        return np.diff(upto[bounds])

    return Aligned(n_a, n_b, per_chunk(closes_a, in_a), per_chunk(count, in_a), pairs, _group_texts(a, closes_a, in_a, b, closes_b, in_b), whole)


@lru_cache(maxsize=1)
def _marked_numbers(most: int) -> np.ndarray:
    """Numbers as text with each of the marks that may follow."""
    return np.array([f"{i}{mark}" for i in range(most) for mark in ",|;"], object)


def _group_texts(a, closes_a, in_a, b, closes_b, in_b) -> list[str]:
    """The groups of each chunk as text, every group closed by a semicolon: its tokens
    of A, then its tokens of B."""
    group_a, group_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
    n = int(closes_a.sum())
    before_a = np.concatenate(([0], np.cumsum(np.bincount(group_a, minlength=n))))
    before_b = np.concatenate(([0], np.cumsum(np.bincount(group_b, minlength=n))))
    last_a = np.zeros(len(a), np.int64)
    last_a[before_a[1:] - 1] = 1  # followed by the group's tokens of B
    text = np.empty(len(a) + len(b), object)
    numbers = _marked_numbers(1 << LOW)
    text[np.arange(len(a)) + before_b[group_a]] = numbers[3 * a + last_a]
    text[np.arange(len(b)) + before_a[group_b + 1]] = numbers[3 * b + 2 * closes_b]
    at, listed = (in_a + in_b).tolist(), text.tolist()
    return ["".join(listed[s:e]) for s, e in zip(at[:-1], at[1:])]


# -- inverted pair bitmaps --------------------------------------------------------


def _runs(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of the runs of the given sizes."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


@dataclass
class Postings:
    """Pairs (ascending) with the documents that have them. A pair's bitmap over the
    block's documents is compressed: few documents are listed, many are bits. Over the
    set bits of all bitmaps lie planes of the binary digits of (links - 1)."""

    n_docs: int
    pairs: np.ndarray
    counts: np.ndarray  # popcount of each bitmap
    listed: np.ndarray  # documents of the sparse bitmaps
    bits: np.ndarray  # bytes of the dense ones
    planes: list[np.ndarray]  # packed

    @property
    def row(self) -> int:
        return (self.n_docs + 7) // 8

    @property
    def dense(self) -> np.ndarray:
        return self.counts * DENSE > self.n_docs

    @classmethod
    def of(cls, n_docs: int, pair: np.ndarray, doc: np.ndarray, times: np.ndarray) -> Postings:
        """From (pair, document, links) rows, distinct and in that order."""
        starts = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1]))) if len(pair) else np.empty(0, np.int64)
        counts = np.diff(np.concatenate((starts, [len(pair)])))
        made = cls(n_docs, pair[starts], counts, np.empty(0, np.uint16), np.empty((0, 0), np.uint8), [])
        dense = made.dense
        is_dense = np.repeat(dense, counts)
        made.listed = doc[~is_dense].astype(np.uint16)
        made.bits = np.zeros((int(dense.sum()), made.row), np.uint8)
        which = np.repeat(np.arange(int(dense.sum())), counts[dense])
        at = doc[is_dense]
        np.bitwise_or.at(made.bits, (which, at >> 3), (1 << (at & 7)).astype(np.uint8))
        more = times - 1
        made.planes = [np.packbits((more >> p & 1).astype(np.uint8), bitorder="little") for p in range(int(more.max(initial=0)).bit_length())]
        return made

    def documents(self) -> np.ndarray:
        """Set bits of all bitmaps, pair by pair, ascending."""
        out = np.empty(int(self.counts.sum()), np.int64)
        is_dense = np.repeat(self.dense, self.counts)
        out[~is_dense] = self.listed
        if len(self.bits):
            out[is_dense] = np.nonzero(np.unpackbits(self.bits, axis=1, bitorder="little"))[1]
        return out

    def times(self) -> np.ndarray:
        """Links of each set bit."""
        n = int(self.counts.sum())
        out = np.ones(n, np.int64)
        for p, plane in enumerate(self.planes):
            out += np.unpackbits(plane, count=n, bitorder="little").astype(np.int64) << p
        return out

    def doc_counts(self) -> np.ndarray:
        """Popcounts of the bitmaps."""
        out = self.counts.copy()
        out[self.dense] = np.bitwise_count(self.bits).sum(axis=1, dtype=np.int64)
        return out

    def link_counts(self) -> np.ndarray:
        """Documents plus the planes' popcounts by their weight."""
        out = self.doc_counts()
        ends = np.cumsum(self.counts)
        n = int(self.counts.sum())
        for p, plane in enumerate(self.planes):
            upto = np.concatenate(([0], np.cumsum(np.unpackbits(plane, count=n, bitorder="little"), dtype=np.int64)))
            out += (upto[ends] - upto[ends - self.counts]) << p
        return out

    def scores(self, *values: np.ndarray) -> list[np.ndarray]:
        """For values by pair: each document's sum of them over its links."""
        docs, times = self.documents(), self.times()
        return [_sums(docs, np.repeat(v, self.counts) * times, self.n_docs) for v in values]

    @staticmethod
    def merged(n_docs: int, parts: list[Postings]) -> Postings:
        """OR of the parts' bitmaps pair by pair; parts hold different documents, so
        their planes lie side by side."""
        pair = np.concatenate([np.repeat(p.pairs, p.counts) for p in parts] or [np.empty(0, np.int64)])
        doc = np.concatenate([p.documents() for p in parts] or [np.empty(0, np.int64)])
        times = np.concatenate([p.times() for p in parts] or [np.empty(0, np.int64)])
        order = np.argsort(pair, kind="stable")  # parts come in the order of their documents
        return Postings.of(n_docs, pair[order], doc[order], times[order])


def _sums(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Exact whole-number sums by place."""
    out = np.zeros(n, np.int64)
    np.add.at(out, at, values)
    return out


def part_postings(n_docs: int, doc: np.ndarray, chunk: np.ndarray, found: Aligned) -> Postings:
    """Postings of documents given as (document, chunk) rows."""
    bound = np.concatenate(([0], np.cumsum(found.n_links)))
    use, repeats = np.unique(doc * len(found.n_links) + chunk, return_counts=True) if len(doc) else (np.empty(0, np.int64),) * 2
    doc, chunk = np.divmod(use, max(1, len(found.n_links)))
    links = found.n_links[chunk]
    pair = found.pairs[np.repeat(bound[chunk], links) + _runs(links)]
    distinct, pair = np.unique(pair, return_inverse=True)
    key = pair * n_docs + np.repeat(doc, links)
    order = np.argsort(key, kind="stable")
    key, times = key[order], np.repeat(repeats, links)[order]
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
    pair, doc = np.divmod(key[starts], n_docs)
    return Postings.of(n_docs, distinct[pair], doc, np.add.reduceat(times, starts) if len(key) else times)


# -- blocks -----------------------------------------------------------------------


def _index_block(both: TwoTokenizers, names: pa.Array, texts: pa.Array):
    """(per-document columns, postings) of the documents of a block."""
    n = len(texts)
    coded, sizes = [], []
    for part in portions(texts, PART_BYTES):
        lists = [both.chunks(t) for t in part.to_pylist()]
        sizes.append(np.fromiter(map(len, lists), np.int64, len(lists)))
        coded.append(pa.array(list(chain.from_iterable(lists)), pa.string()).dictionary_encode())
        del lists
    merged = pa.chunked_array(coded).unify_dictionaries()
    chunk = np.concatenate([c.indices.to_numpy(zero_copy_only=False) for c in merged.chunks]).astype(np.int64)
    distinct = max((c.dictionary for c in merged.chunks), key=len).to_pylist()
    del coded, merged
    found = align(both, distinct)
    upto = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
    doc = np.repeat(np.arange(n), np.diff(upto))
    broken = np.zeros(n, bool)
    broken[doc[~found.whole[chunk]]] = True
    sums = {c: np.bincount(doc, np.where(broken[doc], 0, getattr(found, c)[chunk]), n).astype(np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
    digests = []
    for k, (s, e) in enumerate(zip(upto[:-1].tolist(), upto[1:].tolist())):
        line = "" if broken[k] else "".join([found.groups[c] for c in chunk[s:e].tolist()])
        digests.append(hashlib.sha256(line[:-1].encode()).hexdigest() if line else "")
    parts, first = [], 0
    for part in portions(texts, PART_BYTES):  # bounds what the postings are made from at once
        some = slice(upto[first], upto[first + len(part)])
        kept = ~broken[doc[some]]
        parts.append(part_postings(n, doc[some][kept], chunk[some][kept], found))
        first += len(part)
    columns = {"doc_id": names, **{c: pa.array(v) for c, v in sums.items()}, "groups_sha256": pa.array(digests, pa.string())}
    return columns, Postings.merged(n, parts)


def _arrow_bytes(columns: dict) -> bytes:
    held = io.BytesIO()
    table = pa.table(columns)
    with pa.ipc.new_stream(held, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return held.getvalue()


def _write_block(folder: str, columns: dict, index: Postings) -> str:
    """One file: the documents' table, the pairs' table, the bitmaps and planes."""
    sections = [
        _arrow_bytes(columns),
        _arrow_bytes({"pair": index.pairs, "n": index.counts}),
        _arrow_bytes({"doc": index.listed}),
        _arrow_bytes({"bits": pa.array([r.tobytes() for r in index.bits], pa.binary())}),
        *[_arrow_bytes({"plane": p}) for p in index.planes],
    ]
    uri, stream = create(folder, "block", ".pairs")
    with stream:
        stream.write(np.array([len(sections), *map(len, sections)], "<u8").tobytes())
        for s in sections:
            stream.write(s)
    return uri


def _read_block(path: str) -> tuple[pa.Table, Postings]:
    with open_random(path) as file:
        n = int.from_bytes(read_at(file, 0, 8), "little")
        sizes = np.frombuffer(read_at(file, 8, 8 * n), "<u8").astype(np.int64)
        at = 8 + 8 * n
        tables = []
        for size in sizes.tolist():
            with pa.ipc.open_stream(read_at(file, at, size)) as found:
                tables.append(found.read_all().combine_chunks())
            at += size
    docs, pairs, listed, bits, *planes = tables
    rows = bits["bits"].to_pylist()
    row = (len(docs) + 7) // 8
    index = Postings(
        len(docs),
        pairs["pair"].to_numpy(),
        pairs["n"].to_numpy(),
        listed["doc"].to_numpy(),
        np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), row),
        [p["plane"].to_numpy() for p in planes],
    )
    return docs, index


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(ids, texts) of consecutive documents, :data:`BLOCK_BYTES` of text together."""
    names, texts, held, n = [], [], 0, 0
    for batch in batches:
        at = 0
        for part in portions(batch.column(1), BLOCK_BYTES // 4):
            for first in range(0, len(part), BLOCK_DOCS // 4):
                some = part.slice(first, BLOCK_DOCS // 4)
                texts.append(some)
                names.append(batch.column(0).slice(at, len(some)))
                at, n, held = at + len(some), n + len(some), held + some.nbytes
                if held >= BLOCK_BYTES or n > BLOCK_DOCS * 3 // 4:
                    yield pa.concat_arrays(names), pa.concat_arrays(texts)
                    names, texts, held, n = [], [], 0, 0
    if n:
        yield pa.concat_arrays(names), pa.concat_arrays(texts)


@dataclass
class PairIndex:
    blocks: DataFrame  # (block, path), a row per block
    local: DataFrame  # (block, pair, docs, links): popcounts by block


def index_pairs(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> PairIndex:
    """Align every document and write the inverted pair bitmaps, block by block."""
    folder = shared_folder(docs.sparkSession, "pair-bitmaps")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, task = tokenizers(path_a, path_b), TaskContext.get().partitionId()
        for k, (names, texts) in enumerate(_blocks(batches)):
            columns, index = _index_block(both, names, texts)
            path, block, n = _write_block(folder, columns, index), task << 32 | k, len(index.pairs)
            for c, rows in (([[block], [path], [None], [None], [None]], 1), ([np.full(n, block), [None] * n, index.pairs, index.doc_counts(), index.link_counts()], n)):
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(c, (pa.int64(), pa.string(), *[pa.int64()] * 3))], ["block", "path", "pair", "docs", "links"])

    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    written = cut_lineage(rows.mapInArrow(run, "block long, path string, pair long, docs long, links long"), "pair-counts")
    return PairIndex(written.where("path is not null").select("block", "path"), written.where("path is null").drop("path"))


def pair_counts(index: PairIndex) -> DataFrame:
    """(``id_a``, ``id_b``, ``docs``, ``links``, ``best``): of every linked id pair, in
    how many documents and how often it is linked, and whether no other id of B is
    linked with the id of A in more documents. An id of A meets at most the whole
    vocabulary of B, which bounds the window."""
    sums = index.local.groupBy("pair").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))
    ids = sums.select(F.shiftright("pair", LOW).cast("int").alias("id_a"), F.col("pair").bitwiseAND((1 << LOW) - 1).cast("int").alias("id_b"), "docs", "links")
    return ids.withColumn("best", F.col("docs") == F.max("docs").over(Window.partitionBy("id_a")))


def cross_align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``,
    ``count_sum``, ``groups_sha256``): a row per row of ``docs``, whole texts read.

    A is a tokenizers file with byte-level entries and reads blank + text, B a
    sentencepiece model that puts the blank itself. Null and empty texts, and texts
    whose tokens of A or B don't spell blank + text (such as those that hold B's marker
    character), have no tokens: zeros and an empty digest. Repeated rows and rows with
    a null id count each for themselves. Empty tables give no rows, other columns are
    not looked at."""
    index = index_pairs(docs, path_a, path_b, id_col, text_col)
    counts = pair_counts(index).select(
        (F.shiftleft(F.col("id_a").cast("long"), LOW).bitwiseOR(F.col("id_b").cast("long"))).alias("pair"), F.col("docs").alias("total"), "best"
    )
    answers = index.local.join(counts, "pair").select("block", "pair", "total", "best")
    kind = docs.schema[id_col].dataType.simpleString()

    def score(blocks: pa.Table, found: pa.Table) -> pa.Table:
        (path,) = blocks["path"].to_pylist()
        table, own = _read_block(path)
        found = found.sort_by("pair")
        if not (found["pair"].to_numpy() == own.pairs).all():
            raise ValueError(f"counts for {len(found)} of {len(own.pairs)} pairs of {path}")
        total, best = found["total"].to_numpy(), found["best"].to_numpy()
        n_best, count_sum = own.scores(best.astype(np.int64), total)
        columns = {c: table[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
        return pa.table({**columns, "n_best": n_best, "count_sum": count_sum, "groups_sha256": table["groups_sha256"]})

    return (
        index.blocks.select(F.col("block").alias("home"), "path")
        .groupBy("home")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(score, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
    )
