"""SentencePiece encoding and decoding over tables of distinct chunks.

No piece of the vocabulary has a white-space marker behind another character, so no
merge crosses from a word to the marker that follows it: a text is a sequence of
marked words (a run of markers and the characters up to the next one), and the ids of
the text are those of its marked words in order. Each distinct marked word of a task
is segmented once, in a chunk table, and ids are joined back by position. A
vocabulary for which this doesn't hold is noticed when it is loaded; its texts are
segmented whole.

The table's scope is a task: one table for the whole corpus needs every (block,
word) pair shuffled there and back, several times the input, to save work that a
task's own table has already saved but for words it shares with other tasks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeful.llm.chunks import ChunkTable, cut, portions
from wakeful.llm.common import text_of

MARK = "▁"
PORTION = 1 << 19  # bytes of text whose ids are Python numbers at once: some 60 bytes for each byte of text
RUNS = re.compile(r" *[^ ]+| +\Z")


class PieceCodec:
    """A loaded model with the chunk table of this process."""

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as spec

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        parsed = spec.ModelProto()
        parsed.ParseFromString(model)
        rule, trainer = parsed.normalizer_spec, parsed.trainer_spec
        self.by_word = (
            rule.name == "identity"
            and not rule.precompiled_charsmap
            and rule.add_dummy_prefix
            and rule.escape_whitespaces
            and not rule.remove_extra_whitespaces
            and not trainer.treat_whitespace_as_suffix
            and trainer.model_type in (trainer.BPE, trainer.UNIGRAM)
            and any(p.piece == MARK for p in parsed.pieces)
            and not any(re.search(f"[^{MARK}]{MARK}", p.piece) for p in parsed.pieces)
            and not any(p.type == spec.ModelProto.SentencePiece.USER_DEFINED for p in parsed.pieces)
        )
        self.table = ChunkTable(self._segment)

    def _segment(self, words: list[str]) -> list[list[int]]:
        lone = [self.library.piece_to_id(MARK)]  # a single marker at the end of a text
        return [ids if w else lone for w, ids in zip(words, self.library.encode(words, num_threads=1))]

    def chunks(self, text: str) -> list[str]:
        """Marked words of the text, each without its first marker (the library puts
        one before whatever it encodes); an empty text has none."""
        if not text:
            return []
        if not self.by_word or MARK in text:  # a text that holds the marker itself goes whole
            return [text]
        return [run[1:] for run in RUNS.findall(" " + text)]

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        for part in portions(texts):
            # single blanks between words are cut by Arrow, other texts one by one
            plain = pc.invert(pc.match_substring_regex(part, f"^$|^ |  | $|{MARK}")) if self.by_word else pa.array([False] * len(part))
            odd = pa.array([self.chunks(t) for t in part.filter(pc.invert(plain)).to_pylist()], pa.list_(pa.string()))
            lists = pa.concat_arrays([pc.split_pattern(part.filter(plain), " "), odd])
            found = list(cut(*self.table.join(lists)))
            mask = plain.to_numpy(zero_copy_only=False)
            order = np.argsort(np.concatenate((np.flatnonzero(mask), np.flatnonzero(~mask))), kind="stable")
            for k in order.tolist():
                yield found[k]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids)


@lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    """The model at ``path``, loaded once per process; the file is part of every
    machine's installation."""
    with open(path, "rb") as f:
        return PieceCodec(f.read())


def encode_pieces(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``doc_id``, ``ids``): the ids of each row's whole text as the library encodes
    it, without begin or end ids and without sampling. Null and empty texts have no
    ids. A row per row, repeated ones and those with a null id included; other columns
    are not looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            ids = pa.array(list(own.encode(batch.column(1))), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, ids array<int>"
    )


def decode_pieces(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(``doc_id``, ``text``): the library's decoding of each row's ids (null ids as
    none: an empty text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            texts = pa.array(own.decode([list(x or ()) for x in batch.column(1).to_pylist()]), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["doc_id", "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"doc_id {kind}, text string")


def _digests(own: PieceCodec, texts: pa.Array, with_ids: bool) -> Iterator[list[pa.Array]]:
    """Columns of :func:`round_trip` but the first, a portion of the texts at a time."""
    for part in portions(texts, PORTION):
        listed = [ids.tolist() for ids in own.encode(part)]
        yield [
            pa.array(list(map(len, listed)), pa.int64()),
            pa.array([hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() for ids in listed], pa.string()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in own.decode(listed)], pa.string()),
            *[pa.array(listed, pa.list_(pa.int32()))] * with_ids,
        ]


def round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``): digests of the
    ids (decimal, joined by commas) and of their decoding, made where the ids are, so
    that only digests leave a task; ``with_ids`` adds the ``ids`` themselves."""
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            at = 0
            for columns in _digests(own, batch.column(1), with_ids):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(columns[0])), *columns], names)
                at += len(columns[0])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    )
