import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wakeful.llm import grammar, pieces

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.01"
ODD = st.lists(st.sampled_from(["a", "The", "ing", " ", "  ", "\n", "\t", "▁", "é", "É", "ß", "日", "👍", "\x00", "1", "...", "don't", "<s>", "<|endoftext|>", "\xa0", "\x1c", "\x85", "　", "Σ", "İ", "é", "́", " ", "!?"]), max_size=12).map("".join)


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(WORDS)


@settings(max_examples=300, deadline=None)
@given(st.lists(ODD | st.text(max_size=20), max_size=4))
def test_pieces_equal_the_library(texts):
    own = pieces.codec(PIECES)
    got = [x.tolist() for x in own.encode(pa.array(texts, pa.string()))]
    assert own.by_word and got == [own.library.encode(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(ODD | st.text(max_size=20), max_size=4))
def test_words_equal_the_library(texts):
    own = grammar.encoder(WORDS)
    got = [x.tolist() for x in own.encode(pa.array(texts, pa.string()))]
    assert got == [own.library.encode(t, add_special_tokens=False).ids for t in texts]


def test_full_tables_are_emptied():
    own = pieces.codec(PIECES)
    small = pieces.ChunkTable(own._segment, most=2)
    lists = pa.array([["a", "b", "c"], [], ["d", "a"]], pa.list_(pa.string()))
    for _ in range(3):
        ids, counts = small.join(lists)
        assert ids.tolist() == [i for w in "abcda" for i in own.library.encode(w)] and len(counts) == 3 and counts[1] == 0


def test_digests_hold_little_at_once():
    """Numbers of many texts' ids are not held together."""
    own = pieces.codec(PIECES)
    texts = pa.array([" ".join(f"word{(i * k) % 97} and" for k in range(400)) for i in range(900)], pa.string())
    list(pieces._digests(own, texts.slice(0, 100), True))  # the chunk table
    tracemalloc.start()
    rows = sum(len(c[0]) for c in pieces._digests(own, texts, True))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert texts.nbytes > 3 << 20 and rows == len(texts) and peak < 40 << 20


def test_vocabulary_whose_pieces_cross_words(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as spec

    model = spec.ModelProto()
    with open(PIECES, "rb") as f:
        model.ParseFromString(f.read())
    model.pieces.add(piece="a▁b", score=0.0)
    own = pieces.PieceCodec(model.SerializeToString())
    assert not own.by_word and [x.tolist() for x in own.encode(pa.array(["a b a b", ""]))] == [own.library.encode("a b a b"), []]


def test_round_trip_of_documents(spark, sp, edge, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(edge.select("doc_id", "text"))
    rows = sorted(pieces.round_trip(docs, PIECES, with_ids=True).collect(), key=str)
    want = []
    for r in docs.collect():
        ids = sp.encode(r["text"] or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((r["doc_id"], len(ids), digest, hashlib.sha256(sp.decode(ids).encode()).hexdigest(), ids))
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    encoded = pieces.encode_pieces(edge, PIECES)
    decoded = {r["doc_id"]: r["text"] for r in pieces.decode_pieces(encoded, PIECES).collect()}
    assert decoded[108] == "one two" and decoded[104] == "" and decoded[107].endswith(" x")
    assert pieces.round_trip(none, PIECES).count() == pieces.encode_pieces(none, PIECES).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=400), st.integers(2, 5))
def test_repair_is_lossless(ids, least):
    ids = np.array(ids, np.int64)
    g = grammar.repair(ids, least=least, rounds=6)
    assert grammar.expand(g.symbols, g.first, g.rules).tolist() == ids.tolist()
    for k, n in enumerate(g.lengths.tolist()):
        assert len(grammar.expand(np.array([g.first + k]), g.first, g.rules)) == n


def test_repair_with_wide_symbols():
    ids = np.array([70_000, 5, 70_000, 5] * 50 + list(range(80_000)), np.int64)
    g = grammar.repair(ids)
    assert len(g.symbols) < len(ids) - 90 and (grammar.expand(g.symbols, g.first, g.rules) == ids).all()


def test_random_access_in_a_segment():
    rng = random.Random(2)
    parts = [np.array(rng.choices(range(50), weights=[50] * 5 + [1] * 45, k=n), np.int32) for n in (0, 1, 5000, 300, 0, 20_000)]
    data = grammar.segment([1, None, 3, 4, 5, 6], parts)
    found = grammar.SegmentReader(pa.BufferReader(b"before" + data), 6)
    assert found.names == [1, None, 3, 4, 5, 6] and found.n_symbols < found.n_ids * 0.8
    assert all(found.document(k).tolist() == p.tolist() for k, p in enumerate(parts))
    flat = np.concatenate(parts)
    for _ in range(300):
        a, b = sorted(rng.randint(0, len(flat)) for _ in "ab")
        assert (found.ids(a, b) == flat[a:b]).all()
    with pytest.raises(ValueError):
        grammar.SegmentReader(pa.BufferReader(data[4:] + bytes(60)), 0)


@pytest.mark.parametrize("segment_ids", [1 << 20, 500])
def test_token_files(spark, words, edge, none, segment_ids, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(edge.select("doc_id", "text").where("doc_id >= 100 or doc_id is null").selectExpr("doc_id + 100000", "text"))
    monkeypatch.setattr(grammar, "SEGMENT_IDS", segment_ids)
    manifest = grammar.write_ids(docs, WORDS, end_id=2)
    rows = grammar.read_ids(manifest).collect()
    want = sorted(((r["doc_id"], words.encode(r["text"] or "", add_special_tokens=False).ids + [2]) for r in docs.collect()), key=lambda x: (x[0] is not None, x[0] or 0))
    got = sorted(((r["doc_id"], r["ids"], r["start"], r["n_tokens"]) for r in rows), key=lambda x: x[2])
    assert [g[0] for g in got] == [w[0] for w in want]
    assert sorted((str(g[0]), g[1]) for g in got) == sorted((str(w[0]), w[1]) for w in want)
    start = 0
    for _, ids, at, n in got:
        assert at == start and n == len(ids)
        start += n
    crc = {r["start"]: r["ids_crc32"] for r in grammar.read_ids(manifest, digest=True).collect()}
    assert all(crc[g[2]] == zlib.crc32(np.array(g[1], "<u4").tobytes()) for g in got)
    path = manifest.first()["path"]
    assert re.search(r"\.rpg$", path)
    empty = grammar.write_ids(none, WORDS, end_id=2)
    assert empty.count() == 0 and grammar.read_ids(empty).count() == 0
