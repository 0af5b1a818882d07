import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wakeful.llm import alignment
from wakeful.llm.queries import op12_cross_tokenizer

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.01"
ODD = st.lists(
    st.sampled_from(["a", "The", "ing", " ", " ", "  ", "\n", "\t", "▁", "é", "ß", "日", "👍", "\x00", "12", "...", "don't", "<s>", "<|endoftext|>", "<0x41>", "\xa0", "\x1c", "\x85", "　", "Σ", "́", " ", "!?", "'s"]),
    max_size=14,
).map("".join)


@pytest.fixture(scope="module")
def both():
    return alignment.tokenizers(A, B)


def tokens_of(both, text):
    """Whole-text encodings with byte ranges, or None."""
    if not text:
        return None
    want = b" " + text.encode()
    out = []
    for ids, spelled in ((both.a.encode(" " + text, add_special_tokens=False).ids, both.bytes_a), (both.b.encode(text), both.bytes_b)):
        if b"".join(spelled[i] for i in ids) != want:
            return None
        at, ranges = 0, []
        for i in ids:
            ranges.append((i, at, at + len(spelled[i])))
            at += len(spelled[i])
        out.append(ranges)
    return out


def brute(both, texts):
    per, docs = [], defaultdict(set)
    for k, text in enumerate(texts):
        found = tokens_of(both, text)
        if found is None:
            per.append(None)
            continue
        a, b = found
        links = [(x, y) for x, s, e in a for y, t, f in b if s < f and t < e] if len(a) < 400 else sweep(a, b)
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, last = [], 0
        for end in ends:
            groups.append(",".join(str(i) for i, s, e in a if last <= s and e <= end) + "|" + ",".join(str(i) for i, s, e in b if last <= s and e <= end) if len(a) < 400 else None)
            last = end
        if len(a) >= 400:
            groups = cut(a, b, ends)
        for p in set(links):
            docs[p].add(k)
        per.append((a, b, links, groups))
    count = {p: len(d) for p, d in docs.items()}
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for f in per:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            a, b, links, groups = f
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
            out.append((len(a), len(b), len(groups), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), digest))
    return out, count, Counter(p for f in per if f for p in f[2])


def sweep(a, b):
    links, j = [], 0
    for x, s, e in a:
        while b[j][2] <= s:
            j += 1
        k = j
        while k < len(b) and b[k][1] < e:
            links.append((x, b[k][0]))
            k += 1
    return links


def cut(a, b, ends):
    out, i, j = [], 0, 0
    for end in ends:
        x, y = [], []
        while i < len(a) and a[i][2] <= end:
            x.append(str(a[i][0]))
            i += 1
        while j < len(b) and b[j][2] <= end:
            y.append(str(b[j][0]))
            j += 1
        out.append(",".join(x) + "|" + ",".join(y))
    return out


@settings(max_examples=400, deadline=None)
@given(ODD | st.text(max_size=30))
def test_chunks_are_encoded_like_whole_texts(text):
    both = alignment.tokenizers(A, B)
    found = tokens_of(both, text)
    chunks = both.chunks(text)
    (a, _, _), (b, _, _), whole = both.encode(chunks)
    if found is None:
        assert not chunks or not whole.all()
    else:
        assert whole.all() and a.tolist() == [i for i, _, _ in found[0]] and b.tolist() == [i for i, _, _ in found[1]]


def rows_of(df):
    return [(r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in df]


@pytest.mark.parametrize("small", [False, True])
def test_alignment_equals_brute_force(spark, both, edge, monkeypatch, small):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    if small:
        docs = docs.where("doc_id < 300")
        monkeypatch.setattr(alignment, "BLOCK_BYTES", 40_000)
        monkeypatch.setattr(alignment, "PART_BYTES", 9_000)
    docs = docs.unionByName(edge.select("doc_id", "text").where("doc_id is not null").selectExpr("doc_id + 1000000 AS doc_id", "text"))
    rows = docs.orderBy("doc_id").collect()
    want, count, links = brute(both, [r["text"] for r in rows])
    got = sorted(alignment.cross_align(docs, A, B).collect(), key=lambda r: r["doc_id"])
    assert sorted(zip([r["doc_id"] for r in got], rows_of(got))) == sorted(zip([r["doc_id"] for r in rows], want))
    if small:
        found = {(r["id_a"], r["id_b"]): r for r in alignment.pair_counts(alignment.index_pairs(docs, A, B)).collect()}
        assert {p: (r["docs"], r["links"]) for p, r in found.items()} == {p: (count[p], links[p]) for p in count}


def test_registered_query_on_odd_tables(spark, both, edge, none):
    got = op12_cross_tokenizer(spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    found = alignment.cross_align(edge, A, B).collect()
    assert len(found) == edge.count() and sum(r["doc_id"] is None for r in found) == 3
    by = {r["doc_id"]: r for r in found}
    for i in (103, 104, 109):  # empty, null, B's marker in the text
        assert tuple(by[i])[1:] == (0, 0, 0, 0, 0, 0, "")
    assert by[105]["n_a"] > 0 and by[106]["n_links"] > 30_000
    assert alignment.cross_align(none, A, B).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 90), st.lists(st.tuples(st.integers(0, 5), st.integers(0, 89), st.integers(1, 9)), max_size=200))
def test_bitmaps(n, rows):
    rows = sorted({(p, d % n): t for p, d, t in rows}.items())
    pair, doc, times = (np.array(x, np.int64) for x in ([p for (p, _), _ in rows], [d for (_, d), _ in rows], [t for _, t in rows]))
    whole = alignment.Postings.of(n, pair, doc, times)
    assert whole.documents().tolist() == doc.tolist() and whole.times().tolist() == times.tolist()
    assert whole.doc_counts().tolist() == [int((pair == p).sum()) for p in whole.pairs]
    assert whole.link_counts().tolist() == [int(times[pair == p].sum()) for p in whole.pairs]
    cut_at = n // 2
    parts = [alignment.Postings.of(n, pair[m], doc[m], times[m]) for m in (doc < cut_at, doc >= cut_at)]
    merged = alignment.Postings.merged(n, parts)
    for a, b in ((merged.pairs, whole.pairs), (merged.documents(), doc), (merged.times(), times), (merged.bits, whole.bits)):
        assert (a == b).all()
    scores = whole.scores(np.arange(len(whole.pairs)) + 1)[0]
    want = np.zeros(n, np.int64)
    for p, d, t in zip(pair, doc, times):
        want[d] += (1 + whole.pairs.tolist().index(p)) * t
    assert scores.tolist() == want.tolist()
