import hashlib
import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wakeful.llm import pii
from wakeful.llm.queries import op13_private_data

SF = "/root/testdata/sf0.01"
PLAIN = {  # the contract's patterns as they stand
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def checked(kind, span):
    digits = [int(c) for c in re.sub("[^0-9]", "", span)]
    if kind == "ip":
        return all(int(p) <= 255 for p in span.split("."))
    if kind == "card":
        doubled = [d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if checked(k, m[0])]


def named(spans):
    return [(pii.KINDS[k], s, e) for k, s, e in spans]


BITS = st.lists(st.sampled_from(["a", "b.c", "@", "@x.y", ".", "-", " ", "(", ")", "+1", "+", "4111111111111111", "12", "255", "256", "1.2.3.4", "0", "555-1234", "%", "é", "\n", "007"]), max_size=16).map("".join)


@settings(max_examples=600, deadline=None)
@given(BITS | st.text(alphabet="0123456789+.-@ a()", max_size=40))
def test_base_spans_equal_the_plain_patterns(text):
    assert named(pii.base_spans(text)[0]) == brute(text)


def test_base_spans_read_long_runs_once():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" + "(" * 200_000, "a@" * 100_000, "1 " * 100_000):
        pii._scan(text)


def one_field(seed=0):
    rng = np.random.default_rng(seed)
    return pii.Field({"*": 0}, rng.normal(size=(1, pii.N)), rng.normal(size=(pii.N, pii.N)), np.abs(rng.normal(size=5)))


def exact(unary, chain, skip, field):
    """Marginals by summing over all labellings."""
    n, total = len(unary), np.zeros((len(unary), pii.N))
    for y in itertools.product(range(pii.N), repeat=n):
        v = sum(unary[i, y[i]] for i in range(n)) + sum(field.chain[y[a], y[b]] for a, b in chain)
        v += sum(field.skip[pii.TYPE[y[a]]] for a, b in skip if pii.TYPE[y[a]] == pii.TYPE[y[b]])
        for i in range(n):
            total[i, y[i]] += np.exp(v)
    return total / total.sum(axis=1, keepdims=True)


def test_messages_give_exact_marginals_on_trees():
    field, unary = one_field(), np.random.default_rng(1).normal(size=(4, pii.N))
    none = np.empty((0, 2), np.int64)
    for chain, skip in ((np.array([[0, 1], [1, 2]]), none), (np.array([[0, 1]]), np.array([[1, 3], [0, 2]])), (none, none)):
        assert np.allclose(pii.marginals(unary, chain, skip, field), exact(unary, chain.tolist(), skip.tolist(), field), atol=1e-8)


def test_loopy_messages_come_near_on_a_cycle():
    field, unary = one_field(2), np.random.default_rng(3).normal(size=(4, pii.N))
    field.chain *= 0.5
    chain, skip = np.array([[0, 1], [2, 3]]), np.array([[0, 2], [1, 3]])
    got, want = pii.marginals(unary, chain, skip, field), exact(unary, chain.tolist(), skip.tolist(), field)
    assert np.abs(got - want).max() < 0.05


def test_fitted_chain_is_a_maximum():
    windows = [([["*", "x"], ["*", "y"]], [1, 2], 5), ([["*", "x"]], [1], 3), ([["*", "y"]], [0], 4), ([["*"], ["*", "x"], ["*"]], [0, 1, 0], 2)]
    vocabulary, token, chain = pii.fit_chain(windows)

    def value(token, chain):
        out = -pii.PRIOR / 2 * ((token**2).sum() + (chain**2).sum())
        for seen, y, n in windows:
            u = [sum(token[vocabulary[f]] for f in x) for x in seen]

            def score(z):
                return sum(u[i][z[i]] for i in range(len(z))) + sum(chain[a, b] for a, b in zip(z, z[1:]))

            out += n * (score(y) - np.log(sum(np.exp(score(z)) for z in itertools.product(range(pii.N), repeat=len(y)))))
        return out

    best, rng = value(token, chain), np.random.default_rng(0)
    for _ in range(20):
        assert value(token + rng.normal(size=token.shape) * 0.05, chain + rng.normal(size=chain.shape) * 0.05) < best + 1e-3


def test_skip_edges():
    words = ["4111-1111-1111-1111", "4111111111111111", "4111111111111112", "ab.1@x.y", "AB.1@z.de", "(555)", "12", "12"]
    edges = pii.skip_edges(words, np.zeros(8, np.int64)).tolist()
    assert edges == [[0, 1], [1, 2], [3, 4]]  # one digit differs in one half only; short numbers aren't linked
    assert pii.skip_edges(["12345", "12345"], np.array([0, 1])).tolist() == []


@pytest.fixture(scope="module")
def field(spark):
    return pii.train(pii.scan(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id", "text"))


def spans_of(field, text):
    row = dict(zip([c.split()[0] for c in pii.SCANNED.split(", ")], pii._scan(text)))
    (more,) = pii.added_spans(field, [row])
    return [(pii.KINDS[k], text[s:e]) for k, s, e in sorted(more)]


def test_added_spans(field):
    card, other = "4111111111111111", "4524132264652876"
    text = f"well +1 (269) 555-3296 {other}, {card} 27.65.93.188 x"
    assert brute(text) == [("ip", text.index("27.65"), text.index(" x"))]
    assert spans_of(field, text) == [("card", other), ("card", card), ("phone", "+1 (269) 555-3296")]
    # repeats without what the patterns ask for, far from the plain mention
    far = "lorem ipsum " * 400
    assert spans_of(field, f"call +1 (988) 555-2485 now. {far} again (988) 555-2485 today") == [("phone", "(988) 555-2485")]
    assert spans_of(field, f"card {card} ok. {far} card 4111111111111112 again") == [("card", "4111111111111112")]
    assert spans_of(field, f"to ab.42@mail8.example.com {far} or ab.42@mail8 again") == [("email", "ab.42@mail8")]


def test_clean_texts_stay_clean(field):
    for text in ("in 1999 and 2024-01-01 at 10:30, 3.14 of 1,000,000 (p. 12) v1.2.3 no. 123456789", "4111111111111112 and 4524132264652877", "1. one\n2. two\n1. one\n10. ten", "user@host and (988) 555-2485", ""):
        assert spans_of(field, text) == []


def test_field_finds_the_kinds_by_itself(spark, field):
    """Base labels taken away: documents that training has not seen."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id >= 5000")
    rows = [r.asDict() for r in pii.scan(docs, "doc_id", "text").where("size(t_word) > 0").collect()]
    words, truth = [w for r in rows for w in r["t_word"]], np.array([x for r in rows for x in r["t_label"]])
    joined = np.array([x for r in rows for x in r["t_joined"]])
    p = pii.marginals(field.unary(words), pii._joins(joined), np.empty((0, 2), np.int64), field)
    known = truth >= 0
    right = pii.TYPE[p.argmax(axis=1)] == np.where(truth > 0, pii.TYPE[truth], 0)
    assert known.sum() > 500 and right[known].mean() > 0.98


def test_registered_query(spark):
    rows = op13_private_data(spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        base = brute(texts[r["doc_id"]])
        listed = [f"{k}:{s}:{e}" for k, s, e in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert tuple(r[f"n_{k}"] for k in pii.KINDS) == tuple(sum(b[0] == k for b in base) for k in pii.KINDS)
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(listed) <= set(spans) and spans == sorted(spans, key=lambda x: (pii.KINDS.index(x.split(":")[0]), int(x.split(":")[1])))
        if not listed:
            assert len(spans) <= 2
    assert sum(r["n_card"] for r in rows) > 10


def test_odd_tables(spark, edge, none):
    rows = pii.find_private(edge).collect()
    assert len(rows) == edge.count() and sum(r["doc_id"] is None for r in rows) == 3
    assert all(r["spans"] == "" and r["base_sha256"] == hashlib.sha256(b"").hexdigest() for r in rows)
    assert pii.find_private(none).count() == 0
