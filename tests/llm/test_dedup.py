import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wakeful.llm import exact, simhash
from wakeful.llm.components import connected_components

SF = "/root/testdata/sf0.01"


def brute_simhash(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(fps, bits):
    label = list(range(len(fps)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return [find(i) for i in range(len(fps))]


def test_fingerprints_against_brute_force(edge):
    texts = {(r["doc_id"], r["text"]) for r in edge.select("doc_id", "text").collect()}
    texts = {(d, t) for d, t in texts if t is None or len(t) < 10_000}
    for d, t in texts:
        assert simhash.simhash((t or "").encode()) == brute_simhash(t)
    assert simhash.simhash(b"") == simhash.simhash(b" \n\t") == 0


def test_near_duplicates_of_documents_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted(map(tuple, simhash.near_duplicates(docs).collect()))
    fps = [brute_simhash(r["text"]) for r in sorted(docs.select("doc_id", "text").collect())]
    assert [g[1] & (1 << 64) - 1 for g in got] == fps
    roots = brute_components(fps, 2)
    assert [g[2] for g in got] == [got[r][0] for r in roots]


def test_near_duplicates_edge_cases(edge, none):
    rows = simhash.near_duplicates(edge).collect()
    assert len(rows) == edge.count()
    of = {}
    for r in rows:
        of.setdefault(r["fp"], set()).add(r["component_id"])
    assert all(len(c) == 1 for c in of.values())
    empty = {r["doc_id"]: (r["fp"], r["component_id"]) for r in rows if r["doc_id"] in (103, 104, 105)}
    assert set(empty.values()) == {(0, 103)}  # no words: linked like others
    assert simhash.near_duplicates(none).collect() == []
    kept = simhash.one_per_group(edge)
    assert kept.columns == edge.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert 0 in ids and 100 not in ids and 102 not in ids and ids.count(3) == 1
    assert ids.count(None) == 1  # the others are near a named row
    assert simhash.one_per_group(none).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_tree_loses_no_link(spark, seed):
    """Clustered fingerprints, leaves far smaller than the clusters."""
    rng = random.Random(seed)
    fps = set()
    for _ in range(60):
        centre = rng.getrandbits(64)
        for _ in range(40):
            centre ^= 1 << rng.randrange(64)  # a chain of near copies
            fps.add(centre)
    fps = sorted(fps)
    table = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    edges = simhash.near_links(table, 2, leaf_rows=64, max_sample=256)
    found = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    got = [found.get(f, f) for f in [x - (1 << 64) if x >> 63 else x for x in fps]]
    want = brute_components(fps, 2)
    groups = {}
    for g, w in zip(got, want):
        groups.setdefault(w, set()).add(g)
    assert all(len(v) == 1 for v in groups.values()) and len(set(got)) == len(set(want))


def test_leaf_search_with_blocks_only():
    """All fingerprints so close that no vantage point parts them."""
    fps = np.array(sorted({(1 << a) | (1 << b) for a in range(64) for b in range(a)}), np.uint64)
    assert set(simhash.leaf_components(fps, 2)) == {0}
    assert simhash.leaf_components(np.array([], np.uint64), 2).tolist() == []


def test_components_of_a_long_path(spark):
    n = 200
    order = list(range(n))
    random.Random(1).shuffle(order)
    edges = [(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (7, 7), (None, 4)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, n)}, 1001: 1000}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_exact(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(d)
    out = []
    for norm, ids in groups.items():
        named = [i for i in ids if i is not None]
        keep = min(named) if named else None
        for d in ids:
            out.append((d, keep, len(ids), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hash_of", [exact.content_hash, lambda t: F.substring(F.md5(t), 1, 1)], ids=["md5", "colliding"])
def test_exact_groups_edge_cases(edge, none, hash_of):
    rows = exact.exact_groups(edge, hash_of=hash_of).collect()
    got = sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows), key=str)
    assert got == brute_exact([tuple(r) for r in edge.select("doc_id", "text").collect()])
    kept = {}
    for r in rows:
        kept.setdefault(r["text_sha256"], []).append(r["kept"])
    assert all(sum(v) == 1 for v in kept.values())  # also of repeated rows and null ids
    assert exact.exact_groups(none, hash_of=hash_of).collect() == []


def test_exact_dedup_keeps_columns_and_first_rows(edge, none):
    kept = exact.exact_dedup(edge)
    assert kept.columns == edge.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert ids.count(3) == 1 and not {100, 101, 104} & set(ids) and {0, 102, 103, 105, 106, 107} <= set(ids)
    assert ids.count(None) == 1  # the null ids whose texts no named row has
    assert exact.exact_dedup(none).count() == 0


def brute_survivors(rows, group_of):
    """(id, text) of the one row that stays of each group."""
    groups = {}
    for d, t in rows:
        groups.setdefault(group_of[t], []).append((d is None, d or 0, hashlib.sha256((t or "").encode()).hexdigest(), d, t or ""))
    return sorted(((m[3], m[4]) for m in (min(g, key=lambda m: m[:3]) for g in groups.values())), key=str)


def test_stages_keep_one_row_of_each_group(spark):
    """Repeated and null ids, of equal and of different texts."""
    rng = random.Random(2)
    base = [" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(400)) for _ in range(6)]
    texts = ["a b c", "a  b c", "a\tb c", "other words", None, "", *base, base[0] + "  ", *(" ".join(b.split()[:-1]) for b in base)]
    rows = [(3, "a b c"), (3, "a  b c"), (7, "a b c"), *[(None, t) for t in ("x y", "x  y", "x y")], (3, base[0]), (7, " ".join(base[0].split()[:-1])), (7, "other")]
    rows += [(rng.choice([None, 1, 2, 3, 5, 8]), rng.choice(texts)) for _ in range(150)]
    docs = spark.createDataFrame([(d, t, {str(i): t or ""}) for i, (d, t) in enumerate(rows)], "doc_id long, text string, row_key map<string,string>").repartition(7)
    norm = {t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows}
    kept = exact.exact_dedup(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    # equal ids and texts that differ in white space only are ties: any of them may stay
    assert sorted(((r["doc_id"], norm[r["text"]]) for r in got), key=str) == brute_survivors([(d, norm[t]) for d, t in rows], {n: n for n in norm.values()})
    assert all(list(r["row_key"].values()) == [r["text"] or ""] for r in got)  # whole rows
    distinct = sorted(norm, key=str)
    group = dict(zip(distinct, brute_components([brute_simhash(t) for t in distinct], 2)))
    near = simhash.one_per_group(docs)
    assert near.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"] or "") for r in near.collect()), key=str) == brute_survivors(rows, group)
    assert len(set(group.values())) < len(set(norm.values()))  # some are near and not equal
