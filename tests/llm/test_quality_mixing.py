import json
import random
import re
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from wakeful.llm import mixing, quality, queries

SF = "/root/testdata/sf0.01"


def brute_statistics(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    inside = {j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(inside)


def test_statistics_against_brute_force(spark, edge, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(edge.select("doc_id", "text"))
    more = [(9000, "a b c d e a b c d e"), (9001, "x " * 50), (9002, "l1 w\nl1 w\n\n \nl1 w \nl2"), (9003, "a b c d e f a b c d e f a b")]
    docs = docs.union(spark.createDataFrame(more, "doc_id long, text string"))
    stats = quality.statistics(docs).collect()
    texts = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=str)
    want = sorted(((d, *brute_statistics(t)) for d, t in texts), key=str)
    assert sorted(((r["doc_id"], *[r[c] for c in quality.BASE]) for r in stats), key=str) == want
    for r in stats:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
    assert quality.statistics(none).count() == 0


def test_rules_find_junk_and_keep_the_rest(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.quality(docs, labels).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k"), F.avg(F.col("base_failed").cast("int")).alias("b"))
    share = {r["quality"]: (r["k"], r["b"]) for r in found.collect()}
    assert share[0][0] < 0.05 and share[1][0] >= 1 - share[1][1] - 0.01


def test_decision_list_is_ordered(spark):
    rules = quality.DecisionList((quality.Rule((quality.Condition("n_words", True, 5.0), quality.Condition("symbol_share", False, 0.5))), quality.Rule((quality.Condition("n_words", True, 2.0),))))
    rows = spark.createDataFrame([(1.0, 0.0), (3.0, 0.0), (9.0, 0.0), (9.0, 0.9)], "n_words double, symbol_share double")
    assert [r[0] for r in rows.select(rules.rule_number()).collect()] == [None, 2, 1, 2]
    assert str(rules.rules[0]) == "n_words > 5 and symbol_share <= 0.5"


def test_covering_learns_a_conjunction(spark):
    """Bad only where two features are high together."""
    rows = [(i, i % 10, i // 10 % 10) for i in range(2000)]
    data = spark.createDataFrame(rows, "doc_id long, a long, b long").select(
        "doc_id",
        ((F.col("a") >= 6) & (F.col("b") >= 7)).cast("int").alias("bad"),
        *[(F.col("a") if f == "symbol_share" else F.col("b") if f == "word_length" else F.lit(0)).cast("double").alias(f) for f in quality.FEATURES],
        (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("held"),
    )
    rules = quality.Covering(data).learn()
    assert {c.feature for c in rules.rules[0].conditions} == {"symbol_share", "word_length"}
    wrong = data.where(rules.rule_number().isNotNull() != (F.col("bad") == 1)).count()
    assert wrong == 0


def test_quality_edge_cases(edge, none, labels):
    rows = quality.quality(edge, labels).collect()
    assert len(rows) == edge.count()
    verdict = {r["doc_id"]: r["kept"] for r in rows}
    assert not verdict[103] and not verdict[104] and not verdict[105] and verdict[0]
    assert quality.quality(none, labels).count() == 0
    kept = quality.keep_good(edge, labels.limit(0))
    assert kept.columns == edge.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert ids.count(3) == 3 and ids.count(None) == 2 and not {103, 104, 105, 108} & set(ids)
    assert quality.keep_good(none, labels).count() == 0


def brute_targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    full, total = set(), Fraction(3, 2) * sum(sizes.values())
    while True:  # share, stop those above, share the excess again
        rest = total - sum(2 * sizes[s] for s in full)
        share = sum(weight[s] for s in names if s not in full)
        target = {s: Fraction(2 * sizes[s]) if s in full else rest * weight[s] / share for s in names}
        above = {s for s in names if target[s] > 2 * sizes[s]}
        if not above:
            return target
        full |= above


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10, None: 10}, {"a": 1, "b": 1000, "c": 5}, {"x": 7}, {"a": 0, "b": 9, "c": 0}, {str(i): (i * 37) % 101 + 1 for i in range(25)}])
def test_targets(sizes):
    got, want = mixing.weighted_quotas(sizes), brute_targets(sizes)
    assert all(abs(got[s] - float(want[s])) < 1e-6 for s in sizes)
    assert abs(sum(got.values()) - 1.5 * sum(sizes.values())) < 1e-6


def test_flow_of_overlapping_sources():
    tokens = {"a": 100, "ab": 100, "b": 10}
    members = {"a": ["a"], "ab": ["a", "b"], "b": ["b"]}
    took = mixing.route(tokens, members, {"a": 100, "b": 110})
    assert took == {"a": 100, "ab": 100, "b": 10}  # nothing twice: the shared pattern goes to b
    took = mixing.route(tokens, members, {"a": 250, "b": 110})
    assert sum(took.values()) == 360 and max(took[p] / tokens[p] for p in tokens) <= 2
    took = mixing.route({"a": 10, "ab": 10}, {"a": ["a"], "ab": ["a", "b"]}, {"a": 15, "b": 0})
    assert took["a"] + took["ab"] == 15 and max(took.values()) <= 10  # fresh tokens before copies
    assert mixing.route({"a": 10}, {"a": ["a"]}, {"a": 1000}) == {"a": 20}
    assert mixing.route({}, {}, {}) == {}


def test_mix_edge_cases(edge, none):
    taken = mixing.mix(edge, F.array("source"))
    rows = mixing.per_source(taken).collect()
    assert len(rows) == edge.count() and all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    again = mixing.per_source(mixing.mix(edge.repartition(5), F.array("source"))).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    for source, target in taken.targets.items():
        got = sum(r["taken"] for r in rows if r["source_size"] == taken.sizes[source] and r["target"] == target)
        assert abs(got - target) <= max(2, 0.02 * target)
    out = mixing.apply_mix(edge, taken, F.array("source"))
    assert out.columns == edge.columns
    assert out.count() == sum(r["copies"] for r in taken.rows.collect())
    empty = mixing.mix(none, F.array("source"))
    assert empty.rows.count() == 0 and mixing.apply_mix(none, empty, F.array("source")).count() == 0


def test_mix_of_overlapping_sources(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 9), ["a", "b"] if i % 3 == 0 else ["a"] if i % 3 == 1 else None) for i in range(300)], "doc_id long, text string, s array<string>")
    taken = mixing.mix(docs, F.col("s"), quotas=lambda sizes: {s: n / 2 for s, n in sizes.items()})
    rows = taken.rows.collect()
    assert {r["copies"] for r in rows if r["pattern"] == "[]"} == {0}
    total = sum(r["size"] * r["copies"] for r in rows)
    assert abs(total - sum(taken.targets.values())) <= 12


def brute_ending(groups, rest):
    """Taken hashes by the rule of ``mix``, one document after the other."""
    taken, left = set(), rest
    for u, size in groups:
        if size <= left and (size or taken == {v for v, _ in groups if v < u}):  # of no size: up to the first that doesn't fit
            taken.add(u)
            left -= size
    near = min(((abs(left - s), s, u) for u, s in groups if u not in taken and 0 < s < 2 * left), default=None)
    return (taken | {near[2]}, left - near[1]) if near else (taken, left)


def test_mix_with_long_documents(spark):
    plans = {f"{long}-{k}": [100] * 200 + [long] for long in (10_000, 20_000, 40_000) for k in range(8)}
    plans |= {f"falling-{k}": [2000 - 3 * i for i in range(400)] + [40_000] for k in range(4)}  # sizes close to what is open
    plans |= {f"tail-{k}": [1 + (7919 * (i + k)) % 97 * 10 ** (i % 4) for i in range(60)] for k in range(8)}
    table = [(s, i // 2 if s.startswith("tail") and i < 6 else i, n) for s, sizes in plans.items() for i, n in enumerate(sizes)]
    docs = spark.createDataFrame([(f"{s}:{i}", s, n) for s, i, n in table], "doc_id string, source string, n long")
    taken = mixing.mix(docs, F.array("source"), quotas=lambda sizes: {s: 1.5 * n for s, n in sizes.items()}, size=F.col("n"))
    by_source = {}
    for r in taken.rows.collect():
        by_source.setdefault(json.loads(r["pattern"])[0], []).append(r)
    assert set(by_source) == set(plans)
    for source, rows in by_source.items():
        total, quota = taken.sizes[source], int(taken.targets[source] + 0.5)
        groups = Counter()
        for r in rows:
            groups[r["u"]] += r["size"]
        want, left = brute_ending(sorted(groups.items()), quota - total)
        assert {r["u"] for r in rows if r["copies"] == 2} == want and {r["copies"] for r in rows} <= {1, 2}
        assert sum(r["size"] * r["copies"] for r in rows) == quota - left
        untaken = [s for u, s in groups.items() if u not in want]
        assert left <= 0 or not any(0 < s <= left for s in untaken)  # nothing that fits is left
        if source[0].isdigit():
            long = max(plans[source])
            best = min(abs(quota - total - 100 * k - long * j) for k in range(201) for j in (0, 1))
            assert abs(left) <= best + 0.01 * quota


def test_mix_equals_its_sql_on_long_documents(spark, tmp_path):
    """Sources that hold a document of a third or two of their words, null and repeated ids."""
    import duckdb

    rng = random.Random(4)
    rows = []
    for k in range(9):
        sizes = [rng.choice([1, 30, 100, 100, 170]) for _ in range(60)] + [[2500, 5000, 9000][k % 3]]
        rows += [(None if i == 7 else 1000 * k + i // 2 if i < 6 else 1000 * k + i, None if k == 8 else f"s{k}", "w " * n) for i, n in enumerate(sizes)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op2_source_mixing(spark, str(tmp_path)).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(mixing.ORACLE).fetchall()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
