import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wakeful.llm import exact, language, mixing, quality, queries, simhash, toxicity
from wakeful.llm.common import cut_lineage, table

SF = "/root/testdata/sf0.01"
LANGUAGES = ["de", "en", "es", "fr"]
KEYS = ["q", "q0", "said", "count", "prior", "posterior", "domain", "suffix", "domain_share", "suffix_ll", "said_ll", "known_host", "_host"]


# -- language ---------------------------------------------------------------------


def test_page_evidence(spark):
    rows = [
        ("https://user@WWW.Example.co.de:80/a?b", '<!doctype html><HTML class="x" LANG=\'de-AT\'><script>if (a < b) "x"</script><p>Wort &amp; mehr<!-- <b>no</b> -->'),
        ("no url", "<html><style>p{}</style>"),
        (None, None),
    ]
    got = spark.createDataFrame(rows, "url string, html string").select(
        language.host_of(F.col("url")).alias("host"), language.declared_in(F.col("html")).alias("said"), F.trim(F.regexp_replace(language.visible_text(F.coalesce("html", F.lit(""))), " +", " ")).alias("text")
    ).withColumns({"domain": language.domain_of(F.col("host")), "suffix": language.suffix_of(F.col("host"))}).collect()
    assert tuple(got[0]) == ("www.example.co.de", "de", "Wort &amp; mehr", "co.de", "de")
    assert tuple(got[1]) == (None, None, "", None, None) and got[2]["host"] is None


def test_text_scores_against_brute_force():
    model = {"": np.zeros(2), " th": np.array([-1.0, -3.0]), "the": np.array([-1.0, -2.0]), "he ": np.array([-0.5, -2.0])}
    sums, sizes = language.TextScorer(model, 2).score(["The the!", "", "12 34", "other"])
    assert sizes.tolist() == [2, 0, 0, 1]
    assert sums.tolist() == [[-5.0, -14.0], [0, 0], [0, 0], [-1.0, -2.0]]


def test_fusion_against_brute_force(spark):
    """Short texts, so that the host, the suffix and the markup decide."""
    rng = random.Random(3)
    rows = []
    for i in range(400):
        host = rng.choice(["a.x.de", "b.x.de", "c.y.fr", "d.z.com", None])
        declared = rng.choice(["de", "fr", "xx", None])
        words = rng.choice([0, 1, 2])
        rows.append((i, host, declared, [round(-rng.random() * 3, 3) if words else 0.0, round(-rng.random() * 3, 3) if words else 0.0], words))
    got = {r["id"]: r for r in language.fuse(spark.createDataFrame(rows, "id long, host string, declared string, ll array<double>, n_words long"), ["de", "fr"]).collect()}

    def shares(x):
        e = np.exp(np.array(x) - max(x))
        return e / e.sum()

    q = {i: shares(ll) if n else np.zeros(2) for i, _, _, ll, n in rows}
    total = sum(q.values())
    world = (total + 1) / (total.sum() + 2)
    by = {}
    for key in ("host", "domain", "suffix", "said"):
        by[key] = {}
    for i, h, d, _, _ in rows:
        if h:
            for key, v in (("host", h), ("domain", ".".join(h.split(".")[-2:])), ("suffix", h.split(".")[-1])):
                by[key][v] = by[key].get(v, 0) + q[i]
        if d:
            name = d if d in ("de", "fr") else "other"
            by["said"][name] = by["said"].get(name, 0) + q[i]
    hosts, said = sum(by["host"].values()), sum(by["said"].values())
    for i, h, d, ll, n in rows:
        prior, extra = world, np.zeros(2)
        if h:
            c = by["domain"][".".join(h.split(".")[-2:])]
            domain = (c + 10 * world) / (c.sum() + 10)
            own = np.maximum(by["host"][h] - q[i], 0)
            prior = (own + 10 * domain) / (own.sum() + 10)
            extra = np.log((by["suffix"][h.split(".")[-1]] + world) / (hosts + 1))
        if d:
            extra = extra + np.log((by["said"][d if d in ("de", "fr") else "other"] + 1) / (said + len(by["said"]) + 1))
        p = shares(np.array(ll) + np.log(prior) + extra)
        assert abs(got[i]["confidence"] - p.max()) < 1e-9
        assert got[i]["lang_found"] == ["de", "fr"][int(p.argmax())] or abs(p[0] - p[1]) < 1e-9


def test_languages_of_held_out_documents(spark):
    docs = table(spark, SF, "documents")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    rows = docs.where(held).select("doc_id", "lang", "text", F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("declared"))
    found = language.identify(rows, docs.where(~held), LANGUAGES)
    right = found.agg(F.avg((F.col("lang") == F.col("text_lang")).cast("int"))).first()[0]
    assert right > 0.98


def test_language_edge_cases(spark, edge, none):
    cast = lambda d: d.select("doc_id", "text", F.col("source").alias("host"), F.lit(None).cast("string").alias("declared"), "rank", "size", *[F.col("doc_id").alias(c) for c in KEYS])
    found = language.identify(cast(edge), edge, LANGUAGES).collect()
    assert len(found) == edge.count() and all(r[c] == r["doc_id"] for r in found for c in KEYS)
    assert all(r["lang_found"] in LANGUAGES and 0 < r["confidence"] <= 1 for r in found)
    assert {r["text_lang"] for r in found if r["n_words"] == 0} == {None}
    assert language.identify(cast(none), edge, LANGUAGES).count() == 0
    assert len(language.identify(cast(edge), none, LANGUAGES).collect()) == edge.count()


# -- toxicity ---------------------------------------------------------------------


def test_tokens():
    assert toxicity.tokens("Clownish!!") == ["clownish", "clow*", "clown*", "!!"]
    assert toxicity.tokens("clown") == ["clown", "clow*"] and toxicity.tokens("12") == []
    own = toxicity.Tokens({"clow*": 0, "!!": 1, "idiot": 2})
    got = [x.tolist() for x in own.of(pa.array(["a clown! CLOWNS !! clown", "", "idiot", "x"]))]
    assert got == [[0, 1], [], [2], []]


def test_logistic_fit_reaches_the_optimum():
    rng = np.random.default_rng(1)
    n, width = 400, 30
    rows = [np.flatnonzero(rng.random(width) < 0.2) for _ in range(n)]
    true = rng.normal(size=width)
    extra = rng.random((n, 1))
    y = np.array([rng.random() < 1 / (1 + np.exp(-(true[r].sum() + 2 * e[0] - 1))) for r, e in zip(rows, extra)], float)
    indptr = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
    w = toxicity.fit_logistic(indptr, np.concatenate(rows), extra, y, width)

    def slope(w):
        m = np.array([w[r].sum() for r in rows]) + extra[:, 0] * w[width] + w[-1]
        off = 1 / (1 + np.exp(-m)) - y
        g = np.zeros(width + 2)
        for r, o in zip(rows, off):
            g[r] += o
        g[width], g[-1] = extra[:, 0] @ off, off.sum()
        g[:-1] += toxicity.PENALTY * w[:-1]
        return np.abs(g).max()

    assert slope(w) < 0.1 * slope(np.zeros_like(w))


def test_chain_on_held_out_folds(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    labels = labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    chain = toxicity.train_chain(docs, labels, ["low_quality", "toxic"])
    assert len(chain.weights[1]) == len(chain.weights[0]) + 1  # the earlier probability is an input
    seen = Counter(map(tuple, chain.held_out.select("toxic", F.col("p_toxic") >= 0.5).collect()))
    assert seen[1, True] > 0.8 * (seen[1, True] + seen[1, False])
    assert seen[0, True] < 0.005 * (seen[0, True] + seen[0, False])
    planted = spark.createDataFrame([(1, "x " * 20_000 + "you worthless idiot, you clown"), (2, "nothing of the kind in here"), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["p_toxic"] for r in toxicity.classify(planted, chain).collect()}
    assert got[1] > 0.5 > got[2] and got[3] < 0.5


def test_chain_edge_cases(edge, none, labels):
    marks = labels.select("doc_id", F.col("quality").alias("low"), "toxic")
    chain = toxicity.train_chain(edge, marks, ["low", "toxic"])
    assert {r["doc_id"] for r in chain.held_out.collect()} == {0, 1, 3}
    rows = toxicity.classify(edge, chain).collect()
    assert len(rows) == edge.count() and all(0 <= r["p_toxic"] <= 1 for r in rows)
    assert toxicity.classify(none, chain).count() == 0
    untrained = toxicity.train_chain(edge, marks.limit(0), ["low", "toxic"])
    assert max(r["p_toxic"] for r in toxicity.classify(edge, untrained).collect()) < 1e-6
    assert toxicity.classify(edge, toxicity.train_chain(none, marks, ["low", "toxic"])).count() == edge.count()


# -- the pipeline -----------------------------------------------------------------


def test_pipeline_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "simhash_near_dedup", "source_mixing", "sentencepiece"]
    docs = table(spark, SF, "documents")
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(cut_lineage(stage(spark, steps[-1], SF), f"test-{name}"))
    assert all(s.columns == docs.columns for s in steps[:-1])
    ids = [[r["doc_id"] for r in s.select("doc_id").collect()] for s in steps]
    verdict = quality.quality(docs, table(spark, SF, "labels"))
    assert sorted(ids[1]) == sorted(r["doc_id"] for r in verdict.where("kept").collect())
    assert sorted(ids[2]) == sorted({r["keep_id"] for r in exact.exact_groups(steps[1]).collect()})
    assert sorted(ids[3]) == sorted({r["component_id"] for r in simhash.near_duplicates(steps[2]).collect()})
    taken = Counter({r["doc_id"]: r["copies"] for r in mixing.mix(steps[3], F.array("source")).rows.collect()})
    assert Counter(ids[4]) == +taken and sorted(ids[5]) == sorted(ids[4])
    last = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, last.collect())) == sorted(map(str, steps[-1].collect()))
    assert corpus_pipeline.ORACLE_SQL is None


def test_pipeline_on_empty_and_odd_documents(spark, edge, none):
    for docs in (edge, none):
        for name, stage in corpus_pipeline.STAGES:
            docs = cut_lineage(stage(spark, docs, SF), f"test-{name}")
        docs.count()


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_queries_cover_their_tables(spark, name):
    got = queries.QUERIES[name](spark, SF)
    want = {"op4_warc_packages": 250, "op5_language_id": 1250, "op11_hard_negatives": 150}.get(name, 1000)
    assert got.count() == want
