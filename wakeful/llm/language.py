"""Language identification by Bayesian evidence fusion.

For every document the posterior over the languages is the product of
  * the likelihood of its text under a naive Bayes model of character trigrams,
  * the likelihood of the language that its markup declares,
  * the likelihood of its address suffix (last label of the host name),
  * the prior of its host, smoothed towards its domain and that towards all hosts.
The last three are learned from all documents by grouped aggregation of the text
model's posteriors: soft counts per host, domain, suffix and declared language. A
document's own count is taken out of its host's before it serves as the document's
prior. Sums are aggregates with map-side combine; a host that holds a third of the
rows is one row per task before the shuffle.
"""

from __future__ import annotations

import html as markup
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeful.llm.chunks import portions
from wakeful.llm.common import cut_lineage, free_name, let, text_of

SAMPLE_ROWS = 20_000  # labelled texts that the trigram model is fitted on, at most about
TRIGRAMS = 50_000
KNOWN_WORDS = 1 << 18
SMOOTHING = 10.0  # documents that a level's parent counts for
EVIDENCE_SHARE = 1 / 3  # trigrams overlap: a letter is counted once, not three times
WORD = re.compile(r"[^\W\d_]+")


# -- evidence of pages ------------------------------------------------------------


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)
    return F.when(found != "", found)


def domain_of(host: Column) -> Column:
    """The last two labels."""
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def declared_in(page: Column) -> Column:
    found = F.lower(F.regexp_extract(page, r"(?i)<html[^>]*?\slang\s*=\s*[\"']?([a-z]{2,3})", 1))
    return F.when(found != "", found)


def visible_text(page: Column) -> Column:
    """Text between tags, without scripts, styles and comments."""
    return F.regexp_replace(page, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")


# -- the text model ---------------------------------------------------------------


def _trigrams(word: str) -> list[str]:
    marked = f" {word} "
    return [marked[i : i + 3] for i in range(len(marked) - 2)]


def fit_trigrams(texts: DataFrame, languages: list[str]) -> dict[str, np.ndarray]:
    """Log-likelihoods of the most frequent trigrams per language, from ``text`` and
    ``lang`` rows: additive smoothing, what is left out shares one entry (``""``)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, Counter] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.setdefault(lang, Counter()).update(WORD.findall(text.lower()))
            for lang, words in found.items():
                grams: Counter = Counter()
                for word, n in words.items():
                    for gram in _trigrams(word):
                        grams[gram] += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(grams)), pa.array([lang] * len(grams)), pa.array(list(grams.values()), pa.int64())], ["gram", "lang", "n"]
                )

    counts = texts.select(text_of("text").alias("text"), "lang").mapInArrow(count, "gram string, lang string, n long")
    wide = counts.groupBy("gram").agg(*[F.sum(F.when(F.col("lang") == x, F.col("n")).otherwise(0)).alias(f"n{i}") for i, x in enumerate(languages)])
    total = sum((F.col(f"n{i}") for i in range(len(languages))), F.lit(0))
    rows = wide.orderBy(total.desc(), "gram").limit(TRIGRAMS).collect()
    table = np.array([[r[f"n{i}"] for i in range(len(languages))] for r in rows], float).reshape(-1, len(languages)) + 0.5
    scaled = np.log(table / (table.sum(axis=0) + 0.5)) * EVIDENCE_SHARE
    model = {r["gram"]: v for r, v in zip(rows, scaled)}
    model[""] = np.zeros(len(languages))  # unseen: no evidence
    return model


class TextScorer:
    """Sums of word likelihoods; each distinct word of a task is looked up once."""

    def __init__(self, model: dict[str, np.ndarray], n: int):
        self.model, self.n = model, n
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.table = np.empty((1 << 12, self.n))

    def _add(self, words: list[str]) -> None:
        none = self.model[""]
        found = [sum((self.model.get(g, none) for g in _trigrams(w)), none) for w in words]
        n = len(self.rows)
        while len(self.table) < n + len(words):
            self.table = np.concatenate((self.table, np.empty_like(self.table)))
        self.table[n : n + len(words)] = found
        self.rows.update(zip(words, range(n, n + len(words))))

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(log-likelihoods per text, words per text)"""
        if len(self.rows) > KNOWN_WORDS:
            self.clear()
        split = [WORD.findall(t.lower()) for t in texts]
        missing = list({w for words in split for w in words if w not in self.rows})
        if missing:
            self._add(missing)
        sizes = np.array([len(w) for w in split])
        row = self.rows.__getitem__
        at = np.fromiter((row(w) for words in split for w in words), np.int64, int(sizes.sum()))
        sums = np.zeros((len(texts), self.n))
        some = np.flatnonzero(sizes)
        if len(some):
            starts = (np.cumsum(sizes) - sizes)[some]
            sums[some] = np.add.reduceat(self.table[at], starts, axis=0)
        return sums, sizes


def text_evidence(rows: DataFrame, model: dict[str, np.ndarray], languages: list[str]) -> DataFrame:
    """``rows`` without ``text``, with ``ll`` (log-likelihood per language, largest 0)
    and ``n_words``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # at most TRIGRAMS entries
    other = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = TextScorer(shared.value, len(languages))
        for batch in batches:
            at = batch.schema.get_field_index("text")
            parts = (part.to_pylist() for part in portions(batch.column(at), 4 << 20))
            found = [scorer.score([markup.unescape(t) if "&" in t else t for t in part]) for part in parts]
            sums = np.concatenate([s for s, _ in found]) if found else np.zeros((0, len(languages)))
            sums = sums - sums.max(axis=1, keepdims=True)
            sizes = np.concatenate([n for _, n in found]) if found else np.zeros(0, np.int64)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in other]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(list(sums), pa.list_(pa.float64())), pa.array(sizes, pa.int64())], [*other, "ll", "n_words"]
            )

    kept = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c != "text")
    return rows.withColumn("text", text_of("text")).mapInArrow(run, f"{kept}, ll array<double>, n_words long")


# -- fusion -----------------------------------------------------------------------


def _softmax(scores: Column) -> Column:
    def shares(odds: Column) -> Column:
        return let(F.aggregate(odds, F.lit(0.0), lambda a, b: a + b), lambda n: F.transform(odds, lambda x: x / n))

    def of(found: Column) -> Column:
        return let(F.array_max(found), lambda top: let(F.transform(found, lambda x: F.exp(x - top)), shares))

    return let(scores, of)


def _shares(counts: Column, parent: Column) -> Column:
    """Counts of a level smoothed towards the parent's shares."""
    n = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
    return F.zip_with(counts, parent, lambda c, p: (c + SMOOTHING * p) / (n + SMOOTHING))


def fuse(rows: DataFrame, languages: list[str]) -> DataFrame:
    """``rows`` with ``host``, ``declared``, ``ll``, ``n_words`` -> the same rows with
    ``text_lang``, ``lang_found`` and ``confidence`` in place of ``ll``. A host without
    a dot (a source's name) has no domain and no suffix: its prior is smoothed towards
    that of all hosts."""
    k = len(languages)
    q_, said_, host_, count_, share_, suffix_ll_, prior_, said_ll_, posterior_ = (
        free_name(rows, c) for c in ("q", "said", "known_host", "count", "domain_share", "suffix_ll", "prior", "said_ll", "posterior")
    )
    q = F.when(F.col("n_words") > 0, _softmax(F.col("ll"))).otherwise(F.array(*[F.lit(0.0)] * k))
    rows = cut_lineage(
        rows.withColumn(q_, q).withColumn(
            said_, F.when(F.col("declared").isNull(), F.lit(None)).when(F.col("declared").isin(languages), F.col("declared")).otherwise("other")
        ),
        "language",
    )
    sums = [F.sum(F.col(q_)[i]).alias(f"q{i}") for i in range(k)]
    counts = F.array(*[F.col(f"q{i}") for i in range(k)])
    none = F.array(*[F.lit(0.0)] * k)

    everywhere = rows.agg(*sums).first()
    total = [everywhere[i] or 0.0 for i in range(k)]
    world = [(t + 1) / (sum(total) + k) for t in total]
    whole = F.array(*map(F.lit, world))

    # markup: P(said | language), a table of k + 1 rows at most
    said = rows.where(F.col(said_).isNotNull()).groupBy(F.col(said_).alias("said")).agg(*sums).collect()
    named = {r["said"]: [r[f"q{i}"] for i in range(k)] for r in said}
    mass = [sum(v[i] for v in named.values()) for i in range(k)]
    markup_ll: Column = none
    for name, v in named.items():
        logs = [float(np.log((v[i] + 1) / (mass[i] + len(named) + 1))) for i in range(k)]
        markup_ll = F.when(F.col(said_) == name, F.array(*map(F.lit, logs))).otherwise(markup_ll)

    # hosts: counts, then their domain's shares and their suffix's likelihood
    hosts = cut_lineage(
        rows.where("host is not null").groupBy(F.col("host").alias("host")).agg(*sums).select("host", counts.alias("count")), "hosts"
    )
    by = [F.sum(F.col("count")[i]).alias(f"q{i}") for i in range(k)]
    host = F.col("host")
    addresses = hosts.where(F.contains(host, F.lit(".")))
    domains = addresses.groupBy(domain_of(host).alias("domain")).agg(*by).select("domain", _shares(counts, whole).alias("domain_share"))
    suffixes = addresses.groupBy(suffix_of(host).alias("suffix")).agg(*by)
    mass_of = addresses.agg(*by).first()
    suffix_ll = F.array(*[F.log((F.col(f"q{i}") + world[i]) / ((mass_of[i] or 0.0) + 1.0)) for i in range(k)])
    suffixes = suffixes.select("suffix", F.transform(suffix_ll, lambda x: x - F.array_max(suffix_ll)).alias("suffix_ll"))
    dotted = F.contains(host, F.lit("."))
    level = (
        hosts.withColumn("domain", F.when(dotted, domain_of(host)))
        .withColumn("suffix", F.when(dotted, suffix_of(host)))
        .join(domains, "domain", "left")
        .join(suffixes, "suffix", "left")
        .select(
            host.alias(host_), F.col("count").alias(count_), F.coalesce("domain_share", whole).alias(share_), F.coalesce("suffix_ll", none).alias(suffix_ll_)
        )
    )
    joined = rows.join(level, rows["host"] == level[host_], "left")
    own = F.zip_with(count_, q_, lambda c, mine: F.greatest(c - mine, F.lit(0.0)))
    prior = F.coalesce(_shares(own, F.col(share_)), whole)
    joined = joined.withColumn(prior_, prior).withColumn(said_ll_, markup_ll)
    scores = F.transform(
        F.arrays_zip(
            F.col("ll").alias("a"), F.col(prior_).alias("b"), F.col(said_ll_).alias("c"), F.coalesce(suffix_ll_, none).alias("d")
        ),
        lambda x: x["a"] + F.log(x["b"]) + x["c"] + x["d"],
    )
    names = F.array(*map(F.lit, languages))
    best = F.array_max(posterior_)
    return (
        joined.withColumn(posterior_, _softmax(scores))
        .withColumn("lang_found", F.element_at(names, F.array_position(posterior_, best).cast("int")))
        .withColumn("confidence", best)
        .withColumn("text_lang", F.when(F.col("n_words") > 0, F.element_at(names, F.array_position(q_, F.array_max(q_)).cast("int"))))
        .drop(host_, count_, share_, suffix_ll_, prior_, said_ll_, posterior_, q_, said_, "ll")
    )


def identify(rows: DataFrame, labelled: DataFrame, languages: list[str]) -> DataFrame:
    """``rows`` (``text``, ``host``, ``declared`` and any keys) -> a row per row with
    ``lang_found``, ``confidence`` (its posterior), ``text_lang`` (by text alone) and
    ``n_words``.

    ``labelled`` (``text``, ``lang``) trains the trigram model on at most about
    :data:`SAMPLE_ROWS` rows chosen by a hash of the text. Null and empty texts, and
    texts without letters, are judged by the other evidence; a null host takes the
    prior of all hosts, a null or unknown declaration says nothing or ``other``.
    Without any evidence the most frequent language is given. Repeated rows are each
    returned; empty tables give no rows; key columns may have any names but ``ll`` and
    the four of the result.
    """
    known = labelled.where(F.col("lang").isin(languages) & F.col("text").isNotNull())
    share = max(1, -(-known.select("lang").count() // SAMPLE_ROWS))
    model = fit_trigrams(known.where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0), languages)
    return fuse(text_evidence(rows, model, languages), languages)
