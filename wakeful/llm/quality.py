"""Quality rules: learned decision lists, DataFrame functions only.

Statistics of every document are column expressions. From labelled documents an
ordered list of rules is learned by sequential covering: a rule grows one threshold
condition at a time (largest information gain over the documents that no earlier
rule covers), is pruned from its end against held-out documents, and is added while
it rejects mostly bad documents there. Candidates are counted by Spark: each step is
one grouped aggregate over (feature, bin, label), so all labelled documents take part
and only a few hundred counts reach the driver. The list is emitted as a nested
conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeful.llm.common import cut_lineage, let, squeezed, text_of

SYMBOLS = "#*$%&|<>"
WINDOW = 5
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("word_length", "symbol_share", "dup_line_share", "repeat_share", "n_words", "upper_share", "stop_share", "list_share")


# -- statistics -------------------------------------------------------------------


def _repeated_words(words: Column) -> Column:
    """Words inside windows of five words that occur twice or more in ``words``.

    Windows are hashed; where all hashes differ the answer is 0. Else the windows,
    ordered by (hash, words, position), lie beside their equals, and the lengths
    their positions cover are added up: n log n steps whatever the repetition.
    """

    def window(w: Column, i: Column) -> Column:
        return F.slice(w, i + 1, WINDOW)

    def covered(w: Column, hashes: Column) -> Column:
        items = F.array_sort(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), F.array_join(window(w, i), " ").alias("w"), i.alias("i")))
        )

        def same(s: Column, j: Column, k: Column) -> Column:
            a, b = s[j], s[k]
            return (a["h"] == b["h"]) & (a["w"] == b["w"])

        repeated = let(
            items,
            lambda s: F.transform(
                F.filter(
                    s,
                    lambda x, j: F.when(j > 0, same(s, j, j - 1)).otherwise(F.lit(False))
                    | F.when(j < F.size(s) - 1, same(s, j, j + 1)).otherwise(F.lit(False)),
                ),
                lambda x: x["i"],
            ),
        )
        return let(
            F.array_sort(repeated),
            lambda p: F.aggregate(
                F.transform(
                    p,
                    lambda at, j: F.when(j < F.size(p) - 1, F.least(F.lit(WINDOW), p[j + 1] - at)).otherwise(F.lit(WINDOW)),
                ),
                F.lit(0),
                lambda a, b: a + b,
            ),
        )

    def counted(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - WINDOW)
        return let(
            F.transform(starts, lambda i: F.xxhash64(*[w[i + k] for k in range(WINDOW)])),
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(w, h)),
        )

    return let(words, lambda w: F.when(F.size(w) < WINDOW + 1, F.lit(0)).otherwise(counted(w)))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, and what further features need), a row per
    row; null text has no words. Whole texts are read."""
    text = text_of(text_col)
    has_word = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        let(has_word, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))).alias("lines"),
        F.length(F.regexp_replace(text, "[^\\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.length(F.regexp_replace(text, "[^.!?]+", "")).cast("long").alias("n_stops"),
        squeezed(text_col).alias("words"),
    )
    split = F.split("words", " ")
    counted = base.select(
        "doc_id",
        "text_hash",
        F.when(F.col("words") == "", F.lit(0)).otherwise(F.size(split)).cast("long").alias("n_words"),
        F.when(F.col("words") == "", F.lit(0)).otherwise(F.length("words") - F.size(split) + 1).cast("long").alias("word_chars"),
        "n_symbols",
        F.col("lines.dup").cast("long").alias("n_dup_lines"),
        _repeated_words(split).cast("long").alias("n_repeat_words"),
        F.col("lines.n").cast("long").alias("n_lines"),
        "n_upper",
        "n_stops",
    )
    return counted.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def features() -> dict[str, Column]:
    """What conditions look at: ratios that don't depend on a document's length, and
    the length."""
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    values = (
        F.col("word_chars") / words,
        F.col("n_symbols") / chars,
        F.col("n_dup_lines") / lines,
        F.col("n_repeat_words") / words,
        F.col("n_words").cast("double"),
        F.col("n_upper") / chars,
        F.col("n_stops") / words,
        F.col("n_lines") / words,
    )
    return dict(zip(FEATURES, values))


# -- rules ------------------------------------------------------------------------


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # value > threshold, else value <= threshold
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def column(self) -> Column:
        return reduce(lambda a, b: a & b, [c.column() for c in self.conditions])

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; a document that meets one is rejected, others are kept."""

    rules: tuple[Rule, ...]

    def rule_number(self) -> Column:
        """Position (from 1) of the first rule met, null for none, as one ordered
        conditional expression."""
        found = F.lit(None).cast("int")
        for k, rule in reversed(list(enumerate(self.rules, 1))):
            found = F.when(rule.column(), F.lit(k)).otherwise(found)
        return found


def _gain(pos: float, neg: float, pos0: float, neg0: float) -> float:
    """Information gain of a rule's extension, weighed by the bad documents kept."""
    if pos == 0:
        return 0.0
    return pos * (math.log2(pos / (pos + neg)) - math.log2(pos0 / (pos0 + neg0)))


class Covering:
    """Learns a :class:`DecisionList` from rows of features and ``bad`` (0/1).

    ``held`` rows (a third, by hash of the id) prune and accept rules, the rest grow
    them. Thresholds lie half-way between neighbouring quantiles (``cuts`` of all
    labelled rows and as many of the values above 0, as most shares are 0). A rule
    stays while it rejects ``least`` bad held-out documents and at least ``precision``
    of the held-out documents that it rejects are bad.
    """

    def __init__(self, rows: DataFrame, cuts: int = 40, precision: float = 0.9, least: int = 4, max_rules: int = 12, max_conditions: int = 4):
        self.rows, self.precision, self.least = rows, precision, least
        self.max_rules, self.max_conditions = max_rules, max_conditions
        points = [k / (cuts + 1) for k in range(1, cuts + 1)]
        above = [F.percentile_approx(F.when(F.col(f) > 0, F.col(f)), [0.01, *points], 2000).alias(f"{f}_above") for f in FEATURES]
        found = rows.agg(*[F.percentile_approx(f, points, 2000).alias(f) for f in FEATURES], *above).first()
        values = {f: sorted({*(found[f] or ()), *(found[f"{f}_above"] or ())}) for f in FEATURES}
        # half-way between neighbours: a value a little off what was seen stays on its side
        self.cuts = {f: [(a + b) / 2 for a, b in zip(v, v[1:])] for f, v in values.items()}
        bins = [
            reduce(lambda a, b: a + b, [(F.col(f) > c).cast("int") for c in self.cuts[f]], F.lit(0)).cast("int")
            for f in FEATURES
        ]
        self.rows = cut_lineage(rows.select("*", F.array(*bins).alias("bins")), "labelled")

    def _counts(self, where: Column, held: bool) -> dict:
        """(feature, bin) -> [good, bad] of the rows that meet ``where``."""
        table: dict[tuple[int, int], list[int]] = {}
        rows = (
            self.rows.where(where & (F.col("held") == held))
            .select("bad", F.posexplode("bins").alias("f", "bin"))
            .groupBy("f", "bin", "bad")
            .count()
            .collect()  # at most features x (cuts + 1) x 2 rows
        )
        for r in rows:
            table.setdefault((r["f"], r["bin"]), [0, 0])[r["bad"]] += r["count"]
        return table

    def _grow(self, open_: Column) -> list[Condition]:
        conditions: list[Condition] = []
        where = open_
        while len(conditions) < self.max_conditions:
            table = self._counts(where, False)
            neg0, pos0 = (sum(v[k] for (f, _), v in table.items() if f == 0) for k in (0, 1))
            if not pos0 or not neg0:
                break
            best, score = None, 1e-9
            for f, name in enumerate(FEATURES):
                below = [0, 0]
                for b, cut in enumerate(self.cuts[name]):
                    good, bad = table.get((f, b), (0, 0))
                    below = [below[0] + good, below[1] + bad]
                    for above, (neg, pos) in ((False, below), (True, (neg0 - below[0], pos0 - below[1]))):
                        gain = _gain(pos, neg, pos0, neg0)
                        if gain > score:
                            best, score = Condition(name, above, cut), gain
            if best is None:
                break
            conditions.append(best)
            where = where & best.column()
        return conditions

    def _prune(self, conditions: list[Condition], open_: Column) -> tuple[int, int, int]:
        """Length of the best prefix on held-out rows, and its [good, bad] there."""
        aggs, where = [], F.lit(True)
        for k, c in enumerate(conditions):
            where = where & c.column()
            aggs += [F.sum((where & (F.col("bad") == v)).cast("long")).alias(f"n{k}_{v}") for v in (0, 1)]
        row = self.rows.where(open_ & F.col("held")).agg(*aggs).first()
        scored = []
        for k in range(len(conditions)):
            good, bad = row[f"n{k}_0"] or 0, row[f"n{k}_1"] or 0
            scored.append(((bad - good) / (bad + good) if bad + good else -1.0, bad, -k, k + 1, good))
        _, bad, _, length, good = max(scored)
        return length, good, bad

    def learn(self) -> DecisionList:
        rules: list[Rule] = []
        open_: Column = F.lit(True)
        while len(rules) < self.max_rules:
            conditions = self._grow(open_)
            if not conditions:
                break
            length, good, bad = self._prune(conditions, open_)
            if bad < self.least or bad < self.precision * (bad + good):
                break
            rules.append(Rule(tuple(conditions[:length])))
            open_ = open_ & ~rules[-1].column()
        return DecisionList(tuple(rules))


def learn_rules(stats: DataFrame, labels: DataFrame, **options) -> DecisionList:
    """Decision list from :func:`statistics` rows and ``labels`` (doc_id, quality 0/1;
    other values and null ids are left out). No usable labels, or labels of one kind
    only, give an empty list, which keeps everything."""
    known = labels.where("doc_id is not null and quality in (0, 1)").select("doc_id", (1 - F.col("quality")).cast("int").alias("bad"))
    rows = (
        stats.where("not base_failed")
        .join(known, "doc_id")
        .select("doc_id", "bad", *[v.alias(k) for k, v in features().items()])
        .withColumn("held", F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0)
    )
    return Covering(rows, **options).learn()


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """A row per row of ``docs``: its statistics, ``base_failed``, ``rule`` (number of
    the rule that rejects it, null for none) and ``kept``.

    Null and empty texts have no words and fail the base. Repeated rows are each
    returned; rows with a null id are judged like others but never train. Empty
    tables give no rows. Other columns of ``docs`` are not looked at.
    """
    stats = cut_lineage(statistics(docs, id_col, text_col), "quality")
    rules = learn_rules(stats, labels, **options)
    return judged(stats, rules)


def judged(stats: DataFrame, rules: DecisionList) -> DataFrame:
    names = stats.columns
    return (
        stats.select(*names, *[v.alias(k) for k, v in features().items() if k not in names])
        .select(*names, rules.rule_number().alias("rule"))
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that :func:`quality` rejects, columns as given. Rows
    are matched to their verdict by id and a hash of the text, null ids included."""
    stats = cut_lineage(statistics(docs, id_col, text_col), "quality")
    rules = learn_rules(stats, labels, **options)
    gone = judged(stats, rules).where("not kept").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    return docs.join(
        gone, docs[id_col].eqNullSafe(gone["_id"]) & (F.xxhash64(text_of(docs[text_col])) == gone["_hash"]), "left_anti"
    )
