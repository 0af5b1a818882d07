"""Personal data by a skip-chain conditional random field.

Fixed patterns with their checks find the plain cases (base spans). They read greedily
and never retry, so a phone number followed by a card number hides both. The field
reads tokens instead: words that hold a digit or ``@`` (all others are no part of these
four kinds) get a label, O or the begin or inside of a kind. Its potentials are

* of a token: its shape, number of digits and checks;
* of neighbours (no other word between them): the pair of labels;
* of skip edges: two tokens of a document, however far apart, that are equal or similar
  (equal but for letter case or for marks between digits, one half of a long number or
  the local part of an address in common) share a potential for being of one kind. Each
  token is linked to the next one with the same key, so edges grow with the tokens.

Base spans are observed labels. Loopy message passing over each whole document gives
the other tokens' marginals; a run of tokens that is more probably of a kind than not
becomes a span, if it passes that kind's check and touches no base span.

Token and neighbour weights are fitted by maximum likelihood, skip weights piecewise,
on a bounded sample of token windows labelled by the base spans; windows in which a
pattern matched but failed its check have no label and are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeful.llm.common import cut_lineage, text_of

KINDS = ["email", "ip", "card", "phone"]
LABELS = ["O", *[f"{p}-{k}" for k in KINDS for p in "BI"]]
TYPE = np.array([0, *[1 + k for k in range(len(KINDS)) for _ in "BI"]])  # label -> 0 or 1 + kind
N = len(LABELS)
WINDOW = 16  # tokens of a training window
SAMPLE_WINDOWS = 10_000  # training windows, at most about
PRIOR = 0.05  # of the weights' squares
SKIP_MEAN, SKIP_PRIOR = 1.0, 1.0
FIT_STEPS = 300
ROUNDS = 30  # of message passing
DAMPING = 0.2
TOKENS_AT_ONCE = 100_000  # of documents that are inferred together

# -- base spans -------------------------------------------------------------------

# Patterns of the contract. A run of digits is tried from its start only and never given
# back: a match inside of it would exist at its start too, so reading stays linear.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile("[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) << (k & 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each ``@`` to both sides."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text, start - 1):
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        else:
            done = at + 1
        at = text.find("@", done)


def passes(kind: str, span: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in span.split("."))
    digits = NOT_DIGIT.sub("", span)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """((kind, start, end) of matches, by kind and start; (start, end) of those that
    failed their check)."""
    found, failed = [], []
    if "@" in text:
        found += [(0, s, e) for s, e in emails(text)]
    for k, pattern in ((1, IP), (2, CARD), (3, PHONE)):
        for m in pattern.finditer(text):
            if passes(KINDS[k], m[0]):
                found.append((k, *m.span()))
            elif k == 1 or len(NOT_DIGIT.sub("", m[0])) >= 9:
                failed.append(m.span())
    return found, failed


# -- tokens -----------------------------------------------------------------------

# Words with a digit or @; a word is looked at once.
TOKEN = re.compile(r"(?<![^\x20\x09-\x0D])(?=[^\x20\x09-\x0D0-9@]*+[0-9@])[^\x20\x09-\x0D]++")
FULL_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
FULL_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")


def core(text: str, start: int, end: int) -> tuple[int, int]:
    """A word without the marks around it."""
    word = text[start:end]
    lead = re.match(r"[^A-Za-z0-9+(@]*", word).end()
    trail = len(word)
    while trail > lead and not (word[trail - 1].isascii() and word[trail - 1].isalnum() or word[trail - 1] in ")@"):
        trail -= 1
    return start + lead, start + max(trail, lead)


def features(word: str) -> list[str]:
    """What is seen of a token."""
    digits = NOT_DIGIT.sub("", word)
    shape = re.sub(r"[0-9]+", "9", re.sub(r"[^\W\d_]+", "a", word))
    out = ["*", "s" + (shape if len(shape) <= 24 else shape[:24] + "+"), f"n{min(len(digits), 20)}", f"r{min(len(re.findall('[0-9]+', word)), 6)}"]
    if 13 <= len(digits) <= 19 and not re.search("[A-Za-z]", word):
        out.append(f"luhn{luhn(digits):d}")
    if "@" in word:
        out.append(f"mail{FULL_EMAIL.fullmatch(word) is not None:d}")
    if FULL_IP.fullmatch(word):
        out.append(f"ip{passes('ip', word):d}")
    return out


def keys(word: str) -> list[str]:
    """Tokens with a key in common are equal or similar."""
    out = ["w" + word.lower()] if len(word) >= 4 else []
    digits = NOT_DIGIT.sub("", word)
    letters = re.search("[A-Za-z]", word)
    if len(digits) >= 6 and not letters:
        out.append("d" + digits)
    if len(digits) >= 12 and not letters:
        out += [f"f{len(digits)}:{digits[: len(digits) // 2]}", f"b{len(digits)}:{digits[len(digits) // 2 :]}"]
    local = word.rpartition("@")[0]
    if len(local) >= 3:
        out.append("l" + local.lower())
    return out


def labels_of(spans: list[tuple[int, int]], found: list[tuple[int, int, int]], failed: list[tuple[int, int]]) -> list[int]:
    """Label of each token (core): begin or inside of the first base span, by kind,
    that covers it; -1 where spans or failed matches only touch it; else O."""
    out = [0] * len(spans)
    touched = sorted([(s, e, -1) for s, e in failed] + [(s, e, k) for k, s, e in found])
    starts = np.array([s for s, _ in spans] or [0])
    ends = np.array([e for _, e in spans] or [0])
    rank = [9] * len(spans)
    for s, e, k in touched:
        lo, hi = int(np.searchsorted(ends, s, "right")), int(np.searchsorted(starts, e, "left"))
        for i in range(lo, min(hi, len(spans))):
            covered = k >= 0 and s <= spans[i][0] and spans[i][1] <= e
            if covered and k < rank[i]:
                rank[i] = k
                out[i] = 1 + 2 * k + (i > lo)
            elif not covered and rank[i] == 9:
                out[i] = -1
    return out


SCANNED = "b_kind array<int>, b_start array<int>, b_end array<int>, t_start array<int>, t_end array<int>, t_label array<int>, t_joined array<boolean>, t_word array<string>"


def _scan(text: str) -> tuple:
    found, failed = base_spans(text)
    words = [m.span() for m in TOKEN.finditer(text)]
    spans = [core(text, *w) for w in words]
    joined = [k > 0 and not text[words[k - 1][1] : words[k][0]].strip(" \t\n\v\f\r") for k in range(len(words))]
    return (
        [k for k, _, _ in found],
        [s for _, s, _ in found],
        [e for _, _, e in found],
        [s for s, _ in spans],
        [e for _, e in spans],
        labels_of(spans, found, failed),
        joined,
        [text[s:e] for s, e in spans],
    )


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Base spans and tokens of every document, a written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = ([],) * 8
        types = [pa.list_(pa.int32())] * 6 + [pa.list_(pa.bool_()), pa.list_(pa.string())]
        for batch in batches:
            some = pc.match_substring_regex(batch.column(1), "[0-9@]").to_pylist()
            rows = [_scan(t.as_py()) if x else none for t, x in zip(batch.column(1), some)]
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *[c.split()[0] for c in SCANNED.split(", ")]])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return cut_lineage(rows.mapInArrow(run, f"doc_id {kind}, {SCANNED}"), "pii-tokens")


# -- the field --------------------------------------------------------------------


@dataclass
class Field:
    vocabulary: dict[str, int]
    token: np.ndarray  # (features, labels)
    chain: np.ndarray  # (labels, labels) log potentials
    skip: np.ndarray  # by type: log potential of both ends being of it

    def unary(self, words: list[str]) -> np.ndarray:
        seen: dict[str, np.ndarray] = {}
        for w in words:
            if w not in seen:
                seen[w] = sum((self.token[self.vocabulary[f]] for f in features(w) if f in self.vocabulary), np.zeros(N))
        return np.array([seen[w] for w in words]).reshape(len(words), N)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit_chain(windows: list[tuple[list[list[str]], list[int], int]]) -> tuple[dict[str, int], np.ndarray, np.ndarray]:
    """Weights of a linear chain from (features of each token, labels, times seen), by
    Adam steps on the penalised likelihood."""
    listed = [x for x, _, _ in windows]
    vocabulary = {f: i for i, f in enumerate(sorted({f for x in listed for y in x for f in y}))}
    wide, long = len(windows), max((len(x) for x in listed), default=0)
    at = [(k, j, vocabulary[f]) for k, x in enumerate(listed) for j, y in enumerate(x) for f in y]
    row, place, feature = np.array(at, np.int64).reshape(-1, 3).T
    y = np.zeros((wide, long), np.int64)
    real = np.zeros((wide, long), bool)
    for k, (_, labels, _) in enumerate(windows):
        y[k, : len(labels)], real[k, : len(labels)] = labels, True
    times = np.array([n for _, _, n in windows], float)
    both = real[:, 1:]
    truth = np.eye(N)[y] * (real * times[:, None])[:, :, None]
    want_token = np.zeros((len(vocabulary), N))
    np.add.at(want_token, feature, truth[row, place])
    want_chain = np.zeros((N, N))
    np.add.at(want_chain, (y[:, :-1][both], y[:, 1:][both]), np.repeat(times, both.sum(axis=1)))
    token, chain = np.zeros_like(want_token), np.zeros((N, N))
    moments = [np.zeros_like(token), np.zeros_like(token), np.zeros_like(chain), np.zeros_like(chain)]
    for step in range(1, FIT_STEPS + 1):
        u = np.zeros((wide, long, N))
        np.add.at(u, (row, place), token[feature])
        ahead, back = np.empty_like(u), np.zeros_like(u)
        ahead[:, 0] = u[:, 0]
        for j in range(1, long):
            ahead[:, j] = np.where(real[:, j, None], u[:, j] + _logsum(ahead[:, j - 1, :, None] + chain, 1), ahead[:, j - 1])
        whole = _logsum(ahead[:, -1], 1)
        for j in range(long - 2, -1, -1):
            back[:, j] = np.where(real[:, j + 1, None], _logsum(chain + (u[:, j + 1] + back[:, j + 1])[:, None, :], 2), 0.0)
        p = np.exp(ahead + back - whole[:, None, None]) * (real * times[:, None])[:, :, None]
        have_token = np.zeros_like(token)
        np.add.at(have_token, feature, p[row, place])
        pair = ahead[:, :-1, :, None] + chain + (u[:, 1:] + back[:, 1:])[:, :, None, :] - whole[:, None, None, None]
        have_chain = (np.exp(np.minimum(pair, 0)) * (both * times[:, None])[:, :, None, None]).sum(axis=(0, 1))
        for k, (w, slope) in enumerate(((token, want_token - have_token - PRIOR * token), (chain, want_chain - have_chain - PRIOR * chain))):
            first, second = moments[2 * k], moments[2 * k + 1]
            first += 0.1 * (slope - first)
            second += 0.01 * (slope**2 - second)
            w += 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return vocabulary, token, chain


def fit_skip(same: np.ndarray, other: int) -> np.ndarray:
    """Skip weights by type from the numbers of sample edges whose ends are both of it
    (``other``: of two types), each edge a piece of its own."""
    w, types = np.full(len(same), SKIP_MEAN), len(same)
    total = same.sum() + other
    for _ in range(500):
        z = np.exp(w).sum() + types * (types - 1)
        slope = same - total * np.exp(w) / z - SKIP_PRIOR * (w - SKIP_MEAN)
        w += slope / (0.25 * total + SKIP_PRIOR)
    return np.maximum(w, 0.0)


def skip_edges(words: list[str], document: np.ndarray) -> np.ndarray:
    """(edges, 2): every token and the next one of its document with a key in common."""
    last: dict[tuple[int, str], int] = {}
    found: dict[str, list[str]] = {}
    edges = set()
    for i, (w, d) in enumerate(zip(words, document.tolist())):
        if w not in found:
            found[w] = keys(w)
        for key in found[w]:
            before = last.get((d, key))
            if before is not None:
                edges.add((before, i))
            last[d, key] = i
    return np.array(sorted(edges), np.int64).reshape(-1, 2)


def marginals(unary: np.ndarray, chain_edges: np.ndarray, skip: np.ndarray, field: Field) -> np.ndarray:
    """(tokens, labels) by sum-product message passing on both kinds of edges; exact
    where there are no cycles and no path is longer than the rounds."""
    pair_skip = np.where(TYPE[:, None] == TYPE, field.skip[TYPE][:, None], 0.0)
    source = np.concatenate((chain_edges[:, 0], chain_edges[:, 1], skip[:, 0], skip[:, 1]))
    target = np.concatenate((chain_edges[:, 1], chain_edges[:, 0], skip[:, 1], skip[:, 0]))
    c, s = len(chain_edges), len(skip)
    back = np.concatenate((np.arange(c) + c, np.arange(c), np.arange(s) + 2 * c + s, np.arange(s) + 2 * c))
    forward, backward, level = np.exp(field.chain), np.exp(field.chain.T), np.exp(pair_skip)
    messages = np.zeros((len(source), N))

    def beliefs():
        out = unary.copy()
        for label in range(N):
            out[:, label] += np.bincount(target, weights=messages[:, label], minlength=len(unary))
        return out

    for _ in range(ROUNDS if len(source) else 0):
        x = beliefs()[source] - messages[back]
        x = np.exp(x - x.max(axis=1, keepdims=True))
        new = np.concatenate((x[:c] @ forward, x[c : 2 * c] @ backward, x[2 * c :] @ level))
        new = np.log(new + 1e-300)
        new -= new.max(axis=1, keepdims=True)
        messages = DAMPING * messages + (1 - DAMPING) * new
    out = beliefs()
    out = np.exp(out - out.max(axis=1, keepdims=True))
    return out / out.sum(axis=1, keepdims=True)


def _joins(joined: np.ndarray) -> np.ndarray:
    at = np.flatnonzero(joined)
    return np.stack((at - 1, at), axis=1)


# -- training ---------------------------------------------------------------------


def _windows(words: list[str], labels: list[int], joined: list[bool]) -> Iterator[tuple[str, list[int]]]:
    """Labelled windows: the tokens' features, a line each, and their labels."""
    first = 0
    for k in range(1, len(words) + 1):
        if k == len(words) or not joined[k] or k - first == WINDOW:
            if -1 not in labels[first:k]:
                yield "\n".join("\t".join(features(w)) for w in words[first:k]), labels[first:k]
            first = k


def train(scanned: DataFrame) -> Field | None:
    """The field fitted on at most about :data:`SAMPLE_WINDOWS` windows, taken by a hash
    of their document's row, and on those documents' skip edges. None without windows."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, labels, joined = (batch.column(i).to_pylist() for i in (1, 2, 3))
            out: dict[tuple, int] = defaultdict(int)
            for h, w, y, j in zip(batch.column(0).to_pylist(), words, labels, joined):
                for a, b in _windows(w, y, j):
                    out[h, "w", a, tuple(b)] += 1
                types = [0 if x == 0 else -1 if x < 0 else TYPE[x] for x in y]
                for a, b in skip_edges(w, np.zeros(len(w), np.int64)).tolist():
                    if types[a] >= 0 and types[b] >= 0:
                        out[h, "s", "", (int(types[a] if types[a] == types[b] else -1),)] += 1
            columns = list(zip(*[(*k, n) for k, n in out.items()])) or [()] * 5
            kinds = (pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["h", "part", "seen", "labels", "n"])

    rows = scanned.where(F.size("t_word") > 0).select(F.xxhash64("doc_id", "t_word").alias("h"), "t_word", "t_label", "t_joined")
    size = rows.agg(F.sum(F.ceil(F.size("t_word") / WINDOW) + F.size(F.filter("t_joined", lambda x: ~x)))).first()[0]
    if not size:
        return None
    share = max(1, -(-size // SAMPLE_WINDOWS))
    found = rows.mapInArrow(windows, "h long, part string, seen string, labels array<int>, n long")
    # windows of a long document are sampled too: by the document's hash and their place
    found = found.where(F.pmod(F.xxhash64("h", "seen", "labels"), F.lit(share)) == 0)
    sample = cut_lineage(found.groupBy("part", "seen", "labels").agg(F.sum("n").alias("n")), "pii-sample")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = sorted((r["part"], r["seen"], tuple(r["labels"]), r["n"]) for b in batches for r in b.to_pylist())
        same, other = np.zeros(1 + len(KINDS)), 0
        for part, _, (kind, *_), n in parts:
            if part == "s" and kind >= 0:
                same[kind] += n
            elif part == "s":
                other += n
        seen = [([x.split("\t") for x in w.split("\n")], list(y), n) for part, w, y, n in parts if part == "w"]
        if not seen:
            return
        vocabulary, token, chain = fit_chain(seen)
        skip = fit_skip(same, other)
        yield pa.RecordBatch.from_pylist([{"names": list(vocabulary), "token": token.ravel().tolist(), "chain": chain.ravel().tolist(), "skip": skip.tolist()}])

    model = sample.coalesce(1).mapInArrow(fit, "names array<string>, token array<double>, chain array<double>, skip array<double>").collect()
    if not model:
        return None
    (m,) = model
    return Field({f: i for i, f in enumerate(m["names"])}, np.array(m["token"]).reshape(-1, N), np.array(m["chain"]).reshape(N, N), np.array(m["skip"]))


# -- spans ------------------------------------------------------------------------

OBSERVED = 40.0  # log potential of a label that a base span gives
LEAD = {k: re.compile("[^0-9+(]*" if k == "phone" else "[^A-Za-z0-9]*") for k in KINDS}
TRAIL = re.compile("[^A-Za-z0-9]*$")


def _fits(kind: str, span: str, linked: bool) -> bool:
    """The kind's check on an added span; a looser one where a token of it is like one
    of a base span of that kind."""
    digits = len(NOT_DIGIT.sub("", span))
    if kind == "email":
        return FULL_EMAIL.fullmatch(span) is not None or linked and "@" in span[1:-1]
    if kind == "ip":
        return FULL_IP.fullmatch(span) is not None and (passes(kind, span) or linked)
    if re.search("[A-Za-z@]", span):
        return False
    if (CARD if kind == "card" else PHONE).fullmatch(span) and passes(kind, span):
        return True
    return linked and (13 if kind == "card" else 7) <= digits <= (19 if kind == "card" else 15)


def added_spans(field: Field, rows: list[dict]) -> list[list[tuple[int, int, int]]]:
    """Spans that the field adds, for documents as :func:`scan` returns them."""
    sizes = [len(r["t_word"]) for r in rows]
    words = [w for r in rows for w in r["t_word"]]
    if not words:
        return [[] for _ in rows]
    document = np.repeat(np.arange(len(rows)), sizes)
    label = np.array([x for r in rows for x in r["t_label"]])
    joined = np.array([x for r in rows for x in r["t_joined"]], bool)
    unary = field.unary(words)
    observed = np.flatnonzero(label > 0)
    unary[observed] = 0.0
    unary[observed, label[observed]] = OBSERVED
    links = skip_edges(words, document)
    p = marginals(unary, _joins(joined), links, field)
    by_type = np.stack([p[:, TYPE == t].sum(axis=1) for t in range(1 + len(KINDS))], axis=1)
    kind = by_type.argmax(axis=1)
    linked = np.zeros(len(words), bool)
    for a, b in ((0, 1), (1, 0)):
        near = (label[links[:, a]] > 0) & (TYPE[label[links[:, a]]] == kind[links[:, b]])
        linked[links[near, b]] = True
    begins = p[np.arange(len(words)), np.maximum(0, 2 * kind - 1)] > p[np.arange(len(words)), 2 * kind]
    out: list[list[tuple[int, int, int]]] = []
    at = 0
    for r, n in zip(rows, sizes):
        new, i = [], at
        base = list(zip(r["b_start"], r["b_end"]))
        while i < at + n:
            k = i + 1
            if kind[i] and label[i] <= 0:
                while k < at + n and joined[k] and kind[k] == kind[i] and label[k] <= 0 and not begins[k]:
                    k += 1
                new += _span(KINDS[kind[i] - 1], kind[i] - 1, r, i - at, k - at, base, bool(linked[i:k].any()))
            i = k
        out.append(new)
        at += n
    return out


def _span(name: str, k: int, r: dict, i: int, j: int, base: list[tuple[int, int]], linked: bool) -> list[tuple[int, int, int]]:
    """The span of tokens i to j, without marks at its ends, if it may be added. White
    space between tokens counts as blanks, which the checks don't look at."""
    text = " ".join(r["t_word"][i:j])
    start = r["t_start"][i] + LEAD[name].match(text).end()
    end = r["t_end"][j - 1] - (len(text) - TRAIL.search(text).start())
    inner = text[LEAD[name].match(text).end() : TRAIL.search(text).start()]
    if start >= end or not _fits(name, inner, linked) or any(s < end and start < e for s, e in base):
        return []
    return [(k, start, end)]


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def find_private(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", field: Field | None = None) -> DataFrame:
    """(``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base_sha256``,
    ``spans``): a row per row of ``docs``, whole texts read. The counts and the digest
    are those of the base spans; ``spans`` has these and the added ones, each as
    kind:start:end in code points. ``field`` is fitted on ``docs`` where none is given.

    Null and empty texts have no spans. Repeated rows and rows with a null id count each
    for themselves; empty tables give no rows; other columns are not looked at."""
    scanned = scan(docs, id_col, text_col)
    field = field or train(scanned)
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select(batch.schema.names[1:]).to_pylist()
            base = [list(zip(r["b_kind"], r["b_start"], r["b_end"])) for r in rows]
            more: list[list[tuple[int, int, int]]] = []
            first = held = 0
            for k, r in enumerate(rows, 1):
                held += len(r["t_word"])
                if k == len(rows) or held >= TOKENS_AT_ONCE:
                    more += added_spans(field, rows[first:k]) if field else [[]] * (k - first)
                    first, held = k, 0
            counts = [pa.array([sum(k == i for k, _, _ in b) for b in base], pa.int64()) for i in range(len(KINDS))]
            digests = pa.array([hashlib.sha256(spans_text(b).encode()).hexdigest() for b in base], pa.string())
            spans = pa.array([spans_text(b + a) for b, a in zip(base, more)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, digests, spans], names)

    kind = scanned.schema["doc_id"].dataType.simpleString()
    return scanned.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")

