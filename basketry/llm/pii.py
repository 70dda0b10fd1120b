"""PII spans: candidate generators, gradient-boosted trees, calibrated thresholds.

Base spans (e-mail, IP, card, phone) come from fixed patterns and checks and
always stay. Generators of high recall propose more spans, which may overlap:
written-out addresses, digit groups with other separators, numbers without
their plus sign. Of neighbouring digit groups each run with a fitting number of
digits is proposed, so a number beside a date or another number is there on its
own; of overlapping proposals the one of the best score stays. Boosted regression trees score each proposal from its format
and the characters and words around it; a proposal that no base span meets is
redacted if its score reaches its kind's threshold. Thresholds are calibrated
on held-back rows: the smallest score above which the wanted precision holds.

There are no labels for spans, so the trees learn from a bounded hash sample
of the documents (``sample`` rows): base spans, and the same spans rewritten
in other formats in their own context or beside other numbers, are positive;
proposals that no base span meets, runs of digits that are less or more than
the rewritten number, and base spans spoiled (a wrong check digit, a part over
255, too few digits), are negative. So clean numbers stay clean.

Defined results: a null text counts as empty; a text without spans has the
SHA-256 of the empty string and empty spans; without any base span in the
sample nothing is added; repeated rows come back as often as they came; extra
columns are carried by ``redact`` and named as they were; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import common

KINDS = ("email", "ip", "card", "phone")
# The patterns of the contract; possessive, and for numbers only from the start of a run of digits, so that no run
# is read more than once (a shorter or later part of a run that fails would fail as well).
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

#: Proposals of a text that are scored at a time.
STEP = 4096

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits))))
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping, found from each @ outwards: no run of letters is read twice."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 38 and 16 <= len(d := digits_of(m.group())) <= 19 and luhn(d):
            out.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                out.append((3, *m.span()))
    return out


# Generators of high recall: each names the kind it proposes.
AT = re.compile(r" ?(?:[\[({<] ?(?:at|@) ?[\])}>]|\bat\b|@) ?", re.I)
SPELT_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:(?:\.| ?(?:[\[({<](?:dot|\.)[\])}>]|\bdot\b) ?)[A-Za-z0-9-]+)+", re.I)
QUAD = re.compile(r"(?<![0-9])[0-9]{1,3}(?: ?(?:\.|\[\.\]|\(\.\)|,|:) ?[0-9]{1,3}){3}(?![0-9])")
GROUP = re.compile(r"(?<![0-9A-Za-z])[0-9]{1,19}(?![0-9A-Za-z])")
SEPARATOR = r"\)?[ ./()‐-–-]{1,3}"
GAP = re.compile(SEPARATOR)
CLOSED = re.compile(r"\)(?![0-9A-Za-z])")
OPENED = re.compile(r"(?<![0-9A-Za-z])(?:\+\(?|\()")
DIGIT = re.compile("[0-9]")


def spelt(text: str) -> Iterator[Span]:
    """Addresses written out, from each "at" outwards; runs are read whole, and no run twice."""
    before, known = 0, 0  # the last "at", and where the run of letters that ends there starts
    for m in AT.finditer(text):
        start = m.start()
        while start > before and text[start - 1] in LOCAL:
            start -= 1
        if start == before:
            start = known
        before, known = m.start(), start
        domain = SPELT_DOMAIN.match(text, m.end()) if start < m.start() else None
        if domain:
            yield 0, start, domain.end()


def numbers(text: str) -> Iterator[Span]:
    """Every run of neighbouring digit groups with 7 to 15 (phone) or 13 to 19 (card) digits: at most 19 runs start at a group."""
    groups = [m.span() for m in GROUP.finditer(text)]
    joined = [b - a <= 4 and GAP.fullmatch(text, a, b) is not None for (_, a), (b, _) in zip(groups, groups[1:], strict=False)] + [False]
    for i, (start, _) in enumerate(groups):
        opened = next((at for at in (start - 2, start - 1) if at >= 0 and OPENED.fullmatch(text, at, start)), start)
        n = 0
        for j in range(i, len(groups)):
            a, b = groups[j]
            n += b - a
            if n > 19:
                break
            if j == i and CLOSED.match(text, b):
                b += 1
            if 7 <= n <= 15:
                yield 3, opened, b
            if n >= 13:
                yield 2, opened, b
            if not joined[j]:
                break


def proposed(text: str) -> Iterator[Span]:
    yield from spelt(text)
    if DIGIT.search(text):
        yield from ((1, *m.span()) for m in QUAD.finditer(text))
        yield from numbers(text)


def proposals(text: str) -> list[Span]:
    """Spans that may be personal data, overlapping as they are."""
    return list(proposed(text))


BEFORE, AFTER = re.compile(rf"[0-9]({SEPARATOR})$"), re.compile(rf"({SEPARATOR})[0-9]")
CUES = tuple(map(re.compile, (r"(?i)mail|contact|write", r"(?i)\bip\b|address|host|server", r"(?i)card|visa|credit|account", r"(?i)phone|tel|call|mobile|fax")))


def features(text: str, span: Span) -> list[float]:
    """Format and context of a proposal, as numbers."""
    kind, a, b = span
    s, before, after = text[a:b], text[max(0, a - 24):a], text[b:b + 12]
    d = digits_of(s)
    runs = [len(r) for r in re.findall("[0-9]+", s)]
    words = re.findall("[A-Za-z]+", s)
    gaps = set(re.findall("(?<=[0-9])[^0-9]+(?=[0-9])", s))
    left, right = BEFORE.search(before[-5:]), AFTER.match(after)
    return [
        kind, len(s), len(d), len(d) / max(1, len(s)), len(runs), max(runs, default=0), min(runs, default=0),
        float(13 <= len(d) <= 19 and luhn(d)), float(all(int(r[:4]) <= 255 for r in re.findall("[0-9]+", s))),
        s.count("."), s.count("-"), s.count(" "), float("(" in s), float(s[:1] == "+"), float("@" in s),
        float(bool(re.search(r"(?i)[\[({<]at[\])}>]", s))), float(bool(re.search(r"(?i)\bat\b", s))), float(bool(re.search(r"(?i)[\[({<]dot[\])}>]|\bdot\b", s))),
        len(words[-1]) if words else 0, max(map(len, words), default=0),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(before[-1:] in ("", " ", "\n")),
        *(float(bool(c.search(before))) for c in CUES),
        len(gaps), float(bool(left)), float(bool(right)), float(bool(left) and left[1] in gaps), float(bool(right) and right[1] in gaps),
    ]


def rewrites(text: str, span: Span) -> list[tuple[str, Span, int]]:
    """The text with a base span in another format (label 1) or spoiled (label 0)."""
    kind, a, b = span
    s, d = text[a:b], digits_of(text[a:b])
    if kind == 0:
        name, _, domain = s.partition("@")
        new = [(f"{name} [at] {domain.replace('.', ' [dot] ')}", 1), (f"{name} at {domain.replace('.', ' dot ')}", 1),
               (f"{name}(at){domain}", 1), (f"{name} at {domain.split('.')[0]}", 0), (f"{name[-2:]} at the. {domain[:4]}", 0)]
    elif kind == 1:
        p = s.split(".")
        new = [("[.]".join(p), 1), (" . ".join(p), 0), (", ".join(p), 0), (".".join([p[0], p[1], p[2], str(int(p[3]) + 256)]), 0), (":".join(p), 0)]
    elif kind == 2:
        four = [d[i:i + 4] for i in range(0, len(d), 4)]
        bad = d[:-1] + str((int(d[-1]) + 5) % 10)
        new = [(".".join(four), 1), ("/".join(four), 1), (bad, 0), (" ".join(bad[i:i + 4] for i in range(0, 16, 4)), 0), (d[:14], 0)]
    else:
        rest = d[1:]
        new = [(f"00{d[0]} {rest[:3]} {rest[3:6]} {rest[6:]}", 1), (f"({rest[:3]}) {rest[3:6]}-{rest[6:]}", 1), (f"{d[0]}-{rest[:3]}-{rest[3:6]}-{rest[6:]}", 1),
               (rest, 0), (f"{rest[:3]} {rest[3:]}", 0), (f"{d[:4]}-{d[4:6]}-{d[6:8]}", 0)]
    front, back = text[max(0, a - 30):a], text[b:b + 20]
    beside = [("", "", v, y) for v, y in new]
    if kind > 1:
        beside += [(left, right, v, 1) for v, y in new if y for left, right in (("", " 12/27"), ("2024-01-02 ", ""), ("", f" {v}"))]
    return [(front + left + v + right + back, (kind, len(front + left), len(front + left + v)), y) for left, right, v, y in beside]


def examples(text: str) -> list[tuple[list[float], int]]:
    """Labelled proposals of one text: see the module's text."""
    base, out = base_spans(text), []
    for kind, a, b in base:
        out.append((features(text, (kind, a, b)), 1))
        for new, (_, s, e), y in rewrites(text, (kind, a, b)):
            for p in proposals(new):
                if p[1] < e and p[2] > s and (kind > 1 < p[0] or p[1] >= s - 1 and p[2] <= e + 1):
                    whole = kind < 2 or s - 1 <= p[1] and p[2] <= e + 1 and digits_of(new[p[1]:p[2]]) == digits_of(new[s:e])
                    out.append((features(new, p), int(y and p[0] == kind and whole)))
    out += [(features(text, p), 0) for p in proposals(text) if not any(p[1] < e and p[2] > s for _, s, e in base)]
    return out


class Trees:
    """Gradient-boosted regression trees of a fixed depth for a yes or no."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.3):
        self.depth, self.rate, self.trees = depth, rate, []
        p = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
        self.start = float(np.log(p / (1 - p)))
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0.03, 0.97, 24))) for j in range(x.shape[1])]
        score = np.full(len(y), self.start)
        for _ in range(rounds):
            q = 1 / (1 + np.exp(-score))
            tree = self._grow(x, y - q, q * (1 - q) + 1e-6)
            self.trees.append(tree)
            score += rate * self._tree(tree, x)

    def _grow(self, x: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        inner = (1 << self.depth) - 1
        feature, cut, leaf = np.zeros(inner, dtype=int), np.full(inner, np.inf), np.zeros(inner + 1)
        node = np.zeros(len(g), dtype=int)
        for k in range(inner):
            mine = node == k
            if mine.sum() > 4:
                best = 1e-6
                for j, cuts in enumerate(self.cuts):
                    v, gg, hh = x[mine, j], g[mine], h[mine]
                    for c in cuts:
                        low = v <= c
                        a, b = hh[low].sum() + 1, hh[~low].sum() + 1
                        ga, gb = gg[low].sum(), gg[~low].sum()
                        gain = ga * ga / a + gb * gb / b - (ga + gb) ** 2 / (a + b - 1)
                        if gain > best:
                            best, feature[k], cut[k] = gain, j, c
            node[mine] = 2 * k + 1 + (x[mine, feature[k]] > cut[k])
        for k in range(inner + 1):
            mine = node == inner + k
            leaf[k] = g[mine].sum() / (h[mine].sum() + 1)
        return feature, cut, leaf

    def _tree(self, tree: tuple, x: np.ndarray) -> np.ndarray:
        feature, cut, leaf = tree
        node = np.zeros(len(x), dtype=int)
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
        return leaf[node - len(feature)]

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for t in self.trees:
            total += self.rate * self._tree(t, x)
        return 1 / (1 + np.exp(-total))


class Detector:
    """Base spans and the proposals that reach their kind's threshold."""

    def __init__(self, x: np.ndarray, y: np.ndarray, precision: float = 0.99):
        self.trees, self.thresholds = None, [2.0] * len(KINDS)
        held = np.arange(len(y)) % 3 == 2
        if not y.any() or y.all() or not (held & (y == 1)).any():
            return
        self.trees = Trees(x[~held], y[~held])
        s = self.trees.scores(x[held])
        for k in range(len(KINDS)):
            mine = x[held][:, 0] == k
            self.thresholds[k] = threshold(s[mine], y[held][mine], precision)

    def added(self, text: str, base: list[Span]) -> list[Span]:
        if self.trees is None:
            return []
        taken: list[tuple[int, int]] = []
        for _, a, b in sorted(base, key=lambda b: b[1]):
            if taken and a < taken[-1][1]:
                taken[-1] = taken[-1][0], max(b, taken[-1][1])
            else:
                taken.append((a, b))
        free = (p for p in proposed(text) if not meets(taken, p))
        good: list[tuple[float, Span]] = []
        while part := list(islice(free, STEP)):
            s = self.trees.scores(np.array([features(text, p) for p in part]))
            good += [(v, p) for v, p in zip(s.tolist(), part, strict=True) if v >= self.thresholds[p[0]]]
        out: list[Span] = []
        for _, p in sorted(good, key=lambda g: -g[0]):
            if not meets(taken, p):
                out.append(p)
                taken.insert(bisect_left(taken, p[1:]), p[1:])
        return out

    def spans(self, text: str | None) -> tuple[list[Span], list[Span]]:
        """Base spans and all spans, each by kind, then start."""
        base = base_spans(text or "")
        return base, sorted(base + self.added(text or "", base))


def meets(taken: list[tuple[int, int]], span: Span) -> bool:
    """If the span overlaps one of some disjoint, sorted places."""
    i = bisect_left(taken, (span[2],)) - 1
    return i >= 0 and taken[i][1] > span[1]


def threshold(scores: np.ndarray, labels: np.ndarray, precision: float) -> float:
    """The smallest score from which on at least ``precision`` of the rows are positive; over 1 if none."""
    order = np.argsort(-scores, kind="stable")
    hits = np.cumsum(labels[order])
    right = hits / np.arange(1, len(order) + 1)
    good = np.flatnonzero((right >= precision) & (np.append(scores[order][1:], -1) < scores[order]))
    return max(0.5, float(scores[order][good[-1]])) if good.size and hits[good[-1]] >= 10 else 2.0


def train(docs: DataFrame, sample: int = 4000, most_examples: int = 6_000) -> Detector:
    """Fit on a hash sample of about ``sample`` documents; at most ``most_examples`` labelled proposals of it."""
    n = docs.count()
    share = int(min(1.0, sample / max(1, n)) * (1 << 20))
    chosen = docs.select("text").where("text is not null").where(F.pmod(F.xxhash64(F.lit("sample"), "text"), F.lit(1 << 20)) < share)

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            found = [e for t in b.column("text").to_pylist() for e in examples(t)]
            yield common.batch_of({"x": [f for f, _ in found], "y": [y for _, y in found]}, {"x": pa.list_(pa.float64()), "y": pa.int32()})

    found = common.arrow_pass(chosen, run, "x array<double>, y int")
    rows = found.orderBy(F.xxhash64("x"), "y").limit(most_examples).collect()
    if not rows:
        return Detector(np.zeros((0, 1)), np.zeros(0, dtype=int))
    return Detector(np.array([r.x for r in rows]), np.array([r.y for r in rows]))


def listing(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find_pii(docs: DataFrame, detector: Detector) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all), n_added."""
    types = {"doc_id": pa.int64()} | {f"n_{k}": pa.int64() for k in KINDS} | {"base_sha256": pa.string(), "spans": pa.string(), "n_added": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            out: dict = {k: [] for k in types}
            out["doc_id"] = b.column("doc_id")
            for t in b.column("text").to_pylist():
                base, every = detector.spans(t)
                for k, name in enumerate(KINDS):
                    out[f"n_{name}"].append(sum(s[0] == k for s in base))
                out["base_sha256"].append(hashlib.sha256(listing(base).encode()).hexdigest())
                out["spans"].append(listing(every))
                out["n_added"].append(len(every) - len(base))
            yield common.batch_of(out, types)

    return common.arrow_pass(docs.select(F.col("doc_id").cast("long"), "text"), run,
                             "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def redacted(text: str | None, spans: list[Span]) -> str | None:
    """The text with each span (overlapping ones merged) replaced by the name of its first kind."""
    if not spans or text is None:
        return text
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{KINDS[kind].upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, detector: Detector | None = None) -> DataFrame:
    """The documents with all spans redacted in ``text``; n_chars, where there is one, counts the new text."""
    own = detector or train(docs)
    text_at, schema = docs.columns.index("text"), docs.schema
    count_at = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            old = b.column(text_at).to_pylist()
            new = [redacted(t, own.spans(t)[1]) for t in old]
            columns = list(b.columns)
            columns[text_at] = pa.array(new, type=b.column(text_at).type)
            if count_at is not None:
                columns[count_at] = pa.array([len(v) if v != t and n is not None else n for v, t, n in zip(new, old, b.column(count_at).to_pylist(), strict=True)],
                                             type=b.column(count_at).type)
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    return common.arrow_pass(docs, run, schema)
