"""Personal data by a skip-chain conditional random field.

Fixed patterns find the plain cases. Tokens with a digit or an at sign are the nodes of a graph: neighbours are linked,
and so is each token to the last one before it, however far, that is the same or similar (same digits at the end, same
name before the at sign). Patterns label some nodes; the field is fitted to these labels over the whole corpus by
pseudo-likelihood, for which the counts of the few different (shape, label, labels of neighbours) are enough. In each
document loopy message passing then carries the evidence along both kinds of links, and nodes that no pattern
labelled get spans where their label is likely: a card that a pattern misses because other digits touch it, or the
second mention of a number.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameyard.llm.common import materialize

#: The kinds, in the order in which spans of one start are listed.
KINDS = ("email", "ip", "card", "phone")
#: Fixed patterns. Runs are taken whole and from their first character, which changes no match and keeps each linear.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Nodes: what stands between these characters, if it has one of MARK.
MARK, BREAK = re.compile("[0-9@]"), frozenset("\"'<>,;|[]{}=:()") | {chr(c) for c in range(33)}
REST = re.compile("[^\\x00-\\x20\"'<>,;|\\[\\]{}=:()]*")
DIGITS = re.compile("[0-9]+")

SHAPES = ("other", "email", "at", "ip", "dotted", "card", "long", "nine", "3-4", "huge", "five", "short", "hex", "mixed")
FLAGS = ("plus", "paren", "assigned")
#: Sweeps of message passing, and the probability from which on a label gives a span.
SWEEPS, SURE = 20, 0.8
#: Fit: steps, their size, and the pull towards where the weights start: no label by PLAIN, equal labels over links by SHARED.
STEPS, RATE, PULL, PLAIN, SHARED = 600, 0.03, 1e-3, 1.0, 3.0
#: Shapes that are plain cases by themselves.
CLEAR = ("email", "ip", "card")
NODES = "starts array<int>, ends array<int>, shapes array<int>, labels array<int>, near array<boolean>, skips array<int>, same array<boolean>, cases array<long>"


def luhn(digits: str) -> bool:
    low = sum(map(int, digits[-1::-2]))
    return (low + sum(2 * d - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        a = at
        while a > end and text[a - 1] in LOCAL:
            a -= 1
        if a < at and (m := DOMAIN.match(text, at + 1)):
            end = m.end()
            yield a, end
        at = text.find("@", max(end, at + 1))


def matches(text: str) -> list[tuple[int, int, int, bool]]:
    """(start, kind, end, whether it passes) of the patterns' matches, in order. Of those that fail only the doubtful are
    listed: with so many digits that those of something else may be among them."""
    out = [(a, 0, b, True) for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end(), True))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12 and len(d := m[0].replace(" ", "").replace("-", "")) >= 12:
            out.append((m.start(), 2, m.end(), len(d) <= 19 and luhn(d)))
    for m in PHONE.finditer(text):
        if (n := sum(map(len, DIGITS.findall(m[0])))) >= 9:
            out.append((m.start(), 3, m.end(), n <= 15))
    return sorted(out)


def _shape(word: str) -> str:
    digits = "".join(DIGITS.findall(word))
    if "@" in word.strip("@"):
        name, _, host = word.partition("@")
        return "email" if name and DOMAIN.fullmatch(host) else "at"
    if len(digits) == len(word.replace("-", "").lstrip("+")):
        n = len(digits)
        if 12 <= n <= 19:
            return "card" if luhn(digits) else "long"
        if n == 7 and len(word) == 8 and word[3] == "-":
            return "3-4"
        return "huge" if n > 19 else "nine" if n >= 9 else "five" if n > 4 else "short"
    if len(digits) == len(word.replace(".", "")):
        parts = word.split(".")
        return "ip" if len(parts) == 4 and all(p and len(p) <= 3 and int(p) <= 255 for p in parts) else "dotted"
    if not digits or not any(c.isalpha() for c in word):
        return "other"
    return "hex" if not word.strip("0123456789abcdefABCDEF") else "mixed"


def _likeness(word: str, shape: str) -> str:
    """What similar tokens share; '' for tokens that say too little."""
    name = "".join(filter(str.isalnum, word.partition("@")[0])).lower()
    if name.isdigit() and shape != "email":
        return name if shape == "ip" else name[-7:] if len(name) >= 7 else ""
    return name if len(name) >= 4 else ""


def nodes(text: str, found: list[tuple[int, int, int, bool]]) -> tuple:
    """The graph of a text and its matches: lists in the order of NODES."""
    starts, ends, shapes, labels, near, skips, same, known = [], [], [], [], [], [], [], []
    last: dict[str, int] = {}
    pos, kinds, at = 0, [[f for f in found if f[1] == k] for k in range(len(KINDS))], [0] * len(KINDS)
    while m := MARK.search(text, pos):
        a = m.start()
        while a > pos and text[a - 1] not in BREAK:
            a -= 1
        pos = b = REST.match(text, m.start()).end()
        while text[b - 1] in ".!?-_":
            b -= 1
        while a < b and text[a] in ".-_":
            a += 1
        if a >= b or not MARK.search(text, a, b):
            continue
        word = text[a:b]
        shape = _shape(word)
        flags = (word[0] == "+") | (text[a - 1 : a] == "(" and text[b : b + 1] == ")") << 1 | (a > 0 and text[a - 1] in "=:\"'") << 2
        over = []
        for k, of_kind in enumerate(kinds):  # matches of a kind do not overlap
            while at[k] < len(of_kind) and of_kind[at[k]][2] <= a:
                at[k] += 1
            over += [f for f in of_kind[at[k] : at[k] + 1] if f[0] < b]
        like = _likeness(word, shape)
        before = last.get(like, -1) if like else -1
        near.append(bool(ends) and len(gap := text[ends[-1] : a]) <= 3 and not gap.strip(" ()-."))
        skips.append(before)
        same.append(before >= 0 and text[starts[before] : ends[before]] == word)
        if like:
            last[like] = len(starts)
        starts.append(a)
        ends.append(b)
        shapes.append(SHAPES.index(shape) * 8 + int(flags))
        labels.append(next((f[1] + 1 for f in over if f[3]), 0))
        # a shape that is plain by itself, or one in a doubtful match: other characters touch it, which says nothing
        known.append(labels[-1] > 0 or not over and SHAPES[shapes[-1] >> 3] not in CLEAR)
    return starts, ends, shapes, labels, near, skips, same, _cases(shapes, labels, near, skips, same, known)


def _cases(shapes, labels, near, skips, same, known) -> list[int]:
    """Each node whose label is known with those of its neighbours as one number, of which a corpus has few: shape, label,
    label to the left and right (5: none), and the labels over the links to the last and next similar node (10: none)."""
    n, left, right, back, ahead = len(shapes), [5] * len(shapes), [5] * len(shapes), [10] * len(shapes), [10] * len(shapes)
    for i in range(n):
        if near[i]:
            left[i], right[i - 1] = labels[i - 1], labels[i]
        if (j := skips[i]) >= 0:
            back[i], ahead[j] = 2 * labels[j] + same[i], 2 * labels[i] + same[i]
    return [((((s * 5 + y) * 6 + a) * 6 + b) * 11 + c) * 11 + d for s, y, a, b, c, d, k in zip(shapes, labels, left, right, back, ahead, known, strict=True) if k]


class Field:
    """Weights: by shape and flag and label, by labels of neighbours (the last row and column, no neighbour, stay 0, so
    that neighbours never seen together say nothing), and for equal labels over links between similar and same tokens."""

    def __init__(self):
        self.unary = np.zeros((len(SHAPES) + len(FLAGS), 5))
        self.unary[: len(SHAPES), 0] = PLAIN
        self.chain, self.skip = np.zeros((6, 6)), np.full((2, 5), SHARED)

    def nodes(self, shapes: np.ndarray) -> np.ndarray:
        out = self.unary[shapes >> 3]
        for f in range(len(FLAGS)):
            out = out + ((shapes >> f) & 1)[:, None] * self.unary[len(SHAPES) + f]
        return out


def fit_field(cases: list[tuple[int, int]]) -> Field:
    """The field that makes the labels most likely given those of their neighbours, from (case, count)."""
    field = Field()
    if not cases:
        return field
    code, count = np.array(sorted(cases), "i8").T
    code, ahead = np.divmod(code, 11)
    code, back = np.divmod(code, 11)
    code, right = np.divmod(code, 6)
    code, left = np.divmod(code, 6)
    shapes, y = np.divmod(code, 5)
    weight = count / count.sum()
    one = np.eye(5)
    flags = np.stack([(shapes >> f) & 1 for f in range(len(FLAGS))], 1).astype("f8")
    x = np.concatenate([np.eye(len(SHAPES))[shapes >> 3], flags], 1)
    links = [np.stack([(v == 2 * k + t).astype("f8") for k in range(5)], 1) for t in (0, 1) for v in (back, ahead)]
    start = [field.unary.copy(), field.chain.copy(), field.skip.copy()]
    mean, square = [np.zeros_like(w) for w in start], [np.zeros_like(w) for w in start]
    for step in range(1, STEPS + 1):
        score = field.nodes(shapes) + field.chain[left, :5] + field.chain[:5, right].T
        for t in (0, 1):
            score = score + (links[2 * t] + links[2 * t + 1]) * field.skip[t]
        p = np.exp(score - score.max(1, keepdims=True))
        off = weight[:, None] * (one[y] - p / p.sum(1, keepdims=True))
        chain = np.zeros((6, 6))
        np.add.at(chain[:, :5], left, off)
        np.add.at(chain[:5].T, right, off)
        chain[5], chain[:, 5] = 0, 0
        skip = np.stack([((links[2 * t] + links[2 * t + 1]) * off).sum(0) for t in (0, 1)])
        for w, g, s, m, v in zip((field.unary, field.chain, field.skip), (x.T @ off, chain, skip), start, mean, square, strict=True):
            g = g - PULL * (w - s)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return field


def label_probabilities(field: Field, shapes, labels, near, skips, same) -> np.ndarray:
    """Marginals of all nodes by loopy message passing; nodes with a pattern's label are evidence. Skips count from the
    first node. Each connected part is by itself, so that several documents at once give what each gives alone."""
    n, at = len(shapes), np.arange(len(shapes))
    theta = np.where((labels > 0)[:, None] & (np.arange(5) != labels[:, None]), -1e3, field.nodes(shapes))
    a, b = np.concatenate([at[near] - 1, skips[skips >= 0]]), np.concatenate([at[near], at[skips >= 0]])
    pair = np.concatenate([np.broadcast_to(field.chain[:5, :5], (near.sum(), 5, 5)), np.eye(5) * field.skip[same[skips >= 0].astype(int)][:, None, :]])
    ahead, back = np.zeros((len(a), 5)), np.zeros((len(a), 5))

    def total():
        return theta + np.stack([np.bincount(b, ahead[:, k], n) + np.bincount(a, back[:, k], n) for k in range(5)], 1)

    def soft(x, axis):
        top = x.max(axis, keepdims=True)
        return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)

    for _ in range(SWEEPS if len(a) else 0):
        belief = total()
        ahead_new, back_new = soft((belief[a] - back)[:, :, None] + pair, 1), soft((belief[b] - ahead)[:, None, :] + pair, 2)
        ahead, back = ahead_new - ahead_new.max(1, keepdims=True), back_new - back_new.max(1, keepdims=True)
    belief = total()
    p = np.exp(belief - belief.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def _graph(rows: DataFrame) -> DataFrame:
    """(doc_id, base, nodes) of (doc_id, text)."""
    schema = f"doc_id long, base array<struct<start: int, kind: int, end: int>>, {NODES}"
    types = [pa.list_(pa.int32())] * 4 + [pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.list_(pa.int64())]
    span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "base", *(c.split()[0] for c in NODES.split(", "))]
        for batch in batches:
            base, graphs = [], []
            for text in batch.column(1).to_pylist():
                found = matches(text) if MARK.search(text) else []
                base.append([{"start": a, "kind": k, "end": b} for a, k, b, good in found if good])
                graphs.append(nodes(text, found))
            columns = list(zip(*graphs, strict=True)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, span), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names)

    return rows.mapInArrow(scan, schema)


def _added(field: Field, batch: pa.RecordBatch, sure: float) -> list[list[dict]]:
    """Spans of the nodes that no pattern labelled, per row of starts, ends, shapes, labels, near, skips, same."""
    starts, ends, shapes, labels, near, skips, same = (c.flatten().to_numpy(zero_copy_only=False) for c in batch.columns)
    sizes = np.diff(batch.column(0).offsets.to_numpy())
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    p = label_probabilities(field, shapes, labels, near, np.where(skips >= 0, skips + first, -1), same)
    kind = p.argmax(1)
    out: list[list[dict]] = [[] for _ in sizes]
    doc, before = np.repeat(np.arange(len(sizes)), sizes), -2
    for i in np.flatnonzero((labels == 0) & (kind > 0) & (p.max(1) >= sure)):
        spans = out[doc[i]]
        if near[i] and before == i - 1 and spans and spans[-1]["kind"] == KINDS[kind[i] - 1] == "phone":
            spans[-1]["end"], spans[-1]["p"] = int(ends[i]), min(spans[-1]["p"], float(p[i].max()))
        else:
            spans.append({"kind": KINDS[kind[i] - 1], "start": int(starts[i]), "end": int(ends[i]), "p": float(p[i].max())})
        before = i
    return out


def pii_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sure: float = SURE) -> DataFrame:
    """One row per row of docs: the counts of the patterns' spans by kind, and all spans with their probability (1 for
    the patterns' own), `base` true for those.

    Offsets are code points, ends exclusive. Null and empty texts have no spans; repeated rows are scanned each; a null
    id stays null; without rows there are none. Where the corpus has no plain case of a kind, nothing is added of it.
    Spans that message passing adds do not touch those of the patterns. Other columns are not read.
    """
    graph = materialize(_graph(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))))
    seen = graph.select(F.explode("cases").alias("case")).groupBy("case").agg(F.count("*").alias("n")).collect()
    field = fit_field([(r["case"], r["n"]) for r in seen])
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64()), ("base", pa.bool_())]))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base = batch.column(1).to_pylist()
            added = _added(field, pa.RecordBatch.from_arrays(batch.columns[2:], batch.schema.names[2:]), sure)
            spans = [
                sorted(
                    [{"kind": KINDS[s["kind"]], "start": s["start"], "end": s["end"], "p": 1.0, "base": True} for s in b] + [s | {"base": False} for s in a],
                    key=lambda s: (s["start"], KINDS.index(s["kind"])),
                )
                for b, a in zip(base, added, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, span)], ["doc_id", "spans"])

    columns = ["doc_id", "base", *(c.split()[0] for c in NODES.split(", "))][:-1]
    out = graph.select(*columns).mapInArrow(decode, "doc_id long, spans array<struct<kind: string, start: long, end: long, p: double, base: boolean>>")
    plain = F.transform(F.filter("spans", lambda s: s["base"]), lambda s: s["kind"])
    counts = ((F.size(plain) - F.size(F.array_remove(plain, k))).cast("long").alias(f"n_{k}") for k in KINDS)
    return out.select("doc_id", *counts, "spans")


def span_list(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
