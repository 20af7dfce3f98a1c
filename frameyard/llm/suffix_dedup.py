"""Removal of long repeated byte strings by suffix sorting.

A byte string of `length` bytes is selected by the least hash among its inner grams (winnowing), so equal strings meet
under one gram. The different stretches of text around a gram are gathered, cut into tokens at places that only the
symbols beside them decide, and their suffixes sorted by linear grouping: groups of suffixes with equal longest Lyndon
prefix are processed in descending order, each passing its members' previous-smaller pointers on to refine the groups
below it; then the order inside each group is emitted from the order of the groups, without renaming or recursion. Runs
of long common prefixes in that order, refined to the left symbol by symbol, are the repeated strings. A gram with more
stretches than one task should sort is cut into longer grams and goes through the same once more.

The same is done over words: passages of more than 50 words that stand elsewhere too, shorter than `length` bytes or
not, are reported beside what is removed.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameyard.llm.common import bounded_broadcast, materialize, release
from frameyard.llm.shingles import _powers, mix, word_hashes

LENGTH, GRAM = 400, 96
PASSAGE, PASSAGE_GRAM = 51, 12
BYTES, WORDS = 0, 1
#: Different stretches under one gram that one task sorts; beyond, the gram is cut into longer ones.
GROUP = 4000
SEGMENT = 4 << 20
_LOW = np.uint64((1 << 24) - 1)


def _grams(symbols: np.ndarray, gram: int) -> np.ndarray:
    """A hash of every gram of a sequence of hashed symbols."""
    n = len(symbols)
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, "u8")
    np.cumsum(symbols * up[:n], out=total[1:])
    return mix((total[gram:] - total[:-gram]) * down[: n - gram + 1])


def _select(symbols: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, a, b): the selected gram of the strings that start from a to b, in order; every start is in one."""
    g = _grams(symbols, gram)
    m, w, starts = len(g), length - gram + 1, len(symbols) - length + 1
    x = np.full(-(-m // w) * w, ~np.uint64(0))
    x[:m] = (g & ~_LOW) | np.arange(m, dtype="u8")  # the leftmost of equal grams
    rows = x.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, 1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    chosen = (np.minimum(behind[:starts], ahead[w - 1 : w - 1 + starts]) & _LOW).astype("i8")
    first = np.flatnonzero(np.diff(chosen, prepend=-1))
    return g[chosen[first]], first, np.append(first[1:], starts) - 1


_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def word_places(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the words of a text."""
    edge = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[np.frombuffer(raw, "u1")], [True]))))
    return edge[::2], edge[1::2]


def select_grams(raw: bytes, length: int = LENGTH, gram: int = GRAM, unit: int = BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, a, e): for each selected gram the bytes from a to e that its strings of `length` symbols span. Words are
    taken with A-Z lower-cased. The lowest bit of a hash is its unit."""
    out = [(np.zeros(0, "u8"), np.zeros(0, "i8"), np.zeros(0, "i8"))]
    if unit == WORDS:
        if len(raw) < 2 * length - 1:
            return out[0]
        start, end = word_places(raw)
        symbols = word_hashes(raw) if len(start) >= length else start
    for at in range(0, (len(symbols) if unit == WORDS else len(raw)) - length + 1, SEGMENT):
        if unit == WORDS:
            h, a, b = _select(symbols[at : at + SEGMENT + length - 1], length, gram)
            out.append((h, start[a + at], end[b + at + length - 1]))
        else:
            part = np.frombuffer(raw, "u1", count=min(len(raw) - at, SEGMENT + length - 1), offset=at)
            h, a, b = _select(part.astype("u8") + np.uint64(1), length, gram)
            out.append((h, a + at, b + at + length))
    h, a, e = (np.concatenate(c) for c in zip(*out, strict=True))
    return (h & ~np.uint64(1)) | np.uint64(unit), a, e


def suffix_order(s: list[int]) -> list[int]:
    """Suffix array of s, whose last item is its only smallest."""
    n = len(s)
    count = Counter(s)
    start, at = {}, 0
    for c in sorted(count):
        start[c] = at
        at += count[c]
    group = [start[c] for c in s]  # a group is named by its first place
    place, order, fill = [0] * n, [0] * n, dict(start)
    for i, c in enumerate(s):
        p = fill[c]
        order[p], place[i] = i, p
        fill[c] = p + 1
    size = {start[c]: count[c] for c in count}
    prev = [-1] * n
    high = n
    while high > 0:
        name = group[order[high - 1]]
        members = order[name:high]
        if len(members) > 1:
            members.sort()
        high = name
        counts: dict[int, int] = {}
        for i in members:  # the nearest suffix before it that is in a lower group
            p = i - 1
            while p >= 0 and group[p] >= name:
                p = prev[p]
            prev[i] = p
            if p >= 0:
                counts[p] = counts.get(p, 0) + 1
        if not counts:
            continue
        levels: dict[int, list[int]] = {}
        for p, c in counts.items():
            levels.setdefault(c, []).append(p)
        for c in sorted(levels, reverse=True):
            moved: dict[int, list[int]] = {}
            for p in levels[c]:
                moved.setdefault(group[p], []).append(p)
            for old, ps in moved.items():  # they become a group right above what is left of theirs
                k = size[old]
                if len(ps) == k:
                    continue
                new = old + k - len(ps)
                end = old + k - 1
                for p in ps:
                    q, r = order[end], place[p]
                    order[end], place[p], order[r], place[q] = p, end, q, r
                    end -= 1
                    group[p] = new
                size[old], size[new] = k - len(ps), len(ps)
    out, done = [0] * n, [False] * n
    nxt = {g: g for g in size}
    out[0], done[n - 1] = n - 1, True
    for i in range(n):
        p = out[i] - 1
        while p >= 0 and not done[p]:
            g = group[p]
            out[nxt[g]] = p
            nxt[g] += 1
            done[p] = True
            p = prev[p]
    return out


#: Places between two bytes that part tokens: about one pair in 24. Words part by themselves, about one in 8.
_PAIR = (np.arange(65536, dtype="u8") * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(24) == 0


def _cuts(t: np.ndarray) -> np.ndarray:
    """Inner places before which a token begins; only the symbols beside them decide."""
    if t.dtype == np.uint8:
        return np.flatnonzero(_PAIR[t[:-1].astype("i4") * 256 + t[1:]]) + 1
    return np.flatnonzero(mix(t[1:].astype("u8")) % np.uint64(8) == 0) + 1


def _common(flat: np.ndarray, at: np.ndarray, left: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of each place's symbols with those of the place before it, `most` at most."""
    out = np.zeros(len(at), "i8")
    step = max(1, 4_000_000 // most)
    for k in range(1, len(at), step):
        a, b = at[k - 1 : k - 1 + step][: len(at) - k], at[k : k + step]
        differ = flat[a[:, None] + np.arange(most)] != flat[b[:, None] + np.arange(most)]
        n = np.where(differ.any(1), differ.argmax(1), most)
        out[k : k + step] = np.minimum(n, np.minimum(left[k - 1 : k - 1 + step][: len(n)], left[k : k + step]))
    return out


def repeated_starts(texts: list[np.ndarray | bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each text, bytes or an array of symbols, which of its strings of `length` symbols (by start) stand elsewhere
    in texts, itself included."""
    texts = [np.frombuffer(t, "u1") if isinstance(t, bytes) else t for t in texts]
    size = np.array([len(t) for t in texts], "i8")
    base = np.concatenate(([0], np.cumsum(size)))
    flat = np.concatenate([*texts, np.zeros(length, texts[0].dtype if texts else "u1")])
    marks = np.zeros(len(flat), bool)
    tokens: list[bytes] = []
    at: list[np.ndarray] = []  # place of the boundary in flat, or -1 for the end of a text
    back: list[np.ndarray] = []  # symbols back to the one before it
    plain: dict[bytes, list[int]] = {}
    for x, t in enumerate(texts):
        inner = _cuts(t)
        cuts = [0, *inner.tolist(), len(t)]
        tokens += [t[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False) if b > a] + [b""]
        begin = np.array(cuts[:-1] if len(t) else [], "i8")
        at += [begin + base[x], np.array([-1])]
        back += [np.diff(begin, prepend=0) if len(begin) else begin, np.array([0])]
        # strings without an inner boundary: low in variety, compared as they are
        wide = np.flatnonzero(np.diff(np.array(cuts)) >= length)
        for c in wide:
            for p in range(cuts[c], cuts[c + 1] - length + 1):
                plain.setdefault(t[p : p + length].tobytes(), []).append(int(base[x]) + p)
    for hits in plain.values():
        if len(hits) > 1:
            marks[hits] = True
    # numbers in the order of the tokens' symbols; separators are all different and below them, the last the smallest
    number = {t: i for i, t in enumerate(sorted({*tokens} - {b""}))}
    seq, stop = [], 0
    for t in tokens:
        stop -= not t
        seq.append(number[t] if t else stop)
    order = np.array(suffix_order(seq) if seq else [], "i8")
    at, back = (np.concatenate([np.zeros(0, "i8"), *c])[order] for c in (at, back))
    text = np.searchsorted(base, at, "right") - 1
    left = np.where(at >= 0, base[text + 1] - at, 0) if len(at) else at
    on = (back > 0) & (left >= length - back)
    at, back, left = at[on], np.minimum(back[on], length - 1), left[on]
    lcp = _common(flat, at, left, length)
    # strings whose first inner boundary lies d symbols in: equal d symbols before it, in one run of long common parts
    kind, alive = np.zeros(len(at), "i8"), np.arange(len(at))
    for d in range(1, length):
        alive = alive[back[alive] >= d]
        if len(alive) < 2:
            break
        _, got, often = np.unique((kind[alive] << 32) + flat[at[alive] - d], return_inverse=True, return_counts=True)
        kind[alive] = got
        alive = alive[often[got] > 1]  # what differs here differs for every longer d
        fits = alive[left[alive] >= length - d]
        run = np.cumsum(lcp < length - d)
        _, got, often = np.unique(kind[fits] * (len(at) + 1) + run[fits], return_inverse=True, return_counts=True)
        marks[at[fits[often[got] > 1]] - d] = True
    return [marks[a : a + max(0, n - length + 1)] for a, n in zip(base[:-1], size, strict=True)]


def _runs(mask: np.ndarray, add: int) -> list[tuple[int, int]]:
    """Maximal runs of a mask as (first, last + add)."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False]))))
    return [(int(a), int(b) - 1 + add) for a, b in zip(edge[::2], edge[1::2], strict=True)]


def repeated_spans(raws: list[bytes], length: int, unit: int) -> list[list[tuple[int, int]]]:
    """Of each text the bytes (first, end) of its runs of repeated strings of `length` bytes or words."""
    if unit == BYTES:
        return [_runs(m, length) for m in repeated_starts(raws, length)]
    number: dict[bytes, int] = {}
    texts = [np.array([number.setdefault(w, len(number)) for w in r.lower().split()], "u4") for r in raws]
    out = []
    for r, m in zip(raws, repeated_starts(texts, length), strict=True):
        start, end = word_places(r)
        out.append([(int(start[a]), int(end[b - 1])) for a, b in _runs(m, length)])
    return out


#: Symbols of a string and of a gram, by unit.
Rules = dict[int, tuple[int, int]]


def _stretches(docs: DataFrame, rules: Rules) -> DataFrame:
    """(key, h, ctx, a, e) for every selected gram of every text; ctx is a digest of the bytes that its strings span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list[np.ndarray]] = [[np.zeros(0, "i8")] for _ in range(5)]
            for n, t in enumerate(batch.column(1)):
                raw = t.as_py()
                for unit, (length, gram) in rules.items():
                    h, a, e = select_grams(raw, length, gram, unit)
                    ctx = np.fromiter((xxhash.xxh3_64_intdigest(raw[i:j]) for i, j in zip(a.tolist(), e.tolist(), strict=True)), "u8", len(a))
                    for c, v in zip(cols, (np.full(len(a), n, "i8"), h.view("i8"), ctx.view("i8"), a, e), strict=True):
                        c.append(v)
            row, *values = map(np.concatenate, cols)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), *map(pa.array, values)], names=["key", "h", "ctx", "a", "e"])

    return docs.mapInArrow(run, "key binary, h long, ctx long, a long, e long")


def _contents(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h, ctx, content) of the wanted (key, h, ctx, a, e), cut out of the texts."""
    lists = wanted.groupBy(F.col("key").alias("k")).agg(F.collect_list(F.struct("h", "ctx", "a", "e")).alias("cuts"))  # as long as a text at most
    joined = docs.join(bounded_broadcast(materialize(lists), 20_000).hint("shuffle_hash"), F.col("key") == F.col("k")).select("text", "cuts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, ctx, content = [], [], []
            for t, cuts in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                raw = t.as_py()
                for c in cuts:
                    h.append(c["h"])
                    ctx.append(c["ctx"])
                    content.append(raw[c["a"] : c["e"]])
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(ctx, pa.int64()), pa.array(content, pa.binary())], names=["h", "ctx", "content"])

    return joined.mapInArrow(run, "h long, ctx long, content binary")


SPANS = "h long, ctx long, spans array<struct<s: long, e: long>>"


def _sorted_spans(contents: DataFrame, buckets: int, rules: Rules) -> DataFrame:
    """(h, ctx, spans): the repeated strings of each stretch, as runs of bytes counted from its begin."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["h", "ctx"])  # a text that stands in several rows was cut for each
        unit, spans = pdf["h"].to_numpy() & 1, [[] for _ in range(len(pdf))]
        for u, (length, _) in rules.items():
            here = np.flatnonzero(unit == u)
            for i, found in zip(here.tolist(), repeated_spans(pdf["content"].iloc[here].tolist(), length, u), strict=True):
                spans[i] = [{"s": s, "e": e} for s, e in found]
        return pd.DataFrame({"h": pdf["h"], "ctx": pdf["ctx"], "spans": spans})

    return contents.groupBy(F.pmod(F.xxhash64("h"), F.lit(buckets)).alias("bucket")).applyInPandas(run, SPANS)


def _key(text):
    return F.unhex(F.md5(text))


def find_repeats(docs: DataFrame, rules: Rules) -> DataFrame:
    """(key, spans): runs of repeated bytes of each text that has any, with their unit; docs: (key, text), the key a
    digest of the text. Equal texts count by their number."""
    rows = materialize(_stretches(docs, rules))
    grams = rows.groupBy("h").agg(F.count("*").alias("n"), F.min("ctx").alias("lo"), F.max("ctx").alias("hi")).where("n > 1")
    grams = materialize(grams.select("h", (F.col("lo") == F.col("hi")).alias("same")))
    hits = materialize(rows.join(bounded_broadcast(grams), "h"))
    release(rows)
    # one stretch and no other under the gram: nothing to sort, each of its strings stands wherever the gram does
    same = hits.where("same").select("key", F.col("h").bitwiseAND(1).alias("u"), F.col("a").alias("s"), "e")
    kinds = materialize(hits.where("not same").groupBy("h", "ctx").agg(F.count("*").alias("n"), F.min(F.struct("key", "a", "e")).alias("at")))
    longer = {u: (length, gram + max(1, (length - gram) // 2)) for u, (length, gram) in rules.items() if gram < length}  # up to the strings themselves
    big = kinds.groupBy("h").agg(F.count("*").alias("kinds")).where((F.col("kinds") > GROUP) & F.col("h").bitwiseAND(1).isin(*longer))
    big = materialize(big.select("h"))
    # where every stretch of a gram stands twice, all strings do; the others are sorted
    open_ = kinds.groupBy("h").agg(F.min("n").alias("least")).where("least = 1").select("h")
    contents = materialize(_contents(docs, kinds.join(open_, "h", "left_semi").select("at.key", "h", "ctx", "at.a", "at.e")))
    n_big = big.count()
    small = contents.join(bounded_broadcast(big, counted=n_big), "h", "left_anti") if n_big else contents
    spans = _sorted_spans(small, max(16, kinds.count() // 2000), rules)
    if n_big:
        hot = materialize(contents.dropDuplicates(["h", "ctx"]).join(bounded_broadcast(big, counted=n_big), "h", "left_semi").withColumn("key", _key(F.col("content"))))
        for u, rule in longer.items():
            own = hot.where(F.col("h").bitwiseAND(1) == u)
            if own.limit(1).count():
                inner = find_repeats(own.select("key", F.col("content").alias("text")), {u: rule})
                spans = spans.unionByName(own.join(inner, "key").select("h", "ctx", F.transform("spans", lambda p: F.struct(p["s"].alias("s"), p["e"].alias("e"))).alias("spans")))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("s"), F.lit(1 << 40).cast("long").alias("e")))
    found = kinds.select("h", "ctx", "n").join(spans, ["h", "ctx"], "left").withColumn("spans", F.when(F.col("n") > 1, whole).otherwise(F.col("spans")))
    found = bounded_broadcast(materialize(found.where(F.size("spans") > 0).select("h", "ctx", "spans")), 20_000)
    mixed = (
        hits.where("not same").select("key", "h", "ctx", "a", "e").distinct().join(found, ["h", "ctx"])
        .select("key", F.col("h").bitwiseAND(1).alias("u"), "a", F.col("e").alias("end"), F.explode("spans").alias("p"))
        .select("key", "u", (F.col("a") + F.col("p.s")).alias("s"), F.least(F.col("a") + F.col("p.e"), F.col("end")).alias("e"))
    )
    return same.distinct().unionByName(mixed).groupBy("key").agg(F.collect_list(F.struct("u", "s", "e")).alias("spans"))  # as long as a text at most


def _merged(spans: list[tuple[int, int]], raw: bytes, unit: int) -> list[tuple[int, int]]:
    """The spans as maximal runs; between runs of words only white space may stand."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and (s <= out[-1][1] or unit == WORDS and not raw[out[-1][1] : s].strip()):
            out[-1] = out[-1][0], max(out[-1][1], e)
        else:
            out.append((s, e))
    return out


OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, n_passages long, passage_bytes long"


def suffix_dedup(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", passage: int = PASSAGE, with_kept: bool = True) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes; null without
    with_kept), and n_passages and passage_bytes: maximal runs of words covered by strings of `passage` words that stand elsewhere, and
    their bytes, removed or not.

    A byte goes if a string of `length` bytes that covers it also starts anywhere else in docs, the same text and
    repeated rows included. Null or empty text: no bytes, the digest of nothing. Texts shorter than `length` stay
    whole. A null id stays null; other columns are not read. kept may end inside a character.
    """
    rules = {BYTES: (length, min(GRAM, length)), WORDS: (passage, min(PASSAGE_GRAM, passage))}
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), _key(text).alias("key"), text.alias("text"))
    least = min(length, 2 * passage - 1)
    spans = bounded_broadcast(materialize(find_repeats(rows.where(F.octet_length("text") >= least).select("key", "text"), rules).withColumnRenamed("key", "k")), 20_000)
    joined = rows.join(spans.hint("shuffle_hash"), F.col("key") == F.col("k"), "left").select("doc_id", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, removed, runs, digest, kept, passages, covered = [], [], [], [], [], [], []
            for t, spans in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                raw = t.as_py()
                by = {u: _merged([(p["s"], p["e"]) for p in spans or () if p["u"] == u], raw, u) for u in (BYTES, WORDS)}
                out, at = [], 0
                for s, e in by[BYTES]:
                    out.append(raw[at:s])
                    at = e
                left = b"".join([*out, raw[at:]])
                size.append(len(raw))
                removed.append(len(raw) - len(left))
                runs.append(len(by[BYTES]))
                digest.append(hashlib.sha256(left).hexdigest())
                kept.append(left if with_kept else None)
                passages.append(len(by[WORDS]))
                covered.append(sum(e - s for s, e in by[WORDS]))
            longs = [pa.array(c, pa.int64()) for c in (size, removed, runs)]
            rest = [pa.array(digest, pa.string()), pa.array(kept, pa.binary()), pa.array(passages, pa.int64()), pa.array(covered, pa.int64())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "n_passages", "passage_bytes"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *longs, *rest], names=names)

    return joined.mapInArrow(cut, OUT)
