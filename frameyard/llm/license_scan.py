"""License scans: fuzzy search for short notices.

Each notice phrase may be met with a bounded number of edits. By the pigeonhole principle a phrase cut into
k + 1 pieces keeps one piece intact under k edits, so exact piece hits (bytes.find) locate candidate windows and
the regex library's bounded-error matching verifies the edits and gives the span.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The base phrases and their labels.
BASE = {b"gnu general public license": "gpl", b"apache license": "apache", b"cc by": "cc-by", b"mit license": "mit"}
#: phrase, label, edits allowed. "cc by" is too short for any edit.
NOTICES = (
    (b"gnu general public license", "gpl", 2),
    (b"apache license", "apache", 1),
    (b"mit license", "mit", 1),
    (b"mozilla public license", "mpl", 2),
    (b"bsd license", "bsd", 1),
    (b"creative commons attribution", "cc-by", 2),
)
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans array<struct<label: string, first_word: long, last_word: long, edits: int>>"
)
ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("spans", pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32())]))),
])


def pieces(phrase: bytes, edits: int) -> list[tuple[int, bytes]]:
    """The phrase cut into edits + 1 pieces of about equal length, with their offsets."""
    cut = [round(i * len(phrase) / (edits + 1)) for i in range(edits + 2)]
    return [(a, phrase[a:b]) for a, b in zip(cut, cut[1:], strict=False)]


def _plan(notices):
    return [
        (p, label, k, pieces(p, k), regex.compile(rb"(?b)(?<=\x20)(?:" + regex.escape(p) + rb"){e<=%d}(?=\x20)" % k))
        for p, label, k in notices
    ]


def _find_all(text: bytes, needle: bytes) -> Iterator[int]:
    at = text.find(needle)
    while at >= 0:
        yield at
        at = text.find(needle, at + 1)


def _matches(pattern, canon: bytes, at: int, to: int) -> Iterator:
    """Matches of a best-match pattern within [at, to), in order: the best one, and those before and behind it."""
    todo = [(at, to, None)]
    while todo:
        at, to, found = todo.pop()
        if found:
            yield found
        elif m := pattern.search(canon, at, to):
            todo += [(m.end(), to, None), (at, to, m), (at, m.start(), None)]


def fuzzy_matches(canon: bytes, plan) -> Iterator[tuple[int, int, str, int, int]]:
    """(start, end, label, edits, phrase length) of notices in words joined and surrounded by single spaces."""
    for phrase, label, k, seeds, pattern in plan:
        hits = sorted(at - off for off, seed in seeds for at in _find_all(canon, seed))
        last = -1
        while hits:
            lo = hi = hits[0]
            n = 1
            while n < len(hits) and hits[n] <= hi + len(phrase) + 2 * k + 2:  # windows that touch are one
                hi = hits[n]
                n += 1
            hits = hits[n:]
            at = max(0, last, lo - k - 1)
            to = min(len(canon), hi + len(phrase) + k + 1)
            for m in _matches(pattern, canon, at, to):
                yield m.start(), m.end(), label, sum(m.fuzzy_counts), len(phrase)
                last = m.end()


def scan_text(raw: bytes | None, plan) -> tuple:
    words = WORD.findall((raw or b"").lower())
    canon = b" " + b" ".join(words) + b" "
    word_at = lambda p: canon.count(b" ", 0, p) - 1  # noqa: E731  the word that starts at p
    starts, base = [], set()
    for phrase, label in BASE.items():
        for at in _find_all(canon, b" " + phrase + b" "):
            starts.append(word_at(at + 1))
            base.add(label)
    labels, spans, score = set(base), [], 1.0 if base else 0.0
    for a, b, label, edits, size in fuzzy_matches(canon, plan):
        labels.add(label)
        score = max(score, 1 - edits / size)
        spans.append({"label": label, "first_word": word_at(a), "last_word": word_at(b) - 1 if canon[b - 1 : b] == b" " else word_at(b), "edits": edits})
    return (
        len(words), len(starts), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(base)), ",".join(sorted(labels)), score, spans,
    )


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices=NOTICES) -> DataFrame:
    """One row per row of docs: word count, places of the base phrases, labels, score, and the spans found.

    Null or empty text: no words, empty label strings, score 0, null first_word and last_word. Repeated rows are
    scanned each; a null id stays null; other columns of docs, whatever their names, are not read.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = _plan(notices)
        for batch in batches:
            got = [scan_text(t.as_py(), plan) for t in batch.column(1)]
            cols = list(zip(*got, strict=True)) if got else [[] for _ in range(8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, type=f.type) for c, f in zip(cols, list(ARROW)[1:], strict=True))], schema=ARROW
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(scan, SCHEMA)
