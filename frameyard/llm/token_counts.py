"""Token counts at every prefix of a text, for a sentencepiece BPE vocabulary.

No piece of the vocabulary holds a space mark after another character or a line feed, so a text falls into units
(space marks with what follows them) that are tokenized independently. Inside a unit, dynamic programming over its
prefixes keeps the last token of each prefix: the encoding of a prefix is the encoding of a shorter prefix and one
more token, and that token is the one that the encoder leaves beside the shorter prefix's last token unmerged.
Counts of units add up, so the table of a text answers what a truncation keeps or where a budget ends.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
UNIT = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n+")
#: Units whose tables a worker keeps; the store is emptied when full.
CACHE_UNITS = 1_000_000


def vocabulary_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_SHARED: dict[str, PrefixCounter] = {}


class PrefixCounter:
    def __init__(self, model_path: str, cache_units: int = CACHE_UNITS):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        ids = range(self.sp.get_piece_size())
        self.pieces = {self.sp.id_to_piece(i) for i in ids if not (self.sp.is_control(i) or self.sp.is_unknown(i) or self.sp.is_byte(i))}
        lengths: dict[str, set[int]] = {}
        for p in self.pieces:
            lengths.setdefault(p[-2:], set()).add(len(p))
        #: Lengths of the pieces of two characters or more by their last two, the longest first.
        self.lengths = {k: tuple(sorted((n for n in v if n > 1), reverse=True)) for k, v in lengths.items()}
        if any(re.search(f"[^{MARK}]{MARK}|\n", p) for p in self.pieces):
            raise ValueError("a piece crosses units; this vocabulary cannot be counted by units")
        self.cache_units, self.totals, self.pair_ok = cache_units, {}, {}

    @classmethod
    def shared(cls, model_path: str) -> PrefixCounter:
        """One counter for all tasks of a worker process."""
        if model_path not in _SHARED:
            _SHARED[model_path] = cls(model_path)
        return _SHARED[model_path]

    def _encode(self, s: str) -> list[str]:
        """Tokens of s without the mark that the library puts in front of every text."""
        return self.sp.encode("\n" + s.replace(MARK, " "), out_type=str)[2:]

    def _stays(self, left: str, right: str) -> bool:
        """Whether the encoder leaves the two tokens as they are when they stand side by side."""
        key = left, right
        if (ok := self.pair_ok.get(key)) is None:
            if len(self.pair_ok) >= 3 * self.cache_units:
                self.pair_ok.clear()
            ok = self.pair_ok[key] = self._encode(left + right) == ([left, right] if left else [right])
        return ok

    def unit_table(self, unit: str) -> list[int]:
        """Exact token count of every prefix of a unit, the empty one included."""
        counts, last, pieces, pair_ok, lengths = [0], [""], self.pieces, self.pair_ok, self.lengths
        for i in range(1, len(unit) + 1):
            for n in lengths.get(unit[i - 2 : i], ()) if i > 1 else ():
                if n <= i and (token := unit[i - n : i]) in pieces:
                    ok = pair_ok.get((last[i - n], token))
                    if ok or ok is None and self._stays(last[i - n], token):
                        break
            else:
                n, token = 1, unit[i - 1]
                if token not in pieces:  # outside the vocabulary: its UTF-8 bytes, which never merge
                    counts.append(counts[-1] + len(token.encode("utf-8", "surrogatepass")))
                    last.append("")
                    continue
            counts.append(counts[i - n] + 1)
            last.append(token)
        return counts

    def _fill(self, units: set[str]) -> None:
        if len(self.totals) + len(units) > self.cache_units:
            self.totals.clear()
        for u in units:
            self.totals[u] = self.unit_table(u)[-1]

    def units(self, text: str) -> list[str]:
        return UNIT.findall(MARK + text.replace(" ", MARK)) if text else []

    def count(self, text: str) -> int:
        units = self.units(text)
        try:
            return sum(map(self.totals.__getitem__, units))
        except KeyError:
            self._fill(set(units).difference(self.totals))
            return sum(self.totals.get(u) if u in self.totals else self.unit_table(u)[-1] for u in units)

    def unit_ends(self, text: str) -> tuple[list[int], list[int]]:
        """Code points and tokens up to the end of each unit: the outer part of the table of prefixes."""
        units = self.units(text)
        self._fill(set(units).difference(self.totals))
        return [n - 1 for n in accumulate(map(len, units))], list(accumulate(self.totals.get(u) if u in self.totals else self.unit_table(u)[-1] for u in units))

    def prefix_counts(self, text: str) -> list[int]:
        """Token count of text[:n] for n from 0 to the text's length, as the library gives it."""
        out, total = [0], 0
        for k, u in enumerate(self.units(text)):
            table = self.unit_table(u)
            out += [total + c for c in table[1 + (k == 0) :]]
            total += table[-1]
        return out

    def cut(self, text: str, budget: int) -> int:
        """Code points of the longest prefix with at most budget tokens, answered from the table."""
        ends, tokens = self.unit_ends(text)
        k = bisect_right(tokens, budget)
        if k == len(ends):
            return len(text)
        at, had = (ends[k - 1], tokens[k - 1]) if k else (-1, 0)
        table = self.unit_table(self.units(text)[k])
        best = max((i for i, c in enumerate(table) if had + c <= budget), default=0)
        return max(0, at + best) if k == 0 and at + best > 0 or k else 0


def token_counts(docs: DataFrame, model_path: str | None = None, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: UTF-8 bytes, tokens, over_limit, and cut: the code points of the longest prefix within
    limit tokens. Null or empty text: 0 bytes, 0 tokens, cut 0. Repeated rows are counted each; a null id stays
    null; other columns are not read. Whole texts are counted, however long."""
    path = model_path or vocabulary_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter.shared(path)
        for batch in batches:
            size, tokens, cut = [], [], []
            for t in batch.column(1):
                raw = t.as_py() or b""
                text = raw.decode("utf-8", "replace")
                n = counter.count(text)
                size.append(len(raw))
                tokens.append(n)
                cut.append(len(text) if n <= limit else counter.cut(text, limit))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_()), pa.array(cut, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "cut"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, cut long"
    )


def prefix_table(docs: DataFrame, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs with counts: the token count of every prefix (n code points at index n, from 0)."""
    path = model_path or vocabulary_path()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter.shared(path)
        for batch in batches:
            for i in range(batch.num_rows):  # a table is as long as its text: one row at a time
                counts = counter.prefix_counts((batch.column(1)[i].as_py() or b"").decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays([batch.column(0)[i : i + 1], pa.array([counts], pa.list_(pa.int32()))], names=["doc_id", "counts"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(build, "doc_id long, counts array<int>")
