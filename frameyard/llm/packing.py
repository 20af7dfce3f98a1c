"""Best-fit packing of tokenized documents into sequences, with certified repacking.

Pieces are dealt evenly over partitions and packed there by best-fit decreasing. A lower bound from dual-feasible
functions certifies a partition whose bins are as few as can be; the bins of the other partitions that are not full
are opened, their pieces are dealt anew over fewer partitions, and packed again.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameyard.llm.common import give_back, materialize

#: Pieces in a partition, at most about; fewer would leave more open bins.
PARTITION_PIECES = 20_000
LEAST_PARTITION = 2_000
#: Distinct chunks whose ids a worker keeps: the last ones used, and as many before them.
CACHE = 150_000
#: Latin letters, then ASCII marks other than the apostrophe: the two parts are never one token.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-įıĲ-ɏ]+)([!-&(-/:-@\[-`{-~]*)")
#: Those marks as bytes: ASCII chunks, most of all, are told apart without the pattern.
MARKS = bytes(b for b in range(33, 127) if b != 39 and not chr(b).isalnum())
_SHARED: dict[str, ChunkEncoder] = {}


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkEncoder:
    """Ids of a text as packed 32-bit numbers. The vocabulary drops white space and no token crosses it, so chunks
    between ASCII white space are encoded by themselves and kept."""

    def __init__(self, path: str, cache: int = CACHE):
        from tokenizers import Tokenizer

        self.tok, self.cache = Tokenizer.from_file(path), cache
        self.chunks, self.old_chunks, self.words, self.old_words = {}, {}, {}, {}
        self.model = self.tok.model
        # the library's byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in plain]
        self.alphabet = {b: b for b in plain} | {b: 256 + i for i, b in enumerate(other)}

    @classmethod
    def shared(cls, path: str, cache: int) -> ChunkEncoder:
        if path not in _SHARED:
            _SHARED[path] = cls(path)
        _SHARED[path].cache = cache
        return _SHARED[path]

    def _library(self, parts: list[str]) -> list[bytes]:
        # one by one: a batch wakes the library's threads, which cost a task more than the few parts are worth
        return [np.asarray(self.tok.encode(p, add_special_tokens=False).ids, "<u4").tobytes() for p in parts]

    def _plain(self, part: str) -> bytes:
        """Ids of lower-case Latin letters or of ASCII marks: one piece before BPE, so that the model itself is asked."""
        spelled = part if part.isascii() else part.encode().decode("latin-1").translate(self.alphabet)
        ids = [t.id for t in self.model.tokenize(spelled)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _part(self, part: str) -> bytes:
        found = self.words.get(part)
        if found is None:
            found = self.words[part] = self.old_words.get(part) or self._plain(part)
        return found

    def _fill(self, new: set[bytes]) -> None:
        chunks, old, part, rest = self.chunks, self.old_chunks, self._part, []
        for c in new:
            if (known := old.get(c)) is not None:
                chunks[c] = known
                continue
            word = c.rstrip(MARKS)
            if word.isalpha():  # of bytes: ASCII letters only
                ids = part(word.lower().decode())
                chunks[c] = ids + part(c[len(word) :].decode()) if len(word) < len(c) else ids
            elif not c.isascii() and (m := PLAIN.fullmatch(c.decode("utf-8", "replace"))):
                chunks[c] = part(m[1].lower()) + (part(m[2]) if m[2] else b"")
            else:
                rest.append(c)
        if rest:
            chunks.update(zip(rest, self._library([c.decode("utf-8", "replace") for c in rest]), strict=True))
        if len(self.words) > self.cache:
            self.words, self.old_words = {}, self.words

    def ids(self, raw: bytes) -> bytes:
        if len(self.chunks) > self.cache:  # those still in use come back from the old ones
            self.chunks, self.old_chunks = {}, self.chunks
        chunks = raw.split()
        found = list(map(self.chunks.get, chunks))
        if None in found:
            new = {c for c, ids in zip(chunks, found) if ids is None}
            if len(new) > self.cache and len(chunks) > 1:  # a very long text of new words: in parts
                half = len(chunks) // 2
                return b"".join(self.ids(b" ".join(c)) for c in (chunks[:half], chunks[half:]))
            self._fill(new)
            get = self.chunks.__getitem__
            found = [get(c) if ids is None else ids for c, ids in zip(chunks, found)]
        return b"".join(found)


def token_pieces(docs: DataFrame, capacity: int, path: str, end_id: int, id_col: str, text_col: str, cache: int = CACHE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and a row_id of the piece; only documents over capacity are cut."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder.shared(path, cache)
        end, step = int(end_id).to_bytes(4, "little"), 4 * capacity
        serial = TaskContext.get().partitionId() << 40
        for batch in batches:
            doc, piece, start, length, crc = [], [], [], [], []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.ids(t.as_py() or b"") + end
                for n, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    doc.append(i)
                    piece.append(n)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            rows = np.arange(serial, serial + len(doc))
            serial += len(doc)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(rows)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "row_id"],
            )
        give_back()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long, row_id long"
    )


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Best-fit decreasing: bin and offset of each item, and the number of bins."""
    order = np.argsort(-lengths, kind="stable")
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by the room left
    mask, n = 0, 0
    bins, offsets = np.empty(len(lengths), "i8"), np.empty(len(lengths), "i8")
    for i, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        if fits := mask >> size:
            left = size + ((fits & -fits).bit_length() - 1)
            b = room[left].pop()
            if not room[left]:
                mask ^= 1 << left
        else:
            b, left, n = n, capacity, n + 1
        bins[i], offsets[i] = b, capacity - left
        left -= size
        if left:
            if not room[left]:
                mask |= 1 << left
            room[left].append(b)
    return bins, offsets, n


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The best bound of two families of dual-feasible functions: f_eps, which rounds items over capacity - eps up to
    a bin and drops items under eps; and u_k, which rounds x (k + 1) / capacity down unless it is whole."""
    count = np.bincount(lengths, minlength=capacity + 1).astype("i8")
    size = np.arange(capacity + 1, dtype="i8")
    n_below, sum_below = np.concatenate(([0], np.cumsum(count))), np.concatenate(([0], np.cumsum(count * size)))
    best = -(-int(sum_below[-1]) // capacity)
    for eps in range(1, capacity // 2 + 1):  # sizes over capacity - eps count 1; from eps to capacity - eps x / capacity
        high = int(n_below[-1] - n_below[capacity - eps + 1])
        middle = int(sum_below[capacity - eps + 1] - sum_below[eps])
        best = max(best, high + -(-middle // capacity))
    for k in range(1, 9):
        scaled = size * (k + 1)
        value = np.where(scaled % capacity == 0, size * k, scaled // capacity * capacity)  # k * capacity times u_k(x)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def pack(pieces: DataFrame, capacity: int, rounds: int = 3) -> DataFrame:
    """Adds sequence_id and offset to pieces (row_id, length, ...); pieces must be materialized."""
    names = pieces.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + ", bin long, offset long, open boolean"
    full = pieces.where(F.col("length") == capacity).select(
        *names, (-1 - F.col("row_id")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    out, rest = [full], pieces.where(F.col("length") < capacity)
    parts = 0
    for r in range(rounds):
        n = rest.count()
        if not n:
            break
        even = max(1, -(-n // PARTITION_PIECES), min(16, n // LEAST_PARTITION))
        parts = even if r == 0 else max(1, min(even, parts // 2))
        last = r == rounds - 1 or parts == 1

        def repack(key, pdf):
            sizes = pdf["length"].to_numpy()
            bins, offsets, n_bins = best_fit(sizes, capacity)
            gap = n_bins > lower_bound(sizes, capacity)
            fill = np.bincount(bins, weights=sizes, minlength=n_bins)
            return pdf[names].assign(bin=bins + (int(key[0]) << 28), offset=offsets, open=(gap & (not last)) & (fill[bins] < capacity))

        packed = materialize(
            rest.select(*names, F.expr(f"pmod(xxhash64(row_id, {r}), {parts})").alias("_part"))
            .groupBy("_part").applyInPandas(repack, schema)
        )
        out.append(packed.where("not open").select(*names, (F.col("bin") + F.lit(r << 56)).alias("sequence_id"), "offset"))
        rest = packed.where("open").select(*names)
    whole = out[0]
    for df in out[1:]:
        whole = whole.unionByName(df)
    return whole


def pack_documents(docs: DataFrame, capacity: int = 2048, path: str | None = None, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", cache: int = CACHE) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and end_id; null or empty text is end_id alone. Documents over capacity are cut into pieces
    of that length, the last one shorter. Repeated rows are packed each; a null id stays null; other columns of docs
    are not read; no rows give no sequences. Every offset of a sequence follows the piece before it without a gap.
    `cache` bounds what a worker remembers of chunks, about 300 bytes each twice; fewer cost time only.
    """
    pieces = materialize(token_pieces(docs, capacity, path or vocabulary_path(), end_id, id_col, text_col, cache))
    return pack(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
