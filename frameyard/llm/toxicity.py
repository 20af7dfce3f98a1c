"""Toxicity by the nearest labelled examples under TF-IDF cosine.

Terms are words and the beginnings of longer words; those that stand mostly in positive examples, and by a chi-square
test not by chance, are kept. The examples lie in an inverted index whose postings are cut into blocks with the largest
weight of each term in each block. A text's blocks are visited by falling upper bound until no block can hold a better
neighbour, so the neighbours are exact. Their votes, weighted by distance, are calibrated on the examples, each left
out of its own vote.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameyard.llm.common import give_back, materialize

#: Bounds of the fitted classifier: labelled examples, and terms kept of them.
EXAMPLES, TERMS = 20_000, 4096
CHI_SQUARE, LEAST_DF, LEAST_SHARE = 20.0, 3, 0.5
NEIGHBOURS, BLOCK, EVIDENCE = 15, 64, 3
THRESHOLD = 0.3
WORD = re.compile(r"[^\W\d_]+")
STEMS = (4, 5)


def _terms(words: set[str]) -> set[str]:
    return words | {w[:n] + "*" for n in STEMS for w in words if len(w) > n}


def _count_terms(examples: DataFrame) -> DataFrame:
    """(term, pos, neg): in how many positive and negative examples a term stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter(), Counter()
        for batch in batches:
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts[y == 1].update(_terms(set(WORD.findall((t.as_py() or b"").decode("utf-8", "replace").lower()))))
        terms = list(counts[0] | counts[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), pa.array([counts[1][t] for t in terms], pa.int64()), pa.array([counts[0][t] for t in terms], pa.int64())],
            names=["term", "pos", "neg"],
        )

    counted = examples.select("toxic", "text").mapInArrow(run, "term string, pos long, neg long")
    return counted.groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _select_terms(examples: DataFrame) -> list[str]:
    n_pos, n_neg = examples.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    n, p, q = float(n_pos + n_neg), F.col("pos"), F.col("neg")
    # chi-square of the 2 x 2 table of term and label
    top = (p * (n_neg - q) - q * (n_pos - p)).cast("double")
    bottom = (p + q) * (n - p - q) * float(n_pos) * float(n_neg)
    chi = F.when(bottom > 0, top * top * n / bottom).otherwise(0.0)
    kept = _count_terms(examples).where(p + q >= LEAST_DF).withColumn("chi", chi).where((F.col("chi") >= CHI_SQUARE) & ((p + 0.5) / (p + q + 1) >= LEAST_SHARE))
    return sorted(r["term"] for r in kept.orderBy(F.desc("chi"), "term").limit(TERMS).select("term").collect())


def _features(docs: DataFrame, terms: list[str]) -> DataFrame:
    """(doc_id, t, tf, _key): the numbers of the kept terms in each text, and how often they stand in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(terms)}
        for batch in batches:
            ts, tfs = [], []
            for t in batch.column(1):
                words = WORD.findall((t.as_py() or b"").decode("utf-8", "replace").lower())
                own = set(words)
                hits = {w: got for w in own if (got := [n for t in _terms({w}) if (n := number.get(t)) is not None])}
                tf: Counter[int] = Counter()
                if hits:
                    for w in filter(hits.__contains__, words):
                        tf.update(hits[w])
                found = sorted(tf)
                ts.append(found)
                tfs.append([tf[i] for i in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ts, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32())), batch.column(2)], names=["doc_id", "t", "tf", "_key"])
        give_back()

    return docs.select("doc_id", "text", "_key").mapInArrow(run, "doc_id long, t array<int>, tf array<int>, _key long")


class BlockMaxIndex:
    """Exact top-k cosine over at most EXAMPLES weighted term vectors."""

    def __init__(self, ids: list[int], labels: list[int], vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        # neighbours in the order share their heaviest term, which makes the block bounds tight
        order = sorted(range(len(ids)), key=lambda i: (int(vectors[i][0][np.argmax(vectors[i][1])]), ids[i]))
        self.ids = np.array([ids[i] for i in order], "i8")
        self.labels = np.array([labels[i] for i in order], "i1")
        self.blocks = -(-len(order) // BLOCK)
        row = np.repeat(np.arange(len(order)), [len(vectors[i][0]) for i in order])
        term = np.concatenate([vectors[i][0] for i in order] or [np.zeros(0, "i4")])
        weight = np.concatenate([vectors[i][1] for i in order] or [np.zeros(0)])
        by = np.lexsort((row, term))
        self.row, self.weight = row[by], weight[by]
        cell = term[by].astype("i8") * self.blocks + self.row // BLOCK
        self.start = np.searchsorted(cell, np.arange(n_terms * self.blocks + 1)) if self.blocks else np.zeros(1, "i8")
        self.most = np.zeros(n_terms * self.blocks)
        np.maximum.at(self.most, cell, self.weight)
        self.most = self.most.reshape(n_terms, self.blocks)

    def top(self, terms: np.ndarray, weights: np.ndarray, k: int, skip: int | None = None) -> list[tuple[float, int]]:
        """(cosine, row) of the k nearest, those with any common term; ties by row. skip: an id left out."""
        if not self.blocks or not len(terms):
            return []
        bound = weights @ self.most[terms]
        best: list[tuple[float, int]] = []
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or len(best) == k and bound[b] + 1e-9 < best[0][0]:
                break
            score = np.zeros(BLOCK)
            for t, w in zip(terms, weights, strict=True):
                s, e = self.start[t * self.blocks + b], self.start[t * self.blocks + b + 1]
                if e > s:
                    score[self.row[s:e] - b * BLOCK] += w * self.weight[s:e]
            for i in np.flatnonzero(score > 0):
                item = (float(score[i]), -int(b * BLOCK + i))
                if skip is not None and self.ids[-item[1]] == skip:
                    continue
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
        return [(s, -r) for s, r in sorted(best, reverse=True)]


def weigh(t, tf, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    t = np.asarray(t, "i4")
    w = (1 + np.log(np.asarray(tf, "f8"))) * idf[t]
    return t, w / math.sqrt(float(w @ w)) if len(t) else w


def vote(index: BlockMaxIndex, near: list[tuple[float, int]], prior: float) -> float:
    """Share of positive votes, each weighted by nearness, with one vote at distance 1 for the prior."""
    weight = [1 / (1.05 - min(1.0, c)) for c, _ in near]
    return (prior + sum(w for w, (_, r) in zip(weight, near, strict=True) if index.labels[r])) / (1 + sum(weight))


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators fit of y by x: points for a piecewise linear, rising map. Each pool has one more example
    at the overall rate, so that a few examples never give 0 or 1."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # sum, count, sum of x
    for a, b in zip(x[order], y[order], strict=True):
        pools.append([float(b), 1.0, float(a)])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            s, n, m = pools.pop()
            pools[-1] = [pools[-1][0] + s, pools[-1][1] + n, pools[-1][2] + m]
    rate = float(y.mean()) if len(y) else 0.0
    return np.array([m / n for _, n, m in pools]), np.maximum.accumulate([(s + rate) / (n + 1) for s, n, _ in pools])


SCORED = "doc_id long, score double, evidence array<struct<doc_id: long, cosine: double, toxic: int>>, _key long"


def score_toxicity(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", key_col: str | None = None) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted, and evidence: the nearest labelled examples.

    Examples are the labelled rows outside the held-out fold (crc32 of the id modulo 4 is 2), at most `examples` of
    them, chosen by a hash of the id; of several labels of an id the largest counts. Term frequencies in documents
    are counted over all of docs. A text without a kept term (null and empty ones too) gets the rate of such
    examples; without any example every score is 0. A null id is scored and not held out; repeated rows are scored
    each; other columns are not read. key_col, if given, names a column of whole numbers that comes along with each
    row, last, for callers to whom the id does not name a row.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), (F.col(key_col) if key_col else F.lit(None)).cast("long").alias("_key"))
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    known = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic"))
        .where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~fold)
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples)
    )
    known = F.broadcast(materialize(known))  # at most `examples` rows of two numbers
    labelled = texts.join(known, "doc_id").withColumn("copy", F.xxhash64("text"))
    labelled = labelled.groupBy("copy").agg(F.min_by(F.struct("doc_id", "toxic", "text"), "doc_id").alias("x")).select("x.*")
    labelled = materialize(labelled)  # copies of a text would count its chance words again and again
    terms = _select_terms(labelled)
    features = materialize(_features(texts, terms))
    n_docs = features.count()
    df = {r["t"]: r["n"] for r in features.select(F.explode("t").alias("t")).groupBy("t").agg(F.count("*").alias("n")).collect()}
    idf = np.array([math.log((1 + n_docs) / (1 + df.get(i, 0))) + 1 for i in range(len(terms))])
    # of several texts under an id the one whose features sort first stands for it
    rows = features.join(known, "doc_id").groupBy("doc_id", "toxic").agg(F.min(F.struct("t", "tf")).alias("x")).select("doc_id", "toxic", "x.t", "x.tf").collect()
    rows.sort(key=lambda r: r["doc_id"])
    prior = sum(r["toxic"] for r in rows) / max(1, len(rows))
    bare = [r["toxic"] for r in rows if not r["t"]]
    bare_rate = sum(bare) / len(bare) if bare else prior
    rich = [r for r in rows if r["t"]]
    index = BlockMaxIndex([r["doc_id"] for r in rich], [r["toxic"] for r in rich], [weigh(r["t"], r["tf"], idf) for r in rich], len(terms))
    held = spark.sparkContext.broadcast((index, idf))

    def scored(source: DataFrame, leave_out: bool, fit) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ix, weights = held.value
            for batch in batches:
                score, evidence = [], []
                for i, t, tf in zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True):
                    near = ix.top(*weigh(t, tf, weights), NEIGHBOURS, i if leave_out else None) if t else []
                    raw = vote(ix, near, prior)
                    score.append((float(np.interp(raw, *fit)) if fit else raw) if near else bare_rate)
                    evidence.append([{"doc_id": int(ix.ids[r]), "cosine": c, "toxic": int(ix.labels[r])} for c, r in near[:EVIDENCE]])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(score, pa.float64()),
                     pa.array(evidence, pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))), batch.column(3)],
                    names=["doc_id", "score", "evidence", "_key"],
                )
            give_back()

        return source.select("doc_id", "t", "tf", "_key").mapInArrow(run, SCORED)

    fit = None
    if rich:
        chosen = features.where(F.size("t") > 0).join(known.select("doc_id"), "doc_id").groupBy("doc_id").agg(F.min(F.struct("t", "tf")).alias("x"))
        own = scored(chosen.select("doc_id", "x.t", "x.tf", F.lit(None).cast("long").alias("_key")), True, None)
        truth = {r["doc_id"]: r["toxic"] for r in rich}
        pairs = [(r["score"], truth[r["doc_id"]]) for r in own.select("doc_id", "score").collect()]
        fit = isotonic(np.array([a for a, _ in pairs]), np.array([b for _, b in pairs], "f8"))
    return scored(features, False, fit).select(
        "doc_id", F.coalesce(fold, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence",
        *([F.col("_key").alias(key_col)] if key_col else []),
    )
