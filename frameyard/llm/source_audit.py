"""Source divergence audit by chunk factorization.

Texts are cut at white space into chunks, and the chunks of each document are counted (Arrow kernels and NumPy inside
the tasks). Each distinct chunk of the whole corpus is tokenized once and its terms are joined back, so that the work
of tokenizing grows with the different chunks, not with the text. A term's documents are counted exactly, but only where
they decide: the chunk with most documents is a lower bound of them and the sum over the chunks an upper one, so only
terms with the least number of documents in between have their documents told apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from frameyard.llm.common import bounded_broadcast, materialize, release

#: A term of a language is kept from so many of its documents on; smoothing; scale of the rounded shares; ranks of terms.
LEAST_DOCS, SMOOTH, SCALE, TOP = 30, 5, 1_000_000_000, 50
#: Cells (sources times terms) of one task's table of shares.
CELLS = 500_000
#: Digests that may be broadcast (about 32 MB); beyond, both joins go by shuffle.
DIGESTS = 2_000_000
#: Terms: no ASCII but letters.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def count_chunks(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Chunks of (row, lang, source, text), none of them null: per batch of rows, language and chunk the number of
    documents, the occurrences by source, and the documents' rows where they are fewer than least_docs."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, lang, source, text = batch.columns
            lists = pc.ascii_split_whitespace(text)
            doc = np.repeat(np.arange(len(row)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            chunks = lists.flatten().dictionary_encode()
            code = chunks.indices.to_numpy(zero_copy_only=False).astype("i8")
            full = pc.greater(pc.binary_length(chunks.dictionary), 0).to_numpy(zero_copy_only=False)[code]
            doc, code, width = doc[full], code[full], max(1, len(chunks.dictionary))
            held, times = np.unique(doc * width + code, return_counts=True)
            doc, code = held // width, held % width
            langs, sources = lang.dictionary_encode(), source.dictionary_encode()
            many = max(1, len(sources.dictionary))
            key = (langs.indices.to_numpy().astype("i8")[doc] * width + code) * many + sources.indices.to_numpy()[doc]
            by = np.argsort(key, kind="stable")
            use = np.flatnonzero(np.diff(key[by], prepend=-1))  # where a language, chunk and source begin
            of_use = key[by[use]]
            first = np.flatnonzero(np.diff(of_use // many, prepend=-1))  # the first of them with a language and chunk
            n = np.diff(use[first], append=len(by))
            rare = n < least_docs
            uses = pa.StructArray.from_arrays(
                [sources.dictionary.take(pa.array(of_use % many)), pa.array(np.add.reduceat(times[by], use) if len(use) else [], pa.int64())], ["source", "times"]
            )
            at = np.zeros(len(first) + 1, "i4")
            np.cumsum(np.where(rare, n, 0), out=at[1:])
            yield pa.RecordBatch.from_arrays(
                [
                    langs.dictionary.take(pa.array(of_use[first] // many // width)), chunks.dictionary.take(pa.array(of_use[first] // many % width)), pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.append(first, len(use)), pa.int32()), uses),
                    pa.ListArray.from_arrays(pa.array(at), row.take(pa.array(doc[by][np.repeat(rare, n)])), mask=pa.array(~rare)),
                ],
                ["lang", "chunk", "docs", "uses", "rows"],
            )

    return docs.select("row", "lang", "source", "text").mapInArrow(
        scan, "lang string, chunk string, docs long, uses array<struct<source: string, times: long>>, rows array<long>"
    )


def chunk_terms(chunks: DataFrame) -> DataFrame:
    """(chunk, term, n): the terms of each chunk, which chunks holds once, and how often they stand in it."""
    found = F.regexp_extract_all(F.translate("chunk", UPPER, LOWER), F.lit(TERM), F.lit(0))
    return chunks.select("chunk", F.explode(found).alias("term")).groupBy("chunk", "term").agg(F.count("*").alias("n"))


def _kept(counted: DataFrame, least_docs: int) -> DataFrame:
    """(lang, chunk, term, n) of all chunks with a term that stands in least_docs documents of the language."""
    by_chunk = counted.groupBy("lang", "chunk").agg(F.sum("docs").alias("docs")).repartition("chunk")
    terms = materialize(by_chunk.join(chunk_terms(by_chunk.select("chunk").distinct()), "chunk").select("lang", "chunk", "term", "n", "docs"))
    bounds = terms.groupBy("lang", "term").agg(F.max("docs").alias("most"), F.sum("docs").alias("sum")).where(F.col("sum") >= least_docs)
    bounds = materialize(bounds.select("lang", "term", (F.col("most") >= least_docs).alias("sure")))
    wanted = materialize(terms.join(bounded_broadcast(bounds), ["lang", "term"]).drop("docs"))
    release(terms)
    unsure = bounded_broadcast(materialize(wanted.where("NOT sure").select("lang", "chunk", "term")))
    held = counted.select("lang", "chunk", "rows").join(unsure, ["lang", "chunk"])
    held = held.select("lang", "term", F.explode("rows").alias("row")).distinct().groupBy("lang", "term").agg(F.count("*").alias("docs"))
    kept = materialize(bounds.where("sure").select("lang", "term").unionByName(held.where(F.col("docs") >= least_docs).select("lang", "term")))
    return materialize(wanted.drop("sure").join(bounded_broadcast(kept), ["lang", "term"]))


def _share(count: Column, total: Column, terms: Column, smooth: int, scale: int) -> Column:
    """1 + floor(scale * (count + smooth) / (total + smooth * terms)) in decimals, which nothing here overflows; null
    without terms."""
    top = (count + F.lit(smooth)).cast("decimal(20,0)") * F.lit(scale).cast("decimal(12,0)")
    below = (total + F.lit(smooth) * terms).cast("decimal(20,0)")
    return F.when(terms > 0, F.lit(1).cast("long") + ((top - top % below) / below).cast("decimal(20,0)").cast("long"))


def _pairs(shares: DataFrame, groups: DataFrame, cells: int) -> DataFrame:
    """(lang, source, item, value): the sum of absolute differences of the shares of every two sources of a language.

    The terms of a language are dealt to so many tasks that none has more than about `cells` shares; each task adds up its terms,
    source by source."""
    sizes = groups.groupBy("lang").agg(F.count("*").alias("m"), F.max("v").alias("v"))
    sizes = sizes.select("lang", F.ceil(F.col("m") * F.col("v") / F.lit(cells)).cast("int").alias("deals")).where("deals > 0")
    term = shares.join(sizes, "lang").select("lang", F.pmod(F.xxhash64("term"), "deals").cast("int").alias("deal"), "term", "source", "p")
    every = groups.join(sizes, "lang").select("lang", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)).alias("deal"), F.lit(None).cast("string").alias("term"), "source", F.col("p0").alias("p"))

    def differences(key: tuple, table: pd.DataFrame) -> pd.DataFrame:
        source, term, p = table.source.to_numpy(object), table.term.to_numpy(object), table.p.to_numpy("i8")
        bare = table.term.isna().to_numpy()
        sources, at = np.unique(source, return_inverse=True)
        cells = np.zeros((len(sources), len(terms := np.unique(term[~bare]))), "i8")
        cells[at[bare]] = p[bare][:, None]
        cells[at[~bare], np.searchsorted(terms, term[~bare])] = p[~bare]
        i, j = np.triu_indices(len(sources), 1)
        value = [np.abs(cells[k + 1 :] - cells[k]).sum(1) for k in range(len(sources) - 1)]
        return pd.DataFrame({"lang": np.full(len(i), key[0], object), "a": sources[i], "b": sources[j], "value": np.concatenate(value or [i])})

    part = term.unionByName(every).groupBy("lang", "deal").applyInPandas(differences, "lang string, a string, b string, value long")
    found = part.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return found.select("lang", both.alias("x"), "value").select("lang", "x.source", "x.item", "value")


def source_audit(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS,
    smooth: int = SMOOTH, scale: int = SCALE, top: int = TOP, cells: int = CELLS,
) -> DataFrame:
    """How the word use of each source differs from its language and from the other sources of the language.

    Part "pair" has a row for each other source of the language, with the sum of absolute differences of the smoothed
    shares of all kept terms; part "term" has the terms that a source uses more than its language, up to rank `top`.
    Null texts, languages and sources count as ''. Repeated rows are documents each. A source without terms has the
    smoothed shares of no occurrences; a language without kept terms has pairs of value 0 and no terms; a source that
    is alone in its language has no pairs; no rows give none. Ties go by the item's bytes. Other columns are not read.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    counted = materialize(count_chunks(rows, least_docs))
    wanted = _kept(counted, least_docs)
    # most chunks have no kept term: they are left by a digest, eight bytes a chunk, before the exact join
    digest = F.xxhash64("lang", "chunk").alias("digest")
    known = bounded_broadcast(materialize(wanted.select(digest).distinct()), DIGESTS)
    occur = counted.select("lang", "chunk", "uses", digest).join(known, "digest", "left_semi").join(bounded_broadcast(wanted), ["lang", "chunk"])
    occur = occur.select("lang", "term", "n", F.explode("uses").alias("use"))
    count = materialize(occur.groupBy("lang", "use.source", "term").agg(F.sum(F.col("use.times") * F.col("n")).alias("count")))
    release(counted)

    whole = count.groupBy("lang", "term").agg(F.sum("count").alias("whole"))
    vocab = whole.groupBy("lang").agg(F.count("*").alias("v"), F.sum("whole").alias("all"))
    total = count.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    groups = rows.select("lang", "source").distinct().join(total, ["lang", "source"], "left").join(vocab, "lang", "left")
    groups = groups.select("lang", "source", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("total", "v", "all")))
    groups = materialize(groups.withColumn("p0", _share(F.lit(0).cast("long"), F.col("total"), F.col("v"), smooth, scale)))
    small = bounded_broadcast(groups)
    shares = count.join(small, ["lang", "source"]).withColumn("p", _share(F.col("count"), F.col("total"), F.col("v"), smooth, scale))

    other = groups.select("lang", F.col("source").alias("item"))
    bare = groups.where("v = 0").select("lang", "source").join(other, "lang").where("source <> item").withColumn("value", F.lit(0).cast("long"))
    pairs = _pairs(shares, groups, cells).unionByName(bare).withColumn("part", F.lit("pair"))
    terms = shares.join(whole, ["lang", "term"]).withColumn("value", F.col("p") - _share(F.col("whole"), F.col("all"), F.col("v"), smooth, scale))
    terms = terms.where("value > 0").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")).cast(T.IntegerType())
    pairs, terms = pairs.withColumn("rank", rank), terms.withColumn("rank", rank).where(F.col("rank") <= top)
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")
