"""Benchmark decontamination with a positional inverted index, in DataFrame functions only.

Of every window of consecutive item words the rarest term in the corpus is the window's anchor. The index stores, for
the anchor terms, postings of the training texts: where the term stands, and the words around it. Postings of an
anchor are joined with its places in the items, the two lists of words are laid over each other at that offset, and
the stretch of equal words through the anchor gives exact window hits and near (proximity) matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameyard.llm.common import bounded_broadcast, materialize

#: Bytes that part words: everything of ASCII but digits and letters.
NON_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10
#: Words of the surroundings that must agree for a near match, of 2 * WINDOW - 1.
NEAR = 8


def words(text: Column) -> Column:
    """The words of a text, letters A-Z not yet lower-cased; null or wordless: no words."""
    cleaned = F.trim(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), NON_WORD, " "))
    return F.when(cleaned == "", F.array().cast("array<string>")).otherwise(F.split(cleaned, " "))


def ascii_lower(word: Column) -> Column:
    """A-Z lower-cased and nothing else; words in lower case already, the most, pass at the price of a comparison."""
    return F.when(F.lower(word) == word, word).otherwise(F.translate(word, UPPER, LOWER))


def item_words(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item_id, words) of the items that have words; equal items once."""
    return (
        items.select(F.col(item_col).cast("string").alias("item_id"), F.transform(words(F.col(text_col)), ascii_lower).alias("words"))
        .where(F.size("words") > 0).distinct()
    )


def anchors(items: DataFrame, frequency: DataFrame, window: int) -> DataFrame:
    """(term, item_id, left, right, need): for each window the place of its rarest term, with the item's words up to
    window - 1 on either side and how many in a row are a hit. Ties go to the term that sorts first, then the first place."""
    placed = items.select("item_id", F.size("words").alias("size"), "words", F.posexplode("words").alias("pos", "term"))
    placed = placed.join(frequency, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rank = F.struct("n", "term", "pos")
    # a window starts at s in [0, max(0, size - window)]; its rarest place is the least rank among pos in [s, s + window)
    w = Window.partitionBy("item_id", "words").orderBy("pos").rowsBetween(0, window - 1)
    best = placed.withColumn("best", F.min(rank).over(w)).where(F.col("pos") <= F.greatest(F.lit(0), F.col("size") - window))
    at = best.select("item_id", "words", "size", F.col("best.pos").alias("pos"), F.col("best.term").alias("term")).distinct()
    lo = F.greatest(F.lit(0), F.col("pos") - (window - 1))
    return at.select(
        "term", "item_id",
        F.slice("words", lo + 1, F.col("pos") - lo).alias("item_left"),
        F.slice("words", F.col("pos") + 2, F.lit(window - 1)).alias("item_right"),
        F.least(F.lit(window), F.col("size")).alias("need"),
    )


def postings(docs: DataFrame, terms: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """(term, doc_id, _hash, pos, left, right): the places of the given terms, with the words around them."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("_hash"), words(F.col(text_col)).alias("words"))
    placed = d.select("doc_id", "_hash", "words", F.posexplode("words").alias("pos", "word")).withColumn("term", ascii_lower(F.col("word")))
    lo = F.greatest(F.lit(0), F.col("pos") - (window - 1))
    return placed.join(terms, "term", "left_semi").select(
        "term", "doc_id", "_hash", "pos",
        F.slice("words", lo + 1, F.col("pos") - lo).alias("left"),
        F.slice("words", F.col("pos") + 2, F.lit(window - 1)).alias("right"),
    )


def term_counts(docs: DataFrame, terms: DataFrame, text_col: str) -> DataFrame:
    """How often each of the given terms stands in all of docs."""
    placed = docs.select(F.explode(words(F.col(text_col))).alias("word")).select(ascii_lower(F.col("word")).alias("term"))
    return placed.join(terms, "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))


def _equal_run(doc: Column, item: Column) -> Column:
    """How many leading words of two arrays are equal."""
    pairs = F.zip_with(doc, item, lambda a, b: F.when(a.isNull() | b.isNull(), F.lit(False)).otherwise(ascii_lower(a) == b))
    first = F.array_position(pairs, False)
    return F.when(first > 0, first - 1).otherwise(F.size(pairs)).cast("int")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near.

    Null or wordless texts: no words and no hits, the digest of the empty string. Items without words are left out;
    an item with a null id counts for hits, not among the items. Repeated rows are judged each; a null doc id stays
    null; other columns are not read. n_near counts anchored places where at least NEAR of the words around agree
    although no window does.
    """
    it = materialize(item_words(items, item_col, item_text))
    vocabulary = materialize(it.select(F.explode("words").alias("term")).distinct())
    known = bounded_broadcast(vocabulary)
    frequency = materialize(term_counts(docs, known, text_col))
    at = materialize(anchors(it, frequency, window))
    terms = materialize(at.select("term").distinct())
    laid = (
        postings(docs, bounded_broadcast(terms), window, id_col, text_col)
        .join(bounded_broadcast(at, 50_000), "term")
        .withColumn("l", _equal_run(F.reverse("left"), F.reverse("item_left")))
        .withColumn("r", _equal_run(F.col("right"), F.col("item_right")))
    )
    same = lambda a, b: F.size(F.filter(F.zip_with(a, b, lambda x, y: F.coalesce(ascii_lower(x) == y, F.lit(False))), lambda x: x))
    laid = laid.withColumn("agree", F.lit(1) + same(F.reverse("left"), F.reverse("item_left")) + same(F.col("right"), F.col("item_right")))
    exact = F.col("l") + F.col("r") + 1 >= F.col("need")
    hits = materialize(
        laid.where(exact | (F.col("agree") >= NEAR))
        .select("doc_id", "_hash", F.when(exact, F.col("item_id")).alias("item_id"), exact.alias("exact"),
                (F.col("pos") - F.col("l")).alias("a"), (F.col("pos") + F.col("r")).alias("b"), "pos")
        .groupBy("doc_id", "_hash", "exact", "a", "b", "item_id").agg(F.min("pos").alias("pos"))
    )
    # words under any hit: stretches merged in order of their start
    spans = hits.where("exact").select("doc_id", "_hash", "a", "b").distinct()
    before = Window.partitionBy("doc_id", "_hash").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    covered = (
        spans.withColumn("end", F.coalesce(F.max("b").over(before), F.lit(-1)))
        .groupBy("doc_id", "_hash").agg(F.sum(F.greatest(F.lit(0), F.col("b") - F.greatest(F.col("a"), F.col("end") + 1) + 1)).alias("n_hit"))
    )
    per_doc = (
        hits.groupBy("doc_id", "_hash")
        .agg(F.sort_array(F.collect_set("item_id")).alias("ids"), F.count_if(~F.col("exact")).alias("n_near"))
        .join(covered.withColumnsRenamed({"doc_id": "_d", "_hash": "_g"}), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_hash") == F.col("_g")), "left")
        .select(F.col("doc_id").alias("_id"), F.col("_hash").alias("_h"), "ids", "n_near", "n_hit")
    )
    found = bounded_broadcast(materialize(per_doc), 50_000)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("_hash"),
        F.size(words(F.col(text_col))).cast("long").alias("n_words"),
    )
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return rows.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h")), "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
    )
