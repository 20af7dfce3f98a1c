"""Joins by stem, and ordered selection: first N, pages, buckets, and limits that count what they passed over."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from frameyard.operators.candidates import rank_within, with_rank


def exclude(df: DataFrame, gone: DataFrame, key: str = "stem", ignore_case: bool = False) -> DataFrame:
    """Rows whose key is not in gone; gone null or missing keys exclude nothing."""
    fold = F.lower if ignore_case else (lambda c: F.col(c))
    other = gone.select(fold(key).alias("_gone")).where("_gone is not null").distinct()
    return df.join(other, fold(key) == F.col("_gone"), "left_anti")


def with_flag(df: DataFrame, known: DataFrame, flag: str, key: str = "stem", ignore_case: bool = False) -> DataFrame:
    """J1, J5 with reasons: a Boolean column instead of dropping."""
    fold = F.lower if ignore_case else (lambda c: F.col(c))
    other = known.select(fold(key).alias("_known")).distinct()
    return df.join(other, fold(key) == F.col("_known"), "left").withColumn(flag, F.col("_known").isNotNull()).drop("_known")


def require_pair(df: DataFrame, other: DataFrame, key: str = "stem") -> DataFrame:
    """Rows with a counterpart."""
    return df.join(other.select(key), key, "left_semi")


def split_pool(df: DataFrame, labelled: DataFrame, key: str = "stem") -> tuple[DataFrame, DataFrame]:
    """The rows whose key is labelled, and those still pending; a row without a key is pending."""
    flagged = with_flag(df, labelled, "_in", key)
    return flagged.where("_in").drop("_in"), flagged.where("NOT _in").drop("_in")


def attach_confirmed(images: DataFrame, labels: DataFrame, key: str = "source_path") -> tuple[DataFrame, Observation]:
    """Images with the columns of their label (a row a key), unlisted images left out; the observation tells how many
    were unlisted once the result has been computed, so that no second scan counts them."""
    seen = Observation()
    given = labels.select(F.col(key).alias("_key"), *(c for c in labels.columns if c != key), F.lit(True).alias("_listed"))
    both = images.join(given, F.col(key) == F.col("_key"), "left").drop("_key")
    both = both.observe(seen, F.count_if(F.col("_listed").isNull()).alias("unlisted"), F.count_if(F.col("_listed")).alias("listed"))
    return both.where("_listed").drop("_listed"), seen


def resolve_first(index: DataFrame, key: str, rank: list[str]) -> DataFrame:
    """The first row of each key by rank."""
    return index.withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy(*rank))).where("_k = 1").drop("_k")


def merge_review(new: DataFrame, old: DataFrame, key: str = "source_path") -> DataFrame:
    """New rows with what reviewers wrote for their key; rows gone from new vanish."""
    was = old.select(F.col(key).alias("_k"), *(F.col(c).alias(f"_{c}") for c in ("confirmed_label", "reviewed", "notes")))
    out = new.join(was, F.col(key) == F.col("_k"), "left")
    return out.select(
        *new.columns, F.coalesce("_confirmed_label", "suggested_label").alias("confirmed_label"),
        F.coalesce("_reviewed", F.lit("no")).alias("reviewed"), F.coalesce("_notes", F.lit("")).alias("notes"),
    )


def resolve_with_prefix(df: DataFrame, index: DataFrame, prefix: str, key: str = "name", value: str = "path") -> DataFrame:
    """The value under the exact name, else under prefix and name."""
    a = index.select(F.col(key).alias("_a"), F.col(value).alias("_va"))
    b = index.select(F.col(key).alias("_b"), F.col(value).alias("_vb"))
    out = df.join(a, F.col(key) == F.col("_a"), "left").join(b, F.concat(F.lit(prefix), F.col(key)) == F.col("_b"), "left")
    return out.withColumn(value, F.coalesce("_va", "_vb")).drop("_a", "_va", "_b", "_vb")


def expand_reject_stems(df: DataFrame, stem: str = "stem") -> DataFrame:
    """Each stem and what follows its last double underscore."""
    return df.select(F.explode(F.array_distinct(F.array(F.col(stem), F.substring_index(stem, "__", -1)))).alias(stem)).distinct()


def running_total(df: DataFrame, flag: Column, order: list[str], name: str) -> DataFrame:
    """Adds how many rows up to each one have flag, in order: sums inside blocks of the rank, then over the blocks."""
    ranked = with_rank(df, order, "_r").withColumn("_f", F.when(flag, 1).otherwise(0)).withColumn("_b", F.floor((F.col("_r") - 1) / 4096))
    blocks = ranked.groupBy("_b").agg(F.sum("_f").alias("_s"))
    before = blocks.select("_b", F.coalesce(F.sum("_s").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_o"))
    inside = F.sum("_f").over(Window.partitionBy("_b").orderBy("_r").rowsBetween(Window.unboundedPreceding, 0))
    return ranked.withColumn("_i", inside).join(before, "_b").withColumn(name, F.col("_o") + F.col("_i")).drop("_b", "_f", "_i", "_o", "_r")


def limit_with_rejects(df: DataFrame, selected: Column, order: list[str], n: int) -> DataFrame:
    """Rows up to the n-th selected one, the rejected before it included; what follows was never looked at."""
    out = running_total(df.withColumn("_sel", selected), F.col("_sel"), order, "_t")
    return out.where((F.col("_t") < n) | ((F.col("_t") == n) & F.col("_sel"))).drop("_t", "_sel")


def page(df: DataFrame, order: list, skip: int, n: int) -> DataFrame:
    """D8"""
    return df.orderBy(*order).offset(skip).limit(n)


def first_n(df: DataFrame, order: list, n: int) -> DataFrame:
    """D9"""
    return df.orderBy(*order).limit(n)


def bucketize(df: DataFrame, by: list[str], order: list, chunk: int | None = None) -> DataFrame:
    """Place in its bucket, and batch_NNN of chunk rows."""
    out = rank_within(df, by, order, "place").withColumn("place", F.col("place").cast("int"))
    number = F.ceil(F.col("place") / chunk) if chunk else F.lit(1)
    return out.withColumn("batch", F.concat(F.lit("batch_"), F.lpad(number.cast("string"), 3, "0")))


def top_boxes(boxes: DataFrame, k: int = 2, least: float = 0.25, image: str = "stem") -> DataFrame:
    """The k boxes of highest confidence of each image; those that agree in it and in box_idx go by seq, if they have it."""
    best = Window.partitionBy(image).orderBy(F.desc("conf"), "box_idx", *(c for c in boxes.columns if c == "seq"))
    return boxes.where(F.col("conf") >= least).withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)


def decide_candidates(df: DataFrame, prefix: str, words: list[str], least_edge: int) -> DataFrame:
    """The staging decision of each row; flags in_exceptions, known_reject, labelled, dup_stem, dup_hash, has_file
    come from joins. Precedence is the order of the cases."""
    reason = (
        F.when(F.col("in_exceptions"), "exception").when(~F.col("stem").startswith(prefix), "wrong_prefix")
        .when(F.col("known_reject"), "known_reject").when(F.col("labelled"), "already_labelled")
        .when(F.lower(F.concat_ws(" ", "stem", "path")).rlike("|".join(words)), "keyword")
        .when(F.col("dup_stem"), "duplicate_stem").when(F.col("dup_hash"), "duplicate_hash")
        .when(F.col("width").isNull() | (F.col("width") < 0), "unusable_image")
        .when(F.greatest("width", "height") < least_edge, "too_small").when(~F.col("has_file"), "missing_file").otherwise("selected")
    )
    return df.withColumn("status", F.when(reason == "selected", "selected").otherwise("rejected")).withColumn("reason", reason)


def index_manifest(df: DataFrame, order: list[str], filename: str = "filename", stem: str = "stem") -> DataFrame:
    """1-based index in selection order."""
    return with_rank(df, order, "index").select("index", filename, stem)


def safe_name(prefix: str, width: int, index: str, *parts: Column) -> Column:
    """Prefix, zero-padded index, and further parts joined by underscores."""
    number = F.lpad(F.col(index).cast("string"), width, "0")
    return F.concat_ws("_", *([F.lit(prefix)] if prefix else []), number, *parts)
