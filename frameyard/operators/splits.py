"""Reproducible splits and ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameyard.functions.columns import hex_modulo, md5_modulo_5
from frameyard.operators.candidates import rank_within


def split_by_id(digest: str) -> Column:
    """One of five ids goes to val."""
    return F.when(hex_modulo(digest, 5) == 0, "val").otherwise("train")


def split_by_stem(df: DataFrame, stem: str = "stem", split: str = "split", least: int = 5) -> DataFrame:
    """The given split, unless all rows are train and there are enough: then md5 of the stem decides."""
    one = df.agg((F.count("*") >= least).alias("_n"), F.coalesce(F.every(F.col(split) == "train"), F.lit(False)).alias("_t"))  # one row
    decide = F.when(md5_modulo_5(stem) == 0, "val").otherwise("train")
    return df.crossJoin(F.broadcast(one)).withColumn(split, F.when(F.col("_n") & F.col("_t"), decide).otherwise(F.col(split))).drop("_n", "_t")


def last_n_split(df: DataFrame, stem: str = "stem") -> DataFrame:
    """The last max(1, min(8, a quarter)) stems, letters in either case, go to val; fewer than 4 rows are an error.
    Only the stems of the last places are ordered in full: they are found by a top-k, not by a global sort."""
    n = df.count()
    if n < 4:
        raise ValueError("fewer than 4 labels")
    val = max(1, min(8, round(n * 0.25)))
    last = df.select(F.lower(stem).alias("_l"), F.col(stem).alias("_s")).orderBy(F.desc("_l"), F.desc("_s")).limit(val)
    return df.join(F.broadcast(last.select("_s").withColumn("_v", F.lit(True))), F.col(stem) == F.col("_s"), "left").withColumn(
        "split", F.when(F.col("_v"), "val").otherwise("train")
    ).drop("_s", "_v")


def shuffle_split(df: DataFrame, label: str, path: str, seed: int = 42, share: float = 0.8) -> DataFrame:
    """Per class, the first floor(share n) rows by md5 of seed and path are train."""
    keyed = df.withColumn("_h", F.md5(F.concat(F.lit(str(seed)), F.col(path)).cast("binary")))
    sizes = df.groupBy(F.col(label).alias("_l")).agg(F.count("*").alias("_n"))
    ranked = rank_within(keyed, [label], ["_h", path], "_k").join(sizes, F.col(label).eqNullSafe(F.col("_l")))
    return ranked.withColumn("split", F.when(F.col("_k") <= F.floor(F.col("_n") * share), "train").otherwise("val")).drop("_k", "_n", "_h", "_l")


def row_id(url: str) -> Column:
    """P5: a 32-digit id that a retry finds again."""
    return F.md5(F.col(url).cast("binary"))
