"""Candidate images: url filters, first-wins per key, seen urls, queries, and a total order without one big window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameyard.functions import params as P
from frameyard.functions.durable import bounded_broadcast, materialize

#: Up to so many rows of a group Spark limits a ranking window within each task.
GROUP_LIMIT = 1000


def filter_bad_urls(df: DataFrame, url: str = "image_url") -> DataFrame:
    """Web urls without advertising parts or vector formats."""
    low = F.lower(url)
    bad = low.rlike("|".join(P.BAD_URL_PARTS))
    for end in P.BAD_URL_ENDS:
        bad = bad | low.endswith(end)
    return df.where(F.col(url).startswith("http") & ~bad)


def dedupe_and_cap(df: DataFrame, group: list[str], key: str, order: list[str], n: int) -> DataFrame:
    """The first row of each key in a group, in order, at most n of a group."""
    first = df.withColumn("_k", F.row_number().over(Window.partitionBy(*group, key).orderBy(*order))).where("_k = 1").drop("_k")
    if n <= GROUP_LIMIT:  # every task keeps n rows of a group before they meet
        return first.withColumn("_n", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("_n") <= n).drop("_n")
    return rank_within(first, group, order, "_n").where(F.col("_n") <= n).drop("_n")


def extract_image_urls(pages: DataFrame, text: str = "html", id_col: str = "page_id") -> DataFrame:
    """Image urls harvested from page text: (id, pos, image_url)."""
    found = F.regexp_extract_all(F.col(text), F.lit(r'https?://[^"\\]+?\.(?:jpg|jpeg|png|webp)'), F.lit(0))
    return pages.select(id_col, F.posexplode(found).alias("pos", "image_url"))


def payload_url(json: str, full: str, thumb: str) -> Column:
    """The full-size url of a JSON payload, or else its thumbnail; null if the JSON is malformed."""
    pick = lambda k: F.nullif(F.get_json_object(F.col(json), f"$.{k}"), F.lit(""))
    return F.coalesce(pick(full), pick(thumb))


def filter_queries(df: DataFrame, needle: str, n: int, query: str = "query", order: str = "query_idx") -> DataFrame:
    """C4: queries that contain needle, letters in either case; the first n. That none does is an error, raised in the
    same pass when the rows are computed."""
    first = df.where(F.contains(F.lower(query), F.lit(needle.lower()))).orderBy(order).limit(n)
    held = first.agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("_at"), F.struct("*").alias("_row")))).alias("_rows"))  # n rows
    some = F.when(F.size("_rows") > 0, F.col("_rows")).otherwise(F.raise_error(F.lit(f"no query contains {needle!r}")))
    return held.select(F.explode(some).alias("_x")).select("_x._row.*")


def query_matrix(models: DataFrame, views: DataFrame, template: str = "%s %s") -> DataFrame:
    """Every model with every view; both are short lists."""
    return models.crossJoin(F.broadcast(views)).withColumn("query", F.format_string(template, "model", "view"))


def mark_seen(df: DataFrame, seen: DataFrame, url: str = "image_url") -> DataFrame:
    """Outcome and reason for urls that were seen or are blocked; others get nulls."""
    known = seen.select(F.col(url).alias("_seen")).distinct()
    out = df.join(known, F.col(url) == F.col("_seen"), "left")
    hit = F.col("_seen").isNotNull()
    return out.withColumn("outcome", F.when(hit, "rejected_dedup_clip")).withColumn("reason_detail", F.when(hit, "url_seen")).drop("_seen")


def with_rank(df: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """A total order from 1. Rows are range-partitioned and sorted; each partition counts its rows, and the offset of
    a partition is the sum of the counts before it: no window over the whole table. order must be unique."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id() % (1 << 33))
    dealt = materialize(dealt)
    counts = dealt.groupBy("_p").agg(F.count("*").alias("_n"))
    before = counts.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_o"))
    return dealt.join(F.broadcast(before), "_p").withColumn(name, F.col("_o") + F.col("_m") + 1).drop("_p", "_m", "_o")


def rank_within(df: DataFrame, by: list[str], order: list[str], name: str = "place") -> DataFrame:
    """The place from 1 of each row among those that agree in `by`, in order: row_number over a window, but a key whose
    rows are most of the table is spread over all tasks.

    Rows are range-partitioned and sorted by key and order; each partition counts its rows of a key, and those in the
    partitions before it are added. The counts are as many as partitions and keys together. order must be unique within a
    key; null keys agree with each other.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *by, *order).sortWithinPartitions(*by, *order)
    dealt = materialize(dealt.withColumn("_within_p", F.spark_partition_id()).withColumn("_within_m", F.monotonically_increasing_id() % (1 << 33)))
    keys = [F.col(k).alias(f"_within_k{i}") for i, k in enumerate(by)]
    counts = dealt.groupBy("_within_p", *keys).agg(F.count("*").alias("_within_n"), F.min("_within_m").alias("_within_s"))
    names = [f"_within_k{i}" for i in range(len(by))]
    earlier = F.sum("_within_n").over(Window.partitionBy(*names).orderBy("_within_p").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(F.col("_within_p").alias("_within_q"), *names, (F.coalesce(earlier, F.lit(0)) - F.col("_within_s") + 1).alias("_within_shift"))
    starts = bounded_broadcast(materialize(starts))
    out = dealt.join(starts, [F.col("_within_p") == F.col("_within_q")] + [F.col(k).eqNullSafe(F.col(f"_within_k{i}")) for i, k in enumerate(by)])
    return out.withColumn(name, F.col("_within_m") + F.col("_within_shift")).drop("_within_p", "_within_m", "_within_q", "_within_shift", *names)
