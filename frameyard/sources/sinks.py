"""Writers and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameyard.functions.columns import fixed
from frameyard.functions.durable import _fs_path

URL_COLUMNS = ("uuid", "image_url", "source_name", "query", "domain", "view", "split", "view_confidence")


def with_storage_keys(df: DataFrame, prefix: str = "") -> DataFrame:
    """image_key, label_key and manifest_key of rows with uuid, view and split."""
    head = [F.lit(prefix.strip("/"))] if prefix.strip("/") else []
    key = lambda kind, end: F.concat(F.concat_ws("/", *head, F.lit(kind), "split", "view", "uuid"), F.lit(end))
    return df.withColumn("image_key", key("images", ".jpg")).withColumn("label_key", key("labels", ".txt")).withColumn(
        "manifest_key", F.concat(F.concat_ws("/", *head, F.lit("manifests"), "uuid"), F.lit(".json")))


def write_dataset(df: DataFrame, root: str, mode: str = "append") -> None:
    """Rows as Parquet, a folder per split and view."""
    df.write.mode(mode).partitionBy("split", "view").parquet(root)


def urls_export(manifests: DataFrame) -> DataFrame:
    """The eight columns as text, empty where missing."""
    return manifests.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in manifests.columns else F.lit("").alias(c) for c in URL_COLUMNS))


def export_report(df: DataFrame, floats: dict[str, int] | None = None, lists: dict[str, str] | None = None) -> DataFrame:
    """Columns as text: numbers with fixed decimals, arrays joined, null and non-finite values empty."""
    floats, lists = floats or {}, lists or {}
    text = lambda c: fixed(c, floats[c]) if c in floats else F.array_join(c, lists[c]) if c in lists else F.col(c).cast("string")
    return df.select(*(F.coalesce(text(c), F.lit("")).alias(c) for c in df.columns))


def save_quota(quota: DataFrame, path: str) -> None:
    """The small table, written beside the path and renamed into its place, so that it may come from there: a table
    cannot be overwritten while it is read. A save that is lost leaves the old table, or itself under <path>-new."""
    fs, old = _fs_path(quota.sparkSession, path)
    _, new = _fs_path(quota.sparkSession, path.rstrip("/") + "-new")
    quota.select("view", "target", "accepted").write.mode("overwrite").json(str(new))
    fs.delete(old, True)
    if not fs.rename(new, old):
        raise OSError(f"could not save quota under {path}")


def append_index(df: DataFrame, path: str, batch: str) -> None:
    """Embeddings appended under the name of their batch, a folder per view; the same batch again replaces itself
    and nothing else."""
    rows = df.select("view", F.lit(batch).alias("batch"), "uuid", "embedding")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("view", "batch").parquet(path)


def read_index(spark: SparkSession, path: str, views: list[str]) -> DataFrame:
    """The index of some views; the folders of others are not opened."""
    return spark.read.schema("uuid string, embedding array<float>, view string, batch string").parquet(path).where(F.col("view").isin(views))


def write_priors(priors: DataFrame, path: str) -> None:
    """(label, x_norm, y_norm, confidence), at most a row a keypoint, as one JSON object that read_priors reads."""
    entry = F.struct("label", F.struct(*(F.round(c, 6).alias(c) for c in ("x_norm", "y_norm", "confidence"))).alias("v"))
    one = priors.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(entry)))).alias("value"))
    one.coalesce(1).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
