"""Readers: listings, decoded images, annotation and manifest JSON, reports, lists, and saved state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from frameyard.functions import params as P
from frameyard.functions.columns import stem, suffix

MANIFEST = (
    "uuid string, image_url string, source_name string, query string, domain string, view string, split string, "
    "view_confidence double, bboxes array<struct<cx:double,cy:double,w:double,h:double,confidence:double>>"
)


def scan_images(spark: SparkSession, root: str, suffixes: tuple[str, ...] = P.IMAGE_SUFFIXES, recursive: bool = True) -> DataFrame:
    """(path, length, stem) of image files, suffixes in either case; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(root)
    return files.where(suffix("path").isin(*suffixes)).select("path", "length", stem("path").alias("stem"))


def decode_images(spark: SparkSession, root: str) -> DataFrame:
    """Decoded images; one that cannot be decoded has width and height -1."""
    return spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True).load(root)


def scan_annotations(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """S3: one row per JSON file: path, stem, raw, and whether it is malformed."""
    files = spark.read.option("recursiveFileLookup", recursive).option("pathGlobFilter", "*.json").text(root, wholetext=True)
    rows = files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"))
    return rows.select("path", stem("path").alias("stem"), "raw", F.expr("try_parse_json(raw) IS NULL").alias("malformed"))


def scan_manifests(spark: SparkSession, root: str) -> DataFrame:
    """Manifest rows; files that are no JSON are skipped."""
    read = spark.read.schema(MANIFEST + ", _corrupt_record string").option("multiLine", True).option("mode", "PERMISSIVE")
    return read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(root).where("_corrupt_record IS NULL AND uuid IS NOT NULL").drop("_corrupt_record")


def coerce_quality_report(df: DataFrame) -> DataFrame:
    """Typed columns of a report whose columns are all strings; rows without an image are dropped."""
    number = lambda c: F.expr(f"try_cast({c} AS double)")
    return df.where(F.trim("image") != "").select(
        F.trim("image").alias("image"), F.lower(F.trim("success")).isin("true", "1", "yes").alias("success"),
        F.coalesce(number("wheel_detections"), F.lit(0.0)).cast("int").alias("wheel_detections"),
        number("quality_score").alias("quality_score"), F.upper(F.trim("review_priority")).alias("review_priority"),
        F.filter(F.transform(F.split("warnings", r"\|"), lambda w: F.trim(w)), lambda w: w != "").alias("warnings"),
    )


def read_quality_report(spark: SparkSession, path: str) -> DataFrame:
    """S5"""
    return coerce_quality_report(spark.read.option("header", True).csv(path))


def scan_stems(spark: SparkSession, root: str, ext: str, recursive: bool = True) -> DataFrame:
    """Distinct stems of files with a suffix."""
    return scan_images(spark, root, (ext,), recursive).select("stem").distinct()


def read_priors(spark: SparkSession, path: str) -> DataFrame:
    """(label, x_norm, y_norm, confidence) of a JSON object; entries without numbers are skipped, confidence 0.8 by default."""
    raw = spark.read.text(path, wholetext=True).selectExpr("try_parse_json(value) AS v")
    rows = spark.sql("SELECT key AS label, value AS e FROM {raw}, LATERAL variant_explode(v)", raw=raw)
    get = lambda k: F.expr(f"try_variant_get(e, '$.{k}', 'double')")
    return rows.select("label", get("x_norm").alias("x_norm"), get("y_norm").alias("y_norm"), F.coalesce(get("confidence"), F.lit(0.8)).alias("confidence")).where("x_norm IS NOT NULL AND y_norm IS NOT NULL")


def reference_list(spark: SparkSession, values: list[str], name: str = "value") -> DataFrame:
    """Trimmed distinct values of a short list, blanks dropped."""
    return spark.createDataFrame([(v,) for v in dict.fromkeys(x.strip() for x in values) if v], f"{name} string")


def assign_query_pages(images: DataFrame, queries: DataFrame, per_query: int, order: str = "pos") -> DataFrame:
    """Each query takes the next per_query images; images behind the last query are left."""
    from frameyard.operators.candidates import with_rank

    ranked = with_rank(images, [order], "_r").withColumn("query_idx", F.floor((F.col("_r") - 1) / per_query).cast("int")).drop("_r")
    return ranked.join(F.broadcast(queries), "query_idx")


def load_quota(spark: SparkSession, targets: dict[str, int], saved: DataFrame | None = None) -> DataFrame:
    """Configured targets with the saved counts; a view without a count starts at 0, one without a target is kept as full."""
    want = spark.createDataFrame(list(targets.items()), "view string, target int")
    if saved is None:
        return want.withColumn("accepted", F.lit(0))
    was = saved.select("view", F.col("accepted").alias("_a"))
    return want.join(was, "view", "full_outer").select("view", F.coalesce("target", F.lit(0)).alias("target"), F.coalesce("_a", F.lit(0)).cast("int").alias("accepted"))


def read_manifest_lines(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed lines, blanks dropped."""
    return spark.read.text(path).select(F.trim("value").alias("line")).where("line <> ''")


def first_by_path(df: DataFrame) -> DataFrame:
    """The first file of each stem in the order of a walk."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy("stem").orderBy(F.split("path", "/")))).where("_k = 1").drop("_k")
