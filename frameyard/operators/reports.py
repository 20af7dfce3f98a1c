"""Reports: one aggregation each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameyard.functions.columns import warning_code


def outcome_report(df: DataFrame) -> DataFrame:
    """Rows per view (accepted only), per outcome and per source (rejected only), in one pass."""
    kind = F.array(
        F.when(F.col("outcome") == "accepted", F.struct(F.lit("accepted_view").alias("kind"), F.col("view").alias("key"))),
        F.when(F.col("outcome") != "accepted", F.struct(F.lit("rejected_outcome").alias("kind"), F.col("outcome").alias("key"))),
        F.when(F.col("outcome") != "accepted", F.struct(F.lit("rejected_source").alias("kind"), F.col("source_name").alias("key"))),
    )
    return df.select(F.explode(F.array_compact(kind)).alias("x")).groupBy("x.kind", "x.key").agg(F.count("*").alias("n"))


def quota_progress(quota: DataFrame) -> DataFrame:
    """R2: remaining and a bar of at most 30 marks."""
    bar = F.least(F.lit(30), F.floor(30 * F.col("accepted") / F.greatest(F.col("target"), F.lit(1)))).cast("int")
    return quota.select("view", "accepted", "target", F.greatest(F.lit(0), F.col("target") - F.col("accepted")).alias("remaining"), F.repeat(F.lit("#"), bar).alias("bar"))


def suggestion_summary(report: DataFrame) -> DataFrame:
    """Totals, success share, means over successes, and counts per priority."""
    ok = F.col("success")
    return report.agg(
        F.count("*").alias("total"), F.count_if(ok).alias("succeeded"),
        (F.count_if(ok) * 100.0 / F.count("*")).alias("success_percent"),
        F.avg(F.when(ok, F.col("avg_confidence"))).alias("mean_confidence"), F.avg(F.when(ok, F.col("quality_score"))).alias("mean_quality"),
        *(F.count_if(F.col("review_priority") == f"REVIEW_{p}").alias(f"n_{p.lower()}") for p in ("HIGH", "MEDIUM", "LOW")),
    )


def warning_counts(df: DataFrame, warnings: str = "warnings") -> DataFrame:
    """Rows per warning code, the most common first."""
    return df.select(F.explode(warnings).alias("w")).groupBy(warning_code("w").alias("code")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "code")


def status_counts(df: DataFrame, statuses: tuple[str, ...] = ("VALID", "REVIEW", "INVALID")) -> DataFrame:
    """One row with the count of each status, zero included, of rows with warnings, and where they are listed of rows
    with keypoints of low confidence. With other statuses: written and skipped, passed and failed, converted and skipped."""
    low = [F.count_if(F.size("low_conf_keypoints") > 0).alias("n_low_confidence")] if "low_conf_keypoints" in df.columns else []
    warned = [F.count_if(F.size("warnings") > 0).alias("n_warned")] if "warnings" in df.columns else []
    return df.agg(*(F.count_if(F.col("status") == s).alias(f"n_{s.lower()}") for s in statuses), *warned, *low)


def action_counts(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows per group."""
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def review_gate(sheet: DataFrame, classes: tuple[str, ...]) -> DataFrame:
    """How many rows block the upload, not reviewed or with a label outside the classes, and the first ten paths."""
    pending, bad = F.coalesce(F.col("reviewed") != "yes", F.lit(True)), ~F.coalesce(F.col("confirmed_label").isin(*classes), F.lit(False))
    first = sheet.where(pending | bad).orderBy("source_path").limit(10).agg(F.array_join(F.sort_array(F.collect_list("source_path")), ",").alias("first"))
    return sheet.agg(F.count_if(pending).alias("n_pending"), F.count_if(bad).alias("n_bad_label"), F.count_if(~pending & ~bad).alias("n_ready")).crossJoin(first)


def dataset_integrity(images: DataFrame, labels: DataFrame) -> DataFrame:
    """Every stem with what it lacks, and whether its label line has 5 or 5 + 3k fields."""
    a, b = images.select("stem", "view"), labels.select("stem", "line")
    both = a.withColumn("_i", F.lit(1)).join(b.withColumn("_l", F.lit(1)), "stem", "full_outer")
    n = F.size(F.split(F.trim("line"), r"\s+"))
    problem = F.when(F.col("_l").isNull(), "image_without_label").when(F.col("_i").isNull(), "label_without_image").when((n < 5) | ((n - 5) % 3 != 0), "bad_line")
    return both.select("stem", "view", problem.alias("problem"))


def schema_purity(labels: DataFrame, by: str = "dir") -> DataFrame:
    """Directories with the field counts of their lines; pure if there is one."""
    n = F.size(F.split(F.trim("line"), r"\s+"))
    return labels.groupBy(by).agg(F.sort_array(F.collect_set(n)).alias("fields")).withColumn("pure", F.size("fields") == 1)


def view_counts(images: DataFrame, labels: DataFrame) -> DataFrame:
    """R10 per view: images, those that cannot be read (width below 0 or unknown), and those without a sound label."""
    unreadable = images.select("stem", F.coalesce(F.col("width") < 0, F.lit(True)).alias("_bad"))
    found = dataset_integrity(images, labels).where("view IS NOT NULL").join(unreadable, "stem")
    return found.groupBy("view").agg(F.count("*").alias("n_images"), F.count_if("_bad").alias("n_unreadable"), F.count_if(F.col("problem").isNotNull()).alias("n_problems"))


def first_rows(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """One row: the first n values of a column, comma-joined ('' if there are none); no more than n rows of a task meet."""
    return df.orderBy(column).limit(n).agg(F.array_join(F.sort_array(F.collect_list(column)), ",").alias("first"))


def prelabel_summary(report: DataFrame, n: int = 10) -> DataFrame:
    """R3 of a wheel-box run (stem, success, boxes_written, error): totals and the first n failures."""
    totals = report.agg(F.count("*").alias("total"), F.count_if("success").alias("succeeded"), F.count_if(~F.col("success")).alias("failed"), F.coalesce(F.sum("boxes_written"), F.lit(0)).alias("boxes"))
    failures = report.where(~F.col("success")).select(F.concat_ws(": ", "stem", "error").alias("failure"))
    return totals.crossJoin(first_rows(failures, "failure", n))  # one row each


def pool_status(images: DataFrame, annotated: DataFrame, trained: DataFrame, exceptions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """How many images (stem) there are, are annotated, trained, excepted, and pending, that is none of these; over all
    and, with by, per group as well (whole is true for all), in one pass over the images. An image in several lists counts
    in each of them; repeated stems of a list count once."""
    out = images
    for name, known in (("_annotated", annotated), ("_trained", trained), ("_excepted", exceptions)):
        keys = known.select(F.col("stem").alias(name)).distinct()
        out = out.join(keys, F.col("stem") == F.col(name), "left")
    flag = {n: F.col(f"_{n}").isNotNull() for n in ("annotated", "trained", "excepted")}
    counts = [F.count("*").alias("total"), *(F.count_if(f).alias(f"n_{n}") for n, f in flag.items()), F.count_if(~(flag["annotated"] | flag["trained"] | flag["excepted"])).alias("n_pending")]
    if not by:
        return out.agg(F.lit(True).alias("whole"), *counts)
    groups = [F.col(c) for c in by]
    return out.groupingSets([[], groups], *groups).agg((F.grouping_id() > 0).alias("whole"), *counts)


def match_counts(matched: DataFrame, n: int | None = None) -> DataFrame:
    """Train, val, and matches by kind of source; with n also the first n stems without a source."""
    counts = matched.agg(
        F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "val").alias("n_val"),
        F.count_if(F.col("source_kind") == "wheel").alias("n_wheel"), F.count_if(F.col("source_kind") == "legacy").alias("n_legacy"),
        F.count_if(F.col("source_kind").isNull()).alias("n_missing"),
    )
    if n is None:
        return counts
    return counts.crossJoin(first_rows(matched.where("source_kind IS NULL"), "stem", n))  # one row each


def require_wheel_match(counts: DataFrame) -> DataFrame:
    """The counts of match_counts; an error where no label has a wheel source, raised when the row is computed."""
    bad = F.when(F.col("n_wheel") == 0, F.raise_error(F.lit("no label matches an image of a wheel source")))
    return counts.withColumn("n_wheel", F.coalesce(bad.cast("long"), F.col("n_wheel")))


def run_summary(df: DataFrame, **params) -> DataFrame:
    """Selected and passed-over rows with the parameters, one row."""
    return df.agg(F.count_if(F.col("status") == "selected").alias("selected"), F.count_if(F.col("status") != "selected").alias("rejected"), *(F.lit(v).alias(k) for k, v in params.items()))
