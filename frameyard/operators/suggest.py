"""Keypoint suggestions end to end, and their storage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from frameyard.functions import params as P
from frameyard.functions.columns import fixed
from frameyard.functions.durable import _fs_path, materialize, release
from frameyard.operators.gates import side_view_warnings
from frameyard.operators.keypoints import bumper_orientation, geometry_warnings, placed_points, quality, wheels_from_boxes

REPORT = (
    "stem", "success", "wheel_detections", "keypoints_estimated", "avg_confidence", "warnings", "quality_score", "review_priority", "orientation", "out_of_frame_count", "error", "payload",
)


def ordered_names(phases: dict[str, tuple[str, ...]], only: str | None = None) -> list[str]:
    """Keypoints in the order of their phases, then the others; with only, those of that phase."""
    named = [n for phase, names in phases.items() if only in (None, phase) for n in names]
    return list(dict.fromkeys(named if only else [*named, *P.KEYPOINTS]))


def _payload(names: list[str], points: dict[str, Column]) -> Column:
    """The annotation document of a row: a point per keypoint, with its confidence in the description."""
    shape = lambda n: F.struct(
        F.lit(n).alias("label"), F.array(F.array(points[n]["x"], points[n]["y"])).alias("points"), F.lit("point").alias("shape_type"),
        F.concat(F.lit("confidence="), fixed(points[n]["confidence"], 3)).alias("description"),
    )
    document = F.struct(
        F.struct(F.lit(True).alias("agent1_generated")).alias("flags"), F.array(*map(shape, names)).alias("shapes"),
        F.col("width").alias("imageWidth"), F.col("height").alias("imageHeight"),
    )
    return F.to_json(document)


def suggest(
    images: DataFrame, boxes: DataFrame, priors: DataFrame | None = None, existing: DataFrame | None = None, phases: dict[str, tuple[str, ...]] = P.PHASES,
    phase_only: str | None = None, least_conf: float = 0.25, least_phase1: float = 0.75, gate: bool = True, least_ratio: float = 0.32,
) -> DataFrame:
    """One report row per image (stem, width, height, and from the orientation classifier heading, heading_confidence,
    heading_margin, null where it did not run), with the annotation as JSON in payload where there is one.

    Images whose stem is in existing are passed over; images without a size cannot be read; images whose wheels, found
    by boxes (stem, box_idx, conf, x1, y1, x2, y2), speak against a side view are rejected_non_side_view. The others get
    all keypoints from their wheels, or from anchors where fewer than two boxes are sure enough, with warnings, quality
    score and review priority. Wheels cost the one shuffle of the boxes by image; all the rest is one projection.
    """
    seen = images.limit(0).select("stem") if existing is None else existing.select("stem").distinct()
    flagged = images.join(seen.select(F.col("stem").alias("_seen")), F.col("stem") == F.col("_seen"), "left")
    flagged = flagged.withColumn("_old", F.col("_seen").isNotNull()).drop("_seen")
    readable = F.coalesce(F.col("width") > 0, F.lit(False)) & F.coalesce(F.col("height") > 0, F.lit(False))
    state = F.when(F.col("_old"), "exists").when(~readable, "unreadable")
    predicted = F.col("heading")
    asked = flagged.withColumn("_predicted", predicted).withColumn("_state", state).withColumn("heading", F.coalesce(predicted, F.lit("right-looking")))
    rows = wheels_from_boxes(asked, boxes.where(F.col("conf") >= least_conf))

    said = F.when(
        F.col("_predicted").isNotNull(),
        F.array(F.concat(F.lit("orientation_clip: "), "_predicted", F.lit(" confidence="), fixed("heading_confidence", 3), F.lit(" margin="), fixed("heading_margin", 3))),
    ).otherwise(F.array().cast("array<string>"))
    lost = F.when(F.col("source_detections") == 0, F.array(F.lit("fallback_wheels: detector missed wheels, used image-geometry anchors"))).otherwise(F.array().cast("array<string>"))
    against = side_view_warnings(least_ratio) if gate else F.array().cast("array<string>")
    against = F.when(F.col("source_detections") > 0, against).otherwise(F.array().cast("array<string>"))

    # the points are never columns: what the report needs of them is a few numbers a row, each made in a step of its own
    rows, at = placed_points(rows, priors)
    points = list(at.values())
    w, h = F.col("width"), F.col("height")
    outside = reduce(lambda a, b: a + b, (F.when((p["x"] < 0) | (p["x"] > w) | (p["y"] < 0) | (p["y"] > h), 1).otherwise(0) for p in points))
    average = reduce(lambda a, b: a + b, (p["confidence"] for p in points)) / F.lit(float(len(points)))
    first = [at[n]["confidence"] for n in phases.get("phase1", ()) if n in at]
    unsure = F.least(*first) < least_phase1 if len(first) > 1 else first[0] < least_phase1 if first else F.lit(False)
    more = lambda c, text: F.when(c, F.array(F.lit(text))).otherwise(F.array().cast("array<string>"))
    wide = geometry_warnings(rows, points=at).drop("valid").select(
        "*", outside.alias("_outside"), average.alias("_average"), unsure.alias("_unsure"), bumper_orientation(at["front_bumper"], at["rear_bumper"]).alias("_bumpers"),
        said.alias("_said"), against.alias("_against"),
    )
    done = F.concat(
        "_said", lost, "warnings", more(F.col("_unsure"), "phase1_low_confidence: one or more Phase 1 keypoints below threshold"),
        more(F.col("_outside") > 2, "non_90_pov: excessive out-of-frame keypoints suggest non-lateral view/crop"),
    )
    wide = wide.withColumns({"_done": done, "_state": F.coalesce("_state", F.when(F.size("_against") > 0, "gated"))})
    parts = ("_average", "_done", "source_detections", "_outside")
    wide = wide.withColumn("_score", quality(*parts)[0])
    score, priority = quality(*parts, scored="_score")
    names = ordered_names(phases, phase_only)
    ok, gated, old = F.col("_state").isNull(), F.col("_state") == "gated", F.col("_state") == "exists"
    none = F.array().cast("array<string>")
    return wide.select(
        "stem", ok.alias("success"), F.when(ok | gated, F.col("source_detections")).otherwise(0).alias("wheel_detections"), F.when(ok, len(names)).otherwise(0).alias("keypoints_estimated"),
        F.when(ok, F.col("_average")).when(gated, F.col("confidence")).otherwise(0.0).alias("avg_confidence"),
        F.when(ok, F.col("_done")).when(gated, F.concat("_said", "_against")).when(old, F.array(F.lit("File already exists"))).otherwise(none).alias("warnings"),
        F.when(ok, score).otherwise(0.0).alias("quality_score"), F.when(ok, priority).otherwise("REVIEW_HIGH").alias("review_priority"),
        F.when(ok, F.coalesce("_bumpers", F.lit("unknown"))).when(gated, F.coalesce("_predicted", F.lit("unknown"))).otherwise("unknown").alias("orientation"),
        F.when(ok, F.col("_outside")).otherwise(0).alias("out_of_frame_count"),
        F.when(gated, "rejected_non_side_view").when(F.col("_state") == "unreadable", "Failed to read image").alias("error"), F.when(ok, _payload(names, at)).alias("payload"),
    )


def existing_annotations(spark: SparkSession, path: str) -> DataFrame:
    """Stems that have an annotation under path; none before the first one is written."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return spark.createDataFrame([], "stem string")
    return spark.read.schema("stem string, payload string, bucket int").parquet(path).select("stem")


def save_annotations(suggested: DataFrame, path: str, overwrite: bool = False, buckets: int = 64) -> int:
    """Write the annotations of suggested (stem, payload; rows without a payload are passed over) and return how many.

    Annotations lie in buckets of their stem. Without overwrite stems that have one keep it, and where all have one
    nothing is written. With overwrite the buckets of the stems are written anew, with what else is in them; other
    buckets are not touched.
    """
    spark = suggested.sparkSession
    rows = suggested.where("payload IS NOT NULL").select("stem", "payload", F.pmod(F.xxhash64("stem"), F.lit(buckets)).cast("int").alias("bucket"))
    old = existing_annotations(spark, path)
    if not overwrite:
        rows = rows.join(old.distinct(), "stem", "left_anti")
    new = materialize(rows)
    n = new.count()
    if n and not overwrite:
        new.write.mode("append").partitionBy("bucket").parquet(path)
    elif n:
        fs, p = _fs_path(spark, path)
        out = new
        if fs.exists(p):
            stored = spark.read.schema("stem string, payload string, bucket int").parquet(path)
            kept = stored.join(F.broadcast(new.select("bucket").distinct()), "bucket", "left_semi").join(new.select("stem"), "stem", "left_anti")  # at most `buckets` rows
            out = materialize(new.unionByName(kept.select("stem", "payload", "bucket")))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
        if out is not new:
            release(out)
    release(new)
    return n
