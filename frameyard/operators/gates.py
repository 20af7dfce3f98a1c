"""Accept/reject gates. A gate adds outcome or reason columns and keeps every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameyard.functions import params as P
from frameyard.functions.columns import clamp, first_message, fixed, messages


def size_reason(width: str = "width", height: str = "height", rules: P.SizeRules = P.SizeRules()) -> Column:
    """Why a size or aspect fails, or null."""
    w, h = F.col(width), F.col(height)
    long_edge, short = F.greatest(w, h), F.least(w, h)
    aspect = w.cast("double") / F.nullif(h, F.lit(0)).cast("double")
    return first_message(
        (long_edge < rules.min_long_edge, F.concat(F.lit("too_small:"), long_edge.cast("string"), F.lit("px"))),
        (long_edge > rules.max_long_edge, F.concat(F.lit("too_large:"), long_edge.cast("string"), F.lit("px"))),
        (short == 0, "zero_dimension"),
        (aspect < rules.min_aspect, F.concat(F.lit("portrait_or_square:"), fixed(aspect, 2))),
        (aspect > rules.max_aspect, F.concat(F.lit("panoramic:"), fixed(aspect, 2))),
    )


def raw_pool_reason(width: str = "width", height: str = "height", rules: P.RawPoolRules = P.RawPoolRules()) -> Column:
    """The raw pool's size gate."""
    w, h = F.col(width), F.col(height)
    aspect = F.when(h > 0, w.cast("double") / h).otherwise(0.0)
    return first_message(
        (w.isNull() | h.isNull(), "missing_image_size"),
        (F.greatest(w, h) < rules.min_long_edge, F.concat(F.lit("too_small:"), w.cast("string"), F.lit("x"), h.cast("string"))),
        ((aspect < rules.min_aspect) | (aspect > rules.max_aspect), F.concat(F.lit("aspect_out_of_range:"), fixed(aspect, 3))),
    )


def decoded_reason(content: str = "content", width: str = "width") -> Column:
    """G1: empty or undecodable bytes."""
    return first_message((F.coalesce(F.length(content), F.lit(0)) == 0, "empty_response"), (F.coalesce(F.col(width), F.lit(-1)) < 0, "decode_failed"))


def normalize_detections(df: DataFrame, width: str = "width", height: str = "height") -> DataFrame:
    """Boxes of class car as centre and size relative to the image, clamped; area_px of the box as it was."""
    bw, bh = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    w, h = F.col(width).cast("double"), F.col(height).cast("double")
    return df.where((F.col("cls") == 2) & (bw > 0) & (bh > 0)).select(
        "*",
        clamp((F.col("x1") + F.col("x2")) / 2.0 / w).alias("cx"), clamp((F.col("y1") + F.col("y2")) / 2.0 / h).alias("cy"),
        clamp(bw / w).alias("w"), clamp(bh / h).alias("h"), (bw * bh).cast("long").alias("area_px"),
    )


def gate_car_presence(images: DataFrame, boxes: DataFrame, least: float = 0.30) -> DataFrame:
    """The largest box of each image (the first of equals), and whether it covers enough of the image."""
    best = Window.partitionBy("stem").orderBy(F.desc("area_px"), "box_idx")
    top = boxes.withColumn("_k", F.row_number().over(best)).where("_k = 1").select("stem", "box_idx", "area_px")
    area = F.col("width").cast("double") * F.col("height")
    reason = first_message(
        (F.col("area_px").isNull(), "no_detections"),
        ((area <= 0) | (F.col("area_px") / area < least), "car_area_below_ratio"),
    )
    return images.join(top, "stem", "left").withColumn("reason", reason)


def truncation_reason(margin: float = 0.0) -> Column:
    """Which side of the image cuts a box; left, right, top, bottom."""
    cx, cy, w, h = (F.col(c) for c in ("cx", "cy", "w", "h"))
    left, right, top, bottom = cx - w / 2, cx + w / 2, cy - h / 2, cy + h / 2
    say = lambda side, v: F.concat(F.lit(f"truncated_{side}:"), fixed(v, 2))
    return first_message((left < margin, say("left", left)), (right > 1 - margin, say("right", right)), (top < margin, say("top", top)), (bottom > 1 - margin, say("bottom", bottom)))


def face_reason(n_faces: str = "n_faces") -> Column:
    """G7"""
    return F.when(F.col(n_faces) > 0, "face_detected")


def margin_passes(kind: str, a: str, b: str) -> Column:
    """Gates on the best score of two prompt lists. real: a photo, b rendering; interior (true: interior): a inside,
    b outside; clean: a noisy, b clean; straight: a straight, b angled."""
    x, y = F.col(a), F.col(b)
    return {
        "real": (x >= 0.55) & (x - y >= 0.05), "interior": (x > y) | (x >= 0.45),
        "clean": (x < 0.35) & (x < y - 0.05), "straight": x - y >= 0.08,
    }[kind]


def view_reason(confidence: str = "confidence", margin: str = "margin", least: float = 0.60, least_margin: float = 0.10) -> Column:
    """G11"""
    c, m = F.col(confidence), F.col(margin)
    return first_message(
        (c.isNull(), "no_classification"),
        ((c < least) | (m < least_margin), F.concat(F.lit("conf="), fixed(c, 2), F.lit(" margin="), fixed(m, 2))),
    )


def run_cascade(df: DataFrame, gates: list[tuple[str, Column]], accepted: str = "accepted") -> DataFrame:
    """Outcome and reason_detail of the first gate (outcome, reason column) with a reason. Costly scores belong in
    a mapInPandas step that skips rows whose outcome is set (see scoring.score_images)."""
    outcome = F.coalesce(*(F.when(reason.isNotNull(), F.lit(name)) for name, reason in gates), F.lit(accepted))
    return df.withColumn("outcome", outcome).withColumn("reason_detail", F.coalesce(*(reason for _, reason in gates)))


def filter_has_vehicle(images: DataFrame, boxes: DataFrame, least: float = 0.25) -> DataFrame:
    """Name of the first box with a vehicle class and enough confidence, else none; action keep or discard."""
    names = F.create_map(*(F.lit(v) for kv in P.VEHICLE_CLASSES.items() for v in kv))
    ok = boxes.where(F.col("cls").isin(*P.VEHICLE_CLASSES) & (F.col("conf") >= least))
    first = ok.groupBy("stem").agg(F.min(F.struct("box_idx", "cls")).alias("_b")).select("stem", F.element_at(names, F.col("_b.cls")).alias("_v"))
    out = images.join(first, "stem", "left").withColumn("detected_vehicle", F.coalesce("_v", F.lit("none")))
    return out.withColumn("action", F.when(F.col("_v").isNull(), "discard").otherwise("keep")).drop("_v")


def side_view_warnings(least_ratio: float = 0.32, least_spacing: float = 4.0, least_ground: float = 0.55) -> Column:
    """All reasons against a lateral view, from wheel columns, width and height."""
    wheelbase = F.abs(F.col("front_cx") - F.col("rear_cx"))
    given = (F.col("front_radius_px") + F.col("rear_radius_px")) / 2.0
    derived = (F.abs(F.col("front_gy") - F.col("front_cy")) + F.abs(F.col("rear_gy") - F.col("rear_cy"))) / 2.0
    radius = F.when(given > 0, given).otherwise(derived)
    w, h = F.col("width").cast("double"), F.col("height").cast("double")
    return messages(
        ((w > 0) & (wheelbase / F.nullif(w, F.lit(0.0)) < least_ratio), "non_side_view: wheelbase too narrow for a clean lateral view"),
        ((radius > 0) & (wheelbase / F.nullif(radius, F.lit(0.0)) < least_spacing), "non_side_view: wheel spacing too small relative to wheel size"),
        ((h > 0) & (F.greatest("front_gy", "rear_gy") / F.nullif(h, F.lit(0.0)) < least_ground), "non_side_view: wheel ground appears too high in frame"),
    )


def name_is_anomalous(path: str, stem: str, words: list[str]) -> Column:
    """Any of the words in the lower-cased stem and path."""
    return F.lower(F.concat_ws(" ", stem, path)).rlike("|".join(words))


def prefix_reason(stem: str, prefix: str) -> Column:
    """G17"""
    return F.when(~F.col(stem).startswith(prefix), "wrong_prefix")


def readiness(raw: str = "raw", least: float = 0.7, resources: int = 2) -> Column:
    """First failing check of a JSON request, or null when it is ready."""
    v = f"try_parse_json({raw})"
    kind = lambda k: f"schema_of_variant(try_variant_get({v}, '$.{k}', 'variant'))"
    conf, res, task = (f"try_variant_get({v}, '$.{k}', '{t}')" for k, t in (("confidence", "double"), ("resources", "double"), ("task", "string")))
    numeric = lambda k: f"({kind(k)} RLIKE '^(BIGINT|DECIMAL|DOUBLE|FLOAT)')"
    return F.expr(f"""CASE
        WHEN {v} IS NULL OR NOT schema_of_variant({v}) LIKE 'OBJECT<%' THEN 'not_an_object'
        WHEN {task} IS NULL OR {conf} IS NULL OR {res} IS NULL THEN 'missing_key'
        WHEN {kind('task')} <> 'STRING' OR trim({task}) = '' THEN 'bad_task'
        WHEN NOT {numeric('confidence')} OR {conf} NOT BETWEEN 0 AND 1 THEN 'bad_confidence'
        WHEN {kind('resources')} <> 'BIGINT' OR {res} < 1 THEN 'bad_resources'
        WHEN {conf} < {least} OR {res} < {resources} THEN 'not_ready' END""")


def promote(df: DataFrame, prefix: str) -> DataFrame:
    """All rules that keep a row from training; columns stem, exception, status, corrected, outcome, priority,
    approved, fallback_only."""
    failing = messages(
        (~F.col("stem").startswith(prefix), "source_not_allowed"),
        (F.col("exception"), "exception"),
        ((F.col("status") != "VALID") & ~F.col("corrected"), "geometry"),
        (F.col("outcome") == "rejected_non_side_view", "non_side_view"),
        ((F.col("priority") == "REVIEW_HIGH") & ~F.col("approved"), "needs_approval"),
        (F.col("fallback_only"), "fallback_wheels"),
    )
    return df.withColumn("failing", failing).withColumn("promoted", F.size("failing") == 0)
