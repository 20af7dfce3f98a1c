"""Queries over keypoints: estimation, checks, and label lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameyard.functions import params as P
from frameyard.functions.columns import geometry_score, orientation
from frameyard.operators import keypoints as K
from frameyard.operators import reports
from frameyard.operators.suggest import suggest
from frameyard.plans.bind import BOXES, IMAGES, SPARK_WHEELS, WHEELS, Inputs, duck, query
from frameyard.plans.gates import NORMAL, _normal

TEMPLATE = ", ".join(f"('{n}', CAST({x!r} AS DOUBLE), CAST({y!r} AS DOUBLE), CAST({c!r} AS DOUBLE))" for n, x, y, c in P.TEMPLATE)
PRIORS = f"""t(label, x, y, c) AS (VALUES {TEMPLATE}), tp AS (SELECT label, (x - 235.0) / 575.0 AS xn, (y - 864.0) / 94.0 AS yn, c FROM t WHERE label NOT LIKE '%wheel%')"""
HEAD = "CASE WHEN abs({a} - {b}) <= 1 THEN 'ambiguous' WHEN {a} > {b} THEN 'right-looking' ELSE 'left-looking' END"
SCORE = "(0.4 * least(greatest(wb / 180.0, 0.0), 1.0) + 0.3 * least(greatest(r / 35.0, 0.0), 1.0) + 0.3 * (1.0 - least(1.0, dy / greatest(r * 0.8, 1.0))))"
MEASURED = f"""w AS ({duck(WHEELS)}), m AS (SELECT *, abs(front_cx - rear_cx) AS wb, (abs(front_gy - front_cy) + abs(rear_gy - rear_cy)) / 2.0 AS r, abs(front_gy - rear_gy) AS dy,
CASE WHEN front_cx >= rear_cx THEN 1.0 ELSE -1.0 END AS way, {HEAD.format(a='front_cx', b='rear_cx')} AS heading FROM w)"""
ESTIMATED = f"""{MEASURED}, {PRIORS}, names(label) AS (VALUES {", ".join(f"('{n}')" for n in P.KEYPOINTS)}),
e AS (SELECT stem, names.label, heading, wb < 20 OR r < 8 AS lost,
CASE names.label WHEN 'front_wheel_center' THEN front_cx WHEN 'front_wheel_ground' THEN front_gx WHEN 'rear_wheel_center' THEN rear_cx WHEN 'rear_wheel_ground' THEN rear_gx WHEN 'ground_ref' THEN (front_gx + rear_gx) / 2.0 ELSE rear_gx + way * xn * wb END AS x,
CASE names.label WHEN 'front_wheel_center' THEN front_cy WHEN 'front_wheel_ground' THEN front_gy WHEN 'rear_wheel_center' THEN rear_cy WHEN 'rear_wheel_ground' THEN rear_gy WHEN 'ground_ref' THEN (front_gy + rear_gy) / 2.0 ELSE rear_gy + yn * r END AS y,
CASE WHEN names.label LIKE '%wheel%' OR names.label = 'ground_ref' THEN confidence ELSE least(greatest(0.6 * confidence + 0.25 * {SCORE} + 0.15 * c - CASE WHEN dy <= r * 0.5 THEN 0.0 ELSE 0.3 END, 0.25), 1.0) END AS conf
FROM m CROSS JOIN names LEFT JOIN tp ON tp.label = names.label),
f AS (SELECT stem, label, heading, CASE WHEN lost THEN 0.0 ELSE x END AS x, CASE WHEN lost THEN 0.0 ELSE y END AS y, CASE WHEN lost THEN 0.2 ELSE conf END AS conf FROM e)"""


def _wheels(x: Inputs) -> DataFrame:
    return x.sql(SPARK_WHEELS)


@query("k4_k9b_orientation_score", f"WITH {MEASURED} SELECT stem, heading, CAST(round({SCORE}, 6) AS DOUBLE) AS score FROM m")
def k4(x: Inputs) -> DataFrame:
    wb, r = F.abs(F.col("front_cx") - F.col("rear_cx")), (F.abs(F.col("front_gy") - F.col("front_cy")) + F.abs(F.col("rear_gy") - F.col("rear_cy"))) / 2.0
    dy = F.abs(F.col("front_gy") - F.col("rear_gy"))
    return _wheels(x).select("stem", orientation("front_cx", "rear_cx").alias("heading"), F.round(geometry_score(wb, r, dy), 6).alias("score"))


@query("k9_estimate_keypoints", f"WITH {ESTIMATED} SELECT stem, label, CAST(round(x, 4) AS DOUBLE) AS x, CAST(round(y, 4) AS DOUBLE) AS y, CAST(round(conf, 6) AS DOUBLE) AS confidence FROM f")
def k9(x: Inputs) -> DataFrame:
    out = K.estimate_keypoints(_wheels(x))
    return out.select("stem", "label", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"), F.round("confidence", 6).alias("confidence"))


@query("k7_learn_priors", f"""WITH {ESTIMATED}, g AS (SELECT m.stem, label, way * (f.x - rear_gx) / wb AS xn, (f.y - rear_gy) / r AS yn FROM f JOIN m USING (stem) WHERE wb >= 20 AND r >= 8 AND label NOT LIKE '%wheel%')
SELECT label, CAST(round(avg(xn), 6) AS DOUBLE) AS x_norm, CAST(round(avg(yn), 6) AS DOUBLE) AS y_norm, CAST(round(least(0.85, 0.55 + 0.01 * count(*)), 6) AS DOUBLE) AS confidence FROM g
WHERE NOT (label = 'front_bumper' AND xn <= 1.0) AND NOT (label = 'rear_bumper' AND xn >= 0.0) GROUP BY 1""")
def k7(x: Inputs) -> DataFrame:
    w = _wheels(x)
    out = K.learn_priors(w, K.estimate_keypoints(w))
    return out.select("label", *(F.round(c, 6).alias(c) for c in ("x_norm", "y_norm", "confidence")))


@query("k6_k8_plausible_priors", f"WITH {PRIORS}, s AS (SELECT label, xn, yn, c, s_suppkey FROM tp CROSS JOIN supplier), v AS (SELECT *, xn + CAST(s_suppkey % 21 - 10 AS DOUBLE) / 8.0 AS x2 FROM s) SELECT s_suppkey, label FROM v WHERE abs(x2 - xn) <= 0.8 AND NOT (label = 'front_bumper' AND x2 <= 1.0) AND NOT (label = 'rear_bumper' AND x2 >= 0.0)")
def k8(x: Inputs) -> DataFrame:
    t = K.template_priors(x.spark)
    shifted = t.crossJoin(x.table("supplier").select("s_suppkey")).withColumn("x_norm", F.col("x_norm") + (F.col("s_suppkey") % 21 - 10).cast("double") / 8.0)
    return K.plausible_priors(shifted, t).select("s_suppkey", "label")


#: Wide keypoints by arithmetic: the estimate's points, some moved by the row number.
WIDE = f"""{ESTIMATED}, p AS (SELECT f.stem, k, label, f.x + CASE WHEN label = 'front_bumper' AND k % 5 = 0 THEN -400.0 WHEN label = 'rear_bumper' AND k % 7 = 0 THEN 300.0 ELSE 0.0 END AS x,
f.y + CASE WHEN label = 'hood_edge' AND k % 6 = 0 THEN -500.0 ELSE 0.0 END AS y, conf, heading FROM f JOIN (SELECT stem, k FROM w) USING (stem) WHERE NOT (label = 'roof_apex' AND k % 9 = 0) AND NOT (label = 'rear_bumper' AND k % 11 = 0)),
d AS (SELECT stem, any_value(k) AS k, {", ".join(f"max(x) FILTER (label = '{n}') AS {n}_x, max(y) FILTER (label = '{n}') AS {n}_y, max(conf) FILTER (label = '{n}') AS {n}_c" for n in P.KEYPOINTS)} FROM p GROUP BY stem)"""


def _wide(x: Inputs) -> DataFrame:
    """Estimates with points moved or missing, in the row of their wheels."""
    wide, k = K.estimate_wide(_wheels(x)), F.col("k")

    def moved(n: str) -> Column:
        dx = {"front_bumper": F.when(k % 5 == 0, -400.0), "rear_bumper": F.when(k % 7 == 0, 300.0)}.get(n)
        dy = {"hood_edge": F.when(k % 6 == 0, -500.0)}.get(n)
        p = F.col(n)
        point = F.struct(*((p[a] if d is None else p[a] + d.otherwise(0.0)).alias(a) for a, d in (("x", dx), ("y", dy))), p["confidence"].alias("confidence"))
        gone = {"roof_apex": k % 9 == 0, "rear_bumper": k % 11 == 0}.get(n)
        return (point if gone is None else F.when(~gone, point)).alias(n)

    wide = wide.select("stem", *map(moved, P.KEYPOINTS))
    conf = F.array_compact(F.array(*(F.col(n)["confidence"] for n in P.KEYPOINTS)))
    return wide.withColumn("avg_confidence", F.try_divide(F.aggregate(conf, F.lit(0.0), lambda s, v: s + v), F.size(conf)))


@query("k3_pivot", f"WITH {WIDE} SELECT stem, CAST(round(front_bumper_x, 4) AS DOUBLE) AS front_x, CAST(round(rear_bumper_x, 4) AS DOUBLE) AS rear_x, CAST(round(roof_apex_y, 4) AS DOUBLE) AS roof_y FROM d")
def k3(x: Inputs) -> DataFrame:
    wide = _wide(x)
    each = F.array(*(F.struct(F.lit(n).alias("label"), F.col(n).alias("p")) for n in ("front_bumper", "rear_bumper", "roof_apex")))
    long = wide.select("stem", F.explode(each).alias("e")).where("e.p IS NOT NULL").select("stem", "e.label", "e.p.*")
    return K.pivot_keypoints(long).select("stem", F.round("front_bumper.x", 4).alias("front_x"), F.round("rear_bumper.x", 4).alias("rear_x"), F.round("roof_apex.y", 4).alias("roof_y"))


WB, A, B = "abs(front_wheel_center_x - rear_wheel_center_x)", "abs(front_wheel_ground_y - front_wheel_center_y)", "abs(rear_wheel_ground_y - rear_wheel_center_y)"
BUMPERS = HEAD.format(a="front_bumper_x", b="rear_bumper_x")
WHEEL_HEAD = HEAD.format(a="front_wheel_center_x", b="rear_wheel_center_x")
BUMP = f"CASE WHEN rear_bumper_x IS NOT NULL THEN {BUMPERS} END"
NEAREST = "least(hood_edge_y, front_bumper_y, rear_bumper_y, windshield_base_y, rear_glass_base_y, side_window_top_front_y, side_window_top_rear_y)"
LOW = "CASE WHEN {n}_c < 0.5 THEN 1 ELSE 0 END"
CODES_11 = f"""concat_ws('|', CASE WHEN abs(front_wheel_ground_y - rear_wheel_ground_y) > 100 THEN 'wheel_misalignment' END,
{", ".join(f"CASE WHEN {n}_y <= roof_apex_y THEN 'invalid_geometry' END" for n in ("hood_edge", "front_bumper", "rear_bumper"))},
CASE WHEN {BUMP} = 'ambiguous' THEN 'orientation_ambiguous' END, CASE WHEN {WB} < 40 OR {WB} > 5000 THEN 'invalid_wheelbase' END,
CASE WHEN {" + ".join(LOW.format(n=n) for n in P.KEYPOINTS)} > 5 THEN 'low_confidence' END)"""


def _codes(c: str = "warnings"):
    return F.array_join(F.transform(c, lambda w: F.substring_index(w, ":", 1)), "|")


@query("k11_geometry_warnings", f"WITH {WIDE} SELECT stem, {CODES_11} AS codes FROM d")
def k11(x: Inputs) -> DataFrame:
    return K.geometry_warnings(_wide(x), wheels=False).select("stem", _codes().alias("codes"))


CODES_15 = f"""concat_ws('|', CASE WHEN roof_apex_x IS NULL OR rear_bumper_x IS NULL THEN 'missing_required' END,
CASE WHEN {" + ".join(LOW.format(n=n) for n in P.KEYPOINTS)} > 0 THEN 'low_confidence' END,
CASE WHEN {WB} < 40 OR {WB} > 5000 THEN 'wheel_geometry_invalid' END, CASE WHEN abs(front_wheel_ground_y - rear_wheel_ground_y) > 50 THEN 'wheel_misalignment' END,
CASE WHEN least({A}, {B}) > 0 AND greatest({A}, {B}) / least({A}, {B}) > 1.2 THEN 'non_90_pov' END, CASE WHEN least({A}, {B}) <= 0 THEN 'wheel_geometry_invalid' END,
CASE WHEN {WHEEL_HEAD} = 'ambiguous' THEN 'orientation_ambiguous' END, CASE WHEN {NEAREST} - roof_apex_y < 20 THEN 'roof_clearance_low' END,
{", ".join(f"CASE WHEN {n}_y <= roof_apex_y THEN 'invalid_geometry' END" for n in ("hood_edge", "front_bumper", "rear_bumper"))},
CASE WHEN roof_apex_x IS NULL THEN 'missing_required' END, CASE WHEN {BUMP} = 'ambiguous' THEN 'orientation_ambiguous' END,
CASE WHEN {BUMP} <> 'ambiguous' AND {WHEEL_HEAD} <> 'ambiguous' AND {BUMP} <> {WHEEL_HEAD} THEN 'orientation_inconsistent' END)"""
CHECKED_15 = f"{WIDE}, v AS (SELECT stem, {CODES_15} AS codes FROM d), s AS (SELECT *, CASE WHEN regexp_matches(codes, 'invalid_geometry|missing_required|wheel_geometry_invalid') THEN 'INVALID' WHEN codes <> '' THEN 'REVIEW' ELSE 'VALID' END AS status FROM v)"


@query("k15_validate_19kp", f"WITH {CHECKED_15} SELECT stem, codes, status FROM s")
def k15(x: Inputs) -> DataFrame:
    return K.validate_19(_wide(x)).select("stem", _codes().alias("codes"), "status")


@query("r4_status_counts", f"WITH {CHECKED_15} SELECT count(*) FILTER (status = 'VALID') AS n_valid, count(*) FILTER (status = 'REVIEW') AS n_review, count(*) FILTER (status = 'INVALID') AS n_invalid, count(*) FILTER (codes <> '') AS n_warned, count(*) FILTER (regexp_matches(codes, 'low_confidence')) AS n_low_confidence FROM s")
def r4(x: Inputs) -> DataFrame:
    return reports.status_counts(K.validate_19(_wide(x)))


def _out(x: str, wheel: str, front: bool, margin: str) -> str:
    ahead, behind = f"{x} >= {wheel} + {margin}", f"{x} <= {wheel} - {margin}"
    a, b = (ahead, behind) if front else (behind, ahead)
    return f"CASE {WHEEL_HEAD} WHEN 'right-looking' THEN {a} WHEN 'left-looking' THEN {b} ELSE false END"


MARGIN = f"greatest({WB} * 0.04, ({A} + {B}) * 0.1)"
SOUND = f"(rear_bumper_x IS NOT NULL AND {A} + {B} > 1 AND {WB} > 1)"
CODES_16 = f"""concat_ws('|', CASE WHEN rear_bumper_x IS NULL THEN 'missing_required' END, CASE WHEN rear_bumper_x IS NOT NULL AND {WHEEL_HEAD} = 'ambiguous' THEN 'orientation_ambiguous' END,
CASE WHEN rear_bumper_x IS NOT NULL AND NOT {SOUND} THEN 'invalid_wheel_geometry' END,
CASE WHEN {SOUND} AND NOT {_out('front_bumper_x', 'front_wheel_center_x', True, MARGIN)} THEN 'front_endpoint_inside_body' END,
CASE WHEN {SOUND} AND NOT {_out('rear_bumper_x', 'rear_wheel_center_x', False, MARGIN)} THEN 'rear_endpoint_inside_body' END,
CASE WHEN {SOUND} AND NOT {WB} / ({A} + {B}) BETWEEN 2.8 AND 6.5 THEN 'wheelbase_ratio_invalid' END,
CASE WHEN {SOUND} AND NOT abs(front_bumper_x - front_wheel_center_x) / ({A} + {B}) BETWEEN 0.25 AND 2.75 THEN 'overhang_ratio_invalid' END,
CASE WHEN {SOUND} AND NOT abs(rear_bumper_x - rear_wheel_center_x) / ({A} + {B}) BETWEEN 0.25 AND 2.75 THEN 'overhang_ratio_invalid' END)"""


@query("k16_validate_7kp", f"WITH {WIDE}, v AS (SELECT stem, {CODES_16} AS codes FROM d) SELECT stem, codes, CASE WHEN codes <> '' THEN 'INVALID' ELSE 'VALID' END AS status FROM v")
def k16(x: Inputs) -> DataFrame:
    return K.validate_7(_wide(x)).select("stem", _codes().alias("codes"), "status")


ROOM = f"greatest({WB} * 0.04, 1.0)"
CODES_18 = f"""concat_ws('|', CASE WHEN rear_bumper_x IS NULL THEN 'missing_predictions' END, CASE WHEN rear_bumper_x IS NOT NULL AND ({WHEEL_HEAD} = 'ambiguous' OR {WB} <= 1) THEN 'orientation_ambiguous' END,
CASE WHEN rear_bumper_x IS NOT NULL AND NOT {_out('front_bumper_x', 'front_wheel_center_x', True, ROOM)} THEN 'front_endpoint_inside_body' END,
CASE WHEN rear_bumper_x IS NOT NULL AND NOT {_out('rear_bumper_x', 'rear_wheel_center_x', False, ROOM)} THEN 'rear_endpoint_inside_body' END)"""


@query("k18_evaluate_predictions", f"WITH {WIDE}, v AS (SELECT stem, {CODES_18} AS codes FROM d) SELECT stem, codes, CASE WHEN codes = '' THEN 'PASS' ELSE 'FAIL' END AS status FROM v")
def k18(x: Inputs) -> DataFrame:
    return K.evaluate_predictions(_wide(x)).select("stem", _codes().alias("codes"), "status")


@query("k18b_promotion_gate", f"WITH {WIDE}, v AS (SELECT {CODES_18} AS codes FROM d) SELECT count(*) FILTER (codes = '') AS n_pass, count(*) AS total, count(*) FILTER (codes = '') >= floor(0.7 * count(*)) AS promoted FROM v")
def k18b(x: Inputs) -> DataFrame:
    return K.promotion_gate(K.evaluate_predictions(_wide(x)))


@query("k12_wheels_from_boxes", f"""WITH i AS ({duck(IMAGES)}), b AS ({duck(BOXES)}), k AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY conf DESC, box_idx) AS k FROM b), t AS (SELECT stem, count(*) AS n, min((x1 + x2) / 2) AS l, max((x1 + x2) / 2) AS r, avg(conf) AS c FROM k WHERE k <= 2 GROUP BY 1)
SELECT i.stem, CASE WHEN n = 2 THEN r ELSE 0.72 * width END AS front_cx, CASE WHEN n = 2 THEN l ELSE 0.30 * width END AS rear_cx, CASE WHEN n = 2 THEN CAST(round(c, 6) AS DOUBLE) ELSE 0.35 END AS confidence, CASE WHEN n = 2 THEN 2 ELSE 0 END AS source_detections FROM i LEFT JOIN t USING (stem)""")
def k12(x: Inputs) -> DataFrame:
    out = K.wheels_from_boxes(x.sql(IMAGES).withColumn("heading", F.lit("right-looking")), x.boxes())
    return out.select("stem", "front_cx", "rear_cx", F.round("confidence", 6).alias("confidence"), "source_detections")


@query("k13_quality", """WITH p AS (SELECT p_partkey, CAST(40 + p_partkey % 61 AS DOUBLE) / 100.0 AS a, p_partkey % 3 AS n, p_partkey % 5 AS o, p_partkey % 4 AS w FROM part), s AS (SELECT *, least(greatest(a - CASE n WHEN 0 THEN 0.25 WHEN 1 THEN 0.10 ELSE 0.0 END
- CASE w WHEN 1 THEN 0.25 WHEN 2 THEN 0.06 + 0.02 ELSE 0.0 END - least(0.2, 0.02 * o), 0.0), 1.0) AS q FROM p)
SELECT p_partkey, CAST(round(q, 6) AS DOUBLE) AS score, CASE WHEN w = 1 OR q < 0.55 OR n = 0 OR o > 2 THEN 'REVIEW_HIGH' WHEN q < 0.75 THEN 'REVIEW_MEDIUM' ELSE 'REVIEW_LOW' END AS priority FROM s""")
def k13(x: Inputs) -> DataFrame:
    p = x.sql("SELECT p_partkey, CAST(40 + p_partkey % 61 AS DOUBLE) / 100.0 AS avg_confidence, p_partkey % 3 AS source_detections, p_partkey % 5 AS out_of_frame_count, p_partkey % 4 AS w FROM {part}")
    p = p.withColumn("warnings", F.when(F.col("w") == 1, F.array(F.lit("non_90_pov: x"))).when(F.col("w") == 2, F.array(F.lit("low_confidence: y"), F.lit("other"))).otherwise(F.array().cast("array<string>")))
    score, priority = K.quality()
    return p.select("p_partkey", F.round(score, 6).alias("score"), priority.alias("priority"))


@query("k14_low_phase", f"WITH {ESTIMATED} SELECT stem, CAST(round(min(conf), 6) AS DOUBLE) AS lowest FROM f WHERE label IN ('front_bumper', 'roof_apex') GROUP BY 1 HAVING min(conf) < 0.75")
def k14(x: Inputs) -> DataFrame:
    return K.low_phase(K.estimate_keypoints(_wheels(x)), ["front_bumper", "roof_apex"]).select("stem", F.round("lowest", 6).alias("lowest"))


FIVE = ("ground_ref", *P.WHEELS)


@query("k19_yolo_pose", f"""WITH {MEASURED}, n AS (SELECT stem, [((front_gx + rear_gx) / 2.0) / width, front_cx / width, front_gx / width, rear_cx / width, rear_gx / width] AS xs, [((front_gy + rear_gy) / 2.0) / height, front_cy / height, front_gy / height, rear_cy / height, rear_gy / height] AS ys FROM m),
b AS (SELECT *, greatest(0.0, list_min(xs) - 0.02) AS x0, least(1.0, list_max(xs) + 0.02) AS x1, greatest(0.0, list_min(ys) - 0.02) AS y0, least(1.0, list_max(ys) + 0.02) AS y1 FROM n)
SELECT stem, printf('0 %.6f %.6f %.6f %.6f', (x0 + x1) / 2, (y0 + y1) / 2, x1 - x0, y1 - y0) || ' ' || array_to_string([printf('%.6f %.6f 2.000000', xs[i], ys[i]) for i in range(1, 6)], ' ') AS line FROM b""")
def k19(x: Inputs) -> DataFrame:
    w = _wheels(x)
    point = lambda a, b: F.struct(F.col(a).alias("x"), F.col(b).alias("y"), F.col("confidence"))
    named = {"front_wheel_center": ("front_cx", "front_cy"), "front_wheel_ground": ("front_gx", "front_gy"), "rear_wheel_center": ("rear_cx", "rear_cy"), "rear_wheel_ground": ("rear_gx", "rear_gy")}
    wide = w.select("stem", "width", "height", *(point(*ab).alias(n) for n, ab in named.items()), point("rear_gx", "rear_gy").alias("ground_ref"))
    return K.to_yolo_pose(wide, FIVE)


@query("k20_yolo_bbox", f"WITH {NORMAL} SELECT stem, string_agg(printf('0 %.6f %.6f %.6f %.6f', cx, cy, w, h), chr(10) ORDER BY box_idx, printf('0 %.6f %.6f %.6f %.6f', cx, cy, w, h)) AS lines FROM d GROUP BY 1")
def k20(x: Inputs) -> DataFrame:
    return K.to_yolo_bbox(_normal(x))


@query("k22_prelabel_wheels", f"""WITH i AS ({duck(IMAGES)}), b AS ({duck(BOXES)}), k AS (SELECT b.*, width, height, row_number() OVER (PARTITION BY b.stem ORDER BY conf DESC, box_idx) AS k FROM b JOIN i ON b.stem = i.stem WHERE conf >= 0.25),
s AS (SELECT stem, count(*) AS n, count(*) FILTER (greatest(0, least(width, x2) - greatest(0, x1)) > 1 AND greatest(0, least(height, y2) - greatest(0, y1)) > 1) AS good FROM k WHERE k <= 2 GROUP BY 1)
SELECT i.stem, coalesce(n, 0) >= 2 AND good > 0 AS success, CAST(CASE WHEN coalesce(n, 0) >= 2 THEN good ELSE 0 END AS INTEGER) AS boxes_written FROM i LEFT JOIN s USING (stem)""")
def k22(x: Inputs) -> DataFrame:
    return K.prelabel_wheels(x.sql(IMAGES), x.boxes()).select("stem", "success", "boxes_written")


@query("r3_prelabel_summary", f"""WITH i AS ({duck(IMAGES)}), b AS ({duck(BOXES)}), k AS (SELECT b.*, width, height, row_number() OVER (PARTITION BY b.stem ORDER BY conf DESC, box_idx) AS k FROM b JOIN i ON b.stem = i.stem WHERE conf >= 0.25),
s AS (SELECT stem, count(*) AS n, count(*) FILTER (greatest(0, least(width, x2) - greatest(0, x1)) > 1 AND greatest(0, least(height, y2) - greatest(0, y1)) > 1) AS good FROM k WHERE k <= 2 GROUP BY 1),
r AS (SELECT i.stem, coalesce(n, 0) AS n, coalesce(n, 0) >= 2 AND good > 0 AS ok, CASE WHEN coalesce(n, 0) >= 2 THEN good ELSE 0 END AS boxes FROM i LEFT JOIN s USING (stem)),
e AS (SELECT stem || ': ' || CASE WHEN n < 2 THEN 'Detected ' || n || ' boxes (< min_boxes=2)' ELSE 'All detected boxes were invalid after normalization' END AS e FROM r WHERE NOT ok)
SELECT count(*) AS total, count(*) FILTER (ok) AS succeeded, count(*) FILTER (NOT ok) AS failed, CAST(sum(boxes) AS BIGINT) AS boxes, (SELECT string_agg(e, ',' ORDER BY e) FROM (SELECT e FROM e ORDER BY e LIMIT 10)) AS first FROM r""")
def r3b(x: Inputs) -> DataFrame:
    return reports.prelabel_summary(K.prelabel_wheels(x.sql(IMAGES), x.boxes()))


@query("k23_assemble", "SELECT CAST(p_partkey AS VARCHAR) AS stem, 'a/' || CAST(p_partkey AS VARCHAR) AS path FROM part WHERE p_partkey % 3 <> 0")
def k23(x: Inputs) -> DataFrame:
    labels = x.sql("SELECT CAST(p_partkey AS STRING) AS stem, 'train' AS split FROM {part}")
    images = x.sql("SELECT CAST(p_partkey AS STRING) AS stem, 0 AS source_rank, concat('a/', CAST(p_partkey AS STRING)) AS path FROM {part} WHERE p_partkey % 3 <> 0 UNION ALL SELECT CAST(p_partkey AS STRING), 1, 'b' FROM {part} WHERE p_partkey % 3 = 1")
    return K.assemble_pose_dataset(labels, images)[0].select("stem", "path")


@query("k24_check_boxes", "SELECT l_orderkey, l_linenumber, l_discount * 12 <= 1 AND l_tax * 20 <= 1 AS valid FROM lineitem")
def k24(x: Inputs) -> DataFrame:
    b = x.sql("SELECT l_orderkey, l_linenumber, l_discount * 12 AS cx, l_tax * 20 AS cy, 0.5D AS w, 0.5D AS h, 1.0D AS confidence FROM {lineitem}")
    return b.select("l_orderkey", "l_linenumber", K.check_boxes().alias("valid"))


@query("k1_k17_extract_rebuild")
def k17(x: Inputs) -> DataFrame:
    """Annotation JSON made of the wheels, some of it broken, read back and rebuilt."""
    shape = lambda n, a, b: f"""'{{{{"label": "{n}", "points": [[', CAST({a} AS STRING), ', ', CAST({b} AS STRING), ']], "shape_type": "point", "description": "confidence=', CAST(confidence AS STRING), '"}}}}'"""
    shapes = ", ', ', ".join(shape(n, f"{s}x", f"{s}y") for n, s in (("front_wheel_center", "front_c"), ("front_wheel_ground", "front_g"), ("rear_wheel_center", "rear_c"), ("rear_wheel_ground", "rear_g")))
    raw = f"""CASE WHEN k % 13 = 0 THEN 'broken' ELSE concat('{{{{"shapes": [', CASE WHEN k % 5 = 0 THEN '"stray", ' ELSE '' END, {shapes}, '], "imageWidth": ', CAST(width + 900 AS STRING), ', "imageHeight": ', CAST(height AS STRING), '}}}}') END"""
    docs = x.sql(f"SELECT stem, {raw} AS raw FROM ({SPARK_WHEELS}) AS s0")
    return K.rebuild_7(docs).select("stem", "status", "reason")


#: Images of a suggestion run: with or without a predicted heading, a few unreadable.
ASKED = f"""SELECT stem, CASE WHEN CAST(stem AS BIGINT) % 97 <> 0 THEN width END AS width, height, CASE CAST(stem AS BIGINT) % 3 WHEN 0 THEN 'left-looking' WHEN 1 THEN 'right-looking' END AS heading,
    CAST(CAST(stem AS BIGINT) % 100 AS DOUBLE) / 100.0 AS heading_confidence, CAST(CAST(stem AS BIGINT) % 7 AS DOUBLE) / 10.0 AS heading_margin FROM ({WHEELS}) AS i0"""
#: Boxes around the wheels, in a few images of too little confidence.
SEEN = " UNION ALL ".join(
    f"""SELECT stem, {i} AS box_idx, CASE WHEN k % 13 = 0 THEN 0.2e0 ELSE confidence END AS conf, {s}_cx - {s}_radius_px AS x1, {s}_cy - {s}_radius_px AS y1, {s}_cx + {s}_radius_px AS x2, {s}_gy AS y2 FROM ({WHEELS}) AS b{i}"""
    for i, s in enumerate(("front", "rear"))
)
OLD = "CAST(stem AS BIGINT) % 11 = 0"
_AT = lambda side, part: "CASE WHEN found THEN {0}.{1} ELSE CAST({2} AS DOUBLE) * {3} END".format(side[0], *{"cx": ("cx", "CASE WHEN (heading = 'left-looking') = {0} THEN 0.30 ELSE 0.72 END".format("true" if side == "front" else "false"), "width"), "cy": ("cy", "0.73", "height"), "gy": ("gy", "0.84", "height")}[part])
FOUND = f"""WITH i AS (SELECT stem, width, height, heading AS predicted, coalesce(heading, 'right-looking') AS heading, {OLD} AS old FROM ({duck(ASKED)})), k AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY conf DESC, box_idx) AS k FROM ({duck(SEEN)}) WHERE conf >= 0.25),
t AS (SELECT stem, list({{'cx': (x1 + x2) / 2, 'cy': (y1 + y2) / 2, 'gy': y2, 'conf': conf, 'r': greatest(1.0, (y2 - y1) / 2.0)}} ORDER BY x1 + x2, k) AS bs FROM k WHERE k <= 2 GROUP BY 1),
u AS (SELECT i.*, coalesce(len(bs) = 2, false) AS found, CASE heading WHEN 'left-looking' THEN bs[1] ELSE bs[2] END AS f, CASE heading WHEN 'left-looking' THEN bs[2] ELSE bs[1] END AS r FROM i LEFT JOIN t USING (stem))
SELECT stem, width, height, predicted, old, {", ".join(f"{_AT(s, p)} AS {s}_{q}" for s in ("front", "rear") for p, q in (("cx", "cx"), ("cy", "cy"), ("cx", "gx"), ("gy", "gy")))},
{", ".join(f"CASE WHEN found THEN {s[0]}.r ELSE abs(CAST(0.84 AS DOUBLE) * height - CAST(0.73 AS DOUBLE) * height) END AS {s}_radius_px" for s in ("front", "rear"))},
CASE WHEN found THEN (f.conf + r.conf) / 2 ELSE 0.35 END AS confidence, CASE WHEN found THEN 2 ELSE 0 END AS source_detections FROM u"""
_GIVEN = "((front_radius_px + rear_radius_px) / 2.0)"
AGAINST = f"""concat_ws('|', CASE WHEN abs(front_cx - rear_cx) / width < 0.32 THEN 'non_side_view' END, CASE WHEN abs(front_cx - rear_cx) / {_GIVEN} < 4.0 THEN 'non_side_view' END,
CASE WHEN greatest(front_gy, rear_gy) / height < 0.55 THEN 'non_side_view' END)"""
_OF = lambda n, c: f"max({c}) FILTER (label = '{n}')"
SAID = {
    "orientation_clip": "predicted IS NOT NULL", "fallback_wheels": "source_detections = 0", "wheel_misalignment": "abs(front_gy - rear_gy) > 100 AND NOT lost", "invalid_geometry": "hood_edge_y <= roof_apex_y",
    "invalid_geometry:2": "front_bumper_y <= roof_apex_y", "invalid_geometry:3": "rear_bumper_y <= roof_apex_y", "orientation_ambiguous": "bumpers = 'ambiguous'",
    "invalid_geometry:4": "bumpers <> 'ambiguous' AND wheels <> 'ambiguous' AND bumpers <> wheels", "invalid_wheelbase": "(CASE WHEN lost THEN 0.0 ELSE abs(front_cx - rear_cx) END) NOT BETWEEN 40 AND 5000", "low_confidence": "n_low > 5",
    "non_90_pov": "greatest(front_radius_px, rear_radius_px) / greatest(least(front_radius_px, rear_radius_px), 0.000001) > 1.20", "phase1_low_confidence": "least(confidence, CASE WHEN lost THEN 0.2 ELSE 1.0 END) < 0.75",
    "non_90_pov:2": "n_out > 2",
}
COST = " + ".join(f"CASE WHEN {c} THEN {P.PENALTIES.get(k.split(':')[0], P.OTHER_PENALTY)!r} ELSE 0.0 END" for k, c in SAID.items())
SUGGESTED = f"""{ESTIMATED.replace(f"w AS ({duck(WHEELS)})", f"w AS MATERIALIZED ({FOUND})").replace(", f AS (", ", f AS MATERIALIZED (")}, g AS (SELECT f.stem, {", ".join(f"{_OF(n, c)} AS {n}_{c}" for n, c in (("hood_edge", "y"), ("roof_apex", "y"), ("front_bumper", "x"), ("front_bumper", "y"), ("rear_bumper", "x"), ("rear_bumper", "y")))},
({" + ".join(_OF(n, 'conf') for n in P.KEYPOINTS)}) / {float(len(P.KEYPOINTS))!r} AS average, count(*) FILTER (conf < 0.5) AS n_low, count(*) FILTER (f.x < 0 OR f.x > width OR f.y < 0 OR f.y > height) AS n_out FROM f JOIN (SELECT stem, width, height FROM w) USING (stem) GROUP BY 1),
j AS (SELECT m.*, g.* EXCLUDE (stem), m.heading AS wheels, {HEAD.format(a='front_bumper_x', b='rear_bumper_x')} AS bumpers, wb < 20 OR r < 8 AS lost, {AGAINST} AS against FROM m JOIN g USING (stem)),
s AS (SELECT *, CASE WHEN old THEN 'exists' WHEN width IS NULL THEN 'unreadable' WHEN found AND against <> '' THEN 'gated' ELSE 'ok' END AS state, concat_ws('|', {", ".join(f"CASE WHEN {c} THEN '{k.split(':')[0]}' END" for k, c in SAID.items())}) AS codes,
least(greatest(average - CASE source_detections WHEN 0 THEN 0.25 ELSE 0.0 END - ({COST}) - least(0.2, 0.02 * n_out), 0.0), 1.0) AS score FROM (SELECT *, source_detections = 2 AS found FROM j))"""


@query("k14b_suggest", f"""WITH {SUGGESTED} SELECT stem, state = 'ok' AS success, CASE WHEN state IN ('ok', 'gated') THEN source_detections ELSE 0 END AS wheel_detections, CASE WHEN state = 'ok' THEN 19 ELSE 0 END AS keypoints_estimated,
CAST(round(CASE state WHEN 'ok' THEN average WHEN 'gated' THEN confidence ELSE 0.0 END, 6) AS DOUBLE) AS avg_confidence, CASE state WHEN 'ok' THEN codes WHEN 'gated' THEN concat_ws('|', CASE WHEN predicted IS NOT NULL THEN 'orientation_clip' END, against) WHEN 'exists' THEN 'File already exists' ELSE '' END AS codes,
CAST(round(CASE WHEN state = 'ok' THEN score ELSE 0.0 END, 6) AS DOUBLE) AS quality_score, CASE WHEN state <> 'ok' OR regexp_matches(codes, 'non_90_pov|phase1_low_confidence') OR score < 0.55 OR source_detections = 0 OR n_out > 2 THEN 'REVIEW_HIGH' WHEN score < 0.75 THEN 'REVIEW_MEDIUM' ELSE 'REVIEW_LOW' END AS review_priority,
CASE state WHEN 'ok' THEN bumpers WHEN 'gated' THEN coalesce(predicted, 'unknown') ELSE 'unknown' END AS orientation, CAST(CASE WHEN state = 'ok' THEN n_out ELSE 0 END AS INTEGER) AS out_of_frame_count,
CASE state WHEN 'gated' THEN 'rejected_non_side_view' WHEN 'unreadable' THEN 'Failed to read image' END AS error FROM s""")
def k14b(x: Inputs) -> DataFrame:
    images = x.sql(ASKED.replace(WHEELS, SPARK_WHEELS))
    out = suggest(images, x.sql(SEEN.replace(WHEELS, SPARK_WHEELS)), existing=images.where(OLD))
    return out.select("stem", "success", "wheel_detections", "keypoints_estimated", F.round("avg_confidence", 6).alias("avg_confidence"), _codes().alias("codes"), F.round("quality_score", 6).alias("quality_score"), "review_priority", "orientation", "out_of_frame_count", "error")
