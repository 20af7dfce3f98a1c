"""Annotation operators. The shared shape is the long table keypoints(stem, pos, label, x, y, confidence); checks work
on one wide row per image whose columns are structs named by label."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from frameyard.functions import params as P
from frameyard.functions.codegen import short_methods
from frameyard.functions.columns import clamp, col, confidence_in, fixed, geometry_score, messages, orientation

POINT = "struct<x:double,y:double,confidence:double>"
#: Keypoints that the wheels give as they are.
GIVEN = (*P.WHEELS, "ground_ref")
#: What is read of an annotation's shape.
SHAPE = "struct<label:string,points:array<array<double>>,description:string,flags:struct<confidence:double,avg_confidence:double,score:double>>"


def extract_keypoints(docs: DataFrame, dialect: str = "any", order: tuple[str, ...] = ()) -> DataFrame:
    """K1, K2: keypoints of annotation JSON (stem, raw). Dialects: any (first shape of a label wins, two or more
    coordinates), exact (just two coordinates), last (the last shape wins, labels untrimmed), point (only shapes of type
    point with labels of order). A malformed shape costs only itself; in dialect last it costs its document."""
    parsed = docs.selectExpr("stem", "try_variant_get(try_parse_json(raw), '$.shapes', 'variant') AS v")
    shapes = docs.sparkSession.sql("SELECT stem, pos, value AS s FROM {parsed}, LATERAL variant_explode(v)", parsed=parsed)
    get = lambda p, t: F.expr(f"try_variant_get(s, '{p}', '{t}')")
    label = F.coalesce(get("$.label", "string"), F.lit(""))
    rows = shapes.select(
        "stem", "pos", (label if dialect == "last" else F.trim(label)).alias("label"), get("$.points[0][0]", "double").alias("x"),
        get("$.points[0][1]", "double").alias("y"), get("$.points[0][2]", "variant").alias("third"), get("$.shape_type", "string").alias("kind"),
        F.coalesce(
            F.expr("try_cast(nullif(regexp_extract(try_variant_get(s, '$.description', 'string'), '(?i)confidence\\\\s*=\\\\s*([0-9]*\\\\.?[0-9]+)', 1), '') AS double)"),
            *(get(f"$.flags.{k}", "double") for k in ("confidence", "avg_confidence", "score")),
        ).alias("confidence"),
    )
    bad = F.col("x").isNull() | F.col("y").isNull()
    if dialect == "last":
        rows = rows.withColumn("_bad", F.max(bad).over(Window.partitionBy("stem"))).where(~F.col("_bad"))
        by = F.desc("pos")
    else:
        rows = rows.where(~bad & (F.col("label") != ""))
        by = F.asc("pos")
    if dialect == "exact":
        rows = rows.where(F.col("third").isNull())
    if dialect == "point":
        rows = rows.where((F.col("kind") == "point") & F.col("label").isin(*order))
    w = Window.partitionBy("stem", "label")
    return (
        rows.withColumn("_k", F.row_number().over(w.orderBy(by))).withColumn("copies", F.count("*").over(w)).where("_k = 1")
        .select("stem", "pos", "label", "x", "y", "confidence", "copies")
    )


def pivot_keypoints(keypoints: DataFrame, names: tuple[str, ...] = P.KEYPOINTS) -> DataFrame:
    """K3: one row per image, a struct per label; x and y are there in every row. Plain numbers are aggregated, not structs,
    so that the groups are hashed and no task sorts all its points."""
    known = keypoints.where(F.col("label").isin(*names))
    first = lambda n, c: F.first(F.when(F.col("label") == n, c), ignorenulls=True)
    # a point without confidence must not take that of another point with its label
    conf = F.coalesce(F.col("confidence").cast("double"), F.lit(float("nan")))
    flat = known.groupBy("stem").agg(*(first(n, c).alias(f"_{n}_{i}") for n in names for i, c in enumerate((F.col("x"), F.col("y"), conf))))
    point = lambda n: F.struct(F.col(f"_{n}_0").alias("x"), F.col(f"_{n}_1").alias("y"), F.when(~F.isnan(f"_{n}_2"), F.col(f"_{n}_2")).alias("confidence"))
    return flat.select("stem", *(F.when(F.col(f"_{n}_0").isNotNull(), point(n)).alias(n) for n in names))


def bumper_orientation(front: str | Column = "front_bumper", rear: str | Column = "rear_bumper") -> Column:
    """K5"""
    front, rear = col(front), col(rear)
    return F.when(front.isNotNull() & rear.isNotNull(), orientation(front["x"], rear["x"]))


def _template_values() -> list[tuple[str, float, float, float]]:
    """K6 on the driver: the template's other points by wheelbase and radius about the rear ground, times 1."""
    at = {n: (x, y) for n, x, y, _ in P.TEMPLATE}
    wb = abs(at["front_wheel_center"][0] - at["rear_wheel_center"][0])
    radius = (abs(at["front_wheel_ground"][1] - at["front_wheel_center"][1]) + abs(at["rear_wheel_ground"][1] - at["rear_wheel_center"][1])) / 2.0
    gx, gy = at["rear_wheel_ground"]
    return [(n, (x - gx) / wb, (y - gy) / radius, c) for n, x, y, c in P.TEMPLATE if n not in P.WHEELS]


def template_priors(spark: SparkSession) -> DataFrame:
    """K6: (label, x_norm, y_norm, confidence), 15 rows."""
    return spark.createDataFrame(_template_values(), "label string, x_norm double, y_norm double, confidence double")


def plausible_priors(priors: DataFrame, template: DataFrame) -> DataFrame:
    """K8: priors near the template, bumpers on their sides."""
    t = template.select(F.col("label").alias("_l"), F.col("x_norm").alias("_x"), F.col("y_norm").alias("_y"))
    ok = (F.abs(F.col("x_norm") - F.col("_x")) <= 0.8) & (F.abs(F.col("y_norm") - F.col("_y")) <= 1.0)
    ok &= ~((F.col("label") == "front_bumper") & (F.col("x_norm") <= 1.0)) & ~((F.col("label") == "rear_bumper") & (F.col("x_norm") >= 0.0))
    return priors.join(F.broadcast(t), F.col("label") == F.col("_l")).where(ok).drop("_l", "_x", "_y")


def learn_priors(wheels: DataFrame, keypoints: DataFrame) -> DataFrame:
    """K7: mean place of each label relative to its image's wheels (rows with a wheels struct, see wheel_columns); points are
    mirrored by heading, bumpers between the wheels are dropped."""
    wb, radius = F.abs(F.col("front_cx") - F.col("rear_cx")), (F.abs(F.col("front_gy") - F.col("front_cy")) + F.abs(F.col("rear_gy") - F.col("rear_cy"))) / 2.0
    usable = wheels.where((wb >= 20) & (radius >= 8)).select("stem", wb.alias("_wb"), radius.alias("_r"), F.when(F.col("front_cx") >= F.col("rear_cx"), 1.0).otherwise(-1.0).alias("_d"), F.col("rear_gx").alias("_gx"), F.col("rear_gy").alias("_gy"))
    rel = (
        keypoints.where(~F.col("label").isin(*P.WHEELS) & F.col("label").isin(*P.KEYPOINTS)).join(usable, "stem")
        .select("label", (F.col("_d") * (F.col("x") - F.col("_gx")) / F.col("_wb")).alias("xn"), ((F.col("y") - F.col("_gy")) / F.col("_r")).alias("yn"))
        .where(~((F.col("label") == "front_bumper") & (F.col("xn") <= 1.0)) & ~((F.col("label") == "rear_bumper") & (F.col("xn") >= 0.0)))
    )
    return rel.groupBy("label").agg(F.avg("xn").alias("x_norm"), F.avg("yn").alias("y_norm"), F.least(F.lit(0.85), 0.55 + 0.01 * F.count("*")).alias("confidence"))


def _wheel_columns() -> list[Column]:
    """Wheel columns of a row with the four wheel points (K17's confidence rule); without one of them it has no place."""
    conf = F.array_compact(F.array(*(F.col(n)["confidence"] for n in P.WHEELS)))
    mean = F.try_divide(F.aggregate(conf, F.lit(0.0), lambda a, c: a + c), F.size(conf))
    named = [(s, e, n) for s, n in (("front_c", "front_wheel_center"), ("front_g", "front_wheel_ground"), ("rear_c", "rear_wheel_center"), ("rear_g", "rear_wheel_ground")) for e in "xy"]
    return [
        *(F.col(n)[e].alias(s + e) for s, e, n in named), F.coalesce(mean, F.lit(0.85)).alias("confidence"), F.lit(2).alias("source_detections"),
        F.abs(F.col("front_wheel_ground")["y"] - F.col("front_wheel_center")["y"]).alias("front_radius_px"),
        F.abs(F.col("rear_wheel_ground")["y"] - F.col("rear_wheel_center")["y"]).alias("rear_radius_px"),
    ]


def wheels_from_points(wide: DataFrame) -> DataFrame:
    """Wheel columns of images whose four wheel points are all there (K17's confidence rule)."""
    have = reduce(lambda a, b: a & b, (F.col(n).isNotNull() for n in P.WHEELS))
    return wide.where(have).select("stem", *_wheel_columns())


def _known_priors(wheels: DataFrame, priors: DataFrame | None) -> dict[str, tuple[float, float, float]]:
    """The template, and in its place the plausible ones of the learned priors, which have at most a row a keypoint."""
    known = {n: (x, y, c) for n, x, y, c in _template_values()}
    if priors is not None:
        template = template_priors(wheels.sparkSession)
        learned = plausible_priors(priors.select("label", "x_norm", "y_norm", "confidence"), template).collect()
        known |= {r["label"]: (r["x_norm"], r["y_norm"], r["confidence"]) for r in learned if r["label"] in known}
    return known


def _prior_table(known: dict[str, tuple]) -> Column:
    """A literal array with an entry per keypoint: its own prior and its locked partner's, both with the place among the
    given points (null: it is estimated), and side 1 or -1 at the front or rear of a locked pair, else 0."""
    given = {n: i for i, n in enumerate(GIVEN)}
    partner = {a: b for p in P.LOCKED_PAIRS for a, b in (p, p[::-1])}
    side = {n: s for p in P.LOCKED_PAIRS for n, s in zip(p, (1.0, -1.0))}
    double = lambda v, name: F.lit(v).cast("double").alias(name)
    prior = lambda n: F.struct(*(double(v, a) for a, v in zip("xyc", known.get(n, (None,) * 3))), F.lit(given.get(n)).cast("int").alias("at"))
    return F.array(*(
        F.struct(F.lit(i).alias("ord"), F.lit(n).alias("label"), double(side.get(n, 0.0), "side"), prior(n).alias("own"), prior(partner.get(n, n)).alias("other"))
        for i, n in enumerate(P.KEYPOINTS)
    ))


def placed_points(wheels: DataFrame, priors: DataFrame | None = None) -> tuple[DataFrame, dict[str, Column]]:
    """The rows of wheels with lost and the few numbers that place all keypoints, and by label the struct
    (x, y, confidence) made of them. A plausible learned prior beats the template; pairs whose order contradicts the
    heading are swapped. priors has at most a row a keypoint. Who needs only something of the points, such as a count,
    takes it from the structs and carries no point along: 19 structs are about a kilobyte a row, copied at every step."""
    short_methods(wheels.sparkSession)
    known = _known_priors(wheels, priors)
    c = {k: F.col(k) for k in ("front_cx", "front_cy", "front_gx", "front_gy", "rear_cx", "rear_cy", "rear_gx", "rear_gy", "confidence")}
    wb = F.abs(c["front_cx"] - c["rear_cx"])
    radius = (F.abs(c["front_gy"] - c["front_cy"]) + F.abs(c["rear_gy"] - c["rear_cy"])) / 2.0
    dy = F.abs(c["front_gy"] - c["rear_gy"])
    lost = (wb < 20) | (radius < 8)
    unless = lambda v, other=0.0: F.when(lost, other).otherwise(v)
    base = wheels.select(
        "*", lost.alias("lost"), unless(c["rear_gx"]).alias("_x"), unless(F.when(c["front_cx"] >= c["rear_cx"], wb).otherwise(-wb)).alias("_dx"), unless(c["rear_gy"]).alias("_y"), unless(radius).alias("_dy"),
        ((0.60 * c["confidence"]) + (0.25 * geometry_score(wb, radius, dy))).alias("_fused"), F.when(dy <= radius * 0.5, 0.0).otherwise(0.3).alias("_off"), unless(F.lit(0.25), 0.2).alias("_least"),
        unless(F.lit(1.0), 0.2).alias("_most"), orientation("front_cx", "rear_cx").alias("_heading"),
    )
    prior = {n: [F.lit(v).cast("double") for v in known[n]] for n in P.KEYPOINTS if n not in GIVEN}
    x = lambda xn: F.col("_x") + xn * F.col("_dx")
    right, left = F.col("_heading") == "right-looking", F.col("_heading") == "left-looking"
    wrong = [(right & (x(prior[f][0]) < x(prior[r][0]))) | (left & (x(prior[f][0]) > x(prior[r][0]))) for f, r in P.LOCKED_PAIRS]
    base = base.select("*", *(F.coalesce(w, F.lit(False)).alias(f"_swap{i}") for i, w in enumerate(wrong)))
    for i, pair in enumerate(P.LOCKED_PAIRS):
        own, swap = [prior[n] for n in pair], F.col(f"_swap{i}")
        for n, mine, other in zip(pair, own, own[::-1]):
            prior[n] = [F.when(swap, b).otherwise(a) for a, b in zip(mine, other)]
    given = {f"{side}_wheel_{part}": (c[f"{side}_{p}x"], c[f"{side}_{p}y"]) for side in ("front", "rear") for part, p in (("center", "c"), ("ground", "g"))}
    given["ground_ref"] = tuple((c[f"front_g{axis}"] + c[f"rear_g{axis}"]) / 2.0 for axis in "xy")

    def point(name: str) -> Column:
        if name in given:
            at = (F.when(F.col("lost"), other).otherwise(v) for v, other in zip((*given[name], c["confidence"]), (0.0, 0.0, 0.2)))
        else:
            xn, yn, sure = prior[name]
            at = x(xn), F.col("_y") + yn * F.col("_dy"), F.greatest("_least", F.least("_most", F.col("_fused") + 0.15 * sure - F.col("_off")))
        return F.struct(*(v.alias(a) for v, a in zip(at, ("x", "y", "confidence"))))

    return base, {n: point(n) for n in P.KEYPOINTS}


def estimate_wide(wheels: DataFrame, priors: DataFrame | None = None) -> DataFrame:
    """The rows of wheels with lost and a struct (x, y, confidence) for each of the 19 keypoints (placed_points): no row is
    multiplied and nothing is shuffled."""
    rows, points = placed_points(wheels, priors)
    return rows.select(*wheels.columns, "lost", *(p.alias(n) for n, p in points.items()))


def estimate_keypoints(wheels: DataFrame, priors: DataFrame | None = None) -> DataFrame:
    """K9 in long form: (stem, ord, label, x, y, confidence), the points of estimate_wide. The table of priors is exploded
    before the points are made, so that all of them go through one expression: one for each point makes a generated method
    over the 8000 bytes that the JVM compiles."""
    table = _prior_table(_known_priors(wheels, priors))
    c = {k: F.col(k) for k in ("front_cx", "front_cy", "front_gx", "front_gy", "rear_cx", "rear_cy", "rear_gx", "rear_gy", "confidence")}
    wb = F.abs(c["front_cx"] - c["rear_cx"])
    radius = (F.abs(c["front_gy"] - c["front_cy"]) + F.abs(c["rear_gy"] - c["rear_cy"])) / 2.0
    dy = F.abs(c["front_gy"] - c["rear_gy"])
    heading = orientation("front_cx", "rear_cx")
    lost = F.col("lost")
    unless = lambda v, other=0.0: F.when(lost, other).otherwise(v)
    given = {f"{side}_wheel_{part}": (c[f"{side}_{p}x"], c[f"{side}_{p}y"]) for side in ("front", "rear") for part, p in (("center", "c"), ("ground", "g"))}
    given["ground_ref"] = tuple((c[f"front_g{axis}"] + c[f"rear_g{axis}"]) / 2.0 for axis in "xy")
    base = wheels.withColumn("lost", (wb < 20) | (radius < 8)).select(
        "*", unless(c["rear_gx"]).alias("_x"), unless(F.when(c["front_cx"] >= c["rear_cx"], wb).otherwise(-wb)).alias("_dx"), unless(c["rear_gy"]).alias("_y"), unless(radius).alias("_dy"),
        ((0.60 * c["confidence"]) + (0.25 * geometry_score(wb, radius, dy))).alias("_fused"), F.when(dy <= radius * 0.5, 0.0).otherwise(0.3).alias("_off"),
        F.when(heading == "right-looking", 1.0).when(heading == "left-looking", -1.0).otherwise(0.0).alias("_turn"),
        F.array(*(F.struct(unless(x).alias("x"), unless(y).alias("y"), unless(c["confidence"], 0.2).alias("confidence")) for x, y in map(given.get, GIVEN))).alias("_given"),
    )
    x = lambda p: F.col("_x") + p["x"] * F.col("_dx")

    def holds(entry: Column) -> Column:
        way = F.col("_turn") * entry["side"]
        return F.when(way * x(entry["own"]) < way * x(entry["other"]), entry["other"]).otherwise(entry["own"])

    def point(p: Column) -> list[Column]:
        conf = unless(clamp(F.col("_fused") + 0.15 * p["c"] - F.col("_off"), 0.25, 1.0), 0.2)
        guess = {"x": x(p), "y": F.col("_y") + p["y"] * F.col("_dy"), "confidence": conf}
        return [F.when(p["at"].isNotNull(), F.get("_given", p["at"])[a]).otherwise(v).alias(a) for a, v in guess.items()]

    entries = base.select("stem", "lost", "_x", "_dx", "_y", "_dy", "_fused", "_off", "_turn", "_given", F.explode(table).alias("_entry")).withColumn("_prior", holds(F.col("_entry")))
    return entries.select("stem", "_entry.ord", "_entry.label", *point(F.col("_prior")))


def enforce_pairs(long: DataFrame) -> DataFrame:
    """Swaps the points of the locked pairs of images whose heading they contradict; lost and ambiguous images stay."""
    pair = F.create_map(*(F.lit(v) for i, p in enumerate(P.LOCKED_PAIRS) for n in p for v in (n, i)))
    front = F.col("label").isin(*(f for f, _ in P.LOCKED_PAIRS))
    w = Window.partitionBy("stem", "_pair")
    pick = lambda f: F.max(F.when(front if f else ~front, F.struct("x", "y", "confidence"))).over(w)
    tagged = long.withColumn("_pair", F.coalesce(F.element_at(pair, F.col("label")), F.lit(100) + F.col("ord")))
    both = tagged.withColumn("_f", pick(True)).withColumn("_r", pick(False))
    swap = (F.col("_pair") < 100) & ~F.col("lost") & (
        ((F.col("heading") == "right-looking") & (F.col("_f.x") < F.col("_r.x"))) | ((F.col("heading") == "left-looking") & (F.col("_f.x") > F.col("_r.x"))))
    swap = F.coalesce(swap, F.lit(False))
    other = F.when(front, F.col("_r")).otherwise(F.col("_f"))
    for c in ("x", "y", "confidence"):
        both = both.withColumn(f"_{c}", F.when(swap, other[c]).otherwise(F.col(c)))
    return both.drop("x", "y", "confidence", "_pair", "_f", "_r").withColumnsRenamed({f"_{c}": c for c in ("x", "y", "confidence")})


def geometry_warnings(wide: DataFrame, wheels: bool = True, points: dict[str, Column] | None = None) -> DataFrame:
    """Adds warnings and valid to wide keypoints; with wheels, columns front_cx, rear_cx and both radii are there.
    points are those of placed_points where wide has no columns of them."""
    at = points or {n: F.col(n) for n in P.KEYPOINTS}
    y = lambda n: at[n]["y"]
    has = lambda n: at[n].isNotNull()
    bumpers = bumper_orientation(at["front_bumper"], at["rear_bumper"])
    wb = F.abs(at["front_wheel_center"]["x"] - at["rear_wheel_center"]["x"])
    low = reduce(lambda a, b: a + b, (F.when(at[n]["confidence"] < 0.5, 1).otherwise(0) for n in P.KEYPOINTS))
    checks = [
        (F.abs(y("front_wheel_ground") - y("rear_wheel_ground")) > 100, "wheel_misalignment: front and rear wheels not level"),
        *((has("roof_apex") & (y(n) <= y("roof_apex")), f"invalid_geometry: {n} not below roof_apex") for n in ("hood_edge", "front_bumper", "rear_bumper")),
        (bumpers == "ambiguous", "orientation_ambiguous: front_bumper and rear_bumper are nearly aligned"),
    ]
    if wheels:
        heading = orientation("front_cx", "rear_cx")
        checks.append(((bumpers != "ambiguous") & (heading != "ambiguous") & (bumpers != heading), "invalid_geometry: bumper orientation disagrees with wheel orientation"))
    checks += [
        ((wb < 40) | (wb > 5000), F.concat(F.lit("invalid_wheelbase: "), fixed(wb, 1), F.lit("px (expected 40-5000)"))),
        (low > 5, F.concat(F.lit("low_confidence: "), low.cast("string"), F.lit(" keypoints below 0.5"))),
    ]
    if wheels:
        a, b = F.col("front_radius_px"), F.col("rear_radius_px")
        ratio = F.greatest(a, b) / F.greatest(F.least(a, b), F.lit(1e-6))
        checks.append(((a > 0) & (b > 0) & (ratio > 1.20), F.concat(F.lit("non_90_pov: wheel radius ratio "), fixed(ratio, 2), F.lit(" exceeds 1.20 (perspective likely)"))))
    return wide.withColumn("warnings", messages(*checks)).withColumn("valid", F.size("warnings") == 0)


def wheels_from_boxes(images: DataFrame, boxes: DataFrame) -> DataFrame:
    """Wheels of each image (stem, width, height, heading) from its two boxes of highest confidence; images with fewer
    than two boxes get anchors by image size, with no detections. Other columns of images come along. Boxes that agree in
    confidence and box_idx go by seq, if they have that column."""
    rank = Window.partitionBy("stem").orderBy(F.desc("conf"), "box_idx", *(c for c in boxes.columns if c == "seq"))
    box = {"cx": (F.col("x1") + F.col("x2")) / 2, "cy": (F.col("y1") + F.col("y2")) / 2, "gy": F.col("y2"), "conf": F.col("conf"), "radius": F.greatest(F.lit(1.0), (F.col("y2") - F.col("y1")) / 2.0), "at": F.col("x1") + F.col("x2"), "k": F.col("_k")}
    # the second box comes to the row of the first: plain numbers in the order that the join needs, with no group to build
    two = boxes.withColumn("_k", F.row_number().over(rank)).where("_k <= 2").select("stem", *(v.alias(f"_{n}1") for n, v in box.items()), *(F.lead(v).over(rank).alias(f"_{n}2") for n, v in box.items())).where("_k1 = 1 AND _k2 = 2")
    second_is_left = F.coalesce(F.col("_at1") > F.col("_at2"), F.col("_at2").isNull() & F.col("_at1").isNotNull())
    out = images.join(two.withColumn("_turned", second_is_left), "stem", "left")
    left = F.col("heading") == "left-looking"
    found = F.col("_k2").isNotNull()
    w, h = F.col("width").cast("double"), F.col("height").cast("double")
    cols = []
    for side in ("front", "rear"):
        at_left = left if side == "front" else ~left
        got = {n: F.when(F.coalesce(at_left, F.lit(False)) != F.col("_turned"), F.col(f"_{n}1")).otherwise(F.col(f"_{n}2")) for n in ("cx", "cy", "gy", "radius")}
        x = F.when(at_left, 0.30 * w).otherwise(0.72 * w)
        cols += [
            F.when(found, got["cx"]).otherwise(x).alias(f"{side}_cx"), F.when(found, got["cy"]).otherwise(0.73 * h).alias(f"{side}_cy"),
            F.when(found, got["cx"]).otherwise(x).alias(f"{side}_gx"), F.when(found, got["gy"]).otherwise(0.84 * h).alias(f"{side}_gy"),
            F.when(found, got["radius"]).otherwise(F.abs(0.84 * h - 0.73 * h)).alias(f"{side}_radius_px"),
        ]
    return out.select(
        *images.columns, *cols, F.when(found, (F.col("_conf1") + F.col("_conf2")) / 2).otherwise(0.35).alias("confidence"),
        F.when(found, 2).otherwise(0).alias("source_detections"),
    )


def quality(avg: str = "avg_confidence", warnings: str = "warnings", detections: str = "source_detections", outside: str = "out_of_frame_count", scored: str | None = None) -> tuple[Column, Column]:
    """Quality score and review priority; scored is the column of the score where it is made already."""
    code = lambda w: F.substring_index(w, ":", 1)
    cost = F.create_map(*(F.lit(v) for kv in P.PENALTIES.items() for v in kv))
    lost = F.aggregate(warnings, F.lit(0.0), lambda a, w: a + F.coalesce(F.element_at(cost, code(w)), F.lit(P.OTHER_PENALTY)))
    n = F.col(detections)
    score = F.col(avg) - F.when(n == 0, 0.25).when(n == 1, 0.10).otherwise(0.0) - lost - F.least(F.lit(0.20), 0.02 * F.col(outside))
    score = F.col(scored) if scored else clamp(score)
    hard = F.arrays_overlap(F.transform(warnings, code), F.array(F.lit("non_90_pov"), F.lit("phase1_low_confidence")))
    high = F.coalesce(hard, F.lit(False)) | (score < 0.55) | (n == 0) | (F.col(outside) > 2)
    return score, F.when(high, "REVIEW_HIGH").when(score < 0.75, "REVIEW_MEDIUM").otherwise("REVIEW_LOW")


def phase_order(phases: DataFrame, only: list[str] | None = None) -> DataFrame:
    """Labels in the order of their phases (phase, ord, label), then the others in keypoint order: (place, label)."""
    chosen = phases.where(F.col("phase").isin(*only)) if only else phases
    first = chosen.groupBy("label").agg(F.min(F.struct("phase", "ord")).alias("k"))
    if not only:
        rest = phases.sparkSession.createDataFrame(list(enumerate(P.KEYPOINTS)), "ord int, label string")
        rest = rest.join(first, "label", "left_anti").select("label", F.struct(F.lit("~").alias("phase"), "ord").alias("k"))
        first = first.unionByName(rest)
    return first.select(F.row_number().over(Window.orderBy("k")).alias("place"), "label")  # 19 rows


def low_phase(keypoints: DataFrame, labels: list[str], least: float = 0.75) -> DataFrame:
    """Images with a keypoint of the first phase below the least confidence."""
    return keypoints.where(F.col("label").isin(*labels)).groupBy("stem").agg(F.min("confidence").alias("lowest")).where(F.col("lowest") < least)


def _outside(x: Column, wheel: Column, heading: Column, front: bool, margin: Column) -> Column:
    ahead, behind = x >= wheel + margin, x <= wheel - margin
    right, left = (ahead, behind) if front else (behind, ahead)
    return F.when(heading == "right-looking", right).when(heading == "left-looking", left).otherwise(False)


def validate_19(wide: DataFrame, low: float = 0.50, dy_max: float = 50.0, ratio_max: float = 1.20, roof_min: float = 20.0) -> DataFrame:
    """Warnings, status and measures of wide rows; extra_keypoints and avg_confidence come as columns (extra_keypoints
    may be missing). Null columns are points that are not there."""
    y, x = (lambda n: F.col(n)["y"]), (lambda n: F.col(n)["x"])
    has = lambda n: F.col(n).isNotNull()
    if "extra_keypoints" not in wide.columns:
        wide = wide.withColumn("extra_keypoints", F.array().cast("array<string>"))
    missing = messages(*((~has(n), n) for n in P.KEYPOINTS))
    lows = messages(*((F.col(n)["confidence"] < low, n) for n in P.KEYPOINTS))
    wheels = reduce(lambda a, b: a & b, map(has, P.WHEELS))
    dy, wb = F.abs(y("front_wheel_ground") - y("rear_wheel_ground")), F.abs(x("front_wheel_center") - x("rear_wheel_center"))
    a, b = F.abs(y("front_wheel_ground") - y("front_wheel_center")), F.abs(y("rear_wheel_ground") - y("rear_wheel_center"))
    ratio = F.try_divide(F.greatest(a, b), F.least(a, b))
    heading, bumpers = F.when(wheels, orientation(x("front_wheel_center"), x("rear_wheel_center"))), bumper_orientation()
    nearest = F.array_min(F.array(*(y(n) for n in ("hood_edge", "front_bumper", "rear_bumper", "windshield_base", "rear_glass_base", "side_window_top_front", "side_window_top_rear"))))
    roof = nearest - y("roof_apex")
    join = lambda c: F.array_join(c, ", ")
    out = wide.withColumn("missing_keypoints", missing).withColumn("low_conf_keypoints", lows)
    warnings = messages(
        (F.size("missing_keypoints") > 0, F.concat(F.lit("missing_required: "), join("missing_keypoints"))),
        (F.size("extra_keypoints") > 0, F.concat(F.lit("extra_keypoints: "), join("extra_keypoints"))),
        (F.size("low_conf_keypoints") > 0, F.concat(F.lit("low_confidence: "), join("low_conf_keypoints"), F.lit(f" below {low:.2f}"))),
        (wheels & ((wb < 40) | (wb > 5000)), F.concat(F.lit("wheel_geometry_invalid: wheelbase "), fixed(wb, 1), F.lit("px outside 40-5000"))),
        (wheels & (dy > dy_max), F.concat(F.lit("wheel_misalignment: wheel ground y difference "), fixed(dy, 1), F.lit(f"px exceeds {dy_max:.1f}px"))),
        (wheels & (ratio > ratio_max), F.concat(F.lit("non_90_pov: wheel radius ratio "), fixed(ratio, 2), F.lit(f" exceeds {ratio_max:.2f}"))),
        (wheels & (F.least(a, b) <= 0), "wheel_geometry_invalid: zero wheel radius detected"),
        (heading == "ambiguous", "orientation_ambiguous: wheel centers are nearly aligned"),
        (~wheels, "wheel_geometry_invalid: missing one or more wheel keypoints"),
        (roof < roof_min, F.concat(F.lit("roof_clearance_low: roof apex is only "), fixed(roof, 1), F.lit("px above the nearest major landmark"))),
        *((y(n) <= y("roof_apex"), f"invalid_geometry: {n} is not below roof_apex") for n in ("hood_edge", "front_bumper", "rear_bumper")),
        (~has("roof_apex"), "missing_required: roof_apex"),
        (bumpers == "ambiguous", "orientation_ambiguous: front_bumper and rear_bumper are nearly aligned"),
        ((heading != "ambiguous") & (bumpers != "ambiguous") & (heading != bumpers), "orientation_inconsistent: bumper direction disagrees with wheel direction"),
    )
    hard = "malformed_json|invalid_keypoints|invalid_geometry|missing_required|wheel_geometry_invalid"
    out = out.withColumn("warnings", warnings)
    status = F.when((F.size("missing_keypoints") > 0) | F.array_join("warnings", "\n").rlike(hard), "INVALID").when(F.size("warnings") > 0, "REVIEW").otherwise("VALID")
    return out.select(
        *wide.columns, "missing_keypoints", "low_conf_keypoints", "warnings", status.alias("status"), F.when(wheels, dy).alias("wheel_y_diff_px"),
        F.when(wheels, wb).alias("wheelbase_px"), roof.alias("roof_clearance_px"), F.when(wheels, ratio).alias("wheel_radius_ratio"),
        F.coalesce(bumpers, heading).alias("orientation"),
    )


def validate_7(wide: DataFrame, rules: P.BodyEndRules = P.BodyEndRules()) -> DataFrame:
    """Body-end checks of wide rows with the seven keypoints; duplicates, if given, is an array column."""
    y, x = (lambda n: F.col(n)["y"]), (lambda n: F.col(n)["x"])
    if "duplicates" not in wide.columns:
        wide = wide.withColumn("duplicates", F.array().cast("array<string>"))
    missing = messages(*((F.col(n).isNull(), n) for n in P.SEVEN))
    whole = F.size(missing) == 0
    heading = F.when(whole, orientation(x("front_wheel_center"), x("rear_wheel_center"))).otherwise("")
    dia = F.abs(y("front_wheel_center") - y("front_wheel_ground")) + F.abs(y("rear_wheel_center") - y("rear_wheel_ground"))
    wb = F.abs(x("front_wheel_center") - x("rear_wheel_center"))
    sound = whole & (dia > 1.0) & (wb > 1.0)
    ratio, front = F.try_divide(wb, dia), F.try_divide(F.abs(x("front_bumper") - x("front_wheel_center")), dia)
    rear = F.try_divide(F.abs(x("rear_bumper") - x("rear_wheel_center")), dia)
    margin = F.greatest(wb * rules.outside_margin, dia * 0.10)
    f_out = _outside(x("front_bumper"), x("front_wheel_center"), heading, True, margin)
    r_out = _outside(x("rear_bumper"), x("rear_wheel_center"), heading, False, margin)
    span = lambda lo, hi: f"{lo:.2f}-{hi:.2f}"
    overhang = span(rules.min_overhang, rules.max_overhang)
    warnings = messages(
        (~whole, F.concat(F.lit("missing_required: "), F.array_join(missing, ", "))),
        (F.size("duplicates") > 0, F.concat(F.lit("duplicate_keypoints: "), F.array_join("duplicates", ", "))),
        (whole & (heading == "ambiguous"), "orientation_ambiguous: front/rear wheel centers are nearly aligned"),
        (whole & ~sound, "invalid_wheel_geometry: wheelbase or wheel diameter is too small"),
        (sound & ~f_out, "front_endpoint_inside_body: front_bumper is not outside front_wheel_center"),
        (sound & ~r_out, "rear_endpoint_inside_body: rear_bumper is not outside rear_wheel_center"),
        (sound & ~ratio.between(rules.min_wheelbase, rules.max_wheelbase), F.concat(F.lit("wheelbase_ratio_invalid: "), fixed(ratio, 2), F.lit(f" outside {span(rules.min_wheelbase, rules.max_wheelbase)}"))),
        (sound & ~front.between(rules.min_overhang, rules.max_overhang), F.concat(F.lit("overhang_ratio_invalid: front "), fixed(front, 2), F.lit(f" outside {overhang}"))),
        (sound & ~rear.between(rules.min_overhang, rules.max_overhang), F.concat(F.lit("overhang_ratio_invalid: rear "), fixed(rear, 2), F.lit(f" outside {overhang}"))),
    )
    hard = "front_endpoint_inside_body|rear_endpoint_inside_body|orientation_ambiguous|invalid_wheel_geometry|overhang_ratio_invalid|wheelbase_ratio_invalid"
    confs = F.array_compact(F.array(*(F.col(n)["confidence"] for n in P.SEVEN)))
    out = wide.withColumn("warnings", warnings)
    status = F.when(~whole | F.array_join("warnings", "\n").rlike(hard), "INVALID").when(F.size("warnings") > 0, "REVIEW").otherwise("VALID")
    return out.select(
        *wide.columns, missing.alias("missing_keypoints"), "warnings", status.alias("status"), heading.alias("orientation"),
        F.when(whole, wb).alias("wheelbase_px"), F.when(whole, dia).alias("wheel_diameter_px"), F.when(sound, ratio).alias("wheelbase_ratio"),
        F.when(sound, front).alias("front_overhang_ratio"), F.when(sound, rear).alias("rear_overhang_ratio"),
        F.when(sound, f_out).alias("front_outside_wheel"), F.when(sound, r_out).alias("rear_outside_wheel"),
        F.try_divide(F.aggregate(confs, F.lit(0.0), lambda s, c: s + c), F.size(confs)).alias("avg_confidence"),
    )


def _wheel_points(parsed: DataFrame) -> DataFrame:
    """The rows of parsed (v: annotation JSON) with a struct for each wheel point: what extract_keypoints (exact) and
    pivot_keypoints find for the document, but within its row. The shapes are read by one cast."""
    shapes = f"coalesce(try_variant_get(v, '$.shapes', 'array<{SHAPE}>'), map_values(try_variant_get(v, '$.shapes', 'map<string,{SHAPE}>')))"
    # no row without a stem has points, as none is joined to it
    rows = parsed.withColumn("_shapes", F.expr(f"CASE WHEN stem IS NOT NULL THEN {shapes} END"))
    whole = "size(get(s.points, 0)) = 2 AND get(s.points, 0)[0] IS NOT NULL AND get(s.points, 0)[1] IS NOT NULL"
    rows = rows.select(*parsed.columns, *(F.expr(f"get(filter(_shapes, s -> trim(s.label) = '{n}' AND {whole}), 0)").alias(f"_{n}") for n in P.WHEELS))

    def point(n: str) -> Column:
        at, flags = F.get(F.col(f"_{n}.points"), F.lit(0)), F.col(f"_{n}.flags")
        conf = F.coalesce(confidence_in(f"_{n}.description"), *(flags[k] for k in ("confidence", "avg_confidence", "score")))
        return F.when(F.col(f"_{n}").isNotNull(), F.struct(at[0].alias("x"), at[1].alias("y"), F.when(~F.isnan(conf), conf).alias("confidence"))).alias(n)

    return rows.select(*parsed.columns, *map(point, P.WHEELS))


def rebuild_7(docs: DataFrame, priors: DataFrame | None = None, existing: DataFrame | None = None, allow_outside: bool = False, overwrite: bool = False) -> DataFrame:
    """The seven keypoints rebuilt from the wheels of each document (stem, raw): status WRITE or SKIP, reason, and for
    WRITE the points and the JSON payload. Each document is parsed once and all is made within its row; only existing is
    joined."""
    parsed = docs.select("stem", F.expr("try_parse_json(raw)").alias("v"), F.col("raw").rlike(r"^\s*\{").alias("_object"))
    parsed = _wheel_points(parsed).select(
        "stem", (F.col("v").isNull() | ~F.col("_object")).alias("malformed"),
        *(F.expr(f"coalesce(try_variant_get(v, '$.image{k}', 'double'), 0)").alias(k.lower()) for k in ("Width", "Height")),
        F.expr("try_variant_get(v, '$.imagePath', 'string')").alias("image"), *P.WHEELS,
    )
    lacking = messages(*((F.col(n).isNull(), n) for n in P.WHEELS))
    out, points = placed_points(parsed.select("*", *_wheel_columns()), priors)
    out = out.withColumn("wheel_confidence", F.col("confidence")).withColumns({f"e_{n}": points[n] for n in ("ground_ref", "front_bumper", "rear_bumper")})
    if existing is None or overwrite:
        out = out.withColumn("exists", F.lit(False))
    else:
        out = out.join(existing.select("stem").distinct().withColumn("exists", F.lit(True)), "stem", "left")
    inside = lambda p: F.col(p)["x"].between(F.lit(0.0), F.col("width")) & F.col(p)["y"].between(F.lit(0.0), F.col("height"))
    gone = messages(*((~inside(f"e_{n}"), n) for n in ("front_bumper", "rear_bumper")))
    reason = (
        F.when(F.col("malformed"), "malformed_json").when(F.size(lacking) > 0, F.concat(F.lit("missing_wheels: "), F.array_join(lacking, ", ")))
        .when((F.col("width") <= 0) | (F.col("height") <= 0), "missing_image_dimensions")
        .when(F.lit(not allow_outside) & (F.size(gone) > 0), F.concat(F.lit("out_of_frame: "), F.array_join(gone, ", ")))
        .when(F.lit(not overwrite) & F.coalesce("exists", F.lit(False)), "output_exists").otherwise("ok")
    )
    point = lambda n, p, c: F.struct(F.lit(n).alias("label"), F.array(F.array(p["x"], p["y"])).alias("points"), F.lit("point").alias("shape_type"), F.concat(F.lit("confidence="), fixed(c, 3)).alias("description"))
    shapes = F.array(
        point("ground_ref", F.col("e_ground_ref"), F.col("wheel_confidence")), *(point(n, F.col(n), F.col("wheel_confidence")) for n in P.WHEELS),
        *(point(n, F.col(f"e_{n}"), F.col(f"e_{n}")["confidence"]) for n in ("front_bumper", "rear_bumper")),
    )
    payload = F.to_json(F.struct(shapes.alias("shapes"), F.coalesce("image", F.concat("stem", F.lit(".jpg"))).alias("imagePath"), F.col("height").cast("int").alias("imageHeight"), F.col("width").cast("int").alias("imageWidth")))
    return out.withColumn("reason", reason).select("stem", F.when(F.col("reason") == "ok", "WRITE").otherwise("SKIP").alias("status"), "reason", F.when(F.col("reason") == "ok", payload).alias("payload"))


def evaluate_predictions(wide: DataFrame, margin: float = 0.04) -> DataFrame:
    """PASS or FAIL of predicted points; an image with none of the points has no pose."""
    need = ("front_wheel_center", "rear_wheel_center", "front_bumper", "rear_bumper")
    x = lambda n: F.col(n)["x"]
    missing = messages(*((F.col(n).isNull(), n) for n in need))
    none = reduce(lambda a, b: a & b, (F.col(n).isNull() for n in need))
    whole = F.size(missing) == 0
    wb, heading = F.abs(x("front_wheel_center") - x("rear_wheel_center")), F.when(whole, orientation(x("front_wheel_center"), x("rear_wheel_center"))).otherwise("")
    room = F.greatest(wb * margin, F.lit(1.0))
    f_out = _outside(x("front_bumper"), x("front_wheel_center"), heading, True, room)
    r_out = _outside(x("rear_bumper"), x("rear_wheel_center"), heading, False, room)
    warnings = messages(
        (none, "no_pose_detection"), (~none & ~whole, F.concat(F.lit("missing_predictions: "), F.array_join(missing, ", "))),
        (whole & ((heading == "ambiguous") | (wb <= 1)), "orientation_ambiguous"), (whole & ~f_out, "front_endpoint_inside_body"), (whole & ~r_out, "rear_endpoint_inside_body"),
    )
    confs = F.array_compact(F.array(*(F.col(n)["confidence"] for n in need)))
    return wide.select(
        "*", warnings.alias("warnings"), F.when(F.size(warnings) == 0, "PASS").otherwise("FAIL").alias("status"), heading.alias("orientation"),
        F.try_divide(F.aggregate(confs, F.lit(0.0), lambda s, c: s + c), F.size(confs)).alias("avg_confidence"),
        F.when(whole, f_out).alias("front_outside_wheel"), F.when(whole, r_out).alias("rear_outside_wheel"),
    )


def promotion_gate(summary: DataFrame, share: float = 0.7) -> DataFrame:
    """Passes against the share of the total, rounded down."""
    return summary.agg(F.count_if(F.col("status") == "PASS").alias("n_pass"), F.count("*").alias("total")).withColumn("promoted", F.col("n_pass") >= F.floor(F.col("total") * share))


def parse_order(text: str, known: tuple[str, ...] = P.KEYPOINTS) -> tuple[str, ...]:
    """A comma-separated keypoint order; unknown names and no names are errors, repeats count once."""
    names = [n.strip() for n in text.split(",") if n.strip()]
    if unknown := [n for n in names if n not in known]:
        raise ValueError(f"unknown keypoints: {', '.join(unknown)}")
    if not names:
        raise ValueError("no keypoints")
    return tuple(dict.fromkeys(names))


def derive_ground_ref(wide: DataFrame) -> DataFrame:
    """ground_ref as the middle of the ground points; ground_ref_moved tells where it was another."""
    a, b, g = (F.col(n) for n in ("front_wheel_ground", "rear_wheel_ground", "ground_ref"))
    middle = F.struct(((a["x"] + b["x"]) / 2.0).alias("x"), ((a["y"] + b["y"]) / 2.0).alias("y"), g["confidence"].alias("confidence"))
    both = a.isNotNull() & b.isNotNull()
    moved = both & g.isNotNull() & ((g["x"] != middle["x"]) | (g["y"] != middle["y"]))
    return wide.withColumn("ground_ref_moved", F.coalesce(moved, F.lit(False))).withColumn("ground_ref", F.when(both, middle).otherwise(g))


def to_yolo_pose(wide: DataFrame, order: tuple[str, ...], pad: float = 0.02) -> DataFrame:
    """(stem, line) of wide rows with width and height; rows without points or a size are skipped."""
    w, h = F.col("width").cast("double"), F.col("height").cast("double")
    if set(order) == set(("ground_ref", *P.WHEELS)):
        wide = derive_ground_ref(wide)
    xs, ys = (F.array_compact(F.array(*(F.col(n)[e] / s for n in order))) for e, s in (("x", w), ("y", h)))
    x0, x1 = F.greatest(F.lit(0.0), F.array_min(xs) - pad), F.least(F.lit(1.0), F.array_max(xs) + pad)
    y0, y1 = F.greatest(F.lit(0.0), F.array_min(ys) - pad), F.least(F.lit(1.0), F.array_max(ys) + pad)
    six = lambda v: fixed(v, 6)
    triples = [F.when(F.col(n).isNotNull(), F.concat_ws(" ", six(F.col(n)["x"] / w), six(F.col(n)["y"] / h), F.lit("2.000000"))).otherwise("0.000000 0.000000 0.000000") for n in order]
    line = F.concat_ws(" ", F.lit("0"), six((x0 + x1) / 2), six((y0 + y1) / 2), six(x1 - x0), six(y1 - y0), *triples)
    return wide.where((F.size(xs) > 0) & (w > 0) & (h > 0)).select("stem", line.alias("line"))


def to_yolo_bbox(boxes: DataFrame) -> DataFrame:
    """(stem, lines) of normalised boxes (box_idx, cx, cy, w, h), in box order."""
    line = F.concat_ws(" ", F.lit("0"), *(fixed(c, 6) for c in ("cx", "cy", "w", "h")))
    rows = F.array_sort(F.collect_list(F.struct("box_idx", line.alias("line"))))
    return boxes.groupBy("stem").agg(F.array_join(F.transform(rows, lambda r: r["line"]), "\n").alias("lines"))


def flip_index(order: tuple[str, ...]) -> list[int]:
    """For each keypoint the place of its front/rear partner, if it is in the order, else its own."""
    partner = {a: b for p in P.FLIP_PAIRS for a, b in (p, p[::-1])}
    return [order.index(partner[n]) if partner.get(n) in order else i for i, n in enumerate(order)]


def prelabel_wheels(images: DataFrame, boxes: DataFrame, k: int = 2, least: float = 0.25, min_boxes: int = 2) -> DataFrame:
    """(stem, success, boxes_written, lines, error) of the top boxes, clamped to the frame; flat boxes are dropped."""
    from frameyard.operators.select import top_boxes

    w, h = F.col("width").cast("double"), F.col("height").cast("double")
    zero = F.lit(0.0)
    bw = F.greatest(zero, F.least(w, F.col("x2")) - F.greatest(zero, F.col("x1")))
    bh = F.greatest(zero, F.least(h, F.col("y2")) - F.greatest(zero, F.col("y1")))
    cx, cy = F.greatest(zero, F.least(w, (F.col("x1") + F.col("x2")) / 2)), F.greatest(zero, F.least(h, (F.col("y1") + F.col("y2")) / 2))
    line = F.concat_ws(" ", F.lit("0"), fixed(cx / w, 6), fixed(cy / h, 6), fixed(bw / w, 6), fixed(bh / h, 6))
    top = top_boxes(boxes, k, least).join(images.select("stem", "width", "height"), "stem")
    per = top.groupBy("stem").agg(
        F.count("*").alias("n"), F.array_sort(F.collect_list(F.when((bw > 1.0) & (bh > 1.0), F.struct("place", line.alias("line"))))).alias("rows"))  # k at most
    out = images.select("stem").join(per, "stem", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    lines = F.coalesce(F.transform("rows", lambda r: r["line"]), F.array().cast("array<string>"))
    error = F.when(F.col("n") < min_boxes, F.concat(F.lit("Detected "), F.col("n").cast("string"), F.lit(f" boxes (< min_boxes={min_boxes})"))).when(
        F.size(lines) == 0, "All detected boxes were invalid after normalization")
    return out.select("stem", error.isNull().alias("success"), F.when(error.isNull(), F.size(lines)).otherwise(0).alias("boxes_written"), F.when(error.isNull(), F.array_join(lines, "\n")).alias("lines"), error.alias("error"))


def assemble_pose_dataset(labels: DataFrame, images: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Labels with the first image of their stem (by source_rank, then path) and a split, and the labels without one."""
    from frameyard.operators.select import resolve_first
    from frameyard.operators.splits import split_by_stem

    index = resolve_first(images, "stem", ["source_rank", "path"])
    return split_by_stem(labels.join(index, "stem")), labels.join(index, "stem", "left_anti")


def check_boxes() -> Column:
    """Whether all values of a box are in [0, 1]."""
    return reduce(lambda a, b: a & b, (F.coalesce(F.col(c).between(0.0, 1.0), F.lit(False)) for c in ("cx", "cy", "w", "h", "confidence")))
