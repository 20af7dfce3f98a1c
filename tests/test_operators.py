"""Golden rows and sequential models of the dataset-preparation operators."""

import json
import random

import numpy as np
import pytest
from frameyard.functions import params as P
from frameyard.functions.columns import fixed, messages, path_order
from frameyard.operators import dedup, gates, keypoints as K, reports, scoring, select, splits
from frameyard.operators.candidates import with_rank
from frameyard.sources import files, sinks
from pyspark.sql import functions as F


def one(df):
    return df.first()


def test_number_format_and_paths(spark):
    rows = spark.createDataFrame([(0.125,), (2.675,), (1234.565,), (-0.004,), (float("nan"),), (None,)], "x double")
    got = [r[0] for r in rows.select(fixed("x", 2)).collect()]
    assert got[:4] == ["%.2f" % v for v in (0.125, 2.675, 1234.565, -0.004)] and got[4:] == [None, None]
    paths = spark.createDataFrame([("a-b/x",), ("a/b",)], "p string")
    assert [r[0] for r in paths.orderBy(path_order("p")).collect()] == ["a/b", "a-b/x"]


def test_size_gate(spark):
    df = spark.createDataFrame([(800, 600, None), (100, 80, "too_small"), (8000, 6000, "too_large"), (400, 800, "portrait"), (4000, 500, "panoramic"), (200, 0, "zero")], "width int, height int, want string")
    for r in df.withColumn("got", gates.size_reason()).collect():
        assert (r["got"] is None) == (r["want"] is None) and (r["want"] or "") in (r["got"] or "")


def test_car_presence(spark):
    images = spark.createDataFrame([("a", 1000, 1000), ("b", 1000, 1000), ("c", 0, 0), ("d", 10, 10)], "stem string, width int, height int")
    boxes = spark.createDataFrame([("a", 0, 500000), ("a", 1, 500000), ("b", 0, 100000), ("c", 0, 100)], "stem string, box_idx int, area_px long")
    got = {r["stem"]: (r["box_idx"], r["reason"]) for r in gates.gate_car_presence(images, boxes).collect()}
    assert got == {"a": (0, None), "b": (0, "car_area_below_ratio"), "c": (0, "car_area_below_ratio"), "d": (None, "no_detections")}


def test_view_confidence(spark):
    df = spark.createDataFrame([(0.85, 0.20, True), (0.55, 0.20, False), (0.85, 0.05, False), (None, None, False)], "confidence double, margin double, ok boolean")
    assert all((r["r"] is None) == r["ok"] for r in df.withColumn("r", gates.view_reason()).collect())
    assert one(spark.createDataFrame([(0.80, 0.15)], "confidence double, margin double").select(gates.view_reason(least=0.80, least_margin=0.15).alias("r")))["r"] is None


def test_box_check(spark):
    df = spark.createDataFrame([(0.5, 0.5, 0.4, 0.3, 0.9, True), (1.1, 0.5, 0.4, 0.3, 0.9, False), (0.5, 0.5, 0.4, -0.1, 0.9, False), (0.5, 0.5, 0.4, 0.3, 1.5, False)], "cx double, cy double, w double, h double, confidence double, ok boolean")
    assert all(r["v"] == r["ok"] for r in df.withColumn("v", K.check_boxes()).collect())


def test_readiness(spark):
    cases = [
        ('{"task": "labeling", "confidence": 0.9, "resources": 3}', True), ('{"task": "training", "confidence": 0.7, "resources": 2}', True),
        ('{"task": "training", "confidence": 0.6, "resources": 3}', False), (None, False), ("{}", False), ("[1,2,3]", False), ("oops", False),
        ('{"task": "a", "confidence": 1.5, "resources": 2}', False), ('{"task": "a", "confidence": -0.1, "resources": 2}', False),
        ('{"task": "a", "confidence": 0.9, "resources": 0}', False), ('{"task": " ", "confidence": 0.9, "resources": 3}', False), ('{"task": "a", "confidence": "0.9", "resources": 3}', False),
    ]
    df = spark.createDataFrame(cases, "raw string, ok boolean")
    for r in df.withColumn("f", gates.readiness()).collect():
        assert (r["f"] is None) == r["ok"], r


def test_storage_keys(spark):
    df = spark.createDataFrame([("abc123", "side", "train")], "uuid string, view string, split string")
    r = one(sinks.with_storage_keys(df))
    assert (r["image_key"], r["label_key"], r["manifest_key"]) == ("images/train/side/abc123.jpg", "labels/train/side/abc123.txt", "manifests/abc123.json")
    assert one(sinks.with_storage_keys(df, "datasets/cars/v1"))["manifest_key"] == "datasets/cars/v1/manifests/abc123.json"


def test_splits(spark):
    df = spark.createDataFrame([("0946ffb5dc2647018840dac0de32a459",), ("deadbeef" * 4,)], "u string").withColumn("s", splits.split_by_id("u"))
    assert [r["s"] for r in df.collect()] == ["val", "val" if int("deadbeef", 16) % 5 == 0 else "train"]
    stems = spark.createDataFrame([(f"s{i:02d}",) for i in range(41)], "stem string")
    assert splits.last_n_split(stems).groupBy("split").count().orderBy("split").collect() == [("train", 33), ("val", 8)]
    with pytest.raises(ValueError):
        splits.last_n_split(stems.limit(3))


#: Right-looking car seen from the side: label, x, y, confidence.
def base(fb, rb):
    return {"front_wheel_ground": (300, 500, 0.9), "rear_wheel_ground": (100, 500, 0.9), "front_wheel_center": (300, 450, 0.9), "rear_wheel_center": (100, 450, 0.9),
            "roof_apex": (200, 300, 0.8), "hood_edge": (280, 380, 0.8), "front_bumper": (fb, 420, 0.8), "rear_bumper": (rb, 420, 0.8)}


def wide(spark, *images, names=P.KEYPOINTS, extra=""):
    point = "struct<x:double,y:double,confidence:double>"
    rows = [(f"i{n}", *(tuple(map(float, im[k])) if k in im else None for k in names)) for n, im in enumerate(images)]
    return spark.createDataFrame(rows, "stem string, " + ", ".join(f"{k} {point}" for k in names))


WHEEL = "stem string, front_cx double, front_cy double, front_gx double, front_gy double, rear_cx double, rear_cy double, rear_gx double, rear_gy double, confidence double, source_detections int, front_radius_px double, rear_radius_px double"


def wheels(spark, fx, rx, cy=450.0, gy=500.0):
    return spark.createDataFrame([("i0", fx, cy, fx, gy, rx, cy, rx, gy, 0.9, 2, gy - cy, gy - cy)], WHEEL)


def test_geometry_warnings(spark):
    w = wide(spark, base(90, 310))
    assert one(K.geometry_warnings(w, wheels=False))["valid"]
    got = one(K.geometry_warnings(w.join(wheels(spark, 300.0, 100.0).drop("confidence"), "stem")))
    assert got["warnings"] == ["invalid_geometry: bumper orientation disagrees with wheel orientation"]


@pytest.mark.parametrize(("fx", "rx", "priors"), [
    (100.0, 300.0, None), (300.0, 100.0, [("body_waist_front", -0.10, -2.0, 0.8), ("body_waist_rear", 0.90, -2.0, 0.8), ("panel_front", -0.20, -1.0, 0.8), ("panel_rear", 0.80, -1.0, 0.8)]),
    (100.0, 300.0, [("body_waist_front", 0.90, -2.0, 0.8), ("body_waist_rear", -0.10, -2.0, 0.8)]), (300.0, 100.0, [("front_bumper", -0.40, -2.0, 0.8), ("rear_bumper", 0.08, -2.0, 0.8)]),
])
def test_estimate(spark, fx, rx, priors):
    p = spark.createDataFrame(priors, "label string, x_norm double, y_norm double, confidence double") if priors else None
    got = {r["label"]: (r["x"], r["y"]) for r in K.estimate_keypoints(wheels(spark, fx, rx), p).collect()}
    sign = 1 if fx > rx else -1
    assert len(got) == 19 and got["ground_ref"] == (200.0, 500.0)
    for front, rear in P.LOCKED_PAIRS:
        assert sign * (got[front][0] - got[rear][0]) > 0
    if sign > 0:
        assert got["front_bumper"][0] > 300 and got["rear_bumper"][0] < 100


def test_estimate_without_geometry(spark):
    got = K.estimate_keypoints(wheels(spark, 105.0, 100.0)).collect()
    assert {(r["x"], r["y"], r["confidence"]) for r in got} == {(0.0, 0.0, 0.2)}


def test_side_view_gate(spark):
    rows = [("bad", 170.0, 120.0, 170.0, 160.0, 100.0, 120.0, 100.0, 160.0, 0.9, 2, 35.0, 35.0), ("good", 250.0, 120.0, 250.0, 170.0, 50.0, 120.0, 50.0, 170.0, 0.9, 2, 25.0, 25.0)]
    df = spark.createDataFrame(rows, WHEEL).withColumn("width", F.lit(300)).withColumn("height", F.lit(200)).withColumn("w", gates.side_view_warnings())
    got = {r["stem"]: r["w"] for r in df.collect()}
    assert got["good"] == [] and got["bad"] and all(w.startswith("non_side_view") for w in got["bad"])


def annotation(points, conf=None, **more):
    shapes = [{"label": k, "points": [list(p)], "shape_type": "point", "description": f"confidence={conf}" if conf else ""} for k, p in points.items()]
    return json.dumps({"shapes": shapes, **more})


def test_extraction_dialects(spark):
    shapes = [{"label": " a ", "points": [[1, 2]], "shape_type": "point"}, "stray", {"label": "a", "points": [["3", 4]], "shape_type": "line", "description": "Confidence = .75"},
              {"label": "b", "points": [[5, 6, 7]], "shape_type": "point", "flags": {"score": 0.5}}, {"label": "c", "points": []}]
    docs = spark.createDataFrame([("d", json.dumps({"shapes": shapes})), ("bad", "{not json"), ("none", "{}")], "stem string, raw string")
    get = lambda dialect, order=(): sorted((r["label"], r["x"], r["confidence"]) for r in K.extract_keypoints(docs, dialect, order).collect())
    assert get("any") == [("a", 1.0, None), ("b", 5.0, 0.5)]
    assert get("exact") == [("a", 1.0, None)]
    assert get("point", ("b",)) == [("b", 5.0, 0.5)]
    assert get("last") == []  # a bad shape costs the document
    clean = spark.createDataFrame([("d", json.dumps({"shapes": [shapes[0], {"label": " a ", "points": [[9, 9]]}]}))], "stem string, raw string")
    assert [(r["label"], r["x"]) for r in K.extract_keypoints(clean, "last").collect()] == [(" a ", 9.0)]
    assert one(K.extract_keypoints(docs, "any").where("label = 'a'"))["copies"] == 2


def test_learned_priors(spark):
    right = {"front_wheel_center": (300, 450), "front_wheel_ground": (300, 500), "rear_wheel_center": (100, 450), "rear_wheel_ground": (100, 500), "front_bumper": (350, 420), "rear_bumper": (50, 420), "body_waist_front": (320, 390), "body_waist_rear": (80, 395)}
    left = {k: (400 - x, y) for k, (x, y) in right.items()}
    docs = spark.createDataFrame([("r", annotation(right)), ("l", annotation(left))], "stem string, raw string")
    kps = K.extract_keypoints(docs, "last")
    got = {r["label"]: r for r in K.learn_priors(K.wheels_from_points(K.pivot_keypoints(kps)), kps).collect()}
    assert abs(got["front_bumper"]["x_norm"] - 1.25) < 1e-9 and abs(got["rear_bumper"]["x_norm"] + 0.25) < 1e-9 and abs(got["front_bumper"]["confidence"] - 0.57) < 1e-9
    assert got["body_waist_front"]["x_norm"] > 0.9 and got["body_waist_rear"]["x_norm"] < 0
    inside = dict(right, front_bumper=(250, 420), rear_bumper=(150, 420))
    kps = K.extract_keypoints(spark.createDataFrame([("r", annotation(inside))], "stem string, raw string"), "last")
    labels = {r["label"] for r in K.learn_priors(K.wheels_from_points(K.pivot_keypoints(kps)), kps).collect()}
    assert "body_waist_front" in labels and not labels & {"front_bumper", "rear_bumper"}


def seven(front=330, rear=70, fb=(390, 120), rb=(10, 120)):
    return {"ground_ref": (200, 180, 0.9), "front_wheel_center": (front, 140, 0.9), "front_wheel_ground": (front, 180, 0.9), "rear_wheel_center": (rear, 140, 0.9), "rear_wheel_ground": (rear, 180, 0.9),
            "front_bumper": (*fb, 0.9), "rear_bumper": (*rb, 0.9)}


def test_validate_7(spark):
    images = [seven(), seven(70, 330, (10, 120), (390, 120)), seven(fb=(260, 130)), seven(160, 70)]
    got = [one(K.validate_7(wide(spark, im))) for im in images]
    assert [r["status"] for r in got] == ["VALID", "VALID", "INVALID", "INVALID"] and got[0]["front_outside_wheel"] and got[1]["rear_outside_wheel"]
    assert any(w.startswith("front_endpoint_inside_body") for w in got[2]["warnings"]) and any(w.startswith("wheelbase_ratio_invalid") for w in got[3]["warnings"])
    lack = one(K.validate_7(wide(spark, {k: v for k, v in seven().items() if k != "rear_bumper"})))
    assert lack["status"] == "INVALID" and lack["missing_keypoints"] == ["rear_bumper"] and lack["orientation"] == ""


def test_rebuild(spark):
    pts = {"ground_ref": (250, 210), "front_wheel_center": (380, 170), "front_wheel_ground": (380, 210), "rear_wheel_center": (120, 170), "rear_wheel_ground": (120, 210), "front_bumper": (260, 170), "rear_bumper": (150, 170)}
    docs = spark.createDataFrame([("ok", annotation(pts, 0.9, imageWidth=500, imageHeight=300)), ("narrow", annotation(pts, 0.9, imageWidth=460, imageHeight=300)), ("bad", "[1]"), ("nosize", annotation(pts)), ("nowheel", annotation({"a": (1, 2)}, imageWidth=5, imageHeight=5))], "stem string, raw string")
    got = {r["stem"]: r for r in K.rebuild_7(docs).collect()}
    assert got["ok"]["status"] == "WRITE" and "out_of_frame" in got["narrow"]["reason"] and got["bad"]["reason"] == "malformed_json" and got["nosize"]["reason"] == "missing_image_dimensions"
    assert got["nowheel"]["reason"].startswith("missing_wheels: front_wheel_center")
    again = K.pivot_keypoints(K.extract_keypoints(spark.createDataFrame([("ok", got["ok"]["payload"])], "stem string, raw string")))
    assert one(K.validate_7(again))["status"] == "VALID"


def test_rebuild_within_the_row(spark):
    """The wheel points of odd documents are those of the long form, and nothing is shuffled for them."""
    shape = lambda n, at, **more: {"label": n, "points": [at], **more}
    a, b, c, d = P.WHEELS
    shapes = {
        "plain": [shape(n, [i, i + 1], description=f"Confidence = .{i + 1}") for i, n in enumerate(P.WHEELS)],
        "copies": ["stray", None, 3, shape(a, [1, 2, 3]), shape(f" {a} ", [4, 5]), shape(a, [6, 7]), shape(b, [1]), shape(b, ["8", "x"]), shape(b, ["8", "9.5"])],
        "thirds": [shape(a, [1, 2, None]), shape(b, [1, None]), shape(c, []), {"label": c}, {"label": None, "points": [[1, 2]]}, shape(d, [1, True])],
        "flags": [shape(a, [1, 2], flags={"score": 0.5}), shape(b, [1, 2], flags={"confidence": "NaN"}), shape(c, ["NaN", 2], description="confidence=x", flags={"avg_confidence": "0.25"}), shape(d, [1, 2])],
        "fields": {"z": shape(a, [1, 2]), "y": shape(a, [3, 4]), "x": 5}, "text": "a", "none": None, "empty": [],
    }
    rows = [(k, json.dumps({"shapes": v, "imageWidth": 900, "imageHeight": 900})) for k, v in shapes.items()]
    rows += [(None, rows[0][1]), ("list", " [1]"), ("bare", "{}"), ("space", "\n\t " + rows[0][1]), ("broken", "{"), ("null", None), ("three", "3"), ("word", '"{"')]
    docs = spark.createDataFrame(rows, "stem string, raw string")
    long = {r["stem"]: [r[n] for n in P.WHEELS] for r in K.pivot_keypoints(K.extract_keypoints(docs, "exact")).collect()}
    got = [(r["stem"], [r[n] for n in P.WHEELS]) for r in K._wheel_points(docs.selectExpr("stem", "try_parse_json(raw) AS v")).collect()]
    assert len(got) == len(rows) and sorted(map(repr, got)) == sorted(repr((k, long.get(k, [None] * 4) if k else [None] * 4)) for k, _ in rows)
    out = K.rebuild_7(docs)
    reasons = {r["stem"]: r["reason"].split(":")[0] for r in out.collect()}
    assert {k for k, v in reasons.items() if v == "malformed_json"} == {"list", "broken", "null", "three", "word"} and reasons["bare"] == reasons[None] == "missing_wheels"
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r["reason"] for r in K.rebuild_7(docs.where("stem = 'plain'"), existing=docs, allow_outside=True).collect()} == {"output_exists"}


def test_yolo_pose_and_flip(spark):
    pts = {"ground_ref": (0, 0, 1), "front_wheel_center": (150, 60, 1), "front_wheel_ground": (160, 80, 1), "rear_wheel_center": (50, 60, 1), "rear_wheel_ground": (40, 90, 1)}
    order = ("ground_ref", "front_wheel_center", "front_wheel_ground", "rear_wheel_center", "rear_wheel_ground")
    w = wide(spark, pts).withColumn("width", F.lit(200)).withColumn("height", F.lit(100))
    line = one(K.to_yolo_pose(w, order))["line"].split()
    assert [float(v) for v in line[5:8]] == [0.5, 0.85, 2.0] and len(line) == 20 and one(K.derive_ground_ref(w))["ground_ref_moved"]
    assert K.flip_index(order) == [0, 3, 4, 1, 2]
    assert K.flip_index((*order, "fender_arch_front", "fender_arch_rear", "front_bumper", "rear_bumper")) == [0, 3, 4, 1, 2, 6, 5, 8, 7]
    assert K.flip_index((*order[1:], "ground_ref", "front_bumper", "rear_bumper")) == [2, 3, 0, 1, 4, 6, 5]
    assert K.parse_order(" roof_apex, hood_edge,roof_apex") == ("roof_apex", "hood_edge")
    for bad in ("", "nose"):
        with pytest.raises(ValueError):
            K.parse_order(bad)


def test_quota(spark):
    rows = spark.createDataFrame([(i, "front" if i % 2 else "side") for i in range(1, 11)] + [(11, "odd")], "rank long, view string")
    quota = spark.createDataFrame([("front", 2, 0), ("side", 5, 1)], "view string, target int, accepted int")
    got = {r["rank"]: r["outcome"] for r in dedup.apply_quota(rows, quota).collect()}
    assert [r for r, o in got.items() if o == "accepted"] and got[1] == got[3] == "accepted" and got[5] == "rejected_quota_full" and got[8] == "accepted" and got[9] == got[11] == "not_processed"


def sequential(rows, edges, quota, k):
    taken, urls, n, out = set(), set(), dict.fromkeys(quota, 0), {}
    for rank, view, url in rows:
        if all(n[v] >= quota[v] for v in quota):
            out[rank] = "not_processed"
            continue
        before = [kind for a, b, kind in edges if b == rank and a in taken]
        if url in urls:
            out[rank] = "url_seen"
        elif view not in quota or n[view] >= quota[view]:
            out[rank] = "rejected_quota_full"
        elif "A" in before or before.count("B") >= k:
            out[rank] = "rejected_dedup_clip"
        else:
            out[rank] = "accepted"
            taken.add(rank)
            urls.add(url)
            n[view] += 1
    return out


@pytest.mark.parametrize("seed", range(3))
def test_select_with_quota(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["front", "side", "rear"]), f"u{rng.randint(0, 25)}") for i in range(1, 31)]
    edges = list({(a, b, rng.choice("AB")) for a in range(1, 31) for b in range(a + 1, 31) if rng.random() < 0.06})
    quota = {v: rng.randint(0, 6) for v in ("front", "side", "rear")}
    got = dedup.select_with_quota(spark.createDataFrame(rows, "rank long, view string, url string"), spark.createDataFrame(edges, "a long, b long, kind string"), quota)
    assert {r["rank"]: r["outcome"] for r in got.collect()} == sequential(rows, edges, quota, 2)


def test_rank_ignores_partitioning(spark):
    df = spark.createDataFrame([(random.Random(i).random(), i) for i in range(500)], "x double, id long")
    want = {i: n for n, (x, i) in enumerate(sorted((r["x"], r["id"]) for r in df.collect()), 1)}
    for parts in (1, 7):
        assert {r["id"]: r["rank"] for r in with_rank(df.repartition(parts), ["x", "id"]).collect()} == want
    got = select.limit_with_rejects(df, F.col("id") % 3 == 0, ["id"], 4)
    assert sorted(r["id"] for r in got.collect()) == list(range(10))


def test_phash_pairs(spark):
    rng = random.Random(1)
    codes = [rng.getrandbits(64) for _ in range(40)]
    codes += [c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 7))) for c in codes]
    signed = [(i, c - (1 << 64) if c >> 63 else c) for i, c in enumerate(codes)]
    got = {(r["a"], r["b"]): r["distance"] for r in dedup.phash_pairs(spark.createDataFrame(signed, "id long, phash long")).collect()}
    want = {(i, j): bin(codes[i] ^ codes[j]).count("1") for i in range(80) for j in range(i + 1, 80) if bin(codes[i] ^ codes[j]).count("1") <= 5}
    assert got == want


def test_pixels(spark):
    rng = np.random.default_rng(0)
    noise = rng.integers(0, 256, (900, 1000, 3), dtype=np.uint8)
    g = scoring.grey(noise)
    assert scoring.laplacian_variance(np.full((10, 10), 7.0)) == 0 and scoring.laplacian_variance(g) > 100
    assert bin((scoring.phash(g) ^ scoring.phash(np.clip(g + 1, 0, 255))) & (2**64 - 1)).count("1") <= 5
    image = "image struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>"
    rows = [(("noise", 900, 1000, 3, 16, noise.tobytes()),), (("flat", 900, 1000, 1, 0, bytes([128]) * 900_000),), (("bad", -1, -1, -1, -1, b""),), (("small", 10, 10, 1, 0, bytes(100)),)]
    got = {r["path"]: (r["action"], r["reason"]) for r in scoring.pixel_verdict(scoring.pixel_metrics(spark.createDataFrame(rows, image))).collect()}
    assert got == {"noise": ("keep", "pass"), "flat": ("discard", "excessive_blur"), "bad": ("discard", "corrupt_file"), "small": ("discard", "low_resolution")}


def test_scorer_skips_decided_rows(spark):
    def make():
        def score(pdf):
            assert pdf["outcome"].isna().all()
            return pdf.assign(n_faces=pdf["id"] * 2.0)

        return score

    df = spark.createDataFrame([(i, "rejected" if i % 2 else None) for i in range(10)], "id long, outcome string")
    got = {r["id"]: r["n_faces"] for r in scoring.score_images(df, make, "n_faces double").collect()}
    assert got == {i: None if i % 2 else i * 2.0 for i in range(10)}


def test_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "X.JPG").write_bytes(b"no image")
    (tmp_path / "b.txt").write_text(" l1 \n\n l2\n")
    (tmp_path / "m.json").write_text(json.dumps({"uuid": "u1", "image_url": "http://x", "view": "side", "bboxes": [{"cx": 0.5}]}, indent=1))
    (tmp_path / "n.json").write_text("{broken")
    (tmp_path / "p.json.prior").write_text(json.dumps({"roof_apex": {"x_norm": 1, "y_norm": "2"}, "bad": {"x_norm": None}}))
    assert [(r["stem"]) for r in files.scan_images(spark, str(tmp_path)).collect()] == ["X"]
    assert [r["line"] for r in files.read_manifest_lines(spark, str(tmp_path / "b.txt")).collect()] == ["l1", "l2"]
    assert [r["uuid"] for r in files.scan_manifests(spark, str(tmp_path)).collect()] == ["u1"]
    assert {(r["stem"], r["malformed"]) for r in files.scan_annotations(spark, str(tmp_path)).collect()} == {("m", False), ("n", True)}
    assert [(r["label"], r["y_norm"], r["confidence"]) for r in files.read_priors(spark, str(tmp_path / "p.json.prior")).collect()] == [("roof_apex", 2.0, 0.8)]
    assert [r["image"]["width"] for r in files.decode_images(spark, str(tmp_path / "a")).collect()] == [-1]
    assert files.reference_list(spark, [" a ", "", "a", "b"]).count() == 2


def test_reports(spark):
    q = spark.createDataFrame([("front", 2, 5000), ("full", 9, 5)], "view string, accepted int, target int")
    assert [(r["remaining"], len(r["bar"])) for r in reports.quota_progress(q).orderBy("view").collect()] == [(4998, 0), (0, 30)]


def test_dedupe_exact_without_keys(spark):
    rows = [(1, "a", True), (2, "a", True), (3, None, True), (4, None, True), (5, None, False), (6, "b", False), (7, "b", True)]
    out = dedup.dedupe_exact(spark.createDataFrame(rows, "id int, sha string, ok boolean"), "sha", ["id"], F.col("ok"))
    assert out.columns == ["id", "sha", "ok", "selected", "duplicate"]
    assert {r["id"] for r in out.collect() if r["selected"]} == {1, 3, 4, 7}
    assert {r["id"] for r in out.collect() if r["duplicate"]} == {2}


def test_phash_pairs_shuffle_and_spread_bits(spark):
    """Bands multiply the codes, so neither side may be broadcast; bits that never vary must not void whole bands."""
    codes = spark.range(400).selectExpr("id", "(id * 7919) % 65536 AS phash")
    out = dedup.phash_pairs(codes)
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
    near = {(r["a"], r["b"], r["distance"]) for r in out.collect()}
    v = [i * 7919 % 65536 for i in range(400)]
    assert near == {(i, j, (v[i] ^ v[j]).bit_count()) for i in range(400) for j in range(i + 1, 400) if (v[i] ^ v[j]).bit_count() <= 5}


def test_boxes_that_tie_keep_their_order(spark):
    images = spark.createDataFrame([("a", 1000, 500, "right-looking")], "stem string, width int, height int, heading string")
    rows = [("a", 1, 0.9, 0.0, 0.0, 100.0, 9.0, 5), ("a", 2, 0.8, 400.0, 0.0, 600.0, 9.0, 7), ("a", 2, 0.8, 800.0, 0.0, 900.0, 9.0, 6)]
    schema = "stem string, box_idx int, conf double, x1 double, y1 double, x2 double, y2 double, seq int"
    for given in (rows, rows[::-1]):
        assert K.wheels_from_boxes(images, spark.createDataFrame(given, schema)).first()["front_cx"] == 850.0


def test_pivot_hashes_its_groups(spark):
    long = spark.createDataFrame([("a", "roof_apex", 1.0, 2.0, None), ("a", "hood_edge", 3.0, 4.0, 0.5)], "stem string, label string, x double, y double, confidence double")
    out = K.pivot_keypoints(long)
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
    row = out.first()
    assert tuple(row["roof_apex"]) == (1.0, 2.0, None) and tuple(row["hood_edge"]) == (3.0, 4.0, 0.5) and row["rear_bumper"] is None


def longest_method(df):
    """Bytes of the longest method that Spark generates for df; the JVM compiles none over 8000."""
    made = df._jdf.queryExecution().debug().codegenToSeq()
    return max(made.apply(i)._3().maxMethodCodeSize() for i in range(made.size()))


def test_long_estimate_is_compiled_and_agrees_with_the_wide_one(spark):
    priors = spark.createDataFrame([("front_bumper", -0.40, -2.0, 0.8), ("body_waist_front", -0.10, -2.0, 0.8), ("body_waist_rear", 0.90, -2.0, None)], "label string, x_norm double, y_norm double, confidence double")
    rows = [("right", 300.0, 450.0, 301.0, 500.0, 100.0, 451.0, 99.0, 503.0, 0.9, 2, 50.0, 52.0), ("left", 100.0, 450.0, 101.0, 500.0, 300.0, 451.0, 299.0, 560.0, 0.5, 2, 50.0, 52.0),
            ("lost", 101.0, 450.0, 101.0, 500.0, 100.0, 450.0, 100.0, 500.0, 0.9, 2, 50.0, 50.0), ("null", 300.0, None, 300.0, 500.0, None, 450.0, 100.0, 500.0, None, 2, 50.0, 50.0)]
    w = spark.createDataFrame(rows, WHEEL)
    for p in (None, priors):
        long = K.estimate_keypoints(w, p)
        assert longest_method(long) < 8000
        got = {(r["stem"], r["label"]): (r["x"], r["y"], r["confidence"]) for r in long.collect()}
        assert got == {(r["stem"], n): tuple(r[n]) for r in K.estimate_wide(w, p).collect() for n in P.KEYPOINTS}


def test_checks_stand_under_no_higher_order_function(spark):
    x, w = F.col("x"), F.lit(None).cast("string")
    df = spark.createDataFrame([(1.0,), (None,)], "x double").withColumn("m", messages((x > 0, "a"), (x < 0, "b"), (x > 0, F.concat(F.lit("c"), x.cast("string"))), (x > 0, w)))
    assert "lambda" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r["m"] for r in df.collect()) == [[], ["a", "c1.0"]]


def test_wide_estimate_asks_for_methods_that_are_compiled(spark):
    limit = "spark.sql.codegen.hugeMethodLimit"
    for given, kept in (("65535", "8000"), ("4000", "4000")):
        spark.conf.set(limit, given)
        K.estimate_wide(wheels(spark, 300.0, 100.0))
        assert spark.conf.get(limit) == kept
    spark.conf.unset(limit)


def test_status_is_told_without_a_function_per_warning(spark):
    checked = K.validate_19(wide(spark, base(90, 310)).withColumn("avg_confidence", F.lit(0.9))).select("status")
    assert "lambda" not in checked._jdf.queryExecution().optimizedPlan().toString()
