"""The suggestion pipeline with its storage, and the whole cascade with its scorers."""

import json
import uuid

import pandas as pd
import pytest
from frameyard.functions import params as P
from frameyard.functions.durable import shared_dir
from frameyard.operators import cascade, suggest
from frameyard.operators.keypoints import wheels_from_boxes
from pyspark.sql import functions as F


@pytest.fixture
def root(spark):
    return f"{shared_dir(spark)}/test-{uuid.uuid4().hex}"


IMAGES = "stem string, width int, height int, heading string, heading_confidence double, heading_margin double"
BOXES = "stem string, box_idx int, conf double, x1 double, y1 double, x2 double, y2 double"


def _wheel(stem, i, cx, gy=600.0, r=60.0, conf=0.95):
    return (stem, i, conf, cx - r, gy - 2 * r, cx + r, gy)


def _run(spark, **kw):
    images = [
        ("good", 1000, 700, "right-looking", 0.9, 0.4), ("left", 1000, 700, "left-looking", 0.9, 0.4), ("bare", 1000, 700, None, None, None), ("narrow", 1000, 700, "right-looking", 0.8, 0.2),
        ("broken", None, None, "right-looking", 0.8, 0.2), ("old", 1000, 700, "right-looking", 0.8, 0.2), ("one", 1000, 700, None, None, None),
    ]
    boxes = [b for s in ("good", "left", "broken", "old") for b in (_wheel(s, 0, 300.0), _wheel(s, 1, 760.0), _wheel(s, 2, 500.0, conf=0.3))]
    boxes += [_wheel("narrow", 0, 480.0), _wheel("narrow", 1, 560.0), _wheel("one", 0, 300.0), _wheel("one", 1, 700.0, conf=0.1)]
    old = spark.createDataFrame([("old",), ("old",), ("gone",)], "stem string")
    return suggest.suggest(spark.createDataFrame(images, IMAGES), spark.createDataFrame(boxes, BOXES), existing=old, **kw)


def test_suggest_reports_every_image_once(spark):
    rows = {r["stem"]: r for r in _run(spark).collect()}
    assert len(rows) == 7 and [s for s in sorted(rows) if rows[s]["success"]] == ["bare", "good", "left", "one"]
    good, left = rows["good"], rows["left"]
    assert good["orientation"] == "right-looking" and good["wheel_detections"] == 2 and good["keypoints_estimated"] == 19
    assert good["warnings"] == ["orientation_clip: right-looking confidence=0.900 margin=0.400"] and good["review_priority"] == "REVIEW_LOW"
    shapes = {s["label"]: s for s in json.loads(good["payload"])["shapes"]}
    assert shapes["front_wheel_center"]["points"] == [[760.0, 540.0]] and shapes["rear_wheel_ground"]["points"] == [[300.0, 600.0]]
    assert shapes["ground_ref"]["description"] == "confidence=0.950" and list(shapes)[:5] == list(P.PHASES["phase1"])
    assert left["orientation"] == "left-looking" and {s["label"]: s for s in json.loads(left["payload"])["shapes"]}["front_wheel_center"]["points"] == [[300.0, 540.0]]
    for s in ("bare", "one"):
        assert rows[s]["wheel_detections"] == 0 and rows[s]["review_priority"] == "REVIEW_HIGH" and any(w.startswith("fallback_wheels") for w in rows[s]["warnings"])
    narrow = rows["narrow"]
    assert narrow["error"] == "rejected_non_side_view" and narrow["quality_score"] == 0 and narrow["wheel_detections"] == 2 and narrow["orientation"] == "right-looking"
    assert narrow["avg_confidence"] == 0.95 and [w.split(":")[0] for w in narrow["warnings"]] == ["orientation_clip", "non_side_view", "non_side_view"] and narrow["payload"] is None
    assert rows["broken"]["error"] == "Failed to read image" and rows["old"]["warnings"] == ["File already exists"] and rows["old"]["error"] is None


def test_suggest_phase_only_and_without_gate(spark):
    rows = {r["stem"]: r for r in _run(spark, phase_only="phase1", gate=False).collect()}
    assert rows["narrow"]["success"] and rows["narrow"]["keypoints_estimated"] == 5
    assert [s["label"] for s in json.loads(rows["good"]["payload"])["shapes"]] == list(P.PHASES["phase1"])
    assert suggest.ordered_names({"a": ("roof_apex", "x"), "b": ("roof_apex",)}) == ["roof_apex", "x", *(n for n in P.KEYPOINTS if n != "roof_apex")]


def _files(spark, root):
    return {r["p"] for r in spark.read.parquet(root).select(F.col("_metadata.file_path").alias("p")).distinct().collect()}


def test_annotations_are_written_once(spark, root):
    out = _run(spark).select("stem", "payload")
    assert suggest.existing_annotations(spark, root).count() == 0
    assert suggest.save_annotations(out, root, buckets=4) == 4
    before = _files(spark, root)
    assert suggest.save_annotations(out, root, buckets=4) == 0 and _files(spark, root) == before  # a rerun writes nothing
    assert sorted(r["stem"] for r in suggest.existing_annotations(spark, root).collect()) == ["bare", "good", "left", "one"]
    changed = spark.createDataFrame([("good", "{}"), ("new", "{}"), ("skipped", None)], "stem string, payload string")
    assert suggest.save_annotations(changed, root, buckets=4) == 1
    assert suggest.save_annotations(changed, root, overwrite=True, buckets=4) == 2
    got = {r["stem"]: r["payload"] for r in spark.read.parquet(root).collect()}
    assert sorted(got) == ["bare", "good", "left", "new", "one"] and got["good"] == "{}" and got["left"].startswith("{\"flags\"")


def test_scorers_see_open_rows_only(spark):
    rows = [(i, f"u{i}", "bytes" if i % 4 else "") for i in range(40)]
    df = spark.createDataFrame(rows, "rank long, url string, content string").repartition(3)

    def strict(column, value):
        def score(pdf: pd.DataFrame) -> pd.DataFrame:
            assert pdf["outcome"].isna().all() and (pdf["content"] == "bytes").all()
            return pd.DataFrame({column: value(pdf["rank"]).astype("f8")})

        return lambda: score

    scorers = [
        cascade.Scorer("cars", strict("cars", lambda r: r % 3), "cars double", [("rejected_no_car", F.when(F.col("cars") == 0, "no_detections"))]),
        cascade.Scorer("faces", strict("faces", lambda r: r % 5), "faces double", [("rejected_has_face", F.when(F.col("faces") == 0, ""))]),
        cascade.Scorer("embed", strict("e", lambda r: r), "e double"),
    ]
    out, seen = cascade.score_cascade(df, [("rejected_download", F.when(F.col("content") == "", "empty_response"))], scorers, ["content"])
    got = {r["rank"]: r for r in out.collect()}
    want = {i: "rejected_download" if i % 4 == 0 else "rejected_no_car" if i % 3 == 0 else "rejected_has_face" if i % 5 == 0 else None for i in range(40)}
    assert {i: r["outcome"] for i, r in got.items()} == want
    assert got[5]["reason_detail"] is None and got[3]["reason_detail"] == "no_detections" and got[3]["content"] is None and got[1]["content"] == "bytes"
    n = lambda *o: sum(w in o for w in want.values())
    assert {k: v.get["open"] for k, v in seen.items()} == {"cars": 40 - n("rejected_download"), "faces": 40 - n("rejected_download", "rejected_no_car"), "embed": n(None)}
    assert all(v.get["open"] + v.get["closed"] == 40 for v in seen.values()) and all(r["e"] is None for i, r in got.items() if want[i])


def test_settle_looks_urls_up_first(spark):
    gated = spark.createDataFrame([(1, "a", None, None), (2, "a", "rejected_no_car", "no_detections"), (3, "b", "rejected_angle", "x"), (4, "b", None, None), (5, "b", "rejected_angle", "x"), (6, "a", None, None)], "rank long, view string, outcome string, reason_detail string")
    decided = spark.createDataFrame([(1, "accepted"), (2, "url_seen"), (3, "rejected_heuristic"), (4, "rejected_quota_full"), (5, "not_processed"), (6, "rejected_dedup_clip")], "rank long, outcome string")
    got = [(r["outcome"], r["reason_detail"]) for r in cascade.settle(gated, decided).orderBy("rank").collect()]
    assert got == [("accepted", None), ("rejected_dedup_clip", "url_seen"), ("rejected_angle", "x"), ("rejected_quota_full", "b"), ("not_processed", None), ("rejected_dedup_clip", "a")]


def test_suggest_carries_no_points_and_builds_no_groups(spark):
    plan = _run(spark).drop("payload")._jdf.queryExecution()
    steps = plan.optimizedPlan().toString()
    assert "explode" not in steps and not any(f" AS {n}#" in steps for n in P.KEYPOINTS)  # a struct a point was copied at each step
    assert "SortAggregate" not in plan.sparkPlan().toString()


def test_wheels_of_odd_boxes(spark):
    images = spark.createDataFrame([(s, 1000, 700, h) for s in ("null", "tie", "one", "turned") for h in ("left-looking",)] + [("none", 1000, 700, None)], "stem string, width int, height int, heading string")
    boxes = [("null", 0, 0.9, 10.0, 0.0, 30.0, 60.0), ("null", 1, 0.8, None, 0.0, 90.0, 50.0), ("tie", 0, 0.5, 10.0, 0.0, 30.0, 60.0), ("tie", 1, 0.9, 10.0, 0.0, 30.0, 40.0), ("tie", 2, 0.1, 0.0, 0.0, 1.0, 1.0),
             ("one", 0, 0.9, 10.0, 0.0, 30.0, 60.0), ("turned", 0, 0.9, 70.0, 0.0, 90.0, 60.0), ("turned", 1, 0.9, 10.0, 0.0, 30.0, 50.0), (None, 0, 0.9, 1.0, 0.0, 3.0, 6.0), (None, 1, 0.9, 1.0, 0.0, 3.0, 6.0)]
    got = {r["stem"]: r for r in wheels_from_boxes(images, spark.createDataFrame(boxes, BOXES)).collect()}
    # front is the left box here: one without a centre comes first, and of equal centres the surer box does
    assert {s: (r["front_cx"], r["front_gy"], r["rear_cx"], r["rear_gy"], r["source_detections"]) for s, r in got.items() if s != "none"} == {
        "null": (None, 50.0, 20.0, 60.0, 2), "tie": (20.0, 40.0, 20.0, 60.0, 2), "one": (300.0, 588.0, 720.0, 588.0, 0), "turned": (20.0, 50.0, 80.0, 60.0, 2)}
    assert got["tie"]["confidence"] == 0.7 and got["tie"]["front_radius_px"] == 20.0 and got["none"]["front_cx"] == 720.0
