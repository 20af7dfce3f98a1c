"""Report parts, counts observed in the same pass, and errors for empty results."""

import pytest
from frameyard.operators import candidates, reports, select


def test_pool_status(spark):
    images = spark.createDataFrame([(s, "train" if i % 2 else "val") for i, s in enumerate("abcdefg")] + [(None, "val")], "stem string, split string")
    stems = lambda text: spark.createDataFrame([(c,) for c in text], "stem string")
    got = {r["split"] if not r["whole"] else "all": tuple(r)[2:] for r in reports.pool_status(images, stems("aabx"), stems("bc"), stems("g"), ["split"]).select("whole", "split", "total", "n_annotated", "n_trained", "n_excepted", "n_pending").collect()}
    assert got == {"all": (8, 2, 2, 1, 4), "val": (5, 1, 1, 1, 2), "train": (3, 1, 1, 0, 2)}
    assert tuple(reports.pool_status(images.where("false"), stems("a"), stems(""), stems("")).first()) == (True, 0, 0, 0, 0, 0)


def test_attach_confirmed_counts_in_the_same_pass(spark):
    images = spark.createDataFrame([("p1", 1), ("p2", 2), (None, 3), ("p4", 4)], "source_path string, _listed long")
    labels = spark.createDataFrame([("p1", "side"), ("p4", None), ("zz", "x")], "source_path string, label string")
    out, seen = select.attach_confirmed(images.withColumnRenamed("_listed", "n"), labels)
    assert sorted((r["n"], r["label"]) for r in out.collect()) == [(1, "side"), (4, None)] and seen.get == {"unlisted": 2, "listed": 2}


def test_no_query_is_an_error(spark):
    queries = spark.createDataFrame([(2, "red Car"), (1, "CAR side"), (3, "boat"), (4, "car")], "query_idx int, query string")
    assert sorted(r["query_idx"] for r in candidates.filter_queries(queries, "car", 2).collect()) == [1, 2]
    with pytest.raises(Exception, match="no query contains 'plane'"):
        candidates.filter_queries(queries, "plane", 2).collect()


def test_split_pool(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "stem string")
    labelled, pending = select.split_pool(df, spark.createDataFrame([("a",), ("a",), (None,)], "stem string"))
    assert [r["stem"] for r in labelled.collect()] == ["a", "a"] and {r["stem"] for r in pending.collect()} <= {"b", None}


def test_match_counts_and_the_wheel_requirement(spark):
    rows = [("a", "train", "wheel"), ("b", "val", "legacy"), ("d", "train", None), ("c", "val", None)]
    df = spark.createDataFrame(rows, "stem string, split string, source_kind string")
    assert tuple(reports.require_wheel_match(reports.match_counts(df, 1)).first()) == (2, 2, 1, 1, 2, "c")
    with pytest.raises(Exception, match="no label matches"):
        reports.require_wheel_match(reports.match_counts(df.where("stem <> 'a'"))).collect()


def test_prelabel_summary_and_view_counts(spark):
    report = spark.createDataFrame([("b", False, 0, "bad"), ("a", False, 0, "none"), ("c", True, 2, None)], "stem string, success boolean, boxes_written int, error string")
    assert tuple(reports.prelabel_summary(report, 1).first()) == (3, 1, 2, 2, "a: none")
    assert tuple(reports.prelabel_summary(report.where("false")).first()) == (0, 0, 0, 0, "")
    images = spark.createDataFrame([("a", "side", 10), ("b", "side", -1), ("c", "rear", None)], "stem string, view string, width int")
    labels = spark.createDataFrame([("a", "0 1 1 1 1"), ("b", "0 1"), ("z", "0")], "stem string, line string")
    assert {r["view"]: tuple(r)[1:] for r in reports.view_counts(images, labels).collect()} == {"side": (2, 1, 1), "rear": (1, 1, 1)}
