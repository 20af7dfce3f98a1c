"""State carried from run to run: committed batches, lost attempts, the index, quota and priors files."""

import random
import uuid

import numpy as np
import pytest
from frameyard.functions.durable import shared_dir
from frameyard.operators import dedup
from frameyard.sources import files, sinks
from frameyard.streaming import jobs
from frameyard.streaming.state import RunState
from pyspark.sql import functions as F


@pytest.fixture
def root(spark):
    return f"{shared_dir(spark)}/test-{uuid.uuid4().hex}"


def _batch(spark, ranks, outcome="accepted"):
    return spark.createDataFrame([(r, "side" if r % 2 else "rear", outcome, f"u{r}") for r in ranks], "rank long, view string, outcome string, url string")


def _ranks(df):
    return sorted(r["rank"] for r in df.collect())


def test_commits_are_seen_whole_or_not_at_all(spark, root):
    state = RunState(spark, root, compact=2)
    assert state.rows() is None and state.accepted() is None and state.quota({"side": 3}) == {"side": 3}
    state.commit(0, _batch(spark, [1, 2]), ["rank", "view", "url"])

    class Lost(RunState):
        def _publish(self, number, manifest):
            raise OSError("the driver is lost here")

    with pytest.raises(OSError, match="lost"):
        Lost(spark, root).commit(1, _batch(spark, [3, 4, 5]), ["rank", "view", "url"])
    assert _ranks(state.rows()) == _ranks(state.accepted()) == [1, 2] and state.commits() == [0]
    state.commit(1, _batch(spark, [3, 4, 5]), ["rank", "view", "url"])  # run again
    assert _ranks(state.rows()) == [1, 2, 3, 4, 5] and state.quota({"side": 4, "rear": 1, "front": 2}) == {"side": 1, "rear": 0, "front": 2}
    assert _ranks(state.rows(state.latest(1))) == [1, 2]  # what a rerun of batch 1 sees
    state.commit(2, _batch(spark, [6], "rejected_heuristic"), ["rank", "view", "url"])
    state.commit(3, _batch(spark, [8, 9]), ["rank", "view", "url"])
    assert len(state.latest()["accepted"]) <= 2 and _ranks(state.accepted()) == [1, 2, 3, 4, 5, 8, 9]
    assert _ranks(state.accepted(views=["rear"])) == [2, 4, 8] and state.latest()["last_rank"] == 9
    assert state.vacuum() > 0 and _ranks(state.accepted()) == [1, 2, 3, 4, 5, 8, 9] and _ranks(state.rows()) == [1, 2, 3, 4, 5, 6, 8, 9] and state.vacuum() == 0


def test_ingest_after_a_killed_batch_equals_one_run(spark, root):
    rows = _batch(spark, range(1, 13)).drop("outcome")
    for part in range(3):
        rows.where(f"(rank - 1) div 4 = {part}").coalesce(1).write.mode("append").parquet(f"{root}/in")
    seen = []

    def decide(batch, manifest, state):
        """Accepts what is left of the quota, in order, and notes what it was decided against."""
        before = state.accepted(manifest)
        seen.append((sorted(r["rank"] for r in batch.collect()), 0 if before is None else before.count()))
        if fail and seen[-1][0][0] == 5:
            raise RuntimeError("killed")
        quota = spark.createDataFrame([(v, n, 0) for v, n in state.quota({"side": 5, "rear": 2}, manifest).items()], "view string, target int, accepted int")
        return dedup.apply_quota(batch, quota)

    state = RunState(spark, f"{root}/state")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    run = lambda: jobs.ingest(stream, decide, state, ["rank", "view", "url"], f"{root}/log").awaitTermination()
    fail = True
    with pytest.raises(Exception, match="killed"):
        run()
    assert state.commits() == [0]
    fail = False
    run()
    got = {r["rank"]: r["outcome"] for r in state.rows().collect()}
    assert [r for r, o in sorted(got.items()) if o == "accepted"] == [1, 2, 3, 4, 5, 7, 9] and len(got) == 12
    assert seen.count(([5, 6, 7, 8], 4)) == 2  # the rerun saw what the lost attempt saw
    run()
    assert state.commits() == [0, 1, 2]


def _walk(rows, quota, least, k, small):
    taken, left, out = [], dict(quota), {}
    for rank, view, url, e, width in rows:
        if not any(left.values()):
            out[rank] = "not_processed"
        elif any(u == url for _, u, _ in taken):
            out[rank] = "url_seen"
        elif width < small:
            out[rank] = "rejected_heuristic"
        elif not left.get(view):
            out[rank] = "rejected_quota_full"
        elif sum(v == view and np.dot(e, o) / np.linalg.norm(e) / np.linalg.norm(o) >= least for v, _, o in taken) >= k:
            out[rank] = "rejected_dedup_clip"
        else:
            out[rank] = "accepted"
            taken.append((view, url, e))
            left[view] -= 1
    return out


@pytest.mark.parametrize("quota", [{"a": 9, "b": 50}, {"a": 4, "b": 3}])
def test_runs_in_parts_equal_a_walk(spark, quota):
    rng, norm = random.Random(1), np.random.default_rng(1)
    rows = [(i + 1, rng.choice("abc"), f"u{rng.randrange(40)}", norm.normal(size=3).astype("f4").tolist(), rng.randrange(100)) for i in range(60)]
    df = spark.createDataFrame(rows, "rank long, view string, url string, embedding array<float>, width int")
    want, got, accepted, left = _walk(rows, quota, 0.9, 2, 10), {}, None, dict(quota)
    for lo, hi in ((0, 25), (25, 60)):
        out = dedup.continue_run(df.where((F.col("rank") > lo) & (F.col("rank") <= hi)), accepted, left, F.when(F.col("width") < 10, "small"), 0.9, block=8)
        decided = out.collect()
        got |= {r["rank"]: r["outcome"] for r in decided}
        taken = [r for r in decided if r["outcome"] == "accepted"]
        for r in taken:
            left[r["view"]] -= 1
        accepted = spark.createDataFrame([(r["rank"], r["view"], r["url"], r["embedding"]) for r in taken], "rank long, view string, url string, embedding array<float>")
    assert got == want and {"accepted", "url_seen", "rejected_heuristic", "rejected_quota_full"} <= set(want.values())


def test_index_is_written_once_a_batch_and_read_by_view(spark, root):
    rows = lambda *r: spark.createDataFrame(list(r), "view string, uuid string, embedding array<float>, batch string")
    sinks.append_index(rows(("side", "a", [1.0], "x"), ("rear", "b", [2.0], "x")), root, "r1")
    for _ in range(2):
        sinks.append_index(rows(("side", "c", [3.0], "x")), root, "r2")
    index = sinks.read_index(spark, root, ["side", "front"])
    assert sorted((r["uuid"], r["batch"]) for r in index.collect()) == [("a", "r1"), ("c", "r2")]
    assert "view#" in index._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    seeds = spark.createDataFrame([(3, "a"), (9, "b")], "rank long, uuid string")
    got = dedup.seed_index(spark.createDataFrame([(1, "c")], "rank long, uuid string"), seeds).orderBy("rank").collect()
    assert [(r["rank"], r["uuid"], r["seeded"]) for r in got] == [(-6, "a", True), (0, "b", True), (1, "c", False)]


def test_quota_can_be_saved_over_itself(spark, root):
    path = f"{root}/quota.json"
    sinks.save_quota(files.load_quota(spark, {"side": 5, "rear": 2}), path)
    for _ in range(2):
        saved = files.load_quota(spark, {"side": 6, "front": 1}, spark.read.json(path))
        sinks.save_quota(saved.withColumn("accepted", F.col("accepted") + 1), path)
    got = sorted((r["view"], r["target"], r["accepted"]) for r in files.load_quota(spark, {"side": 7}, spark.read.json(path)).collect())
    assert got == [("front", 0, 2), ("rear", 0, 2), ("side", 7, 2)]


def test_priors_round_trip(spark, root):
    rows = [("hood_edge", 1.25, -4.5, 0.7), ("roof_apex", 0.123456789, 2.0, 0.85)]
    sinks.write_priors(spark.createDataFrame(rows, "label string, x_norm double, y_norm double, confidence double"), root)
    assert sorted(tuple(r) for r in files.read_priors(spark, root).collect()) == [("hood_edge", 1.25, -4.5, 0.7), ("roof_apex", 0.123457, 2.0, 0.85)]


def test_run_in_rounds_equals_one_walk(spark):
    """Rounds of a few rows, with and without seeds, decide as a walk row by row; pairs behind a full quota never arise."""
    import numpy as np

    from frameyard.operators import dedup

    rng = np.random.default_rng(5)
    rows = [(i + 1, "abc"[int(rng.integers(3))], f"u{int(rng.integers(25))}", [float(x) for x in rng.normal(size=4)]) for i in range(60)]
    bad = lambda r: r % 9 == 4
    unit = {r: np.array(e) / np.linalg.norm(e) for r, _, _, e in rows}

    def walk(quota, held, batch):
        left, out, view = dict(quota), {}, {r: v for r, v, _, _ in rows}
        for r, v, u, _ in batch:
            if all(n <= 0 for n in left.values()):
                out[r] = "not_processed"
            elif any(u == rows[h - 1][2] for h in held):
                out[r] = "url_seen"
            elif bad(r):
                out[r] = "rejected_heuristic"
            elif left.get(v, 0) <= 0:
                out[r] = "rejected_quota_full"
            elif sum(view[h] == v and float(unit[h] @ unit[r]) >= 0.6 for h in held) >= 2:
                out[r] = "rejected_dedup_clip"
            else:
                out[r], left[v] = "accepted", left[v] - 1
                held.append(r)
        return out

    df = spark.createDataFrame(rows, "rank long, view string, url string, embedding array<double>")
    reason = F.when(F.col("rank") % 9 == 4, "bad")
    for quota, seeds in (({"a": 4, "b": 3, "c": 2}, [1, 2, 3]), ({"a": 9, "b": 30}, [])):
        batch = df.where(~F.col("rank").isin(*seeds)) if seeds else df
        got = dedup.continue_run(batch, df.where(F.col("rank").isin(*seeds)) if seeds else None, quota, reason, 0.6, 2, block=8, walk=12)
        assert {r["rank"]: r["outcome"] for r in got.collect()} == walk(quota, list(seeds), [r for r in rows if r[0] not in seeds])
