"""First-wins over several keys, staging decisions, ranks within keys, long chains, quota state."""

import random
import time

import pandas as pd
import pytest
from frameyard.operators import candidates, dedup, staging
from frameyard.streaming.jobs import QuotaProcessor


def _walk(rows, keys=2):
    """rows: (rank, ok, *keys) in any order."""
    seen, out = [set() for _ in range(keys)], {}
    for rank, ok, *values in sorted(rows):
        dup = [v is not None and v in s for v, s in zip(values, seen, strict=True)]
        if take := bool(ok) and not any(dup):
            for v, s in zip(values, seen, strict=True):
                s.add(v)
        out[rank] = (take, *dup)
    return out


def _by_keys(spark, rows):
    df = spark.createDataFrame(rows, "id long, ok boolean, a string, b string").repartition(3)
    from pyspark.sql import functions as F

    got = staging.dedupe_by_keys(df, ["a", "b"], ["id"], F.col("ok")).collect()
    return {r["id"]: (r["selected"], r["dup_a"], r["dup_b"]) for r in got}


def test_two_keys_against_a_walk(spark):
    rng = random.Random(4)
    for n, values in ((60, 12), (200, 60)):
        pick = lambda: rng.choice([None, "hot", *map(str, range(values))])  # noqa: B023, E731
        rows = [(i, rng.random() < 0.8 or None, pick(), pick()) for i in range(n)]
        assert _by_keys(spark, rows) == _walk(rows)


def test_two_keys_chain_hot_key_and_bare_rows(spark):
    chain = [(i, True, f"a{(i + 1) // 2}", f"b{i // 2}") for i in range(1, 12)]  # each row shares one key with the next
    hot = [(100 + i, True, "same", f"own{i}") for i in range(3000)]
    copies = [(5000 + i, True, "x", "y") for i in range(500)]
    bare = [(9000 + i, i < 3, None, None) for i in range(4)]
    rows = chain + hot + copies + bare
    assert _by_keys(spark, rows) == _walk(rows)
    assert _by_keys(spark, []) == {}


def test_stage_candidates(spark):
    cols = "n long, stem string, path string, sha string, width int, height int, has_file boolean, reason string"
    rows = [
        (1, "car_a", "p/1", "h1", 100, 90, True), (2, "Car_A", "p/2", "h2", 900, 400, True), (3, "car_a", "p/3", "h3", 900, 400, True),
        (4, "car_b", "p/4", "h2", None, None, True), (5, "car_b", "p/5", "h5", 900, 400, False), (6, "car_b", "rear/6", "h6", 900, 400, True),
        (7, "car_c", "p/7", "h7", 900, 400, True), (8, "car_d", "p/8", "h8", 900, 400, True), (9, "van_e", "p/9", "h9", 900, 400, True),
        (10, "car_f", "p/10", "h10", -1, -1, True), (11, "car_g", "p/11", "h11", 900, 400, True), (12, "car_h", "p/12", "h12", 900, 400, True),
    ]
    df = spark.createDataFrame([(*r, "old") for r in rows], cols).drop("reason")
    lists = [spark.createDataFrame([(s,)], "stem string") for s in ("CAR_C", "car_D", "Car_g")]
    want = ["too_small:100x90", "wrong_source_prefix", "selected", "unusable_image", "missing_source_file", "non_side_keyword", "scrape_exception_stem",
            "known_rejected_non_side", "wrong_source_prefix", "unusable_image", "already_labeled", "selected"]
    got = staging.stage_candidates(df, ["n"], *lists, "car_", ["rear"], 500).orderBy("n").collect()
    assert [r["reason"] for r in got] == want and [r["status"] == "selected" for r in got] == [w == "selected" for w in want]
    limited = staging.stage_candidates(df, ["n"], *lists, "car_", ["rear"], 500, 1).orderBy("n").collect()
    assert [r["reason"] for r in limited] == want[:3]


def test_rank_within_spreads_a_hot_key(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["hot"] * 8 + ["b", None]), i, "x", 7) for i in range(5000)]
    df = spark.createDataFrame(rows, "k string, i long, _o string, _q int").repartition(5)
    got = candidates.rank_within(df, ["k"], ["i"], "place")
    seen = {}
    want = {i: seen.setdefault(k, []).append(i) or len(seen[k]) for k, i, *_ in rows}
    assert {r["i"]: r["place"] for r in got.collect()} == want
    assert candidates.rank_within(df.where("false"), ["k"], ["i"], "place").collect() == []


def test_rank_within_several_keys(spark):
    rows = [(a, b, i) for i, (a, b) in enumerate([(1, "x"), (1, None), (None, "x"), (1, "x"), (None, None), (1, None), (2, "x"), (None, None)])]
    got = candidates.rank_within(spark.createDataFrame(rows, "a int, b string, i long"), ["a", "b"], ["i"]).collect()
    assert {r["i"]: r["place"] for r in got} == {0: 1, 1: 1, 2: 1, 3: 2, 4: 1, 5: 2, 6: 1, 7: 2}


def _greedy(n, edges, k):
    before = {}
    for a, b, kind in edges:
        before.setdefault(b, set()).add((a, kind))
    ok = {}
    for r in range(n):
        hits = [kind for a, kind in before.get(r, ()) if ok[a]]
        ok[r] = "A" not in hits and hits.count("B") < k
    return ok


@pytest.mark.parametrize("block", [4, 4096])
def test_greedy_in_blocks_against_a_walk(spark, block):
    rng = random.Random(block)
    n = 120
    edges = [(*sorted(rng.sample(range(n), 2)), rng.choice("AB")) for _ in range(400)]
    edges += [(0, b, "A") for b in range(60, 90)]
    rows = spark.range(n).withColumnRenamed("id", "rank")
    got = dedup.greedy_select(rows, spark.createDataFrame(edges + edges[:5], "a long, b long, kind string"), 2, block).collect()
    assert {r["rank"]: r["accepted"] for r in got} == _greedy(n, set(edges), 2)


def test_greedy_chain_of_thousands(spark):
    n = 5000
    rows = spark.range(n).withColumnRenamed("id", "rank")
    edges = rows.where("rank > 0").selectExpr("rank - 1 AS a", "rank AS b", "'A' AS kind")
    began = time.time()
    got = dedup.greedy_select(rows, edges).where("accepted").agg({"rank": "sum", "*": "count"}).collect()[0]
    assert tuple(got) in {(n // 2, sum(range(0, n, 2))), (sum(range(0, n, 2)), n // 2)} and time.time() - began < 60


def test_quota_state_goes_by_order_over_all_chunks():
    class Value:
        kept = None

        def exists(self):
            return self.kept is not None

        def get(self):
            return self.kept

        def update(self, v):
            self.kept = v

    p = QuotaProcessor({"side": 3}, "rank")
    p.accepted = Value()
    chunk = lambda *ranks: pd.DataFrame({"view": "side", "rank": ranks})
    run = lambda *chunks: {r: o for pdf in p.handleInputRows(("side",), iter(chunks), None) for r, o in zip(pdf["rank"], pdf["outcome"], strict=True)}
    assert run(chunk(9, 8), chunk(1), chunk(), chunk(5, 2, 7)) == {r: "accepted" if r in (1, 2, 5) else "rejected_quota_full" for r in (9, 8, 1, 5, 2, 7)}
    assert run(chunk(0)) == {0: "rejected_quota_full"} and p.accepted.get() == (3,)


@pytest.mark.parametrize(("bits", "distance", "agree"), [(64, 5, 2), (64, 5, 1), (64, 3, 3), (12, 1, 2)])
def test_phash_pairs_against_all_pairs(spark, bits, distance, agree):
    rng = random.Random(bits + agree)
    codes = []
    for _ in range(60):
        base = rng.getrandbits(bits) if rng.random() < 0.7 else rng.getrandbits(bits) & 0xFFF  # a crowd with equal high bands
        codes += [base] + [base ^ sum({1 << rng.randrange(bits) for _ in range(rng.randrange(8))}) for _ in range(3)]
    codes += codes[:5]
    signed = lambda c: c - (1 << 64) if c >= 1 << 63 else c
    rows = [(i, signed(c)) for i, c in enumerate(codes)] + [(999, None)]
    got = dedup.phash_pairs(spark.createDataFrame(rows, "id long, phash long"), distance, bits, agree=agree).collect()
    first = {}
    for i, c in enumerate(codes):
        first.setdefault(c, i)
    want = [(min(a, b), max(a, b), (x ^ y).bit_count()) for x, a in first.items() for y, b in first.items() if x < y and (x ^ y).bit_count() <= distance]
    want += [(first[c], i, 0) for i, c in enumerate(codes) if first[c] != i]
    assert sorted(tuple(r) for r in got) == sorted(want) and len(want) > 5
