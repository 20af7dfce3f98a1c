"""Queries over staging runs, carried-over state and whole pipelines."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameyard.functions.durable import materialize, shared_dir
from frameyard.operators import cascade, dedup, gates, reports, staging
from frameyard.plans.bind import Inputs, duck, query
from frameyard.sources import sinks
from frameyard.streaming import jobs
from frameyard.streaming.state import RunState

#: Two keys, each with a hot value, in an order that makes chains of rows that share one key or the other.
KEYED = """SELECT p_partkey AS id, p_size % 5 <> 0 AS ok, CASE WHEN p_partkey % 3 = 0 THEN 'hot' WHEN p_partkey % 41 <> 1 THEN concat('h', CAST((p_partkey * 7919) % 601 AS STRING)) END AS sha,
    CASE WHEN p_partkey % 7 = 0 THEN 'hot' ELSE concat('s', CAST((p_partkey * 104729) % 433 AS STRING)) END AS stem FROM {part}"""
WALKED = """w(i, h, s, sel, dh, ds) AS (SELECT CAST(0 AS BIGINT), CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[]), false, false, false UNION ALL
SELECT d.i, CASE WHEN take AND {h} IS NOT NULL THEN list_append(h, {h}) ELSE h END, CASE WHEN take THEN list_append(s, {s}) ELSE s END, take, dh2, ds2
FROM (SELECT w.h, w.s, d.*, coalesce(list_contains(w.h, d.{h}), false) AS dh2, list_contains(w.s, d.{s}) AS ds2, d.ok AND NOT dh2 AND NOT ds2 AS take FROM w JOIN d ON d.i = w.i + 1) AS d)"""


@query("d1_two_keys", f"""WITH RECURSIVE k AS ({duck(KEYED)}), d AS (SELECT *, row_number() OVER (ORDER BY id) AS i FROM k), {WALKED.format(h='sha', s='stem')}
SELECT id, sel AS selected, dh AS dup_sha, ds AS dup_stem FROM d JOIN w USING (i)""")
def d1_two_keys(x: Inputs) -> DataFrame:
    return staging.dedupe_by_keys(x.sql(KEYED), ["sha", "stem"], ["id"], F.col("ok")).select("id", "selected", "dup_sha", "dup_stem")


#: Candidates of several folders; contents and stems repeat.
STAGED = """SELECT p_size % 3 AS source_rank, concat(CASE WHEN p_partkey % 10 = 4 THEN 'web_' ELSE 'Pool_' END, CAST((p_partkey * 31) % 1300 AS STRING)) AS stem,
    concat('raw/', CASE WHEN p_partkey % 23 = 5 THEN 'Interior' ELSE 'side' END, '/', CAST(p_partkey AS STRING), '.jpg') AS path, p_partkey,
    md5(CAST(CASE WHEN p_partkey % 4 = 3 THEN 1 ELSE (p_partkey * 17) % 1700 END AS STRING)) AS sha, CASE WHEN p_partkey % 29 <> 3 THEN CAST(200 + (p_partkey * 37) % 900 AS INT) END AS width,
    CAST(100 + (p_partkey * 53) % 500 AS INT) AS height, p_partkey % 31 <> 7 AS has_file FROM {part}"""
LISTS = ("SELECT concat('pool_', CAST(s_suppkey * 13 AS STRING)) AS stem FROM {supplier} WHERE s_suppkey % 2 = 0", "SELECT concat('POOL_', CAST(c_custkey * 11 AS STRING)) AS stem FROM {customer} WHERE c_custkey % 3 = 0",
         "SELECT concat('Pool_', CAST(doc_id AS STRING)) AS stem FROM {labels} WHERE toxic = 1")
IN_LIST = "lower(stem) IN (SELECT lower(stem) FROM ({}))"


@query("g18_stage_candidates", f"""WITH RECURSIVE a AS ({duck(STAGED)}), b AS (SELECT *, lower(stem) AS stem_key, row_number() OVER (ORDER BY source_rank, stem, path) AS i,
CASE WHEN {IN_LIST.format(duck(LISTS[0]))} THEN 'scrape_exception_stem' WHEN NOT starts_with(stem, 'Pool_') THEN 'wrong_source_prefix' WHEN {IN_LIST.format(duck(LISTS[1]))} THEN 'known_rejected_non_side'
WHEN {IN_LIST.format(duck(LISTS[2]))} THEN 'already_labeled' WHEN regexp_matches(lower(stem || ' ' || path), 'interior|rear') THEN 'non_side_keyword' END AS before,
CASE WHEN width IS NULL THEN 'unusable_image' WHEN greatest(width, height) < 500 THEN 'too_small:' || width || 'x' || height WHEN NOT has_file THEN 'missing_source_file' END AS behind FROM a),
d AS (SELECT *, before IS NULL AND behind IS NULL AS ok FROM b), {WALKED.format(h='sha', s='stem_key')},
f AS (SELECT d.*, sel, coalesce(before, CASE WHEN ds THEN 'duplicate_stem' WHEN dh THEN 'duplicate_content_hash' END, behind, 'selected') AS reason, count(*) FILTER (sel) OVER (ORDER BY i ROWS UNBOUNDED PRECEDING) AS t FROM d JOIN w USING (i))
SELECT p_partkey, stem, CASE WHEN sel THEN 'selected' ELSE 'rejected' END AS status, reason FROM f WHERE t < 60 OR (t = 60 AND sel)""")
def g18_stage_candidates(x: Inputs) -> DataFrame:
    out = staging.stage_candidates(x.sql(STAGED), ["source_rank", "stem", "path"], *map(x.sql, LISTS), "Pool_", ["interior", "rear"], 500, 60)
    return out.select("p_partkey", "stem", "status", "reason")


#: Images of a run in order of rank: embeddings, with urls that come again and sizes that a gate rejects.
SHOTS = """SELECT vec_id + 1 AS rank, CASE label % 3 WHEN 0 THEN 'front' WHEN 1 THEN 'side' ELSE 'rear' END AS view, concat('u', CAST((vec_id * 7) % 400 AS STRING)) AS url,
    CAST(vec_id AS STRING) AS uuid, embedding, CAST((vec_id * 37) % 1000 AS INT) AS width FROM {embeddings}"""
TARGETS = {"front": 60, "side": 80, "rear": 50}
NEAR, SMALL = 0.3, 100


def sequential_sql(targets: dict[str, int], near: str, hits: int, gate: str = "NULL") -> str:
    """The outcome of each row of s (rank, view, url) when rows are walked one by one: p (a, b) are similar ranks."""
    count = {v: f"n{i}" for i, v in enumerate(targets)}
    full = " AND ".join(f"w.{c} >= {targets[v]}" for v, c in count.items())
    mine = "CASE view " + " ".join(f"WHEN '{v}' THEN w.{c} >= {targets[v]}" for v, c in count.items()) + " ELSE true END"
    return f"""p AS ({near}), d AS (SELECT s.*, {gate} AS reason, coalesce((SELECT list(a) FROM p WHERE b = rank), []) AS near, row_number() OVER (ORDER BY rank) AS i FROM s),
w(i, acc, urls, {", ".join(count.values())}, outcome) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST([] AS VARCHAR[]), {", ".join("0" for _ in count)}, '' UNION ALL
SELECT i, CASE WHEN o = 'accepted' THEN list_append(acc, rank) ELSE acc END, CASE WHEN o = 'accepted' THEN list_append(urls, url) ELSE urls END,
{", ".join(f"{c} + CASE WHEN o = 'accepted' AND view = '{v}' THEN 1 ELSE 0 END" for v, c in count.items())}, o
FROM (SELECT d.*, w.acc, w.urls, {", ".join(f"w.{c}" for c in count.values())}, CASE WHEN {full} THEN 'not_processed' WHEN list_contains(w.urls, d.url) THEN 'url_seen' WHEN d.reason IS NOT NULL THEN 'rejected_heuristic'
WHEN {mine} THEN 'rejected_quota_full' WHEN len(list_filter(d.near, lambda x: list_contains(w.acc, x))) >= {hits} THEN 'rejected_dedup_clip' ELSE 'accepted' END AS o FROM w JOIN d ON d.i = w.i + 1))"""


SIMILAR = """SELECT a.rank AS a, b.rank AS b FROM v a JOIN v b ON a.{by} = b.{by} AND a.rank < b.rank AND list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e) * list_inner_product(b.e, b.e)) >= """
RUN = f"""WITH RECURSIVE s AS ({duck(SHOTS)}), v AS (SELECT rank, view, [CAST(a AS DOUBLE) for a in embedding] AS e FROM s WHERE width >= {SMALL}),
{sequential_sql(TARGETS, SIMILAR.format(by="view") + str(NEAR), 2, f"CASE WHEN width < {SMALL} THEN 'too_small' END")}"""


def _too_small():
    return F.when(F.col("width") < SMALL, "too_small")


@query("t1_ingest", f"{RUN} SELECT d.rank, d.view, w.outcome FROM d JOIN w USING (i)")
def t1_ingest(x: Inputs) -> DataFrame:
    """Three files as three micro-batches, each decided against what the ones before have committed."""
    root = f"{shared_dir(x.spark)}/ingest-{uuid.uuid4().hex}"
    shots = materialize(x.sql(SHOTS))
    last = shots.agg(F.max("rank")).collect()[0][0] or 0
    for part in range(3):
        shots.where((F.col("rank") * 3 > last * part) & (F.col("rank") * 3 <= last * (part + 1))).coalesce(1).write.mode("append").parquet(f"{root}/in")
    state = RunState(x.spark, f"{root}/state", compact=2)

    def decide(batch: DataFrame, manifest: dict, state: RunState) -> DataFrame:
        return dedup.continue_run(batch, state.accepted(manifest), state.quota(TARGETS, manifest), _too_small(), NEAR, block=256)

    stream = x.spark.readStream.schema(shots.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    jobs.ingest(stream, decide, state, ["rank", "view", "url", "uuid", "embedding"], f"{root}/log").awaitTermination()
    out = state.rows()
    return (shots.limit(0).withColumn("outcome", F.lit("")) if out is None else out).select("rank", "view", "outcome")


@query("s14_d5_second_run", f"{RUN} SELECT d.rank, d.view, w.outcome FROM d JOIN w USING (i)")
def s14_d5_second_run(x: Inputs) -> DataFrame:
    """Two runs, the second seeded with the index of the first, as one run would decide."""
    root = f"{shared_dir(x.spark)}/index-{uuid.uuid4().hex}"
    shots = materialize(x.sql(SHOTS))
    half = (shots.agg(F.max("rank")).collect()[0][0] or 0) // 2
    first = materialize(dedup.continue_run(shots.where(F.col("rank") <= half), None, TARGETS, _too_small(), NEAR, block=256))
    taken = first.where("outcome = 'accepted'")
    for _ in range(2):  # a batch that is written again replaces itself
        sinks.append_index(taken, root, "first")
    counts = {r["view"]: r["n"] for r in reports.action_counts(taken, ["view"]).collect()}  # a row a view
    index = sinks.read_index(x.spark, root, list(TARGETS)).select("uuid", F.col("embedding").alias("_e"))
    seeds = taken.drop("embedding").join(index, "uuid").withColumnRenamed("_e", "embedding")
    left = {v: max(0, n - counts.get(v, 0)) for v, n in TARGETS.items()}
    second = dedup.continue_run(shots.where(F.col("rank") > half), seeds, left, _too_small(), NEAR, block=256)
    return first.unionByName(second).select("rank", "view", "outcome")


#: The shots with bytes and sizes; the scorers below make up what models would see, by arithmetic on the rank.
PHOTOS = """SELECT vec_id + 1 AS rank, CASE label % 3 WHEN 0 THEN 'front' WHEN 1 THEN 'side' ELSE 'rear' END AS view, concat('u', CAST((vec_id * 7) % 400 AS STRING)) AS url, embedding,
    CASE WHEN vec_id % 37 = 5 THEN '' ELSE 'bytes' END AS content, CASE WHEN vec_id % 41 = 6 THEN -1 ELSE CAST(400 + (vec_id * 37) % 900 AS INT) END AS width, CAST(200 + (vec_id * 53) % 220 AS INT) AS height FROM {embeddings}"""
#: Scores: column, factor, modulus, divisor, offset.
FAKES = {
    "detector": (("area", 13, 50, 100.0, 0.27), ("cx", 29, 30, 100.0, 0.35), ("cy", 23, 20, 100.0, 0.40), ("w", 31, 40, 100.0, 0.42), ("h", 17, 30, 100.0, 0.40), ("cars", 1, 43, 1.0, 0.0)),
    "faces": (("n_faces", 1, 29, 28.0, 0.0),),
    "prompts": (("photo", 7, 40, 100.0, 0.52), ("drawn", 11, 20, 100.0, 0.30), ("inside", 13, 46, 100.0, 0.02), ("outside", 3, 10, 100.0, 0.44), ("noisy", 5, 40, 100.0, 0.0), ("clean", 9, 50, 100.0, 0.30),
                ("straight", 19, 40, 100.0, 0.50), ("angled", 7, 20, 100.0, 0.32)),
    "views": (("confidence", 21, 39, 100.0, 0.58), ("margin", 33, 40, 100.0, 0.08)),
}


def _fake(name: str) -> cascade.Scorer:
    def make():
        return lambda pdf: pd.DataFrame({c: (pdf["rank"] * f % m).astype("f8") / d + o for c, f, m, d, o in FAKES[name]})

    c = F.col
    found = {
        "detector": [
            ("rejected_no_car", F.when(c("cars") == 4, "no_detections").when(c("area") < 0.30, "car_area_below_ratio")), ("rejected_truncated", gates.truncation_reason()),
        ],
        "faces": [("rejected_has_face", F.when(c("n_faces") >= 1, ""))],
        "prompts": [
            ("rejected_not_real", F.when(~gates.margin_passes("real", "photo", "drawn"), "")), ("rejected_interior", F.when(gates.margin_passes("interior", "inside", "outside"), "")),
            ("rejected_noisy", F.when(~gates.margin_passes("clean", "noisy", "clean"), "")), ("rejected_angle", F.when(~gates.margin_passes("straight", "straight", "angled"), "3q_or_diagonal")),
        ],
        "views": [("rejected_view_unsure", gates.view_reason())],
    }[name]
    return cascade.Scorer(name, make, ", ".join(f"{c[0]} double" for c in FAKES[name]), found)


SCORED = ", ".join(f"CAST(rank * {f} % {m} AS DOUBLE) / {d!r} + {o!r} AS {c}" for cols in FAKES.values() for c, f, m, d, o in cols)
ASPECT = "CAST(width AS DOUBLE) / height"
GATED = f"""CASE WHEN content = '' THEN ['rejected_download', 'empty_response'] WHEN width < 0 THEN ['rejected_download', 'decode_failed']
WHEN {ASPECT} < 1.10 THEN ['rejected_heuristic', 'portrait_or_square:' || printf('%.2f', {ASPECT})] WHEN {ASPECT} > 4.0 THEN ['rejected_heuristic', 'panoramic:' || printf('%.2f', {ASPECT})]
WHEN cars = 4 THEN ['rejected_no_car', 'no_detections'] WHEN area < 0.30 THEN ['rejected_no_car', 'car_area_below_ratio']
WHEN cx - w / 2 < 0 THEN ['rejected_truncated', 'truncated_left:' || printf('%.2f', cx - w / 2)] WHEN cx + w / 2 > 1 THEN ['rejected_truncated', 'truncated_right:' || printf('%.2f', cx + w / 2)]
WHEN cy - h / 2 < 0 THEN ['rejected_truncated', 'truncated_top:' || printf('%.2f', cy - h / 2)] WHEN cy + h / 2 > 1 THEN ['rejected_truncated', 'truncated_bottom:' || printf('%.2f', cy + h / 2)]
WHEN n_faces >= 1 THEN ['rejected_has_face', NULL] WHEN NOT (photo >= 0.55 AND photo - drawn >= 0.05) THEN ['rejected_not_real', NULL] WHEN inside > outside OR inside >= 0.45 THEN ['rejected_interior', NULL]
WHEN NOT (noisy < 0.35 AND noisy < clean - 0.05) THEN ['rejected_noisy', NULL] WHEN straight - angled < 0.08 THEN ['rejected_angle', '3q_or_diagonal']
WHEN confidence < 0.60 OR margin < 0.10 THEN ['rejected_view_unsure', 'conf=' || printf('%.2f', confidence) || ' margin=' || printf('%.2f', margin)] END"""
WANTED = {"front": 9, "side": 60, "rear": 8}


@query("g12_whole_cascade", f"""WITH RECURSIVE g AS (SELECT *, {GATED} AS gate FROM (SELECT *, {SCORED} FROM ({duck(PHOTOS)}))), s AS (SELECT rank, view, url, gate FROM g),
v AS (SELECT rank, view, [CAST(a AS DOUBLE) for a in embedding] AS e FROM g WHERE gate IS NULL), {sequential_sql(WANTED, SIMILAR.format(by="view") + "0.2", 2, "gate")}
SELECT rank, CASE outcome WHEN 'rejected_heuristic' THEN reason[1] WHEN 'url_seen' THEN 'rejected_dedup_clip' ELSE outcome END AS outcome,
CASE WHEN outcome = 'rejected_heuristic' THEN reason[2] WHEN outcome = 'url_seen' THEN 'url_seen' WHEN outcome IN ('rejected_quota_full', 'rejected_dedup_clip') THEN view END AS reason_detail FROM d JOIN w USING (i)""")
def g12_whole(x: Inputs) -> DataFrame:
    cheap = [("rejected_download", gates.decoded_reason()), ("rejected_heuristic", gates.size_reason())]
    gated, _ = cascade.score_cascade(x.sql(PHOTOS), cheap, [_fake(n) for n in FAKES], ["content", "embedding"])
    gated = materialize(gated.select("rank", "view", "url", "embedding", "outcome", "reason_detail"))
    decided = dedup.continue_run(gated.drop("outcome", "reason_detail").join(gated.select("rank", F.col("outcome").alias("gate")), "rank"), None, WANTED, F.col("gate"), 0.2, block=256)
    return cascade.settle(gated, decided).select("rank", "outcome", "reason_detail")
