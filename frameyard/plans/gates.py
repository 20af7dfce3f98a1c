"""Queries over candidates, gates, scores, splits and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameyard.functions.columns import md5_modulo_5, stem, suffix
from frameyard.operators import candidates, gates, reports, scoring, splits
from frameyard.plans.bind import BOXES, CANDIDATES, IMAGES, SPARK_WHEELS, WHEELS, Inputs, duck, query

SIZE = """CASE WHEN greatest(width, height) < 150 THEN 'too_small:' || CAST(greatest(width, height) AS VARCHAR) || 'px'
    WHEN greatest(width, height) > 6000 THEN 'too_large:' || CAST(greatest(width, height) AS VARCHAR) || 'px'
    WHEN least(width, height) = 0 THEN 'zero_dimension'
    WHEN CAST(width AS DOUBLE) / height < 1.10 THEN 'portrait_or_square:' || printf('%.2f', CAST(width AS DOUBLE) / height)
    WHEN CAST(width AS DOUBLE) / height > 4.0 THEN 'panoramic:' || printf('%.2f', CAST(width AS DOUBLE) / height) END"""
QUOTA = {"view": 300, "signup": 200, "purchase": 100, "error": 50}


def _quota(x: Inputs) -> DataFrame:
    return x.spark.createDataFrame([(v, n, 0) for v, n in QUOTA.items()], "view string, target int, accepted int")


QUOTA_SQL = ", ".join(f"('{v}', {n})" for v, n in QUOTA.items())
PASSED = f"""c AS ({duck(CANDIDATES)}), s AS (SELECT c.*, row_number() OVER (ORDER BY event_id) AS rank, {SIZE} AS size_reason FROM c),
q(view, target) AS (VALUES {QUOTA_SQL}),
n AS (SELECT s.*, coalesce(q.target, 0) AS free, row_number() OVER (PARTITION BY s.view ORDER BY rank) AS k FROM s LEFT JOIN q USING (view) WHERE size_reason IS NULL),
e AS (SELECT CASE WHEN count(*) = {len(QUOTA)} THEN max(rank) END AS last FROM n WHERE k = free),
p AS (SELECT n.*, CASE WHEN rank > (SELECT last FROM e) THEN 'not_processed' WHEN k <= free THEN 'accepted' ELSE 'rejected_quota_full' END AS outcome FROM n)"""


def _flagship(x: Inputs) -> DataFrame:
    ranked = candidates.with_rank(x.sql(CANDIDATES), ["event_id"]).withColumn("size_reason", gates.size_reason())
    passed = gates_quota(ranked.where("size_reason IS NULL"), x)
    failed = ranked.where("size_reason IS NOT NULL").withColumn("outcome", F.lit("rejected_quality"))
    return passed.unionByName(failed)


def gates_quota(df: DataFrame, x: Inputs) -> DataFrame:
    from frameyard.operators.dedup import apply_quota

    return apply_quota(df, _quota(x))


@query("flagship_outcomes", f"""WITH {PASSED}, a AS (SELECT view, source_name, outcome FROM p UNION ALL SELECT view, source_name, 'rejected_quality' FROM s WHERE size_reason IS NOT NULL)
SELECT 'accepted_view' AS kind, view AS key, count(*) AS n FROM a WHERE outcome = 'accepted' GROUP BY view
UNION ALL SELECT 'rejected_outcome', outcome, count(*) FROM a WHERE outcome <> 'accepted' GROUP BY outcome
UNION ALL SELECT 'rejected_source', source_name, count(*) FROM a WHERE outcome <> 'accepted' GROUP BY source_name""")
def flagship(x: Inputs) -> DataFrame:
    return reports.outcome_report(_flagship(x))


@query("c1_filter_bad_urls", """SELECT page_id, url FROM pages WHERE starts_with(url, 'http') AND NOT regexp_matches(lower(url), 'logo|icon|avatar|profile|banner|ads|sponsor')
AND NOT (ends_with(lower(url), '.svg') OR ends_with(lower(url), '.ai') OR ends_with(lower(url), '.eps'))""")
def c1(x: Inputs) -> DataFrame:
    return candidates.filter_bad_urls(x.table("pages"), "url").select("page_id", "url")


@query("c2_dedupe_and_cap", f"""WITH c AS ({duck(CANDIDATES)}), f AS (SELECT *, row_number() OVER (PARTITION BY view, source_name, image_url ORDER BY pos) AS k FROM c),
n AS (SELECT *, row_number() OVER (PARTITION BY view, source_name ORDER BY pos) AS m FROM f WHERE k = 1) SELECT event_id, view, source_name, image_url FROM n WHERE m <= 20""")
def c2(x: Inputs) -> DataFrame:
    out = candidates.dedupe_and_cap(x.sql(CANDIDATES), ["view", "source_name"], "image_url", ["pos"], 20)
    return out.select("event_id", "view", "source_name", "image_url")


@query("c3_extract_urls", r"""SELECT page_id, u AS image_url, CAST(i - 1 AS INTEGER) AS pos FROM (SELECT page_id, unnest(l) AS u, generate_subscripts(l, 1) AS i
FROM (SELECT page_id, regexp_extract_all(html, 'https?://[^"\\]+?\.(?:jpg|jpeg|png|webp)') AS l FROM pages))""")
def c3(x: Inputs) -> DataFrame:
    return candidates.extract_image_urls(x.table("pages"))


@query("c3_payload_url", """SELECT event_id, coalesce(nullif(props ->> '$.murl', ''), nullif(props ->> '$.k', '')) AS url FROM events""")
def c3b(x: Inputs) -> DataFrame:
    return x.table("events").select("event_id", candidates.payload_url("props", "murl", "k").alias("url"))


@query("c4_filter_queries", "SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'ring') ORDER BY p_partkey LIMIT 5")
def c4(x: Inputs) -> DataFrame:
    return candidates.filter_queries(x.table("part"), "RING", 5, "p_name", "p_partkey").select("p_partkey", "p_name")


@query("c5_query_matrix", "SELECT p_brand AS model, r_name AS view, p_brand || ' ' || r_name AS query FROM (SELECT DISTINCT p_brand FROM part) CROSS JOIN region")
def c5(x: Inputs) -> DataFrame:
    models = x.table("part").select(F.col("p_brand").alias("model")).distinct()
    return candidates.query_matrix(models, x.table("region").select(F.col("r_name").alias("view")))


@query("c6_mark_seen", f"""WITH c AS ({duck(CANDIDATES)}), s AS (SELECT DISTINCT image_url FROM c WHERE view = 'error')
SELECT event_id, CASE WHEN s.image_url IS NOT NULL THEN 'rejected_dedup_clip' END AS outcome, CASE WHEN s.image_url IS NOT NULL THEN 'url_seen' END AS reason_detail
FROM c LEFT JOIN s ON c.image_url = s.image_url""")
def c6(x: Inputs) -> DataFrame:
    c = x.sql(CANDIDATES)
    return candidates.mark_seen(c, c.where("view = 'error'")).select("event_id", "outcome", "reason_detail")


@query("c7_rank", "SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rank FROM lineitem")
def c7(x: Inputs) -> DataFrame:
    out = candidates.with_rank(x.table("lineitem"), ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    return out.select("l_orderkey", "l_linenumber", "rank")


@query("g2a_size_gate", f"WITH c AS ({duck(CANDIDATES)}) SELECT event_id, {SIZE} AS reason FROM c")
def g2a(x: Inputs) -> DataFrame:
    return x.sql(CANDIDATES).select("event_id", gates.size_reason().alias("reason"))


@query("g2b_raw_pool_gate", f"""WITH c AS ({duck(CANDIDATES)}) SELECT event_id, CASE WHEN greatest(width, height) < 220 THEN 'too_small:' || CAST(width AS VARCHAR) || 'x' || CAST(height AS VARCHAR)
WHEN CAST(width AS DOUBLE) / height < 1.10 OR CAST(width AS DOUBLE) / height > 3.20 THEN 'aspect_out_of_range:' || printf('%.3f', CAST(width AS DOUBLE) / height) END AS reason FROM c""")
def g2b(x: Inputs) -> DataFrame:
    return x.sql(CANDIDATES).select("event_id", gates.raw_pool_reason().alias("reason"))


NORMAL = f"""i AS ({duck(IMAGES)}), b AS ({duck(BOXES)}), d AS (SELECT b.stem, box_idx, i.width, i.height, cls, conf,
least(greatest((x1 + x2) / 2.0 / width, 0.0), 1.0) AS cx, least(greatest((y1 + y2) / 2.0 / height, 0.0), 1.0) AS cy,
least(greatest((x2 - x1) / width, 0.0), 1.0) AS w, least(greatest((y2 - y1) / height, 0.0), 1.0) AS h, CAST(trunc((x2 - x1) * (y2 - y1)) AS BIGINT) AS area_px
FROM b JOIN i USING (stem) WHERE cls = 2 AND x2 > x1 AND y2 > y1)"""


def _normal(x: Inputs) -> DataFrame:
    return gates.normalize_detections(x.sql(BOXES).join(x.sql(IMAGES).select("stem", "width", "height"), "stem"))


@query("g4_normalize_detections", f"WITH {NORMAL} SELECT stem, box_idx, cx, cy, w, h, area_px FROM d")
def g4(x: Inputs) -> DataFrame:
    return _normal(x).select("stem", "box_idx", "cx", "cy", "w", "h", "area_px")


@query("g5_car_presence", f"""WITH {NORMAL}, t AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY area_px DESC, box_idx) AS k FROM d)
SELECT i.stem, t.box_idx, t.area_px, CASE WHEN t.area_px IS NULL THEN 'no_detections' WHEN t.area_px / (CAST(i.width AS DOUBLE) * i.height) < 0.3 THEN 'car_area_below_ratio' END AS reason
FROM i LEFT JOIN t ON i.stem = t.stem AND k = 1""")
def g5(x: Inputs) -> DataFrame:
    return gates.gate_car_presence(x.sql(IMAGES), _normal(x)).select("stem", "box_idx", "area_px", "reason")


@query("g6_truncation", f"""WITH {NORMAL} SELECT stem, box_idx, CASE WHEN cx - w / 2 < 0 THEN 'truncated_left:' || printf('%.2f', cx - w / 2) WHEN cx + w / 2 > 1 THEN 'truncated_right:' || printf('%.2f', cx + w / 2)
WHEN cy - h / 2 < 0 THEN 'truncated_top:' || printf('%.2f', cy - h / 2) WHEN cy + h / 2 > 1 THEN 'truncated_bottom:' || printf('%.2f', cy + h / 2) END AS reason FROM d""")
def g6(x: Inputs) -> DataFrame:
    return _normal(x).select("stem", "box_idx", gates.truncation_reason().alias("reason"))


@query("g7_g9_g11_margin_gates", """WITH v AS (SELECT event_id, event_id % 3 AS f, CAST((event_id * 7) % 100 AS DOUBLE) / 100.0 AS a, CAST((event_id * 13) % 100 AS DOUBLE) / 100.0 AS b FROM events)
SELECT event_id, CASE WHEN f > 0 THEN 'face_detected' END AS face, a >= 0.55 AND a - b >= 0.05 AS real, a > b OR a >= 0.45 AS interior, a < 0.35 AND a < b - 0.05 AS clean, a - b >= 0.08 AS straight,
CASE WHEN a < 0.6 OR b < 0.1 THEN 'conf=' || printf('%.2f', a) || ' margin=' || printf('%.2f', b) END AS view_reason FROM v""")
def g9(x: Inputs) -> DataFrame:
    v = x.sql("SELECT event_id, event_id % 3 AS f, CAST((event_id * 7) % 100 AS DOUBLE) / 100.0 AS a, CAST((event_id * 13) % 100 AS DOUBLE) / 100.0 AS b FROM {events}")
    kinds = [gates.margin_passes(k, "a", "b").alias(k) for k in ("real", "interior", "clean", "straight")]
    return v.select("event_id", gates.face_reason("f").alias("face"), *kinds, gates.view_reason("a", "b").alias("view_reason"))


@query("g12_cascade", f"""WITH c AS ({duck(CANDIDATES)}), s AS (SELECT *, {SIZE} AS size_reason, CASE WHEN event_id % 5 = 0 THEN 'face_detected' END AS face FROM c)
SELECT event_id, CASE WHEN size_reason IS NOT NULL THEN 'rejected_quality' WHEN face IS NOT NULL THEN 'rejected_face' ELSE 'accepted' END AS outcome, coalesce(size_reason, face) AS reason_detail FROM s""")
def g12(x: Inputs) -> DataFrame:
    c = x.sql(CANDIDATES).withColumn("n_faces", F.when(F.col("event_id") % 5 == 0, 1).otherwise(0))
    return gates.run_cascade(c, [("rejected_quality", gates.size_reason()), ("rejected_face", gates.face_reason())]).select("event_id", "outcome", "reason_detail")


@query("g13_has_vehicle", f"""WITH i AS ({duck(IMAGES)}), b AS ({duck(BOXES)}), f AS (SELECT stem, min({{'b': box_idx, 'c': cls}}).c AS cls FROM b WHERE cls IN (1, 2, 3, 5, 7) AND conf >= 0.25 GROUP BY stem)
SELECT i.stem, CASE f.cls WHEN 1 THEN 'bicycle' WHEN 2 THEN 'car' WHEN 3 THEN 'motorcycle' WHEN 5 THEN 'bus' WHEN 7 THEN 'truck' ELSE 'none' END AS detected_vehicle,
CASE WHEN f.cls IS NULL THEN 'discard' ELSE 'keep' END AS action FROM i LEFT JOIN f USING (stem)""")
def g13(x: Inputs) -> DataFrame:
    return gates.filter_has_vehicle(x.sql(IMAGES), x.sql(BOXES)).select("stem", "detected_vehicle", "action")


@query("g14_side_view", f"""WITH w AS ({duck(WHEELS)}), v AS (SELECT *, abs(front_cx - rear_cx) AS wb, (front_radius_px + rear_radius_px) / 2.0 AS r FROM w)
SELECT stem, concat_ws('|', CASE WHEN wb / width < 0.32 THEN 'non_side_view: wheelbase too narrow for a clean lateral view' END,
CASE WHEN wb / r < 4.0 THEN 'non_side_view: wheel spacing too small relative to wheel size' END,
CASE WHEN greatest(front_gy, rear_gy) / height < 0.55 THEN 'non_side_view: wheel ground appears too high in frame' END) AS warnings FROM v""")
def g14(x: Inputs) -> DataFrame:
    return x.sql(SPARK_WHEELS).select("stem", F.array_join(gates.side_view_warnings(), "|").alias("warnings"))


@query("g15_g17_name_gates", f"""WITH i AS ({duck(IMAGES)}) SELECT stem, regexp_matches(lower(stem || ' ' || path), 'pool/3|99') AS anomalous, CASE WHEN NOT starts_with(stem, '1') THEN 'wrong_prefix' END AS reason FROM i""")
def g15(x: Inputs) -> DataFrame:
    return x.sql(IMAGES).select("stem", gates.name_is_anomalous("path", "stem", ["pool/3", "99"]).alias("anomalous"), gates.prefix_reason("stem", "1").alias("reason"))


@query("g16_readiness", """SELECT event_id, CASE WHEN user_id % 4 = 3 THEN 'bad_confidence' WHEN event_id % 3 = 0 THEN 'bad_resources' WHEN user_id % 4 = 0 OR event_id % 3 < 2 THEN 'not_ready' END AS failing FROM events""")
def g16(x: Inputs) -> DataFrame:
    raw = x.sql("""SELECT event_id, concat('{{"task": "t", "confidence": ', CASE user_id % 4 WHEN 0 THEN '0.5' WHEN 1 THEN '0.7' WHEN 2 THEN '0.9' ELSE '1.5' END,
        ', "resources": ', CAST(event_id % 3 AS STRING), '}}') AS raw FROM {events}""")
    return raw.select("event_id", gates.readiness().alias("failing"))


@query("g19_promotion", """WITH p AS (SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'raw_x' ELSE 'stanford_x' END AS stem, p_size % 7 = 0 AS exc, p_size % 3 = 0 AS bad, p_size % 9 = 0 AS corr, p_size % 5 = 0 AS high, p_size % 10 = 0 AS ok FROM part)
SELECT p_partkey, concat_ws(',', CASE WHEN NOT starts_with(stem, 'stanford_') THEN 'source_not_allowed' END, CASE WHEN exc THEN 'exception' END, CASE WHEN bad AND NOT corr THEN 'geometry' END,
CASE WHEN high AND NOT ok THEN 'needs_approval' END) AS failing FROM p""")
def g19(x: Inputs) -> DataFrame:
    p = x.sql("""SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'raw_x' ELSE 'stanford_x' END AS stem, p_size % 7 = 0 AS exception, CASE WHEN p_size % 3 = 0 THEN 'INVALID' ELSE 'VALID' END AS status,
        p_size % 9 = 0 AS corrected, 'ok' AS outcome, CASE WHEN p_size % 5 = 0 THEN 'REVIEW_HIGH' ELSE 'REVIEW_LOW' END AS priority, p_size % 10 = 0 AS approved, false AS fallback_only FROM {part}""")
    return gates.promote(p, "stanford_").select("p_partkey", F.array_join("failing", ",").alias("failing"))


EMBEDDED = "v AS (SELECT vec_id AS id, label, [CAST(a AS DOUBLE) for a in embedding] AS e FROM embeddings), u AS (SELECT id, label, [a / sqrt(list_sum([b * b for b in e])) for a in e] AS e FROM v)"
SCORES = f"""{EMBEDDED}, p AS (SELECT id AS prompt_idx, CAST(label % 3 AS VARCHAR) AS grp, e AS pe FROM u WHERE id < 9), z AS (SELECT u.id, prompt_idx, grp, 10.0 * list_inner_product(e, pe) AS z FROM u, p),
s AS (SELECT id, prompt_idx, grp, exp(z) / sum(exp(z)) OVER (PARTITION BY id) AS score FROM z)"""


def _scores(x: Inputs) -> DataFrame:
    e = x.table("embeddings")
    prompts = e.where("vec_id < 9").select(F.col("vec_id").alias("prompt_idx"), (F.col("label") % 3).cast("string").alias("grp"), "embedding")
    return scoring.prompt_scores(e.select(F.col("vec_id").alias("id"), "embedding"), prompts, 10.0)


@query("g8_prompt_scores", f"WITH {SCORES} SELECT id, prompt_idx, CAST(round(score, 6) AS DOUBLE) AS score FROM s")
def g8(x: Inputs) -> DataFrame:
    return _scores(x).select("id", "prompt_idx", F.round("score", 6).alias("score"))


@query("g10_classify_groups", f"""WITH {SCORES}, g AS (SELECT id, grp, sum(score) AS t FROM s GROUP BY ALL), r AS (SELECT id, grp, t, row_number() OVER (PARTITION BY id ORDER BY t DESC, grp DESC) AS k, lead(t) OVER (PARTITION BY id ORDER BY t DESC, grp DESC) AS nxt FROM g)
SELECT id, grp AS view, CAST(round(t, 6) AS DOUBLE) AS confidence, CAST(round(t - coalesce(nxt, 0), 6) AS DOUBLE) AS margin FROM r WHERE k = 1""")
def g10(x: Inputs) -> DataFrame:
    out = scoring.classify_groups(_scores(x))
    return out.select("id", "view", F.round("confidence", 6).alias("confidence"), F.round("margin", 6).alias("margin"))


@query("x_path_functions", r"""SELECT page_id, regexp_replace(b, '(.)\.[^.]*$', '\1') AS stem, lower(regexp_extract(b, '.(\.[^.]+)$', 1)) AS suffix FROM (SELECT page_id, regexp_extract(url, '[^/]*$') AS b FROM pages)""")
def x1(x: Inputs) -> DataFrame:
    return x.table("pages").select("page_id", stem("url").alias("stem"), suffix("url").alias("suffix"))


@query("x4_x8_hashes", """SELECT doc_id, sha256(text) AS sha, CAST(list_sum([CAST(position(substr(md5(text), CAST(i AS INTEGER), 1) IN '0123456789abcdef') AS BIGINT) - 1 for i in range(1, 33)]) % 5 AS INTEGER) AS m5, 'stanford_raw_' || lpad(CAST(doc_id AS VARCHAR), 5, '0') AS name FROM documents""")
def x4(x: Inputs) -> DataFrame:
    from frameyard.operators.select import safe_name

    return x.table("documents").select("doc_id", F.sha2("text", 256).alias("sha"), md5_modulo_5("text").cast("int").alias("m5"), safe_name("stanford_raw", 5, "doc_id").alias("name"))


@query("p1_split_by_id", "SELECT event_id, CASE WHEN CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 5 = 0 THEN 'val' ELSE 'train' END AS split FROM events")
def p1(x: Inputs) -> DataFrame:
    e = x.table("events").withColumn("uuid", F.md5(F.col("event_id").cast("string").cast("binary")))
    return e.select("event_id", splits.split_by_id("uuid").alias("split"))


@query("p2_split_by_stem", """SELECT p_partkey, CASE WHEN list_sum([CAST(position(substr(md5(p_name || CAST(p_partkey AS VARCHAR)), CAST(i AS INTEGER), 1) IN '0123456789abcdef') AS BIGINT) - 1 for i in range(1, 33)]) % 5 = 0 THEN 'val' ELSE 'train' END AS split FROM part""")
def p2(x: Inputs) -> DataFrame:
    return splits.split_by_stem(x.sql("SELECT p_partkey, concat(p_name, CAST(p_partkey AS STRING)) AS stem, 'train' AS split FROM {part}")).select("p_partkey", "split")


@query("p3_last_n_split", """WITH s AS (SELECT s_name, row_number() OVER (ORDER BY lower(s_name) DESC, s_name DESC) AS k, count(*) OVER () AS n FROM supplier)
SELECT s_name AS stem, CASE WHEN k <= greatest(1, least(8, round_even(0.25 * n, 0))) THEN 'val' ELSE 'train' END AS split FROM s""")
def p3(x: Inputs) -> DataFrame:
    return splits.last_n_split(x.table("supplier").select(F.col("s_name").alias("stem"))).select("stem", "split")


@query("p4_shuffle_split", """WITH d AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('42' || CAST(doc_id AS VARCHAR)), CAST(doc_id AS VARCHAR)) AS k, count(*) OVER (PARTITION BY lang) AS n FROM documents)
SELECT doc_id, CASE WHEN k <= floor(n * 0.8) THEN 'train' ELSE 'val' END AS split FROM d""")
def p4(x: Inputs) -> DataFrame:
    d = x.table("documents").select("doc_id", "lang", F.col("doc_id").cast("string").alias("path"))
    return splits.shuffle_split(d, "lang", "path").select("doc_id", "split")


@query("p5_row_id", "SELECT page_id, md5(url) AS uuid FROM pages")
def p5(x: Inputs) -> DataFrame:
    return x.table("pages").select("page_id", splits.row_id("url").alias("uuid"))


@query("d6_quota", f"WITH {PASSED} SELECT event_id, outcome FROM p")
def d6(x: Inputs) -> DataFrame:
    ranked = candidates.with_rank(x.sql(CANDIDATES), ["event_id"]).where(gates.size_reason().isNull())
    return gates_quota(ranked, x).select("event_id", "outcome")


@query("r2_quota_progress", f"""WITH q(view, target) AS (VALUES {QUOTA_SQL}), a AS (SELECT event_type AS view, count(*) AS n FROM events GROUP BY 1)
SELECT view, n AS accepted, target, greatest(0, target - n) AS remaining, repeat('#', CAST(least(30, floor(30 * n / greatest(target, 1))) AS INTEGER)) AS bar FROM q JOIN a USING (view)""")
def r2(x: Inputs) -> DataFrame:
    n = x.table("events").groupBy(F.col("event_type").alias("view")).agg(F.count("*").alias("accepted"))
    return reports.quota_progress(_quota(x).drop("accepted").join(n, "view"))


@query("r6_action_counts", "SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL")
def r6(x: Inputs) -> DataFrame:
    return reports.action_counts(x.table("documents"), ["lang", "source"])


@query("r7_review_gate", """WITH s AS (SELECT lpad(CAST(doc_id AS VARCHAR), 9, '0') AS p, quality = 0 AS pending, toxic = 1 AS bad FROM labels)
SELECT count(*) FILTER (pending) AS n_pending, count(*) FILTER (bad) AS n_bad_label, count(*) FILTER (NOT pending AND NOT bad) AS n_ready,
(SELECT string_agg(p, ',' ORDER BY p) FROM (SELECT p FROM s WHERE pending OR bad ORDER BY p LIMIT 10)) AS first FROM s""")
def r7(x: Inputs) -> DataFrame:
    s = x.table("labels").select(F.lpad(F.col("doc_id").cast("string"), 9, "0").alias("source_path"), F.when(F.col("quality") == 0, "no").otherwise("yes").alias("reviewed"), F.when(F.col("toxic") == 1, "odd").otherwise("side").alias("confirmed_label"))
    return reports.review_gate(s, ("side", "other"))


@query("r10_dataset_integrity", """SELECT coalesce(d.stem, l.stem) AS stem, CASE WHEN l.stem IS NULL THEN 'image_without_label' WHEN d.stem IS NULL THEN 'label_without_image' WHEN l.n < 5 OR (l.n - 5) % 3 <> 0 THEN 'bad_line' END AS problem
FROM (SELECT CAST(doc_id AS VARCHAR) AS stem FROM documents WHERE doc_id % 7 <> 0) d FULL JOIN (SELECT CAST(doc_id AS VARCHAR) AS stem, 4 + doc_id % 5 AS n FROM labels) l ON d.stem = l.stem""")
def r10(x: Inputs) -> DataFrame:
    images = x.sql("SELECT CAST(doc_id AS STRING) AS stem, lang AS view FROM {documents} WHERE doc_id % 7 <> 0")
    labels = x.sql("SELECT CAST(doc_id AS STRING) AS stem, trim(repeat('1 ', CAST(4 + doc_id % 5 AS INT))) AS line FROM {labels}")
    return reports.dataset_integrity(images, labels).select("stem", "problem")


@query("r10_view_counts", """SELECT lang AS view, count(*) AS n_images, count(*) FILTER (d.doc_id % 13 = 0) AS n_unreadable, count(*) FILTER (l.doc_id IS NULL OR 4 + l.doc_id % 5 < 5 OR (4 + l.doc_id % 5 - 5) % 3 <> 0) AS n_problems
FROM documents d LEFT JOIN labels l USING (doc_id) WHERE d.doc_id % 7 <> 0 GROUP BY 1""")
def r10b(x: Inputs) -> DataFrame:
    images = x.sql("SELECT CAST(doc_id AS STRING) AS stem, lang AS view, CASE WHEN doc_id % 13 = 0 THEN -1 ELSE 100 END AS width FROM {documents} WHERE doc_id % 7 <> 0")
    labels = x.sql("SELECT CAST(doc_id AS STRING) AS stem, trim(repeat('1 ', CAST(4 + doc_id % 5 AS INT))) AS line FROM {labels}")
    return reports.view_counts(images, labels)


@query("r11_schema_purity", "SELECT source AS dir, array_to_string(list_sort(list_distinct(list(CAST(5 + 3 * (doc_id % CASE WHEN source < 'src3' THEN 1 ELSE 2 END) AS VARCHAR)))), ',') AS fields FROM documents GROUP BY 1")
def r11(x: Inputs) -> DataFrame:
    labels = x.sql("SELECT source AS dir, trim(repeat('1 ', CAST(5 + 3 * (doc_id % CASE WHEN source < 'src3' THEN 1 ELSE 2 END) AS INT))) AS line FROM {documents}")
    return reports.schema_purity(labels).select("dir", F.array_join(F.sort_array(F.transform("fields", lambda f: f.cast("string"))), ",").alias("fields"))


