"""Embedding near-duplicates with a robust-pruned flat graph.

Vectors of a label are dealt to the shards of their nearest centroids, several each, so that shards overlap. Each
shard builds a graph whose adjacency lists are robust-pruned (a neighbour is dropped if a kept one lies much nearer to
it); the lists of a vector in all its shards are united. Each vector then searches its shards: greedily from the
shard's medoids with a beam, and then on through every vector within range, the range search of the flat graph. Hits
are verified in double precision, and a pair that several shards hold counts in the first of them only. Recall is
audited against brute force on a sample of queries; below the target the overlap is doubled, and from half of all
shards on blocked products take the place of the graphs, in which every two parts of a label meet once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameyard.llm.common import bounded_broadcast, connected_components, materialize, release

#: The index is fitted on at most SAMPLE vectors, four a centroid or more; every vector is indexed.
SAMPLE, SHARD = 20_000, 1500
OVERLAP, DEGREE, BEAM, ALPHA, MEDOIDS = 2, 24, 64, 1.2, 24
AUDIT, TARGET = 512, 0.99


def robust_prune(v: np.ndarray, i: int, cand: np.ndarray, sims: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Neighbours of i out of cand: nearest first; one is dropped if a kept neighbour is alpha times nearer to it."""
    order = np.argsort(-sims, kind="stable")
    cand, dist = cand[order], 2 - 2 * sims[order]
    near = v[cand]
    kept: list[int] = []
    alive = cand != i
    while len(kept) < degree and alive.any():
        j = int(alive.argmax())
        kept.append(cand[j])
        alive &= alpha * alpha * (2 - 2 * (near @ near[j])) > dist
        alive[j] = False
    return np.array(kept, "i4")


def medoids(v: np.ndarray, k: int = MEDOIDS) -> np.ndarray:
    """The vectors nearest to the centres of k clusters: where searches start."""
    c = kmeans(v, min(k, len(v)), 4)
    return np.unique((c @ v.T).argmax(1))


def build_graph(v: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> list[np.ndarray]:
    """Adjacency lists of a shard: from a random start graph, twice: each vector searches the graph as it is, prunes
    what it met, and its neighbours take it in and prune again."""
    m = len(v)
    if m <= 1:
        return [np.zeros(0, "i4") for _ in range(m)]
    rng = np.random.default_rng(m)
    graph = [np.unique(rng.integers(0, m, min(degree, m))).astype("i4") for _ in range(m)]
    start = medoids(v)
    for _ in range(2):
        met = search(v, v, graph, start, beam, None)[1]
        lists = []
        for i in range(m):
            cand = np.union1d(met[i], graph[i]).astype("i4")
            sims = v[cand] @ v[i]
            # alpha = 1 keeps a way out of a dense cluster, alpha > 1 the ways inside it
            lists.append(np.union1d(robust_prune(v, i, cand, sims, degree, 1.0), robust_prune(v, i, cand, sims, degree, alpha)))
        back: list[list[int]] = [[] for _ in range(m)]
        for i, g in enumerate(lists):
            for j in g:
                back[j].append(i)
        for j in range(m):
            cand = np.union1d(lists[j], back[j]).astype("i4")
            if len(cand) > 2 * degree:
                sims = v[cand] @ v[j]
                cand = np.union1d(robust_prune(v, j, cand, sims, degree, 1.0), robust_prune(v, j, cand, sims, degree, alpha))
            graph[j] = cand.astype("i4")
    return graph


def search(queries: np.ndarray, v: np.ndarray, graph: list[np.ndarray], start: np.ndarray, beam: int, least: float | None):
    """Range search of all queries at once. Greedy with a beam from the medoids; then, if least is given, on from every
    vector with cosine >= least until none is new. Returns (hits, met): per query the numbers in range, and all met."""
    n, m = len(queries), len(v)
    table = np.full((m, max([1, *map(len, graph)])), -1, "i4")
    for i, g in enumerate(graph):
        table[i, : len(g)] = g
    sims = np.full((n, m), -2.0, "f4")  # -2: not met
    opened = np.zeros((n, m), bool)
    sims[:, start] = queries @ v[start].T
    ids, near = np.full((n, beam), start[0], "i4"), np.full((n, beam), -2.0, "f4")
    ids[:, : len(start)], near[:, : len(start)] = start, sims[:, start]
    rows = np.arange(n)
    while len(rows):
        # the best vector of each beam not yet opened is opened; queries whose beam is all open are through
        left = np.where(opened[rows[:, None], ids[rows]], -2, near[rows])
        best = left.argmax(1)
        go = left[np.arange(len(rows)), best] > -2
        rows, pick = rows[go], ids[rows[go], best[go]]
        if not len(rows):
            break
        new = table[pick]
        score = np.full(new.shape, -2.0, "f4")
        fresh = (new >= 0) & (sims[rows[:, None], new] == -2)
        r, c = np.nonzero(fresh)
        score[r, c] = np.einsum("ij,ij->i", queries[rows[r]], v[new[r, c]])
        sims[rows[r], new[r, c]] = score[r, c]
        opened[rows, pick] = True
        all_ids, all_near = np.concatenate((ids[rows], new), 1), np.concatenate((near[rows], score), 1)
        top = np.argpartition(-all_near, beam - 1, axis=1)[:, :beam]
        ids[rows], near[rows] = np.take_along_axis(all_ids, top, 1), np.take_along_axis(all_near, top, 1)
    if least is not None:
        while True:
            q, i = np.nonzero((sims >= least) & ~opened)
            if not len(q):
                break
            for at in range(0, len(q), 20_000):
                _open(queries, v, table, sims, opened, q[at : at + 20_000], i[at : at + 20_000])
    met = [np.flatnonzero(s > -2) for s in sims]
    return ([np.flatnonzero(s >= least) for s in sims] if least is not None else None), met


def _open(queries, v, table, sims, opened, q, i) -> None:
    opened[q, i] = True
    near = table[i]
    qq = np.repeat(q, near.shape[1])
    nn = near.ravel()
    new = nn >= 0
    qq, nn = qq[new], nn[new]
    new = sims[qq, nn] == -2
    qq, nn = qq[new], nn[new]
    sims[qq, nn] = np.einsum("ij,ij->i", queries[qq], v[nn])


def _unit(pdf: pd.DataFrame) -> np.ndarray:
    x = np.array(pdf["embedding"].tolist(), "f8")
    x /= np.abs(x).max(1, keepdims=True, initial=1e-320)  # squares of very large and very small numbers don't exist
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    c = x[np.random.default_rng(k).choice(len(x), k, replace=False)]
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        c = np.stack([x[own == j].sum(0) if (own == j).any() else c[j] for j in range(k)])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def _valid(vec: Column, label: Column) -> Column:
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return label.isNotNull() & vec.isNotNull() & (F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0)


def _assign(reps: DataFrame, centroids, overlap: int) -> DataFrame:
    """reps with shards: the overlap nearest centroids of the label, in order."""

    def run(batches):
        table = centroids.value
        for pdf in batches:
            out = []
            for label, part in pdf.groupby("label", sort=False):
                c = table.get(label)  # a label outside the sample has one shard
                near = np.zeros((len(part), 1), "i4") if c is None else np.argsort(-(_unit(part) @ c.T), axis=1, kind="stable")[:, :overlap]
                out.append(part.assign(shards=[np.sort(r).astype("i4") for r in near]))
            if out:
                yield pd.concat(out)

    return reps.mapInPandas(run, "rep long, label string, embedding array<double>, many long, shards array<int>")


def _shard_rows(assigned: DataFrame) -> DataFrame:
    """One row per vector and shard. A shard over its size is cut into parts: each builds its own graph, and the vectors
    of every part search all the parts, so that none is left out."""
    rows = assigned.withColumn("shard", F.explode("shards"))
    sizes = rows.groupBy("label", "shard").agg(F.count("*").alias("size"))
    sizes = sizes.select(F.col("label").alias("l"), F.col("shard").alias("s"), F.ceil(F.col("size") / (2 * SHARD)).alias("parts"))
    rows = rows.join(sizes, (F.col("label") == F.col("l")) & (F.col("shard") == F.col("s")))
    home = F.pmod(F.xxhash64("rep"), F.col("parts"))
    return rows.select("rep", "label", "embedding", "many", "shards", "shard", "parts", home.alias("home"))


def _adjacency(rows: DataFrame) -> DataFrame:
    """(rep, near): united adjacency lists of all shards."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rep = pdf["rep"].to_numpy()
        graph = build_graph(_unit(pdf).astype("f4"))
        return pd.DataFrame({"rep": rep, "near": [rep[g] for g in graph]})

    lists = rows.groupBy("label", "shard", "home").applyInPandas(run, "rep long, near array<long>")
    return lists.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))  # overlap lists at most


def _all_rows(reps: DataFrame) -> DataFrame:
    """Rows for the exact way: one per vector, the whole label as one shard in parts, so that two parts meet no matter
    how many shards there were."""
    sizes = reps.groupBy(F.col("label").alias("l")).agg(F.ceil(F.count("*") / (2 * SHARD)).alias("parts"))
    rows = reps.join(sizes, F.col("label") == F.col("l")).withColumn("home", F.pmod(F.xxhash64("rep"), F.col("parts")))
    return rows.select("rep", "label", "embedding", "many", F.array(F.lit(0)).alias("shards"), F.lit(0).alias("shard"), "parts", "home")


def _range_search(rows: DataFrame, adjacency: DataFrame | None, least: float) -> DataFrame:
    """(rep, n, u, v): per vector and shard part the copies linked with it, and an edge towards a linked vector that
    keeps the component. A pair counts in the first shard that both are in. A task has the vectors of two parts at
    most: those that search and those of the graph, or without adjacency those that they are compared with one by one."""
    exact = adjacency is None
    graph = rows.withColumn("near", F.array().cast("array<long>")) if exact else rows.join(adjacency.withColumnRenamed("rep", "r"), F.col("rep") == F.col("r")).drop("r")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    searching = graph.withColumn("part", other).withColumn("chunk", F.col("home"))
    searched = graph.withColumn("chunk", other).withColumn("part", F.col("home")).where("chunk <> part")
    parts = searching.unionByName(searched)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        shard = int(pdf["shard"].iloc[0])
        here = np.flatnonzero(pdf["home"].to_numpy() == pdf["part"].to_numpy())
        asks = np.flatnonzero(pdf["home"].to_numpy() == pdf["chunk"].to_numpy())
        if not len(here) or not len(asks):
            return pd.DataFrame({"rep": [], "n": [], "u": [], "v": []})
        rep, many = pdf["rep"].to_numpy(), pdf["many"].to_numpy()
        x = _unit(pdf)
        v = x[here]
        if not exact:
            at = {r: i for i, r in enumerate(rep[here])}
            lists = [np.array([at[r] for r in near if r in at], "i4") for near in pdf["near"].iloc[here]]
            v4 = v.astype("f4")
            start = medoids(v4)
        home = pdf["home"].to_numpy() == pdf["part"].to_numpy()
        n_rows, codes = len(rep), [np.zeros(0, "i8")]
        step = max(1, 8_000_000 // len(here))
        for a in range(0, len(asks), step):
            some = asks[a : a + step]
            if exact:
                hits = [np.flatnonzero(near) for near in x[some] @ v.T >= least - 1e-4]
            else:
                hits = search(x[some].astype("f4"), v4, lists, start, BEAM, least - 1e-4)[0]
            for q, h in zip(some, hits, strict=True):
                h = h[v[h] @ x[q] >= least]  # in double precision
                codes.append(q * n_rows + here[h[here[h] != q]])
        code = np.concatenate(codes)
        a, b = code // n_rows, code % n_rows
        both = home[a] & home[b]  # a link met from one end holds from the other
        a, b = np.divmod(np.union1d(code, b[both] * n_rows + a[both]), n_rows)
        shards = np.stack([np.resize(s, max(map(len, pdf["shards"]))) for s in pdf["shards"]])
        first = np.zeros(len(a), bool)
        for at in range(0, len(a), 200_000):
            sa, sb = shards[a[at : at + 200_000]], shards[b[at : at + 200_000]]
            common = np.where((sa[:, :, None] == sb[:, None, :]).any(2), sa, 1 << 30)
            first[at : at + 200_000] = common.min(1) == shard
        n = np.bincount(a[first], weights=many[b[first]], minlength=n_rows).astype("i8")
        label = np.arange(n_rows)
        while True:  # least row number of each component in this part
            new = label.copy()
            np.minimum.at(new, a, label[b])
            np.minimum.at(new, b, label[a])
            new = new[new]
            if (new == label).all():
                break
            label = new
        on = (n > 0) | (label != np.arange(n_rows))
        return pd.DataFrame({"rep": rep[on], "n": n[on], "u": rep[on], "v": rep[label[on]]})

    return parts.groupBy("label", "shard", "chunk", "part").applyInPandas(run, "rep long, n long, u long, v long")


def brute_force(reps: DataFrame, queries: list, least: float) -> DataFrame:
    """(rep, truth): copies linked with each of a bounded list of queries, by comparing it with every vector."""
    held = reps.sparkSession.sparkContext.broadcast(queries)

    def run(batches):
        by: dict[str, list] = {}
        for r in held.value:
            by.setdefault(r["label"], []).append(r)
        for pdf in batches:
            for label, part in pdf.groupby("label", sort=False):
                if own := by.get(label):
                    q = np.array([r["embedding"] for r in own], "f8")
                    near = _unit(pd.DataFrame({"embedding": list(q)})) @ _unit(part).T >= least
                    near &= np.array([r["rep"] for r in own])[:, None] != part["rep"].to_numpy()[None, :]
                    yield pd.DataFrame({"rep": [r["rep"] for r in own], "truth": near @ part["many"].to_numpy()})

    return reps.mapInPandas(run, "rep long, truth long").groupBy("rep").agg(F.sum("truth").alias("truth"))


def _centroids(reps: DataFrame) -> dict[str, np.ndarray]:
    """Centroids of each label, fitted on a bounded sample; so many that a shard has about SHARD vectors."""
    sample = reps.orderBy("rep").limit(SAMPLE).select("label", "embedding").toPandas()
    if not len(sample):
        return {}
    labels = reps.sparkSession.createDataFrame([(x,) for x in sample["label"].unique().tolist()], "label string")
    size = {r["label"]: r["n"] for r in reps.groupBy("label").agg(F.count("*").alias("n")).join(F.broadcast(labels), "label").collect()}
    out = {}
    for label, part in sample.groupby("label"):
        k = max(1, min(-(-size[label] * OVERLAP // SHARD), len(part) // 4))
        out[label] = kmeans(_unit(part), k)
    return out


def near_duplicates(vectors: DataFrame, least: float = 0.93, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding") -> DataFrame:
    """One row per row of vectors: vec_id, n_links, component_id, kept, and recall, the audited recall of the search.

    Vectors link when their labels are equal and not null and their cosine is at least `least`. A vector that is null,
    empty, zero, or has null or non-finite components, or whose label is null, links with nothing. Equal vectors of a
    label are searched once and count with their number; repeated rows are vectors of their own. component_id is the
    smallest id reachable by links; a null id is never the smallest. Vectors of different lengths don't link. Other
    columns are not read. recall is null where no audited vector has a link.
    """
    spark = vectors.sparkSession
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vec_col).cast("array<double>").alias("embedding"))
    v = v.withColumn("label", F.concat("label", F.lit(" "), F.size("embedding").cast("string")))
    v = v.withColumn("rep", F.when(_valid(F.col("embedding"), F.col("label")), F.xxhash64("label", "embedding")))
    reps = materialize(v.where("rep is not null").groupBy("label", "embedding", "rep").agg(F.count("*").alias("many"), F.min("vec_id").alias("least")))
    table = _centroids(reps)
    widest = max([1, *map(len, table.values())])
    queries = reps.orderBy(F.xxhash64("rep")).limit(AUDIT).select("rep", "label", "embedding").collect()
    truth = materialize(brute_force(reps, queries, least))
    centroids, overlap = spark.sparkContext.broadcast(table), min(OVERLAP, widest)
    while True:
        rows = materialize(_shard_rows(_assign(reps.select("rep", "label", "embedding", "many"), centroids, overlap)))
        adjacency = materialize(_adjacency(rows))
        found = materialize(_range_search(rows, adjacency, least))
        counted = found.groupBy("rep").agg(F.sum("n").alias("n"))
        recall = truth.where("truth > 0").join(counted, "rep", "left").agg(F.avg(F.coalesce("n", F.lit(0)) / F.col("truth"))).first()[0]
        if recall is None or recall >= TARGET:
            break
        for df in (rows, adjacency, found):
            release(df)
        if overlap * 4 > widest:  # with half of all shards each, the graphs would cost what all products cost
            found = materialize(_range_search(_all_rows(reps), None, least))
            counted, recall = found.groupBy("rep").agg(F.sum("n").alias("n")), 1.0
            break
        overlap *= 2
    roots = connected_components(found.select("u", "v")).select(F.col("node").alias("rep"), F.col("component").alias("root"))
    classes = reps.select("rep", "many", "least").join(roots, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    smallest = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = classes.join(smallest, "root").join(counted, "rep", "left")
    classes = bounded_broadcast(materialize(classes.select(F.col("rep").alias("r"), (F.coalesce("n", F.lit(0)) + F.col("many") - 1).alias("n_links"), "component_id")), 100_000)
    return v.join(classes, F.col("rep") == F.col("r"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"), F.lit(recall).cast("double").alias("recall"),
    )
