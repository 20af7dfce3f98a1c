"""N-gram Jaccard join by a blocked sparse matrix product.

Texts with equal sets of n-grams are one row of the incidence matrix. Its columns are ordered from rare to frequent by a
sketch of counts; the size of a set bounds how many of its n-grams a linked set may lack, so if the first n-grams of each
set are some more than that, linked sets have as many in common among them. Sets that do are candidates. The candidate
groups are cut into blocks of rows, and each block multiplies its incidence matrix with itself, a stretch of columns at a
time, adding up overlap counts and discarding pairs that can no longer reach the bound given by their sizes. A block
returns a spanning forest of its links, not its pairs. Groups of many blocks share pivots; after that only blocks with rows
of different components are laid against each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameyard.llm.common import bounded_broadcast, connected_components, give_back, materialize
from frameyard.llm.shingles import mix, shingle_set

#: Rows of a block, n-grams of a block, pivots that the blocks of a group share, columns multiplied at a time.
BLOCK_ROWS, BLOCK_GRAMS, PIVOTS, COLUMNS = 512, 600_000, 32, 4096
#: Cells of the sketch (a power of two; about 2 MB to each worker), and the least count of a frequent cell.
CELLS, FREQUENT = 1 << 21, 16
#: Of so many n-grams of a set one more is among the first; so linked sets have about as many first ones in common.
SPARE = 10
#: First n-grams that a worker hands on at a time, and sets that it remembers.
EMIT, REMEMBER = 200_000, 500_000
#: Up to so many rows under an n-gram are paired; pairs are counted over the other n-grams too where this joins at most so
#: many times the rows that there are.
FEW, COUNTED = 8, 2
#: Up to so many blocks of a candidate group are laid against each other as they are.
APART = 16
#: The room of a block, in units of which each set takes some.
ROOM = 1 << 30


def _cells(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(65 - CELLS.bit_length())).astype("i8")


def _profile(docs: DataFrame, n_gram: int) -> DataFrame:
    """(doc_id, t, k, n, cell): a digest of each text, one of its set, and the set's size; besides, where cell is not null,
    k counts n-grams in a cell of the sketch. A task tells only the cells that stand out among its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "t", "k", "n", "cell"]
        counts = np.zeros(CELLS, "i4")
        for batch in batches:
            sets = [shingle_set(t.as_py(), n_gram) for t in batch.column(1)]
            k = [xxhash.xxh3_64_intdigest(h.tobytes()) - (1 << 63) for h in sets]
            for h in sets:
                np.add.at(counts, _cells(h), 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(k, pa.int64()), pa.array([len(h) for h in sets], pa.int32()), pa.nulls(len(k), pa.int32())], names=names
            )
        mean = counts.mean()
        top = np.flatnonzero(counts > mean + 2 * mean**0.5 + 1)
        for at in range(0, len(top), EMIT):
            cell = top[at : at + EMIT]
            none = pa.nulls(len(cell), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, pa.array(counts[cell].astype("i8")), pa.nulls(len(cell), pa.int32()), pa.array(cell.astype("i4"))], names=names)
        give_back()

    return docs.mapInArrow(run, "doc_id long, t long, k long, n int, cell int")


def _levels(profile: DataFrame) -> np.ndarray:
    """For each cell of the sketch how frequent its n-grams are, in half powers of two; 0 if not frequent. At most CELLS
    rows come to the driver. Any levels give the right links; good ones keep frequent passages from making candidates."""
    told = profile.where("cell IS NOT NULL").groupBy("cell").agg(F.sum("k").alias("c")).where(F.col("c") >= FREQUENT).toPandas()
    levels = np.zeros(CELLS, "u1")
    levels[told["cell"].to_numpy("i8")] = 2 * np.log2(told["c"].to_numpy("f8"))
    return levels


def first_grams(h: np.ndarray, levels: np.ndarray, percent: int) -> np.ndarray:
    """The first n-grams of a set, from rare to frequent: as many as a linked set may lack, and one in SPARE more. The
    least of what two linked sets have in common, as many as the smaller spare, are among the first ones of both."""
    lack = len(h) - -(-percent * len(h) // 100)
    return h[np.argsort(levels[_cells(h)], kind="stable")[: lack + max(1, len(h) // SPARE)]]


def _need(percent: int) -> Column:
    """How many first n-grams a set of n has in common with any linked set, which has n * percent / 100 at least."""
    return F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * percent / 100) / SPARE)).cast("int")


def _meeting(firsts: DataFrame) -> DataFrame:
    """The rows (h, k) of n-grams that different sets have, with v, the least of these; the window spills, and an n-gram's
    rows need not fit into memory."""
    under = Window.partitionBy("h")
    kept = [c for c in firsts.columns if c not in ("v", "m")]
    return firsts.select(*kept, F.min("k").over(under).alias("v"), F.max("k").over(under).alias("w"), F.count("*").over(under).alias("m")).where("v <> w").drop("w")


def _enough(under: DataFrame) -> DataFrame:
    """The rows (k, need, ...) of sets that have as many rows here as linked sets have first n-grams in common."""
    return under.withColumn("own", F.count("*").over(Window.partitionBy("k"))).where("own >= need").drop("own")


def _shared(firsts: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(h, k, need, v, m): of the first n-grams those that m different sets have, v the least of them; only of sets that
    have enough of these. What other sets fall short of may leave more sets short, so this is done twice."""
    sizes = sets.select(F.col("k").alias("sk"), _need(percent).alias("need"))
    shared = _meeting(firsts).select("h", "k").distinct()
    shared = materialize(_enough(shared.join(sizes, F.col("k") == F.col("sk")).drop("sk")))
    shared = materialize(_enough(_meeting(shared)).select("h", "k", "need"))
    return materialize(_meeting(shared))


def _firsts(docs: DataFrame, n_gram: int, percent: int, levels: np.ndarray) -> DataFrame:
    """(h, k): the first n-grams of each text's set; a task hands them on once for a set that it meets again, as long as
    it remembers it, so that copies of a set don't pile up under their n-grams."""
    held = docs.sparkSession.sparkContext.broadcast(levels)

    def out(hs: list[np.ndarray], ks: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(hs).view("i8")), pa.array(np.concatenate(ks))], names=["h", "k"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            hs, ks, n = [np.zeros(0, "u8")], [np.zeros(0, "i8")], 0
            for t in batch.column(1):
                h = shingle_set(t.as_py(), n_gram)
                k = xxhash.xxh3_64_intdigest(h.tobytes()) - (1 << 63)
                if len(h) and k not in seen:
                    seen.add(k)
                    hs.append(first_grams(h, held.value, percent))
                    ks.append(np.full(len(hs[-1]), k, "i8"))
                    n += len(hs[-1])
                if len(seen) > REMEMBER:
                    seen.clear()
                if n > EMIT:
                    yield out(hs, ks)
                    hs, ks, n = [np.zeros(0, "u8")], [np.zeros(0, "i8")], 0
            yield out(hs, ks)
        give_back()

    return docs.mapInArrow(run, "h long, k long")


def block_links(sets: list[np.ndarray], left: np.ndarray | None, percent: int) -> np.ndarray:
    """Component label (smallest index) of each row under the links of a block. left, if given, parts the rows in two:
    only pairs across are compared."""
    m = len(sets)
    size = np.array([len(s) for s in sets], "i8")
    total = size[:, None] + size[None, :]
    bound = -(-percent * total // (100 + percent))  # least overlap of a link
    alive = np.minimum(size[:, None], size[None, :]) >= bound
    np.fill_diagonal(alive, False)
    if left is not None:
        alive &= left[:, None] != left[None, :]
    if not alive.any():
        return np.arange(m)
    row = np.repeat(np.arange(m), size)
    grams, column, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = df > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = row[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    rest = np.bincount(row, minlength=m).astype("i8")  # shared n-grams of each row not yet multiplied
    overlap = np.zeros((m, m), "f4" if m * int(size.max(initial=0)) < 1 << 24 else "f8")
    alive &= np.minimum(rest[:, None], rest[None, :]) >= bound  # rows of a block may share no column at all
    n_columns = int(shared.sum())
    width = max(64, min(COLUMNS, (1 << 22) // m))
    for at in range(0, n_columns, width):
        a, b = np.searchsorted(column, [at, at + width])
        part = np.zeros((m, min(width, n_columns - at)), "f4")
        part[row[a:b], column[a:b] - at] = 1
        overlap += part @ part.T
        rest -= np.bincount(row[a:b], minlength=m)
        alive &= overlap + np.minimum(rest[:, None], rest[None, :]) >= bound
        if not alive.any():
            return np.arange(m)
    label = np.arange(m)
    while True:
        new = np.minimum(label, np.where(alive, label[None, :], m).min(axis=1))
        if (new == label).all():
            return label
        label = new


def _multiply(rows: DataFrame, keys: list[str], n_gram: int, percent: int, sided: bool) -> DataFrame:
    """Spanning forests (u, v) of the links in each block; rows: keys, k, text, and side if sided."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        # texts came by id; of an id with several texts only the one whose digest is k stands for k
        by = {}
        for i, (k, t) in enumerate(zip(pdf["k"].tolist(), pdf["text"], strict=True)):
            if k not in by and xxhash.xxh3_64_intdigest((h := shingle_set(t, n_gram)).tobytes()) - (1 << 63) == k:
                by[k] = i, h
        k = np.array(list(by), "i8")
        rows = [i for i, _ in by.values()]
        label = block_links([h for _, h in by.values()], pdf["side"].to_numpy()[rows] if sided else None, percent) if rows else np.arange(0)
        on = label != np.arange(len(k))
        return pd.DataFrame({"u": k[on], "v": k[label[on]]})

    return rows.groupBy(*keys).applyInPandas(run, "u long, v long")


def _rarest(rows: DataFrame) -> DataFrame:
    """Of the rows (h, k, need, m, ...) of each set those with the least m, all but need - 1. Two sets that have at least as
    many n-grams in common as either needs still share the rarest of these: the others come after it in both."""
    own, place = Window.partitionBy("k"), Window.partitionBy("k").orderBy("m", "h")
    return rows.withColumn("own", F.count("*").over(own)).withColumn("place", F.row_number().over(place)).where("place <= own - need + 1").drop("own", "place")


def _candidates(shared: DataFrame) -> DataFrame:
    """Edges (u, v) between sets that may link, or are bound to share a group: the pairs that meet as often as linked sets
    do, counted under n-grams of few rows and then, for those that may still come to it, under the others; and, for pairs
    that meet under the others only, each row and the least under the rarest of these that a set has."""
    few, many = shared.where(F.col("m") <= FEW), shared.where(F.col("m") > FEW)
    a, b = (few.select("h", F.col("k").alias(k), F.col("need").alias(f"need_{k}")) for k in "uv")
    pairs = a.join(b, "h").where("u > v").groupBy("u", "v").agg(F.count("*").alias("met"), F.max(F.greatest("need_u", "need_v")).alias("need"))
    pairs = materialize(pairs)
    held = materialize(many.groupBy("k").agg(F.count("*").alias("many")))
    open_ = pairs.where("met < need")
    for k in "uv":
        open_ = open_.join(held.select(F.col("k").alias(k), F.col("many").alias(f"many_{k}")), k)
    open_ = materialize(open_.where("met + least(many_u, many_v) >= need").select("u", "v", "met", "need", "many_u"))
    if (open_.agg(F.sum("many_u")).first()[0] or 0) <= COUNTED * shared.count():
        under = open_.join(many.select("h", F.col("k").alias("u")), "u").join(many.select("h", F.col("k").alias("v")), ["h", "v"])
        open_ = under.groupBy("u", "v", "met", "need").agg(F.count("*").alias("more")).where("met + more >= need")
    tied = _rarest(many).select("k", F.min("k").over(Window.partitionBy("h")).alias("v")).where("k <> v")
    return pairs.where("met >= need").select("u", "v").unionByName(open_.select("u", "v")).unionByName(tied.select(F.col("k").alias("u"), "v"))


def _restless(big: DataFrame, shared: DataFrame) -> DataFrame:
    """The rows of big that may link with a row of another label: those with enough first n-grams that rows of different
    labels have."""
    under = shared.join(big.select(F.col("k").alias("bk"), "label"), F.col("k") == F.col("bk"))
    each = Window.partitionBy("h")
    under = under.select("k", "need", F.min("label").over(each).alias("lo"), F.max("label").over(each).alias("hi")).where("lo <> hi")
    return big.join(_enough(under).select("k").distinct(), "k", "left_semi")


def _narrowed(big: DataFrame, shared: DataFrame) -> DataFrame:
    """big, rows (comp, k, n, at, label) of candidate groups of more than APART blocks, with the groups that were brought
    together by chains of n-grams taken apart again: into the rows under each n-gram, where that makes fewer pairs.
    N-grams under which all rows are of one label go, then all but the rarest of each set; of n-grams with the same rows one
    stays."""
    under = shared.select("h", "k", "need", "m").join(big.select(F.col("k").alias("bk"), "comp", "label"), F.col("k") == F.col("bk")).drop("bk")
    each = Window.partitionBy("comp", "h")
    under = under.withColumn("lo", F.min("label").over(each)).withColumn("hi", F.max("label").over(each)).where("lo <> hi")
    under = materialize(_rarest(under).select("h", "k", "comp", "label"))
    mark = F.xxhash64("k")
    groups = under.groupBy("comp", "h").agg(F.count("*").alias("m"), F.sum(mark % (1 << 31)).alias("s"), F.bit_xor(mark).alias("x"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    groups = materialize(groups.where("lo <> hi").groupBy("comp", "m", "s", "x").agg(F.min("h").alias("g")))
    cost = groups.groupBy("comp").agg(F.sum(F.col("m").cast("double") * F.col("m")).alias("apart"))
    whole = big.groupBy("comp").agg((F.count("*").cast("double") * F.count("*")).alias("whole"))
    choice = materialize(whole.join(cost, "comp", "left").select(F.col("comp").alias("c"), (F.coalesce("apart", F.lit(0.0)) < F.col("whole")).alias("take_apart")))
    chosen = big.join(bounded_broadcast(choice), F.col("comp") == F.col("c")).drop("c")
    parts = groups.join(bounded_broadcast(choice), F.col("comp") == F.col("c")).where("take_apart").select(F.col("comp").alias("pc"), "g")
    rows = under.select("k", "h", F.col("comp").alias("uc")).join(parts, (F.col("uc") == F.col("pc")) & (F.col("h") == F.col("g"))).select(F.col("k").alias("rk"), "g")
    apart = chosen.where("take_apart").join(rows, F.col("k") == F.col("rk")).select(F.col("g").alias("comp"), "k", "n", "at", "label")
    return chosen.where("not take_apart").select("comp", "k", "n", "at", "label").unionByName(apart)


def _room(rows: int, grams: int) -> Column:
    """What a set of n n-grams takes of the room of a block of so many rows and n-grams."""
    return F.greatest(F.lit(ROOM // rows).cast("long"), F.ceil(F.col("n") * (ROOM / grams)).cast("long"))


def _by_size(sets: DataFrame, keys: list[str], rows: int, grams: int) -> DataFrame:
    """sets (k, n, keys) with part, a block of their group: blocks follow each other by the size of sets, so that most
    blocks of a group are too far apart in size for a link. Places come from a histogram of sizes; no group is sorted."""
    bin_ = F.floor(F.log(F.col("n").cast("double")) * 20).cast("int")
    bins = sets.groupBy(*keys, bin_.alias("bin")).agg(F.sum(_room(rows, grams)).alias("wide"))
    before = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("start", F.coalesce(F.sum("wide").over(before), F.lit(0)))
    bins = bins.select(*(F.col(c).alias(f"_{c}") for c in keys), F.col("bin").alias("_bin"), "wide", "start")
    same = bin_ == F.col("_bin")
    for c in keys:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    place = F.col("start") + F.pmod(F.xxhash64("k", F.lit(2)), F.col("wide"))
    found = sets.join(bounded_broadcast(materialize(bins)), same)
    return found.select(*sets.columns, F.floor(place / ROOM).cast("long").alias("part"))


def _links(members: DataFrame, texts: DataFrame, shared: DataFrame, n_gram: int, percent: int) -> DataFrame:
    """All forests of links. members: (k, n, at, comp), materialized, one row per set in a candidate
    group; at: the (doc_id, t) of one of its texts. shared: (h, k, need, m), the first n-grams that different sets have."""
    groups = members.groupBy("comp").agg(F.count("*").alias("m"), F.ceil(F.sum(_room(BLOCK_ROWS, BLOCK_GRAMS)) / ROOM).alias("blocks"))
    placed = members.join(groups, "comp")
    many = F.col("blocks") > 1
    placed = materialize(placed.where(~many).withColumn("part", F.lit(0).cast("long")).unionByName(_by_size(placed.where(many), ["comp"], BLOCK_ROWS, BLOCK_GRAMS)))
    own = F.col("part")
    pivot = many & (F.pmod(F.xxhash64("k", F.lit(1)), F.ceil(F.col("m") / PIVOTS)) == 0)
    homes = F.when(pivot, F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array(own))
    dealt = placed.select("comp", "k", "at", F.explode(homes).alias("block"))

    def with_text(rows: DataFrame) -> DataFrame:
        held = bounded_broadcast(materialize(rows))
        return texts.join(held, F.col("doc_id").eqNullSafe(F.col("at.doc_id")) & (F.col("t") == F.col("at.t")))

    first = materialize(_multiply(with_text(dealt), ["comp", "block"], n_gram, percent, sided=False))
    big = placed.where(many)
    if not big.limit(1).count():
        return first
    # groups of many blocks: what is one component already needs no more products
    labels = connected_components(first)
    big = materialize(big.join(labels.select(F.col("node").alias("k"), "component"), "k", "left").withColumn("label", F.coalesce("component", "k")))
    named = ["comp", "k", "n", "at", "label"]
    big = materialize(_restless(big, shared).select(*named, "blocks"))
    mixed = big.groupBy("comp").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("comp")
    big = materialize(big.join(mixed, "comp").select(*named, "blocks"))
    wide = big.where(F.col("blocks") > APART).select(*named)
    if wide.limit(1).count():
        big = materialize(big.where(F.col("blocks") <= APART).select(*named).unionByName(_narrowed(wide, shared)))
    sizes = big.groupBy("comp", "label").agg(F.count("*").alias("size"), F.sum("n").alias("label_grams"))
    # a component with many rows has blocks of its own; the others of a group share blocks
    sizes = sizes.withColumn("mine", F.when((F.col("size") >= BLOCK_ROWS // 4) | (F.col("label_grams") >= BLOCK_GRAMS // 4), F.col("label")))
    owned = materialize(big.join(sizes.select("comp", "label", "mine"), ["comp", "label"]).select("comp", "k", "n", "at", "mine"))
    spread = materialize(_by_size(owned, ["comp", "mine"], BLOCK_ROWS // 2, BLOCK_GRAMS // 2))
    blocks = spread.groupBy("comp", "mine", "part").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    blocks = materialize(blocks.withColumn("id", F.xxhash64("mine", "part")))
    a, b = (blocks.select("comp", *(F.col(c).alias(f"{c}_{s}") for c in ("mine", "part", "lo", "hi", "id"))) for s in "ab")
    pairs = a.join(b, "comp").where(
        (F.col("id_a") <= F.col("id_b"))
        & ~(F.col("mine_a").eqNullSafe(F.col("mine_b")) & F.col("mine_a").isNotNull())
        & (F.col("hi_a") * 100 >= F.col("lo_b") * percent) & (F.col("hi_b") * 100 >= F.col("lo_a") * percent)
    )
    sides = pairs.select("comp", "id_a", "id_b", F.explode(F.when(F.col("id_a") == F.col("id_b"), F.array("id_a")).otherwise(F.array("id_a", "id_b"))).alias("id"))
    rows = spread.withColumn("id", F.xxhash64("mine", "part")).join(sides, ["comp", "id"]).select("comp", "id_a", "id_b", "k", "at", F.col("id").alias("side"))
    alone = F.col("id_a") == F.col("id_b")
    rows = with_text(rows)
    across = _multiply(rows.where(~alone), ["comp", "id_a", "id_b"], n_gram, percent, sided=True)
    within = _multiply(rows.where(alone), ["comp", "id_a"], n_gram, percent, sided=False)
    return first.unionByName(materialize(across)).unionByName(materialize(within))


def jaccard_join(docs: DataFrame, n_gram: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id.

    Two texts link when 100 * common >= percent * all n-grams of both. component_id is the smallest doc_id reachable
    by links. Texts without words (null, empty, blank) have no n-grams and link with nothing; a text of fewer than
    n_gram words has one, its whole sequence. Repeated rows are in one component; a null doc_id takes part and is
    never the smallest; alone it has a null component. Other columns are not read. No rows: no rows.
    """
    text = F.col(text_col).cast("binary")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("t"))
    profile = materialize(_profile(texts, n_gram))
    rows = profile.where("cell IS NULL").drop("cell")
    sets = rows.where("n > 0").groupBy("k", "n").agg(F.min("doc_id").alias("doc_id"), F.min(F.struct("doc_id", "t")).alias("at"))
    shared = _shared(_firsts(texts, n_gram, percent, _levels(profile)), sets, percent)
    groups = connected_components(_candidates(shared))
    members = materialize(sets.join(groups.select(F.col("node").alias("k"), F.col("component").alias("comp")), "k"))
    links = _links(members, texts, shared, n_gram, percent)
    roots = connected_components(links)
    classes = sets.join(roots.select(F.col("node").alias("k"), F.col("component").alias("root")), "k", "left").withColumn("root", F.coalesce("root", "k"))
    classes = materialize(classes)
    least = classes.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = bounded_broadcast(materialize(classes.join(least, "root").select(F.col("k").alias("k2"), F.col("n").alias("n2"), "component_id")), 100_000)
    return rows.join(named, (F.col("k") == F.col("k2")) & (F.col("n") == F.col("n2")), "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
