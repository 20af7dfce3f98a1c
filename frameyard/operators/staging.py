"""Staging of candidates: first-wins over two keys at once, and the whole decision chain of a staging run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameyard.functions.durable import materialize, release
from frameyard.operators.candidates import with_rank
from frameyard.operators.select import limit_with_rejects, with_flag


def _least(open_: DataFrame, key: str) -> DataFrame:
    """The least rank that holds each value of a key; combined before the shuffle, so a hot value is one row a task."""
    return open_.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("rank").alias(f"_first_{key}"))


def select_by_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """D1 with several keys: (rank, keys) of the rows that are selected when rows are walked by rank and one is taken
    unless it shares a key with one taken before.

    Claim rounds: every open row claims its keys, the least rank gets each; who gets all of them is selected, for all
    rows before it that share one are decided; rows that share a key with a selected row are out. Each round decides
    the least open row at any rate, so that the rounds end, and most rows in the first. A value that a million rows
    share costs one claim, not pairs of rows. Ranks are unique; a null key blocks nothing and is not blocked.
    """
    # of rows that agree in all keys only the first can ever be taken
    same = rows.groupBy(*keys).agg(F.min("rank").alias("rank"))
    lone = F.lit(True)
    for k in keys:
        lone = lone & F.col(k).isNull()
    free = rows.where(lone).select("rank", *keys)
    open_ = materialize(same.where(~lone))
    taken = [materialize(free)]
    while open_.limit(1).count():
        claims = open_
        holds = F.lit(True)
        for k in keys:
            claims = claims.join(_least(open_, k), k, "left")
            holds = holds & (F.col(k).isNull() | (F.col(f"_first_{k}") == F.col("rank")))
        won = materialize(claims.where(holds).select("rank", *keys))
        rest = open_
        for k in keys:
            rest = rest.join(won.where(F.col(k).isNotNull()).select(F.col(k).alias("_won")), F.col(k) == F.col("_won"), "left_anti")
        rest = materialize(rest.join(won.select("rank"), "rank", "left_anti"))
        release(open_)
        open_ = rest
        taken.append(won)
    out = taken[0]
    for t in taken[1:]:
        out = out.unionByName(t)
    return out


def dedupe_by_keys(df: DataFrame, keys: list[str], order: list[str], eligible: Column | None = None) -> DataFrame:
    """D1 with several keys, e.g. content hash and lower-cased stem: adds rank, selected, and for each key dup_<key>:
    whether a selected earlier row has its value. Rows that are not eligible are never selected and block none."""
    ranked = materialize(with_rank(df, order).withColumn("_ok", F.coalesce(eligible, F.lit(False)) if eligible is not None else F.lit(True)))
    taken = materialize(select_by_keys(ranked.where("_ok").select("rank", *keys), keys))
    out = ranked.join(taken.select("rank", F.lit(True).alias("_taken")), "rank", "left")
    for k in keys:  # a value has one selected row
        holder = taken.where(F.col(k).isNotNull()).select(F.col(k).alias("_value"), F.col("rank").alias("_holder"))
        out = out.join(holder, F.col(k) == F.col("_value"), "left").withColumn(f"dup_{k}", F.coalesce(F.col("_holder") < F.col("rank"), F.lit(False))).drop("_value", "_holder")
    return out.withColumn("selected", F.coalesce("_taken", F.lit(False))).drop("_taken", "_ok")


def stage_candidates(
    candidates: DataFrame, order: list[str], exceptions: DataFrame, rejects: DataFrame, labelled: DataFrame, prefix: str, words: list[str],
    least_edge: int, limit: int | None = None,
) -> DataFrame:
    """The decision of a staging run over candidates (stem, path, sha, width, height, has_file), in order: status
    and reason of every row up to the limit-th selected one. exceptions, rejects and labelled have a stem column; stems
    are compared without case. A row is a duplicate if a row selected before it has its stem or content; rows that fail
    for any other reason, a too small image included, block none. Sizes that are unknown are an unusable image."""
    df = with_flag(candidates, exceptions, "_exception", ignore_case=True)
    df = with_flag(df, rejects, "_reject", ignore_case=True)
    df = with_flag(df, labelled, "_labelled", ignore_case=True).withColumn("stem_key", F.lower("stem"))
    before = (
        F.when(F.col("_exception"), "scrape_exception_stem").when(~F.col("stem").startswith(prefix), "wrong_source_prefix")
        .when(F.col("_reject"), "known_rejected_non_side").when(F.col("_labelled"), "already_labeled")
        .when(F.lower(F.concat_ws(" ", "stem", "path")).rlike("|".join(words)), "non_side_keyword")
    )
    behind = (
        F.when(F.coalesce("width", F.lit(-1)) < 0, "unusable_image")
        .when(F.greatest("width", "height") < least_edge, F.concat(F.lit("too_small:"), F.col("width").cast("string"), F.lit("x"), F.col("height").cast("string")))
        .when(~F.coalesce("has_file", F.lit(False)), "missing_source_file")
    )
    df = df.withColumn("_before", before).withColumn("_behind", behind)
    out = dedupe_by_keys(df, ["stem_key", "sha"], order, F.col("_before").isNull() & F.col("_behind").isNull())
    reason = F.coalesce("_before", F.when(F.col("dup_stem_key"), "duplicate_stem").when(F.col("dup_sha"), "duplicate_content_hash"), "_behind", F.lit("selected"))
    out = out.withColumn("reason", reason).withColumn("status", F.when(F.col("selected"), "selected").otherwise("rejected"))
    out = out.drop("_exception", "_reject", "_labelled", "_before", "_behind", "dup_stem_key", "dup_sha", "stem_key", "selected")
    if limit is None:
        return out
    return limit_with_rejects(out, F.col("status") == "selected", ["rank"], limit)
