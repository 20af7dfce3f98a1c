"""The whole gate cascade with costly scorers, each run on rows that are still open only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from frameyard.operators.scoring import score_images


@dataclass
class Scorer:
    """A model that adds the columns of schema, and the gates (outcome, reason column) that read them."""

    name: str
    make: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]
    schema: str
    gates: list[tuple[str, Column]] = field(default_factory=list)


def _close(df: DataFrame, gates: list[tuple[str, Column]], heavy: list[str]) -> DataFrame:
    """Give open rows the outcome of the first gate with a reason; closed rows let go of their heavy columns."""
    if not gates:
        return df
    first = F.coalesce(*(F.when(reason.isNotNull(), F.struct(F.lit(name).alias("outcome"), reason.alias("reason"))) for name, reason in gates))
    df = df.withColumn("_found", F.when(F.col("outcome").isNull(), first))
    df = df.withColumn("outcome", F.coalesce("outcome", "_found.outcome")).withColumn("reason_detail", F.coalesce("reason_detail", F.nullif("_found.reason", F.lit("")))).drop("_found")
    for c in heavy:
        df = df.withColumn(c, F.when(F.col("outcome").isNull(), F.col(c)))
    return df


def score_cascade(df: DataFrame, cheap: list[tuple[str, Column]], scorers: list[Scorer], heavy: list[str] | None = None) -> tuple[DataFrame, dict[str, Observation]]:
    """Rows with outcome and reason_detail of the first gate that rejects them, null where none does.

    The cheap gates are column expressions. Then each scorer runs over the rows that are open when its turn comes, and
    its gates close some of them; an empty reason closes without detail. Closed rows pass by without their heavy columns (image bytes), so that they cost next
    to nothing. The observations tell, once the result has been computed, how many rows each scorer was given (open) and
    how many passed by (closed).
    """
    heavy = heavy or []
    out = _close(df.withColumn("outcome", F.lit(None).cast("string")).withColumn("reason_detail", F.lit(None).cast("string")), cheap, heavy)
    seen = {}
    for s in scorers:
        seen[s.name] = Observation(s.name)
        out = out.observe(seen[s.name], F.count_if(F.col("outcome").isNull()).alias("open"), F.count_if(F.col("outcome").isNotNull()).alias("closed"))
        out = _close(score_images(out, s.make, s.schema), s.gates, heavy)
    return out, seen


def settle(gated: DataFrame, decided: DataFrame) -> DataFrame:
    """Outcomes of the whole run: gated has rank, outcome and reason_detail of the gates, decided rank and the outcome of
    the ordered selection behind them (dedup.continue_run, for which a gate's outcome is the reason to bar a row). A url
    that was seen before counts before the gates, as it is looked up first; rows behind the end were not looked at."""
    behind = decided.select(F.col("rank").alias("_rank"), F.col("outcome").alias("_outcome"))
    both = gated.join(behind, F.col("rank") == F.col("_rank"))
    o = F.col("_outcome")
    outcome = F.when(o == "url_seen", "rejected_dedup_clip").when(o == "rejected_heuristic", F.col("outcome")).otherwise(o)
    detail = (
        F.when(o == "url_seen", "url_seen").when(o == "rejected_heuristic", F.col("reason_detail"))
        .when(o.isin("rejected_quota_full", "rejected_dedup_clip"), F.col("view"))
    )
    return both.withColumn("outcome", outcome).withColumn("reason_detail", detail).drop("_rank", "_outcome")
