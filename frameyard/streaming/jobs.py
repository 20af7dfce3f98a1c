"""Structured Streaming jobs: restartable ingestion, deduplication, quotas and counters."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from frameyard.functions.durable import materialize, release
from frameyard.streaming.state import RunState


def ingest(stream: DataFrame, decide: Callable[[DataFrame, dict, RunState], DataFrame], state: RunState, index: list[str], checkpoint: str) -> StreamingQuery:
    """Batches of candidates are decided one after the other against the state of the batches before: the accepted
    rows (urls and embeddings) and the quota counts. decide(batch, manifest, state) returns rows with rank, view and
    outcome; index names the columns of accepted rows that later batches need. A batch is committed as a whole; run
    again, it sees the same state as the first time, or was committed and is passed over."""

    def step(batch: DataFrame, number: int) -> None:
        if number in state.commits():
            return
        decided = materialize(decide(batch, state.latest(number), state))
        state.commit(number, decided, index)
        release(decided)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def dedupe_stream(stream: DataFrame, keys: list[str], within: tuple[str, str] | None = None) -> DataFrame:
    """The first row of each key; with within = (time column, delay) the state is let go behind the watermark."""
    if within:
        return stream.withWatermark(*within).dropDuplicatesWithinWatermark(keys)
    return stream.dropDuplicates(keys)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class QuotaProcessor(StatefulProcessor):
    """Accepts rows of a view while its count is below the target: batches as they arrive, the rows of a batch in order."""

    def __init__(self, targets: dict[str, int], order: str):
        self.targets, self.order = targets, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.accepted = handle.getValueState("accepted", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        n = self.accepted.get()[0] if self.accepted.exists() else 0
        free = max(0, self.targets.get(key[0], 0) - n)
        held = None  # the first rows by order of all that came; at most as many as are still free
        for pdf in rows:
            pdf = (pdf if held is None else pd.concat([held, pdf])).sort_values(self.order, kind="stable")
            held = pdf.iloc[:free]
            yield pdf.iloc[free:].assign(outcome="rejected_quota_full")
        if held is not None:
            yield held.assign(outcome="accepted")
            self.accepted.update((n + len(held),))

    def close(self) -> None:
        pass


def quota_stream(stream: DataFrame, targets: dict[str, int], view: str = "view", order: str = "rank") -> DataFrame:
    """Adds outcome by the quota of each view, kept as state. State with columns of its own needs the RocksDB store,
    which is set for the session here."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stream.schema) + ", outcome string"
    return stream.groupBy(view).transformWithStateInPandas(QuotaProcessor(targets, order), schema, "append", "none")


def count_stream(stream: DataFrame, by: list[str]) -> DataFrame:
    """T4: running counts, for update mode."""
    return stream.groupBy(*by).agg(F.count("*").alias("n"))
