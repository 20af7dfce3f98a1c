"""A corpus pipeline of five stages. Each takes the documents that its predecessor kept, decides on whole texts, and
returns documents again; the last returns packed sequences."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameyard.llm.common import bounded_broadcast, materialize, small_batches, table
from frameyard.llm.decontam import decontaminate
from frameyard.llm.jaccard_join import jaccard_join
from frameyard.llm.packing import pack_documents
from frameyard.llm.secret_scan import mask_secrets
from frameyard.llm.toxicity import score_toxicity


#: Near copies in the corpus: five-word shingles, of which 80 percent agree.
SHINGLE, PERCENT = 5, 80
#: Chunks that a packing worker remembers: less than by itself, as the earlier stages' workers still live.
CACHE = 50_000
#: Documents that a stage hands to a Python worker at once: buffers of early stages stay with the JVM through the later ones.
BATCH = 1000
#: The stages' own name for a row: ids may be missing, repeated, or stand for several texts.
ROW = "_corpus_pipeline_row"


def _numbered(docs: DataFrame) -> DataFrame:
    """docs with a number for each row, written once so that every later read sees the same numbers."""
    return materialize(docs.withColumn(ROW, F.monotonically_increasing_id()))


def _without(numbered: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows whose numbers are not among the rejected, without the numbers; nothing else changes."""
    gone = bounded_broadcast(materialize(rejected.select(ROW)))
    return numbered.join(gone, ROW, "left_anti").select(*(c for c in numbered.columns if c != ROW))


def _in_small_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with small_batches(spark, BATCH):
            return stage(spark, docs, sf_dir)

    return run


@_in_small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is predicted toxic go; other texts under the same id stay, rows without an id are judged like the
    others. A null or empty text gets the rate of examples without a term and so stays unless most of those are toxic;
    without labels nothing goes. Repeated rows go or stay together. Of the columns only doc_id and text are read."""
    rows = _numbered(docs)
    return _without(rows, score_toxicity(rows, table(spark, sf_dir, "labels"), key_col=ROW).where("predicted = 1"))


@_in_small_batches
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by n-gram Jaccard (SHINGLE words, PERCENT) one row stays: the least by id, digest of the
    text, and place among the rows. Rows without an id come last; repeated rows are a group; null, empty and wordless
    texts are in no group and stay. Of the columns only doc_id and text are read."""
    rows = _numbered(docs)
    linked = jaccard_join(rows, n_gram=SHINGLE, percent=PERCENT, id_col=ROW).select(F.col("doc_id").alias("_at"), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("bare"), F.col("doc_id"), F.xxhash64("text").alias("digest"), F.col(ROW))
    ranked = materialize(rows.select(ROW, order.alias("order")).join(linked, F.col(ROW) == F.col("_at")).select(ROW, "component_id", "order"))
    stay = ranked.groupBy("component_id").agg(F.min("order").alias("least")).select(F.col("least")[ROW].alias("_stay"))
    return _without(rows, ranked.join(stay, F.col(ROW) == F.col("_stay"), "left_anti"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds a window of a benchmark item go; other texts under the same id stay. Null and wordless
    texts stay, and all rows where the benchmark is empty. Repeated rows go or stay together."""
    rows = _numbered(docs)
    found = decontaminate(rows, table(spark, sf_dir, "benchmark"), id_col=ROW).where("contaminated")
    return _without(rows, found.select(F.col("doc_id").alias(ROW)))


def mask_found_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; n_chars, null or not, becomes the new length then. No row goes; null and empty
    texts and texts without secrets are as they were, all other columns too."""
    return mask_secrets(docs, length_col="n_chars")


@_in_small_batches
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left is packed into sequences, one row per piece; a null or empty text is its end token alone, repeated
    rows are packed each, no rows give none."""
    return pack_documents(docs, cache=CACHE)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", mask_found_secrets),
    ("best_fit_packing", pack),
]
#: A classifier and a packing are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
