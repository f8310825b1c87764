"""The corpus pipeline: documents go through the stages, each written as Parquet and read again.

Rows without id or text pass the filtering stages. A stage sees only what the one before it kept.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from migrascope.llm import decontaminate, jaccard, secrets, toxicity
from migrascope.llm.common import fresh, row_key, ship, table
from migrascope.llm.queries import TOXIC_FROM, mixed, secret_rows
from migrascope.session import ensure_checkpoint_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
NEAR_RULE = jaccard.Rule(shingle=5, percent=80)


def stage(function: Stage) -> Stage:
    """The stage, after the package has been sent to the Python workers."""

    @functools.wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, docs, sf_dir)

    return run


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go; null and empty texts stay."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    score = fresh(docs, "score")
    return toxicity.add_score(docs, model, score=score).filter(F.col(score) < TOXIC_FROM).select(*docs.columns)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the least id stays; rows that repeat both id and text become one."""
    found = jaccard.join(docs, NEAR_RULE)
    gone = found.filter("doc_id <> component_id").select("doc_id").distinct()
    text = fresh(docs, "fp")
    kept = docs.join(gone, "doc_id", "left_anti").withColumn(text, F.xxhash64("text"))
    return kept.dropDuplicates(["doc_id", text]).select(*docs.columns)


@stage
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    benchmark = table(spark, sf_dir, "benchmark")
    latent = decontaminate.fit(docs, benchmark)
    kept, leaks = docs, fresh(docs, "leaks")
    for block in decontaminate.blocks(benchmark):
        found = decontaminate.add_leaks(kept, decontaminate.Search(block, latent), leaks)
        kept = found.filter(F.size(leaks) == 0).select(*docs.columns)
    return kept


@stage
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking secrets are replaced in the text, and n_chars follows; no document goes."""
    live = secrets.judged(secret_rows(docs))
    out = secrets.redacted(docs, live, row_key(F.col("doc_id"), F.col("text")))
    if "n_chars" in docs.columns:
        length = F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.coalesce(length, "n_chars"))
    return out


@stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The drawn documents of the mixture, with topic, words, weight and probability."""
    return mixed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near-copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("secrets", redact_secrets),
    ("mixing", mix),
]
ORACLE_SQL: str | None = None  # no stage is within reach of SQL; the tests hold the rows against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to the shared folder and read again."""
    ensure_checkpoint_dir(spark)
    root = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, function) in enumerate(STAGES):
        path = f"{root}/{i}-{name}"
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
