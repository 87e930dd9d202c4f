"""Documents to token ids in five stages, each an operator of docloom.llm.

Every stage writes its result as Parquet, and its intermediate tables go then; the next
one reads the result, so that a lost executor costs at most the stage at work. The stages
that drop documents give each row a key of its own first, so that rows with null or
repeated ids are judged one by one.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.bpe import encode_documents
from docloom.llm.fm_index import find_contamination
from docloom.llm.ngram_join import jaccard_groups
from docloom.llm.pii import replace_entities
from docloom.llm.queries import DEMO_KEY
from docloom.llm.toxicity import score_documents
from docloom.llm.workspace import Workspace, gathered, scratch


#: The row key within a stage.
ROW = "__pipeline_row"


def _keyed(spark: SparkSession, docs: DataFrame, stage: str) -> DataFrame:
    """docs with a unique key in ROW, written so that all readers see the same keys."""
    return Workspace(spark, f"pipeline-{stage}").write(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")


def _without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """rows without those whose key is in the column ROW of gone; the key itself goes too."""
    return rows.join(gone.select(ROW), ROW, "left_anti").drop(ROW)


def _written(stage):
    """The stage with its result written, and nothing else of it left."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        out = Workspace(spark, f"pipeline-{stage.__name__}")
        with scratch():
            return out.write(stage(spark, docs, sf_dir), "rows")

    return run_stage


@_written
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = _keyed(spark, docs, "toxicity")
    return _without(rows, score_documents(rows, labels, row_col=ROW).filter("predicted = 1"))


@_written
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word shingles at 0.8, one row with the smallest id stays."""
    rows = _keyed(spark, docs, "near-duplicates")
    groups = jaccard_groups(rows, id_col=ROW, k=5, threshold=0.8).select(F.col("doc_id").alias(ROW), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", ROW)
    kept = groups.join(rows.select(ROW, "doc_id"), ROW).groupBy("component_id").agg(F.min(order).getField(ROW).alias(ROW))
    return rows.join(kept.select(ROW), ROW, "left_semi").drop(ROW)


@_written
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = _keyed(spark, docs, "decontamination")
    return _without(rows, find_contamination(rows, benchmark, id_col=ROW).filter("contaminated").select(F.col("doc_id").alias(ROW)))


@_written
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gets surrogates; n_chars is that of the new text."""
    return replace_entities(docs, key=DEMO_KEY).withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


@_written
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit) and the digests of ids and decoded bytes."""
    return encode_documents(docs, ranks_path=public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern=public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("token_ids", token_ids),
]

#: A label model, graph components and BPE merges are beyond SQL; tests/llm holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. The result of a stage goes when the next one's is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, stage in STAGES:
        with gathered() as own:
            docs = stage(spark, docs, sf_dir)
        for ws in before:
            ws.drop()
        before = own
    return docs
