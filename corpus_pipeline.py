"""The corpus pipeline: quality, line dedup, near-dedup, mixture, token ids.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which run() writes
as Parquet to the shared folder and reads again for the next. All but the last
give the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ohmbridge.llm import bpe, common, gbdt, linededup, mixing, neardup

#: Tokens that the mixture keeps, as a share of those it is given; no text is taken twice here.
BUDGET, EPOCHS = 0.9, 1


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more; it learns from the labels of ``docs``.

    Null and empty texts are scored like others, by their zero statistics.
    Repeated rows stay or go together. Without labels of both kinds every row has
    the share of ones as its score; an empty table stays empty.
    """
    return gbdt.keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that five documents or more share, but for the last that holds each.

    A document of which no line is left goes; n_chars is that of the text left.
    Null and empty texts, and rows without a doc_id, stay as they are; repeated
    rows of a doc_id count once and lose the same lines.
    """
    names = common.free_names(docs.columns, "kept_text", "n_lines", "n_dropped")
    kept, dropped = F.col(names[0]), F.col(names[2])
    rows = linededup.LineDedup.of(docs).apply(docs, tuple(names))
    rows = rows.where((dropped == 0) | (F.length(kept) > 0))
    changed = {"text": F.when(dropped == 0, F.col("text")).otherwise(kept)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(dropped == 0, F.col("n_chars")).otherwise(F.length(kept)).cast(docs.schema["n_chars"].dataType)
    return rows.withColumns(changed).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of the least doc_id.

    Rows without a doc_id, and texts without words, are in no group and stay.
    Rows that repeat the least doc_id of a group all stay.
    """
    gone = neardup.near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen to the target weights.

    Nulls of lang and source are names of their own; rows of one doc_id and leaf
    are taken together, texts without words with their place in the order.
    """
    return mixing.mix(docs, BUDGET, mixing.WEIGHTS, epochs=EPOCHS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text; a null or empty text has none."""
    return bpe.encode_documents(docs, keep=("doc_id", "lang", "source")).select("doc_id", "lang", "source", "n_tokens", "ids", "ids_sha256")


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("mixture", mixture), ("encode", encode)]

#: The classifier and byte-pair encoding are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = common.materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
