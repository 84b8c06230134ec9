"""A training corpus from raw documents: each stage calls one corpus operator on what the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parcelflow.llm import line_dedup, packing, secret_scan, simhash, toxicity
from parcelflow.llm.queries import BYTE_VOCABULARY, fold, table
from parcelflow.llm.shared import written

#: Documents with this toxicity or more are rejected.
TOXIC = 0.5


def with_text(docs: DataFrame, columns: list[str], text: Column, within: str = "") -> DataFrame:
    """The given columns (or fields of the struct ``within``) with another text, and its length where there is a column for it."""
    own = {c: F.col(f"{within}.`{c}`" if within else f"`{c}`") for c in columns}
    changed = {"text": text} | ({"n_chars": F.coalesce(F.length(text).cast("bigint"), own["n_chars"])} if "n_chars" in columns else {})
    return docs.select(*[changed.get(c, own[c]).alias(c) for c in columns])


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not scored as toxic, by a model of the labels of the training fold.

    Null and empty texts get the score of texts without known words; copies share their score; with labels of one
    class only, or without any, all have the prior; a table without rows stays without rows; other columns pass.
    """
    labels = table(spark, sf_dir, "labels").filter(fold("doc_id", 5) != 0)
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.filter(F.col("score") < TOXIC).select("row.*")


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that three or more of them share but for the largest doc_id.

    A null text becomes an empty one; of rows that share the largest doc_id all keep the line; a table without rows
    stays without rows; other columns pass, whatever their names.
    """
    return with_text(line_dedup.dedup_lines(docs, keep=docs.columns), docs.columns, F.col("kept"), "kept_columns")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id; rows that share it stay together.

    Null and empty texts are alike and form one group; a null doc_id stays only where its whole group has none;
    a table without rows stays without rows; other columns pass, whatever their names.
    """
    found = simhash.near_duplicates(docs, shingle=3, max_bits=2)
    kept = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(kept.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(kept["__kept"]), "left_semi")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in their texts replaced by a mark.

    Texts without secrets pass as they are, null ones among them; overlapping secrets get one mark; a table without
    rows stays without rows; other columns pass, whatever their names.
    """
    return with_text(secret_scan.redact(docs), docs.columns, F.col("text"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1,024 ids.

    A null or empty text is its end id alone; repeated rows are packed each; a table without rows gives no pieces; other
    columns do not pass.
    """
    return packing.pack(docs, public_tokenizers.path(BYTE_VOCABULARY))


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_shared_lines),
    ("simhash", without_near_duplicates),
    ("secret_scan", without_secrets),
    ("packing", packed),
]

#: Scores of a classifier, fingerprints and token ids are beyond SQL; tests hold each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents through all stages, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
