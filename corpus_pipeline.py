"""A corpus pipeline over ``documents``: toxicity, near-duplicates, secrets, mixing, packing.

Each stage is (name, function) with function(spark, docs, sf_dir) -> DataFrame; its result is written as Parquet and
reread as the next one's input. All but the last return the columns of ``documents``.

Defined cases of all stages: columns may have any names and hold nulls; null texts count as empty, and stay null until they
are packed; rows that repeat an id or have none are rows each but where a stage says otherwise; an empty table stays
empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgraph.llm.common import cut, table
from claimgraph.llm.minhash import near_duplicates
from claimgraph.llm.mixing import take
from claimgraph.llm.packing import pack
from claimgraph.llm.queries import tokenizer_path
from claimgraph.llm.secrets import redact_secrets
from claimgraph.llm.toxicity import score_rows

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below 0.5; empty and null texts have the score of the prior and stay."""
    score = "score" + "_" * max(map(len, docs.columns))
    return score_rows(docs, docs, table(spark, sf_dir, "labels"), score_col=score).filter(F.col(score) < 0.5).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest doc_id.

    Rows of one doc_id are one document, so they stay or go together, also where they repeat word for word. A null doc_id
    and a text without words are like nothing and stay.
    """
    gone = near_duplicates(docs).filter("not kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked; n_chars is that of the new text, and as it was for a null text."""
    masked = redact_secrets(docs)
    return masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long"))).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as many times as the mix takes it, none to three times; null sources are one, rows without words are not taken unless their source has none."""
    return take(docs)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences; each row of the mix is a document of its own, also if it repeats another, and a null text is the id 0 alone."""
    pieces = pack(docs, tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("token_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_group")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, name)
    return docs
