"""The corpus pipeline: documents in, encoded documents out.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and is the next stage's ``docs``. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyflux.llm.bpe import bpe_encode
from skyflux.llm.common import checkpoint_table, small_side, table
from skyflux.llm.exact_dedup import drop_exact_duplicates
from skyflux.llm.mixing import TARGETS, mix
from skyflux.llm.shingle_join import shingle_components
from skyflux.llm.toxicity import predict, train_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not find toxic."""
    models, cut = train_toxic(docs, table(spark, sf_dir, "labels"))
    prefix = "p_" + "_" * max(map(len, docs.columns))                  # longer than any column of the documents
    return predict(docs, models, keep=docs.columns, prefix=prefix).filter(F.col(f"{prefix}toxic") < cut).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with the same normalised text, the one with the smallest id."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one with the smallest id."""
    found = shingle_components(docs)
    gone = checkpoint_table(found.filter("component_id <> doc_id").select(F.col("doc_id").alias("_gone")), "near-gone")
    side = small_side(gone)
    return docs.join(side, docs["doc_id"] == side["_gone"], "left_anti")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn with their cell's calibrated probability."""
    return mix(docs, TARGETS).filter("mix_kept").select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document's tokens, and digests of the ids and of the decoded text."""
    import public_tokenizers as P
    out = bpe_encode(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN, decoded_col="decoded",
                     keep=["doc_id", "lang", "source"], states=24_000, cache_bytes=60_000_000,
                     chunk=2_000_000)                           # executors hold the earlier stages' memory
    return out.select("doc_id", "lang", "source", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing),
          ("encoding", encoding)]

#: The classifier chain cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = checkpoint_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
