"""Exact deduplication by a tree-merge of sorted digest runs.

Every input partition forms a run of (digest, smallest id, count) rows. Runs
are exchanged in rounds of a radix-``fan_in`` butterfly: before round ``l`` a
cell is (run group, digest range); the round joins ``fan_in`` neighbouring run
groups and at once cuts the digest range into ``fan_in`` parts, so the number
of cells stays the same, each cell merges ``fan_in`` sorted runs, and no cell
ever holds more than its share of the digests. Equal digests collapse to one row
in every round: a text that is a third of all rows is at most ``fan_in`` rows
of any merge. After the last round each digest lies in exactly one cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyflux.llm.common import SPACES, checkpoint_table, shuffle_partitions, small_side, text_or_empty

_RUN = "cell long, sha string, len long, check long, void boolean, id long, row long, n long, run long"
_SAME = ["cell", "sha", "len", "check"]


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row, run, sha, len, check) of every row, stored in the shared folder.

    ``sha`` is the SHA-256 of the text with each run of ASCII white space made
    one space (null counts as empty). ``len`` and ``check`` (an independent
    64-bit hash) verify a match: digests count as equal only when all three
    agree. ``row`` tells rows with the same id apart.
    """
    t = F.regexp_replace(text_or_empty(text_col), SPACES, " ")
    df = docs.select(F.col(id_col).cast("long").alias("id"), t.alias("_t"))
    return checkpoint_table(df.select(
        "id", F.monotonically_increasing_id().alias("row"), F.spark_partition_id().cast("long").alias("run"),
        F.sha2(F.col("_t"), 256).alias("sha"), F.octet_length("_t").cast("long").alias("len"),
        F.xxhash64("_t").alias("check")), "digests")


def _collapse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Merge equal digests of sorted rows; the first row of a group has its
    smallest (id, row). The last group of a batch is carried to the next."""
    carry = None
    for pdf in batches:
        if carry is not None:
            pdf = pd.concat([carry, pdf], ignore_index=True)
        if not len(pdf):
            continue
        new = np.ones(len(pdf), dtype=bool)
        new[1:] = False
        for c in _SAME:
            v = pdf[c].to_numpy()
            new[1:] |= v[1:] != v[:-1]
        at = np.flatnonzero(new)
        out = pdf.iloc[at].reset_index(drop=True)
        out["n"] = np.add.reduceat(pdf["n"].to_numpy(), at)
        carry = out.iloc[-1:]
        yield out.iloc[:-1]
    if carry is not None:
        yield carry


def merge_runs(runs: DataFrame, partitions: int, fan_in: int = 8) -> DataFrame:
    """One row per digest: (sha, len, check, keep_id, keep_row, group_size)."""
    levels = 1
    while fan_in ** levels < partitions:
        levels += 1
    width = fan_in ** levels
    # 48 leading bits of the digest as a number in [0, 2^48)
    head = F.conv(F.substring("sha", 1, 12), 16, 10).cast("long")
    df = runs.select("sha", "len", "check", F.col("id").isNull().alias("void"), F.coalesce("id", F.lit(0)).alias("id"), "row", F.lit(1).cast("long").alias("n"),
                     F.pmod(F.col("run"), F.lit(width)).alias("run"))
    for level in range(1, levels + 1):
        ranges = fan_in ** level
        group = F.floor(F.col("run") / F.lit(ranges)).cast("long")
        part = F.shiftright(head * F.lit(ranges), 48) if ranges <= 2 ** 14 else F.floor(head / (2.0 ** 48 / ranges))
        df = (df.withColumn("cell", group * F.lit(ranges) + part.cast("long"))
              .repartition(width, "cell")
              .sortWithinPartitions("cell", "sha", "len", "check", "void", "id", "row")
              .select("cell", "sha", "len", "check", "void", "id", "row", "n", "run")).mapInPandas(_collapse, _RUN)
    return df.select("sha", "len", "check", F.when(~F.col("void"), F.col("id")).alias("keep_id"), F.col("row").alias("keep_row"),
                     F.col("n").alias("group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 8) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty. The row with the smallest id of a group stays;
    null ids come last; of repeated rows with the same id, one stays. An empty
    table gives an empty result; other columns of ``docs`` are ignored.
    """
    spark = docs.sparkSession
    rows = digests(docs, id_col, text_col)
    best = merge_runs(rows, shuffle_partitions(spark), fan_in)
    same = ["sha", "len", "check"]
    return rows.join(best, same).select(
        F.col("id").alias(id_col), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.col("sha").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 8) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows are matched by id. Where an id occurs on several rows the digest is
    matched too, and equal rows under one id are reduced to one.
    """
    decided = checkpoint_table(exact_dedup(docs, id_col, text_col, fan_in), "dedup")
    ids = checkpoint_table(decided.groupBy(id_col).agg(F.count("*").alias("_rows"), F.max("kept").alias("_kept"))
                           .filter("_rows > 1 OR NOT _kept").withColumnRenamed(id_col, "_id"), "dedup-ids")
    side = small_side(ids.select("_id"))
    once = docs.join(side, docs[id_col].eqNullSafe(side["_id"]), "left_anti")
    again = ids.filter("_kept").select("_id")
    if again.isEmpty():
        return once
    mark = "_sha"
    while mark in docs.columns:
        mark = "_" + mark
    keep = decided.filter("kept").select(F.col(id_col).alias("_id"), F.col("text_sha256").alias("_sha"))
    sha = F.sha2(F.regexp_replace(text_or_empty(text_col), SPACES, " "), 256)
    rest = docs.join(again, docs[id_col].eqNullSafe(again["_id"]), "left_semi").withColumn(mark, sha)
    rest = rest.alias("d").join(keep.alias("k"), F.col(f"d.{id_col}").eqNullSafe(F.col("k._id"))
                                & (F.col(f"d.{mark}") == F.col("k._sha")), "left_semi").dropDuplicates([id_col, mark])
    return once.unionByName(rest.drop(mark))
