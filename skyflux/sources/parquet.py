"""Parquet datasets and simple sinks (SRC6, SRC7, SRC13, SRC16)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_lightcurves(curves: DataFrame, path: str, partition: str | list[str] = "class", key: str = "SNID",
                      mode: str = "overwrite", max_rows: int = 1_000_000, bloom: bool = True) -> None:
    """SRC6: one Parquet dataset partitioned by class (or class and file
    number). Rows are range-partitioned by (partition, key), so a large class
    is written by many tasks, each with a range of keys and files of at most
    ``max_rows`` rows; row-group statistics, and Bloom filters unless ``bloom``
    is false, serve point lookups."""
    parts = [partition] if isinstance(partition, str) else list(partition)
    (curves.repartitionByRange(*parts, key).sortWithinPartitions(*parts, key)
     .write.mode(mode).option("maxRecordsPerFile", max_rows).options(**(bloom_options(key) if bloom else {})).partitionBy(*parts).parquet(path))


#: Sizes a Bloom filter is tried at, halved from Parquet's largest (1 MB) down to about 1 KB.
BLOOM_SIZES = 12


def bloom_options(key: str, distinct: int | None = None) -> dict[str, str]:
    """Writer options for a Parquet Bloom filter on ``key`` in every row group, sized
    for ``distinct`` values, or without it for those the row group turns out to hold
    (else every file, however small, has one of 1 MB): a point lookup skips row
    groups whose range of ids holds the wanted one but whose rows do not."""
    out = {f"parquet.bloom.filter.enabled#{key}": "true"}
    if distinct:
        out[f"parquet.bloom.filter.expected.ndv#{key}"] = str(distinct)
    else:
        out["parquet.bloom.filter.adaptive.enabled"] = "true"
        out[f"parquet.bloom.filter.candidates.number#{key}"] = str(BLOOM_SIZES)
    return out


def write_colocated(df: DataFrame, table: str, path: str, key: str = "SNID", buckets: int = 64, mode: str = "overwrite",
                    distinct: int | None = None) -> DataFrame:
    """SRC6, co-located: ``df`` as the catalogue table ``table`` (files at
    ``path``), bucketed and sorted by ``key`` with Bloom filters on it. Tables
    written with the same key and number of buckets, such as HEAD, truth and
    curves, are joined and grouped by the key without a shuffle, and a lookup
    of one key reads one bucket. One file per bucket: choose ``buckets`` so that
    one is some hundred MB."""
    (df.repartition(buckets, key).write.mode(mode).bucketBy(buckets, key).sortBy(key)
     .options(**bloom_options(key, distinct)).option("path", path).format("parquet").saveAsTable(table))
    return df.sparkSession.table(table)


def read_lightcurves(spark: SparkSession, path: str, classes: list | None = None,
                     partition: str = "class", file_num: str | list[str] | None = None) -> DataFrame:
    """SRC7: read the dataset back; a class list and file numbers prune
    partitions (where written with them) or reach the Parquet statistics."""
    df = spark.read.parquet(path)
    if "file_num" in df.columns and df.schema["file_num"].dataType != T.StringType():
        # a partition folder "file_num=0001" is read as a number; its text is the key
        fields = [T.StructField(f.name, T.StringType()) if f.name == "file_num" else f for f in df.schema.fields]
        df = spark.read.schema(T.StructType(fields)).parquet(path)
    if classes:
        df = df.filter(F.col(partition).isin(classes))
    if file_num is not None:
        df = df.filter(F.col("file_num").isin([file_num] if isinstance(file_num, str) else list(file_num)))
    return df


def read_gw_tables(spark: SparkSession, source: str, table: str, fmt: str = "parquet",
                   **options) -> DataFrame:
    """SRC13: ``sim_inspiral`` / ``coinc_inspiral`` from a Parquet export
    (``source``/``table``) or over JDBC (``fmt='jdbc'``, driver jar supplied by
    the user)."""
    if fmt == "jdbc":
        return spark.read.format("jdbc").option("url", source).option("dbtable", table).options(**options).load()
    return spark.read.format(fmt).options(**options).load(f"{source.rstrip('/')}/{table}")


def format_fixed(df: DataFrame, decimals: int = 4) -> DataFrame:
    """SRC16: float columns as fixed-point text (rounded half-up)."""
    s = float(10 ** decimals)
    return df.select(*[
        F.format_string(f"%.{decimals}f", F.floor(F.col(f.name) * s + 0.5) / s).alias(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else F.col(f.name)
        for f in df.schema.fields])


def write_csv_fixed(df: DataFrame, path: str, decimals: int = 4, mode: str = "overwrite") -> None:
    """SRC16: CSV with a header, floats written as ``%.<decimals>f``."""
    format_fixed(df, decimals).write.mode(mode).option("header", True).csv(path)
