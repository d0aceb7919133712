"""Text-format sources (SRC1, SRC2, SRC10, SRC11, SRC12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyflux.operators.filters import nan_to_null

_WS = r"\s+"


def _split(c="value"):
    return F.split(F.trim(F.col(c)), _WS)


def infer_types(df: DataFrame, cols: list[str]) -> dict[str, str]:
    """Pick long / double / string for string columns in one aggregation job."""
    aggs = []
    for c in cols:
        v = F.nullif(F.trim(F.col(c)), F.lit(""))
        aggs += [F.count(v).alias(f"n__{c}"),
                 F.count(F.expr(f"try_cast(nullif(trim(`{c}`), '') as bigint)")).alias(f"l__{c}"),
                 F.count(F.expr(f"try_cast(nullif(trim(`{c}`), '') as double)")).alias(f"d__{c}")]
    r = df.agg(*aggs).first()
    out = {}
    for c in cols:
        n = r[f"n__{c}"]
        out[c] = "bigint" if r[f"l__{c}"] == n else ("double" if r[f"d__{c}"] == n else "string")
    return out


def read_object_truth(spark: SparkSession, path: str, types: dict[str, str] | None = None,
                      key_from: str = "CID", key_to: str = "SNID") -> DataFrame:
    """SRC2: whitespace-separated DUMP text. The ``VARNAMES:`` line of each
    file names the columns of its data lines, so files of a folder may differ
    in columns and their order (a column missing in a file is NULL there);
    ``#`` comments and blank lines are skipped; the leading tag column is
    dropped and CID is renamed SNID. Types are inferred (long, double, string)
    in one aggregation unless given."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("__file"))
    body = lines.filter((F.trim("value") != "") & ~F.trim("value").startswith("#"))
    is_header = F.trim("value").startswith("VARNAMES:")
    header = (body.filter(is_header).groupBy("__file")
              .agg(F.min_by(_split(), "value").alias("__h"), F.count_distinct(F.array_join(_split(), " ")).alias("__n")))
    seen = header.groupBy("__h").agg(F.max("__n").alias("n"), F.min("__file").alias("f")).orderBy("f").collect()   # distinct headers
    if not seen:
        raise ValueError(f"no VARNAMES line in {path}")
    if any(r["n"] > 1 for r in seen):
        raise ValueError(f"two different VARNAMES lines in one file of {path}")
    names = list(dict.fromkeys(n for r in seen for n in r["__h"][1:]))
    # one header only: the files are parts of one table, and it serves those without their own
    only = F.array(*[F.lit(x) for x in seen[0]["__h"]]) if len(seen) == 1 else F.lit(None).cast("array<string>")
    data = body.filter(~is_header).select("__file", _split().alias("__t")).join(header.drop("__n"), "__file", "left")
    # a line of a file without a header cannot be read: fail instead of losing it
    data = data.withColumn("__h", F.coalesce("__h", only))
    checked = F.when(F.col("__h").isNull(), F.raise_error(F.concat(F.lit("no VARNAMES line in "), F.col("__file")))).otherwise(F.col("__h"))
    at = {n: F.array_position(F.slice(checked, F.lit(2), F.size(checked)), n) for n in names}
    raw = data.select(*[F.when(at[n] > 0, F.get("__t", at[n].cast("int"))).alias(n) for n in names])
    types = types or infer_types(raw, names)
    typed = raw.select(*[F.expr(f"try_cast(nullif(`{n}`, '') as {types.get(n, 'string')})").alias(n)
                         for n in names])
    return typed.withColumnRenamed(key_from, key_to) if key_from in names else typed


# converter names -> Spark types; '' -> NULL for all of them
CONVERTERS = {"int": "bigint", "float": "double", "str": "string"}


def read_truth_csv(spark: SparkSession, path: str, converters: dict[str, str],
                   renames: dict[str, str] | None = None, sep: str = ",") -> DataFrame:
    """SRC10: CSV (plain or gzip), ``#`` comments and blank lines skipped,
    leading spaces ignored, per-column converters (``''`` -> NULL), renames,
    NaN -> NULL."""
    df = (spark.read.option("header", True).option("sep", sep).option("comment", "#")
          .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
          .option("inferSchema", False).csv(path))
    cols = []
    for c in df.columns:
        t = CONVERTERS.get(converters.get(c, "str"), converters.get(c, "string"))
        v = F.nullif(F.trim(F.col(c)), F.lit(""))
        cols.append(F.expr(f"try_cast(nullif(trim(`{c}`), '') as {t})").alias(c) if t != "string" else v.alias(c))
    out = nan_to_null(df.select(*cols))
    for a, b in (renames or {}).items():
        out = out.withColumnRenamed(a, b)
    return out


def read_gentype_map(spark: SparkSession, path: str) -> DataFrame:
    """SRC11: ``<gentype> <model>`` lines; comments/blank lines skipped; a type
    may map to several models (many-to-many)."""
    lines = spark.read.text(path)
    body = lines.filter((F.trim("value") != "") & ~F.trim("value").startswith("#"))
    t = body.select(_split().alias("__t"))
    return t.select(F.col("__t")[0].cast("int").alias("gentype"), F.col("__t")[1].alias("model"))


TEMPLATE_JSON = T.MapType(T.StringType(), T.StructType([
    T.StructField("VK", T.DoubleType()), T.StructField("LOGXLAN", T.DoubleType()),
    T.StructField("LOGMASS", T.DoubleType())]))


def read_template_index(spark: SparkSession, path: str) -> DataFrame:
    """SRC12: JSON objects keyed by the template index -> rows (index, VK,
    LOGXLAN, LOGMASS). Each file holds one object (the survey ships one file
    of a few hundred keys); a folder of such files is read in parallel, one
    text value per file, and exploded."""
    t = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    m = t.select(F.explode(F.from_json("value", TEMPLATE_JSON)).alias("k", "v"))
    return m.select(F.col("k").cast("int").alias("index"), "v.VK", "v.LOGXLAN", "v.LOGMASS")


def list_classes(spark: SparkSession, base: str, prefix: str = "") -> DataFrame:
    """SRC1: class names = sub-directory names under ``base`` with ``prefix``
    stripped, sorted. Lists files (content is not read: the binary source
    prunes the content column)."""
    import re
    b = re.escape(base.rstrip("/").split(":", 1)[-1])
    pat = b + r"/(?:[^/=]+=)?" + re.escape(prefix) + r"([^/]+)/"
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .load(base).select("path"))
    return (files.select(F.regexp_extract("path", pat, 1).alias("class"))
            .filter(F.col("class") != "").distinct().orderBy("class"))


def apply_converters(df: DataFrame, converters: dict) -> DataFrame:
    """UDF5: per-column converters; a value is a type name ('int', 'float',
    'str', or any Spark type) or a function ``Column -> Column``. Empty
    strings become NULL before typed conversion."""
    cols = []
    for c in df.columns:
        conv = converters.get(c)
        if conv is None:
            cols.append(F.col(c))
        elif callable(conv):
            cols.append(conv(F.col(c)).alias(c))
        else:
            t = CONVERTERS.get(conv, conv)
            cols.append(F.expr(f"try_cast(nullif(trim(cast(`{c}` as string)), '') as {t})").alias(c))
    return df.select(*cols)
