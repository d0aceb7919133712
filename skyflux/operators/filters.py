"""Predicates and filters (FLT1-FLT10)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyflux.functions.photometry import has_flag
from skyflux.schemas import BANDS, PHOTFLAG_DETECT, PHOTFLAG_SATURATE


def detections_only(phot: DataFrame, flag: str = "PHOTFLAG", mask: int = PHOTFLAG_DETECT) -> DataFrame:
    """FLT2: keep detected points (without it a curve is forced photometry)."""
    return phot.filter(has_flag(flag, mask))


def select_range(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """FLT3: half-open range ``lo <= col < hi`` (pushed to the Parquet scan)."""
    return df.filter((F.col(col) >= lo) & (F.col(col) < hi))


def drop_sentinels(df: DataFrame, key: str = "SNID") -> DataFrame:
    """FLT4: drop separator rows (negative object id)."""
    return df.filter(F.col(key) >= 0)


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """FLT5: NaN -> NULL on every float/double column (or on ``cols``)."""
    floats = [f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    targets = set(cols if cols is not None else floats) & set(floats)
    return df.select(*[
        F.when(~F.isnan(F.col(c)), F.col(c)).alias(c) if c in targets else F.col(c)
        for c in df.columns
    ])


def drop_uninformative(df: DataFrame, cols: list[str]) -> DataFrame:
    """FLT6: drop an explicit list of columns (missing names are ignored)."""
    return df.drop(*cols)


def positive_redshift(df: DataFrame, z: str = "SIM_REDSHIFT_CMB") -> DataFrame:
    """FLT7: z > 0."""
    return df.filter(F.col(z) > 0)


def max_ejecta(df: DataFrame, mej: str = "MEJ", threshold: float = 0.1) -> DataFrame:
    """FLT7: ejecta mass <= threshold."""
    return df.filter(F.col(mej) <= threshold)


def drop_failed_masses(df: DataFrame, m1: str = "m1", m2: str = "m2") -> DataFrame:
    """FLT7: failed mass inversions are 0 (or NULL) and are removed."""
    return df.filter((F.col(m1) > 0) & (F.col(m2) > 0))


def cut_windows(objects: DataFrame, windows: dict[str, tuple], allow_null: bool = False) -> DataFrame:
    """FLT8: keep rows whose columns all lie in inclusive windows ``{col: (lo, hi)}``
    (e.g. a peak magnitude per band: any band outside rejects the object).

    A ``None`` bound is open. NULL values fail the cut unless ``allow_null``
    (an unobserved band is not outside its window)."""
    conds = []
    for c, (lo, hi) in windows.items():
        cond = F.col(c).isNotNull()
        if lo is not None:
            cond = cond & (F.col(c) >= lo)
        if hi is not None:
            cond = cond & (F.col(c) <= hi)
        conds.append((F.col(c).isNull() | cond) if allow_null else cond)
    return objects.filter(reduce(lambda a, b: a & b, conds)) if conds else objects


def count_unsaturated(phot: DataFrame, key: str = "SNID", band: str = "BAND",
                      flag: str = "PHOTFLAG", bands: list[str] | None = None,
                      name: str = "NOBS") -> DataFrame:
    """FLT8 helper: per object, number of unsaturated points in the chosen bands."""
    p = phot.filter(~has_flag(flag, PHOTFLAG_SATURATE))
    if bands:
        p = p.filter(F.col(band).isin(bands))
    return p.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def validate_class(spark, cls: str, known: list[str]) -> str:
    """FLT9: unknown class -> ValueError (a driver-side argument check, no job)."""
    if cls not in known:
        raise ValueError(f"Unknown class {cls}")
    return cls


def unknown_bands(phot: DataFrame, band: str = "BAND", known: list[str] | None = None) -> DataFrame:
    """FLT9: distinct band values that are not in the band dimension."""
    spark = phot.sparkSession
    dim = spark.createDataFrame([(b,) for b in (known or BANDS)], [band])  # fixed 6 rows
    return (phot.select(band).distinct()
            .join(F.broadcast(dim), band, "left_anti"))


def crop_to_detections(phot: DataFrame, key: str = "SNID", mjd: str = "MJD",
                       flag: str = "PHOTFLAG", mask: int = PHOTFLAG_DETECT,
                       before: float = 20.0, after: float = 20.0) -> DataFrame:
    """FLT10: keep points from first detection - ``before`` to last + ``after`` days.

    Per-object bounds come from a partial aggregation joined back on the key
    (one row per object on the build side), not from an unbounded window."""
    bounds = (phot.filter(has_flag(flag, mask))
              .groupBy(key)
              .agg(F.min(mjd).alias("__lo"), F.max(mjd).alias("__hi")))
    return (phot.join(bounds, key, "inner")
            .filter((F.col(mjd) >= F.col("__lo") - before) & (F.col(mjd) <= F.col("__hi") + after))
            .drop("__lo", "__hi"))
