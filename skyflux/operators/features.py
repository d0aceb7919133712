"""Photometric features: cadence, triggers, per-object summaries, per-band
feature arrays (FN5, AGG6, AGG17, WIN1-WIN3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyflux.operators.ordered import MAX_ROWS, exact_median, group_max, ordered_lag, ranked
from skyflux.functions.photometry import (fractional_error, has_flag, mag_error,
                                          mag_from_flux, snr)
from skyflux.schemas import BANDS, PHOTFLAG_DETECT, PHOTFLAG_SATURATE, PHOTFLAG_TRIGGER


def delta_t(phot: DataFrame, key: str = "SNID", band: str = "BAND", mjd: str = "MJD",
            tiebreak: str | None = "obs_id", name: str = "delta_t", skew_safe: bool = True,
            top: int | None = None) -> DataFrame:
    """WIN1: gap to the previous point of the same object and band (NULL first).

    ``skew_safe`` (default) range-partitions on (object, band, time) so a huge
    curve is split over tasks (``ordered.ordered_lag``); otherwise a plain
    window per (object, band)."""
    order = [mjd] + ([tiebreak] if tiebreak else [])
    if skew_safe:
        return ordered_lag(phot, [key, band], order, mjd, "__prev_mjd", top=top) \
            .withColumn(name, F.col(mjd) - F.col("__prev_mjd")).drop("__prev_mjd")
    w = Window.partitionBy(key, band).orderBy(*order)
    return phot.withColumn(name, F.col(mjd) - F.lag(mjd).over(w))


def cadence_median(phot: DataFrame, key: str = "SNID", band: str = "BAND", mjd: str = "MJD",
                   tiebreak: str | None = "obs_id", name: str = "median_delta_t",
                   skew_safe: bool = True) -> DataFrame:
    """AGG17: exact median of consecutive gaps per object and band (by rank,
    ``ordered.exact_median``, so no group is held in one task's memory)."""
    if skew_safe:
        # one count of the raw points bounds both rankings (gaps = points - 1)
        top = group_max(phot, [key, band])
        d = delta_t(phot, key, band, mjd, tiebreak, "__dt", True, top).filter(F.col("__dt").isNotNull())
        return exact_median(d, [key, band], "__dt", name, top=top)
    d = delta_t(phot, key, band, mjd, tiebreak, "__dt", False).filter(F.col("__dt").isNotNull())
    return d.groupBy(key, band).agg(F.median("__dt").alias(name))


def first_trigger(phot: DataFrame, key: str = "SNID", mjd: str = "MJD",
                  flag: str = "PHOTFLAG") -> DataFrame:
    """WIN2: first trigger MJD and first/last detection MJD per object (one
    partial aggregation; objects without detections get NULLs)."""
    det = has_flag(flag, PHOTFLAG_DETECT)
    trg = has_flag(flag, PHOTFLAG_TRIGGER)
    return phot.groupBy(key).agg(
        F.min(F.when(trg, F.col(mjd))).alias("MJD_TRIGGER"),
        F.min(F.when(det, F.col(mjd))).alias("MJD_DETECT_FIRST"),
        F.max(F.when(det, F.col(mjd))).alias("MJD_DETECT_LAST"))


def trigger_after_two(phot: DataFrame, key: str = "SNID", mjd: str = "MJD",
                      flag: str = "PHOTFLAG", gap: float = 0.021) -> DataFrame:
    """WIN3: an object triggers at its first detection at least ``gap`` days
    after an earlier detection, i.e. the first detection with
    MJD >= first detection + gap. Objects that never trigger are absent.

    Two partial aggregations and a join on the key (one row per object on
    the build side); no per-object sort is needed."""
    det = phot.filter(has_flag(flag, PHOTFLAG_DETECT)).select(key, mjd)
    first = det.groupBy(key).agg(F.min(mjd).alias("__first"))
    return (det.join(first, key)
            .filter(F.col(mjd) >= F.col("__first") + F.lit(gap))
            .groupBy(key).agg(F.min(mjd).alias("MJD_TRIGGER2"),
                              F.min("__first").alias("MJD_DETECT_FIRST")))


def object_summary(phot: DataFrame, key: str = "SNID", band: str = "BAND", mjd: str = "MJD",
                   flux: str = "FLUXCAL", err: str = "FLUXCALERR", flag: str = "PHOTFLAG",
                   tiebreak: str = "obs_id", bands: list[str] | None = None) -> DataFrame:
    """AGG6: observed analogue of the simulation summary, one row per object:
    NOBS, NOBS_SATURATE, MJD_DETECT_FIRST/LAST, PEAKMJD (MJD of the largest flux,
    earliest on ties), PEAKMAG_<band> (magnitude of the band's largest flux) and
    SNRMAX/SNRMAX2/SNRMAX3 (largest, 2nd and 3rd largest per-band S/N maxima).

    Two-level aggregation (object x band, then object): both levels combine
    partially map-side, the second sees at most one row per band."""
    bands = bands or BANDS
    det = has_flag(flag, PHOTFLAG_DETECT)
    per_band = phot.groupBy(key, band).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(has_flag(flag, PHOTFLAG_SATURATE), 1)).alias("nsat"),
        F.min(F.when(det, F.col(mjd))).alias("dfirst"),
        F.max(F.when(det, F.col(mjd))).alias("dlast"),
        F.max(F.struct(F.col(flux).alias("f"), (-F.col(mjd)).alias("nm"),
                       (-F.col(tiebreak)).alias("nt"))).alias("peak"),
        F.max(snr(flux, err)).alias("snrmax"))
    snrs = F.sort_array(F.collect_list("snrmax"), asc=False)
    peak = F.max(F.col("peak"))
    agg = per_band.groupBy(key).agg(
        F.sum("n").alias("NOBS"), F.sum("nsat").alias("NOBS_SATURATE"),
        F.min("dfirst").alias("MJD_DETECT_FIRST"), F.max("dlast").alias("MJD_DETECT_LAST"),
        (-peak.getField("nm")).alias("PEAKMJD"),
        *[F.max(F.when(F.col(band) == b, mag_from_flux(F.col("peak").getField("f"))))
          .alias(f"PEAKMAG_{b}") for b in bands],
        snrs.alias("__snrs"))
    return agg.select(key, "NOBS", "NOBS_SATURATE", "MJD_DETECT_FIRST", "MJD_DETECT_LAST",
                      "PEAKMJD", *[f"PEAKMAG_{b}" for b in bands],
                      F.element_at("__snrs", 1).alias("SNRMAX"),
                      F.when(F.size("__snrs") >= 2, F.element_at("__snrs", 2)).alias("SNRMAX2"),
                      F.when(F.size("__snrs") >= 3, F.element_at("__snrs", 3)).alias("SNRMAX3"))


def _array_median(a: Column) -> Column:
    s = F.array_sort(a)
    n = F.size(s)
    h = (n / 2).cast("int")
    odd = F.element_at(s, h + 1)
    even = (F.element_at(s, F.greatest(h, F.lit(1))) + F.element_at(s, h + 1)) / 2.0
    return F.when(n <= 0, F.lit(None)).when(n % 2 == 1, odd).otherwise(even)


def band_features(phot: DataFrame, key: str = "SNID", band: str = "BAND", mjd: str = "MJD",
                  flux: str = "FLUXCAL", err: str = "FLUXCALERR", flag: str = "PHOTFLAG",
                  bands: str = "gri", extra: list[str] | None = None,
                  tiebreak: str | None = "obs_id") -> DataFrame:
    """FN5: per object and band, time-ordered arrays; masked ones keep points with
    magerr != 0 and photflag != 0 (mjd, fluxcal, fluxcalerr, photflag, mag,
    magerr, snr = fluxerr/|flux| as in the source); unmasked ones are
    ``delta_t``, ``median_delta_t``, ``magobs`` (equal to the cadence median, as
    in the source) and ``extra`` columns (psf, sky, zero point, ...).

    One aggregation by object; the arrays are built with higher-order functions."""
    extra = extra or []
    fields = [mjd] + ([tiebreak] if tiebreak else []) + [flux, err, flag] + extra
    aggs = [F.array_sort(F.collect_list(F.when(F.col(band) == b, F.struct(*fields))))
            .alias(f"__{b}") for b in bands]
    g = phot.groupBy(key).agg(*aggs)
    out = [F.col(key)]
    for b in bands:
        pts = F.col(f"__{b}")
        m = pts.getField(mjd)
        n = F.size(m)
        dts = F.when(n > 1, F.transform(F.slice(m, 2, n - 1),
                                        lambda x, i: x - F.element_at(m, i + 1))) \
            .otherwise(F.array().cast("array<double>"))
        kept = F.filter(pts, lambda p: (mag_error(p[flux], p[err]) != 0) & (p[flag] != 0))
        out += [
            kept.getField(mjd).alias(f"mjd_{b}"),
            kept.getField(flux).alias(f"fluxcal_{b}"),
            kept.getField(err).alias(f"fluxcalerr_{b}"),
            kept.getField(flag).alias(f"photflag_{b}"),
            F.transform(kept, lambda p: mag_from_flux(p[flux])).alias(f"mag_{b}"),
            F.transform(kept, lambda p: mag_error(p[flux], p[err])).alias(f"magerr_{b}"),
            F.transform(kept, lambda p: fractional_error(p[flux], p[err])).alias(f"snr_{b}"),
            dts.alias(f"delta_t_{b}"),
            _array_median(dts).alias(f"median_delta_t_{b}"),
            _array_median(dts).alias(f"magobs_{b}"),
        ]
        out += [pts.getField(c).alias(f"{c.lower()}_{b}") for c in extra]
    return g.select(*out)


def band_feature_chunks(phot: DataFrame, key: str = "SNID", band: str = "BAND", mjd: str = "MJD",
                        flux: str = "FLUXCAL", err: str = "FLUXCALERR", flag: str = "PHOTFLAG",
                        bands: str = "gri", extra: list[str] | None = None,
                        tiebreak: str | None = "obs_id", max_points: int = 10_000,
                        max_rows: int = MAX_ROWS) -> DataFrame:
    """FN5 in bounded rows: one row per object, band and ``chunk`` (0-based, in
    time order) of at most ``max_points`` points. The arrays are those of
    ``band_features`` without the band in their names; put together chunk by
    chunk they are the whole curve's, since a chunk's first gap reaches back to
    the chunk before. ``median_delta_t`` and ``magobs`` are of the whole curve.
    Bands without points have no rows.

    Positions, gaps and medians come from the skew-safe helpers (curves of over
    ``max_rows`` points are cut into slices), so neither a band nor an object is
    ever one unbounded task or one value."""
    extra = extra or []
    order = [mjd] + ([tiebreak] if tiebreak else [])
    pts = phot.filter(F.col(band).isin(list(bands))).select(key, band, *order, flux, err, flag, *extra)
    top = group_max(pts, [key, band])
    r = (ranked(pts, [key, band], order, mjd, max_rows=max_rows, top=top)
         .withColumn("chunk", F.floor(F.col("__rank") / F.lit(max_points)).cast("int"))
         .withColumn("__dt", F.col(mjd) - F.col("__prev")))
    median = exact_median(r.filter(F.col("__dt").isNotNull()), [key, band], "__dt", "median_delta_t",
                          max_rows=max_rows, top=top)
    nested = (r.groupBy(key, band, "chunk")
              .agg(F.array_sort(F.collect_list(F.struct(*order, flux, err, flag, *extra, "__dt"))).alias("__pts")))
    p = F.col("__pts")
    kept = F.filter(p, lambda x: (mag_error(x[flux], x[err]) != 0) & (x[flag] != 0))
    out = nested.select(
        key, band, "chunk",
        kept.getField(mjd).alias("mjd"), kept.getField(flux).alias("fluxcal"),
        kept.getField(err).alias("fluxcalerr"), kept.getField(flag).alias("photflag"),
        F.transform(kept, lambda x: mag_from_flux(x[flux])).alias("mag"),
        F.transform(kept, lambda x: mag_error(x[flux], x[err])).alias("magerr"),
        F.transform(kept, lambda x: fractional_error(x[flux], x[err])).alias("snr"),
        F.filter(p.getField("__dt"), lambda x: x.isNotNull()).alias("delta_t"),
        *[p.getField(c).alias(c.lower()) for c in extra])
    return out.join(median, [key, band], "left").withColumn("magobs", F.col("median_delta_t"))
