"""Registered queries: photometric features."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyflux.functions import photometry as ph
from skyflux.operators import features as fe
from skyflux.operators import filters as flt
from skyflux.plans import bindings as B
from skyflux.plans.registry import query
from skyflux.plans.sql import PHOT_EV, TRUTH_EV, with_


@query("photometry_columns", with_(PHOT_EV) + """
SELECT SNID, obs_id,
       -2.5 * log10(abs(FLUXCAL)) + 27.5 AS mag,
       FLUXCALERR / abs(FLUXCAL) AS fracerr,
       least(1.086 * (FLUXCALERR / abs(FLUXCAL)), 0.5) AS magerr,
       FLUXCAL / FLUXCALERR AS snr
FROM phot_ev""", ["mag", "fracerr", "magerr", "snr"])
def q_photometry_columns(spark, d):
    """FN1-FN4 on every point."""
    p = B.phot_ev(spark, d)
    return p.select("SNID", "obs_id",
                    ph.mag_from_flux("FLUXCAL").alias("mag"),
                    ph.fractional_error("FLUXCAL", "FLUXCALERR").alias("fracerr"),
                    ph.mag_error("FLUXCAL", "FLUXCALERR").alias("magerr"),
                    ph.snr("FLUXCAL", "FLUXCALERR").alias("snr"))


@query("one_hot_label", with_(TRUTH_EV) + """
SELECT SNID, CAST(GENTYPE = 0 AS INTEGER) AS SNIa_True FROM truth_ev""")
def q_one_hot_label(spark, d):
    """AGG19: boolean label as 0/1."""
    t = B.truth_ev(spark, d)
    return t.select("SNID", ph.one_hot_label("GENTYPE", 0).alias("SNIa_True"))


@query("delta_t", with_(PHOT_EV) + """
SELECT SNID, obs_id, BAND, MJD,
       MJD - lag(MJD) OVER (PARTITION BY SNID, BAND ORDER BY MJD, obs_id) AS delta_t
FROM phot_ev""", ["MJD", "delta_t"])
def q_delta_t(spark, d):
    return fe.delta_t(B.phot_ev(spark, d)).select("SNID", "obs_id", "BAND", "MJD", "delta_t")


@query("cadence_median", with_(PHOT_EV) + """
SELECT SNID, BAND, median(dt) AS median_delta_t FROM (
  SELECT SNID, BAND, MJD - lag(MJD) OVER (PARTITION BY SNID, BAND ORDER BY MJD, obs_id) AS dt
  FROM phot_ev) WHERE dt IS NOT NULL GROUP BY SNID, BAND""", ["median_delta_t"])
def q_cadence_median(spark, d):
    return fe.cadence_median(B.phot_ev(spark, d))


@query("first_trigger", with_(PHOT_EV) + """
SELECT SNID, min(MJD) FILTER (WHERE (PHOTFLAG & 2048) <> 0) AS MJD_TRIGGER,
       min(MJD) FILTER (WHERE (PHOTFLAG & 4096) <> 0) AS MJD_DETECT_FIRST,
       max(MJD) FILTER (WHERE (PHOTFLAG & 4096) <> 0) AS MJD_DETECT_LAST
FROM phot_ev GROUP BY SNID""", ["MJD_TRIGGER", "MJD_DETECT_FIRST", "MJD_DETECT_LAST"])
def q_first_trigger(spark, d):
    return fe.first_trigger(B.phot_ev(spark, d))


@query("trigger_after_two", with_(PHOT_EV) + """
, det AS (SELECT SNID, MJD FROM phot_ev WHERE (PHOTFLAG & 4096) <> 0),
f AS (SELECT SNID, min(MJD) AS first_mjd FROM det GROUP BY SNID)
SELECT det.SNID, min(det.MJD) AS MJD_TRIGGER2, min(f.first_mjd) AS MJD_DETECT_FIRST
FROM det JOIN f ON det.SNID = f.SNID
WHERE det.MJD >= f.first_mjd + 0.021 GROUP BY det.SNID""".replace("\n, det AS", ",\ndet AS", 1),
       ["MJD_TRIGGER2", "MJD_DETECT_FIRST"])
def q_trigger_after_two(spark, d):
    return fe.trigger_after_two(B.phot_ev(spark, d), gap=0.021)


_SUMMARY_SQL = with_(PHOT_EV) + """
, pb AS (
  SELECT SNID, BAND, count(*) AS n, count(*) FILTER (WHERE (PHOTFLAG & 1024) <> 0) AS nsat,
         min(MJD) FILTER (WHERE (PHOTFLAG & 4096) <> 0) AS dfirst,
         max(MJD) FILTER (WHERE (PHOTFLAG & 4096) <> 0) AS dlast,
         max(FLUXCAL) AS fmax, max(FLUXCAL / FLUXCALERR) AS snrmax
  FROM phot_ev GROUP BY SNID, BAND),
pk AS (
  SELECT SNID, MJD AS PEAKMJD FROM (
    SELECT SNID, MJD, row_number() OVER (PARTITION BY SNID ORDER BY FLUXCAL DESC, MJD, obs_id) AS rn
    FROM phot_ev) WHERE rn = 1),
sn AS (
  SELECT SNID, snrmax, row_number() OVER (PARTITION BY SNID ORDER BY snrmax DESC) AS r FROM pb)
SELECT a.SNID, a.NOBS, a.NOBS_SATURATE, a.MJD_DETECT_FIRST, a.MJD_DETECT_LAST, pk.PEAKMJD,
       a.PEAKMAG_u, a.PEAKMAG_g, a.PEAKMAG_r, a.PEAKMAG_i, a.PEAKMAG_z, a.PEAKMAG_Y,
       s1.snrmax AS SNRMAX, s2.snrmax AS SNRMAX2, s3.snrmax AS SNRMAX3
FROM (SELECT SNID, CAST(sum(n) AS BIGINT) AS NOBS, CAST(sum(nsat) AS BIGINT) AS NOBS_SATURATE,
             min(dfirst) AS MJD_DETECT_FIRST, max(dlast) AS MJD_DETECT_LAST,
             max(CASE WHEN BAND = 'u' THEN -2.5 * log10(abs(fmax)) + 27.5 END) AS PEAKMAG_u,
             max(CASE WHEN BAND = 'g' THEN -2.5 * log10(abs(fmax)) + 27.5 END) AS PEAKMAG_g,
             max(CASE WHEN BAND = 'r' THEN -2.5 * log10(abs(fmax)) + 27.5 END) AS PEAKMAG_r,
             max(CASE WHEN BAND = 'i' THEN -2.5 * log10(abs(fmax)) + 27.5 END) AS PEAKMAG_i,
             max(CASE WHEN BAND = 'z' THEN -2.5 * log10(abs(fmax)) + 27.5 END) AS PEAKMAG_z,
             max(CASE WHEN BAND = 'Y' THEN -2.5 * log10(abs(fmax)) + 27.5 END) AS PEAKMAG_Y
      FROM pb GROUP BY SNID) a
JOIN pk ON a.SNID = pk.SNID
LEFT JOIN sn s1 ON a.SNID = s1.SNID AND s1.r = 1
LEFT JOIN sn s2 ON a.SNID = s2.SNID AND s2.r = 2
LEFT JOIN sn s3 ON a.SNID = s3.SNID AND s3.r = 3""".replace("\n, pb AS", ",\npb AS", 1)


@query("object_summary", _SUMMARY_SQL,
       ["MJD_DETECT_FIRST", "MJD_DETECT_LAST", "PEAKMJD", "PEAKMAG_u", "PEAKMAG_g", "PEAKMAG_r",
        "PEAKMAG_i", "PEAKMAG_z", "PEAKMAG_Y", "SNRMAX", "SNRMAX2", "SNRMAX3"])
def q_object_summary(spark, d):
    return fe.object_summary(B.phot_ev(spark, d))


_BF_SQL = with_(PHOT_EV) + """
, pts AS (
  SELECT SNID, BAND, MJD, obs_id, FLUXCAL, FLUXCALERR, PHOTFLAG,
         MJD - lag(MJD) OVER (PARTITION BY SNID, BAND ORDER BY MJD, obs_id) AS dt,
         row_number() OVER (PARTITION BY SNID, BAND,
                            (least(1.086 * (FLUXCALERR / abs(FLUXCAL)), 0.5) <> 0 AND PHOTFLAG <> 0)
                            ORDER BY MJD, obs_id) AS rk
  FROM phot_ev WHERE BAND IN ('g', 'r', 'i')),
pb AS (
  SELECT SNID, BAND,
         count(*) FILTER (WHERE least(1.086 * (FLUXCALERR / abs(FLUXCAL)), 0.5) <> 0 AND PHOTFLAG <> 0) AS n,
         median(dt) AS med,
         max(-2.5 * log10(abs(FLUXCAL)) + 27.5) FILTER (
           WHERE rk = 1 AND least(1.086 * (FLUXCALERR / abs(FLUXCAL)), 0.5) <> 0 AND PHOTFLAG <> 0) AS mag1
  FROM pts GROUP BY SNID, BAND)
SELECT o.SNID,
       coalesce(g.n, 0) AS n_g, g.med AS median_delta_t_g, g.mag1 AS first_mag_g,
       coalesce(r.n, 0) AS n_r, r.med AS median_delta_t_r, r.mag1 AS first_mag_r,
       coalesce(i.n, 0) AS n_i, i.med AS median_delta_t_i, i.mag1 AS first_mag_i
FROM (SELECT DISTINCT SNID FROM phot_ev) o
LEFT JOIN pb g ON o.SNID = g.SNID AND g.BAND = 'g'
LEFT JOIN pb r ON o.SNID = r.SNID AND r.BAND = 'r'
LEFT JOIN pb i ON o.SNID = i.SNID AND i.BAND = 'i'""".replace("\n, pts AS", ",\npts AS", 1)


@query("band_features", _BF_SQL,
       [f"{c}_{b}" for b in "gri" for c in ("median_delta_t", "first_mag")])
def q_band_features(spark, d):
    """FN5: per-band arrays, shown as kept counts, cadence medians and first magnitude."""
    bf = fe.band_features(B.phot_ev(spark, d))
    cols = ["SNID"]
    for b in "gri":
        cols += [F.size(f"mjd_{b}").cast("long").alias(f"n_{b}"),
                 F.col(f"median_delta_t_{b}"),
                 F.element_at(f"mag_{b}", 1).alias(f"first_mag_{b}")]
    return bf.select(*cols)


_ALL = ["mjd", "fluxcal", "fluxcalerr", "photflag", "mag", "magerr", "snr", "delta_t", "value2"]


@query("band_features_all", with_(PHOT_EV) + """
, pts AS (
  SELECT SNID, BAND, MJD, FLUXCAL, FLUXCALERR, PHOTFLAG, MJD - lag(MJD) OVER (PARTITION BY SNID, BAND ORDER BY MJD, obs_id) AS dt,
         least(1.086 * (FLUXCALERR / abs(FLUXCAL)), 0.5) <> 0 AND PHOTFLAG <> 0 AS keep
  FROM phot_ev WHERE BAND IN ('g', 'r', 'i')),
o AS (SELECT DISTINCT SNID FROM phot_ev),
b AS (SELECT * FROM o CROSS JOIN (VALUES ('g'), ('r'), ('i')) v(BAND))
SELECT b.SNID, b.BAND AS band, coalesce(sum(MJD) FILTER (keep), 0) AS mjd, coalesce(sum(FLUXCAL) FILTER (keep), 0) AS fluxcal,
       coalesce(sum(FLUXCALERR) FILTER (keep), 0) AS fluxcalerr, CAST(coalesce(sum(PHOTFLAG) FILTER (keep), 0) AS DOUBLE) AS photflag,
       coalesce(sum(-2.5 * log10(abs(FLUXCAL)) + 27.5) FILTER (keep), 0) AS mag,
       coalesce(sum(least(1.086 * (FLUXCALERR / abs(FLUXCAL)), 0.5)) FILTER (keep), 0) AS magerr,
       coalesce(sum(FLUXCALERR / abs(FLUXCAL)) FILTER (keep), 0) AS snr, coalesce(sum(dt), 0) AS delta_t,
       coalesce(sum(FLUXCAL * 2), 0) AS value2, median(dt) AS median_delta_t, median(dt) AS magobs
FROM b LEFT JOIN pts p ON p.SNID = b.SNID AND p.BAND = b.BAND GROUP BY b.SNID, b.BAND""".replace("\n, pts AS", ",\npts AS", 1),
       [*_ALL, "median_delta_t", "magobs"])
def q_band_features_all(spark, d):
    """FN5: every column of every band, arrays shown as their sums; with an extra column."""
    bf = fe.band_features(B.phot_ev(spark, d).withColumn("VALUE2", F.col("FLUXCAL") * 2), extra=["VALUE2"])
    total = lambda c: F.aggregate(F.coalesce(F.col(c).cast("array<double>"), F.array().cast("array<double>")),
                                  F.lit(0.0), lambda s, x: s + x)
    row = lambda b: F.struct(F.lit(b).alias("band"), *[total(f"{c}_{b}").alias(c) for c in _ALL],
                             F.col(f"median_delta_t_{b}").alias("median_delta_t"), F.col(f"magobs_{b}").alias("magobs"))
    return bf.select("SNID", F.explode(F.array(*[row(b) for b in "gri"])).alias("r")).select("SNID", "r.*")


@query("peakmag_cut", with_(PHOT_EV) + """
, pb AS (SELECT SNID, BAND, -2.5 * log10(abs(max(FLUXCAL))) + 27.5 AS mag FROM phot_ev
         WHERE BAND IN ('g', 'r', 'i') GROUP BY SNID, BAND),
bad AS (SELECT DISTINCT SNID FROM pb WHERE mag < 14 OR mag > 22.5)
SELECT o.SNID, o.NOBS FROM (SELECT SNID, count(*) AS NOBS FROM phot_ev GROUP BY SNID) o
WHERE o.NOBS >= 10 AND NOT EXISTS (SELECT 1 FROM bad WHERE bad.SNID = o.SNID)""".replace("\n, pb AS", ",\npb AS", 1))
def q_peakmag_cut(spark, d):
    """FLT8 on the object summary: NOBS >= 10 and peak magnitude in [14, 22.5]
    in every observed band of g, r, i."""
    s = fe.object_summary(B.phot_ev(spark, d))
    cut = flt.cut_windows(s, {"PEAKMAG_g": (14, 22.5), "PEAKMAG_r": (14, 22.5), "PEAKMAG_i": (14, 22.5)},
                          allow_null=True)
    return flt.cut_windows(cut, {"NOBS": (10, None)}).select("SNID", "NOBS")


@query("band_features_chunks", with_(PHOT_EV) + """
, pts AS (
  SELECT SNID, BAND, MJD, FLUXCAL, FLUXCALERR, PHOTFLAG, MJD - lag(MJD) OVER w AS dt,
         CAST((row_number() OVER w - 1) // 8 AS INTEGER) AS chunk,
         least(1.086 * (FLUXCALERR / abs(FLUXCAL)), 0.5) <> 0 AND PHOTFLAG <> 0 AS keep
  FROM phot_ev WHERE BAND IN ('g', 'r', 'i') WINDOW w AS (PARTITION BY SNID, BAND ORDER BY MJD, obs_id)),
med AS (SELECT SNID, BAND, median(dt) AS m FROM pts GROUP BY SNID, BAND)
SELECT p.SNID, p.BAND, p.chunk, count(*) FILTER (keep) AS n_kept, count(dt) AS n_gaps,
       coalesce(sum(MJD) FILTER (keep), 0) AS mjd, coalesce(sum(FLUXCAL) FILTER (keep), 0) AS fluxcal,
       coalesce(sum(-2.5 * log10(abs(FLUXCAL)) + 27.5) FILTER (keep), 0) AS mag,
       coalesce(sum(FLUXCALERR / abs(FLUXCAL)) FILTER (keep), 0) AS snr, coalesce(sum(dt), 0) AS delta_t,
       any_value(m) AS median_delta_t
FROM pts p JOIN med ON med.SNID = p.SNID AND med.BAND = p.BAND GROUP BY p.SNID, p.BAND, p.chunk""".replace("\n, pts AS", ",\npts AS", 1),
       ["mjd", "fluxcal", "mag", "snr", "delta_t", "median_delta_t"])
def q_band_features_chunks(spark, d):
    """FN5 in rows of at most 8 points: sizes and sums of each chunk's arrays."""
    bf = fe.band_feature_chunks(B.phot_ev(spark, d), max_points=8)
    total = lambda c: F.aggregate(F.col(c).cast("array<double>"), F.lit(0.0), lambda s, x: s + x).alias(c)
    return bf.select("SNID", "BAND", "chunk", F.size("mjd").cast("long").alias("n_kept"), F.size("delta_t").cast("long").alias("n_gaps"),
                     *[total(c) for c in ("mjd", "fluxcal", "mag", "snr", "delta_t")], "median_delta_t")
