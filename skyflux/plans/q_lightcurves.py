"""Registered queries: light-curve core and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyflux.functions.photometry import has_flag
from skyflux.operators import filters as flt
from skyflux.operators import lightcurves as lc
from skyflux.plans import bindings as B
from skyflux.plans.registry import query
from skyflux.plans.sql import PHOT_EV, TRUTH_EV, PHOT_RAW, ALERTS_EV, FORCED_EV, BULK_LI, with_
from skyflux.schemas import PHOTFLAG_DETECT, PHOTFLAG_SATURATE, PHOTFLAG_TRIGGER

PHOT_COLS = "SNID, obs_id, MJD, BAND, FLUXCAL, FLUXCALERR, PHOTFLAG"
PHOT_ROUND = ["MJD", "FLUXCAL", "FLUXCALERR"]


@query("truth_with_detection_counts", with_(PHOT_EV, TRUTH_EV) + """
SELECT t.SNID, t.ZCMB, t.GENTYPE, d.ndetect
FROM truth_ev t
JOIN (SELECT SNID, count(*) AS ndetect FROM phot_ev WHERE (PHOTFLAG & 4096) <> 0 GROUP BY SNID) d
  ON t.SNID = d.SNID
WHERE t.ZCMB >= 0.1 AND t.ZCMB < 0.5 AND d.ndetect > 20""", ["ZCMB"])
def q_truth_with_detection_counts(spark, d):
    """Flagship: objects with 0.1 <= z < 0.5 and more than 20 detections, with counts."""
    truth = flt.select_range(B.truth_ev(spark, d), "ZCMB", 0.1, 0.5)
    return (lc.truth_with_detection_counts(truth, B.phot_ev(spark, d))
            .filter(F.col("ndetect") > 20))


@query("has_flag_counts", with_(PHOT_EV) + """
SELECT BAND, count(*) FILTER (WHERE (PHOTFLAG & 1024) <> 0) AS n_saturated,
       count(*) FILTER (WHERE (PHOTFLAG & 2048) <> 0) AS n_trigger,
       count(*) FILTER (WHERE (PHOTFLAG & 4096) <> 0) AS n_detect,
       count(*) AS n_points
FROM phot_ev GROUP BY BAND""")
def q_has_flag_counts(spark, d):
    p = B.phot_ev(spark, d)
    return p.groupBy("BAND").agg(
        F.count(F.when(has_flag("PHOTFLAG", PHOTFLAG_SATURATE), 1)).alias("n_saturated"),
        F.count(F.when(has_flag("PHOTFLAG", PHOTFLAG_TRIGGER), 1)).alias("n_trigger"),
        F.count(F.when(has_flag("PHOTFLAG", PHOTFLAG_DETECT), 1)).alias("n_detect"),
        F.count(F.lit(1)).alias("n_points"))


@query("detections_only", with_(PHOT_EV) + f"""
SELECT {PHOT_COLS} FROM phot_ev WHERE (PHOTFLAG & 4096) <> 0""", PHOT_ROUND)
def q_detections_only(spark, d):
    return flt.detections_only(B.phot_ev(spark, d))


@query("select_range", with_(PHOT_EV) + f"""
SELECT {PHOT_COLS} FROM phot_ev WHERE MJD >= 60320 AND MJD < 60325""", PHOT_ROUND)
def q_select_range(spark, d):
    return flt.select_range(B.phot_ev(spark, d), "MJD", 60320, 60325)


@query("assign_object_ids", with_(PHOT_EV, PHOT_RAW) + """
SELECT SNID, file_num, row_idx, obs_id, MJD FROM phot_pos
UNION ALL
SELECT CAST(-999 AS BIGINT) AS SNID, file_num, CAST(PTROBS_MAX AS BIGINT) AS row_idx,
       CAST(NULL AS BIGINT) AS obs_id, CAST(-777 AS DOUBLE) AS MJD
FROM head_ev""", ["MJD"])
def q_assign_object_ids(spark, d):
    """JOIN1 over the pointer layout, separators kept as SNID -999."""
    raw, head = B.phot_files(spark, d)
    out = lc.assign_object_ids(raw, head, keep_separators=True)
    return out.select("SNID", "file_num", "row_idx", "obs_id", "MJD")


@query("drop_sentinels", with_(PHOT_EV, PHOT_RAW) + """
SELECT SNID, file_num, row_idx, obs_id, MJD FROM phot_pos""", ["MJD"])
def q_drop_sentinels(spark, d):
    raw, head = B.phot_files(spark, d)
    out = flt.drop_sentinels(lc.assign_object_ids(raw, head, keep_separators=True))
    return out.select("SNID", "file_num", "row_idx", "obs_id", "MJD")


@query("join_head", with_(PHOT_EV, PHOT_RAW) + """
SELECT p.SNID, p.obs_id, p.MJD, p.BAND, p.FLUXCAL, p.FLUXCALERR, p.PHOTFLAG,
       h.PTROBS_MIN, h.PTROBS_MAX, h.MJD_first AS MJD_right
FROM phot_ev p
JOIN (SELECT h.*, m.MJD_first FROM head_ev h
      JOIN (SELECT SNID, min(MJD) AS MJD_first FROM phot_ev GROUP BY SNID) m ON h.SNID = m.SNID) h
  ON p.SNID = h.SNID""", PHOT_ROUND + ["MJD_right"])
def q_join_head(spark, d):
    """JOIN2: HEAD carries its own MJD column, which arrives suffixed."""
    p = B.phot_ev(spark, d)
    _, head = B.phot_files(spark, d)
    first = p.groupBy("SNID").agg(F.min("MJD").alias("MJD"))
    return lc.join_head(p, head.join(first, "SNID"))


@query("join_truth", with_(PHOT_EV, TRUTH_EV) + f"""
SELECT p.*, t.ZCMB, t.GENTYPE FROM phot_ev p JOIN truth_ev t ON p.SNID = t.SNID""",
       PHOT_ROUND + ["ZCMB"])
def q_join_truth(spark, d):
    return lc.join_truth(B.phot_ev(spark, d), B.truth_ev(spark, d))


@query("detection_counts", with_(PHOT_EV) + """
SELECT SNID, count(*) AS ndetect FROM phot_ev WHERE (PHOTFLAG & 4096) <> 0 GROUP BY SNID""")
def q_detection_counts(spark, d):
    return lc.detection_counts(B.phot_ev(spark, d))


@query("nest_lightcurves", with_(PHOT_EV) + """
SELECT SNID, count(*) AS npts,
       string_agg(CAST(obs_id AS VARCHAR), ',' ORDER BY BAND, MJD, obs_id) AS obs_ids,
       string_agg(BAND, '' ORDER BY BAND, MJD, obs_id) AS bands,
       min(MJD) AS mjd_min, max(MJD) AS mjd_max
FROM phot_ev GROUP BY SNID""", ["mjd_min", "mjd_max"])
def q_nest_lightcurves(spark, d):
    """AGG1, shown as id/band strings in list order plus list sizes."""
    n = lc.nest_lightcurves(B.phot_ev(spark, d))
    return n.select("SNID", F.size("MJD").cast("long").alias("npts"),
                    F.array_join(F.col("obs_id").cast("array<string>"), ",").alias("obs_ids"),
                    F.array_join("BAND", "").alias("bands"),
                    F.array_min("MJD").alias("mjd_min"), F.array_max("MJD").alias("mjd_max"))


@query("nest_lightcurves_chunks", with_(PHOT_EV) + """
, r AS (SELECT *, CAST((row_number() OVER (PARTITION BY SNID ORDER BY BAND, MJD, obs_id) - 1) // 16 AS INTEGER) AS chunk FROM phot_ev)
SELECT SNID, chunk, count(*) AS npts,
       string_agg(CAST(obs_id AS VARCHAR), ',' ORDER BY BAND, MJD, obs_id) AS obs_ids,
       string_agg(BAND, '' ORDER BY BAND, MJD, obs_id) AS bands
FROM r GROUP BY SNID, chunk""".replace("\n, r AS", ",\nr AS", 1))
def q_nest_lightcurves_chunks(spark, d):
    """AGG1 in bounded rows: consecutive chunks of at most 16 points, none left out."""
    n = lc.nest_lightcurves(B.phot_ev(spark, d), max_points=16)
    return n.select("SNID", "chunk", F.size("MJD").cast("long").alias("npts"),
                    F.array_join(F.col("obs_id").cast("array<string>"), ",").alias("obs_ids"), F.array_join("BAND", "").alias("bands"))


@query("explode_lightcurves", with_(PHOT_EV) + f"SELECT {PHOT_COLS} FROM phot_ev", PHOT_ROUND)
def q_explode_lightcurves(spark, d):
    """AGG2: explode(nest(x)) == x."""
    n = lc.nest_lightcurves(B.phot_ev(spark, d))
    return lc.explode_lightcurves(n, ["obs_id", "MJD", "BAND", "FLUXCAL", "FLUXCALERR", "PHOTFLAG"])


@query("snr_detection_counts", with_(PHOT_EV) + """
SELECT SNID, count(*) FILTER (WHERE FLUXCAL / FLUXCALERR >= 5) AS ndets
FROM phot_ev GROUP BY SNID HAVING count(*) FILTER (WHERE FLUXCAL / FLUXCALERR >= 5) > 40""")
def q_snr_detection_counts(spark, d):
    n = lc.nest_lightcurves(B.phot_ev(spark, d))
    out = lc.snr_detection_counts(n, min_count=40)
    return out.select("SNID", F.col("ndets").cast("long").alias("ndets"))


@query("histogram", with_(TRUTH_EV) + """
, bins AS (SELECT CAST(i AS INTEGER) AS bin,
                 CAST(0 AS DOUBLE) + CAST(i AS DOUBLE) * CAST(0.1 AS DOUBLE) AS bin_lo,
                 CAST(0 AS DOUBLE) + CAST(i + 1 AS DOUBLE) * CAST(0.1 AS DOUBLE) AS bin_hi
          FROM range(0, 8) r(i))
SELECT b.bin, b.bin_lo, b.bin_hi, count(t.ZCMB) AS n
FROM bins b LEFT JOIN truth_ev t
  ON (t.ZCMB >= b.bin_lo AND t.ZCMB < b.bin_hi) OR (b.bin = 7 AND t.ZCMB = b.bin_hi)
GROUP BY b.bin, b.bin_lo, b.bin_hi""".replace("\n, bins", ",\nbins", 1), ["bin_lo", "bin_hi"])
def q_histogram(spark, d):
    """AGG5: ZCMB in 8 bins of 0.1 from 0 (values above 0.8 drop)."""
    return lc.histogram(B.truth_ev(spark, d), "ZCMB", 0.0, 0.8, 0.1)


@query("class_counts", with_(PHOT_EV, TRUTH_EV) + """
SELECT t.GENTYPE, count(DISTINCT p.SNID) AS n_objects, count(*) AS n_points
FROM phot_ev p JOIN truth_ev t ON p.SNID = t.SNID GROUP BY t.GENTYPE""")
def q_class_counts(spark, d):
    j = B.phot_ev(spark, d).join(B.truth_ev(spark, d), "SNID")
    return lc.class_counts(j, "GENTYPE", "SNID")


@query("table_bounds", with_(PHOT_EV) + """
SELECT min(MJD) AS min_MJD, max(MJD) AS max_MJD, min(FLUXCAL) AS min_FLUXCAL,
       max(FLUXCAL) AS max_FLUXCAL, min(SNID) AS min_SNID, max(SNID) AS max_SNID
FROM phot_ev""", ["min_MJD", "max_MJD", "min_FLUXCAL", "max_FLUXCAL"])
def q_table_bounds(spark, d):
    return lc.table_bounds(B.phot_ev(spark, d), ["MJD", "FLUXCAL", "SNID"])


@query("sort_lightcurves", with_(PHOT_EV) + f"""
SELECT {PHOT_COLS} FROM phot_ev ORDER BY SNID, BAND, MJD, obs_id""", PHOT_ROUND)
def q_sort_lightcurves(spark, d):
    return lc.sort_lightcurves(B.phot_ev(spark, d), ("SNID", "BAND", "MJD", "obs_id"))


@query("union_tables", with_(PHOT_EV) + f"""
SELECT {PHOT_COLS}, 'detected' AS part FROM phot_ev WHERE (PHOTFLAG & 4096) <> 0
UNION ALL
SELECT {PHOT_COLS}, 'forced' AS part FROM phot_ev WHERE (PHOTFLAG & 4096) = 0""", PHOT_ROUND)
def q_union_tables(spark, d):
    p = B.phot_ev(spark, d)
    det = p.filter(has_flag("PHOTFLAG", PHOTFLAG_DETECT)).withColumn("part", F.lit("detected"))
    rest = p.filter(~has_flag("PHOTFLAG", PHOTFLAG_DETECT)).withColumn("part", F.lit("forced"))
    return lc.union_tables(det, None, rest)


@query("merge_photometry", with_(PHOT_EV, ALERTS_EV, FORCED_EV) + """
, u AS (
  SELECT diaObjectId, midPointTai, filterName, psFlux, psFluxErr, 1 AS prio, 'source' AS kind
  FROM alerts_ev
  UNION ALL
  SELECT diaObjectId, midPointTai, filterName, psFlux, psFluxErr, 0 AS prio, 'forced' AS kind
  FROM forced_ev WHERE psFluxErr < 6)
SELECT diaObjectId, midPointTai, filterName, psFlux, psFluxErr, kind FROM (
  SELECT *, row_number() OVER (PARTITION BY diaObjectId, midPointTai, filterName
                               ORDER BY prio, psFlux, psFluxErr) AS rn FROM u) WHERE rn = 1
""".replace("\n, u AS", ",\nu AS", 1), ["midPointTai", "psFlux", "psFluxErr"])
def q_merge_photometry(spark, d):
    """SET3: forced points (only those with error < 6 exist here) win over detections."""
    forced = B.forced_ev(spark, d).filter(F.col("psFluxErr") < 6)
    return lc.merge_photometry(B.sources_ev(spark, d), forced,
                               cols=["psFlux", "psFluxErr"])


@query("list_mask", with_(PHOT_EV) + """
SELECT SNID, count(*) FILTER (WHERE FLUXCAL / FLUXCALERR >= 10) AS n_kept,
       coalesce(string_agg(CAST(obs_id AS VARCHAR), ',' ORDER BY BAND, MJD, obs_id)
                FILTER (WHERE FLUXCAL / FLUXCALERR >= 10), '') AS kept_ids
FROM phot_ev GROUP BY SNID""")
def q_list_mask(spark, d):
    """FN19: keep list elements with S/N >= 10, lists stay aligned."""
    n = lc.nest_lightcurves(B.phot_ev(spark, d))
    cols = ["BAND", "MJD", "obs_id", "FLUXCAL", "FLUXCALERR", "PHOTFLAG"]
    m = lc.list_mask(n, cols, lambda x: x["FLUXCAL"] / x["FLUXCALERR"] >= 10)
    return m.select("SNID", F.size("obs_id").cast("long").alias("n_kept"),
                    F.array_join(F.col("obs_id").cast("array<string>"), ",").alias("kept_ids"))


@query("lightcurve", with_(PHOT_EV) + f"SELECT {PHOT_COLS} FROM phot_ev WHERE SNID = 7", PHOT_ROUND)
def q_lightcurve(spark, d):
    """SRC5: point lookup of one object, checked against HEAD."""
    _, head = B.phot_files(spark, d)
    return lc.lightcurve(B.phot_ev(spark, d), head, 7)


@query("crop_to_detections", with_(PHOT_EV) + f"""
, b AS (SELECT SNID, min(MJD) AS lo, max(MJD) AS hi FROM phot_ev
        WHERE (PHOTFLAG & 4096) <> 0 GROUP BY SNID)
SELECT p.SNID, p.obs_id, p.MJD, p.BAND, p.FLUXCAL, p.FLUXCALERR, p.PHOTFLAG
FROM phot_ev p JOIN b ON p.SNID = b.SNID
WHERE p.MJD >= b.lo - 2.0 AND p.MJD <= b.hi + 2.0""".replace("\n, b AS", ",\nb AS", 1), PHOT_ROUND)
def q_crop_to_detections(spark, d):
    return flt.crop_to_detections(B.phot_ev(spark, d), before=2.0, after=2.0)


@query("nan_to_null", with_(TRUTH_EV) + """
SELECT SNID, CASE WHEN ZCMB < CAST(1000 AS DOUBLE) / CAST(11000 AS DOUBLE) THEN NULL ELSE ZCMB END AS ZCMB,
       GENTYPE FROM truth_ev""", ["ZCMB"])
def q_nan_to_null(spark, d):
    """FLT5: negative balances are written as NaN, then NaN -> NULL."""
    t = B.truth_ev(spark, d)
    t = t.withColumn("ZCMB", F.when(F.col("ZCMB") < F.lit(1000.0 / 11000.0), F.lit(float("nan")))
                     .otherwise(F.col("ZCMB")))
    return flt.nan_to_null(t)


@query("drop_uninformative", with_(PHOT_EV) + "SELECT SNID, obs_id, MJD, BAND, FLUXCAL FROM phot_ev",
       ["MJD", "FLUXCAL"])
def q_drop_uninformative(spark, d):
    return flt.drop_uninformative(B.phot_ev(spark, d), ["FLUXCALERR", "PHOTFLAG", "NOT_THERE"])


@query("cut_windows", with_(PHOT_EV, TRUTH_EV) + """
SELECT n.SNID, n.NOBS, t.ZCMB
FROM (SELECT SNID, count(*) AS NOBS FROM phot_ev
      WHERE (PHOTFLAG & 1024) = 0 AND BAND IN ('g', 'r', 'i') GROUP BY SNID) n
JOIN truth_ev t ON n.SNID = t.SNID
WHERE n.NOBS >= 10 AND t.ZCMB >= 0.05 AND t.ZCMB <= 0.95""", ["ZCMB"])
def q_cut_windows(spark, d):
    """FLT8: NOBS (unsaturated, bands g r i) >= 10 and 0.05 <= ZCMB <= 0.95."""
    nobs = flt.count_unsaturated(B.phot_ev(spark, d), bands=["g", "r", "i"])
    objs = nobs.join(B.truth_ev(spark, d).select("SNID", "ZCMB"), "SNID")
    return flt.cut_windows(objs, {"NOBS": (10, None), "ZCMB": (0.05, 0.95)})


@query("unknown_bands", with_(BULK_LI) + """
SELECT DISTINCT BAND FROM bulk_li WHERE BAND NOT IN ('u', 'g', 'r', 'i', 'z', 'Y')""")
def q_unknown_bands(spark, d):
    """FLT9: bands of the bulk table missing from the band dimension."""
    return flt.unknown_bands(B.bulk_li(spark, d))


@query("bulk_nest_lightcurves", with_(BULK_LI) + """
SELECT SNID, count(*) AS npts,
       count(*) FILTER (WHERE FLUXCAL / FLUXCALERR >= 5) AS ndets,
       string_agg(CAST(obs_id AS VARCHAR), ',' ORDER BY BAND, MJD, FLUXCAL, FLUXCALERR, PHOTFLAG, obs_id) AS obs_ids
FROM bulk_li GROUP BY SNID""")
def q_bulk_nest_lightcurves(spark, d):
    """AGG1 + AGG4 at bench size (lineitem as photometry; full-row order)."""
    n = lc.nest_lightcurves(B.bulk_li(spark, d))
    n = lc.snr_detection_counts(n)
    return n.select("SNID", F.size("MJD").cast("long").alias("npts"), F.col("ndets").cast("long").alias("ndets"),
                    F.array_join(F.col("obs_id").cast("array<string>"), ",").alias("obs_ids"))


@query("bulk_detection_counts", with_(BULK_LI, TRUTH_EV) + """
SELECT o.o_custkey AS SNID_cust, count(*) AS n_points, count(DISTINCT b.SNID) AS n_orders,
       count(*) FILTER (WHERE b.FLUXCAL / b.FLUXCALERR >= 5000) AS n_bright
FROM bulk_li b JOIN orders o ON b.SNID = o.o_orderkey GROUP BY o.o_custkey""")
def q_bulk_detection_counts(spark, d):
    """Bench-size fact-to-fact join (lineitem x orders) with aggregation per customer."""
    b = B.bulk_li(spark, d)
    o = B.table(spark, d, "orders").select(F.col("o_orderkey").alias("SNID"), F.col("o_custkey").alias("SNID_cust"))
    j = b.join(o, "SNID")
    return j.groupBy("SNID_cust").agg(F.count(F.lit(1)).alias("n_points"), F.countDistinct("SNID").alias("n_orders"),
                                      F.count(F.when(F.col("FLUXCAL") / F.col("FLUXCALERR") >= 5000, 1)).alias("n_bright"))


@query("sample_objects", with_(PHOT_EV) + """
SELECT SNID FROM (SELECT DISTINCT SNID FROM phot_ev) ORDER BY md5(CAST(SNID AS VARCHAR) || '|42'), SNID LIMIT 3""")
def q_sample_objects(spark, d):
    """ORD3: three objects picked by a seeded hash."""
    return lc.sample_objects(B.phot_ev(spark, d), "SNID", seed=42, k=3)


@query("head", with_(TRUTH_EV) + "SELECT SNID, ZCMB, GENTYPE FROM truth_ev ORDER BY SNID LIMIT 5", ["ZCMB"])
def q_head(spark, d):
    """ORD4: the first five objects by id."""
    return lc.head(B.truth_ev(spark, d), "SNID", 5)


@query("strip_pad_ids", """
SELECT o_orderkey AS simulation_id, CAST(o_custkey AS BIGINT) AS SNID,
       printf('%04d', CAST(o_custkey % 40 + 1 AS BIGINT)) AS file_num
FROM orders""")
def q_strip_pad_ids(spark, d):
    """FN17: 'GAL<id>' -> id, and zero-padded file numbers."""
    from skyflux.functions.ids import pad_num, strip_id
    s = B.sim_inspiral(spark, d).select("simulation_id", "source")
    return s.select("simulation_id", strip_id("source").alias("SNID"),
                    pad_num(strip_id("source") % 40 + 1, 4).alias("file_num"))


@query("apply_converters", with_(PHOT_EV) + """
SELECT obs_id, CASE WHEN BAND = 'g' THEN NULL ELSE PHOTFLAG END AS PHOTFLAG, upper(BAND) AS BAND
FROM phot_ev""")
def q_apply_converters(spark, d):
    """UDF5: text columns converted per column ('' -> NULL, type names, functions)."""
    from skyflux.sources.text import apply_converters
    p = B.phot_ev(spark, d).select(
        "obs_id", F.when(F.col("BAND") == "g", F.lit("")).otherwise(F.col("PHOTFLAG").cast("string")).alias("PHOTFLAG"),
        "BAND")
    out = apply_converters(p, {"PHOTFLAG": "int", "BAND": lambda c: F.upper(c)})
    return out.select("obs_id", F.col("PHOTFLAG").cast("int").alias("PHOTFLAG"), "BAND")


@query("class_lightcurves", with_(PHOT_EV, PHOT_RAW, TRUTH_EV) + """
SELECT p.SNID, count(*) AS npts, min(p.MJD) AS mjd_first, any_value(h.PTROBS_MIN) AS PTROBS_MIN,
       any_value(t.ZCMB) AS ZCMB, any_value(h.PTROBS_MAX) AS PEAKMJD, any_value(t.GENTYPE) AS PEAKMJD_right
FROM phot_pos p JOIN head_ev h ON p.SNID = h.SNID JOIN truth_ev t ON t.SNID = p.SNID
WHERE p.file_num = (SELECT min(file_num) FROM phot_pos) GROUP BY p.SNID""", ["mjd_first", "ZCMB"])
def q_class_lightcurves(spark, d):
    """The whole reader: one file's curves, one row per object, with HEAD and
    truth joined; both have a column PEAKMJD, so truth's gets the suffix."""
    raw, head = B.phot_files(spark, d)
    first = head.agg(F.min("file_num")).first()[0]
    truth = B.truth_ev(spark, d).withColumn("PEAKMJD", F.col("GENTYPE"))
    out = lc.class_lightcurves(raw, head.withColumn("PEAKMJD", F.col("PTROBS_MAX")), truth, file_num=first, agg=True,
                               include_header=True, include_truth=True)
    return out.select("SNID", F.size("MJD").cast("long").alias("npts"), F.array_min("MJD").alias("mjd_first"), "PTROBS_MIN",
                      "ZCMB", "PEAKMJD", "PEAKMJD_right")


@query("class_lightcurves_all", with_(PHOT_EV, PHOT_RAW, TRUTH_EV) + """
SELECT p.SNID, count(*) AS npts, min(p.MJD) AS mjd_first, any_value(h.PTROBS_MIN) AS PTROBS_MIN,
       any_value(t.ZCMB) AS ZCMB, any_value(h.PTROBS_MAX) AS PEAKMJD, any_value(t.GENTYPE) AS PEAKMJD_right
FROM phot_pos p JOIN head_ev h ON p.SNID = h.SNID JOIN truth_ev t ON t.SNID = p.SNID GROUP BY p.SNID""", ["mjd_first", "ZCMB"])
def q_class_lightcurves_all(spark, d):
    """The whole reader over every file of the class."""
    raw, head = B.phot_files(spark, d)
    truth = B.truth_ev(spark, d).withColumn("PEAKMJD", F.col("GENTYPE"))
    out = lc.class_lightcurves(raw, head.withColumn("PEAKMJD", F.col("PTROBS_MAX")), truth, agg=True,
                               include_header=True, include_truth=True)
    return out.select("SNID", F.size("MJD").cast("long").alias("npts"), F.array_min("MJD").alias("mjd_first"), "PTROBS_MIN",
                      "ZCMB", "PEAKMJD", "PEAKMJD_right")
