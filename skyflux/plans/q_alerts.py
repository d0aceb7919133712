"""Registered queries: alert packaging, replay bookkeeping, loading."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyflux.functions.photometry import has_flag
from skyflux.operators import alerts as al
from skyflux.operators import loading as ld
from skyflux.plans import bindings as B
from skyflux.plans.registry import query
from skyflux.plans.sql import ALERTS_EV, FORCED_EV, PHOT_EV, SKY_OBJECTS, with_
from skyflux.schemas import PHOTFLAG_DETECT

_ALERTS_SQL = with_(PHOT_EV, ALERTS_EV, FORCED_EV, SKY_OBJECTS) + """
, s AS (
  SELECT a.*,
         count(*) OVER w - 1 AS n_prv_all,
         string_agg(CAST(diaSourceId AS VARCHAR), ',') OVER w1 AS prv_ids,
         min(midPointTai) OVER (PARTITION BY diaObjectId) AS first_det
  FROM alerts_ev a
  WINDOW w AS (PARTITION BY diaObjectId ORDER BY midPointTai, diaSourceId
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         w1 AS (PARTITION BY diaObjectId ORDER BY midPointTai, diaSourceId
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (
  SELECT s.alertId, count(*) AS n_forced, min(fe.midPointTai) AS forced_first,
         max(fe.midPointTai) AS forced_last
  FROM s JOIN forced_ev fe ON fe.diaObjectId = s.diaObjectId
  WHERE s.midPointTai - s.first_det >= 1.0
    AND fe.midPointTai >= s.first_det - 30.0 AND fe.midPointTai <= s.midPointTai
  GROUP BY s.alertId)
SELECT s.alertId, s.diaObjectId, s.n_prv_all AS n_prv, coalesce(s.prv_ids, '') AS prv_ids,
       f.n_forced, f.forced_first, f.forced_last, o.objectId IS NOT NULL AS has_object
FROM s LEFT JOIN f ON s.alertId = f.alertId
LEFT JOIN sky_objects o ON o.objectId = s.diaObjectId""".replace("\n, s AS", ",\ns AS", 1)


@query("build_alerts", _ALERTS_SQL, ["forced_first", "forced_last"])
def q_build_alerts(spark, d):
    """JOIN17: alerts with source history and forced photometry (30 d lookback,
    objects at least 1 d old), shown as sizes, id lists and time bounds."""
    objs = B.sky_objects(spark, d).withColumnRenamed("objectId", "diaObjectId")
    a = al.build_alerts(B.sources_ev(spark, d), B.forced_ev(spark, d), objs)
    fm = F.col("prvDiaForcedSources")
    return a.select(
        "alertId", F.col("diaSource.diaObjectId").alias("diaObjectId"),
        F.size("prvDiaSources").cast("long").alias("n_prv"),
        F.array_join(F.transform("prvDiaSources", lambda x: x["diaSourceId"].cast("string")), ",").alias("prv_ids"),
        F.when(fm.isNotNull(), F.size(fm).cast("long")).alias("n_forced"),
        F.array_min(fm["midPointTai"]).alias("forced_first"),
        F.array_max(fm["midPointTai"]).alias("forced_last"),
        F.col("diaObject").isNotNull().alias("has_object"))


@query("alert_history", with_(PHOT_EV, ALERTS_EV) + """
SELECT diaSourceId,
       count(*) OVER w - 1 AS n_prv,
       coalesce(string_agg(CAST(diaSourceId AS VARCHAR), ',') OVER w1, '') AS prv_ids
FROM alerts_ev
WINDOW w AS (PARTITION BY diaObjectId ORDER BY midPointTai, diaSourceId
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       w1 AS (PARTITION BY diaObjectId ORDER BY midPointTai, diaSourceId
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def q_alert_history(spark, d):
    h = al.alert_history(B.sources_ev(spark, d))
    return h.select("diaSourceId", F.size("prvDiaSources").cast("long").alias("n_prv"),
                    F.array_join(F.transform("prvDiaSources", lambda x: x["diaSourceId"].cast("string")), ",")
                    .alias("prv_ids"))


@query("nightly_stats", with_(PHOT_EV, ALERTS_EV) + """
SELECT CAST(floor(midPointTai) AS INTEGER) AS night, count(*) AS n_alerts,
       CAST(sum(length(CAST(alertId AS VARCHAR) || ',' || CAST(diaObjectId AS VARCHAR) || ',' || filterName)) AS BIGINT) AS n_bytes
FROM alerts_ev GROUP BY ROLLUP (CAST(floor(midPointTai) AS INTEGER))""")
def q_nightly_stats(spark, d):
    """AGG8: alerts and payload bytes per night plus the campaign total (night NULL)."""
    a = B.alerts_ev(spark, d)
    a = a.withColumn("payload", F.concat_ws(",", "alertId", "diaObjectId", "filterName"))
    return al.nightly_stats(a)


@query("exposure_batches", with_(PHOT_EV, ALERTS_EV) + """
SELECT floor(midPointTai * 24) / 24 AS exposure, count(*) AS n_alerts,
       min(alertId) AS first_alertId, max(alertId) AS last_alertId
FROM alerts_ev GROUP BY floor(midPointTai * 24) / 24""", ["exposure"])
def q_exposure_batches(spark, d):
    """AGG9: hourly exposures."""
    a = B.alerts_ev(spark, d).withColumn("exposure", F.floor(F.col("midPointTai") * 24) / 24)
    return al.exposure_batches(a)


@query("exposure_alert_ids", with_(PHOT_EV, ALERTS_EV) + """
SELECT exposure, batch, count(*) AS n_alerts, min(alertId) AS first_alertId, max(alertId) AS last_alertId,
       string_agg(CAST(alertId AS VARCHAR), ',' ORDER BY alertId) AS alertIds
FROM (SELECT floor(midPointTai * 24) / 24 AS exposure, alertId,
             (row_number() OVER (PARTITION BY floor(midPointTai * 24) / 24 ORDER BY alertId) - 1) // 3 AS batch
      FROM alerts_ev)
GROUP BY exposure, batch""", ["exposure"])
def q_exposure_alert_ids(spark, d):
    """AGG9 with ids: hourly exposures, ids in batches of at most 3."""
    a = B.alerts_ev(spark, d).withColumn("exposure", F.floor(F.col("midPointTai") * 24) / 24)
    out = al.exposure_batches(a, with_ids=True, max_ids=3)
    return out.withColumn("alertIds", F.array_join(F.col("alertIds").cast("array<string>"), ","))


@query("alerts_in_time_order", with_(PHOT_EV, ALERTS_EV) + """
SELECT alertId, midPointTai FROM alerts_ev ORDER BY midPointTai, alertId""", ["midPointTai"])
def q_alerts_in_time_order(spark, d):
    return al.alerts_in_time_order(B.alerts_ev(spark, d).select("alertId", "midPointTai"))


@query("night_range", with_(PHOT_EV) + """
, b AS (SELECT CAST(min(floor(MJD)) AS BIGINT) AS f0, CAST(max(floor(MJD)) AS BIGINT) AS f1 FROM phot_ev),
days AS (SELECT DISTINCT CAST(floor(MJD) AS BIGINT) - f0 AS day, f0, f1 FROM phot_ev, b)
SELECT day,
       CASE WHEN f0 + day * 3 > f1 OR f0 + day * 3 + 2 < f0 THEN NULL ELSE greatest(f0 + day * 3, f0) END AS n0,
       CASE WHEN f0 + day * 3 > f1 OR f0 + day * 3 + 2 < f0 THEN NULL ELSE least(f0 + day * 3 + 2, f1) END AS n1
FROM days""".replace("\n, b AS", ",\nb AS", 1))
def q_night_range(spark, d):
    """FN16 for each campaign day present in the data (3 nights per day)."""
    p = B.phot_ev(spark, d)
    first, last = B.nights(p)
    days = p.select((F.floor("MJD").cast("long") - first).alias("day")).distinct()
    return al.night_range_table(days, "day", first, last, 3)


@query("pending_nights", with_(PHOT_EV) + """
SELECT CAST(i AS INTEGER) AS night
FROM (SELECT unnest(range(CAST(min(floor(MJD)) AS BIGINT) - 5, CAST(max(floor(MJD)) AS BIGINT) + 7)) AS i FROM phot_ev)
WHERE NOT EXISTS (SELECT 1 FROM phot_ev p WHERE p.BAND = 'i' AND p.FLUXCAL > 300
                  AND CAST(floor(p.MJD) AS INTEGER) = CAST(i AS INTEGER))""")
def q_pending_nights(spark, d):
    """JOIN12: the ledger holds the nights of bright i-band points."""
    p = B.phot_ev(spark, d)
    ledger = p.filter((F.col("BAND") == "i") & (F.col("FLUXCAL") > 300)).select(F.floor("MJD").alias("night"))
    first, last = B.nights(p)
    return al.pending_nights(spark, first - 5, last + 6, ledger)


_HOT_SQL = with_(PHOT_EV) + """
, recent AS (SELECT DISTINCT SNID FROM phot_ev
             WHERE (PHOTFLAG & 4096) <> 0 AND MJD >= (SELECT floor(max(MJD)) - 13.5 FROM phot_ev) - 1.0
               AND MJD <= (SELECT floor(max(MJD)) - 13.5 FROM phot_ev))
SELECT p.SNID, count(*) AS npts, string_agg(p.BAND, '' ORDER BY p.MJD, p.obs_id) AS bands,
       max(p.MJD) AS mjd_last, list(p.FLUXCAL ORDER BY p.MJD, p.obs_id)[1] AS flux_first
FROM phot_ev p JOIN recent r ON p.SNID = r.SNID
WHERE p.MJD <= (SELECT floor(max(MJD)) - 13.5 FROM phot_ev) GROUP BY p.SNID""".replace("\n, recent AS", ",\nrecent AS", 1)


@query("hot_transients", _HOT_SQL, ["mjd_last", "flux_first"])
def q_hot_transients(spark, d):
    """AGG18, nested-record layout; mjd_now = 13.5 days before the last night, last 1 day."""
    h = al.hot_transients(B.phot_ev(spark, d), B.nights(B.phot_ev(spark, d))[1] - 13.5, 1.0, layout=1)
    p = F.col("photometry")
    return h.select("SNID", F.size(p["mjd"]).cast("long").alias("npts"),
                    F.array_join(p["band"], "").alias("bands"),
                    F.array_max(p["mjd"]).alias("mjd_last"),
                    F.element_at(p["flux"], 1).alias("flux_first"))


@query("hot_transients_columnar", _HOT_SQL, ["mjd_last", "flux_first"])
def q_hot_transients_columnar(spark, d):
    """AGG18, columnar layout."""
    h = al.hot_transients(B.phot_ev(spark, d), B.nights(B.phot_ev(spark, d))[1] - 13.5, 1.0, layout=2)
    return h.select("SNID", F.size("mjd").cast("long").alias("npts"), F.array_join("band", "").alias("bands"),
                    F.array_max("mjd").alias("mjd_last"), F.element_at("flux", 1).alias("flux_first"))


@query("hot_transients_chunks", with_(PHOT_EV) + """
, now AS (SELECT floor(max(MJD)) - 13.5 AS t FROM phot_ev),
recent AS (SELECT DISTINCT SNID FROM phot_ev, now WHERE (PHOTFLAG & 4096) <> 0 AND MJD BETWEEN t - 1.0 AND t),
r AS (SELECT p.*, CAST((row_number() OVER (PARTITION BY p.SNID ORDER BY p.MJD, p.obs_id) - 1) // 8 AS INTEGER) AS chunk
      FROM phot_ev p SEMI JOIN recent ON p.SNID = recent.SNID WHERE p.MJD <= (SELECT t FROM now))
SELECT SNID, chunk, count(*) AS npts, string_agg(BAND, '' ORDER BY MJD, obs_id) AS bands,
       max(MJD) AS mjd_last, list(FLUXCAL ORDER BY MJD, obs_id)[1] AS flux_first
FROM r GROUP BY SNID, chunk""".replace("\n, now AS", ",\nnow AS", 1), ["mjd_last", "flux_first"])
def q_hot_transients_chunks(spark, d):
    """AGG18 in bounded rows: consecutive chunks of at most 8 points of each curve."""
    p = B.phot_ev(spark, d)
    h = al.hot_transients(p, B.nights(p)[1] - 13.5, 1.0, layout=2, max_points=8)
    return h.select("SNID", "chunk", F.size("mjd").cast("long").alias("npts"), F.array_join("band", "").alias("bands"),
                    F.array_max("mjd").alias("mjd_last"), F.element_at("flux", 1).alias("flux_first"))


def _alert_names(spark, d):
    p = B.phot_ev(spark, d)
    ext = F.when(F.col("BAND") == "g", F.lit(".avro")).otherwise(F.lit(".avro.gz"))
    name = F.when(has_flag("PHOTFLAG", PHOTFLAG_DETECT),
                  F.concat(F.format_string("alert_mjd%.6f_obj%d_src%d", "MJD", "SNID", "obs_id"), ext)) \
        .otherwise(F.format_string("forced_%d.txt", "obs_id"))
    return p.select(name.alias("name"), "MJD", "SNID", "obs_id", "PHOTFLAG")


_NAMES_SQL = """names AS (
  SELECT CASE WHEN (PHOTFLAG & 4096) <> 0
              THEN printf('alert_mjd%.6f_obj%d_src%d', MJD, SNID, obs_id)
                   || CASE WHEN BAND = 'g' THEN '.avro' ELSE '.avro.gz' END
              ELSE printf('forced_%d.txt', obs_id) END AS name, MJD, SNID, obs_id, PHOTFLAG
  FROM phot_ev)"""


@query("alert_file_metadata", with_(PHOT_EV, _NAMES_SQL) + r"""
SELECT name,
       CAST(regexp_extract(name, '^alert_mjd([0-9]+(?:\.[0-9]+)?)_obj([0-9]+)_src([0-9]+)\.avro(?:\.gz)?$', 1) AS DOUBLE) AS mjd,
       CAST(regexp_extract(name, '^alert_mjd([0-9]+(?:\.[0-9]+)?)_obj([0-9]+)_src([0-9]+)\.avro(?:\.gz)?$', 2) AS BIGINT) AS objectId,
       CAST(regexp_extract(name, '^alert_mjd([0-9]+(?:\.[0-9]+)?)_obj([0-9]+)_src([0-9]+)\.avro(?:\.gz)?$', 3) AS BIGINT) AS sourceId
FROM names WHERE regexp_matches(name, '^alert_mjd([0-9]+(?:\.[0-9]+)?)_obj([0-9]+)_src([0-9]+)\.avro(?:\.gz)?$')""",
       ["mjd"])
def q_alert_file_metadata(spark, d):
    """SRC9 over archive member names (forced-photometry files do not match)."""
    return al.alert_file_metadata(_alert_names(spark, d).select("name"))


def _archives(spark, d):
    n = _alert_names(spark, d).filter(F.col("name").startswith("alert_"))
    a = n.filter(F.col("MJD") < 60325).select("name", "SNID", F.lit("A").alias("archive"))
    b = n.filter(F.col("MJD") >= 60320).select("name", "SNID", F.lit("B").alias("archive"))
    return a, b


@query("union_dedupe_sources", with_(PHOT_EV, _NAMES_SQL) + """
, u AS (SELECT name, SNID, 'A' AS archive FROM names WHERE name LIKE 'alert_%' AND MJD < 60325
        UNION ALL
        SELECT name, SNID, 'B' AS archive FROM names WHERE name LIKE 'alert_%' AND MJD >= 60320)
SELECT name, SNID, min(archive) AS archive FROM u GROUP BY name, SNID""".replace("\n, u AS", ",\nu AS", 1))
def q_union_dedupe_sources(spark, d):
    """SET2: two overlapping archives merged, each file once."""
    a, b = _archives(spark, d)
    return al.union_dedupe_sources(a, b)[0]


@query("duplicate_sources", with_(PHOT_EV, _NAMES_SQL) + """
, u AS (SELECT name FROM names WHERE name LIKE 'alert_%' AND MJD < 60325
        UNION ALL
        SELECT name FROM names WHERE name LIKE 'alert_%' AND MJD >= 60320)
SELECT name, count(*) AS copies FROM u GROUP BY name HAVING count(*) > 1""".replace("\n, u AS", ",\nu AS", 1))
def q_duplicate_sources(spark, d):
    """SET2: the duplicate report."""
    a, b = _archives(spark, d)
    return al.union_dedupe_sources(a.select("name"), b.select("name"))[1]


@query("missing_keys", """
SELECT d.doc_id, d.n_chars FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def q_missing_keys(spark, d):
    """JOIN10: documents without labels."""
    docs = B.table(spark, d, "documents").select("doc_id", "n_chars")
    return ld.missing_keys(docs, B.table(spark, d, "labels"), "doc_id")


@query("append_new_only", with_(PHOT_EV) + """
SELECT SNID, obs_id, MJD, BAND, FLUXCAL FROM phot_ev WHERE MJD >= 60325""", ["MJD", "FLUXCAL"])
def q_append_new_only(spark, d):
    """JOIN11: stored = points before 60325; the new batch re-sends from 60320
    and repeats its g-band rows; only unseen rows are appended."""
    p = B.phot_ev(spark, d).select("SNID", "obs_id", "MJD", "BAND", "FLUXCAL")
    existing = p.filter(F.col("MJD") < 60325)
    new = p.filter(F.col("MJD") >= 60320)
    new = new.unionByName(new.filter(F.col("BAND") == "g"))
    return ld.append_new_only(new, existing, ["obs_id"])


@query("load_totals", with_(PHOT_EV) + """
, per AS (
  SELECT CAST(floor(MJD) AS BIGINT) AS batch, count(DISTINCT SNID) AS n_objects,
         count(DISTINCT obs_id) AS n_sources,
         count(*) FILTER (WHERE (PHOTFLAG & 4096) <> 0) AS n_alerts,
         count(*) FILTER (WHERE (PHOTFLAG & 4096) = 0) AS n_forced
  FROM phot_ev GROUP BY CAST(floor(MJD) AS BIGINT))
SELECT *, CAST(sum(n_objects) OVER w AS BIGINT) AS cum_n_objects,
       CAST(sum(n_sources) OVER w AS BIGINT) AS cum_n_sources,
       CAST(sum(n_alerts) OVER w AS BIGINT) AS cum_n_alerts,
       CAST(sum(n_forced) OVER w AS BIGINT) AS cum_n_forced
FROM per WINDOW w AS (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""".replace("\n, per AS", ",\nper AS", 1))
def q_load_totals(spark, d):
    """AGG10 + WIN7: nightly load batches."""
    p = B.phot_ev(spark, d)
    loads = p.select(F.floor("MJD").cast("long").alias("batch"), "SNID", "obs_id",
                     has_flag("PHOTFLAG", PHOTFLAG_DETECT).alias("is_alert"),
                     (~has_flag("PHOTFLAG", PHOTFLAG_DETECT)).alias("is_forced"))
    return ld.load_totals(loads, "batch", "SNID", "obs_id", "is_alert", "is_forced")


@query("cumulative_counts", with_(PHOT_EV) + """
, per AS (SELECT CAST(floor(MJD) AS BIGINT) AS night, count(*) AS n_points,
                 count(*) FILTER (WHERE BAND = 'i') AS n_i
          FROM phot_ev GROUP BY CAST(floor(MJD) AS BIGINT))
SELECT *, CAST(sum(n_points) OVER w AS BIGINT) AS cum_n_points, CAST(sum(n_i) OVER w AS BIGINT) AS cum_n_i
FROM per WINDOW w AS (ORDER BY night ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""".replace("\n, per AS", ",\nper AS", 1))
def q_cumulative_counts(spark, d):
    """WIN7: running totals of nightly point counts."""
    p = B.phot_ev(spark, d)
    per = p.groupBy(F.floor("MJD").cast("long").alias("night")).agg(
        F.count(F.lit(1)).alias("n_points"), F.count(F.when(F.col("BAND") == "i", 1)).alias("n_i"))
    return ld.cumulative_counts(per, "night", ["n_points", "n_i"])
