"""Registered queries: sky positions and the GW / kilonova catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyflux.functions import physics as phy
from skyflux.functions import timefn as tf
from skyflux.operators import filters as flt
from skyflux.operators import gw, pixels
from skyflux.operators import sky
from skyflux.plans import bindings as B
from skyflux.plans.registry import query
from skyflux.plans.sql import PHOT_EV, SKY_OBJECTS, SKY_SOURCES, TARGETS, TRUTH_EV, with_


def _hav(ra1, d1, ra2, d2):
    return (f"degrees(2 * asin(sqrt(least(1.0, pow(sin((radians({d2}) - radians({d1})) / 2), 2) "
            f"+ cos(radians({d1})) * cos(radians({d2})) * pow(sin((radians({ra2}) - radians({ra1})) / 2), 2)))))")


@query("cone_search", with_(SKY_OBJECTS) + f"""
SELECT objectId, ra, decl, {_hav('100.0', '20.0', 'ra', 'decl')} AS sep_deg
FROM sky_objects WHERE {_hav('100.0', '20.0', 'ra', 'decl')} <= 10.0""", ["ra", "decl", "sep_deg"])
def q_cone_search(spark, d):
    """JOIN13: 10 degrees around (100, +20)."""
    return sky.cone_search(B.sky_objects(spark, d), 100.0, 20.0, 10.0)


@query("associate_by_position", with_(SKY_OBJECTS, SKY_SOURCES) + f"""
SELECT sourceId, objectId, sep * 3600.0 AS sep_arcsec FROM (
  SELECT s.sourceId, o.objectId, {_hav('s.ra', 's.decl', 'o.ra', 'o.decl')} AS sep,
         row_number() OVER (PARTITION BY s.sourceId
                            ORDER BY {_hav('s.ra', 's.decl', 'o.ra', 'o.decl')}, o.objectId) AS rn
  FROM sky_sources s, sky_objects o
  WHERE {_hav('s.ra', 's.decl', 'o.ra', 'o.decl')} <= 1.0 / 3600.0) WHERE rn = 1""", ["sep_arcsec"])
def q_associate_by_position(spark, d):
    """JOIN14: sources assigned to the nearest object within 1 arcsec."""
    return sky.associate_by_position(B.sky_sources(spark, d), B.sky_objects(spark, d), 1.0)


_PIX_SQL = """pix AS (
  SELECT map_id, p * 16 AS pix_lo, p * 16 + 16 AS pix_hi, w / sum(w) OVER (PARTITION BY map_id) AS prob,
         16.0 AS area
  FROM (SELECT o_orderpriority AS map_id, o_custkey % 512 AS p, sum(o_totalprice) AS w
        FROM orders GROUP BY o_orderpriority, o_custkey % 512)),
ranked AS (
  SELECT *, prob / area AS density,
         sum(prob) OVER (PARTITION BY map_id ORDER BY prob / area DESC, pix_lo
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS searched_prob
  FROM pix),
obj AS (
  SELECT objectId, CAST(least(floor((decl + 90.0) / 180.0 * 64), 63) * 128
                        + least(floor(ra / 360.0 * 128), 127) AS BIGINT) AS ipix
  FROM sky_objects)"""


@query("skymap_crossmatch", with_(SKY_OBJECTS, _PIX_SQL) + """
SELECT o.objectId, o.ipix, r.map_id, r.pix_lo, r.pix_hi, r.density, r.searched_prob
FROM obj o JOIN ranked r ON o.ipix >= r.pix_lo AND o.ipix < r.pix_hi""", ["density", "searched_prob"])
def q_skymap_crossmatch(spark, d):
    """JOIN15: probability density and searched probability of each object in each map."""
    objs = B.sky_objects(spark, d).select("objectId", B.sky_ipix().alias("ipix"))
    return sky.skymap_crossmatch(objs, B.skymap_pixels(spark, d), bucket=16)


@query("skymap_crossmatch_credible", with_(SKY_OBJECTS, _PIX_SQL) + """
SELECT o.objectId, o.ipix, r.map_id, r.pix_lo, r.pix_hi, r.density, r.searched_prob
FROM obj o JOIN ranked r ON o.ipix >= r.pix_lo AND o.ipix < r.pix_hi
WHERE r.searched_prob - r.prob < 0.5""", ["density", "searched_prob"])
def q_skymap_crossmatch_credible(spark, d):
    """JOIN15 inside the 50% credible region of each map."""
    objs = B.sky_objects(spark, d).select("objectId", B.sky_ipix().alias("ipix"))
    return sky.skymap_crossmatch(objs, B.skymap_pixels(spark, d), bucket=16, credible=0.5)


@query("skymap_crossmatch_pairs", with_(SKY_OBJECTS, _PIX_SQL) + """
SELECT o.objectId, o.ipix, r.map_id, r.pix_lo, r.pix_hi, r.density, r.searched_prob
FROM obj o JOIN (SELECT DISTINCT o_custkey AS c, o_orderpriority AS m FROM orders) p ON p.c = o.objectId
JOIN ranked r ON r.map_id = p.m AND o.ipix >= r.pix_lo AND o.ipix < r.pix_hi""", ["density", "searched_prob"])
def q_skymap_crossmatch_pairs(spark, d):
    """JOIN15 for named (object, map) pairs: a customer and the priorities of its orders."""
    objs = B.sky_objects(spark, d).select("objectId", B.sky_ipix().alias("ipix"))
    pairs = B.table(spark, d, "orders").select(F.col("o_custkey").alias("objectId"), F.col("o_orderpriority").alias("map_id"))
    return sky.skymap_crossmatch(objs, B.skymap_pixels(spark, d), bucket=16, pairs=pairs)


def _morton_sql(order: int) -> str:
    """Nested pixel in DuckDB, bit by bit."""
    n = 1 << order
    col = f"CAST(least(floor(ra / CAST(360 AS DOUBLE) * {n}), {n - 1}) AS BIGINT)"
    row = f"CAST(least(floor((sin(radians(decl)) + 1) / 2 * {n}), {n - 1}) AS BIGINT)"
    return " + ".join(f"(({col} >> {k}) & 1) * {1 << 2 * k} + (({row} >> {k}) & 1) * {1 << 2 * k + 1}" for k in range(order))


@query("skymap_crossmatch_multiorder", with_(SKY_OBJECTS) + f"""
, obj AS (SELECT objectId, {_morton_sql(3)} AS p3, {_morton_sql(5)} AS p5 FROM sky_objects),
pix AS (
  SELECT o_orderpriority AS map_id, CASE WHEN p3 % 2 = 0 THEN 3 ELSE 5 END AS "order",
         CASE WHEN p3 % 2 = 0 THEN p3 ELSE p5 END AS map_pix, CAST(sum(o_totalprice) AS DOUBLE) AS w
  FROM orders JOIN obj ON objectId = o_custkey GROUP BY ALL),
prob AS (SELECT map_id, "order", map_pix, w / sum(w) OVER (PARTITION BY map_id) AS prob FROM pix),
ranked AS (
  SELECT *, prob / (4 * pi() / pow(4.0, "order")) AS density,
         sum(prob) OVER (PARTITION BY map_id ORDER BY prob / (4 * pi() / pow(4.0, "order")) DESC, "order", map_pix
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS searched_prob FROM prob)
SELECT objectId, map_id, "order", map_pix, density, searched_prob
FROM obj JOIN ranked ON CASE WHEN "order" = 3 THEN p3 ELSE p5 END = map_pix
WHERE searched_prob - prob < 0.5""".replace("\n, obj AS", ",\nobj AS", 1), ["density", "searched_prob"])
def q_skymap_crossmatch_multiorder(spark, d):
    """JOIN15: maps of nested pixels of two orders, one per order priority;
    objects inside the 50% credible region of each."""
    objs = pixels.with_pixel(B.sky_objects(spark, d))
    o = B.table(spark, d, "orders").join(objs, F.col("objectId") == F.col("o_custkey"))
    even = pixels.parent("pix", 3) % 2 == 0
    w = (o.groupBy(F.col("o_orderpriority").alias("map_id"), F.when(even, 3).otherwise(5).alias("order"),
                   F.when(even, pixels.parent("pix", 3)).otherwise(pixels.parent("pix", 5)).alias("map_pix"))
         .agg(F.sum("o_totalprice").cast("double").alias("w")))
    total = w.groupBy("map_id").agg(F.sum("w").alias("t"))
    maps = w.join(total, "map_id").withColumn("prob", F.col("w") / F.col("t"))
    out = pixels.crossmatch_multiorder(objs.select("objectId", "pix"), maps, credible=0.5)
    return out.select("objectId", "map_id", "order", "map_pix", "density", "searched_prob")


@query("match_within_tolerance", with_(TARGETS) + """
, best AS (
  SELECT target_id, cand_id, cx, d FROM (
    SELECT t.target_id, c.cand_id, c.x AS cx, abs(c.x - t.x) AS d,
           row_number() OVER (PARTITION BY t.target_id ORDER BY abs(c.x - t.x), c.cand_id) AS rn
    FROM targets t JOIN candidates c ON abs(c.x - t.x) <= 0.001) WHERE rn = 1)
SELECT t.target_id, t.x, b.cand_id, b.cx AS cand_id_x, b.d AS abs_diff
FROM targets t LEFT JOIN best b ON t.target_id = b.target_id""".replace("\n, best AS", ",\nbest AS", 1),
       ["x", "cand_id_x", "abs_diff"])
def q_match_within_tolerance(spark, d):
    """JOIN16: closest candidate within 0.001 of each target (NULL = failed)."""
    t, c = B.targets_candidates(spark, d)
    return gw.match_within_tolerance(t, c, "x", 0.001)


@query("join_gw_head", with_(TRUTH_EV) + """
SELECT o.o_orderkey AS simulation_id, 'GAL' || CAST(o.o_custkey AS VARCHAR) AS source, t.SNID, t.ZCMB
FROM orders o JOIN truth_ev t ON o.o_custkey = t.SNID""", ["ZCMB"])
def q_join_gw_head(spark, d):
    """JOIN5: injections ('GAL<snid>') joined to HEAD rows."""
    sim = B.sim_inspiral(spark, d).select("simulation_id", "source")
    return gw.join_gw_head(sim, B.truth_ev(spark, d).select("SNID", "ZCMB"))


@query("sim_coinc_map", """
, sim AS (
  SELECT o_orderkey AS simulation_id, 1.0 + o_totalprice / 500000.0 AS mass1,
         (1.0 + o_totalprice / 500000.0) * 0.8 AS mass2, 0.0 AS spin1x, 0.0 AS spin1y, 0.0 AS spin1z,
         40.0 + o_custkey % 400 AS distance, 'GAL' || CAST(o_custkey AS VARCHAR) AS source,
         radians(CAST(o_orderkey % 180 AS DOUBLE)) AS inclination FROM orders),
coinc AS (
  SELECT l_orderkey AS coinc_event_id, sum(l_quantity) / 10.0 AS snr,
         CASE WHEN count(*) > 3 THEN 'H1,L1,V1' ELSE 'H1,L1' END AS ifos
  FROM lineitem GROUP BY l_orderkey)
SELECT A.mass1, A.mass2, A.spin1x, A.spin1y, A.spin1z, A.distance, A.source, A.inclination,
       A.simulation_id, B.snr, B.ifos
FROM sim A JOIN coinc B ON A.simulation_id = B.coinc_event_id""".replace("\n, sim AS", "WITH sim AS", 1),
       ["mass1", "mass2", "spin1x", "spin1y", "spin1z", "distance", "inclination", "snr"])
def q_sim_coinc_map(spark, d):
    """JOIN6: injections x coincidences."""
    return gw.sim_coinc_map(B.sim_inspiral(spark, d), B.coinc_inspiral(spark, d))


_TEMPLATE_SQL = """tpl AS (
  SELECT CAST(p_partkey AS INTEGER) AS SIM_TEMPLATE_INDEX, p_size / 100.0 AS VK,
         -1.0 - (p_size % 9) AS LOGXLAN, -3.0 + (p_retailprice - 900.0) / 50.0 AS LOGMASS
  FROM part),
head AS (SELECT SNID, CAST(SNID * 2 AS INTEGER) AS SIM_TEMPLATE_INDEX, ZCMB - 0.05 AS REDSHIFT_FINAL
         FROM truth_ev)"""


@query("attach_template_params", with_(TRUTH_EV, _TEMPLATE_SQL) + """
SELECT h.SNID, h.SIM_TEMPLATE_INDEX, h.REDSHIFT_FINAL, t.VK, t.LOGXLAN, t.LOGMASS
FROM head h LEFT JOIN tpl t ON h.SIM_TEMPLATE_INDEX = t.SIM_TEMPLATE_INDEX""",
       ["REDSHIFT_FINAL", "VK", "LOGXLAN", "LOGMASS"])
def q_attach_template_params(spark, d):
    """JOIN7: template parameters by key (indices beyond the part keys find none)."""
    out = gw.attach_template_params(B.head_kn(spark, d), B.template_index(spark, d))
    return out.select("SNID", "SIM_TEMPLATE_INDEX", "REDSHIFT_FINAL", "VK", "LOGXLAN", "LOGMASS")


@query("ejecta_selection", with_(TRUTH_EV, _TEMPLATE_SQL) + """
SELECT h.SNID, h.REDSHIFT_FINAL, pow(10.0, t.LOGMASS) AS MEJ
FROM head h JOIN tpl t ON h.SIM_TEMPLATE_INDEX = t.SIM_TEMPLATE_INDEX
WHERE h.REDSHIFT_FINAL > 0 AND pow(10.0, t.LOGMASS) <= 0.05""", ["REDSHIFT_FINAL", "MEJ"])
def q_ejecta_selection(spark, d):
    """FLT7 + FN9: positive redshift, MEJ = 10^LOGMASS <= 0.05."""
    h = flt.positive_redshift(B.head_kn(spark, d), "REDSHIFT_FINAL")
    out = gw.attach_template_params(h, B.template_index(spark, d))
    out = out.withColumn("MEJ", phy.ejecta_from_log("LOGMASS"))
    return flt.max_ejecta(out, "MEJ", 0.05).select("SNID", "REDSHIFT_FINAL", "MEJ")


@query("candidate_masses", """
SELECT cand_id, mchirp, q, m1, m2 FROM (
  SELECT p_partkey AS cand_id, 0.87 + (p_partkey % 74) * 0.01 AS mchirp, 0.5 + (p_size % 51) * 0.01 AS q,
         (0.87 + (p_partkey % 74) * 0.01) * pow(1 + 0.5 + (p_size % 51) * 0.01, 1.2)
           / pow(0.5 + (p_size % 51) * 0.01, 0.6) / (1 + 0.5 + (p_size % 51) * 0.01) AS m1,
         (0.87 + (p_partkey % 74) * 0.01) * pow(1 + 0.5 + (p_size % 51) * 0.01, 1.2)
           / pow(0.5 + (p_size % 51) * 0.01, 0.6)
         - (0.87 + (p_partkey % 74) * 0.01) * pow(1 + 0.5 + (p_size % 51) * 0.01, 1.2)
           / pow(0.5 + (p_size % 51) * 0.01, 0.6) / (1 + 0.5 + (p_size % 51) * 0.01) AS m2
  FROM part) WHERE m2 >= 1.0 AND m1 <= 2.21""", ["mchirp", "q", "m1", "m2"])
def q_candidate_masses(spark, d):
    """FN7 + FN8: component masses of (chirp mass, ratio) candidates, bounded."""
    p = B.table(spark, d, "part")
    mc = F.lit(0.87) + (F.col("p_partkey") % 74) * 0.01
    q = F.lit(0.5) + (F.col("p_size") % 51) * 0.01
    m1, m2 = phy.component_masses(mc, q)
    c = p.select(F.col("p_partkey").alias("cand_id"), mc.alias("mchirp"), q.alias("q"),
                 m1.alias("m1"), m2.alias("m2"))
    return gw.mass_bounds(c)


@query("mass_functions", with_(TRUTH_EV) + """
SELECT o.o_orderkey AS simulation_id,
       (1.0 + o.o_totalprice / 500000.0) * (1 + t.ZCMB) AS mass1,
       (1.0 + o.o_totalprice / 500000.0) * 0.8 * (1 + t.ZCMB) AS mass2,
       pow(((1.0 + o.o_totalprice / 500000.0) * (1 + t.ZCMB)) * ((1.0 + o.o_totalprice / 500000.0) * 0.8 * (1 + t.ZCMB)), 0.6)
         / pow((1.0 + o.o_totalprice / 500000.0) * (1 + t.ZCMB) + (1.0 + o.o_totalprice / 500000.0) * 0.8 * (1 + t.ZCMB), 0.2) AS chirp_mass,
       (1.0 + o.o_totalprice / 500000.0) * ((1.0 + o.o_totalprice / 500000.0) * 0.8)
         / pow((1.0 + o.o_totalprice / 500000.0) + (1.0 + o.o_totalprice / 500000.0) * 0.8, 2) AS eta
FROM orders o JOIN truth_ev t ON o.o_custkey = t.SNID""", ["mass1", "mass2", "chirp_mass", "eta"])
def q_mass_functions(spark, d):
    """FN6 + FN10 + FN11: detector-frame masses, chirp mass, symmetric mass ratio."""
    sim = B.sim_inspiral(spark, d).select("simulation_id", F.col("mass1").alias("mass1_source"),
                                          F.col("mass2").alias("mass2_source"), "source")
    j = gw.join_gw_head(sim, B.truth_ev(spark, d).select("SNID", F.col("ZCMB").alias("redshift")))
    out = gw.detector_frame(j)
    return out.select("simulation_id", "mass1", "mass2", "chirp_mass",
                      phy.symmetric_mass_ratio("mass1_source", "mass2_source").alias("eta"))


@query("time_conversions", with_(PHOT_EV) + """
SELECT obs_id, (MJD - 40587) * 86400.0 - 315964800 + 18 AS gps,
       (((MJD - 40587) * 86400.0 - 315964800 + 18) + 315964800 - 18) / 86400.0 + 40587 + 2400000.5 AS jd,
       strftime(make_timestamp(CAST(round((MJD - 40587) * 86400000000.0) AS BIGINT)), '%Y-%m-%d %H:%M:%S.%f') AS utc
FROM phot_ev""", ["gps", "jd"])
def q_time_conversions(spark, d):
    """FN15: MJD -> GPS seconds -> JD, and MJD -> UTC timestamp (as text)."""
    p = B.phot_ev(spark, d).select("obs_id", tf.mjd_to_gps("MJD").alias("gps"),
                                   F.date_format(tf.mjd_to_timestamp("MJD"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("utc"))
    return p.withColumn("jd", tf.gps_to_jd("gps"))


@query("simulation_ids", with_(TRUTH_EV) + """
SELECT SNID, row_number() OVER (ORDER BY SNID) - 1 AS simulation_id FROM truth_ev""")
def q_simulation_ids(spark, d):
    """WIN4: dense 0-based ids in SNID order."""
    return gw.simulation_ids(B.truth_ev(spark, d).select("SNID"), "SNID")


_INJ_SQL = with_(PHOT_EV, SKY_OBJECTS) + """
, first AS (SELECT SNID, min(MJD) FILTER (WHERE (PHOTFLAG & 4096) <> 0) AS fd FROM phot_ev GROUP BY SNID),
inp AS (
  SELECT c.c_custkey AS simulation_id, c.c_custkey AS snid, 1.2 + c.c_nationkey / 100.0 AS mass1,
         1.1 + c.c_nationkey / 200.0 AS mass2, 100.0 + c.c_nationkey AS distance, s.ra, s.decl AS dec,
         greatest(-1.0, least(1.0, c.c_acctbal / 10000.0)) AS costheta,
         (f.fd - 40587) * 86400.0 - 315964800 + 18 AS first_detection
  FROM customer c JOIN sky_objects s ON s.objectId = c.c_custkey JOIN first f ON f.SNID = c.c_custkey
  WHERE f.fd IS NOT NULL)
SELECT simulation_id, 'GAL' || CAST(snid AS VARCHAR) AS source,
       pow(mass1 * mass2, 0.6) / pow(mass1 + mass2, 0.2) AS mchirp,
       mass1 * mass2 / pow(mass1 + mass2, 2) AS eta, ra / 180.0 * pi() AS longitude,
       dec / 180.0 * pi() AS latitude, acos(costheta) AS inclination,
       first_detection - 7200 AS geocent_end_time, 'TaylorF2threePointFivePN' AS waveform
FROM inp""".replace("\n, first AS", ",\nfirst AS", 1)


@query("injection_rows", _INJ_SQL, ["mchirp", "eta", "longitude", "latitude", "inclination", "geocent_end_time"])
def q_injection_rows(spark, d):
    """FN12 (deterministic columns) for objects with a detection."""
    c = B.table(spark, d, "customer")
    first = B.phot_ev(spark, d).filter(F.col("PHOTFLAG").bitwiseAND(4096) != 0) \
        .groupBy("SNID").agg(F.min("MJD").alias("fd"))
    inp = (c.join(B.sky_objects(spark, d), F.col("objectId") == F.col("c_custkey"))
           .join(first, F.col("SNID") == F.col("c_custkey"))
           .select(F.col("c_custkey").alias("simulation_id"), F.col("c_custkey").alias("snid"),
                   (F.lit(1.2) + F.col("c_nationkey") / 100.0).alias("mass1"),
                   (F.lit(1.1) + F.col("c_nationkey") / 200.0).alias("mass2"),
                   (F.lit(100.0) + F.col("c_nationkey")).alias("distance"), "ra", F.col("decl").alias("dec"),
                   F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("c_acctbal") / 10000.0)).alias("costheta"),
                   tf.mjd_to_gps("fd").alias("first_detection")))
    inj = gw.injection_rows(inp, seed=7)
    return inj.select("simulation_id", "source", "mchirp", "eta", "longitude", "latitude", "inclination",
                      "geocent_end_time", "waveform")


_GRID_SQL = """grid0 AS (
  SELECT i, CAST(i AS DOUBLE) * CAST(0.0001 AS DOUBLE) AS z,
         CAST(1 AS DOUBLE) / sqrt(CAST(0.3 AS DOUBLE) * pow(1 + CAST(i AS DOUBLE) * CAST(0.0001 AS DOUBLE), 3)
                                  + (CAST(1 AS DOUBLE) - CAST(0.3 AS DOUBLE))) AS f
  FROM range(0, 30001) r(i)),
grid1 AS (
  SELECT i, z, coalesce((f + lag(f) OVER (ORDER BY i)) * CAST(0.00005 AS DOUBLE), 0.0) AS trap FROM grid0),
grid AS (
  SELECT i, z, (1 + z) * (sum(trap) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                          * (CAST(299792.458 AS DOUBLE) / CAST(70 AS DOUBLE))) AS d_l FROM grid1),
seg AS (SELECT a.i, a.z AS z0, a.d_l AS d0, b.z AS z1, b.d_l AS d1 FROM grid a JOIN grid b ON b.i = a.i + 1)"""


@query("luminosity_distance", with_(TRUTH_EV, _GRID_SQL) + """
SELECT t.SNID, t.ZCMB,
       round(s.d0 + ((t.ZCMB - s.z0) / CAST(0.0001 AS DOUBLE)) * (s.d1 - s.d0), 3) AS distance
FROM truth_ev t LEFT JOIN seg s
  ON s.i = least(CAST(floor(t.ZCMB / CAST(0.0001 AS DOUBLE)) AS BIGINT), 29999)""", ["ZCMB", "distance"])
def q_luminosity_distance(spark, d):
    """FN13: flat LambdaCDM (H0 70, Om0 0.3) distance of each ZCMB (Mpc, 3 decimals)."""
    grid = gw.distance_grid(spark)
    out = gw.luminosity_distance(B.truth_ev(spark, d).select("SNID", "ZCMB"), "ZCMB", grid)
    return out.withColumn("distance", F.round("distance", 3))


@query("redshift_from_distance", with_(_GRID_SQL) + """
, sim AS (SELECT o_orderkey AS simulation_id, 40.0 + o_custkey % 400 AS distance FROM orders)
SELECT sim.simulation_id, sim.distance,
       s.z0 + ((sim.distance - s.d0) / (s.d1 - s.d0)) * (s.z1 - s.z0) AS z
FROM sim JOIN seg s ON sim.distance >= s.d0 AND sim.distance < s.d1""".replace("\n, sim AS", ",\nsim AS", 1),
       ["distance", "z"])
def q_redshift_from_distance(spark, d):
    """FN14: redshift of each injection distance (inverse lookup on the same grid)."""
    grid = gw.distance_grid(spark)
    return gw.redshift_from_distance(B.sim_inspiral(spark, d).select("simulation_id", "distance"),
                                     "distance", grid)


def _distance_sql(z: str, om0: float = 0.3, h0: float = 70.0, panels: int = 400) -> str:
    """Distance by Simpson's rule in t = (1 + z)^(-1/2), far finer than needed."""
    dbl = lambda x: f"CAST({x!r} AS DOUBLE)"
    t = f"(1 - k / {dbl(float(panels))} * (1 - 1 / sqrt(1 + {z})))"
    term = f"(CASE WHEN k = 0 OR k = {panels} THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END) / sqrt({dbl(om0)} + {dbl(1 - om0)} * pow({t}, 6))"
    return (f"(1 + {z}) * {dbl(299792.458 / h0)} * 2 * (1 - 1 / sqrt(1 + {z})) / {dbl(3.0 * panels)} "
            f"* list_sum(list_transform(range(0, {panels + 1}), lambda k: {term}))")


@query("luminosity_distance_far", with_(TRUTH_EV) + f"""
SELECT SNID, z, round({_distance_sql('z')}, 3) AS distance
FROM (SELECT SNID, CAST(ZCMB * 8 AS DOUBLE) AS z FROM truth_ev)""", ["z", "distance"])
def q_luminosity_distance_far(spark, d):
    """FN13 up to z = 8, by quadrature per row."""
    t = B.truth_ev(spark, d).select("SNID", (F.col("ZCMB") * 8).cast("double").alias("z"))
    return gw.luminosity_distance(t, "z").withColumn("distance", F.round("distance", 3))


@query("redshift_from_distance_far", f"""
WITH RECURSIVE sim AS (SELECT o_orderkey AS simulation_id, CAST(40.0 + (o_custkey % 400) * 200.0 AS DOUBLE) AS distance FROM orders),
bisect AS (
  SELECT 0 AS i, distance, CAST(0 AS DOUBLE) AS lo, CAST(64 AS DOUBLE) AS hi FROM (SELECT DISTINCT distance FROM sim)
  UNION ALL
  SELECT i + 1, distance, CASE WHEN far THEN lo ELSE (lo + hi) / 2 END, CASE WHEN far THEN (lo + hi) / 2 ELSE hi END
  FROM (SELECT *, {_distance_sql('((lo + hi) / 2)', panels=200)} >= distance AS far FROM bisect WHERE i < 55))
SELECT sim.simulation_id, sim.distance, b.lo AS z FROM sim JOIN bisect b ON b.distance = sim.distance AND b.i = 55""", ["distance", "z"])
def q_redshift_from_distance_far(spark, d):
    """FN14 up to 80 Gpc, by Newton steps per row."""
    sim = B.table(spark, d, "orders").select(F.col("o_orderkey").alias("simulation_id"),
                                             (F.lit(40.0) + (F.col("o_custkey") % 400) * 200.0).alias("distance"))
    return gw.redshift_from_distance(sim, "distance")


@query("skymap_manifest", with_(PHOT_EV) + """
, first AS (SELECT SNID, min(MJD) AS MJD FROM phot_ev GROUP BY SNID)
SELECT 'skymaps/' || CAST(o.o_orderkey AS VARCHAR) || '.fits' AS path, o.o_orderkey AS simulation_id,
       f.SNID, f.MJD, printf('SNID_%d_MJD_%.6f.fits', f.SNID, f.MJD) AS target
FROM orders o JOIN first f ON o.o_custkey = f.SNID""".replace("\n, first AS", ",\nfirst AS", 1), ["MJD"])
def q_skymap_manifest(spark, d):
    """SRC17: map files of injections whose object has photometry -> target names."""
    first = B.phot_ev(spark, d).groupBy("SNID").agg(F.min("MJD").alias("MJD"))
    sim = B.sim_inspiral(spark, d).select("simulation_id", "source")
    coinc = gw.join_gw_head(sim, first.select("SNID"))
    maps = coinc.select(F.concat(F.lit("skymaps/"), F.col("simulation_id").cast("string"), F.lit(".fits")).alias("path"))
    return gw.skymap_manifest(maps, coinc, first, decimals=6)


@query("mass_inversion", with_(TRUTH_EV, _TEMPLATE_SQL) + """
, cand AS (
  SELECT i AS cand_id, 0.87 + (i // 51) * (0.73 / 73) AS mc, 0.5 + (i % 51) * 0.01 AS q, (i // 51) * 0.0005 AS mej
  FROM range(0, 3774) r(i)),
one AS (SELECT mej, min(cand_id) AS cand_id FROM cand GROUP BY mej),
tgt AS (SELECT h.SNID, h.REDSHIFT_FINAL AS redshift, pow(10.0, t.LOGMASS) AS mej
        FROM head h JOIN tpl t ON h.SIM_TEMPLATE_INDEX = t.SIM_TEMPLATE_INDEX
        WHERE h.REDSHIFT_FINAL > 0 AND pow(10.0, t.LOGMASS) <= 0.05),
best AS (SELECT tgt.*, arg_min(one.cand_id, [abs(one.mej - tgt.mej), CAST(one.cand_id AS DOUBLE)]) AS cand_id
         FROM tgt JOIN one ON abs(one.mej - tgt.mej) <= 0.0002 GROUP BY ALL),
m AS (SELECT best.*, mc * pow(1 + q, 1.2) / pow(q, 0.6) / (1 + q) AS m1,
             mc * pow(1 + q, 1.2) / pow(q, 0.6) - mc * pow(1 + q, 1.2) / pow(q, 0.6) / (1 + q) AS m2
      FROM best JOIN cand USING (cand_id))
SELECT m.SNID, m.redshift, m.mej, m.cand_id, m1 * (1 + redshift) AS mass1, m2 * (1 + redshift) AS mass2,
       pow(m1 * (1 + redshift) * (m2 * (1 + redshift)), 0.6) / pow(m1 * (1 + redshift) + m2 * (1 + redshift), 0.2) AS chirp_mass,
       round(%s, 3) AS distance
FROM m""".replace("%s", _distance_sql("redshift", 0.30966, 67.66)).replace("\n, cand AS", ",\ncand AS", 1),
       ["redshift", "mej", "mass1", "mass2", "chirp_mass", "distance"])
def q_mass_inversion(spark, d):
    """Filter, template, ejecta mass, closest candidate of the grid (forward
    value: 0.0005 per chirp-mass step), detector frame, distance."""
    grid = gw.candidate_grid(spark)
    cand = grid.withColumn("mej", F.floor(F.col("cand_id") / 51) * F.lit(0.0005))
    out = gw.mass_inversion(B.head_kn(spark, d), B.template_index(spark, d), cand, tol=0.0002)
    return out.select("SNID", "redshift", "mej", "cand_id", "mass1", "mass2", "chirp_mass", F.round("distance", 3).alias("distance"))
