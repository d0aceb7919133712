"""Gravitational-wave / kilonova catalogue operators (JOIN5-JOIN7, JOIN16,
FN8, FN10, FN12-FN14, WIN4, SRC17)."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyflux.functions.ids import strip_id
from skyflux.functions.physics import chirp_mass, component_masses, symmetric_mass_ratio
from skyflux.functions.timefn import mjd_to_gps
from skyflux.operators.intervals import interval_join
from skyflux.session import broadcast_if_small, checkpoint_table

# Fixed values of the injection table: waveform, lower frequency, ad-hoc delay
# between first optical detection and merger, and the speed of light in km/s.
WAVEFORM = "TaylorF2threePointFivePN"
F_LOWER = 20.0
MERGER_DELAY_S = 7200
C_KM_S = 299792.458
#: Nodes of the distance integral and Newton steps of its inverse.
NODES, NEWTON_STEPS = 24, 8
# The Planck 2018 parameters (H0, Om0) and the default of the survey.
PLANCK18 = {"h0": 67.66, "om0": 0.30966}


def join_gw_head(gw: DataFrame, head: DataFrame, source: str = "source", key: str = "SNID",
                 prefix: str = "GAL") -> DataFrame:
    """JOIN5: 'GAL<snid>' source names joined to HEAD rows on SNID."""
    return gw.withColumn(key, strip_id(source, prefix)).join(head, key, "inner")


def sim_coinc_map(sim: DataFrame, coinc: DataFrame) -> DataFrame:
    """JOIN6: injections joined to their coincidences (simulation_id =
    coinc_event_id), the 11 columns of the source query."""
    cols = ["mass1", "mass2", "spin1x", "spin1y", "spin1z", "distance", "source",
            "inclination", "simulation_id"]
    return (sim.select(*cols)
            .join(coinc.select(F.col("coinc_event_id").alias("simulation_id"), "snr", "ifos"),
                  "simulation_id")
            .select(*cols, "snr", "ifos"))


def attach_template_params(head: DataFrame, index_dim: DataFrame, index: str = "SIM_TEMPLATE_INDEX",
                           dim_key: str = "index") -> DataFrame:
    """JOIN7: SED parameters of each object's template (left join on the key;
    the dimension is a few hundred rows, broadcast after a size check)."""
    dim = index_dim.withColumnRenamed(dim_key, index)
    return head.join(broadcast_if_small(dim, 100_000), index, "left")


def candidate_grid(spark: SparkSession, mc_lo: float = 0.87, mc_hi: float = 1.6, n_mc: int = 74,
                   q_lo: float = 0.5, q_hi: float = 1.0, n_q: int = 51) -> DataFrame:
    """FN8: a regular (chirp mass, mass ratio) grid with component masses
    (n_mc * n_q rows, generated on the executors)."""
    g = spark.range(n_mc * n_q)
    mc = F.lit(mc_lo) + (F.col("id") / n_q).cast("long") * ((mc_hi - mc_lo) / max(n_mc - 1, 1))
    q = F.lit(q_lo) + (F.col("id") % n_q) * ((q_hi - q_lo) / max(n_q - 1, 1))
    m1, m2 = component_masses(mc, q)
    return g.select(F.col("id").alias("cand_id"), mc.alias("mchirp"), q.alias("q"),
                    m1.alias("m1"), m2.alias("m2"))


def mass_bounds(df: DataFrame, lo: float = 1.0, hi: float = 2.21, m1: str = "m1", m2: str = "m2") -> DataFrame:
    """FN8: reject m2 < lo or m1 > hi."""
    return df.filter((F.col(m2) >= lo) & (F.col(m1) <= hi))


def match_within_tolerance(targets: DataFrame, candidates: DataFrame, x: str = "x", tol: float = 0.005,
                           target_id: str = "target_id", cand_id: str = "cand_id") -> DataFrame:
    """JOIN16: for each target value the candidate whose value is closest and
    within ``tol`` (ties -> lowest candidate id); none -> NULL (a failed
    inversion, kept so the caller can report it).

    The closest candidate is the last one at or before the target or the first
    one after it, so no pairs are formed: distinct values of both sides are
    ordered together in range partitions of like size, however dense the values
    are; the neighbours inside a partition are filled forward and backward, and
    those beyond its ends come from one row per partition."""
    c = candidates.groupBy(F.col(x).alias("__x")).agg(F.min(cand_id).alias("__cid")).filter("__x IS NOT NULL")
    c = c.select("__x", F.struct(F.col("__x").alias("v"), F.col("__cid").alias("id")).alias("__c"), F.lit(0).alias("__t"))
    t = targets.select(F.col(x).alias("__x")).distinct().filter("__x IS NOT NULL")
    both = t.select("__x", F.lit(None).cast(c.schema["__c"].dataType).alias("__c"), F.lit(1).alias("__t")).unionByName(c)
    both = checkpoint_table(both.repartitionByRange("__x", "__t").withColumn("__s", F.spark_partition_id()), "match")
    w = Window.partitionBy("__s").orderBy("__x", "__t")             # a candidate before a target of the same value
    near = (both.withColumn("__p", F.last("__c", True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("__n", F.first("__c", True).over(w.rowsBetween(0, Window.unboundedFollowing)))
            .filter("__t = 1").select("__x", "__s", "__p", "__n"))
    parts = Window.orderBy("__s")                                   # one row per partition
    ends = (both.groupBy("__s").agg(F.min("__c").alias("__lo"), F.max("__c").alias("__hi"))
            .select("__s", F.last("__hi", True).over(parts.rowsBetween(Window.unboundedPreceding, -1)).alias("__q"),
                    F.first("__lo", True).over(parts.rowsBetween(1, Window.unboundedFollowing)).alias("__m")))
    near = near.join(F.broadcast(ends), "__s", "left")
    far = lambda k: F.when(F.abs(F.col(k)["v"] - F.col("__x")) <= tol, F.struct(
        F.abs(F.col(k)["v"] - F.col("__x")).alias("d"), F.col(k)["id"].alias("id"), F.col(k)["v"].alias("v")))
    best = near.select("__x", F.least(*[far(k) for k in ("__p", "__n", "__q", "__m")]).alias("__best"))
    out = targets.select(F.col(target_id).alias("__tid"), F.col(x).alias("__x")).join(best, "__x", "left")
    return out.select(F.col("__tid").alias(target_id), F.col("__x").alias(x),
                      F.col("__best.id").alias(cand_id), F.col("__best.v").alias(f"{cand_id}_x"),
                      F.col("__best.d").alias("abs_diff"))


def detector_frame(df: DataFrame, m1: str = "mass1_source", m2: str = "mass2_source",
                   z: str = "redshift") -> DataFrame:
    """FN10: detector-frame masses m (1 + z) and their chirp mass."""
    return (df.withColumn("mass1", F.col(m1) * (1 + F.col(z)))
            .withColumn("mass2", F.col(m2) * (1 + F.col(z)))
            .withColumn("chirp_mass", chirp_mass("mass1", "mass2")))


def simulation_ids(df: DataFrame, order: str, name: str = "simulation_id",
                   max_rows: int | None = None) -> DataFrame:
    """WIN4: dense 0-based ids in ``order`` (a column of any sortable type;
    nulls first, equal values in any order). The table is range-partitioned and
    sorted once and stored; a row's id is its place in its partition plus the
    sizes of the partitions before it (one small row per partition), so no task
    sees more than a partition. ``max_rows`` bounds the rows of a partition."""
    salted = df.withColumn("__salt", F.monotonically_increasing_id())       # equal values are split too
    parts = [max(1, -(-df.count() // max_rows))] if max_rows else []
    placed = (salted.repartitionByRange(*parts, order, "__salt").sortWithinPartitions(order, "__salt")
              .drop("__salt").withColumn("__pos", F.monotonically_increasing_id()))
    rows = checkpoint_table(placed, "ids")
    part = F.shiftright("__pos", 33)
    sizes = rows.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    out = rows.withColumn("__part", part).join(offsets, "__part")
    return out.withColumn(name, F.col("__off") + F.col("__pos").bitwiseAND(F.lit(2 ** 33 - 1))).drop("__part", "__off", "__pos")


def injection_rows(df: DataFrame, seed: int = 0, snid: str = "snid", ra: str = "ra", dec: str = "dec",
                   costheta: str = "costheta", first_detection: str | None = "first_detection",
                   gps_start: float = 1e9, gps_step: float = 1000.0, id_col: str = "simulation_id") -> DataFrame:
    """FN12: rows of the injection table. Deterministic part: radians, merger
    time = first detection (GPS) - 7200 s (or gps_start + i * gps_step when the
    column is missing), source 'GAL<snid>', symmetric mass ratio, constants.
    Random parts (phases; isotropic inclination, only when the whole costheta
    column is NaN or NULL) come from a hash of (id, seed), so they repeat on retries."""
    from skyflux.operators.classification import uniform
    two_pi = 2 * math.pi
    if first_detection and first_detection in df.columns:
        t = F.col(first_detection) - MERGER_DELAY_S
    else:
        t = F.lit(gps_start) + F.col(id_col) * gps_step
    inc = F.acos(F.col(costheta))
    if df.agg(F.coalesce(F.bool_and(F.col(costheta).isNull() | F.isnan(costheta)), F.lit(False))).first()[0]:
        inc = F.acos(F.lit(2.0) * uniform(seed, F.col(id_col), F.lit(0)) - 1.0)
    return df.select(
        F.col(id_col),
        F.concat(F.lit("GAL"), F.col(snid).cast("string")).alias("source"),
        F.col("mass1"), F.col("mass2"),
        chirp_mass("mass1", "mass2").alias("mchirp"),
        symmetric_mass_ratio("mass1", "mass2").alias("eta"),
        F.col("distance"),
        (F.col(ra) / 180.0 * math.pi).alias("longitude"),
        (F.col(dec) / 180.0 * math.pi).alias("latitude"),
        inc.alias("inclination"),
        t.alias("geocent_end_time"),
        (uniform(seed, F.col(id_col), F.lit(1)) * two_pi).alias("coa_phase"),
        (uniform(seed, F.col(id_col), F.lit(2)) * two_pi).alias("polarization"),
        F.lit(WAVEFORM).alias("waveform"), F.lit(F_LOWER).alias("f_lower"),
        F.lit(0.0).alias("spin1z"), F.lit(0.0).alias("spin2z"), F.lit(-1).alias("amp_order"),
        F.lit("TAPER_NONE").alias("taper"))


# ---------------------------------------------------------------- cosmology
def distance_grid(spark: SparkSession, h0: float = 70.0, om0: float = 0.3, z_max: float = 3.0,
                  n: int = 30000) -> DataFrame:
    """Flat LambdaCDM luminosity distance on a uniform z grid (trapezoid rule
    for the comoving integral; radiation neglected). ``n`` rows, computed on
    the executors; the running integral is a window over this fixed grid."""
    dz = z_max / n
    g = spark.range(n + 1).select(F.col("id").alias("i"), (F.col("id") * dz).alias("z"))
    inv_e = 1.0 / F.sqrt(F.lit(om0) * F.pow(1 + F.col("z"), 3) + (1 - om0))
    w = Window.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    g = g.withColumn("__f", inv_e).withColumn("__trap", F.coalesce(
        (F.col("__f") + F.lag("__f").over(Window.orderBy("i"))) * (dz / 2), F.lit(0.0)))
    g = g.withColumn("__dc", F.sum("__trap").over(w) * (C_KM_S / h0))
    return g.select("i", "z", ((1 + F.col("z")) * F.col("__dc")).alias("d_l"))


def _comoving(z: Column, om0: float) -> Column:
    """Comoving distance to ``z`` in Hubble lengths, flat LambdaCDM. With t =
    (1 + z)^(-1/2) the integrand dz / E(z) is 2 dt / sqrt(Om + OL t^6) on [t(z),
    1], smooth and bounded up to any redshift, so one Gauss-Legendre rule holds
    to rounding: an expression of the row, without a table, join or window."""
    x, w = np.polynomial.legendre.leggauss(NODES)
    width = -F.expm1(F.log1p(z) * -0.5)                       # 1 - t, exact for small z
    total = None
    for xi, wi in zip((x + 1) / 2, w / 2):
        t = F.lit(1.0) - width * F.lit(float(xi))
        t3 = t * t * t
        term = F.lit(float(2 * wi)) / F.sqrt(F.lit(float(om0)) + F.lit(1.0 - om0) * t3 * t3)
        total = term if total is None else total + term
    return width * total


def luminosity_distance(df: DataFrame, z: str, grid: DataFrame | None = None, name: str = "distance",
                        h0: float = 70.0, om0: float = 0.3) -> DataFrame:
    """FN13: luminosity distance (Mpc) of each z in flat LambdaCDM, by
    quadrature per row (``_comoving``). With ``grid`` (i, z, d_l: a caller's
    tabulated cosmology) by linear interpolation instead; the grid index is
    computed, so the lookup is an equi-join. A z that is null, NaN, negative or
    past the end of a given grid has a null distance."""
    if grid is None:
        at = F.when((F.col(z) >= 0) & ~F.isnan(F.col(z).cast("double")), F.col(z).cast("double"))
        return df.withColumn(name, (1 + at) * _comoving(at, om0) * (C_KM_S / h0))
    n, z_end = grid.agg(F.max("i"), F.max("z")).first()
    dz = grid.filter(F.col("i") == 1).first()["z"]
    g0 = grid.select(F.col("i").alias("__i"), F.col("z").alias("__z0"), F.col("d_l").alias("__d0"))
    g1 = grid.select((F.col("i") - 1).alias("__i"), F.col("d_l").alias("__d1"))
    seg = g0.join(g1, "__i")
    i = F.floor(F.col(z) / dz).cast("long")
    x = df.withColumn("__i", F.when((i >= n) & (F.col(z) <= z_end), F.lit(n - 1)).otherwise(i))
    out = x.join(seg, "__i", "left")
    frac = (F.col(z) - F.col("__z0")) / dz
    return out.withColumn(name, F.col("__d0") + frac * (F.col("__d1") - F.col("__d0"))) \
        .drop("__i", "__z0", "__d0", "__d1")


def redshift_from_distance(df: DataFrame, d: str, grid: DataFrame | None = None, name: str = "z",
                           h0: float = 70.0, om0: float = 0.3) -> DataFrame:
    """FN14: inverse of FN13 by NEWTON_STEPS Newton steps of log distance in log
    redshift, whose slope is between 1 and 2 everywhere, started at Hubble's
    law; one projection per step. With ``grid`` each distance finds its segment
    through an interval join and is interpolated. Every row is kept; a distance
    that is null, NaN, negative or outside a given grid has a null z."""
    if grid is None:
        far = F.when((F.col(d) >= 0) & ~F.isnan(F.col(d).cast("double")), F.col(d).cast("double") * (h0 / C_KM_S))
        out = df.withColumn("__d", far).withColumn("__z", F.col("__d"))
        for _ in range(NEWTON_STEPS):
            zz = F.col("__z")
            out = out.withColumn("__c", _comoving(zz, om0))
            e = F.sqrt(F.lit(float(om0)) * F.pow(1 + zz, 3) + F.lit(1.0 - om0))
            slope = zz * (1 / (1 + zz) + 1 / (e * F.col("__c")))
            step = F.log((1 + zz) * F.col("__c") / F.col("__d")) / slope
            out = out.withColumn("__z", F.when(F.col("__d") > 0, zz * F.exp(-step)).otherwise(F.col("__d")))
        return out.withColumn(name, F.col("__z")).drop("__d", "__z", "__c")
    g0 = grid.select(F.col("i"), F.col("z").alias("__z0"), F.col("d_l").alias("__d0"))
    g1 = grid.select((F.col("i") - 1).alias("i"), F.col("z").alias("__z1"), F.col("d_l").alias("__d1"))
    seg = g0.join(g1, "i").drop("i")
    width = seg.agg(F.max(F.col("__d1") - F.col("__d0"))).first()[0]
    hit = interval_join(df, seg, d, "__d0", "__d1", bucket=float(width), integral=False, how="left")
    frac = (F.col(d) - F.col("__d0")) / (F.col("__d1") - F.col("__d0"))
    return hit.withColumn(name, F.col("__z0") + frac * (F.col("__z1") - F.col("__z0"))) \
        .drop("__z0", "__d0", "__z1", "__d1")


def gps_of_mjd(df: DataFrame, mjd: str, name: str = "first_detection") -> DataFrame:
    """FN15 applied to a column (GPS seconds, constant leap-second offset)."""
    return df.withColumn(name, mjd_to_gps(mjd))


def skymap_manifest(maps: DataFrame, coinc: DataFrame, mjd: DataFrame, file_col: str = "path",
                    sim: str = "simulation_id", key: str = "SNID", mjd_col: str = "MJD",
                    decimals: int = 4) -> DataFrame:
    """SRC17: sky-map file (simulation id in the name) -> SNID -> MJD -> target
    name ``SNID_<snid>_MJD_<mjd>.fits``. Each map must match exactly one SNID
    with an MJD and every map must be matched; violations raise (a small check job)."""
    m = maps.withColumn(sim, F.regexp_extract(F.col(file_col), r"(\d+)\.fits$", 1).cast("long"))
    j = m.join(coinc.select(sim, key), sim, "left").join(mjd.select(key, mjd_col), key, "left")
    bad = (j.groupBy(file_col).agg(F.count(key).alias("n"), F.count(mjd_col).alias("t"), F.count(F.lit(1)).alias("rows"))
           .filter("n <> 1 OR t <> 1 OR rows <> 1").limit(1).count())
    if bad:
        raise ValueError("every sky map must match exactly one SNID that has an MJD")
    return j.select(file_col, sim, key, mjd_col,
                    F.format_string(f"SNID_%d_MJD_%.{decimals}f.fits", F.col(key), F.col(mjd_col)).alias("target"))


def mass_inversion(head: DataFrame, templates: DataFrame, candidates: DataFrame, max_mej: float = 0.05, tol: float = 0.005,
                   key: str = "SNID", z: str = "REDSHIFT_FINAL", forward: str = "mej", **cosmology) -> DataFrame:
    """The mass inversion as one flow: positive redshifts, template parameters,
    ejecta mass 10^LOGMASS up to ``max_mej``, the candidate whose ``forward``
    value is closest within ``tol``, failed inversions removed, detector-frame
    masses and chirp mass, luminosity distance (Planck 2018 unless given)."""
    from skyflux.functions.physics import ejecta_from_log
    from skyflux.operators.filters import drop_failed_masses, max_ejecta, positive_redshift
    h = attach_template_params(positive_redshift(head, z), templates)
    h = max_ejecta(h.withColumn("mej", ejecta_from_log("LOGMASS")), "mej", max_mej)
    hit = match_within_tolerance(h.select(F.col(key).alias("target_id"), F.col("mej").alias("x")),
                                 candidates.select("cand_id", F.col(forward).alias("x")), tol=tol)
    hit = hit.select(F.col("target_id").alias(key), "cand_id").join(
        candidates.select("cand_id", F.col("m1").alias("mass1_source"), F.col("m2").alias("mass2_source")), "cand_id", "left")
    out = h.select(key, F.col(z).alias("redshift"), "mej").join(hit, key)
    out = detector_frame(drop_failed_masses(out, "mass1_source", "mass2_source"))
    return luminosity_distance(out, "redshift", **(cosmology or PLANCK18))
