"""Registered queries: file-format sources and sinks. Each writes a table
derived from the driver's data in the format (under the session's shared
checkpoint folder), reads it back through the operator; the oracle selects
from the original tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from skyflux.operators import gw
from skyflux.operators import pixels
from skyflux.plans.q_sky_gw import _hav
from skyflux.operators import lightcurves as lc
from skyflux.plans import bindings as B
from skyflux.plans.registry import query
from skyflux.plans.sql import PHOT_EV, SKY_OBJECTS, TRUTH_EV, with_
from skyflux.session import scratch_path
from skyflux.sources import parquet as pq
from skyflux.sources import text as tx


def _write_lines(df, path):
    df.select(F.col("line").alias("value")).write.mode("overwrite").text(path)


@query("read_object_truth", with_(TRUTH_EV) + "SELECT SNID, GENTYPE, ZCMB FROM truth_ev", ["ZCMB"])
def q_read_object_truth(spark, d):
    """SRC2: truth written as DUMP text (header, comments, blank lines) and read back."""
    t = B.truth_ev(spark, d)
    path = scratch_path(spark, "dump")
    head = spark.createDataFrame([("# object truth dump",), ("",), ("VARNAMES: CID GENTYPE ZCMB",)], ["line"])
    rows = t.select(F.concat_ws(" ", F.lit("SN:"), F.col("SNID").cast("string"),
                                F.col("GENTYPE").cast("string"), F.col("ZCMB").cast("string")).alias("line"))
    _write_lines(head.unionByName(rows), path)
    out = tx.read_object_truth(spark, path)
    return out.select("SNID", F.col("GENTYPE").cast("int").alias("GENTYPE"), "ZCMB")


@query("read_truth_csv", """
SELECT c_custkey AS SNID, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_nationkey END AS GENTYPE,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE (c_acctbal + CAST(1000 AS DOUBLE)) / CAST(11000 AS DOUBLE) END AS ZCMB
FROM customer""", ["ZCMB"])
def q_read_truth_csv(spark, d):
    """SRC10: CSV with comments, leading spaces, empty ints and NaN."""
    t = B.truth_ev(spark, d)
    path = scratch_path(spark, "truthcsv")
    g = F.when(F.col("SNID") % 7 == 0, F.lit("")).otherwise(F.concat(F.lit(" "), F.col("GENTYPE").cast("string")))
    z = F.when(F.col("ZCMB") < F.lit(1000.0 / 11000.0), F.lit(" nan")).otherwise(
        F.concat(F.lit("  "), F.col("ZCMB").cast("string")))
    rows = t.select(F.col("SNID").cast("string").alias("CID"), g.alias("GENTYPE"), z.alias("ZCMB"))
    note = spark.createDataFrame([("# truth table", None, None)], "CID string, GENTYPE string, ZCMB string")
    (rows.unionByName(note).write.mode("overwrite").option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("comment", "\u0001").csv(path))
    out = tx.read_truth_csv(spark, path, {"CID": "int", "GENTYPE": "int", "ZCMB": "float"},
                            renames={"CID": "SNID"})
    return out.select("SNID", F.col("GENTYPE").cast("int").alias("GENTYPE"), "ZCMB")


@query("read_gentype_map", with_(TRUTH_EV) + """
SELECT DISTINCT GENTYPE AS gentype, 'model_' || CAST(GENTYPE AS VARCHAR) AS model FROM truth_ev
UNION ALL
SELECT DISTINCT GENTYPE, 'alt_' || CAST(GENTYPE AS VARCHAR) FROM truth_ev WHERE GENTYPE % 10 = 0""")
def q_read_gentype_map(spark, d):
    """SRC11: whitespace map with comments; types divisible by 10 have two models."""
    g = B.truth_ev(spark, d).select(F.col("GENTYPE").alias("g")).distinct()
    path = scratch_path(spark, "gentype")
    lines = (g.select(F.format_string(" %d      model_%d", "g", "g").alias("line"))
             .unionByName(g.filter(F.col("g") % 10 == 0).select(F.format_string("%d alt_%d", "g", "g").alias("line")))
             .unionByName(spark.createDataFrame([("# TRUE_GENTYPE MODEL_NAME",), ("   ",)], ["line"])))
    _write_lines(lines, path)
    return tx.read_gentype_map(spark, path)


@query("read_template_index", """
SELECT CAST(p_partkey AS INTEGER) AS index, p_size / 100.0 AS VK, -1.0 - (p_size % 9) AS LOGXLAN,
       -3.0 + (p_retailprice - 900.0) / 50.0 AS LOGMASS
FROM part""", ["VK", "LOGXLAN", "LOGMASS"])
def q_read_template_index(spark, d):
    """SRC12: the template dimension written as JSON objects keyed by index
    (one object of at most 10,000 indices per file) and read back."""
    t = B.template_index(spark, d).withColumn("__part", F.floor(F.col("index") / 10000))
    js = t.groupBy("__part").agg(F.to_json(F.map_from_entries(F.collect_list(
        F.struct(F.col("index").cast("string"), F.struct("VK", "LOGXLAN", "LOGMASS"))))).alias("value"))
    path = scratch_path(spark, "template")
    js.write.mode("overwrite").partitionBy("__part").text(path)
    return tx.read_template_index(spark, path)


def _class_curves(spark, d):
    p = B.phot_ev(spark, d)
    n = lc.nest_lightcurves(p)
    return n.join(B.truth_ev(spark, d).select("SNID", F.col("GENTYPE").alias("class")), "SNID")


@query("write_read_lightcurves", with_(PHOT_EV, TRUTH_EV) + """
SELECT p.SNID, t.GENTYPE AS class, count(*) AS npts, min(p.MJD) AS mjd_min
FROM phot_ev p JOIN truth_ev t ON p.SNID = t.SNID WHERE t.GENTYPE IN (3, 7) GROUP BY p.SNID, t.GENTYPE""",
       ["mjd_min"])
def q_write_read_lightcurves(spark, d):
    """SRC6 + SRC7: nested curves written per class, two classes read back (partition pruning)."""
    path = scratch_path(spark, "curves")
    pq.write_lightcurves(_class_curves(spark, d), path)
    r = pq.read_lightcurves(spark, path, [3, 7])
    return r.select("SNID", F.col("class").cast("int").alias("class"), F.size("MJD").cast("long").alias("npts"),
                    F.array_min("MJD").alias("mjd_min"))


@query("read_lightcurves_file", with_(PHOT_EV, TRUTH_EV) + """
SELECT p.SNID, t.GENTYPE AS class, printf('%04d', CAST(p.SNID // 100 + 1 AS BIGINT)) AS file_num, count(*) AS npts
FROM phot_ev p JOIN truth_ev t ON p.SNID = t.SNID
WHERE p.SNID // 100 + 1 = (SELECT min(SNID // 100 + 1) FROM phot_ev) GROUP BY p.SNID, t.GENTYPE""")
def q_read_lightcurves_file(spark, d):
    """SRC6 + SRC7: curves written by class and file number, one file number read back."""
    path = scratch_path(spark, "curves-file")
    curves = _class_curves(spark, d).withColumn("file_num", B.file_num_of("SNID"))
    pq.write_lightcurves(curves, path, partition=["class", "file_num"])
    first = B.phot_ev(spark, d).agg(F.min(B.file_num_of("SNID"))).first()[0]
    r = pq.read_lightcurves(spark, path, file_num=first)
    return r.select("SNID", F.col("class").cast("int").alias("class"), "file_num", F.size("MJD").cast("long").alias("npts"))


@query("list_classes", with_(PHOT_EV, TRUTH_EV) + """
SELECT DISTINCT CAST(t.GENTYPE AS VARCHAR) AS class FROM phot_ev p JOIN truth_ev t ON p.SNID = t.SNID""")
def q_list_classes(spark, d):
    """SRC1: class directories (prefix stripped) of a written dataset."""
    path = scratch_path(spark, "classes")
    c = _class_curves(spark, d).withColumn("dir", F.concat(F.lit("TRAIN_"), F.col("class").cast("string")))
    pq.write_lightcurves(c.drop("class"), path, partition="dir")
    return tx.list_classes(spark, path, prefix="TRAIN_")


@query("write_csv_fixed", """
SELECT CAST(o_orderkey AS VARCHAR) AS simulation_id,
       printf('%.4f', floor((1.0 + o_totalprice / 500000.0) * 10000.0 + 0.5) / 10000.0) AS mass1,
       printf('%.4f', floor(((1.0 + o_totalprice / 500000.0) * 0.8) * 10000.0 + 0.5) / 10000.0) AS mass2,
       printf('%.4f', floor((40.0 + o_custkey % 400) * 10000.0 + 0.5) / 10000.0) AS distance
FROM orders""")
def q_write_csv_fixed(spark, d):
    """SRC16: CSV with %.4f floats, read back as text."""
    sim = B.sim_inspiral(spark, d).select("simulation_id", "mass1", "mass2", "distance")
    path = scratch_path(spark, "csvfixed")
    pq.write_csv_fixed(sim, path)
    return spark.read.option("header", True).csv(path)


@query("read_gw_tables", """
SELECT o_orderkey AS simulation_id, 'GAL' || CAST(o_custkey AS VARCHAR) AS source,
       40.0 + o_custkey % 400 AS distance FROM orders""", ["distance"])
def q_read_gw_tables(spark, d):
    """SRC13: injections exported as Parquet and read back by table name."""
    base = scratch_path(spark, "gwtables")
    B.sim_inspiral(spark, d).write.mode("overwrite").parquet(f"{base}/sim_inspiral")
    return pq.read_gw_tables(spark, base, "sim_inspiral").select("simulation_id", "source", "distance")


@query("cone_search_stored", with_(SKY_OBJECTS) + f"""
SELECT objectId, ra, decl, {_hav('100.0', '20.0', 'ra', 'decl')} AS sep_deg
FROM sky_objects WHERE {_hav('100.0', '20.0', 'ra', 'decl')} <= 10.0""", ["ra", "decl", "sep_deg"])
def q_cone_search_stored(spark, d):
    """JOIN13 on a stored object table ordered by nested pixels: the cone's id
    ranges are pushed to the Parquet scan (row groups outside them, in either
    coordinate, are skipped)."""
    path = scratch_path(spark, "objects")
    pixels.sort_by_pixel(B.sky_objects(spark, d)).write.mode("overwrite").parquet(path)
    return pixels.cone_search(spark.read.parquet(path), 100.0, 20.0, 10.0).drop("pix")


@query("lightcurve_stored", with_(PHOT_EV) + """
SELECT SNID, obs_id, MJD, BAND, FLUXCAL, FLUXCALERR, PHOTFLAG FROM phot_ev WHERE SNID = 7""",
       ["MJD", "FLUXCAL", "FLUXCALERR"])
def q_lightcurve_stored(spark, d):
    """SRC5 on a stored, SNID-clustered light-curve table: the id filter is
    pushed to the scan, so only matching row groups are read."""
    path = scratch_path(spark, "curves-long")
    lc.sort_lightcurves(B.phot_ev(spark, d), ("SNID", "BAND", "MJD"), for_storage=True) \
        .write.mode("overwrite").parquet(path)
    _, head = B.phot_files(spark, d)
    return lc.lightcurve(spark.read.parquet(path), head, 7)


@query("read_valid_class", with_(PHOT_EV, TRUTH_EV) + """
SELECT p.SNID, count(*) AS npts FROM phot_ev p JOIN truth_ev t ON p.SNID = t.SNID
WHERE CAST(t.GENTYPE AS VARCHAR) = (SELECT min(CAST(t2.GENTYPE AS VARCHAR))
                                    FROM phot_ev p2 JOIN truth_ev t2 ON p2.SNID = t2.SNID)
GROUP BY p.SNID""")
def q_read_valid_class(spark, d):
    """SRC1 + FLT9 + SRC7: list the classes of a written dataset, check the
    requested one (unknown -> ValueError), read only that class."""
    from skyflux.operators.filters import validate_class
    path = scratch_path(spark, "validcls")
    c = _class_curves(spark, d).withColumn("dir", F.concat(F.lit("TRAIN_"), F.col("class").cast("string")))
    pq.write_lightcurves(c.drop("class"), path, partition="dir")
    known = [r["class"] for r in tx.list_classes(spark, path, prefix="TRAIN_").collect()]   # class names only
    cls = validate_class(spark, known[0], known)          # the first class in listing order
    try:
        validate_class(spark, "not-a-class", known)
        raise AssertionError("unknown class accepted")
    except ValueError:
        pass
    r = pq.read_lightcurves(spark, path, [f"TRAIN_{cls}"], partition="dir")
    return r.select("SNID", F.size("MJD").cast("long").alias("npts"))


@query("join_truth_colocated", with_(PHOT_EV, TRUTH_EV) + """
SELECT p.SNID, t.GENTYPE, t.ZCMB, count(*) AS npts, max(p.MJD) AS last_mjd
FROM phot_ev p JOIN truth_ev t ON p.SNID = t.SNID GROUP BY ALL""", ["ZCMB", "last_mjd"])
def q_join_truth_colocated(spark, d):
    """SRC6 + JOIN3: curves and truth stored in like buckets of SNID; the join and
    the count per object run without a shuffle."""
    name = "skyflux_" + uuid.uuid4().hex[:10]
    phot = pq.write_colocated(B.phot_ev(spark, d), f"{name}_phot", scratch_path(spark, "colocated-phot"), buckets=8)
    truth = pq.write_colocated(B.truth_ev(spark, d), f"{name}_truth", scratch_path(spark, "colocated-truth"), buckets=8)
    return (lc.join_truth(phot, truth).groupBy("SNID", "GENTYPE", "ZCMB")
            .agg(F.count(F.lit(1)).alias("npts"), F.max("MJD").alias("last_mjd")))
