"""Sky association edges (RA wrap, poles) and GW catalogue helpers."""

import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyflux.operators import gw, pixels, sky


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_associate_across_ra_wrap_and_poles(spark):
    objs = spark.createDataFrame([(1, 359.99995, 0.0), (2, 10.0, 89.99990), (3, 180.0, -89.9999),
                                  (4, 0.0002, 0.0)], "objectId long, ra double, decl double")
    srcs = spark.createDataFrame([(10, 0.00005, 0.0), (20, 190.0, 89.99991), (30, 0.0, -89.99995),
                                  (40, 50.0, 50.0)], "sourceId long, ra double, decl double")
    out = {r.sourceId: r.objectId for r in sky.associate_by_position(srcs, objs, 1.0).collect()}
    assert out == {10: 1, 20: 2, 30: 3}
    plan = _plan(sky.associate_by_position(srcs, objs, 1.0))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_associate_nearest_wins(spark):
    objs = spark.createDataFrame([(1, 10.0, 10.0), (2, 10.0, 10.0002)], "objectId long, ra double, decl double")
    srcs = spark.createDataFrame([(5, 10.0, 10.00015)], "sourceId long, ra double, decl double")
    assert sky.associate_by_position(srcs, objs, 1.0).first().objectId == 2


def test_cone_search(spark):
    df = spark.createDataFrame([(1, 10.0, 0.0), (2, 12.5, 0.0), (3, 10.0, 3.0)], "objectId long, ra double, decl double")
    got = sorted(r.objectId for r in sky.cone_search(df, 10.0, 0.0, 2.6).collect())
    assert got == [1, 2]


def test_match_within_tolerance_exact(spark):
    rng = np.random.default_rng(1)
    tx, cx = rng.uniform(0, 1, 200), rng.uniform(0, 1, 300)
    t = spark.createDataFrame([(i, float(x)) for i, x in enumerate(tx)], "target_id long, x double")
    c = spark.createDataFrame([(i, float(x)) for i, x in enumerate(cx)], "cand_id long, x double")
    res = {r.target_id: r.cand_id for r in gw.match_within_tolerance(t, c, "x", 0.002).collect()}
    for i, x in enumerate(tx):
        d = np.abs(cx - x)
        ok = np.where(d <= 0.002)[0]
        want = None if len(ok) == 0 else int(min(ok, key=lambda j: (d[j], j)))
        assert res[i] == want
    assert "CartesianProduct" not in _plan(gw.match_within_tolerance(t, c, "x", 0.002))


def test_component_masses_invert_chirp(spark):
    from skyflux.functions.physics import chirp_mass, component_masses
    df = spark.createDataFrame([(1.2, 0.8)], "mc double, q double")
    m1, m2 = component_masses("mc", "q")
    r = df.select(m1.alias("m1"), m2.alias("m2")).withColumn("mc2", chirp_mass("m1", "m2")).first()
    assert abs(r.mc2 - 1.2) < 1e-12 and abs(r.m2 / r.m1 - 0.8) < 1e-12


def test_distance_grid_and_inverse(spark):
    grid = gw.distance_grid(spark, n=20000)
    z = spark.createDataFrame([(1, 0.1), (2, 1.0)], "id long, z double")
    d = {r.id: r.distance for r in gw.luminosity_distance(z, "z", grid).collect()}
    # numeric reference: D_L = (1+z) c/H0 int dz/E(z)
    for k, zz in ((1, 0.1), (2, 1.0)):
        xs = np.linspace(0, zz, 200001)
        f = 1 / np.sqrt(0.3 * (1 + xs) ** 3 + 0.7)
        integ = float(np.sum((f[1:] + f[:-1]) / 2 * np.diff(xs)))
        ref = (1 + zz) * 299792.458 / 70 * integ
        assert abs(d[k] - ref) / ref < 1e-6
    back = gw.redshift_from_distance(spark.createDataFrame([(1, d[1]), (2, d[2])], "id long, distance double"),
                                     "distance", grid)
    zs = {r.id: r.z for r in back.collect()}
    assert abs(zs[1] - 0.1) < 1e-6 and abs(zs[2] - 1.0) < 1e-6


def test_simulation_ids_dense(spark):
    df = spark.range(0, 1000, 7).select((F.col("id") * 3).alias("SNID")).repartition(5)
    for mr in (None, 10):
        ids = sorted((r.SNID, r.simulation_id) for r in gw.simulation_ids(df, "SNID", max_rows=mr).collect())
        assert [i for _, i in ids] == list(range(len(ids)))


def test_copies_do_not_multiply_pairs(spark):
    # a third of the objects are copies at one position: the nearest-wins answer
    # is the lowest id there, and the joins see one row per position
    objs = spark.createDataFrame([(i, 10.0, 10.0) for i in range(50, 80)] + [(1, 10.0, 10.00025)],
                                 "objectId long, ra double, decl double")
    srcs = spark.createDataFrame([(i, 10.0, 10.0001) for i in range(40)], "sourceId long, ra double, decl double")
    out = sky.associate_by_position(srcs, objs, 1.0).collect()
    assert len(out) == 40 and {r.objectId for r in out} == {50}
    t = spark.createDataFrame([(i, 0.5) for i in range(30)], "target_id long, x double")
    c = spark.createDataFrame([(i, 0.5004) for i in range(5, 20)] + [(2, 0.4997)], "cand_id long, x double")
    res = {r.cand_id for r in gw.match_within_tolerance(t, c, "x", 0.001).collect()}
    assert res == {2}


def test_running_sum_matches_window(spark):
    from pyspark.sql import Window
    from skyflux.operators.ordered import running_sum
    rows = [(m, i, float((i * 7919) % 101)) for m in ("a", "b") for i in range(2000 if m == "a" else 50)]
    df = spark.createDataFrame(rows, "map_id string, pix long, prob double").repartition(5)
    a = {(r.map_id, r.pix): r.c for r in running_sum(df, ["map_id"], ["prob", "pix"], "prob", "c",
                                                     descending=True, max_rows=150).collect()}
    w = Window.partitionBy("map_id").orderBy(F.col("prob").desc(), "pix").rowsBetween(Window.unboundedPreceding, 0)
    b = {(r.map_id, r.pix): r.c for r in df.withColumn("c", F.sum("prob").over(w)).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-6 for k in a)


def test_distances_past_any_grid(spark):
    df = spark.createDataFrame([(0.5,), (3.0,), (6.0,), (None,)], "z double")
    d = {r.z: r.distance for r in gw.luminosity_distance(df, "z").collect()}
    assert d[None] is None and abs(d[6.0] - 57728) < 3 and d[0.5] < d[3.0] < d[6.0]
    short = gw.distance_grid(spark, z_max=1.0, n=1000)
    cut = {r.z: r.distance for r in gw.luminosity_distance(df, "z", short).collect()}
    assert cut[6.0] is None and abs(cut[0.5] - d[0.5]) < 1e-2
    back = gw.redshift_from_distance(spark.createDataFrame([(d[0.5],), (d[6.0],), (None,)], "x double"), "x")
    assert sorted(round(r.z, 6) for r in back.collect() if r.z is not None) == [0.5, 6.0] and back.count() == 3
    assert gw.redshift_from_distance(spark.createDataFrame([(1e6,)], "x double"), "x", short).first().z is None
    planck = gw.luminosity_distance(df, "z", **gw.PLANCK18).filter("z = 0.5").first().distance
    assert planck != d[0.5] and 2800 < planck < 3000


def test_pad_num_keeps_long_numbers(spark):
    from skyflux.functions.ids import pad_num
    got = [r[0] for r in spark.createDataFrame([(7,), (12345,)], "n long").select(pad_num("n")).collect()]
    assert got == ["0007", "12345"]


def test_match_is_linear_and_nearest(spark):
    import random
    rnd = random.Random(1)
    t = [(i, rnd.choice([rnd.random(), 0.5, 0.5001])) for i in range(300)] + [(999, None)]
    c = [(i, rnd.choice([rnd.random(), 0.5, 0.4995])) for i in range(300)]
    got = {r.target_id: (r.cand_id, r.abs_diff) for r in gw.match_within_tolerance(
        spark.createDataFrame(t, "target_id long, x double"), spark.createDataFrame(c, "cand_id long, x double"), tol=0.003).collect()}
    for i, x in t:
        best = min(((abs(y - x), j) for j, y in c if abs(y - x) <= 0.003), default=None) if x is not None else None
        assert got[i][1] == (best[0] if best else None)
        assert got[i][0] == (best[1] if best else None)


def test_unmatched_map_raises(spark):
    import pytest
    maps = spark.createDataFrame([("m/1.fits",), ("m/2.fits",)], "path string")
    coinc = spark.createDataFrame([(1, 5), (2, 6)], "simulation_id long, SNID long")
    ok = spark.createDataFrame([(5, 60000.5), (6, 60001.0)], "SNID long, MJD double")
    assert {r.target for r in gw.skymap_manifest(maps, coinc, ok).collect()} == {"SNID_5_MJD_60000.5000.fits", "SNID_6_MJD_60001.0000.fits"}
    for bad in (ok.filter("SNID = 5"), ok.withColumn("MJD", F.when(F.col("SNID") == 5, F.col("MJD")))):
        with pytest.raises(ValueError):
            gw.skymap_manifest(maps, coinc, bad)


def test_leap_seconds(spark):
    from skyflux.functions import timefn as tf
    got = [r[0] for r in spark.createDataFrame([(44244.0,), (50000.0,), (60000.0,)], "m double").select(tf.mjd_to_gps("m")).collect()]
    assert got == [0.0, (50000 - 44244) * 86400 + 10, (60000 - 44244) * 86400 + 18]
    jd = spark.createDataFrame([(50000.25,)], "m double").select(tf.gps_to_jd(tf.mjd_to_gps("m"))).first()[0]
    assert abs(jd - 2450000.75) < 1e-8


def test_distance_by_quadrature(spark):
    """Against a fine sum up to z = 1,100, edge values, and the inverse at any distance."""
    zs = [0.0, 1e-12, 1e-4, 0.1, 0.7, 3.0, 20.0, 1100.0]
    df = spark.createDataFrame([(z,) for z in zs] + [(None,), (float("nan"),), (-0.5,)], "z double")
    for cosmology in ({}, gw.PLANCK18):
        h0, om = cosmology.get("h0", 70.0), cosmology.get("om0", 0.3)
        out = gw.luminosity_distance(df, "z", **cosmology)
        got = {r.z: r.distance for r in out.collect()}
        for z in zs:
            t = np.linspace(0, 1, 200_001)
            y = np.log1p(z) * t                                  # midpoint rule in log(1 + z)
            mid = (y[1:] + y[:-1]) / 2
            fine = (np.exp(mid) / np.sqrt(om * np.exp(3 * mid) + 1 - om)).mean() * np.log1p(z)
            assert got[z] == pytest.approx((1 + z) * fine * gw.C_KM_S / h0, rel=1e-8, abs=1e-300)
        assert all(r.distance is None for r in out.filter("z is null or isnan(z) or z < 0").collect())
        back = gw.redshift_from_distance(out.filter("z >= 0 and not isnan(z)").select("z", F.col("distance").alias("x")), "x", name="back", **cosmology)
        assert all(r.back == pytest.approx(r.z, rel=1e-9, abs=1e-300) for r in back.collect())
    odd = spark.createDataFrame([(1, None), (2, float("nan")), (3, -1.0), (4, 1e9), (5, 0.0)], "i int, x double")
    got = {r.i: r.z for r in gw.redshift_from_distance(odd, "x").collect()}
    assert got[1] is None and got[2] is None and got[3] is None and got[5] == 0.0 and got[4] > 1e4
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


@pytest.mark.parametrize("key,values", [("string", ["b", "a", None, "a", "c", "ä", "", "z", "a", "y"]), ("date", None), ("double", [3.5, -1.0, None, 2.0, 2.0, 9.0])])
def test_simulation_ids_of_any_key(spark, key, values):
    values = values or [datetime.date(2024, 1, d) for d in (9, 1, 5, 5, 30)]
    df = spark.createDataFrame([(v,) for v in values], f"k {key}")
    order = sorted(values, key=lambda v: (v is not None, v if not isinstance(v, str) else v.encode()))if None in values else sorted(values)
    for most in (None, 1, 4, 2_000_000):
        got = gw.simulation_ids(df, "k", max_rows=most).orderBy("simulation_id").collect()
        assert [r.simulation_id for r in got] == list(range(len(values))) and [r.k for r in got] == order
    assert gw.simulation_ids(df.limit(0), "k").count() == 0


def _points(n=4000):
    rnd = np.random.default_rng(4)
    ra, dec = rnd.uniform(0, 360, n), np.degrees(np.arcsin(rnd.uniform(-1, 1, n)))
    rows = [(i, float(a), float(d)) for i, (a, d) in enumerate(zip(ra, dec))]
    near = [(0.0, 0.0), (359.9999, 0.5), (0.0001, -0.5), (360.0, 1.0), (-0.3, 0.2), (720.2, 0.1), (10.0, 89.9), (190.0, 89.95), (77.0, 90.0),
            (200.0, -90.0), (33.0, -89.8), (180.0, 0.0), (180.0, 60.0)]
    return rows + [(n + i, a, d) for i, (a, d) in enumerate(near)] + [(n + 50, None, 1.0), (n + 51, 1.0, None), (n + 52, float("nan"), 0.0)]


def test_nested_pixels_hold_their_children(spark):
    df = spark.createDataFrame(_points(), "id long, ra double, dec double").withColumn("p", pixels.pixel("ra", "dec"))
    for k in (0, 1, 5, 13):
        own = df.withColumn("k", pixels.pixel("ra", "dec", k)).withColumn("up", pixels.parent("p", k))
        assert own.filter("k <> up").count() == 0 and own.filter(f"k < 0 OR k >= {4 ** k}").count() == 0
    assert df.filter("p IS NULL").count() == 3
    share = df.filter("id < 4000").groupBy(pixels.parent("p", 1)).count().collect()
    assert len(share) == 4 and all(abs(r["count"] - 1000) < 150 for r in share)            # equal areas


@pytest.mark.parametrize("ra0,dec0,r", [(0.0, 0.0, 1.0), (359.9, 0.4, 2.0), (100.0, 20.0, 10.0), (10.0, 89.5, 1.0), (200.0, -89.9, 0.5),
                                        (45.0, 90.0, 3.0), (180.0, 0.0, 0.0), (180.0, 60.0, 40.0), (30.0, 10.0, 95.0), (0.0, 0.0, 180.0), (-0.3, 0.2, 1e-6)])
def test_cone_search_by_pixels_is_the_plain_one(spark, ra0, dec0, r):
    pts = _points()
    df = spark.createDataFrame(pts, "id long, ra double, decl double")
    want = {x.id for x in df.withColumn("s", sky.angular_separation(F.lit(ra0), F.lit(dec0), F.col("ra"), F.col("decl")))
            .filter(F.col("s") <= r).filter("NOT isnan(ra) AND ra IS NOT NULL AND decl IS NOT NULL").collect()}
    got = {x.id for x in pixels.cone_search(pixels.with_pixel(df), ra0, dec0, r).collect()}
    assert got == want
    ranges = pixels.cone_cover(ra0, dec0, r)
    assert 0 < len(ranges) <= pixels.MAX_RANGES and all(a < b for a, b in ranges) and all(x[1] < y[0] for x, y in zip(ranges, ranges[1:]))
    if 0 < r < 5 and abs(dec0) < 45:
        assert sum(b - a for a, b in ranges) / 4 ** pixels.ORDER < 40 * (r / 57) ** 2      # both axes are cut


def test_cone_ranges_reach_the_scan(spark, scratch):
    path = scratch("pixels")
    pixels.sort_by_pixel(spark.createDataFrame(_points(), "id long, ra double, decl double"), partitions=4).write.parquet(path)
    found = pixels.cone_search(spark.read.parquet(path), 100.0, 20.0, 3.0)
    found.count()
    assert "PushedFilters: [Or(" in _plan(found).replace("PushedFilters: [IsNotNull(pix), Or(", "PushedFilters: [Or(") and "GreaterThanOrEqual(pix" in _plan(found)
    import glob

    import pyarrow.parquet as pq
    spans = [pq.read_metadata(f).row_group(0).column(3).statistics for f in glob.glob(path.replace("file:", "") + "/*.parquet")]
    cover = pixels.cone_cover(100.0, 20.0, 3.0)
    hit = [any(s.min < b and s.max >= a for a, b in cover) for s in spans]
    assert len(spans) == 4 and sum(hit) < 4                                                # files that cannot match are skipped


def test_multiorder_crossmatch(spark):
    """Against every object and pixel; nothing outside a region is paired."""
    rnd = np.random.default_rng(8)
    objs = pixels.with_pixel(spark.createDataFrame(_points(300), "objectId long, ra double, decl double"))
    maps = []
    for m in ("a", "b"):
        for p in range(16):                                                                # order 2, some cut into order 4, one into order 6
            k = {0: 2, 1: 4, 2: 6}[min(p % 5, 2)]
            maps += [(m, k, (p << 2 * (k - 2)) + c, float(rnd.random())) for c in range(4 ** (k - 2))]
    total = {m: sum(x[3] for x in maps if x[0] == m) for m in "ab"}
    maps = [(m, k, p, w / total[m]) for m, k, p, w in maps] + [("a", None, 3, 0.1), (None, 2, 1, 0.5)]
    got = pixels.crossmatch_multiorder(objs, spark.createDataFrame(maps, "map_id string, order int, map_pix long, prob double"), credible=0.6).collect()
    want = set()
    for m in "ab":
        mine = sorted(((w / (4 * math.pi / 4 ** k), k, p, w) for n, k, p, w in maps if n == m and k is not None), key=lambda x: (-x[0], x[1], x[2]))
        done, region = 0.0, set()
        for _, k, p, w in mine:
            if done < 0.6:
                region.add((k, p))
            done += w
        want |= {(o.objectId, m, k, p) for o in objs.collect() if o.pix is not None for k, p in region if o.pix >> 2 * (pixels.ORDER - k) == p}
    assert {(r.objectId, r.map_id, r.order, r.map_pix) for r in got} == want and len(got) == len(want)
    empty = spark.createDataFrame([], "map_id string, order int, map_pix long, prob double")
    assert pixels.crossmatch_multiorder(objs, empty).count() == 0


def test_match_dense_values_fill_several_partitions(spark):
    """All values within one tolerance: the work is still dealt to several partitions, with equal results."""
    t = spark.range(4000).select(F.col("id").alias("target_id"), (0.5 + F.col("id") * 1e-7).alias("x"))
    c = spark.range(0, 4000, 37).select(F.col("id").alias("cand_id"), (0.5 + F.col("id") * 1e-7 + 3e-8).alias("x"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = gw.match_within_tolerance(t, c, tol=0.01)
        got = {r.target_id: r.cand_id for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    xs = [(0.5 + i * 1e-7 + 3e-8, i) for i in range(0, 4000, 37)]
    assert got == {i: min((abs(v - (0.5 + i * 1e-7)), j) for v, j in xs)[1] for i in range(4000)}
