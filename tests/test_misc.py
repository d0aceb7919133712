"""Smaller contracts: night ranges, sampling, candidate grid, restart, progress."""

from pyspark.sql import functions as F

from skyflux.functions.timefn import gps_to_jd, mjd_to_gps, night_range
from skyflux.operators import gw
from skyflux.operators import lightcurves as lc
from skyflux.streaming import io as sio
from skyflux.streaming import ops as sops


def test_night_range_clamps_and_empties(spark):
    df = spark.createDataFrame([(0,), (3,), (9,), (10,)], "day int")
    n0, n1 = night_range(F.col("day"), F.lit(60310), F.lit(60339), F.lit(3))
    r = {x.day: (x.a, x.b) for x in df.select("day", n0.alias("a"), n1.alias("b")).collect()}
    assert r[0] == (60310, 60312) and r[3] == (60319, 60321) and r[9] == (60337, 60339)
    assert r[10] == (None, None)


def test_gps_round_trip(spark):
    df = spark.createDataFrame([(60000.25,)], "mjd double")
    r = df.select(gps_to_jd(mjd_to_gps("mjd")).alias("jd")).first()
    assert abs(r.jd - (60000.25 + 2400000.5)) < 1e-9


def test_sample_objects_repeatable(spark):
    df = spark.range(100).select(F.col("id").alias("SNID"))
    a = [r.SNID for r in lc.sample_objects(df, seed=5, k=4).collect()]
    b = [r.SNID for r in lc.sample_objects(df.repartition(7), seed=5, k=4).collect()]
    assert a == b and len(set(a)) == 4


def test_candidate_grid_bounds(spark):
    g = gw.candidate_grid(spark, n_mc=10, n_q=6)
    assert g.count() == 60
    kept = gw.mass_bounds(g)
    assert kept.filter((F.col("m2") < 1.0) | (F.col("m1") > 2.21)).count() == 0


def test_restart_from_start_new_checkpoint():
    opts, ck = sio.restart_from_start({"subscribe": "t", "startingOffsets": "latest"}, "/ckpt/base")
    assert opts["startingOffsets"] == "earliest" and ck.startswith("/ckpt/base/restart-")


def test_stream_progress_aggregation(spark):
    df = spark.createDataFrame([("a", 0, 1, 10), ("a", 0, 2, 11), ("a", 1, 7, 12)],
                               "topic string, partition int, offset long, timestamp long")
    r = {(x.topic, x.partition): (x.n_messages, x.last_offset) for x in sops.stream_progress(df).collect()}
    assert r == {("a", 0): (2, 2), ("a", 1): (1, 7)}


def test_append_new_only_is_idempotent(spark):
    from skyflux.operators.loading import append_new_only, missing_keys
    existing = spark.createDataFrame([(1, "a"), (2, "b")], "alertId long, v string")
    new = spark.createDataFrame([(2, "b"), (3, "c"), (3, "c"), (4, "d")], existing.schema)
    first = append_new_only(new, existing, ["alertId"])
    assert sorted(r.alertId for r in first.collect()) == [3, 4]
    stored = existing.unionByName(first)
    assert append_new_only(new, stored, ["alertId"]).count() == 0
    assert sorted(r.alertId for r in missing_keys(new, existing, "alertId").distinct().collect()) == [3, 4]


def test_interval_join_boundaries(spark):
    from skyflux.operators.intervals import interval_join
    iv = spark.createDataFrame([(0.0, 1.5, "a"), (1.5, 4.0, "b"), (10.0, 10.5, "c")], "lo double, hi double, name string")
    pts = spark.createDataFrame([(0.0,), (1.5,), (3.999,), (4.0,), (10.2,), (-1.0,)], "x double")
    got = sorted((r.x, r.name) for r in interval_join(pts, iv, "x", "lo", "hi", bucket=0.7, integral=False).collect())
    assert got == [(0.0, "a"), (1.5, "b"), (3.999, "b"), (10.2, "c")]
    left = interval_join(pts, iv, "x", "lo", "hi", bucket=0.7, integral=False, how="left")
    assert left.count() == 6


def test_nightly_totals_and_bounded_exposure_batches(spark):
    from skyflux.operators import alerts as al
    rows = [(i, 60000.0 + (i % 5) * 0.3 + i * 1e-4, "x" * (i % 3 + 1)) for i in range(50)]
    df = spark.createDataFrame(rows, "alertId long, midPointTai double, payload string")
    st = {r.night: (r.n_alerts, r.n_bytes) for r in al.nightly_stats(df).collect()}
    total = st.pop(None)
    assert total == (sum(v[0] for v in st.values()), sum(v[1] for v in st.values())) == (50, sum(i % 3 + 1 for i in range(50)))
    b = al.exposure_batches(df.withColumn("exposure", F.floor(F.col("midPointTai") * 10) / 10), with_ids=True, max_ids=4)
    got = b.collect()
    assert max(len(r.alertIds) for r in got) <= 4 and sum(len(r.alertIds) for r in got) == 50
    assert all(r.alertIds == sorted(r.alertIds) for r in got)


def test_alert_file_metadata_ignores_other_names(spark):
    from skyflux.operators.alerts import alert_file_metadata
    names = ["alert_mjd60310.123456_obj12_src345.avro.gz", "alert_mjd60311_obj1_src2.avro", "README.txt",
             "alert_mjdX_obj1_src2.avro.gz", "alert_mjd60310.5_obj7_src8.avro.gz.bak"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = sorted((r.mjd, r.objectId, r.sourceId) for r in alert_file_metadata(df).collect())
    assert got == [(60310.123456, 12, 345), (60311.0, 1, 2)]
