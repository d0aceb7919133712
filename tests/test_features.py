"""Photometric functions and features."""

import math

from pyspark.sql import functions as F

from skyflux.functions import photometry as ph
from skyflux.operators import features as fe
from skyflux.operators import filters as flt


def test_flux_functions_with_zero_and_negative(spark):
    df = spark.createDataFrame([(0.0, 1.0), (-5.0, 1.0), (100.0, 2.0)], "f double, e double")
    r = df.select(ph.mag_from_flux("f").alias("m"), ph.mag_error("f", "e").alias("me"),
                  ph.fractional_error("f", "e").alias("fe"), ph.snr("f", "e").alias("s")).collect()
    assert math.isinf(r[0].m) and r[0].me == 0.5
    assert abs(r[1].m - (-2.5 * math.log10(5) + 27.5)) < 1e-12
    assert abs(r[2].fe - 0.02) < 1e-15 and abs(r[2].me - 1.086 * 0.02) < 1e-12 and r[2].s == 50.0


def _det(spark, mjds, flag=4096):
    return spark.createDataFrame([(1, float(m), "g", 10.0, 1.0, flag, i) for i, m in enumerate(mjds)],
                                 "SNID long, MJD double, BAND string, FLUXCAL double, FLUXCALERR double, PHOTFLAG int, obs_id long")


def test_trigger_after_two(spark):
    assert fe.trigger_after_two(_det(spark, [])).count() == 0
    assert fe.trigger_after_two(_det(spark, [100.0])).count() == 0
    assert fe.trigger_after_two(_det(spark, [100.0, 100.01])).count() == 0
    r = fe.trigger_after_two(_det(spark, [100.0, 100.03])).first()
    assert r.MJD_TRIGGER2 == 100.03 and r.MJD_DETECT_FIRST == 100.0


def test_crop_to_detections(spark):
    rows = [(1, 10.0, 0), (1, 30.0, 4096), (1, 45.0, 0), (1, 51.0, 0), (1, 75.0, 0)]
    df = spark.createDataFrame(rows, "SNID long, MJD double, PHOTFLAG int")
    out = sorted(r.MJD for r in flt.crop_to_detections(df).collect())
    assert out == [10.0, 30.0, 45.0]


def test_cadence_and_band_features(spark):
    df = _det(spark, [1.0, 2.0, 4.0, 8.0])
    med = fe.cadence_median(df).first().median_delta_t
    assert med == 2.0
    bf = fe.band_features(df, bands="g").first()
    assert bf.delta_t_g == [1.0, 2.0, 4.0] and bf.median_delta_t_g == 2.0 and bf.magobs_g == 2.0
    assert len(bf.mjd_g) == 4


def test_object_summary_band_maxima(spark):
    rows = [(1, 1.0, "g", 10.0, 1.0, 4096, 1), (1, 2.0, "r", 50.0, 1.0, 1024, 2), (1, 3.0, "i", 20.0, 1.0, 0, 3)]
    df = spark.createDataFrame(rows, "SNID long, MJD double, BAND string, FLUXCAL double, FLUXCALERR double, PHOTFLAG int, obs_id long")
    r = fe.object_summary(df).first()
    assert (r.NOBS, r.NOBS_SATURATE, r.PEAKMJD) == (3, 1, 2.0)
    assert (r.SNRMAX, r.SNRMAX2, r.SNRMAX3) == (50.0, 20.0, 10.0)
    assert r.PEAKMAG_u is None and abs(r.PEAKMAG_r - (27.5 - 2.5 * math.log10(50))) < 1e-12


def test_skew_safe_lag_and_median_match_windows(spark):
    import random
    random.seed(3)
    # one hot (object, band) with most of the rows, spread over many slices
    rows = [(1, "g", random.random() * 100, i) for i in range(3000)] + \
           [(k, b, random.random() * 100, 10000 + k * 10 + j) for k in range(2, 40) for b in "gr" for j in range(5)]
    df = spark.createDataFrame(rows, "SNID long, BAND string, MJD double, obs_id long").repartition(6)
    a = {r.obs_id: r.delta_t for r in fe.delta_t(df, skew_safe=True).collect()}
    b = {r.obs_id: r.delta_t for r in fe.delta_t(df, skew_safe=False).collect()}
    assert a == b
    m1 = {(r.SNID, r.BAND): r.median_delta_t for r in fe.cadence_median(df, skew_safe=True).collect()}
    m2 = {(r.SNID, r.BAND): r.median_delta_t for r in fe.cadence_median(df, skew_safe=False).collect()}
    assert m1.keys() == m2.keys() and all(abs(m1[k] - m2[k]) < 1e-12 for k in m1)


def test_sliced_helpers_exact_on_a_hot_group(spark):
    import random
    from pyspark.sql import Window
    from skyflux.operators.ordered import exact_median, ordered_lag, ranked
    random.seed(5)
    rows = [(1, "g", float(random.randint(0, 500)), i) for i in range(3000)] + \
           [(k, "r", float(random.randint(0, 50)), 10000 + k * 10 + j) for k in range(2, 30) for j in range(7)]
    df = spark.createDataFrame(rows, "SNID long, BAND string, MJD double, obs_id long").repartition(7)
    w = Window.partitionBy("SNID", "BAND").orderBy("MJD", "obs_id")
    want = {r.obs_id: (r.rk, r.pv) for r in df.select("obs_id", (F.row_number().over(w) - 1).alias("rk"),
                                                         F.lag("MJD").over(w).alias("pv")).collect()}
    got = {r["obs_id"]: (r["__rank"], r["__prev"]) for r in
           ranked(df, ["SNID", "BAND"], ["MJD", "obs_id"], "MJD", max_rows=200).collect()}
    assert got == want
    lag = {r.obs_id: r.p for r in ordered_lag(df, ["SNID", "BAND"], ["MJD", "obs_id"], "MJD", "p", max_rows=200).collect()}
    assert lag == {k: v[1] for k, v in want.items()}
    med = {(r.SNID, r.BAND): r.m for r in exact_median(df, ["SNID", "BAND"], "MJD", "m", max_rows=200).collect()}
    ref = {(r.SNID, r.BAND): r.m for r in df.groupBy("SNID", "BAND").agg(F.median("MJD").alias("m")).collect()}
    assert med.keys() == ref.keys() and all(abs(med[k] - ref[k]) < 1e-9 for k in med)


def test_cut_windows_null_rule(spark):
    df = spark.createDataFrame([(1, 20.0, None), (2, 20.0, 30.0), (3, None, None)], "SNID long, PEAKMAG_g double, PEAKMAG_r double")
    w = {"PEAKMAG_g": (14, 24), "PEAKMAG_r": (14, 24)}
    assert sorted(r.SNID for r in flt.cut_windows(df, w, allow_null=True).collect()) == [1, 3]
    assert sorted(r.SNID for r in flt.cut_windows(df, w).collect()) == []


def test_ordered_types_and_ties(spark):
    """One type below and above the slicing size, and a median where most values are equal."""
    from skyflux.operators.ordered import exact_median, ranked, running_sum
    df = spark.createDataFrame([(1, i % 7, i) for i in range(500)] + [(2, 5, 0)] * 300 + [(2, i, 0) for i in range(6)], "g int, v long, i long")
    for n in (100, 10_000):
        assert dict(ranked(df, ["g"], ["v", "i"], max_rows=n).dtypes)["__rank"] == "bigint"
        assert dict(running_sum(df, ["g"], ["v", "i"], "v", "s", max_rows=n).dtypes)["s"] == "bigint"
        assert {r.g: r["median"] for r in exact_median(df, ["g"], "v", max_rows=n).collect()} == {1: 3.0, 2: 5.0}


def test_hot_transients_in_chunks(spark):
    from skyflux.operators.alerts import hot_transients
    rows = [(k, i, 60000.0 + i / 100, "gri"[i % 3], float(i), 1.0, 4096) for k in (1, 2) for i in range(100 * k)]
    df = spark.createDataFrame(rows + [(3, 0, 60000.0, "g", 1.0, 0.0, 0)], "SNID long, obs_id long, MJD double, BAND string, FLUXCAL double, FLUXCALERR double, PHOTFLAG int")
    whole = {r.SNID: r.mjd for r in hot_transients(df, 60002.0, 5.0, layout=2).collect()}
    parts = {}
    for r in sorted(hot_transients(df, 60002.0, 5.0, layout=2, max_points=30).collect(), key=lambda r: r.chunk):
        assert len(r.mjd) <= 30
        parts.setdefault(r.SNID, []).extend(r.mjd)
    assert parts == whole and set(whole) == {1, 2}
    assert hot_transients(df, 60002.0, 5.0, min_snr=50.0).count() == 2          # a zero error is no division by zero


def test_band_features_in_chunks(spark):
    """Chunks put together are the whole arrays, also where a band is cut into slices."""
    from skyflux.operators.features import band_feature_chunks, band_features
    rows = [(k, i, 60000.0 + (i * 37 % 101) / 10, "gri"[i % 3] if k else "z", float(i - 20), 1.0 + i % 3, i % 4) for k in (0, 1, 2) for i in range(60 * k + 1)]
    df = spark.createDataFrame(rows, "SNID long, obs_id long, MJD double, BAND string, FLUXCAL double, FLUXCALERR double, PHOTFLAG int") \
        .withColumn("ZP", F.col("FLUXCAL") * 2)
    names = ["mjd", "fluxcal", "fluxcalerr", "photflag", "mag", "magerr", "snr", "delta_t", "zp"]
    whole = {r.SNID: r.asDict() for r in band_features(df, extra=["ZP"]).collect()}
    for rows_at_once in (10, 1_000_000):
        got = band_feature_chunks(df, extra=["ZP"], max_points=7, max_rows=rows_at_once).collect()
        assert {r.SNID for r in got} == {1, 2} and max(r.chunk for r in got) >= 5 and all(len(r.zp) <= 7 for r in got)
        for k in (1, 2):
            for b in "gri":
                mine = sorted((r for r in got if (r.SNID, r.BAND) == (k, b)), key=lambda r: r.chunk)
                for c in names:
                    assert [x for r in mine for x in r[c]] == whole[k][f"{c}_{b}"]
                assert {r.median_delta_t for r in mine} == {r.magobs for r in mine} == {whole[k][f"median_delta_t_{b}"]}
    assert band_feature_chunks(df.limit(0)).count() == 0
