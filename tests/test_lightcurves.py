"""Light-curve core on hand-made fixtures (pointers, nesting, histogram)."""

from pyspark.sql import functions as F

from skyflux.operators import filters as flt
from skyflux.operators import lightcurves as lc

PHOT_COLS = "row_idx long, file_num string, MJD double, BAND string, FLUXCAL double, FLUXCALERR double, PHOTFLAG int"


def _pointer_fixture(spark):
    # 2 files x 3 objects of 3/0/2 points, one separator (MJD -777) after each object
    rows, head = [], []
    for f in ("0001", "0002"):
        idx = 0
        for k, n in enumerate((3, 0, 2)):
            snid = int(f) * 100 + k
            start = idx
            for i in range(n):
                rows.append((idx, f, 60000.0 + i, "g", 10.0 * (i + 1), 1.0, 4096))
                idx += 1
            head.append((snid, f, start + 1, start + n))     # 1-based inclusive; n=0 -> max < min
            rows.append((idx, f, -777.0, None, None, None, None))
            idx += 1
    return (spark.createDataFrame(rows, PHOT_COLS),
            spark.createDataFrame(head, "SNID long, file_num string, PTROBS_MIN int, PTROBS_MAX int"))


def test_assign_object_ids_pointers(spark):
    phot, head = _pointer_fixture(spark)
    out = lc.assign_object_ids(phot, head).collect()
    assert len(out) == 10                                   # rows in - separators
    by = {}
    for r in out:
        by.setdefault(r.SNID, []).append(r.row_idx)
    assert sorted(by) == [100, 102, 200, 202]
    assert sorted(by[100]) == [0, 1, 2] and sorted(by[102]) == [5, 6]
    kept = lc.assign_object_ids(phot, head, keep_separators=True)
    assert kept.filter("SNID = -999").count() == 6
    assert flt.drop_sentinels(kept).count() == 10
    assert all(r.MJD != -777.0 for r in flt.drop_sentinels(kept).collect())


def test_assign_object_ids_plan_has_no_nested_loop(spark):
    phot, head = _pointer_fixture(spark)
    plan = lc.assign_object_ids(phot, head)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_single_curve_is_slice_of_all(spark):
    phot, head = _pointer_fixture(spark)
    allc = lc.assign_object_ids(phot, head)
    one = lc.lightcurve(allc, head, 102)
    assert sorted(r.row_idx for r in one.collect()) == [5, 6]
    import pytest
    with pytest.raises(ValueError, match="Unknown object id"):
        lc.lightcurve(allc, head, 999)


def test_nest_explode_identity(spark):
    phot, head = _pointer_fixture(spark)
    curves = lc.assign_object_ids(phot, head).drop("file_num")
    nested = lc.nest_lightcurves(curves)
    cols = [c for c in nested.columns if c != "SNID"]
    back = lc.explode_lightcurves(nested, cols)
    a = sorted(tuple(r) for r in back.select(sorted(back.columns)).collect())
    b = sorted(tuple(r) for r in curves.select(sorted(curves.columns)).collect())
    assert a == b
    # lists are aligned and in (BAND, MJD) order
    r = nested.filter("SNID = 100").first()
    assert r.MJD == sorted(r.MJD) and r.FLUXCAL == [10.0, 20.0, 30.0]


def test_snr_counts_and_mask(spark):
    df = spark.createDataFrame([(1, [10.0, 1.0, 50.0], [1.0, 1.0, 10.0])], "SNID long, FLUXCAL array<double>, FLUXCALERR array<double>")
    assert lc.snr_detection_counts(df).first().ndets == 2
    m = lc.list_mask(df, ["FLUXCAL", "FLUXCALERR"], lambda x: x["FLUXCAL"] > 5).first()
    assert m.FLUXCAL == [10.0, 50.0] and m.FLUXCALERR == [1.0, 10.0]


def test_histogram_numpy_rule(spark):
    import numpy as np
    vals = [0.0, 0.05, 0.1, 0.3, 0.79, 0.8, 0.81, -0.1, 0.2999999999]
    df = spark.createDataFrame([(v,) for v in vals], "z double")
    h = {r.bin: r.n for r in lc.histogram(df, "z", 0.0, 0.8, 0.1).collect()}
    ref, _ = np.histogram(vals, bins=[0.0 + i * 0.1 for i in range(9)])
    assert [h[i] for i in range(8)] == list(ref)


def test_merge_photometry_forced_wins(spark):
    s = spark.createDataFrame([(1, 1.0, "g", 5.0, 1.0), (1, 2.0, "g", 6.0, 1.0)],
                              "diaObjectId long, midPointTai double, filterName string, psFlux double, psFluxErr double")
    f = spark.createDataFrame([(1, 1.0, "g", 4.0, 2.0)], s.schema)
    out = {(r.midPointTai): (r.kind, r.psFlux) for r in lc.merge_photometry(s, f).collect()}
    assert out == {1.0: ("forced", 4.0), 2.0: ("source", 6.0)}


def test_nest_chunked_keeps_every_point_in_order(spark):
    rows = [(1, "g", float(i), i) for i in range(10)] + [(2, "r", 1.0, 100)]
    df = spark.createDataFrame(rows, "SNID long, BAND string, MJD double, obs_id long")
    n = lc.nest_lightcurves(df, max_points=4).orderBy("SNID", "chunk").collect()
    assert [(r.SNID, r.chunk, len(r.MJD)) for r in n] == [(1, 0, 4), (1, 1, 4), (1, 2, 2), (2, 0, 1)]
    assert [x for r in n if r.SNID == 1 for x in r.obs_id] == list(range(10))


def test_core_plans_stay_on_the_jvm(spark):
    import __spark_entry__ as E
    qs = E.queries()
    for name in ("truth_with_detection_counts", "nest_lightcurves", "object_summary", "build_alerts",
                 "associate_by_position", "match_within_tolerance", "rollup_probabilities", "hot_transients"):
        plan = qs[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "ArrowEval" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_nest_chunked_across_bands(spark):
    rows = [(1, b, float(i), i + 100 * k) for k, b in enumerate("gri") for i in range(5)]
    df = spark.createDataFrame(rows, "SNID long, BAND string, MJD double, obs_id long")
    n = lc.nest_lightcurves(df, max_points=4).orderBy("chunk").collect()
    flat = [(b, m) for r in n for b, m in zip(r.BAND, r.MJD)]
    assert flat == sorted((b, m) for _, b, m, _ in rows)
    assert [len(r.MJD) for r in n] == [4, 4, 4, 3]


def test_build_alerts_holds_what_a_loop_finds(spark):
    from skyflux.operators import alerts as al
    from skyflux.plans import bindings as B
    d = "/root/testdata/sf0.001"
    src, frc = B.sources_ev(spark, d), B.forced_ev(spark, d)
    got = {r.alertId: (tuple(x.diaSourceId for x in r.prvDiaSources),
                       None if r.prvDiaForcedSources is None else tuple(x.diaForcedSourceId for x in r.prvDiaForcedSources))
           for r in al.build_alerts(src, frc, lookback=2.0, min_age=1.0).collect()}
    s = sorted((r.diaObjectId, r.midPointTai, r.diaSourceId) for r in src.collect())
    f = sorted((r.diaObjectId, r.midPointTai, r.diaForcedSourceId) for r in frc.collect())
    first = {}
    for o, t, _ in s:
        first[o] = min(t, first.get(o, t))
    want = {i: (tuple(j for p, u, j in s if p == o and (u, j) < (t, i)),
                tuple(j for p, u, j in f if p == o and first[o] - 2.0 <= u <= t) if t - first[o] >= 1.0 else None)
            for o, t, i in s}
    assert got == want and len(got) > 100
    assert any(v[1] is None for v in got.values()) and any(v[1] for v in got.values())
    hist = {r.diaSourceId: tuple(x.diaSourceId for x in r.prvDiaSources) for r in al.alert_history(src).collect()}
    assert hist == {i: v[0] for i, v in want.items()} and max(map(len, hist.values())) > 5



def test_shared_history_of_a_long_object(spark):
    """One object of thousands of points is stored once, in bounded chunks;
    prefixes name each alert's part, and expanding them gives the plain form."""
    from skyflux.operators import alerts as al
    src = spark.range(700).selectExpr("case when id < 600 then 1 else id end as diaObjectId", "1000 + id * 0.5 as midPointTai",
                                      "id * 3 as diaSourceId", "concat('s', id) as note")
    frc = spark.range(3000).selectExpr("1L as diaObjectId", "900 + id * 0.15 as midPointTai", "id as diaForcedSourceId")
    chunks = al.history_chunks(src, frc, bits=4)
    sizes = [r[0] for r in chunks.selectExpr("size(entries)").collect()]
    held = [970 <= 900 + i * 0.15 <= 1000 + 599 * 0.5 for i in range(3000)]
    assert sum(sizes) == 700 + sum(held) and max(sizes) <= 16                   # linear in the points
    assert chunks.filter("diaObjectId = 1").count() > 100
    prefixes = al.alert_prefixes(chunks)
    assert prefixes.count() == 700
    got = {r.alertId: r for r in al.expand_alerts(chunks, prefixes.filter("alertId % 50 = 0")).collect()}
    assert set(got) == {i * 3 for i in range(700) if i * 3 % 50 == 0}
    whole = {r.alertId: r for r in al.build_alerts(src, frc).collect()}
    assert len(whole) == 700
    for a, r in got.items():
        i = a // 3
        t = 1000 + i * 0.5
        assert [x.diaSourceId for x in r.prvDiaSources] == ([k * 3 for k in range(i)] if i < 600 else [])
        want = [k for k in range(3000) if held[k] and 900 + k * 0.15 <= t] if 1 < i + 1 <= 600 and t - 1000 >= 1 else None
        assert (None if r.prvDiaForcedSources is None else [x.diaForcedSourceId for x in r.prvDiaForcedSources]) == (want if i < 600 else None)
        assert whole[a].prvDiaSources == r.prvDiaSources and whole[a].prvDiaForcedSources == r.prvDiaForcedSources


def test_hot_transients_chunks_keep_every_point(spark):
    from skyflux.operators import alerts as al
    rows = [(1, 100.0 + i * 0.1, "g", float(i), 1.0, 4096 if i == 8 else 0, i) for i in range(10)] + \
           [(2, 100.0, "r", 5.0, 1.0, 0, 50)]
    df = spark.createDataFrame(rows, "SNID long, MJD double, BAND string, FLUXCAL double, FLUXCALERR double, "
                                     "PHOTFLAG int, obs_id long")
    whole = al.hot_transients(df, 101.0, 0.5, layout=2).collect()
    assert [r.SNID for r in whole] == [1] and len(whole[0].mjd) == 10
    parts = al.hot_transients(df, 101.0, 0.5, layout=2, max_points=3).orderBy("chunk").collect()
    assert [len(r.mjd) for r in parts] == [3, 3, 3, 1]
    assert [m for r in parts for m in r.mjd] == whole[0].mjd


def test_reader_query_covers_every_object(spark):
    import __spark_entry__ as E
    d = "/root/testdata/sf0.01"
    want = {r[0] for r in spark.read.parquet(f"{d}/events.parquet").select("user_id").distinct().collect()}
    got = [r["SNID"] for r in E.queries()["class_lightcurves_all"](spark, d).collect()]
    assert len(want) > 100 and sorted(got) == sorted(want)
