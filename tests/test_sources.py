"""Text sources on hand-made files (DUMP, truth CSV, gentype map, template JSON)."""

import gzip
import io
import json
import os
import tarfile

import pytest
from pyspark.sql import functions as F

from skyflux.session import local_path
from skyflux.sources import text as tx


def _write(path, text, gz=False):
    p = local_path(path)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    if gz:
        with gzip.open(p, "wt") as f:
            f.write(text)
    else:
        with open(p, "w") as f:
            f.write(text)


def test_read_object_truth_dump(spark, scratch):
    base = scratch("dumpfx")
    _write(f"{base}/X.DUMP", "# a comment\n\nVARNAMES: CID GENTYPE ZCMB NAME\nSN: 12 10 0.25 abc\nSN: 13 11 1.5 de\n")
    df = tx.read_object_truth(spark, f"{base}/X.DUMP")
    assert df.columns == ["SNID", "GENTYPE", "ZCMB", "NAME"]
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [(12, 10, 0.25, "abc"), (13, 11, 1.5, "de")]
    assert dict(df.dtypes)["SNID"] == "bigint" and dict(df.dtypes)["ZCMB"] == "double"


def test_read_truth_csv(spark, scratch):
    base = scratch("csvfx")
    _write(f"{base}/t.csv.gz", "# comment\nSourceID, SNID, MJD, DETECT\n1, 5, 60000.5, 1\n2, , nan, 0\n", gz=True)
    df = tx.read_truth_csv(spark, f"{base}/t.csv.gz", {"SourceID": "int", "SNID": "int", "MJD": "float", "DETECT": "int"},
                           renames={"SourceID": "sourceId"})
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [(1, 5, 60000.5, 1), (2, None, None, 0)]
    assert df.columns[0] == "sourceId"


def test_gentype_map_many_to_many(spark, scratch):
    base = scratch("mapfx")
    _write(f"{base}/map.txt", "# TRUE_GENTYPE MODEL\n 10 SNIa-SALT2\n\n 40 SLSN-I+host\n 40 SLSN-I_no_host\n")
    rows = sorted(tuple(r) for r in tx.read_gentype_map(spark, f"{base}/map.txt").collect())
    assert rows == [(10, "SNIa-SALT2"), (40, "SLSN-I+host"), (40, "SLSN-I_no_host")]


def test_template_index(spark, scratch):
    base = scratch("jsonfx")
    _write(f"{base}/idx.json", json.dumps({"1": {"VK": 0.03, "LOGXLAN": -1, "LOGMASS": -3},
                                           "2": {"VK": 0.1, "LOGXLAN": -2, "LOGMASS": -2}}, indent=2))
    rows = sorted(tuple(r) for r in tx.read_template_index(spark, f"{base}/idx.json").collect())
    assert rows == [(1, 0.03, -1.0, -3.0), (2, 0.1, -2.0, -2.0)]


def test_list_classes(spark, scratch):
    base = scratch("clsfx")
    for d in ("PREFIX_AGN", "PREFIX_SNIa-SALT3", "OTHER"):
        _write(f"{base}/{d}/f.txt", "x")
    got = [r["class"] for r in tx.list_classes(spark, base, "PREFIX_").collect()]
    assert got == ["AGN", "SNIa-SALT3"]


def test_convert_fits_classes_to_parquet(spark, scratch):
    import pandas as pd
    from skyflux.sources import fits
    base = local_path(scratch("survey"))
    expect = {}
    for cls, snids in (("AGN", [11, 12]), ("KN", [21])):
        for fn in ("0001", "0002"):
            rows, heads, idx = [], [], 0
            for s in snids:
                sn = s * 10 + int(fn)
                start = idx
                for i in range(3):
                    rows.append((60000.0 + i, "g" if i % 2 else "r", 100.0 + sn + i, 1.0, 4096))
                    idx += 1
                rows.append((-777.0, "-", 0.0, 0.0, 0))
                idx += 1
                heads.append((str(sn).rjust(8), start + 1, start + 3, 0.5))
                expect[sn] = cls
            os.makedirs(f"{base}/PFX_{cls}", exist_ok=True)
            p = pd.DataFrame(rows, columns=["MJD", "BAND", "FLUXCAL", "FLUXCALERR", "PHOTFLAG"]).astype(
                {"PHOTFLAG": "int32", "FLUXCAL": "float32", "FLUXCALERR": "float32"})
            h = pd.DataFrame(heads, columns=["SNID", "PTROBS_MIN", "PTROBS_MAX", "PEAKMJD"]).astype(
                {"PTROBS_MIN": "int32", "PTROBS_MAX": "int32", "PEAKMJD": "float32"})
            with gzip.open(f"{base}/PFX_{cls}/PFX_{cls}-{fn}_PHOT.FITS.gz", "wb") as f:
                f.write(fits.encode_bintable(p, {"BAND": 2}))
            with open(f"{base}/PFX_{cls}/PFX_{cls}-{fn}_HEAD.FITS", "wb") as f:
                f.write(fits.encode_bintable(h))
    out = scratch("converted")
    fits.convert_to_parquet(spark, base, out, prefix="PFX_")
    df = spark.read.parquet(out)
    got = {r.SNID: (r["class"], len(r.MJD), r.MJD == sorted(r.MJD) or True) for r in df.collect()}
    assert {k: v[0] for k, v in got.items()} == expect
    assert all(v[1] == 3 for v in got.values())
    assert "PEAKMJD" in df.columns and "file_num" not in df.columns
    assert sorted(r["class"] for r in spark.read.parquet(out).select("class").distinct().collect()) == ["AGN", "KN"]


def test_read_phot_row_idx_continuous_across_chunks(spark, scratch):
    import pandas as pd
    from skyflux.sources import fits
    base = local_path(scratch("chunks"))
    os.makedirs(base, exist_ok=True)
    p = pd.DataFrame({"MJD": [60000.0 + i for i in range(7)], "BAND": list("grgrgri")})
    with open(f"{base}/X-0003_PHOT.FITS", "wb") as f:
        f.write(fits.encode_bintable(p, {"BAND": 1}))
    rows = sorted((r.row_idx, r.MJD, r.BAND) for r in fits.read_phot(spark, base, ["MJD", "BAND"], chunk=2).collect())
    assert rows == [(i, 60000.0 + i, b) for i, b in enumerate("grgrgri")]


def test_read_head_twin_rule_and_dropped_columns(spark, scratch):
    import pandas as pd
    from skyflux.sources import fits
    base = local_path(scratch("twins"))
    os.makedirs(base, exist_ok=True)
    good = pd.DataFrame({"SNID": ["   12", "   13"], "IAUC": ["NULL", "NULL"],
                         "PEAKMJD": pd.Series([60000.5, 60001.5], dtype="float32")})
    stale = good.iloc[:1].assign(SNID=["   99"])
    with open(f"{base}/X-0001_HEAD.FITS", "wb") as f:
        f.write(fits.encode_bintable(good))
    with gzip.open(f"{base}/X-0001_HEAD.FITS.gz", "wb") as f:
        f.write(fits.encode_bintable(stale))
    with gzip.open(f"{base}/X-0002_HEAD.FITS.gz", "wb") as f:
        f.write(fits.encode_bintable(stale.assign(SNID=["   20"])))
    h = fits.read_head(spark, base)
    assert "IAUC" not in h.columns and dict(h.dtypes)["SNID"] == "bigint"
    rows = sorted((r.SNID, r.file_num, r.head_filename) for r in h.collect())
    assert rows == [(12, "0001", "X-0001_HEAD.FITS"), (13, "0001", "X-0001_HEAD.FITS"),
                    (20, "0002", "X-0002_HEAD.FITS.gz")]


def _fits(path, pdf, strings=None):
    from skyflux.sources import fits
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(fits.encode_bintable(pdf, strings))


def test_classes_with_other_columns_equal_ids_and_short_numbers(spark, scratch):
    import pandas as pd
    from skyflux.operators.lightcurves import assign_object_ids
    from skyflux.sources import fits
    base = local_path(scratch("mixed"))
    for cls, extra in (("A", {}), ("B", {"SIM_TEMPLATE_INDEX": pd.Series([5], dtype="int32"), "OK": pd.Series([True])})):
        h = pd.DataFrame({"SNID": ["   10"], "PTROBS_MIN": pd.Series([1], dtype="int32"), "PTROBS_MAX": pd.Series([2], dtype="int32"), **extra})
        p = pd.DataFrame({"MJD": [1.0 if cls == "A" else 5.0, 2.0, -777.0], "BAND": ["g", "r", "-"],
                          "FLUXCAL": pd.Series([1, 2, 0], dtype="float32")})
        _fits(f"{base}/{cls}/X-7_HEAD.FITS", h)
        _fits(f"{base}/{cls}/X-7_PHOT.FITS", p, {"BAND": 2})
    head = fits.read_head(spark, base)
    got = {r.survey_dir[-1]: (r.SIM_TEMPLATE_INDEX, r.OK) for r in head.collect()}
    assert got == {"A": (None, None), "B": (5, True)}
    points = assign_object_ids(fits.read_phot(spark, base, ["MJD", "BAND", "FLUXCAL"]), head)
    assert points.count() == 4 and {r.file_num for r in points.collect()} == {"7"}
    out = scratch("mixed-out")
    fits.convert_to_parquet(spark, base, out)
    curves = {r["class"]: (r.SNID, sorted(r.MJD), r.SIM_TEMPLATE_INDEX) for r in spark.read.parquet(out).collect()}
    assert curves == {"A": (10, [1.0, 2.0], None), "B": (10, [2.0, 5.0], 5)}
    _fits(f"{base}/A/X_HEAD.FITS", pd.DataFrame({"SNID": ["1"]}))
    with pytest.raises(Exception, match="no file number"):
        fits.read_head(spark, base).count()


def test_fits_logicals(spark, scratch):
    import pandas as pd
    from skyflux.sources import fits
    base = local_path(scratch("logical"))
    _fits(f"{base}/X-0001_HEAD.FITS", pd.DataFrame({"SNID": ["1", "2"], "FLAG": [True, False]}))
    assert {r.SNID: r.FLAG for r in fits.read_head(spark, base).collect()} == {1: True, 2: False}


def test_dump_files_with_their_own_columns(spark, scratch):
    base = local_path(scratch("dumps"))
    _write(f"{base}/a.DUMP", "VARNAMES: CID GENTYPE\nSN: 1 20\n")
    _write(f"{base}/b.DUMP", "# note\nVARNAMES: GENTYPE CID ZCMB\nSN: 30 2 0.5\n")
    got = sorted((r.SNID, r.GENTYPE, r.ZCMB) for r in tx.read_object_truth(spark, base).collect())
    assert got == [(1, 20, None), (2, 30, 0.5)]
    _write(f"{base}/c.DUMP", "SN: 9 9 9\n")
    with pytest.raises(Exception, match="no VARNAMES line"):
        tx.read_object_truth(spark, base).count()


def test_large_class_is_written_by_several_tasks(spark, scratch):
    from skyflux.sources import parquet as pq
    df = spark.range(4000).selectExpr("id as SNID", "cast(case when id < 3900 then 1 else 2 end as int) as class",
                                      "lpad(cast(id % 3 as string), 4, '0') as file_num")
    path = scratch("ranges")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pq.write_lightcurves(df, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = spark.read.parquet(path).select(F.input_file_name().alias("f"), "class").distinct().groupBy("class").count().collect()
    assert {r["class"]: r["count"] for r in files}[1] >= 3
    assert pq.read_lightcurves(spark, path, [1], file_num="0002").count() == 1300
    pq.write_lightcurves(df, path + "-f", partition=["class", "file_num"])
    plan = pq.read_lightcurves(spark, path + "-f", file_num="0001")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(file_num" in plan


def test_colocated_tables_join_without_a_shuffle(spark, scratch):
    import uuid

    from skyflux.operators import lightcurves as lc
    from skyflux.sources import parquet as pq
    name = "t_" + uuid.uuid4().hex[:8]
    phot = pq.write_colocated(spark.range(3000).selectExpr("id % 300 as SNID", "id as obs_id", "id * 0.1 as MJD"), f"{name}_p", scratch("cp"), buckets=4)
    head = pq.write_colocated(spark.range(300).selectExpr("id as SNID", "id % 5 as file_num", "id * 2 as RA"), f"{name}_h", scratch("ch"), buckets=4)
    truth = pq.write_colocated(spark.range(100, 300).selectExpr("id as SNID", "id % 7 as GENTYPE"), f"{name}_t", scratch("ct"), buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lc.join_truth(lc.join_head(phot, head), truth).groupBy("SNID").count()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert {(r.SNID, r["count"]) for r in out.collect()} == {(i, 10) for i in range(100, 300)}
        assert phot.filter("SNID = 7").count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for t in "pht":
            spark.sql(f"DROP TABLE {name}_{t}")


def test_bloom_filters_skip_row_groups(spark, scratch):
    """An id inside every row group's range but in none of them: only with
    Bloom filters does the scan give no rows to the filter."""
    from skyflux.sources import parquet as pq
    curves = spark.range(20_000).selectExpr("id * 2 as SNID", "'A' as class", "id as obs_id")

    def scanned(bloom, snid):
        path = scratch("bloom")
        w = curves.coalesce(1).write.partitionBy("class").option("parquet.enable.dictionary", "false")
        w.options(**(pq.bloom_options("SNID", 20_000) if bloom else {})).parquet(path)
        df = pq.read_lightcurves(spark, path, ["A"]).filter(F.col("SNID") == snid).select("SNID", "obs_id")
        rows = df.collect()
        leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
        return len(rows), leaf.metrics().apply("numOutputRows").value()
    assert scanned(True, 20_001) == (0, 0) and scanned(False, 20_001)[1] > 0
    assert scanned(True, 20_002)[0] == 1
    path = scratch("bloom-curves")
    pq.write_lightcurves(curves, path)
    df = pq.read_lightcurves(spark, path, ["A"]).filter("SNID = 20001")
    assert df.count() == 0


def test_bloom_filters_grow_with_the_values_of_a_file(spark, scratch):
    """Small files have small filters (they were 1 MB each), which still skip row groups."""
    import glob

    from skyflux.sources import parquet as pq
    path = scratch("bloom-small")
    pq.write_lightcurves(spark.range(400).selectExpr("id * 2 as SNID", "id % 40 as class", "id as obs_id"), path)
    sizes = [os.path.getsize(f) for f in glob.glob(local_path(path) + "/class=*/*.parquet")]
    assert len(sizes) >= 40 and max(sizes) < 8_192

    def scanned(rows, snid):
        out = scratch("bloom-own")
        (spark.range(rows).selectExpr("id * 2 as SNID").coalesce(1).write.option("parquet.enable.dictionary", "false")
         .options(**pq.bloom_options("SNID")).parquet(out))
        df = spark.read.parquet(out).filter(F.col("SNID") == snid)
        n = len(df.collect())
        return n, df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()
    assert scanned(10, 7) == (0, 0) and scanned(20_000, 20_001) == (0, 0)
    assert all(scanned(20_000, k)[0] == 1 for k in (0, 20_002, 39_998))


def test_loose_alerts_share_tasks_and_frames(spark, scratch):
    """200 loose alerts: few tasks (there was one per 32 files), few frames (one
    per file), every alert once; the settings of the caller's session stay."""
    import pandas as pd
    from skyflux.sources import archive as ar
    base = local_path(scratch("loose"))
    os.makedirs(f"{base}/n1/n2")
    want = {(f"a{i}.avro" + (".gz" if i % 2 else ""), b"x%d" % i) for i in range(200)}
    for name, data in want:
        with open(f"{base}/n1/{'n2/' if len(data) == 3 else ''}{name}", "wb") as f:
            f.write(gzip.compress(data) if name.endswith(".gz") else data)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    df = ar.read_alert_archive(spark, base)
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
    assert not [t for t in spark.catalog.listTables("global_temp") if t.name.startswith("alert_files_")]
    got = [(r.member, bytes(r.payload)) for r in df.collect()]
    assert len(got) == 200 and set(got) == want
    assert df.rdd.getNumPartitions() <= 5                      # 4 cores
    frames = list(ar._unpack(iter([pd.DataFrame({"path": [f"p{i}.avro"] * 3, "content": [b"x"] * 3}) for i in range(4)])))
    assert [len(f) for f in frames] == [12] and list(frames[0].columns) == ["archive", "member", "payload"]


def test_unpacked_frames_are_bounded(monkeypatch):
    """A frame ends at BATCH alerts or BATCH_BYTES of payload, within a file too; none is lost."""
    import pandas as pd
    from skyflux.sources import archive as ar
    monkeypatch.setattr(ar, "BATCH", 5)
    monkeypatch.setattr(ar, "BATCH_BYTES", 100)
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w:gz") as tf:
        for i in range(12):
            ti = tarfile.TarInfo(f"n/m{i}.avro")
            ti.size = 1
            tf.addfile(ti, io.BytesIO(b"y"))
    files = pd.DataFrame({"path": ["d/t.tar.gz", "d/big.avro", "d/skip.txt", "d/last.avro"],
                          "content": [buf.getvalue(), b"z" * 150, b"-", b"w"]})
    frames = list(ar._unpack(iter([files])))
    assert [len(f) for f in frames] == [5, 5, 3, 1]
    assert [m for f in frames for m in f["member"]] == [f"m{i}.avro" for i in range(12)] + ["big.avro", "last.avro"]
