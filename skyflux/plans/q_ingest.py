"""Registered queries: bulk file ingestion (FITS tables, alert archives).
Fixture files are written from the driver's tables by grouped pandas
writers under the session's shared checkpoint folder, then read back."""

from __future__ import annotations

import gzip
import io
import json
import os
import tarfile

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from skyflux.operators import filters as flt
from skyflux.operators import lightcurves as lc
from skyflux.plans import bindings as B
from skyflux.plans.registry import query
from skyflux.plans.sql import ALERTS_EV, PHOT_EV, PHOT_RAW, with_
from skyflux.session import local_path, scratch_path
from skyflux.sources import archive as ar
from skyflux.sources import fits
from skyflux.streaming.io import decode_payload


def _fits_fixture(spark, d):
    raw, head = B.phot_files(spark, d)
    base = local_path(scratch_path(spark, "fits"))

    def write_phot(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row_idx")
        fn = pdf["file_num"].iloc[0]
        assert (pdf["row_idx"].to_numpy() == np.arange(len(pdf))).all()
        out = pd.DataFrame({"obs_id": pdf["obs_id"].fillna(-1).astype("int64"),
                            "MJD": pdf["MJD"].astype("float64"), "BAND": pdf["BAND"].fillna("").astype(object),
                            "FLUXCAL": pdf["FLUXCAL"].astype("float32"),
                            "PHOTFLAG": pdf["PHOTFLAG"].fillna(0).astype("int32")})
        d = f"{base}/TRAIN_{'A' if int(fn) % 2 == 1 else 'B'}"
        os.makedirs(d, exist_ok=True)
        with open(f"{d}/X-{fn}_PHOT.FITS.gz", "wb") as f:
            f.write(gzip.compress(fits.encode_bintable(out, {"BAND": 2})))
        return pd.DataFrame({"file_num": [fn], "n": [len(pdf)]})

    def write_head(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("SNID")
        fn = pdf["file_num"].iloc[0]
        out = pd.DataFrame({"SNID": pdf["SNID"].astype(str).str.rjust(12).astype(object),
                            "IAUC": pd.Series(["NULL"] * len(pdf), dtype=object),
                            "PTROBS_MIN": pdf["PTROBS_MIN"].astype("int32"),
                            "PTROBS_MAX": pdf["PTROBS_MAX"].astype("int32")})
        d = f"{base}/TRAIN_{'A' if int(fn) % 2 == 1 else 'B'}"
        os.makedirs(d, exist_ok=True)
        with open(f"{d}/X-{fn}_HEAD.FITS", "wb") as f:
            f.write(fits.encode_bintable(out))
        if fn == "0001":      # a stale gzip twin: the plain file must win
            with open(f"{d}/X-{fn}_HEAD.FITS.gz", "wb") as f:
                f.write(gzip.compress(fits.encode_bintable(out.iloc[:1])))
        return pd.DataFrame({"file_num": [fn], "n": [len(pdf)]})

    raw.groupBy("file_num").applyInPandas(write_phot, "file_num string, n long").collect()
    head.groupBy("file_num").applyInPandas(write_head, "file_num string, n long").collect()
    return base


@query("read_fits_lightcurves", with_(PHOT_EV, PHOT_RAW) + """
SELECT SNID, file_num, row_idx, obs_id, MJD FROM phot_pos""", ["MJD"])
def q_read_fits_lightcurves(spark, d):
    """SRC3 + SRC4 + JOIN1 + FLT4: HEAD/PHOT FITS files (gzip PHOT, a stale
    gzip HEAD twin) read in bulk and assigned to objects."""
    base = _fits_fixture(spark, d)
    head = fits.read_head(spark, base)
    assert "IAUC" not in head.columns and dict(head.dtypes)["SNID"] == "bigint"
    phot = fits.read_phot(spark, base, columns=["obs_id", "MJD", "BAND", "FLUXCAL", "PHOTFLAG"])
    out = flt.drop_sentinels(lc.assign_object_ids(phot, head, keep_separators=True))
    return out.select("SNID", "file_num", "row_idx", "obs_id", "MJD")


@query("convert_to_parquet", with_(PHOT_EV) + """
SELECT SNID, CASE WHEN (SNID // 100 + 1) % 2 = 1 THEN 'A' ELSE 'B' END AS class, count(*) AS npts,
       string_agg(CAST(obs_id AS VARCHAR), ',' ORDER BY BAND, MJD, obs_id) AS obs_ids,
       CAST(min(MJD) AS DOUBLE) AS mjd_min
FROM phot_ev GROUP BY SNID""", ["mjd_min"])
def q_convert_to_parquet(spark, d):
    """Survey files of two classes -> nested curves with HEAD columns -> Parquet by class."""
    base = _fits_fixture(spark, d)
    out = scratch_path(spark, "converted")
    fits.convert_to_parquet(spark, base, out, prefix="TRAIN_",
                            phot_columns=["obs_id", "MJD", "BAND", "FLUXCAL", "PHOTFLAG"])
    r = spark.read.parquet(out)
    return r.select("SNID", "class", F.size("MJD").cast("long").alias("npts"),
                    F.array_join(F.col("obs_id").cast("array<string>"), ",").alias("obs_ids"),
                    F.array_min("MJD").alias("mjd_min"))


ALERT_JSON = "alertId long, diaSource struct<diaSourceId:long, diaObjectId:long, midPointTai:double, filterName:string>"


def _archive_fixture(spark, d):
    a = (B.alerts_ev(spark, d).withColumn("night", F.floor("midPointTai").cast("int"))
         .withColumn("block", F.floor(F.col("alertId") / 1000)))      # bounded archives
    base = local_path(scratch_path(spark, "archive"))

    def write_night(pdf: pd.DataFrame) -> pd.DataFrame:
        night = int(pdf["night"].iloc[0])
        block = int(pdf["block"].iloc[0])
        os.makedirs(f"{base}/{night}", exist_ok=True)
        members = []
        for r in pdf.itertuples(index=False):
            rec = {"alertId": int(r.alertId), "diaSource": {"diaSourceId": int(r.diaSourceId),
                   "diaObjectId": int(r.diaObjectId), "midPointTai": float(r.midPointTai), "filterName": r.filterName}}
            name = f"alert_mjd{r.midPointTai:.6f}_obj{r.diaObjectId}_src{r.diaSourceId}.avro"
            members.append((name, json.dumps(rec).encode(), r.filterName))
        tar_members = [m for m in members if m[2] != "g"]
        with tarfile.open(f"{base}/{night}/alerts-{block}.tar.gz", "w:gz") as tf:
            for name, data, _ in tar_members:
                blob = gzip.compress(data)
                ti = tarfile.TarInfo(f"{night}/{name}.gz")
                ti.size = len(blob)
                tf.addfile(ti, io.BytesIO(blob))
            note = b"not an alert"
            ti = tarfile.TarInfo(f"{night}/README.txt")
            ti.size = len(note)
            tf.addfile(ti, io.BytesIO(note))
        for name, data, band in members:
            if band == "g":
                with open(f"{base}/{night}/{name}", "wb") as f:
                    f.write(data)
        return pd.DataFrame({"night": [night], "n": [len(pdf)]})

    # the rows are few bytes but a file or member each: tasks by cores, not merged by bytes
    tasks = 8 * spark.sparkContext.defaultParallelism
    a.repartition(tasks, "night", "block").groupBy("night", "block").applyInPandas(write_night, "night int, n long").collect()
    return base


@query("read_alert_archive", with_(PHOT_EV, ALERTS_EV) + """
SELECT alertId, diaObjectId, midPointTai, filterName FROM alerts_ev""", ["midPointTai"])
def q_read_alert_archive(spark, d):
    """SRC8: nightly tar.gz archives (one per 1,000 alert ids) of gzipped alerts plus loose .avro files
    (payload codec here: JSON), non-alert members skipped."""
    base = _archive_fixture(spark, d)
    from pyspark.sql import types as T
    schema = T._parse_datatype_string(ALERT_JSON)
    recs = decode_payload(ar.read_alert_archive(spark, base), schema, value="payload")
    return recs.select("payload.alertId", "payload.diaSource.diaObjectId", "payload.diaSource.midPointTai",
                       "payload.diaSource.filterName")
