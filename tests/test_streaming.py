"""Streaming operators: same input in one or several micro-batches as the batch result."""

import pytest
from pyspark.sql import functions as F

from skyflux.operators import features as fe
from skyflux.streaming import io as sio
from skyflux.streaming import ops as sops

SCHEMA = "SNID long, MJD double, PHOTFLAG int, ts timestamp, alertId long"


def _rows():
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for snid, mjds in ((1, [100.0, 100.01, 100.05, 101.0]), (2, [100.0, 100.03]), (3, [100.5])):
        for i, m in enumerate(mjds):
            rows.append((snid, m, 4096, t0 + dt.timedelta(days=m - 100), snid * 100 + i))
    return rows


def _stage(spark, scratch, rows, parts):
    base = scratch("sin")
    df = spark.createDataFrame(rows, SCHEMA)
    for i in range(parts):
        df.filter(F.col("alertId") % parts == i).coalesce(1).write.parquet(f"{base}/p{i}")
    return base


def _collect(spark, scratch, stream):
    sink, ck = scratch("sout"), scratch("sck")
    q = stream.writeStream.format("parquet").option("checkpointLocation", ck).trigger(availableNow=True).start(sink)
    sio.run_bounded(q)
    return spark.read.parquet(sink)


def test_detections_stream_matches_batch(spark, scratch):
    """One, three and out-of-order micro-batches give the batch result, once per
    object and whole; also after a restart from the checkpoint between batches."""
    rows = [(s, m + 60000, *rest) for s, m, *rest in _rows()]                  # a watermark starts in 1970
    df = spark.createDataFrame(rows, SCHEMA)
    batch = {r.SNID: r.MJD_TRIGGER2 for r in fe.trigger_after_two(df).collect()}
    orders = [[rows], [rows[:3], rows[3:5], rows[5:]], [[rows[3]], [rows[2], rows[5], rows[6]], [rows[1], rows[4], rows[0]]]]
    again = [(1, 60120.0, 4096, rows[0][3], 9900)]                              # a third detection: fires no second time
    for parts in orders:
        base, sink, ckpt = scratch("sin"), scratch("sout"), scratch("sck")
        last = sops.closing_rows(spark.createDataFrame(rows + again, SCHEMA), after=30.0)
        files = [spark.createDataFrame(part, SCHEMA) for part in [*parts, again]] + [last]
        for i, f in enumerate(files):
            f.coalesce(1).write.parquet(f"{base}/b{i}")
            if i in (len(parts) - 1, len(files) - 1):                           # two runs of the query on one checkpoint
                s = sio.read_alert_stream(spark, fmt="parquet", path=f"{base}/*", schema=df.schema, max_per_trigger=1)
                with sops.rocksdb_state(spark):
                    sio.run_bounded(sops.detections_stream(s, delay="5 days").writeStream.format("parquet").option("checkpointLocation", ckpt)
                                    .trigger(availableNow=True).outputMode("append").start(sink))
        out = spark.read.parquet(sink).collect()
        assert sorted((r.SNID, r.trigger_mjd) for r in out) == sorted(batch.items()) == [(1, 60100.05), (2, 60100.03)]
        assert {r.SNID: r.n_det for r in out} == {1: 3, 2: 2}


def test_dedupe_stream(spark, scratch):
    rows = _rows()
    base = _stage(spark, scratch, rows + rows[:3], 1)
    s = sio.read_alert_stream(spark, fmt="parquet", path=f"{base}/*", schema=spark.createDataFrame(rows, SCHEMA).schema)
    out = _collect(spark, scratch, sops.dedupe_stream(s, "alertId", "ts"))
    assert out.count() == len(rows)


def test_nightly_counts_late_row_dropped(spark, scratch):
    import datetime as dt
    base = scratch("late")
    sch = "alertId long, ts timestamp"
    spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 1)), (2, dt.datetime(2024, 1, 5, 1))], sch).coalesce(1).write.parquet(f"{base}/a")
    s = sio.read_alert_stream(spark, fmt="parquet", path=f"{base}/*", schema=spark.createDataFrame([], sch).schema,
                              max_per_trigger=1)
    sink, ck = scratch("lout"), scratch("lck")
    q = (sops.nightly_counts_stream(s, "ts", "1 day").writeStream.format("parquet")
         .option("checkpointLocation", ck).trigger(processingTime="1 second").start(sink))
    import time
    q.processAllAvailable()
    spark.createDataFrame([(3, dt.datetime(2024, 1, 1, 2))], sch).coalesce(1).write.parquet(f"{base}/b")
    q.processAllAvailable()
    spark.createDataFrame([(4, dt.datetime(2024, 1, 9, 1))], sch).coalesce(1).write.parquet(f"{base}/c")
    q.processAllAvailable()
    time.sleep(1.5)
    q.processAllAvailable()
    dropped = sio.rows_dropped_late(q)
    q.stop()
    assert dropped == 1
    got = {str(r.w.start)[:10]: r.n_alerts for r in spark.read.parquet(sink).collect()}
    # the row of Jan 1 arriving after the watermark passed Jan 4 is late and dropped
    assert got.get("2024-01-01") == 1


def test_encode_decode_roundtrip(spark):
    from pyspark.sql import types as T
    df = spark.createDataFrame([(1, "g", 1.5)], "alertId long, band string, flux double")
    enc = sio.encode_payload(df, key="alertId")
    dec = sio.decode_payload(enc, T.StructType.fromJson(df.schema.jsonValue()))
    assert dec.select("payload.*").first() == df.first()


def test_dedupe_over_three_micro_batches_equals_batch(spark, scratch):
    rows = _rows()
    base = scratch("dd3")
    df = spark.createDataFrame(rows, SCHEMA)
    for i, part in enumerate((rows[:4], rows[2:6], rows[4:] + rows[:1])):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(f"{base}/b{i}")
    s = sio.read_alert_stream(spark, fmt="parquet", path=f"{base}/*", schema=df.schema, max_per_trigger=1)
    out = _collect(spark, scratch, sops.dedupe_stream(s, "alertId", "ts"))
    assert sorted(r.alertId for r in out.collect()) == sorted(r.alertId for r in df.dropDuplicates(["alertId"]).collect())


def test_nightly_counts_stream_equals_batch(spark, scratch):
    rows = _rows()
    base = _stage(spark, scratch, rows, 3)
    s = sio.read_alert_stream(spark, fmt="parquet", path=f"{base}/*",
                              schema=spark.createDataFrame(rows, SCHEMA).schema, max_per_trigger=1)
    q = (sops.nightly_counts_stream(s, "ts", "10 days").writeStream.format("memory").queryName("nc_eq")
         .outputMode("complete").trigger(availableNow=True).start())
    sio.run_bounded(q)
    got = {str(r.w.start)[:10]: r.n_alerts for r in spark.table("nc_eq").collect()}
    df = spark.createDataFrame(rows, SCHEMA)
    want = {str(r.d): r.c for r in df.groupBy(F.to_date("ts").alias("d")).agg(F.count("*").alias("c")).collect()}
    assert got == want


def test_classify_stream_one_pass(spark, scratch):
    from skyflux.operators import classification as cl
    rows = _rows()
    base = _stage(spark, scratch, rows, 1)
    s = sio.read_alert_stream(spark, fmt="parquet", path=f"{base}/*", schema=spark.createDataFrame(rows, SCHEMA).schema)
    m = sops.classify_stream(s.withColumn("diaSourceId", F.col("alertId")),
                             [cl.FixedClassifier(), cl.RandomSplitClassifier(seed=2)])
    out = _collect(spark, scratch, m)
    assert out.count() == 2 * len(rows)
    assert {r.classifierName for r in out.select("classifierName").distinct().collect()} == {"FixedClass", "RandomSplit"}


def test_epochs_restart_from_the_beginning(spark, scratch):
    """A restart reads everything again; readers see whole epochs only."""
    base = _stage(spark, scratch, _rows(), 3)
    schema = spark.createDataFrame([], SCHEMA).schema
    sink, ckpt = scratch("ep"), scratch("epck")

    def stream():
        return sio.read_alert_stream(spark, fmt="parquet", path=f"{base}/*", schema=schema, max_per_trigger=1).select("alertId")

    def broken():
        return stream().withColumn("x", F.raise_error(F.lit("stop"))).select("alertId", F.coalesce("x", F.lit(1)).alias("x"))
    assert sio.latest_epoch(spark, sink) is None
    with pytest.raises(Exception):
        sio.run_epoch(spark, broken, sink, ckpt)
    assert sio.latest_epoch(spark, sink) is None                                 # an epoch that failed is not seen
    assert sio.run_epoch(spark, stream, sink, scratch("epck2")) == 0 and sio.latest_epoch(spark, sink).count() == 7
    spark.createDataFrame(_rows()[:1], SCHEMA).write.parquet(f"{base}/later")
    ckpt2 = scratch("epck3")
    assert sio.run_epoch(spark, stream, sink, ckpt2) == 1
    got = [r.alertId for r in sio.latest_epoch(spark, sink).collect()]
    assert sorted(got) == sorted([r[4] for r in _rows()] + [_rows()[0][4]])


def test_batch_handler_counts_a_retried_batch_once(spark, scratch):
    base = _stage(spark, scratch, _rows(), 3)
    schema = spark.createDataFrame([], SCHEMA).schema
    out, ckpt, ledger = scratch("h"), scratch("hck"), scratch("hl")
    calls = []

    def handler(batch, i):
        calls.append(i)
        sio.write_batch(batch.select("alertId"), i, out)
        if calls == [0, 1]:
            raise RuntimeError("after the write")

    def start(where):
        s = sio.read_alert_stream(spark, fmt="parquet", path=f"{base}/*", schema=schema, max_per_trigger=1)
        return sio.foreach_batch(s, handler, "h", where, ledger)
    with pytest.raises(Exception):
        start(ckpt).awaitTermination()
    sio.run_bounded(start(ckpt))
    assert calls == [0, 1, 1, 2]
    assert sorted(r.alertId for r in spark.read.parquet(out).collect()) == sorted(r[4] for r in _rows())
    sio.run_bounded(start(scratch("hck2")))                                      # delivered again under the same ids: skipped
    assert calls == [0, 1, 1, 2]


def test_lag_quantiles_are_within_the_accuracy(spark):
    import datetime as dt

    import numpy as np
    rnd = np.random.default_rng(3)
    t0 = dt.datetime(2024, 1, 1, 5)
    lags = [float(x) for x in rnd.lognormal(2, 3, 3000)] + [0.0] * 40
    rows = [(t0, t0 + dt.timedelta(microseconds=round(x * 1e6)), "a") for x in lags] + [(t0, None, "a"), (None, t0, "a"), (t0, t0, "b")]
    df = spark.createDataFrame(rows, "publishTimestamp timestamp, dbIngestTimestamp timestamp, classifierName string")
    qs = {"p01": 0.01, "p50": 0.5, "p95": 0.95, "p99": 0.99, "top": 1.0}
    whole = sops.lag_sketch(df)
    got = {r.classifierName: r for r in sops.lag_quantiles(whole, qs).collect()}
    assert got["a"].n_messages == len(lags) and got["b"].p99 == 0.0
    exact = sorted(round(x * 1e6) / 1e6 for x in lags)
    for c, q in qs.items():
        want = exact[int(np.ceil(len(lags) * q)) - 1]
        assert abs(got["a"][c] - want) <= 0.01 * want + 1e-6
    halves = sops.lag_sketch(df.filter("second(dbIngestTimestamp) < 20")).union(sops.lag_sketch(df.filter("second(dbIngestTimestamp) >= 20")))
    assert sorted(map(str, sops.lag_quantiles(halves, qs).collect())) == sorted(map(str, sops.lag_quantiles(whole, qs).collect()))


def test_observed_progress_over_two_runs(spark, scratch):
    """Counts and offsets per partition; a restart goes on where the first run ended."""
    import datetime as dt
    rows = [("t", i % 2, i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i)) for i in range(20)] + [("u", 0, 100, dt.datetime(2024, 1, 2))]
    schema = "topic string, partition int, offset long, timestamp timestamp"
    base, ckpt, sink, path = (scratch(n) for n in ("pr", "prc", "pro", "prl"))
    parts = [("t", 0), ("t", 1), ("u", 0), ("silent", 7)]
    log = sops.ProgressLog(parts)
    spark.streams.addListener(log)
    try:
        for i, some in enumerate((rows[:9], rows[9:])):
            spark.createDataFrame(some, schema).coalesce(1).write.parquet(f"{base}/{i}")
            s = sio.read_alert_stream(spark, fmt="parquet", path=f"{base}/*", schema=spark.createDataFrame([], schema).schema, max_per_trigger=1)
            q = (sops.observed_progress(s, parts).writeStream.format("parquet").option("checkpointLocation", ckpt)
                 .trigger(availableNow=True).start(sink))
            sio.run_bounded(q)
            log.wait(q)
            log.drain(spark, path)
    finally:
        spark.streams.removeListener(log)
    got = {(r.topic, r.partition): (r.n_messages, r.last_offset, r.last_timestamp) for r in sops.progress_totals(spark.read.parquet(path)).collect()}
    assert got == {("t", 0): (10, 18, rows[18][3]), ("t", 1): (10, 19, rows[19][3]), ("u", 0): (1, 100, rows[20][3])}
    assert spark.read.parquet(sink).count() == 21


def _nights(spark, scratch, nights, base=None):
    """Alerts of some nights, in two files of several row groups each."""
    base = base or scratch("nights")
    df = spark.range(0, 1000).select(F.explode(F.array(*[F.lit(n) for n in nights])).alias("night"), "id")
    df = df.select("night", (F.col("night") * 1000 + F.col("id")).alias("alertId"),
                   F.struct(F.col("id").alias("diaSourceId"), (F.col("id") % 7).alias("diaObjectId")).alias("diaSource"))
    df.repartitionByRange(2, "alertId").sortWithinPartitions("alertId").write.mode("append").option("parquet.block.size", 2048) \
        .option("maxRecordsPerFile", 600).partitionBy("night").parquet(base)
    return base, df


NIGHT_SCHEMA = "alertId long, diaSource struct<diaSourceId: long, diaObjectId: long>, night int, file string, offset long, extra string"


def test_alert_nights_offsets_and_restart(spark, scratch):
    """N messages a micro-batch, across files and nights; a restart goes on with the
    next message, and nights released later are read by the next run."""
    base, df = _nights(spark, scratch, [9, 10])
    sink, ckpt = scratch("nights-out"), scratch("nights-ck")
    sizes = []

    def run(stop_after=None):
        def take(batch, i):
            if stop_after is not None and len(sizes) >= stop_after:
                raise RuntimeError("lost")
            batch.write.mode("overwrite").parquet(f"{sink}/batch={i}")
            sizes.append(batch.count())
        s = sio.read_alert_stream(spark, "alert_nights", path=base, schema=NIGHT_SCHEMA, max_per_trigger=450)
        return s.writeStream.option("checkpointLocation", ckpt).foreachBatch(take).trigger(processingTime="0 seconds").start()
    with pytest.raises(Exception, match="lost"):
        sio.run_to_end(run(stop_after=2))
    sio.run_to_end(run())
    assert sizes == [450, 450, 450, 450, 200]
    _nights(spark, scratch, [11], base)
    sio.run_to_end(run())
    assert sizes[5:] == [450, 450, 100]
    out = spark.read.parquet(sink)
    assert out.count() == 3000 and out.select("alertId").distinct().count() == 3000
    assert out.filter("alertId div 1000 <> night OR extra IS NOT NULL OR diaSource.diaSourceId <> alertId % 1000").isEmpty()
    files = out.groupBy("file").agg(F.min("offset").alias("a"), F.max("offset").alias("z"), F.countDistinct("offset").alias("n")).collect()
    assert all(f.a == 0 and f.z == f.n - 1 for f in files) and sum(f.n for f in files) == 3000
    first = out.filter("batch = 0").agg(F.max("night")).first()[0]
    assert first == 9                                              # 9 comes before 10: nights are numbers


def test_alert_nights_subscription(spark, scratch):
    base, df = _nights(spark, scratch, [3, 4, 5])

    def ids(**kw):
        s = sio.read_alert_stream(spark, "alert_nights", path=kw.pop("path", base), schema=NIGHT_SCHEMA, **kw)
        return {r.alertId // 1000 for r in _collect(spark, scratch, s).select("alertId").collect()}
    assert ids() == {3, 4, 5}                                      # one available-now micro-batch reads all
    assert ids(topics=[3, 5]) == {3, 5} and ids(topics="4") == {4}
    assert ids(options={"taskBytes": "1000"}) == {3, 4, 5}         # files cut into ranges of rows
    assert ids(starting="latest") == set()
    empty = scratch("no-nights")
    q = sio.read_alert_stream(spark, "alert_nights", path=empty, schema=NIGHT_SCHEMA).writeStream.format("noop") \
        .option("checkpointLocation", scratch("ck")).trigger(availableNow=True).start()
    q.awaitTermination()
