"""Registered queries: streaming operators. Each runs a stream to completion
(available-now trigger) over data derived from the driver's tables, with
checkpoints and sinks under the session's shared checkpoint folder, and
returns the sink's contents as a DataFrame."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyflux.operators import classification as cl
from skyflux.plans import bindings as B
from skyflux.plans.q_classification import MESSAGE_ROUND, message_view, messages_sql
from skyflux.plans.registry import query
from skyflux.plans.sql import ALERTS_EV, PHOT_EV, with_
from skyflux.session import scratch_path
from skyflux.streaming import io as sio
from skyflux.streaming import ops as sops


def _stage(df, name):
    """Write a stream input as parquet files under the shared folder."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return path


def _run(df, name, mode="append"):
    spark = df.sparkSession
    sink, ckpt = scratch_path(spark, name + "-out"), scratch_path(spark, name + "-ckpt")
    if mode == "append":
        q = (df.writeStream.format("parquet").option("checkpointLocation", ckpt)
             .outputMode("append").trigger(availableNow=True).start(sink))
        sio.run_bounded(q)
        return spark.read.parquet(sink)
    table = "skyflux_" + name.replace("-", "_") + "_" + sink[-12:]
    q = (df.writeStream.format("memory").queryName(table).option("checkpointLocation", ckpt)
         .outputMode(mode).trigger(availableNow=True).start())
    sio.run_bounded(q)
    out = spark.table(table)
    return checkpoint_copy(out, name)


def checkpoint_copy(df, name):
    from skyflux.session import checkpoint_table
    return checkpoint_table(df, name + "-final")


def _events_stream(spark, d):
    ev = B.table(spark, d, "events")
    # a glob keeps the file source on the table's own file inside the folder
    return sio.read_alert_stream(spark, fmt="parquet", path=f"{d.rstrip('/')}/event[s].parquet", schema=ev.schema)


@query("stream_nightly_counts", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS night_start, count(*) AS n_alerts
FROM events WHERE (CAST(json_extract_string(props, '$.k') AS INTEGER) & 32) <> 0
GROUP BY date_trunc('day', ts)""")
def q_stream_nightly_counts(spark, d):
    """STR9: detections per night on a stream (watermark 1 day, append output).
    A second source holds one row 30 days past the end, which closes all nights."""
    s = _events_stream(spark, d)
    s = (s.filter(F.get_json_object("props", "$.k").cast("int").bitwiseAND(32) != 0)
         .select(F.col("ts").cast("timestamp").alias("ts")))
    end = B.table(spark, d, "events").agg((F.max(F.col("ts").cast("timestamp")) + F.expr("INTERVAL 30 DAYS")).alias("ts"))
    path = _stage(end, "nightly-end")
    s = s.union(sio.read_alert_stream(spark, fmt="parquet", path=path, schema=end.schema))
    out = _run(sops.nightly_counts_stream(s, "ts"), "nightly")
    return out.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("night_start"), "n_alerts")


@query("stream_dedupe", "SELECT event_id, user_id, event_type FROM events")
def q_stream_dedupe(spark, d):
    """STR10: a stream with re-sent click events is deduplicated on event_id;
    ids are remembered for the time span of the data, so none is late."""
    ev = B.table(spark, d, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    path = scratch_path(spark, "dedupe-in")
    ev.write.mode("overwrite").parquet(f"{path}/a")
    ev.filter(F.col("event_type") == "click").write.mode("overwrite").parquet(f"{path}/b")
    span = ev.agg(F.date_diff(F.max("ts"), F.min("ts"))).first()[0] or 0
    s = sio.read_alert_stream(spark, fmt="parquet", path=f"{path}/*", schema=ev.schema, max_per_trigger=1)
    out = _run(sops.dedupe_stream(s, "event_id", "ts", delay=f"{span + 1} days"), "dedupe")
    return out.select("event_id", "user_id", "event_type")


@query("stream_restart", with_(PHOT_EV, ALERTS_EV) + """
SELECT alertId, diaSourceId, diaObjectId, 1 AS epoch FROM alerts_ev""")
def q_stream_restart(spark, d):
    """STR4: the alert stream is read, then restarted from its beginning; the
    last complete epoch holds every alert once."""
    recs = _alert_records(spark, d)
    path = _stage(recs, "restart-in")

    def stream():
        s = sio.read_alert_stream(spark, fmt="parquet", path=path, schema=recs.schema, max_per_trigger=2)
        return s.select("alertId", F.col("diaSource.diaSourceId").alias("diaSourceId"), F.col("diaSource.diaObjectId").alias("diaObjectId"))
    sink, ckpt = scratch_path(spark, "restart-out"), scratch_path(spark, "restart-ckpt")
    sio.run_epoch(spark, stream, sink, ckpt)
    epoch = sio.run_epoch(spark, stream, sink, ckpt)
    return sio.latest_epoch(spark, sink).withColumn("epoch", F.lit(epoch))


@query("batch_handler", with_(PHOT_EV, ALERTS_EV) + """
SELECT diaObjectId, count(*) AS n_alerts, max(midPointTai) AS last_mjd FROM alerts_ev GROUP BY diaObjectId""", ["last_mjd"])
def q_batch_handler(spark, d):
    """UDF4: a handler adds up each micro-batch per object; the ledger and the
    batch ids make it count once although the handler fails after its first write."""
    recs = _alert_records(spark, d).select("diaSource.diaObjectId", "diaSource.midPointTai")
    path, out, base = _stage(recs, "handler-in"), scratch_path(spark, "handler-out"), scratch_path(spark, "handler")
    failed = []

    def handler(batch, batch_id):
        sio.write_batch(batch.groupBy("diaObjectId").agg(F.count(F.lit(1)).alias("n"), F.max("midPointTai").alias("last")), batch_id, out)
        if not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after the write")

    def start():
        s = sio.read_alert_stream(spark, fmt="parquet", path=path, schema=recs.schema, max_per_trigger=2)
        return sio.foreach_batch(s, handler, "handler", f"{base}/ckpt", f"{base}/ledger")
    try:
        start().awaitTermination()
    except StreamingQueryException:
        sio.run_bounded(start())
    done = spark.read.parquet(out)
    return done.groupBy("diaObjectId").agg(F.sum("n").alias("n_alerts"), F.max("last").alias("last_mjd"))


def _alert_records(spark, d):
    a = B.alerts_ev(spark, d)
    return a.select("alertId", F.struct("diaSourceId", "diaObjectId", "midPointTai", "filterName",
                                        "psFlux", "psFluxErr").alias("diaSource"))


@query("stream_ingest_alert_ids", with_(PHOT_EV, ALERTS_EV) + """
SELECT alertId, diaSourceId, diaObjectId FROM alerts_ev""")
def q_stream_ingest_alert_ids(spark, d):
    """STR1: alert records streamed into an id table."""
    recs = _alert_records(spark, d)
    path = _stage(recs, "alerts-in")
    s = sio.read_alert_stream(spark, fmt="parquet", path=path, schema=recs.schema, max_per_trigger=2)
    sink, ckpt = scratch_path(spark, "ids-out"), scratch_path(spark, "ids-ckpt")
    sio.run_bounded(sops.ingest_alert_ids(s, sink, ckpt))
    return spark.read.parquet(sink)


def _night_stream(spark, d, name, batches):
    """SRC14: the alerts as night folders, read a share of the messages at a time."""
    recs = _alert_records(spark, d).withColumn("night", F.floor("diaSource.midPointTai").cast("int"))
    path = scratch_path(spark, name)
    recs.repartition("night").sortWithinPartitions("night", "alertId").write.option("maxRecordsPerFile", 1_000_000).partitionBy("night").parquet(path)
    schema = T.StructType([*recs.schema.fields, T.StructField("offset", T.LongType())])
    limit = recs.count() // batches + 1
    return lambda: sio.read_alert_stream(spark, fmt="alert_nights", path=path, schema=schema, max_per_trigger=limit)


@query("stream_night_ids", with_(PHOT_EV, ALERTS_EV) + """
SELECT alertId, diaSourceId, diaObjectId FROM alerts_ev""")
def q_stream_night_ids(spark, d):
    """STR1 on SRC14: ids of the alerts of all nights; the query stops after its
    first micro-batch and a second run goes on from the offset of the first."""
    stream = _night_stream(spark, d, "night-ids-in", 3)
    sink, ckpt = scratch_path(spark, "night-ids-out"), scratch_path(spark, "night-ids-ckpt")
    sio.run_bounded(sops.ingest_alert_ids(stream(), sink, ckpt))                      # available now: one micro-batch
    sio.run_to_end(sops.ingest_alert_ids(stream(), sink, ckpt, trigger={"processingTime": "0 seconds"}))
    return spark.read.parquet(sink)


@query("stream_night_progress", with_(PHOT_EV, ALERTS_EV) + """
SELECT CAST(floor(midPointTai) AS INTEGER) AS night, count(*) AS n_messages, max(alertId) AS last_offset
FROM alerts_ev GROUP BY 1""")
def q_stream_night_progress(spark, d):
    """STR7 on SRC14: messages and the latest alert of each night, counted by a
    handler of micro-batches that are handed over with their ids."""
    stream = _night_stream(spark, d, "night-progress-in", 4)
    out, base = scratch_path(spark, "night-progress"), scratch_path(spark, "night-progress-run")

    def handler(batch, batch_id):
        sio.write_batch(sops.stream_progress(batch.withColumn("timestamp", F.lit(None).cast("timestamp")), ("night",), "alertId"), batch_id, out)
    sio.run_to_end(sio.foreach_batch(stream(), handler, "night-progress", f"{base}/ckpt", f"{base}/ledger", {"processingTime": "0 seconds"}))
    return (spark.read.parquet(out).groupBy("night")
            .agg(F.sum("n_messages").alias("n_messages"), F.max("last_offset").alias("last_offset")))


@query("stream_classify", with_(PHOT_EV, ALERTS_EV) + messages_sql(1), MESSAGE_ROUND)
def q_stream_classify(spark, d):
    """STR2 + SRC15: two classifiers over the alert stream, published as
    serialised messages (file sink here, Kafka topic on a cluster) and read back."""
    recs = _alert_records(spark, d).withColumn("diaSourceId", F.col("diaSource.diaSourceId"))
    path = _stage(recs, "cls-in")
    s = sio.read_alert_stream(spark, fmt="parquet", path=path, schema=recs.schema)
    m = sops.classify_stream(s, [cl.FixedClassifier(), cl.RandomSplitClassifier(seed=1)])
    sink, ckpt = scratch_path(spark, "cls-out"), scratch_path(spark, "cls-ckpt")
    sio.run_bounded(sio.write_message_stream(m, ckpt, fmt="parquet", path=sink))     # SRC15
    schema = T.StructType([f for f in m.schema.fields if f.name in ("alertId", "classifierName", "classifications")])
    return message_view(sio.decode_payload(spark.read.parquet(sink), schema).select("payload.*"))


@query("stream_detections", with_(PHOT_EV) + """
, det AS (SELECT SNID, MJD FROM phot_ev WHERE (PHOTFLAG & 4096) <> 0),
f AS (SELECT SNID, min(MJD) AS first_mjd FROM det GROUP BY SNID),
t AS (SELECT det.SNID, min(det.MJD) AS trigger_mjd, min(f.first_mjd) AS first_mjd
      FROM det JOIN f ON det.SNID = f.SNID WHERE det.MJD >= f.first_mjd + 0.021 GROUP BY det.SNID)
SELECT t.SNID, t.first_mjd, t.trigger_mjd,
       (SELECT count(*) FROM det WHERE det.SNID = t.SNID AND det.MJD <= t.trigger_mjd) AS n_det
FROM t""".replace("\n, det AS", ",\ndet AS", 1), ["first_mjd", "trigger_mjd"])
def q_stream_detections(spark, d):
    """STR11: stateful per-object trigger on a stream of photometry that comes
    in three micro-batches of several files, up to five days out of order; a
    closing row ends the stream, so that every trigger comes out."""
    p = B.phot_ev(spark, d)
    lo, hi = p.agg(F.min("MJD"), F.max("MJD")).first()
    shifted = F.col("MJD") + F.pmod(F.xxhash64("obs_id"), F.lit(500)) / 100.0     # arrival time
    third = F.least(F.floor((shifted - lo) / F.lit((hi - lo) / 3 + 1e-6)), F.lit(2))
    path = scratch_path(spark, "det-in")
    for i in range(3):                                                             # four files, one micro-batch each
        p.filter(third == i).repartition(4).write.parquet(f"{path}/{i}")
    sops.closing_rows(p, after=30.0).coalesce(1).write.parquet(f"{path}/3")
    s = sio.read_alert_stream(spark, fmt="parquet", path=f"{path}/*", schema=p.schema, max_per_trigger=4)
    with sops.rocksdb_state(spark):
        out = _run(sops.detections_stream(s, delay="6 days"), "det")
    return out.select("SNID", "first_mjd", "trigger_mjd", "n_det")


@query("message_latency", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type AS classifierName,
       count(*) AS n_messages,
       avg(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS mean_broker_lag_s,
       max(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS max_broker_lag_s,
       avg(CAST(round(value * 1000000) AS BIGINT) / 1000000.0) AS mean_store_lag_s,
       max(CAST(round(value * 1000000) AS BIGINT) / 1000000.0) AS max_store_lag_s
FROM events GROUP BY date_trunc('day', ts), event_type""",
       ["mean_broker_lag_s", "max_broker_lag_s", "mean_store_lag_s", "max_store_lag_s"])
def q_message_latency(spark, d):
    """STR8 (batch form): broker lag = k seconds, store lag = value seconds."""
    ev = B.table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    pub = F.col("ts").cast("timestamp")
    broker = F.timestamp_add("SECOND", k, pub)
    store = F.timestamp_add("MICROSECOND", F.round(F.col("value") * 1e6).cast("long"), broker)
    m = ev.select(pub.alias("publishTimestamp"), broker.alias("brokerIngestTimestamp"),
                  store.alias("dbIngestTimestamp"), F.col("event_type").alias("classifierName"))
    out = sops.message_latency(m)
    return out.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "classifierName",
                      "n_messages", "mean_broker_lag_s", "max_broker_lag_s", "mean_store_lag_s", "max_store_lag_s")


@query("replay_nights", with_(PHOT_EV, ALERTS_EV) + """
SELECT alertId, CAST(floor(midPointTai) AS INTEGER) AS night FROM alerts_ev
WHERE CAST(floor(midPointTai) AS INTEGER) - (SELECT CAST(floor(min(MJD)) AS INTEGER) FROM phot_ev) IN (6, 8)""")
def q_replay_nights(spark, d):
    """STR5: campaign day 2 streams the seventh to ninth night; the eighth is already in the ledger."""
    first, last = B.nights(B.phot_ev(spark, d))
    ledger = scratch_path(spark, "ledger")
    spark.createDataFrame([(first + 7,)], "night int").write.parquet(ledger)
    out = scratch_path(spark, "replay")
    done = sops.replay_nights(spark, B.alerts_ev(spark, d), ledger, out, day=2, first_night=first,
                              last_night=last, factor=3)
    assert done == [first + 6, first + 8], done
    again = sops.replay_nights(spark, B.alerts_ev(spark, d), ledger, out, day=2, first_night=first,
                               last_night=last, factor=3)
    assert again == [], again
    return spark.read.parquet(out).select("alertId", F.col("night").cast("int").alias("night"))


@query("ack_sent", with_(PHOT_EV, ALERTS_EV) + "SELECT alertId FROM alerts_ev")
def q_ack_sent(spark, d):
    """STR6: acknowledgements of a stream with re-sent alerts, each id once."""
    recs = _alert_records(spark, d).withColumn("night", F.floor("diaSource.midPointTai").cast("int"))
    path = scratch_path(spark, "ack-in")
    recs.write.mode("overwrite").parquet(f"{path}/a")
    recs.filter(F.col("diaSource.filterName") == "g").write.mode("overwrite").parquet(f"{path}/b")
    s = sio.read_alert_stream(spark, fmt="parquet", path=f"{path}/*", schema=recs.schema, max_per_trigger=1)
    ack, ckpt = scratch_path(spark, "ack"), scratch_path(spark, "ack-ckpt")
    q = (s.writeStream.option("checkpointLocation", ckpt)
         .foreachBatch(lambda b, _: sops.ack_sent(b, ack, night="night")).trigger(availableNow=True).start())
    sio.run_bounded(q)
    return spark.read.parquet(ack).select("alertId")


@query("message_to_json", with_(PHOT_EV, ALERTS_EV) + """
SELECT CAST(alertId AS VARCHAR) AS key,
       CAST(to_json({'alertId': alertId, 'diaObjectId': diaObjectId, 'filterName': filterName}) AS VARCHAR) AS value
FROM alerts_ev""")
def q_message_to_json(spark, d):
    """FN18: records serialised as JSON message values (sorted keys) with a key."""
    a = B.alerts_ev(spark, d).select("filterName", "diaObjectId", "alertId")
    return sio.encode_payload(a, key="alertId")


@query("stream_progress", """
SELECT event_type AS topic, CAST(user_id % 3 AS INTEGER) AS partition, count(*) AS n_messages,
       max(event_id) AS last_offset, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_timestamp
FROM events GROUP BY event_type, CAST(user_id % 3 AS INTEGER)""")
def q_stream_progress(spark, d):
    """STR7: messages handled and latest offset/time per topic partition
    (topic = event type, partition = user % 3, offset = event id)."""
    s = _events_stream(spark, d).select(F.col("event_type").alias("topic"),
                                        (F.col("user_id") % 3).cast("int").alias("partition"),
                                        F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"))
    out = _run(sops.stream_progress(s), "progress", mode="complete")
    return out.select("topic", "partition", "n_messages", "last_offset",
                      F.date_format("last_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_timestamp"))


@query("stream_progress_observed", """
SELECT event_type AS topic, CAST(user_id % 3 AS INTEGER) AS partition, count(*) AS n_messages,
       max(event_id) AS last_offset, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_timestamp
FROM events GROUP BY event_type, CAST(user_id % 3 AS INTEGER)""")
def q_stream_progress_observed(spark, d):
    """STR7 beside a stream's own sink: observed metrics, written by a listener."""
    ev = B.table(spark, d, "events").select(F.col("event_type").alias("topic"), (F.col("user_id") % 3).cast("int").alias("partition"),
                                            F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"))
    path, log_path = scratch_path(spark, "observed-in"), scratch_path(spark, "observed-log")
    ev.repartition(6).write.parquet(path)
    parts = sorted(tuple(r) for r in ev.select("topic", "partition").distinct().collect())        # the subscription
    log = sops.ProgressLog(parts)
    spark.streams.addListener(log)
    try:
        s = sio.read_alert_stream(spark, fmt="parquet", path=path, schema=ev.schema, max_per_trigger=2)
        q = (sops.observed_progress(s, parts).select("offset").writeStream.format("parquet").trigger(availableNow=True)
             .option("checkpointLocation", scratch_path(spark, "observed-ckpt")).start(scratch_path(spark, "observed-out")))
        sio.run_bounded(q)
        log.wait(q)
    finally:
        spark.streams.removeListener(log)
    log.drain(spark, log_path)
    out = sops.progress_totals(spark.read.parquet(log_path))
    return out.select("topic", F.col("partition").cast("int").alias("partition"), "n_messages", "last_offset",
                      F.date_format("last_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_timestamp"))


@query("message_latency_tail", """
WITH m AS (SELECT date_trunc('day', ts) AS w, event_type AS c,
             CAST(json_extract_string(props, '$.k') AS DOUBLE) + CAST(round(value * 1000000) AS BIGINT) / 1000000.0 AS lag FROM events),
b AS (SELECT w, c, CASE WHEN lag > 1e-6 THEN CAST(ceil(ln(lag) / ln(CAST(1.01 AS DOUBLE) / 0.99)) AS INTEGER) END AS bucket, count(*) AS n
      FROM m GROUP BY ALL),
r AS (SELECT *, sum(n) OVER (PARTITION BY w, c ORDER BY bucket NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
             sum(n) OVER (PARTITION BY w, c) AS total, coalesce(2 * pow(CAST(1.01 AS DOUBLE) / 0.99, bucket) / (1 + CAST(1.01 AS DOUBLE) / 0.99), 0) AS v FROM b)
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, c AS classifierName, CAST(sum(n) AS BIGINT) AS n_messages,
       min(v) FILTER (upto >= ceil(total * 0.5)) AS p50, min(v) FILTER (upto >= ceil(total * 0.95)) AS p95,
       min(v) FILTER (upto >= ceil(total * 0.99)) AS p99
FROM r GROUP BY w, c""", ["p50", "p95", "p99"])
def q_message_latency_tail(spark, d):
    """STR8 tails: sketch of the publish-to-warehouse lag kept in a stream's state."""
    ev = B.table(spark, d, "events")
    pub = F.col("ts").cast("timestamp")
    store = F.timestamp_add("MICROSECOND", F.round(F.col("value") * 1e6).cast("long"),
                            F.timestamp_add("SECOND", F.get_json_object("props", "$.k").cast("int"), pub))
    m = ev.select(pub.alias("publishTimestamp"), store.alias("dbIngestTimestamp"), F.col("event_type").alias("classifierName"))
    end = m.agg((F.max("publishTimestamp") + F.expr("INTERVAL 30 DAYS")).alias("publishTimestamp")).select(
        "publishTimestamp", F.col("publishTimestamp").alias("dbIngestTimestamp"), F.lit("end").alias("classifierName"))
    path, last = scratch_path(spark, "lag-in"), _stage(end, "lag-end")
    m.repartition(6).write.parquet(path)
    s = sio.read_alert_stream(spark, fmt="parquet", path=path, schema=m.schema)
    s = s.union(sio.read_alert_stream(spark, fmt="parquet", path=last, schema=m.schema))
    sketch = _run(sops.lag_sketch(s, watermark="1 day"), "lag")
    out = sops.lag_quantiles(sketch, {"p50": 0.5, "p95": 0.95, "p99": 0.99})
    return out.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "classifierName", "n_messages", "p50", "p95", "p99")
