"""Stream sources and sinks (SRC14, SRC15, STR3, STR4). The source format is a
parameter: ``kafka`` on a cluster (package supplied by the user), file or
rate sources in tests; payloads are JSON or (with the Avro package) Avro."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from skyflux.sources.nightly import FORMAT as NIGHTS
from skyflux.sources.nightly import AlertNights


def read_alert_stream(spark: SparkSession, fmt: str = "kafka", topics: list[str] | str | None = None,
                      servers: str | None = None, group_id: str | None = None,
                      starting: str = "earliest", max_per_trigger: int | None = None,
                      path: str | None = None, schema: T.StructType | None = None,
                      options: dict | None = None) -> DataFrame:
    """SRC14: subscribe to one topic or a list (Kafka), to nights of alerts in
    folders (``alert_nights``; topics are night numbers, all if none), or stream
    files. Of the nights an available-now run reads one micro-batch, so with
    ``max_per_trigger`` use ``run_to_end``."""
    if fmt == NIGHTS:
        spark.dataSource.register(AlertNights)
    r = spark.readStream.format(fmt)
    if fmt == "kafka":
        tl = topics if isinstance(topics, str) else ",".join(topics or [])
        r = (r.option("kafka.bootstrap.servers", servers).option("subscribe", tl)
             .option("startingOffsets", starting))
        if group_id:
            r = r.option("kafka.group.id", group_id)
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_per_trigger)
    elif fmt == NIGHTS:
        r = r.schema(schema).option("startingOffsets", starting)
        if topics:
            r = r.option("nights", topics if isinstance(topics, str) else ",".join(str(t) for t in topics))
        if max_per_trigger:
            r = r.option("maxMessagesPerTrigger", max_per_trigger)
    else:
        if schema is not None:
            r = r.schema(schema)
        if max_per_trigger:
            r = r.option("maxFilesPerTrigger", max_per_trigger)
    r = r.options(**(options or {}))
    return r.load(path) if path else r.load()


def decode_payload(df: DataFrame, schema: T.StructType, codec: str = "json", value: str = "value",
                   avro_schema: str | None = None) -> DataFrame:
    """Decode message bytes into the record struct (``payload``) next to the
    transport columns. Schemaless Avro datums need the Avro package."""
    if codec == "json":
        rec = F.from_json(F.col(value).cast("string"), schema)
    elif codec == "avro":
        try:
            from pyspark.sql.avro.functions import from_avro
        except ImportError as e:  # pragma: no cover
            raise RuntimeError("Avro decoding needs the spark-avro package") from e
        rec = from_avro(F.col(value), avro_schema)
    else:
        raise ValueError(f"unknown codec {codec}")
    return df.withColumn("payload", rec)


def sorted_fields(c, t: T.DataType):
    """The value with the fields of its structs in name order, at all levels."""
    if isinstance(t, T.StructType):
        fields = [sorted_fields(c[f.name], f.dataType).alias(f.name) for f in sorted(t.fields, key=lambda f: f.name)]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(t, T.ArrayType) and isinstance(t.elementType, (T.StructType, T.ArrayType)):
        return F.transform(c, lambda x: sorted_fields(x, t.elementType))
    return c


def encode_payload(df: DataFrame, codec: str = "json", avro_schema: str | None = None,
                   key: str | None = None) -> DataFrame:
    """Serialise each row as the message value: JSON with keys sorted at all
    levels, ISO timestamps and NULL fields written as null; or Avro."""
    if codec == "json":
        rec = F.struct(*[sorted_fields(F.col(c), df.schema[c].dataType).alias(c) for c in sorted(df.columns)])
        val = F.to_json(rec, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"})
    else:
        from pyspark.sql.avro.functions import to_avro
        rec = F.struct(*[F.col(c) for c in sorted(df.columns)])
        val = to_avro(rec, avro_schema) if avro_schema else to_avro(rec)
    cols = [val.alias("value")]
    if key:
        cols.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*cols)


def write_message_stream(df: DataFrame, checkpoint: str, fmt: str = "kafka", topic: str | None = None,
                         servers: str | None = None, path: str | None = None, codec: str = "json",
                         key: str | None = None, trigger: dict | None = None,
                         options: dict | None = None, avro_schema: str | None = None) -> StreamingQuery:
    """SRC15: serialise records and publish them (Kafka topic, or files of
    serialised messages). With codec "rows" a file sink gets the rows as they are."""
    out = df if codec == "rows" else encode_payload(df, codec, avro_schema, key)
    w = out.writeStream.format(fmt).option("checkpointLocation", checkpoint).options(**(options or {}))
    if fmt == "kafka":
        w = w.option("kafka.bootstrap.servers", servers).option("topic", topic)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start(path) if path else w.start()


def run_bounded(query: StreamingQuery, stop_after_s: float | None = None) -> StreamingQuery:
    """STR3: wait for the query to finish (available-now trigger) or for at most
    ``stop_after_s`` seconds, then stop it."""
    if stop_after_s is None:
        query.awaitTermination()
    else:
        if not query.awaitTermination(stop_after_s):
            query.stop()
    return query


def run_to_end(query: StreamingQuery) -> StreamingQuery:
    """STR3 for a query with a processing-time trigger: micro-batches until its
    sources have nothing new, then stop."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query


def restart_from_start(options: dict, checkpoint_base: str) -> tuple[dict, str]:
    """STR4: replay a topic from its beginning: earliest offsets and a new,
    empty checkpoint (offsets of the old one are left untouched)."""
    opts = dict(options)
    opts["startingOffsets"] = "earliest"
    return opts, f"{checkpoint_base.rstrip('/')}/restart-{uuid.uuid4().hex[:8]}"


def _rows_at(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A ledger table, empty while nothing has been written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def run_epoch(spark: SparkSession, make_stream: Callable[[], DataFrame], sink: str, checkpoint_base: str,
              options: dict | None = None, stop_after_s: float | None = None) -> int:
    """STR4 as an operation: read a stream into ``sink``/epoch=N, from the
    beginning of its source (``make_stream`` asks for the earliest offsets) with
    a checkpoint of the epoch's own. While an epoch is not complete a call goes
    on with it, exactly once; after that the next call is a restart: a new epoch
    reads everything again. ``latest_epoch`` shows the last complete one, so a
    replay never doubles rows and a half-read one is never seen. Returns N."""
    ledger = f"{sink}-epochs"
    last = _rows_at(spark, ledger, "epoch int").agg(F.max("epoch")).first()[0]
    epoch = 0 if last is None else last + 1
    q = (make_stream().writeStream.format("parquet").option("checkpointLocation", f"{checkpoint_base.rstrip('/')}/epoch-{epoch}")
         .options(**(options or {})).outputMode("append").trigger(availableNow=True).start(f"{sink}/epoch={epoch}"))
    if stop_after_s is not None and not q.awaitTermination(stop_after_s):
        q.stop()
        return epoch                                           # still open
    q.awaitTermination()
    spark.createDataFrame([(epoch,)], "epoch int").write.mode("append").parquet(ledger)
    return epoch


def latest_epoch(spark: SparkSession, sink: str) -> DataFrame | None:
    """The rows of the last complete epoch of ``run_epoch``; None before the first."""
    last = _rows_at(spark, f"{sink}-epochs", "epoch int").agg(F.max("epoch")).first()[0]
    return None if last is None else spark.read.parquet(f"{sink}/epoch={last}")


def foreach_batch(stream: DataFrame, fn: Callable[[DataFrame, int], None], name: str, checkpoint: str, ledger: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """UDF4: ``fn(batch, batch_id)`` for every micro-batch of the query ``name``,
    with a ledger of the batches it has finished: a batch that is delivered
    again after that is skipped. A batch that failed halfway is handed over
    again with the same id; ``write_batch`` makes its output replace what the
    failed try left. So each batch counts once."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark, mark = batch.sparkSession, f"{ledger}/query={name}/batch={batch_id}"
        if not _rows_at(spark, mark, "done long").isEmpty():
            return
        fn(batch, batch_id)
        spark.createDataFrame([(batch_id,)], "done long").coalesce(1).write.mode("overwrite").parquet(mark)
    return (stream.writeStream.option("checkpointLocation", checkpoint).queryName(name).foreachBatch(run)
            .trigger(**(trigger or {"availableNow": True})).start())


def write_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    """Output of one micro-batch in a folder of its own, replaced on a retry."""
    batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def rows_dropped_late(query: StreamingQuery) -> int:
    """Rows dropped by the watermark so far in this run (sum over the
    stateful operators of the recent progress reports)."""
    total = 0
    for p in query.recentProgress:
        for op in p.get("stateOperators", []) if isinstance(p, dict) else p.stateOperators:
            n = op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) else op.numRowsDroppedByWatermark
            total += int(n or 0)
    return total
