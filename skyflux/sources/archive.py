"""Alert archives (SRC8): directories of ``.avro``, ``.avro.gz``, ``.tar`` and
``.tar.gz`` files, one alert per file or tar member."""

from __future__ import annotations

import gzip
import io
import logging
import tarfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_log = logging.getLogger(__name__)

ARCHIVE_SCHEMA = T.StructType([
    T.StructField("archive", T.StringType()), T.StructField("member", T.StringType()),
    T.StructField("payload", T.BinaryType())])


def _payload(name: str, data: bytes) -> bytes | None:
    if name.endswith(".avro.gz"):
        return gzip.decompress(data)
    if name.endswith(".avro"):
        return data
    return None


BATCH = 10_000                   # alerts per yielded frame
BATCH_BYTES = 32 << 20           # and bytes of payload

#: A task's share of files, and what opening one counts for in it: about 500 small files a
#: task. Spark's own values (128 MB, 4 MB) give 32, and loose alerts a task per 32 rows.
TASK_BYTES, OPEN_BYTES = 16 << 20, 32 << 10


def _alerts(path: str, content: bytes) -> Iterator[tuple[str, str, bytes]]:
    """(archive, member, payload) of one file, in the order of its members."""
    name = path.rsplit("/", 1)[-1]
    if name.endswith((".tar", ".tar.gz", ".tgz")):
        with tarfile.open(fileobj=io.BytesIO(content), mode="r:*") as tf:
            for m in tf:
                if not m.isfile():
                    continue
                p = _payload(m.name, tf.extractfile(m).read())
                if p is None:
                    _log.warning("skipping tar member %s of %s", m.name, path)
                    continue
                yield path, m.name.rsplit("/", 1)[-1], p
    else:
        p = _payload(name, content)
        if p is None:
            _log.warning("skipping %s", path)
        else:
            yield path, name, p


def _unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Frames of up to ``BATCH`` alerts, over the borders of files: a frame per
    file costs more than the one alert that a loose file holds."""
    rows, size = [], 0
    for b in batches:
        for path, content in zip(b["path"], b["content"]):
            for row in _alerts(path, bytes(content)):
                rows.append(row)
                size += len(row[2])
                if len(rows) >= BATCH or size >= BATCH_BYTES:
                    yield pd.DataFrame(rows, columns=ARCHIVE_SCHEMA.names)
                    rows, size = [], 0
    if rows:
        yield pd.DataFrame(rows, columns=ARCHIVE_SCHEMA.names)


def _files(spark: SparkSession, base: str) -> DataFrame:
    """The files under ``base``, packed into tasks by ``TASK_BYTES`` and
    ``OPEN_BYTES``. Spark takes these settings from the session that opened the
    files, so they are opened in one of their own and the caller's stays as it is."""
    own, view = spark.newSession(), f"alert_files_{uuid.uuid4().hex}"
    own.conf.set("spark.sql.files.maxPartitionBytes", str(TASK_BYTES))
    own.conf.set("spark.sql.files.openCostInBytes", str(OPEN_BYTES))
    own.read.format("binaryFile").option("recursiveFileLookup", True).load(base).createGlobalTempView(view)
    try:
        return spark.table(f"global_temp.{view}").select("path", "content")
    finally:
        spark.catalog.dropGlobalTempView(view)


def read_alert_archive(spark: SparkSession, base: str) -> DataFrame:
    """SRC8: walk ``base`` recursively; every alert becomes a row (archive,
    member file name, payload bytes). A file is read by one task, small ones
    many to a task; decode the payload afterwards with
    ``streaming.io.decode_payload`` (JSON, or Avro with the Avro package)."""
    return _files(spark, base).mapInPandas(_unpack, ARCHIVE_SCHEMA)
