"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyflux.session import checkpoint_table

__all__ = ["checkpoint_table", "table", "text_or_empty", "word_hashes", "mix64", "by_chars", "shuffle_partitions"]

#: ASCII white space as one character class (Java and RE2 read it alike).
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

MULT = _MULT = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(31)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str | Column) -> Column:
    """The text, null counted as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Ids that a join may broadcast (about 60 MB); beyond it the join shuffles.
BROADCAST_IDS = 1_000_000


def small_side(ids: DataFrame) -> DataFrame:
    """A stored table of ids, marked for broadcast if it has at most BROADCAST_IDS rows."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8 bytes, A-Z lower-cased: ``bytes.lower`` touches
    ASCII letters only and ``bytes.split`` cuts at exactly x20 and x09-x0D."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_hashes(ws: Iterable[bytes]) -> np.ndarray:
    """64-bit hashes of words (the same in every process)."""
    ws = list(ws) if not isinstance(ws, list) else ws
    return np.fromiter(map(xxhash.xxh3_64_intdigest, ws), dtype=np.uint64, count=len(ws))


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalise a 64-bit combination, so that low and high bits are both usable."""
    h = (h ^ (h >> _SHIFT)) * _MULT
    return h ^ (h >> _SHIFT)


def chain(h: np.ndarray, n: int) -> np.ndarray:
    """Order-dependent hashes of all runs of ``n`` consecutive words."""
    m = len(h) - n + 1
    out = h[:m].copy()
    for i in range(1, n):
        out = out * _MULT + h[i:i + m]
    return mix64(out)


def give_back_memory() -> None:
    """Return freed memory to the system. Workers are reused from stage to
    stage, and allocators keep what an earlier stage has freed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)          # glibc only
    if trim is not None:
        trim(0)


_CACHES: list[dict] = []
_OWNER = [""]


def worker_cache() -> dict:
    """A dictionary that a worker keeps from task to task of one operator."""
    _CACHES.append({})
    return _CACHES[-1]


def claim(owner: str) -> None:
    """Called when an operator's task starts: what another operator has left in
    the reused worker is dropped."""
    if _OWNER[0] != owner:
        _OWNER[0] = owner
        for c in _CACHES:
            c.clear()
        give_back_memory()


@contextmanager
def lean():
    """Around a task's work in a worker that later tasks reuse."""
    try:
        yield
    finally:
        give_back_memory()


def by_chars(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes in ``column`` each (a longer
    value is its own slice), so that a worker holds few long texts at once."""
    col = batch.column(column)
    n = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(n) // size
    cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1), len(n)] if len(n) else [0]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(int(a), int(b - a))
