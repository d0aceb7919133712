"""Loading bookkeeping (JOIN10, JOIN11, AGG10, WIN7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def missing_keys(rows: DataFrame, known: DataFrame, key: str | list[str],
                 known_key: str | list[str] | None = None) -> DataFrame:
    """JOIN10: rows whose key is not among the known ones (left anti join)."""
    keys = [key] if isinstance(key, str) else list(key)
    kk = keys if known_key is None else ([known_key] if isinstance(known_key, str) else list(known_key))
    k = known.select(*[F.col(a).alias(b) for a, b in zip(kk, keys)])
    return rows.join(k, keys, "left_anti")


def append_new_only(new: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """JOIN11: at-least-once delivery made idempotent: drop repeats inside the
    new batch (smallest row per key wins, deterministic) and keys already
    stored. Returns the rows to append."""
    rest = [c for c in new.columns if c not in keys]
    dedup = (new.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__r"))
             .select(*keys, *[F.col("__r")[c].alias(c) for c in rest])) if rest else new.dropDuplicates(keys)
    return dedup.join(existing.select(*keys), keys, "left_anti")


def cumulative_counts(df: DataFrame, order: str, cols: list[str], prefix: str = "cum_") -> DataFrame:
    """WIN7: running totals over an ordered table of per-batch counts. The
    input is already one row per batch (small), so the global frame is cheap."""
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.select("*", *[F.sum(c).over(w).alias(prefix + c) for c in cols])


def load_totals(loads: DataFrame, batch: str, obj: str, source: str, is_alert: str,
                is_forced: str) -> DataFrame:
    """AGG10: per load batch, objects / sources / alerts / forced counts and
    their cumulative sums (objects counted per batch, as the loader does)."""
    per = loads.groupBy(batch).agg(
        F.countDistinct(obj).alias("n_objects"),
        F.countDistinct(source).alias("n_sources"),
        F.count(F.when(F.col(is_alert), 1)).alias("n_alerts"),
        F.count(F.when(F.col(is_forced), 1)).alias("n_forced"))
    return cumulative_counts(per, batch, ["n_objects", "n_sources", "n_alerts", "n_forced"])
