"""Interval (range) lookup as a bucketed equi-join (used by JOIN1, JOIN15, FN14)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def interval_join(points: DataFrame, intervals: DataFrame, point: str, lo: str, hi: str,
                  by: list[str] | None = None, bucket: float = 4096, how: str = "inner",
                  integral: bool = True) -> DataFrame:
    """Join each point to the interval ``[lo, hi)`` that contains it (intervals of
    one ``by`` group must not overlap).

    Intervals are exploded into the ``bucket``-wide blocks they cover and the
    points carry their block, so the join is an equi-join on (by, block) plus a
    range check: no nested loop, and a block never holds more than ``bucket``
    points' worth of key range however long an interval is. ``integral``
    selects integer (``hi - 1`` is the last point) or real-valued keys."""
    by = by or []
    last = (F.col(hi) - 1) if integral else F.col(hi)
    b0 = F.floor(F.col(lo) / F.lit(bucket)).cast("long")
    b1 = F.floor(last / F.lit(bucket)).cast("long")
    iv = (intervals.filter(F.col(hi) > F.col(lo))
          .withColumn("__blk", F.explode(F.sequence(b0, b1))))
    p = points.withColumn("__blk", F.floor(F.col(point) / F.lit(bucket)).cast("long"))
    keys = by + ["__blk"]
    pj = p.alias("__p")
    ij = iv.alias("__i")
    cond = [F.col(f"__p.{k}") == F.col(f"__i.{k}") for k in keys]
    cond.append(F.col(f"__p.{point}") >= F.col(f"__i.{lo}"))
    cond.append(F.col(f"__p.{point}") < F.col(f"__i.{hi}"))
    c = cond[0]
    for x in cond[1:]:
        c = c & x
    out = pj.join(ij, c, how)
    icols = [x for x in intervals.columns if x not in by]
    pcols = [x for x in points.columns]
    return out.select(*[F.col(f"__p.{x}") for x in pcols],
                      *[F.col(f"__i.{x}") for x in icols if x not in pcols])
