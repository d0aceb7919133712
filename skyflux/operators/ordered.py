"""Ordered operations per group that stay parallel when one group is huge.

A window ``partitionBy(group)`` runs each group in one task. Here a group
larger than ``max_rows`` is cut into slices along its first order column: the
slice bounds are approximate quantiles of that group, computed once and
written to the shared checkpoint folder, so a row's slice ``__k`` is a pure
function of the row and fixed bounds (every consumer, retry or recomputation
gets the same slice). Each (group, slice) is ranked by a window, and a small
table with one row per (group, slice) supplies offsets and the last value of
the preceding slice. Results are exact: global ranks, previous-row values,
medians, running sums. Groups below ``max_rows`` form a single slice, so on
unskewed data the plan is a plain window plus one counting pass."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_ROWS = 2_000_000        # rows per slice before a group is split
MAX_SLICES = 1024


def group_max(df: DataFrame, groups: list[str]) -> int:
    """Size of the largest group (one partial aggregation)."""
    return df.groupBy(*groups).agg(F.count(F.lit(1)).alias("__n")).agg(F.max("__n")).first()[0] or 0


def _slice(df: DataFrame, groups: list[str], col: str, descending: bool, max_rows: int,
           top: int | None = None, hot_flag: str | None = None) -> tuple[DataFrame, bool]:
    """Adds ``__k``: 0 for ordinary groups, the quantile slice for hot ones.
    ``top`` (largest group size, or an upper bound) skips the counting pass;
    ``hot_flag`` names an extra boolean column marking rows of sliced groups.
    Returns (frame, whether any group was sliced)."""
    from skyflux.session import broadcast_if_small, checkpoint_table
    counts = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("__n"))
    if top is None:
        top = counts.agg(F.max("__n").alias("m")).first()["m"]
    if not top or top <= max_rows:
        out = df.withColumn("__k", F.lit(0))
        return (out.withColumn(hot_flag, F.lit(False)) if hot_flag else out), False
    k = min(MAX_SLICES, int(math.ceil(top / max_rows)))
    pct = [i / k for i in range(1, k)]
    v = F.col(col)
    if not groups:
        # one global group: its (at most MAX_SLICES) bounds become a literal
        vals = df.agg(F.percentile_approx(col, pct, max(10_000, 20 * k))).first()[0]
        b = F.array(*[F.lit(x) for x in vals])
        k_expr = F.size(F.filter(b, (lambda x: x > v) if descending else (lambda x: x <= v)))
        out = df.withColumn("__k", F.when(v.isNull(), F.size(b) if descending else F.lit(0)).otherwise(k_expr))
        return (out.withColumn(hot_flag, F.lit(True)) if hot_flag else out), True
    hot = counts.filter(F.col("__n") > max_rows).select(*groups)
    bounds = (df.join(hot, groups, "left_semi").groupBy(*groups)
              .agg(F.percentile_approx(col, pct, max(10_000, 20 * k)).alias("__b")))
    bounds = checkpoint_table(bounds, "slice-bounds")          # fixed once written
    b = F.col("__b")
    k_expr = F.size(F.filter(b, (lambda x: x > v) if descending else (lambda x: x <= v)))
    # NULL order values sort first ascending and last descending
    k_null = F.size(b) if descending else F.lit(0)
    out = df.join(broadcast_if_small(bounds, 200_000), groups, "left")
    k = F.when(b.isNull(), F.lit(0)).when(v.isNull(), k_null).otherwise(k_expr)
    out = out.withColumn("__k", k)
    if hot_flag:
        out = out.withColumn(hot_flag, b.isNotNull())
    return out.drop("__b"), True


def _order_cols(order: list[str], descending: bool) -> list[Column]:
    cols = [F.col(o) for o in order]
    if descending:
        cols[0] = cols[0].desc()
    return cols


def ranked(df: DataFrame, groups: list[str], order: list[str], value: str | None = None,
           descending: bool = False, max_rows: int = MAX_ROWS, top: int | None = None) -> DataFrame:
    """Adds ``__rank`` (0-based position in the group, in ``order``), ``__cnt``
    (group size) and, when ``value`` is given, ``__prev`` (that column on the
    previous row of the group). ``descending`` applies to the first order column."""
    s, sliced = _slice(df, groups, order[0], descending, max_rows, top)
    oc = _order_cols(order, descending)
    if not sliced:
        # every group has at most max_rows rows: a plain window per group
        w = Window.partitionBy(*groups).orderBy(*oc)
        out = s.drop("__k").withColumn("__rank", (F.row_number().over(w) - 1).cast("long")) \
            .withColumn("__cnt", F.count(F.lit(1)).over(Window.partitionBy(*groups)))
        return out.withColumn("__prev", F.lag(value).over(w)) if value else out
    w = Window.partitionBy(*groups, "__k").orderBy(*oc)
    s = s.withColumn("__lr", F.row_number().over(w) - 1)
    if value:
        s = s.withColumn("__lprev", F.lag(value).over(w))
    aggs = [F.count(F.lit(1)).alias("__n")]
    if value:
        aggs.append(F.max_by(F.col(value), F.struct(*order) if not descending else
                             F.struct(*([(-F.col(order[0])).alias("__o0")] + [F.col(o) for o in order[1:]])))
                    .alias("__last"))
    per = s.groupBy(*groups, "__k").agg(*aggs)          # one row per (group, slice)
    wg = Window.partitionBy(*groups).orderBy("__k")
    per = (per.withColumn("__off", F.coalesce(F.sum("__n").over(wg.rowsBetween(Window.unboundedPreceding, -1)),
                                              F.lit(0)))
           .withColumn("__cnt", F.sum("__n").over(Window.partitionBy(*groups))))
    if value:
        per = per.withColumn("__plast", F.lag("__last").over(wg))
    out = s.join(per.drop("__n", *(["__last"] if value else [])), [*groups, "__k"])
    out = out.withColumn("__rank", (F.col("__off") + F.col("__lr")).cast("long"))
    if value:
        out = out.withColumn("__prev", F.when(F.col("__lr") == 0, F.col("__plast")).otherwise(F.col("__lprev")))
    return out.drop("__k", "__lr", "__off", *(["__lprev", "__plast"] if value else []))


def ordered_lag(df: DataFrame, groups: list[str], order: list[str], value: str, name: str,
                max_rows: int = MAX_ROWS, top: int | None = None) -> DataFrame:
    """``value`` of the previous row in the group (NULL for the first row)."""
    return (ranked(df, groups, order, value, max_rows=max_rows, top=top)
            .withColumnRenamed("__prev", name).drop("__rank", "__cnt"))


def exact_median(df: DataFrame, groups: list[str], value: str, name: str = "median",
                 max_rows: int = MAX_ROWS, top: int | None = None) -> DataFrame:
    """Exact median per group (mean of the two middle values for even counts)
    without holding any group in one task. Equal values are counted first, so
    a value that most rows of a group share is one row; the running count over
    distinct values then finds the one or two that hold the middle positions."""
    v = (df.filter(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("__c")))
    if top is not None and top <= max_rows:
        # no group is large: running and whole counts in one pass over the sorted values
        w = Window.partitionBy(*groups)
        r = v.withColumn("__upto", F.sum("__c").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)))
        r = r.withColumn("__cnt", F.sum("__c").over(w))
    else:
        r = running_sum(v, groups, [value], "__c", "__upto", max_rows=max_rows)
        r = r.join(v.groupBy(*groups).agg(F.sum("__c").alias("__cnt")), groups)
    holds = lambda at: (F.col("__upto") - F.col("__c") <= at) & (at < F.col("__upto"))
    mid = r.filter(holds(F.floor((F.col("__cnt") - 1) / 2)) | holds(F.ceil((F.col("__cnt") - 1) / 2)))
    return mid.groupBy(*groups).agg(F.avg(value).alias(name))


def running_sum(df: DataFrame, groups: list[str], order: list[str], value: str, name: str,
                descending: bool = False, max_rows: int = MAX_ROWS) -> DataFrame:
    """Cumulative sum of ``value`` per group in ``order`` (current row
    included; ``descending`` applies to the first order column): a running sum
    per slice plus the totals of the group's earlier slices."""
    s, sliced = _slice(df, groups, order[0], descending, max_rows)
    if not sliced:
        w = (Window.partitionBy(*groups).orderBy(*_order_cols(order, descending))
             .rowsBetween(Window.unboundedPreceding, 0))
        return s.drop("__k").withColumn(name, F.sum(value).over(w))
    w = (Window.partitionBy(*groups, "__k").orderBy(*_order_cols(order, descending))
         .rowsBetween(Window.unboundedPreceding, 0))
    s = s.withColumn("__local", F.sum(value).over(w))
    per = s.groupBy(*groups, "__k").agg(F.sum(value).alias("__tot"))
    wg = Window.partitionBy(*groups).orderBy("__k").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("__off", F.coalesce(F.sum("__tot").over(wg), F.lit(0)))    # the sum's own type
    return (s.join(per.drop("__tot"), [*groups, "__k"])
            .withColumn(name, F.col("__off") + F.col("__local")).drop("__k", "__local", "__off"))
