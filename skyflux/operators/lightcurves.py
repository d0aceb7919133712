"""Light-curve core: object assignment, joins, nesting, counts (JOIN1-JOIN4,
AGG1-AGG5, AGG7, ORD1, SET1, SET3, SRC5, FN19)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyflux.functions.photometry import has_flag
from skyflux.schemas import PHOTFLAG_DETECT, SEPARATOR_SNID


# --------------------------------------------------------------------- JOIN1
def assign_object_ids(phot: DataFrame, head: DataFrame, key: str = "SNID",
                      idx: str = "row_idx", file: str | list[str] = "file_num",
                      ptr_min: str = "PTROBS_MIN", ptr_max: str = "PTROBS_MAX",
                      bucket: int = 4096, keep_separators: bool = False) -> DataFrame:
    """Give every photometry row its object: same ``file`` and
    ``PTROBS_MIN - 1 <= idx < PTROBS_MAX`` (1-based inclusive pointers, disjoint
    within a file).

    No join: the starts of the HEAD intervals are sorted in among the
    photometry, and a row takes the last start before it, if that interval
    reaches it. The table is shuffled once, by (file, block of ``bucket``
    indices); an interval that runs over several blocks starts anew in each, so
    no task sees more than a block of a file or of an object. Rows outside every
    interval (separators) are dropped, or kept with key -999 when
    ``keep_separators``."""
    files = [file] if isinstance(file, str) else list(file)
    if "survey_dir" in phot.columns and "survey_dir" in head.columns and "survey_dir" not in files:
        files.append("survey_dir")                     # file numbers repeat in every class folder
    p = phot.drop(key) if key in phot.columns else phot
    block = lambda c: F.floor(c / F.lit(bucket)).cast("long")
    lo, hi = F.col(ptr_min).cast("long") - 1, F.col(ptr_max).cast("long")
    starts = (head.select(*files, F.col(key).alias("__k"), lo.alias("__lo"), hi.alias("__hi")).filter("__hi > __lo").dropna(subset=files)
              .withColumn("__b", F.explode(F.sequence(block(F.col("__lo")), block(F.col("__hi") - 1))))
              .select(*files, "__b", F.greatest(F.col("__lo"), F.col("__b") * bucket).alias("__i"), F.struct("__k", "__hi").alias("__s")))
    rows = p.select(*files, block(F.col(idx)).alias("__b"), F.col(idx).cast("long").alias("__i"), F.struct(*[F.col(c) for c in p.columns]).alias("__p"))
    both = rows.unionByName(starts, allowMissingColumns=True)
    w = (Window.partitionBy(*files, "__b").orderBy("__i", F.col("__s").isNull())       # a start before the row it begins at
         .rowsBetween(Window.unboundedPreceding, 0))
    got = both.withColumn("__o", F.last("__s", True).over(w)).filter(F.col("__p").isNotNull())
    mine = F.when(F.col("__i") < F.col("__o.__hi"), F.col("__o.__k"))
    if keep_separators:
        mine = F.coalesce(mine, F.lit(SEPARATOR_SNID).cast("long"))
    return got.select(mine.alias(key), "__p.*") if keep_separators else got.filter(mine.isNotNull()).select(mine.alias(key), "__p.*")


# ---------------------------------------------------------------- JOIN2/3/4
def join_with_suffix(left: DataFrame, right: DataFrame, key: str | list[str],
                     how: str = "inner", suffix: str = "_right",
                     drop: tuple[str, ...] = ()) -> DataFrame:
    """Equi-join; right-side columns whose names clash get ``suffix``."""
    keys = [key] if isinstance(key, str) else list(key)
    right = right.drop(*drop)
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    right = right.select(*[F.col(c).alias(c + suffix) if c in clash else F.col(c)
                           for c in right.columns])
    return left.join(right, keys, how)


def join_head(curves: DataFrame, head: DataFrame, key: str | list[str] = "SNID") -> DataFrame:
    """JOIN2: curves inner-join HEAD on key; file columns dropped, clashes suffixed."""
    return join_with_suffix(curves, head, key, drop=("file_num", "head_filename", "survey_dir"))


def join_truth(curves: DataFrame, truth: DataFrame, key: str = "SNID") -> DataFrame:
    """JOIN3: curves inner-join object truth on key, clashes suffixed."""
    return join_with_suffix(curves, truth, key)


def detection_counts(phot: DataFrame, key: str = "SNID", flag: str = "PHOTFLAG",
                     mask: int = PHOTFLAG_DETECT, name: str = "ndetect") -> DataFrame:
    """AGG3: number of flagged points per object (partial aggregation map-side)."""
    return (phot.filter(has_flag(flag, mask)).groupBy(key)
            .agg(F.count(F.lit(1)).alias(name)))


def truth_with_detection_counts(truth: DataFrame, phot: DataFrame, key: str = "SNID",
                                flag: str = "PHOTFLAG", mask: int = PHOTFLAG_DETECT,
                                name: str = "ndetect") -> DataFrame:
    """JOIN4: truth inner-join detection counts; objects without detections drop."""
    return truth.join(detection_counts(phot, key, flag, mask, name), key, "inner")


# ---------------------------------------------------------------- AGG1/AGG2
def nest_lightcurves(df: DataFrame, key: str | list[str] = "SNID", order: tuple[str, ...] = ("BAND", "MJD"),
                     cols: list[str] | None = None, sort_output: bool = False,
                     max_points: int | None = None) -> DataFrame:
    """AGG1: one row per object; every other column becomes a list, all lists
    aligned and in ``order`` (remaining columns break ties, so output is stable).

    Structs are collected and sorted once, then split into parallel arrays:
    separate ``collect_list`` calls would not be aligned after a shuffle.

    With ``max_points`` a curve is split into consecutive chunks of at most that
    many points (extra column ``chunk``, 0-based, in list order), so no single
    value grows with the largest object; every point is kept. The chunk index
    comes from a per-object sort, which Spark spills to disk when large."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in (cols or df.columns) if c not in keys and c not in order]
    fields = list(order) + rest
    if max_points:
        df = _chunked(df.select(*keys, *fields), keys, list(order), rest, max_points)
        keys = [*keys, "chunk"]
    nested = (df.groupBy(*keys)
              .agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("__pts")))
    out = nested.select(*keys, *[F.col("__pts")[c].alias(c) for c in fields])
    return out.orderBy(*keys) if sort_output else out


def _chunked(df: DataFrame, keys: list[str], order: list[str], rest: list[str], max_points: int) -> DataFrame:
    """``chunk`` = position in (order + rest) within the key, div ``max_points``.

    A text column that comes first in the order (the band) becomes part of the
    group: positions within (key, band) come from the skew-safe
    ``ordered.ranked`` (sliced on the numeric second column) and band offsets
    from a table with one row per (key, band). A number that comes first (the
    time) is what the slices are cut on."""
    from pyspark.sql import Window
    from skyflux.operators.ordered import ranked
    by_band = len(order) >= 2 and dict(df.dtypes)[order[0]] == "string"
    if by_band:
        groups, within = [*keys, order[0]], order[1:] + rest
    else:
        groups, within = keys, order + rest
    r = ranked(df, groups, within)
    if by_band:
        sizes = r.select(*groups, "__cnt").distinct()
        w = Window.partitionBy(*keys).orderBy(order[0]).rowsBetween(Window.unboundedPreceding, -1)
        sizes = sizes.withColumn("__boff", F.coalesce(F.sum("__cnt").over(w), F.lit(0))).drop("__cnt")
        r = r.join(sizes, groups).withColumn("__rank", F.col("__rank") + F.col("__boff")).drop("__boff")
    return r.withColumn("chunk", (F.col("__rank") / F.lit(max_points)).cast("int")).drop("__rank", "__cnt")


def explode_lightcurves(nested: DataFrame, list_cols: list[str], key: str = "SNID") -> DataFrame:
    """AGG2: inverse of ``nest_lightcurves`` (aligned lists -> one row per point)."""
    z = F.explode(F.arrays_zip(*[F.col(c) for c in list_cols])).alias("__z")
    return nested.select(key, z).select(key, *[F.col("__z")[c].alias(c) for c in list_cols])


def snr_detection_counts(nested: DataFrame, flux: str = "FLUXCAL", err: str = "FLUXCALERR",
                         min_snr: float = 5.0, name: str = "ndets",
                         min_count: int | None = None) -> DataFrame:
    """AGG4: per nested curve, number of points with flux/err >= min_snr; keep
    curves with more than ``min_count`` such points when given."""
    ratios = F.zip_with(F.col(flux), F.col(err),
                        lambda f, e: F.when(e != 0, f.cast("double") / e.cast("double")))
    out = nested.withColumn(name, F.size(F.filter(ratios, lambda r: r >= F.lit(min_snr))))
    return out.filter(F.col(name) > min_count) if min_count is not None else out


def list_mask(nested: DataFrame, cols: list[str], predicate: Callable[[Column], Column]) -> DataFrame:
    """FN19: filter aligned list columns by a predicate on the zipped element."""
    kept = F.filter(F.arrays_zip(*[F.col(c) for c in cols]), predicate)
    tmp = nested.withColumn("__kept", kept)
    return tmp.select(*[F.col("__kept")[c].alias(c) if c in cols else F.col(c)
                        for c in nested.columns])


# --------------------------------------------------------------------- AGG5
def histogram(df: DataFrame, col: str, lo: float, hi: float, width: float,
              name: str = "n") -> DataFrame:
    """AGG5: fixed-width bins with edges ``lo + i*width``, left-closed, the last
    bin also closed on the right (numpy rule); values outside are dropped.
    Every bin is reported, empty ones with 0."""
    spark = df.sparkSession
    nbins = int(round((hi - lo) / width))
    last_edge = lo + nbins * width
    x = F.col(col).cast("double")
    b = F.floor((x - lo) / width).cast("int")
    # correct float rounding against the edges actually used
    b = F.when(x < F.lit(lo) + b * F.lit(width), b - 1).otherwise(b)
    b = F.when(x >= F.lit(lo) + (b + 1) * F.lit(width), b + 1).otherwise(b)
    b = F.when(x == F.lit(last_edge), nbins - 1).otherwise(b)
    counts = (df.select(b.alias("bin"))
              .filter((F.col("bin") >= 0) & (F.col("bin") < nbins))
              .groupBy("bin").agg(F.count(F.lit(1)).alias(name)))
    bins = spark.range(nbins).select(F.col("id").cast("int").alias("bin"))  # nbins rows, fixed
    return (F.broadcast(bins).join(counts, "bin", "left")
            .select("bin",
                    (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"),
                    F.coalesce(F.col(name), F.lit(0).cast("long")).alias(name)))


# --------------------------------------------------------------------- AGG7
def class_counts(df: DataFrame, cls: str = "class", key: str = "SNID") -> DataFrame:
    """AGG7: objects and points per class."""
    return df.groupBy(cls).agg(F.countDistinct(key).alias("n_objects"),
                               F.count(F.lit(1)).alias("n_points"))


def table_bounds(df: DataFrame, cols: list[str]) -> DataFrame:
    """AGG7: one row with min/max of each column."""
    return df.agg(*[a for c in cols for a in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))])


# ------------------------------------------------------------- ORD1 / SET1 / SET3
def sort_lightcurves(df: DataFrame, cols: tuple[str, ...] = ("SNID", "BAND", "MJD"),
                     for_storage: bool = False, partitions: int | None = None) -> DataFrame:
    """ORD1: total order for display, or range-partition + local sort for storage
    (keeps row-group statistics tight for point lookups)."""
    if for_storage:
        r = df.repartitionByRange(partitions, cols[0]) if partitions else df.repartitionByRange(cols[0])
        return r.sortWithinPartitions(*cols)
    return df.orderBy(*cols)


def union_tables(*dfs: DataFrame | None) -> DataFrame:
    """SET1: vertical concatenation by name; ``None`` parts are skipped."""
    parts = [d for d in dfs if d is not None]
    if not parts:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b), parts)


def merge_photometry(sources: DataFrame, forced: DataFrame, key: str = "diaObjectId",
                     mjd: str = "midPointTai", band: str = "filterName",
                     cols: list[str] | None = None) -> DataFrame:
    """SET3: detected and forced photometry as one curve; where both exist for
    (object, mjd, band) the forced point wins. Per-point groups hold at most a
    few rows; the choice is an aggregation (partial, map-side)."""
    keep = cols or [c for c in forced.columns if c in sources.columns and c not in (key, mjd, band)]
    s = sources.select(key, mjd, band, *keep, F.lit(1).alias("__prio"), F.lit("source").alias("kind"))
    f = forced.select(key, mjd, band, *keep, F.lit(0).alias("__prio"), F.lit("forced").alias("kind"))
    u = s.unionByName(f)
    best = F.min_by(F.struct(*keep, "kind"), F.struct("__prio", *keep))
    return (u.groupBy(key, mjd, band).agg(best.alias("__b"))
            .select(key, mjd, band, *[F.col("__b")[c].alias(c) for c in keep + ["kind"]]))


# --------------------------------------------------------------------- SRC5
def lightcurve(curves: DataFrame, head: DataFrame, snid: int, key: str = "SNID") -> DataFrame:
    """SRC5: the curve of one object; unknown id or duplicate HEAD rows raise.

    The check is a bounded point lookup (``limit(2)``), the filter reaches the
    Parquet scan so only matching row groups are read."""
    n = head.filter(F.col(key) == F.lit(snid)).limit(2).count()
    if n == 0:
        raise ValueError(f"Unknown object id {snid}")
    if n > 1:
        raise ValueError(f"Object id {snid} is not unique in HEAD")
    return curves.filter(F.col(key) == F.lit(snid))


# ------------------------------------------------------------- ORD3 / ORD4
def sample_objects(df: DataFrame, key: str = "SNID", seed: int = 0, k: int = 1) -> DataFrame:
    """ORD3: a repeatable random pick of ``k`` objects: order by the MD5 of
    "key|seed" and keep the first k (a top-k: each task keeps k candidates)."""
    return (df.select(key).distinct()
            .withColumn("__h", F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)))))
            .orderBy("__h", key).limit(k).drop("__h"))


def head(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """ORD4: the first ``n`` rows in key order (top-k, not a full sort)."""
    return df.orderBy(key).limit(n)


def class_lightcurves(phot: DataFrame, head: DataFrame, truth: DataFrame | None = None, key: str = "SNID",
                      file_num: str | list[str] | None = None, agg: bool = False, include_header: bool = False,
                      include_truth: bool = False) -> DataFrame:
    """The whole reader in one call: photometry of a class (or of some of its
    files) given its objects, separators removed. With ``agg`` one row per
    object, to which HEAD columns and object truth are joined on request
    (clashing names get ``_right``)."""
    if file_num is not None:
        some = [file_num] if isinstance(file_num, str) else list(file_num)
        phot, head = phot.filter(F.col("file_num").isin(some)), head.filter(F.col("file_num").isin(some))
    curves = assign_object_ids(phot, head, key)
    if not agg:
        return curves
    out = nest_lightcurves(curves.drop("file_num", "row_idx", "survey_dir"), key)
    if include_header:
        out = join_head(out, head, key)
    if include_truth:
        if truth is None:
            raise ValueError("include_truth needs the truth table")
        out = join_truth(out, truth, key)
    return out
