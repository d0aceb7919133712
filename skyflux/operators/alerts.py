"""Alert packaging and replay bookkeeping (JOIN17, WIN8, AGG8, AGG9, AGG18,
FN16 table form, JOIN12, SET2, ORD2, SRC9)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyflux.functions.photometry import has_flag, snr
from skyflux.schemas import PHOTFLAG_DETECT
from skyflux.session import checkpoint_table

#: Points of a history chunk, as a power of two.
CHUNK_BITS = 10

# Fixed value: alert file names in an archive.
ALERT_NAME_PATTERN = r"^alert_mjd([0-9]+(?:\.[0-9]+)?)_obj([0-9]+)_src([0-9]+)\.avro(?:\.gz)?$"


def alert_history(sources: DataFrame, obj: str = "diaObjectId", mjd: str = "midPointTai",
                  sid: str = "diaSourceId", name: str = "prvDiaSources") -> DataFrame:
    """WIN8: for every source, the earlier sources of its object (by mjd, then
    id) as an array of structs: ``build_alerts`` without forced photometry."""
    none = sources.select(F.col(sid).alias("__fid"), obj, mjd).limit(0)
    a = build_alerts(sources, none, None, obj=obj, mjd=mjd, sid=sid, fid="__fid")
    return a.select("diaSource.*", F.col("prvDiaSources").alias(name))


def history_chunks(sources: DataFrame, forced: DataFrame, lookback: float = 30.0, min_age: float = 1.0,
                   obj: str = "diaObjectId", mjd: str = "midPointTai", sid: str = "diaSourceId",
                   fid: str = "diaForcedSourceId", bits: int = CHUNK_BITS) -> DataFrame:
    """(obj, block, entries): every object's points, sources and forced ones
    together, in order of (time, forced first, id) and cut into stored, immutable
    chunks of at most 2^bits entries (pos, t, s, f). ``pos`` numbers all points
    of the table in that order, so a source's history is the points of its
    object with a smaller ``pos``: all earlier chunks and the start of its own.

    Points are ordered over the whole cluster (range partitions), so that an
    object of any length is many chunks on many tasks. Forced points that no
    alert can hold are dropped by one aggregation before: those outside [first
    detection - lookback, last], or of an object younger than ``min_age``."""
    s_struct, f_struct = F.struct(*[F.col(c) for c in sources.columns]), F.struct(*[F.col(c) for c in forced.columns])
    s = sources.select(F.col(obj).alias("__o"), F.col(mjd).alias("__t"), F.lit(1).alias("__k"), F.col(sid).cast("long").alias("__id"),
                       s_struct.alias("s"))
    f = forced.select(F.col(obj).alias("__o"), F.col(mjd).alias("__t"), F.lit(0).alias("__k"), F.col(fid).cast("long").alias("__id"),
                      f_struct.alias("f"))
    span = s.groupBy("__o").agg(F.min("__t").alias("__first"), F.max("__t").alias("__last")).filter(F.col("__last") - F.col("__first") >= min_age)
    f = (f.join(span, "__o").filter((F.col("__t") >= F.col("__first") - lookback) & (F.col("__t") <= F.col("__last")))
         .drop("__first", "__last"))
    order = ["__o", "__t", "__k", "__id"]
    rows = (s.unionByName(f, allowMissingColumns=True).repartitionByRange(*order).sortWithinPartitions(*order)
            .select(F.col("__o").alias(obj), F.monotonically_increasing_id().alias("pos"), F.col("__t").alias("t"), "s", "f"))
    chunks = rows.groupBy(obj, F.shiftright("pos", bits).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "t", "s", "f"))).alias("entries"))
    return checkpoint_table(chunks, "history")


def alert_prefixes(chunks: DataFrame, obj: str = "diaObjectId", alert_id: str = "diaSourceId") -> DataFrame:
    """One short row per alert: alertId, the object, its chunk (``block``) and its
    place in it (``offset``). With ``history_chunks`` that is every alert's
    history, stored once whatever the number of alerts that share it."""
    at = chunks.select(obj, "block", F.posexplode("entries").alias("offset", "e")).filter(F.col("e.s").isNotNull())
    return at.select(F.col(f"e.s.{alert_id}").alias("alertId"), obj, "block", "offset")


def expand_alerts(chunks: DataFrame, prefixes: DataFrame | None = None, min_age: float = 1.0, obj: str = "diaObjectId",
                  alert_id: str = "diaSourceId") -> DataFrame:
    """(alertId, diaSource, prvDiaSources, prvDiaForcedSources, obj) of all
    alerts, or of those in ``prefixes``. A chunk meets the earlier chunks of its
    object once, for all of its alerts; an object of one chunk meets none."""
    mine = chunks if prefixes is None else chunks.join(prefixes.select(obj, "block").distinct(), [obj, "block"], "left_semi")
    first = chunks.groupBy(F.col(obj).alias("__o")).agg(F.min("block").alias("__low"), F.max("block").alias("__high")).filter("__low < __high")
    later = mine.join(first, (F.col(obj) == F.col("__o")) & (F.col("block") > F.col("__low")), "left_semi").select(obj, "block")
    old = chunks.select(F.col(obj).alias("__o"), F.col("block").alias("__b"), F.col("entries").alias("__e"))
    earlier = (later.join(old, (F.col(obj) == F.col("__o")) & (F.col("__b") < F.col("block"))).groupBy(obj, "block")
               .agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("__b", "__e"))), lambda c: c["__e"])).alias("__old")))
    whole = mine.join(earlier, [obj, "block"], "left")
    points = F.concat(F.coalesce("__old", F.array().cast(chunks.schema["entries"].dataType)), "entries")
    a = whole.select(obj, "block", points.alias("__all"), F.posexplode("entries").alias("offset", "a")).filter(F.col("a.s").isNotNull())
    if prefixes is not None:
        a = a.join(prefixes.select(obj, "block", "offset"), [obj, "block", "offset"], "left_semi")
    here = F.filter("__all", lambda r: (r["pos"] < F.col("a.pos")) & (r["t"] <= F.col("a.t")))
    a = a.withColumn("__upto", here).withColumn("__first", F.filter("__all", lambda r: r["s"].isNotNull())[0]["t"])
    forced = F.transform(F.filter("__upto", lambda r: r["f"].isNotNull()), lambda r: r["f"])
    return a.select(F.col(f"a.s.{alert_id}").alias("alertId"), F.col("a.s").alias("diaSource"),
                    F.transform(F.filter("__upto", lambda r: r["s"].isNotNull()), lambda r: r["s"]).alias("prvDiaSources"),
                    F.when(F.col("a.t") - F.col("__first") >= min_age, forced).alias("prvDiaForcedSources"), obj)


def build_alerts(sources: DataFrame, forced: DataFrame, objects: DataFrame | None = None,
                 lookback: float = 30.0, min_age: float = 1.0, obj: str = "diaObjectId",
                 mjd: str = "midPointTai", sid: str = "diaSourceId",
                 fid: str = "diaForcedSourceId", alert_id: str | None = None) -> DataFrame:
    """JOIN17: one alert per detection: the source, its object, all earlier
    sources, and, when the object's first detection is at least ``min_age`` days
    before this source, the forced photometry from ``lookback`` days before the
    first detection up to this source's time (inclusive; NULL otherwise).

    Histories are stored as shared chunks (``history_chunks``) and expanded
    here; keep the chunks with ``alert_prefixes`` where the (inherently
    quadratic) expanded form of long-lived objects is not needed whole."""
    chunks = history_chunks(sources, forced, lookback, min_age, obj, mjd, sid, fid)
    res = expand_alerts(chunks, None, min_age, obj, alert_id or sid)
    if objects is not None:
        res = res.join(objects.select(F.col(obj).alias("__o"), F.struct(*objects.columns).alias("diaObject")), F.col(obj) == F.col("__o"), "left")
        res = res.drop("__o")
    return res.drop(obj)


def nightly_stats(alerts: DataFrame, mjd: str = "midPointTai", payload: str = "payload") -> DataFrame:
    """AGG8: alerts and payload bytes per night, plus the campaign total
    (the row with night NULL, from ROLLUP)."""
    return (alerts.withColumn("night", F.floor(mjd).cast("int"))
            .rollup("night")
            .agg(F.count(F.lit(1)).alias("n_alerts"),
                 F.sum(F.octet_length(payload).cast("long")).alias("n_bytes")))


def exposure_batches(alerts: DataFrame, exposure: str = "exposure", aid: str = "alertId",
                     with_ids: bool = False, max_ids: int = 10_000) -> DataFrame:
    """AGG9: alerts grouped by exposure, in time order. Without ``with_ids``:
    one row per exposure with the number of alerts and the id range. With it,
    the sorted ids as well, packed in consecutive batches of at most
    ``max_ids`` (column ``batch``), so a crowded exposure never becomes one
    unbounded value; positions come from ``ordered.ranked`` (skew-safe)."""
    if not with_ids:
        return (alerts.groupBy(exposure)
                .agg(F.count(F.lit(1)).alias("n_alerts"), F.min(aid).alias("first_alertId"),
                     F.max(aid).alias("last_alertId")))
    from skyflux.operators.ordered import ranked
    r = ranked(alerts.select(exposure, aid), [exposure], [aid])
    r = r.withColumn("batch", (F.col("__rank") / F.lit(max_ids)).cast("long"))
    return (r.groupBy(exposure, "batch")
            .agg(F.count(F.lit(1)).alias("n_alerts"), F.min(aid).alias("first_alertId"),
                 F.max(aid).alias("last_alertId"), F.array_sort(F.collect_list(aid)).alias("alertIds")))


def alerts_in_time_order(alerts: DataFrame, mjd: str = "midPointTai", aid: str = "alertId",
                         for_storage: bool = False) -> DataFrame:
    """ORD2: alerts by time, then id; range-partitioned + locally sorted when
    written for replay, a total order otherwise."""
    if for_storage:
        return alerts.repartitionByRange(mjd).sortWithinPartitions(mjd, aid)
    return alerts.orderBy(mjd, aid)


def night_range_table(days: DataFrame, day: str, first_night: int, last_night: int,
                      factor: int) -> DataFrame:
    """FN16 over a table of campaign days: nights n0..n1 streamed on each day."""
    from skyflux.functions.timefn import night_range
    n0, n1 = night_range(F.col(day), F.lit(first_night), F.lit(last_night), F.lit(factor))
    return days.withColumn("n0", n0).withColumn("n1", n1)


def pending_nights(spark, n0: int, n1: int, ledger: DataFrame, night: str = "night") -> DataFrame:
    """JOIN12: nights n0..n1 not yet in the ledger (left anti join)."""
    want = spark.range(n0, n1 + 1).select(F.col("id").cast("int").alias(night))
    return want.join(ledger.select(F.col(night).cast("int").alias(night)).distinct(), night, "left_anti")


def hot_transients(phot: DataFrame, mjd_now: float, days: float, key: str = "SNID",
                   mjd: str = "MJD", band: str = "BAND", flux: str = "FLUXCAL",
                   err: str = "FLUXCALERR", flag: str = "PHOTFLAG", min_snr: float | None = None,
                   layout: int = 1, tiebreak: str | None = "obs_id",
                   max_points: int | None = None) -> DataFrame:
    """AGG18: objects detected in [mjd_now - days, mjd_now] with all their
    photometry up to mjd_now, time-ordered. A detection is the DETECT flag, or
    S/N >= ``min_snr`` when given (inclusive bounds are our rule).
    layout 1: one struct column ``photometry`` {mjd, band, flux, fluxerr}
    layout 2: parallel array columns mjd, band, flux, fluxerr.
    ``max_points`` splits a long curve into consecutive bounded chunks
    (column ``chunk``), as in ``nest_lightcurves``."""
    from skyflux.operators.lightcurves import nest_lightcurves
    det = (snr(flux, err) >= min_snr) if min_snr is not None else has_flag(flag, PHOTFLAG_DETECT)
    upto = phot.filter(F.col(mjd) <= mjd_now)
    recent = upto.filter(det & (F.col(mjd) >= mjd_now - days)).select(key).distinct()
    pts = upto.join(recent, key, "left_semi").select(
        key, F.col(mjd).alias("mjd"), *([F.col(tiebreak).alias("__tb")] if tiebreak else []),
        F.col(band).alias("band"), F.col(flux).alias("flux"), F.col(err).alias("fluxerr"))
    order = ("mjd", "__tb") if tiebreak else ("mjd",)
    g = nest_lightcurves(pts, key, order=order, max_points=max_points)
    keys = [key] + (["chunk"] if max_points else [])
    cols = [F.col(c) for c in ("mjd", "band", "flux", "fluxerr")]
    if layout == 1:
        return g.select(*keys, F.struct(*cols).alias("photometry"))
    return g.select(*keys, *cols)


def alert_file_metadata(files: DataFrame, name: str = "name") -> DataFrame:
    """SRC9: parse ``alert_mjd<F>_obj<I>_src<I>.avro[.gz]``; other names are ignored."""
    ok = files.filter(F.col(name).rlike(ALERT_NAME_PATTERN))
    return ok.select(name,
                     F.regexp_extract(name, ALERT_NAME_PATTERN, 1).cast("double").alias("mjd"),
                     F.regexp_extract(name, ALERT_NAME_PATTERN, 2).cast("long").alias("objectId"),
                     F.regexp_extract(name, ALERT_NAME_PATTERN, 3).cast("long").alias("sourceId"))


def union_dedupe_sources(*dfs: DataFrame, name: str = "name") -> tuple[DataFrame, DataFrame]:
    """SET2: merge several archives; a file name counts once. Returns
    (deduplicated rows, duplicate report name -> copies)."""
    u = reduce(lambda a, b: a.unionByName(b), dfs)
    rest = [c for c in u.columns if c != name]
    # keep the smallest row per name (deterministic, partial aggregation)
    dedup = (u.groupBy(name).agg(F.min(F.struct(*rest)).alias("__r"))
             .select(name, *[F.col("__r")[c].alias(c) for c in rest]))
    dups = u.groupBy(name).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
    return dedup, dups
