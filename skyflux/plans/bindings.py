"""Logical survey tables derived from the driver's tables (FIXTURES.md §B).

Every binding is a lazy DataFrame over the given parquet, so work grows with
the input; column pruning and filters reach the scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyflux.functions.ids import pad_num
from skyflux.functions.timefn import mjd_from_timestamp
from skyflux.schemas import SEPARATOR_MJD

# Fixed values of the binding: event type -> band, and the class ids used for
# the embedding-derived broker messages.
EVENT_BAND = [("click", "g"), ("view", "r"), ("purchase", "i"), ("signup", "z"), ("error", "Y")]
MESSAGE_CLASSES = [2222, 2223, 2224, 2225, 2226]
OBJECTS_PER_FILE = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _band(c: str = "event_type"):
    expr = None
    for et, b in EVENT_BAND:
        expr = (F.when(F.col(c) == et, b) if expr is None else expr.when(F.col(c) == et, b))
    return expr


def _k():
    return F.get_json_object("props", "$.k").cast("int")


def phot_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long light curves: SNID, obs_id, MJD, BAND, FLUXCAL, FLUXCALERR, PHOTFLAG."""
    ev = table(spark, sf_dir, "events")
    k = _k()
    return ev.select(
        F.col("user_id").alias("SNID"),
        F.col("event_id").alias("obs_id"),
        mjd_from_timestamp("ts").alias("MJD"),
        _band().alias("BAND"),
        F.col("value").alias("FLUXCAL"),
        (F.lit(1.0) + k / F.lit(10.0)).alias("FLUXCALERR"),
        (k * F.lit(128)).alias("PHOTFLAG"),
    )


def nights(p: DataFrame, mjd: str = "MJD") -> tuple[int, int]:
    """First and last night of the data."""
    lo, hi = p.agg(F.min(mjd), F.max(mjd)).first()
    return int(lo), int(hi)


def truth_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object truth: SNID, ZCMB in [0, 1], GENTYPE."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("SNID"),
                    ((F.col("c_acctbal") + 1000.0) / 11000.0).alias("ZCMB"),
                    F.col("c_nationkey").alias("GENTYPE"))


def file_num_of(snid) -> "F.Column":
    """Pointer files hold at most OBJECTS_PER_FILE objects (consecutive ids)."""
    return pad_num(F.floor(F.col(snid) / OBJECTS_PER_FILE) + 1)


def phot_files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(phot_raw, head) in the pointer layout of the survey files.

    Files hold at most ``OBJECTS_PER_FILE`` objects; inside a file, rows are ordered by
    (object, time), with one separator row (MJD -777) after each object.
    ``row_idx`` is 0-based per file, pointers are 1-based inclusive.

    Positions in a file come from range-sliced ranks (``ordered.ranked``);
    per-object offsets from per-object counts (one row per object)."""
    from skyflux.operators.ordered import ranked
    p = phot_ev(spark, sf_dir).withColumn("file_num", file_num_of("SNID"))
    per_obj = p.groupBy("file_num", "SNID").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("file_num").orderBy("SNID").rowsBetween(Window.unboundedPreceding, -1)
    # per object: rows and separators of the earlier objects of its file
    offs = (per_obj.withColumn("off", F.coalesce(F.sum(F.col("n") + 1).over(w), F.lit(0)).cast("long"))
            .withColumn("k", F.coalesce(F.count(F.lit(1)).over(w), F.lit(0)).cast("long")))
    # position in the file (a large file is sliced over tasks by object id)
    pos = ranked(p, ["file_num"], ["SNID", "MJD", "obs_id"]).drop("__cnt")
    raw = (pos.join(offs.select("SNID", "k"), "SNID")
           .select("file_num", (F.col("__rank") + F.col("k")).cast("long").alias("row_idx"),
                   "obs_id", "MJD", "BAND", "FLUXCAL", "FLUXCALERR", "PHOTFLAG"))
    seps = offs.select("file_num", (F.col("off") + F.col("n")).alias("row_idx"),
                       F.lit(None).cast("long").alias("obs_id"),
                       F.lit(SEPARATOR_MJD).alias("MJD"), F.lit(None).cast("string").alias("BAND"),
                       F.lit(None).cast("double").alias("FLUXCAL"),
                       F.lit(None).cast("double").alias("FLUXCALERR"),
                       F.lit(None).cast("int").alias("PHOTFLAG"))
    head = offs.select("SNID", "file_num",
                       (F.col("off") + 1).cast("int").alias("PTROBS_MIN"),
                       (F.col("off") + F.col("n")).cast("int").alias("PTROBS_MAX"))
    return raw.unionByName(seps), head


def alerts_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detected sources as alerts: alertId = diaSourceId = obs id."""
    from skyflux.functions.photometry import has_flag
    from skyflux.schemas import PHOTFLAG_DETECT
    p = phot_ev(spark, sf_dir)
    return (p.filter(has_flag("PHOTFLAG", PHOTFLAG_DETECT))
            .select(F.col("obs_id").alias("alertId"), F.col("obs_id").alias("diaSourceId"),
                    F.col("SNID").alias("diaObjectId"), F.col("MJD").alias("midPointTai"),
                    F.col("BAND").alias("filterName"), F.col("FLUXCAL").alias("psFlux"),
                    F.col("FLUXCALERR").alias("psFluxErr")))


def sources_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """diaSource-shaped detections (same rows as ``alerts_ev`` without alertId)."""
    return alerts_ev(spark, sf_dir).drop("alertId")


def forced_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forced photometry = every point of every object."""
    p = phot_ev(spark, sf_dir)
    return p.select(F.col("obs_id").alias("diaForcedSourceId"), F.col("SNID").alias("diaObjectId"),
                    F.col("MJD").alias("midPointTai"), F.col("BAND").alias("filterName"),
                    F.col("FLUXCAL").alias("psFlux"), F.col("FLUXCALERR").alias("psFluxErr"))


def messages_emb(spark: SparkSession, sf_dir: str, normalise: bool = True) -> DataFrame:
    """Broker messages from embeddings: message/source id = vec_id, classes
    2222..2226, class number c getting the share of every fifth |e_i| from the
    c-th on (all dimensions count); classifier = vec_id % 3."""
    e = table(spark, sf_dir, "embeddings")
    n = len(MESSAGE_CLASSES)

    def every_nth(k):
        return F.aggregate(F.filter("embedding", lambda x, i: i % n == k), F.lit(0.0), lambda s, x: s + F.abs(x.cast("double")))
    a = [every_nth(k) for k in range(n)]
    e = e.withColumns({f"__a{k}": x for k, x in enumerate(a)})
    a = [F.col(f"__a{k}") for k in range(n)]
    tot = a[0] + a[1] + a[2] + a[3] + a[4]
    probs = [(x / tot) if normalise else x for x in a]
    cls = F.array(*[F.struct(F.lit(c).alias("classId"), p.alias("probability"))
                    for c, p in zip(MESSAGE_CLASSES, probs)])
    return e.select(F.col("vec_id").alias("messageId"), F.col("vec_id").alias("diaSourceId"),
                    (F.col("vec_id") % 3).cast("int").alias("classifierId"),
                    (F.lit(2222) + F.col("label") % 5).cast("int").alias("trueClassId"),
                    cls.alias("classifications"))


def bulk_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bench-size photometry from lineitem."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("SNID"),
                     mjd_from_timestamp("l_shipdate").alias("MJD"),
                     F.col("l_returnflag").alias("BAND"),
                     F.col("l_extendedprice").alias("FLUXCAL"),
                     F.col("l_quantity").alias("FLUXCALERR"),
                     F.col("l_linenumber").alias("PHOTFLAG"),
                     F.col("l_partkey").alias("obs_id"))


def _golden_ra(k):
    return F.pmod(k.cast("double") * F.lit(137.50776405), F.lit(360.0))


def _golden_dec(k):
    return F.degrees(F.asin(2.0 * F.pmod(k.cast("double") * F.lit(0.61803398875), F.lit(1.0)) - 1.0))


def sky_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(k.alias("objectId"), _golden_ra(k).alias("ra"), _golden_dec(k).alias("decl"))


def sky_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(k.alias("sourceId"), _golden_ra(k).alias("ra"),
                    (_golden_dec(k) + F.lit(0.0002)).alias("decl"))


def targets_candidates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p = table(spark, sf_dir, "part")
    t = p.select(F.col("p_partkey").alias("target_id"), (F.col("p_size") / 1000.0).alias("x"))
    c = p.select(F.col("p_partkey").alias("cand_id"), ((F.col("p_retailprice") - 900.0) / 4000.0).alias("x"))
    return t, c


def class_map_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gentype -> true (leaf) class id, from the model types present in truth."""
    t = truth_ev(spark, sf_dir)
    return (t.select(F.col("GENTYPE").alias("gentype")).distinct()
            .withColumn("classId", (F.lit(2222) + F.col("gentype") % 5).cast("int")))


def messages_resent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with an ingest time, plus a later re-send of those with label 1."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    m = messages_emb(spark, sf_dir).join(e.withColumnRenamed("vec_id", "messageId"), "messageId")
    t0 = F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'")
    base = m.select("messageId", "diaSourceId", "classifierId", "classifications",
                    F.timestamp_add("SECOND", F.col("messageId"), t0).alias("brokerIngestTimestamp"),
                    F.lit("orig").alias("version"), "label")
    again = (base.filter(F.col("label") == 1)
             .withColumn("messageId", F.col("messageId") * 2 + 1)
             .withColumn("brokerIngestTimestamp", F.timestamp_add("HOUR", F.lit(1), F.col("brokerIngestTimestamp")))
             .withColumn("version", F.lit("resend")))
    base = base.withColumn("messageId", F.col("messageId") * 2)            # even: sent first, odd: sent again
    return base.unionByName(again).drop("label")


def messages_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages carrying the four classifier identity strings."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("messageId"),
                    F.concat(F.lit("broker"), (F.col("label") % 2).cast("string")).alias("brokerName"),
                    F.concat(F.lit("v"), (F.col("vec_id") % 3).cast("string")).alias("brokerVersion"),
                    F.concat(F.lit("clf"), (F.col("vec_id") % 3).cast("string")).alias("classifierName"),
                    F.concat(F.lit("p"), (F.col("label") % 3).cast("string")).alias("classifierParams"))


def sky_ipix(ra: str = "ra", dec: str = "decl"):
    """Fine sky pixel of a position on a 64 x 128 (dec x ra) grid."""
    d = F.least(F.floor((F.col(dec) + 90.0) / 180.0 * 64), F.lit(63))
    r = F.least(F.floor(F.col(ra) / 360.0 * 128), F.lit(127))
    return (d * 128 + r).cast("long")


def skymap_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability sky maps, one per order priority: coarse pixels of 16 fine
    pixels, weighted by order value (customer key picks the pixel)."""
    o = table(spark, sf_dir, "orders")
    w = (o.groupBy(F.col("o_orderpriority").alias("map_id"), (F.col("o_custkey") % 512).alias("p"))
         .agg(F.sum("o_totalprice").alias("w")))
    tot = w.groupBy("map_id").agg(F.sum("w").alias("tot"))
    return (w.join(tot, "map_id")
            .select("map_id", (F.col("p") * 16).alias("pix_lo"), (F.col("p") * 16 + 16).alias("pix_hi"),
                    (F.col("w") / F.col("tot")).alias("prob"), F.lit(16.0).alias("area")))


def sim_inspiral(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Injections from orders (one per order)."""
    o = table(spark, sf_dir, "orders")
    m1 = F.lit(1.0) + F.col("o_totalprice") / 500000.0
    return o.select(F.col("o_orderkey").alias("simulation_id"), m1.alias("mass1"),
                    (m1 * 0.8).alias("mass2"), F.lit(0.0).alias("spin1x"), F.lit(0.0).alias("spin1y"),
                    F.lit(0.0).alias("spin1z"), (F.lit(40.0) + F.col("o_custkey") % 400).alias("distance"),
                    F.concat(F.lit("GAL"), F.col("o_custkey").cast("string")).alias("source"),
                    F.radians((F.col("o_orderkey") % 180).cast("double")).alias("inclination"))


def coinc_inspiral(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coincidences from lineitem (one per order that has line items)."""
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_orderkey").alias("coinc_event_id"))
            .agg((F.sum("l_quantity") / 10.0).alias("snr"),
                 F.when(F.count(F.lit(1)) > 3, "H1,L1,V1").otherwise("H1,L1").alias("ifos")))


def template_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Template index -> (VK, LOGXLAN, LOGMASS), one template per part."""
    p = table(spark, sf_dir, "part")
    return (p.select(F.col("p_partkey").cast("int").alias("index"), (F.col("p_size") / 100.0).alias("VK"),
                    (F.lit(-1.0) - (F.col("p_size") % 9)).alias("LOGXLAN"),
                    (F.lit(-3.0) + (F.col("p_retailprice") - 900.0) / 50.0).alias("LOGMASS")))


def head_kn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kilonova HEAD rows from customer."""
    t = truth_ev(spark, sf_dir)
    return t.select("SNID", (F.col("SNID") * 2).cast("int").alias("SIM_TEMPLATE_INDEX"),
                    (F.col("ZCMB") - 0.05).alias("REDSHIFT_FINAL"))
