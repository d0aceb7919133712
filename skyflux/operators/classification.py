"""Classifiers and classification analytics (UDF1-UDF3, STR2, SET4, JOIN8,
AGG11-AGG16, WIN5, WIN6)."""

from __future__ import annotations

from collections.abc import Callable
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyflux.operators.taxonomy import explode_classifications
from skyflux.schemas import CLASSIFICATION
from skyflux.session import broadcast_if_small

CLASS_ARRAY = T.ArrayType(CLASSIFICATION)


class Classifier:
    """UDF1: a classifier = four identity strings + a Column of
    array<struct<classId int, probability float>> computed from an alert row.

    Subclasses override ``classifications``; keep it to built-in functions so
    it stays JVM-side, or derive from ``PandasClassifier`` for Python models."""

    def __init__(self, broker_name: str, broker_version: str, classifier_name: str,
                 classifier_params: str):
        self.broker_name = broker_name
        self.broker_version = broker_version
        self.classifier_name = classifier_name
        self.classifier_params = classifier_params

    def classifications(self, alerts: DataFrame) -> Column:
        raise NotImplementedError


def _class_array(pairs: list[tuple[int, Column]]) -> Column:
    return F.array(*[F.struct(F.lit(c).cast("int").alias("classId"),
                              p.cast("float").alias("probability")) for c, p in pairs])


class FixedClassifier(Classifier):
    """UDF2: always the same class with probability 1."""

    def __init__(self, class_id: int = 111, broker_name="ExampleBroker", broker_version="v1.0",
                 classifier_name="FixedClass", classifier_params="100%"):
        super().__init__(broker_name, broker_version, classifier_name, classifier_params)
        self.class_id = class_id

    def classifications(self, alerts: DataFrame) -> Column:
        return _class_array([(self.class_id, F.lit(1.0))])


def uniform(seed: int, *cols) -> Column:
    """Repeatable U[0,1): the first 48 bits of the MD5 of the columns and the seed, joined by '|'."""
    h = F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols], F.lit(str(seed))))
    return F.conv(F.substring(h, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


class RandomSplitClassifier(Classifier):
    """UDF3: stick-breaking split, p_i = u_i * (1 - sum of earlier p); the rest
    goes to ``rest``; sums to 1. Draws are hashes of (alert id, i, seed), so
    retries and repartitioning give the same values."""

    # The (old-taxonomy) class ids of the source classifier.
    TYPES = [111, 112, 113, 114, 115, 135]
    REST = 131

    def __init__(self, seed: int = 0, types: list[int] | None = None, rest: int | None = None,
                 id_col: str = "alertId", broker_name="ExampleBroker", broker_version="v1.0",
                 classifier_name="RandomSplit", classifier_params="stick-breaking"):
        super().__init__(broker_name, broker_version, classifier_name, classifier_params)
        self.seed, self.id_col = seed, id_col
        self.types = types or self.TYPES
        self.rest = self.REST if rest is None else rest

    def classifications(self, alerts: DataFrame) -> Column:
        remaining = F.lit(1.0)
        pairs = []
        for i, t in enumerate(self.types):
            u = uniform(self.seed, F.col(self.id_col), F.lit(i))
            pairs.append((t, u * remaining))
            remaining = remaining * (F.lit(1.0) - u)
        pairs.append((self.rest, remaining))
        return _class_array(pairs)


class PandasClassifier(Classifier):
    """A Python model over Arrow batches: ``fn(pdf) -> list of [(classId, p), ...]``
    receives a pandas frame with ``input_cols`` (vectorised, never per row)."""

    def __init__(self, fn: Callable[[pd.DataFrame], list], input_cols: list[str], **ident):
        super().__init__(ident.get("broker_name", "broker"), ident.get("broker_version", "v1"),
                         ident.get("classifier_name", "pandas"), ident.get("classifier_params", ""))
        self.fn, self.input_cols = fn, input_cols

    def classifications(self, alerts: DataFrame) -> Column:
        cols = self.input_cols
        fn = self.fn

        @F.pandas_udf(CLASS_ARRAY)
        def run(*series: pd.Series) -> pd.Series:
            pdf = pd.concat(series, axis=1, keys=cols)
            out = fn(pdf)
            return pd.Series([[{"classId": int(c), "probability": float(p)} for c, p in r] for r in out])
        return run(*[F.col(c) for c in cols])


def classify(alerts: DataFrame, classifier: Classifier, alert_id: str = "alertId",
             source_id: str = "diaSourceId", publish_ts: str | None = None) -> DataFrame:
    """STR2: alerts -> broker messages (one per alert). Publish time is the
    given column (e.g. the Kafka timestamp), ingest time is now."""
    pub = F.col(publish_ts).cast("timestamp") if publish_ts else F.lit(None).cast("timestamp")
    return alerts.select(
        F.col(alert_id).cast("long").alias("alertId"),
        F.col(source_id).cast("long").alias("diaSourceId"),
        pub.alias("publishTimestamp"),
        F.current_timestamp().alias("brokerIngestTimestamp"),
        F.lit(classifier.broker_name).alias("brokerName"),
        F.lit(classifier.broker_version).alias("brokerVersion"),
        F.lit(classifier.classifier_name).alias("classifierName"),
        F.lit(classifier.classifier_params).alias("classifierParams"),
        classifier.classifications(alerts).alias("classifications"))


def classify_all(alerts: DataFrame, classifiers: list[Classifier], alert_id: str = "alertId",
                 source_id: str = "diaSourceId", publish_ts: str | None = None) -> DataFrame:
    """SET4: every classifier sees every alert; one pass over the input (the
    per-classifier messages are an array that is exploded), batch or stream."""
    pub = F.col(publish_ts).cast("timestamp") if publish_ts else F.lit(None).cast("timestamp")
    msgs = F.array(*[F.struct(F.lit(c.broker_name).alias("brokerName"),
                              F.lit(c.broker_version).alias("brokerVersion"),
                              F.lit(c.classifier_name).alias("classifierName"),
                              F.lit(c.classifier_params).alias("classifierParams"),
                              c.classifications(alerts).alias("classifications"))
                     for c in classifiers])
    x = alerts.select(F.col(alert_id).cast("long").alias("alertId"),
                      F.col(source_id).cast("long").alias("diaSourceId"),
                      pub.alias("publishTimestamp"),
                      F.current_timestamp().alias("brokerIngestTimestamp"),
                      F.explode(msgs).alias("__m"))
    return x.select("alertId", "diaSourceId", "publishTimestamp", "brokerIngestTimestamp", "__m.*")


def alert_truth(messages: DataFrame, sources: DataFrame, truth: DataFrame, class_map: DataFrame,
                source_id: str = "diaSourceId", object_id: str = "diaObjectId",
                truth_key: str = "SNID", gentype: str = "GENTYPE",
                map_gentype: str = "gentype", map_class: str = "classId") -> DataFrame:
    """JOIN8: message -> source -> object -> truth -> true class.

    Fact-to-fact joins shuffle on their keys; the class map is a size-checked
    broadcast."""
    s = sources.select(source_id, object_id)
    t = truth.select(F.col(truth_key).alias(object_id), F.col(gentype).alias("__g"))
    m = class_map.select(F.col(map_gentype).alias("__g"), F.col(map_class).alias("trueClassId"))
    return (messages.join(s, source_id).join(t, object_id)
            .join(broadcast_if_small(m, 10_000), "__g").withColumnRenamed("__g", "gentype"))


def best_class(messages: DataFrame, arr: str = "classifications") -> DataFrame:
    """WIN5: arg-max class of each message, ties -> lowest class id. A per-row
    array expression (``array_max`` over (p, -id) structs), no shuffle."""
    best = F.array_max(F.transform(arr, lambda x: F.struct(x["probability"].alias("p"),
                                                           (-x["classId"]).alias("nid"))))
    return messages.withColumn("bestClassId", (-best["nid"]).cast("int")) \
        .withColumn("bestProbability", best["p"])


def latest_message(messages: DataFrame, keys: tuple[str, ...] = ("diaSourceId", "classifierId"),
                   ts: str = "brokerIngestTimestamp", tiebreak: str = "messageId") -> DataFrame:
    """WIN6: latest message per (source, classifier) by ingest time (ties ->
    highest ``tiebreak``). An aggregation with ``max_by`` (partial, map-side)
    rather than a window, so a hot key is combined before the shuffle."""
    rest = [c for c in messages.columns if c not in keys]
    pick = F.max_by(F.struct(*rest), F.struct(ts, tiebreak))
    return messages.groupBy(*keys).agg(pick.alias("__m")).select(*keys, *[F.col("__m")[c].alias(c) for c in rest])


def mean_probabilities(long: DataFrame, keys=("trueClassId", "classifierId", "diaObjectId", "classId"),
                       prob: str = "probability") -> DataFrame:
    """AGG11: mean probability per (true class, classifier, object, class)."""
    return long.groupBy(*keys).agg(F.avg(prob).alias("meanProbability"), F.count(F.lit(1)).alias("nMessages"))


def max_probabilities(long: DataFrame, keys=("trueClassId", "classifierId", "diaObjectId", "classId"),
                      prob: str = "probability") -> DataFrame:
    """AGG12: max probability per (true class, classifier, object, class)."""
    return long.groupBy(*keys).agg(F.max(prob).alias("maxProbability"))


def objects_of_class(df: DataFrame, classifier_id: int, class_id: int, what: str = "diaObjectId",
                     clf: str = "classifierId", true_class: str = "trueClassId") -> DataFrame:
    """AGG13: distinct objects (or sources, ``what``) of a true class seen by a classifier."""
    return df.filter((F.col(clf) == classifier_id) & (F.col(true_class) == class_id)).select(what).distinct()


def confusion_matrix(best: DataFrame, classes: list[int], true_col: str = "trueClassId",
                     pred_col: str = "bestClassId", prefix: str = "pred_") -> DataFrame:
    """AGG14: true x predicted counts, one column per class of the explicit
    list (no extra job to discover pivot values; stable columns)."""
    p = best.groupBy(true_col).pivot(pred_col, classes).count()
    return p.select(true_col, *[F.coalesce(F.col(str(c)), F.lit(0)).cast("long").alias(f"{prefix}{c}")
                                for c in classes])


def classifier_dim(messages: DataFrame,
                   cols: tuple[str, ...] = ("brokerName", "brokerVersion", "classifierName",
                                            "classifierParams"),
                   existing: DataFrame | None = None) -> DataFrame:
    """AGG15: distinct classifier identities with dense integer ids (1-based, in
    identity order). With ``existing`` (identities and ``classifierId``) its ids
    are kept and new identities follow the largest. The distinct set is tiny
    (one row per classifier), so the global ranking runs on already-reduced data."""
    from pyspark.sql import Window
    d = messages.select(*cols).distinct()
    rank = F.dense_rank().over(Window.orderBy(*cols)).cast("long")
    if existing is None:
        return d.withColumn("classifierId", rank)
    old = existing.select(*cols, F.col("classifierId").cast("long").alias("classifierId"))
    top = old.agg(F.coalesce(F.max("classifierId"), F.lit(0))).first()[0]
    return old.unionByName(d.join(old, list(cols), "left_anti").withColumn("classifierId", rank + F.lit(top)))


def probability_sum_check(messages: DataFrame, arr: str = "classifications",
                          eps: float = 1e-4, key: str = "messageId") -> DataFrame:
    """AGG16: messages whose probabilities do not sum to 1 within ``eps``."""
    total = F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, x: acc + x["probability"].cast("double"))
    return (messages.select(key, total.alias("probabilitySum"), F.size(arr).alias("nClasses"))
            .filter(F.abs(F.col("probabilitySum") - 1.0) > eps))


def to_table_form(messages: DataFrame, arr: str = "classifications") -> DataFrame:
    """Messages as the warehouse stores them: parallel arrays ``classid``
    (short) and ``probability`` (float) in place of the array of structs."""
    return messages.select(*[c for c in messages.columns if c not in (arr, "classid", "probability")],
                           F.transform(arr, lambda x: x["classId"].cast("short")).alias("classid"),
                           F.transform(arr, lambda x: x["probability"].cast("float")).alias("probability"))


def from_table_form(table: DataFrame, arr: str = "classifications") -> DataFrame:
    """The array of structs of stored messages. Arrays of different length are an error."""
    same = F.size("classid") == F.size("probability")
    ids = F.when(same, F.col("classid")).otherwise(F.raise_error(F.lit("classid and probability differ in length")).cast("array<short>"))
    zipped = F.zip_with(ids, "probability", lambda c, p: F.struct(c.cast("int").alias("classId"), p.cast("float").alias("probability")))
    return table.select(*[c for c in table.columns if c not in (arr, "classid", "probability")], zipped.alias(arr))
