"""Registered queries: taxonomy and classification analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyflux.functions.taxonomy import class_at_level
from skyflux.operators import classification as cl
from skyflux.operators import taxonomy as tx
from skyflux.plans import bindings as B
from skyflux.plans.registry import query
from skyflux.plans.sql import ALERTS_EV, MESSAGES_EMB, PHOT_EV, TRUTH_EV, with_

CLASSES = [2222, 2223, 2224, 2225, 2226]


@query("rollup_probabilities", with_(MESSAGES_EMB) + """
SELECT messageId, lv AS level,
       CAST(floor(classId / power(10, 4 - lv)) * power(10, 4 - lv) AS INTEGER) AS classId,
       sum(probability) AS probability
FROM msg_long, (VALUES (1), (2), (3), (4)) l(lv)
GROUP BY messageId, lv, CAST(floor(classId / power(10, 4 - lv)) * power(10, 4 - lv) AS INTEGER)""",
       ["probability"])
def q_rollup_probabilities(spark, d):
    """TAX3: probabilities summed to every ancestor level."""
    return tx.rollup_probabilities(B.messages_emb(spark, d), ["messageId"])


@query("residual_fill", with_(MESSAGES_EMB) + """
, s AS (SELECT messageId, sum(probability) AS tot FROM msg_long WHERE classId <= 2225 GROUP BY messageId)
SELECT messageId,
       CAST(CASE WHEN abs(tot - 1.0) > 1e-6 THEN 5 ELSE 4 END AS INTEGER) AS nClasses,
       CASE WHEN abs(tot - 1.0) > 1e-6 THEN 1.0 - tot END AS residual
FROM s""".replace("\n, s AS", ",\ns AS", 1), ["residual"])
def q_residual_fill(spark, d):
    """TAX4: messages keep only four of five classes; the Residual (200) takes the rest."""
    m = B.messages_emb(spark, d)
    m = m.withColumn("classifications", F.slice("classifications", 1, 4))
    r = tx.residual_fill(m)
    res = F.filter("classifications", lambda x: x["classId"] == tx.RESIDUAL_ID)
    return r.select("messageId", F.size("classifications").alias("nClasses"),
                    F.element_at(res, 1)["probability"].alias("residual"))


@query("probability_sum_check", with_(MESSAGES_EMB) + """
SELECT messageId, sum(raw_probability) AS probabilitySum, CAST(count(*) AS INTEGER) AS nClasses
FROM msg_long GROUP BY messageId HAVING abs(sum(raw_probability) - 1.0) > 1e-4""", ["probabilitySum"])
def q_probability_sum_check(spark, d):
    """AGG16 on unnormalised scores: violators of sum(p) = 1."""
    return cl.probability_sum_check(B.messages_emb(spark, d, normalise=False))


_BEST = """best AS (
  SELECT messageId, diaSourceId, classifierId, trueClassId, classId AS bestClassId,
         probability AS bestProbability
  FROM (SELECT *, row_number() OVER (PARTITION BY messageId ORDER BY probability DESC, classId) AS rn
        FROM msg_long) WHERE rn = 1)"""


@query("best_class", with_(MESSAGES_EMB, _BEST) + """
SELECT messageId, bestClassId, bestProbability FROM best""", ["bestProbability"])
def q_best_class(spark, d):
    b = cl.best_class(B.messages_emb(spark, d))
    return b.select("messageId", "bestClassId", "bestProbability")


@query("confusion_matrix", with_(MESSAGES_EMB, _BEST) + """
SELECT trueClassId,
       count(*) FILTER (WHERE bestClassId = 2222) AS pred_2222,
       count(*) FILTER (WHERE bestClassId = 2223) AS pred_2223,
       count(*) FILTER (WHERE bestClassId = 2224) AS pred_2224,
       count(*) FILTER (WHERE bestClassId = 2225) AS pred_2225,
       count(*) FILTER (WHERE bestClassId = 2226) AS pred_2226
FROM best GROUP BY trueClassId""")
def q_confusion_matrix(spark, d):
    return cl.confusion_matrix(cl.best_class(B.messages_emb(spark, d)), CLASSES)


def _messages_long_with_objects(spark, d):
    m = B.messages_emb(spark, d).join(B.sources_ev(spark, d).select("diaSourceId", "diaObjectId"),
                                      "diaSourceId")
    return tx.explode_classifications(m)


_MSG_OBJ = """mo AS (
  SELECT m.*, a.diaObjectId FROM msg_long m JOIN alerts_ev a ON m.diaSourceId = a.diaSourceId)"""


@query("mean_probabilities", with_(PHOT_EV, ALERTS_EV, MESSAGES_EMB, _MSG_OBJ) + """
SELECT trueClassId, classifierId, diaObjectId, classId, avg(probability) AS meanProbability,
       count(*) AS nMessages
FROM mo GROUP BY trueClassId, classifierId, diaObjectId, classId""", ["meanProbability"])
def q_mean_probabilities(spark, d):
    return cl.mean_probabilities(_messages_long_with_objects(spark, d))


@query("max_probabilities", with_(PHOT_EV, ALERTS_EV, MESSAGES_EMB, _MSG_OBJ) + """
SELECT trueClassId, classifierId, diaObjectId, classId, max(probability) AS maxProbability
FROM mo GROUP BY trueClassId, classifierId, diaObjectId, classId""", ["maxProbability"])
def q_max_probabilities(spark, d):
    return cl.max_probabilities(_messages_long_with_objects(spark, d))


@query("objects_of_class", with_(PHOT_EV, ALERTS_EV, MESSAGES_EMB, _MSG_OBJ) + """
SELECT DISTINCT diaObjectId FROM mo WHERE classifierId = 0 AND trueClassId = 2222""")
def q_objects_of_class(spark, d):
    return cl.objects_of_class(_messages_long_with_objects(spark, d), 0, 2222)


@query("sources_of_class", with_(PHOT_EV, ALERTS_EV, MESSAGES_EMB, _MSG_OBJ) + """
SELECT DISTINCT diaSourceId FROM mo WHERE classifierId = 1 AND trueClassId = 2223""")
def q_sources_of_class(spark, d):
    return cl.objects_of_class(_messages_long_with_objects(spark, d), 1, 2223, what="diaSourceId")


@query("alert_truth", with_(PHOT_EV, ALERTS_EV, TRUTH_EV) + """
, msg AS (SELECT vec_id AS messageId, vec_id AS diaSourceId FROM embeddings),
cmap AS (SELECT DISTINCT GENTYPE AS gentype, CAST(2222 + GENTYPE % 5 AS INTEGER) AS classId FROM truth_ev)
SELECT m.messageId, m.diaSourceId, a.diaObjectId, t.GENTYPE AS gentype, c.classId AS trueClassId
FROM msg m JOIN alerts_ev a ON m.diaSourceId = a.diaSourceId
JOIN truth_ev t ON a.diaObjectId = t.SNID
JOIN cmap c ON t.GENTYPE = c.gentype""".replace("\n, msg AS", ",\nmsg AS", 1))
def q_alert_truth(spark, d):
    """JOIN8: message -> source -> object -> truth -> true class."""
    m = B.messages_emb(spark, d).select("messageId", "diaSourceId")
    out = cl.alert_truth(m, B.sources_ev(spark, d), B.truth_ev(spark, d), B.class_map_ev(spark, d))
    return out.select("messageId", "diaSourceId", "diaObjectId", "gentype", "trueClassId")


@query("map_gentype_class", with_(MESSAGES_EMB, TRUTH_EV, _BEST) + """
, cmap AS (SELECT DISTINCT GENTYPE AS gentype, CAST(2222 + GENTYPE % 5 AS INTEGER) AS classId FROM truth_ev),
q AS (SELECT messageId, CAST(floor(bestClassId / power(10, messageId % 4))
                             * power(10, messageId % 4) AS INTEGER) AS classId,
             CAST(4 - messageId % 4 AS INTEGER) AS lvl FROM best)
SELECT q.messageId, q.classId, c.gentype FROM q JOIN cmap c
  ON CAST(floor(c.classId / power(10, 4 - q.lvl)) * power(10, 4 - q.lvl) AS INTEGER) = q.classId""".replace(
    "\n, cmap AS", ",\ncmap AS", 1))
def q_map_gentype_class(spark, d):
    """JOIN9 at all four match levels: message k asks for its best class at
    level 4 - k % 4 (exact, category, broad, general)."""
    b = cl.best_class(B.messages_emb(spark, d))
    lvl = F.lit(4) - F.col("messageId") % 4
    k = F.pow(F.lit(10), F.lit(4) - lvl)
    q = b.select("messageId", (F.floor(F.col("bestClassId") / k) * k).cast("int").alias("classId"))
    return tx.map_gentype_class(q, B.class_map_ev(spark, d)).select("messageId", "classId", "gentype")


@query("latest_message", with_(MESSAGES_EMB) + """
, m AS (SELECT DISTINCT messageId, diaSourceId, classifierId FROM msg_long),
e AS (SELECT vec_id, label FROM embeddings),
u AS (SELECT m.messageId * 2 AS messageId, m.diaSourceId, m.classifierId, 'orig' AS version, 0 AS t FROM m
      UNION ALL
      SELECT m.messageId * 2 + 1, m.diaSourceId, m.classifierId, 'resend', 1 FROM m
      JOIN e ON m.messageId = e.vec_id WHERE e.label = 1)
SELECT diaSourceId, classifierId, messageId, version FROM (
  SELECT *, row_number() OVER (PARTITION BY diaSourceId, classifierId ORDER BY t DESC, messageId DESC) AS rn
  FROM u) WHERE rn = 1""".replace("\n, m AS", ",\nm AS", 1))
def q_latest_message(spark, d):
    """WIN6: a re-sent message (one hour later) replaces the original."""
    out = cl.latest_message(B.messages_resent(spark, d))
    return out.select("diaSourceId", "classifierId", "messageId", "version")


@query("classifier_dim", """
SELECT brokerName, brokerVersion, classifierName, classifierParams,
       dense_rank() OVER (ORDER BY brokerName, brokerVersion, classifierName, classifierParams) AS classifierId
FROM (SELECT DISTINCT 'broker' || CAST(label % 2 AS VARCHAR) AS brokerName,
             'v' || CAST(vec_id % 3 AS VARCHAR) AS brokerVersion,
             'clf' || CAST(vec_id % 3 AS VARCHAR) AS classifierName,
             'p' || CAST(label % 3 AS VARCHAR) AS classifierParams FROM embeddings)""")
def q_classifier_dim(spark, d):
    return cl.classifier_dim(B.messages_identity(spark, d))


@query("fixed_classifier", with_(PHOT_EV, ALERTS_EV) + """
SELECT alertId, diaSourceId, 'FixedClass' AS classifierName, 111 AS classId,
       CAST(1.0 AS FLOAT) AS probability FROM alerts_ev""")
def q_fixed_classifier(spark, d):
    """UDF2 over every alert."""
    m = cl.classify(B.alerts_ev(spark, d), cl.FixedClassifier())
    return tx.explode_classifications(m.select("alertId", "diaSourceId", "classifierName", "classifications")) \
        .withColumn("probability", F.col("probability").cast("float"))


def messages_sql(seed: int) -> str:
    """Both classifiers' messages: number of classes, their sum and the first
    and last probability of the stick-breaking draws."""
    u = lambda i: (f"CAST(CAST('0x' || substr(md5(CAST(alertId AS VARCHAR) || '|{i}|{seed}'), 1, 12) AS BIGINT) AS DOUBLE)"  # noqa: E731
                   " / 281474976710656")
    rest = " * ".join(f"(1 - {u(i)})" for i in range(6))
    return f"""SELECT alertId, 'FixedClass' AS classifierName, CAST(1 AS INTEGER) AS nClasses, CAST(1 AS DOUBLE) AS probabilitySum,
       CAST(1 AS DOUBLE) AS firstProbability, CAST(1 AS DOUBLE) AS lastProbability FROM alerts_ev
UNION ALL
SELECT alertId, 'RandomSplit', CAST(7 AS INTEGER), CAST(1 AS DOUBLE), CAST(CAST({u(0)} AS FLOAT) AS DOUBLE),
       CAST(CAST({rest} AS FLOAT) AS DOUBLE) FROM alerts_ev"""


MESSAGE_ROUND = ["probabilitySum", "firstProbability", "lastProbability"]


def message_view(m):
    p = lambda at: F.element_at("classifications", at)["probability"].cast("double")
    return m.select("alertId", "classifierName", F.size("classifications").alias("nClasses"),
                    F.aggregate("classifications", F.lit(0.0).cast("double"),
                                lambda a, x: a + x["probability"].cast("double")).alias("probabilitySum"),
                    p(1).alias("firstProbability"), p(-1).alias("lastProbability"))


@query("classify_all", with_(PHOT_EV, ALERTS_EV) + messages_sql(42), MESSAGE_ROUND)
def q_classify_all(spark, d):
    """SET4 + UDF3: every classifier on every alert."""
    alerts = B.alerts_ev(spark, d)
    m = cl.classify_all(alerts, [cl.FixedClassifier(), cl.RandomSplitClassifier(seed=42)])
    return message_view(m)


# The class ids and names of the taxonomy, written out so that the
# oracle does not come from the operator.
_TAXONOMY = """0 Meta;100 Meta/Other;200 Residual;300 NotClassified;1000 Static;1100 Static/Other;2000 Variable;
2100 Variable/Other;2200 Non-Recurring;2210 Non-Recurring/Other;2220 SN-like;2221 SN-like/Other;2222 Ia;2223 Ib/c;2224 II;
2225 Iax;2226 91bg;2230 Fast;2231 Fast/Other;2232 KN;2233 M-dwarf Flare;2234 Dwarf Novae;2235 uLens;2240 Long;
2241 Long/Other;2242 SLSN;2243 TDE;2244 ILOT;2245 CART;2246 PISN;2300 Recurring;2310 Recurring/Other;2320 Periodic;
2321 Periodic/Other;2322 Cepheid;2323 RR Lyrae;2324 Delta Scuti;2325 EB;2326 LPV/Mira;2330 Non-Periodic;
2331 Non-Periodic/Other;2332 AGN"""


def taxonomy_values() -> list[tuple[int, str]]:
    return [(int(i), name) for i, name in (x.strip().split(" ", 1) for x in _TAXONOMY.replace("\n", "").split(";"))]


def _taxonomy_values() -> str:
    return "tax(classId, name) AS (VALUES " + ", ".join(f"({i}, '{n}')" for i, n in taxonomy_values()) + ")"


@query("rollup_probabilities_named", with_(MESSAGES_EMB, _taxonomy_values()) + """
, r AS (
  SELECT messageId, lv AS level,
         CAST(floor(classId / power(10, 4 - lv)) * power(10, 4 - lv) AS INTEGER) AS classId,
         sum(probability) AS probability
  FROM msg_long, (VALUES (1), (2), (3), (4)) l(lv)
  GROUP BY messageId, lv, CAST(floor(classId / power(10, 4 - lv)) * power(10, 4 - lv) AS INTEGER))
SELECT r.messageId, r.level, r.classId, t.name, r.probability
FROM r LEFT JOIN tax t ON CAST(t.classId AS INTEGER) = r.classId""".replace("\\n, r AS", ",\\nr AS", 1),
       ["probability"])
def q_rollup_probabilities_named(spark, d):
    """TAX1 + TAX3: roll-ups labelled with the taxonomy's class names."""
    r = tx.rollup_probabilities(B.messages_emb(spark, d), ["messageId"])
    names = F.broadcast(tx.taxonomy_table(spark).select("classId", "name"))   # fixed tens of rows
    return r.join(names, "classId", "left").select("messageId", "level", "classId", "name", "probability")


@query("class_id_table", with_(TRUTH_EV, _taxonomy_values()) + """
, g AS (SELECT DISTINCT GENTYPE AS gentype, 2222 + GENTYPE % 5 AS c FROM truth_ev),
lv AS (SELECT *, CASE WHEN classId = 0 THEN 0 WHEN classId % 1000 = 0 THEN 1000 WHEN classId % 100 = 0 THEN 100
                      WHEN classId % 10 = 0 THEN 10 ELSE 1 END AS k FROM tax)
SELECT lv.classId, lv.name AS description,
       coalesce(string_agg(CAST(g.gentype AS VARCHAR), ',' ORDER BY g.gentype), '') AS gentypes,
       (classId // 1000) % 10 <> 0 AS generalmatch, (classId // 100) % 10 <> 0 AS broadmatch,
       (classId // 10) % 10 <> 0 AS categorymatch, classId % 10 <> 0 AS exactmatch
FROM lv LEFT JOIN g ON lv.k > 0 AND (g.c // lv.k) * lv.k = lv.classId GROUP BY lv.classId, lv.name""".replace("\n, g AS", ",\ng AS", 1))
def q_class_id_table(spark, d):
    """Every class id with its description, model types of the data and match level."""
    t = tx.class_id_table(spark, B.class_map_ev(spark, d))
    return t.withColumn("gentypes", F.array_join(F.col("gentypes").cast("array<string>"), ","))


@query("messages_table_form", with_(PHOT_EV, ALERTS_EV, MESSAGES_EMB, _MSG_OBJ) + """
SELECT trueClassId, classifierId, diaObjectId, classId, max(CAST(CAST(probability AS FLOAT) AS DOUBLE)) AS maxProbability
FROM mo GROUP BY trueClassId, classifierId, diaObjectId, classId""", ["maxProbability"])
def q_messages_table_form(spark, d):
    """Messages stored as parallel arrays, read back and aggregated (AGG12)."""
    stored = cl.to_table_form(B.messages_emb(spark, d))
    m = cl.from_table_form(stored).join(B.sources_ev(spark, d).select("diaSourceId", "diaObjectId"), "diaSourceId")
    long = tx.explode_classifications(m.select("trueClassId", "classifierId", "diaObjectId", "classifications"))
    return cl.max_probabilities(long)
