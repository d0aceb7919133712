"""Taxonomy ids, roll-ups and classifiers."""

from pyspark.sql import functions as F

from skyflux.functions.taxonomy import class_at_level, class_level
from skyflux.operators import classification as cl
from skyflux.operators import taxonomy as tx


def test_taxonomy_ids_match_fixture():
    ids = {r[1]: r[0] for r in tx.taxonomy_rows()}
    assert ids["Meta"] == 0 and ids["Residual"] == 200 and ids["NotClassified"] == 300
    assert ids["Static/Other"] == 1100 and ids["Variable"] == 2000
    assert ids["Ia"] == 2222 and ids["91bg"] == 2226 and ids["uLens"] == 2235
    assert ids["PISN"] == 2246 and ids["LPV/Mira"] == 2326 and ids["AGN"] == 2332
    assert ids["Non-Periodic/Other"] == 2331 and ids["Long/Other"] == 2241


def test_class_levels(spark):
    df = spark.createDataFrame([(2222,), (2220,), (2200,), (2000,), (0,)], "c int")
    r = df.select(class_level("c").alias("l"), class_at_level("c", 2).alias("a")).collect()
    assert [x.l for x in r] == [4, 3, 2, 1, 0]
    assert [x.a for x in r] == [2200, 2200, 2200, 2000, 0]


def _msgs(spark, rows):
    return spark.createDataFrame(rows, "messageId long, classifications array<struct<classId:int,probability:float>>")


def test_taxonomy_ids_are_the_written_ones():
    from skyflux.plans.q_classification import taxonomy_values
    assert sorted((r[0], r[1]) for r in tx.taxonomy_rows()) == taxonomy_values()


def test_classifier_dim_keeps_ids(spark):
    from skyflux.operators import classification as cl
    cols = "brokerName string, brokerVersion string, classifierName string, classifierParams string"
    old = cl.classifier_dim(spark.createDataFrame([("b", "1", "x", ""), ("c", "1", "x", "")], cols))
    new = cl.classifier_dim(spark.createDataFrame([("a", "1", "x", ""), ("c", "1", "x", ""), ("d", "1", "x", "")], cols), existing=old)
    assert {r.brokerName: r.classifierId for r in new.collect()} == {"b": 1, "c": 2, "a": 3, "d": 4}


def test_sum_check_and_residual(spark):
    m = _msgs(spark, [(1, [(2222, 0.6), (2223, 0.4)]), (2, [(2222, 0.33)]), (3, [(300, 1.0)])])
    bad = {r.messageId for r in cl.probability_sum_check(m).collect()}
    assert bad == {2}
    filled = {r.messageId: r.classifications for r in tx.residual_fill(m).collect()}
    assert len(filled[1]) == 2 and filled[2][-1].classId == 200
    assert abs(filled[2][-1].probability - 0.67) < 1e-6


def test_rollup_sums_to_one_per_level(spark):
    m = _msgs(spark, [(1, [(2222, 0.5), (2232, 0.25), (2332, 0.25)])])
    r = tx.rollup_probabilities(m, ["messageId"])
    lv = {x.level: x.s for x in r.groupBy("level").agg(F.sum("probability").alias("s")).collect()}
    assert all(abs(v - 1.0) < 1e-6 for v in lv.values()) and set(lv) == {1, 2, 3, 4}
    l3 = {x.classId: x.probability for x in r.filter("level = 3").collect()}
    assert l3 == {2220: 0.5, 2230: 0.25, 2330: 0.25}


def test_random_split_sums_to_one_and_repeats(spark):
    a = spark.range(200).select(F.col("id").alias("alertId"), F.col("id").alias("diaSourceId"))
    c = cl.RandomSplitClassifier(seed=3)
    m1 = cl.classify_all(a, [c, cl.FixedClassifier()])
    s = m1.select("alertId", "classifierName", F.aggregate("classifications", F.lit(0.0).cast("double"),
                                                           lambda x, y: x + y["probability"].cast("double")).alias("s"))
    assert s.filter(F.abs(F.col("s") - 1) > 1e-5).count() == 0
    assert m1.count() == 400
    p1 = [r.classifications for r in cl.classify(a.repartition(3), c).orderBy("alertId").collect()]
    p2 = [r.classifications for r in cl.classify(a, c).orderBy("alertId").collect()]
    assert p1 == p2


def test_pandas_classifier(spark):
    a = spark.range(10).select(F.col("id").alias("alertId"), F.col("id").alias("diaSourceId"))

    def model(pdf):
        return [[(2222, 0.7), (200, 0.3)] if x % 2 else [(300, 1.0)] for x in pdf["alertId"]]
    m = cl.classify(a, cl.PandasClassifier(model, ["alertId"]))
    r = {x.alertId: x.classifications for x in m.collect()}
    assert r[1][0].classId == 2222 and r[2][0].classId == 300


def test_best_class_tie_lowest_id(spark):
    m = _msgs(spark, [(1, [(2224, 0.5), (2222, 0.5)])])
    assert cl.best_class(m).first().bestClassId == 2222


def test_confusion_matrix_explicit_columns(spark):
    b = spark.createDataFrame([(2222, 2222), (2222, 2223), (2223, 2223)], "trueClassId int, bestClassId int")
    cm = {r.trueClassId: r for r in cl.confusion_matrix(b, [2222, 2223, 2224]).collect()}
    assert (cm[2222].pred_2222, cm[2222].pred_2223, cm[2222].pred_2224) == (1, 1, 0)


def test_latest_message_picks_latest_then_highest_id(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, 10, 0, t0, "a"), (2, 10, 0, t0 + dt.timedelta(hours=1), "b"), (3, 10, 1, t0, "c"),
            (4, 11, 0, t0, "d"), (5, 11, 0, t0, "e")]
    df = spark.createDataFrame(rows, "messageId long, diaSourceId long, classifierId int, "
                                     "brokerIngestTimestamp timestamp, version string")
    got = {(r.diaSourceId, r.classifierId): r.version for r in cl.latest_message(df).collect()}
    assert got == {(10, 0): "b", (10, 1): "c", (11, 0): "e"}
