"""Class taxonomy (TAX1, TAX3, TAX4, JOIN9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyflux.functions.taxonomy import class_at_level, class_level
from skyflux.session import broadcast_if_small

# The class tree. Each entry is (parent, children, add "Other").
# Meta sits at id 0; children ids follow the rule
# child = parent + (i + 1) * 10^(3 - depth(parent)), with "<parent>/Other" first
# when the flag is set.
TREE = [
    ("Meta", ["Residual", "NotClassified"], True),
    ("Alert", ["Static", "Variable"], False),
    ("Static", [], True),
    ("Variable", ["Non-Recurring", "Recurring"], True),
    ("Recurring", ["Periodic", "Non-Periodic"], True),
    ("Periodic", ["Cepheid", "RR Lyrae", "Delta Scuti", "EB", "LPV/Mira"], True),
    ("Non-Periodic", ["AGN"], True),
    ("Non-Recurring", ["SN-like", "Fast", "Long"], True),
    ("SN-like", ["Ia", "Ib/c", "II", "Iax", "91bg"], True),
    ("Fast", ["KN", "M-dwarf Flare", "Dwarf Novae", "uLens"], True),
    ("Long", ["SLSN", "TDE", "ILOT", "CART", "PISN"], True),
]
RESIDUAL_ID = 200
NOT_CLASSIFIED_ID = 300

TAXONOMY_SCHEMA = T.StructType([
    T.StructField("classId", T.IntegerType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("parentId", T.IntegerType(), True),
    T.StructField("level", T.IntegerType(), False),
])


def taxonomy_rows() -> list[tuple]:
    """(classId, name, parentId, level) for every node below the root."""
    ids = {"Alert": None, "Meta": 0}
    depth = {"Alert": 0, "Meta": 1}
    parent = {"Meta": None}
    order = ["Meta"]
    for par, children, other in TREE:
        kids = ([f"{par}/Other"] if other else []) + children
        step = 10 ** (3 - depth[par])
        base = ids[par] or 0
        for i, k in enumerate(kids):
            ids[k] = base + (i + 1) * step
            depth[k] = depth[par] + 1
            parent[k] = ids[par]
            order.append(k)
    return [(ids[n], n, parent[n], depth[n]) for n in order]


def taxonomy_table(spark: SparkSession) -> DataFrame:
    """TAX1: the taxonomy as a small dimension (tens of rows)."""
    return spark.createDataFrame(taxonomy_rows(), TAXONOMY_SCHEMA)


def explode_classifications(messages: DataFrame, arr: str = "classifications") -> DataFrame:
    """One row per (message, class) from the classification array."""
    keep = [c for c in messages.columns if c != arr]
    return (messages.select(*keep, F.explode(arr).alias("__c"))
            .select(*keep, F.col("__c.classId").alias("classId"),
                    F.col("__c.probability").cast("double").alias("probability")))


def rollup_probabilities(messages: DataFrame, keys: list[str], arr: str = "classifications",
                         levels: tuple[int, ...] = (1, 2, 3, 4)) -> DataFrame:
    """TAX3: sum leaf probabilities up to ancestor classes at each level.

    Each (message, class) row is expanded to one row per requested level (the
    same expansion GROUPING SETS performs), then aggregated with a partial,
    map-side sum. Output: keys, level, classId (ancestor), probability."""
    long = explode_classifications(messages.select(*keys, arr), arr)
    anc = F.explode(F.array(*[F.struct(F.lit(lv).alias("level"),
                                       class_at_level("classId", lv).alias("anc"))
                              for lv in levels])).alias("__a")
    x = long.select(*keys, "probability", anc)
    return (x.groupBy(*keys, F.col("__a.level").alias("level"), F.col("__a.anc").alias("classId"))
            .agg(F.sum("probability").alias("probability")))


def residual_fill(messages: DataFrame, arr: str = "classifications",
                  residual_id: int = RESIDUAL_ID, eps: float = 1e-6) -> DataFrame:
    """TAX4: append (Residual, 1 - sum p) to messages whose probabilities sum to
    less than 1 (by more than ``eps``). A sum above 1 leaves no remainder: such
    a message is kept as it is, and ``probability_sum_check`` reports it. A
    per-row array expression, no shuffle."""
    et = messages.schema[arr].dataType.elementType
    ptype = et["probability"].dataType
    total = F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, x: acc + x["probability"].cast("double"))
    extra = F.array(F.struct(F.lit(residual_id).cast(et["classId"].dataType).alias("classId"),
                             (F.lit(1.0) - total).cast(ptype).alias("probability")))
    return messages.withColumn(arr, F.when(1.0 - total > eps, F.concat(F.col(arr), extra))
                               .otherwise(F.col(arr)))


def map_gentype_class(df: DataFrame, class_map: DataFrame, class_col: str = "classId",
                      level: int | None = None, map_class: str = "classId",
                      gentype: str = "gentype") -> DataFrame:
    """JOIN9: attach every model type (gentype) whose true class matches the
    row's class at ``level`` (1 general, 2 broad, 3 category, 4 exact; default:
    the row's own level, from its lowest non-zero digit).

    An equi-join: the class map (a size-checked broadcast) is expanded into
    the ancestors of each class at the four levels, and each row joins on
    (level, its class at that level)."""
    anc = F.explode(F.array(*[F.struct(F.lit(lv).alias("lv"), class_at_level(map_class, lv).alias("anc"))
                               for lv in (1, 2, 3, 4)])).alias("__a")
    m = (class_map.select(F.col(gentype).alias(gentype), anc)
         .select(gentype, F.col("__a.lv").alias("__lv"), F.col("__a.anc").alias("__anc")))
    m = broadcast_if_small(m, 40_000)
    lv = F.lit(level) if level is not None else class_level(F.col(class_col))
    key = class_at_level(class_col, level) if level is not None else F.col(class_col)
    x = df.withColumn("__lv", lv.cast("int")).withColumn("__anc", key.cast("int"))
    return x.join(m, ["__lv", "__anc"], "inner").drop("__lv", "__anc")


def class_id_table(spark: SparkSession, class_map: DataFrame, map_class: str = "classId", gentype: str = "gentype") -> DataFrame:
    """Every class of the taxonomy with its name, the sorted model types
    (``gentypes``) whose class it is or contains, and how precise the id is:
    one boolean per digit that is not 0, from most general to exact."""
    level = class_level("classId")
    t = taxonomy_table(spark).select("classId", F.col("name").alias("description")).withColumn("__lv", level)
    anc = F.explode(F.array(*[F.struct(F.lit(lv).alias("lv"), class_at_level(map_class, lv).alias("anc"))
                               for lv in (1, 2, 3, 4)])).alias("__a")
    types = (class_map.select(F.col(gentype).alias("__g"), anc).select("__g", F.col("__a.lv").alias("__lv"), F.col("__a.anc").alias("classId"))
             .groupBy("classId", "__lv").agg(F.array_sort(F.collect_set("__g")).alias("gentypes")))
    digit = lambda k: (F.floor(F.col("classId") / k) % 10) != 0
    out = t.join(types, ["classId", "__lv"], "left")
    return out.select("classId", "description",
                      F.coalesce("gentypes", F.array().cast(types.schema["gentypes"].dataType)).alias("gentypes"),
                      digit(1000).alias("generalmatch"), digit(100).alias("broadmatch"),
                      digit(10).alias("categorymatch"), digit(1).alias("exactmatch"))
