"""Mixing sources to target weights by iterative proportional fitting.

Token counts per (source, language, topic) cell are raked until the marginals
agree with the targets; a document is then kept with its cell's calibrated
probability. A category that no target names counts under ``*``, so the cells
are at most the product of the target lists, whatever the data.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyflux.llm.common import WORD, checkpoint_table, text_or_empty

OTHER = "*"

#: (name, pattern): the first pattern found anywhere in the text names its topic.
#: All are read alike by Java and RE2.
TOPICS = [
    ("legal", r"[Ll]icen[sc]e"),
    ("contact", r"[A-Za-z0-9._]@[A-Za-z0-9.]"),      # an address, not a bare mention
    ("table", r"\|"),
    ("numbers", r"[0-9]{3}"),
    ("emphatic", r"[!?]"),
]


def topic_of(text: Column) -> Column:
    """A topic from the whole text: the first of TOPICS that occurs, else "prose"."""
    out = None
    for name, pattern in TOPICS:
        hit = text.rlike(pattern)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("prose")


@dataclass
class Targets:
    """Shares of each marginal, by category; ``*`` is the share of all others.
    ``keep`` is the share of all tokens to keep."""

    marginals: dict[str, dict[str, float]]
    keep: float = 0.5
    rounds: int = 60
    seed: str = "mix-1"
    names: list[str] = field(init=False)

    def __post_init__(self):
        self.names = list(self.marginals)


def rake(tokens: np.ndarray, targets: list[np.ndarray], rounds: int) -> np.ndarray:
    """Cell weights with the target marginals, of the shape of ``tokens``.
    A category without tokens cannot be filled: its share goes to the others in
    proportion. ``tokens`` must have a positive sum."""
    w = tokens.astype(float) / tokens.sum()
    axes = range(tokens.ndim)
    goals = []
    for a in axes:
        there = w.sum(axis=tuple(x for x in axes if x != a)) > 0
        g = np.where(there, targets[a], 0.0)
        if g.sum() <= 0:
            g = there.astype(float)
        goals.append(g / g.sum())
    for _ in range(rounds):
        for a in axes:
            now = w.sum(axis=tuple(x for x in axes if x != a))
            f = np.divide(goals[a], now, out=np.zeros_like(now), where=now > 0)
            w = w * f.reshape([-1 if x == a else 1 for x in axes])
        if w.sum() <= 0:
            return tokens / tokens.sum()
    return w


def calibrate(tokens: np.ndarray, weights: np.ndarray, keep: float) -> np.ndarray:
    """Keeping probability per cell: proportional to weight / tokens, at most 1,
    scaled so that the expected kept tokens are ``keep`` of all, as far as cells
    with a positive weight have them."""
    ratio = np.divide(weights, tokens, out=np.zeros_like(weights), where=tokens > 0)
    budget = min(keep * tokens.sum(), tokens[ratio > 0].sum())
    order = np.argsort(-ratio, axis=None, kind="stable")
    r, t = ratio.ravel()[order], tokens.ravel()[order].astype(float)
    full, rest = np.concatenate([[0.0], np.cumsum(t)]), np.concatenate([np.cumsum((r * t)[::-1])[::-1], [0.0]])
    scale = 0.0
    for k in range(len(r)):                       # the k cells with the largest ratio are kept whole
        if rest[k] > 0:
            scale = (budget - full[k]) / rest[k]
            if r[k] * scale <= 1.0 + 1e-12:
                break
    return np.minimum(1.0, ratio * scale)


def _class_of(col: Column, shares: dict[str, float]) -> Column:
    named = [k for k in shares if k != OTHER]
    return F.when(col.cast("string").isin(named), col.cast("string")).otherwise(F.lit(OTHER))


def label(docs: DataFrame, targets: Targets, text_col: str = "text", topic: Column | None = None) -> DataFrame:
    """``docs`` plus mix_tokens (words) and the cell: mix_source, mix_lang, mix_topic.
    ``topic``: the caller's topic of a row, such as a classifier's, else ``topic_of`` its text."""
    text = text_or_empty(text_col)
    return docs.drop(*_NEW).withColumns({
        "mix_tokens": F.regexp_count(text, F.lit(WORD)).cast("long"),
        "mix_source": _class_of(F.col("source"), targets.marginals["source"]),
        "mix_lang": _class_of(F.col("lang"), targets.marginals["lang"]),
        "mix_topic": _class_of(topic_of(text) if topic is None else topic, targets.marginals["topic"])})


def draw(labelled: DataFrame, targets: Targets, id_col: str = "doc_id") -> DataFrame:
    """``labelled`` plus mix_p (keeping probability), mix_u (the row's draw in
    [0, 1)) and mix_kept."""
    names = ["source", "lang", "topic"]
    cells = labelled.groupBy("mix_source", "mix_lang", "mix_topic").agg(F.sum("mix_tokens").alias("n")).collect()
    cats = [sorted({*targets.marginals[n], OTHER}) for n in names]
    tokens = np.zeros([len(c) for c in cats])
    for r in cells:
        tokens[tuple(c.index(v) for c, v in zip(cats, (r[0], r[1], r[2])))] = r["n"]
    p = np.ones_like(tokens)
    if tokens.sum() > 0:
        goal = [np.array([targets.marginals[n].get(c, 0.0) for c in cs]) for n, cs in zip(names, cats)]
        p = np.where(tokens > 0, calibrate(tokens, rake(tokens, goal, targets.rounds), targets.keep), 1.0)
    prob = labelled.sparkSession.createDataFrame(
        [(s, la, t, float(p[i, j, k])) for i, s in enumerate(cats[0]) for j, la in enumerate(cats[1])
         for k, t in enumerate(cats[2])], "mix_source string, mix_lang string, mix_topic string, mix_p double")
    u = F.conv(F.substring(F.md5(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")),
                                             F.lit(targets.seed))), 1, 12), 16, 10).cast("double") / F.lit(2.0 ** 48)
    # the cells are at most the product of the target lists: a proven size
    out = labelled.join(F.broadcast(prob), ["mix_source", "mix_lang", "mix_topic"], "left").withColumn("mix_u", u)
    out = out.withColumn("mix_kept", F.col("mix_u") < F.col("mix_p"))
    return out.select(*[c for c in labelled.columns if c not in _NEW], *_NEW)


def mix(docs: DataFrame, targets: Targets, id_col: str = "doc_id", text_col: str = "text", topic: Column | None = None) -> DataFrame:
    """``docs`` plus mix_tokens, mix_source, mix_lang, mix_topic, mix_p, mix_u, mix_kept.

    The marginals are named ``source``, ``lang`` and ``topic``; null or unnamed
    categories count under ``*``. A text without words has no tokens: it follows
    its cell's probability, 1 in a cell without tokens. Draws come from the id
    and the seed, so a rerun gives the same sample, and repeated rows share
    their fate. Columns of ``docs`` are kept; those with the new names are
    replaced. An empty table gives an empty result.

    The input is read twice, for the cells and for the rows, and not shuffled.
    """
    return draw(label(docs, targets, text_col, topic), targets, id_col)


def mix_decisions(docs: DataFrame, targets: Targets, id_col: str = "doc_id", text_col: str = "text",
                  topic: Column | None = None) -> DataFrame:
    """The same without the text: labels are stored once and drawn from there."""
    return draw(checkpoint_table(label(docs, targets, text_col, topic).drop(text_col), "mix"), targets, id_col)


def mix_report(mixed: DataFrame, targets: Targets, tolerance: float = 0.01) -> DataFrame:
    """How far the targets are reached, one row per marginal and category of a
    result of ``mix``: target (its share as asked for), there (share of the
    input's tokens), expected (share by the probabilities), drawn (share of the
    kept tokens), missed (expected and target differ by more than ``tolerance``).

    Targets are missed where a category has no tokens, where marginals exclude
    each other, and where cells are kept whole and still fall short. A share of
    nothing is null. One aggregation per cell; the marginals come from its rows."""
    names = ["source", "lang", "topic"]
    cells = mixed.groupBy(*[f"mix_{n}" for n in names]).agg(
        F.sum("mix_tokens").alias("n"), F.sum(F.col("mix_tokens") * F.col("mix_p")).alias("e"),
        F.sum(F.when(F.col("mix_kept"), F.col("mix_tokens")).otherwise(0)).alias("d"))
    long = cells.select("n", "e", "d", F.explode(F.array(*[
        F.struct(F.lit(n).alias("marginal"), F.col(f"mix_{n}").alias("category")) for n in names])).alias("m"))
    got = long.groupBy("m.marginal", "m.category").agg(*[F.sum(c).alias(c) for c in "ned"])
    asked = mixed.sparkSession.createDataFrame(
        [(n, c, float(targets.marginals[n].get(c, 0.0))) for n in names for c in sorted({*targets.marginals[n], OTHER})],
        "marginal string, category string, target double")
    every = Window.partitionBy("marginal")                                  # at most the categories of one target list
    share = lambda c: F.coalesce(F.col(c), F.lit(0)) / F.nullif(F.sum(c).over(every), F.lit(0))
    out = asked.join(got, ["marginal", "category"], "left").select(
        "marginal", "category", "target", share("n").alias("there"), share("e").alias("expected"), share("d").alias("drawn"))
    return out.withColumn("missed", F.coalesce(F.abs(F.col("expected") - F.col("target")) > tolerance, F.lit(True)))


_NEW = ["mix_tokens", "mix_source", "mix_lang", "mix_topic", "mix_p", "mix_u", "mix_kept"]


#: Production targets: the largest source is held to a tenth, languages and topics are evened out.
TARGETS = Targets({
    "source": {"src0": 0.10, "src1": 0.10, "src2": 0.10, OTHER: 0.70},
    "lang": {"en": 0.40, "de": 0.25, "fr": 0.20, "es": 0.13, OTHER: 0.02},
    "topic": {"prose": 0.50, "numbers": 0.15, "legal": 0.10, "contact": 0.10, "table": 0.05, "emphatic": 0.10, OTHER: 0.0},
})
