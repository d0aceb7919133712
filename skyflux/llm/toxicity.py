"""Toxicity by a classifier chain.

Categories are predicted one after the other by logistic models over hashed
word features; a later model also gets the probabilities of the earlier ones.
In training those probabilities are out-of-fold: each row's comes from a model
that has not seen the row, so a later model learns from what it will meet.

The models are fitted on a bounded sample of labelled rows (``SAMPLE``, half of
it with and half without the last category where there are enough, weighted
back to their shares). Everything else runs over all rows and whole texts.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyflux.llm.common import by_chars, claim, give_back_memory, lean, words

#: Labelled rows that a chain is fitted on, at most.
SAMPLE = 20_000
#: Hash buckets of the features; features of a category; folds.
BUCKETS = 1 << 18
FEATURES = 1024
FOLDS = 3
_PREFIXES = (4, 5, 6)
_MARKS = b".,;:!?\"'()[]{}<>|*#%&$@-_~/\\"
_CACHE = 150_000
_CHUNK = 4_000_000


def word_features(word: bytes) -> tuple[int, ...]:
    """Buckets of a word (marks around it removed) and of its first letters."""
    w = word.strip(_MARKS)
    if not w:
        return ()
    return tuple({zlib.crc32(b"w" + w) % BUCKETS, *(zlib.crc32(b"p" + w[:n]) % BUCKETS for n in _PREFIXES if len(w) > n)})


def text_features(text: str | None) -> np.ndarray:
    """Distinct buckets of a whole text."""
    found: set[int] = set()
    for w in set(words(text)):
        found.update(word_features(w))
    return np.fromiter(sorted(found), dtype=np.int32, count=len(found))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


class Rows:
    """A 0/1 matrix by its ones, with a few dense columns after it and a column of ones last."""

    def __init__(self, row: np.ndarray, col: np.ndarray, width: int, dense: np.ndarray):
        self.row, self.col, self.width = row, col, width
        self.dense = np.hstack([dense, np.ones((len(dense), 1))])

    def take(self, keep: np.ndarray) -> Rows:
        to = np.cumsum(keep) - 1
        ones = keep[self.row]
        return Rows(to[self.row[ones]], self.col[ones], self.width, self.dense[keep, :-1])

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.col], minlength=len(self.dense)) + self.dense @ w[self.width:]

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(self.col, weights=r[self.row], minlength=self.width), self.dense.T @ r])


def fit_logistic(x: Rows, y: np.ndarray, weight: np.ndarray, rounds: int = 250, ridge: float = 1e-5) -> np.ndarray:
    """Weights and, last, the bias: accelerated gradient steps on the weighted log-loss."""
    weight = weight / weight.sum()
    size = x.width + x.dense.shape[1]
    v = np.ones(size)
    for _ in range(12):                                      # largest eigenvalue of the curvature bound
        v = x.back(weight * x.dot(v))
        v /= max(np.linalg.norm(v), 1e-12)
    step = 1.0 / (0.26 * float(v @ x.back(weight * x.dot(v))) + ridge)
    w = look = np.zeros(size)
    for k in range(rounds):
        grad = x.back(weight * (_sigmoid(x.dot(look)) - y)) + ridge * np.append(look[:-1], 0)
        new = look - step * grad
        look = new + (k / (k + 3)) * (new - w)
        w = new
    return w


def best_threshold(p: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The cut with the largest F1, half-way to the next lower probability, from
    0.1 to 0.9; 0.5 where under ten rows are positive, too few to choose by."""
    if (y > 0).sum() < 10:
        return 0.5
    by = np.argsort(-p, kind="stable")
    p, hit = p[by], np.cumsum((weight * y)[by])
    f1 = 2 * hit / (np.cumsum(weight[by]) + (weight * y).sum())
    f1[:-1][p[:-1] == p[1:]] = 0                             # a cut lies between different values
    at = int(np.argmax(f1))
    return float(np.clip((p[at] + (p[at + 1] if at + 1 < len(p) else 0.0)) / 2, 0.1, 0.9))


def _select(buckets: list[np.ndarray], y: np.ndarray, weight: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` buckets with the largest chi-square, those in under 3 rows left out."""
    n, with_, pos = (np.zeros(BUCKETS) for _ in range(3))
    for b, w, hit in zip(buckets, weight, y):                # a row's buckets are distinct
        n[b] += 1
        with_[b] += w
        pos[b] += w * hit
    total, p = weight.sum(), (weight * y).sum()
    expect = with_ * p / total
    other = (total - with_) * p / total
    chi = (pos - expect) ** 2 * (1 / np.maximum(expect, 1e-9) + 1 / np.maximum(other, 1e-9))
    chi[n < 3] = 0
    best = np.argsort(-chi, kind="stable")[:size]
    return np.sort(best[chi[best] > 0])


def fit_chain(buckets: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, names: list[str], folds: int = FOLDS,
              size: int = FEATURES) -> list[dict]:
    """One model per category, in order. Each has its buckets, weights (buckets,
    earlier probabilities, bias) and the threshold with the best out-of-fold F1;
    where a category has one value only, that value."""
    models, chained = [], np.zeros((len(buckets), 0))
    fold = np.arange(len(buckets)) % folds
    for c, name in enumerate(names):
        y = labels[:, c].astype(float)
        if not len(y) or y.min() == y.max():
            models.append({"name": name, "constant": float(y[0]) if len(y) else 0.0})
            chained = np.hstack([chained, np.full((len(y), 1), models[-1]["constant"])])
            continue
        cols = _select(buckets, y, weight, size)
        at = np.full(BUCKETS, -1, dtype=np.int64)
        at[cols] = np.arange(len(cols))
        hits = [h[h >= 0] for h in (at[b] for b in buckets)]
        x = Rows(np.repeat(np.arange(len(hits)), [len(h) for h in hits]), np.concatenate(hits), len(cols), chained)
        oof = np.zeros(len(y))
        for f in range(folds):
            test = fold == f
            if test.any() and (~test).any():
                oof[test] = _sigmoid(x.take(test).dot(fit_logistic(x.take(~test), y[~test], weight[~test])))
        models.append({"name": name, "buckets": cols, "weights": fit_logistic(x, y, weight),
                       "threshold": best_threshold(oof, y, weight)})
        chained = np.hstack([chained, oof[:, None]])
    return models


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], id_col: str = "doc_id",
          text_col: str = "text", sample: int = SAMPLE) -> list[dict]:
    """Fit the chain. ``categories`` are boolean columns over ``labels``; rows
    where one is null are left out. The sample is taken by the digest of the id;
    its ids are broadcast (at most ``sample`` rows), so only its texts are read
    further. Without labelled rows every model is the constant 0."""
    names = list(categories)
    known = labels.select(F.col(id_col).alias("_id"), *[c.cast("int").alias(f"_y{i}") for i, c in enumerate(categories.values())]).dropna()
    known = known.groupBy("_id").agg(*[F.max(f"_y{i}").alias(f"_y{i}") for i in range(len(names))])
    last, key = F.col(f"_y{len(names) - 1}"), F.md5(F.col("_id").cast("string"))
    sizes = {r[0]: r[1] for r in known.groupBy(last).count().collect()}
    take = {v: min(n, max(sample // 2, sample - sizes.get(1 - v, 0))) for v, n in sizes.items()}
    chosen = None
    for v, n in take.items():
        part = known.filter(last == v).orderBy(key, "_id").limit(n).withColumn("_w", F.lit(sizes[v] / n))
        chosen = part if chosen is None else chosen.unionByName(part)
    if chosen is None:
        return [{"name": n, "constant": 0.0} for n in names]

    def featurize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim("toxicity")
        for pdf in batches:
            pdf["x"] = [text_features(t).tobytes() for t in pdf["text"]]
            yield pdf.drop(columns="text")

    ys = ", ".join(f"_y{i} int" for i in range(len(names)))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "_id")
    cols = ["_id", *[f"_y{i}" for i in range(len(names))], "_w", "text"]
    rows = rows.select(*cols).mapInPandas(featurize, f"_id {docs.schema[id_col].dataType.simpleString()}, {ys}, _w double, x binary")

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim("toxicity")
        got = list(batches)
        models = [{"name": n, "constant": 0.0} for n in names]
        if got and sum(map(len, got)):
            pdf = pd.concat(got).drop_duplicates("_id").sort_values("_id")
            got.clear()
            y = pdf[[f"_y{i}" for i in range(len(names))]].to_numpy()
            with lean():
                models = fit_chain([np.frombuffer(b, dtype=np.int32) for b in pdf["x"]], y, pdf["_w"].to_numpy(), names)
        yield pd.DataFrame({"model": [pickle.dumps(models)]})

    # features are made where the texts are; only the bounded sample's meet in one task (a shuffle: coalesce()
    # would pull the scan into it). What comes back is FEATURES weights a category.
    return pickle.loads(rows.repartition(1).mapInPandas(fit, "model binary").first()[0])


def predict(docs: DataFrame, models: list[dict], id_col: str = "doc_id", text_col: str = "text",
            keep: list[str] | None = None, prefix: str = "p_") -> DataFrame:
    """``keep`` columns (the id by default) plus p_<category> (double) of each
    model in turn; columns with these names are replaced. Null and empty texts
    have no features. Every row is kept."""
    keep = [id_col] if keep is None else keep
    names = [prefix + m["name"] for m in models]
    keep = [c for c in keep if c not in names]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(n, T.DoubleType()) for n in names])
    every = np.unique(np.concatenate([m["buckets"] for m in models if "buckets" in m] or [np.zeros(0, dtype=np.int64)]))
    sent = docs.sparkSession.sparkContext.broadcast((models, every))      # at most FEATURES buckets per category

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("toxicity")
        models, every = sent.value
        wanted = frozenset(every.tolist())
        local = {b: i for i, b in enumerate(every.tolist())}
        table = []
        for c, m in enumerate(models):
            if "buckets" in m:
                w = np.zeros(len(every))
                w[[local[b] for b in m["buckets"].tolist()]] = m["weights"][:len(m["buckets"])]
                table.append((w, m["weights"][len(m["buckets"]):-1].astype(float), float(m["weights"][-1])))
            else:
                table.append(None)
        seen: dict[bytes, tuple[int, ...]] = {}
        for batch in batches:
            for b in by_chars(batch, text_col, _CHUNK):
                p = np.zeros((b.num_rows, len(models)))
                for i, t in enumerate(b.column(text_col)):
                    found: set[int] = set()
                    for word in set(words(t.as_py())):
                        hit = seen.get(word)
                        if hit is None:
                            if len(seen) >= _CACHE:
                                seen.clear()
                            hit = seen[word] = tuple(local[f] for f in word_features(word) if f in wanted)
                        if hit:
                            found.update(hit)
                    at = sorted(found)
                    for c, fitted in enumerate(table):
                        if fitted is None:
                            p[i, c] = models[c]["constant"]
                        else:
                            w, chain, bias = fitted
                            p[i, c] = _sigmoid(w[at].sum() + p[i, :c] @ chain + bias)
                yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [pa.array(p[:, c]) for c in range(len(models))],
                                                 names=[*keep, *names])
        seen.clear()
        give_back_memory()                                    # the worker is reused by later stages

    cols = [*keep, *([text_col] if text_col not in keep else [])]
    return docs.select(*cols).mapInArrow(run, schema)


#: Production chain: toxic in English, toxic in another language, then toxic at all.
def toxic_categories() -> dict[str, Column]:
    toxic, english = F.col("toxic") == 1, F.coalesce(F.col("lang") == "en", F.lit(False))
    return {"toxic_english": toxic & english, "toxic_other": toxic & ~english, "toxic": toxic}


def train_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[list[dict], float]:
    """The production chain and its threshold (the best out-of-fold F1 of the last category).
    ``labels``: id and toxic (0 or 1; null is no label); an id labelled twice counts as toxic if any says so."""
    known = labels.select(id_col, "toxic").join(docs.select(F.col(id_col), "lang"), id_col)
    models = train(docs, known, toxic_categories(), id_col, text_col)
    return models, models[-1].get("threshold", 0.5)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float | None = None) -> DataFrame:
    """One row per row of ``docs`` (id, text, lang): id, p_toxic_english,
    p_toxic_other, p_toxic and toxic (p_toxic >= threshold), trained on ``labels``."""
    models, best = train_toxic(docs, labels, id_col, text_col)
    return predict(docs, models, id_col, text_col).withColumn("toxic", F.col("p_toxic") >= (best if threshold is None else threshold))
