"""Approximate nearest neighbours by a robust-pruned directed graph per shard.

Vectors are dealt to shards by id; each shard indexes its distinct vectors in a
graph of bounded degree. Points enter in batches: a greedy beam search on the
graph so far proposes neighbours, and relaxed distance pruning keeps a proposal
only if no kept one is much nearer to it than the point itself (so long edges
in other directions survive). A second pass over all points with the relaxed
factor mends early edges. Every query is sent to every shard in blocks, found by
beam search there, and the shards' best are merged.

Nearness is the largest inner product. A vector gets one more coordinate,
M - sqrt(M^2 - |x|^2) with M the largest norm of its graph, which makes the order of
inner products the order of Euclidean distances to (q, M). Written as
|x|^2 / (M + sqrt(M^2 - |x|^2)) it is small for a small vector, so one vector
of a large norm does not drown the differences of the others in rounding.
Queries are ranked by -q.x, without the constant. A shard has a graph for each
band of norms (a factor of two), and every query searches all of them.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skyflux.llm.common import checkpoint_table

DEGREE = 24
BEAM = 64
RELAX = 1.2
#: Norm bands in a doubling: a query has no share in the added coordinate, and
#: the wider a band, the more of its points' length lies there.
BANDS = 8
#: Rows and components of a shard: recall falls with the points of a graph.
SHARD_ROWS, SHARD_VALUES = 8_192, 1_048_576
MIN_SHARDS = 12
QUERY_BLOCK = 50_000
_STEP = 4          # beam entries opened at a time
_BATCH = 512


def _search(x: np.ndarray, norms: np.ndarray, graph: np.ndarray, start: int, q: np.ndarray, beam: int):
    """(ids, distances) of the ``beam`` best found for each row of ``q``, nearest
    first; missing ones are -1 / inf. Distances are squared, less |q|^2; with
    zeros for ``norms`` the order is that of the inner products."""
    n = len(q)
    ids = np.full((n, beam), -1, dtype=np.int64)
    dist = np.full((n, beam), np.inf, dtype=np.float32)
    done = np.ones((n, beam), dtype=bool)
    ids[:, 0], dist[:, 0], done[:, 0] = start, norms[start] - 2 * (q @ x[start]), False
    live = np.arange(n)
    while len(live):
        li, ld, lo = ids[live], dist[live], done[live]
        rank = np.where(lo, np.inf, ld)
        pick = np.argpartition(rank, _STEP - 1, axis=1)[:, :_STEP]
        opened = np.take_along_axis(rank, pick, 1) < np.inf
        np.put_along_axis(lo, pick, True, 1)
        nxt = graph[np.where(opened, np.take_along_axis(li, pick, 1), -1)].reshape(len(live), -1)   # row -1 is all -1
        known = nxt < 0
        safe = np.where(known, 0, nxt)
        nd = norms[safe] - 2 * np.einsum("qkd,qd->qk", x[safe], q[live], optimize=True)
        nd[known] = np.inf
        ci, cd = np.concatenate([li, nxt], 1), np.concatenate([ld, nd.astype(np.float32)], 1)
        co = np.concatenate([lo, known], 1)
        by_id = np.argsort(ci, axis=1, kind="stable")              # the beam's own entry comes first: it knows if it was opened
        si = np.take_along_axis(ci, by_id, 1)
        twice = np.zeros_like(known, shape=si.shape)
        twice[:, 1:] = si[:, 1:] == si[:, :-1]
        np.put_along_axis(cd, by_id, np.where(twice, np.inf, np.take_along_axis(cd, by_id, 1)), 1)
        best = np.argsort(cd, axis=1, kind="stable")[:, :beam]
        ids[live], dist[live] = np.take_along_axis(ci, best, 1), np.take_along_axis(cd, best, 1)
        done[live] = np.take_along_axis(co, best, 1) | np.isinf(dist[live])
        live = live[~done[live].all(1)]
    ids[np.isinf(dist)] = -1
    return ids, dist


def _prune(x: np.ndarray, norms: np.ndarray, points: np.ndarray, cand: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """Robust pruning of candidate lists (-1: none) for many points at once."""
    cand = np.where(cand == points[:, None], -1, cand)
    cand = np.sort(cand, axis=1)
    cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
    safe = np.where(cand < 0, 0, cand)
    cx, cn = x[safe], norms[safe]
    d = np.maximum(cn + norms[points][:, None] - 2 * np.einsum("bcd,bd->bc", cx, x[points], optimize=True), 0)
    between = np.maximum(cn[:, :, None] + cn[:, None, :] - 2 * np.matmul(cx, cx.transpose(0, 2, 1)), 0)
    d = np.where(cand < 0, np.inf, d)
    out = np.full((len(points), degree), -1, dtype=np.int64)
    rows = np.arange(len(points))
    for k in range(degree):
        at = d.argmin(1)
        ok = d[rows, at] < np.inf
        if not ok.any():
            break
        out[:, k] = np.where(ok, cand[rows, at], -1)
        near = relax * relax * between[rows, at] <= d
        near[rows, at] = True
        d[near & ok[:, None]] = np.inf
    return out


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, relax: float = RELAX, seed: int = 7):
    """(graph, start): row i of ``graph`` has the out-neighbours of point i, -1
    where there are fewer; one more row of -1 ends it. ``x`` has distinct rows."""
    n = len(x)
    x = x.astype(np.float32)
    norms = np.einsum("ij,ij->i", x, x)
    graph = np.full((n + 1, degree), -1, dtype=np.int64)
    start = int(np.argmin(((x - x.mean(0)) ** 2).sum(1)))
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate([[start], order[order != start]])

    def link(points: np.ndarray, factor: float, proposals: np.ndarray) -> None:
        cand = np.concatenate([proposals, graph[points]], 1)
        graph[points] = _prune(x, norms, points, cand, degree, factor)
        # the way back: q gets p wherever p got q
        p, q = np.repeat(points, degree), graph[points].ravel()
        p, q = p[q >= 0], q[q >= 0]
        by = np.argsort(q, kind="stable")
        p, q = p[by], q[by]
        to, first, count = np.unique(q, return_index=True, return_counts=True)
        slot = np.arange(len(q)) - np.repeat(first, count)
        of = np.repeat(np.arange(len(to)), count)
        for low in range(0, int(count.max(initial=0)), 2 * degree):   # in rounds: a hub gets all its edges proposed
            merge(to, np.flatnonzero(count > low), p, of, slot - low, factor)

    def merge(to: np.ndarray, some: np.ndarray, p: np.ndarray, of: np.ndarray, slot: np.ndarray, factor: float) -> None:
        more = np.full((len(some), 2 * degree), -1, dtype=np.int64)
        fits = (slot >= 0) & (slot < 2 * degree)
        more[np.searchsorted(some, of[fits]), slot[fits]] = p[fits]
        to = to[some]
        both = np.sort(np.concatenate([graph[to], more], 1), axis=1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1               # an edge that was there already
        room = (both >= 0).sum(1) <= degree
        for rows in np.array_split(np.flatnonzero(~room), max(1, (~room).sum() // _BATCH)):
            if len(rows):
                graph[to[rows]] = _prune(x, norms, to[rows], both[rows], degree, factor)
        few = both[room]
        graph[to[room]] = np.take_along_axis(few, np.argsort(few < 0, axis=1, kind="stable")[:, :degree], 1)

    at = 1
    while at < n:                                     # the graph at most doubles with a batch
        pts = order[at:at + min(_BATCH, at)]
        link(pts, 1.0, _search(x, norms, graph, start, x[pts], beam)[0])
        at += len(pts)
    for at in range(0, n, _BATCH):
        pts = order[at:at + _BATCH]
        link(pts, relax, _search(x, norms, graph, start, x[pts], beam)[0])
    return graph, start


def _pack(pdf: pd.DataFrame, degree: int, beam: int) -> bytes:
    """The index of one shard: distinct vectors, the ids of each, a graph per
    norm band; a band of at most ``beam`` vectors is read whole."""
    x = np.array(pdf["vector"].tolist(), dtype=np.float64)
    ids = pdf["id"].to_numpy()
    by = np.lexsort([*x.T[::-1], ids])                              # one vector an id: the smallest
    by = by[np.concatenate([[True], ids[by][1:] != ids[by][:-1]])]
    x, ids = x[by], ids[by]
    u, of = np.unique(x, axis=0, return_inverse=True)
    of = of.ravel()
    order = np.lexsort([ids, of])
    begin = np.searchsorted(of[order], np.arange(len(u) + 1))
    band = np.floor(np.log2(_norms(u)) * BANDS + 0.5)                 # norms within a factor of 2^(1/BANDS), 1 in the middle
    parts = []
    for v in np.unique(band):
        nodes = np.flatnonzero(band == v)
        part = {"nodes": nodes}
        if len(nodes) > beam:
            w = np.ldexp(u[nodes], -int(v // BANDS))                            # norms near 1: nothing overflows or vanishes in float32
            wq = (w ** 2).sum(1)
            aug = np.concatenate([w, (wq / (np.sqrt(wq.max()) + np.sqrt(np.maximum(wq.max() - wq, 0))))[:, None]], 1)
            graph, start = build_graph(aug, degree, beam)
            part |= {"aug": aug.astype(np.float32), "graph": graph.astype(np.int32), "start": start}
        parts.append(part)
    return pickle.dumps({"x": u, "ids": ids[order], "begin": begin, "parts": parts}, protocol=5)


def _norms(x: np.ndarray) -> np.ndarray:
    """Lengths of non-zero rows of any finite size."""
    top = np.abs(x).max(1)
    return top * np.sqrt(((x / top[:, None]) ** 2).sum(1))


def _inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed in order of the components."""
    s = np.zeros(len(a))
    for j in range(a.shape[1]):
        s += a[:, j] * b[:, j]
    return s


def _ask(index: dict, qid: np.ndarray, q: np.ndarray, k: int, beam: int) -> Iterator[pd.DataFrame]:
    x, ids, begin = index["x"], index["ids"], index["begin"]
    parts = [p | ({"graph": p["graph"].astype(np.int64)} if "graph" in p else {}) for p in index["parts"]]
    for at in range(0, len(q), _BATCH):
        part, part_id = q[at:at + _BATCH], qid[at:at + _BATCH]
        unit = part / np.abs(part).max(1)[:, None]                  # the order of -q.x is that of any multiple of q
        probe = np.concatenate([unit, np.zeros((len(part), 1))], 1).astype(np.float32)
        found = []
        for p in parts:
            if "graph" in p:
                zero = np.zeros(len(p["aug"]), dtype=np.float32)       # ranked by -q.x
                at_most = min(max(beam, k + 1), max(len(p["nodes"]), _STEP))
                got, _ = _search(p["aug"], zero, p["graph"], p["start"], probe, at_most)
                found.append(np.where(got >= 0, p["nodes"][got], -1))
            else:
                found.append(np.broadcast_to(p["nodes"], (len(part), len(p["nodes"]))))
        found = np.concatenate(found, 1)
        row, col = np.nonzero(found >= 0)
        node = found[row, col]
        score = _inner(part[row], x[node])
        by = np.lexsort([-score, row])
        row, node, score = row[by], node[by], score[by]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        best = rank <= k                                            # k + 1: one may be the query's own vector
        row, node, score = row[best], node[best], score[best]
        many = np.minimum(begin[node + 1] - begin[node], k + 1)     # of equal vectors, the smallest ids
        row, score, first = np.repeat(row, many), np.repeat(score, many), np.repeat(begin[node], many)
        vid = ids[first + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)]
        ok = vid != part_id[row]
        row, vid, score = row[ok], vid[ok], score[ok]
        by = np.lexsort([vid, -score, row])
        row, vid, score = row[by], vid[by], score[by]
        top = np.arange(len(row)) - np.searchsorted(row, row) < k
        yield pd.DataFrame({"query_id": part_id[row[top]], "vec_id": vid[top], "score": score[top]})


def valid_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector, dim) of the rows that take part: not null, not zero, all components finite."""
    odd = F.exists("vector", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
            .filter(F.col("id").isNotNull() & F.col("vector").isNotNull()).filter(~odd)
            .filter(F.exists("vector", lambda c: c != 0)).withColumn("dim", F.size("vector")))


def build_index(vectors: DataFrame, shards: int, degree: int = DEGREE, beam: int = BEAM) -> DataFrame:
    """(shard, dim, payload): one graph per shard and vector length, in the shared folder."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "dim": [int(pdf["dim"].iloc[0])],
                             "payload": [_pack(pdf, degree, beam)]})
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    return checkpoint_table(dealt.groupBy("shard", "dim").applyInPandas(build, "shard int, dim int, payload binary"), "ann")


def nearest(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
            degree: int = DEGREE, beam: int = BEAM, shards: int | None = None) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` found with the largest
    inner product (double) for every query, ties to the smaller id; all of them
    if there are fewer. The query's own id is never among them.

    Vectors that are null, zero or hold null or non-finite components take no
    part on either side. Only vectors of the query's length are candidates. Of
    rows with the same id the smallest vector counts. Equal vectors are one
    point of the graph with all their ids. Empty tables give an empty result.

    A shard holds ``SHARD_ROWS`` rows and ``SHARD_VALUES`` components at most on
    average, and a task one shard and ``QUERY_BLOCK`` queries. Every query asks
    every shard: with queries a fixed share of the rows the work grows with the
    square of the rows.
    """
    v, q = valid_vectors(vectors, id_col, vector_col), valid_vectors(queries, id_col, vector_col)
    q = q.groupBy("id").agg(F.min(F.struct("vector", "dim")).alias("s")).select("id", "s.vector", "s.dim")
    if shards is None:
        rows, values = v.agg(F.count(F.lit(1)), F.coalesce(F.sum("dim"), F.lit(0))).first()
        shards = max(MIN_SHARDS, -(-rows // SHARD_ROWS), -(-values // SHARD_VALUES))
    blocks = max(1, -(-q.count() // QUERY_BLOCK))
    index = build_index(v, shards, degree, beam).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = (q.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"),
                                 "score": pd.Series(dtype="float64")})
        index = pickle.loads(right["payload"].iloc[0])
        return pd.concat(_ask(index, left["id"].to_numpy(), np.array(left["vector"].tolist(), dtype=np.float64), k, beam),
                         ignore_index=True)

    key = ["shard", "dim", "block"]
    found = asked.groupBy(*key).cogroup(index.groupBy(*key)).applyInPandas(
        search, "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
