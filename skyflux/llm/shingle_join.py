"""Exact n-gram Jaccard join by a count-vector R-tree.

A document's set holds the 64-bit hashes of its distinct word shingles. Two
sets link when 100 * |A n B| >= 75 * |A u B|, that is 7 |A n B| >= 3 (|A| + |B|).

The hashes are dealt to G groups; the number of a document's shingles in each
group is a point, and |A n B| is at most the sum over groups of the smaller
count. R-tree nodes hold the largest count per group and the smallest size, so
a node whose bound misses 3/7 (|A| + smallest size) is skipped with all below
it; pairs that survive at the points are verified on the sets.

1. Equal sets form one class; only its smallest id goes on.
2. Sets that cannot link are left out. All sets are ordered by hash; in that
   order the first k common members of a linked pair lie in the first
   n - ceil(3n/4) + k of both. So a set has to share enough members of this
   prefix with another set of a linkable size (`_prefix`, `_needed`). Prefix
   members are shuffled packed, by hash range; a member that two sets of one
   batch share is settled there and travels once, so a passage found in a third
   of all texts is one row per batch.
3. The rest is dealt to tiles: size class (steps of 4/3) and smallest hash. A
   tile above TILE_ROWS or TILE_BYTES, such as a group of near copies with one
   smallest hash, is split: documents that link to one of a few pivots are
   connected by these links, so they form hub tiles that are never joined with
   each other; what is still too large is dealt by hash. A document goes to the tile pairs that its bound
   against the other tile's largest counts admits; every pair of tiles is one
   bounded group with an R-tree, joined by probing.
4. Within a group a pair that is already connected is not verified again: a
   group returns a spanning forest of its links, which has the components of
   all of them. Components of the forests are found by alternating stars.
"""

from __future__ import annotations

import itertools
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyflux.llm.common import by_chars, chain, checkpoint_table, claim, lean, mix64, shuffle_partitions, small_side, word_hashes, words

WIDTH = 5
GROUPS = 64
TILE_ROWS = 4096
TILE_BYTES = 16_000_000
BUCKET_BYTES = 16_000_000   # prefix members (18 bytes each) that one group counts
PIVOTS, PIVOT_TURNS = 8, 3
_LEAF, _FAN = 16, 16
_CHUNK = 8_000_000
_LOG = math.log(4 / 3)
_STEPS = 64            # size steps within a ratio of 4/3


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; a shorter text is one run."""
    h = word_hashes(words(text))
    if len(h) >= width:
        return np.unique(chain(h, width))
    if not len(h):
        return h
    return mix64(chain(h, len(h)) + np.uint64(len(h)))


def _slack(n):
    return np.maximum(1, n // 8)


def _prefix(n):
    """Members of the hash order that can hold the first common ones."""
    return np.where(n > 0, np.minimum(n, n - (3 * n + 3) // 4 + _slack(n)), 0)


def _needed(n):
    """Common prefix members that a link takes at least: the partner's slack is at least that of ceil(3n/4)."""
    return np.maximum(1, ((3 * n + 3) // 4) // 8)


def _size_step(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log(np.maximum(n, 1)) / _LOG * _STEPS).astype(np.uint16)


def _linkable(key: np.ndarray, step: np.ndarray) -> np.ndarray:
    """For entries sorted by (key, step): whether a neighbour of the key is within the size ratio."""
    near = (key[1:] == key[:-1]) & (step[1:].astype(np.int32) - step[:-1].astype(np.int32) <= _STEPS + 1)
    out = np.zeros(len(key), dtype=bool)
    out[1:] |= near
    out[:-1] |= near
    return out


# ------------------------------------------------------------------ 1: sets
def _sets(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("shingle_join")
        for batch in batches:
            for b in by_chars(batch, "text", _CHUNK):
                sets = [shingle_set(t.as_py(), width) for t in b.column("text")]
                n = np.array([len(s) for s in sets], dtype=np.int64)
                pre = [s[:k].tobytes() for s, k in zip(sets, _prefix(n))]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array(n), pa.array([xxhash.xxh3_128_hexdigest(s.tobytes()) for s in sets]),
                     pa.array(pre, pa.binary())], names=["id", "n", "sig", "prefix"])
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return checkpoint_table(src.mapInArrow(run, "id long, n long, sig string, prefix binary"), "shingles")


# ------------------------------------------------- 2: sets that share enough
def _buckets(sets: DataFrame) -> int:
    """Ranges of hashes so that each has about BUCKET_BYTES of prefix members, whatever the input."""
    size = sets.agg(F.sum(F.length("prefix")).alias("b")).first()["b"] or 0
    return max(shuffle_partitions(sets.sparkSession), math.ceil(size * 18 / 8 / BUCKET_BYTES))


def _shared_counts(sets: DataFrame, buckets: int) -> DataFrame:
    """(node, shared): per set (64 bits of its digest) how many prefix members it shares, at least."""
    shift = np.uint64(64 - max(1, math.ceil(math.log2(buckets))))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("shingle_join")
        for batch in batches:
            for b in by_chars(batch, "prefix", _CHUNK):
                node = np.array([int(x[:16], 16) for x in b.column("sig").to_pylist()], dtype=np.uint64)
                _, first = np.unique(node, return_index=True)          # copies within the batch count once
                parts = [np.frombuffer(b.column("prefix")[int(i)].as_py(), dtype=np.uint64) for i in first]
                lens = np.array([len(p) for p in parts], dtype=np.int64)
                if not lens.sum():
                    continue
                h = np.concatenate(parts)
                who = np.repeat(node[first], lens)
                step = np.repeat(_size_step(b.column("n").to_numpy()[first]), lens)
                by = np.lexsort([step, h])
                h, who, step = h[by], who[by], step[by]
                here = _linkable(h, step)
                found, times = np.unique(who[here], return_counts=True)
                # a settled member travels once per size step, as a witness (node 0)
                settled = np.flatnonzero(here)
                keep = np.ones(len(h), dtype=bool)
                again = settled[1:][(h[settled[1:]] == h[settled[:-1]]) & (step[settled[1:]] == step[settled[:-1]])]
                keep[again] = False
                who = np.where(here, np.uint64(0), who)
                h, who, step = h[keep], who[keep], step[keep]
                at = (h >> shift).astype(np.int64)
                cut = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1], [True]]))
                rows = [(int(at[a]), h[a:z].tobytes(), who[a:z].tobytes(), step[a:z].tobytes())
                        for a, z in zip(cut, cut[1:])]
                spread = int(found[0] % np.uint64(buckets)) if len(found) else 0
                rows.append((-1 - spread, b"", found.tobytes(), times.astype(np.uint32).tobytes()))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32())] + [pa.array(c, pa.binary()) for c in cols[1:]],
                                                 names=["bucket", "h", "who", "step"])

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        claim("shingle_join")
        who = np.frombuffer(b"".join(pdf["who"]), dtype=np.uint64)
        if pdf["bucket"].iloc[0] < 0:
            times = np.frombuffer(b"".join(pdf["step"]), dtype=np.uint32)
            node, inv = np.unique(who, return_inverse=True)
            n = np.bincount(inv, weights=times, minlength=len(node)).astype(np.int64)
        else:
            h = np.frombuffer(b"".join(pdf["h"]), dtype=np.uint64)
            step = np.frombuffer(b"".join(pdf["step"]), dtype=np.uint16)
            by = np.lexsort([who, step, h])
            h, who, step = h[by], who[by], step[by]
            one = np.ones(len(h), dtype=bool)                          # a set met in several batches counts once
            one[1:] = (h[1:] != h[:-1]) | (who[1:] != who[:-1]) | (step[1:] != step[:-1])
            h, who, step = h[one], who[one], step[one]
            node, n = np.unique(who[_linkable(h, step) & (who != 0)], return_counts=True)
        # partial counts travel packed, by the leading bits of the node
        at = (node >> shift).astype(np.int64)
        cut = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1], [True]])) if len(at) else np.zeros(1, dtype=np.int64)
        rows = [(int(at[a]), node[a:z].tobytes(), n[a:z].astype(np.int64).tobytes()) for a, z in zip(cut, cut[1:])]
        with lean():
            return pd.DataFrame(rows, columns=["part", "node", "n"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        node, inv = np.unique(np.frombuffer(b"".join(pdf["node"]), dtype=np.uint64), return_inverse=True)
        n = np.bincount(inv, weights=np.frombuffer(b"".join(pdf["n"]), dtype=np.int64), minlength=len(node))
        return pd.DataFrame({"node": node.astype(np.int64), "shared": n.astype(np.int64)})

    packed = sets.select("sig", "n", "prefix").mapInArrow(pack, "bucket int, h binary, who binary, step binary")
    parts = packed.groupBy("bucket").applyInPandas(count, "part int, node binary, n binary")
    return parts.groupBy("part").applyInPandas(add, "node long, shared long")


# ------------------------------------------------------------- 3, 4: R-tree
def _counts(s: np.ndarray, groups: int) -> np.ndarray:
    return np.bincount((s & np.uint64(groups - 1)).astype(np.int64), minlength=groups)


class CountTree:
    """R-tree over group counts. ``levels[0]`` are the points; a node of a
    higher level covers a run of ``_LEAF`` or ``_FAN`` nodes below it and holds
    their largest count per group and their smallest and largest size."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        # bulk loading: slabs of like size, then by the fullest groups, so that like documents are neighbours
        top = np.argsort(-points, axis=1, kind="stable")[:, :3] if len(points) else np.zeros((0, 3), int)
        self.order = np.lexsort([*top.T[::-1], np.floor(np.log(np.maximum(sizes, 1)) * 20)])
        pts, n = points[self.order], sizes[self.order]
        self.levels = [(pts, n, n)]
        while len(self.levels[-1][0]) > _FAN:
            hi, lo_n, hi_n = self.levels[-1]
            cuts = np.arange(0, len(hi), _LEAF if len(self.levels) == 1 else _FAN)
            self.levels.append((np.maximum.reduceat(hi, cuts), np.minimum.reduceat(lo_n, cuts), np.maximum.reduceat(hi_n, cuts)))

    def candidates(self, point: np.ndarray, size: int) -> np.ndarray:
        """Points whose overlap bound with ``point`` admits a link."""
        at = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            hi, lo_n, hi_n = self.levels[depth]
            near = at[(4 * hi_n[at] >= 3 * size) & (3 * lo_n[at] <= 4 * size)]
            bound = np.minimum(hi[near], point).sum(1)
            near = near[7 * np.minimum(bound, hi_n[near]) >= 3 * (size + lo_n[near])]
            if depth == 0 or not len(near):
                return self.order[near] if depth == 0 else near
            fan = _LEAF if depth == 1 else _FAN
            at = (near[:, None] * fan + np.arange(fan)).ravel()
            at = at[at < len(self.levels[depth - 1][0])]
        return at


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(a) + len(b) - len(np.union1d(a, b))
    return 7 * both >= 3 * (len(a) + len(b))


def _forest(ids: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, same: bool):
    """Spanning forest of the links between documents ``left`` and ``right``
    (positions); with ``same`` they are one set of documents."""
    n = np.array([len(s) for s in sets], dtype=np.int64)
    groups = GROUPS
    while groups < 4096 and groups * 8 < n.max(initial=0):
        groups *= 2
    points = np.array([_counts(s, groups) for s in sets], dtype=np.int32).reshape(len(sets), groups)
    tree = CountTree(points[right], n[right])
    comp = np.arange(len(sets))
    out = []
    for a in left:
        cand = right[tree.candidates(points[a], int(n[a]))]
        cand = cand[cand < a] if same else cand
        for b in cand[comp[cand] != comp[a]]:
            if comp[b] == comp[a]:
                continue
            if _linked(sets[a], sets[b]):
                out.append((ids[a], ids[b]))
                comp[comp == comp[b]] = comp[a]
    return out


def _first_tiles(live: DataFrame) -> DataFrame | None:
    """(id, set, tile): tiles by size class and smallest hash; none without rows."""
    classes = live.groupBy(F.floor(F.log("n") / _LOG).cast("int").alias("c")).agg(
        F.count("*").alias("rows"), F.sum(F.col("n") * 8).alias("bytes")).collect()      # size classes: under 100
    parts = {r["c"]: max(1, -(-r["rows"] // TILE_ROWS), -(-r["bytes"] // TILE_BYTES)) for r in classes}
    if not parts:
        return None
    n_of = F.create_map(*[F.lit(x) for kv in parts.items() for x in kv])
    first = F.conv(F.hex(F.reverse(F.substring("set", 1, 8))), 16, 10).cast("decimal(20,0)")
    tile = F.col("c").cast("long") * 2 ** 32 + F.pmod(F.xxhash64(first), F.element_at(n_of, F.col("c")))
    return live.withColumn("c", F.floor(F.log("n") / _LOG).cast("int")).select("id", "set", tile.alias("tile"))


def _by_pivots(tiled: DataFrame, tiles: list[int], turn: int, fresh: Iterator[int], hubs: dict[int, int]):
    """(tiled, links): in each of ``tiles`` the documents that link to a pivot
    move to a hub tile; pivots with a common document share theirs."""
    spark = tiled.sparkSession
    chosen = F.broadcast(spark.createDataFrame([(t,) for t in tiles], "tile long"))
    inside, outside = tiled.join(chosen, "tile", "left_semi"), tiled.join(chosen, "tile", "left_anti")
    key = F.xxhash64("id", "set", F.lit(turn))
    picked = inside.groupBy("tile", F.pmod(key, F.lit(PIVOTS)).alias("slot")).agg(F.min_by(F.struct("id", "set"), key).alias("p"))
    pivots = defaultdict(list)
    for r in picked.select("tile", "p.id", "p.set").collect():             # PIVOTS sets per tile of over TILE_ROWS or 1,024 rows
        pivots[r["tile"]].append((r["id"], np.frombuffer(bytes(r["set"]), dtype=np.uint64)))
    top = spark.sparkContext.broadcast(dict(pivots))

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sets = [np.frombuffer(s, dtype=np.uint64) for s in pdf["set"]]
            to = [[i for i, p in top.value[t] if _linked(s, p)] for t, s in zip(pdf["tile"], sets)]
            yield pdf.assign(to=to)

    found = checkpoint_table(inside.select("id", "set", "tile").mapInPandas(near, "id long, set binary, tile long, to array<long>"), "pivot-links")
    root = {(t, i): i for t, ps in pivots.items() for i, _ in ps}

    def find(t: int, i: int) -> int:
        while root[t, i] != i:
            i = root[t, i]
        return i

    for r in found.filter(F.size("to") > 0).select("tile", "to").distinct().collect():     # 2^PIVOTS per tile at most
        for i in r["to"][1:]:
            root[r["tile"], find(r["tile"], i)] = find(r["tile"], r["to"][0])
    named = {k: next(fresh) for k in sorted({(t, find(t, i)) for t, i in root})}
    hubs.update({t: t for t in named.values()})
    moves = spark.createDataFrame([(t, i, named[t, find(t, i)]) for t, i in root], "tile long, pivot long, hub long")
    moved = (found.withColumn("pivot", F.get("to", F.lit(0))).join(F.broadcast(moves), ["tile", "pivot"], "left")
             .select("id", "set", F.coalesce("hub", "tile").alias("tile")))
    return outside.select("id", "set", "tile").unionByName(moved), found.select(F.col("id").alias("a"), F.explode("to").alias("b"))


def _bounded(tiled: DataFrame):
    """(tiled, links, hubs): (id, set, tile) with tiles of TILE_ROWS and
    TILE_BYTES at most (a single set may be larger), links already found, and
    the hub of each tile whose documents these links connect."""
    spark = tiled.sparkSession
    fresh, hubs, links = itertools.count(2 ** 45), {}, []
    for turn in itertools.count():
        rows, size = F.count("*").alias("rows"), F.sum(F.length("set")).alias("bytes")
        large = (tiled.groupBy("tile").agg(rows, size)
                 .filter((F.col("rows") > 1) & ((F.col("rows") > TILE_ROWS) | (F.col("bytes") > TILE_BYTES))).collect())
        if not large:
            return tiled, links, hubs
        times = {r["tile"]: max(r["rows"] / TILE_ROWS, r["bytes"] / TILE_BYTES) for r in large}
        mixed = [r["tile"] for r in large if turn < PIVOT_TURNS and r["tile"] not in hubs and times[r["tile"]] > 2
                 and r["rows"] >= min(1024, TILE_ROWS)]
        cut = []
        for t in sorted(set(times) - set(mixed)):
            to = [next(fresh) for _ in range(math.ceil(1.25 * times[t]))]
            cut.append((t, to[0], len(to)))
            hubs.update({x: hubs[t] for x in to if t in hubs})
        if mixed:
            tiled, more = _by_pivots(tiled, mixed, turn, fresh, hubs)
            links.append(more)
        if cut:
            cuts = F.broadcast(spark.createDataFrame(cut, "tile long, first long, parts int"))
            tiled = tiled.join(cuts, "tile", "left").select("id", "set", F.coalesce(
                F.col("first") + F.pmod(F.xxhash64("id", "set", F.lit(-1 - turn)), F.col("parts")), "tile").alias("tile"))


def _tile_links(live: DataFrame) -> DataFrame:
    """(a, b): forests of the links among ``live`` (id, n, set)."""
    spark = live.sparkSession
    tiled = _first_tiles(live)
    if tiled is None:
        return spark.createDataFrame([], "a long, b long")
    tiled, links, hubs = _bounded(tiled)

    def box(pdf: pd.DataFrame) -> pd.DataFrame:
        hi, lo_n, hi_n = np.zeros(GROUPS, dtype=np.int32), 1 << 60, 0
        for s in pdf["set"]:
            a = np.frombuffer(s, dtype=np.uint64)
            hi, lo_n, hi_n = np.maximum(hi, _counts(a, GROUPS)), min(lo_n, len(a)), max(hi_n, len(a))
        return pd.DataFrame({"tile": [int(pdf["tile"].iloc[0])], "hi": [hi.astype(np.int32).tobytes()], "lo_n": [lo_n], "hi_n": [hi_n]})

    # one box of 64 counts per tile, the tree's upper level: 300 bytes for every 4,096 live documents
    boxes = tiled.groupBy("tile").applyInPandas(box, "tile long, hi binary, lo_n long, hi_n long").orderBy("tile").collect()
    top = spark.sparkContext.broadcast((np.array([r["tile"] for r in boxes]), np.array([np.frombuffer(r["hi"], np.int32) for r in boxes]),
                                        np.array([r["lo_n"] for r in boxes]), np.array([r["hi_n"] for r in boxes]),
                                        np.array([hubs.get(r["tile"], 0) for r in boxes])))

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tiles, hi, lo_n, hi_n, hub = top.value
        for pdf in batches:
            for i in range(0, len(pdf), 256):
                rows = []
                for doc, tile, s in pdf[["id", "tile", "set"]].iloc[i:i + 256].itertuples(index=False):
                    a = np.frombuffer(s, dtype=np.uint64)
                    n = len(a)
                    own = hub[np.searchsorted(tiles, tile)]
                    near = np.flatnonzero((4 * hi_n >= 3 * n) & (3 * lo_n <= 4 * n) & ((hub == 0) | (hub != own)))   # one hub is connected
                    bound = np.minimum(np.minimum(hi[near], _counts(a, GROUPS)).sum(1), hi_n[near])
                    for t in tiles[near[(7 * bound >= 3 * (n + lo_n[near])) | (tiles[near] == tile)]]:
                        rows.append((min(t, tile), max(t, tile), t > tile, doc, s))
                yield pd.DataFrame(rows, columns=["i", "j", "is_left", "id", "set"])

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        claim("shingle_join")
        ids, sets = pdf["id"].to_numpy(), [np.frombuffer(s, dtype=np.uint64) for s in pdf["set"]]
        every, same = np.arange(len(ids)), pdf["i"].iloc[0] == pdf["j"].iloc[0]
        is_left = pdf["is_left"].to_numpy(dtype=bool)
        left, right = (every, every) if same else (every[is_left], every[~is_left])
        with lean():
            return pd.DataFrame(_forest(ids, sets, left, right, same), columns=["a", "b"], dtype="int64")

    routed = tiled.select("id", "tile", "set").mapInPandas(route, "i long, j long, is_left boolean, id long, set binary")
    found = routed.groupBy("i", "j").applyInPandas(join, "a long, b long")
    for more in links:
        found = found.unionByName(more)
    return found


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every id on an edge (a, b): root is the smallest id that it
    reaches. Alternating large and small stars; every round is written to the
    shared folder, and a hub's edges are reduced by a map-side minimum."""
    e = checkpoint_table(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("x"), "u", "m")
        small = small.select(F.col("x").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        e = checkpoint_table(small.filter("u <> v").distinct(), "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return e.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "id")
        seen = now


def shingle_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles (long), component_id.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case. ``component_id`` is
    the smallest id reachable by links, the row's own included. Null and empty
    texts, and texts without words, have no shingles and link with nothing.
    Equal sets link. Rows with the same id count as one document in links. A
    null id takes no part in links and gets a null component. An empty table
    gives an empty result; other columns are ignored.
    """
    sets = _sets(docs, id_col, text_col, width)
    heads = sets.filter("n > 0 AND id IS NOT NULL").groupBy("sig").agg(F.min("id").alias("head"), F.first("n").alias("n"))
    node = F.conv(F.substring("sig", 1, 16), 16, -10).cast("long")      # the same 64 bits, signed
    need = F.greatest(F.lit(1), F.floor(F.floor((F.col("n") * 3 + 3) / 4) / 8))
    real = sets.filter("n > 0 AND id IS NOT NULL")
    shared = _shared_counts(real, _buckets(real))
    live = checkpoint_table(heads.withColumn("node", node).join(shared, "node").filter(F.col("shared") >= need)
                            .select(F.col("head").alias("id"), "sig"), "live")

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("shingle_join")
        for batch in batches:
            for b in by_chars(batch, "text", _CHUNK):
                got = [shingle_set(t.as_py(), width) for t in b.column("text")]
                mine = [xxhash.xxh3_128_hexdigest(s.tobytes()) == x for s, x in zip(got, b.column("sig").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").filter(pa.array(mine)), pa.array([len(s) for s, m in zip(got, mine) if m], pa.int64()),
                     pa.array([s.tobytes() for s, m in zip(got, mine) if m], pa.binary())], names=["id", "n", "set"])

    text = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    text = text.join(small_side(live), "id")
    full = checkpoint_table(text.mapInArrow(again, "id long, n long, set binary").dropDuplicates(["id", "set"]), "live-sets")
    # a document with several texts belongs to the classes of all of them
    several = real.groupBy("id").agg(F.min("sig").alias("lo"), F.max("sig").alias("hi")).filter("lo <> hi").select("id")
    shared = real.join(several, "id", "left_semi").select("id", "sig").join(heads.select("sig", "head"), "sig").select(
        F.col("id").alias("a"), F.col("head").alias("b"))
    roots = components(_tile_links(full).unionByName(shared))
    of = heads.join(roots.withColumnRenamed("id", "head"), "head", "left").select(
        "sig", F.coalesce("root", "head").alias("component_id"))
    whole = sets.select("id", "n", F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("sig")).alias("sig")).join(of, "sig", "left")
    return whole.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))
