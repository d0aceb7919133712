"""Near duplicates by MinHash bands and odd sketches.

1. A document's set holds the 64-bit hashes of its distinct word shingles. Its
   SAMPLES MinHash values are cut into bands of ROWS_PER_BAND; two documents
   with one equal band are candidates (sets of similarity 0.8 miss each other
   with probability (1 - 0.8^4)^32 = 5e-8).
2. The samples are also folded into an odd sketch: (place, value) flips one of
   BITS bits, so that equal samples cancel in the XOR of two sketches. With m
   differing entries the expected number of ones is BITS / 2 (1 - (1 - 2 /
   BITS)^m), which is steep for high similarities. Candidates with more ones
   than five standard deviations above those of the threshold are dropped.
3. What is left is confirmed on the full sets.

Equal sets form one class beforehand. Two turns keep large groups linear:

* every member of a bucket (one value of one band) is compared with the
  bucket's smallest id; of those that its sketch admits it takes the smallest,
  and these pairs, one per document at most, are confirmed first;
* within buckets that still hold documents of different components, all members
  are compared, in blocks of up to 1,024 documents ordered by component; pairs
  of blocks within one component are skipped. A pair is handled in the first
  band that both share. What the sketches admit travels as one row per pair of
  blocks and is confirmed there, where the sets meet; pairs of components that
  are already joined are not confirmed again, so that a pair of blocks returns
  a spanning forest.

So no link between candidates is lost, whatever the size of a bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyflux.llm.common import MULT, by_chars, chain, checkpoint_table, claim, mix64, word_hashes, words
from skyflux.llm.shingle_join import components

WIDTH = 4
SIMILARITY = (80, 100)
BANDS, ROWS_PER_BAND = 32, 4
SAMPLES = BANDS * ROWS_PER_BAND
BITS = 512
BLOCK_BITS = 10                       # blocks of 1,024 documents, of sets above LARGE of 16
LARGE, LARGE_BITS = 8192, 6
DEVIATIONS = 5
_CHUNK = 8_000_000
_STEP = 512                           # shingles hashed at a time
_PART = 1024                          # partners that share one copy of a set


def _seeds() -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(1, 2 * SAMPLES + 1, dtype=np.uint64)
    h = mix64(mix64(at * MULT) + at)
    return h[:SAMPLES, None], h[SAMPLES:, None] | np.uint64(1)


_XOR, _ODD = _seeds()
_PLACE = np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32)


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; a shorter text is one run."""
    h = word_hashes(words(text))
    if len(h) >= width:
        return np.unique(chain(h, width))
    return mix64(chain(h, len(h)) + np.uint64(len(h))) if len(h) else h


def min_hashes(s: np.ndarray) -> np.ndarray:
    """The SAMPLES smallest values of a set, one for each hash function."""
    out = np.full(SAMPLES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for a in range(0, len(s), _STEP):
        h = (s[None, a:a + _STEP] ^ _XOR) * _ODD
        h ^= h >> np.uint64(32)
        np.minimum(out, (h * _ODD).min(1), out=out)
    return out


def odd_sketch(mins: np.ndarray) -> np.ndarray:
    """Parity bitmap, as 64-bit words, of the (place, value) entries of a MinHash sample."""
    at = mix64(mix64(mins) ^ _PLACE) % np.uint64(BITS)
    return np.packbits((np.bincount(at.astype(np.int64), minlength=BITS) & 1).astype(np.uint8)).view(np.int64)


def band_keys(mins: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; the band is part of it."""
    return mix64(chain_rows(mins.reshape(BANDS, ROWS_PER_BAND)) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def chain_rows(rows: np.ndarray) -> np.ndarray:
    h = rows[:, 0].copy()
    for i in range(1, rows.shape[1]):
        h = h * MULT + rows[:, i]
    return mix64(h)


def most_ones(similarity: float, samples: int = SAMPLES, bits: int = BITS, deviations: float = DEVIATIONS) -> int:
    """Ones in the XOR of two sketches up to which a pair of at least ``similarity`` is kept."""
    shrink = 1 - 2 / bits
    differ = samples * (1 - similarity)                       # samples that differ; each flips two entries
    mean = bits / 2 * (1 - shrink ** (2 * differ))
    slope = -bits * math.log(shrink) * shrink ** (2 * differ)
    spread = slope ** 2 * samples * similarity * (1 - similarity)
    parity = bits / 4 * (1 - shrink ** (4 * differ)) + bits * (bits - 1) / 4 * ((1 - 4 / bits) ** (2 * differ) - shrink ** (4 * differ))
    return min(bits, math.ceil(mean + deviations * math.sqrt(spread + max(parity, 0))))


def estimate(ones: int, samples: int = SAMPLES, bits: int = BITS) -> float:
    """Similarity that the number of ones stands for."""
    left = max(1 - 2 * ones / bits, 1 / bits)
    return max(0.0, 1 - math.log(left) / math.log(1 - 2 / bits) / (2 * samples))


# --------------------------------------------------------------- 1: sketches
def _sketches(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, n, sig, bands, sketch) of every row; no bands without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("odd_sketch")
        for batch in batches:
            for b in by_chars(batch, "text", _CHUNK):
                cols = []
                for t in b.column("text"):
                    s = shingle_set(t.as_py(), width)
                    mins = min_hashes(s) if len(s) else None
                    cols.append((len(s), xxhash.xxh3_128_digest(s.tobytes()), [] if mins is None else band_keys(mins).tolist(),
                                 [] if mins is None else odd_sketch(mins).tolist()))
                n, sig, bands, sketch = zip(*cols) if cols else ((), (), (), ())
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n, pa.int64()), pa.array(sig, pa.binary()),
                                                  pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.list_(pa.int64()))],
                                                 names=["id", "n", "sig", "bands", "sketch"])
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return checkpoint_table(src.mapInArrow(run, "id long, n long, sig binary, bands array<long>, sketch array<long>"), "odd-sketches")


def _ones(a, b):
    """Ones of the XOR of two sketches, in the engine."""
    total = F.lit(0)
    for i in range(BITS // 64):
        total = total + F.bit_count(a[i].bitwiseXOR(b[i]))
    return total


# ------------------------------------------------------ 2: pairs to confirm
def _leader_pairs(heads: DataFrame, cut: int) -> tuple[DataFrame, DataFrame]:
    """(pairs, members): the smallest bucket leader that each class's sketch
    admits, as (a, b) signatures; and (key, sig) of all buckets with company."""
    each = heads.select("sig", F.explode("bands").alias("key"))
    lead = (heads.select("sig", "id", F.explode("bands").alias("key")).groupBy("key")
            .agg(F.count("*").alias("size"), F.min(F.struct("id", "sig")).alias("lead")).filter("size > 1"))
    members = checkpoint_table(each.join(lead.select("key", F.col("lead.sig").alias("lead")), "key"), "bucket-members")
    near = members.filter("sig <> lead").select("sig", "lead").distinct()
    near = near.join(heads.select("sig", F.col("sketch").alias("mine")), "sig")
    near = near.join(heads.select(F.col("sig").alias("lead"), F.col("id").alias("lead_id"), "sketch"), "lead")
    pairs = (near.filter(_ones(F.col("mine"), F.col("sketch")) <= cut).groupBy(F.col("sig").alias("a"))
             .agg(F.min(F.struct("lead_id", "lead")).alias("lead")).select("a", F.col("lead.lead").alias("b")))
    return pairs, members.select("key", "sig")


def _blocks(members: DataFrame, heads: DataFrame, block_bits: int) -> DataFrame:
    """(key, block, docs, lo, hi): the members of buckets that hold several
    components (``root`` of ``heads``), in blocks; ``lo`` and ``hi`` bound the roots."""
    rows = members.join(heads.select("sig", "n", "sketch", "bands", "root"), "sig")
    mixed = rows.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("key")
    # a document's place in the order (key, component), numbered from each partition's start
    rows = rows.join(mixed, "key", "left_semi").repartitionByRange("key", "root", "sig").sortWithinPartitions("key", "root", "sig")
    pos, small, large = F.monotonically_increasing_id(), block_bits, max(0, block_bits - LARGE_BITS)
    block = F.when(F.col("n") > LARGE, F.shiftright(pos, large) * 2 + 1).otherwise(F.shiftright(pos, small) * 2)
    rows = rows.select("key", block.alias("block"), "sig", "root", "sketch", "bands")
    return checkpoint_table(rows.groupBy("key", "block").agg(F.collect_list(F.struct("sig", "root", "sketch", "bands")).alias("docs"),
                                                             F.min("root").alias("lo"), F.max("root").alias("hi")), "sketch-blocks")


def _block_pairs(blocks: DataFrame, cut: int) -> DataFrame:
    """(key, i, j, left, right): per pair of blocks the places of the pairs of
    documents of different components that the sketches admit."""
    a = blocks.select("key", F.col("block").alias("i"), F.col("docs").alias("left"), F.col("lo").alias("lo_i"), F.col("hi").alias("hi_i"))
    b = blocks.select("key", F.col("block").alias("j"), F.col("docs").alias("right"), "lo", "hi")
    one = (F.col("lo_i") == F.col("hi_i")) & (F.col("lo") == F.col("hi")) & (F.col("lo") == F.col("lo_i"))
    both = a.join(b, "key").filter((F.col("i") <= F.col("j")) & ~one).select("key", "i", "j", "left", "right")

    def unpack(cell):
        docs = cell.values
        n = len(docs)
        sketch = docs.field("sketch").flatten().to_numpy().view(np.uint64).reshape(n, BITS // 64)
        return docs.field("root").to_numpy(), sketch, docs.field("bands").flatten().to_numpy().reshape(n, BANDS)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("odd_sketch")
        for batch in batches:
            rows = []
            for key, i, j, left, right in zip(*(batch.column(c) for c in ("key", "i", "j", "left", "right"))):
                key, i, j = key.as_py(), i.as_py(), j.as_py()
                (ra, xa, ba), (rb, xb, bb) = unpack(left), unpack(right)
                at, to = [], []
                for k in range(len(ra)):
                    near = ra[k] != rb
                    if i == j:
                        near[:k + 1] = False
                    near = np.flatnonzero(near)
                    near = near[np.bitwise_count(xb[near] ^ xa[k]).sum(1) <= cut]
                    if len(near):                             # only in the first band that both share
                        near = near[ba[k][(bb[near] == ba[k]).argmax(1)] == key]
                        at.append(np.full(len(near), k, dtype=np.uint16))
                        to.append(near.astype(np.uint16))
                if sum(map(len, to)):
                    rows.append((key, i, j, np.concatenate(at).tobytes(), np.concatenate(to).tobytes()))
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 3 + [pa.binary()] * 2)],
                                             names=["key", "i", "j", "left", "right"])

    return both.mapInArrow(compare, "key long, i long, j long, left binary, right binary")


def _block_members(found: DataFrame, blocks: DataFrame) -> DataFrame:
    """(key, block, at, sig, root) of the documents on any pair of ``found``."""
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, cells in (("i", "left"), ("j", "right")):
                for key, b, cell in zip(batch.column("key"), batch.column(block), batch.column(cells)):
                    at = np.unique(np.frombuffer(cell.as_buffer(), dtype=np.uint16)).astype(np.int32)
                    n = len(at)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, key.as_py())), pa.array(np.full(n, b.as_py())), pa.array(at)],
                                                     names=["key", "block", "at"])
    used = (found.mapInArrow(places, "key long, block long, at int").groupBy("key", "block").agg(F.collect_set("at").alias("used"))
            .join(blocks.select("key", "block", "docs"), ["key", "block"]))
    each = F.transform("used", lambda k: F.struct(k.alias("at"), F.col("docs")[k]["sig"].alias("sig"), F.col("docs")[k]["root"].alias("root")))
    return used.select("key", "block", F.inline(each))


def _block_links(found: DataFrame, placed: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): roots joined by a pair of ``found`` whose full sets are similar
    enough; a spanning forest per pair of blocks."""
    packed = placed.join(sets, "sig").groupBy("key", "block").agg(F.collect_list(F.struct("at", "root", "set")).alias("docs"))
    both = (found.join(packed.withColumnRenamed("block", "i").withColumnRenamed("docs", "docs_i"), ["key", "i"])
            .join(packed.withColumnRenamed("block", "j").withColumnRenamed("docs", "docs_j"), ["key", "j"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("odd_sketch")
        for batch in batches:
            out = []
            for left, right, a, b in zip(*(batch.column(c) for c in ("left", "right", "docs_i", "docs_j"))):
                sides = []
                for cell in (a, b):
                    docs = cell.values
                    sides.append({k: (r, np.frombuffer(x.as_buffer(), dtype=np.uint64))
                                  for k, r, x in zip(docs.field("at").to_pylist(), docs.field("root").to_pylist(), docs.field("set"))})
                up: dict[int, int] = {}

                def find(x):
                    while up.get(x, x) != x:
                        x = up[x]
                    return x
                for k, m in zip(np.frombuffer(left.as_buffer(), dtype=np.uint16).tolist(), np.frombuffer(right.as_buffer(), dtype=np.uint16).tolist()):
                    (rx, x), (ry, y) = sides[0][k], sides[1][m]
                    fx, fy = find(rx), find(ry)
                    if fx != fy and _similar(x, y):
                        out.append((rx, ry))
                        up[max(fx, fy)] = min(fx, fy)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])
    return both.select("left", "right", "docs_i", "docs_j").mapInArrow(run, "a long, b long")


# ------------------------------------------------------------- 3: full sets
def _sets(docs: DataFrame, live: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(sig, set) of the classes ``live`` (id, sig), made from the texts once more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("odd_sketch")
        for batch in batches:
            for b in by_chars(batch, "text", _CHUNK):
                got = [shingle_set(t.as_py(), width).tobytes() for t in b.column("text")]
                mine = [(s, g) for s, g in zip(b.column("sig").to_pylist(), got) if xxhash.xxh3_128_digest(g) == s]
                yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in mine], pa.binary()), pa.array([g for _, g in mine], pa.binary())],
                                                 names=["sig", "set"])
    text = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return text.join(live, "id").select("sig", "text").mapInArrow(run, "sig binary, set binary").dropDuplicates(["sig"])


def _similar(x: np.ndarray, y: np.ndarray) -> bool:
    need, of = SIMILARITY
    both = np.sort(np.concatenate([x, y]), kind="stable")     # two sorted runs are merged
    common = int((both[1:] == both[:-1]).sum())
    return of * common >= need * (len(both) - common)


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full sets are similar enough. A set with many partners is
    sent once for every _PART of them."""
    times = pairs.groupBy("b").agg(F.ceil(F.count("*") / _PART).cast("int").alias("parts"))
    spread = F.pmod(F.xxhash64("a"), F.col("parts")).cast("int")
    left = pairs.join(times, "b").select("a", "b", spread.alias("part")).join(sets.withColumnRenamed("sig", "a").withColumnRenamed("set", "x"), "a")
    right = (sets.withColumnRenamed("sig", "b").withColumnRenamed("set", "y").join(times, "b")
             .select("b", "y", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("odd_sketch")
        for batch in batches:
            keep = pa.array([_similar(*(np.frombuffer(c.as_buffer(), dtype=np.uint64) for c in pair))
                             for pair in zip(batch.column("x"), batch.column("y"))], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])
    return left.join(right, ["b", "part"]).select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")


def _edges(links: DataFrame, heads: DataFrame) -> DataFrame:
    ids = heads.select("sig", "id")
    return (links.join(ids.withColumnRenamed("sig", "a").withColumnRenamed("id", "u"), "a")
            .join(ids.withColumnRenamed("sig", "b").withColumnRenamed("id", "v"), "b").select(F.col("u").alias("a"), F.col("v").alias("b")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, block_bits: int = BLOCK_BITS) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles (long), component_id, kept.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; a set holds the
    distinct runs of ``width`` words, of a shorter text the whole sequence. Sets
    link when 100 times their intersection is at least 80 times their union.
    ``component_id`` is the smallest id reachable by links, the row's own
    included; the row of that id is ``kept``. Null and empty texts, and texts
    without words, have no shingles and link with nothing. Equal sets link. Rows
    with the same id are one document in links, whatever their texts. A null id
    takes no part, gets a null component and is kept. An empty table gives an
    empty result; other columns are ignored.
    """
    rows = _sketches(docs, id_col, text_col, width)
    real = rows.filter("n > 0 AND id IS NOT NULL")
    heads = checkpoint_table(real.groupBy("sig").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.min_by("bands", "id").alias("bands"),
                                                     F.min_by("sketch", "id").alias("sketch")), "heads")
    cut = most_ones(SIMILARITY[0] / SIMILARITY[1])
    pairs, members = _leader_pairs(heads, cut)
    pairs = checkpoint_table(pairs, "leader-pairs")
    live = pairs.select(F.col("a").alias("sig")).union(pairs.select(F.col("b").alias("sig"))).distinct().join(heads.select("sig", "id"), "sig")
    sets = checkpoint_table(_sets(docs, live, id_col, text_col, width), "live-sets")
    # a document with several texts belongs to the classes of all of them
    several = real.groupBy("id").agg(F.min("sig").alias("lo"), F.max("sig").alias("hi")).filter("lo <> hi").select("id")
    shared = (real.join(several, "id", "left_semi").select("id", "sig").join(heads.select("sig", F.col("id").alias("b")), "sig")
              .select(F.col("id").alias("a"), "b"))
    edges = checkpoint_table(_edges(_confirmed(pairs, sets), heads).unionByName(shared), "links")
    comp = checkpoint_table(components(edges), "first-components")
    heads = heads.join(comp, "id", "left").withColumn("root", F.coalesce("root", "id"))
    blocks = _blocks(members, heads, block_bits)
    found = checkpoint_table(_block_pairs(blocks, cut), "block-pairs")
    if not found.isEmpty():
        placed = checkpoint_table(_block_members(found, blocks), "block-members")
        rest = placed.select("sig").distinct().join(sets.select("sig"), "sig", "left_anti").join(heads.select("sig", "id"), "sig")
        every = sets.unionByName(_sets(docs, rest, id_col, text_col, width))
        joined = components(_block_links(found, placed, every)).select(F.col("id").alias("root"), F.col("root").alias("least"))
        heads = heads.join(joined, "root", "left").withColumn("root", F.coalesce("least", "root"))
    of = heads.select("sig", F.col("root").alias("component_id"))
    whole = rows.select("id", "n", F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("sig")).alias("sig")).join(of, "sig", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return whole.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
