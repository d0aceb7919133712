"""Nested sky pixels: a quad tree on the sphere for JOIN13 and JOIN15.

The sphere is the rectangle of right ascension and sin(declination), on which
areas are true. Order k cuts it into 2^k x 2^k pixels of equal area; a pixel's
id interleaves the bits of its row and column, so that its four children have
the ids 4p .. 4p + 3, and a pixel of any order is one range of ids of ORDER.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyflux.operators.ordered import running_sum
from skyflux.operators.sky import angular_separation

#: The finest order: 2^24 steps in right ascension are 0.08 arcsec.
ORDER = 24
#: Id ranges that a cone's cover may have.
MAX_RANGES = 64


def _spread(x: Column) -> Column:
    """Bits of a number below 2^32 moved apart: bit k goes to bit 2k."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def pixel(ra: Column | str, dec: Column | str, order: int = ORDER) -> Column:
    """Nested pixel of a position in degrees; right ascension may be of any turn.
    Null or NaN coordinates, and declinations beyond the poles, have none."""
    ra, dec = (F.col(c) if isinstance(c, str) else c for c in (ra, dec))
    n = 1 << order
    col = F.least(F.floor(F.pmod(ra, F.lit(360.0)) / 360.0 * n), F.lit(n - 1)).cast("long")
    row = F.least(F.floor((F.sin(F.radians(dec)) + 1) / 2 * n), F.lit(n - 1)).cast("long")
    ok = ra.isNotNull() & (F.abs(dec) <= 90) & ~F.isnan(ra) & ~F.isnan(dec)
    return F.when(ok, _spread(col).bitwiseOR(F.shiftleft(_spread(row), 1)))


def parent(pix: Column | str, order: int, finest: int = ORDER) -> Column:
    """The pixel of ``order`` that holds a pixel of order ``finest``."""
    return F.shiftright(pix, 2 * (finest - order))


def _interleave(col: int, row: int, order: int) -> int:
    return sum(((col >> k & 1) << 2 * k) | ((row >> k & 1) << 2 * k + 1) for k in range(order))


def cone_cover(ra0: float, dec0: float, radius_deg: float, max_ranges: int = MAX_RANGES) -> list[tuple[int, int]]:
    """Ranges [lo, hi) of ids of ORDER that hold every position within
    ``radius_deg`` of (ra0, dec0): the tree is descended where a pixel is
    neither outside nor inside the cone's bounding box, as long as the ranges
    stay few. Boxes wrap at 0/360 and take all right ascensions at a pole."""
    pad = 1e-9 + radius_deg * 1e-12
    r = min(max(radius_deg, 0.0) + pad, 180.0)
    lo, hi = max(dec0 - r, -90.0), min(dec0 + r, 90.0)
    s_lo, s_hi = (math.sin(math.radians(x)) for x in (lo, hi))
    y = (max((s_lo + 1) / 2 - 1e-14, 0.0), min((s_hi + 1) / 2 + 1e-14, 1.0))
    if lo <= -90.0 or hi >= 90.0 or math.sin(math.radians(r)) >= math.cos(math.radians(dec0)):
        xs = [(0.0, 1.0)]
    else:
        width = math.degrees(math.asin(math.sin(math.radians(r)) / math.cos(math.radians(dec0)))) / 360.0 + 1e-12
        x = (ra0 % 360.0) / 360.0
        xs = [(max(a, 0.0), min(b, 1.0)) for a, b in ((x - width, x + width), (x - width - 1, x + width - 1), (x - width + 1, x + width + 1))
              if b >= 0.0 and a <= 1.0]
    done, open_, order = [], [(0, 0)], 0
    while open_:
        n, below = 1 << order, []
        for col, row in open_:
            box = (col / n, (col + 1) / n, row / n, (row + 1) / n)
            parts = [(a, b) for a, b in xs if box[0] <= b and box[1] >= a]
            if not parts or box[2] > y[1] or box[3] < y[0]:
                continue
            inside = any(a <= box[0] and box[1] <= b for a, b in parts) and y[0] <= box[2] and box[3] <= y[1]
            if inside or order == ORDER:
                done.append((_interleave(col, row, order), order))
            else:
                below.append((col, row))
        if len(done) + len(below) > max_ranges // 4 or order == ORDER:
            done += [(_interleave(col, row, order), order) for col, row in below]
            break
        open_, order = [(2 * col + i, 2 * row + j) for col, row in below for i in (0, 1) for j in (0, 1)], order + 1
    out: list[tuple[int, int]] = []
    for a, b in sorted((p << 2 * (ORDER - k), (p + 1) << 2 * (ORDER - k)) for p, k in done):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def in_ranges(pix: Column | str, ranges: list[tuple[int, int]]) -> Column:
    """Whether a pixel lies in one of the ranges, as comparisons that a scan takes."""
    pix = F.col(pix) if isinstance(pix, str) else pix
    keep = None
    for lo, hi in ranges:
        one = (pix >= F.lit(lo)) & (pix < F.lit(hi))
        keep = one if keep is None else keep | one
    return F.lit(False) if keep is None else keep


def with_pixel(df: DataFrame, ra: str = "ra", dec: str = "decl", name: str = "pix") -> DataFrame:
    return df.withColumn(name, pixel(ra, dec))


def sort_by_pixel(df: DataFrame, ra: str = "ra", dec: str = "decl", name: str = "pix", partitions: int | None = None) -> DataFrame:
    """Storage layout for cone searches: pixel column, range-partitioned and
    sorted by it. Neighbours on the sky are neighbours in the files, so the
    statistics of files and row groups prune both coordinates."""
    out = with_pixel(df, ra, dec, name)
    out = out.repartitionByRange(partitions, name) if partitions else out.repartitionByRange(name)
    return out.sortWithinPartitions(name)


def cone_search(df: DataFrame, ra0: float, dec0: float, radius_deg: float, ra: str = "ra", dec: str = "decl",
                pix: str = "pix", name: str = "sep_deg", max_ranges: int = MAX_RANGES) -> DataFrame:
    """JOIN13 on a table with nested pixels: rows within ``radius_deg`` of
    (ra0, dec0). The cone's cover is a few id ranges that reach the scan; the
    exact distance test follows. Rows without a position match nothing."""
    near = df.filter(in_ranges(pix, cone_cover(ra0, dec0, radius_deg, max_ranges)))
    sep = angular_separation(F.lit(float(ra0)), F.lit(float(dec0)), F.col(ra), F.col(dec))
    return near.withColumn(name, sep).filter(F.col(name) <= radius_deg)


def crossmatch_multiorder(objects: DataFrame, maps: DataFrame, credible: float = 0.9, pix: str = "pix", map_id: str = "map_id",
                          order: str = "order", map_pix: str = "map_pix", prob: str = "prob") -> DataFrame:
    """JOIN15 for multi-resolution sky maps: ``maps`` holds nested pixels of
    mixed orders (``order``, ``map_pix`` of that order, ``prob``), disjoint
    within a map; ``objects`` a pixel of ORDER. Every object meets the pixels
    that hold it within the ``credible`` region of a map (densest pixels first
    until that probability is reached): its columns, map_id, order, map_pix,
    density (per steradian) and searched_prob.

    An object is looked up once per order that occurs in the maps, by an
    equi-join on (order, pixel), so nothing outside a region is paired and no
    range is expanded. Pixels with a null, or without an object, pair with
    nothing."""
    area = F.lit(4 * math.pi) / F.pow(F.lit(4.0), F.col(order))
    px = maps.select(map_id, order, map_pix, prob).dropna().withColumn("density", F.col(prob) / area)
    ranked = running_sum(px, [map_id], ["density", order, map_pix], prob, "searched_prob", descending=True)
    region = ranked.filter(F.col("searched_prob") - F.col(prob) < credible).select(map_id, order, map_pix, "density", "searched_prob")
    orders = sorted(r[0] for r in maps.select(order).filter(F.col(order).isNotNull()).distinct().collect())      # 0 to ORDER: 25 at most
    orders = orders or [0]
    at = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), parent(F.col(pix), k).alias("p")) for k in orders]))
    asked = objects.filter(F.col(pix).isNotNull()).withColumn("__at", at)
    hit = asked.join(region, (F.col("__at.k") == F.col(order)) & (F.col("__at.p") == F.col(map_pix)))
    return hit.drop("__at")
