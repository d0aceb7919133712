"""Sky-position operators: cone search, positional association, sky-map
crossmatch (JOIN13, JOIN14, JOIN15)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyflux.operators.intervals import interval_join
from skyflux.operators.ordered import running_sum


def angular_separation(ra1, dec1, ra2, dec2) -> Column:
    """Great-circle distance in degrees (haversine form, stable at small angles)."""
    def _c(c):
        return c if isinstance(c, Column) else (F.col(c) if isinstance(c, str) else F.lit(c))
    r1, d1, r2, d2 = (F.radians(_c(c)) for c in (ra1, dec1, ra2, dec2))
    h = F.pow(F.sin((d2 - d1) / 2), 2) + F.cos(d1) * F.cos(d2) * F.pow(F.sin((r2 - r1) / 2), 2)
    return F.degrees(2 * F.asin(F.sqrt(F.least(F.lit(1.0), h))))


def cone_search(df: DataFrame, ra0: float, dec0: float, radius_deg: float, ra: str = "ra",
                dec: str = "decl", name: str = "sep_deg") -> DataFrame:
    """JOIN13: rows within ``radius_deg`` of (ra0, dec0). The declination band
    is a plain range filter (reaches the Parquet scan); the exact test follows."""
    band = df.filter((F.col(dec) >= dec0 - radius_deg) & (F.col(dec) <= dec0 + radius_deg))
    sep = angular_separation(F.lit(ra0), F.lit(dec0), F.col(ra), F.col(dec))
    return band.withColumn(name, sep).filter(F.col(name) <= radius_deg)


def sort_by_declination(df: DataFrame, dec: str = "decl", partitions: int | None = None) -> DataFrame:
    """Storage layout for cone searches: range-partitioned and sorted by
    declination, so Parquet row-group statistics prune declination bands."""
    r = df.repartitionByRange(partitions, dec) if partitions else df.repartitionByRange(dec)
    return r.sortWithinPartitions(dec)


def _n_ra(band: Column, h: float) -> Column:
    lo = F.lit(-90.0) + band.cast("double") * h
    hi = lo + h
    maxabs = F.least(F.greatest(F.abs(lo), F.abs(hi)), F.lit(90.0))
    return F.greatest(F.lit(1), F.floor(F.lit(360.0) * F.cos(F.radians(maxabs)) / h).cast("int"))


def sky_cell(ra: Column, dec: Column, h: float) -> tuple[Column, Column]:
    """(declination band, RA bin) of a position on a grid of cell size ``h``
    degrees whose RA bins widen with declination (equal physical width >= h)."""
    nb = int(math.ceil(180.0 / h))
    band = F.least(F.floor((dec + 90.0) / h).cast("int"), F.lit(nb - 1))
    n = _n_ra(band, h)
    rabin = F.least(F.floor(F.pmod(ra, F.lit(360.0)) / (F.lit(360.0) / n)).cast("int"), n - 1)
    return band, rabin


def neighbour_cells(ra: Column, dec: Column, radius_deg: float, h: float) -> Column:
    """Array of (band, rabin) cells that may hold a position within
    ``radius_deg`` of (ra, dec), wrapping at RA 0/360 and covering the poles."""
    nb = int(math.ceil(180.0 / h))
    b, _ = sky_cell(ra, dec, h)
    dra = F.least(F.lit(180.0),
                  F.lit(radius_deg) / F.cos(F.radians(F.least(F.abs(dec) + radius_deg, F.lit(89.999999)))))
    parts = []
    for db in (-1, 0, 1):
        band = b + db
        n = _n_ra(band, h)
        w = F.lit(360.0) / n
        lo = F.floor((ra - dra) / w).cast("int")
        hi = F.floor((ra + dra) / w).cast("int")
        bins = F.when(hi - lo + 1 >= n, F.sequence(F.lit(0), n - 1)) \
            .otherwise(F.transform(F.sequence(lo, hi), lambda x: F.pmod(x, n)))
        cells = F.transform(bins, lambda x: F.struct(band.alias("band"), x.alias("rabin")))
        parts.append(F.when((band >= 0) & (band < nb), cells)
                     .otherwise(F.array().cast("array<struct<band:int,rabin:int>>")))
    return F.array_distinct(F.concat(*parts))


def associate_by_position(sources: DataFrame, objects: DataFrame, radius_arcsec: float = 1.0,
                          src_id: str = "sourceId", obj_id: str = "objectId",
                          ra: str = "ra", dec: str = "decl", cell_deg: float | None = None) -> DataFrame:
    """JOIN14: each source is assigned the nearest object within the radius
    (ties -> lowest object id); sources without one are absent.

    Objects carry their grid cell; sources are exploded to the neighbouring
    cells (at most a 3 x 3 block away from the poles); the join is an equi-join
    on the cell, the exact distance test follows, and the nearest object is
    chosen with a partial aggregation per source."""
    r = radius_arcsec / 3600.0
    h = cell_deg or max(2 * r, 1e-4)
    # copies at one position: only the lowest object id can win there, and
    # equal source positions share one answer, so both sides are reduced to
    # distinct positions first (partial aggregations) and sources rejoin at the end
    objs = objects.groupBy(F.col(ra).alias("__ora"), F.col(dec).alias("__odec")) \
        .agg(F.min(obj_id).alias("__oid"))
    ob, orb = sky_cell(F.col("__ora"), F.col("__odec"), h)
    o = objs.select("__oid", "__ora", "__odec", ob.alias("band"), orb.alias("rabin"))
    pos = sources.select(F.col(ra).alias("__sra"), F.col(dec).alias("__sdec")).distinct()
    s = pos.select("__sra", "__sdec",
                   F.explode(neighbour_cells(F.col("__sra"), F.col("__sdec"), r, h)).alias("__c"))
    s = s.select("__sra", "__sdec", F.col("__c.band").alias("band"), F.col("__c.rabin").alias("rabin"))
    pairs = s.join(o, ["band", "rabin"])
    pairs = pairs.withColumn("__sep", angular_separation("__sra", "__sdec", "__ora", "__odec")) \
        .filter(F.col("__sep") <= r)
    best = F.min(F.struct(F.col("__sep").alias("sep"), F.col("__oid").alias("oid")))
    per_pos = pairs.groupBy("__sra", "__sdec").agg(best.alias("__b"))
    src = sources.select(F.col(src_id).alias("__sid"), F.col(ra).alias("__sra"), F.col(dec).alias("__sdec"))
    return (src.join(per_pos, ["__sra", "__sdec"])
            .select(F.col("__sid").alias(src_id), F.col("__b.oid").alias(obj_id),
                    (F.col("__b.sep") * 3600.0).alias("sep_arcsec")))


def skymap_crossmatch(objects: DataFrame, pixels: DataFrame, obj_pix: str = "ipix",
                      map_id: str = "map_id", pix_lo: str = "pix_lo", pix_hi: str = "pix_hi",
                      prob: str = "prob", area: str = "area", bucket: int = 4096, credible: float | None = None,
                      pairs: DataFrame | None = None, obj_id: str = "objectId") -> DataFrame:
    """JOIN15: for each object and sky map, the probability density of the
    pixel holding it and the searched probability (the summed probability of
    all pixels at least as dense, ties by pixel start).

    Without limits that is every object in every map. ``credible`` keeps only
    the pixels of each map's credible region of that level (densest first, until
    the level is reached), so an object meets the few maps that can hold it;
    ``pairs`` (``obj_id``, ``map_id``) names the pairs to be scored. Both cut before the join.

    Objects find their pixel through a bucketed interval join; the cumulative
    probability is a running sum per map (``ordered.running_sum``), computed
    once per pixel (not per object)."""
    px = pixels.withColumn("density", F.col(prob) / F.col(area))
    # running sum per map, range-sliced so a large map spans many tasks
    ranked = running_sum(px, [map_id], ["density", pix_lo], prob, "searched_prob", descending=True)
    if credible is not None:
        ranked = ranked.filter(F.col("searched_prob") - F.col(prob) < credible)
    ranked = ranked.select(map_id, pix_lo, pix_hi, "density", "searched_prob")
    if pairs is None:
        return interval_join(objects, ranked, obj_pix, pix_lo, pix_hi, by=None, bucket=bucket)
    wanted = objects.join(pairs.select(obj_id, map_id).distinct(), obj_id)
    return interval_join(wanted, ranked, obj_pix, pix_lo, pix_hi, by=[map_id], bucket=bucket)
