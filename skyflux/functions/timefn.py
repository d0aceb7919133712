"""Time conversions (FN15, FN16) and the MJD of a timestamp."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyflux.functions._util import col

# MJD of the Unix epoch, JD of MJD 0, GPS epoch as Unix seconds, and
# the MJDs from which each leap second since the GPS epoch counts.
MJD_UNIX_EPOCH = 40587
JD_MJD_OFFSET = 2400000.5
GPS_EPOCH_UNIX = 315964800
LEAP_MJD = [44786, 45151, 45516, 46247, 47161, 47892, 48257, 48804, 49169, 49534,
            50083, 50630, 51179, 53736, 54832, 56109, 57204, 57754]


def _leaps(c, starts: list[float]) -> Column:
    """GPS - UTC in seconds: how many leap seconds have begun by ``c``."""
    n = F.lit(0)
    for s in starts:
        n = n + F.when(col(c) >= F.lit(float(s)), 1).otherwise(0)
    return n


def mjd_from_timestamp(ts, decimals: int = 6) -> Column:
    """MJD of a timestamp, rounded half-up to ``decimals`` places of a day.

    Computed on integer microseconds, so every engine gets the same double;
    free of the session time zone for TIMESTAMP_NTZ input."""
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    us = F.timestamp_diff("MICROSECOND", epoch, col(ts).cast("timestamp_ntz"))
    unit = 86400 * 10 ** 6 // 10 ** decimals          # microseconds per rounding step
    # floor of an exact double quotient: the step 1/unit is far above one ulp here
    steps = F.floor((us + F.lit(unit // 2)) / F.lit(unit))
    return F.lit(float(MJD_UNIX_EPOCH)) + steps.cast("double") / F.lit(float(10 ** decimals))


def mjd_to_timestamp(mjd) -> Column:
    """UTC timestamp of an MJD (microsecond resolution)."""
    us = F.round((col(mjd) - MJD_UNIX_EPOCH) * 86400e6).cast("long")
    return F.timestamp_micros(us)


def mjd_to_gps(mjd) -> Column:
    """GPS seconds of an MJD (UTC), with the leap seconds of its date."""
    return (col(mjd) - MJD_UNIX_EPOCH) * 86400.0 - GPS_EPOCH_UNIX + _leaps(mjd, LEAP_MJD)


def gps_to_jd(gps) -> Column:
    """Julian date (UTC) of a GPS time, with the leap seconds of its date."""
    starts = [(m - MJD_UNIX_EPOCH) * 86400.0 - GPS_EPOCH_UNIX + n for n, m in enumerate(LEAP_MJD, 1)]
    unix = col(gps) + GPS_EPOCH_UNIX - _leaps(gps, starts)
    return unix / 86400.0 + MJD_UNIX_EPOCH + JD_MJD_OFFSET


def night_of(mjd) -> Column:
    """Integer night number = floor(MJD)."""
    return F.floor(col(mjd)).cast("int")


def night_range(day, first_night, last_night, factor) -> tuple[Column, Column]:
    """Nights streamed on campaign ``day``: n0 = first + day*factor, n1 = n0 + factor - 1,
    clamped to [first, last]. Returns (n0, n1); n0 > n1 means nothing to stream."""
    d, f0, f1, k = col(day), col(first_night), col(last_night), col(factor)
    n0 = f0 + d * k
    n1 = n0 + k - 1
    c0 = F.greatest(n0, f0)
    c1 = F.least(n1, f1)
    outside = (n0 > f1) | (n1 < f0)
    return F.when(outside, F.lit(None)).otherwise(c0), F.when(outside, F.lit(None)).otherwise(c1)
