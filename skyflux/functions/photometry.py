"""Photometry column functions (FLT1, FN1-FN4, AGG19)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyflux.functions._util import col

# Zero point of the FLUXCAL magnitude scale and magnitude-error cap.
ZERO_POINT = 27.5
MAGERR_FACTOR = 1.086
MAGERR_CAP = 0.5


def has_flag(photflag, mask: int) -> Column:
    """``(PHOTFLAG & mask) != 0``."""
    return col(photflag).bitwiseAND(F.lit(mask)) != 0


def mag_from_flux(flux) -> Column:
    """-2.5 log10(|flux|) + 27.5; flux 0 gives +infinity (as numpy does)."""
    f = F.abs(col(flux).cast("double"))
    return F.when(f == 0, F.lit(float("inf"))).otherwise(-2.5 * F.log10(f) + ZERO_POINT)


def fractional_error(flux, fluxerr) -> Column:
    """fluxerr / |flux| (the inverse of a signal-to-noise ratio)."""
    f = F.abs(col(flux).cast("double"))
    e = col(fluxerr).cast("double")
    return F.when(f == 0, F.lit(float("inf"))).otherwise(e / f)


def mag_error(flux, fluxerr) -> Column:
    """min(1.086 * fluxerr/|flux|, 0.5)."""
    return F.least(MAGERR_FACTOR * fractional_error(flux, fluxerr), F.lit(MAGERR_CAP))


def snr(flux, fluxerr) -> Column:
    """flux / fluxerr (NULL when the error is 0)."""
    e = col(fluxerr).cast("double")
    return F.when(e != 0, col(flux).cast("double") / e)


def one_hot_label(c, value) -> Column:
    """Integer label ``c == value`` (1/0)."""
    return (col(c) == F.lit(value)).cast("int")
