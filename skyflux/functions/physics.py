"""Binary-merger mass relations (FN6, FN7, FN9, FN11)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyflux.functions._util import col


def chirp_mass(m1, m2) -> Column:
    """(m1 m2)^(3/5) / (m1 + m2)^(1/5)."""
    a, b = col(m1), col(m2)
    return F.pow(a * b, 0.6) / F.pow(a + b, 0.2)


def component_masses(mc, q) -> tuple[Column, Column]:
    """Inverse of the chirp mass for mass ratio q = m2/m1 <= 1: returns (m1, m2)."""
    mc_, q_ = col(mc), col(q)
    mtot = mc_ * F.pow(1 + q_, 1.2) / F.pow(q_, 0.6)
    m1 = mtot / (1 + q_)
    return m1, mtot - m1


def ejecta_from_log(logmass) -> Column:
    """Ejecta mass 10^LOGMASS."""
    return F.pow(F.lit(10.0), col(logmass))


def symmetric_mass_ratio(m1, m2) -> Column:
    """m1 m2 / (m1 + m2)^2."""
    a, b = col(m1), col(m2)
    return a * b / F.pow(a + b, 2)
