"""Identifier text helpers (FN17)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyflux.functions._util import col


def strip_id(c, prefix: str = "GAL") -> Column:
    """'GAL123' -> 123 (long); anything else -> NULL."""
    digits = F.regexp_extract(F.trim(col(c)), "^" + prefix + r"(\d+)$", 1)
    return F.when(digits != "", digits.cast("long"))


def pad_num(c, width: int = 4) -> Column:
    """Zero-padded file number, e.g. 7 -> '0007'; longer numbers are kept whole."""
    t = col(c).cast("string")
    return F.when(F.length(t) < width, F.lpad(t, width, "0")).otherwise(t)
