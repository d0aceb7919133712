"""Class-id arithmetic of the 4-digit decimal taxonomy (TAX2)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyflux.functions._util import col


def class_at_level(c, level: int) -> Column:
    """Ancestor of a class id at ``level`` (1 = thousands ... 4 = the id itself).

    Ids with fewer than 4 digits (the meta branch, 0-300) keep their own value
    at level >= their level and map to 0 above it."""
    k = 10 ** (4 - level)
    return (F.floor(col(c) / F.lit(k)) * F.lit(k)).cast("int")


def class_level(c) -> Column:
    """Level of an id = position of its lowest non-zero digit (0 -> 0)."""
    x = col(c)
    return (F.when(x == 0, 0)
            .when(x % 1000 == 0, 1)
            .when(x % 100 == 0, 2)
            .when(x % 10 == 0, 3)
            .otherwise(4))
