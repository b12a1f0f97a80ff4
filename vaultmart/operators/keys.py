"""Per-key selection helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order`` (``DISTINCT ON`` semantics).

    ``row_number() = 1`` is planned as a partial ``WindowGroupLimit`` before the
    shuffle and a final one after it, so a hot key is cut to one row per map
    task before it moves.
    """
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rn).where(F.col("_rn") == 1).drop("_rn")
