"""Rows of many sequences in order, cut into segments of bounded length.

A sequence may hold a third of all rows, so no step numbers or sums a whole sequence in one task.  Rows
are range-partitioned by their order and written with `at`, their place in it, and `seg`, the
run of at most SEGMENT consecutive places they lie in.  What needs a sequence is computed per
(sequence, segment), and totals of segments, a few thousandth of the rows, carry it on.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultmart.llm.common import write_table

SEGMENT_BITS = 12
SEGMENT = 1 << SEGMENT_BITS
PART_ROWS = 1_000_000  # rows of a range partition, beyond which there are more of them


def in_order(rows: DataFrame, order: list, label: str, part_rows: int = PART_ROWS) -> DataFrame:
    """Written table: `rows` plus `at` (ascending along `order`) and `seg`.

    Rows equal in all of `order` are told apart by their place in the input, so that many of them still split.
    """
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows.count() / part_rows))
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    placed = (tied.repartitionByRange(parts, *order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
              .withColumn("at", F.monotonically_increasing_id()))
    return write_table(placed.withColumn("seg", F.shiftright("at", SEGMENT_BITS)), label)
