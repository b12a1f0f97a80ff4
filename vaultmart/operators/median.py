"""Exact continuous median per group by selection, distributed even for one huge group.

``percentile_cont(0.5)`` as a built-in keeps a value->count map per group in
one task; a group holding a third of all rows with mostly distinct prices
would not fit.  Nor are values sorted here.  Rows are first counted per ``(group, value)``, map-side, then:

1. the range of values is cut into CELLS cells and rows are counted per ``(group, cell)``, with the least and
   greatest value in it (partial aggregates: at most CELLS rows per group leave a task);
2. running counts over a group's cells tell the cells that hold the ranks ``(n-1) div 2`` and ``n div 2``;
3. if these are two cells, the median lies between the greatest value of the first and the least of the second; if they
   are one cell with one value, it is that value; else only the rows of that cell go on, and its own
   range is cut again.

A cell's least and greatest value never share a cell of the next round, so every round narrows the range, by
a factor of CELLS for values spread evenly: three rounds for a billion different prices.  Rows meet their group's
middle cell in a join on ``(group, cell)``, over which a hot group is spread.  No group is ever collected into
one task or the driver, and nothing depends on a number of partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CELLS = 1024


def exact_median(df: DataFrame, group_cols: Sequence[str], value_col: str,
                 out_col: str = "median",
                 materialize: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``percentile_cont(0.5) within group (order by value)`` per group.

    Nulls in the value are ignored; the result keeps the value's decimal type
    widened by one digit of scale (exact half of a sum).  Groups whose values
    are all null are absent.  ``materialize`` writes what a round leaves
    (default: reliable ``checkpoint()``) and must give each call a place of its own.
    """
    counts = (df.where(F.col(value_col).isNotNull())
              .groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("_c")))
    return median_from_counts(counts, group_cols, value_col, "_c", out_col, materialize)


def median_from_counts(counts: DataFrame, group_cols: Sequence[str], value_col: str,
                       count_col: str, out_col: str = "median",
                       materialize: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The same median from rows ``(group..., value, count)`` with non-null values."""
    g, keep = list(group_cols), materialize or (lambda d: d.checkpoint())
    rows = keep(counts.select(*g, F.col(value_col).alias("_v"), F.col(count_col).alias("_c")))
    lo, hi = rows.agg(F.min("_v"), F.max("_v")).first()
    kind = rows.schema["_v"].dataType
    bound = lambda x: F.lit(x).cast(kind)
    rows = rows.withColumns({"_lo": bound(lo), "_hi": bound(hi), "_r1": F.lit(None).cast("long"), "_r2": F.lit(None).cast("long")})
    found = []
    while True:
        # monotone in the value, 0 at the least one and CELLS - 1 at the greatest
        share = (F.col("_v") - F.col("_lo")).cast("double") / F.greatest((F.col("_hi") - F.col("_lo")).cast("double"), F.lit(1e-300))
        rows = rows.withColumn("_cell", F.least(F.floor(share * CELLS), F.lit(CELLS - 1)).cast("int"))
        cells = rows.groupBy(*g, "_r1", "_r2", "_cell").agg(F.sum("_c").alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
        whole = Window.partitionBy(*g)
        upto = F.sum("_n").over(whole.orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        ranked = cells.withColumns({"_upto": upto, "_all": F.sum("_n").over(whole)}).withColumns({
            "_r1": F.coalesce("_r1", F.expr("(_all - 1) div 2")), "_r2": F.coalesce("_r2", F.expr("_all div 2"))})
        holds = lambda r: (F.col("_upto") - F.col("_n") <= F.col(r)) & (F.col(r) < F.col("_upto"))
        middle = keep(ranked.where(holds("_r1") | holds("_r2")).withColumns({"_first": holds("_r1"), "_second": holds("_r2")}))
        open_ = F.col("_first") & F.col("_second") & (F.col("_least") < F.col("_most"))
        halves = (F.max(F.when(F.col("_first"), F.col("_most"))) + F.max(F.when(F.col("_second"), F.col("_least"))))
        found.append(middle.where(~open_).groupBy(*g).agg((halves * F.lit(0.5).cast("decimal(2,1)")).alias(out_col)))
        again = middle.where(open_)
        if again.isEmpty():
            return reduce(DataFrame.unionByName, found)
        before = F.col("_upto") - F.col("_n")
        again = again.select(*[F.col(c).alias(f"_g{k}") for k, c in enumerate(g)], F.col("_cell").alias("_in"),
                             F.col("_least").alias("_lo"), F.col("_most").alias("_hi"),
                             (F.col("_r1") - before).alias("_r1"), (F.col("_r2") - before).alias("_r2"))
        match = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g{k}")) for k, c in enumerate(g)], F.col("_cell") == F.col("_in"))
        rows = keep(rows.drop("_lo", "_hi", "_r1", "_r2").join(again, match).select(*g, "_v", "_c", "_lo", "_hi", "_r1", "_r2"))
