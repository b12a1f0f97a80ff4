"""The declared tests after a batch, from what the batch before left and the rows the batch brought.

Silver and mart tables are whole tables per batch and are tested as such.  Gold tables only grow in keys, so

* a value is duplicated now if it was before, or if it is among the batch's rows and either twice there or already
  in the table: only the batch's values meet the history, by a join on the bucket key where the
  test is on it;
* a child value lacks a parent now if it lacked one before or is among the batch's rows, and the parent (which
  may have come meanwhile) is not there: the child's history is not read;
* nulls in an append-only table are those from before plus the batch's.  In a type-2 satellite, whose batches also
  replace rows, they are counted by a filter that Parquet's own statistics answer.

Violating values, normally none, are kept per batch in the run folder; only if there are any are their rows counted over the
table.  The first batch, or one whose predecessor left nothing, is tested in full.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultmart.operators import quality
from vaultmart.operators.quality import DECLARED_TESTS, Test
from vaultmart.plans.pipeline import KEYS, MART_TABLES, SATELLITES, STAGING_TABLES, Pipeline

STATE = "table_name string, column_name string, test string, value string, n long"


def _state_path(run: Pipeline, batch: int) -> str:
    return f"{run.root}/_quality/batch={batch}"


def _brought(run: Pipeline, table: str, batch: int) -> DataFrame:
    """The rows of a gold table that ``batch`` wrote."""
    return run.store.read_batch("gold", table, batch)


def _before(run: Pipeline, table: str, batch: int, column: str) -> DataFrame | None:
    """The values of a column that earlier batches wrote (of open, closed and replaced rows alike)."""
    rows = run.store.read_appended("gold", table, batch - 1)
    return None if rows is None else rows.select(column)


def _values(df: DataFrame, t: Test) -> DataFrame:
    """Violating values with the number of rows the test counts for them."""
    return df.select(F.lit(t.table).alias("table_name"), F.lit(t.column).alias("column_name"), F.lit(quality._label(t)).alias("test"),
                     F.col("value").cast("string").alias("value"), F.col("n").cast("long").alias("n"))


def _carried(state: DataFrame, t: Test) -> DataFrame:
    mine = (F.col("table_name") == t.table) & (F.col("column_name") == t.column) & (F.col("test") == quality._label(t))
    return state.where(mine).select("value")


def _not_null(run: Pipeline, t: Test, batch: int, state: DataFrame | None) -> DataFrame:
    nulls = lambda df: df.where(F.col(t.column).isNull()).agg(F.count(F.lit(1)).alias("n"))
    if t.table in SATELLITES:
        rows = nulls(run.satellite(t.table, batch))
    elif state is None:
        rows = nulls(run.hub(t.table, batch))
    else:
        mine = state.where((F.col("table_name") == t.table) & (F.col("column_name") == t.column) & (F.col("test") == "not_null"))
        rows = nulls(_brought(run, t.table, batch)).unionByName(mine.select("n")).agg(F.sum("n").alias("n"))
    return _values(rows.where("n > 0").withColumn("value", F.lit(None).cast("string")), t)


def _unique(run: Pipeline, t: Test, batch: int, state: DataFrame | None) -> DataFrame:
    if state is None:
        found = quality.unique_violations(run.hub(t.table, batch), t.column).select(F.col(t.column).alias("value"))
    else:
        new = _brought(run, t.table, batch).where(F.col(t.column).isNotNull()).groupBy(t.column).agg(F.count(F.lit(1)).alias("k"))
        twice = new.where("k > 1").select(t.column)
        known = _before(run, t.table, batch, t.column)
        again = twice if known is None else twice.unionByName(new.select(t.column).join(known, t.column, "left_semi"))
        found = again.select(F.col(t.column).cast("string").alias("value")).unionByName(_carried(state, t)).distinct()
    return _values(found.withColumn("n", F.lit(1)), t)


def _relationship(run: Pipeline, t: Test, batch: int, state: DataFrame | None) -> DataFrame:
    parents = run.hub(t.to_table, batch).select(F.col(t.to_field).alias("value"))
    child = run.satellite if t.table.startswith("sat_") else run.hub
    if state is None:
        values = child(t.table, batch).select(F.col(t.column).alias("value"))
    else:
        values = _brought(run, t.table, batch).select(F.col(t.column).alias("value"))
    lone = values.where(F.col("value").isNotNull()).distinct().join(parents, "value", "left_anti")
    if state is not None:
        lone = lone.unionByName(_carried(state, t).join(parents, "value", "left_anti")).distinct()
    return lone.select(F.lit(t.table).alias("table_name"), F.lit(t.column).alias("column_name"),
                       F.lit(quality._label(t)).alias("test"), F.col("value").cast("string").alias("value"))


def _lone_rows(run: Pipeline, tests: list[Test], batch: int, state: DataFrame | None) -> DataFrame:
    """Child values without a parent, with their rows: counted for the tests that have any."""
    lone = reduce(DataFrame.unionByName, [_relationship(run, t, batch, state) for t in tests])
    lone = run._materializer("quality_lone", batch)(lone)
    red = {tuple(r) for r in lone.select("table_name", "column_name", "test").distinct().collect()}  # one row a test at most
    counted = [lone.limit(0).withColumn("n", F.lit(0).cast("long"))]
    for t in tests:
        if (t.table, t.column, quality._label(t)) in red:
            child = run.satellite if t.table.startswith("sat_") else run.hub
            mine = lone.where((F.col("table_name") == t.table) & (F.col("column_name") == t.column) & (F.col("test") == quality._label(t)))
            rows = child(t.table, batch).select(F.col(t.column).cast("string").alias("value"))
            counted.append(_values(rows.join(mine.select("value"), "value").groupBy("value").agg(F.count(F.lit(1)).alias("n")), t))
    return reduce(DataFrame.unionByName, counted)


def carry(run: Pipeline, batch: int) -> DataFrame:
    """Write and return the violating values of the gold tables after ``batch``, from those after the batch before."""
    before = [b for b in run.store.marked("finished") if b < batch]
    path = _state_path(run, before[-1]) if before else None
    state = run.spark.read.schema(STATE).parquet(path) if path and run.store._exists(f"{path}/_SUCCESS") else None
    gold = [t for t in DECLARED_TESTS if t.layer == "gold"]
    found = [_not_null(run, t, batch, state) for t in gold if t.kind == "not_null"]
    found += [_unique(run, t, batch, state) for t in gold if t.kind == "unique"]
    found.append(_lone_rows(run, [t for t in gold if t.kind == "relationships"], batch, state))
    run.store.write_files(reduce(DataFrame.unionByName, found), _state_path(run, batch))
    return run.spark.read.schema(STATE).parquet(_state_path(run, batch))


def quality_delta(run: Pipeline, batch: int) -> DataFrame:
    """The results of ``run.quality(batch)``, in the same columns and order; keeps the state for the next batch."""
    counted = carry(run, batch).groupBy("table_name", "column_name", "test").agg(F.sum("n").alias("violations"))
    tables = {n: run.staged(n, batch) for n in STAGING_TABLES} | {t: run.mart(t, batch) for t in MART_TABLES}
    whole = quality.run_tests([t for t in DECLARED_TESTS if t.layer != "gold"], tables, {t: k for (_, t), k in KEYS.items()})
    results = counted.unionByName(whole.select("table_name", "column_name", "test", "violations"))
    declared = run.spark.createDataFrame([(i, t.layer, t.table, t.column, quality._label(t)) for i, t in enumerate(DECLARED_TESTS)],
                                         "_order int, layer string, table_name string, column_name string, test string")
    return (declared.join(results, ["table_name", "column_name", "test"], "left").orderBy("_order")
            .select("layer", "table_name", "column_name", "test", F.coalesce("violations", F.lit(0)).cast("long").alias("violations")))
