"""Data-quality tests: not_null, unique, relationships.

A test fails when its violation query returns rows.  ``not_null`` tests of
one table run fused in a single aggregate pass; ``unique`` is a partially
aggregated count per value; ``relationships`` is an anti join against the
parent's distinct keys (duplicates of a hot parent key collapse map-side
before the shuffle).  The results frame is ``(layer, table_name,
column_name, test, violations)``; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null_violations(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col`` is null."""
    return df.where(F.col(col).isNull())


def unique_violations(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Non-null values that occur more than once, with their count ``n_records``."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    present = df
    for c in cols:
        present = present.where(F.col(c).isNotNull())
    return (present.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def relationship_violations(child: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """Non-null child values without a parent row (every child row is kept)."""
    keys = parent.select(F.col(field).alias(col)).where(F.col(col).isNotNull()).distinct()
    return child.select(col).where(F.col(col).isNotNull()).join(keys, col, "left_anti")


def relationship_count(child: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """Number of violating child rows, as one row ``violations``.

    Child keys are counted first (partial aggregation collapses a hot key
    map-side), so the anti join sees one row per distinct key.
    """
    keys = parent.select(F.col(field).alias(col)).where(F.col(col).isNotNull()).distinct()
    per_key = (child.where(F.col(col).isNotNull()).groupBy(col)
               .agg(F.count(F.lit(1)).alias("_n")))
    return (per_key.join(keys, col, "left_anti")
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("violations")))


@dataclass(frozen=True)
class Test:
    layer: str
    table: str
    column: str
    kind: str                      # not_null | unique | relationships
    to_table: str | None = None
    to_field: str | None = None


def _label(t: Test) -> str:
    return t.kind if t.kind != "relationships" else f"relationships:{t.to_table}.{t.to_field}"


def unique_count(df: DataFrame, col: str) -> DataFrame:
    """``(column_name, violations)`` of one column, grouped by the column itself: a table
    bucketed by it is not shuffled."""
    dup = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return dup.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(col).alias("column_name"), "violations")


def unique_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Duplicated non-null values per column, all columns in one shuffle.

    Columns are stacked as ``(column_name, value as text)`` pairs and grouped
    once; text is injective for the key types tested (strings, integers,
    dates, fixed-scale decimals).  Returns ``(column_name, violations)``,
    one row per column, zeros included.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v"))
                                for c in cols]))
    dup = (df.select(pairs.alias("p")).select("p.c", "p.v").where(F.col("v").isNotNull())
           .groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))
    wide = dup.agg(*[F.count_if(F.col("c") == c).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column_name", "violations")


def not_null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null rows per column in one scan: ``(column_name, violations)``."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column_name", "violations")


def run_tests(tests: Sequence[Test], tables: Mapping[str, DataFrame],
              bucket_keys: Mapping[str, str] | None = None) -> DataFrame:
    """All test results as one DataFrame ``(layer, table_name, column_name, test,
    violations)``, one row per declared test, in declaration order.  ``bucket_keys``:
    the column each table is bucketed by, whose unique test then needs no shuffle."""
    spark = next(iter(tables.values())).sparkSession
    frames = []
    by_table: dict[str, list[Test]] = {}
    for t in tests:
        by_table.setdefault(t.table, []).append(t)
    for table, items in by_table.items():
        df = tables[table]
        for kind, fn in (("not_null", not_null_counts), ("unique", unique_counts)):
            cols = list(dict.fromkeys(t.column for t in items if t.kind == kind))
            own = (bucket_keys or {}).get(table)
            if kind == "unique" and own in cols:
                cols.remove(own)
                frames.append(unique_count(df, own).select(F.lit(table).alias("table_name"), "column_name",
                                                           F.lit(kind).alias("test"), "violations"))
            if cols:
                frames.append(fn(df, cols).select(F.lit(table).alias("table_name"), "column_name",
                                                  F.lit(kind).alias("test"), "violations"))
        for t in items:
            if t.kind == "relationships":
                v = relationship_count(df, t.column, tables[t.to_table], t.to_field)
                frames.append(v.select(
                    F.lit(table).alias("table_name"), F.lit(t.column).alias("column_name"),
                    F.lit(_label(t)).alias("test"), "violations"))
    results = reduce(DataFrame.unionByName, frames)
    declared = spark.createDataFrame(
        [(i, t.layer, t.table, t.column, _label(t)) for i, t in enumerate(tests)],
        "_order int, layer string, table_name string, column_name string, test string")
    return (declared.join(results, ["table_name", "column_name", "test"], "left")
            .orderBy("_order")
            .select("layer", "table_name", "column_name", "test",
                    F.col("violations").cast("long").alias("violations")))


def _nn_uq(layer: str, table: str, nn: Sequence[str], uq: Sequence[str]) -> list[Test]:
    out = []
    for c in nn:
        out.append(Test(layer, table, c, "not_null"))
        if c in uq:
            out.append(Test(layer, table, c, "unique"))
    return out


def _hk_ri(table: str, hk: str, hub: str) -> list[Test]:
    return [Test("gold", table, hk, "not_null"),
            Test("gold", table, hk, "relationships", hub, hk)]


# The 56 declared tests, table by table, in declaration order.
DECLARED_TESTS: list[Test] = [
    *_nn_uq("silver", "stg_transactions",
            ["transaction_id", "transaction_hk", "property_id", "sale_price", "sale_date"],
            ["transaction_id", "transaction_hk"]),
    *_nn_uq("silver", "stg_properties", ["property_id", "property_hk", "suburb"],
            ["property_id", "property_hk"]),
    *_nn_uq("silver", "stg_owners", ["owner_id", "owner_hk"], ["owner_id", "owner_hk"]),
    *_nn_uq("silver", "stg_agents", ["agent_id", "agent_hk"], ["agent_id", "agent_hk"]),
    *_nn_uq("gold", "hub_property", ["property_hk", "property_id"], ["property_hk", "property_id"]),
    *_nn_uq("gold", "hub_owner", ["owner_hk"], ["owner_hk"]),
    *_nn_uq("gold", "hub_agent", ["agent_hk"], ["agent_hk"]),
    *_nn_uq("gold", "hub_transaction", ["transaction_hk"], ["transaction_hk"]),
    *_hk_ri("lnk_transaction_property", "transaction_hk", "hub_transaction"),
    *_hk_ri("lnk_transaction_property", "property_hk", "hub_property"),
    *_hk_ri("sat_property_details", "property_hk", "hub_property"),
    Test("gold", "sat_property_details", "hashdiff", "not_null"),
    *_hk_ri("sat_owner_details", "owner_hk", "hub_owner"),
    Test("gold", "sat_owner_details", "hashdiff", "not_null"),
    *_hk_ri("sat_agent_details", "agent_hk", "hub_agent"),
    Test("gold", "sat_agent_details", "hashdiff", "not_null"),
    *_hk_ri("sat_transaction_details", "transaction_hk", "hub_transaction"),
    Test("gold", "sat_transaction_details", "hashdiff", "not_null"),
    *_nn_uq("mart", "mart_property_sales", ["transaction_id", "sale_price", "suburb"], ["transaction_id"]),
    *_nn_uq("mart", "mart_agent_performance", ["agent_name", "total_transactions"], []),
    *_nn_uq("mart", "mart_suburb_trends", ["suburb", "sale_month"], []),
    *_nn_uq("mart", "mart_owner_portfolio", ["owner_id"], ["owner_id"]),
]
assert len(DECLARED_TESTS) == 56, len(DECLARED_TESTS)
