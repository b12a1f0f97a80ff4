"""Dashboard chart queries over the marts.

Each returns a small aggregate or projection; sorting is left to the chart
except for the top-k report, whose order and limit are the feature.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultmart.plans.marts import median_rounded, sale_month

TOP_AGENTS = 10


def sales_volume(sales: DataFrame) -> DataFrame:
    """Transactions per month."""
    return (sales.groupBy(sale_month().alias("sale_month"))
            .agg(F.count(F.lit(1)).alias("transaction_count")))


def median_price_by_suburb(sales: DataFrame, materialize=None) -> DataFrame:
    """Exact median sale price per suburb."""
    return median_rounded(sales, ["suburb"], "sale_price", "median_sale_price", 0, materialize)


def sale_types(sales: DataFrame) -> DataFrame:
    """D3: sale type breakdown."""
    return sales.groupBy("sale_type").agg(F.count(F.lit(1)).alias("transaction_count"))


def top_agents(agent_perf: DataFrame, k: int = TOP_AGENTS) -> DataFrame:
    """Top agents by volume; ties broken by the grain (deterministic)."""
    return (agent_perf.orderBy(F.col("total_transactions").desc(), F.col("agent_name").asc(),
                               F.col("agency_name").asc_nulls_first(),
                               F.col("agent_region").asc_nulls_first())
            .limit(k)
            .select("agent_name", "agency_name", "agent_region", "total_transactions"))


def agent_days_on_market(agent_perf: DataFrame) -> DataFrame:
    """Average days on market by agent."""
    return agent_perf.select("agent_name", "agency_name", "agent_region", "avg_days_on_market")


def agent_price_vs_listing(agent_perf: DataFrame) -> DataFrame:
    """Price achieved vs listing by agent."""
    return agent_perf.select("agent_name", "agency_name", "agent_region", "avg_price_vs_listing_pct")


def median_trend(trends: DataFrame) -> DataFrame:
    """Median price trend by suburb and month."""
    return trends.select("suburb", "state", "sale_month", "median_sale_price")


def heatmap(trends: DataFrame) -> DataFrame:
    """Transaction frequency, suburb x month."""
    return (trends.groupBy("suburb", "sale_month")
            .agg(F.sum("transaction_count").cast("long").alias("transaction_count")))


def investor_split(portfolio: DataFrame) -> DataFrame:
    """Investors vs owner-occupiers."""
    return portfolio.groupBy("investor_flag").agg(F.count(F.lit(1)).alias("owner_count"))


def net_properties(portfolio: DataFrame) -> DataFrame:
    """Histogram of net properties held."""
    return portfolio.groupBy("net_properties_held").agg(F.count(F.lit(1)).alias("owner_count"))


def multi_property(portfolio: DataFrame) -> DataFrame:
    """Distribution of owners holding more than one property."""
    return (portfolio.where(F.col("net_properties_held") > 1)
            .groupBy("net_properties_held").agg(F.count(F.lit(1)).alias("owner_count")))


def row_counts(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """``UNION ALL`` of per-table row counts, ``(layer, table_name, row_count)``."""
    frames = [df.agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count")
              for (layer, name), df in tables.items()]
    return reduce(DataFrame.unionByName, frames)
