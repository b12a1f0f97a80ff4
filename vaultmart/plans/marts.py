"""Mart layer: the sales star join and three aggregates over the vault.

Inputs are vault tables (hubs and links whole, satellites current only).
All joins are equi joins on md5 hash keys; the planner (AQE) picks broadcast
for small dimensions at run time and splits skewed partitions.  Null link
keys in the outer join are spread with a per-row sentinel that can never
match a hash key, so a mass of nulls does not land in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultmart.functions.numeric import avg_rounded, div_round_half_away, pct_change_rounded
from vaultmart.operators.median import exact_median, median_from_counts


@dataclass
class VaultView:
    """The vault tables a mart reads (satellites: current rows only)."""

    hub_transaction: DataFrame
    hub_property: DataFrame
    hub_owner: DataFrame
    hub_agent: DataFrame
    lnk_transaction_property: DataFrame
    lnk_transaction_buyer: DataFrame
    lnk_transaction_seller: DataFrame
    lnk_transaction_agent: DataFrame
    sat_transaction_details: DataFrame
    sat_property_details: DataFrame
    sat_owner_details: DataFrame
    sat_agent_details: DataFrame


def spread_nulls(key: str, row_id: str) -> Column:
    """Join key with nulls replaced by a unique non-matching sentinel.

    Hash keys are 32 hex characters; ``'~' || row_id`` never equals one.
    """
    return F.coalesce(F.col(key), F.concat(F.lit("~"), F.col(row_id)))


def exchange_key(key: str) -> Column:
    """The same hash key through an expression the planner cannot match to a
    table's bucketing (md5 hex is already lower case, so values are equal).

    A bucketed dimension would otherwise enter the join without an exchange,
    and AQE only splits a skewed key when both join inputs are exchanges: this
    keeps a property or agent that holds a large share of all sales from
    landing in one task, at the price of shuffling the (one row per key)
    dimension.  An explicit ``repartition`` would not do: AQE keeps
    user-requested partitionings as they are and does not split them.
    """
    return F.lower(F.col(key))


def mart_property_sales(v: VaultView) -> DataFrame:
    """M1: one row per transaction with its property and (optional) agent."""
    tx = v.hub_transaction.select("transaction_hk", "transaction_id").join(
        v.sat_transaction_details.select("transaction_hk", "sale_price", "sale_date",
                                         "settlement_date", "days_on_market", "sale_type"),
        "transaction_hk")
    props = v.hub_property.select("property_hk", "property_id").join(
        v.sat_property_details.select("property_hk", "address", "suburb", "postcode", "state",
                                      "bedrooms", "bathrooms", "land_size_sqm", "property_type",
                                      "year_built", "listing_price"),
        "property_hk")
    agents = v.hub_agent.select("agent_hk").join(
        v.sat_agent_details.select("agent_hk", F.col("full_name").alias("agent_name"),
                                   "agency_name", F.col("region").alias("agent_region")),
        "agent_hk").withColumnRenamed("agent_hk", "_agent_key")

    props = props.withColumn("_property_key", exchange_key("property_hk")).drop("property_hk")
    agents = agents.withColumn("_agent_key", exchange_key("_agent_key"))
    sales = (tx.join(v.lnk_transaction_property.select("transaction_hk", "property_hk"),
                     "transaction_hk")
             .join(v.lnk_transaction_agent.select("transaction_hk", "agent_hk"),
                   "transaction_hk", "left"))
    # agents first: their columns are fewer, and what the first join adds to a sale the second shuffles
    sales = sales.withColumn("_agent_key", spread_nulls("agent_hk", "transaction_hk"))
    sales = sales.join(agents, "_agent_key", "left")
    sales = sales.join(props, sales.property_hk == props._property_key).drop("_property_key")
    return sales.select(
        "transaction_id", "sale_date", "sale_price", "sale_type", "days_on_market",
        "settlement_date", "property_id", "address", "suburb", "state", "property_type",
        "bedrooms", "bathrooms", "land_size_sqm", "postcode", "year_built", "listing_price",
        pct_change_rounded("sale_price", "listing_price", 2).alias("price_vs_listing_pct"),
        "agent_name", "agency_name", "agent_region")


def mart_agent_performance(sales: DataFrame) -> DataFrame:
    """M2: per agent name, agency and region (not per agent id)."""
    return (sales.where(F.col("agent_name").isNotNull())
            .groupBy("agent_name", "agency_name", "agent_region")
            .agg(F.count(F.lit(1)).alias("total_transactions"),
                 avg_rounded("sale_price", 0).alias("avg_sale_price"),
                 avg_rounded("days_on_market", 1).alias("avg_days_on_market"),
                 avg_rounded("price_vs_listing_pct", 2).alias("avg_price_vs_listing_pct"),
                 F.min("sale_date").alias("first_sale_date"),
                 F.max("sale_date").alias("last_sale_date")))


def sale_month(col: str = "sale_date") -> Column:
    """``date_trunc('month', d)`` as a zone-free timestamp."""
    return F.trunc(F.col(col), "month").cast("timestamp_ntz")


def median_rounded(df: DataFrame, group_cols: list[str], value: str, out: str,
                   digits: int = 0, materialize=None) -> DataFrame:
    """Exact median rounded half away from zero, as ``decimal(18, digits)``."""
    med = exact_median(df, group_cols, value, "_median", materialize=materialize)
    return med.select(*group_cols, F.round("_median", digits).cast(f"decimal(18,{digits})").alias(out))


def _null_safe_on(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    cond = None
    for c in cols:
        term = left[c].eqNullSafe(right[c])
        cond = term if cond is None else cond & term
    return cond


def mart_suburb_trends(sales: DataFrame, materialize=None) -> DataFrame:
    """M3: per suburb, state and month.

    One scan of the sales mart: rows collapse map-side to one per ``(group,
    price)`` with their count and days-on-market sum; the counts, the exact
    averages (whole-number half-away rounding) and the exact distributed
    median all come from that pre-aggregate, written once to the run folder.
    """
    keys = ["suburb", "state", "sale_month"]
    per_price = (sales.select("suburb", "state", sale_month().alias("sale_month"),
                              "sale_price", "days_on_market")
                 .groupBy(*keys, "sale_price")
                 .agg(F.count(F.lit(1)).alias("_c"), F.sum("days_on_market").alias("_dom"),
                      F.count("days_on_market").alias("_ndom")))
    per_price = (materialize or (lambda d: d.checkpoint()))(per_price)
    cents = (F.col("sale_price") * 100).cast("long") * F.col("_c")
    agg = per_price.groupBy(*keys).agg(
        F.sum("_c").alias("transaction_count"),
        F.sum(F.when(F.col("sale_price").isNotNull(), cents)).alias("_cents"),
        F.sum(F.when(F.col("sale_price").isNotNull(), F.col("_c"))).alias("_nprice"),
        F.sum("_dom").alias("_dom"), F.sum("_ndom").alias("_ndom"))
    avg_price = div_round_half_away(F.col("_cents"), F.col("_nprice") * 100)
    avg_dom = div_round_half_away(F.col("_dom") * 10, F.col("_ndom"))
    agg = agg.select(*keys, "transaction_count",
                     avg_price.cast("decimal(18,0)").alias("avg_sale_price"),
                     (avg_dom.cast("decimal(20,0)") / F.lit(10)).cast("decimal(18,1)")
                     .alias("avg_days_on_market"))
    med = median_from_counts(per_price.where(F.col("sale_price").isNotNull()), keys, "sale_price",
                             "_c", "_median", materialize)
    med = med.select(*keys, F.round("_median", 0).cast("decimal(18,0)").alias("median_sale_price"))
    joined = agg.join(med, _null_safe_on(agg, med, keys), "left")
    return joined.select(*[agg[c] for c in keys], "transaction_count", "avg_sale_price",
                         "median_sale_price", "avg_days_on_market")


def mart_owner_portfolio(v: VaultView) -> DataFrame:
    """M4: purchases and sales per current owner (pre-aggregated link counts)."""
    owners = v.hub_owner.select("owner_hk", "owner_id").join(
        v.sat_owner_details.select("owner_hk", "full_name", "suburb", "state", "investor_flag"),
        "owner_hk")
    buys = v.lnk_transaction_buyer.groupBy("owner_hk").agg(F.count(F.lit(1)).alias("_buys"))
    sells = v.lnk_transaction_seller.groupBy("owner_hk").agg(F.count(F.lit(1)).alias("_sells"))
    out = owners.join(buys, "owner_hk", "left").join(sells, "owner_hk", "left")
    b = F.coalesce(F.col("_buys"), F.lit(0)).cast("long")
    s = F.coalesce(F.col("_sells"), F.lit(0)).cast("long")
    return out.select("owner_id", "full_name", "suburb", "state", "investor_flag",
                      b.alias("total_purchases"), s.alias("total_sales"),
                      (b - s).alias("net_properties_held"))
