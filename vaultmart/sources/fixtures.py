"""The property feed, derived from the driver's TPC-H-like tables.

Orders become sale transactions, parts become properties, customers become
CRM owners and suppliers become CRM agents.  Three batches exercise the
incremental loaders: new keys, attribute changes, a revert, a late arrival,
a same-instant replacement and keys missing from a batch.  Everything is a
Spark plan over the whole input tables; only three row counts are read on
the driver (they fix the modulus of the derived keys).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Batch load instants and the special instants of batch 3.
BATCH_LOADED_AT = {
    1: "2024-01-01 00:00:00",
    2: "2024-01-02 00:00:00",
    3: "2024-01-03 00:00:00",
}
LATE_LOADED_AT = "2023-12-31 00:00:00"
SAME_INSTANT_LOADED_AT = "2024-01-02 00:00:00"

# Accreditation tiers by supplier key modulo 4, in order.
TIERS = ["bronze", "silver", "gold", "platinum"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@dataclass(frozen=True)
class FeedSizes:
    """Row counts that fix the modulus of derived keys."""

    n_part: int
    n_customer: int
    n_supplier: int


def feed_sizes(spark: SparkSession, sf_dir: str) -> FeedSizes:
    return FeedSizes(
        n_part=read_table(spark, sf_dir, "part").count(),
        n_customer=read_table(spark, sf_dir, "customer").count(),
        n_supplier=read_table(spark, sf_dir, "supplier").count(),
    )


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _property_key(orderkey: Column, n_part: int) -> Column:
    return (orderkey * 7919) % n_part


def transactions(spark: SparkSession, sf_dir: str, sizes: FeedSizes, batch: int) -> DataFrame:
    """Sale transactions of one batch, with the numeric property key kept."""
    k = F.col("o_orderkey")
    pkey = _property_key(k, sizes.n_part)
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    if batch == 1:
        orders = orders.where(k % 10 != 9)           # these keys arrive in batch 2
    elif batch == 3:
        orders = orders.where(pkey % 100 != 7)       # these keys are missing in batch 3

    price = F.col("o_totalprice").cast("decimal(14,2)")
    agent = F.when(k % 50 != 0, ((k * 31) % sizes.n_supplier).cast("string"))
    if batch >= 2:
        # changes the loaders must ignore: an insert-only satellite and a link
        price = F.when(k % 1000 == 0, (price + 1).cast("decimal(14,2)")).otherwise(price)
        agent = F.when(k % 1000 == 1, ((k * 31 + 1) % sizes.n_supplier).cast("string")).otherwise(agent)
    sale_date = F.col("o_orderdate").cast("date")
    return orders.select(
        pkey.alias("_pkey"),
        k.cast("string").alias("transaction_id"),
        pkey.cast("string").alias("property_id"),
        price.alias("sale_price"),
        sale_date.alias("sale_date"),
        F.col("o_custkey").cast("string").alias("buyer_id"),
        ((F.col("o_custkey") + 1 + k % 7) % sizes.n_customer).cast("string").alias("seller_id"),
        agent.alias("agent_id"),
        F.when(F.col("o_orderstatus") == "F", F.lit("auction"))
         .when(F.col("o_orderstatus") == "O", F.lit("private_sale")).alias("sale_type"),
        F.date_add(sale_date, (k % 91).cast("int")).alias("settlement_date"),
        (F.lit(3) + k % 178).cast("int").alias("days_on_market"),
    )


def properties(spark: SparkSession, sf_dir: str, batch: int) -> DataFrame:
    """Property attributes of one batch, each with its own ``_loaded_at``."""
    p = F.col("p_partkey")
    suburb = F.col("p_brand")
    loaded_at = _ts(BATCH_LOADED_AT[batch])
    if batch == 2:
        suburb = F.when(p % 10 == 0, F.concat(suburb, F.lit("-updated"))).otherwise(suburb)
    elif batch == 3:
        suburb = (F.when(p % 20 == 0, suburb)                      # reverted
                  .when(p % 100 == 30, F.concat(suburb, F.lit("-late")))
                  .when(p % 100 == 50, F.concat(suburb, F.lit("-replaced")))
                  .when(p % 10 == 0, F.concat(suburb, F.lit("-updated")))
                  .otherwise(suburb))
        loaded_at = (F.when(p % 100 == 30, _ts(LATE_LOADED_AT))
                     .when(p % 100 == 50, _ts(SAME_INSTANT_LOADED_AT))
                     .otherwise(loaded_at))
    return read_table(spark, sf_dir, "part").select(
        p.alias("_pkey"),
        F.col("p_name").alias("address"),
        suburb.alias("suburb"),
        F.lpad(F.col("p_size").cast("string"), 4, "0").alias("postcode"),
        F.col("p_type").alias("state"),
        (F.col("p_size") % 6 + 1).cast("int").alias("bedrooms"),
        (F.col("p_size") % 4 + 1).cast("int").alias("bathrooms"),
        (F.lit(50) + p % 1950).cast("decimal(18,2)").alias("land_size_sqm"),
        F.col("p_type").alias("property_type"),
        (F.lit(1960) + F.col("p_size")).cast("int").alias("year_built"),
        (F.col("p_retailprice").cast("decimal(14,2)") * 275).cast("decimal(14,2)").alias("listing_price"),
        loaded_at.alias("_row_loaded_at"),
    )


def property_raw(spark: SparkSession, sf_dir: str, batch: int,
                 sizes: FeedSizes | None = None) -> DataFrame:
    """The wide raw feed of one batch: transactions left join properties."""
    sizes = sizes or feed_sizes(spark, sf_dir)
    tx = transactions(spark, sf_dir, sizes, batch)
    props = properties(spark, sf_dir, batch)
    # join on the numeric key: same result as the string id, cheaper to hash
    raw = tx.join(props, "_pkey", "left")
    loaded_at = F.coalesce(F.col("_row_loaded_at"), _ts(BATCH_LOADED_AT[batch]))
    return raw.select(
        "transaction_id", "property_id", "sale_price", "sale_date", "buyer_id",
        "seller_id", "agent_id", "sale_type", "settlement_date", "days_on_market",
        "address", "suburb", "postcode", "state", "bedrooms", "bathrooms",
        "land_size_sqm", "property_type", "year_built", "listing_price",
        loaded_at.alias("_loaded_at"))


def crm_owners(spark: SparkSession, sf_dir: str, batch: int) -> DataFrame:
    """CRM owners: customer joined to nation and region."""
    c = F.col("c_custkey")
    phone = F.when(c % 11 != 0, F.concat(F.lit("04"), F.lpad(c.cast("string"), 8, "0")))
    if batch >= 2:
        phone = F.when(c % 20 == 0, F.concat(F.lit("05"), F.lpad(c.cast("string"), 8, "0"))).otherwise(phone)
    cust = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey"), F.col("n_name"), F.col("r_name"))
    return cust.join(geo, cust.c_nationkey == geo.n_nationkey, "left").select(
        c.cast("string").alias("owner_id"),
        F.col("c_name").alias("full_name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        phone.alias("phone"),
        F.col("n_name").alias("suburb"),
        F.col("r_name").alias("state"),
        F.date_add(F.lit("2010-01-01").cast("date"), (c % 3650).cast("int")).alias("registration_date"),
        (c % 3 == 0).alias("investor_flag"),
    )


def crm_agents(spark: SparkSession, sf_dir: str, batch: int) -> DataFrame:
    """CRM agents: supplier joined to nation."""
    s = F.col("s_suppkey")
    tier = F.element_at(F.array(*[F.lit(t) for t in TIERS]), (s % 4 + 1).cast("int"))
    if batch >= 2:
        tier = F.when(s % 5 == 0, F.lit("platinum")).otherwise(tier)
    supp = read_table(spark, sf_dir, "supplier")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return supp.join(nation, supp.s_nationkey == nation.n_nationkey, "left").select(
        s.cast("string").alias("agent_id"),
        F.col("s_name").alias("full_name"),
        F.concat(F.lower("s_name"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("Agency "), (s % 20).cast("string")).alias("agency_name"),
        F.concat(F.lit("LIC"), (s + 100000).cast("string")).alias("license_no"),
        F.col("n_name").alias("region"),
        tier.alias("accreditation_tier"),
        F.date_add(F.lit("2005-01-01").cast("date"), (s % 5000).cast("int")).alias("active_from"),
    )


def with_loaded_at(df: DataFrame, batch: int) -> DataFrame:
    """Load audit column (S5) as a batch literal, so reruns are exact."""
    return df.withColumn("_loaded_at", _ts(BATCH_LOADED_AT[batch]))
