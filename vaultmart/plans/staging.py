"""Silver layer: typed, null-cleaned entities with hash keys and hashdiffs.

The wide raw feed is split in two entities (transactions, properties); the
CRM tables map one to one.  Only properties are deduplicated (latest load
per business key); the hashdiff is its deterministic tie-break.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultmart.functions.hashing import hash_key, hash_key_sql, hashdiff_sql
from vaultmart.operators.keys import first_per_key

# Record sources of the staged entities.
RECORD_SOURCE_RAW = "bronze.property_raw"
RECORD_SOURCE_OWNERS = "src_crm.owners"
RECORD_SOURCE_AGENTS = "src_crm.agents"

# The column each staged entity's hash key is made of.
BUSINESS_KEYS = {"stg_transactions": "transaction_id", "stg_properties": "property_id",
                 "stg_owners": "owner_id", "stg_agents": "agent_id"}
# Per staged entity the columns that its other columns determine, last in the table, as SQL: they are computed
# where they are read, since an MD5 in hex takes more room than what it is made of.
DERIVED = {
    "stg_transactions": {
        "property_hk": hash_key_sql("property_id"), "buyer_hk": hash_key_sql("buyer_id"),
        "seller_hk": hash_key_sql("seller_id"), "agent_hk": hash_key_sql("agent_id"),
        "hashdiff": hashdiff_sql(["sale_price", "sale_date", "settlement_date", "days_on_market", "sale_type"])},
    "stg_properties": {
        "hashdiff": hashdiff_sql(["address", "suburb", "postcode", "state", "bedrooms", "bathrooms", "land_size_sqm",
                                  "property_type", "year_built", "listing_price"],
                                 null_as_empty=("address", "suburb", "postcode", "state", "property_type"))},
    "stg_owners": {
        "hashdiff": hashdiff_sql(["full_name", "email", "phone", "suburb", "state", "registration_date", "investor_flag"],
                                 null_as_empty=("full_name", "email", "phone", "suburb", "state"))},
    "stg_agents": {
        "hashdiff": hashdiff_sql(["full_name", "email", "agency_name", "license_no", "region", "accreditation_tier", "active_from"],
                                 null_as_empty=("full_name", "email", "agency_name", "license_no", "region", "accreditation_tier"))},
}


def _with_hashes(typed: DataFrame, entity: str, hk: str) -> DataFrame:
    derived = {hk: hash_key(BUSINESS_KEYS[entity]), **{c: F.expr(sql) for c, sql in DERIVED[entity].items()}}
    return typed.select("*", *[col.alias(name) for name, col in derived.items()])


def _load_date():
    return F.col("_loaded_at").cast("timestamp_ntz").alias("load_date")


def stg_transactions(raw: DataFrame) -> DataFrame:
    typed = raw.where(F.col("transaction_id").isNotNull()).select(
        "transaction_id", "property_id", "buyer_id", "seller_id", "agent_id",
        F.col("sale_price").cast("decimal(14,2)").alias("sale_price"),
        F.col("sale_date").cast("date").alias("sale_date"),
        F.col("settlement_date").cast("date").alias("settlement_date"),
        F.col("days_on_market").cast("int").alias("days_on_market"),
        F.coalesce(F.col("sale_type"), F.lit("unknown")).alias("sale_type"),
        F.lit(RECORD_SOURCE_RAW).alias("record_source"),
        _load_date(),
    )
    return _with_hashes(typed, "stg_transactions", "transaction_hk")


def stg_properties(raw: DataFrame) -> DataFrame:
    typed = raw.where(F.col("property_id").isNotNull()).select(
        "property_id", "address", "suburb", "postcode", "state",
        F.col("bedrooms").cast("int").alias("bedrooms"),
        F.col("bathrooms").cast("int").alias("bathrooms"),
        F.col("land_size_sqm").cast("decimal(18,2)").alias("land_size_sqm"),
        "property_type",
        F.col("year_built").cast("int").alias("year_built"),
        F.col("listing_price").cast("decimal(14,2)").alias("listing_price"),
        _load_date(),
        F.lit(RECORD_SOURCE_RAW).alias("record_source"),
    )
    # one row per distinct version first: a hash aggregate that combines map-side, so the hashes
    # and the sort below see a few rows per property, not one per sale
    staged = _with_hashes(typed.distinct(), "stg_properties", "property_hk")
    # latest load per property; PostgreSQL sorts nulls first in descending order
    return first_per_key(staged, ["property_id"],
                         [F.col("load_date").desc_nulls_first(), F.col("hashdiff").asc()])


def stg_owners(owners: DataFrame) -> DataFrame:
    typed = owners.where(F.col("owner_id").isNotNull()).select(
        "owner_id", "full_name", "email", "phone", "suburb", "state",
        F.col("registration_date").cast("date").alias("registration_date"),
        F.col("investor_flag").cast("boolean").alias("investor_flag"),
        _load_date(),
        F.lit(RECORD_SOURCE_OWNERS).alias("record_source"),
    )
    return _with_hashes(typed, "stg_owners", "owner_hk")


def stg_agents(agents: DataFrame) -> DataFrame:
    typed = agents.where(F.col("agent_id").isNotNull()).select(
        "agent_id", "full_name", "email", "agency_name", "license_no", "region",
        "accreditation_tier",
        F.col("active_from").cast("date").alias("active_from"),
        _load_date(),
        F.lit(RECORD_SOURCE_AGENTS).alias("record_source"),
    )
    return _with_hashes(typed, "stg_agents", "agent_hk")
