"""Explicit schemas of the bronze layer (no inference anywhere).

Timestamps are ``timestamp_ntz``: the source system's ``timestamp`` has no
time zone, and neither does the value we keep.
"""

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

MONEY = DecimalType(14, 2)
AREA = DecimalType(18, 2)

TRANSACTION_FIELDS = [
    StructField("transaction_id", StringType()),
    StructField("property_id", StringType()),
    StructField("sale_price", MONEY),
    StructField("sale_date", DateType()),
    StructField("buyer_id", StringType()),
    StructField("seller_id", StringType()),
    StructField("agent_id", StringType()),
    StructField("sale_type", StringType()),
    StructField("settlement_date", DateType()),
    StructField("days_on_market", IntegerType()),
]

PROPERTY_FIELDS = [
    StructField("address", StringType()),
    StructField("suburb", StringType()),
    StructField("postcode", StringType()),
    StructField("state", StringType()),
    StructField("bedrooms", IntegerType()),
    StructField("bathrooms", IntegerType()),
    StructField("land_size_sqm", AREA),
    StructField("property_type", StringType()),
    StructField("year_built", IntegerType()),
    StructField("listing_price", MONEY),
]

LOADED_AT = StructField("_loaded_at", TimestampNTZType())

# The wide raw feed: one row per transaction joined to its property.
PROPERTY_RAW_CSV = StructType(TRANSACTION_FIELDS + PROPERTY_FIELDS)
PROPERTY_RAW = StructType(TRANSACTION_FIELDS + PROPERTY_FIELDS + [LOADED_AT])

CRM_OWNERS = StructType([
    StructField("owner_id", StringType()),
    StructField("full_name", StringType()),
    StructField("email", StringType()),
    StructField("phone", StringType()),
    StructField("suburb", StringType()),
    StructField("state", StringType()),
    StructField("registration_date", DateType()),
    StructField("investor_flag", BooleanType()),
])

CRM_AGENTS = StructType([
    StructField("agent_id", StringType()),
    StructField("full_name", StringType()),
    StructField("email", StringType()),
    StructField("agency_name", StringType()),
    StructField("license_no", StringType()),
    StructField("region", StringType()),
    StructField("accreditation_tier", StringType()),
    StructField("active_from", DateType()),
])

BRONZE_OWNERS = StructType(CRM_OWNERS.fields + [LOADED_AT])
BRONZE_AGENTS = StructType(CRM_AGENTS.fields + [LOADED_AT])
