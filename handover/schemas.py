"""Declared schemas of the staging, target, lineage and audit tables."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _s(*fields: tuple[str, object, bool]) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


# Source (legacy) tables as extracted: ids of growing tables are longs, values are text.
LOCATIONS = _s(
    ("location_id", IntegerType(), False),
    ("street_addr", StringType(), True),
    ("municipality", StringType(), True),
    ("region_code", StringType(), True),
    ("postal_code", StringType(), True),
)
ENTITIES = _s(
    ("entity_id", LongType(), False),
    ("entity_label", StringType(), False),
    ("type_flag", StringType(), True),
    ("location_ref", IntegerType(), True),
    ("contact_info", StringType(), True),
)
ITEMS = _s(
    ("item_id", LongType(), False),
    ("label", StringType(), False),
    ("source_ref", LongType(), True),
    ("group_ref", IntegerType(), True),
    ("cost", StringType(), True),
    ("qty_available", IntegerType(), True),
)
BATCHES = _s(
    ("batch_id", LongType(), False),
    ("batch_date", LongType(), False),
    ("reference_id", LongType(), True),
    ("total_value", StringType(), True),
)
TRANSACTIONS = _s(
    ("transaction_id", LongType(), False),
    ("batch_ref", LongType(), True),
    ("item_ref", LongType(), True),
    ("partner_ref", LongType(), True),
    ("qty", IntegerType(), True),
    ("date_key", LongType(), True),
    ("amount", StringType(), True),
)

SOURCE_SCHEMAS: dict[str, StructType] = {
    "locations": LOCATIONS,
    "entities": ENTITIES,
    "items": ITEMS,
    "batches": BATCHES,
    "transactions": TRANSACTIONS,
}

# Primary key of each staging table.
SOURCE_KEYS: dict[str, str] = {
    "locations": "location_id",
    "entities": "entity_id",
    "items": "item_id",
    "batches": "batch_id",
    "transactions": "transaction_id",
}

# Quality columns appended on staging.
QUALITY_FIELDS = [
    StructField("is_valid", BooleanType(), False),
    StructField("validation_error", StringType(), True),
    StructField("load_timestamp", TimestampNTZType(), True),
]

# Declared text lengths (varchar(n)/char(n)) and NOT NULL columns of staging.
# Fixed values from the staging DDL.
MAX_LENGTHS: dict[str, dict[str, int]] = {
    "batches": {"total_value": 15},
    "entities": {"entity_label": 100, "type_flag": 1, "contact_info": 20},
    "items": {"label": 100, "cost": 10},
    "locations": {"street_addr": 100, "municipality": 50, "region_code": 2, "postal_code": 10},
    "transactions": {"amount": 10},
}
NOT_NULL: dict[str, list[str]] = {
    "batches": ["batch_id", "batch_date"],
    "entities": ["entity_id", "entity_label"],
    "items": ["item_id", "label"],
    "locations": ["location_id"],
    "transactions": ["transaction_id"],
}

# Target (order system) tables the migration writes.
CUSTOMERS = _s(
    ("customer_id", StringType(), False),
    ("company_name", StringType(), False),
    ("contact_name", StringType(), True),
    ("phone", StringType(), True),
    ("address", StringType(), True),
    ("city", StringType(), True),
    ("region", StringType(), True),
    ("postal_code", StringType(), True),
    ("country", StringType(), True),
)
SUPPLIERS = _s(
    ("supplier_id", LongType(), False),
    ("company_name", StringType(), False),
    ("phone", StringType(), True),
    ("address", StringType(), True),
    ("city", StringType(), True),
    ("region", StringType(), True),
    ("postal_code", StringType(), True),
    ("country", StringType(), True),
)
