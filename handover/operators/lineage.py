"""Key lineage: which source key became which target key, per inserted row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from handover.functions.scalars import json_object, ntz_lit

# Target table names written to the lineage log.
CUSTOMERS = "Customers"
SUPPLIERS = "Suppliers"
PRODUCTS = "Products"
ORDERS = "Orders"
ORDER_DETAILS = "Order Details"

# (target key columns, source key columns) of each load.
LINEAGE_KEYS: dict[str, tuple[list[str], list[str]]] = {
    CUSTOMERS: (["customer_id"], ["entity_id"]),
    SUPPLIERS: (["supplier_id"], ["entity_id"]),
    PRODUCTS: (["product_id"], ["item_id"]),
    ORDERS: (["order_id"], ["batch_id"]),
    ORDER_DETAILS: (["order_id", "product_id"], ["transaction_id"]),
}


def lineage(inserted: DataFrame, table_name: str, inserted_at: dt.datetime) -> DataFrame:
    """(target_key, source_key, table_name, inserted_at) with keys as JSON text."""
    target_keys, source_keys = LINEAGE_KEYS[table_name]
    return inserted.select(
        json_object(**{k: k for k in target_keys}).alias("target_key"),
        json_object(**{k: k for k in source_keys}).alias("source_key"),
        F.lit(table_name).alias("table_name"),
        ntz_lit(inserted_at).alias("inserted_at"),
    )


def insert_log(loaded: dict[str, DataFrame], inserted_at: dt.datetime) -> DataFrame:
    """Lineage of all loads in one frame (``loaded``: table name -> rows with both keys)."""
    parts = [lineage(df, name, inserted_at) for name, df in loaded.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
