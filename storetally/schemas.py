"""Declared schemas of the model tables."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

TYPES = {
    "int": IntegerType(),
    "bigint": LongType(),
    "string": StringType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "timestamp": TimestampType(),
    "timestamp_ntz": TimestampNTZType(),
}


def declared(**columns: str) -> StructType:
    schema = StructType()
    for name, kind in columns.items():
        schema = schema.add(name, TYPES[kind])
    return schema


STORES = declared(
    store_id="bigint",
    store_type="string",
    region="string",
    state="string",
    city="string",
    zip_code="string",
    square_footage="bigint",
    opening_date="timestamp",
    manager_id="string",
    phone="string",
)

PRODUCTS = declared(
    sku="string",
    product_name="string",
    category="string",
    brand="string",
    sheen="string",
    size="string",
    color_name="string",
    base_price="double",
    cost="double",
    weight_lbs="double",
    is_hazmat="boolean",
    vendor_id="string",
    launch_date="timestamp",
)

TRANSACTIONS = declared(
    transaction_id="bigint",
    store_id="bigint",
    customer_id="string",
    customer_segment="string",
    timestamp="timestamp",
    date="date",
    hour="bigint",
    day_of_week="bigint",
    month="bigint",
    quarter="bigint",
    year="bigint",
    subtotal="double",
    tax_amount="double",
    total_amount="double",
    payment_method="string",
    employee_id="string",
    is_return="boolean",
    loyalty_member="boolean",
    channel="string",
)

ITEMS = declared(
    transaction_id="bigint",
    item_sequence="bigint",
    sku="string",
    quantity="bigint",
    unit_price="double",
    line_total="double",
    discount_amount="double",
)

FLAT = declared(
    customer_id="string",
    store_id="bigint",
    customer_segment="string",
    product_category="string",
    region="string",
    state="string",
    quantity="bigint",
    unit_price="double",
    transaction_total="double",
    transaction_date="timestamp",
)

# Columns the analyses cannot do without; the others may be absent.
REQUIRED = {
    "stores": ["store_id", "region", "state"],
    "products": ["sku", "category"],
    "transactions": ["store_id", "customer_id", "customer_segment", "timestamp", "date", "total_amount"],
    "items": ["transaction_id", "sku", "quantity", "unit_price", "line_total"],
    "flat": ["customer_id", "store_id", "transaction_total"],
}
DECLARED = {
    "stores": STORES,
    "products": PRODUCTS,
    "transactions": TRANSACTIONS,
    "items": ITEMS,
    "flat": FLAT,
}
