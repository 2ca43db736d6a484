"""What the seven entities and the star schema look like, and each entity's rules.

An entity is described once, by an ``EntitySpec``; validation, cleaning and
loading all read the description. Supporting another entity means adding one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from .functions.text import DECIMAL_PATTERN, INTEGER_PATTERN

_TYPES = {
    "text": T.StringType(),
    "upper": T.StringType(),
    "title": T.StringType(),
    "day": T.DateType(),
    "utc": T.TimestampType(),
    "int": T.IntegerType(),
    "money": T.DecimalType(12, 2),
    "daily_money": T.DecimalType(15, 2),
}


@dataclass(frozen=True)
class EntitySpec:
    """One raw entity.

    ``columns`` maps each column, in file order, to how it is cleaned.
    ``required``, ``patterns`` and ``allowed`` are the validation rules; the key
    must also be a well-formed identifier and unique within its file.
    ``references`` are identifier columns the staging table types as such.
    ``timestamps`` must parse, because a fact table needs them.
    ``updated`` are the columns an upsert overwrites; the others keep the value
    the row had when it was first seen.
    """

    name: str
    key: str
    columns: dict[str, str]
    required: tuple[str, ...]
    updated: tuple[str, ...]
    patterns: dict[str, str] = field(default_factory=dict)
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)
    references: tuple[str, ...] = ()
    timestamps: tuple[str, ...] = ()

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    @property
    def staging_schema(self) -> T.StructType:
        fields = [T.StructField(c, _TYPES[kind]) for c, kind in self.columns.items()]
        return T.StructType(
            fields
            + [T.StructField("_loaded_at", T.TimestampType()), T.StructField("_source_file", T.StringType())]
        )


# Columns, required columns, formats and allow-lists per entity.
ENTITIES = {
    spec.name: spec
    for spec in (
        EntitySpec(
            name="customers",
            key="customer_id",
            columns={
                "customer_id": "text",
                "signup_date": "day",
                "country": "upper",
                "acquisition_channel": "title",
                "customer_segment": "title",
            },
            required=("customer_id", "signup_date", "country", "acquisition_channel", "customer_segment"),
            allowed={
                "acquisition_channel": ("Organic", "Facebook", "Google", "Email"),
                "customer_segment": ("New", "Returning", "VIP"),
            },
            updated=("signup_date", "country", "acquisition_channel", "customer_segment"),
        ),
        EntitySpec(
            name="products",
            key="product_id",
            columns={
                "product_id": "text",
                "product_name": "text",
                "category": "title",
                "cost_price": "money",
                "selling_price": "money",
                "inventory_quantity": "int",
            },
            required=(
                "product_id", "product_name", "category", "cost_price", "selling_price", "inventory_quantity",
            ),
            patterns={
                "cost_price": DECIMAL_PATTERN,
                "selling_price": DECIMAL_PATTERN,
                "inventory_quantity": INTEGER_PATTERN,
            },
            updated=("product_name", "category", "cost_price", "selling_price", "inventory_quantity"),
        ),
        EntitySpec(
            name="orders",
            key="order_id",
            columns={
                "order_id": "text",
                "customer_id": "text",
                "product_id": "text",
                "quantity": "int",
                "unit_price": "money",
                "total_amount": "money",
                "order_timestamp": "utc",
                "payment_method": "text",
                "order_status": "title",
            },
            required=(
                "order_id", "customer_id", "product_id", "quantity", "unit_price", "total_amount",
                "order_timestamp",
            ),
            patterns={
                "unit_price": DECIMAL_PATTERN,
                "total_amount": DECIMAL_PATTERN,
                "quantity": INTEGER_PATTERN,
            },
            allowed={"order_status": ("Pending", "Completed", "Cancelled", "Refunded")},
            references=("customer_id", "product_id"),
            timestamps=("order_timestamp",),
            updated=(
                "customer_id", "product_id", "quantity", "unit_price", "total_amount", "order_timestamp",
                "payment_method", "order_status",
            ),
        ),
        EntitySpec(
            name="payments",
            key="payment_id",
            columns={
                "payment_id": "text",
                "order_id": "text",
                "payment_date": "utc",
                "payment_method": "text",
                "amount": "money",
                "payment_status": "title",
            },
            required=("payment_id", "order_id", "payment_date", "payment_method", "amount", "payment_status"),
            patterns={"amount": DECIMAL_PATTERN},
            allowed={"payment_status": ("Successful", "Failed", "Pending")},
            references=("order_id",),
            updated=("order_id", "payment_date", "payment_method", "amount", "payment_status"),
        ),
        EntitySpec(
            name="inventory",
            key="inventory_id",
            columns={
                "inventory_id": "text",
                "product_id": "text",
                "warehouse_location": "text",
                "quantity_on_hand": "int",
                "last_restock_date": "day",
            },
            required=(
                "inventory_id", "product_id", "warehouse_location", "quantity_on_hand", "last_restock_date",
            ),
            patterns={"quantity_on_hand": INTEGER_PATTERN},
            references=("product_id",),
            updated=("quantity_on_hand", "last_restock_date"),
        ),
        EntitySpec(
            name="revenue",
            key="revenue_id",
            columns={
                "revenue_id": "text",
                "record_date": "day",
                "total_revenue": "daily_money",
                "total_profit": "daily_money",
            },
            required=("revenue_id", "record_date", "total_revenue", "total_profit"),
            patterns={"total_revenue": DECIMAL_PATTERN, "total_profit": DECIMAL_PATTERN},
            updated=("total_revenue", "total_profit"),
        ),
        EntitySpec(
            name="returns",
            key="return_id",
            columns={
                "return_id": "text",
                "order_id": "text",
                "return_date": "utc",
                "return_reason": "title",
                "refund_amount": "money",
                "return_status": "title",
            },
            required=("return_id", "order_id", "return_date", "return_reason", "refund_amount", "return_status"),
            patterns={"refund_amount": DECIMAL_PATTERN},
            allowed={
                "return_reason": ("Defective", "Wrong Item", "Changed Mind"),
                "return_status": ("Processed", "Pending", "Rejected"),
            },
            references=("order_id",),
            updated=("order_id", "return_date", "return_reason", "refund_amount", "return_status"),
        ),
    )
}


def spec_for(entity: str) -> EntitySpec:
    try:
        return ENTITIES[entity]
    except KeyError:
        raise ValueError(f"unknown entity: {entity!r}") from None


# Column lists of the star schema and the load ledger, as DDL.
ANALYTICS = {
    "dim_date": "date_key int, full_date date, day_of_week smallint, day_name string, "
    "day_of_month smallint, day_of_year smallint, week_of_year smallint, month_number smallint, "
    "month_name string, quarter smallint, year smallint, is_weekend boolean",
    "dim_customers": "customer_sk bigint, customer_id string, signup_date date, country string, "
    "acquisition_channel string, customer_segment string, valid_from timestamp, valid_to timestamp, "
    "is_current boolean",
    "dim_products": "product_sk bigint, product_id string, product_name string, category string, "
    "cost_price decimal(12,2), selling_price decimal(12,2), valid_from timestamp, valid_to timestamp, "
    "is_current boolean",
    "dim_inventory": "inventory_sk bigint, inventory_id string, product_id string, "
    "warehouse_location string, quantity_on_hand int, last_restock_date date, updated_at timestamp",
    "fact_orders": "order_id string, customer_sk bigint, product_sk bigint, date_key int, "
    "order_timestamp timestamp, quantity int, revenue decimal(12,2), profit decimal(12,2), "
    "order_status string, payment_method string",
    "fact_payments": "payment_id string, order_id string, date_key int, payment_date timestamp, "
    "payment_method string, amount decimal(12,2), payment_status string",
    "fact_returns": "return_id string, order_id string, date_key int, return_date timestamp, "
    "refund_amount decimal(12,2), return_reason string, return_status string",
    "agg_revenue": "record_date date, total_revenue decimal(38,2), total_profit decimal(38,2), "
    "total_orders int, updated_at timestamp",
}

LEDGER = (
    "object_path string, entity string, processed_at timestamp, row_count bigint, "
    "quarantine_count bigint, status string"
)
