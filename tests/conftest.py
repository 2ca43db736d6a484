import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartwright.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", **{
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.sql.maxMetadataStringLength": "10000",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# One or two clean rows per entity, all text.
CUSTOMER = "a1b2c3d4-e5f6-7890-abcd-ef1234567890"
CUSTOMER_2 = "b2c3d4e5-f6a7-8901-bcde-f12345678901"
PRODUCT = "c3d4e5f6-a7b8-9012-cdef-123456789012"
ORDER = "d4e5f6a7-b8c9-0123-defa-234567890123"

ROWS = {
    "customers": [
        dict(customer_id=CUSTOMER, signup_date="2024-01-15", country="US", acquisition_channel="Organic",
             customer_segment="New"),
        dict(customer_id=CUSTOMER_2, signup_date="2024-03-22", country="UK", acquisition_channel="Google",
             customer_segment="VIP"),
    ],
    "products": [
        dict(product_id=PRODUCT, product_name="Wireless Headphones", category="Electronics", cost_price="45.00",
             selling_price="89.99", inventory_quantity="200"),
    ],
    "orders": [
        dict(order_id=ORDER, customer_id=CUSTOMER, product_id=PRODUCT, quantity="2", unit_price="89.99",
             total_amount="179.98", order_timestamp="2024-06-15T14:23:00Z", payment_method="Credit Card",
             order_status="Completed"),
    ],
    "payments": [
        dict(payment_id="e5f6a7b8-c9d0-1234-efab-345678901234", order_id=ORDER, payment_date="2024-06-15T14:25:00Z",
             payment_method="Credit Card", amount="179.98", payment_status="Successful"),
    ],
    "inventory": [
        dict(inventory_id="f6a7b8c9-d0e1-2345-fabc-456789012345", product_id=PRODUCT,
             warehouse_location="New York, US", quantity_on_hand="500", last_restock_date="2024-05-01"),
    ],
    "revenue": [
        dict(revenue_id="a7b8c9d0-e1f2-3456-abcd-567890123456", record_date="2024-06-15", total_revenue="12500.00",
             total_profit="4200.00"),
    ],
    "returns": [
        dict(return_id="b8c9d0e1-f2a3-4567-bcde-678901234567", order_id=ORDER, return_date="2024-06-20T10:00:00Z",
             return_reason="Defective", refund_amount="89.99", return_status="Processed"),
    ],
}


@pytest.fixture
def raw(spark):
    """``raw(entity, **changes)``: the clean rows with columns of the first one replaced."""
    from cartwright.catalog import ENTITIES

    def make(entity, rows=None, file="f.csv", **changes):
        rows = [dict(r) for r in (ROWS[entity] if rows is None else rows)]
        rows[0].update(changes)
        columns = list(ENTITIES[entity].columns)
        ddl = ", ".join(f"{c} string" for c in columns) + ", _source_file string, _row int"
        data = [tuple(r[c] for c in columns) + (r.get("_source_file", file), i) for i, r in enumerate(rows)]
        return spark.createDataFrame(data, ddl)

    return make
