import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cartwright.functions.numbers import to_int, to_money
from cartwright.functions.text import na_to_null, name_uuid, strip, title_case, zero_padded
from cartwright.functions.times import to_day, to_utc
from cartwright.operators.clean import clean


def one(raw, entity, column, **changes):
    return clean(entity, raw(entity, **changes)).collect()[0][column]


def column_of(spark, fn, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("c"))).collect()]


@pytest.mark.parametrize(
    "entity, column, value, expected",
    [
        ("customers", "country", "  US  ", "US"),
        ("customers", "country", "de", "DE"),
        ("customers", "customer_segment", "vip", "Vip"),
        ("customers", "acquisition_channel", "EMAIL", "Email"),
        ("customers", "signup_date", "2024-01-15", dt.date(2024, 1, 15)),
        ("customers", "signup_date", "not-a-date", None),
        ("products", "selling_price", "89.999999", Decimal("90.00")),
        ("products", "cost_price", "45.00", Decimal("45.00")),
        ("products", "inventory_quantity", "200", 200),
        ("products", "category", "home goods", "Home Goods"),
        ("orders", "order_status", "completed", "Completed"),
        ("orders", "quantity", "many", 0),
        ("orders", "total_amount", "179.98", Decimal("179.98")),
        ("payments", "payment_status", " failed ", "Failed"),
        ("payments", "amount", "x", None),
        ("inventory", "last_restock_date", "invalid-date", None),
        ("inventory", "quantity_on_hand", "500", 500),
        ("revenue", "total_profit", "4200.005", Decimal("4200.01")),
        ("revenue", "record_date", "2024-06-15", dt.date(2024, 6, 15)),
        ("returns", "return_reason", "defective", "Defective"),
        ("returns", "return_reason", "wrong item", "Wrong Item"),
        ("returns", "refund_amount", "89.99", Decimal("89.99")),
    ],
)
def test_column(raw, entity, column, value, expected):
    assert one(raw, entity, column, **{column: value}) == expected


def test_timestamps_are_utc(spark, raw):
    df = clean("orders", raw("orders", order_timestamp="2024-06-15T16:23:00+02:00"))
    assert df.select(F.date_format("order_timestamp", "yyyy-MM-dd HH:mm")).first()[0] == "2024-06-15 14:23"


def test_strip_all_white_space(spark):
    assert column_of(spark, strip, " a\t", "\n b ", "c d", "", None) == ["a", "b", "c d", "", None]


def test_title_case(spark):
    got = column_of(spark, title_case, "VIP", "men's e-MAIL kit", "3rd floor", "a1b", "", None)
    assert got == ["Vip", "Men'S E-Mail Kit", "3Rd Floor", "A1B", "", None]


def test_numbers(spark):
    assert column_of(spark, to_money, "1.005", "2.345", "-1", "1e3", "1.5f", "NaN", "", None, "99999999999") == [
        Decimal("1.01"), Decimal("2.35"), Decimal("-1.00"), Decimal("1000.00"), None, None, None, None, None]
    assert column_of(spark, to_int, "12.7", "-3", "x", None, "", "1d", "99999999999") == [12, -3, 0, 0, 0, 0, 0]


def test_times(spark):
    assert column_of(spark, to_day, "2024-02-30", "2024-02-29", "12:30", "T1:2", "1:20", None) == [
        None, dt.date(2024, 2, 29), None, None, None, None]
    got = column_of(spark, lambda c: F.date_format(to_utc(c), "yyyyMMddHHmmss"), "2024", "2024-06-15", "10:00", "x")
    assert got == ["20240101000000", "20240615000000", None, None]


def test_missing_tokens(spark):
    got = column_of(spark, na_to_null, "", "NA", "null", "None", "nan", "n/a", "#N/A", " ", "na", "US")
    assert got == [None] * 7 + [" ", "na", "US"]


def test_identifiers_and_padding(spark):
    got = column_of(spark, lambda c: name_uuid("order", c), "1", "1")
    assert got[0] == got[1] and len(got[0]) == 36 and [got[0][i] for i in (8, 13, 18, 23)] == ["-"] * 4
    assert column_of(spark, lambda c: zero_padded(c, 3), "7", "123", "12345") == ["007", "123", "12345"]


def test_unknown_entity(raw):
    with pytest.raises(ValueError, match="No cleaner defined"):
        clean("suppliers", raw("customers"))
