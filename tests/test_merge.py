import pytest
from pyspark.sql import functions as F

from cartwright.operators import merge
from cartwright.plans import staging


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def tables(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, None, "z")], "k int, v string, w string")
    source = spark.createDataFrame([(2, "B", "Y"), (3, None, "Z"), (4, "D", "W")], "k int, v string, w string")
    return target, source


def test_upsert_all_columns(tables):
    assert rows(merge.upsert(*tables, ["k"])) == [(1, "a", "x"), (2, "B", "Y"), (3, None, "Z"), (4, "D", "W")]


def test_upsert_listed_columns_only(tables):
    assert rows(merge.upsert(*tables, ["k"], ["w"])) == [(1, "a", "x"), (2, "b", "Y"), (3, None, "Z"), (4, "D", "W")]


def test_upsert_can_write_a_null(spark, tables):
    source = spark.createDataFrame([(1, None, "q")], "k int, v string, w string")
    assert (1, None, "x") in rows(merge.upsert(tables[0], source, ["k"], ["v"]))


def test_upsert_of_nothing_and_into_nothing(tables):
    target, source = tables
    assert rows(merge.upsert(target, source.limit(0), ["k"], ["v"])) == rows(target)
    assert rows(merge.upsert(target.limit(0), source, ["k"], ["v"])) == rows(source)


def test_upsert_twice_is_once(tables):
    target, source = tables
    once = merge.upsert(target, source, ["k"], ["v"])
    assert rows(merge.upsert(once, source, ["k"], ["v"])) == rows(once)


def test_insert_ignore(tables):
    assert rows(merge.insert_ignore(*tables, ["k"])) == [(1, "a", "x"), (2, "b", "y"), (3, None, "z"), (4, "D", "W")]


def test_delete_insert(tables):
    target, source = tables
    assert rows(merge.delete_insert(target, source, ["k"])) == [(1, "a", "x"), (2, "B", "Y"), (3, None, "Z"), (4, "D", "W")]
    only = source.filter("k = 4")
    assert rows(merge.delete_insert(target, only, ["k"], deleted=source)) == [(1, "a", "x"), (4, "D", "W")]


def test_update_from(tables):
    target, source = tables
    got = merge.update_from(target, source, ["k"], {"w": F.col("s_w")}, where=F.col("v").isNotNull())
    assert rows(got) == [(1, "a", "x"), (2, "b", "Y"), (3, None, "z")]


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [(1, 5, "a"), (1, 7, "b"), (2, None, "c"), (2, 1, "d"), (3, 1, "e"), (3, 1, "f")], "k int, t int, v string"
    )
    assert rows(merge.latest_per_key(df, ["k"], ["t"])) == [(1, 7, "b"), (2, 1, "d"), (3, 1, "f")]


@pytest.mark.parametrize("entity, kept", [("inventory", "warehouse_location"), ("revenue", "record_date")])
def test_load_keeps_columns_that_are_not_updated(raw, entity, kept):
    at = F.lit("2024-01-01").cast("timestamp")
    first = staging.check(entity, raw(entity)).newest(at)
    change = {"warehouse_location": "Elsewhere"} if entity == "inventory" else {"record_date": "2020-02-02"}
    second = staging.check(entity, raw(entity, file="g.csv", **change)).newest(at + F.expr("interval 1 day"))
    before, after = first.first(), staging.load(entity, first, second).first()
    assert after[kept] == before[kept]
    assert after._source_file == "g.csv" and after._loaded_at > before._loaded_at


def test_later_file_wins(raw):
    from conftest import ROWS

    files = [dict(ROWS["orders"][0], order_status=s, _source_file=f)
             for f, s in (("orders/2.csv", "Refunded"), ("orders/1.csv", "Pending"))]
    newest = staging.check("orders", raw("orders", rows=files)).newest(F.current_timestamp()).collect()
    assert [r.order_status for r in newest] == ["Refunded"]


def test_unknown_entity(tables):
    with pytest.raises(ValueError, match="No loader defined"):
        staging.load("suppliers", *tables)
