"""Work is done once per file or per batch, on narrow rows, and tables nobody reads are not built."""

import os

import pytest
from pyspark.sql import functions as F

from cartwright.catalog import ENTITIES
from cartwright.functions import text
from cartwright.operators import merge
from cartwright.operators import validate as V
from cartwright.operators.store import Store
from cartwright.plans import staging
from cartwright.plans.warehouse import Warehouse, ts
from cartwright.registry import quality as checks
from cartwright.registry import staging as loaded
from cartwright.session import prepare
from cartwright.sources import files, retail
from cartwright.streaming import loads
from conftest import SMALL
from test_files import write
from test_narrow_rows import ODD_IDS, below_exchanges, plan
from test_streaming import line, load  # noqa: F401

needs_tables = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")


def test_methods_are_small_enough_to_be_compiled(spark):
    prepare(spark)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_columns_are_placed_once_per_file(spark, tmp_path):
    write(tmp_path, "customers", "2024-01-01", "a,2024-01-15,US,Organic,New")
    rows = files.read_raw(spark, str(tmp_path), "customers")
    text = plan(rows)
    assert "array_position" in text and "array_position" not in text[:text.index("BroadcastExchange")]


def test_a_batch_is_bound_once(load, tmp_path, monkeypatch):  # noqa: F811
    write(tmp_path / "landing", "orders", "2024-01-01", line("1"), line("2", quantity="-1"))
    seen = []
    check = staging.check
    monkeypatch.setattr(staging, "check", lambda entity, rows: seen.append(plan(rows)) or check(entity, rows))
    load.run(ts("2024-07-01"))
    assert len(seen) == 1 and "arrived-" in seen[0] and "Join" not in seen[0]
    assert load.store.read("stg_orders").count() == 1


@needs_tables
@pytest.mark.parametrize("entity", sorted(retail.NARROW))
def test_files_that_do_not_land_yet_are_left_out_first(spark, entity):
    part = F.col("_day") < F.lit("1998-01-01").cast("date")
    found = retail.raw_by_file(spark, SMALL, entity, part)
    day = retail.raw_by_file(spark, SMALL, entity).withColumn(
        "_day", F.to_date(F.regexp_extract("_source_file", r"(\d{4}/\d{2}/\d{2})", 1), "yyyy/MM/dd"))
    columns = [*ENTITIES[entity].columns, "_source_file"]
    slow = day.filter(part).select(*columns)
    assert "1998-01-01" in below_exchanges(found)
    assert 0 < found.count() == slow.count() < day.count() and found.select(*columns).exceptAll(slow).isEmpty()


def test_the_newest_rows_move_with_packed_identifiers(raw):
    batch = staging.check("orders", raw("orders"))
    assert "unhex(" in below_exchanges(batch.newest(ts("2024-07-01")))
    assert dict(batch.newest(ts("2024-07-01")).dtypes)["order_id"] == "string"


SCHEMA = "k string, a int, b string"


@pytest.mark.parametrize("updated", [None, ["a"], ["a", "b"]])
def test_one_join_gives_the_rows_of_an_upsert(spark, updated):
    target = spark.createDataFrame([("1", 1, "x"), ("2", None, "y"), ("3", 3, None)], SCHEMA)
    source = spark.createDataFrame([("2", 20, None), ("3", None, "z"), ("4", 40, "w")], SCHEMA)
    want = merge.upsert(target, source, ["k"], updated)
    found = merge.upsert_in_one_join(target, source, ["k"], updated)
    assert found.columns == want.columns and sorted(map(str, found.collect())) == sorted(map(str, want.collect()))


@needs_tables
def test_a_load_stores_neither_orders_nor_its_batch(spark):
    w = Warehouse(spark, SMALL)
    shared = os.path.dirname(w.root.removeprefix("file:"))
    before = set(os.listdir(shared))
    merged = loaded._load("orders")(w)
    assert merged.count() > 0 and not os.path.exists(f"{w.root.removeprefix('file:')}/stg_orders")
    assert not [n for n in set(os.listdir(shared)) - before if n.startswith("batch-")]


def test_rows_beside_many_repeated_keys_move_packed(spark, monkeypatch):
    monkeypatch.setattr(V, "FEW", 0)
    ids = [i for i in ODD_IDS if i] + [ODD_IDS[0], "a"]
    rows = [(i, "f", n) for n, i in enumerate(ids)] + [(None, "f", 90), (None, "f", 91), (ODD_IDS[0], "g", 92)]
    df = spark.createDataFrame(rows, "order_id string, _source_file string, n int")
    found = V.flag_repeated(df, "order_id", "failed")
    assert "unhex(" in below_exchanges(found)
    assert {r.n: (r.order_id, r.failed) for r in found.collect()} == {
        n: (i, f == "f" and i in (ODD_IDS[0], "a")) for i, f, n in rows}


def test_stripping_looks_at_both_ends(spark):
    words = ["a", " a", "a ", "\ta b\n", "　a", "a ", "é", " é", "", " ", "~", "!a!", "\x7fa", None, "a\x1f"]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string")
    got = df.select("i", text.strip(F.col("w")).alias("s"), F.btrim("w", F.lit(text.WHITE_SPACE)).alias("t")).collect()
    assert all(r.s == r.t for r in got)


@needs_tables
def test_payment_dates_are_checked_without_order_facts(spark):
    w = Warehouse(spark, SMALL)
    assert checks.orphan_payment_date(w).count() > 0
    built = os.listdir(w.root.removeprefix("file:"))
    assert not [n for n in built if n.startswith(("fact_orders", "stg_orders", "dim_customers", "stg_returns"))]


@needs_tables
@pytest.mark.parametrize("check", [checks.orphan_customer, checks.orphan_product, checks.orphan_order_date])
def test_a_column_of_the_order_facts_needs_no_stored_facts(spark, check):
    w = Warehouse(spark, SMALL)
    found = check(w)
    columns = found.columns
    rows = sorted(map(tuple, found.collect()), key=str)
    assert not [n for n in os.listdir(w.root.removeprefix("file:")) if n.startswith(("fact_orders", "stg_orders"))]
    w["fact_orders_asof"]
    again = check(w).select(*columns)
    assert "fact_orders_asof" in plan(again) and rows == sorted(map(tuple, again.collect()), key=str)
