"""Tables in parts: what a batch leaves alone, what a failure leaves, what is read."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.operators import merge
from cartwright.operators.history import merge_history
from cartwright.operators.parted import BUCKET, History, Keyed, Monthly, with_bucket
from cartwright.operators.store import Store
from cartwright.plans.warehouse import ts
from cartwright.session import stored

ROWS = "k string, v int, w string"


def data_files(path, layout="rows"):
    out = {}
    for folder, _, names in os.walk(f"{path}/{layout}"):
        for n in names:
            if n.endswith(".parquet"):
                out[os.path.join(folder, n)] = os.path.getmtime(os.path.join(folder, n))
    return out


def live(table, layout="rows"):
    """Files that the newest manifest names, by part."""
    return {f.split("=")[-1].split("/")[0]: f for f in table.layout(layout).inputFiles()}


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def keyed(spark, tmp_path):
    table = Keyed(spark, str(tmp_path / "t"), "k")
    table.ensure(T.StructType.fromDDL(ROWS), buckets=8)
    table.upsert(spark.createDataFrame([(f"k{i}", i, "a") for i in range(200)], ROWS))
    return table


def test_an_upsert_leaves_other_buckets_alone(spark, keyed):
    before, files = live(keyed), data_files(keyed.path)
    batch = spark.createDataFrame([("k7", -7, "b"), ("new", 1, "b")], ROWS)
    touched = {r[0] for r in with_bucket(batch, "k", 8).select(BUCKET).collect()}
    want = rows(merge.upsert(keyed.read(), batch, ["k"], ["v"]))
    assert keyed.upsert(batch, ["v"])
    after = live(keyed)
    assert {b for b in before if before[b] != after[b]} == touched and len(touched) <= 2
    assert rows(keyed.read()) == want and keyed.read().columns == ["k", "v", "w"]
    assert all(data_files(keyed.path)[f] == t for f, t in files.items())
    plan = keyed.layout("rows", sorted(touched))
    assert {f.split("=")[-1].split("/")[0] for f in plan.inputFiles()} == touched


def test_nothing_is_lost_between_write_and_switch(spark, keyed, monkeypatch):
    before, versions = rows(keyed.read()), keyed.versions()

    def stop(manifest):
        raise RuntimeError("stopped")

    monkeypatch.setattr(keyed, "_publish", stop)
    batch = spark.createDataFrame([(f"k{i}", 0, "z") for i in range(0, 300, 3)], ROWS)
    with pytest.raises(RuntimeError):
        keyed.upsert(batch)
    monkeypatch.undo()
    assert rows(keyed.read()) == before and keyed.versions() == versions
    keyed.upsert(batch)
    assert keyed.read().filter("w = 'z'").count() == 100
    keyed.retain(1)
    assert set(data_files(keyed.path)) == {f.removeprefix("file://").replace("file:", "") for f in live(keyed).values()}


def test_a_repeated_batch_makes_no_version(spark, keyed):
    batch = spark.createDataFrame([("k1", 100, "s")], ROWS)
    assert keyed.upsert(batch, None, "stream", 4)
    versions = keyed.versions()
    assert not keyed.upsert(batch, None, "stream", 4) and not keyed.upsert(batch, None, "stream", 3)
    assert keyed.versions() == versions
    # Another stream, as after a lost checkpoint, is not taken for a repetition.
    assert keyed.upsert(spark.createDataFrame([("k1", 5, "s")], ROWS), None, "other", 0)
    assert rows(keyed.read().filter("k = 'k1'")) == [("k1", 5, "s")]


def test_empty_and_unknown(spark, tmp_path):
    table = Keyed(spark, str(tmp_path / "t"), "k")
    assert not table.exists() and table.ensure(T.StructType.fromDDL(ROWS)) and not table.ensure(T.StructType.fromDDL(ROWS))
    assert table.read().collect() == [] and table.read().columns == ["k", "v", "w"]
    batch = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x")], ROWS)
    assert not table.upsert(batch.limit(0)) and table.upsert(batch)
    more = spark.createDataFrame([("b", 2, "y"), ("c", 2, "y")], ROWS)
    assert rows(table.unknown(more)) == [("c", 2, "y")]


def test_the_store_reads_and_cleans_them(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    table = Keyed(spark, f"{store.root}/t", "k")
    table.ensure(T.StructType.fromDDL(ROWS), buckets=2)
    for n in range(5):
        table.upsert(spark.createDataFrame([("a", n, "x")], ROWS))
    assert store.exists("t") and rows(store.read("t")) == [("a", 4, "x")]
    store.retain(2)
    assert len(table.versions()) == 2 and len(data_files(table.path)) == 2 and rows(store.read("t")) == [("a", 4, "x")]


ORDERS = "order_id string, order_month string, v int"


@pytest.fixture
def monthly(spark, tmp_path):
    table = Monthly(spark, str(tmp_path / "m"))
    months = [f"2024-{m:02d}" for m in range(1, 13)]
    table.write(spark.createDataFrame([(f"o{i}", months[i % 12], i) for i in range(240)], ORDERS), buckets=8)
    return table


def test_a_row_leaves_its_old_month_and_other_months_are_not_read(spark, monthly):
    before = live(monthly)
    # o0 and o12 of January: one moves to March, one stays; a new one comes in May.
    batch = stored(spark.createDataFrame([("o0", "2024-03", -1), ("o12", "2024-01", -2), ("new", "2024-05", -3)], ORDERS), "batch")
    assert monthly.replace(batch) == ["2024-01", "2024-03", "2024-05"]
    after = live(monthly)
    assert {m for m in before if before[m] != after[m]} == {"2024-01", "2024-03", "2024-05"}
    got = {r.order_id: (r.order_month, r.v) for r in monthly.read().collect()}
    assert got["o0"] == ("2024-03", -1) and got["o12"] == ("2024-01", -2) and got["new"] == ("2024-05", -3) and len(got) == 241
    # Where the keys are is found without a file of any month.
    found = monthly.months_of(batch)
    assert {r.order_month for r in found.collect()} == {"2024-03", "2024-01", "2024-05"}
    assert found.inputFiles() and not any("/rows/" in f for f in found.inputFiles())


def test_a_stopped_replacement_keeps_rows_and_months_together(spark, monthly, monkeypatch):
    before = rows(monthly.read())
    batch = stored(spark.createDataFrame([("o0", "2024-03", -1)], ORDERS), "batch")
    monkeypatch.setattr(monthly, "_publish", lambda m: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        monthly.replace(batch)
    monkeypatch.undo()
    assert rows(monthly.read()) == before
    assert monthly.replace(batch) == ["2024-01", "2024-03"]
    assert monthly.read().filter("order_id = 'o0'").count() == 1 and monthly.read().count() == 240


def test_a_month_that_empties_goes(spark, tmp_path):
    table = Monthly(spark, str(tmp_path / "m"))
    table.write(spark.createDataFrame([("a", "2024-01", 1), ("b", "2024-02", 1)], ORDERS), indexed=False)
    assert table.replace(spark.createDataFrame([("a", "2024-02", 2)], ORDERS)) == ["2024-01", "2024-02"]
    assert sorted(live(table)) == ["2024-02"] and table.read().count() == 2


DIM = ("customer_sk bigint, customer_id string, signup_date date, country string, valid_from timestamp, "
       "valid_to timestamp, is_current boolean")
STAGED = "customer_id string, signup_date date, country string"


def by_key(df):
    return sorted((r.customer_id, r.customer_sk, r.country, str(r.valid_from), str(r.valid_to), r.is_current) for r in df.collect())


def test_history_is_appended_and_equals_the_merge(spark, tmp_path):
    table = History(spark, str(tmp_path / "d"), "customer_id", "customer_sk", ["country"])
    table.ensure(T.StructType.fromDDL(DIM), buckets=8)
    plain = spark.createDataFrame([], DIM)
    batches = [
        [(f"c{i}", None, "US") for i in range(60)],
        [("c3", None, "DE"), ("c5", None, "US"), ("n1", None, "FR")],
        [("c3", None, None), ("n1", None, "FR")],
        [("c5", None, "US")],
        [("c3", None, "DE"), ("c4", None, None)],
    ]
    closed = set()
    for n, batch in enumerate(batches):
        staged, at = spark.createDataFrame(batch, STAGED), ts(f"2024-01-0{n + 1}")
        plain = stored(merge_history(plain, staged, "customer_id", "customer_sk", ["country"], at), "plain")
        before = set(table.layout("current").inputFiles()) if n else set()
        table.merge(staged, at)
        assert by_key(table.read().select(plain.columns)) == by_key(plain)
        assert by_key(table.current().select(plain.columns)) == by_key(plain.filter("is_current"))
        # Closed rows stay in the files they were written to; few buckets of current rows are written.
        now = set(table.layout("closed").inputFiles())
        assert closed <= now
        closed = now
        if n:
            assert len(before - set(table.layout("current").inputFiles())) <= 2
    assert len(closed) == 3


def test_history_takes_over_a_table_and_keeps_closed_keys_closed(spark, tmp_path):
    day = "2024-01-01 00:00:00"
    dim = spark.createDataFrame([(7, "gone", None, "US", None, None, False), (9, "here", None, "US", None, None, True)], DIM)
    dim = dim.withColumn("valid_from", F.lit(day).cast("timestamp"))
    table = History(spark, str(tmp_path / "d"), "customer_id", "customer_sk", ["country"])
    table.adopt(dim, buckets=4)
    staged = spark.createDataFrame([("gone", None, "DE"), ("here", None, "DE"), ("new", None, "DE")], STAGED)
    want = by_key(merge_history(dim, staged, "customer_id", "customer_sk", ["country"], ts("2024-02-01")))
    assert table.merge(staged, ts("2024-02-01"), "s", 0) and by_key(table.read()) == want
    versions = table.versions()
    assert not table.merge(staged, ts("2024-03-01"), "s", 0) and table.versions() == versions
    assert not table.merge(staged, ts("2024-03-01"), "s", 1) and by_key(table.read()) == want
