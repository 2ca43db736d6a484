import pytest
from pyspark.sql import functions as F

from cartwright.catalog import ENTITIES, LEDGER
from cartwright.operators.store import Store
from cartwright.plans import staging
from cartwright.session import fresh_dir, shared_dir
from cartwright.sources import files, sinks
from conftest import PRODUCT, ROWS


def write(folder, entity, day, *lines):
    y, m, d = day.split("-")
    path = folder / f"entity={entity}" / f"yyyy={y}" / f"mm={m}" / f"dd={d}"
    path.mkdir(parents=True, exist_ok=True)
    (path / f"{entity}_{y}{m}{d}.csv").write_text("\n".join([",".join(ENTITIES[entity].columns), *lines]) + "\n")


def test_every_column_is_text_and_missing_tokens_are_null(spark, tmp_path):
    write(tmp_path, "customers", "2024-01-01", "a,2024-01-15,NA,Organic,New", 'b,,"  ",null,007')
    rows = files.read_raw(spark, str(tmp_path), "customers").orderBy("customer_id").collect()
    assert [tuple(r)[:5] for r in rows] == [
        ("a", "2024-01-15", None, "Organic", "New"), ("b", None, "  ", None, "007")]
    assert rows[0]._source_file == "entity=customers/yyyy=2024/mm=01/dd=01/customers_20240101.csv"


def test_rows_of_a_file_keep_their_order(spark, tmp_path):
    write(tmp_path, "customers", "2024-01-01", *[f"{i},2024-01-15,US,Organic,New" for i in range(2000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = files.read_raw(spark, str(tmp_path), "customers")
        # Line breaks may be quoted, so a file is never split.
        assert rows.rdd.getNumPartitions() == 1
        got = [int(r.customer_id) for r in rows.orderBy("_source_file", "_row").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == list(range(2000))


def test_listing_and_ledger(spark, tmp_path):
    write(tmp_path, "customers", "2024-01-01", "a,2024-01-15,US,Organic,New")
    write(tmp_path, "orders", "2024-01-02")
    listing = files.list_objects(spark, str(tmp_path))
    assert {r.entity: files_day for r in listing.collect() for files_day in [r.object_path[-12:]]} == {
        "customers": "20240101.csv", "orders": "20240102.csv"}
    ledger = listing.filter("entity = 'orders'")
    assert [r.entity for r in files.discover(listing, ledger).collect()] == ["customers"]
    assert files.discover(listing, listing).isEmpty()


def test_round_trip_of_the_sink(spark, raw, tmp_path):
    rows = ROWS["inventory"] + [dict(ROWS["inventory"][0], inventory_id=None, warehouse_location="  a, b ")]
    df = raw("inventory", rows=rows)
    columns = list(ENTITIES["inventory"].columns)
    sinks.write_dated_csv(df.select(*columns, F.lit("2024-05-06").cast("date").alias("_day")), str(tmp_path), "inventory", "_day")
    back = files.read_raw(spark, str(tmp_path), "inventory")
    assert sorted(map(str, back.select(*columns).collect())) == sorted(map(str, df.select(*columns).collect()))
    assert back.select(files.folder_day(F.col("_source_file")).cast("string")).first()[0] == "2024-05-06"


def test_positions(spark, tmp_path):
    write(tmp_path, "orders", "2024-01-01", "o1,c,p,1,2.0,3.5,t,m,s", "o2,c,p,1,2.0,free,t,m,s", "o3,c", "o4,c,p,1,2.0, 4 ,t,m,s")
    lines = files.read_lines(spark, f"{tmp_path}/entity=orders")
    got = sorted((r.id, r.number_5) for r in files.positional(lines, 0, 5).collect())
    assert got == [("o1", 3.5), ("o4", 4.0)]
    assert sorted(r.id for r in files.positional(lines, 0).collect()) == ["o1", "o2", "o3", "o4"]


def test_ledger_rows_and_status(spark, raw):
    rows = [dict(ROWS["customers"][0], _source_file="good"), dict(ROWS["customers"][1], _source_file="bad", country=None)]
    at = F.lit("2024-01-01").cast("timestamp")
    ledger = staging.ledger_rows(staging.check("customers", raw("customers", rows=rows)), at)
    assert {r.object_path: (r.row_count, r.quarantine_count, r.status) for r in ledger.collect()} == {
        "good": (1, 0, "success"), "bad": (0, 0, "empty")}
    renamed = ledger.withColumn("entity", F.lit("other")).withColumn("row_count", F.lit(5).cast("bigint"))
    after = staging.write_ledger(ledger, renamed)
    assert {(r.entity, r.row_count) for r in after.collect()} == {("customers", 5)}


def test_store_publishes_complete_versions_only(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    with pytest.raises(LookupError):
        store.read("t")
    store.publish("t", spark.range(3))
    with pytest.raises(Exception):
        store.publish("t", spark.range(3).select(F.raise_error(F.lit("lost")).cast("long").alias("id")))
    assert store.version("t") == 1 and store.read("t").count() == 3
    store.publish("t", store.read("t").union(spark.range(2)))
    assert store.read("t").count() == 5
    assert store.ensure("t", "id long") is False and store.ensure("l", LEDGER) is True
    assert store.read("l").count() == 0


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_dir(spark, "x").startswith(shared_dir(spark) + "/x-")


def test_quotes_line_breaks_and_backslashes_survive(spark, tmp_path):
    """Written and read back, and read as other writers put them."""
    names = ['Say "hi", now', "two\nlines", "ends in \\", 'both "\\"', "plain", "a,b"]
    rows = [(PRODUCT[:-1] + str(i), n, "c", "1.00", "2.00", "3", "2024-06-15") for i, n in enumerate(names)]
    columns = [*ENTITIES["products"].columns, "day"]
    df = spark.createDataFrame(rows, columns).withColumn("day", F.to_date("day"))
    sinks.write_dated_csv(df, str(tmp_path / "a"), "products", "day")
    got = files.read_raw(spark, str(tmp_path / "a"), "products").collect()
    assert {r.product_id: r.product_name for r in got} == {r[0]: r[1] for r in rows}
    assert {r.category for r in got} == {"c"} and {r.inventory_quantity for r in got} == {"3"}
    folder = tmp_path / "b" / "entity=products"
    folder.mkdir(parents=True)
    body = ['"' + '","'.join(x.replace('"', '""') for x in r[:-1]) + '"' for r in rows]
    (folder / "f.csv").write_text("\n".join([",".join(columns[:-1]), *body]) + "\n")
    got = files.read_raw(spark, str(tmp_path / "b"), "products").collect()
    assert {r.product_id: r.product_name for r in got} == {r[0]: r[1] for r in rows}


def test_columns_are_bound_by_their_own_header(spark, tmp_path):
    """Another order of columns, a column more, one less, a quoted header."""
    folder = tmp_path / "entity=products"
    folder.mkdir(parents=True)
    columns = list(ENTITIES["products"].columns)
    row = ROWS["products"][0]
    turned = columns[::-1]
    (folder / "a.csv").write_text(",".join(columns) + "\n" + ",".join(row[c] for c in columns) + "\n")
    (folder / "b.csv").write_text(",".join(turned) + "\n" + ",".join(row[c] for c in turned) + "\n")
    more = ["note", *columns[2:], *columns[:2]]
    (folder / "c.csv").write_text(",".join(f'"{c}"' for c in more) + "\n" + ",".join({**row, "note": "x, \"y".replace('"', "")}[c].replace(",", ";") for c in more) + "\n")
    less = columns[1:]
    (folder / "d.csv").write_text(",".join(less) + "\n" + ",".join(row[c] for c in less) + "\n")
    (folder / "e.csv").write_text(",".join(turned) + "\n")
    got = {r._source_file[-5:]: r for r in files.read_raw(spark, str(tmp_path), "products").collect()}
    assert sorted(got) == ["a.csv", "b.csv", "c.csv", "d.csv"]
    for name in ("a.csv", "b.csv", "c.csv"):
        assert {c: got[name][c] for c in columns} == row
    assert got["d.csv"].product_id is None and got["d.csv"].product_name == row["product_name"]
