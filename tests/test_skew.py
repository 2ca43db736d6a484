"""One key holds a third of the rows; no task may have to take them all."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartwright.operators import merge, quality
from cartwright.operators import validate as V
from cartwright.operators.history import join_as_of
from cartwright.operators.skew import PARTS, hot_only, key_counts

# Small data has to look large to adaptive execution.
LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "65536",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "131072",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}
ROWS = 60_000


@pytest.fixture
def large(spark):
    for k, v in LARGE.items():
        spark.conf.set(k, v)
    yield spark
    for k in LARGE:
        spark.conf.unset(k)


def table(spark, path, copies):
    hot = F.col("id") % 3 == 0
    own = F.lit(0) if copies else F.col("id")
    spark.range(0, ROWS, 1, 8).select(
        F.when(hot, "hot").otherwise(F.md5(F.col("id").cast("string"))).alias("key"),
        F.when(hot, own).otherwise(F.col("id")).alias("n"),
        F.concat(F.lit("file"), F.when(hot, 0).otherwise(F.col("id") % 5)).alias("_source_file"),
        F.md5(F.concat(F.lit("x"), F.when(hot, own).otherwise(F.col("id")))).alias("payload"),
    ).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def skewed(large, tmp_path):
    """A stored table of which a third shares the key 'hot'."""
    return table(large, str(tmp_path / "skewed"), copies=False)


@pytest.fixture
def copies(large, tmp_path):
    """The same, where the rows of the hot key are copies of one row."""
    return table(large, str(tmp_path / "copies"), copies=True)


def run(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def largest_share(df, condition):
    """The largest part of the rows that one task of the final stage held."""
    per_task = df.filter(condition).groupBy(F.spark_partition_id().alias("p")).count().collect()
    return max(r["count"] for r in per_task) / sum(r["count"] for r in per_task)


def test_repeats_of_a_hot_key_are_flagged_without_gathering_them(copies):
    flagged = V.flag_repeated(copies, "key", "failed")
    rows, plan = run(flagged)
    assert len(rows) == ROWS and sum(r.failed for r in rows) == ROWS // 3
    assert all(r.failed == (r.key == "hot") for r in rows)
    assert "Window" not in plan
    assert largest_share(flagged, "key = 'hot'") < 0.6


def test_missing_keys_are_scattered_too(copies):
    keyless = copies.withColumn("key", F.when(F.col("key") != "hot", F.col("key")))
    flagged = V.flag_repeated(keyless, "key", "failed")
    assert flagged.filter("failed").isEmpty() and flagged.count() == ROWS
    assert largest_share(flagged, "key IS NULL") < 0.6


def test_cold_repeats_are_flagged(large):
    df = large.range(10_000).select(
        F.md5((F.col("id") / 2).cast("int").cast("string")).alias("key"), F.lit("f").alias("_source_file"),
    )
    assert hot_only(key_counts(df, ["key"])).isEmpty()
    assert V.flag_repeated(df, "key", "failed").filter("failed").count() == 10_000


def test_uniqueness_reads_its_rows_once_and_moves_none_where_few_keys_repeat(copies):
    flagged = V.flag_repeated(copies, "key", "failed")
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and "hashpartitioning(key" not in plan
    assert "HashAggregate" not in plan


def test_many_repeated_keys_are_not_broadcast(copies, monkeypatch):
    monkeypatch.setattr(V, "FEW", 0)
    more = copies.unionByName(copies.filter("key < '1'"))
    rows, plan = run(V.flag_repeated(more, "key", "failed"))
    again = copies.filter("key < '1'").count()
    assert again > 1000 and sum(r.failed for r in rows) == ROWS // 3 + 2 * again
    assert all(r.failed == (r.key == "hot" or r.key < "1") for r in rows) and "SortMergeJoin" in plan or "ShuffledHashJoin" in plan


def test_hot_keys_are_fewer_than_the_parts(large):
    even = large.range(PARTS * 3).select((F.col("id") % (PARTS - 1)).alias("key"))
    assert 0 < hot_only(key_counts(even, ["key"])).count() < PARTS
    assert hot_only(key_counts(large.range(5 * PARTS).select(F.col("id").alias("key")), ["key"])).isEmpty()


def test_latest_row_is_reduced_before_the_shuffle(skewed):
    rows, plan = run(merge.latest_per_key(skewed, ["key"], ["n"]))
    assert len(rows) == ROWS - ROWS // 3 + 1
    assert "partial_max" in plan and "Window" not in plan


def stored(df, tmp_path, name):
    df.write.parquet(str(tmp_path / name))
    return df.sparkSession.read.parquet(str(tmp_path / name))


def test_dimension_lookup_is_split(skewed, tmp_path):
    dim = stored(skewed.select("key").distinct().withColumn("sk", F.xxhash64("key")), tmp_path, "dim")
    rows, plan = run(skewed.join(dim, "key", "left"))
    assert len(rows) == ROWS and all(r.sk is not None for r in rows)
    assert "skew=true" in plan


def test_orphan_repair_is_split(skewed, tmp_path):
    dim = stored(skewed.select(F.col("key").alias("sk")).distinct().filter("sk <> 'hot'"), tmp_path, "dim")
    rows, plan = run(quality.clear_orphans(skewed.withColumnRenamed("key", "sk"), "sk", dim))
    assert sum(r.sk is None for r in rows) == ROWS // 3
    assert "skew=true" in plan


def test_fan_out_of_a_hot_key_is_split(skewed, tmp_path):
    left = skewed.sparkSession.createDataFrame([("hot", 1), ("cold", 2)], "key string, left_n int")
    joined = merge.left_join_fanout(stored(left, tmp_path, "left"), skewed, ["key"])
    rows, plan = run(joined)
    assert sum(r.key == "hot" for r in rows) == ROWS // 3
    assert [r.n for r in rows if r.key == "cold"] == [None]
    assert "skew=true" in plan


def test_as_of_with_a_key_of_many_versions(large):
    """A third of all versions belong to one key; results equal brute force."""
    start = dt.datetime(2020, 1, 1)
    dim = []
    for key, versions in [("hot", 1000), *[(f"k{i}", 1) for i in range(1500)], ("two", 2)]:
        times = [start + dt.timedelta(days=2 * v) for v in range(versions)] + [None]
        dim += [(key, i, times[i], times[i + 1]) for i in range(versions)]
    facts = [(k, start + dt.timedelta(days=d, hours=h)) for k in ("hot", "two", "k7", "none")
             for d in (-400, -1, 0, 1, 2, 31, 59, 700, 1999, 5000) for h in (0, 5)]
    dim_df = large.createDataFrame(dim, "key string, v int, valid_from timestamp, valid_to timestamp")
    fact_df = large.createDataFrame(facts, "key string, t timestamp")
    got = sorted(((r.key, r.t, r.v) for r in join_as_of(fact_df, dim_df, "key", "t").collect()), key=str)
    want = []
    for k, t in facts:
        hits = [v for key, v, a, b in dim if key == k and a <= t and (b is None or b > t)]
        want += [(k, t, v) for v in hits or [None]]
    assert got == sorted(want, key=str)
    assert [r.key for r in hot_only(key_counts(dim_df, ["key"])).collect()] == ["hot"]
