import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartwright.operators.history import join_as_of, merge_history
from cartwright.plans import transforms
from cartwright.plans.warehouse import ts

DIM = "sk bigint, id string, name string, tier string, valid_from timestamp, valid_to timestamp, is_current boolean"
T0, T1, T2 = (dt.datetime(2024, m, 1) for m in (1, 2, 3))


@pytest.fixture
def dim(spark):
    return spark.createDataFrame(
        [
            (1, "a", "Ann", "New", T0, None, True),
            (2, "b", "Bob", None, T0, None, True),
            (3, "c", "Cid", "New", T0, T1, False),
            (4, "d", "Dot", "New", T0, T1, False),
            (5, "d", "Dot", "VIP", T1, None, True),
        ],
        DIM,
    )


def merged(spark, dim, *staged, at=T2):
    batch = spark.createDataFrame(list(staged), "id string, name string, tier string")
    return merge_history(dim, batch, "id", "sk", ["tier"], ts(str(at)))


def versions(df, key):
    return [tuple(r) for r in df.filter(F.col("id") == key).orderBy("valid_from")
            .select("sk", "name", "tier", "valid_to", "is_current").collect()]


def test_new_key(spark, dim):
    assert versions(merged(spark, dim, ("n", "Nat", "New")), "n") == [(6, "Nat", "New", None, True)]


def test_changed_key_closes_and_opens_at_the_same_instant(spark, dim):
    out = merged(spark, dim, ("a", "Anna", "VIP"))
    assert versions(out, "a") == [(1, "Ann", "New", T2, False), (6, "Anna", "VIP", None, True)]
    assert out.filter("id = 'a' and is_current").first().valid_from == T2


def test_unchanged_key_is_left_alone_even_if_untracked_columns_differ(spark, dim):
    assert versions(merged(spark, dim, ("a", "Other", "New")), "a") == [(1, "Ann", "New", None, True)]


@pytest.mark.parametrize("key, value", [("b", "New"), ("a", None)])
def test_null_and_value_differ(spark, dim, key, value):
    assert len(versions(merged(spark, dim, (key, "X", value)), key)) == 2


def test_null_equals_null(spark, dim):
    assert len(versions(merged(spark, dim, ("b", "Bob", None)), "b")) == 1


def test_key_with_only_closed_rows_stays_closed(spark, dim):
    assert versions(merged(spark, dim, ("c", "Cid", "VIP")), "c") == [(3, "Cid", "New", T1, False)]


def test_history_is_kept(spark, dim):
    assert [v[0] for v in versions(merged(spark, dim, ("d", "Dot", "New")), "d")] == [4, 5, 6]


def test_repeating_a_batch_changes_nothing(spark, dim):
    batch = (("a", "Ann", "VIP"), ("n", "Nat", "New"), ("b", "Bob", None))
    once = merged(spark, dim, *batch)
    twice = merged(spark, once, *batch)
    assert sorted(map(str, twice.collect())) == sorted(map(str, once.collect()))


def test_surrogate_keys_are_dense_and_unique(spark, dim):
    out = merged(spark, dim, *[(f"k{i}", "x", "New") for i in range(50)], ("a", "Ann", "VIP"))
    assert sorted(r.sk for r in out.select("sk").collect()) == list(range(1, 57))


@pytest.mark.parametrize("moment, tier", [
    (T0, "New"), (T1 - dt.timedelta(seconds=1), "New"), (T1, "VIP"), (T2, "VIP"),
    (T0 - dt.timedelta(seconds=1), None),
])
def test_as_of_is_half_open(spark, dim, moment, tier):
    facts = spark.createDataFrame([("d", moment)], "id string, t timestamp")
    got = join_as_of(facts, dim.select("id", "tier", "valid_from", "valid_to"), "id", "t").collect()
    assert [r.tier for r in got] == [tier]


def test_dim_customers_does_not_track_sign_up(spark):
    staging = "customer_id string, signup_date date, country string, acquisition_channel string, " \
              "customer_segment string, _loaded_at timestamp"
    day = dt.date(2024, 1, 1)
    first = spark.createDataFrame([("a", day, "US", "Email", "New", T0)], staging)
    second = spark.createDataFrame(
        [("a", dt.date(2020, 1, 1), "US", "Email", "New", T1), ("a", day, "UK", "Email", "New", T0)], staging
    )
    from cartwright.catalog import ANALYTICS

    dim = transforms.dim_customers(spark.createDataFrame([], ANALYTICS["dim_customers"]), first, ts(str(T0)))
    out = transforms.dim_customers(dim, second, ts(str(T1))).collect()
    assert [(r.customer_sk, r.signup_date, r.country) for r in out] == [(1, day, "US")]
