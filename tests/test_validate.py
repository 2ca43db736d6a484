import pytest

from cartwright.catalog import ENTITIES
from cartwright.operators import validate as V
from cartwright.plans import staging
from conftest import CUSTOMER, ROWS


def split(raw, entity, **changes):
    valid, invalid = V.validate(entity, raw(entity, **changes))
    return valid.collect(), invalid.collect()


@pytest.mark.parametrize("entity", list(ENTITIES))
def test_clean_rows_pass(raw, entity):
    valid, invalid = split(raw, entity)
    assert len(valid) == len(ROWS[entity]) and invalid == []


@pytest.mark.parametrize(
    "entity, column, value, reason",
    [
        ("customers", "country", None, "null:country"),
        ("customers", "acquisition_channel", "Twitter", "enum:acquisition_channel"),
        ("customers", "acquisition_channel", "organic", "enum:acquisition_channel"),
        ("customers", "acquisition_channel", " Organic ", "enum:acquisition_channel"),
        ("customers", "customer_segment", "Premium", "enum:customer_segment"),
        ("customers", "customer_id", "not-a-uuid", "uuid:customer_id"),
        ("customers", "customer_id", CUSTOMER.upper(), "uuid:customer_id"),
        ("products", "cost_price", "-10", "number:cost_price"),
        ("products", "product_name", None, "null:product_name"),
        ("products", "selling_price", "free", "number:selling_price"),
        ("products", "selling_price", "+1", "number:selling_price"),
        ("products", "selling_price", "1e3", "number:selling_price"),
        ("products", "selling_price", " 1", "number:selling_price"),
        ("products", "inventory_quantity", "1.5", "number:inventory_quantity"),
        ("orders", "order_status", "InProgress", "enum:order_status"),
        ("orders", "order_timestamp", None, "null:order_timestamp"),
        ("orders", "quantity", "-1", "number:quantity"),
        ("payments", "payment_status", "Declined", "enum:payment_status"),
        ("inventory", "quantity_on_hand", "-50", "number:quantity_on_hand"),
        ("revenue", "total_revenue", None, "null:total_revenue"),
        ("revenue", "total_profit", "-3.50", "number:total_profit"),
        ("returns", "return_reason", "Buyer Remorse", "enum:return_reason"),
        ("returns", "return_status", "Completed", "enum:return_status"),
    ],
)
def test_one_fault(raw, entity, column, value, reason):
    valid, invalid = split(raw, entity, **{column: value})
    assert len(valid) == len(ROWS[entity]) - 1
    assert [r._reasons for r in invalid] == [reason]
    assert invalid[0][column] == value


@pytest.mark.parametrize(
    "entity, column, value",
    [
        ("orders", "order_status", "Pending"),
        ("orders", "order_status", None),
        ("orders", "payment_method", None),
        ("orders", "customer_id", "anything"),
        ("orders", "order_timestamp", "not-a-date"),
        ("customers", "country", "   "),
        ("products", "cost_price", "007"),
    ],
)
def test_not_a_fault(raw, entity, column, value):
    assert split(raw, entity, **{column: value})[1] == []


def test_every_copy_of_a_repeated_key_fails(raw):
    valid, invalid = V.validate("customers", raw("customers", rows=ROWS["customers"] + ROWS["customers"][:1]))
    assert valid.count() == 1
    assert [r._reasons for r in invalid.collect()] == ["unique:customer_id"] * 2


def test_uniqueness_ends_with_the_file(raw):
    rows = [dict(ROWS["customers"][0], _source_file=f) for f in ("a.csv", "b.csv")]
    valid, invalid = V.validate("customers", raw("customers", rows=rows))
    assert valid.count() == 2 and invalid.count() == 0


def test_null_keys_are_not_repeats(raw):
    rows = [dict(r, customer_id=None) for r in ROWS["customers"]]
    _, invalid = V.validate("customers", raw("customers", rows=rows))
    assert {r._reasons for r in invalid.collect()} == {"null:customer_id"}


def test_reasons_add_up(raw):
    _, invalid = split(raw, "orders", order_id="x", quantity="-1", total_amount=None)
    assert invalid[0]._reasons == "null:total_amount|number:quantity|uuid:order_id"


def test_halves_make_the_whole(raw):
    df = raw("customers", rows=ROWS["customers"] + ROWS["customers"][:1], country=None)
    valid, invalid = V.validate("customers", df)
    both = valid.unionByName(invalid.select(*valid.columns))
    assert sorted(map(str, both.collect())) == sorted(map(str, df.collect()))


@pytest.mark.parametrize(
    "column, value, reason",
    [
        ("customer_id", "anything", "uuid:customer_id"),
        ("order_timestamp", "not-a-date", "unparseable:order_timestamp"),
        ("unit_price", "99999999999.00", "overflow:unit_price"),
    ],
)
def test_what_a_typed_table_cannot_store_is_rejected_alone(raw, column, value, reason):
    rows = ROWS["orders"] + [dict(ROWS["orders"][0], order_id=CUSTOMER)]
    batch = staging.check("orders", raw("orders", rows=rows, **{column: value}))
    assert [r._reasons for r in batch.rejected.collect()] == [reason]
    assert batch.accepted.count() == 1


def test_summary_counts_per_file(raw):
    rows = [dict(ROWS["customers"][0], _source_file="a"), dict(ROWS["customers"][1], _source_file="a", country=None),
            dict(ROWS["customers"][1], _source_file="b")]
    got = {r._source_file: tuple(r)[1:] for r in V.summary(V.annotate("customers", raw("customers", rows=rows))).collect()}
    assert got == {"a": (1, 1, 1), "b": (1, 0, 0)}


def test_unknown_entity(raw):
    with pytest.raises(ValueError, match="No validator defined"):
        V.validate("suppliers", raw("customers"))


def test_an_integer_that_does_not_fit_is_quarantined(raw):
    from cartwright.plans import staging

    batch = staging.check("orders", raw("orders", quantity="99999999999"))
    assert [r["_reasons"] for r in batch.rejected.collect()] == ["overflow:quantity"]
    assert staging.check("orders", raw("orders", quantity="2147483647")).accepted.first().quantity == 2147483647
