from datetime import timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import bag, day, money, silver_rows, tuples
from millrace.operators.gold import (
    GOLD_COLUMNS, gold_daily_signed, gold_since, gold_transactions, with_adjusted_price,
)
from millrace.operators.gold import with_signed_price

SOME = settings(max_examples=12, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])
ROWS = st.lists(st.tuples(
    st.sampled_from(["a@x", "b@x", None]), st.sampled_from(["p", "q"]),
    st.integers(0, 5).map(lambda n: (day("2024-01-29") + timedelta(days=n)).isoformat()),
    st.sampled_from(["purchase", "return", None]),
    st.sampled_from(["1.10", "2.25", "9.99"])), min_size=1, max_size=30)


def test_daily_sum_is_signed_and_has_date_parts(spark):
    df = silver_rows(spark, [("a", "p", "2024-02-03", "purchase", "2.50"),
                             ("a", "p", "2024-02-03", "purchase", "2.50"),
                             ("a", "p", "2024-02-03", "return", "2.50")])
    assert bag(gold_daily_signed(df)) == [
        ("a", "p", day("2024-02-03"), 2024, 2, "purchase", money("5")),
        ("a", "p", day("2024-02-03"), 2024, 2, "return", money("-2.5"))]


def test_previous_entry_ties_by_type_and_stays_in_customer_and_product(spark):
    df = silver_rows(spark, [("a", "p", "2024-01-02", "return", "1"),
                             ("a", "p", "2024-01-02", "purchase", "2"),
                             ("a", "p", "2024-01-05", "purchase", "3"),
                             ("a", "q", "2024-01-06", "purchase", "4"),
                             ("b", "p", "2024-01-06", "return", "5")])
    out = gold_transactions(df)
    assert tuple(out.columns) == GOLD_COLUMNS
    got = [(r.email, r.product_id, r.date.day, r.transaction_type,
            r.previous_purchase_signed_price) for r in out.collect()]
    assert sorted(got) == [("a", "p", 2, "purchase", None), ("a", "p", 2, "return", money("2")),
                           ("a", "p", 5, "purchase", money("-1")), ("a", "q", 6, "purchase", None),
                           ("b", "p", 6, "return", None)]


def test_adjusted_price(spark):
    df = silver_rows(spark, [("a", "p", "2024-01-01", "return", "1"),
                             ("a", "p", "2024-01-02", "purchase", "3"),
                             ("a", "p", "2024-01-03", "return", "3"),
                             ("b", "p", "2024-01-01", "purchase", "4")])
    out = with_adjusted_price(gold_transactions(df))
    got = {(r.email, r.date.day): r.adjusted_signed_price for r in out.collect()}
    assert got == {("a", 1): money("-1"), ("a", 2): money("2"), ("a", 3): money("0"),
                   ("b", 1): None}


@SOME
@given(ROWS)
def test_daily_sums_keep_the_total(spark, rows):
    df = silver_rows(spark, rows)
    total = with_signed_price(df).agg({"signed_price": "sum"}).first()[0]
    assert gold_daily_signed(df).agg({"daily_signed_price": "sum"}).first()[0] == total


@SOME
@given(ROWS, st.integers(-1, 6))
def test_continuing_from_history_equals_a_full_build(spark, rows, split):
    df = silver_rows(spark, rows)
    since = day("2024-01-29") + timedelta(days=split)
    full = gold_transactions(df)
    continued = gold_since(df.filter(df.date >= since), full.filter(full.date < since))
    assert tuple(continued.columns) == GOLD_COLUMNS
    assert bag(continued) == bag(full.filter(full.date >= since))
