from decimal import Decimal

from helpers import bag, day, tuples
from millrace.operators.completeness import (
    DAILY_COLUMNS, completeness_by_year, completeness_daily, completeness_verdict,
    control_totals_spine, daily_visitors_hits,
)
from millrace.sources.control import control_totals

CLICK = ("visid_high bigint, visid_low bigint, hitid_high bigint, hitid_low bigint, "
         "utc_date date")


def clicks(spark, rows):
    return spark.createDataFrame([(*ids, day(d)) for *ids, d in rows], CLICK)


def many(spark, days):
    """``{day: number of clicks}``, each click of its own visitor."""
    return clicks(spark, [(n, n, n, n, d) for d, count in days.items() for n in range(count)])


def test_ids_are_pairs_and_half_null_pairs_do_not_count(spark):
    df = clicks(spark, [(1, 23, 1, 23, "2024-01-01"), (12, 3, 12, 3, "2024-01-01"),
                        (1, None, None, 1, "2024-01-01"), (1, 23, 1, 23, "2024-01-01"),
                        (1, 23, 5, 5, "2024-01-02")])
    assert bag(daily_visitors_hits(df)) == [(day("2024-01-01"), 2, 2), (day("2024-01-02"), 1, 1)]


def test_spine_has_every_day_once(spark):
    control = control_totals(spark, [(day("2024-01-01"), 3, None), (day("2024-01-03"), 4, 2),
                                     (day("2024-02-01"), 9, 9)])
    got = control_totals_spine(control, day("2023-12-31"), day("2024-01-03"))
    assert bag(got) == [(day("2023-12-31"), 0, 0), (day("2024-01-01"), 3, 0),
                        (day("2024-01-02"), 0, 0), (day("2024-01-03"), 4, 2)]


def test_daily_rates_and_threshold(spark):
    df = many(spark, {"2024-01-01": 98, "2024-01-02": 99, "2024-01-04": 5})
    control = control_totals(spark, [(day(f"2024-01-0{n}"), 100, 100) for n in (1, 2, 3)]
                             + [(day("2024-01-04"), 0, 5)])
    args = (df, control, day("2024-01-01"), day("2024-01-04"))
    daily = completeness_daily(*args)
    assert tuple(daily.columns) == DAILY_COLUMNS
    rate = Decimal("0.9800"), Decimal("0.9900"), Decimal("0.0000"), None
    got = [(r.hit_completeness, r.reach_threshold) for r in daily.orderBy("utc_date").collect()]
    assert got == list(zip(rate, (False, True, False, False)))
    relaxed = completeness_daily(*args, threshold=0.98)
    assert [r.reach_threshold for r in relaxed.orderBy("utc_date").collect()] == [
        True, True, False, False]


def test_one_failing_day_is_tolerated(spark):
    df = many(spark, {"2024-01-01": 10, "2024-01-02": 5, "2024-01-03": 5})
    control = control_totals(spark, [(day(f"2024-01-0{n}"), 10, 10) for n in (1, 2, 3)])
    two = completeness_daily(df, control, day("2024-01-01"), day("2024-01-02"))
    three = completeness_daily(df, control, day("2024-01-01"), day("2024-01-03"))
    assert tuples(completeness_verdict(two)) == [(1, True)]
    assert tuples(completeness_verdict(three)) == [(2, False)]
    assert tuples(completeness_verdict(three, max_failing_days=2)) == [(2, True)]


def test_years_are_judged_apart(spark):
    df = many(spark, {"2023-12-30": 1, "2023-12-31": 1, "2024-01-02": 1})
    control = control_totals(spark, [(day(d), 1, 1) for d in
                                     ("2023-12-30", "2023-12-31", "2024-01-01", "2024-01-02",
                                      "2024-01-03")])
    got = completeness_by_year(df, control, day("2023-12-30"), day("2024-01-03"))
    assert bag(got) == [(2023, 2, 0, True), (2024, 3, 2, False)]
