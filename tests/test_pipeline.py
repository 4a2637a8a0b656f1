from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException

from helpers import bag, day, money, tuples
from millrace.operators.gold import gold_transactions
from millrace.plans.loads import load_transactions, next_fetch, refresh_gold, watermark_of, write_report
from millrace.plans.pipeline import PipelineConfig, run_pipeline
from millrace.plans.quality import check_history, repair_clickstream
from millrace.sources.control import control_totals
from millrace.sources.layout import Layout, run_stamp
from millrace.sources.schemas import BRONZE_SCHEMAS
from millrace.sources.tables import scan_bronze, scan_table
from millrace.streaming.landing import ingest_landing

AT = datetime(2024, 3, 1, 12, 0, 0)
CLICK_NAMES = [column.split()[0] for column in BRONZE_SCHEMAS["clickstream"].split(", ")]


@pytest.fixture
def layout(tmp_path):
    return Layout(str(tmp_path))


def write(spark, name, rows, path):
    spark.createDataFrame(rows, BRONZE_SCHEMAS[name]).write.mode("append").parquet(path)


def sale(order, d, kind="purchase", items=("p",), email="a@x"):
    return (email, list(items), order, len(items), money("1"), 1704067200, kind, day(d))


def click(n, d):
    values = {"visid_high": n, "visid_low": 0, "hitid_high": n, "hitid_low": 0,
              "hit_time_gmt": 1704067200 + n, "utc_date": day(d)}
    return tuple(values.get(name) for name in CLICK_NAMES)


def deliver(spark, layout, sales, clicks=()):
    write(spark, "transactions", sales, layout.landing("transactions"))
    if clicks:
        write(spark, "clickstream", clicks, layout.landing("clickstream"))


@pytest.fixture
def shop(spark, layout):
    """Two products, one user, sales of January and February, clicks of two days."""
    write(spark, "users", [("1", "a@x", 0)], layout.landing("users"))
    write(spark, "products", [("p", "Pen", money("2")), ("q", "Quill", money("5"))],
          layout.landing("products"))
    deliver(spark, layout,
            [sale("1", "2024-01-05"), sale("2", "2024-01-31", items=("p", "q", "x")),
             sale("3", "2024-02-10", kind="return"), sale("4", "2024-02-29", items=("q",))],
            [click(n, d) for d in ("2024-02-28", "2024-02-29") for n in range(4)])
    return layout


def test_whole_run(spark, shop):
    control = control_totals(spark, [(day("2024-02-28"), 4, 4), (day("2024-02-29"), 4, 4)])
    report = run_pipeline(spark, PipelineConfig(shop, AT, control=control))
    want = [("Pen", 2024, "Jan", money("4"), money("4"), money("0")),
            ("Pen", 2024, "Feb", money("-2"), money("-6"), money("-150")),
            ("Quill", 2024, "Jan", money("5"), money("5"), money("0")),
            ("Quill", 2024, "Feb", money("5"), money("0"), money("0"))]
    assert tuples(report) == want
    assert bag(scan_table(spark, shop.report(run_stamp(AT)))) == bag(report)
    checks = scan_table(spark, shop.qa("transactions", "checks"))
    assert checks.columns[:4] == ["date", "null_check", "duplicates_check", "all_cols_check"]
    assert tuples(checks.select(*checks.columns[:4])) == [(AT.timestamp(), "pass", "pass", "pass")]
    assert scan_table(spark, shop.table("silver", "users")).count() == 1
    assert scan_table(spark, shop.table("silver", "clickstream")).count() == 8


def tables(spark, layout):
    names = [("silver", "transactions"), ("silver", "clickstream"), ("gold", "transactions")]
    return [bag(scan_table(spark, layout.table(*name)).drop("etl_loaded_at")) for name in names]


def test_a_second_run_changes_no_table_and_new_days_continue(spark, shop):
    run_pipeline(spark, PipelineConfig(shop, AT))
    first = tables(spark, shop)
    run_pipeline(spark, PipelineConfig(shop, AT + timedelta(hours=1)))
    assert tables(spark, shop) == first
    deliver(spark, shop, [sale("5", "2024-03-02"), sale("6", "2024-03-02", kind="return")],
            [click(9, "2024-03-01")])
    run_pipeline(spark, PipelineConfig(shop, AT + timedelta(hours=2)))
    silver = scan_table(spark, shop.table("silver", "transactions"))
    gold = scan_table(spark, shop.table("gold", "transactions"))
    rebuilt = gold_transactions(silver)
    assert bag(gold.select(*rebuilt.columns)) == bag(rebuilt)
    assert silver.count() == len(first[0]) + 2


def test_a_report_is_never_replaced(spark, shop):
    run_pipeline(spark, PipelineConfig(shop, AT))
    with pytest.raises(AnalysisException):
        write_report(spark, shop, run_stamp(AT))


def test_late_days_are_loaded_on_request(spark, shop):
    run_pipeline(spark, PipelineConfig(shop, AT))
    deliver(spark, shop, [sale("late", "2024-01-20")])
    ingest_landing(spark, shop, "transactions")
    load_transactions(spark, shop, AT)
    refresh_gold(spark, shop)
    silver = scan_table(spark, shop.table("silver", "transactions"))
    assert silver.filter("order_id = 'late'").count() == 0
    for _ in range(2):
        load_transactions(spark, shop, AT, after=day("2024-01-19"))
        refresh_gold(spark, shop, after=day("2024-01-19"))
    silver = scan_table(spark, shop.table("silver", "transactions"))
    gold = scan_table(spark, shop.table("gold", "transactions"))
    rebuilt = gold_transactions(silver)
    assert silver.filter("order_id = 'late'").count() == 1
    assert bag(gold.select(*rebuilt.columns)) == bag(rebuilt)


def test_a_failed_gold_refresh_is_caught_up(spark, shop):
    run_pipeline(spark, PipelineConfig(shop, AT))
    for n, d in enumerate(("2024-03-02", "2024-03-03")):
        deliver(spark, shop, [sale(f"n{n}", d)])
        ingest_landing(spark, shop, "transactions")
        load_transactions(spark, shop, AT)
    refresh_gold(spark, shop)
    rebuilt = gold_transactions(scan_table(spark, shop.table("silver", "transactions")))
    gold = scan_table(spark, shop.table("gold", "transactions"))
    assert bag(gold.select(*rebuilt.columns)) == bag(rebuilt)


def test_next_fetch_follows_the_watermark(spark, shop):
    args = (spark, shop, "transactions", day("2024-03-10"), day("2024-01-01"))
    assert next_fetch(*args) == (day("2024-01-01"), day("2024-03-09"))
    run_pipeline(spark, PipelineConfig(shop, AT))
    assert next_fetch(*args) == (day("2024-03-01"), day("2024-03-09"))
    assert watermark_of(spark, shop.table("gold", "transactions")) == day("2024-02-29")


SPAN = day("2024-02-27"), day("2024-02-29")


@pytest.fixture
def gaps(spark, layout):
    """Ten clicks expected on each of three days; half of them delivered, refetches follow."""
    days = ["2024-02-27", "2024-02-28", "2024-02-29"]
    write(spark, "clickstream", [click(n, d) for d in days for n in range(5)],
          layout.landing("clickstream"))
    ingest_landing(spark, layout, "clickstream")
    attempts = []
    for number, upto in enumerate((8, 10, 11)):
        attempts.append(layout.attempt("clickstream", AT + timedelta(minutes=number)))
        rows = [click(n, d) for d in days + ["2024-03-01"] for n in range(4, upto)]
        write(spark, "clickstream", rows, attempts[-1])
    return layout, control_totals(spark, [(day(d), 10, 10) for d in days]), attempts


def test_repair_takes_refetches_until_complete(spark, gaps):
    layout, control, attempts = gaps
    for _ in range(2):
        assert repair_clickstream(spark, layout, control, *SPAN, AT, attempts)
        clicks = scan_bronze(spark, layout, "clickstream")
        assert clicks.count() == 30 and clicks.distinct().count() == 30
    log = scan_table(spark, f"{layout.qa_log('clickstream', AT)}/repair")
    got = [(r.initial_number_of_hits, r.QA_number_of_hits, r.desired_number_of_hits,
            r.data_quality_reached_expectation) for r in log.collect()]
    assert got == [(5, 10, 10, True)] * 3


def test_repair_uses_every_refetch_and_skips_empty_ones(spark, gaps):
    layout, control, attempts = gaps
    absent = layout.attempt("clickstream", AT + timedelta(days=1))
    assert repair_clickstream(spark, layout, control, *SPAN, AT,
                              [attempts[0], absent, attempts[0], attempts[1]])
    assert scan_bronze(spark, layout, "clickstream").count() == 30


def test_a_complete_range_is_left_alone(spark, gaps):
    layout, _, attempts = gaps
    control = control_totals(spark, [(day("2024-02-28"), 5, 5)])
    assert repair_clickstream(spark, layout, control, SPAN[1] - timedelta(days=1),
                              SPAN[1] - timedelta(days=1), AT, attempts)
    assert scan_bronze(spark, layout, "clickstream").count() == 15


def test_history_is_checked_over_all_days_of_silver(spark, shop):
    run_pipeline(spark, PipelineConfig(shop, AT))
    control = control_totals(spark, [(day("2024-02-28"), 4, 4), (day("2024-02-29"), 8, 4)])
    daily = check_history(spark, shop, control)
    assert [(r.utc_date.day, r.reach_threshold) for r in daily.orderBy("utc_date").collect()] == [
        (28, True), (29, False)]


def test_late_days_are_loaded_by_the_next_run(spark, shop):
    run_pipeline(spark, PipelineConfig(shop, AT))
    deliver(spark, shop, [sale("on", "2024-02-29"), sale("before", "2024-02-05"),
                          sale("new", "2024-03-01")], [click(50, "2024-02-28")])
    for hours in (1, 2):
        run_pipeline(spark, PipelineConfig(shop, AT + timedelta(hours=hours)))
        silver = scan_table(spark, shop.table("silver", "transactions"))
        assert silver.filter("order_id in ('on', 'before', 'new')").count() == 3
        assert silver.count() == 8
        rebuilt = gold_transactions(silver)
        gold = scan_table(spark, shop.table("gold", "transactions"))
        assert bag(gold.select(*rebuilt.columns)) == bag(rebuilt)
        assert scan_table(spark, shop.table("silver", "clickstream")).count() == 9
    late = [scan_table(spark, f"{shop.qa('transactions', 'late')}/{run_stamp(AT + timedelta(hours=h))}")
            for h in (1, 2)]
    assert set(bag(late[0])) == {(day("2024-02-05"), 1), (day("2024-02-29"), 1)}
    assert bag(late[1]) == []


def test_days_without_deliveries_are_checked_and_repaired(spark, shop):
    days = ["2024-02-27", "2024-02-28", "2024-02-29"]
    control = control_totals(spark, [(day(d), 4, 4) for d in days])
    refetch = shop.attempt("clickstream", AT)
    write(spark, "clickstream", [click(n, days[0]) for n in range(4)], refetch)
    run_pipeline(spark, PipelineConfig(shop, AT, control=control, attempts=[refetch],
                                       max_failing_days=0))
    assert scan_bronze(spark, shop, "clickstream").count() == 12
    later = AT + timedelta(days=2)
    run_pipeline(spark, PipelineConfig(shop, later, control=control))
    log = scan_table(spark, f"{shop.qa_log('clickstream', later)}/initial")
    assert sorted(tuples(log.select("utc_date", "reach_threshold"))) == [
        (day("2024-03-01"), False), (day("2024-03-02"), False)]


def test_no_clicks_at_all_give_a_failing_log(spark, layout):
    write(spark, "users", [("1", "a@x", 0)], layout.landing("users"))
    write(spark, "products", [("p", "Pen", money("2"))], layout.landing("products"))
    write(spark, "clickstream", [], layout.landing("clickstream"))
    deliver(spark, layout, [sale("1", "2024-01-05")])
    control = control_totals(spark, [(day("2024-02-29"), 3 * 10**9, 4)])
    run_pipeline(spark, PipelineConfig(layout, AT, control=control))
    log = scan_table(spark, f"{layout.qa_log('clickstream', AT)}/initial")
    assert tuples(log.select("hits_num", "num_of_hitid", "reach_threshold")) == [
        (3 * 10**9, 0, False)]
