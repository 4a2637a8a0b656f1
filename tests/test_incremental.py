import pytest

from helpers import bag, day, plan_of, tuples
from millrace.operators.incremental import (
    after_watermark, date_bounds, high_watermark, ingest_range, late_rows, late_rows_of, within_dates,
)

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03"]


def source(spark, rows):
    return spark.createDataFrame([(k, d and day(d)) for k, d in rows],
                                 "order_id string, utc_date date")


def target(spark, rows):
    return spark.createDataFrame([(k, d and day(d)) for k, d in rows],
                                 "order_id string, date date")


@pytest.fixture
def orders(spark):
    return source(spark, [("a", DAYS[0]), ("b", DAYS[1]), ("c", DAYS[2]), ("n", None)])


def test_watermark_is_strict(spark, orders):
    held = target(spark, [("a", DAYS[0]), ("b", DAYS[1])])
    want = [("c", day(DAYS[2]))]
    assert tuples(after_watermark(orders, high_watermark(held))) == want
    assert tuples(after_watermark(orders, day(DAYS[1]))) == want


def test_first_load_takes_everything(spark, orders):
    empty = target(spark, [])
    assert after_watermark(orders, high_watermark(empty)).count() == 4
    assert after_watermark(orders, None).count() == 4
    assert tuples(high_watermark(empty)) == [(None,)]


def test_bounds_and_closed_range(spark, orders):
    assert tuples(date_bounds(orders)) == [(day(DAYS[0]), day(DAYS[2]))]
    got = within_dates(orders, day(DAYS[0]), day(DAYS[1]))
    assert [row.order_id for row in got.collect()] == ["a", "b"]


def test_ingest_range(spark):
    held = target(spark, [("a", "2023-12-31")])
    assert tuples(ingest_range(held, day("2024-01-05"))) == [
        (day("2024-01-01"), day("2024-01-04"), 2024)]
    assert tuples(ingest_range(held, day("2024-01-01"))) == []
    assert tuples(ingest_range(target(spark, []), day("2024-01-05"))) == [
        (None, day("2024-01-04"), None)]


def test_late_rows_are_those_the_filter_never_loads(spark):
    src = source(spark, [("a", DAYS[0]), ("late", DAYS[0]), ("late", DAYS[0]), ("b", DAYS[1]),
                         (None, DAYS[1]), ("new", DAYS[2])])
    held = target(spark, [("a", DAYS[0]), ("a", DAYS[0]), ("b", DAYS[1])])
    assert bag(late_rows(src, held)) == sorted(
        [("late", day(DAYS[0])), (None, day(DAYS[1]))], key=repr)


def test_late_rows_of_a_batch_read_the_days_it_touches(spark, tmp_path):
    path = str(tmp_path / "held")
    (target(spark, [("a", DAYS[0]), ("b", DAYS[1]), (None, DAYS[1]), ("c", DAYS[2])])
     .write.partitionBy("date").parquet(path))
    held = spark.read.parquet(path)
    batch = source(spark, [("b", DAYS[1]), ("late", DAYS[1]), ("late", DAYS[1]), (None, DAYS[1]),
                           ("x", None), ("new", "2024-01-09")])
    for watermark in (None, day(DAYS[2])):
        late = late_rows_of(batch, held, watermark)
        assert bag(late) == [("late", day(DAYS[1]))]
        assert "dynamicpruning" in plan_of(late)
        assert bag(late) == bag(late_rows(batch, held))
    assert bag(late_rows_of(batch, held, day("2023-12-31"))) == []
    assert bag(late_rows_of(batch, target(spark, []))) == []
    assert bag(late_rows_of(source(spark, []), held)) == []


def test_watermark_prunes_folders(spark, orders, tmp_path):
    path = str(tmp_path / "t")
    orders.filter("utc_date is not null").write.partitionBy("utc_date").parquet(path)
    table = spark.read.parquet(path)
    literal = after_watermark(table, day(DAYS[1]))
    assert "PartitionFilters: [isnotnull(utc_date" in plan_of(literal)
    assert len(literal.inputFiles()) > 0
    lazy = after_watermark(table, high_watermark(target(spark, [("a", DAYS[1])])))
    assert tuples(lazy) == [("c", day(DAYS[2]))]
    scan = [line for line in plan_of(lazy).split("\n") if "FileScan" in line]
    assert any("PartitionFilters: [(isnull(Subquery" in line
               or "PartitionFilters: [(isnull(scalar" in line for line in scan), scan
