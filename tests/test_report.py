from decimal import Decimal

import pytest

from helpers import GOLD, day, money, tuples
from millrace.operators.report import complete_months, mom_growth, monthly_sales, sales_report

# The published report of one product, April 2020 to March 2023.
GOLDEN = """
2020 Apr 106.08 106.08 0
2020 May 229.84 123.76 116.67
2020 Jun 229.84 0 0
2020 Jul 123.76 -106.08 -46.15
2020 Aug 123.76 0 0
2020 Sep 123.76 0 0
2020 Oct 318.24 194.48 157.14
2020 Nov 123.76 -194.48 -61.11
2020 Dec 265.2 141.44 114.29
2021 Jan 123.76 -141.44 -53.33
2021 Feb 123.76 0 0
2021 Mar 159.12 35.36 28.57
2021 Apr 159.12 0 0
2021 May 194.48 35.36 22.22
2021 Jun 247.52 53.04 27.27
2021 Jul 212.16 -35.36 -14.29
2021 Aug 282.88 70.72 33.33
2021 Sep 194.48 -88.4 -31.25
2021 Oct 229.84 35.36 18.18
2021 Nov 247.52 17.68 7.69
2021 Dec 212.16 -35.36 -14.29
2022 Jan 212.16 0 0
2022 Feb 176.8 -35.36 -16.67
2022 Mar 159.12 -17.68 -10
2022 Apr 212.16 53.04 33.33
2022 May 282.88 70.72 33.33
2022 Jun 212.16 -70.72 -25
2022 Jul 229.84 17.68 8.33
2022 Aug 88.4 -141.44 -61.54
2022 Sep 123.76 35.36 40
2022 Oct 141.44 17.68 14.29
2022 Nov 212.16 70.72 50
2022 Dec 212.16 0 0
2023 Jan 141.44 -70.72 -33.33
2023 Feb 159.12 17.68 12.5
2023 Mar 141.44 -17.68 -11.11
"""
MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()


def golden_rows():
    for line in GOLDEN.split("\n")[1:-1]:
        year, label, total, growth, percent = line.split()
        yield int(year), label, Decimal(total), Decimal(growth), Decimal(percent)


def gold_rows(spark, rows):
    """``(product, day, price)`` rows as a gold table."""
    return spark.createDataFrame(
        [("e", p, day(d), day(d).year, day(d).month, "purchase", money(v)) for p, d, v in rows],
        GOLD)


def monthly(spark, rows):
    return spark.createDataFrame(
        [("p", y, m, money(v)) for y, m, v in rows],
        "product_id string, year int, month int, total_sales decimal(18,2)")


def test_published_report_is_reproduced(spark):
    sold = []
    for year, label, total, _, _ in golden_rows():
        month = MONTHS.index(label) + 1
        half = total / 2
        sold += [("product0", f"{year}-{month:02d}-03", str(half)),
                 ("product0", f"{year}-{month:02d}-28", str(total - half)),
                 ("product1", f"{year}-{month:02d}-31" if month in (1, 3, 5, 7, 8, 10, 12)
                  else f"{year}-{month:02d}-28", "1")]
    products = spark.createDataFrame([("product0", "Tumbler"), ("product1", "Mug")],
                                     "product_id string, product_name string")
    report = sales_report(gold_rows(spark, sold), products, "product0")
    assert report.columns == ["product_name", "year", "aliased_month", "total_sales",
                              "MoM_growth", "MoM_pct_growth"]
    assert tuples(report) == [("Tumbler", *row) for row in golden_rows()]


def test_growth_over_missing_month_zero_total_and_year_end(spark):
    df = monthly(spark, [(2021, 2, "5"), (2020, 12, "0"), (2020, 11, "10")])
    got = [(r.year, r.month, r.MoM_growth, r.MoM_pct_growth)
           for r in mom_growth(df).orderBy("year", "month").collect()]
    assert got == [(2020, 11, money("10"), money("0")), (2020, 12, money("-10"), money("-100")),
                   (2021, 2, money("5"), money("0"))]


def test_products_do_not_mix(spark):
    df = gold_rows(spark, [("p", "2024-01-31", "1"), ("q", "2024-01-31", "7"),
                           ("q", "2024-02-29", "9")])
    products = spark.createDataFrame([("p", "P")], "product_id string, product_name string")
    assert tuples(sales_report(df, products)) == [
        ("P", 2024, "Jan", money("1"), money("1"), money("0")),
        (None, 2024, "Jan", money("7"), money("7"), money("0")),
        (None, 2024, "Feb", money("9"), money("2"), money("28.57"))]


@pytest.mark.parametrize("as_of, kept", [
    (None, 2), ("2024-03-15", 2), ("2024-03-31", 3), ("2024-02-29", 2), ("2024-02-28", 1)])
def test_only_complete_months_count(spark, as_of, kept):
    df = gold_rows(spark, [("p", "2024-01-31", "1"), ("p", "2024-02-29", "2"),
                           ("p", "2024-03-15", "4")])
    months = monthly_sales(complete_months(df, as_of and day(as_of)))
    assert months.count() == kept


def test_the_cutoff_of_one_product_follows_all_products(spark):
    df = gold_rows(spark, [("p", "2024-01-10", "1"), ("q", "2024-02-29", "2")])
    products = spark.createDataFrame([], "product_id string, product_name string")
    assert [r.aliased_month for r in sales_report(df, products, "p").collect()] == ["Jan"]


def test_empty_gold_gives_an_empty_report(spark):
    products = spark.createDataFrame([], "product_id string, product_name string")
    assert tuples(sales_report(spark.createDataFrame([], GOLD), products)) == []
