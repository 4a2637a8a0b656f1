"""The registered queries in ANSI SQL, for a second engine on the same Parquet tables.

Built from CTE blocks: the bronze-shaped tables, then silver, gold and the scenarios.
"""

from __future__ import annotations

TRANSACTIONS_OF = """
  select {email} as email,
         list(p_brand order by l_linenumber, l_partkey) as items,
         o_orderkey || '-' || type as order_id,
         cast(count(*) as integer) as total_item_quantity,
         cast(sum(cast(l_extendedprice as decimal(18,2))) as decimal(18,2)) as total_purchase_usd,
         cast(epoch(o_orderdate) as bigint) as transaction_timestamp,
         type as transaction_type,
         cast(o_orderdate as date) as utc_date
  from {orders}
  join (select *, case when l_returnflag = 'R' then 'return' else 'purchase' end as type
        from lineitem) on l_orderkey = o_orderkey
  join part on p_partkey = l_partkey
  join customer on c_custkey = o_custkey
  group by o_orderkey, o_orderdate, type, c_name, c_acctbal
"""

EMAIL = "c_name || '@example.com'"

USERS = """
users as (
  select cast(c_custkey as varchar) as account_id, c_name || '@example.com' as email,
         1577836800 + c_custkey * 3600 as first_time_time_stamp
  from customer)"""

ALL_PRODUCTS = """
all_products as (
  select p_brand as product_id, 'Product ' || p_brand as product_name,
         cast(min(p_retailprice) as decimal(18,2)) as price
  from part group by p_brand)"""

PRODUCTS = f"""{ALL_PRODUCTS},
products as (select * from all_products where product_id <> 'Brand#25')"""

TRANSACTIONS = f"""
transactions as ({TRANSACTIONS_OF.format(email=EMAIL, orders="orders")})"""

SILVER_TARGET = f"""
silver_target as (
  select * exclude (utc_date), utc_date as date from ({TRANSACTIONS_OF.format(email=EMAIL, orders='''(
    select * from orders
    where cast(o_orderdate as date) <= date '2001-06-30'
      and not (cast(o_orderdate as date) >= date '2001-06-01'
               and o_orderpriority = '1-URGENT'))''')}))"""

TX_DIRTY = f"""
tx_delivered as ({TRANSACTIONS_OF.format(
    email=f"case when c_acctbal >= 0 then {EMAIL} end", orders="orders")}),
tx_dirty as (
  select * from tx_delivered
  union all
  select * from tx_delivered where utc_date >= date '2001-07-01')"""

CLICKSTREAM_OF = """
  select cast(null as varchar) as campaign, 'USD' as currency,
         cast(floor(epoch(ts)) as bigint) as cust_hit_time_gmt,
         cast(null as varchar) as cust_visid, props as event_list,
         cast(floor(epoch(ts)) as bigint) - 60 as first_hit_time_gmt,
         cast(floor(epoch(ts)) as bigint) as hit_time_gmt,
         event_id // 100 as hitid_high, event_id % 100 as hitid_low,
         cast(null as varchar) as os, cast(null as varchar) as page_url,
         event_type as pagename, cast(null as varchar) as product_list,
         user_id // 16 as visid_high, user_id % 16 as visid_low,
         cast(floor(epoch(ts)) as bigint) - 600 as visit_start_time_gmt,
         cast(null as varchar) as evar1, cast(null as varchar) as evar2,
         cast(null as varchar) as evar3, cast(null as varchar) as evar4,
         cast(null as varchar) as evar5, cast(null as varchar) as evar6,
         cast(ts as date) as utc_date
  from events
"""

CLICKSTREAM = f"""
clickstream as ({CLICKSTREAM_OF})"""

CLICKS_BASE = f"""
clicks_base as ({CLICKSTREAM_OF} where event_type <> 'error')"""

CLICKS_ATTEMPT = f"""
clicks_attempt as ({CLICKSTREAM_OF}
  where event_type in ('error', 'click')
    and not (event_type = 'error' and cast(ts as date) = date '2024-01-15'))"""

CLICK_IDS = "hitid_high, hitid_low, visid_high, visid_low, utc_date"

MERGED = f"""
merged as (
  select {CLICK_IDS} from clicks_base
  union
  select {CLICK_IDS} from clicks_attempt)"""

CLICKS_3Y = """
clicks_3y as (
  select * replace (cast(utc_date + to_years(case pagename when 'click' then 1
                                             when 'view' then 2 else 0 end) as date) as utc_date)
  from clickstream)"""


def control_totals(name: str, clicks: str) -> str:
    return f"""
{name} as (
  select utc_date, count(*) as hits_num,
         count(distinct (visid_high, visid_low)) as visitors_num
  from {clicks} group by utc_date)"""


CONTROL = control_totals("control_totals", "clickstream")

CONTROL_GAP = """
control_totals_gap as (
  select utc_date, case when utc_date = date '2024-01-04' then 0 else hits_num end as hits_num,
         visitors_num
  from control_totals where utc_date <> date '2024-01-03')"""


def spine(name: str, control: str, start: str, end: str) -> str:
    return f"""
{name} as (
  select utc_date, coalesce(hits_num, 0) as hits_num, coalesce(visitors_num, 0) as visitors_num
  from (select cast(unnest(generate_series(date '{start}', date '{end}', interval 1 day)) as date)
               as utc_date)
  left join {control} using (utc_date))"""


def daily_counts(name: str, clicks: str) -> str:
    return f"""
{name} as (
  select utc_date,
         count(distinct case when visid_high is not null and visid_low is not null
                             then (visid_high, visid_low) end) as num_of_visid,
         count(distinct case when hitid_high is not null and hitid_low is not null
                             then (hitid_high, hitid_low) end) as num_of_hitid
  from {clicks} group by utc_date)"""


def rate(part: str, whole: str) -> str:
    return (f"cast(round(cast(cast({part} as double) / nullif(cast({whole} as double), 0)"
            f" as decimal(28,10)), 4) as decimal(22,4))")


def daily(name: str, clicks: str, control: str, start: str = "2024-01-01",
          end: str = "2024-01-30") -> str:
    """Completeness per day; needs the clicks and control CTEs before it."""
    return f"""{spine(name + "_days", control, start, end)},{daily_counts(name + "_counts", clicks)},
{name}_rates as (
  select utc_date, hits_num, visitors_num, coalesce(num_of_hitid, 0) as num_of_hitid,
         coalesce(num_of_visid, 0) as num_of_visid,
         {rate("coalesce(num_of_hitid, 0)", "hits_num")} as hit_completeness,
         {rate("coalesce(num_of_visid, 0)", "visitors_num")} as visitors_completeness
  from {name}_days left join {name}_counts using (utc_date)),
{name} as (
  select *, coalesce(hit_completeness >= 0.99 and visitors_completeness >= 0.99, false)
            as reach_threshold
  from {name}_rates)"""


SILVER = """
exploded as (select *, unnest(items) as product_id from transactions),
silver as (
  select order_id, email,
         strftime(make_timestamp(transaction_timestamp * 1000000), '%Y-%m-%d %H:%M:%S')
           as transaction_utc_timestamp,
         transaction_type, product_name, product_id, price, utc_date as date
  from exploded join products using (product_id))"""

GOLD = """
daily_signed as (
  select email, product_id, date, cast(year(date) as integer) as year,
         cast(month(date) as integer) as month, transaction_type,
         cast(sum(case when transaction_type = 'return' then -price else price end)
              as decimal(18,2)) as daily_signed_price
  from silver group by email, product_id, date, transaction_type),
gold as (
  select *, lag(daily_signed_price) over (partition by email, product_id
                                          order by date, transaction_type)
            as previous_purchase_signed_price
  from daily_signed)"""

MONTHS = """
cutoff as (
  select case when last_day(max(date)) = max(date) then max(date)
              else last_day(cast(max(date) - interval 1 month as date)) end as last_date
  from gold),
complete as (select * from gold where date <= (select last_date from cutoff)),
monthly as (
  select product_id, year, month,
         cast(round(sum(daily_signed_price), 2) as decimal(18,2)) as total_sales
  from complete group by product_id, year, month),
lagged as (
  select *, lag(total_sales) over (partition by product_id order by year, month) as prev
  from monthly),
growth as (
  select product_id, year, month, total_sales,
         cast(coalesce(round(total_sales - prev, 2), total_sales) as decimal(18,2)) as MoM_growth,
         cast(coalesce(round(cast(cast(round(total_sales - prev, 2) as double)
                                  / nullif(cast(prev as double), 0) * 100
                                  as decimal(28,10)), 2), 0) as decimal(18,2)) as MoM_pct_growth
  from lagged),
report as (
  select product_id, product_name, year,
         case month when 1 then 'Jan' when 2 then 'Feb' when 3 then 'Mar' when 4 then 'Apr'
                    when 5 then 'May' when 6 then 'Jun' when 7 then 'Jul' when 8 then 'Aug'
                    when 9 then 'Sep' when 10 then 'Oct' when 11 then 'Nov'
                    when 12 then 'Dec' end as aliased_month,
         total_sales, MoM_growth, MoM_pct_growth
  from growth left join products using (product_id))"""

REPORT_COLUMNS = "product_name, year, aliased_month, total_sales, MoM_growth, MoM_pct_growth"
ADJUSTED = """case when transaction_type = 'return' and previous_purchase_signed_price is null
            then daily_signed_price
            else daily_signed_price + previous_purchase_signed_price end"""
ANY_NULL = """email is null or transaction_type is null or total_item_quantity is null
   or items is null or utc_date is null or total_purchase_usd is null"""


def gmt(column: str) -> str:
    return f"strftime(make_timestamp({column} * 1000000), '%Y-%m-%d %H:%M:%S')"


SILVER_IDS = (f"hitid_high, hitid_low, visid_high, visid_low, {gmt('hit_time_gmt')} as hit_gmt_timestamp, "
              "utc_date as date")
DAY_COPIES = """
copies as (select *, count(*) as n_dup from tx_dirty group by all)"""


def sql(*ctes: str, select: str) -> str:
    return f"with {','.join(ctes)}\n{select}"


def oracles() -> dict[str, str]:
    to_silver = (PRODUCTS, TRANSACTIONS, SILVER)
    to_gold = (*to_silver, GOLD)
    to_report = (*to_gold, MONTHS)
    repaired = (CLICKSTREAM, CONTROL, CLICKS_BASE, CLICKS_ATTEMPT, MERGED)
    return {
        "scan_table": "select o_orderkey, o_custkey, o_orderstatus, "
                      "cast(o_orderdate as date) as utc_date from orders",
        "control_totals_spine": sql(
            CLICKSTREAM, CONTROL, CONTROL_GAP,
            spine("days", "control_totals_gap", "2024-01-01", "2024-01-30"),
            select="select utc_date, hits_num, visitors_num from days"),
        "explode_items": sql(
            TRANSACTIONS, select="select order_id, unnest(items) as product_id from transactions"),
        "incremental_filter": sql(
            TRANSACTIONS, SILVER_TARGET,
            select="select order_id, transaction_type, utc_date from transactions "
                   "where utc_date > (select max(date) from silver_target)"),
        "late_rows": sql(
            TRANSACTIONS, SILVER_TARGET,
            select="select order_id, utc_date from transactions "
                   "where utc_date <= (select max(date) from silver_target) "
                   "except select order_id, date from silver_target"),
        "late_rows_of_batch": sql(
            TRANSACTIONS, SILVER_TARGET,
            select="select distinct order_id, utc_date from transactions t "
                   "where utc_date <= (select max(date) from silver_target) "
                   "and not exists (select 1 from silver_target s "
                   "where s.date = t.utc_date and s.order_id = t.order_id)"),
        "high_watermark": sql(TRANSACTIONS, select="select max(utc_date) as max_date from transactions"),
        "ingest_range": sql(
            TRANSACTIONS,
            select="select cast(max(utc_date) + interval 1 day as date) as start_date, "
                   "date '2001-08-31' as end_date, "
                   "cast(year(max(utc_date) + interval 1 day) as integer) as year "
                   "from transactions"),
        "load_time": sql(USERS, select="select account_id, '2024-02-01 12:00:00' as etl_loaded_at from users"),
        "last_entries": sql(
            *to_gold, select="select email, product_id, date, transaction_type, daily_signed_price from gold "
                             "qualify row_number() over (partition by email, product_id "
                             "order by date desc, transaction_type desc) = 1"),
        "date_bounds": sql(
            CLICKSTREAM, select="select min(utc_date) as min_date, max(utc_date) as max_date "
                                "from clickstream"),
        "date_range_filter": sql(
            CLICKSTREAM,
            select="select hitid_high, hitid_low, utc_date from clickstream "
                   "where utc_date between date '2024-01-10' and date '2024-01-20'"),
        "silver_users": sql(
            USERS, select=f"select account_id, email, {gmt('first_time_time_stamp')} "
                          "as first_timestamp from users"),
        "silver_products": sql(ALL_PRODUCTS, select="select * from all_products"),
        "silver_transactions": sql(*to_silver, select="select * from silver"),
        "silver_clickstream": sql(
            CLICKSTREAM,
            select=f"""select campaign, currency, {gmt('cust_hit_time_gmt')} as cust_hit_gmt_timestamp,
       cust_visid, event_list, {gmt('first_hit_time_gmt')} as first_hit_gmt_timestamp,
       {gmt('hit_time_gmt')} as hit_gmt_timestamp, hitid_high, hitid_low, os, page_url, pagename,
       product_list, visid_high, visid_low,
       {gmt('visit_start_time_gmt')} as visit_start_gmt_timestamp,
       evar1, evar2, evar3, evar4, evar5, evar6, utc_date as date
from clickstream"""),
        "signed_price": sql(
            *to_silver,
            select="select order_id, product_id, date, transaction_type, price, "
                   "case when transaction_type = 'return' then -price else price end "
                   "as signed_price from silver"),
        "gold_daily_signed": sql(*to_gold, select="select * from daily_signed"),
        "gold_transactions": sql(*to_gold, select="select * from gold"),
        "gold_continued": sql(*to_gold, select="select * from gold"),
        "adjusted_signed_price": sql(
            *to_gold, select=f"select *, cast({ADJUSTED} as decimal(18,2)) "
                             "as adjusted_signed_price from gold"),
        "complete_months": sql(
            *to_report, select="select email, product_id, date, transaction_type from complete"),
        "monthly_sales": sql(*to_report, select="select * from monthly"),
        "mom_growth": sql(*to_report, select="select * from growth"),
        "report_one_product": sql(
            *to_report, select=f"select {REPORT_COLUMNS} from report where product_id = 'Brand#1'"),
        "report_all_products": sql(*to_report, select=f"select {REPORT_COLUMNS} from report"),
        "daily_visitors_hits": sql(
            CLICKSTREAM, daily_counts("counts", "clickstream"), select="select * from counts"),
        "completeness_daily": sql(
            CLICKSTREAM, CONTROL, CONTROL_GAP, CLICKS_BASE,
            daily("daily", "clicks_base", "control_totals_gap"), select="select * from daily"),
        "completeness_verdict": sql(
            *repaired, daily("daily", "merged", "control_totals"),
            select="select count(*) filter (not reach_threshold) as failing_days, "
                   "count(*) filter (not reach_threshold) <= 1 as complete from daily"),
        "completeness_by_year": sql(
            CLICKSTREAM, CLICKS_3Y, control_totals("control_3y", "clicks_3y"),
            daily("daily", "clicks_3y", "control_3y", "2024-01-01", "2026-01-30"),
            select="select cast(year(utc_date) as integer) as year, count(*) as days, "
                   "count(*) filter (not reach_threshold) as failing_days, "
                   "count(*) filter (not reach_threshold) <= 1 as complete "
                   "from daily group by 1"),
        "merge_attempts": sql(*repaired, select="select * from merged"),
        "repair_delta": sql(
            *repaired, select=f"select * from merged except select {CLICK_IDS} from clicks_base"),
        "qa_repair_log": sql(
            *repaired, daily("before", "clicks_base", "control_totals"),
            daily("after", "merged", "control_totals"),
            select="""select a.utc_date, b.num_of_hitid as initial_number_of_hits,
       a.num_of_hitid as QA_number_of_hits, a.hits_num as desired_number_of_hits,
       coalesce(b.hit_completeness, 0) as initial_hit_completeness_rate,
       coalesce(a.hit_completeness, 0) as QA_hit_completeness_rate,
       b.num_of_visid as initial_number_of_visitors, a.num_of_visid as QA_number_of_visitors,
       a.visitors_num as desired_number_visitors,
       coalesce(b.visitors_completeness, 0) as initial_visitors_completeness_rate,
       coalesce(a.visitors_completeness, 0) as QA_visitors_completeness_rate,
       a.reach_threshold as data_quality_reached_expectation
from after a join before b using (utc_date)"""),
        "null_rows": sql(
            TX_DIRTY, select="select order_id, transaction_type, utc_date from tx_dirty "
                             f"where {ANY_NULL}"),
        "duplicate_rows": sql(
            TX_DIRTY, select="select order_id, transaction_type, count(*) as n_dup from tx_dirty "
                             "group by all having count(*) > 1"),
        "transaction_checks": sql(
            TX_DIRTY,
            """
copies as (select *, count(*) as n_dup from tx_dirty group by all),
counts as (
  select cast(coalesce(sum(n_dup) filter (""" + ANY_NULL + """), 0) as bigint) as null_rows,
         count(*) filter (n_dup > 1) as duplicate_groups,
         cast(coalesce(sum(n_dup - 1), 0) as bigint) as surplus_rows
  from copies)""",
            select="select case when null_rows > 0 then 'fail' else 'pass' end as null_check, "
                   "case when duplicate_groups > 0 then 'fail' else 'pass' end "
                   "as duplicates_check, 'pass' as all_cols_check, null_rows, "
                   "duplicate_groups, surplus_rows from counts"),
        "day_checks": sql(
            TX_DIRTY, DAY_COPIES,
            select=f"""select utc_date, cast(sum(n_dup) as bigint) as rows,
       cast(coalesce(sum(n_dup) filter ({ANY_NULL}), 0) as bigint) as null_rows,
       count(*) filter (n_dup > 1) as duplicate_groups, cast(sum(n_dup - 1) as bigint) as surplus_rows
from copies group by utc_date"""),
        "transaction_checks_range": sql(
            TX_DIRTY, DAY_COPIES,
            f"""
counts as (
  select cast(coalesce(sum(n_dup) filter ({ANY_NULL}), 0) as bigint) as null_rows,
         count(*) filter (n_dup > 1) as duplicate_groups,
         cast(coalesce(sum(n_dup - 1), 0) as bigint) as surplus_rows
  from copies where utc_date between date '2000-06-01' and date '2001-07-15')""",
            select="select case when null_rows > 0 then 'fail' else 'pass' end as null_check, "
                   "case when duplicate_groups > 0 then 'fail' else 'pass' end "
                   "as duplicates_check, 'pass' as all_cols_check, null_rows, "
                   "duplicate_groups, surplus_rows from counts"),
        "column_check": sql(
            TRANSACTIONS,
            select="""select case when utc_date between date '1998-01-01' and date '1999-12-31'
            then 'email' else '' end as missing,
       case when utc_date >= date '2000-01-01' then 'channel' else '' end as extra,
       case when utc_date < date '1998-01-01' then 'pass' else 'fail' end as all_cols_check,
       count(*) as n_rows
from transactions group by all"""),
        "qa_history": sql(
            CLICKSTREAM, CLICKS_3Y, control_totals("control_3y", "clicks_3y"),
            daily("daily", "clicks_3y", "control_3y", "2024-01-01", "2026-01-30"), select="select * from daily"),
        "both_ingests": sql(
            CLICKSTREAM, select=f"select {CLICK_IDS}, hit_time_gmt from clickstream"),
        "snapshot_redelivered": sql(
            *to_silver, select="select order_id, product_id, product_name, cast(case product_id when 'Brand#1' "
                               "then 2 * price else price end as decimal(18,2)) as price from silver"),
        "repair_reaches_silver": sql(
            CLICKSTREAM, select=f"""select {SILVER_IDS} from clickstream
where not (pagename = 'error' and utc_date = date '2024-01-15')"""),
        "late_days_reach_silver": sql(CLICKSTREAM, select=f"select {SILVER_IDS} from clickstream"),
        "medallion_run": sql(*to_report, select=f"select {REPORT_COLUMNS} from report"),
        "landing_ingest": sql(
            CLICKSTREAM, select=f"select {CLICK_IDS}, hit_time_gmt from clickstream"),
        "recursive_scan": sql(
            CLICKSTREAM, select="select hitid_high, hitid_low, hit_time_gmt from clickstream"),
        "partition_replace": sql(
            CLICKSTREAM, select=f"select hitid_high, hitid_low, {gmt('hit_time_gmt')} "
                                "as hit_gmt_timestamp, utc_date as date from clickstream"),
        "repair_run": sql(*repaired, select="select * from merged"),
    }
