"""Bronze table schemas and the column lists that define a well-formed table."""

# Column names and types of the four bronze tables.
BRONZE_SCHEMAS = {
    "users": "account_id string, email string, first_time_time_stamp bigint",
    "products": "product_id string, product_name string, price decimal(18,2)",
    "transactions": (
        "email string, items array<string>, order_id string, total_item_quantity int, "
        "total_purchase_usd decimal(18,2), transaction_timestamp bigint, "
        "transaction_type string, utc_date date"
    ),
    "clickstream": (
        "campaign string, currency string, cust_hit_time_gmt bigint, cust_visid string, "
        "event_list string, first_hit_time_gmt bigint, hit_time_gmt bigint, "
        "hitid_high bigint, hitid_low bigint, os string, page_url string, pagename string, "
        "product_list string, visid_high bigint, visid_low bigint, "
        "visit_start_time_gmt bigint, evar1 string, evar2 string, evar3 string, "
        "evar4 string, evar5 string, evar6 string, utc_date date"
    ),
}

# Full-snapshot tables and incremental fact tables.
SNAPSHOT_TABLES = ("products", "users")
SNAPSHOT_KEYS = {"products": "product_id", "users": "account_id"}
FACT_TABLES = ("transactions", "clickstream")

# The columns a transactions table must have, and those that must not be null.
TRANSACTION_COLUMNS = (
    "email", "items", "order_id", "total_item_quantity", "total_purchase_usd",
    "transaction_timestamp", "transaction_type", "utc_date",
)
TRANSACTION_NOT_NULL = (
    "email", "transaction_type", "total_item_quantity", "items", "utc_date",
    "total_purchase_usd",
)

CONTROL_TOTALS_SCHEMA = "utc_date date, hits_num bigint, visitors_num bigint"
