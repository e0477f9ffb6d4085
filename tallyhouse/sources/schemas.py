"""Column contract of the 25 raw tables.

Every raw column is the table's prefix plus a field name, and the type follows
from the field name, so a table is declared as its ordered field names only.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: field names of the public TPC-DS schema -------------------
ADDRESS = "street_number street_name street_type suite_number city county state zip country gmt_offset"
REC_DATES = "rec_start_date rec_end_date"
SALE_PRICES = (
    "wholesale_cost list_price sales_price ext_discount_amt ext_sales_price "
    "ext_wholesale_cost ext_list_price ext_tax coupon_amt"
)
SHIPPED_SALE_TOTALS = (
    "ext_ship_cost net_paid net_paid_inc_tax net_paid_inc_ship net_paid_inc_ship_tax net_profit"
)
BILL_TO = "bill_customer_sk bill_cdemo_sk bill_hdemo_sk bill_addr_sk"
SHIP_TO = "ship_customer_sk ship_cdemo_sk ship_hdemo_sk ship_addr_sk"
REFUNDED = "refunded_customer_sk refunded_cdemo_sk refunded_hdemo_sk refunded_addr_sk"
RETURNING = "returning_customer_sk returning_cdemo_sk returning_hdemo_sk returning_addr_sk"

# table -> (column prefix, ordered field names)
FIELDS: dict[str, tuple[str, str]] = {
    "call_center": (
        "cc",
        f"call_center_sk call_center_id {REC_DATES} closed_date_sk open_date_sk name class "
        "employees sq_ft hours manager mkt_id mkt_class mkt_desc market_manager division "
        f"division_name company company_name {ADDRESS} tax_percentage",
    ),
    "catalog_page": (
        "cp",
        "catalog_page_sk catalog_page_id start_date_sk end_date_sk department catalog_number "
        "catalog_page_number description type",
    ),
    "catalog_returns": (
        "cr",
        f"returned_date_sk returned_time_sk item_sk {REFUNDED} {RETURNING} call_center_sk "
        "catalog_page_sk ship_mode_sk warehouse_sk reason_sk order_number return_quantity "
        "return_amount return_tax return_amt_inc_tax fee return_ship_cost refunded_cash "
        "reversed_charge store_credit net_loss",
    ),
    "catalog_sales": (
        "cs",
        f"sold_date_sk sold_time_sk ship_date_sk {BILL_TO} {SHIP_TO} call_center_sk "
        "catalog_page_sk ship_mode_sk warehouse_sk item_sk promo_sk order_number quantity "
        f"{SALE_PRICES} {SHIPPED_SALE_TOTALS}",
    ),
    "customer": (
        "c",
        "customer_sk customer_id current_cdemo_sk current_hdemo_sk current_addr_sk "
        "first_shipto_date_sk first_sales_date_sk salutation first_name last_name "
        "preferred_cust_flag birth_day birth_month birth_year birth_country login "
        "email_address last_review_date",
    ),
    "customer_address": ("ca", f"address_sk address_id {ADDRESS} location_type"),
    "customer_demographics": (
        "cd",
        "demo_sk gender marital_status education_status purchase_estimate credit_rating "
        "dep_count dep_employed_count dep_college_count",
    ),
    "date_dim": (
        "d",
        "date_sk date_id date month_seq week_seq quarter_seq year dow moy dom qoy fy_year "
        "fy_quarter_seq fy_week_seq day_name quarter_name holiday weekend following_holiday "
        "first_dom last_dom same_day_ly same_day_lq current_day current_week current_month "
        "current_quarter current_year",
    ),
    "dbgen_version": ("dv", "version create_date create_time cmdline_args"),
    "household_demographics": (
        "hd",
        "demo_sk income_band_sk buy_potential dep_count vehicle_count",
    ),
    "income_band": ("ib", "income_band_sk lower_bound upper_bound"),
    "inventory": ("inv", "date_sk item_sk warehouse_sk quantity_on_hand"),
    "item": (
        "i",
        f"item_sk item_id {REC_DATES} item_desc current_price wholesale_cost brand_id brand "
        "class_id class category_id category manufact_id manufact size formulation color units "
        "container manager_id product_name",
    ),
    "promotion": (
        "p",
        "promo_sk promo_id start_date_sk end_date_sk item_sk cost response_target promo_name "
        "channel_dmail channel_email channel_catalog channel_tv channel_radio channel_press "
        "channel_event channel_demo channel_details purpose discount_active",
    ),
    "reason": ("r", "reason_sk reason_id reason_desc"),
    "ship_mode": ("sm", "ship_mode_sk ship_mode_id type code carrier contract"),
    "store": (
        "s",
        f"store_sk store_id {REC_DATES} closed_date_sk store_name number_employees floor_space "
        "hours manager market_id geography_class market_desc market_manager division_id "
        f"division_name company_id company_name {ADDRESS} tax_precentage",
    ),
    "store_returns": (
        "sr",
        "returned_date_sk return_time_sk item_sk customer_sk cdemo_sk hdemo_sk addr_sk store_sk "
        "reason_sk ticket_number return_quantity return_amt return_tax return_amt_inc_tax fee "
        "return_ship_cost refunded_cash reversed_charge store_credit net_loss",
    ),
    "store_sales": (
        "ss",
        "sold_date_sk sold_time_sk item_sk customer_sk cdemo_sk hdemo_sk addr_sk store_sk "
        f"promo_sk ticket_number quantity {SALE_PRICES} net_paid net_paid_inc_tax net_profit",
    ),
    "time_dim": ("t", "time_sk time_id time hour minute second am_pm shift sub_shift meal_time"),
    "warehouse": ("w", f"warehouse_sk warehouse_id warehouse_name warehouse_sq_ft {ADDRESS}"),
    "web_page": (
        "wp",
        f"web_page_sk web_page_id {REC_DATES} creation_date_sk access_date_sk autogen_flag "
        "customer_sk url type char_count link_count image_count max_ad_count",
    ),
    "web_returns": (
        "wr",
        f"returned_date_sk returned_time_sk item_sk {REFUNDED} {RETURNING} web_page_sk reason_sk "
        "order_number return_quantity return_amt return_tax return_amt_inc_tax fee "
        "return_ship_cost refunded_cash reversed_charge account_credit net_loss",
    ),
    "web_sales": (
        "ws",
        f"sold_date_sk sold_time_sk ship_date_sk item_sk {BILL_TO} {SHIP_TO} web_page_sk "
        "web_site_sk ship_mode_sk warehouse_sk promo_sk order_number quantity "
        f"{SALE_PRICES} {SHIPPED_SALE_TOTALS}",
    ),
    "web_site": (
        "web",
        f"site_sk site_id {REC_DATES} name open_date_sk close_date_sk class manager mkt_id "
        f"mkt_class mkt_desc market_manager company_id company_name {ADDRESS} tax_percentage",
    ),
}

# Types by field name; any other field is text.
DATES = f"{REC_DATES} date create_date".split()
RATES = "gmt_offset tax_percentage tax_precentage".split()
MONEY = (
    f"{SALE_PRICES} {SHIPPED_SALE_TOTALS} current_price return_amt return_amount return_tax "
    "return_amt_inc_tax fee return_ship_cost refunded_cash reversed_charge store_credit "
    "account_credit net_loss"
).split()
NUMBERS = (
    "employees number_employees sq_ft warehouse_sq_ft floor_space mkt_id market_id division "
    "division_id company company_id catalog_number catalog_page_number order_number "
    "ticket_number quantity return_quantity quantity_on_hand birth_day birth_month birth_year "
    "purchase_estimate dep_count dep_employed_count dep_college_count vehicle_count month_seq "
    "week_seq quarter_seq year dow moy dom qoy fy_year fy_quarter_seq fy_week_seq first_dom "
    "last_dom same_day_ly same_day_lq lower_bound upper_bound brand_id class_id category_id "
    "manufact_id manager_id response_target time hour minute second char_count link_count "
    "image_count max_ad_count"
).split()
# --- end of fixed values -----------------------------------------------------


def field_type(field: str) -> T.DataType:
    if field.endswith("_sk") or field in NUMBERS:
        return T.IntegerType()
    if field in DATES:
        return T.DateType()
    if field in RATES:
        return T.DecimalType(5, 2)
    if field in MONEY:
        return T.DecimalType(7, 2)
    if field == "cost":
        return T.DecimalType(15, 2)
    return T.StringType()


def _schema(prefix: str, fields: str) -> T.StructType:
    return T.StructType(
        [T.StructField(f"{prefix}_{field}", field_type(field), True) for field in fields.split()]
    )


SCHEMAS: dict[str, T.StructType] = {
    table: _schema(prefix, fields) for table, (prefix, fields) in FIELDS.items()
}


def columns_for(table: str) -> list[str]:
    return SCHEMAS[table].names


LINEAGE = "_ingested_at timestamp, _source_file string, _batch_id string"
RUN_LOG = (
    "step_run string, batch_id string, layer string, step string, status string, "
    "rows_in bigint, rows_out bigint, started_at timestamp, ended_at timestamp, "
    "duration_sec decimal(10,2), tool string, message string"
)
DQ_RESULT = (
    "batch_id string, suite string, table_name string, expectation string, success tinyint, "
    "observed_value string, run_at timestamp"
)
PERF_LOG = (
    "run_id string, phase string, query_name string, iteration int, duration_sec decimal(10,3), "
    "rows_returned bigint, started_at timestamp, notes string"
)
