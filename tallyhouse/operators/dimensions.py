"""Silver dimensions and the inventory fact, as projections of raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.expressions import date_bucket, open_ended_flag, yes_flag


def _keep(**columns: str) -> list[Column]:
    return [F.col(raw).alias(name) for name, raw in columns.items()]


def _trim(**columns: str) -> list[Column]:
    return [F.trim(raw).alias(name) for name, raw in columns.items()]


def _flag(**columns: str) -> list[Column]:
    return [yes_flag(raw).alias(name) for name, raw in columns.items()]


def dim_date(date_dim: DataFrame) -> DataFrame:
    return date_dim.where("d_date_sk IS NOT NULL").select(
        *_keep(
            date_key="d_date_sk",
            calendar_date="d_date",
            calendar_year="d_year",
            month_of_year="d_moy",
            day_of_month="d_dom",
            quarter_of_year="d_qoy",
        ),
        *_trim(quarter_name="d_quarter_name"),
        *_keep(
            week_seq="d_week_seq",
            month_seq="d_month_seq",
            quarter_seq="d_quarter_seq",
            day_of_week="d_dow",
        ),
        *_trim(day_name="d_day_name"),
        *_flag(
            is_weekend="d_weekend",
            is_holiday="d_holiday",
            is_current_day="d_current_day",
            is_current_week="d_current_week",
            is_current_month="d_current_month",
            is_current_year="d_current_year",
        ),
    )


def with_date_bucket(dates: DataFrame, low: int, high: int, width: int = 365) -> DataFrame:
    """Give the calendar the bucket column of a bucketed fact, so a join on both prunes it."""
    return dates.withColumn(
        "date_bucket", date_bucket("date_key", F.lit(low), F.lit(high), width)
    )


def dim_item(item: DataFrame) -> DataFrame:
    """All versions of an item, with the open-ended one flagged."""
    return item.where("i_item_sk IS NOT NULL").select(
        *_keep(item_key="i_item_sk", item_id="i_item_id", item_description="i_item_desc"),
        *_trim(product_name="i_product_name", brand="i_brand"),
        *_keep(brand_id="i_brand_id"),
        *_trim(item_class="i_class"),
        *_keep(item_class_id="i_class_id"),
        *_trim(category="i_category"),
        *_keep(category_id="i_category_id"),
        *_trim(manufacturer="i_manufact"),
        *_keep(manufacturer_id="i_manufact_id"),
        *_trim(size="i_size", color="i_color", units="i_units", container="i_container"),
        *_keep(
            manager_id="i_manager_id",
            current_price="i_current_price",
            wholesale_cost="i_wholesale_cost",
            rec_start_date="i_rec_start_date",
            rec_end_date="i_rec_end_date",
        ),
        open_ended_flag("i_rec_end_date").alias("is_current"),
    )


def dim_store(store: DataFrame) -> DataFrame:
    return store.where("s_store_sk IS NOT NULL").select(
        *_keep(store_key="s_store_sk", store_id="s_store_id"),
        *_trim(store_name="s_store_name", manager="s_manager", company_name="s_company_name"),
        *_keep(employees="s_number_employees", floor_space="s_floor_space"),
        *_trim(hours="s_hours", city="s_city", county="s_county"),
        *_keep(state="s_state"),
        *_trim(zip="s_zip", country="s_country"),
        *_keep(
            gmt_offset="s_gmt_offset",
            tax_percentage="s_tax_precentage",
            rec_start_date="s_rec_start_date",
            rec_end_date="s_rec_end_date",
        ),
        open_ended_flag("s_rec_end_date").alias("is_current"),
    )


def dim_promotion(promotion: DataFrame) -> DataFrame:
    media = "dmail email catalog tv radio press event demo".split()
    return promotion.where("p_promo_sk IS NOT NULL").select(
        *_keep(promo_key="p_promo_sk", promo_id="p_promo_id"),
        *_trim(promo_name="p_promo_name"),
        *_keep(cost="p_cost", response_target="p_response_target"),
        *_trim(purpose="p_purpose"),
        *_flag(is_active="p_discount_active"),
        *_flag(**{f"via_{medium}": f"p_channel_{medium}" for medium in media}),
        *_keep(
            start_date_key="p_start_date_sk", end_date_key="p_end_date_sk", item_key="p_item_sk"
        ),
    )


def dim_customer(
    customer: DataFrame,
    address: DataFrame,
    demographics: DataFrame,
    household: DataFrame,
    income_band: DataFrame,
) -> DataFrame:
    """Customers with their current address, demographics, household and income band.

    No broadcast hints: the sizes decide, and a hot address or household is split
    by the adaptive skew join, as every join keeps the customer side.
    """
    joined = (
        customer.where("c_customer_sk IS NOT NULL")
        .join(address, F.col("c_current_addr_sk") == F.col("ca_address_sk"), "left")
        .join(demographics, F.col("c_current_cdemo_sk") == F.col("cd_demo_sk"), "left")
        .join(household, F.col("c_current_hdemo_sk") == F.col("hd_demo_sk"), "left")
        .join(income_band, F.col("hd_income_band_sk") == F.col("ib_income_band_sk"), "left")
    )
    full_name = F.concat(F.trim("c_first_name"), F.lit(" "), F.trim("c_last_name"))
    return joined.select(
        *_keep(customer_key="c_customer_sk", customer_id="c_customer_id"),
        *_trim(salutation="c_salutation", first_name="c_first_name", last_name="c_last_name"),
        full_name.alias("customer_name"),
        *_flag(is_preferred_customer="c_preferred_cust_flag"),
        *_keep(
            birth_year="c_birth_year",
            birth_country="c_birth_country",
            email_address="c_email_address",
            first_sales_date_key="c_first_sales_date_sk",
            first_shipto_date_key="c_first_shipto_date_sk",
            city="ca_city",
            county="ca_county",
            state="ca_state",
            zip="ca_zip",
            country="ca_country",
            gmt_offset="ca_gmt_offset",
            gender="cd_gender",
            marital_status="cd_marital_status",
            education_status="cd_education_status",
            credit_rating="cd_credit_rating",
            purchase_estimate="cd_purchase_estimate",
            dependent_count="cd_dep_count",
        ),
        *_trim(buy_potential="hd_buy_potential"),
        *_keep(
            vehicle_count="hd_vehicle_count",
            income_lower_bound="ib_lower_bound",
            income_upper_bound="ib_upper_bound",
        ),
    )


def fact_inventory(inventory: DataFrame) -> DataFrame:
    """Stock per date, item and warehouse; rows without all three keys are left out."""
    keys = ["inv_date_sk", "inv_item_sk", "inv_warehouse_sk"]
    return inventory.dropna(subset=keys).select(
        *_keep(
            date_sk="inv_date_sk",
            item_sk="inv_item_sk",
            warehouse_sk="inv_warehouse_sk",
            quantity_on_hand="inv_quantity_on_hand",
        ),
        "_batch_id",
    )
