from datetime import date

import pytest

from tallyhouse.functions.expressions import day_key, yes_flag
from tallyhouse.operators import dimensions
from tallyhouse.sources.schemas import LINEAGE, SCHEMAS


def frame(spark, table, *rows):
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SCHEMAS[table])
    data = [[r.get(c) for c in SCHEMAS[table].names] + [None, None, "b1"] for r in rows]
    return spark.createDataFrame(data, f"{ddl}, {LINEAGE}")


@pytest.mark.parametrize("value, flag", [("y", 1), ("Y ", 1), ("N", 0), (None, 0), ("", 0)])
def test_yes_flag(spark, value, flag):
    df = spark.createDataFrame([(value,)], "f string")
    assert df.select(yes_flag("f")).first()[0] == flag


def test_customer_joins_and_name(spark):
    customer = frame(
        spark, "customer",
        {"c_customer_sk": 1, "c_first_name": " Ann ", "c_last_name": "Lee ", "c_current_addr_sk": 10,
         "c_current_cdemo_sk": 20, "c_current_hdemo_sk": 30, "c_preferred_cust_flag": "y"},
        {"c_customer_sk": 2, "c_last_name": "X", "c_current_hdemo_sk": 31},
        {"c_customer_sk": None, "c_last_name": "dropped"},
    )
    dim = dimensions.dim_customer(
        customer,
        frame(spark, "customer_address", {"ca_address_sk": 10, "ca_city": "Oslo"}),
        frame(spark, "customer_demographics", {"cd_demo_sk": 20, "cd_gender": "F"}),
        frame(
            spark, "household_demographics",
            {"hd_demo_sk": 30, "hd_income_band_sk": 5, "hd_buy_potential": " >10000 "},
            {"hd_demo_sk": 31, "hd_income_band_sk": 9},
        ),
        frame(spark, "income_band", {"ib_income_band_sk": 5, "ib_lower_bound": 1, "ib_upper_bound": 2}),
    )
    rows = {r.customer_key: r for r in dim.collect()}
    assert set(rows) == {1, 2}
    one = rows[1]
    assert (one.customer_name, one.city, one.gender, one.buy_potential) == ("Ann Lee", "Oslo", "F", ">10000")
    assert (one.income_lower_bound, one.income_upper_bound, one.is_preferred_customer) == (1, 2, 1)
    assert rows[2].customer_name is None and rows[2].city is None
    assert rows[2].income_lower_bound is None
    assert len(dim.columns) == 28


def test_item_versions(spark):
    item = frame(
        spark, "item",
        {"i_item_sk": 1, "i_item_id": "A", "i_rec_end_date": date(2000, 1, 1), "i_brand": " b "},
        {"i_item_sk": 2, "i_item_id": "A"},
        {"i_item_id": "no key"},
    )
    rows = {r.item_key: r for r in dimensions.dim_item(item).collect()}
    assert {k: r.is_current for k, r in rows.items()} == {1: 0, 2: 1}
    assert rows[1].brand == "b"


def test_promotion_flags(spark):
    promotion = frame(
        spark, "promotion",
        {"p_promo_sk": 1, "p_promo_name": " spring ", "p_channel_tv": "Y", "p_discount_active": "y"},
        {"p_promo_sk": None},
    )
    dim = dimensions.dim_promotion(promotion)
    row = dim.collect()
    assert len(row) == 1 and len(dim.columns) == 18
    assert (row[0].promo_name, row[0].via_tv, row[0].via_radio, row[0].is_active) == ("spring", 1, 0, 1)


def test_store_date_and_inventory(spark):
    store = dimensions.dim_store(frame(spark, "store", {"s_store_sk": 1, "s_city": " Rome "}))
    assert (store.first().city, store.first().is_current) == ("Rome", 1)
    dates = dimensions.dim_date(
        frame(spark, "date_dim", {"d_date_sk": 1, "d_weekend": "Y", "d_day_name": "Sunday   "})
    )
    row = dates.first()
    assert (row.is_weekend, row.is_holiday, row.day_name) == (1, 0, "Sunday")
    stock = dimensions.fact_inventory(
        frame(
            spark, "inventory",
            {"inv_date_sk": 1, "inv_item_sk": 2, "inv_warehouse_sk": 3, "inv_quantity_on_hand": None},
            {"inv_date_sk": 1, "inv_item_sk": 2},
        )
    )
    assert [tuple(r) for r in stock.collect()] == [(1, 2, 3, None, "b1")]


def test_day_key(spark):
    df = spark.createDataFrame([(date(1995, 1, 1),), (date(2002, 1, 1),)], "d date")
    assert [r[0] for r in df.select(day_key(df.d)).collect()] == [2449719, 2452276]
