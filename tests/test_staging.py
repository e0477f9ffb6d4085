from decimal import Decimal

from tallyhouse.operators.staging import (
    RETURN_FIELDS,
    SALE_FIELDS,
    stage_returns,
    stage_sales,
    union_channels,
)
from tallyhouse.sources.schemas import LINEAGE, SCHEMAS


def raw(spark, table, **values):
    columns = SCHEMAS[table].names
    row = [values.get(c) for c in columns] + [None, "f.dat", "b1"]
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SCHEMAS[table])
    return spark.createDataFrame([row], f"{ddl}, {LINEAGE}")


def test_store_sales(spark):
    df = raw(spark, "store_sales", ss_ticket_number=7, ss_item_sk=1, ss_net_paid=Decimal("2.50"))
    staged = stage_sales(df, "store")
    row = staged.first()
    assert staged.columns[:2] == ["channel", "sale_order_id"]
    assert len(staged.columns) == 1 + len(SALE_FIELDS) + 3 == 37
    assert (row.channel, row.sale_order_id, row.item_sk) == ("store", 7, 1)
    assert dict(staged.dtypes)["sale_order_id"] == "bigint"
    assert row.ext_ship_cost is None and row.web_site_sk is None
    assert row._batch_id == "b1"


def test_bill_customer_is_the_customer_of_record(spark):
    for channel, prefix in [("catalog", "cs"), ("web", "ws")]:
        values = {f"{prefix}_bill_customer_sk": 5, f"{prefix}_ship_customer_sk": 6}
        df = raw(spark, f"{channel}_sales", **values, **{f"{prefix}_order_number": 9})
        row = stage_sales(df, channel).first()
        assert (row.customer_sk, row.sale_order_id) == (5, 9)


def test_returns(spark):
    store = raw(
        spark, "store_returns", sr_customer_sk=3, sr_return_ship_cost=Decimal("1.00"),
        sr_store_credit=Decimal("4.00"), sr_return_time_sk=11,
    )
    catalog = raw(
        spark, "catalog_returns", cr_refunded_customer_sk=1, cr_returning_customer_sk=2,
        cr_return_amount=Decimal("8.00"), cr_store_credit=Decimal("5.00"),
    )
    web = raw(spark, "web_returns", wr_account_credit=Decimal("6.00"), wr_web_page_sk=4)
    frames = {"store": store, "catalog": catalog, "web": web}
    staged = union_channels([stage_returns(df, channel) for channel, df in frames.items()])
    assert len(staged.columns) == 1 + len(RETURN_FIELDS) + 3 == 30
    rows = {r.channel: r for r in staged.collect()}
    assert (rows["store"].refunded_customer_sk, rows["store"].returning_customer_sk) == (3, 3)
    assert rows["store"].return_ship_cost is None
    assert rows["store"].returned_time_sk == 11
    assert rows["catalog"].return_amt == Decimal("8.00")
    assert [rows[c].credit for c in ("store", "catalog", "web")] == [
        Decimal("4.00"), Decimal("5.00"), Decimal("6.00"),
    ]
    assert rows["web"].web_page_sk == 4 and rows["web"].call_center_sk is None
