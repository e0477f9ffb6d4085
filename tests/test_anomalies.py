import pytest

from tallyhouse.operators.anomalies import RETURN_RULES, SALES_RULES, tag_anomalies

SALES = "item_sk int, sale_order_id bigint, sold_date_sk int, quantity int, sales_price double, net_paid double"
RETURNS = "item_sk int, return_order_id bigint, returned_date_sk int, return_quantity int, return_amt double"


@pytest.mark.parametrize(
    "row, reason",
    [
        ((None, None, 1, 0, 1.0, 1.0), "missing_item_sk"),
        ((1, None, None, 1, 1.0, 1.0), "missing_order_id"),
        ((1, 1, None, 0, 1.0, 1.0), "missing_sold_date"),
        ((1, 1, 1, 0, -1.0, 1.0), "non_positive_quantity"),
        ((1, 1, 1, 1, -0.01, -1.0), "negative_sales_price"),
        ((1, 1, 1, 1, 0.0, -0.01), "negative_net_paid"),
        ((1, 1, 1, None, None, None), None),
        ((1, 1, 1, 1, 0.0, 0.0), None),
    ],
)
def test_sales_rules(spark, row, reason):
    tagged = tag_anomalies(spark.createDataFrame([row], SALES), SALES_RULES)
    assert tagged.first()._anomaly_reason == reason


@pytest.mark.parametrize(
    "row, reason",
    [
        ((None, 1, 1, 1, 1.0), "missing_item_sk"),
        ((1, None, None, 0, 1.0), "missing_order_id"),
        ((1, 1, None, 0, -1.0), "missing_returned_date"),
        ((1, 1, 1, 0, -1.0), "non_positive_quantity"),
        ((1, 1, 1, 1, -0.01), "negative_return_amt"),
        ((1, 1, 1, None, None), None),
    ],
)
def test_return_rules(spark, row, reason):
    tagged = tag_anomalies(spark.createDataFrame([row], RETURNS), RETURN_RULES)
    assert tagged.first()._anomaly_reason == reason
