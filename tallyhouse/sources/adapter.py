"""Raw retail tables derived from the TPC-H-like Parquet tables of TESTDATA.md.

Every rule is a plain expression over the given columns (FIXTURES.md, section 6),
so an SQL engine can repeat it. Moduli on the order key put in the dirty rows the
anomaly rules look for.
"""

from __future__ import annotations

from datetime import UTC, datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.expressions import DAY_KEY_OFFSET as KEY_OF_1995
from tallyhouse.functions.expressions import day_key
from tallyhouse.operators.anomalies import (
    RETURN_RULES,
    SALES_RULES,
    fact_returns,
    fact_sales,
    tag_anomalies,
)
from tallyhouse.operators import dimensions
from tallyhouse.operators.staging import (
    CHANNELS,
    LINEAGE,
    RETURN_FIELDS,
    RETURN_SOURCES,
    SALE_FIELDS,
    SALE_SOURCES,
    raw_names,
)
from tallyhouse.session import keep_compiled, settle
from tallyhouse.sources.delimited import write_raw
from tallyhouse.sources.lineage import with_lineage
from tallyhouse.sources.schemas import SCHEMAS, field_type
from tallyhouse.sources.tables import each

BATCH = "driver"
LOADED_AT = datetime(2026, 1, 1, tzinfo=UTC)
MONEY = "decimal(7,2)"  # as the raw tables have it

# What a line gives to the raw columns of its channel's table, by raw name without prefix;
# a column named as in the line needs no entry.
BILLED_LINE = {
    "order_number": "sale_order_id",
    **{f"bill_{who}": who for who in ("customer_sk", "cdemo_sk", "hdemo_sk", "addr_sk")},
}
RAW_SALES = {
    "store": ("ss", {"ticket_number": "sale_order_id"}),
    "catalog": ("cs", BILLED_LINE),
    "web": ("ws", BILLED_LINE),
}
RAW_RETURNS = {
    "store": (
        "sr",
        {
            "ticket_number": "return_order_id",
            "return_time_sk": "returned_time_sk",
            "customer_sk": "refunded_customer_sk",
            "cdemo_sk": "refunded_cdemo_sk",
            "hdemo_sk": "refunded_hdemo_sk",
            "addr_sk": "refunded_addr_sk",
            "store_credit": "credit",
        },
    ),
    "catalog": (
        "cr",
        {"order_number": "return_order_id", "return_amount": "return_amt", "store_credit": "credit"},
    ),
    "web": ("wr", {"order_number": "return_order_id", "account_credit": "credit"}),
}


def _money(cents: str) -> Column:
    return F.expr(f"CAST(({cents}) * 0.01 AS {MONEY})")


def _hundredths(amount: str) -> Column:
    """A double with two decimals as a whole number of hundredths."""
    return F.expr(f"CAST(FLOOR({amount} * 100 + 0.5D) AS BIGINT)")


def _percent_sql(cents: str, percent: str | int) -> str:
    return f"(({cents}) * {percent} + IF({cents} < 0, -50, 50)) DIV 100"


def _percent(cents: str, percent: str | int) -> Column:
    """That share of an amount, halves of a cent rounded away from zero."""
    return F.expr(_percent_sql(cents, percent))


def _fill(df: DataFrame, table: str) -> DataFrame:
    """The table's full column contract in its types, NULL where no rule gives a column.

    A value that does not fit its type is an error, not a NULL.
    """
    have = set(df.columns)
    columns = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in SCHEMAS[table].fields
    ]
    return df.select(*columns, *[c for c in LINEAGE if c in have])


class DriverTables:
    """Bronze, silver and dimension frames over one folder of driver tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = keep_compiled(spark)
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def loaded(self, name: str) -> DataFrame:
        """A table with the lineage its files give."""
        return with_lineage(self.table(name), BATCH, LOADED_AT)

    def _derived(self, name: str) -> DataFrame:
        """A table with the lineage of rows derived from it, as constants.

        File metadata would be read for every row even where no query asks for it.
        """
        return self.table(name).select(
            "*",
            F.lit(BATCH).alias("_batch_id"),
            F.lit(LOADED_AT).cast("timestamp").alias("_ingested_at"),
            F.lit(f"{name}.parquet").alias("_source_file"),
        )

    # --- order lines -------------------------------------------------------

    @cached_property
    def _lines(self) -> DataFrame:
        """Order lines with money in whole cents, so that rules are integer arithmetic."""
        return (
            self._derived("lineitem")
            .join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                "*",
                F.expr(
                    "CASE o_orderkey % 3 WHEN 0 THEN 'store' WHEN 1 THEN 'catalog' ELSE 'web' END"
                ).alias("channel"),
                F.expr("IF(o_orderkey % 211 = 210, NULL, o_orderkey)").alias("order_no"),
                F.expr("IF(l_partkey % 97 = 96, NULL, l_partkey)").alias("item_sk"),
                F.expr("CAST(l_quantity AS INT)").alias("units"),
                # Half the price, so that all amounts fit the raw tables' money type.
                F.floor(_hundredths("l_extendedprice") / 2).cast("bigint").alias("list_cents"),
                _hundredths("l_discount").alias("discount_pct"),
                _hundredths("l_tax").alias("tax_pct"),
            )
            .withColumn("discount_cents", _percent("list_cents", "discount_pct"))
            .withColumn("sale_cents", F.expr("list_cents - discount_cents"))
            .withColumn("tax_cents", _percent("sale_cents", "tax_pct"))
            .withColumn("wholesale_cents", _percent("list_cents", 60))
        )

    @cached_property
    def _sale_lines(self) -> DataFrame:
        """Unit prices come from the line itself, cut to cents."""
        sold = F.when(F.expr("o_orderkey % 199 <> 198"), day_key(F.col("o_orderdate")))
        cents = self._lines.withColumnRenamed("order_no", "sale_order_id").withColumns(
            {
                "ship_cents": _percent("list_cents", 5),
                "paid_cents": F.expr(
                    "IF(o_orderkey % 173 = 172 AND l_linenumber = 4, -sale_cents, sale_cents)"
                ),
            }
        )
        return cents.withColumns(
            {
                "customer_sk": F.expr(
                    "IF(o_orderkey % 53 = 52 OR o_custkey % 41 = 40, NULL, o_custkey)"
                ),
                "cdemo_sk": F.expr("CAST(o_custkey % 7 AS INT)"),
                "hdemo_sk": F.expr("CAST(o_custkey % 10 AS INT)"),
                "addr_sk": F.expr("CAST(o_custkey % 25 AS INT)"),
                "ship_customer_sk": F.expr("o_custkey + 5"),
                "ship_cdemo_sk": F.expr("CAST((o_custkey + 1) % 7 AS INT)"),
                "ship_hdemo_sk": F.expr("CAST((o_custkey + 1) % 10 AS INT)"),
                "ship_addr_sk": F.expr("CAST((o_custkey + 1) % 25 AS INT)"),
                "promo_sk": F.expr("CAST(l_partkey % 20 AS INT)"),
                "sold_time_sk": F.expr("CAST(o_orderkey % 86400 AS INT)"),
                "sold_date_sk": sold,
                "ship_date_sk": day_key(F.col("l_shipdate")),
                "store_sk": F.col("l_suppkey"),
                "warehouse_sk": F.col("l_suppkey"),
                "quantity": F.expr("IF(o_orderkey % 157 = 156 AND l_linenumber = 2, 0, units)"),
                "wholesale_cost": _money("wholesale_cents DIV units"),
                "list_price": _money("list_cents DIV units"),
                "sales_price": _money(
                    "IF(o_orderkey % 163 = 162 AND l_linenumber = 3, -100, sale_cents DIV units)"
                ),
                "ext_discount_amt": _money("discount_cents"),
                "ext_sales_price": _money("sale_cents"),
                "ext_wholesale_cost": _money("wholesale_cents"),
                "ext_list_price": _money("list_cents"),
                "ext_tax": _money("tax_cents"),
                "coupon_amt": _money("0"),
                "ext_ship_cost": _money("ship_cents"),
                "net_paid": _money("paid_cents"),
                "net_paid_inc_tax": _money("paid_cents + tax_cents"),
                "net_paid_inc_ship": _money("paid_cents + ship_cents"),
                "net_paid_inc_ship_tax": _money("paid_cents + ship_cents + tax_cents"),
                "net_profit": _money("paid_cents - wholesale_cents"),
            }
        )

    @cached_property
    def _return_lines(self) -> DataFrame:
        returned = F.when(F.expr("o_orderkey % 181 <> 180"), day_key(F.col("l_shipdate")))
        cents = (
            self._lines.where("l_returnflag = 'R'")
            .withColumnRenamed("order_no", "return_order_id")
            .withColumns(
                {
                    "back_cents": F.expr(
                        f"IF(o_orderkey % 167 = 166, -500, {_percent_sql('sale_cents', 50)})"
                    ),
                    "back_tax_cents": _percent("tax_cents", 50),
                }
            )
        )
        return cents.withColumns(
            {
                "refunded_customer_sk": F.col("o_custkey"),
                "returning_customer_sk": F.expr("IF(channel = 'store', o_custkey, o_custkey + 1)"),
                **{
                    f"{who}_{what}_sk": F.expr(f"CAST((o_custkey + {shift}) % {parts} AS INT)")
                    for who, shift in (("refunded", 0), ("returning", 1))
                    for what, parts in (("cdemo", 7), ("hdemo", 10), ("addr", 25))
                },
                "reason_sk": F.col("l_linenumber").cast("int"),
                "returned_time_sk": F.expr("CAST((o_orderkey + 60) % 86400 AS INT)"),
                "store_sk": F.col("l_suppkey"),
                "warehouse_sk": F.col("l_suppkey"),
                "returned_date_sk": returned,
                "return_quantity": F.expr(
                    "IF(o_orderkey % 149 = 148, -1, CAST(GREATEST(1, units DIV 2) AS INT))"
                ),
                "return_amt": _money("back_cents"),
                "return_tax": _money("back_tax_cents"),
                "return_amt_inc_tax": _money("back_cents + back_tax_cents"),
                "fee": _money("50"),
                "return_ship_cost": _money(_percent_sql("list_cents", 2)),
                "refunded_cash": _money("back_cents"),
                "reversed_charge": _money("0"),
                "credit": _money(_percent_sql("back_cents", 20)),
                "net_loss": _money(_percent_sql("back_cents", 10)),
            }
        )

    def _raw(self, lines: DataFrame, channel: str, source: tuple[str, dict], table: str) -> DataFrame:
        prefix, renamed = source
        have = set(lines.columns)
        columns = []
        for name in SCHEMAS[table].names:
            field = name.removeprefix(f"{prefix}_")
            if renamed.get(field, field) in have:
                columns.append(F.col(renamed.get(field, field)).alias(name))
        rows = lines.where(F.col("channel") == channel).select(*columns, *LINEAGE)
        return _fill(rows, table)

    def raw_sales(self, channel: str) -> DataFrame:
        return self._raw(self._sale_lines, channel, RAW_SALES[channel], f"{channel}_sales")

    def raw_returns(self, channel: str) -> DataFrame:
        return self._raw(self._return_lines, channel, RAW_RETURNS[channel], f"{channel}_returns")

    def share_lines(self) -> None:
        """Derive the order lines once for everything that follows: the channel tables are
        slices of them."""
        self.__dict__["_lines"] = settle(self._lines)

    def _staged(self, lines: DataFrame, fields: list[str], sources: dict) -> DataFrame:
        """The union of all staged channels, read in one pass.

        The channel tables here are slices of one file, so the union would scan and
        join it once per channel. tests/test_adapter.py holds this equal to the union.
        """
        have = set(lines.columns)
        names = {channel: raw_names(fields, sources[channel]) for channel in CHANNELS}
        columns = [F.col("channel")]
        for field in fields:
            filled = [c for c in CHANNELS if names[c][field]] if field in have else []
            kind = "decimal(7,2)" if field == "credit" else field_type(field)
            if field.endswith("_order_id"):
                kind = "bigint"
            value = F.col(field) if filled else F.lit(None)
            if 0 < len(filled) < len(CHANNELS):
                value = F.when(F.col("channel").isin(filled), value)
            columns.append(value.cast(kind).alias(field))
        return lines.select(*columns, *LINEAGE)

    @cached_property
    def tagged_sales(self) -> DataFrame:
        staged = self._staged(self._sale_lines, SALE_FIELDS, SALE_SOURCES)
        return tag_anomalies(staged, SALES_RULES)

    @cached_property
    def tagged_returns(self) -> DataFrame:
        staged = self._staged(self._return_lines, RETURN_FIELDS, RETURN_SOURCES)
        return tag_anomalies(staged, RETURN_RULES)

    @cached_property
    def sales(self) -> DataFrame:
        return fact_sales(self.tagged_sales)

    @cached_property
    def returns(self) -> DataFrame:
        return fact_returns(self.tagged_returns)

    # --- raw dimension tables ----------------------------------------------

    def date_dim(self) -> DataFrame:
        """One row per day of the whole years with an order or a shipment."""
        day = F.col("d_date")
        dow = F.dayofweek(day) - 1
        months = (F.year(day) - 1900) * 12 + F.month(day) - 1
        quarters = (F.year(day) - 1900) * 4 + F.quarter(day) - 1
        years = self._trade_years
        days = F.sequence(F.make_date(*years[0]), F.make_date(*years[1])) if years else F.array()
        calendar = self.spark.range(1).select(
            F.explode(days.cast("array<date>")).alias("d_date")
        )
        raw = calendar.select(
            "d_date",
            day_key(day).alias("d_date_sk"),
            F.year(day).alias("d_year"),
            F.month(day).alias("d_moy"),
            F.dayofmonth(day).alias("d_dom"),
            F.quarter(day).alias("d_qoy"),
            dow.alias("d_dow"),
            months.alias("d_month_seq"),
            quarters.alias("d_quarter_seq"),
            F.floor((day_key(day) - 2415021) / 7).cast("int").alias("d_week_seq"),
            F.date_format(day, "EEEE").alias("d_day_name"),
            F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string")).alias(
                "d_quarter_name"
            ),
            F.when(dow.isin(0, 6), "Y").otherwise("N").alias("d_weekend"),
            F.when((F.month(day) == 12) & (F.dayofmonth(day) == 25), "y").alias("d_holiday"),
        )
        return _fill(raw, "date_dim")

    @cached_property
    def _trade_years(self) -> tuple | None:
        """First day of the first and last day of the last calendar year with an order or a
        shipment. Two years come to the driver, so every plan has the calendar as constants."""
        ordered = self.table("orders").select(F.col("o_orderdate").cast("date").alias("day"))
        shipped = self.table("lineitem").select(F.col("l_shipdate").cast("date").alias("day"))
        low, high = ordered.unionByName(shipped).agg(
            F.year(F.min("day")), F.year(F.max("day"))
        ).first()
        if low is None:
            return None
        return tuple(map(F.lit, (low, 1, 1))), tuple(map(F.lit, (high, 12, 31)))

    def item(self) -> DataFrame:
        part = self._derived("part").selectExpr(
            "p_partkey AS i_item_sk",
            "CONCAT('ITEM', CAST(p_partkey DIV 2 AS STRING)) AS i_item_id",
            "IF(p_partkey % 2 = 0, DATE'1995-01-01', DATE'1998-01-01') AS i_rec_start_date",
            "IF(p_partkey % 2 = 0, DATE'1997-12-31', NULL) AS i_rec_end_date",
            "p_name AS i_item_desc",
            f"CAST(p_retailprice AS {MONEY}) AS i_current_price",
            f"CAST(CAST(p_retailprice AS {MONEY}) * 0.60 AS {MONEY}) AS i_wholesale_cost",
            "CAST(SUBSTRING(p_brand, 7) AS INT) AS i_brand_id",
            "CONCAT(p_brand, '   ') AS i_brand",
            "p_size % 4 AS i_class_id",
            "CONCAT('class ', CAST(p_size % 4 AS STRING)) AS i_class",
            "CONCAT(' ', p_type) AS i_category",
            "CONCAT('maker ', CAST(p_partkey % 5 AS STRING)) AS i_manufact",
            "CAST(p_size AS STRING) AS i_size",
            "SPLIT_PART(p_name, ' ', 1) AS i_color",
            "CONCAT('  ', p_name, ' ') AS i_product_name",
            *LINEAGE,
        )
        return _fill(part, "item")

    def customer(self) -> DataFrame:
        rows = self._derived("customer").selectExpr(
            "c_custkey AS c_customer_sk",
            "CONCAT('CUST', LPAD(CAST(c_custkey AS STRING), 12, '0')) AS c_customer_id",
            "c_custkey % 7 AS c_current_cdemo_sk",
            "c_custkey % 10 AS c_current_hdemo_sk",
            "c_nationkey AS c_current_addr_sk",
            "IF(c_custkey % 29 = 28, NULL, CONCAT(SPLIT_PART(c_name, '#', 1), ' ')) AS c_first_name",
            "IF(c_custkey % 17 = 0, CONCAT('\"', SPLIT_PART(c_name, '#', 2), '\" | jr'), "
            "SPLIT_PART(c_name, '#', 2)) AS c_last_name",
            "CASE WHEN c_custkey % 37 = 36 THEN NULL WHEN c_acctbal > 5000 THEN 'Y' "
            "WHEN c_acctbal > 4000 THEN 'y ' ELSE 'N' END AS c_preferred_cust_flag",
            "CAST(1940 + c_custkey % 60 AS INT) AS c_birth_year",
            "CONCAT(LOWER(REPLACE(c_name, '#', '.')), '@example.com') AS c_email_address",
            *LINEAGE,
        )
        return _fill(rows, "customer")

    def customer_address(self) -> DataFrame:
        rows = (
            self._derived("nation")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .selectExpr(
                "n_nationkey AS ca_address_sk",
                "CONCAT('City of ', n_name) AS ca_city",
                "n_name AS ca_state",
                "LPAD(CAST(n_nationkey AS STRING), 5, '0') AS ca_zip",
                "r_name AS ca_country",
                "CAST(n_nationkey % 12 - 6 AS DECIMAL(5,2)) AS ca_gmt_offset",
                *LINEAGE,
            )
        )
        return _fill(rows, "customer_address")

    def _numbers(self, table: str, value: str) -> DataFrame:
        """Each value that a given table's rows have, once, as ``id``."""
        return self.table(table).select(F.expr(value).cast("bigint").alias("id")).distinct()

    def customer_demographics(self) -> DataFrame:
        rows = self._numbers("customer", "c_custkey % 7").selectExpr(
            "id AS cd_demo_sk",
            "IF(id % 2 = 0, 'M', 'F') AS cd_gender",
            "SUBSTRING('SMDWU', CAST(id % 5 + 1 AS INT), 1) AS cd_marital_status",
            "IF(id < 4, 'College', 'Primary') AS cd_education_status",
            "500 * (id + 1) AS cd_purchase_estimate",
            "IF(id % 3 = 0, 'Good', 'Low Risk') AS cd_credit_rating",
            "id AS cd_dep_count",
        )
        return _fill(rows, "customer_demographics")

    def household_demographics(self) -> DataFrame:
        rows = self._numbers("customer", "c_custkey % 10").selectExpr(
            "id AS hd_demo_sk",
            "id % 5 AS hd_income_band_sk",
            "IF(id < 5, '501-1000 ', ' >10000') AS hd_buy_potential",
            "id % 4 AS hd_vehicle_count",
        )
        return _fill(rows, "household_demographics")

    def income_band(self) -> DataFrame:
        rows = self._numbers("customer", "c_custkey % 5").selectExpr(
            "id AS ib_income_band_sk",
            "id * 10000 + 1 AS ib_lower_bound",
            "(id + 1) * 10000 AS ib_upper_bound",
        )
        return _fill(rows, "income_band")

    def promotion(self) -> DataFrame:
        """One promotion per key that sales lines refer to."""
        rows = self._numbers("lineitem", "l_partkey % 20").selectExpr(
            "id AS p_promo_sk",
            "CONCAT('PROMO', LPAD(CAST(id AS STRING), 3, '0')) AS p_promo_id",
            f"{KEY_OF_1995} + id AS p_start_date_sk",
            f"{KEY_OF_1995} + id + 30 AS p_end_date_sk",
            "id + 1 AS p_item_sk",
            "1000 * id AS p_cost",
            "1 AS p_response_target",
            "CONCAT(' promo ', CAST(id AS STRING), ' ') AS p_promo_name",
            "IF(id % 2 = 0, 'Y', 'N') AS p_channel_dmail",
            "IF(id % 3 = 0, 'y ', NULL) AS p_channel_email",
            "IF(id % 5 = 0, 'Y', 'N') AS p_channel_tv",
            "'Unknown ' AS p_purpose",
            "IF(id % 4 = 0, 'N', 'Y') AS p_discount_active",
        )
        return _fill(rows, "promotion")

    def time_dim(self) -> DataFrame:
        """One row per second of the day that an event falls into."""
        second = "HOUR(ts) * 3600 + MINUTE(ts) * 60 + SECOND(ts)"
        rows = self._numbers("events", second).selectExpr(
            "id AS t_time_sk",
            "CONCAT('T', CAST(id AS STRING)) AS t_time_id",
            "id AS t_time",
            "id DIV 3600 AS t_hour",
            "id DIV 60 % 60 AS t_minute",
            "id % 60 AS t_second",
            "IF(id < 43200, 'AM', 'PM') AS t_am_pm",
        )
        return _fill(rows, "time_dim")

    def store(self) -> DataFrame:
        rows = self._derived("supplier").selectExpr(
            "s_suppkey AS s_store_sk",
            "CONCAT('STORE', CAST(s_suppkey DIV 2 AS STRING)) AS s_store_id",
            "DATE'1997-03-13' AS s_rec_start_date",
            "IF(s_suppkey % 2 = 0, DATE'1999-03-13', NULL) AS s_rec_end_date",
            "CONCAT(' ', s_name, ' ') AS s_store_name",
            "CAST(s_suppkey % 300 + 1 AS INT) AS s_number_employees",
            "' 8AM-8AM ' AS s_hours",
            "CAST(s_nationkey AS STRING) AS s_state",
            "CAST(s_nationkey % 12 - 6 AS DECIMAL(5,2)) AS s_gmt_offset",
            "CAST(s_suppkey % 12 * 0.01 AS DECIMAL(5,2)) AS s_tax_precentage",
            *LINEAGE,
        )
        return _fill(rows, "store")

    def inventory(self) -> DataFrame:
        """Stock per month start, part and supplier; the moduli leave keys missing."""
        month = F.date_trunc("month", F.col("l_shipdate"))
        rows = (
            self.table("lineitem")
            .groupBy(day_key(month).alias("month_sk"), "l_partkey", "l_suppkey")
            .agg(F.sum("l_quantity").alias("inv_quantity_on_hand"))
            .selectExpr(
                "IF(month_sk % 31 = 30, NULL, month_sk) AS inv_date_sk",
                "IF(l_partkey % 97 = 96, NULL, l_partkey) AS inv_item_sk",
                "IF(l_suppkey % 13 = 12, NULL, l_suppkey) AS inv_warehouse_sk",
                "inv_quantity_on_hand",
                f"'{BATCH}' AS _batch_id",
            )
        )
        return _fill(rows, "inventory")

    def raw_tables(self) -> dict[str, DataFrame]:
        """Every raw table the driver data can fill."""
        return {
            **{SALE_SOURCES[c][0]: self.raw_sales(c) for c in CHANNELS},
            **{RETURN_SOURCES[c][0]: self.raw_returns(c) for c in CHANNELS},
            "customer": self.customer(),
            "customer_address": self.customer_address(),
            "customer_demographics": self.customer_demographics(),
            "household_demographics": self.household_demographics(),
            "income_band": self.income_band(),
            "item": self.item(),
            "store": self.store(),
            "date_dim": self.date_dim(),
            "time_dim": self.time_dim(),
            "promotion": self.promotion(),
            "inventory": self.inventory(),
        }

    def write_raw_files(self, folder: str) -> None:
        """The raw tables as ``<table>.dat`` text files, compressed.

        Each table of lines is derived from the orders of its channel alone, one after the
        other: all lines settled for the six would take more disk than the files.
        """
        frames = self.raw_tables()
        large = [*(f"{c}_{kind}" for kind in ("sales", "returns") for c in CHANNELS), "inventory"]

        def write(table: str) -> None:
            write_raw(frames[table], f"{folder}/{table}.dat", table, packed=True)

        each(write, [table for table in frames if table not in large])
        each(write, large, at_once=1)

    # --- operation logs, from the events table -------------------------------

    def _events(self) -> DataFrame:
        second = F.date_trunc("second", F.col("ts")).cast("timestamp")
        return self.table("events").withColumn("at", second)

    def run_log(self) -> DataFrame:
        """Start and end events of the steps of one run per user and event type."""
        ended = "event_id % 3 <> 0"
        return self._events().selectExpr(
            "CONCAT('run-', CAST(user_id AS STRING), '-', event_type) AS step_run",
            "CONCAT('batch-', CAST(CAST(at AS DATE) AS STRING)) AS batch_id",
            "ELT(CAST(event_id % 4 + 1 AS INT), 'bronze', 'silver', 'gold', 'dq') AS layer",
            "event_type AS step",
            "ELT(CAST(event_id % 3 + 1 AS INT), 'started', 'success', 'failed') AS status",
            f"IF({ended}, user_id, NULL) AS rows_in",
            "IF(event_id % 3 = 1, user_id, NULL) AS rows_out",
            "at AS started_at",
            f"IF({ended}, at + MAKE_DT_INTERVAL(0, 0, 0, event_id % 60), NULL) AS ended_at",
            f"IF({ended}, CAST(event_id % 60 AS DECIMAL(10,2)), NULL) AS duration_sec",
            "'spark' AS tool",
            "CONCAT('event ', CAST(event_id AS STRING)) AS message",
        )

    def dq_result(self) -> DataFrame:
        """One batch of check results per day."""
        return self._events().selectExpr(
            "CONCAT('dq-', CAST(CAST(at AS DATE) AS STRING)) AS batch_id",
            "ELT(CAST(event_id % 3 + 1 AS INT), 'bronze', 'silver', 'gold') AS suite",
            "CONCAT('table_', CAST(user_id % 10 AS STRING)) AS table_name",
            "event_type AS expectation",
            "CAST(IF(event_id % 5 = 0, 0, 1) AS TINYINT) AS success",
            "props AS observed_value",
            "CAST(DATE_TRUNC('DAY', at) AS TIMESTAMP) AS run_at",
        )

    def perf_log(self) -> DataFrame:
        return self._events().selectExpr(
            "CONCAT('perf-', CAST(user_id % 8 AS STRING)) AS run_id",
            "IF(event_id % 2 = 0, 'before', 'after') AS phase",
            "event_type AS query_name",
            "event_id AS iteration",
            "CAST(value AS DECIMAL(10,3)) AS duration_sec",
            "user_id AS rows_returned",
            "at AS started_at",
            "CAST(NULL AS STRING) AS notes",
        )

    # --- silver dimensions ---------------------------------------------------

    @cached_property
    def dates(self) -> DataFrame:
        return dimensions.dim_date(self.date_dim())

    @cached_property
    def items(self) -> DataFrame:
        return dimensions.dim_item(self.item())

    @cached_property
    def customers(self) -> DataFrame:
        return dimensions.dim_customer(
            self.customer(),
            self.customer_address(),
            self.customer_demographics(),
            self.household_demographics(),
            self.income_band(),
        )

    @cached_property
    def promotions(self) -> DataFrame:
        return dimensions.dim_promotion(self.promotion())

    @cached_property
    def stores(self) -> DataFrame:
        return dimensions.dim_store(self.store())

    @cached_property
    def stock(self) -> DataFrame:
        return dimensions.fact_inventory(self.inventory())
