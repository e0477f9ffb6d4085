import pytest

from tallyhouse.operators.quality import ChecksFailed
from tallyhouse.plans.full_run import run_warehouse
from tallyhouse.plans.silver import silver_frames
from tallyhouse.sources.runlog import RunLog, run_log_state
from tallyhouse.sources.schemas import SCHEMAS
from tallyhouse.sources.seeds import dim_channel
from tallyhouse.sources.tables import write_full


def write(folder, table, *rows):
    lines = ["|".join(str(row.get(c, "")) for c in SCHEMAS[table].names) for row in rows]
    (folder / f"{table}.dat").write_text("\n".join(lines) + "\n")


def sale(prefix, order, item, customer, quantity, paid, **more):
    who = "customer_sk" if prefix == "ss" else "bill_customer_sk"
    number = "ticket_number" if prefix == "ss" else "order_number"
    values = {
        "sold_date_sk": 2451545, "item_sk": item, who: customer, number: order,
        "quantity": quantity, "sales_price": "1.50", "ext_sales_price": paid,
        "ext_discount_amt": "0.10", "ext_tax": "0.20", "net_paid": paid, "net_profit": "0.50",
        **more,
    }
    return {f"{prefix}_{name}": value for name, value in values.items()}


@pytest.fixture
def data(tmp_path):
    folder = tmp_path / "data"
    folder.mkdir()
    write(folder, "store_sales", sale("ss", 1, 1, 1, 3, "4.50"), sale("ss", 2, 2, 2, 0, "1.50"))
    write(folder, "catalog_sales", sale("cs", 3, 1, 2, 2, "3.00"))
    write(folder, "web_sales", sale("ws", 4, 2, 1, 1, "1.50"))
    write(
        folder, "web_returns",
        {"wr_returned_date_sk": 2451546, "wr_item_sk": 2, "wr_order_number": 4,
         "wr_return_quantity": 1, "wr_return_amt": "1.50"},
    )
    write(
        folder, "customer",
        *[{"c_customer_sk": k, "c_customer_id": f"C{k}", "c_first_name": "A", "c_last_name": "B"} for k in (1, 2, 3)],
    )
    write(folder, "item", *[{"i_item_sk": k, "i_item_id": f"I{k}", "i_category": "c"} for k in (1, 2)])
    write(
        folder, "date_dim",
        *[{"d_date_sk": 2451545 + n, "d_date": f"2000-01-{n + 1:02}", "d_year": 2000, "d_moy": 1, "d_qoy": 1} for n in range(3)],
    )
    write(folder, "store", {"s_store_sk": 1})
    return folder


def test_facts_are_written_once_with_their_sidecars(spark, layers, data):
    for batch in ("b1", "b2"):
        run_warehouse(spark, layers, str(data), batch_id=batch)
    counts = {t: spark.table(f"{layers.silver}.{t}").count() for t in
              ("fact_sales", "fact_sales__anomalies", "fact_returns", "fact_returns__anomalies")}
    assert list(counts.values()) == [3, 1, 1, 0]
    assert {r._batch_id for r in spark.table(f"{layers.silver}.fact_sales").collect()} == {"b2"}
    folders = {
        r["data_type"].rsplit("/", 1)[0]
        for t in ("fact_sales", "fact_sales__anomalies")
        for r in spark.sql(f"DESCRIBE EXTENDED {layers.silver}.{t}").collect()
        if r["col_name"] == "Location"
    }
    assert len(folders) == 1


def test_whole_run(spark, layers, data):
    assert run_warehouse(spark, layers, str(data), batch_id="b1") == "b1"
    state = run_log_state(spark.table(layers.run_log)).collect()
    assert {r.status for r in state} == {"success"}
    assert {r.step for r in state if r.layer != "bronze"} == {
        "tests_bronze", "dq_bronze", "build_silver", "tests_silver", "dq_silver", "build_gold",
        "tests_gold", "dq_gold",
    }
    assert spark.table(f"{layers.silver}.fact_sales").count() == 3
    sidecar = spark.table(f"{layers.silver}.fact_sales__anomalies").collect()
    assert [(r._anomaly_reason, r._batch_id) for r in sidecar] == [("non_positive_quantity", "b1")]
    segments = spark.table(f"{layers.gold}.mart_customer_360").collect()
    assert len(segments) == 3 and sum(r.segment == "Inactive" for r in segments) == 1
    assert spark.table(f"{layers.gold}.mart_product_analytics").count() == 2
    results = spark.table(layers.dq_result)
    assert results.count() == 16 + 16 + 10 + 27 + 37 + 16
    assert results.where("success = 0").isEmpty()


def test_gate_stops_the_run(spark, layers, data):
    write(data, "customer", {"c_customer_sk": 1, "c_customer_id": "X"}, {"c_customer_sk": 1})
    with pytest.raises(ChecksFailed):
        run_warehouse(spark, layers, str(data), batch_id="b1")
    state = {r.step: r for r in run_log_state(spark.table(layers.run_log)).collect()}
    assert state["tests_bronze"].status == "failed"
    assert "customer unique" in state["tests_bronze"].message
    assert "build_silver" not in state
    assert spark.table(layers.dq_result).where("success = 0").count() == 2


def test_step_log(spark, layers):
    log = RunLog(spark, layers.run_log)
    with log.step("b", "silver", "good") as step:
        step.record(rows_in=2, rows_out=1, tool="spark")
    with pytest.raises(ValueError), log.step("b", "silver", "bad"):
        raise ValueError("x" * 5000)
    events = spark.table(layers.run_log)
    assert events.count() == 4
    state = {r.step: r for r in run_log_state(events).collect()}
    assert (state["good"].status, state["good"].rows_in, state["good"].rows_out) == ("success", 2, 1)
    assert (state["bad"].status, len(state["bad"].message)) == ("failed", 5000)
    killed = run_log_state(events.where("status = 'started'")).collect()
    assert {r.status for r in killed} == {"started"}


def test_seed(spark):
    assert [tuple(r) for r in dim_channel(spark).collect()] == [
        (1, "store", "Store"), (2, "catalog", "Catalog"), (3, "web", "Web"),
    ]


def test_command_line(spark, layers, data, capsys):
    from tallyhouse.__main__ import benchmark_plans, main

    names = [f"--{layer}={getattr(layers, layer)}" for layer in ("bronze", "silver", "gold", "dq")]
    assert main([*names, "load", "--data-dir", str(data), "--table", "item"], spark) == 0
    assert "item" in capsys.readouterr().out
    assert spark.table(f"{layers.bronze}.item").count() == 2
    assert main([*names, "--batch-id", "c1", "check", "--suite", "bronze"], spark) == 0
    write(data, "item", {"i_item_sk": 1}, {"i_item_sk": 1})
    assert main([*names, "load", "--data-dir", str(data), "--include", "item"], spark) == 0
    assert main([*names, "check"], spark) == 1
    assert "item unique" in capsys.readouterr().err
    assert main([*names, "load", "--data-dir", str(data), "--exclude", "store"], spark) == 0
    for name in ("fact_sales", "fact_returns", "dim_item", "dim_customer", "dim_date"):
        frame = silver_frames({t: spark.table(f"{layers.bronze}.{t}") for t in SCHEMAS})[name]
        write_full(frame, f"{layers.silver}.{name}")
    bench = ["bench", "--phase", "before", "--iterations", "1", "--run-id", "r1"]
    assert main([*names, *bench], spark) == 0
    assert spark.table(layers.perf_log).count() == 5
    assert main([*names, "tune"], spark) == 0
    assert "fact_sales" in capsys.readouterr().out
    facts = spark.sql(f"DESCRIBE EXTENDED {layers.silver}.fact_sales item_sk").collect()
    assert {r["info_name"]: r["info_value"] for r in facts}["distinct_count"] != "NULL"
    planned = benchmark_plans(spark, layers)["daily_sales_one_month"]()
    plan = planned._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()


def test_a_run_may_use_its_files_up(spark, layers, data):
    run_warehouse(spark, layers, str(data), batch_id="b1", keep_files=False)
    assert not list(data.iterdir())
    assert spark.table(f"{layers.silver}.fact_sales").count() == 3
    assert spark.table(f"{layers.gold}.mart_customer_360").count() == 3
    state = run_log_state(spark.table(layers.run_log)).collect()
    assert len(state) == 16 and {r.status for r in state} == {"success"}
