import os

import pytest

from tallyhouse.plans import marts
from tallyhouse.plans.full_run import run_warehouse
from tallyhouse.sources import versions
from tallyhouse.sources.runlog import run_log_state
from tallyhouse.sources.tables import Layers, ensure_layout, write_full
from tests.test_full_run import data  # noqa: F401 - the raw files

STAMPS = ("_batch_id", "_ingested_at", "_built_at")


def rows(spark, layers):
    """All rows of silver and gold but for their batch and times."""
    found = {}
    for database in (layers.silver, layers.gold):
        for t in spark.catalog.listTables(database):
            df = spark.table(f"{database}.{t.name}").drop(*STAMPS)
            name = (layers.names().index(database), t.name)
            found[name] = sorted(str(sorted(r.asDict().items())) for r in df.collect())
    return found


def tools(spark, layers, batch):
    state = run_log_state(spark.table(layers.run_log)).where(f"batch_id = '{batch}'").collect()
    return {r.step: r.tool for r in state if r.step.startswith(("load", "build"))}


def test_a_run_goes_on_after_its_driver_was_killed(spark, layers, data, tmp_path, monkeypatch):  # noqa: F811
    def killed(*_):
        raise SystemExit("killed")

    with monkeypatch.context() as patch:
        patch.setattr(marts, "mart_customer_360", killed)
        with pytest.raises(SystemExit):
            run_warehouse(spark, layers, str(data), batch_id="b1")
    state = run_log_state(spark.table(layers.run_log)).collect()
    assert {r.step for r in state if r.status == "started"} == {"build_gold"}

    run_warehouse(spark, layers, str(data), batch_id="b2", reuse=True)
    second = tools(spark, layers, "b2")
    assert second.pop("build_gold") == "spark" and set(second.values()) == {"reused"}
    counts = {
        (r.batch_id, r.step): (r.rows_in, r.rows_out)
        for r in run_log_state(spark.table(layers.run_log)).collect()
    }
    assert all(counts["b1", step] == counts["b2", step] for step in second)
    other = Layers(*[f"scratch_{name}" for name in layers.names()])
    ensure_layout(spark, other, str(tmp_path / "scratch"))
    run_warehouse(spark, other, str(data), batch_id="b1")
    assert rows(spark, layers) == rows(spark, other)

    # One changed file: its load and all builds are done again, the other loads are not.
    path = data / "customer.dat"
    path.write_text(path.read_text().replace("|A|", "|Z|", 1))
    os.utime(path, (1, 1))
    run_warehouse(spark, layers, str(data), batch_id="b3", reuse=True)
    third = tools(spark, layers, "b3")
    assert {step for step, tool in third.items() if tool != "reused"} == {
        "load_customer", "build_silver", "build_gold",
    }


def test_a_table_switched_since_counts_as_not_made(spark, layers):
    table = f"{layers.gold}.some"
    write_full(spark.range(3).toDF("n"), table)
    assert versions.made_rows(spark, table, "x") is None
    versions.mark_made(spark, table, "x", 3)
    assert versions.made_rows(spark, table, "x") == 3
    assert versions.made_rows(spark, table, "y") is None
    write_full(spark.range(3).toDF("n"), table)
    assert versions.made_rows(spark, table, "x") is None
    assert versions.made_rows(spark, f"{layers.gold}.none", "x") is None
    assert versions.layer_rows(spark, layers.gold, "x") is None
    versions.mark_layer(spark, layers.gold, "x", 7)
    assert versions.layer_rows(spark, layers.gold, "x") == 7


def test_fingerprints_follow_inputs_steps_and_settings(spark, tmp_path):
    (tmp_path / "a").write_text("1")
    first = versions.file_versions(spark, str(tmp_path / "a"))
    assert versions.file_versions(spark, str(tmp_path)) == first
    made = {versions.fingerprint(spark, step, inputs) for step in "xy" for inputs in ([], first, [*first, "b"])}
    assert len(made) == 6
    assert versions.fingerprint(spark, "x", ["b", *first]) in made
