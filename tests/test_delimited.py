from datetime import UTC, datetime
from pathlib import Path

import pytest

from tallyhouse.sources import delimited
from tallyhouse.sources.delimited import load_all, read_raw, write_raw
from tallyhouse.sources.lineage import with_lineage
from tallyhouse.sources.runlog import run_log_state
from tallyhouse.sources.schemas import SCHEMAS


def write(folder, table, text):
    path = folder / f"{table}.dat"
    path.write_text(text, encoding="utf-8")
    return str(path)


def rows(df):
    return [tuple(r) for r in df.drop("_metadata").collect()]


def test_empty_field_is_null_and_other_words_stay(spark, tmp_path):
    path = write(tmp_path, "reason", '1|AAAA|unsatisfied\n2|BBBB|\n3|""|NA\n4|null|None\n')
    assert sorted(rows(read_raw(spark, path, "reason"))) == [
        (1, "AAAA", "unsatisfied"),
        (2, "BBBB", None),
        (3, None, "NA"),
        (4, "null", "None"),
    ]


def test_quoted_separator_and_padding(spark, tmp_path):
    path = write(tmp_path, "reason", '1|AAAA   |"a|b"\n')
    assert rows(read_raw(spark, path, "reason")) == [(1, "AAAA", "a|b")]


def test_doubled_quotes_and_backslashes(spark, tmp_path):
    text = '1|A|"he said ""no"" today"\n2|B|"a|""b"" \\ c"\n3|C|back\\slash\n4|D|"""q"""\n'
    path = write(tmp_path, "reason", text)
    assert [r[2] for r in sorted(rows(read_raw(spark, path, "reason")))] == [
        'he said "no" today', 'a|"b" \\ c', "back\\slash", '"q"',
    ]


def test_written_rows_are_read_again(spark, tmp_path):
    values = [(1, "A", 'say "x" | y'), (2, None, "back\\slash"), (3, "C", '"'), (4, "D", "é,;")]
    df = spark.createDataFrame(values, SCHEMAS["reason"])
    write_raw(df, f"{tmp_path}/reason.dat", "reason")
    assert sorted(rows(read_raw(spark, f"{tmp_path}/reason.dat", "reason"))) == values


@pytest.mark.parametrize("bad", ["x|AAAA|text", "1|AAAA", "1|AAAA|text|more", '1|AAAA|"line\nbreak'])
def test_malformed_rows_fail_the_load(spark, tmp_path, bad):
    path = write(tmp_path, "reason", f"1|AAAA|fine\n{bad}\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        rows(read_raw(spark, path, "reason"))


def test_lineage(spark, tmp_path):
    path = write(tmp_path, "reason", "1|AAAA|text\n2|BBBB|text\n")
    at = datetime(2026, 1, 2, 3, 4, 5, 678, tzinfo=UTC)
    df = with_lineage(read_raw(spark, path, "reason"), "b1", at)
    stamped = df.selectExpr("_source_file", "_batch_id", "date_format(_ingested_at, 'HH:mm:ss.SSS')")
    assert {tuple(r) for r in stamped.collect()} == {("reason.dat", "b1", "03:04:05.000")}


def test_load_all_counts_logs_and_replaces(spark, tmp_path, layers):
    write(tmp_path, "reason", "1|AAAA|a\n2|BBBB|b\n")
    write(tmp_path, "income_band", "1|0|10000\n")
    write(tmp_path, "ship_mode", "1|A|t|c|x|y\n")
    counts = load_all(spark, str(tmp_path), "b1", layers, exclude={"ship_mode"})
    assert counts == {"reason": 2, "income_band": 1}
    write(tmp_path, "reason", "9|CCCC|c\n")
    assert load_all(spark, str(tmp_path), "b2", layers, include={"reason"}) == {"reason": 1}
    table = spark.table(f"{layers.bronze}.reason")
    assert [(r.r_reason_sk, r._batch_id) for r in table.collect()] == [(9, "b2")]
    state = run_log_state(spark.table(layers.run_log)).collect()
    assert {(r.batch_id, r.step, r.status, r.rows_in, r.rows_out, r.tool) for r in state} == {
        ("b1", "load_reason", "success", 2, 2, "splits"),
        ("b1", "load_income_band", "success", 1, 1, "splits"),
        ("b2", "load_reason", "success", 1, 1, "splits"),
    }
    assert spark.table(f"{layers.bronze}.ship_mode").count() == 0


def test_a_bad_file_fails_its_step(spark, tmp_path, layers):
    write(tmp_path, "reason", "x|AAAA|a\n")
    with pytest.raises(Exception):
        load_all(spark, str(tmp_path), "b1", layers)
    state = run_log_state(spark.table(layers.run_log)).first()
    assert (state.status, state.step) == ("failed", "load_reason")
    assert state.message


def test_packed_files_are_read_again(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(delimited.PACKED, "maxRecordsPerFile", 2)
    values = [(n, str(n), t) for n, t in enumerate(['say "x" | y', None, "two\nlines", "back\\slash", "é,;"])]
    df = spark.createDataFrame(values, SCHEMAS["reason"]).coalesce(1)
    write_raw(df, f"{tmp_path}/reason.dat", "reason", packed=True)
    assert len(list((tmp_path / "reason.dat").glob("part-*.csv.gz"))) == 3
    assert sorted(rows(read_raw(spark, f"{tmp_path}/reason.dat", "reason"))) == values


def test_files_go_once_they_are_loaded(spark, tmp_path, layers):
    loaded, spoilt = write(tmp_path, "reason", "1|A|a\n"), write(tmp_path, "income_band", "x|0|1\n")
    with pytest.raises(Exception):
        load_all(spark, str(tmp_path), "b1", layers, keep_files=False)
    assert not Path(loaded).exists() and Path(spoilt).exists()
    assert spark.table(f"{layers.bronze}.reason").count() == 1
