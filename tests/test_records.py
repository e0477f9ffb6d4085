import csv
import io
import random

import pytest

from tallyhouse.sources.delimited import load_all, read_raw, write_raw
from tallyhouse.sources.records import MalformedRecord, cut_records, goes_over_lines
from tallyhouse.sources.schemas import SCHEMAS


@pytest.fixture(params=[64, 1000, 1 << 20])
def split(spark, request):
    """Splits of so many bytes."""
    names = {
        "spark.sql.files.maxPartitionBytes": str(request.param),
        "spark.sql.files.openCostInBytes": "1",
        "spark.sql.files.minPartitionNum": "1",
    }
    old = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield request.param
    for name, value in old.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def texts(seed, n):
    some = random.Random(seed)
    pieces = ["a", "é", '"', "|", "\n", "\n\n", " b", '""', "\\", "word " * 30, '"|"\n"', "\r\n"]
    return ["x" + "".join(some.choices(pieces, k=some.randint(0, 9))) + "x" for _ in range(n)]


def written(path, values):
    """A file as Python's csv module writes it."""
    out = io.StringIO()
    csv.writer(out, delimiter="|", lineterminator="\n").writerows(values)
    path.write_text(out.getvalue(), encoding="utf-8", newline="")
    return str(path)


def test_records_over_lines_in_splits_of_any_size(spark, tmp_path, split):
    values = [(i, "A", text) for i, text in enumerate(texts(1, 60))]
    path = written(tmp_path / "reason.dat", values)
    assert goes_over_lines(spark, path)
    rows = read_raw(spark, path, "reason").drop("_metadata")
    if split == 64:
        assert spark.read.text(path).rdd.getNumPartitions() > 20
    assert sorted(tuple(r) for r in rows.collect()) == values


def test_one_field_over_many_splits_among_files(spark, tmp_path, split):
    folder = tmp_path / "reason.dat"
    folder.mkdir()
    wide = "begin\n" + "1|2|3\n" * 200 + "end"
    files = {"a": [(1, "A", "x"), (2, "B", wide)], "b": [(3, "C", "y")], "c": [(4, "D", "p\nq"), (5, "E", wide)]}
    for name, values in files.items():
        written(folder / f"{name}.dat", values)
    rows = read_raw(spark, str(folder), "reason")
    found = {(*r[:3], r["_metadata"]["file_name"]) for r in rows.collect()}
    assert found == {(*v, f"{name}.dat") for name, values in files.items() for v in values}


def test_files_without_such_fields_are_not_cut(spark, tmp_path):
    path = written(tmp_path / "reason.dat", [(1, "A", 'say "x" | y')])
    assert not goes_over_lines(spark, path)
    plan = read_raw(spark, path, "reason")._jdf.queryExecution().toString()
    assert "FileScan csv" in plan and "Exchange" not in plan


def test_blank_lines_and_carriage_returns(spark, tmp_path):
    path = tmp_path / "reason.dat"
    path.write_bytes(b'1|A|"p\r\n\r\nq"\r\n\r\n  \r\n2|B|z\r\n')
    rows = read_raw(spark, str(path), "reason").drop("_metadata")
    assert sorted(tuple(r) for r in rows.collect()) == [(1, "A", "p\r\n\r\nq"), (2, "B", "z")]


@pytest.mark.parametrize("text", ['1|A|"p\nq"|more\n', '1|"p\nq"\n', 'x|A|"p\nq"\n'])
def test_malformed_records_fail(spark, tmp_path, text):
    path = tmp_path / "reason.dat"
    path.write_text("7|G|fine\n" + text)
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        read_raw(spark, str(path), "reason").collect()


def test_quotes_that_do_not_close_or_close_far_away_fail_before_rows_are_gathered(spark, tmp_path):
    path = tmp_path / "reason.dat"
    path.write_text('1|A|"p\n2|B|q\n')
    with pytest.raises(MalformedRecord, match="does not end"):
        read_raw(spark, str(path), "reason")
    path.write_text('1|A|"p\n' + "2|B|q\n" * 50 + '3|C|r"\n')
    with pytest.raises(MalformedRecord, match="characters"):
        cut_records(spark, str(path), longest=100)


def test_two_open_lines_of_the_right_length_are_one_record(spark, tmp_path):
    path = tmp_path / "reason.dat"
    path.write_text('1|A|"x\n2|B|y"\n')
    assert [tuple(r)[:3] for r in read_raw(spark, str(path), "reason").collect()] == [(1, "A", "x\n2|B|y")]


def test_written_rows_with_breaks_are_loaded(spark, tmp_path, layers):
    values = [(i, "A", text) for i, text in enumerate(texts(2, 40)) if "\r" not in text]
    write_raw(spark.createDataFrame(values, SCHEMAS["reason"]), f"{tmp_path}/reason.dat", "reason")
    assert load_all(spark, str(tmp_path), "b1", layers) == {"reason": len(values)}
    rows = spark.table(f"{layers.bronze}.reason").select("r_reason_sk", "r_reason_id", "r_reason_desc")
    assert sorted(tuple(r) for r in rows.collect()) == values
