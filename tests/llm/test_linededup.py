import hashlib
import random

from tallyhouse.llm import linededup
from tests.llm.conftest import ROWS

BLANKS = " \t\n\x0b\x0c\r"
UPPER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute(rows):
    """Per row: lines, dropped lines and the kept text."""

    def key(line):
        return line.strip(BLANKS).translate(UPPER)

    def place(doc_id):
        return 2**63 - 1 if doc_id is None else doc_id

    first = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                first[key(line)] = min(first.get(key(line), 2**63), place(doc_id))
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or first[key(x)] == place(doc_id)]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def compare(df, rows):
    got = [tuple(r) for r in linededup.line_report(df).collect()]
    want = [(d, n, k, sha(t)) for d, n, k, t in brute(rows)]
    assert sorted(got, key=str) == sorted(want, key=str)
    texts = [(r["doc_id"], r["text"] or "") for r in linededup.dedup_lines(df).collect()]
    assert sorted(texts, key=str) == sorted([(d, t) for d, _, _, t in brute(rows)], key=str)


def test_odd_rows(odd):
    compare(odd, [r[:2] for r in ROWS])
    cut = linededup.dedup_lines(odd)
    assert cut.columns == odd.columns
    assert {r["source"] for r in cut.collect()} == {r[3] for r in ROWS}


def test_random_lines_with_a_hot_one(spark, conf):
    draw = random.Random(1)
    lines = [f"line number {i} of all" for i in range(60)] + ["short", "", "  SPACED out line\t", "spaced OUT line"]
    rows = []
    for i in range(300):
        some = [draw.choice(lines) for _ in range(draw.randint(0, 12))]
        if i % 3 == 0:
            some.insert(draw.randint(0, len(some)), "THE hot line of a third")
        rows.append((draw.randint(0, 250), "\n".join(some)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    with conf(spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="7"):
        compare(df, rows)


def test_empty(nothing):
    assert linededup.line_report(nothing).count() == 0
    assert linededup.dedup_lines(nothing).count() == 0


def test_no_python_in_the_plan(odd):
    plan = linededup.line_report(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
