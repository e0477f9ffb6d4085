"""Dropping lines that repeat across documents.

A line's key is the line without white space at both ends and with A-Z in lower case.
Keys of at least ``least`` code points that two or more documents hold keep their lines
only in the smallest document id; all other lines stay.

Only hashes travel. Each line becomes a 128-bit hash with its document and position; the
rows are range-partitioned by hash and a part of the document's id, sorted by document and
position, and streamed: the first row of a run is the first occurrence in that part, so
lines of later documents are repeats. The first occurrences of a key's parts meet in a
second, equal pass, where a key has one document per part at most; what the first pass
decided stays apart there. So a key that a third of all documents hold is spread over as
many tasks as there are shuffle partitions. What comes back is one compressed bitmap per
document: the runs of its dropped lines, all others being kept.

Defined cases: a null or empty text is one empty line; lines of one document never count
as repeats of each other; rows that share an id are one document; a null id is a document
that comes after all others; no documents give no rows. Other columns of the input are
kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.llm.common import BLANKS, LOWER, UPPER, column, partitions

LEAST = 10
LAST_ID = 2**63 - 1  # stands for a null id while ids are compared


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _row(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """What tells rows apart: the id and, where ids repeat, the text."""
    text = column(docs, text_col)
    return [
        F.coalesce(column(docs, id_col).cast("long"), F.lit(LAST_ID)).alias("_id"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("_text"),
    ]


def dropped_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST
) -> DataFrame:
    """The keep bitmaps: ``_id``, ``_text`` and ``runs`` (``start`` and ``end`` of dropped
    lines, counted from 0), for documents that lose a line."""
    parts = partitions(docs.sparkSession)
    found = (
        docs.select(*_row(docs, id_col, text_col), F.posexplode(lines(column(docs, text_col))))
        .withColumn("col", key(F.col("col")))
        .where(F.length("col") >= least)
        .select(
            F.xxhash64("col").alias("a"),
            F.xxhash64(F.lit(1), F.col("col")).alias("b"),
            F.pmod(F.xxhash64("_id"), F.lit(parts)).cast("int").alias("part"),
            "_id",
            "_text",
            F.col("pos").alias("line"),
        )
    )

    def streamed(df: DataFrame) -> DataFrame:
        """Whether the row's document comes after the one that begins the row's run."""
        by = ["a", "b", "part"]
        run = W.partitionBy(*by).orderBy("_id", "line")
        first = F.first("_id").over(run.rowsBetween(W.unboundedPreceding, W.currentRow))
        return df.repartitionByRange(*by).withColumn("later", F.col("_id") > first)

    # First occurrences meet in part -1; a repeat stays in its part, behind no other row.
    once = streamed(found).withColumn("repeat", F.col("later"))
    again = streamed(once.withColumn("part", F.when(F.col("repeat"), F.col("part")).otherwise(-1)))
    gone = again.where(F.col("repeat") | F.col("later"))

    at = F.col("at")
    starts = F.filter(at, lambda p, i: (i == 0) | (F.get(at, i - 1) != p - 1))
    ends = F.filter(at, lambda p, i: (i == F.size(at) - 1) | (F.get(at, i + 1) != p + 1))
    return (
        gone.groupBy("_id", "_text")
        .agg(F.sort_array(F.collect_set("line")).alias("at"))
        .select("_id", "_text", starts.alias("start"), ends.alias("end"))
        .select("_id", "_text", F.arrays_zip("start", "end").alias("runs"))
    )


def kept_text(text: Column, runs: Column) -> Column:
    """The text without the lines in ``runs``."""
    of = lines(text)

    def between(j: Column) -> Column:
        begin = F.when(j == 0, F.lit(0)).otherwise(F.get(runs, j - 1)["end"] + 1)
        stop = F.when(j == F.size(runs), F.size(of)).otherwise(F.get(runs, j)["start"])
        return F.slice(of, begin + 1, stop - begin)

    pieces = F.transform(F.sequence(F.lit(0), F.size(runs)), between)
    return F.when(runs.isNull(), text).otherwise(F.array_join(F.flatten(pieces), "\n"))


def with_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST
) -> DataFrame:
    """Each row of ``docs`` as struct ``doc`` with its ``runs`` (null: nothing dropped)."""
    kept = F.struct(*[column(docs, name).alias(f"c{i}") for i, name in enumerate(docs.columns)])
    rows = docs.select(*_row(docs, id_col, text_col), kept.alias("doc"))
    return rows.join(dropped_runs(docs, id_col, text_col, least), ["_id", "_text"], "left").select(
        "doc", "runs"
    )


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST
) -> DataFrame:
    """``docs`` with its text cut to the lines that stay; other columns as they were."""
    rows = with_runs(docs, id_col, text_col, least)
    out = []
    for i, name in enumerate(docs.columns):
        value = F.col("doc")[f"c{i}"]
        out.append((kept_text(value, F.col("runs")) if name == text_col else value).alias(name))
    return rows.select(*out)


def line_report(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST
) -> DataFrame:
    """Per row: ``doc_id``, ``n_lines`` before dropping, ``n_dropped``, ``kept_sha256``."""
    narrow = docs.select(column(docs, id_col).alias("id"), column(docs, text_col).alias("text"))
    rows = with_runs(narrow, "id", "text", least)
    text, runs = F.col("doc")["c1"], F.col("runs")
    lost = F.aggregate(
        F.coalesce(F.transform(runs, lambda r: (r["end"] - r["start"] + 1).cast("long")), F.array().cast("array<long>")),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    return rows.select(
        F.col("doc")["c0"].alias("doc_id"),
        F.size(lines(text)).cast("long").alias("n_lines"),
        lost.alias("n_dropped"),
        F.sha2(F.coalesce(kept_text(text, runs), F.lit("")), 256).alias("kept_sha256"),
    )
