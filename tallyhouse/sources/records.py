"""Records of delimited text whose quoted fields hold line breaks, cut in splits.

A line with an odd number of quotes opens or closes a field that goes over its end. Whether a
split begins inside such a field follows from the quotes of the splits before it: one count per
split, summed along the file. So files are still read in splits, only the lines of splits that
hold or continue such a field are sorted, within their split, and only the lines of such records
are gathered, per record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.session import settle

LONGEST = 16 * 1024 * 1024  # characters of one record over several lines


class MalformedRecord(ValueError):
    """A quoted field that does not end, or not within ``LONGEST`` characters."""


def _odd(value: Column) -> Column:
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))
    return quotes % 2 == 1


def goes_over_lines(spark: SparkSession, path: str) -> bool:
    """Whether any line leaves a quoted field open; reads the files once and moves nothing."""
    return bool(spark.read.text(path).where(_odd(F.col("value"))).limit(1).take(1))


def cut_records(spark: SparkSession, path: str, longest: int = LONGEST) -> DataFrame:
    """``record`` and the file's ``_metadata`` of each record; lines end with ``\\n`` or ``\\r\\n``.

    Blank lines outside of quotes are no records. The lines are settled once, so that splits
    keep their bounds whatever reads them again. A quote that never closes, or closes after more
    than ``longest`` characters, raises ``MalformedRecord`` before anything is gathered.
    """
    raw = spark.read.text(path, lineSep="\n")
    line = raw.select(
        "_metadata",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )
    lines = settle(line.withColumn("odd", _odd(F.col("value")).cast("int")))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("file", "start").agg(F.sum("odd").alias("n_odd"))
    splits = settle(splits.withColumn("carried", F.coalesce(F.sum("n_odd").over(before), F.lit(0)) % 2))
    unclosed = splits.groupBy("file").agg(F.sum("n_odd").alias("n")).where("n % 2 = 1").first()
    if unclosed:
        raise MalformedRecord(f"MALFORMED: a quoted field of {unclosed['file']} does not end")
    touched = F.col("n_odd") + F.col("carried") > 0
    calm = lines.join(splits.where(~touched), ["file", "start"], "left_semi").select("_metadata", "value")

    # Within a split, a line begins a record where the quotes before it are even.
    along = Window.partitionBy("file", "start").orderBy("at")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    state = lines.join(splits.where(touched), ["file", "start"])
    state = state.withColumn("open", (F.sum("odd").over(upto) - F.col("odd") + F.col("carried")) % 2 == 1)
    state = state.withColumn("record", F.max(F.when(~F.col("open"), F.col("at"))).over(upto))
    alone = ~F.col("open") & (F.col("odd") == 0)
    state = settle(state.select("_metadata", "file", "start", "at", "value", "record", alone.alias("alone")))
    parts = state.where("not alone")

    # Lines before a split's first beginning go on with the last record of a split before.
    last = parts.groupBy("file", "start").agg(F.max("record").alias("last"))
    known = F.last("last", ignorenulls=True).over(before)
    last = last.select("file", "start", known.alias("earlier"))
    parts = parts.join(last, ["file", "start"]).withColumn("record", F.coalesce("record", "earlier"))
    key = ["file", "record"]
    long = parts.groupBy(*key).agg(F.sum(F.length("value") + 1).alias("n")).where(F.col("n") > longest)
    if found := long.first():
        raise MalformedRecord(
            f"MALFORMED: a quoted field of {found['file']} goes over {found['n']} characters"
        )
    pieces = F.array_sort(F.collect_list(F.struct("start", "at", "value")))
    whole = parts.groupBy(*key).agg(
        F.array_join(pieces["value"], "\n").alias("value"), F.first("_metadata").alias("_metadata")
    )
    records = calm.union(state.where("alone").select("_metadata", "value"))
    records = records.union(whole.select("_metadata", "value"))
    record = F.regexp_replace("value", "\r$", "")
    return records.select("_metadata", record.alias("record")).where(F.trim("record") != "")
