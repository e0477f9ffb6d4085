"""Small helpers that several operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the white space of the contracts, U+0020 and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# In regular expressions of Spark and DuckDB alike.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with a tail where ``df`` has a column of that name in any case."""
    taken = {column.lower() for column in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def column(df: DataFrame, name: str) -> Column:
    """A column whose name may hold dots or backticks."""
    return df["`" + name.replace("`", "``") + "`"]


def named(out: DataFrame, docs: DataFrame, extra: list[str]) -> DataFrame:
    """Columns ``c0``, ``c1``... of ``out`` under the names of ``extra``, then its others,
    with a tail where one of ``extra`` has their name."""
    added = out.columns[len(extra) :]
    names = fresh(docs.select(*[column(docs, name) for name in extra]), *added)
    return out.select(
        *[F.col(f"c{i}").alias(name) for i, name in enumerate(extra)],
        *[F.col(old).alias(new) for old, new in zip(added, names, strict=True)],
    )


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo: the folds that the contracts name."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def cores(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism)
