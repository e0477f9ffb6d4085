"""Session helpers: a local session for tests, and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Fixed value: the engine's setting, and the bytecode size beyond which the JVM does not compile.
COMPILED = ("spark.sql.codegen.hugeMethodLimit", "8000")
# The engine's setting to drop a query's shuffle files when it ends.
DROPPED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keep_compiled(spark: SparkSession) -> SparkSession:
    """Let no generated method grow beyond what the JVM compiles.

    Rows of some 40 derived columns make one method that is larger by default and is then
    interpreted, several times slower than the same columns computed apart. A limit that the
    session has set itself stays.
    """
    if spark.conf.get(COMPILED[0]) == "65535":
        spark.conf.set(*COMPILED)
    return spark


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries planned inside lose their shuffle files as they end, not when the driver comes to
    collect its garbage, so a chain of writes holds the files of one. For frames that run once:
    the same frame object run again would have to make the files again.
    """
    before = spark.conf.get(DROPPED, None)
    spark.conf.set(DROPPED, "true")
    try:
        yield
    finally:
        spark.conf.unset(DROPPED) if before is None else spark.conf.set(DROPPED, before)


def local_session(name: str, cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tallyhouse-wh-"),
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, taken from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder: on a
    cluster a machine-local folder would be lost with its executor.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
            "spark.checkpoint.dir", None
        )
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="tallyhouse-shared-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder, for plans that read it again."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
