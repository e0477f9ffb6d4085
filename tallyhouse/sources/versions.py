"""What a stored table was made from, so that a run can go on after a driver was killed.

Every refresh gives a table a folder of its own, which names the version. When a step has stored
and counted its tables, each gets a mark: a fingerprint of the step's inputs and code, its rows,
and the folder. A table that was switched since, by whatever, no longer lies in that folder and
counts as not made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from functools import cache
from importlib import resources

from pyspark.sql import SparkSession

from tallyhouse.sources.tables import _path, location, properties

MADE = "version.made"  # table property: fingerprint, rows and folder
# Settings that change what a step computes.
SETTINGS = ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.caseSensitive")


@cache
def code_version() -> str:
    """Of the package's modules; another release makes everything anew."""
    found = hashlib.sha256()

    def add(folder) -> None:
        for entry in sorted(folder.iterdir(), key=lambda e: e.name):
            if entry.is_dir() and entry.name != "llm" and not entry.name.startswith("__"):
                add(entry)
            elif entry.name.endswith(".py"):
                found.update(entry.name.encode() + b"\0" + entry.read_bytes())

    add(resources.files("tallyhouse"))
    return found.hexdigest()


def fingerprint(spark: SparkSession, step: str, inputs: Iterable[str]) -> str:
    settings = [spark.conf.get(name) for name in SETTINGS]
    facts = "\n".join([step, code_version(), *settings, *sorted(inputs)])
    return hashlib.sha256(facts.encode()).hexdigest()


def file_versions(spark: SparkSession, path: str) -> list[str]:
    """Name, length and time of change of a file, or of all files below a folder."""
    files, root = _path(spark, path)
    listed, found = files.listFiles(root, True), []
    while listed.hasNext():
        status = listed.next()
        found.append(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}")
    return found


def table_versions(spark: SparkSession, database: str) -> list[str]:
    names = [t.name for t in spark.catalog.listTables(database)]
    return [f"{name} {location(spark, f'{database}.{name}')}" for name in names]


def mark_made(spark: SparkSession, table: str, made_from: str, rows: int) -> None:
    where = location(spark, table)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{MADE}' = '{made_from} {rows} {where}')")


def made_rows(spark: SparkSession, table: str, made_from: str) -> int | None:
    """A table's rows, if what it holds now was made from this; else None."""
    where = location(spark, table)
    if where is None:
        return None
    mark = properties(spark, table).get(MADE, "").split(" ", 2)
    return int(mark[1]) if mark[0] == made_from and mark[2] == where else None


def mark_layer(spark: SparkSession, database: str, made_from: str, rows: int) -> None:
    """Mark all tables of a layer that one step makes, with the rows of them all."""
    for name in [t.name for t in spark.catalog.listTables(database)]:
        mark_made(spark, f"{database}.{name}", made_from, rows)


def layer_rows(spark: SparkSession, database: str, made_from: str) -> int | None:
    """The rows of a layer all of whose tables were made from this; else None."""
    names = [t.name for t in spark.catalog.listTables(database)]
    found = {made_rows(spark, f"{database}.{name}", made_from) for name in names}
    return found.pop() if len(found) == 1 else None
