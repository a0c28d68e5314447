"""Atomic publishing of tables.

``mode("overwrite")`` removes the old output before the new one is there, so a
failed rerun leaves nothing. Here every run writes its tables to a folder of its own
and then commits one small manifest; readers resolve the newest manifest, so they
see all tables of the last complete run or, while one is running or has failed, all
tables of the run before it.

    <root>/v-<number>-<id>/<table>/...      the tables of a version (Parquet)
    <root>/commits/c-<number>-<id>/...      its manifest: one JSON line

Manifests are written by Spark like any table (a task's file appears by one rename
or one put), so any store that Spark can write will do. One writer at a time is
expected; ``Draft`` notes the version it started from, and a commit fails if
another version has been committed since.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_path

_MANIFEST = "number long, folder string, commit string, schemas map<string,string>, note map<string,string>"


class PublishConflict(RuntimeError):
    """Another version was committed between the start and the commit of a draft."""


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    commit: str
    schemas: dict[str, str]  # table -> schema as JSON
    note: dict[str, str]

    def path(self, table: str) -> str:
        if table not in self.schemas:
            raise KeyError(f"version {self.number} has no table {table!r}; it has {sorted(self.schemas)}")
        return f"{self.folder}/{table}"

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(self.schemas[table])) if table in self.schemas else None
        return spark.read.schema(schema).parquet(self.path(table)) if schema else spark.read.parquet(self.path(table))


def versions(spark: SparkSession, root: str) -> list[Version]:
    """Committed versions, oldest first (a line a version; see :func:`expire`)."""
    root = root.rstrip("/")
    try:
        rows = spark.read.schema(_MANIFEST).option("recursiveFileLookup", True).json(f"{root}/commits").where(F.col("number").isNotNull()).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    found = [Version(r["number"], f"{root}/{r['folder']}", f"{root}/commits/{r['commit']}", r["schemas"] or {}, r["note"] or {}) for r in rows]
    return sorted(found, key=lambda v: (v.number, v.folder))


def latest(spark: SparkSession, root: str) -> Version | None:
    return (versions(spark, root) or [None])[-1]


def read_published(spark: SparkSession, root: str, table: str, number: int | None = None) -> DataFrame:
    """A table of the newest version, or of the version ``number``."""
    found = [v for v in versions(spark, root) if number is None or v.number == number]
    if not found:
        raise FileNotFoundError(f"nothing is published at {root}" + (f" as version {number}" if number is not None else ""))
    return found[-1].read(spark, table)


class Draft:
    """A version in the making: write its tables, then commit. A draft that is not
    committed is never seen by a reader."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root.rstrip("/")
        before = latest(spark, self._root)
        self._after = before.number if before else 0
        self._name = f"{self._after + 1:010d}-{uuid.uuid4().hex[:12]}"
        self._schemas: dict[str, str] = {}

    def path(self, table: str) -> str:
        return f"{self._root}/v-{self._name}/{table}"

    def write(self, df: DataFrame, table: str) -> DataFrame:
        """Write a table and return it as read back."""
        df.write.mode("errorifexists").parquet(self.path(table))
        back = self._spark.read.parquet(self.path(table))
        self._schemas[table] = back.schema.json()
        return back

    def commit(self, note: dict[str, str] | None = None) -> Version:
        now = latest(self._spark, self._root)
        if (now.number if now else 0) != self._after:
            raise PublishConflict(f"version {now.number if now else 0} was committed at {self._root} after this draft began at {self._after}")
        name = self._name
        row = (self._after + 1, f"v-{name}", f"c-{name}", dict(self._schemas), {k: str(v) for k, v in (note or {}).items()})
        self._spark.createDataFrame([row], _MANIFEST).coalesce(1).write.mode("errorifexists").json(f"{self._root}/commits/c-{name}")
        return Version(row[0], f"{self._root}/v-{name}", f"{self._root}/commits/c-{name}", row[3], row[4])

    def discard(self) -> None:
        """Remove what a failed draft has written."""
        delete_path(self._spark, f"{self._root}/v-{self._name}")


def publish(tables: dict[str, DataFrame], root: str, note: dict[str, str] | None = None) -> Version:
    """Write all tables and commit them together; none is seen if one fails."""
    draft = Draft(next(iter(tables.values())).sparkSession, root)
    for name, df in tables.items():
        draft.write(df, name)
    return draft.commit(note)


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Remove all but the newest ``keep`` versions, each manifest before its tables;
    returns the numbers removed."""
    if keep < 1:
        raise ValueError("the newest version has to stay")
    old = versions(spark, root)[:-keep]
    for v in old:
        delete_path(spark, v.commit)
        delete_path(spark, v.folder)
    return [v.number for v in old]
