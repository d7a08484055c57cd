"""Commit-tagged Parquet tables (K3, K6/K7; S5 re-aimed).

A table is

* ``data/``     Parquet partitioned by ``_commit`` (then the table's own
  partition columns), written with dynamic partition overwrite, and
* ``_commits/`` a plain JSON table with one row per version: ``(version, op,
  commit_id, parent, restored_from, committed_at)``.

A version's rows are those of the commits on its chain of parents: an append
continues the version before it, an overwrite starts a new chain, a restore
continues the restored version.  Data is written before its commits row, and a
replayed ``commit_id`` rewrites only its own partition and adds no second row,
so a re-run micro-batch is exactly-once whatever either run held.  Which rows
are visible never depends on a recorded count.

This is bookkeeping for one writer per table, not a transaction log: racing
writers are neither merged nor detected.
"""

from __future__ import annotations

import datetime as _dt
import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide import fs

COMMIT_COL = "_commit"
# Commit ids are folder names (partition values): keep them path-safe.
_COMMIT_ID = re.compile(r"[A-Za-z0-9_-]{1,128}")

COMMITS_SCHEMA = "version bigint, op string, commit_id string, parent bigint, restored_from bigint, committed_at timestamp"


class SchemaMismatch(ValueError):
    """Raised by a schema-enforced append when the columns do not conform."""


def schema_differences(actual: T.StructType, expected: T.StructType, keep_order: bool = False) -> list[tuple]:
    """``(column, expected type, actual type)`` for every differing column.

    Nullability is never compared (file sources return nullable columns
    whatever was declared).  With ``keep_order`` a column at the wrong
    position also counts as a difference.
    """
    exp = {f.name: f.dataType.simpleString() for f in expected.fields}
    act = {f.name: f.dataType.simpleString() for f in actual.fields}
    diffs = []
    for name in list(exp) + [n for n in act if n not in exp]:
        if exp.get(name) != act.get(name):
            diffs.append((name, exp.get(name), act.get(name)))
    if keep_order and not diffs and [f.name for f in expected.fields] != [f.name for f in actual.fields]:
        for i, (e, a) in enumerate(zip(expected.fields, actual.fields)):
            if e.name != a.name:
                diffs.append((f"#{i}", e.name, a.name))
    return diffs


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, name: str, partition_by: Sequence[str] = ()):
        self.spark = spark
        self.path = path.rstrip("/")
        self.name = name
        self.partition_by = list(partition_by)
        self.data_path = f"{self.path}/data"
        self.commits_path = f"{self.path}/_commits"
        self.schema_path = f"{self.path}/_schema.json"
        self._known: dict[int, dict] | None = None
        self._schema: T.StructType | None = None

    # -- commits ----------------------------------------------------------
    def _commits_df(self) -> DataFrame:
        if not fs.exists(self.spark, self.commits_path):
            return self.spark.createDataFrame([], COMMITS_SCHEMA)
        return self.spark.read.schema(COMMITS_SCHEMA).json(self.commits_path)

    def _commits(self) -> dict[int, dict]:
        """Commits by version (a row per commit, kept by the writer)."""
        if self._known is None:
            self._known = {r["version"]: r.asDict() for r in self._commits_df().collect()}
        return self._known

    def commit_counts(self) -> DataFrame:
        """Rows of every recorded commit that has any, counted in the data."""
        recorded = [r["commit_id"] for r in self._commits().values() if r["commit_id"]]
        if not recorded:
            return self.spark.createDataFrame([], "commit_id string, rows bigint")
        rows = self._data().filter(F.col(COMMIT_COL).isin(recorded))
        return rows.groupBy(F.col(COMMIT_COL).alias("commit_id")).agg(F.count(F.lit(1)).alias("rows"))

    def history(self) -> DataFrame:
        """All commits with their rows, newest first."""
        out = self._commits_df().join(self.commit_counts(), "commit_id", "left")
        rows = F.when(F.col("op") != "RESTORE", F.coalesce("rows", F.lit(0)))
        return out.select("version", "op", "commit_id", "restored_from", rows.alias("rows"), "committed_at").orderBy(F.col("version").desc())

    def current_version(self) -> int:
        return max(self._commits(), default=-1)

    def live_commits(self, version: int | None = None) -> list[str]:
        """Commit ids of a version, oldest first: its chain of parents."""
        commits = self._commits()
        if version is None:
            version = self.current_version()
            if version < 0:
                return []
        if version not in commits:
            raise ValueError(f"{self.name}: no version {version} (latest {self.current_version()})")
        live = []
        while version >= 0:
            row = commits[version]
            if row["commit_id"]:
                live.append(row["commit_id"])
            version = row["parent"]
        return live[::-1]

    # -- read -----------------------------------------------------------
    def _data(self) -> DataFrame:
        # The stored schema spares a footer scan.
        stored = T.StructType(self.schema().fields + [T.StructField(COMMIT_COL, T.StringType())])
        if not fs.exists(self.spark, self.data_path):  # no commit had a row yet
            return self.spark.createDataFrame([], stored)
        return self.spark.read.schema(stored).parquet(self.data_path)

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of the table as of ``version`` (latest by default)."""
        live = self.live_commits(version)
        if not self._commits():
            raise ValueError(f"{self.name}: table has no commits")
        schema = self.schema()
        # A partition filter: folders of other commits are not read.
        return self._data().filter(F.col(COMMIT_COL).isin(live)).select(*schema.names)

    def written_schema(self) -> T.StructType:
        """Columns found in the footers of the files themselves."""
        found = self.spark.read.option("mergeSchema", True).parquet(self.data_path).schema
        return T.StructType([f for f in found.fields if f.name != COMMIT_COL])

    def schema(self) -> T.StructType | None:
        """The table's columns (set by its first commit)."""
        if self._schema is None:
            text = fs.read_text(self.spark, self.schema_path)
            self._schema = T.StructType.fromJson(json.loads(text)) if text else None
        return self._schema

    # -- write ----------------------------------------------------------
    def commit(self, df: DataFrame, mode: str = "append", commit_id: str | None = None) -> int:
        """Write ``df`` as one commit; returns its version.

        Replaying a ``commit_id`` that is already recorded rewrites its
        partition and returns the existing version.
        """
        op = {"append": "APPEND", "overwrite": "OVERWRITE"}[mode]
        commit_id = commit_id or f"c-{uuid.uuid4().hex[:16]}"
        if not _COMMIT_ID.fullmatch(commit_id):
            raise ValueError(f"commit id {commit_id!r}: use letters, digits, '-' and '_' only")
        first = self.schema() is None
        if not first:
            df = df.select(*self.schema().names)
        out = df.withColumn(COMMIT_COL, F.lit(commit_id))
        if self.partition_by:
            # Rebalance on the partition columns: AQE packs small partition
            # values into one task and splits a large (or skewed) one across
            # several, so each value gets a few well-sized files instead of
            # one small file per task and value.
            out = out.hint("rebalance", *self.partition_by)
        (
            out.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(COMMIT_COL, *self.partition_by)
            .parquet(self.data_path)
        )
        # After the data: who finds the schema, or the commit, finds the rows.
        if first:
            fs.write_text(self.spark, self.schema_path, json.dumps(df.schema.jsonValue()))
            self._schema = df.schema
        for version, row in self._commits().items():
            if row["commit_id"] == commit_id:
                return version
        current = self.current_version()
        return self._record(op, commit_id, current if op == "APPEND" else -1, None)

    def append_conforming(self, df: DataFrame, commit_id: str | None = None) -> int:
        """Schema-enforced append (K3): names and types must match the table
        (order and nullability aside); columns are aligned by name."""
        target = self.schema()
        if target is None:
            return self.commit(df, "append", commit_id)
        diffs = schema_differences(df.schema, target)
        if diffs:
            raise SchemaMismatch(f"{self.name}: schema differs: {diffs}")
        return self.commit(df.select(*target.names), "append", commit_id)

    def restore(self, version: int) -> int:
        """Make ``version`` current again; no data is written."""
        self.live_commits(version)  # validates the version
        return self._record("RESTORE", None, version, version)

    def restore_count(self) -> int:
        return sum(r["op"] == "RESTORE" for r in self._commits().values())

    def _record(self, op: str, commit_id: str | None, parent: int, restored_from: int | None) -> int:
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat(timespec="milliseconds") + "Z"
        row = {"version": self.current_version() + 1, "op": op, "commit_id": commit_id, "parent": parent}
        row |= {"restored_from": restored_from, "committed_at": now}
        fs.write_text(self.spark, f"{self.commits_path}/{row['version']:020d}.json", json.dumps(row))
        self._commits()[row["version"]] = row
        return row["version"]
