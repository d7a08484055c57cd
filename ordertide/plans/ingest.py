"""Batch ingest: three order files into one raw dataset of strings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ordertide.schemas import COMMA_SEPARATED_HEADER, RAW_ORDER_COLUMNS, REJECTS_SCHEMA
from ordertide.sources.files import CORRUPT, accepted, read_delimited, read_fixed_width, rejected

BATCH_KINDS = ("fixed_width", "tab_separated", "comma_separated")
RAW_COLUMNS = RAW_ORDER_COLUMNS + ["ingest_file_name", "ingested_at"]


def read_batch(
    spark: SparkSession, kind: str, path: str | Sequence[str], clean: bool = True, lineage: bool = True, keep_rejects: bool = False
) -> DataFrame:
    """One raw order file in the 19-string-column shape (and the rejected
    records' text, with ``keep_rejects``)."""
    options = {"clean": clean, "lineage": lineage, "keep_rejects": keep_rejects}
    if kind == "fixed_width":
        return read_fixed_width(spark, path, **options)
    if kind == "tab_separated":
        return read_delimited(spark, path, sep="\t", positional=False, header=RAW_ORDER_COLUMNS, **options)
    if kind == "comma_separated":
        return read_delimited(spark, path, sep=",", positional=True, header=COMMA_SEPARATED_HEADER, **options)
    raise ValueError(f"unknown batch kind {kind!r}")


def read_all_batches(spark: SparkSession, paths: dict[str, str], clean: bool = True) -> DataFrame:
    """All batch files as one DataFrame (a union; no shuffle)."""
    frames = [read_batch(spark, k, paths[k], clean=clean) for k in BATCH_KINDS]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def write_raw_batches(spark: SparkSession, paths: dict[str, str | Sequence[str]], target: str, rejects: str | None = None) -> None:
    """Ingest each file into the raw Parquet dataset: the first overwrites,
    the later ones append (each write is a map-only job).

    Records that can't be read go to the ``rejects`` dataset (file, time,
    text).  They are counted while the good ones are written; only a file
    that has some is read again for them.
    """
    if rejects is not None:
        spark.createDataFrame([], REJECTS_SCHEMA).write.mode("overwrite").parquet(rejects)
    for i, kind in enumerate(BATCH_KINDS):
        df = read_batch(spark, kind, paths[kind], keep_rejects=True)
        seen = Observation()
        counted = df.observe(seen, F.count(CORRUPT).alias("rejected"))
        accepted(counted).select(RAW_COLUMNS).write.mode("overwrite" if i == 0 else "append").parquet(target)
        if rejects is not None and seen.get["rejected"]:
            rejected(df).select(REJECTS_SCHEMA.names).write.mode("append").parquet(rejects)
