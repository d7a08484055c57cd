"""Deterministic dedupe on a key subset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

FILES = 1_000_000_000  # more than the files of one dedupe
NO_TIME = 9_223_372_036_854_775_807  # stands for a missing time: after every real one


def dedupe_earliest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: tuple[str, str] = ("ingested_at", "ingest_file_name"),
    any_true: Sequence[str] = (),
) -> DataFrame:
    """One row per distinct ``keys``; time and file from the earliest row.

    Unlike ``dropDuplicates`` (which keeps an arbitrary row), the kept values
    are those of the first row by (time, file name), whatever the
    partitioning; a missing time or file name comes last and is kept as NULL
    only when the key has no other.  NULL keys are keys like others.  Flags in
    ``any_true`` are OR-ed over the group.  Time and the file's number are
    packed into one fixed-width decimal, so the aggregates hash (a struct
    holding a string would sort every partition before and after the
    shuffle), and a key holding a third of all rows is combined map-side.  The
    files are numbered from their distinct names, one row per file, and go to
    the rows as a broadcast: the rows are never shuffled by the few file names.
    """
    keys, (time, file) = list(keys), order_by
    numbered = F.row_number().over(Window.orderBy(F.col("_file").asc_nulls_last()))
    files = df.select(F.col(file).alias("_file")).distinct().select("_file", numbered.alias("_file_no"))
    micros = F.coalesce(F.unix_micros(time), F.lit(NO_TIME)).cast("decimal(20,0)")
    packed = micros * F.lit(FILES).cast("decimal(10,0)") + F.col("_file_no")
    aggs = [F.min(packed.cast("decimal(38,0)")).alias("_first")]
    aggs += [F.bool_or(F.col(c)).alias(c) for c in any_true]
    out = df.join(F.broadcast(files), F.col(file).eqNullSafe(F.col("_file"))).groupBy(*keys).agg(*aggs)
    # Times before 1970 are negative: the number's place is taken with pmod.
    number = F.expr(f"cast(pmod(_first, cast({FILES} as decimal(38,0))) as int)")
    out = out.withColumn("_no", number).withColumn("_micros", F.expr(f"cast((_first - _no) div {FILES} as bigint)"))
    out = out.withColumn(time, F.timestamp_micros(F.nullif("_micros", F.lit(NO_TIME))))
    out = out.join(F.broadcast(files.withColumnRenamed("_file", file)), F.col("_no") == F.col("_file_no"))
    kept = {*keys, *any_true, time, file}
    return out.select(*[c for c in df.columns if c in kept])
