"""Data-quality checks as table operators.

Each check is a lazily planned DataFrame; the column-wise checks compute all
columns and rules in ONE aggregate pass (``count_if`` per column and rule),
then ``unpivot`` to long form.  Check results share the shape
``(suite, check_id, status, violations, total)`` so they can be unioned,
stored and rolled up like any other table.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ordertide.operators.versioned import schema_differences
from ordertide.session import shared_dir

RESULT_SCHEMA = "suite string, check_id string, status string, violations bigint, total bigint"


def _count_if(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False))).cast("bigint")


# -- column profiles ------------------------------------------------------------
def null_profile(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """NULLs per column in one pass (A5/D7): ``(*by, column_name, nulls)``."""
    cols = [c for c in (columns or df.columns) if c not in by]
    wide = df.groupBy(*by).agg(*[_count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot(list(by), cols, "column_name", "nulls")


# Columns whose three flags fit one 64-bit mask.
MASKED = 21


def string_hygiene(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Untrimmed, blank and literal-``null`` values per string column (D3).

    ``(*by, column_name, untrimmed, blank, null_literal)``; NULLs count as
    none of them.  A row's flags are packed into masks, three bits a column,
    and rows with equal masks are counted; only the distinct masks are then
    unfolded into columns, so a row stays one row and a group one buffer.
    """
    cols = [c for c in (columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])
            if c not in by]

    def mask(some: Sequence[str]) -> Column:
        out = F.lit(0).cast("bigint")
        for i, c in enumerate(some):
            v, t = F.col(c), F.trim(F.col(c))
            for j, flag in enumerate((v != t, t == "", F.lower(t) == "null")):
                out = out + F.when(flag, F.lit(1 << (3 * i + j)).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        return out

    chunks = [cols[i : i + MASKED] for i in range(0, len(cols), MASKED)]
    masks = [f"_mask{k}" for k in range(len(chunks))]
    rows = df.select(*by, *[mask(some).alias(m) for m, some in zip(masks, chunks)])
    counted = rows.groupBy(*by, *masks).agg(F.count(F.lit(1)).alias("_rows"))
    flags = [
        F.struct(F.lit(c).alias("column_name"), F.shiftright(m, 3 * i).bitwiseAND(F.lit(7).cast("bigint")).alias("flags"))
        for m, some in zip(masks, chunks)
        for i, c in enumerate(some)
    ]
    long = counted.select(*by, "_rows", F.inline(F.array(*flags)))

    def total(bit: int) -> Column:
        return F.sum(F.when(F.col("flags").bitwiseAND(F.lit(bit).cast("bigint")) != 0, F.col("_rows")).otherwise(F.lit(0).cast("bigint")))

    return long.groupBy(*by, "column_name").agg(total(1).alias("untrimmed"), total(2).alias("blank"), total(4).alias("null_literal"))


def length_violations(df: DataFrame, expected: Mapping[str, Iterable[int]]) -> DataFrame:
    """Values whose length is not one of the expected lengths.

    ``(column_name, violations, checked)``; NULLs are not checked.
    """
    aggs = []
    for c, lengths in expected.items():
        aggs.append(_count_if(~F.length(F.col(c)).isin(*list(lengths))).alias(f"{c}\u0001v"))
        aggs.append(F.count(F.col(c)).cast("bigint").alias(f"{c}\u0001n"))
    wide = df.agg(*aggs)
    packed = wide.select(
        *[F.struct(F.col(f"`{c}\u0001v`").alias("violations"), F.col(f"`{c}\u0001n`").alias("checked")).alias(c)
          for c in expected]
    )
    return packed.unpivot([], list(expected), "column_name", "v").select("column_name", "v.violations", "v.checked")


def cast_failures(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Non-NULL values that do not cast to the target type (D9 addition):
    ``(column_name, target_type, failures)``."""
    wide = df.agg(
        *[_count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(c) for c, t in casts.items()]
    )
    types = F.create_map(*[x for c, t in casts.items() for x in (F.lit(c), F.lit(t))])
    return wide.unpivot([], list(casts), "column_name", "failures").select(
        "column_name", types[F.col("column_name")].alias("target_type"), "failures"
    )


def date_violations(df: DataFrame, time: str, day: str, by: Column) -> DataFrame:
    """Rows per source whose ``time`` is missing or not on ``day``:
    ``(source, total, violations)``."""
    on_day = F.coalesce(F.to_date(time) == F.lit(day).cast("date"), F.lit(False))
    return df.groupBy(by.alias("source")).agg(F.count(F.lit(1)).alias("total"), F.count_if(~on_day).cast("bigint").alias("violations"))


def value_range(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Min and max per column in one pass (D8): ``(column_name, min, max)``."""
    wide = df.agg(*[F.struct(F.min(c).alias("min"), F.max(c).alias("max")).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column_name", "v").select("column_name", "v.min", "v.max")


def scalar_row(values: Mapping[str, DataFrame]) -> DataFrame:
    """Put several one-row, one-column aggregates side by side in one row.

    The aggregates are unioned with a label and folded by a conditional
    aggregate, instead of joining one-row frames without a condition
    (a cartesian product in the plan).
    """
    labelled = None
    for name, df in values.items():
        part = df.select(F.lit(name).alias("k"), F.col(df.columns[0]).cast("bigint").alias("v"))
        labelled = part if labelled is None else labelled.unionByName(part)
    return labelled.agg(*[F.max(F.when(F.col("k") == name, F.col("v"))).alias(name) for name in values])


# -- structural -------------------------------------------------------------------
def schema_check(spark: SparkSession, actual: T.StructType, expected: T.StructType, keep_order: bool = False) -> DataFrame:
    """One row per differing column (D1); empty when the schemas conform.
    Metadata only: no job over the data."""
    rows = schema_differences(actual, expected, keep_order)
    return spark.createDataFrame(rows, "column_name string, expected_type string, actual_type string")


def missing_months(df: DataFrame, month_col: str = "submitted_yyyy_mm") -> DataFrame:
    """Months between the first and last partition value that have no rows
    (D10).  The expected months are generated from the data's own range with
    ``sequence``; the present ones are distinct partition values (a
    partition-only scan), anti-joined."""
    present = df.select(F.col(month_col).alias("month")).distinct()
    bounds = present.agg(F.min("month").alias("lo"), F.max("month").alias("hi"))
    expected = bounds.select(
        F.explode(
            F.sequence(F.to_date(F.concat("lo", F.lit("-01"))), F.to_date(F.concat("hi", F.lit("-01"))),
                       F.expr("interval 1 month"))
        ).alias("d")
    ).select(F.date_format("d", "yyyy-MM").alias("month"))
    return expected.join(present, "month", "left_anti")


def month_coverage(df: DataFrame, month_col: str = "submitted_yyyy_mm", expected: Sequence[str] | None = None) -> DataFrame:
    """Present and missing months in one scan (D10): ``(present_months, missing_months)``.

    ``expected`` lists the months that must be there, so a missing first or
    last month shows; without it the months between the first and the last
    present one are expected.  The distinct months are gathered with
    ``collect_set`` - bounded by the calendar (12 per year), combined map-side.
    """
    months = df.agg(F.collect_set(month_col).alias("m"))
    if expected is not None:
        wanted = F.array(*[F.lit(m) for m in expected])
    else:
        first = F.to_date(F.concat(F.array_min("m"), F.lit("-01")))
        last = F.to_date(F.concat(F.array_max("m"), F.lit("-01")))
        wanted = F.transform(F.sequence(first, last, F.expr("interval 1 month")), lambda d: F.date_format(d, "yyyy-MM"))
    return months.select(
        F.size("m").cast("bigint").alias("present_months"),
        F.coalesce(F.size(F.array_except(wanted, F.col("m"))), F.lit(0)).cast("bigint").alias("missing_months"),
    )


def tolerant_diff(left: DataFrame, right: DataFrame, keys: Sequence[str], tolerance: float) -> DataFrame:
    """Keys whose other, numeric columns differ by more than ``tolerance``, or
    that only one side has (D12).  Keys must be unique on either side."""
    keys = list(keys)
    values = [c for c in left.columns if c not in keys]
    r = right.select(*keys, *[F.col(c).alias(f"{c}_right") for c in values], F.lit(True).alias("_in_right"))
    both = left.withColumn("_in_left", F.lit(True)).join(r, keys, "full")
    bad = F.col("_in_left").isNull() | F.col("_in_right").isNull()
    for c in values:
        a, b = F.col(c), F.col(f"{c}_right")
        bad = bad | F.coalesce(F.abs(a - b) > tolerance, a.isNull() != b.isNull())
    return both.filter(bad).drop("_in_left", "_in_right")


def disorder(df: DataFrame, column: str, ascending: bool = True) -> DataFrame:
    """One row: places where ``column`` of an ordered result breaks its order
    (D12, O1).  Rows are numbered as they come; the comparison with the row
    before is a join on that number, so no window gathers the result."""
    at = df.select(F.monotonically_increasing_id().alias("at"), F.col(column).alias("v"), F.spark_partition_id().alias("p"))
    before = at.select((F.col("at") + 1).alias("at"), F.col("v").alias("last"))
    wrong = F.col("v") < F.col("last") if ascending else F.col("v") > F.col("last")
    inside = at.join(before, "at").agg(F.count_if(wrong).alias("n"))
    # Between tasks: the first value of one against the last of the task before.
    edges = at.groupBy("p").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    order = Window.orderBy("p" if ascending else F.col("p").desc())
    across = edges.withColumn("prev", F.lag("hi").over(order)).agg(F.count_if(F.col("lo") < F.col("prev")).alias("n"))
    return inside.unionByName(across).agg(F.sum("n").cast("bigint").alias("out_of_order"))


def numbered(df: DataFrame, position: str = "position") -> DataFrame:
    """An ordered result plus every row's 0-based place in it.

    Sorted rows lie in range-dealt runs, one per task: a row's place is its
    place in its run plus the rows of the runs before, so no window gathers
    the result.  The rows are cut once, which fixes the runs.
    """
    shared_dir(df.sparkSession)
    rows = df.withColumn("_at", F.monotonically_increasing_id()).checkpoint(eager=True)
    run = F.shiftrightunsigned("_at", 33)
    before = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task.
    runs = rows.groupBy(run.alias("_run")).agg(F.count(F.lit(1)).alias("_rows"))
    runs = runs.select("_run", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(runs, run == F.col("_run")).select(place.alias(position), *df.columns)


def position_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Places at which two ordered results differ (D12): ``(position, left,
    right)``, the rows as structs, NULL past the end of a result."""
    cols = left.columns
    if cols != right.columns:
        raise ValueError(f"columns differ: {cols} vs {right.columns}")
    a, b = (numbered(df).select("position", F.struct(*cols).alias(side)) for df, side in ((left, "left"), (right, "right")))
    return a.join(b, "position", "full").filter(~F.col("left").eqNullSafe(F.col("right")))


def first_and_last(df: DataFrame) -> DataFrame:
    """The first and the last row of an ordered result, with their places."""
    rows = numbered(df)
    last = rows.agg(F.max("position").alias("_last"))
    ends = last.select(F.explode(F.array_distinct(F.array(F.lit(0).cast("bigint"), "_last"))).alias("position"))
    return rows.join(ends, "position")


def range_check(ranges: DataFrame, expected: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Min and max of every column against the expected ones, exactly."""
    spark = ranges.sparkSession
    want = spark.createDataFrame([(c, lo, hi) for c, (lo, hi) in expected.items()], "column_name string, expected_min double, expected_max double")
    same = F.col("min").eqNullSafe(F.col("expected_min")) & F.col("max").eqNullSafe(F.col("expected_max"))
    return ranges.join(want, "column_name", "full").withColumn("ok", same)


def multiset_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose multiplicity differs between two DataFrames.

    Each side is grouped by all its columns with a count (partial aggregation
    first), then the two are full-outer-joined null-safely; never collected.
    ``(*columns, left_count, right_count)``.
    """
    cols = left.columns
    if sorted(cols) != sorted(right.columns):
        raise ValueError(f"columns differ: {cols} vs {right.columns}")
    lc = left.groupBy(*cols).agg(F.count(F.lit(1)).alias("left_count"))
    rc = right.select(*cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("right_count")).alias("r")
    lc = lc.alias("l")
    cond = None
    for c in cols:
        e = F.col(f"l.`{c}`").eqNullSafe(F.col(f"r.`{c}`"))
        cond = e if cond is None else cond & e
    joined = lc.join(rc, cond, "full")
    out = joined.select(
        *[F.coalesce(F.col(f"l.`{c}`"), F.col(f"r.`{c}`")).alias(c) for c in cols],
        F.coalesce("left_count", F.lit(0)).alias("left_count"),
        F.coalesce("right_count", F.lit(0)).alias("right_count"),
    )
    return out.filter(F.col("left_count") != F.col("right_count"))


def reconcile_counts(actual: Mapping[str, DataFrame], expected: DataFrame) -> DataFrame:
    """Expected against actual row counts.

    ``expected`` has ``(table_name, expected)``; every actual count is its own
    aggregate, unioned and joined to the expectations (a table missing on
    either side shows as NULL and fails).
    """
    counts = None
    for name, df in actual.items():
        c = df.agg(F.count(F.lit(1)).cast("bigint").alias("actual")).select(F.lit(name).alias("table_name"), "actual")
        counts = c if counts is None else counts.unionByName(c)
    return counts.join(expected, "table_name", "full").select(
        "table_name",
        F.col("expected").cast("bigint").alias("expected"),
        "actual",
        F.coalesce(F.col("expected").cast("bigint") == F.col("actual"), F.lit(False)).alias("ok"),
    )


# -- check results ------------------------------------------------------------------
def check(suite: str, check_id: str, violations: Column, total: Column) -> list[Column]:
    """Columns of one check row computed from aggregate expressions."""
    return [
        F.lit(suite).alias("suite"),
        F.lit(check_id).alias("check_id"),
        F.when(violations == 0, "passed").otherwise("failed").alias("status"),
        violations.cast("bigint").alias("violations"),
        total.cast("bigint").alias("total"),
    ]


def stage_rollup(results: DataFrame) -> DataFrame:
    """Per suite: passed checks, all checks, percent, and whether all passed."""
    return results.groupBy("suite").agg(
        F.count_if(F.col("status") == "passed").cast("bigint").alias("passed"),
        F.count(F.lit(1)).cast("bigint").alias("checks"),
        F.round(F.count_if(F.col("status") == "passed") * 100.0 / F.count(F.lit(1)), 1).alias("percent"),
        F.bool_and(F.col("status") == "passed").alias("all_passed"),
    )


def final_gate(results: DataFrame, stages: Sequence[str]) -> DataFrame:
    """One row: every required stage present and fully passed.
    A stage with no results counts as failed."""
    spark = results.sparkSession
    required = spark.createDataFrame([(s,) for s in stages], "suite string")
    rolled = stage_rollup(results)
    joined = required.join(rolled, "suite", "left")
    return joined.agg(
        F.count(F.lit(1)).cast("bigint").alias("stages"),
        F.count_if(F.coalesce(F.col("all_passed"), F.lit(False))).cast("bigint").alias("stages_passed"),
        F.bool_and(F.coalesce(F.col("all_passed"), F.lit(False))).alias("passed"),
    )
