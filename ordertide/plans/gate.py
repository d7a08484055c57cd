"""Quality gate: check rows per stage, persisted, and rolled up.

Each stage's checks are a few aggregates over its own tables (one scan per
table and kind of check), written once per workspace to a results table that
the roll-up and the final gate only read.  A stage without results fails.
The check functions take DataFrames, so the same code also runs on data with
injected defects (see :mod:`ordertide.plans.defects`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide.functions.clean import epoch_to_timestamp, ssn_format_error
from ordertide.operators import quality as dq
from ordertide.plans.fixtures import ROUTES, STREAM_ROUTE, enriched_orders, state_code, table
from ordertide.plans.jobs import run_concurrently
from ordertide.schemas import LINE_ITEMS_SCHEMA, ORDERS_SCHEMA, PRODUCTS_SCHEMA, RAW_ORDER_COLUMNS, SALES_REPS_SCHEMA
from ordertide.sources.files import file_inventory, read_products_xml

STAGES = ["install", "ingest", "normalize", "products", "stream", "questions"]
COLUMNS = ["suite", "check_id", "status", "violations", "total"]

# Expected value lengths in the raw dataset (ours are numbers,
# so the ids are not fixed-length; the epochs of 1995-2000 have 9 digits).
EXPECTED_LENGTHS = {
    "submitted_at": [9],
    "sales_rep_ssn": [9, 11],
    "sales_rep_state": [2],
    "sales_rep_zip": [5],
    "shipping_address_state": [2],
    "shipping_address_zip": [5],
}
# First and last month the orders must cover.
# Least and greatest adjustment of the products for sale.
EXPECTED_RANGES = {"color_adj": (1.0, 1.1), "size_adj": (0.9, 1.0)}
EXPECTED_MONTHS = ("1995-01", "2001-08")


def months_between(first: str, last: str) -> list[str]:
    """All months from ``first`` to ``last``, both ``yyyy-MM``."""
    a, b = (int(m[:4]) * 12 + int(m[5:]) - 1 for m in (first, last))
    return [f"{k // 12:04d}-{k % 12 + 1:02d}" for k in range(a, b + 1)]


def source_of(path: Column | str) -> Column:
    """Source folder of a file path (the file-name part is a Spark part file)."""
    p = F.col(path) if isinstance(path, str) else path
    return F.element_at(F.split(p, "/"), -2)


def year_fits_route(source: Column, year: Column) -> Column:
    ok, first = F.lit(False), 0
    for name, last in ROUTES:
        ok = F.when(source == name, year.between(first, last)).otherwise(ok)
        first = last + 1
    return ok


def _sum_of(conditions) -> Column:
    total = F.lit(0)
    for c in conditions:
        total = total + F.coalesce(c, F.lit(False)).cast("int")
    return F.sum(total)


def _rows(one_row: DataFrame, checks: list[list[Column]]) -> DataFrame:
    """Check rows from the columns of a one-row aggregate."""
    return one_row.select(F.inline(F.array(*[F.struct(*c) for c in checks])))


def ingest_checks(raw: DataFrame, built_on: str) -> DataFrame:
    """D3-D6 on the raw dataset: a stacked hygiene aggregate and one narrow
    aggregate over the columns that the other checks need."""
    hygiene = dq.string_hygiene(raw, RAW_ORDER_COLUMNS).agg(
        *dq.check("ingest", "clean_strings", F.sum(F.col("untrimmed") + F.col("blank") + F.col("null_literal")), F.count(F.lit(1)))
    )
    year = F.year(epoch_to_timestamp("submitted_at"))
    narrow = raw.agg(
        F.count(F.lit(1)).alias("rows"),
        _sum_of(~F.length(c).isin(*n) for c, n in EXPECTED_LENGTHS.items()).alias("lengths"),
        _sum_of(F.col(c).isNotNull() for c in EXPECTED_LENGTHS).alias("checked"),
        F.count_if(~F.coalesce(year_fits_route(source_of("ingest_file_name"), year), F.lit(False))).alias("years"),
        F.count_if(~F.coalesce(F.to_date("ingested_at") == F.lit(built_on).cast("date"), F.lit(False))).alias("dates"),
    )
    return hygiene.unionByName(
        _rows(
            narrow,
            [
                dq.check("ingest", "value_lengths", F.coalesce("lengths", F.lit(0)), F.coalesce("checked", F.lit(0))),
                dq.check("ingest", "file_year", F.col("years"), F.col("rows")),
                dq.check("ingest", "ingest_date", F.col("dates"), F.col("rows")),
            ],
        )
    )


def schema_rows(spark: SparkSession, suite: str, found: dict[str, T.StructType], expected: dict[str, T.StructType]) -> DataFrame:
    """A check row per table, from the schemas of the written files."""
    rows = []
    for name, want in expected.items():
        bad = dq.schema_differences(found[name], want)
        rows.append((suite, f"schema_{name}", "failed" if bad else "passed", len(bad), len(want.fields)))
    return spark.createDataFrame(rows, dq.RESULT_SCHEMA)


def normalize_checks(orders: DataFrame, items: DataFrame, reps: DataFrame, expected: DataFrame, months: list[str]) -> DataFrame:
    """One aggregate per table; ``expected`` has the counts
    (orders, line_items, sales_reps, flagged_reps) by name."""
    keys = ["submitted_at", "order_id", "customer_id", "submitted_yyyy_mm"]
    o = orders.agg(
        F.count(F.lit(1)).alias("orders"),
        _sum_of(F.col(c).isNull() for c in keys).alias("nulls"),
        F.collect_set("submitted_yyyy_mm").alias("present"),  # bounded by the calendar
    )
    want = F.array(*[F.lit(m) for m in months])
    missing = F.size(F.array_except(want, F.col("present")))
    out = _rows(
        o,
        [
            dq.check("normalize", "non_null_keys", F.coalesce("nulls", F.lit(0)), F.col("orders") * len(keys)),
            dq.check("normalize", "month_partitions", missing, F.lit(len(months))),
        ],
    )
    r = reps.agg(F.count(F.lit(1)).alias("sales_reps"), F.count_if("_error_ssn_format").alias("flagged_reps"))
    actual = (
        o.select(F.lit("orders").alias("name"), F.col("orders").alias("actual"))
        .unionByName(items.agg(F.count(F.lit(1)).alias("actual")).select(F.lit("line_items").alias("name"), "actual"))
        .unionByName(r.unpivot([], ["sales_reps", "flagged_reps"], "name", "actual"))
    )
    both = actual.join(expected, "name", "full")
    differs = ~F.coalesce(F.col("actual") == F.col("expected"), F.lit(False))
    flags = F.col("name") == "flagged_reps"
    counts = both.agg(
        F.count_if(differs & ~flags).alias("rows_bad"), F.count_if(~flags).alias("rows"), F.count_if(differs & flags).alias("flags_bad"), F.count_if(flags).alias("flags")
    )
    return out.unionByName(
        _rows(
            counts,
            [
                dq.check("normalize", "row_counts", F.col("rows_bad"), F.col("rows")),
                dq.check("normalize", "flag_count", F.col("flags_bad"), F.col("flags")),
            ],
        )
    )


def expected_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts computed straight from the source tables: (name, expected)."""
    eo = enriched_orders(spark, sf_dir)
    batch = (F.col("route") != STREAM_ROUTE) & F.col("s_suppkey").isNotNull()
    wrong = ((F.col("s_suppkey") % 3) == 0) | (((F.col("s_suppkey") % 3) == 1) & (F.col("route") == "tab_separated"))
    orders = eo.agg(
        F.count_if(batch | (F.col("route") == STREAM_ROUTE)).cast("bigint").alias("orders"),
        F.count_distinct(F.when(batch, F.col("s_suppkey"))).cast("bigint").alias("sales_reps"),
        F.count_distinct(F.when(batch & wrong, F.col("s_suppkey"))).cast("bigint").alias("flagged_reps"),
    ).unpivot([], ["orders", "sales_reps", "flagged_reps"], "name", "expected")
    items = table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).cast("bigint").alias("expected"))
    return orders.unionByName(items.select(F.lit("line_items").alias("name"), "expected"))


def expected_orders_per_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 computed from the source tables, without any file or typed table."""
    eo = enriched_orders(spark, sf_dir)
    present = (F.col("route") == STREAM_ROUTE) | F.col("s_suppkey").isNotNull()
    return (
        eo.filter(present)
        .groupBy(state_code(F.col("c_nationkey")).alias("shipping_address_state"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def flag_check(reps: DataFrame, raw: DataFrame) -> DataFrame:
    """One row: reps, and reps whose flag isn't that of their raw records
    (true if any of them holds a hyphenated number)."""
    submitted = raw.groupBy("sales_rep_id").agg(F.bool_or(ssn_format_error("sales_rep_ssn")).alias("_hyphenated"))
    both = reps.groupBy("sales_rep_id").agg(F.bool_or("_error_ssn_format").alias("_flag")).join(submitted, "sales_rep_id", "full")
    wrong = ~F.col("_flag").eqNullSafe(F.col("_hyphenated"))
    return both.agg(F.count(F.lit(1)).alias("reps"), F.count_if(wrong).cast("bigint").alias("wrong_flags"))


def product_checks(products: DataFrame, xml: DataFrame, parts: DataFrame) -> DataFrame:
    """Adjustments in range; XML rows and priced products as many
    as the parts they were made from."""
    ranges = dq.range_check(dq.value_range(products, list(EXPECTED_RANGES)), EXPECTED_RANGES)
    adj = ranges.agg(*dq.check("products", "adj_range", F.count_if(~F.col("ok")), F.count(F.lit(1))))
    counts = dq.scalar_row(
        {
            "xml": xml.agg(F.count(F.lit(1))),
            "priced": products.agg(F.count(F.lit(1))),
            "parts": parts.agg(F.count(F.lit(1))),
            "for_sale": parts.agg(F.count_if(F.col("p_size") > 25)),
        }
    )
    off = F.abs(F.col("xml") - F.col("parts")) + F.abs(F.col("priced") - F.col("for_sale"))
    return adj.unionByName(_rows(counts, [dq.check("products", "xml_count", off, F.col("parts"))]))


def stream_checks(batches: DataFrame, reconciled: DataFrame, files: DataFrame, max_triggers: int | None = None) -> DataFrame:
    """At least one micro-batch if there are files, each with rows, and at
    most ``max_triggers`` if that is given; T9: base + new = table."""
    counts = dq.scalar_row(
        {
            "batches": batches.agg(F.count(F.lit(1))),
            "empty": batches.agg(F.count_if(F.col("order_rows") <= 0)),
            "files": files.agg(F.sum("files")),
        }
    )
    bad = F.col("empty") + F.when((F.col("files") > 0) & (F.col("batches") == 0), 1).otherwise(0)
    if max_triggers is not None:
        bad = bad + F.when(F.col("batches") > max_triggers, 1).otherwise(0)
    triggers = _rows(counts, [dq.check("stream", "trigger_count", bad, F.col("batches"))])
    return triggers.unionByName(reconciled.agg(*dq.check("stream", "reconcile", F.count_if(~F.col("ok")), F.count(F.lit(1)))))


def question_checks(q1: DataFrame, q1_expected: DataFrame, q2: DataFrame, q3: DataFrame) -> DataFrame:
    """Q1 equals the result from the source tables; Q2 answered; Q3 one row."""
    diff = dq.multiset_diff(q1, q1_expected)
    one = dq.scalar_row({"rows": q1_expected.agg(F.count(F.lit(1))), "diff": diff.agg(F.count(F.lit(1)))})
    out = _rows(one, [dq.check("questions", "q1_equal", F.col("diff"), F.col("rows"))])
    out = out.unionByName(q2.agg(*dq.check("questions", "q2_answered", F.count_if(F.col("avg_price").isNull()), F.count(F.lit(1)))))
    return out.unionByName(q3.agg(*dq.check("questions", "q3_one_row", F.abs(F.count(F.lit(1)) - 1), F.count(F.lit(1)))))


def install_checks(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Every raw input folder holds files."""
    inventory = file_inventory(spark, paths)
    return inventory.agg(*dq.check("install", "raw_files", F.count_if(F.col("files") == 0), F.count(F.lit(1))))


def write_results(w, folder: str, q2: DataFrame, q3: DataFrame, q1: DataFrame, reconciled: DataFrame) -> None:
    """Run every stage's checks and write their rows under ``folder``, a
    sub-folder per stage.  Stages are independent jobs, run side by side."""
    spark, sf_dir = w.spark, w.sf_dir
    w.streamed()
    tables = w.tables_dir()
    footers = {
        "sales_reps": spark.read.parquet(f"{tables}/sales_reps").schema,
        "products": spark.read.parquet(f"{tables}/products").schema,
        "orders": w.orders_table().written_schema(),
        "line_items": w.line_items_table().written_schema(),
    }
    typed = {"sales_reps": SALES_REPS_SCHEMA, "orders": ORDERS_SCHEMA, "line_items": LINE_ITEMS_SCHEMA}
    paths = w.raw_paths()
    from ordertide.plans import normalize

    xml = normalize.products(read_products_xml(spark, paths["products_xml"]), priced_only=False)
    stages = {
        "install": [install_checks(spark, paths)],
        "ingest": [ingest_checks(w.raw_batched(), w.built_on())],
        "normalize": [
            normalize_checks(w.orders(), w.line_items(), w.sales_reps(), expected_counts(spark, sf_dir), months_between(*EXPECTED_MONTHS)),
            schema_rows(spark, "normalize", footers, typed),
        ],
        "products": [
            product_checks(w.products(), xml, table(spark, sf_dir, "part")),
            schema_rows(spark, "products", footers, {"products": PRODUCTS_SCHEMA}),
        ],
        "stream": [stream_checks(w.order_stream().batch_commits(), reconciled, file_inventory(spark, {"stream": paths["stream"]}))],
        "questions": [question_checks(q1, expected_orders_per_state(spark, sf_dir), q2, q3)],
    }

    def write(name: str, parts: list[DataFrame]) -> None:
        rows = parts[0].select(*COLUMNS)
        for p in parts[1:]:
            rows = rows.unionByName(p.select(*COLUMNS))
        rows.coalesce(1).write.mode("overwrite").parquet(f"{folder}/stage={name}")

    run_concurrently(*[lambda n=n, p=p: write(n, p) for n, p in stages.items()])


def read_results(spark: SparkSession, folder: str) -> DataFrame:
    """Persisted check rows (at most some tens)."""
    return spark.read.schema(dq.RESULT_SCHEMA).parquet(folder).select(*COLUMNS)
