import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from ordertide.operators import quality as dq
from ordertide.operators.dedupe import dedupe_earliest


def test_dedupe_keeps_earliest_and_ors_flags(spark):
    t0, t1 = dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2)
    df = spark.createDataFrame(
        [("a", None, t1, "f2", True), ("a", None, t0, "f1", False), ("b", 1, t0, "f1", False)],
        "k string, k2 int, ingested_at timestamp, ingest_file_name string, flag boolean",
    )
    out = {r.k: r for r in dedupe_earliest(df, ["k", "k2"], any_true=["flag"]).collect()}
    assert out["a"].ingest_file_name == "f1" and out["a"].flag is True and out["a"].k2 is None
    assert out["b"].flag is False


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.sampled_from(["x", "y", "z"]), st.booleans()),
             min_size=1, max_size=30),
    st.integers(1, 7),
)
def test_dedupe_independent_of_partitioning(spark, rows, parts):
    df = spark.createDataFrame(
        [(k, dt.datetime(2020, 1, 1 + t), f, b) for k, t, f, b in rows],
        "k int, ingested_at timestamp, ingest_file_name string, flag boolean",
    )
    a = sorted(map(tuple, dedupe_earliest(df, ["k"], any_true=["flag"]).collect()))
    b = sorted(map(tuple, dedupe_earliest(df.repartition(parts), ["k"], any_true=["flag"]).collect()))
    assert a == b


def test_string_hygiene_counts_each_rule(spark):
    df = spark.createDataFrame([(" a", "x"), ("", "null"), (None, "y "), ("ok", " ")], "a string, b string")
    out = {r.column_name: (r.untrimmed, r.blank, r.null_literal) for r in dq.string_hygiene(df).collect()}
    assert out == {"a": (1, 1, 0), "b": (2, 1, 1)}


def test_null_profile_and_lengths(spark):
    df = spark.createDataFrame([("12", None), ("1", "x"), (None, "y")], "a string, b string")
    nulls = {r.column_name: r.nulls for r in dq.null_profile(df).collect()}
    assert nulls == {"a": 1, "b": 1}
    lv = dq.length_violations(df, {"a": [2]}).first()
    assert (lv.violations, lv.checked) == (1, 2)


def test_cast_failures(spark):
    df = spark.createDataFrame([("1", "1.5"), ("x", "2"), (None, "abc")], "a string, b string")
    out = {r.column_name: r.failures for r in dq.cast_failures(df, {"a": "int", "b": "decimal(10,2)"}).collect()}
    assert out == {"a": 1, "b": 1}


def test_multiset_diff_counts_multiplicity(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "n int, s string")
    right = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "n int, s string")
    out = sorted(map(tuple, dq.multiset_diff(left, right).collect()))
    assert out == [(1, "a", 2, 1), (3, "c", 0, 1)]
    assert dq.multiset_diff(left, left).count() == 0


def test_missing_months(spark):
    df = spark.createDataFrame([("2019-11",), ("2020-02",), ("2020-02",)], "submitted_yyyy_mm string")
    assert sorted(r.month for r in dq.missing_months(df).collect()) == ["2019-12", "2020-01"]


def test_reconcile_and_rollup(spark):
    a = spark.range(3)
    expected = spark.createDataFrame([("t", 3), ("u", 1)], "table_name string, expected bigint")
    out = {r.table_name: r.ok for r in dq.reconcile_counts({"t": a}, expected).collect()}
    assert out == {"t": True, "u": False}
    results = spark.createDataFrame(
        [("s1", "c1", "passed", 0, 1), ("s1", "c2", "failed", 2, 5), ("s2", "c1", "passed", 0, 1)], dq.RESULT_SCHEMA
    )
    roll = {r.suite: (r.passed, r.checks, r.all_passed) for r in dq.stage_rollup(results).collect()}
    assert roll == {"s1": (1, 2, False), "s2": (1, 1, True)}
    gate = dq.final_gate(results, ["s2", "s3"]).first()
    assert (gate.stages, gate.stages_passed, gate.passed) == (2, 1, False)


def test_schema_check_ignores_nullability_and_order(spark):
    from pyspark.sql import types as T

    a = T.StructType([T.StructField("x", T.IntegerType(), False), T.StructField("y", T.StringType())])
    b = T.StructType([T.StructField("y", T.StringType()), T.StructField("x", T.IntegerType(), True)])
    assert dq.schema_check(spark, a, b).count() == 0
    assert dq.schema_check(spark, a, b, keep_order=True).count() == 2
    c = T.StructType([T.StructField("x", T.LongType()), T.StructField("z", T.StringType())])
    assert sorted(r.column_name for r in dq.schema_check(spark, a, c).collect()) == ["x", "y", "z"]


def test_month_coverage_one_scan(spark):
    df = spark.createDataFrame([("2019-11",), ("2020-02",), ("2020-02",)], "submitted_yyyy_mm string")
    r = dq.month_coverage(df).first()
    assert (r.present_months, r.missing_months) == (2, 2)


def test_dedupe_keeps_every_key(spark):
    """Rows without a time or a file name, and times before 1970."""
    t = dt.datetime(2020, 1, 1)
    rows = [
        ("plain", t, "f1"),
        ("no time", None, "f2"),
        ("no file", t, None),
        ("neither", None, None),
        ("1960", dt.datetime(1960, 5, 4, 3, 2, 1, 7), "f1"),
        ("1960", dt.datetime(1960, 5, 4, 3, 2, 1, 7), "f0"),
        ("late null", None, "f0"),
        ("late null", t, "f9"),
        ("tie", t, None),
        ("tie", t, "f5"),
        (None, t, "f1"),
    ]
    df = spark.createDataFrame(rows, "k string, ingested_at timestamp, ingest_file_name string")
    got = {r.k: (r.ingested_at, r.ingest_file_name) for r in dedupe_earliest(df, ["k"]).collect()}
    assert got == {
        "plain": (t, "f1"),
        "no time": (None, "f2"),
        "no file": (t, None),
        "neither": (None, None),
        "1960": (dt.datetime(1960, 5, 4, 3, 2, 1, 7), "f0"),
        "late null": (t, "f9"),
        "tie": (t, "f5"),
        None: (t, "f1"),
    }


def test_positions_and_ends(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v")).repartition(9).orderBy("v")
    got = dq.numbered(df).collect()
    assert sorted((r.position, r.v) for r in got) == [(i, i) for i in range(1000)]
    assert dq.position_diff(df, spark.range(1000).toDF("v").orderBy("v")).count() == 0
    shorter = spark.range(998).select(F.when(F.col("id") == 3, 4).when(F.col("id") == 4, 3).otherwise(F.col("id")).alias("v"))
    found = dq.position_diff(df, shorter.coalesce(1)).orderBy("position").collect()
    assert [(r.position, r.left.v, r.right.v if r.right else None) for r in found] == [(3, 3, 4), (4, 4, 3), (998, 998, None), (999, 999, None)]
    assert sorted(r.v for r in dq.first_and_last(df).collect()) == [0, 999]
    assert dq.first_and_last(df.limit(1)).count() == 1 and dq.numbered(df.limit(0)).count() == 0


def test_rows_are_not_shuffled_by_their_few_files(spark):
    """Whatever the size of the rows, the numbered files are broadcast."""
    rows = [(str(k % 7), dt.datetime(2020, 1, 1 + k % 3), f"f{k % 4}" if k % 5 else None) for k in range(200)]
    df = spark.createDataFrame(rows, "k string, ingested_at timestamp, ingest_file_name string")
    want = sorted(map(tuple, dedupe_earliest(df, ["k"]).collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = dedupe_earliest(df, ["k"])
        assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, out.collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_string_hygiene_keeps_a_row_one_row(spark):
    """More columns than a mask holds, with groups, a null one too."""
    values = ["", "  ", "null", " NULL ", " a", "a", None, "b "]
    columns = [f"c{i}" for i in range(50)]
    rows = [("g" if k % 3 else None, *[values[(k * (i + 1) + i) % 8] for i in range(50)]) for k in range(40)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ["g", *columns]))
    found = dq.string_hygiene(df, columns, by=["g"])
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.columns == ["g", "column_name", "untrimmed", "blank", "null_literal"]
    want = {}
    for g, *row in rows:
        for c, v in zip(columns, row):
            n = want.setdefault((g, c), [0, 0, 0])
            if v is not None:
                t = v.strip(" ")
                n[0], n[1], n[2] = n[0] + (v != t), n[1] + (t == ""), n[2] + (t.lower() == "null")
    assert {(r[0], r[1]): list(r[2:]) for r in found.collect()} == want
    assert dq.string_hygiene(df.limit(0), columns, by=["g"]).collect() == []


def test_splits_are_bounded_unless_the_caller_set_them(spark):
    from ordertide.session import configure

    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        assert configure(spark).conf.get(key) == "32m"
        spark.conf.set(key, "77m")
        assert configure(spark).conf.get(key) == "77m"
    finally:
        spark.conf.set(key, before)
