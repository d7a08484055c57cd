"""The gate reads persisted results; a missing stage or a defect fails it."""

from pyspark.sql import functions as F

from ordertide.operators import quality as dq
from ordertide.plans import catalogue as C
from ordertide.plans import gate


def test_gate_passes_and_fails_without_a_stage(spark, sf_dir):
    rows = C.check_results(spark, sf_dir)
    assert dq.final_gate(rows, gate.STAGES).first().passed
    for stage in gate.STAGES:
        out = dq.final_gate(rows.filter(F.col("suite") != stage), gate.STAGES).first()
        assert not out.passed and out.stages_passed == len(gate.STAGES) - 1


def test_results_are_read_not_recomputed(spark, sf_dir):
    C.check_results(spark, sf_dir)
    plan = C.dq_final_gate(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_months_between():
    assert gate.months_between("1999-11", "2000-02") == ["1999-11", "1999-12", "2000-01", "2000-02"]
    assert len(gate.months_between(*gate.EXPECTED_MONTHS)) == 80


def test_missing_first_and_last_months_are_found(spark):
    df = spark.createDataFrame([(f"2019-{m:02d}",) for m in range(3, 11)], "submitted_yyyy_mm string")
    assert dq.month_coverage(df).first().missing_months == 0
    assert dq.month_coverage(df, expected=gate.months_between("2019-01", "2019-12")).first().missing_months == 4


def test_order_and_tolerance(spark):
    df = spark.createDataFrame([(k, float(k % 17)) for k in range(200)], "k int, v double").repartition(6)
    assert dq.disorder(df.orderBy("v"), "v").first().out_of_order == 0
    assert dq.disorder(df.orderBy(F.col("v").desc()), "v", ascending=False).first().out_of_order == 0
    assert dq.disorder(df.orderBy("k"), "v").first().out_of_order > 0
    near = df.withColumn("v", F.col("v") + F.when(F.col("k") == 3, 0.5).otherwise(0.001))
    assert [r.k for r in dq.tolerant_diff(df, near, ["k"], 0.01).collect()] == [3]
    assert dq.tolerant_diff(df, near.filter("k > 1"), ["k"], 1.0).count() == 2


def test_trigger_bound_is_a_parameter(spark):
    batches = spark.createDataFrame([(k, 1) for k in range(150)], "batch_id int, order_rows bigint")
    ok = spark.createDataFrame([(True,)], "ok boolean")
    files = spark.createDataFrame([("stream", 150)], "source string, files bigint")

    def status(most):
        rows = gate.stream_checks(batches, ok, files, most).collect()
        return {r.check_id: r.status for r in rows}["trigger_count"]

    assert status(None) == "passed" and status(200) == "passed" and status(100) == "failed"
