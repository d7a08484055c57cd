"""Plan properties the design relies on at scale."""

import datetime as dt

from pyspark.sql import functions as F

from ordertide.operators.dedupe import dedupe_earliest
from ordertide.plans import catalogue as C
from ordertide.plans import questions


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_dedupe_is_combined_before_the_shuffle(spark):
    # One key holds a third of all rows.
    n = 3000
    rows = [("hot" if i % 3 == 0 else f"k{i}", dt.datetime(2020, 1, 1) + dt.timedelta(seconds=i), f"f{i % 5}", i % 7 == 0)
            for i in range(n)]
    df = spark.createDataFrame(rows, "k string, ingested_at timestamp, ingest_file_name string, flag boolean")
    out = dedupe_earliest(df.repartition(8), ["k"], any_true=["flag"])
    plan = _plan(out)
    # bool_or is planned as max; both run partially before the exchange
    assert "partial_min" in plan and "partial_max" in plan
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    hot = out.filter(F.col("k") == "hot").first()
    assert hot.ingested_at == dt.datetime(2020, 1, 1) and hot.ingest_file_name == "f0" and hot.flag is True
    assert out.count() == 1 + (n - n // 3)


def test_profit_is_pre_aggregated_per_order(spark, sf_dir):
    w = C.ws(spark, sf_dir)
    q = questions.profit_by_rep(w.line_items(), w.products(), w.orders(), w.sales_reps())
    plan = _plan(q)
    # per-order partial sum below the join with orders, then per-rep sum
    assert plan.count("partial_sum") >= 2


def test_question_filters_reach_the_scans(spark, sf_dir):
    q = C.price_stats(spark, sf_dir)
    plan = _plan(q)
    assert "EqualTo(color,red)" in plan
    assert f"EqualTo(shipping_address_state,{C.Q2_STATE})" in plan
    assert "EqualTo(_error_ssn_format,true)" in plan


def test_month_filter_prunes_partitions(spark, sf_dir):
    plan = _plan(C.month_pruned_scan(spark, sf_dir))
    assert "PartitionFilters: [isnotnull(submitted_yyyy_mm" in plan
    assert "ReadSchema: struct<order_id:string,customer_id:string,shipping_address_state:string>" in plan


def test_no_cartesian_products_in_registered_queries(spark, sf_dir):
    for name in ("stream_reconcile", "dq_partitions", "dq_result_diff", "dq_final_gate"):
        plan = _plan(C.QUERIES[name](spark, sf_dir))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
