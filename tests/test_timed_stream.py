"""Throttled, timed runs; stored progress; rejected documents."""

import pytest
from pyspark.sql import functions as F

from ordertide.operators.versioned import VersionedTable
from ordertide.plans import managed, questions, questions_sql
from ordertide.plans.workspace import Workspace
from ordertide.streaming.orders import OrderStream, StreamTimeout
from ordertide.streaming.progress import ProgressLog, trigger_check, triggers


@pytest.fixture
def stream(spark, sf_dir, tmp_path):
    """A stream over five files, two at a time, with a broken line in one."""
    ws = Workspace.get(spark, sf_dir)
    source = str(tmp_path / "docs")
    spark.read.text(ws.raw_paths()["stream"]).repartition(5).write.text(source)
    spark.createDataFrame([("{broken",)], "value string").coalesce(1).write.mode("append").text(source)
    tables = [VersionedTable(spark, str(tmp_path / n), n) for n in ("orders", "items", "rejects")]
    log = ProgressLog(spark, str(tmp_path / "progress"), "timed")
    yield OrderStream(spark, source, tables[0], tables[1], str(tmp_path / "ck"), "timed", max_files_per_trigger=2, rejects=tables[2], progress=log)
    log.close()


def test_drained_run_and_stored_progress(spark, stream):
    lines = spark.read.text(stream.source_path).count()
    query = stream.run_drained(interval="100 milliseconds", timeout_s=300)
    assert not query.isActive
    assert stream.orders.read().count() == lines - 1
    assert [r.text for r in stream.rejects.read().collect()] == ["{broken"]
    stored = stream.progress.read()
    found = triggers(stored).orderBy("batch_id").collect()
    assert [r.batch_id for r in found] == [0, 1, 2] and sum(r.input_rows for r in found) == lines
    events = {r.event: r.n for r in stored.groupBy("event").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert events["started"] == 1 and events["ended"] == 1
    ok = trigger_check(stored, 3, 100, most_rows=lines).first()
    assert ok.in_bounds and ok.over_throttle == 0
    assert not trigger_check(stored, 4, 100).first().in_bounds and not trigger_check(stored, 1, 3).first().in_bounds
    assert trigger_check(stored, 1, 100, most_rows=1).first().over_throttle == 3
    # The stored ids are the query's; a restart finds nothing, and is logged as well.
    assert {r.query_id for r in stored.select("query_id").distinct().collect()} == {str(query.id)}
    stream.run_drained(interval="100 milliseconds")
    assert stream.orders.read().count() == lines - 1
    assert stream.progress.read().filter("event = 'ended'").count() == 2


def test_a_late_run_raises_and_the_next_goes_on(spark, stream):
    lines = spark.read.text(stream.source_path).count()
    with pytest.raises(StreamTimeout):
        stream.run_drained(interval="30 seconds", timeout_s=3)
    stream.run_available()
    assert stream.orders.read().select("order_id").distinct().count() == stream.orders.read().count() == lines - 1


def test_progress_keeps_a_failure(spark, sf_dir, tmp_path, stream, monkeypatch):
    def fail(self, batch, batch_id):
        raise RuntimeError("sink is down")

    monkeypatch.setattr(OrderStream, "_process", fail)
    with pytest.raises(Exception):
        stream.run_available()
    ended = stream.progress.read().filter("event = 'ended'").collect()
    assert len(ended) == 1 and "sink is down" in ended[0].error


def test_counts_while_the_first_commit_is_written(spark, tmp_path):
    """A reader that looks between the data and the commit sees no table yet."""
    t = VersionedTable(spark, str(tmp_path / "t"), "t")
    other = VersionedTable(spark, str(tmp_path / "t"), "t")
    seen = []
    record = t._record

    def watched(*a):
        seen.append(other.commit_counts().collect())
        return record(*a)

    t._record = watched
    assert t.commit_counts().collect() == []
    t.commit(spark.range(3), "append", "a")
    assert seen == [[]] and t.read().count() == 3
    empty = VersionedTable(spark, str(tmp_path / "e"), "e", partition_by=["p"])
    empty.commit(spark.createDataFrame([], "v int, p string"), "append", "none")
    assert empty.read().collect() == []


def test_months_come_from_the_catalog_without_a_scan(spark):
    from ordertide.operators import catalog

    with managed.scratch_database(spark) as db:
        df = spark.createDataFrame([(1, "2020-01"), (2, "2020-02"), (3, "a b/+%=é")], "id int, m string")
        catalog.save_managed(df, f"`{db}`.t", ["m"])
        months = catalog.partition_values(spark, f"`{db}`.t", "m")
        assert sorted(r.m for r in months.collect()) == sorted(["2020-01", "2020-02", "a b/+%=é"])
        plan = months._jdf.queryExecution().executedPlan().toString()
        assert "FileScan" not in plan and "Scan parquet" not in plan


def test_sql_views_equal_the_dataframe_form(spark, sf_dir):
    w = Workspace.get(spark, sf_dir)
    tables = {"orders": w.orders(), "line_items": w.line_items(), "sales_reps": w.sales_reps(), "products": w.products()}
    args = (tables["line_items"], tables["products"], tables["orders"], tables["sales_reps"])
    with questions_sql.question_views(spark, tables, "t1_") as p:
        got = questions_sql.price_stats(spark, p, "red", "AA"), questions_sql.top_reps(spark, p, 3), questions_sql.orders_per_state(spark, p)
        quoted = questions_sql.price_stats(spark, p, "red' OR '1'='1", "AA")
    want = questions.price_stats(*args, "red", "AA"), questions.top_rep_by_profit(questions.profit_by_rep(*args), 3), questions.orders_per_state(tables["orders"])
    for a, b in zip(got, want):
        assert [tuple(r) for r in a.collect()] == [tuple(r) for r in b.collect()]
    assert quoted.first().avg_price is None
    assert not spark.catalog.tableExists("t1_rep_lines") and not spark.catalog.tableExists("t1_orders")
