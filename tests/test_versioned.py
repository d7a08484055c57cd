import pytest
from pyspark.sql import functions as F

from ordertide.operators.versioned import SchemaMismatch, VersionedTable


def _df(spark, ids, month="2020-01"):
    return spark.createDataFrame([(i, month) for i in ids], "id bigint, m string")


def test_versions_as_of_and_restore(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), "t", partition_by=["m"])
    assert t.commit(_df(spark, [1, 2]), "overwrite") == 0
    assert t.commit(_df(spark, [3], "2020-02"), "append") == 1
    assert t.commit(_df(spark, [9]), "overwrite") == 2
    ids = lambda v=None: sorted(r.id for r in t.read(v).collect())
    assert ids(0) == [1, 2] and ids(1) == [1, 2, 3] and ids() == [9]
    before = ids(1)
    assert t.restore(1) == 3
    assert ids() == before  # restore then read equals the earlier read
    assert ids(2) == [9]  # history is kept
    hist = [(r.version, r.op) for r in t.history().collect()]
    assert hist == [(3, "RESTORE"), (2, "OVERWRITE"), (1, "APPEND"), (0, "OVERWRITE")]
    assert t.history().filter(F.col("version") == 1).first().rows == 1


def test_replayed_commit_is_exactly_once(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), "t")
    t.commit(_df(spark, [1]), "overwrite", "base")
    v1 = t.commit(_df(spark, [2, 3]), "append", "q-b0")
    v2 = t.commit(_df(spark, [2, 3]), "append", "q-b0")
    assert v1 == v2 == 1
    assert t.read().count() == 3 and t.current_version() == 1


def test_schema_enforced_append(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), "t")
    t.commit(_df(spark, [1]), "overwrite")
    with pytest.raises(SchemaMismatch):
        t.append_conforming(_df(spark, [2]).withColumn("id", F.col("id").cast("string")))
    with pytest.raises(SchemaMismatch):
        t.append_conforming(_df(spark, [2]).withColumn("extra", F.lit(1)))
    t.append_conforming(_df(spark, [2]).select("m", "id"))  # aligned by name
    assert sorted(r.id for r in t.read().collect()) == [1, 2]


def test_unknown_version_is_refused(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), "t")
    t.commit(_df(spark, [1]), "overwrite")
    with pytest.raises(ValueError):
        t.read(5)


def test_partition_pruning_on_commit(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), "t", partition_by=["m"])
    t.commit(_df(spark, [1]), "overwrite")
    plan = t.read().filter(F.col("m") == "2020-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_commit" in plan


def test_replay_after_an_empty_run_is_visible(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), "t")
    t.commit(_df(spark, [1, 2]), "overwrite", "base")
    t.commit(_df(spark, []), "append", "q-b0")
    assert t.read().count() == 2
    t.commit(_df(spark, [3, 4]), "append", "q-b0")
    assert sorted(r.id for r in t.read().collect()) == [1, 2, 3, 4]
    assert {r.commit_id: r.rows for r in t.history().collect()} == {"base": 2, "q-b0": 2}


def test_a_new_instance_reads_the_same_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    t = VersionedTable(spark, path, "t")
    for k in range(3):
        t.commit(_df(spark, [k]), "append")
    t.restore(1)
    again = VersionedTable(spark, path, "t")
    assert again.current_version() == 3 and again.live_commits() == t.live_commits()
    assert sorted(r.id for r in again.read().collect()) == [0, 1]


def test_written_schema_comes_from_the_files(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), "t")
    t.commit(_df(spark, [1]), "overwrite")
    assert t.written_schema().simpleString() == "struct<id:bigint,m:string>"
    _df(spark, [2]).withColumn("drift", F.lit(1)).write.parquet(f"{t.data_path}/_commit=other")
    assert "drift" in t.written_schema().names
