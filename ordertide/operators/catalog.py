"""Catalog operations (K4, K5, K8-K12): databases, tables, views, cache.

Tables are Parquet, registered in the session catalog: ``save_table`` writes
to an explicit location on shared storage, ``save_managed`` into the session's
warehouse folder.  ``insert_by_name`` adds to either, checked by Spark's own
store assignment; ``partition_values`` reads the catalog, not the data.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.operators.versioned import SchemaMismatch


def use_database(spark: SparkSession, name: str) -> str:
    """Create the database if needed and make it current."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    spark.catalog.setCurrentDatabase(name)
    return spark.catalog.currentDatabase()


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table if it exists (K11); files of an external table stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def save_table(
    df: DataFrame, name: str, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Overwrite (or append to) a catalog table stored at ``path`` (K4/K5).

    With ``partition_by`` the rows are first rebalanced on the partition
    columns, so every partition value gets a few well-sized files.
    """
    writer_df = df.hint("rebalance", *partition_by) if partition_by else df
    writer = writer_df.write.mode(mode).format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def save_managed(df: DataFrame, name: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Overwrite (or append to) a managed table (K4/K5): its files live in the
    session's warehouse folder and go when it is dropped."""
    writer = (df.hint("rebalance", *partition_by) if partition_by else df).write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


@contextmanager
def _options(spark: SparkSession, options: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k) for k in options}
    try:
        for k, v in options.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def insert_by_name(df: DataFrame, name: str, overwrite_partitions: bool = False) -> None:
    """Insert into an existing table (K3/K6), columns aligned by name.

    ``insertInto`` goes by position, so the columns are put into the table's
    order first; other names are refused here.  Types are Spark's to check:
    strict store assignment refuses a column that could lose values.  With
    ``overwrite_partitions`` the partitions that ``df`` holds are replaced and
    all others stay (dynamic overwrite).
    """
    spark = df.sparkSession
    columns = spark.table(name).columns
    if sorted(columns) != sorted(df.columns):
        raise SchemaMismatch(f"{name}: columns {df.columns}, the table has {columns}")
    options = {"spark.sql.storeAssignmentPolicy": "STRICT", "spark.sql.sources.partitionOverwriteMode": "dynamic"}
    with _options(spark, options):
        df.select(*columns).write.insertInto(name, overwrite=overwrite_partitions)


def partition_values(spark: SparkSession, name: str, column: str) -> DataFrame:
    """The values of a partition column that the catalog lists: no data is
    read.  Values come as text; the catalog escapes some characters."""
    spec = F.regexp_extract("partition", rf"(?:^|/){column}=([^/]*)", 1)
    listed = spark.sql(f"SHOW PARTITIONS {name}").select(F.url_decode(F.replace(spec, F.lit("+"), F.lit("%2B"))).alias(column))
    return listed.distinct()


def cache_view(spark: SparkSession, df: DataFrame, name: str) -> None:
    """Register a temporary view and cache it (K8/K9); filled lazily by the
    first action, spilling to disk when it does not fit in memory."""
    df.createOrReplaceTempView(name)
    spark.catalog.cacheTable(name)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """``SHOW TABLES`` as a DataFrame."""
    return spark.sql(f"SHOW TABLES IN `{database}`" if database else "SHOW TABLES")


def describe(spark: SparkSession, name: str) -> DataFrame:
    """``DESCRIBE TABLE`` as a DataFrame."""
    return spark.sql(f"DESCRIBE TABLE {name}")
