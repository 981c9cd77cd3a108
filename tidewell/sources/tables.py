"""Tables: the batch sources of the lakehouse and its sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name_or_path: str, fmt: str | None = None) -> DataFrame:
    """A catalog table, or files when a format is given."""
    return spark.read.format(fmt).load(name_or_path) if fmt else spark.table(name_or_path)


def overwrite_table(df: DataFrame, name: str) -> None:
    """Rebuild a table: written beside the one there is, which stays readable until both change names.

    `df` may read the table itself.
    """
    spark = df.sparkSession
    beside, before = f"{name}__next", f"{name}__before"
    for left_over in (beside, before):
        spark.sql(f"DROP TABLE IF EXISTS {left_over}")
    df.write.saveAsTable(beside)
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} RENAME TO {before}")
    spark.sql(f"ALTER TABLE {beside} RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {before}")


def overwrite_path(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Rebuild a parquet folder, or with `partition_by` those of its partitions that `df` has rows of.

    Rows of one day first meet in few tasks, or every task would write a small file per day. AQE splits a day that
    is too large for one task. Other days stay as they are.
    """
    if partition_by:
        writer = df.hint("rebalance", partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
