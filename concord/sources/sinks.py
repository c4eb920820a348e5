"""Result tables to files and catalog tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Overwrite a Parquet table; a partition column is balanced before writing.

    The rebalance hint lets adaptive execution split a very large partition value over
    several files and merge small ones.
    """
    if partition_by:
        df.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: str, values: Iterable[str]) -> None:
    """Replace the partitions of the given values by the rows, which have no other; all others stay.

    Partitions that get rows are overwritten by the writer, those that get none are removed after it.
    """
    df.hint("rebalance", partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        partition_by
    ).parquet(path)
    spark = df.sparkSession
    written = {r[0] for r in df.select(F.col(partition_by).cast("string")).distinct().collect()}
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for value in values:
        if value not in written:
            gone = jvm.org.apache.hadoop.fs.Path(f"{path}/{partition_by}={value}")
            gone.getFileSystem(conf).delete(gone, True)


def save_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, path: str | None = None) -> DataFrame:
    """Replace a catalog table, bucketed and sorted by keys: joins on all of them need no exchange."""
    writer = df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite a CSV table with a header; quotes are doubled as in RFC 4180."""
    df.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)


def write_tables(tables: dict[str, DataFrame], folder: str, write=write_csv) -> None:
    """One table per name under a folder."""
    for name, df in tables.items():
        write(df, f"{folder}/{name}")


def save_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a catalog table by the rows."""
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def write_if_any(df: DataFrame, path: str) -> bool:
    """Write a diagnostics table only when it has rows; tells whether it did."""
    if df.isEmpty():
        return False
    write_csv(df, path)
    return True


def with_percent(df: DataFrame, columns=("Matching Rate", "Last Month MR")) -> DataFrame:
    """Rates as percent text with two decimals."""
    return df.withColumns(
        {c: F.format_string("%.2f%%", F.col(f"`{c}`") * 100) for c in columns if c in df.columns}
    )


def write_report(report: DataFrame, path: str) -> None:
    """The wide report as a table, rates shown as percent."""
    write_csv(with_percent(report), path)
