"""Writing results. Parquet tables are published as snapshots, see :mod:`sievewright.sources.snapshots`."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession

from sievewright.sources import snapshots


def write_parquet(
    df: DataFrame, root: str, dataset_id: str | None = None, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write a table once and publish it under ``root``; with an id it lies in ``<root>/archive/<id>``.

    Returns the written copy. ``readers.read_table`` reads what is published.
    """
    return snapshots.write(df, root, partition_by, dataset_id)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_report(
    report: DataFrame, path: str, partition_by: Sequence[str] = (), replaced: Collection[object] | None = None
) -> None:
    """A report as JSON lines, null fields included.

    With ``replaced`` values of its only partition column, those partitions make
    room for the ones it has, and the others stay.
    """
    writer = report.write.mode("overwrite").option("ignoreNullFields", False).partitionBy(*partition_by)
    if replaced is not None:
        drop_report_parts(report.sparkSession, path, partition_by[0], replaced)
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.json(path)


def drop_report_parts(spark: SparkSession, path: str, column: str, values: Collection[object]) -> None:
    for value in values:
        files, folder = snapshots.file_system(spark, f"{path}/{snapshots.part_folder(spark, column, value)}")
        files.delete(folder, True)
