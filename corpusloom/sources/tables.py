"""Named tables with splits, and the written examples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.sources.files import read_files


def catalog_path(root: str, name: str, config: str | None = None) -> str:
    return "/".join([root.rstrip("/"), name, *([config] if config else [])])


def read_catalog(spark: SparkSession, root: str, name: str, config: str | None = None,
                 split: str | None = None) -> DataFrame:
    """The table under ``root/name/config``, its splits in folders ``split=<name>``.

    Asking for one split reads its folder only. A folder without splits is one training split.
    """
    df = spark.read.parquet(catalog_path(root, name, config))
    if "split" not in df.columns:
        return df.withColumn("split", F.lit("train"))
    df = df.withColumn("split", F.col("split").cast("string"))
    return df if split is None else df.where(F.col("split") == split)


def write_catalog(df: DataFrame, root: str, name: str, config: str | None = None) -> str:
    path = catalog_path(root, name, config)
    df.write.partitionBy("split").parquet(path)
    return path


def write_examples(df: DataFrame, path: str, key: str = "row_id", mode: str = "error") -> None:
    """Write examples by split, ordered by key inside every file. No shuffle."""
    df.sortWithinPartitions("split", key).write.mode(mode).partitionBy("split").parquet(path)


__all__ = ["catalog_path", "read_catalog", "read_files", "write_catalog", "write_examples"]
