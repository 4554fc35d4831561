"""Counts over splits and tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from corpusloom.functions.text import is_blank

QUANTILES = (0.5, 0.9, 0.99)


def split_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows per split: all, kept and dropped as blank, in one pass."""
    blank = is_blank(F.col(text))
    return df.groupBy("split").agg(
        F.count("*").alias("n_raw"), F.count_if(~blank).alias("n_kept"),
        F.count_if(blank).alias("n_dropped"))


def token_stats(df: DataFrame, max_len: int = 256, ids: str = "ids",
                quantiles: tuple[float, ...] = QUANTILES, size=None) -> DataFrame:
    """Lengths per split: rows, cut rows, tokens before and after the cut, exact quantiles.

    Rows become a histogram of lengths on the map side, so what is ordered and summed up per split
    is one row per distinct length. ``size`` is an expression for the length when the ids themselves
    are not needed.
    """
    size = (F.size(ids) if size is None else size).cast("bigint")
    lengths = df.select("split", size.alias("_n")).groupBy("split", "_n").agg(
        F.count("*").alias("_rows"))
    n, rows = F.col("_n"), F.col("_rows")
    upto = F.sum("_rows").over(
        Window.partitionBy("split").orderBy("_n").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("_rows").over(Window.partitionBy("split"))
    placed = lengths.withColumns({"_upto": upto, "_total": total})
    return placed.groupBy("split").agg(
        F.sum(rows).alias("n_rows"),
        F.sum(F.when(n > max_len, rows).otherwise(0)).alias("n_truncated"),
        F.sum(n * rows).alias("n_tokens"),
        F.sum(F.least(n, F.lit(max_len)) * rows).alias("n_tokens_kept"),
        F.max(n).alias("longest"),
        *[F.min(F.when(F.col("_upto") >= F.ceil(F.col("_total") * F.lit(q)), n)).alias(
            f"p{round(q * 100)}") for q in quantiles])
