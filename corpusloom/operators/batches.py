"""Batches, padding and accumulation groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from corpusloom.operators.order import check_keys
from corpusloom.operators.splits import shuffle_epochs

# Fixed value: labels that a loss leaves out.
IGNORED_LABEL = -100


def assign_batches(df: DataFrame, batch_size: int = 1, epochs: int = 2, seed: int = 42,
                   key: str = "row_id", ids: str = "input_ids") -> DataFrame:
    """Shuffle per epoch and number the batches; the last one of an epoch may be short.

    Only keys and lengths are ranked; the rows themselves move once, to meet their places, however
    many epochs there are. Where rows have ``ids``, ``longest`` is the greatest length in the batch.
    Keys must be unique, else it raises.
    """
    check_keys(df, key)
    sized = [F.size(ids).alias("_size")] if ids in df.columns else []
    placed = shuffle_epochs(df.select(key, *sized), epochs, seed, key)
    placed = placed.withColumn(
        "batch_id", F.floor(F.col("pos") / batch_size).cast("bigint")).withColumn(
        "slot", (F.col("pos") % batch_size).cast("int")).drop("pos")
    if sized:
        placed = placed.withColumn("longest", F.max("_size").over(
            Window.partitionBy("epoch", "batch_id"))).drop("_size")
    return placed if df.columns == [key] else df.join(placed, key)


def accumulation_groups(df: DataFrame, accum: int = 8) -> DataFrame:
    """The optimizer step of every batch, numbered within the epoch."""
    return df.withColumn("step", F.floor(F.col("batch_id") / accum).cast("bigint"))


def default_pad_id(vocab_rows: int, eos_id: int | None) -> int:
    """Padding uses the end marker; a vocabulary without one gets a new id."""
    return vocab_rows if eos_id is None else eos_id


def pad_batches(df: DataFrame, pad_id: int, side: str = "right", clean: bool = False) -> DataFrame:
    """Pad ids to the longest row of the batch, masks with 0 and labels with -100.

    Every label equal to ``pad_id`` becomes -100, so an end marker that doubles as padding is left
    out too; ``clean=True`` leaves out padding only. A projection where the rows have ``longest``
    (see :func:`assign_batches`); else it is found per batch, which moves the rows.
    """
    if side not in ("right", "left"):
        raise ValueError("side must be 'right' or 'left'")
    longest = F.col("longest") if "longest" in df.columns else F.max(F.size("input_ids")).over(
        Window.partitionBy("epoch", "batch_id"))
    missing = F.col("_longest") - F.size("input_ids")

    def padded(c, value):
        fill = F.array_repeat(F.lit(value).cast("int"), missing)
        return F.concat(fill, c) if side == "left" else F.concat(c, fill)

    labels = F.col("labels")
    if not clean:
        labels = F.transform(
            labels, lambda i: F.when(i == pad_id, F.lit(IGNORED_LABEL)).otherwise(i))
    return (
        df.withColumn("_longest", longest)
        .withColumns({
            "labels": padded(labels, IGNORED_LABEL),
            "attention_mask": padded(F.col("attention_mask"), 0),
            "input_ids": padded(F.col("input_ids"), pad_id),
        })
        .drop("_longest", "longest")
    )


def pad_report(df: DataFrame, accum: int = 8, ids: str = "input_ids") -> DataFrame:
    """Real and padded tokens per step, from the lengths of not yet padded rows."""
    df = df.drop("longest")
    per_batch = df.groupBy("epoch", "batch_id").agg(
        F.count("*").alias("_rows"), F.sum(F.size(ids).cast("bigint")).alias("_real"),
        F.max(F.size(ids)).cast("bigint").alias("_longest"))
    return accumulation_groups(per_batch, accum).groupBy("epoch", "step").agg(
        F.sum("_rows").alias("n_rows"), F.sum("_real").alias("real_tokens"),
        F.sum(F.col("_rows") * F.col("_longest") - F.col("_real")).alias("pad_tokens"))
