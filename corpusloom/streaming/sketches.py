"""Lengths and different words of a stream, as sketches of each trigger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.operators.counts import QUANTILES
from corpusloom.operators.sketches import (
    BITS, LG_K, distinct_sketch, length_sketch, n_words, sketch_stats, word_rows,
)
from corpusloom.sources.folders import is_whole, trigger_name, whole_triggers


def write_sketch_stream(df: DataFrame, path: str, checkpoint: str, text: str = "text",
                        by: tuple[str, ...] = ("split",), eos: str | None = None,
                        bits: int = BITS, lg_k: int = LG_K, wait: bool = True):
    """Sketch what arrives, for :func:`read_sketch_stream`; the texts themselves are not kept.

    A trigger writes its own sketches, so one that comes again changes nothing.
    """
    def add(batch: DataFrame, batch_id: int) -> None:
        name = trigger_name(batch_id)
        if is_whole(batch.sparkSession, f"{path}/distinct/{name}"):
            return
        length_sketch(batch, n_words(F.col(text), eos), by, bits).coalesce(1).write.mode(
            "overwrite").parquet(f"{path}/lengths/{name}")
        distinct_sketch(word_rows(batch, text, by, eos), F.col("token"), by, lg_k).coalesce(
            1).write.mode("overwrite").parquet(f"{path}/distinct/{name}")

    query = df.writeStream.foreachBatch(add).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if wait:
        query.awaitTermination()
    return query


def read_sketch_stream(spark: SparkSession, path: str, by: tuple[str, ...] = ("split",),
                       bits: int = BITS, quantiles: tuple[float, ...] = QUANTILES) -> DataFrame:
    """The statistics of all whole triggers (:func:`sketch_stats`). ``by`` may be fewer columns than
    were written, and ``bits`` must be as written."""
    done = whole_triggers(spark, f"{path}/distinct")
    if not done:
        raise FileNotFoundError(f"no sketches in {path} yet")
    lengths, distinct = (spark.read.parquet(*[f"{path}/{kind}/{name}" for name in done])
                         for kind in ("lengths", "distinct"))
    return sketch_stats(lengths, distinct, by, bits, quantiles)
