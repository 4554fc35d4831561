"""Holdouts of an exact size on a stream.

How many rows are held out, and so which, changes with every row that arrives. Rows are therefore
written with their hash and get their split when they are read: counts per leading digits of the hash
(at most 65,536 a trigger) tell in which of these ranges the cut lies, and only that one is looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.operators.order import HASH_DIGITS, hash_key
from corpusloom.operators.splits import TRAIN, VALIDATION, as_train, holdout_size
from corpusloom.sources.folders import is_whole, trigger_name, whole_triggers

DIGEST, LEADING = "_digest", "_leading"


def write_holdout_stream(df: DataFrame, path: str, checkpoint: str, seed: int = 42,
                         key: str = "row_id", wait: bool = True):
    """Write what has arrived so that :func:`read_holdout_stream` can split it exactly.

    A trigger writes its rows, then its counts, into folders named by its number. The counts are the
    mark that it is whole: one that was broken off is written anew, a whole one is left as it is. A
    later call with the same checkpoint goes on. Keys must be unique over the whole stream and not
    null, which a stream cannot look up; a null key stays in its split.
    """
    def add(batch: DataFrame, batch_id: int) -> None:
        spark, trigger = batch.sparkSession, trigger_name(batch_id)
        if is_whole(spark, f"{path}/counts/{trigger}"):
            return
        digest = F.when(F.col("split").eqNullSafe(TRAIN) & F.col(key).isNotNull(), hash_key(seed, key))
        # In order of the hash a range of it is a few row groups of a file.
        batch.withColumn(DIGEST, digest).sortWithinPartitions(DIGEST).write.mode(
            "overwrite").parquet(f"{path}/rows/{trigger}")
        spark.read.parquet(f"{path}/rows/{trigger}").where(F.col(DIGEST).isNotNull()).groupBy(
            F.left(DIGEST, F.lit(HASH_DIGITS)).alias(LEADING)).agg(F.count("*").alias("n")).coalesce(
            1).write.mode("overwrite").parquet(f"{path}/counts/{trigger}")

    query = as_train(df).writeStream.foreachBatch(add).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if wait:
        query.awaitTermination()
    return query


def read_holdout_stream(spark: SparkSession, path: str, percent: float = 5.0,
                        key: str = "row_id") -> DataFrame:
    """All rows of whole triggers; of ``train`` exactly the percentage rounded up is ``validation``.

    These are the same rows that ``holdout`` would pick from the table of all rows so far, whatever
    the triggers were.
    """
    whole = whole_triggers(spark, f"{path}/counts")
    if not whole:
        raise FileNotFoundError(f"no rows in {path} yet")
    rows = spark.read.parquet(*[f"{path}/rows/{name}" for name in whole])
    counts = spark.read.parquet(*[f"{path}/counts/{name}" for name in whole]).groupBy(
        LEADING).agg(F.sum("n").alias("n")).orderBy(LEADING).collect()
    left = k = holdout_size(sum(c["n"] for c in counts), percent)
    if k == 0:
        return rows.drop(DIGEST)
    for c in counts:
        if left <= c["n"]:
            break
        left -= c["n"]
    # Text between its own leading digits and those followed by a sign past all digits.
    near = rows.where(F.col(DIGEST).between(c[LEADING], c[LEADING] + "g"))
    last = near.select(DIGEST, key).orderBy(DIGEST, key).offset(left - 1).limit(1).first()
    picked = (F.col(DIGEST) < last[DIGEST]) | (
        (F.col(DIGEST) == last[DIGEST]) & (F.col(key) <= last[key]))
    return rows.withColumn("split", F.when(picked, VALIDATION).otherwise(F.col("split"))).drop(DIGEST)
