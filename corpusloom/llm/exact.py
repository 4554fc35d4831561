"""Exact dedup by a tree-merge of sorted digest runs."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.session import materialize

#: What one text is known by: its digest, its length and a second, unrelated hash. Rows are merged
#: only where all three agree, at every level of the tree.
KEY = ["_sha", "_bytes", "_check"]
#: Bits of ``monotonically_increasing_id`` below the partition number.
RUN_BITS = 33


def normalised(text: Column) -> Column:
    """The text that is compared: A-Z in lower case and nothing else; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def digest_runs(df: DataFrame, number: Column, id_: Column, text: Column) -> DataFrame:
    """Row number, id and key of every row; the number's upper bits are the partition, its run."""
    text = normalised(text)
    return df.select(
        number.alias("_uid"), id_.alias("_id"), F.unhex(F.sha2(text, 256)).alias("_sha"),
        F.octet_length(text).cast("long").alias("_bytes"), F.xxhash64(text).alias("_check"))


def merge_runs(runs: DataFrame, keep: str = "largest", fan_in_bits: int = 3) -> DataFrame:
    """The row that stays and the group's size, for every row of :func:`digest_runs`.

    Upward, each round merges up to ``2**fan_in_bits`` runs into one: sort by key, exchange by
    (parent run, key), sort, and keep the best identifier per key. Downward, the winner returns
    along the same tree. A key has at most one row per run, so a group of any size is at most
    ``2**fan_in_bits`` rows of a merge, and only the rows of few neighbouring partitions meet when
    the winner reaches the rows themselves. Every level is a written table.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    known = F.col("_id").isNotNull()
    if keep == "largest":
        best, pick = F.struct(known.alias("k"), F.col("_id"), F.col("_uid")), F.max
    else:
        best, pick = F.struct((~known).alias("k"), F.col("_id"), F.col("_uid")), F.min
    last = runs.agg(F.max(F.shiftright("_uid", RUN_BITS))).first()[0] or 0
    level = runs.select(F.shiftright("_uid", RUN_BITS).alias("_run"), *KEY,
                        best.alias("_best"), F.lit(1).cast("long").alias("_n"))
    levels = []
    while True:
        last >>= fan_in_bits
        level = materialize(
            level.withColumn("_run", F.shiftright("_run", fan_in_bits)).groupBy("_run", *KEY)
            .agg(pick("_best").alias("_best"), F.sum("_n").alias("_n")), "runs")
        levels.append(level)
        if last == 0:
            break
    down = levels.pop()
    up = F.shiftright("_run", fan_in_bits)
    while levels:
        parent = down.withColumnRenamed("_run", "_up")
        below = levels.pop().select("_run", *KEY, up.alias("_up"))
        down = below.join(parent, ["_up", *KEY]).drop("_up")
    rows = runs.withColumn("_run", F.shiftright("_uid", RUN_BITS + fan_in_bits))
    return rows.join(down, ["_run", *KEY]).select(
        "_uid", "_id", "_sha", F.col("_best._id").alias("keep_id"),
        F.col("_n").alias("group_size"), (F.col("_uid") == F.col("_best._uid")).alias("kept"))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "largest", fan_in_bits: int = 3) -> DataFrame:
    """One row per row of ``df``: its id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Two texts are equal when they are the same after A-Z became a-z. Of equal texts the row with
    the largest (or smallest) id stays. Null texts are empty texts and equal each other. A row with
    a null id stays only where no row of its group has one. Repeated ids are told apart by the
    row: exactly one row of a group is ``kept``. Other columns are not read, so their names do not
    matter. An empty table gives no rows.
    """
    runs = materialize(digest_runs(
        df, F.monotonically_increasing_id(), F.col(id_col), F.col(text_col)), "digests")
    return merge_runs(runs, keep, fan_in_bits).select(
        F.col("_id").alias(id_col), "keep_id", "group_size", "kept",
        F.lower(F.hex("_sha")).alias("text_sha256"))


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "largest") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns."""
    numbered = materialize(df.select(
        F.monotonically_increasing_id().alias("_uid"),
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")), "numbered")
    runs = materialize(digest_runs(numbered, F.col("_uid"), F.col(f"_row.`{id_col}`"),
                                   F.col(f"_row.`{text_col}`")), "digests")
    kept = merge_runs(runs, keep).where("kept").select("_uid")
    return numbered.join(kept, "_uid", "left_semi").select("_row.*")
