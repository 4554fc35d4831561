"""A corpus of ids in blocks of fixed size, and random windows that read only the blocks they hit.

The ids of all rows, put end to end in key order, are cut into blocks. The place of an id tells its
block, so a window needs no search; the directory tells where the ids of every row begin.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.operators.order import check_keys, key_bounds, prefix_sum
from corpusloom.operators.splits import TRAIN, VALIDATION
from corpusloom.operators.windows import draw_starts, shifted_pairs
from corpusloom.session import BROADCAST_ROWS

#: Ids of a block, and most blocks that are named to the scan one by one.
BLOCK_IDS, NAMED_BLOCKS = 4096, 10_000


@dataclass
class IdStore:
    """``blocks``: ``block, ids``; ``directory``: ``row_id, off, n``; ``total`` ids in all."""

    blocks: DataFrame
    directory: DataFrame
    total: int
    block_ids: int


def write_id_store(coded: DataFrame, path: str, ids: str = "ids", key: str = "row_id",
                   sep_ids: tuple[int, ...] = (), block_ids: int = BLOCK_IDS) -> IdStore:
    """Write the ids of all rows as blocks and directory below ``path``.

    ``sep_ids`` follow the ids of every row but the last. Null lists are empty. Places come from the
    lengths alone; the ids then move once, as pieces, to the blocks they belong to, and blocks are
    dealt by ranges, so that files hold neighbours. Keys must be unique and not null, else it raises.
    """
    spark = coded.sparkSession
    rows = check_keys(coded, key)
    last = coded.agg(F.max(key)).first()[0]
    own = F.coalesce(F.col(ids), F.array().cast("array<int>"))
    listed = coded.select(key, F.when(F.col(key) == F.lit(last), own).otherwise(F.concat(
        own, F.array(*[F.lit(i) for i in sep_ids]).cast("array<int>"))).alias("_ids"))
    sizes = listed.select(key, F.size("_ids").cast("bigint").alias("n"))
    bounds = key_bounds(coded.select(key), key, rows)
    prefix_sum(sizes, F.col("n"), key, "off", bounds).select(key, "off", "n").write.parquet(
        f"{path}/directory")
    directory = spark.read.parquet(f"{path}/directory")
    total = directory.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    size = F.lit(block_ids)
    first, stop = F.floor(F.col("off") / size), F.floor((F.col("off") + F.col("n") - 1) / size)
    pieces = (
        listed.join(directory.where("n > 0"), key)
        .select("off", "n", "_ids", F.explode(F.sequence(first, stop)).alias("block"))
        .withColumn("_from", F.greatest(F.lit(0), F.col("block") * size - F.col("off")))
        .withColumn("_to", F.least(F.col("n"), (F.col("block") + 1) * size - F.col("off")))
        .select("block", (F.col("off") + F.col("_from")).alias("_at"), F.slice(
            "_ids", (F.col("_from") + 1).cast("int"), (F.col("_to") - F.col("_from")).cast("int"))
            .alias("_part")))
    # A block has at most as many pieces as ids, and blocks are even.
    whole = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_part"))),
                                  lambda p: p["_part"]))
    pieces.groupBy("block").agg(whole.alias("ids")).repartitionByRange("block").sortWithinPartitions(
        "block").write.parquet(f"{path}/blocks")
    spark.createDataFrame([(total, block_ids)], "total bigint, block_ids int").coalesce(
        1).write.parquet(f"{path}/shape")
    return read_id_store(spark, path)


def read_id_store(spark: SparkSession, path: str) -> IdStore:
    shape = spark.read.parquet(f"{path}/shape").first()
    return IdStore(spark.read.parquet(f"{path}/blocks"), spark.read.parquet(f"{path}/directory"),
                   shape["total"], shape["block_ids"])


def sample_id_windows(store: IdStore, n_batches: int, batch_size: int = 32, block_size: int = 256,
                      seed: int = 1337, fraction: float = 0.9,
                      broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``n_batches`` batches of windows of ids per split: ``split, batch_id, slot, start, x, y``.

    The first ``fraction`` of all ids is ``train``, the rest ``validation``; starts are drawn like
    those of :func:`sample_windows`. Windows name their blocks; the scan is narrowed down to these by
    a filter where they are few, else they meet the blocks in a join.
    """
    spark = store.blocks.sparkSession
    cut = int(fraction * store.total)
    parts = {TRAIN: (0, cut), VALIDATION: (cut, store.total)}
    totals = spark.createDataFrame(
        [(name, stop - begin) for name, (begin, stop) in parts.items()], "split string, total bigint")
    begins = F.when(F.col("split") == TRAIN, F.lit(0)).otherwise(F.lit(cut))
    ends = F.when(F.col("split") == TRAIN, F.lit(cut)).otherwise(F.lit(store.total))
    size = F.lit(store.block_ids)
    draws = draw_starts(totals, n_batches, batch_size, block_size, seed).withColumn(
        "_lo", begins + F.col("start")).withColumn(
        "_hi", F.least(F.col("_lo") + block_size + 1, ends))
    wanted = draws.where(F.col("_hi") > F.col("_lo")).select(
        "split", "draw", "_lo", "_hi",
        F.explode(F.sequence(F.floor(F.col("_lo") / size), F.floor((F.col("_hi") - 1) / size)))
        .alias("block"))
    few = 2 * n_batches * batch_size * (2 + block_size // store.block_ids) <= broadcast_rows
    blocks = store.blocks
    if few:
        named = [r["block"] for r in wanted.select("block").distinct().limit(
            NAMED_BLOCKS + 1).collect()]
        if len(named) <= NAMED_BLOCKS:
            blocks = blocks.where(F.col("block").isin(named))
    base = F.col("block") * size
    part = F.slice("ids", (F.greatest(F.col("_lo") - base, F.lit(0)) + 1).cast("int"),
                   (F.least(F.col("_hi") - base, size)
                    - F.greatest(F.col("_lo") - base, F.lit(0))).cast("int"))
    found = blocks.join(F.broadcast(wanted) if few else wanted, "block").select(
        "split", "draw", "block", part.alias("_part")).groupBy("split", "draw").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("block", "_part"))),
                              lambda p: p["_part"])).alias("_ids"))
    x, y = shifted_pairs(F.coalesce("_ids", F.array().cast("array<int>")), block_size)
    return draws.join(found, ["split", "draw"], "left").select(
        "split", "batch_id", "slot", "start", x.alias("x"), y.alias("y"))
