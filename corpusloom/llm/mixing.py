"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from corpusloom.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Golden-ratio step in units of 2**-31; products of two such numbers fit a long.
STEP, UNIT = 1_327_217_885, 1 << 31
CELLS = 4096
SLOTS_PER_CHUNK = 1 << 16


def _sized(df: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(
        "_uid", F.col(id_col).alias("_id"), F.col(source_col).alias("_source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("_size"),
        F.xxhash64(F.lit(seed), F.col(id_col)).alias("_hash"), F.xxhash64(text).alias("_tie"))


def source_targets(sizes: DataFrame, weights, share: float, most: float,
                   block_words: int, blocks_per_source: int, max_sources: int) -> list[dict]:
    """Targets of all sources, in the order of their names, null last.

    ``sizes`` has one row per source; there may be ``max_sources`` of them, so that they fit the
    driver and a broadcast, else it raises. Targets are ``share`` of all words by weight; a target
    above ``most`` times its source's size stops there and the excess goes to the others by weight,
    until none is above.
    """
    rows = sizes.orderBy(F.col("_source").asc_nulls_last()).limit(max_sources + 1).collect()
    if len(rows) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    out = [{"source": r["_source"], "index": i, "size": r["_total"] or 0,
            "weight": float(weights[i % len(weights)]), "target": None}
           for i, r in enumerate(rows)]
    budget, open_ = share * sum(s["size"] for s in out), list(out)
    while open_:
        unit = budget / sum(s["weight"] for s in open_)
        above = [s for s in open_ if unit * s["weight"] > most * s["size"]]
        for s in above:
            s["target"] = most * s["size"]
            budget -= s["target"]
        if not above:
            for s in open_:
                s["target"] = unit * s["weight"]
            break
        open_ = [s for s in open_ if s["target"] is None]
    for s in out:
        s["words"] = max(1, min(block_words, s["size"] // blocks_per_source))
        s["blocks"] = -(-s["size"] // s["words"])
        s["slots"] = s["target"] / s["words"]
    return out


def schedule(spark, sources: list[dict], most: float) -> DataFrame:
    """``_index, _rank, slot``: slot n goes to the source in whose stretch of the cumulative
    weights the n-th golden-ratio point falls; its rank counts the slots of that source before it.

    A stretch is found by an equi-join on cells of the unit interval; there are at most as many
    rows to it as sources and cells together. Ranks are counted per chunk of slots and then within.
    """
    total = sum(s["slots"] for s in sources)
    cells, low = [], 0.0
    last = max((s["index"] for s in sources if s["slots"]), default=None)
    for s in sources:
        high = low + s["slots"] / total if total else low
        if s["slots"]:
            high = 1.0 if s["index"] == last else high
            for c in range(int(low * CELLS), min(CELLS - 1, int(high * CELLS)) + 1):
                cells.append((c, s["index"], low, high, int(most * s["blocks"])))
        low = high
    table = spark.createDataFrame(cells, "_cell int, _index int, _low double, _high double, "
                                         "_most long")
    point = (F.col("slot").bitwiseAND(UNIT - 1) * STEP % UNIT) / F.lit(float(UNIT))
    slots = (
        spark.range(round(total)).withColumnRenamed("id", "slot").withColumn("_x", point)
        .withColumn("_cell", F.floor(F.col("_x") * CELLS).cast("int"))
        .join(F.broadcast(table), "_cell")
        .where((F.col("_x") >= F.col("_low")) & (F.col("_x") < F.col("_high")))
        .select("slot", "_index", "_most",
                F.floor(F.col("slot") / SLOTS_PER_CHUNK).alias("_chunk")))
    before = Window.partitionBy("_index").orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    base = slots.groupBy("_index", "_chunk").agg(F.count("*").alias("_n")).select(
        "_index", "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inner = F.row_number().over(Window.partitionBy("_index", "_chunk").orderBy("slot")) - 1
    return (slots.withColumn("_inner", inner).join(base, ["_index", "_chunk"])
            .withColumn("_rank", F.col("_base") + F.col("_inner"))
            .where(F.col("_rank") < F.col("_most")).select("_index", "_rank", "slot"))


def plan_mix(numbered: DataFrame, id_col: str, text_col: str, source_col: str, weights, share,
             most, block_words, blocks_per_source, max_sources, bucket_bits, seed):
    """``(rows, blocks)``: rows in their place among the shuffled words of their source, and how
    often and up to which pass every block of a source is taken."""
    spark = numbered.sparkSession
    sized = materialize(_sized(numbered, id_col, text_col, source_col, seed), "sizes")
    sources = source_targets(
        sized.groupBy("_source").agg(F.sum("_size").alias("_total")), weights, share, most,
        block_words, blocks_per_source, max_sources)
    table = spark.createDataFrame(
        [(s["source"], s["index"], s["size"], s["target"], s["words"], s["blocks"])
         for s in sources],
        sized.select("_source").schema.add("_index", "integer").add(
            "_total", "long").add("_target", "double").add("_words", "long").add("_blocks", "long"))
    same = sized["_source"].eqNullSafe(table["_source"])
    rows = sized.join(F.broadcast(table), same).drop(table["_source"]).withColumn(
        "_bucket", F.shiftrightunsigned("_hash", 64 - bucket_bits))
    up_to = Window.partitionBy("_index").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    base = rows.groupBy("_index", "_bucket").agg(F.sum("_size").alias("_n")).select(
        "_index", "_bucket", F.coalesce(F.sum("_n").over(up_to), F.lit(0)).alias("_base"))
    inner = Window.partitionBy("_index", "_bucket").orderBy(
        "_hash", "_id", "_size", "_tie", "_uid").rowsBetween(Window.unboundedPreceding, -1)
    rows = materialize(
        rows.withColumn("_in", F.coalesce(F.sum("_size").over(inner), F.lit(0)))
        .join(base, ["_index", "_bucket"])
        .withColumn("_off", F.col("_base") + F.col("_in")).drop("_hash", "_tie", "_base", "_in"),
        "placed")
    of = table.select("_index", "_blocks")
    blocks = schedule(spark, sources, most).join(F.broadcast(of), "_index").groupBy(
        "_index", (F.col("_rank") % F.col("_blocks")).alias("_block")).agg(
        F.count("*").alias("_times"), F.min("slot").alias("first_slot"))
    return rows, blocks


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=(5, 2, 1), share: float = 1.5, most: float = 2.0, block_words: int = 256,
        blocks_per_source: int = 256, max_sources: int = 100_000, bucket_bits: int = 12,
        seed: int = 42) -> DataFrame:
    """Per row: id, ``size`` (words), ``source_size``, ``target`` (of its source), ``taken`` (words
    the mix takes, repeats counted), ``first_slot`` (first place of one of its words in the mix).

    The rows of a source are put in the order of a hash and cut into blocks of equally many words:
    ``block_words``, or less so that a small source still has ``blocks_per_source`` of them. Slots
    of the schedule take the blocks of their source in turn and start anew after the last; no block
    is taken more than ``most`` times. Null sources are a source of their own, named last; null
    texts have no words. Rows without words are taken 0 times and have no first slot. Repeated rows
    are rows of their own. Places follow from hashes, so reruns agree. A source of any size is cut
    into ``2**bucket_bits`` stretches for its order.
    """
    numbered = df.select(F.monotonically_increasing_id().alias("_uid"), *[
        F.col(f"`{c}`") for c in dict.fromkeys([id_col, text_col, source_col])])
    rows, blocks = plan_mix(numbered, id_col, text_col, source_col, weights, share, most,
                            block_words, blocks_per_source, max_sources, bucket_bits, seed)
    end = F.col("_off") + F.col("_size")
    pieces = rows.where("_size > 0").select(
        "_uid", "_index", "_off", "_size", "_words",
        F.explode(F.expr("sequence(_off div _words, (_off + _size - 1) div _words)"))
        .alias("_block"))
    overlap = F.least(end, (F.col("_block") + 1) * F.col("_words")) - F.greatest(
        F.col("_off"), F.col("_block") * F.col("_words"))
    taken = pieces.join(blocks, ["_index", "_block"]).groupBy("_uid").agg(
        F.sum(overlap * F.col("_times")).alias("taken"), F.min("first_slot").alias("first_slot"))
    return rows.join(taken, "_uid", "left").select(
        F.col("_id").alias(id_col), F.col("_size").alias("size"),
        F.col("_total").alias("source_size"), F.col("_target").alias("target"),
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot")


def mix_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source", weights=(5, 2, 1), share: float = 1.5,
                  most: float = 2.0, block_words: int = 256, blocks_per_source: int = 256,
                  max_sources: int = 100_000, bucket_bits: int = 12, seed: int = 42) -> DataFrame:
    """The mix as whole rows with all their columns: a row stands in it as often as the block that
    holds its middle word is taken. Rows without words are not in the mix."""
    numbered = materialize(df.select(F.monotonically_increasing_id().alias("_uid"), F.struct(*[
        F.col(f"`{c}`") for c in df.columns]).alias("_row")), "numbered")
    rows, blocks = plan_mix(
        numbered.select("_uid", *[F.col(f"_row.`{c}`").alias(n) for c, n in (
            (id_col, "i"), (text_col, "t"), (source_col, "s"))]),
        "i", "t", "s", weights, share, most, block_words, blocks_per_source, max_sources,
        bucket_bits, seed)
    middle = F.expr("(_off + _size div 2) div _words").alias("_block")
    times = rows.where("_size > 0").select("_uid", "_index", middle).join(
        blocks, ["_index", "_block"]).select("_uid", "_times")
    return (numbered.join(times, "_uid")
            .withColumn("_each", F.explode(F.expr("sequence(1, _times)"))).select("_row.*"))
