"""Written examples in shards of about equal numbers of tokens, with a manifest of where they begin.

The manifest is made first, from keys and lengths alone: prefix sums of the lengths cut the order of
the keys into shards, and say which example and which token each begins with. The examples then move
once, to their shards. The manifest is written last and makes the version whole; readers go by the
last one that is, so a write that breaks off leaves what was there before.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from corpusloom.operators.order import MAX_BUCKETS, check_keys, key_bounds, prefix_sum, range_bucket
from corpusloom.session import materialize
from corpusloom.sources.folders import trigger_name, whole_triggers


#: Ids that a file has room for: shards of fewer share one, whole and in their order.
FILE_TOKENS = 16_000_000


def _mark(off: Column, n: Column, tokens: int) -> Column:
    """How many times ``tokens`` are passed where a row begins. A shard is over its size by less than
    its last example; examples without tokens go with the one before, as no shard is to be made of
    these alone."""
    return F.floor(F.greatest(off - F.when(n == 0, 1).otherwise(0), F.lit(0)) / F.lit(tokens))


def _placed(rows: DataFrame, size: Column, key: str, tokens: int) -> DataFrame:
    """Key, length and ``mark`` of every row: how many times ``tokens`` are passed where it begins."""
    narrow = rows.select(key, size.alias("_n"))
    bounds = key_bounds(narrow, key, check_keys(narrow, key))
    off = prefix_sum(narrow, F.col("_n"), key, "_off", bounds)
    return off.select(key, "_n", _mark(F.col("_off"), F.col("_n"), tokens).alias("mark"))


def _shards(placed: DataFrame, key: str) -> DataFrame:
    """A row for each shard, numbered from 0, as an example of many marks leaves some of them out."""
    cut = placed.groupBy("mark").agg(
        F.min(key).alias("first_key"), F.max(key).alias("last_key"),
        F.count("*").alias("n_rows"), F.sum("_n").alias("n_tokens"))
    before = Window.orderBy("mark").rowsBetween(Window.unboundedPreceding, -1)
    return cut.select(
        (F.row_number().over(Window.orderBy("mark")) - 1).alias("shard"), "mark", "first_key",
        "last_key", "n_rows", "n_tokens",
        F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("first_number"),
        F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first_token"))


def write_shards(examples: DataFrame, path: str, tokens: int = 100_000_000,
                 ids: str = "input_ids", key: str = "row_id") -> DataFrame:
    """Write examples by split in shards of about ``tokens`` ids; returns the manifest.

    Examples stand in the order of the key, numbered from 0 within their split (``number``). A file
    (folder ``pack``) is written by one task: a shard, or as many following ones as have about
    ``FILE_TOKENS`` ids. Null lists are empty. Keys must be unique within a split and not null,
    else it raises and the former version stays. A table without rows has an empty manifest.
    """
    spark = examples.sparkSession
    if "split" not in examples.columns:
        examples = examples.withColumn("split", F.lit("train"))
    size = F.when(F.col(ids).isNull(), F.lit(0)).otherwise(F.size(ids)).cast("bigint")
    folder, manifests = f"{path}/data/{uuid.uuid4().hex}", []
    per_file = max(1, FILE_TOKENS // tokens)
    kind = examples.schema[key].dataType.simpleString()
    # A row for each name of a split.
    for i, (split,) in enumerate(sorted(examples.select("split").distinct().collect(), key=str)):
        rows = examples.where(F.col("split").eqNullSafe(F.lit(split)))
        placed = materialize(_placed(rows, size, key, tokens), "places")
        manifest = materialize(_shards(placed, key).select(
            F.lit(split).cast("string").alias("split"), "*",
            F.concat(F.lit(f"{folder}/{i}/pack="), F.floor(F.col("shard") / F.lit(per_file))).alias(
                "folder")), "manifest")
        packs = manifest.groupBy(F.floor(F.col("shard") / F.lit(per_file)).cast("int").alias("pack")).agg(
            *[F.min(c).alias(c) for c in ("first_key", "first_number", "first_token", "shard")])
        if packs.count() <= MAX_BUCKETS:
            starts = packs.orderBy("pack").collect()

            def first(name):
                return F.get(F.from_json(F.lit(json.dumps([r[name] for r in starts])),
                                         "array<bigint>"), F.col("pack"))

            dealt = rows.withColumns({"_n": size, "pack": range_bucket(
                rows, key, [r["first_key"] for r in starts[1:]]).cast("int")})
            # A pack goes through its rows once, in their order.
            here = Window.partitionBy("pack").orderBy(key)
            before = here.rowsBetween(Window.unboundedPreceding, -1)
            mark = _mark(first("first_token") + F.coalesce(F.sum("_n").over(before), F.lit(0)),
                         F.col("_n"), tokens)
            dealt = dealt.withColumns({
                "_mark": mark, "number": first("first_number") + F.row_number().over(here) - 1})
            next_ = F.col("_mark") > F.lag("_mark").over(here)
            dealt = dealt.withColumn("_next", F.when(next_, 1).otherwise(0)).withColumn(
                "shard", (first("shard") + F.sum("_next").over(here.rowsBetween(
                    Window.unboundedPreceding, Window.currentRow))).cast("int"))
        else:
            # Past that the places, which are narrow, tell the rows where they go.
            places = placed.join(manifest, "mark").select(
                key, "shard", F.col("first_number").alias("_begin"),
                F.floor(F.col("shard") / F.lit(per_file)).cast("int").alias("pack"))
            inner = F.row_number().over(Window.partitionBy("pack", "shard").orderBy(key)) - 1
            dealt = rows.join(materialize(places, "dealt"), key).repartition("pack").withColumn(
                "number", F.col("_begin") + inner)
        dealt.select(*rows.columns, "number", "shard", "pack").write.partitionBy("pack").parquet(
            f"{folder}/{i}")
        manifests.append(manifest.drop("mark"))
    whole = spark.createDataFrame([], f"split string, shard int, first_key {kind}, last_key {kind}, "
                                  "n_rows bigint, n_tokens bigint, first_number bigint, "
                                  "first_token bigint, folder string")
    for manifest in manifests:
        whole = whole.unionByName(manifest)
    done = whole_triggers(spark, f"{path}/manifest")
    version = int(done[-1].split("=")[1]) + 1 if done else 0
    whole.sort("split", "shard").write.mode("overwrite").parquet(
        f"{path}/manifest/{trigger_name(version)}")
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The shards of the last whole version: where they begin, and what they hold."""
    done = whole_triggers(spark, f"{path}/manifest")
    if not done:
        raise FileNotFoundError(f"no manifest in {path} yet")
    return spark.read.parquet(f"{path}/manifest/{done[-1]}")


def _pack() -> Column:
    return F.regexp_extract("folder", r"/pack=(\d+)$", 1).cast("int")


def _data(spark: SparkSession, folder: str, packs) -> DataFrame:
    """The rows in the files that ``packs`` (a condition) names."""
    return spark.read.parquet(folder.rsplit("/", 1)[0]).where(packs).drop("pack")


def read_numbers(spark: SparkSession, path: str, first: int = 0, stop: int | None = None,
                 split: str = "train") -> DataFrame:
    """The examples numbered from ``first`` on, up to and without ``stop``: reads their shards only."""
    shards = read_manifest(spark, path).where(F.col("split").eqNullSafe(F.lit(split)))
    inside = F.col("first_number") + F.col("n_rows") > first
    if stop is not None:
        inside = inside & (F.col("first_number") < stop)
    low, high = (of(F.when(inside, _pack())).alias(name) for of, name in (
        (F.min, "low"), (F.max, "high")))
    found = shards.agg(F.first("folder").alias("folder"), low, high).first()
    if found["folder"] is None:
        raise ValueError(f"no split {split} in {path}")
    if found["low"] is None:
        return _data(spark, found["folder"], F.lit(False))
    rows = _data(spark, found["folder"], F.col("pack").between(found["low"], found["high"])).where(
        F.col("number") >= first)
    return rows if stop is None else rows.where(F.col("number") < stop)


def read_at(spark: SparkSession, path: str, numbers: list[int], split: str = "train") -> DataFrame:
    """The examples with these numbers, each once; names no file that holds none of them.

    The numbers are part of the plan: for many, read a range or join with the column ``number``.
    """
    asked = sorted(set(numbers))
    wanted = F.array(*[F.lit(n).cast("bigint") for n in asked]).cast("array<bigint>")
    shards = read_manifest(spark, path).where(F.col("split").eqNullSafe(F.lit(split)))
    hit = F.exists(wanted, lambda n: (n >= F.col("first_number")) & (
        n < F.col("first_number") + F.col("n_rows")))
    found = shards.where(hit | (F.col("shard") == 0)).select(
        "folder", _pack().alias("pack"), hit.alias("hit")).collect()
    if not found:
        raise ValueError(f"no split {split} in {path}")
    named = sorted({r["pack"] for r in found if r["hit"]})
    return _data(spark, found[0]["folder"], F.col("pack").isin(named)).where(
        F.col("number").isin(asked))
