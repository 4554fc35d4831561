"""Global order without a global sort.

Every operator here works in two levels. A *bucket* is a function of the order key alone, so a
retried task puts a row in the same bucket again. A small aggregate per bucket (at most 65,536
rows) carries the running total from bucket to bucket, and a window inside each bucket does the
rest. Two kinds of buckets are used: the leading digits of an MD5 (even by construction), and
ranges between key values taken from a sample of the keys (even whatever the keys look like).

Keys must be unique and not null; the operators check it (:func:`check_keys`) and raise.
"""

from __future__ import annotations

import json
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.session import BROADCAST_ROWS

HASH_DIGITS = 4              # 16**4 = 65,536 buckets
MAX_BUCKETS = 16 ** HASH_DIGITS
ROWS_PER_BUCKET = 50_000
SAMPLES_PER_BUCKET = 24


def hash_key(seed: int, *parts: Column | str) -> Column:
    """``md5(seed|part|...)`` as hex text: the order of every seeded shuffle and draw."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in columns]))


def hash_number(digest: Column, digits: int) -> Column:
    """The first hex digits of a digest as a whole number (at most 15 digits fit)."""
    return F.conv(F.left(digest, F.lit(digits)), 16, 10).cast("bigint")


# --- keys ----------------------------------------------------------------------------------------

def check_keys(df: DataFrame, *key: str) -> int:
    """The number of rows; raises if a key is null or stands twice.

    One job over the key: rows are counted per hash of it, combined before the shuffle. Only where a
    hash stands twice are the keys themselves compared.
    """
    null = F.greatest(F.lit(0), *[F.col(k).isNull().cast("int") for k in key])
    hashed = df.select(*key, F.xxhash64(*key).alias("_hash"), null.alias("_null"))
    seen = hashed.groupBy("_hash").agg(F.count("*").alias("_n"), F.sum("_null").alias("_null"))
    n, nulls, most = seen.agg(F.sum("_n"), F.sum("_null"), F.max("_n")).first()
    if nulls:
        raise ValueError(f"{nulls} rows have a null in the key {', '.join(key)}")
    if (most or 0) > 1:
        twice = seen.where("_n > 1").select("_hash")
        same = hashed.join(twice, "_hash", "left_semi").groupBy(*key).agg(
            F.count("*").alias("_n")).where("_n > 1").head(1)
        if same:
            named = ", ".join(f"{k}={same[0][k]!r}" for k in key)
            raise ValueError(f"the key is not unique: {named} stands {same[0]['_n']} times")
    return n or 0


# --- ranges of keys ------------------------------------------------------------------------------

def _json_value(v):
    return str(v) if isinstance(v, (date, datetime, Decimal)) else v


def key_bounds(df: DataFrame, key: str, rows: int, buckets: int | None = None) -> list:
    """Key values that cut ``df`` into ranges of about equal row counts, ascending.

    They come from the keys whose hash falls in a residue class, about 24 per bucket, which are
    sorted in parallel; every so many of a partition is a bound, and only bounds reach the driver.
    """
    buckets = buckets or min(MAX_BUCKETS, max(64, rows // ROWS_PER_BUCKET))
    modulus = max(1, rows // (buckets * SAMPLES_PER_BUCKET))
    step = max(1, rows // modulus // buckets)
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    found = (
        df.select(key).where(F.col(key).isNotNull() & (F.pmod(F.xxhash64(key), F.lit(modulus)) == 0))
        .orderBy(key).withColumn("_place", place)
        .where(F.col("_place") % step == step - 1).select(key).collect())
    return sorted({r[0] for r in found})


def range_bucket(df: DataFrame, key: str, bounds: list) -> Column:
    """How many bounds are not above the key: a binary search over a constant array."""
    if not bounds:
        return F.lit(0)
    dtype = df.schema[key].dataType.simpleString()
    values = F.from_json(F.lit(json.dumps([_json_value(b) for b in bounds])), f"array<{dtype}>")
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]

    def search(below, step):
        ahead = F.get(values, below + step - 1) <= F.col(key)
        return F.when(F.coalesce(ahead, F.lit(False)), below + step).otherwise(below)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), search)


def _running_base(sums: DataFrame, bucket: str, size: str, within: list[str]) -> DataFrame:
    """Total size before each bucket. ``sums`` has one row per bucket (and group)."""
    before = Window.partitionBy(*within).orderBy(bucket).rowsBetween(
        Window.unboundedPreceding, -1)
    return sums.select(
        *within, bucket, F.coalesce(F.sum(size).over(before), F.lit(0)).alias("_base"))


def prefix_sum(df: DataFrame, size: Column, key: str = "row_id", out: str = "off",
               bounds: list | None = None) -> DataFrame:
    """``out`` = sum of ``size`` over all rows with a smaller key.

    One job finds the totals before each bucket (a number per bucket), which then are a constant of
    the plan. The plan itself has one shuffle, by bucket. Pass narrow rows where you can: everything
    in ``df`` goes through it.
    """
    if bounds is None:
        bounds = key_bounds(df, key, check_keys(df, key))
    rows = df.withColumn("_size", size.cast("bigint")).withColumn(
        "_bucket", range_bucket(df, key, bounds))
    sums = rows.groupBy("_bucket").agg(F.sum("_size").alias("_size"))
    totals = [0] * (len(bounds) + 1)
    for row in _running_base(sums, "_bucket", "_size", []).collect():
        totals[row["_bucket"]] = row["_base"]
    base = F.get(F.from_json(F.lit(json.dumps(totals)), "array<bigint>"), F.col("_bucket"))
    before = Window.partitionBy("_bucket").orderBy(key).rowsBetween(
        Window.unboundedPreceding, -1)
    return rows.withColumn(
        out, base + F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_bucket", "_size")


def global_rank(df: DataFrame, key: str = "row_id", out: str = "rank",
                bounds: list | None = None) -> DataFrame:
    """Position of every row in key order, from 0."""
    return prefix_sum(df, F.lit(1), key, out, bounds)


def key_at(df: DataFrame, ranks: list[int], key: str = "row_id", rows: int | None = None) -> list:
    """The keys at the given positions (from 0); None past the end.

    Reads the key column only. The histogram has one row per bucket, and just the buckets that hold
    an asked position are ranked.
    """
    keys = df.select(key)
    rows = check_keys(keys, key) if rows is None else rows
    asked = sorted({r for r in ranks if r < rows})
    if not asked:
        return [None] * len(ranks)
    bounds = key_bounds(keys, key, rows)
    tagged = keys.withColumn("_bucket", range_bucket(keys, key, bounds))
    base = _running_base(
        tagged.groupBy("_bucket").agg(F.count("*").alias("_n")), "_bucket", "_n", [])
    nxt = F.lead("_base", 1, rows).over(Window.orderBy("_bucket"))
    wanted = F.array(*[F.lit(r).cast("bigint") for r in asked])
    hits = (
        base.withColumn("_next", nxt)
        .where(F.exists(wanted, lambda r: (r >= F.col("_base")) & (r < F.col("_next"))))
        .collect()  # at most one row per asked position
    )
    before = F.coalesce(*[F.when(F.col("_bucket") == h["_bucket"], h["_base"]) for h in hits])
    position = before - 1 + F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    found = (
        tagged.where(F.col("_bucket").isin([h["_bucket"] for h in hits]))
        .withColumn("_at", position)
        .where(F.col("_at").isin(asked))
        .select("_at", key)
        .collect()
    )
    by_rank = {r["_at"]: r[key] for r in found}
    return [by_rank.get(r) for r in ranks]


# --- hash order ----------------------------------------------------------------------------------

def hash_cutoff(df: DataFrame, k: int, seed: int, key: str = "row_id"):
    """The ``k``-th smallest ``(md5, key)``, or None when there are fewer rows.

    A histogram over the leading digits finds the bucket; only that one is ranked.
    """
    keyed = df.select(F.col(key), hash_key(seed, key).alias("_hash"))
    keyed = keyed.withColumn("_bucket", F.left("_hash", F.lit(HASH_DIGITS)))
    base = _running_base(
        keyed.groupBy("_bucket").agg(F.count("*").alias("_n")), "_bucket", "_n", [])
    hit = base.where(F.col("_base") < k).orderBy(F.desc("_base")).first()
    if hit is None or k < 1:
        return None
    row = (
        keyed.where(F.col("_bucket") == hit["_bucket"])
        .orderBy("_hash", key)
        .offset(k - hit["_base"] - 1)
        .limit(1)
        .first()
    )
    return (row["_hash"], row[key]) if row else None


def below_cutoff(cutoff, seed: int, key: str = "row_id") -> Column:
    """Whether a row is among the ``k`` smallest of :func:`hash_cutoff`."""
    if cutoff is None:
        return F.lit(False)
    digest, last = F.lit(cutoff[0]), F.lit(cutoff[1])
    h = hash_key(seed, key)
    return (h < digest) | ((h == digest) & (F.col(key) <= last))


def exact_k(df: DataFrame, k: int, seed: int = 42, key: str = "row_id") -> DataFrame:
    """Exactly ``k`` rows (all, if there are fewer), the first ones in the order of the hash."""
    if k <= 0:
        return df.where(F.lit(False))
    cutoff = hash_cutoff(df, k, seed, key)
    return df if cutoff is None else df.where(below_cutoff(cutoff, seed, key))


def hash_rank(df: DataFrame, digest: Column, key: str, within: list[str], out: str = "rank",
              groups: int = 1) -> DataFrame:
    """Position of every row (from 0) in the order of a digest, within each group of ``within``.

    Groups may be of any size: the shuffle is by group and leading digits. ``groups`` is how many
    there are; the totals of their buckets are sent to all tasks while that is few enough.
    """
    rows = df.withColumn("_hash", digest).withColumn(
        "_bucket", F.left("_hash", F.lit(HASH_DIGITS)))
    counts = rows.groupBy(*within, "_bucket").agg(F.count("*").alias("_n"))
    base = _running_base(counts, "_bucket", "_n", within)
    inner = F.row_number().over(
        Window.partitionBy(*within, "_bucket").orderBy("_hash", key)) - 1
    return (
        rows.withColumn("_inner", inner)
        .join(F.broadcast(base) if groups * MAX_BUCKETS <= BROADCAST_ROWS else base,
              [*within, "_bucket"])
        .withColumn(out, F.col("_base") + F.col("_inner"))
        .drop("_hash", "_bucket", "_inner", "_base")
    )
