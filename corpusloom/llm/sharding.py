"""Sharding by best-fit-decreasing bin packing of groups that stay together."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from corpusloom.session import BROADCAST_ROWS, materialize

#: Bytes that every row takes besides its text.
ROW_BYTES = 8
#: Groups of more rows than this (or than a share of all rows, whichever is more) are looked up in a
#: broadcast; there are at most ``HOT_SHARE`` of them.
HOT_ROWS, HOT_SHARE = 1000, 100_000
#: Rows of a bucket in which places are counted, and the most buckets.
BUCKET_ROWS, MAX_BUCKETS = 4096, 16_384

# --- packing -------------------------------------------------------------------------------------


class _Node:
    __slots__ = ("key", "level", "left", "right")

    def __init__(self, key):
        self.key, self.level, self.left, self.right = key, 1, None, None


class Tree:
    """Ordered set of (free space, shard): a balanced tree (AA tree)."""

    def __init__(self):
        self.root = None

    @staticmethod
    def _balance(node):
        if node.left and node.left.level == node.level:  # skew
            up = node.left
            node.left, up.right = up.right, node
            node = up
        if node.right and node.right.right and node.right.right.level == node.level:  # split
            up = node.right
            node.right, up.left = up.left, node
            up.level += 1
            node = up
        return node

    def add(self, key):
        def into(node):
            if node is None:
                return _Node(key)
            if key < node.key:
                node.left = into(node.left)
            else:
                node.right = into(node.right)
            return self._balance(node)

        self.root = into(self.root)

    def remove(self, key):
        def out(node, key):
            if node is None:
                raise KeyError(key)
            if key == node.key:
                if node.left is None or node.right is None:
                    return node.left or node.right
                heir = node.right
                while heir.left:
                    heir = heir.left
                node.key = heir.key
                node.right = out(node.right, heir.key)
            elif key < node.key:
                node.left = out(node.left, key)
            else:
                node.right = out(node.right, key)
            return self._lower(node)

        self.root = out(self.root, key)

    def _lower(self, node):
        below = min(node.left.level if node.left else 0, node.right.level if node.right else 0) + 1
        if below < node.level:
            node.level = below
            if node.right and node.right.level > below:
                node.right.level = below
        node = self._balance(node)
        if node.right:
            node.right = self._balance(node.right)
            if node.right.right:
                node.right.right = self._balance(node.right.right)
        return self._balance(node)

    def at_least(self, space):
        """The least (free, shard) with ``free >= space``, or None."""
        node, found = self.root, None
        while node:
            if node.key[0] >= space:
                found, node = node.key, node.left
            else:
                node = node.right
        return found


def best_fit(sizes: list[tuple[int, int]], capacity: int, most: int | None = None):
    """``(size, first, n, shard)`` of every run of equal groups, or None if ``most`` shards do not do.

    ``sizes`` are ``(size, groups)``, the greatest first. The tightest shard a group fits is still the
    tightest for an equal one, so it takes as many as fit before the next is looked for: the result
    is that of one group after the other. A group above the capacity has a shard to itself.
    """
    tree, shards, plan = Tree(), 0, []
    for size, groups in sizes:
        first = 0
        while first < groups:
            if size > capacity:
                free, shard, n = None, shards, 1
            else:
                found = tree.at_least(size)
                free, shard = found or (capacity, shards)
                if found:
                    tree.remove(found)
                n = min(groups - first, free // size if size else groups)
            if shard == shards:
                if shards == most:
                    return None
                shards += 1
            if free is not None:
                tree.add((free - n * size, shard))
            plan.append((size, first, n, shard))
            first += n
    return plan


def pack(sizes: list[tuple[int, int]], n_shards: int):
    """``(capacity, plan)`` of about the least capacity for which :func:`best_fit` needs no more than
    ``n_shards``: the even share of what no single group exceeds, then larger by doubled steps, then
    halved. Groups above the capacity take a shard each, and the others share the rest."""
    def even() -> int:
        total, left = sum(s * n for s, n in sizes), n_shards
        for size, groups in sizes:
            n = min(groups, left - 1)
            while n > 0 and size * left > total:
                total, left, n = total - size, left - 1, n - 1
            if size * left <= total or left == 1:
                break
        return max(1, -(-total // left))

    low = even()
    plan, step = best_fit(sizes, low, n_shards), 1
    if plan is not None:
        return low, plan
    high = low
    while plan is None:
        low, high = high, high + step
        step *= 2
        plan = best_fit(sizes, high, n_shards)
    # To a millionth, which no shard shows.
    while high - low > 1 + high // 1_000_000:
        middle = (low + high) // 2
        tried = best_fit(sizes, middle, n_shards)
        if tried is None:
            low = middle
        else:
            high, plan = middle, tried
    return high, plan


# --- on tables -----------------------------------------------------------------------------------

def _rank(rows: DataFrame, within: str, number: str, out: str, most: int) -> DataFrame:
    """Place from 0 of every row within ``within``, in the order of hash buckets of ``number``.

    Buckets are even whatever the groups are; their totals carry the count from one to the next.
    """
    buckets = max(1, min(MAX_BUCKETS, most // BUCKET_ROWS))
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(number), F.lit(buckets)))
    before = Window.partitionBy(within).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    base = rows.groupBy(within, "_bucket").agg(F.count("*").alias("_n")).select(
        within, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inner = F.row_number().over(Window.partitionBy(within, "_bucket").orderBy(number)) - 1
    return (rows.withColumn("_inner", inner).join(base, [within, "_bucket"])
            .withColumn(out, (F.col("_base") + F.col("_inner")).cast("long"))
            .drop("_bucket", "_inner", "_base"))


def shard_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               n_shards: int | None = 24, capacity: int | None = None) -> DataFrame:
    """Per row: id, ``size``, ``text_crc32``, ``law`` (``bytes``), ``shard``, ``slot``, ``grown_shard``
    (null, as this law does not grow by a shard).

    The size of a row is the UTF-8 bytes of its text and 8. Rows of equal text are a group and stay
    together (null counts as empty). Groups enter the shards by best fit, the greatest first. Either
    ``capacity`` is fixed and there are as many shards as that takes, or ``n_shards`` is, and the
    capacity is about the least that does; a group above it has a shard to itself. Groups of one size
    are interchangeable, so the packing needs only how many there are of each: a row for each
    different size, of which n bytes of text have at most ``sqrt(2 n)``. Slots are gapless from 0 in
    each shard. Null and repeated ids are rows like others; other columns are not read; an empty table
    gives no rows. Shards without a group do not occur.
    """
    if (n_shards is None) == (capacity is None):
        raise ValueError("give either n_shards or capacity")
    if (n_shards if capacity is None else capacity) < 1:
        raise ValueError("n_shards and capacity must be above 0")
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = materialize(df.select(
        F.monotonically_increasing_id().alias("_uid"), F.col(id_col).alias("_id"),
        (F.octet_length(text).cast("long") + ROW_BYTES).alias("_size"),
        F.crc32(text.cast("binary")).alias("_crc"), F.unhex(F.sha2(text, 256)).alias("_text")), "rows")
    groups = materialize(rows.groupBy("_text").agg(
        F.sum("_size").alias("_group"), F.count("*").alias("_n"), F.min("_uid").alias("_first")),
        "groups")
    n_rows, n_groups = groups.agg(F.sum("_n"), F.count("*")).first()
    sizes = [(r["_group"], r["n"]) for r in groups.groupBy("_group").agg(
        F.count("*").alias("n")).orderBy(F.desc("_group")).collect()]
    plan = best_fit(sizes, capacity) if capacity else pack(sizes, n_shards)[1]

    # Runs of equal groups: the n-th group of a size is in the last run that begins at or before n.
    runs: dict[int, list] = {}
    for size, first, _, shard in plan:
        runs.setdefault(size, []).append((first, shard))
    table = spark.createDataFrame(
        list(runs.items()), "_group long, _runs array<struct<first: long, shard: int>>")
    # Where a size has one run, all its groups go to one shard, and need no rank.
    ranked = groups.join(F.broadcast(table) if len(runs) <= BROADCAST_ROWS else table, "_group")
    single = ranked.where(F.size("_runs") == 1).withColumn("_rank", F.lit(0).cast("long"))
    many = _rank(ranked.where(F.size("_runs") > 1), "_group", "_first", "_rank", n_groups or 0)
    run = F.element_at(F.filter("_runs", lambda r: r["first"] <= F.col("_rank")), -1)
    placed = materialize(single.unionByName(many).select(
        "_text", "_n", run["shard"].alias("shard")), "placed")

    hot = F.col("_n") > max(HOT_ROWS, (n_rows or 0) // HOT_SHARE)
    tagged = rows.join(F.broadcast(placed.where(hot).select("_text", "shard")), "_text", "left")
    here = tagged.where(F.col("shard").isNotNull())
    others = tagged.where(F.col("shard").isNull()).drop("shard").join(
        placed.where(~hot).select("_text", "shard"), "_text")
    kept = materialize(here.unionByName(others).select("_uid", "_id", "_size", "_crc", "shard"),
                       "sharded")
    return _rank(kept, "shard", "_uid", "slot", n_rows or 0).select(
        F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
