"""Best-fit-decreasing packing against a loop over single groups."""

import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import sharding
from corpusloom.llm.queries import op13_best_fit_shards


def slow_best_fit(sizes, capacity):
    """One group after the other into the fullest shard that still holds it: space left per shard,
    and how many groups of each size every shard has."""
    free, held = [], Counter()
    for size, n in sizes:
        for _ in range(n):
            fits = [(f, i) for i, f in enumerate(free) if f is not None and f >= size]
            if size > capacity:
                free.append(None)
                shard = len(free) - 1
            elif fits:
                shard = min(fits)[1]
                free[shard] -= size
            else:
                free.append(capacity - size)
                shard = len(free) - 1
            held[size, shard] += 1
    return len(free), held


def runs(plan):
    held = Counter()
    for size, _, n, shard in plan:
        held[size, shard] += n
    return held


@pytest.mark.parametrize("seed", range(40))
def test_runs_are_single_groups(seed):
    rng = random.Random(seed)
    sizes = sorted({rng.randint(1, 60): rng.randint(1, 9) for _ in range(rng.randint(0, 12))}.items(),
                   reverse=True)
    capacity = rng.randint(20, 80)
    n, held = slow_best_fit(sizes, capacity)
    plan = sharding.best_fit(sizes, capacity)
    assert runs(plan) == held
    assert n == 0 or sharding.best_fit(sizes, capacity, n - 1) is None
    firsts = defaultdict(int)
    for size, first, k, _ in plan:
        assert first == firsts[size]
        firsts[size] += k
    assert firsts == dict(sizes)


def test_tree_is_an_ordered_set():
    rng, tree, kept = random.Random(1), sharding.Tree(), set()
    for _ in range(3000):
        key = (rng.randint(0, 50), rng.randint(0, 30))
        if key in kept:
            tree.remove(key)
            kept.discard(key)
        else:
            tree.add(key)
            kept.add(key)
        space = rng.randint(0, 55)
        assert tree.at_least(space) == min((k for k in kept if k[0] >= space), default=None)

    def depth(node):
        return 0 if node is None else 1 + max(depth(node.left), depth(node.right))

    assert depth(tree.root) <= 2 * len(kept).bit_length()


@pytest.mark.parametrize("seed", range(10))
def test_pack_is_even(seed):
    rng = random.Random(seed)
    sizes = Counter(rng.randint(8, 500) for _ in range(2000))
    if seed % 2:
        sizes[200_000] = 1
    listed = sorted(sizes.items(), reverse=True)
    capacity, plan = sharding.pack(listed, 24)
    loads = Counter()
    for size, _, n, shard in plan:
        loads[shard] += size * n
    assert set(loads) == set(range(24))
    rest = [v for v in loads.values() if v < 200_000]
    assert len(rest) == 24 - seed % 2 and max(rest) <= capacity and min(rest) > 0.98 * max(rest)


def check(df, rows, n_shards=24):
    """``rows``: (doc_id, text); returns the loads."""
    got = df.collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    text = defaultdict(list)
    for i, t in rows:
        text[i].append((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())))
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (i, *v) for i, vs in text.items() for v in vs)
    slots, loads, shard_of = defaultdict(list), Counter(), defaultdict(set)
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < n_shards
        slots[r.shard].append(r.slot)
        loads[r.shard] += r["size"]
        shard_of[r["size"], r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shard_of.values())
    return loads


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    df = op13_best_fit_shards(spark, sf)
    assert dict(df.dtypes) == {
        "doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string",
        "shard": "int", "slot": "bigint", "grown_shard": "int"}
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    loads = check(df, rows)
    total, groups = sum(loads.values()), Counter()
    for _, t in rows:
        groups[t] += len(t.encode()) + 8
    assert max(loads.values()) <= max(1.2 * total / 24, max(groups.values()))


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "HOT_ROWS", 50)
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 16)
    rows = [(None, None), (1, ""), (1, ""), (2, "é" * 9), (3, "x" * 300_000), (None, "a")]
    rows += [(i, "copy") for i in range(400)] + [(i, f"{i:04d}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).select(
        "*", F.lit("x").alias("shard"), F.lit(1).alias("_uid"), F.lit(2).alias("size"))
    assert len(check(sharding.shard_rows(df), rows)) == 24
    assert sharding.shard_rows(df.limit(0)).count() == 0
    assert sharding.shard_rows(df.limit(1)).count() == 1


def test_fixed_capacity(spark):
    rows = [(i, "x" * (i % 7)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    loads = check(sharding.shard_rows(df, n_shards=None, capacity=150), rows, 60)
    sizes = Counter()
    for _, t in rows:
        sizes[len(t)] += len(t) + 8
    n, _ = slow_best_fit(sorted(Counter(sizes.values()).items(), reverse=True), 150)
    assert len(loads) == n
    with pytest.raises(ValueError):
        sharding.shard_rows(df, n_shards=None)
