"""Shards of written examples against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

import corpusloom as cl
from corpusloom.sources import shards as module


def examples(seed, n, longest=30):
    rng = random.Random(seed)
    return [(i * 3 + 1, rng.choice(["train", "train", "validation"]),
             rng.choice([None, [], [0] * rng.randrange(1, longest)] + [
                 [0] * rng.randrange(1, longest)] * 5)) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "row_id bigint, split string, input_ids array<int>").repartition(3)


def expected(rows, split, tokens):
    """(key, number, mark) of every example in order, the mark being where its shard begins."""
    out, off = [], 0
    for number, (key, _, ids) in enumerate(sorted((r for r in rows if r[1] == split))):
        n = len(ids or [])
        out.append((key, number, max(off - (n == 0), 0) // tokens))
        off += n
    return out


@pytest.mark.parametrize("buckets", [None, 3])
def test_shards_and_reads(spark, tmp_path, monkeypatch, buckets):
    if buckets:
        monkeypatch.setattr(module, "MAX_BUCKETS", buckets)
    rows = examples(1, 150) + [(1000, "train", [0] * 500)] + [(1001, "train", None)]
    path = str(tmp_path / "out")
    manifest = cl.write_shards(frame(spark, rows), path, tokens=100).collect()
    for split in ("train", "validation"):
        want = expected(rows, split, 100)
        marks = sorted({m for _, _, m in want})
        got = sorted((r["row_id"], r["number"], r["shard"]) for r in cl.read_numbers(
            spark, path, split=split).collect())
        assert got == [(k, n, marks.index(m)) for k, n, m in want]
        shards = [r for r in manifest if r["split"] == split]
        off = 0
        for r, mark in zip(shards, marks, strict=True):
            inside = [(k, n) for k, n, m in want if m == mark]
            assert (r["first_key"], r["last_key"], r["first_number"], r["n_rows"]) == (
                inside[0][0], inside[-1][0], inside[0][1], len(inside))
            assert r["first_token"] == off
            off += r["n_tokens"]
        assert off == sum(len(ids or []) for _, s, ids in rows if s == split)
    longest = max(len(ids or []) for _, _, ids in rows)
    assert all(r["n_tokens"] < 100 + longest for r in manifest)
    order = [k for k, _, _ in expected(rows, "train", 100)]
    for first, stop in ((0, 5), (17, 60), (len(order) - 2, None), (5, 5), (10 ** 6, None)):
        part = cl.read_numbers(spark, path, first, stop)
        assert sorted(r["row_id"] for r in part.collect()) == order[first:stop]
    some = cl.read_at(spark, path, [3, 3, 40, len(order) - 1, 10 ** 6])
    assert sorted(r["row_id"] for r in some.collect()) == [order[3], order[40], order[-1]]
    assert len(some.inputFiles()) >= 1 and cl.read_at(spark, path, []).count() == 0
    with pytest.raises(ValueError):
        cl.read_at(spark, path, [1], "test")


def test_a_write_that_breaks_off_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        cl.read_manifest(spark, path)
    rows = examples(2, 20)
    cl.write_shards(frame(spark, rows), path, tokens=50)
    broken = frame(spark, rows).withColumn("x", F.when(F.col("row_id") > 30, F.raise_error(F.lit("no"))))
    with pytest.raises(Exception, match="no"):
        cl.write_shards(broken, path, tokens=50)
    with pytest.raises(ValueError, match="unique"):
        cl.write_shards(frame(spark, rows + rows), path, tokens=50)
    assert cl.read_numbers(spark, path).count() == sum(r[1] == "train" for r in rows)
    cl.write_shards(frame(spark, examples(3, 7)).drop("split"), path, tokens=50)
    assert cl.read_numbers(spark, path).count() == 7


def test_empty_table_and_null_split(spark, tmp_path):
    assert cl.write_shards(frame(spark, []), str(tmp_path / "a")).count() == 0
    with pytest.raises(ValueError):
        cl.read_numbers(spark, str(tmp_path / "a"))
    cl.write_shards(frame(spark, [(1, None, [1]), (2, "train", None)]), str(tmp_path / "b"))
    assert cl.read_numbers(spark, str(tmp_path / "b"), split=None).first()["row_id"] == 1
