import hashlib
from math import ceil, floor

import pytest
from pyspark.sql import functions as F

import corpusloom as cl
from corpusloom.operators.splits import holdout_size, slice_bound


def table(spark, *splits):
    rows = [(i, s) for i, s in enumerate(splits)]
    return spark.createDataFrame(rows, "row_id bigint, split string")


def names(df):
    return sorted((r.row_id, r.split) for r in df.select("row_id", "split").collect())


def test_test_split_takes_the_place_of_validation(spark):
    df = table(spark, "train", "validation", "test")
    assert names(cl.normalize_validation(df)) == [(0, "train"), (2, "validation")]
    assert names(cl.normalize_validation(df, clean=True)) == names(df)
    lone = table(spark, "train", "validation", "extra")
    assert names(cl.normalize_validation(lone)) == names(lone)
    dev = table(spark, "train", "test", "dev")
    assert names(cl.normalize_validation(dev)) == [(0, "train"), (2, "validation")]


def test_without_train(spark):
    df = table(spark, "test", "b")
    assert names(cl.ensure_train(df)) == [(1, "train")]
    assert names(cl.ensure_train(df, order=["test", "b"])) == [(0, "train")]
    assert names(cl.ensure_train(df, clean=True)) == [(0, "test"), (1, "train")]
    lone = table(spark, "test", "test")
    assert names(cl.ensure_train(lone)) == [(0, "train"), (1, "train")]


def test_unsplit_table_is_train(spark):
    assert names(cl.ensure_train(spark.range(2).withColumnRenamed("id", "row_id"))) == [
        (0, "train"), (1, "train")]


@pytest.mark.parametrize("rows, percent", [(1000, 5), (1001, 5), (7, 50), (2, 5), (1, 5), (0, 5),
                                           (100, 0), (333, 0.1)])
def test_holdout_size(spark, rows, percent):
    df = spark.range(rows).withColumnRenamed("id", "row_id")
    got = names(cl.holdout(df, percent))
    k = holdout_size(rows, percent)
    assert k == (0 if rows < 2 or percent == 0 else ceil(rows * percent * 10 / 1000))
    order = sorted(range(rows), key=lambda i: (hashlib.md5(f"42|{i}".encode()).hexdigest(), i))
    chosen = set(order[:k])
    assert got == [(i, "validation" if i in chosen else "train") for i in range(rows)]


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_same_whatever_the_partitions(spark, docs, parts):
    moved = docs.repartition(parts)
    assert names(cl.holdout(docs)) == names(cl.holdout(moved))
    assert sorted(cl.shuffle_epochs(docs.select("row_id")).collect()) == sorted(
        cl.shuffle_epochs(moved.select("row_id")).collect())
    assert sorted(cl.corpus_offsets(docs).collect()) == sorted(cl.corpus_offsets(moved).collect())


def test_holdout_keeps_an_existing_validation(spark):
    df = table(spark, "train", "train", "train", "valid")
    assert names(cl.holdout(df, 50)) == names(df)
    assert len([1 for _, s in names(cl.holdout(df, 50, names=("validation",)))
                if s == "validation"]) == 2


def test_threshold_share(spark):
    df = spark.range(20000).withColumnRenamed("id", "row_id")
    held = cl.holdout_threshold(df, 5).where("split = 'validation'").count()
    assert 800 < held < 1200


@pytest.mark.parametrize("rows, lo, hi", [(1000, 0, 50), (1000, 25, 75), (1, 0, 50), (3, 0, 50),
                                          (5, 0, 50), (0, 0, 50), (10, 30, 30), (999, 0, 1),
                                          (100, 99, 100)])
def test_percent_slice(spark, rows, lo, hi):
    df = spark.range(rows).select((F.col("id") * 37 % 1009).alias("row_id"))
    keys = sorted(r.row_id for r in df.collect())
    want = keys[slice_bound(rows, lo):slice_bound(rows, hi)]
    assert sorted(r.row_id for r in cl.percent_slice(df, lo, hi).collect()) == want


def test_rank_of_uneven_keys(spark):
    """Far apart, clustered and textual keys."""
    keys = [i ** 7 for i in range(300)] + [10 ** 15 + i for i in range(300)] + [-(2 ** 60), 2 ** 61]
    df = spark.createDataFrame([(k,) for k in keys], "row_id bigint").repartition(5)
    got = {r.row_id: r.rank for r in cl.global_rank(df).collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}
    text = df.select(F.concat(F.lit("http://common/prefix/"), F.col("row_id")).alias("row_id"))
    got = {r.row_id: r.rank for r in cl.global_rank(text).collect()}
    assert got == {k: i for i, k in enumerate(sorted(got))}


def test_rank_uses_many_buckets(spark):
    """Bounds cut the keys evenly even if a third of them lies close together."""
    from corpusloom.operators.order import key_bounds, range_bucket
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(
        F.col("id") * 10 ** 9).alias("row_id"))
    bounds = key_bounds(df, "row_id", 9000, 16)
    sizes = [r["count"] for r in df.groupBy(range_bucket(df, "row_id", bounds).alias("b"))
             .count().collect()]
    assert 16 <= len(sizes) <= 24 and max(sizes) < 3 * 9000 / 16


def test_key_at(spark):
    df = spark.range(500).select((F.col("id") * 3).alias("row_id"))
    assert cl.key_at(df, [0, 499, 500, 17]) == [0, 1497, None, 51]


def test_exact_k(spark):
    df = spark.range(100).withColumnRenamed("id", "row_id")
    assert cl.exact_k(df, 10).count() == 10
    assert cl.exact_k(df, 1000).count() == 100
    assert cl.exact_k(df, 0).count() == 0


def test_contiguous_split_cuts_inside_a_row(spark):
    df = spark.createDataFrame([(1, "abc"), (2, "defgh"), (3, "")], "row_id int, text string")
    whole = "abc\n\ndefgh\n\n"
    for fraction in (0.0, 0.1, 0.25, 0.4, 0.5, 0.7, 0.9, 1.0):
        cut = floor(fraction * len(whole))
        parts = cl.contiguous_split(cl.concat_corpus(df), fraction).collect()
        index = cl.corpus_offsets(df)
        rows = cl.split_segments(df, index, fraction=fraction).collect()
        for split, want in (("train", whole[:cut]), ("validation", whole[cut:])):
            mine = sorted((r for r in parts if r.split == split), key=lambda r: (r.off, r.row_id))
            assert "".join(r.text for r in mine) == want
            assert all(r.total == len(want) and r.n == len(r.text) for r in mine)
            assert all(want[r.off:r.off + r.n] == r.text for r in mine)
            again = sorted((r for r in rows if r.split == split), key=lambda r: r.row_id)
            assert "".join(r.text for r in again) == want


def test_corpus_length(spark):
    df = spark.createDataFrame([(1, "abc"), (2, ""), (3, "é😀")], "row_id int, text string")
    row = cl.corpus_length(df, "\n").first()
    assert (row.n_rows, row.n_chars) == (3, len("abc\n\né😀"))
    assert cl.corpus_length(df.where("row_id > 9")).first().n_chars == 0


def test_shuffle_epochs(spark):
    df = spark.range(50).withColumnRenamed("id", "row_id")
    rows = cl.shuffle_epochs(df, 3).collect()
    orders = []
    for epoch in range(3):
        mine = sorted((r.pos, r.row_id) for r in rows if r.epoch == epoch)
        assert [p for p, _ in mine] == list(range(50))
        assert sorted(k for _, k in mine) == list(range(50))
        orders.append([k for _, k in mine])
    assert orders[0] != orders[1] != orders[2]


@pytest.mark.parametrize("dtype", ["int", "double", "decimal(12,2)", "date", "timestamp"])
def test_rank_of_other_key_types(spark, dtype):
    ids = spark.range(400)
    key = {"date": F.date_add(F.lit("2020-02-27").cast("date"), F.col("id").cast("int")),
           "timestamp": F.timestamp_micros(F.col("id") * 1234567)}.get(
        dtype, (F.col("id") * 1.25).cast(dtype))
    df = ids.where("id % 4 = 0").select("id", key.alias("row_id"))
    got = {r.id: r.rank for r in cl.global_rank(df).collect()}
    assert got == {i: n for n, i in enumerate(range(0, 400, 4))}
    assert sorted(r.id for r in cl.percent_slice(df, 10, 50).collect()) == list(range(40, 200, 4))
