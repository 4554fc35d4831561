"""What is written in many tasks or few files, as findings of round 3 asked for; own rows."""

import __spark_entry__ as entry
import pytest
from pyspark.sql import functions as F

import corpusloom as cl
from corpusloom.operators import subwords as sw
from corpusloom.sources import shards


@pytest.fixture
def own_docs(spark, tmp_path):
    rows = [(i, f"say \"{i}\" and {{[{i % 7}]}} again", "en" if i % 3 else "de") for i in range(60)]
    spark.createDataFrame([*rows, (None, "no id", "en"), (60, None, None), (60, None, None)],
                          "doc_id bigint, text string, lang string").repartition(4).write.parquet(
        str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_words_are_split_in_one_pass(spark, monkeypatch):
    """no pass for each so many merges of a word."""
    monkeypatch.setattr(sw, "STEPS", 1)
    written = []
    plain = sw.materialize
    monkeypatch.setattr(sw, "materialize", lambda df, name: written.append(name) or plain(df, name))
    merges = spark.createDataFrame([(0, "a", "b"), (1, "ab", "ab")], "rank int, left string, right string")
    words = spark.createDataFrame([("ab" * 40 + "a",), (None,), ("",)], "token string")
    got = {r.token: r.parts for r in cl.split_by_merges(words, merges).collect()}
    assert got == {"ab" * 40 + "a": ["abab"] * 20 + ["a"], None: [], "": []}
    assert len(written) == 1


@pytest.mark.parametrize("size", [100, 1 << 20])
def test_array_in_files_of_bounded_size(spark, own_docs, monkeypatch, size):
    """the same rows from one file and from many."""
    monkeypatch.setattr(entry, "ARRAY_BYTES", size)
    rows = entry.q_src_json_array(spark, own_docs)
    want = spark.read.parquet(f"{own_docs}/documents.parquet").select("doc_id", "lang", "text")
    got = rows.select("doc_id", "lang", "text")
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    assert (len(rows.inputFiles()) > 5) == (size == 100)


def test_arrivals_in_many_files_and_a_trigger_each(spark, tmp_path):
    """a part is written by many tasks, and one trigger takes all its files."""
    files, ran = str(tmp_path / "in"), []
    rows = spark.range(40).repartition(4)

    def read():
        stream = cl.read_stream(spark, files, "parquet", "id bigint")
        stream.writeStream.foreachBatch(lambda df, n: ran.append((n, df.count()))).option(
            "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()

    entry.arrive(rows, [F.col("id") < 25, F.col("id") >= 25], files, read)
    assert ran == [(0, 25), (1, 15)]
    assert len(spark.read.parquet(files).inputFiles()) > 2


@pytest.mark.parametrize("room, buckets", [(16_000_000, None), (250, None), (250, 2)])
def test_small_shards_share_files(spark, tmp_path, monkeypatch, room, buckets):
    """F7, F8: as many files as the ids need, not one for each shard."""
    monkeypatch.setattr(shards, "FILE_TOKENS", room)
    if buckets:
        monkeypatch.setattr(shards, "MAX_BUCKETS", buckets)
    sizes = [(i * 7) % 23 for i in range(200)]
    df = spark.createDataFrame([(i, [0] * n or None) for i, n in enumerate(sizes)],
                               "row_id bigint, input_ids array<int>").repartition(3)
    manifest = cl.write_shards(df, str(tmp_path / "s"), tokens=50).collect()
    got = cl.read_numbers(spark, str(tmp_path / "s"))
    marks, off = [], 0
    for n in sizes:
        marks.append(max(off - (n == 0), 0) // 50)
        off += n
    order = sorted(set(marks))
    assert sorted((r.row_id, r.number, r.shard) for r in got.collect()) == [
        (i, i, order.index(m)) for i, m in enumerate(marks)]
    assert len(manifest) == len(order) > 30
    assert len(got.inputFiles()) == (1 if room > 250 else -(-len(order) // 5))
    part = cl.read_numbers(spark, str(tmp_path / "s"), 20, 30)
    assert sorted(r.number for r in part.collect()) == list(range(20, 30))
