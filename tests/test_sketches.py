"""Sketches against exact statistics."""

import math
import random
import shutil

import pytest
from pyspark.sql import functions as F

import corpusloom as cl


def exact(values, q):
    return sorted(values)[max(0, math.ceil(len(values) * q) - 1)]


@pytest.mark.parametrize("bits", [1, 4, 8])
def test_quantiles_lie_in_their_cells(spark, bits):
    rng = random.Random(bits)
    rows = [("a", rng.randrange(300)) for _ in range(300)]
    rows += [("b", int(math.exp(rng.uniform(0, 37)))) for _ in range(300)]
    rows += [("c", n) for n in (0, 1, 255, 256, 257, 2 ** 62, 2 ** 63 - 1)] + [(None, 7), ("d", None)]
    df = spark.createDataFrame(rows, "split string, n bigint")
    whole = cl.length_sketch(df, F.col("n"), bits=bits).where("split is null or split <> 'c'")
    got = {r["split"]: r for r in cl.sketch_stats(whole, bits=bits).collect()}
    for split in ("a", "b", None, "d"):
        values = [n or 0 for s, n in rows if s == split]
        assert (got[split]["n_rows"], got[split]["n_tokens"]) == (len(values), sum(values))
        for name, q in (("p50", 0.5), ("p90", 0.9), ("p99", 0.99), ("longest", 1.0)):
            least, most = got[split][f"{name}_least"], got[split][f"{name}_most"]
            assert least <= exact(values, q) <= most
            assert most - least <= least * 2.0 ** (1 - bits)
            assert least >= 2 ** bits or least == most
    ends = df.where("split = 'c'").select(
        "n", cl_cell("n", bits).alias("lo")).collect()
    for r in ends:
        e = max(r["n"].bit_length() - bits, 0)
        assert r["lo"] == r["n"] >> e << e


def cl_cell(name, bits):
    from corpusloom.operators.sketches import cell_of
    return cell_of(F.col(name), bits)


def texts(seed, n, wide):
    rng = random.Random(seed)
    return [" ".join(f"w{rng.randrange(wide)}" for _ in range(rng.randrange(400))) for _ in range(n)]


def test_shards_merge_to_the_whole(spark):
    rows = [(f"s{i % 3}", t) for i, t in enumerate(texts(1, 60, 5000) + [None, ""])]
    df = spark.createDataFrame(rows, "split string, text string")
    words = cl.word_rows(df)
    lengths, distinct = cl.length_sketch(df, cl.n_words(F.col("text"))), cl.distinct_sketch(
        words, F.col("token"))
    one = cl.sketch_stats(lengths, distinct, by=()).first()
    sizes = [len((t or "").split()) for _, t in rows]
    different = len({w for _, t in rows for w in (t or "").split()})
    assert (one["n_rows"], one["n_tokens"]) == (len(rows), sum(sizes))
    assert one["p50_least"] <= exact(sizes, 0.5) <= one["p50_most"]
    assert abs(one["n_distinct"] - different) <= 0.05 * different
    assert cl.sketch_stats(lengths, distinct).count() == 3
    empty = df.where("false")
    assert cl.sketch_stats(cl.length_sketch(empty, F.lit(1)), cl.distinct_sketch(
        cl.word_rows(empty), F.col("token"))).count() == 0


def test_stream_and_triggers_that_come_again(spark, tmp_path):
    source, out, marks = str(tmp_path / "in"), str(tmp_path / "out"), tmp_path / "marks"
    with pytest.raises(FileNotFoundError):
        cl.read_sketch_stream(spark, out)
    everything = []
    for i in range(2):
        part = texts(i, 30, 3000) + [None]
        everything += part
        spark.createDataFrame([(t,) for t in part], "text string").coalesce(1).write.mode(
            "append").parquet(source)
        if i == 1:
            shutil.copytree(marks, tmp_path / "old")
        stream = cl.read_stream(spark, source, "parquet", "text string", files_per_trigger=1)
        cl.write_sketch_stream(stream, out, str(marks))
    first = cl.read_sketch_stream(spark, out).collect()
    cl.write_sketch_stream(stream, out, str(tmp_path / "old"))
    assert cl.read_sketch_stream(spark, out).collect() == first
    sizes = [len((t or "").split()) for t in everything]
    different = len({w for t in everything for w in (t or "").split()})
    assert (first[0]["n_rows"], first[0]["n_tokens"]) == (len(sizes), sum(sizes))
    assert first[0]["p90_least"] <= exact(sizes, 0.9) <= first[0]["p90_most"]
    assert abs(first[0]["n_distinct"] - different) <= 0.05 * different
