import re

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import mixing


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    budget, free, out = share * sum(sizes.values()), list(order), {}
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    while free:
        above = [s for s in free
                 if budget * w[s] / sum(w[x] for x in free) > most * sizes[s]]
        if not above:
            return out | {s: budget * w[s] / sum(w[x] for x in free) for s in free}
        for s in above:
            out[s] = most * sizes[s]
        budget -= sum(out[s] for s in above)
        free = [s for s in free if s not in above]
    return out


def check(df, slack=0.05):
    rows = df.collect()
    text = [(r.doc_id, r.text, r.source) for r in rows]
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, t, s in text:
        sizes[s] = sizes.get(s, 0) + count(t)
    want = targets(sizes)
    got = mixing.mix(df).join(df.select("doc_id", "source").distinct(), "doc_id").collect()
    assert sorted((r.doc_id, r.size) for r in got) == sorted((i, count(t)) for i, t, _ in text)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size and (r.first_slot is None) == (r.taken == 0)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, n in taken.items():
        assert abs(n - want[s]) <= max(slack * want[s], 3), s
    return got


def test_given_documents(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    got = check(df)
    again = mixing.mix(df.repartition(5)).collect()
    assert sorted((r.doc_id, r.taken, r.first_slot) for r in got) == sorted(
        (r.doc_id, r.taken, r.first_slot) for r in again)


def test_uneven_sources(spark):
    rows = [(i, "w " * (i % 40), "big") for i in range(3000)]
    rows += [(4000 + i, "a b\x0bc d\n", "é") for i in range(50)] + [(5000, "one", "tiny")]
    rows += [(6000 + i, None if i % 2 else "x y z " * 30, None) for i in range(300)]
    rows += [(7000, "", "empty"), (7001, "long " * 30_000, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn(
        "size", F.lit("clash")).withColumn("_off", F.lit(0))
    check(df)
    out = mixing.mix_documents(df)
    assert out.columns == df.columns
    per = out.groupBy("doc_id").count().agg(F.max("count")).first()[0]
    assert per == 2


def test_ranks_count_the_slots_of_a_source(spark):
    sources = [{"index": 0, "slots": 60_000.5, "blocks": 70_000},
               {"index": 1, "slots": 0.0, "blocks": 0},
               {"index": 2, "slots": 90_000.25, "blocks": 40_000}]
    got = mixing.schedule(spark, sources, 2.0).orderBy("slot").collect()
    seen = {0: 0, 2: 0}
    for r in got:
        assert r._rank == seen[r._index]
        seen[r._index] += 1
    assert abs(seen[0] - 60_000) < 20 and seen[2] == 80_000


def test_too_many_sources_raise(spark):
    df = spark.createDataFrame([(i, "x", str(i)) for i in range(9)],
                               "doc_id long, text string, source string")
    with pytest.raises(ValueError):
        mixing.mix(df, max_sources=8)


def test_empty_table_and_repeated_rows(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0
    assert mixing.mix_documents(spark.createDataFrame([], schema)).count() == 0
    same = spark.createDataFrame([(None, "a b", "s")] * 4 + [(1, None, None)], schema)
    got = mixing.mix(same).collect()
    assert sum(r.taken for r in got) == 12 and len(got) == 5
