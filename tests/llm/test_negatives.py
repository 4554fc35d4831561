"""Strassen's product, the heaps, and mining against a loop over all rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import negatives
from corpusloom.llm.queries import op12_hard_negatives


@pytest.mark.parametrize("shape", [(0, 3, 4), (1, 1, 1), (25, 26, 27), (64, 64, 100), (97, 65, 51),
                                   (130, 128, 257), (30, 0, 30)])
def test_strassen_is_exact(shape):
    m, k, n = shape
    rng = np.random.default_rng(sum(shape))
    for top in (5, 1 << 20, 1 << 28):
        a, b = rng.integers(-top, top, (m, k)), rng.integers(-top, top, (k, n))
        assert (negatives.strassen(a, b) == a @ b).all()
        want = [[sum(int(x) * int(y) for x, y in zip(r, c)) for c in b.T[:3]] for r in a[:3]]
        assert negatives.strassen(a, b)[:3, :3].tolist() == want


def test_strassen_is_used(monkeypatch):
    """Seven products a level, not eight."""
    sides = []
    real = negatives.strassen

    def counted(a, b):
        sides.append(a.shape[0])
        return real(a, b)

    monkeypatch.setattr(negatives, "strassen", counted)
    counted(np.ones((64, 64), np.int64), np.ones((64, 64), np.int64))
    assert [sides.count(s) for s in (64, 32, 16)] == [1, 7, 49]


@pytest.mark.parametrize("seed", range(20))
def test_heaps_are_the_best(seed):
    rng = np.random.default_rng(seed)
    heaps, seen = negatives.Heaps(6, 4), [[] for _ in range(6)]
    number = 0
    for _ in range(5):
        n = int(rng.integers(1, 60))
        scores, fits = rng.integers(-4, 5, (6, n)), rng.random((6, n)) < 0.8
        ids, rows = sorted(rng.integers(0, 9, n).tolist()), list(range(number, number + n))
        number += n
        for i in range(6):
            seen[i] += [(-int(scores[i, j]), ids[j], rows[j]) for j in range(n) if fits[i, j]]
        heaps.push(scores, fits.copy(), ids, rows)
    got = [[] for _ in range(6)]
    for i, score, id_, row in heaps.entries():
        got[i].append((-score, id_, row))
    assert [sorted(g) for g in got] == [sorted(s)[:4] for s in seen]


def slow_negatives(rows, relabel=7):
    """``rows``: (vec_id, embedding, label) in the order of the table."""
    part = []
    for n, (i, e, label) in enumerate(rows):
        if label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        if relabel and i is not None and i % relabel == 0:
            label = (label + 1) % 10
        part.append((n, i, label, [math.floor(256 * x) for x in e]))
    out = []
    for a in part:
        if a[1] is None or a[1] % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[3], r[3])), math.inf if r[1] is None else r[1],
                         r[0], r) for r in part if r[0] != a[0])
        for s, _, _, p in [x for x in scored if x[3][2] == a[2]][:5]:
            fit = [x for x in scored if x[3][2] != a[2] and -30 * s <= -100 * x[0] <= -90 * s]
            out += [(a[1], p[1], k + 1, x[3][1], -s, -x[0]) for k, x in enumerate(fit[:10])]
    return out


def key(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v or 0) for v in r))


def test_given_vectors(spark, sf):
    got = op12_hard_negatives(spark, sf)
    assert dict(got.dtypes) == {
        "anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint",
        "positive_score": "bigint", "negative_score": "bigint"}
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select(
        "vec_id", "embedding", "label").collect()]
    want = slow_negatives(rows)
    assert want and key(tuple(r) for r in got.collect()) == key(want)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHOR_TILE", 3)
    monkeypatch.setattr(negatives, "ROW_TILE", 7)
    rng = random.Random(5)
    rows = [(rng.choice([None, 100, 200, *range(300)]),
             rng.choice([None, [], [1.0, None], [float("nan"), 0.1], [float("inf")]])
             if rng.random() < 0.1 else [rng.randint(-2, 6) / 8 for _ in range(rng.randint(1, 4))],
             rng.choice([None, 0, 1, 1, 2])) for _ in range(300)]
    rows += [(7, [0.5, 0.5], 1)] * 150 + [(100 * k, [0.0], 1) for k in range(4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1)
    df = df.select("*", F.lit(1).alias("_row"), F.lit("x").alias("score"))
    want = key(slow_negatives(rows))
    for chunk in (8192, 2):
        monkeypatch.setattr(negatives, "spread", lambda d: d)
        got = negatives.hard_negatives(df, relabel=7, chunk_anchors=chunk)
        assert key(tuple(r) for r in got.collect()) == want
    assert negatives.hard_negatives(df.limit(0)).count() == 0
    assert negatives.hard_negatives(df.where("vec_id = 7")).count() == 0


def test_scores_beyond_a_long(spark):
    df = spark.createDataFrame([(0, [1e30], 1), (1, [2.0], 1)],
                               "vec_id long, embedding array<double>, label int")
    with pytest.raises(ValueError):
        negatives.hard_negatives(df)
