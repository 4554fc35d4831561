"""Null texts in the joined corpus, next-token tables with back-off, and windows over stored ids."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpusloom as cl
from corpusloom.operators.scores import back_off_levels, back_off_probability
from corpusloom.session import scratch_path

TEXTS = ["ab", None, "cd\n", "", None, "efgh é", "x" * 30, None]


def texts(spark, rows=TEXTS):
    return spark.createDataFrame(list(enumerate(rows)), "row_id int, text string")


def test_null_texts_are_empty(spark):
    df = texts(spark, TEXTS * 8)
    body = "\n\n".join(t or "" for t in TEXTS * 8)
    index = cl.materialize(cl.corpus_offsets(df), "index")
    assert cl.corpus_length(df).first()["n_chars"] == len(body)
    assert index.agg(F.max(F.col("off") + F.col("n"))).first()[0] == len(body)
    whole = cl.concat_corpus(df).orderBy("row_id").collect()
    assert "".join(r.text for r in whole) == body
    parts = cl.split_segments(df, index).orderBy("row_id").collect()
    assert "".join(r.text for r in parts) == body
    cut = math.floor(0.9 * len(body))
    for r in cl.sample_windows(cl.contiguous_split(index), df, 3, 8, 16).collect():
        part = body[:cut] if r.split == "train" else body[cut:]
        assert (r.x, r.y) == (part[r.start:r.start + 16], part[r.start + 1:r.start + 17])
    got = {(r.token, r["next"]): r.n for r in cl.next_token_counts(
        df.select("row_id", cl.operators.corpus.segment(63, "\n\n").alias("text"))).collect()}
    assert got == Counter(zip(body, body[1:]))


def slow_counts(rows, order):
    grams = Counter()
    for i, t in enumerate(rows):
        run = ("" if i == 0 else ("\n\n" * order)[-order:]) + (t or "")
        grams.update(run[k:k + order + 1] for k in range(len(run) - order))
    return grams


def slow_probability(ctx, char, grams, order, size, d=0.75):
    levels, runs = [], dict(grams)
    for _ in range(order + 1):
        levels.insert(0, runs)
        runs = Counter(g[1:] for g in runs)
    p = 1 / size
    for k, level in enumerate(levels):
        if len(ctx) < k:
            break
        h = ctx[len(ctx) - k:]
        own = {g: c for g, c in level.items() if g[:-1] == h}
        if own:
            total = sum(own.values())
            p = (max(own.get(h + char, 0) - d, 0) + d * len(own) * p) / total
    return p


@pytest.mark.parametrize("order", [1, 2, 3])
def test_back_off_against_loops(spark, monkeypatch, order):
    monkeypatch.setattr("corpusloom.operators.scores.PIECE", 5)
    rng = random.Random(order)
    rows = ["".join(rng.choice("aab c.é") for _ in range(rng.randint(0, 40))) for _ in range(12)]
    segments = texts(spark, [*rows, None])
    grams = slow_counts([*rows, None], order)
    counts = cl.next_token_counts(segments, order=order)
    assert {(r.token + r["next"]): r.n for r in counts.collect()} == grams
    levels = back_off_levels(cl.materialize(counts, "c"), order)
    pairs = [(c, x) for c in ["", "a", "zz", "ab", "b c", "\n\n", "aab", "c"] for x in "ab\nz"]
    pairs = [(c[-order:], x) for c, x in pairs]
    got = back_off_probability(spark.createDataFrame(sorted(set(pairs)), "ctx string, next string"),
                               levels, 9).collect()
    for r in got:
        assert r.p == pytest.approx(slow_probability(r.ctx, r["next"], grams, order, 9))
    chars = {g[-1] for g in grams}
    assert sum(slow_probability("a"[-order:], x, grams, order, len(chars))
               for x in chars) == pytest.approx(1)


def test_back_off_loss(spark):
    rows = ["abab abab", "ba ba", "abba"]
    counts = cl.next_token_counts(texts(spark, rows), order=2)
    windows = spark.createDataFrame(
        [("train", 0, "abab", "baba"), ("train", 0, "ba", "a "), ("train", 1, "zz", "zz"),
         ("validation", 0, "", "")], "split string, batch_id bigint, x string, y string")
    grams = slow_counts(rows, 2)
    losses = defaultdict(list)
    for r in windows.collect():
        losses[r.split, r.batch_id] += [
            -math.log(slow_probability(r.x[max(0, i - 1):i + 1], c, grams, 2, 5))
            for i, c in enumerate(r.y)]
    want = [sum(v) / len(v) for k, v in losses.items() if v]
    got = cl.eval_back_off(counts, windows, 2, 5).collect()
    assert [(r.split, r.n_batches) for r in got] == [("train", 2)]
    assert got[0].loss == pytest.approx(sum(want) / len(want))


@pytest.mark.parametrize("block, sep, few", [(7, (), True), (1000, (9, 9), True), (5, (1,), False)])
def test_id_windows(spark, block, sep, few):
    rng = random.Random(block)
    rows = [None if i % 9 == 4 else [rng.randint(0, 50) for _ in range(rng.choice([0, 1, 3, 40]))]
            for i in range(30)]
    coded = spark.createDataFrame(list(enumerate(rows)), "row_id int, ids array<int>").repartition(3)
    store = cl.write_id_store(coded, scratch_path(spark, "ids"), sep_ids=sep, block_ids=block)
    flat = [i for n, r in enumerate(rows) for i in [*(r or []), *(sep if n < 29 else ())]]
    blocks = {r.block: r.ids for r in store.blocks.collect()}
    assert store.total == len(flat)
    assert blocks == {b: flat[b * block:(b + 1) * block] for b in range(-(-len(flat) // block))}
    off = 0
    for r in store.directory.orderBy("row_id").collect():
        assert r.off == off
        off += r.n
    cut = int(0.9 * len(flat))
    got = cl.sample_id_windows(store, 4, 8, 16, broadcast_rows=10 ** 6 if few else 0).collect()
    assert len(got) == 64
    for r in got:
        part = flat[:cut] if r.split == "train" else flat[cut:]
        assert (r.x, r.y) == (part[r.start:r.start + 16], part[r.start + 1:r.start + 17])


def test_empty_id_store(spark):
    coded = spark.createDataFrame([(1, None), (2, [])], "row_id int, ids array<int>")
    store = cl.write_id_store(coded, scratch_path(spark, "ids"))
    assert store.total == 0
    assert all(r.x == [] and r.y == [] for r in cl.sample_id_windows(store, 1, 2, 4).collect())
