"""Windows, batches and next-token tables against plain Python on small tables."""

import hashlib
import re
from collections import Counter, defaultdict
from math import exp, floor, log

import pytest
from pyspark.sql import functions as F

import corpusloom as cl
from corpusloom.operators import windows as win


def naive_windows(texts, n_batches, batch, block, seed=1337, sep="\n\n", fraction=0.9):
    whole = sep.join(texts)
    cut = floor(fraction * len(whole))
    out = {}
    for split, body in (("train", whole[:cut]), ("validation", whole[cut:])):
        top = len(body) - block - 1
        for i in range(n_batches * batch):
            start = 0
            if top > 0:
                digest = hashlib.md5(f"{seed}|{split}|{i}".encode()).hexdigest()
                start = int(digest[:15], 16) % top
            out[split, i // batch, i % batch] = (
                start, body[start:start + block], body[start + 1:start + block + 1])
    return out


def sampled(df, n_batches, batch, block, **options):
    stream = cl.contiguous_split(cl.corpus_offsets(df))
    rows = cl.sample_windows(stream, df, n_batches, batch, block, **options).collect()
    return {(r.split, r.batch_id, r.slot): (r.start, r.x, r.y) for r in rows}


@pytest.mark.parametrize("chunk", [16, 8192])
@pytest.mark.parametrize("few", [True, False])
def test_windows(spark, docs, monkeypatch, chunk, few):
    monkeypatch.setattr(win, "CHUNK", chunk)
    if not few:
        monkeypatch.setattr(win, "BROADCAST_ROWS", 0)
    some = docs.where("row_id < 40")
    texts = [r.text for r in some.orderBy("row_id").collect()]
    assert sampled(some, 3, 8, 64) == naive_windows(texts, 3, 8, 64)


def test_windows_over_one_long_row_and_many_short(spark):
    texts = ["", "a", "é😀" * 30000, "", "b", *["x"] * 50, "zz"]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id bigint, text string")
    assert sampled(df, 4, 16, 100) == naive_windows(texts, 4, 16, 100)


@pytest.mark.parametrize("texts", [["0123"], ["ab", "cd"], ["0123456789"]])
def test_short_data_starts_at_zero(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "row_id bigint, text string")
    got = sampled(df, 1, 2, 8)
    want = {k: v for k, v in naive_windows(texts, 1, 2, 8).items() if k in got}
    assert got == want and any(k[0] == "train" for k in got)


def test_encoded_windows(spark):
    df = spark.createDataFrame([(0, "0123456789" * 5)], "row_id bigint, text string")
    vocab = cl.build_char_vocab(df)
    stream = cl.contiguous_split(cl.corpus_offsets(df))
    rows = cl.sample_windows(stream, df, 2, 8, 4, vocab=vocab).where("split = 'train'").collect()
    assert len(rows) == 16
    for r in rows:
        assert 0 <= r.start <= 45 - 4 - 2
        assert r.x == [(r.start + i) % 10 for i in range(4)]
        assert r.y == [(r.start + i + 1) % 10 for i in range(4)]


def test_batches_and_padding(spark):
    df = spark.createDataFrame(
        [(i, "train", [5] * (i % 4 + 1)) for i in range(10)],
        "row_id int, split string, ids array<int>")
    batches = cl.assign_batches(cl.with_masks(df), batch_size=4, epochs=2)
    sizes = Counter((r.epoch, r.batch_id) for r in batches.collect())
    assert sorted(sizes.values()) == [2, 2, 4, 4, 4, 4]
    for side in ("right", "left"):
        groups = defaultdict(list)
        for r in cl.pad_batches(batches, 0, side).collect():
            groups[r.epoch, r.batch_id].append(r)
        for rows in groups.values():
            width = max(r.row_id % 4 + 1 for r in rows)
            for r in rows:
                n, pad = r.row_id % 4 + 1, width - (r.row_id % 4 + 1)
                want = [([5] * n, [0] * pad), ([1] * n, [0] * pad), ([5] * n, [-100] * pad)]
                got = [r.input_ids, r.attention_mask, r.labels]
                assert got == [a + b if side == "right" else b + a for a, b in want]
    report = {(r.epoch, r.step): r for r in cl.pad_report(batches, 2).collect()}
    assert sum(r.n_rows for r in report.values()) == 20
    assert sum(r.real_tokens for r in report.values()) == 2 * sum(i % 4 + 1 for i in range(10))
    steps = cl.accumulation_groups(batches, 2).select("batch_id", "step").distinct().collect()
    assert sorted(map(tuple, steps)) == [(0, 0), (1, 0), (2, 1)]


def test_padding_id_in_labels(spark):
    df = cl.with_masks(spark.createDataFrame(
        [(0, 0, 0, [5, 6]), (1, 0, 0, [7])], "row_id int, epoch int, batch_id int, ids array<int>"))
    rows = cl.pad_batches(df, 0).orderBy("row_id").collect()
    assert [(r.input_ids, r.attention_mask, r.labels) for r in rows] == [
        ([5, 6], [1, 1], [5, 6]), ([7, 0], [1, 0], [7, -100])]
    assert [r.labels for r in cl.pad_batches(df, 6).orderBy("row_id").collect()] == [
        [5, -100], [7, -100]]
    assert [r.labels for r in cl.pad_batches(df, 6, clean=True).orderBy("row_id").collect()] == [
        [5, 6], [7, -100]]
    assert cl.default_pad_id(10, None) == 10 and cl.default_pad_id(10, 3) == 3
    with pytest.raises(ValueError):
        cl.pad_batches(df, 0, "top")


def test_next_token_counts_and_loss(spark):
    texts = ["abab", "", "é😀b", "ba"]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id bigint, text string")
    whole = "\n\n".join(texts)
    cut = floor(0.9 * len(whole))
    index = cl.corpus_offsets(df)
    train = cl.split_segments(df, index).where("split = 'train'")
    counts = cl.next_token_counts(train, first_key=0)
    want = Counter(zip(whole[:cut], whole[1:cut]))
    assert {(r.token, r.next): r.n for r in counts.collect()} == want

    windows = naive_windows(texts, 2, 4, 3)
    frame = spark.createDataFrame(
        [(s, b, i, x, y) for (s, b, i), (_, x, y) in windows.items()],
        "split string, batch_id bigint, slot int, x string, y string")
    size = len(set(whole))
    context = Counter()
    for (a, _), n in want.items():
        context[a] += n
    expected = {}
    for split in ("train", "validation"):
        means = []
        for b in range(2):
            losses = [-log((want[p, q] + 0.5) / (context[p] + 0.5 * size))
                      for (s, bb, _), (_, x, y) in windows.items() if (s, bb) == (split, b)
                      for p, q in zip(x, y)]
            if losses:
                means.append(sum(losses) / len(losses))
        if means:
            expected[split] = sum(means) / len(means)
    got = {r.split: r.loss for r in cl.eval_loss(counts, frame, 0.5, size).collect()}
    assert got == pytest.approx(expected)
    with pytest.raises(ValueError):
        cl.next_token_counts(train, row_sep="")


LOGITS = {"a": 2.0, "b": 1.0, "c": -1.0, "d": 1.0}


@pytest.fixture(scope="module")
def scores(spark):
    return spark.createDataFrame(
        [("p", t, v) for t, v in LOGITS.items()] + [("q", "z", 0.0)],
        "prompt_id string, token string, logit double")


def probs(logits, t=1.0):
    top = max(logits.values())
    e = {k: exp((v - top) / t) for k, v in logits.items()}
    return {k: v / sum(e.values()) for k, v in e.items()}


def of(df, column):
    return {r.token: r[column] for r in df.where("prompt_id = 'p'").collect()}


def test_softmax_and_filters(scores):
    soft = cl.temperature_softmax(scores, 0.7)
    assert of(soft, "prob") == pytest.approx(probs(LOGITS, 0.7))
    with pytest.raises(ValueError):
        cl.temperature_softmax(scores, 0)
    assert sorted(of(cl.top_k(scores, 2), "logit")) == ["a", "b"]
    assert len(of(cl.top_k(scores, 99), "logit")) == 4
    flat = cl.temperature_softmax(scores, 1.0)
    assert sorted(of(cl.top_p(flat, 0.5), "prob")) == ["a"]
    assert sorted(of(cl.top_p(flat, 0.7), "prob")) == ["a", "b"]
    assert sorted(of(cl.top_p(flat, 1.0), "prob")) == ["a", "b", "c", "d"]
    assert sorted(of(cl.top_p(flat, 0.0), "prob")) == ["a"]


def test_penalty(spark, scores):
    seen = spark.createDataFrame([("p", "a"), ("p", "c"), ("p", "a"), ("x", "b")],
                                 "prompt_id string, token string")
    assert of(cl.repetition_penalty(scores, seen, 2.0), "logit") == {
        "a": 1.0, "b": 1.0, "c": -2.0, "d": 1.0}


def test_greedy_and_draws(spark, scores):
    assert of(cl.greedy_next(scores), "token") == {"a": "a"}
    many = spark.range(4000).select(
        F.col("id").cast("string").alias("prompt_id"),
        F.inline(F.array(*[F.struct(F.lit(t).alias("token"), F.lit(v).alias("logit"))
                           for t, v in LOGITS.items()])))
    drawn = Counter(r.token for r in cl.sample_next(cl.temperature_softmax(many, 1.0), 3).collect())
    assert sum(drawn.values()) == 4000
    for token, p in probs(LOGITS).items():
        assert abs(drawn[token] / 4000 - p) < 0.03


def test_choose_next(spark, scores):
    greedy = cl.PrepConfig(temperature=0)
    assert of(cl.choose_next(scores, greedy), "token") == {"a": "a"}
    sure = cl.PrepConfig(top_k=1)
    assert of(cl.choose_next(scores, sure), "token") == {"a": "a"}
    seen = spark.createDataFrame([("p", "a")], "prompt_id string, token string")
    strict = cl.PrepConfig(top_k=1, repetition_penalty=4.0)
    assert of(cl.choose_next(scores, strict, seen), "token") == {"b": "b"}


def test_only_files_hit_are_read(spark, tmp_path):
    path = str(tmp_path / "texts")
    spark.range(400).repartitionByRange(40, "id").select(
        F.col("id").alias("row_id"), F.repeat(F.lit("abcde"), F.lit(100)).alias("text")
    ).write.parquet(path)
    docs = spark.read.parquet(path)
    stream = cl.contiguous_split(cl.materialize(cl.corpus_offsets(docs), "index"))
    windows = cl.sample_windows(stream, docs, 1, 2, 16)
    assert windows.count() == 4 and all(len(r.x) == 16 for r in windows.collect())
    plan = windows._jdf.queryExecution().executedPlan().toString()
    assert "file_path" in plan
    read = windows._jdf.queryExecution().optimizedPlan().toString()
    assert "file_path" in read


def test_repeated_and_null_keys_raise(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "row_id int, text string")
    for call in (cl.corpus_offsets, cl.global_rank, cl.holdout,
                 lambda d: cl.percent_slice(d, 0, 50), lambda d: cl.assign_batches(d, 2)):
        with pytest.raises(ValueError, match="row_id=2 stands 2 times"):
            call(df)
        with pytest.raises(ValueError, match="1 rows have a null"):
            call(df.selectExpr("if(text = 'b', null, row_id) as row_id", "text"))


def test_arrays_move_once(spark, docs):
    examples = cl.tokenize_dataset(docs, cl.char_table(cl.build_char_vocab(docs)), 32)
    padded = cl.pad_batches(cl.assign_batches(examples, 4, 3), 0)
    plan = padded._jdf.queryExecution().explainString(
        padded.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    moves = [part for part in plan.split("\n\n") if re.search(r"^\(\d+\) (Broadcast)?Exchange", part.strip())]
    wide = [part for part in moves if "input_ids" in part.split("Arguments")[0]]
    assert len(moves) >= 3 and len(wide) <= 1
