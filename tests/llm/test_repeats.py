import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import repeats
from corpusloom.llm.queries import op8_repeated_passages


def brute(texts, length):
    """Every string of every text in one table."""
    seen = defaultdict(list)
    for r, data in enumerate(texts):
        for i in range(len(data) - length + 1):
            seen[data[i:i + length]].append((r, i))
    gone = [np.zeros(len(t), bool) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for r, i in places:
                gone[r][i:i + length] = True
    out = []
    for data, g in zip(texts, gone):
        edge = np.diff(np.concatenate([[0], g.astype(int), [0]]))
        out.append((len(data), int(g.sum()), int((edge == 1).sum()),
                    hashlib.sha256(bytes(b for b, x in zip(data, g) if not x)).hexdigest()))
    return out


def made(seed, n=40):
    """Random texts with copies, shared passages, edits, periods and cut-offs."""
    rng = np.random.default_rng(seed)
    word = lambda k: bytes(rng.choice(list(b"abc de"), k).tolist()).decode()
    shared = [word(int(rng.integers(20, 200))) for _ in range(5)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(int(rng.integers(1, 5))):
            kind = rng.integers(0, 6)
            if kind == 0:
                parts.append(word(int(rng.integers(0, 120))))
            elif kind == 1:
                s = shared[rng.integers(0, 5)]
                a = int(rng.integers(0, 10))
                parts.append(s[a:len(s) - int(rng.integers(0, 10))])
            elif kind == 2:
                parts.append("ab"[rng.integers(0, 2)] * int(rng.integers(0, 90)))
            elif kind == 3:
                parts.append("xyz" * int(rng.integers(0, 40)))
            elif kind == 4 and texts:
                t = list(texts[rng.integers(0, len(texts))])
                if t:
                    t[rng.integers(0, len(t))] = "Q"
                parts.append("".join(t))
            else:
                parts.append("é" + word(30) + "日本")
        texts.append("".join(parts))
    return texts


def check(spark, texts, length, reach, lot=20_000, parts=3):
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _place string").repartition(parts)
    got = {r.doc_id: tuple(r)[1:] for r in repeats.remove_repeats(
        df, length=length, reach=reach, lot=lot).collect()}
    want = brute([(t or "").encode() for t in texts], length)
    assert [got[i] for i in range(len(texts))] == want


@pytest.mark.parametrize("seed, length, reach, lot", [
    (1, 40, 20, 20_000), (2, 40, 32, 20_000), (3, 24, 9, 20_000), (4, 60, 50, 3),
    (5, 40, 20, 1), (6, 12, 4, 2)])
def test_against_brute_force(spark, seed, length, reach, lot):
    check(spark, made(seed), length, reach, lot)


def test_odd_texts(spark):
    body = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(900))
    texts = [None, "", "short", body, body, body + "!", "?" + body[:400], body[200:599],
             "a" * 400, "a" * 401, "b" * 5000, "\0" * 900, body[:399], "é" * 200, "é" * 250]
    check(spark, texts, 400, 255)
    check(spark, texts, 400, 255, lot=2)


def test_long_text_is_parsed_in_stretches(spark, monkeypatch):
    texts = ["".join(made(9, 30)), "".join(made(10, 30))]
    want = [repeats.triggers(t.encode(), 40, 20) for t in texts]
    monkeypatch.setattr(repeats, "STARTS_AT_ONCE", 100)
    for t, (at, low, high) in zip(texts, want):
        a, b, c = repeats.triggers(t.encode(), 40, 20)
        place = lambda x, y, z: np.repeat(x, z - y + 1)
        assert (place(a, b, c) == place(at, low, high)).all()


def test_trigger_depends_on_the_string_alone():
    rng = np.random.default_rng(3)
    data = bytes(rng.integers(97, 100, 300).tolist())
    for lead in (b"", b"zz", bytes(rng.integers(97, 100, 77).tolist())):
        at, low, high = repeats.triggers(lead + data + lead, 40, 30)
        ways = np.repeat(at, high - low + 1) - np.arange(len(lead + data + lead) - 39)
        own = ways[len(lead):len(lead) + len(data) - 39]
        if not lead:
            first = own
        assert (own == first).all() and (own >= 0).all() and (own <= 30).all()


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    got = sorted(tuple(r) for r in repeats.remove_repeats(docs).collect())
    want = brute([r.text.encode() for r in rows], 400)
    assert got == [(r.doc_id, *w) for r, w in zip(rows, want)]


def test_repeated_ids_and_rows(spark):
    a, b = "".join(made(11, 8))[:600], "".join(made(12, 8))[:600]
    rows = [(1, a), (1, a), (1, b), (None, b), (None, None), (2, "k" * 30 + a[:90])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_hash", F.lit(1))
    out = repeats.remove_repeats(df, length=50, reach=30, texts=True)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                 for r in out.collect())
    want = brute([(t or "").encode() for _, t in rows], 50)
    assert got == sorted((str(i), *w) for (i, _), w in zip(rows, want))
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in out.collect())


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.remove_repeats(empty).count() == 0


def test_query_returns_what_is_left(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op8_repeated_passages(spark, sf).collect()
    assert {r.doc_id for r in rows} == set(docs) and any(r.n_removed for r in rows)
    for r in rows:
        assert len(docs[r.doc_id].encode()) == r.n_bytes
        if "\ufffd" not in r.kept_text:
            assert len(r.kept_text.encode()) == r.n_bytes - r.n_removed
            assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256
        if not r.n_removed:
            assert r.kept_text == docs[r.doc_id]
