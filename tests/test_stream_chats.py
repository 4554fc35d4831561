"""Conversations of a stream of turns against plain Python over all turns that were not late."""

import random
import shutil

import pytest
from pyspark.sql import functions as F

import corpusloom as cl
from corpusloom.streaming import chats as module

SCHEMA = "conv string, turn bigint, at timestamp, role string, text string"
NAMES = {"key": "conv", "order": "turn", "time": "at"}


def sessions(turns, gap):
    """(key, start second, contents in order) of every session."""
    out, by_key = [], {}
    for conv, turn, at, role, text in turns:
        by_key.setdefault(conv, []).append((at, turn, role, text))
    for conv, rows in by_key.items():
        rows.sort()
        runs = [[rows[0]]]
        for row in rows[1:]:
            if row[0] - runs[-1][-1][0] >= gap:
                runs.append([])
            runs[-1].append(row)
        out += [(conv, run[0][0], tuple((r[2], r[3]) for r in sorted(
            run, key=lambda r: (r[1], r[2], r[3])))) for run in runs]
    return sorted(out)


def frame(spark, turns):
    return spark.createDataFrame(turns, "conv string, turn bigint, at bigint, role string, "
                                 "text string").withColumn("at", F.timestamp_seconds("at"))


def rows(df):
    return sorted((r["conv"], r["s"], tuple(tuple(m) for m in r["messages"])) for r in df.select(
        "conv", F.unix_seconds("start").alias("s"), "messages").collect())


def random_turns(seed, n, keys=5, span=4000):
    rng = random.Random(seed)
    return [(f"c{min(rng.randrange(keys), rng.randrange(keys))}", i, rng.randrange(span),
             rng.choice(["user", "assistant"]), f"t{i}") for i in range(n)]


@pytest.mark.parametrize("slot_gaps", [1, 3, 256])
def test_sessions_of_a_table(spark, monkeypatch, slot_gaps):
    monkeypatch.setattr(module, "SLOT_GAPS", slot_gaps)
    for seed, gap in ((1, 40), (2, 7), (3, 900)):
        turns = random_turns(seed, 200)
        found = cl.with_sessions(frame(spark, turns), "conv", "at", gap)
        got = sorted((r["conv"], r["s"], r["turn"]) for r in found.select(
            "conv", "turn", F.unix_seconds("start").alias("s")).collect())
        want = sorted((conv, start, int(text[1:])) for conv, start, run in sessions(turns, gap)
                      for _, text in run)
        assert got == want


def arrive(spark, source, turns):
    frame(spark, turns).coalesce(1).write.mode("append").parquet(source)


def run(spark, source, out, marks, gap, delay):
    stream = cl.read_stream(spark, source, "parquet", SCHEMA, files_per_trigger=1)
    cl.write_chat_stream(stream, out, marks, "conv", "turn", "at", gap=gap, delay=delay)


def test_triggers_late_turns_and_a_break(spark, tmp_path):
    source, out, marks = str(tmp_path / "in"), str(tmp_path / "out"), tmp_path / "marks"
    gap, delay = 50, 300
    with pytest.raises(FileNotFoundError):
        cl.read_chat_stream(spark, out, **NAMES)
    # About in the order of time, with some turns far behind.
    rng = random.Random(7)
    turns = sorted(random_turns(5, 240), key=lambda t: t[2] + (
        rng.randrange(2000) if rng.random() < 0.1 else rng.randrange(200)))
    taken, late, top = [], [], None
    for i in range(4):
        part = turns[i * 60:(i + 1) * 60]
        line = None if top is None else top - delay
        for t in part:
            (late if line is not None and t[2] < line else taken).append(t)
        top = max(t[2] for t in part + taken)
        arrive(spark, source, part)
        if i == 3:
            shutil.copytree(marks, tmp_path / "old")
        run(spark, source, out, str(marks), gap, delay)
        everything = sessions(taken, gap)
        assert rows(cl.read_chat_stream(spark, out, gap=gap, open_too=True, **NAMES)) == everything
        ends = {(t[0], t[2]) for t in taken if t[2] + gap > top - delay}
        closed = [c for c in everything if not any(
            k == c[0] and any((r, x) in c[2] for q, _, at, r, x in taken if q == k and at == e)
            for k, e in ends)]
        assert rows(cl.read_chat_stream(spark, out, **NAMES)) == closed
        assert sorted(r["text"] for r in cl.read_late_turns(spark, out).collect()) == sorted(
            t[4] for t in late)
    assert late and closed and len(everything) > len(closed)
    # The offsets of the last run are lost: its trigger comes again and changes nothing.
    before = rows(cl.read_chat_stream(spark, out, gap=gap, open_too=True, **NAMES))
    run(spark, source, out, str(tmp_path / "old"), gap, delay)
    assert rows(cl.read_chat_stream(spark, out, gap=gap, open_too=True, **NAMES)) == before


def test_a_trigger_without_its_mark_is_written_anew(spark, tmp_path):
    source, out, marks = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "marks")
    first, second = random_turns(1, 40, span=500), random_turns(2, 40, span=900)
    arrive(spark, source, first)
    run(spark, source, out, marks, 30, 10_000)
    shutil.copytree(marks, tmp_path / "old")
    arrive(spark, source, second)
    run(spark, source, out, marks, 30, 10_000)
    whole = rows(cl.read_chat_stream(spark, out, gap=30, open_too=True, **NAMES))
    (tmp_path / "out" / "marks" / f"trigger={1:012d}" / "_SUCCESS").unlink()
    run(spark, source, out, str(tmp_path / "old"), 30, 10_000)
    assert rows(cl.read_chat_stream(spark, out, gap=30, open_too=True, **NAMES)) == whole
    assert whole == sessions(first + second, 30)


def test_nulls_and_empty_files(spark, tmp_path):
    source, out, marks = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "marks")
    arrive(spark, source, [])
    arrive(spark, source, [(None, 0, 5, "user", "a"), ("c", 0, None, "user", "b"),
                           ("c", 1, 7, None, None), ("c", None, 8, "user", "d")])
    run(spark, source, out, marks, 10, 0)
    assert sorted(r["text"] for r in cl.read_late_turns(spark, out).collect()) == ["a", "b"]
    found = cl.read_chat_stream(spark, out, gap=10, open_too=True, **NAMES).collect()
    assert [[tuple(m) for m in r["messages"]] for r in found] == [[("user", "d"), (None, None)]]
