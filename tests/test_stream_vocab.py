"""Vocabularies of a stream: ids that never change, counts within their stated error."""

import random
import shutil
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpusloom as cl

SPECIALS = ("<pad>", "</s>", "<unk>")


def texts(seed, n, wide):
    rng = random.Random(seed)
    return [" ".join(f"w{min(rng.randrange(wide), rng.randrange(wide), rng.randrange(wide))}"
                     for _ in range(30)) for _ in range(n)]


def arrive(spark, source, rows, first):
    spark.createDataFrame([(first + i, t) for i, t in enumerate(rows)], "row_id bigint, text string"
                          ).coalesce(1).write.mode("append").parquet(source)


def run(spark, source, out, marks, **how):
    stream = cl.read_stream(spark, source, "parquet", "row_id bigint, text string",
                            files_per_trigger=1)
    cl.write_vocab_stream(stream, out, marks, key="row_id", **how)


def table(df):
    return {r["token"]: r["id"] for r in df.collect()}


def grown(parts, counters, min_count, max_size):
    """The dictionary and summary after each part, and what was taken off, in plain Python."""
    ids, kept, off = {s: i for i, s in enumerate(SPECIALS)}, Counter(), 0
    for part in parts:
        kept = kept + Counter(w for t in part if t for w in t.split())
        ordered = sorted(kept.values(), reverse=True)
        cut = ordered[counters] if len(ordered) > counters else 0
        off += cut
        kept = Counter({w: n - cut for w, n in kept.items() if n > cut})
        new = sorted((w for w, n in kept.items() if n >= min_count and w not in ids),
                     key=lambda w: (-kept[w], w))
        for w in new[:max_size - len(ids)]:
            ids[w] = len(ids)
        yield dict(ids), dict(kept), off


@pytest.mark.parametrize("counters, min_count, max_size", [(1000, 1, 10 ** 6), (40, 3, 10 ** 6),
                                                           (60, 2, 50)])
def test_words_against_plain_python(spark, tmp_path, counters, min_count, max_size):
    source, out, marks = str(tmp_path / "in"), str(tmp_path / "out"), tmp_path / "marks"
    how = {"counters": counters, "min_count": min_count, "max_size": max_size}
    parts = [texts(1, 12, 60), [None, ""] + texts(2, 10, 150), texts(3, 12, 90)]
    with pytest.raises(FileNotFoundError):
        cl.read_vocab_stream(spark, out)
    for i, part in enumerate(parts):
        arrive(spark, source, part, 100 * i)
        if i == 2:
            shutil.copytree(marks, tmp_path / "old")
        run(spark, source, out, str(marks), **how)
    states = list(grown(parts, counters, min_count, max_size))
    for i, (ids, _, _) in enumerate(states):
        assert table(cl.read_vocab_stream(spark, out, i)) == ids
    ids, kept, off = states[-1]
    found = {r["token"]: (r["n"], r["n_most"]) for r in cl.read_heavy_hitters(spark, out).collect()}
    assert found == {w: (n, n + off) for w, n in kept.items()}
    true = Counter(w for part in parts for t in part if t for w in t.split())
    assert off <= sum(true.values()) / (counters + 1)
    assert all(found.get(w, (0, off))[0] <= n <= found.get(w, (0, off))[1] for w, n in true.items())
    often = {w for w, n in true.items() if n >= 0.05 * sum(true.values())}
    assert often <= {r["token"] for r in cl.read_heavy_hitters(spark, out, 0.05).collect()}
    coded = {r["row_id"]: (r["version"], r["ids"]) for r in cl.read_vocab_ids(spark, out).collect()}
    for i, part in enumerate(parts):
        for j, text in enumerate(part):
            assert coded[100 * i + j] == (i, [states[i][0].get(w, 2) for w in (text or "").split()])
    # The offsets of the last run are lost: its trigger comes again and changes nothing.
    run(spark, source, out, str(tmp_path / "old"), **how)
    assert table(cl.read_vocab_stream(spark, out)) == ids


def test_a_broken_trigger_is_written_anew(spark, tmp_path):
    source, out, marks = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "marks")
    arrive(spark, source, ["a b", "b c"], 0)
    run(spark, source, out, marks)
    first = table(cl.read_vocab_stream(spark, out))
    shutil.copytree(marks, tmp_path / "old")
    arrive(spark, source, ["d d a", "e"], 2)
    run(spark, source, out, marks)
    whole = table(cl.read_vocab_stream(spark, out))
    (tmp_path / "out" / "marks" / f"trigger={1:012d}" / "_SUCCESS").unlink()
    assert table(cl.read_vocab_stream(spark, out)) == first
    run(spark, source, out, str(tmp_path / "old"))
    assert table(cl.read_vocab_stream(spark, out)) == whole
    assert whole == first | {"d": 6, "e": 7}


def test_characters(spark, tmp_path):
    source, out, marks = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "marks")
    for first, rows in ((0, ["cab", None]), (10, []), (20, ["ad\U0001f600", "", "é"])):
        arrive(spark, source, rows, first)
    run(spark, source, out, marks, units="chars")
    assert table(cl.read_vocab_stream(spark, out)) == {
        "a": 0, "b": 1, "c": 2, "d": 3, "é": 4, "\U0001f600": 5}
    coded = {r["row_id"]: r["ids"] for r in cl.read_vocab_ids(spark, out).collect()}
    assert coded == {0: [2, 0, 1], 1: None, 20: [0, 3, 5], 21: [], 22: [4]}
