import hashlib
import string

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import exact

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def slow(rows, keep):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    out = []
    for i, t in rows:
        ids = groups[(t or "").translate(LOWER)]
        known = [x for x in ids if x is not None]
        best = (max if keep == "largest" else min)(known) if known else None
        digest = hashlib.sha256((t or "").translate(LOWER).encode()).hexdigest()
        out.append((str(i), str(best), len(ids), digest))
    return sorted(out)


ODD = [(1, None), (2, ""), (3, "Ab"), (4, "aB"), (5, "ab "), (6, "É"), (7, "é"), (8, "İ"),
       (4, "aB"), (None, "AB"), (None, "solo"), (9, "x" * 300_000), (10, "X" * 300_000),
       (11, "a\nb"), (12, "A\nB")]


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("parts, bits", [(1, 3), (7, 1), (20, 2)])
def test_against_a_dictionary(spark, keep, parts, bits):
    rows = ODD + [(100 + i, f"t{i % 7}") for i in range(60)] + [(500 + i, "Hot") for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts).withColumn(
        "kept", F.lit("clash")).withColumn("_uid", F.lit(0))
    got = exact.exact_dedup(df, keep=keep, fan_in_bits=bits).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256)
                  for r in got) == slow(rows, keep)
    n_groups = len({r.text_sha256 for r in got})
    assert sum(r.kept for r in got) == n_groups
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_kept_rows_come_with_all_columns(spark):
    df = spark.createDataFrame([(i, t, "c") for i, t in ODD], "doc_id long, text string, _row string")
    kept = exact.drop_copies(df)
    assert kept.columns == df.columns
    texts = [(r.text or "").translate(LOWER) for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({(t or "").translate(LOWER) for _, t in ODD})


def test_only_texts_that_agree_in_all_three_merge(spark):
    runs = spark.createDataFrame(
        [(0, 1, b"s", 3, 7), (1, 2, b"s", 3, 7), (2, 3, b"s", 4, 7), (3, 4, b"s", 3, 8)],
        "_uid long, _id long, _sha binary, _bytes long, _check long")
    got = {r._uid: (r.keep_id, r.group_size) for r in exact.merge_runs(runs).collect()}
    assert got == {0: (2, 2), 1: (2, 2), 2: (3, 1), 3: (4, 1)}


def test_no_python_in_the_plan_and_sorted_merges(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    plan = exact.exact_dedup(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapIn" not in plan


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert exact.exact_dedup(empty).count() == 0 and exact.drop_copies(empty).count() == 0
