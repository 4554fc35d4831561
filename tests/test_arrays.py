"""JSON arrays read in byte ranges, against a parser in plain Python."""

import json
import random

import pytest

import corpusloom as cl
from corpusloom.sources.arrays import array_records
from corpusloom.sources.files import list_files


@pytest.fixture
def short_ranges(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def odd_value(rng, depth=0):
    kind = rng.random()
    if depth < 3 and kind < .2:
        return {rng.choice("abc"): odd_value(rng, depth + 1) for _ in range(rng.randrange(3))}
    if depth < 3 and kind < .35:
        return [odd_value(rng, depth + 1) for _ in range(rng.randrange(4))]
    if kind < .5:
        return rng.randrange(100)
    return "".join(rng.choice('ab{}[]",\\\n é:') for _ in range(
        rng.randrange(60 if rng.random() > .05 else 900)))


@pytest.mark.parametrize("seed", range(4))
def test_elements_are_those_of_a_parser(spark, short_ranges, tmp_path, seed):
    rng = random.Random(seed)
    items = [{"id": i, "v": odd_value(rng), "w": odd_value(rng)} if rng.random() < .9 or seed < 2
             else odd_value(rng, 1) for i in range(rng.randrange(20, 60))]
    path = tmp_path / "a.json"
    path.write_text(("﻿" if seed == 2 else "") + json.dumps(
        items, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < .5), encoding="utf-8")
    records = array_records(spark, [str(path)])
    found = [r["value"] for r in records.collect()]
    want = [x if isinstance(x, str) else json.dumps(x) for x in items]

    def plain(text):
        try:
            return json.loads(text)
        except ValueError:
            return text
    assert [plain(t) for t in found] == [plain(t) for t in want]
    assert spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions() > 1


def test_records_longer_than_a_range(spark, short_ranges, tmp_path):
    path = tmp_path / "a.json"
    items = [{"id": i, "text": "}{" * 700 * (i % 3) + '"'} for i in range(20)]
    path.write_text(json.dumps(items))
    rows = cl.read_files(spark, str(path), "id bigint, text string").collect()
    assert [(r["id"], r["text"]) for r in rows] == [(x["id"], x["text"]) for x in items]


def test_odd_files(spark, tmp_path):
    schema = "a bigint, b string"
    texts = {"empty.json": "[]", "blank.json": " [ \n ] \n", "null.json": "[null, {\"a\": 1}]",
             "cut.json": '[{"a": 2, "b": "x"}, {"a": 3, "b', "scalar.json": '[7, {"a": 4}, "t"]'}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    rows = cl.read_files(spark, str(tmp_path), schema).collect()
    assert sorted(r["a"] for r in rows if r["a"] is not None) == [1, 2, 4]
    assert sorted(r["_corrupt_record"] for r in rows if r["a"] is None) == ["7", "t", '{"a": 3, "b']
    alone = cl.read_files(spark, str(tmp_path / "empty.json"), schema)
    assert alone.count() == 0 and alone.columns[:2] == ["a", "b"]


def test_schema_and_order_of_the_first_record(spark, short_ranges, tmp_path):
    items = [{"z": "x", "m": i, "a": [i, {"k": str(i)}] if i % 2 else []} for i in range(50)]
    path = tmp_path / "a.json"
    path.write_text(json.dumps(items))
    df = cl.read_files(spark, str(path))
    assert df.columns == ["z", "m", "a", "_corrupt_record", "split"]
    assert [r["m"] for r in cl.with_row_id(df).orderBy("row_id").collect()] == list(range(50))


def test_uri_of_files(spark, tmp_path):
    for i in range(30):
        (tmp_path / f"f{i:02}.json").write_text(
            json.dumps([{"n": i}]) if i % 3 else json.dumps({"n": i}))
    uri = f"file://{tmp_path}"
    assert len(list_files(spark, uri)) == 30
    for path in (uri, f"file:{tmp_path}"):
        rows = cl.read_files(spark, path, "n bigint").collect()
        assert sorted(r["n"] for r in rows) == list(range(30))
