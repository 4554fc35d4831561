"""Sources, sinks, streams, settings and the jobs put together."""

import json

import pytest
from pyspark.sql import functions as F

import corpusloom as cl
from corpusloom.operators import tokens
from corpusloom.operators.tokens import char_table

LINE = '{"id": 1, "text": "a\\nb"}'


def test_kinds(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text(LINE + "\n" + LINE + "\n")
    (tmp_path / "b.json").write_text("[" + LINE + ",\n" + LINE + "]")
    (tmp_path / "c.JSON").write_text(LINE)
    (tmp_path / "d.csv").write_text('id,text\n1,"x, ""y""\nz"\n')
    (tmp_path / "e.txt").write_text("one\n\ntwo\n")
    read = {n: cl.read_files(spark, str(tmp_path / n), multiline=n == "d.csv") for n in
            ("a.jsonl", "b.json", "c.JSON", "d.csv", "e.txt")}
    assert [r.text for r in read["a.jsonl"].collect()] == ["a\nb"] * 2
    assert [r.text for r in read["b.json"].collect()] == ["a\nb"] * 2
    assert [r.text for r in read["c.JSON"].collect()] == ["a\nb"]
    row = read["d.csv"].first()
    assert (row.id, row.text, row.split) == (1, 'x, "y"\nz', "train")
    assert [r.text for r in read["e.txt"].collect()] == ["one", "", "two"]


@pytest.mark.parametrize("schema", [None, "id bigint, text string"])
@pytest.mark.parametrize("name", ["a.jsonl", "a.json"])
def test_bad_lines_are_kept(spark, tmp_path, schema, name):
    (tmp_path / name).write_text(LINE + "\nnot json\n" + LINE + "\n")
    rows = cl.materialize(cl.read_files(spark, str(tmp_path / name), schema), "rows")
    good, bad = cl.split_bad_lines(rows)
    # of the written table or of the file itself
    for found in (good, bad), cl.split_bad_lines(cl.read_files(
            spark, str(tmp_path / name), schema)):
        assert [x.count() for x in found] == [2, 1]
    assert [r.line for r in bad.collect()] == ["not json"]
    assert [(r.id, r.text) for r in good.collect()] == [(1, "a\nb")] * 2
    assert [r.text for r in cl.render(rows, key="id").collect()] == ["a\nb"] * 2


def test_arrays_and_lines_in_one_folder(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"b": 1, "a": "x"},\n {"b": 2, "a": "y"}]')
    (tmp_path / "b.json").write_text('\n\ufeff \n{"b": 3, "a": "z"}\n{"b": "four", "c": 1}\n')
    (tmp_path / "c.json").write_text("")
    for schema in (None, "b string, a string, c bigint"):
        got = cl.read_files(spark, str(tmp_path), schema)
        assert got.columns == ["b", "a", "c", "_corrupt_record", "split"]
        assert sorted((r.b, r.a or "", r.c or 0) for r in got.collect() if r.b) == [
            ("1", "x", 0), ("2", "y", 0), ("3", "z", 0), ("four", "", 1)]


def test_columns_in_the_order_of_the_first_record(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"title": "t", "body": "b"}\n{"body": "c", "aa": 1}\n')
    got = cl.read_files(spark, str(tmp_path / "a.jsonl"))
    assert got.columns[:3] == ["title", "body", "aa"]
    assert [r.text for r in cl.render(got).collect()] == ["t", "None"]


def test_bad_csv_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text\n1,x\ntwo,y\n3,z,more\n")
    rows = cl.materialize(cl.read_files(
        spark, str(tmp_path / "a.csv"), "id bigint, text string"), "rows")
    good, bad = cl.split_bad_lines(rows)
    assert [(r.id, r.text) for r in good.collect()] == [(1, "x")]
    assert sorted(r.line for r in bad.collect()) == ["3,z,more", "two,y"]


def test_bad_lines_of_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"row_id": 1, "text": "x"}\n{"row_id": 2, "te\n')
    stream = cl.read_stream(spark, str(tmp_path / "in"), "json", "row_id bigint, text string")
    cl.write_stream(cl.render(stream), str(tmp_path / "out"), str(tmp_path / "m"))
    assert [r.text for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["x"]
    cl.write_stream(stream, str(tmp_path / "raw"), str(tmp_path / "n"))
    _, bad = cl.split_bad_lines(spark.read.parquet(str(tmp_path / "raw")))
    assert [r.line for r in bad.collect()] == ['{"row_id": 2, "te']


def test_prepare_numbers_rows_of_a_plain_file(spark, tmp_path):
    lines = [json.dumps({"text": f"t {i}"}) for i in range(40)] + ["broken"]
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    cfg = cl.PrepConfig(source="files", path=str(tmp_path / "a.jsonl"), vocab_size=60, batch_size=4,
                        accum=2, epochs=3, schema="text string")
    got = cl.materialize(cl.prepare(spark, cfg), "examples")
    assert got.count() == 40 and got.select("row_id").distinct().count() == 40
    vocab = cl.learn_words(spark.createDataFrame([("t </s>",)], "text string"), cfg)
    batches = cl.prepare_batches(got, vocab, cfg).collect()
    assert len(batches) == 3 * 38 and {r.epoch for r in batches} == {0, 1, 2}
    assert max(r.step for r in batches) == 4 and {r.slot for r in batches} == {0, 1, 2, 3}
    with pytest.raises(ValueError, match="all of the split 'train'"):
        cl.PrepConfig(source="files", path="/x", split="test").validate()


def test_prepare_raises_on_bad_keys(spark, tmp_path):
    for i, line in enumerate(('{"row_id": 1, "text": "b"}', '{"text": "b"}')):
        path = tmp_path / f"{i}.jsonl"
        path.write_text('{"row_id": 1, "text": "a"}\n' + line)
        with pytest.raises(ValueError, match="key"):
            cl.prepare(spark, cl.PrepConfig(source="files", path=str(path)))


def test_folder(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        cl.read_files(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        cl.read_files(spark, str(tmp_path))
    (tmp_path / "note.md").write_text("x")
    with pytest.raises(ValueError):
        cl.read_files(spark, str(tmp_path / "note.md"))
    (tmp_path / "a.jsonl").write_text(LINE)
    (tmp_path / "b.csv").write_text("id,text\n2,c\n")
    both = cl.read_files(spark, str(tmp_path), clean=True)
    assert sorted((r.id, r.text) for r in both.collect()) == [(1, "a\nb"), (2, "c")]
    # By default the first file decides how all of them are read.
    assert cl.read_files(spark, str(tmp_path)).where("id = 2").count() == 0


def test_folder_of_one_kind_is_read_as_a_folder(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).repartition(3).write.parquet(path)
    (tmp_path / "t" / "readme.md").write_text("x")
    assert cl.read_files(spark, path).count() == 10


def test_catalog(spark, tmp_path):
    df = spark.createDataFrame([(1, "train", "a"), (2, "test", "b")],
                               "row_id int, split string, text string")
    cl.write_catalog(df, str(tmp_path), "t", "main")
    back = cl.read_catalog(spark, str(tmp_path), "t", "main")
    assert sorted((r.row_id, r.split, r.text) for r in back.collect()) == [
        (1, "train", "a"), (2, "test", "b")]
    one = cl.read_catalog(spark, str(tmp_path), "t", "main", "test")
    assert [r.row_id for r in one.collect()] == [2]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    df.drop("split").write.parquet(str(tmp_path / "u"))
    assert {r.split for r in cl.read_catalog(spark, str(tmp_path), "u").collect()} == {"train"}


def test_row_ids(spark, tmp_path):
    df = spark.range(1000, numPartitions=7).select(F.concat(F.lit("k"), "id").alias("k"))
    ids = sorted(r.row_id for r in cl.with_row_id(df).collect())
    assert ids == list(range(1000))
    by_key = cl.with_row_id(df, "k").orderBy("row_id").collect()
    assert [r.k for r in by_key] == sorted(r.k for r in df.collect())


def test_examples_are_written_in_order(spark, tmp_path, docs):
    examples = cl.tokenize_dataset(
        cl.holdout(docs, 10), cl.build_char_vocab(docs), 16)
    path = str(tmp_path / "out")
    cl.write_examples(examples, path)
    back = spark.read.parquet(path)
    assert back.where("split = 'validation'").count() == 20
    files = back.select("row_id", F.input_file_name().alias("f"), F.monotonically_increasing_id()
                        .alias("i")).orderBy("i").collect()
    for f in {r.f for r in files}:
        keys = [r.row_id for r in files if r.f == f]
        assert keys == sorted(keys)


def test_stream_resumes(spark, tmp_path):
    src, out, marks = (str(tmp_path / n) for n in ("src", "out", "marks"))
    schema = "row_id bigint, text string"

    def add(lo, hi):
        spark.range(lo, hi).select(F.col("id").alias("row_id"), F.concat(F.lit(" t"), "id")
                                   .alias("text")).coalesce(1).write.mode("append").json(src)

    def run():
        stream = cl.holdout_threshold(cl.read_stream(spark, src, "json", schema), 20)
        cl.write_stream(cl.drop_blank(cl.render(stream, "text", eos="</s>")), out, marks)

    add(0, 50)
    run()
    assert spark.read.parquet(out).count() == 50
    add(50, 80)
    run()
    rows = spark.read.parquet(out)
    assert rows.count() == rows.select("row_id").distinct().count() == 80
    batch = cl.render(cl.holdout_threshold(
        spark.range(80).select(F.col("id").alias("row_id"), F.concat(F.lit("t"), "id")
                               .alias("text")), 20), "text", eos="</s>")
    assert sorted(rows.select("row_id", "split", "text").collect()) == sorted(
        batch.select("row_id", "split", "text").collect())


def test_streaming_counts(spark, tmp_path):
    src, out, marks = (str(tmp_path / n) for n in ("src", "out", "marks"))
    for lo in (0, 10):
        spark.range(lo, lo + 10).select(
            F.when(F.col("id") % 5 == 0, " ").otherwise("x").alias("text")).coalesce(
            1).write.mode("append").json(src)
        cl.streaming_counts(
            cl.read_stream(spark, src, "json", "text string", files_per_trigger=1), out, marks)
    row = cl.latest_counts(spark, out).first()
    assert (row.split, row.n_raw, row.n_kept, row.n_dropped) == ("train", 20, 16, 4)


def test_settings():
    with pytest.raises(ValueError) as e:
        cl.PrepConfig(source="web", validation_percent=60, layout="table", epochs=0, batch_size=0,
                      accum=0, max_len=8, temperature=-1, top_p=2, repetition_penalty=0).validate()
    assert len(str(e.value).splitlines()) == 11
    assert cl.PrepConfig().errors() == ["source 'catalog' needs root and name"]
    assert cl.PrepConfig(source="files", path="/x").errors() == []


def test_prepare_from_files(spark, tmp_path):
    rows = [{"row_id": i, "instruction": f"ask {i}", "output": f"say {i}"} for i in range(40)]
    (tmp_path / "in.jsonl").write_text("\n".join(json.dumps(r) for r in rows))
    cfg = cl.PrepConfig(source="files", path=str(tmp_path / "in.jsonl"), vocab_size=100)
    got = cl.prepare(spark, cfg)
    assert got.columns == ["row_id", "split", "input_ids", "attention_mask", "labels"]
    by_split = {r.split: r["count"] for r in got.groupBy("split").count().collect()}
    assert by_split == {"train": 38, "validation": 2}
    ends = {r.input_ids[-1] for r in got.collect()}
    assert ends == {1}  # the end marker


def test_prepare_from_catalog(spark, tmp_path):
    df = spark.range(60).select(
        F.col("id").alias("row_id"), F.concat(F.lit("t"), "id").alias("text"),
        F.when(F.col("id") < 40, "train").when(F.col("id") < 50, "validation").otherwise("test")
        .alias("split"))
    cl.write_catalog(df, str(tmp_path), "t")
    cfg = cl.PrepConfig(root=str(tmp_path), name="t")
    got = cl.prepare(spark, cfg).collect()
    assert {r.row_id for r in got if r.split == "validation"} == set(range(50, 60))
    assert len(got) == 50


def test_prepare_chars(spark, docs):
    table, segments, windows = cl.prepare_chars(docs, 50, n_batches=2, batch_size=4, block_size=32)
    texts = [r.text for r in docs.orderBy("row_id").collect()]
    whole = "\n\n".join(texts[:len(texts) // 2])
    chars = sorted(set(whole))
    assert table.ids == {c: i for i, c in enumerate(chars)}
    assert sum(len(r.text) for r in segments.collect()) == len(whole)
    cut = int(0.9 * len(whole))
    for r in windows.collect():
        body = whole[:cut] if r.split == "train" else whole[cut:]
        assert [chars[i] for i in r.x] == list(body[r.start:r.start + 32])
        assert r.y[:-1] == r.x[1:]
    assert windows.count() == 16


def test_stream_of_examples(spark, tmp_path, docs, sf, monkeypatch):
    vocab = cl.build_char_vocab(docs, extra="</s>")
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    stream = cl.read_stream(spark, sf, "parquet", schema, "documents.parquet").select(
        F.col("doc_id").alias("row_id"), "text")
    out = str(tmp_path / "out")
    cfg = cl.PrepConfig(source="files", path=sf)
    cl.write_stream(cl.prepare_stream(stream, cfg, vocab), out, str(tmp_path / "marks"))
    rows = spark.read.parquet(out).collect()
    assert len(rows) == docs.count() and max(len(r.input_ids) for r in rows) == 256
    assert char_table(vocab).size == vocab.count()
    words = vocab.withColumnRenamed("ch", "token")
    assert cl.prepare_stream(stream, cfg, words).isStreaming
    monkeypatch.setattr(tokens, "LOOKUP_ROWS", 10)
    with pytest.raises(ValueError):
        cl.prepare_stream(stream, cfg, words)


def test_scratch_is_dropped(spark):
    from corpusloom import session
    cl.drop_scratch(spark)
    kept = session.materialize(spark.range(5), "t")
    path = session._handed_out[session._session_key(spark)][0]
    other = spark.newSession()
    elsewhere = session.materialize(other.range(3), "t")
    assert path.startswith(session.scratch_root(spark)) and kept.count() == 5
    assert cl.drop_scratch(spark) == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    assert cl.drop_scratch(spark) == 0
    assert elsewhere.count() == 3 and cl.drop_scratch(other) == 1


def test_columns_keep_the_order_of_a_long_first_record(spark, tmp_path):
    first = {"text": "t" * 3_000_000, "answer": "a", "Body": "b"}
    path = tmp_path / "long.jsonl"
    path.write_text("\n".join(json.dumps(r) for r in (first, {"Body": "c", "answer": "d"})))
    assert cl.read_files(spark, str(path)).columns[:3] == ["text", "answer", "Body"]
    assert cl.read_files(spark, f"file:{path}").count() == 2
    (tmp_path / "bad.json").write_text("[{\"a\": ")
    cl.read_files(spark, str(tmp_path / "bad.json")).columns
