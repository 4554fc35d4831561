"""The exact holdout of a stream against that of the table."""

import shutil

import pytest
from pyspark.sql import functions as F

import corpusloom as cl


def labels(df):
    return {r["row_id"]: r["split"] for r in df.collect()}


def test_exact_after_every_run_and_after_a_break(spark, tmp_path):
    source, out, marks = tmp_path / "in", str(tmp_path / "out"), tmp_path / "marks"
    seen = 0
    with pytest.raises(FileNotFoundError):
        cl.read_holdout_stream(spark, out)
    for run, n in enumerate((1, 30, 170)):
        new = spark.range(seen, seen + n).select(
            F.col("id").alias("row_id"), F.when(F.col("id") % 9 == 4, "test").otherwise(
                "train").alias("split"))
        new.repartition(2).write.mode("append").parquet(str(source))
        seen += n
        if run == 2:
            # The last run is lost but for its results: its triggers come again.
            shutil.copytree(marks, tmp_path / "old")
        stream = cl.read_stream(spark, str(source), "parquet", "row_id bigint, split string",
                                files_per_trigger=1)
        cl.write_holdout_stream(stream, out, str(marks))
        table = spark.read.parquet(str(source))
        for percent in (5.0, 33.3, 100.0, 0.0):
            assert labels(cl.read_holdout_stream(spark, out, percent)) == labels(
                cl.holdout(table, percent, names=()))
    again = cl.read_stream(spark, str(source), "parquet", "row_id bigint, split string",
                           files_per_trigger=1)
    cl.write_holdout_stream(again, out, str(tmp_path / "old"))
    rows = cl.read_holdout_stream(spark, out, 5.0)
    assert rows.count() == seen and rows.columns == ["row_id", "split"]


def test_half_written_trigger_is_not_read(spark, tmp_path):
    source, out, marks = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "marks")
    spark.range(40).withColumnRenamed("id", "row_id").write.parquet(str(source))
    cl.write_holdout_stream(cl.read_stream(spark, str(source), "parquet", "row_id bigint"), out, marks)
    spark.range(5).selectExpr("id as row_id", "'train' as split", "'00' as _digest").write.parquet(
        f"{out}/rows/trigger={7:012d}")
    assert cl.read_holdout_stream(spark, out).count() == 40


def test_null_keys_stay(spark, tmp_path):
    source, out, marks = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "marks")
    spark.range(40).selectExpr("nullif(id, 3) as row_id").write.parquet(str(source))
    cl.write_holdout_stream(cl.read_stream(spark, str(source), "parquet", "row_id bigint"), out, marks)
    rows = cl.read_holdout_stream(spark, out, 50.0)
    assert rows.where("row_id is null").first()["split"] == "train"
    assert rows.where("split = 'validation'").count() == 20
