"""The stateless operators on streams, with restartable sinks.

Rendering, filtering, encoding and ``holdout_threshold`` are projections and work on a stream as
they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from corpusloom.functions.layout import CORRUPT
from corpusloom.operators.counts import split_counts
from corpusloom.sources.files import with_corrupt


def read_stream(spark: SparkSession, path: str, fmt: str, schema: T.StructType | str,
                name_filter: str | None = None, files_per_trigger: int | None = None,
                multiline: bool = False) -> DataFrame:
    """A folder of files as a stream; new files are new rows. All rows belong to ``train``.

    ``path`` may be a pattern; one file alone must be given as a pattern too (``table.parquet*``).
    Lines of JSON and CSV that do not parse are kept in the column ``_corrupt_record``, as in
    ``read_files``.
    """
    if fmt in ("json", "csv"):
        schema = with_corrupt(schema)
    reader = spark.readStream.schema(schema).format(fmt).option(
        "columnNameOfCorruptRecord", CORRUPT)
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", multiline).option("escape", '"')
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    df = reader.load(path)
    return df if "split" in df.columns else df.withColumn("split", F.lit("train"))


def write_stream(df: DataFrame, path: str, checkpoint: str, partition_by: str | None = "split",
                 wait: bool = True):
    """Write what has arrived as Parquet. A later call with the same checkpoint goes on from there."""
    writer = df.writeStream.format("parquet").option("path", path).option(
        "checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    query = writer.start()
    if wait:
        query.awaitTermination()
    return query


def streaming_counts(df: DataFrame, path: str, checkpoint: str, text: str = "text",
                     wait: bool = True):
    """Keep the counts per split up to date in a small table at ``path``.

    Spark holds one state row per split; map-side sums mean that a big split is no hot key. Every
    trigger writes the totals so far into a folder of its own, named by the trigger; read them with
    :func:`latest_counts`, which finds the table whole whenever it looks.
    """
    def add(counts: DataFrame, batch_id: int) -> None:
        counts.coalesce(1).write.mode("overwrite").parquet(f"{path}/trigger={batch_id:012d}")

    query = (
        split_counts(df, text).writeStream.outputMode("complete").foreachBatch(add)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    if wait:
        query.awaitTermination()
    return query


def latest_counts(spark: SparkSession, path: str) -> DataFrame:
    """The counts of the last trigger that was written to the end."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    done = sorted(
        s.getPath().toString() for s in fs.listStatus(target)
        if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")))
    if not done:
        raise FileNotFoundError(f"no counts in {path} yet")
    return spark.read.parquet(done[-1])
