"""File sources: JSON, CSV, Parquet and plain text, by suffix, on any Hadoop file system."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from corpusloom.functions.layout import CORRUPT
from corpusloom.operators.order import global_rank
from corpusloom.session import materialize
from corpusloom.sources.arrays import array_records, infer_records, parse_records

# The reader of every supported suffix.
FORMATS = {
    ".json": "json", ".jsonl": "json", ".csv": "csv", ".parquet": "parquet", ".txt": "text",
}


# Files whose kind is asked for at a time.
LOOKS = 64


def _suffix(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return "." + name.rsplit(".", 1)[-1].lower() if "." in name[1:] else ""


def list_files(spark: SparkSession, path: str) -> list[str]:
    """The file itself, or the supported files of a folder, by name. Names only, no data is read."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        raise FileNotFoundError(f"no such path: {path}")
    # A Parquet table is a folder too: its suffix says that it is one input.
    if fs.getFileStatus(target).isFile() or _suffix(path) in FORMATS:
        return [path]
    found = sorted(
        status.getPath().toString() for status in fs.listStatus(target)
        if _suffix(status.getPath().getName()) in FORMATS)
    if not found:
        raise FileNotFoundError(f"no files with {sorted(FORMATS)} in {path}")
    return found


def _head(spark: SparkSession, path: str, size: int) -> str:
    """The first bytes of a file, read by the driver."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    try:
        data = bytes(stream.readNBytes(size))
    finally:
        stream.close()
    return data.decode("utf-8", "ignore").lstrip("\ufeff")


def _part_files(spark: SparkSession, path: str, glob: str | None) -> list[str]:
    """The files below a path that is one input (a folder that Spark wrote, or a file)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getFileStatus(target).isFile():
        return [path]
    names = sorted(s.getPath().toString() for s in fs.listStatus(target) if s.isFile())
    return [n for n in names if not n.rsplit("/", 1)[-1].startswith(("_", "."))
            and (glob is None or n.endswith(glob.lstrip("*")))]


def _is_array(spark: SparkSession, path: str) -> bool:
    """Whether a JSON file is one array rather than one object per line."""
    for size in (256, 1 << 20):
        head = _head(spark, path, size).lstrip()
        if head:
            return head.startswith("[")
    return False


def _array_files(spark: SparkSession, files: list[str]) -> set[str]:
    """The files that are arrays; a file named ``.jsonl`` is never opened for it."""
    asked = [f for f in files if _suffix(f) != ".jsonl"]
    if not asked:
        return set()
    # Waiting for the file system is all there is to it, so many files are asked at a time.
    with ThreadPoolExecutor(min(LOOKS, len(asked))) as pool:
        found = pool.map(lambda f: _is_array(spark, f), asked)
        return {f for f, array in zip(asked, found) if array}


def _key_order(spark: SparkSession, path: str) -> list[str]:
    """The names in the first record of a JSON file, in its order; as much is read as it takes."""
    size, head, more = 1 << 20, "", True
    while more:
        data = _head(spark, path, size)
        more, head = len(data) > len(head), data
        try:
            record, _ = json.JSONDecoder().raw_decode(
                head.lstrip().removeprefix("[").lstrip())
        except ValueError:
            size *= 8
            continue
        return list(record) if isinstance(record, dict) else []
    return []


def with_corrupt(schema: T.StructType | str) -> T.StructType:
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if CORRUPT in schema.names:
        return schema
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def _common(schemas: list[T.StructType]) -> T.StructType:
    """One schema for all; a field that has several types is text."""
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            known = fields.get(f.name)
            if known is None:
                fields[f.name] = T.StructField(f.name, f.dataType)
            elif known.dataType != f.dataType:
                fields[f.name] = T.StructField(f.name, T.StringType())
    return T.StructType(list(fields.values()))


def _read_json(spark: SparkSession, paths: list[str], schema, glob: str | None) -> DataFrame:
    files = [f for p in paths for f in _part_files(spark, p, glob)]
    found = _array_files(spark, files)
    arrays, lines = [f for f in files if f in found], [f for f in files if f not in found]
    records = array_records(spark, arrays) if arrays else None

    def read(given):
        reader = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        if given is not None:
            reader = reader.schema(given)
        if arrays:
            return reader.json(lines)
        # All alike: Spark lists the folders by itself.
        return (reader.option("pathGlobFilter", glob) if glob else reader).json(paths)

    if schema is None:
        schemas = [read(None).schema] if lines or not files else []
        common = _common(schemas + ([infer_records(records)] if arrays else []))
        order = {name: i for i, name in enumerate(_key_order(spark, files[0]) if files else [])}
        schema = T.StructType(sorted(common.fields, key=lambda f: order.get(f.name, len(order))))
    schema = with_corrupt(schema)
    tables = [read(schema)] if lines or not files else []
    if arrays:
        tables.append(parse_records(records, schema))
    return reduce(DataFrame.unionByName, tables)


def read_format(spark: SparkSession, paths: list[str], fmt: str,
                schema: T.StructType | str | None = None, glob: str | None = None,
                multiline: bool = False) -> DataFrame:
    """Read files of one kind.

    Pass a ``schema`` for big JSON or CSV inputs; without one they are read twice, once to infer it.
    JSON files are arrays or one object per line, each by itself: the driver looks at the first
    bytes of every one that is not named ``.jsonl``, many at a time. Columns come in the order of
    the first record. A line or an element that does not parse is kept in the column
    ``_corrupt_record``, with a schema or without; ``split_bad_lines`` takes such rows out. Arrays
    are read in byte ranges (``array_records``). CSV files are one task each if ``multiline`` (line
    breaks in quotes).
    """
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if fmt == "json":
        return _read_json(spark, paths, schema, glob)
    if fmt == "csv":
        reader = (reader.option("header", True).option("multiLine", multiline)
                  .option("escape", '"').option("columnNameOfCorruptRecord", CORRUPT))
        if schema is None:
            schema = reader.option("inferSchema", True).csv(paths).schema
        return reader.schema(with_corrupt(schema)).csv(paths)
    if fmt == "parquet":
        return (reader if schema is None else reader.schema(schema)).parquet(*paths)
    if fmt == "text":
        return reader.text(paths).withColumnRenamed("value", "text")
    raise ValueError(f"unsupported format: {fmt}")


def read_files(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               clean: bool = False, multiline: bool = False) -> DataFrame:
    """A file, or all supported files of a folder, as one table in the split ``train``.

    The first file by name decides the kind (JSON, CSV, Parquet, text) by which all are read.
    ``clean=True`` reads every kind with its own reader and puts the tables together by column name.
    """
    files = list_files(spark, path)
    kinds = [FORMATS.get(_suffix(f)) for f in files]
    if kinds[0] is None:
        raise ValueError(f"unsupported file suffix: {files[0]}")
    endings = {f[-len(_suffix(f)):] for f in files}
    if len(files) > 1 and len(endings) == 1:
        # All alike: give Spark the folder, which it lists by itself, not a list of all names.
        table = read_format(spark, [path], kinds[0], schema, "*" + endings.pop(), multiline)
    elif not clean:
        table = read_format(spark, files, kinds[0], schema, multiline=multiline)
    else:
        tables = [
            read_format(spark, [f for f, k in zip(files, kinds) if k == kind], kind, schema,
                        multiline=multiline)
            for kind in dict.fromkeys(kinds)]
        table = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return table.withColumn("split", F.lit("train"))


def with_row_id(df: DataFrame, order: str | None = None, out: str = "row_id") -> DataFrame:
    """A dense row number from 0.

    By a unique column ``order``, it is the position in its order. Without one, rows are numbered as
    they are scanned; the table is written with its marks first, so that the numbers are data and
    never worked out again.
    """
    if order is not None:
        return global_rank(df, order, out)
    placed = materialize(
        df.withColumn("_partition", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id()), "numbered")
    counts = placed.groupBy("_partition").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(
        "_partition", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    # The place counts up from (partition << 33) within a partition.
    inner = F.col("_place") - F.shiftleft(F.col("_partition").cast("bigint"), 33)
    # One row per input partition.
    return placed.join(F.broadcast(base), "_partition").withColumn(
        out, F.col("_base") + inner).drop("_partition", "_place", "_base")
