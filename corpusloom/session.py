"""Session helpers: the shared scratch folder, written tables, scan parallelism."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession

# Most rows a side may have to be sent to every executor, and most bytes of text in them.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 32 << 20

_handed_out: dict[str, list[str]] = defaultdict(list)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster for checkpoints and written tables.

    It is read from ``spark.checkpoint.dir`` (or the checkpoint directory set on the context). Only
    a local session that names none gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="corpusloom-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def _session_key(spark: SparkSession) -> str:
    return f"{spark.sparkContext.applicationId}/{spark._jsparkSession.sessionUUID()}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    _handed_out[_session_key(spark)].append(path)
    return path


def drop_path(spark: SparkSession, path: str) -> bool:
    """Delete a table of this session that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    paths = _handed_out[_session_key(spark)]
    if path in paths:
        paths.remove(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def drop_scratch(spark: SparkSession) -> int:
    """Delete what this session wrote under scratch paths; returns how many there were.

    Call it when no table built on them is read any more, as when a result has been written.
    """
    return sum(drop_path(spark, path) for path in list(_handed_out.pop(_session_key(spark), [])))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a costly plan is read more than once: the lineage ends at the files, lost executors
    lose nothing, and later readers prune columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Re-deal the rows when a scan has fewer splits than the session has cores.

    One Parquet row group is one task however many cores there are. Tables of many files are
    returned unchanged, so at scale this costs nothing.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    plan = df._jdf.queryExecution().executedPlan()
    # Counting the partitions of a plan with shuffles would run them; only scans are counted.
    if "Exchange" in plan.toString() or "Adaptive" in plan.nodeName():
        return df
    return df.repartition(cores) if plan.execute().getNumPartitions() < cores else df
