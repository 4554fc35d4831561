"""The hook for user code over batches of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

BATCH_ROWS = 1000


def map_batches(df: DataFrame, make_fn: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
                schema: str, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Apply a user's function to Arrow batches; the old columns are gone unless it returns them.

    ``make_fn`` runs once per task and returns the function, so models or tables load once. Batches
    have at most ``batch_rows`` rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make_fn()
        for batch in batches:
            for start in range(0, batch.num_rows, batch_rows):
                yield fn(batch.slice(start, batch_rows))

    return df.mapInArrow(run, schema)
