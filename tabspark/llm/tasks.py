"""Small helpers between Spark and the tasks of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tabspark.session import ensure_checkpoint_dir

#: Bytes of an Arrow batch that a task is handed at once, about.
BATCH_BYTES = 8 << 20
#: Bytes of a column that a step with many arrays per word looks at together, about.
PIECE_BYTES = 1 << 20


def output_type(schema: T.StructType) -> pa.Schema:
    """The Arrow schema of a task's output."""
    return to_arrow_schema(schema)


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A batch of the given columns (arrays or lists) in the schema's types."""
    return pa.RecordBatch.from_arrays(
        [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type)
         for c, f in zip(columns, schema, strict=True)], schema=schema)


def bounded_batches(spark: SparkSession) -> None:
    """Bound the bytes of Arrow batches, so that long texts don't fill a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def pieces(batches: Iterable[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The batches' rows in slices of about ``PIECE_BYTES`` of a column, a row at least."""
    for batch in batches:
        parts = max(1, -(-batch.column(column).nbytes // PIECE_BYTES))
        rows = max(1, -(-batch.num_rows // parts))
        for at in range(0, max(1, batch.num_rows), rows):
            yield batch.slice(at, rows)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bounded_labels(labels: DataFrame, key: str, max_rows: int) -> DataFrame:
    """All rows of ``labels``, or about ``max_rows`` of them by a hash of the key if there are more.

    The result is small enough to broadcast: ``max_rows`` bounds its expected
    size, whatever the input's.
    """
    n = labels.count()
    if n <= max_rows:
        return labels
    return labels.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int(max_rows / n * (1 << 30)))
