"""Python functions over Arrow batches, with this package sent along to the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from storelens.operators.shipping import ship

__all__ = ["map_batches", "ship"]

#: bytes of an Arrow batch that is sent to a Python worker
BATCH_BYTES = 8 << 20


def map_batches(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """``df.mapInArrow`` for a function of this package.

    Batches hold ``BATCH_BYTES`` at most besides the last row: the number of rows alone, which is
    what the session bounds tightly, says little where texts are long.
    """
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, schema)
