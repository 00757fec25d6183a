"""Helpers for operators that run Arrow batches through Python tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

ROWS_PER_BATCH = 512
SLICE_BYTES = 4 << 20


def bounded_batches(spark: SparkSession, rows: int = ROWS_PER_BATCH) -> None:
    """Keep Arrow batches small: texts may be long, so a batch is bounded by
    rows here, not by Spark's default of 10,000."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def text_slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(keys, texts) of a batch (key, text without nulls) in slices of at most
    ``limit`` bytes of text; a longer text is a slice of its own."""
    keys, texts = batch.column(0), batch.column(1)
    if texts.type != pa.string():
        texts = texts.cast(pa.string())
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else []
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(offsets, int(offsets[at]) + limit, side="right")) - 1)
        yield keys.slice(at, stop - at), texts.slice(at, stop - at)
        at = stop
