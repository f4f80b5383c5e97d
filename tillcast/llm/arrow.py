"""Helpers for functions over Arrow batches."""

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 16 << 20  # bytes of text worked on at once
FINE = 2 << 20    # the same where many columns per byte or word are held


def slices(batches, column, size=SLICE):
    """Cut batches into row ranges of at most ``size`` bytes of a text column, one row at least."""
    for batch in batches:
        if isinstance(batch, pa.Table):
            batch = batch.combine_chunks().to_batches()[0]
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        sums = np.concatenate([[0], np.cumsum(lengths)])
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(sums, sums[a] + size, side="right")) - 1)
            yield batch.slice(a, b - a)
            a = b


@contextmanager
def small_batches(spark, rows):
    """Arrow batches of at most ``rows`` rows in jobs that run inside the block."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
