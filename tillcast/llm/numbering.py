"""Running sums and gapless numbers without one task that sees all rows.

Rows are dealt to blocks by hash. Each block is summed where it lies. The sums of blocks
are accumulated in two levels: within spans of ``SPAN`` blocks, and over the sums of spans,
so no task sees the sums of all blocks. Rows add the sum of all blocks before theirs.
Only DataFrame operations are used.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BLOCK = 4_000
SPAN = 4_096    # blocks; with ROWS_PER_BLOCK rows each, 10^11 rows make 6,100 spans


def block_count(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_BLOCK))


def running_sum(df: DataFrame, part: str, block: str, order: list, value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all earlier rows of the same ``part``.

    Rows stand in order of (``block``, ``order``). ``block`` is a whole number from 0 on and
    must hold a bounded number of rows; ``part`` may hold any.
    """
    def earlier(*keys):
        return Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)

    totals = df.groupBy(F.col(part).alias("_t_part"), F.col(block).alias("_t_block")).agg(F.sum(value).alias("_t_sum")) \
        .withColumn("_t_span", F.floor(F.col("_t_block") / SPAN))
    spans = totals.groupBy(F.col("_t_part").alias("_t_wide"), F.col("_t_span").alias("_t_far")).agg(F.sum("_t_sum").alias("_t_sum"))
    spans = spans.select("_t_wide", "_t_far", F.coalesce(F.sum("_t_sum").over(earlier("_t_wide").orderBy("_t_far")), F.lit(0)).alias("_t_base"))
    totals = totals.select("_t_part", "_t_block", "_t_span", F.coalesce(
        F.sum("_t_sum").over(earlier("_t_part", "_t_span").orderBy("_t_block")), F.lit(0)).alias("_t_before"))
    totals = totals.join(spans, (F.col("_t_part") == F.col("_t_wide")) & (F.col("_t_span") == F.col("_t_far"))).select(
        "_t_part", "_t_block", (F.col("_t_before") + F.col("_t_base")).alias("_t_before"))
    return (
        df.withColumn(out, F.coalesce(F.sum(value).over(earlier(part, block).orderBy(*order)), F.lit(0)))
        .join(totals, (F.col(part) == F.col("_t_part")) & (F.col(block) == F.col("_t_block")))
        .withColumn(out, (F.col(out) + F.col("_t_before")).cast("long"))
        .drop("_t_part", "_t_block", "_t_before")
    )
