"""Writing panels, metrics, importances, reports and forecasts."""

from pyspark.sql import functions as F

from tillcast.constants import DATE, SERIES_KEYS


def write_panel(df, path, partition_by=None, mode="overwrite"):
    """A parquet panel; rows of a series lie together, in order of time, in each file.

    One sort serves the order and the folders: it begins with ``partition_by``, as the writer
    wants it, so that no second sort holds the rows again and undoes the order.
    """
    folders = [partition_by] if partition_by else []
    writer = df.sortWithinPartitions(*folders, *SERIES_KEYS, DATE).write.mode(mode)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def write_metrics(metrics, path):
    """Metric records as one JSON file; one row per model or group."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def write_importance(importance, path, value):
    """Importances as one CSV file, the largest first; one row per feature."""
    importance.orderBy(F.desc(value), "feature").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_report(lines, path):
    """Report lines in order as one text file."""
    lines.orderBy("line_no").select("line").coalesce(1).write.mode("overwrite").text(path)


def write_sequences(windows, path):
    """Raw imputation arrays per window."""
    windows.write.mode("overwrite").parquet(path)


def write_forecasts(forecasts, path):
    """Plain forecasts, for when a backtest cannot be aligned."""
    forecasts.write.mode("overwrite").parquet(path)
