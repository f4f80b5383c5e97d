"""Smoothed target encoding, median fills and standardisation: fit, then transform."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.constants import ENCODED_COLUMNS, SMOOTHING_ROWS
from tillcast.operators.quantiles import exact_medians
from tillcast.session import materialize


def encoding_cells(train, columns=ENCODED_COLUMNS, target="y_eff"):
    """Sum and count of the target per combination of the encoded columns and month.

    One pass over the rows serves every encoded column. Map-side aggregation makes the
    shuffle as small as the number of combinations, however large a category is.
    """
    return train.groupBy(*columns, "month").agg(F.sum(target).alias("_total"), F.count(target).alias("_rows"))


def encoding_lookup(cells, column, overall=None, smoothing=SMOOTHING_ROWS):
    """Encoded mean per (category, month): the group mean drawn to the overall mean."""
    if overall is None:
        overall = cells.select(F.sum("_total") / F.sum("_rows")).scalar()
    else:
        overall = F.lit(overall)
    groups = cells.filter(F.col(column).isNotNull()).groupBy(column, "month").agg(
        F.sum("_total").alias("_total"), F.sum("_rows").alias("_rows"))
    encoded = (F.col("_total") + overall * smoothing) / (F.col("_rows") + smoothing)
    return groups.select(column, "month", F.when(F.col("_rows") > 0, encoded).alias(f"{column}_te"))


@dataclass
class TargetEncoder:
    """Lookups fitted on training rows; ``transform`` adds ``<column>_te``.

    The lookups are written to the shared folder, so their size is known when the join
    is planned: a small one is broadcast under the session's limit, a large one joins by
    shuffle, where adaptive execution splits a hot category. No hint forces either.
    """

    lookups: dict
    overall: float

    @classmethod
    def fit(cls, train, columns=ENCODED_COLUMNS, target="y_eff", smoothing=SMOOTHING_ROWS):
        cells = materialize(encoding_cells(train, columns, target), "encoding")
        overall = cells.agg(F.try_divide(F.sum("_total"), F.sum("_rows"))).first()[0]
        lookups = {
            c: materialize(encoding_lookup(cells, c, overall, smoothing), f"encoding-{c}") for c in columns}
        return cls(lookups, overall)

    def transform(self, df):
        """Unseen (category, month) pairs get the training mean."""
        for column, lookup in self.lookups.items():
            name = f"{column}_te"
            df = df.drop(name).join(lookup, [column, "month"], "left")
            df = df.withColumn(name, F.coalesce(F.col(name), F.lit(self.overall)))
        return df


@dataclass
class MedianFill:
    """Column medians; ``transform`` puts them where a value is missing."""

    medians: dict

    @classmethod
    def fit(cls, df, columns):
        """Medians over ``df`` of every column, whether it has gaps there or not."""
        return cls(exact_medians(df, list(columns)))

    def transform(self, df):
        present = {c: m for c, m in self.medians.items() if m is not None}
        return df if not present else df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in present.items()})


@dataclass
class Standardizer:
    """Means and population standard deviations; a constant column keeps scale 1."""

    means: dict
    scales: dict
    columns: list = field(default_factory=list)

    @classmethod
    def fit(cls, df, columns):
        columns = list(columns)
        row = df.agg(
            *[F.avg(c).alias(f"{c}|m") for c in columns],
            *[F.stddev_pop(c).alias(f"{c}|s") for c in columns]).first()
        return cls({c: row[f"{c}|m"] for c in columns}, {c: row[f"{c}|s"] or 1.0 for c in columns}, columns)

    def expression(self, column):
        return (F.col(column) - F.lit(self.means[column])) / F.lit(self.scales[column])

    def transform(self, df, suffix=""):
        return df.withColumns({f"{c}{suffix}": self.expression(c) for c in self.columns})


def column_profile(df, columns, where=None):
    """Mean, spread and range of each column, one row per column, in one pass."""
    if where is not None:
        df = df.filter(where)
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])))
    return long.groupBy("column").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std_samp"), F.stddev_pop("value").alias("std_pop"),
        F.min("value").alias("min"), F.max("value").alias("max"))


def as_frame(spark, values, name="column", value="value") -> DataFrame:
    """A fitted ``{name: number}`` as a frame."""
    rows = [(k, None if v is None else float(v)) for k, v in values.items()]
    return spark.createDataFrame(rows, f"{name} string, {value} double")
