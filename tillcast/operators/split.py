"""Temporal split, recency weights and evaluation masks."""

from pyspark.sql import functions as F

from tillcast.constants import (
    DATE, MID_DAYS, MID_WEIGHT, OLD_WEIGHT, RECENT_DAYS, RECENT_WEIGHT, TEST_DAYS, VAL_DAYS,
)
from tillcast.functions.calendar import as_day


def last_day(df, date=DATE):
    """The panel's last day as a scalar subquery: evaluated once, no join, no collect."""
    return df.select(F.max(date)).scalar()


def with_age(df, max_date=None, date=DATE, name="_age"):
    """Days between a row and the panel's last day, or ``max_date`` (a value or a column)."""
    end = as_day(max_date) if max_date is not None else last_day(df, date)
    return df.withColumn(name, F.datediff(end, F.col(date)))


def add_split(df, test_days=TEST_DAYS, val_days=VAL_DAYS, max_date=None, date=DATE):
    """Label rows ``train``, ``val`` or ``test``; one frame instead of three copies."""
    age = F.col("_age")
    label = F.when(age < test_days, "test").when(age < test_days + val_days, "val")
    return with_age(df, max_date, date).withColumn("split", label.otherwise("train")).drop("_age")


def add_weights(df, max_date=None, date=DATE):
    """Age of a row in days and its training weight."""
    age = F.col("days_ago")
    weight = F.when(age <= RECENT_DAYS, RECENT_WEIGHT).when(age <= MID_DAYS, MID_WEIGHT)
    return with_age(df, max_date, date, "days_ago").withColumn("sample_weight", weight.otherwise(OLD_WEIGHT))


def part(df, name):
    return df.filter(F.col("split") == name)


def add_eval_target(df, observed="sale_amount"):
    """Observed sales on days in stock; NULL on stockout days, whose sales are cut short."""
    return df.withColumn("eval_target", F.when(F.col("is_stockout") == 0, F.col(observed)))


def valid_rows(df, columns):
    """Rows with a value in every column."""
    return df.dropna(subset=list(columns))
