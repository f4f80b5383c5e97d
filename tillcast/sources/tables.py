"""Panels derived from order lines and from an event log."""

from pyspark.sql import functions as F

from tillcast.constants import CLOSE_HOUR, HOURS_PER_DAY, OPEN_HOUR
from tillcast.session import materialize
from tillcast.sources.panel import with_series_columns


def read_table(spark, base, name):
    return spark.read.parquet(f"{base}/{name}.parquet")


def weather_columns(date):
    """Covariates that follow from the date alone."""
    doy = F.dayofyear(date)
    return {
        "holiday_flag": F.dayofmonth(date).isin(1, 15).cast("int"),
        "precpt": F.pmod(doy * 7, F.lit(10)) / F.lit(10.0),
        "avg_temperature": F.lit(10.0) + F.pmod(doy, F.lit(20)),
        "avg_humidity": F.lit(60.0) + F.pmod(doy, F.lit(30)),
        "avg_wind_level": F.pmod(doy, F.lit(5)).cast("double"),
    }


def sales_panel(spark, base):
    """Daily sales of each supplier (store) and part type (product).

    A row exists for each day with sales. Returned lines stand for stockout hours.
    The join sides carry no hint: the planner broadcasts a side only if its size,
    known from the files, is below the session's limit.
    """
    lines = read_table(spark, base, "lineitem").select(
        "l_suppkey", "l_partkey", "l_quantity", "l_discount", "l_returnflag", "l_shipdate")
    parts = read_table(spark, base, "part").select("p_partkey", "p_type")
    suppliers = read_table(spark, base, "supplier").select("s_suppkey", "s_nationkey")
    daily = (
        lines.join(parts, lines.l_partkey == parts.p_partkey)
        .groupBy(F.col("l_suppkey").alias("store_id"), F.col("p_type").alias("product_id"),
                 F.to_date("l_shipdate").alias("dt"))
        .agg(F.sum("l_quantity").alias("sale_amount"),
             F.round(F.avg("l_discount"), 6).alias("discount"),
             F.least(F.lit(16), 4 * F.count_if(F.col("l_returnflag") == "R")).cast("int")
             .alias("stock_hour6_22_cnt"))
    )
    placed = daily.join(suppliers, daily.store_id == suppliers.s_suppkey)
    panel = placed.select(
        "store_id", "product_id", F.col("s_nationkey").cast("int").alias("city_id"),
        F.col("product_id").alias("first_category_id"), "dt", "sale_amount", "discount",
        "stock_hour6_22_cnt",
        (F.col("discount") > 0.05).cast("int").alias("activity_flag"),
        (F.col("sale_amount") * (1 + F.col("stock_hour6_22_cnt") / F.lit(16.0))).alias("sale_amount_pred"),
        *[c.alias(n) for n, c in weather_columns(F.col("dt")).items()],
    )
    return with_series_columns(panel)


def sales_span(spark, base):
    """First and last day of the order lines, as subqueries over one column without a join."""
    days = read_table(spark, base, "lineitem").select(
        F.to_date(F.min("l_shipdate")).alias("first"), F.to_date(F.max("l_shipdate")).alias("last"))
    return days.select("first").scalar(), days.select("last").scalar()


def hourly_panel(spark, base, users_per_store=30):
    """Hourly sales vectors of each user group (store) and event type (product).

    An hour is a stockout when most of the store's events in it are errors.
    ``truth_hours`` keeps the sales before censoring, to score imputers. The events are
    read once, into a written table of hour arrays per store, type and day, from which
    status, sales and the days all follow.
    """
    events = read_table(spark, base, "events").select(
        F.floor(F.col("user_id") / users_per_store).alias("store_id"),
        F.col("event_type"), F.to_date("ts").alias("dt"), F.hour("ts").alias("h"), "value")
    hours = range(HOURS_PER_DAY)
    is_error = F.col("event_type") == "error"
    hourly = events.groupBy("store_id", "event_type", "dt", "h").agg(
        F.count("*").alias("n"), F.round(F.coalesce(F.sum("value"), F.lit(0.0)), 2).alias("x"))
    by_hour = F.map_from_entries(F.collect_list(F.struct("h", F.struct("n", "x"))))      # at most one entry per hour
    known = hourly.where("h is not null").groupBy("store_id", "event_type", "dt").agg(by_hour.alias("known"))
    hour = F.sequence(F.lit(0), F.lit(HOURS_PER_DAY - 1))
    cells = materialize(known.select(
        "store_id", "event_type", "dt",
        F.transform(hour, lambda h: F.coalesce(F.col("known")[h]["n"], F.lit(0))).alias("n_events"),
        F.transform(hour, lambda h: F.coalesce(F.col("known")[h]["x"], F.lit(0.0))).alias("truth_hours")), "hours")
    number = lambda h: F.get("n_events", F.lit(h))
    status = cells.groupBy("store_id", "dt").agg(F.array(*[
        (2 * F.sum(F.when(is_error, number(h)).otherwise(0)) > F.sum(number(h))).cast("int")
        for h in hours]).alias("hours_stock_status"))
    sales = cells.filter(~is_error).select("store_id", F.col("event_type").alias("product_id"), "dt", "truth_hours")
    days = F.sequence(cells.select(F.min("dt")).scalar(), cells.select(F.max("dt")).scalar(),
                      F.expr("interval 1 day"))
    grid = sales.select("store_id", "product_id").distinct().withColumn("dt", F.explode(days))
    no_sales = F.array_repeat(F.lit(0.0), HOURS_PER_DAY)
    in_stock = F.array_repeat(F.lit(0), HOURS_PER_DAY)
    filled = (
        grid.join(sales, ["store_id", "product_id", "dt"], "left")
        .join(status, ["store_id", "dt"], "left")
        .withColumns({
            "truth_hours": F.coalesce("truth_hours", no_sales),
            "hours_stock_status": F.coalesce("hours_stock_status", in_stock),
        })
    )
    censored = F.zip_with("truth_hours", "hours_stock_status",
                          lambda x, s: F.when(s == 1, F.lit(0.0)).otherwise(x))
    open_hours = F.slice("hours_stock_status", OPEN_HOUR + 1, CLOSE_HOUR - OPEN_HOUR)
    return (
        filled.withColumn("hours_sale", censored)
        .withColumns({
            "sale_amount": F.aggregate("hours_sale", F.lit(0.0), lambda a, x: a + x),
            "stock_hour6_22_cnt": F.aggregate(open_hours, F.lit(0), lambda a, s: a + s),
            "city_id": F.lit(0),
            "discount": F.pmod(F.dayofmonth("dt"), F.lit(11)) / F.lit(100.0),
            **weather_columns(F.col("dt")),
        })
    )
