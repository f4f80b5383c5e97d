import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillcast.constants import SERIES_KEYS
from tillcast.schemas import PANEL, MissingColumns
from tillcast.session import materialize, shared_dir, shared_path
from tillcast.sources import panel, sinks
from tillcast.sources.tables import hourly_panel, sales_panel

ROW = [(1, 2, 3, 4, None, float("nan"), [0.0] * 24, [0] * 24, 0, 0.1, 0, 0, 0.0, 1.0, 2.0, 3.0)]


def test_splits_prefer_eval_then_validation(spark):
    df = spark.createDataFrame(ROW, PANEL).withColumn("dt", F.lit("2024-01-05").cast("date"))
    base = shared_path(spark, "splits")
    df.write.parquet(f"{base}/train")
    train, held = panel.read_splits(spark, base)
    assert train.first()["sale_amount"] is None and held is None
    df.write.parquet(f"{base}/validation")
    assert panel.read_splits(spark, base)[1].count() == 1
    df.union(df).write.parquet(f"{base}/eval")
    assert panel.read_splits(spark, base)[1].count() == 2


def test_panel_in_the_types_of_the_file(spark):
    df = spark.createDataFrame(ROW, PANEL).withColumns({
        "dt": F.lit("2024-01-05"), "holiday_flag": F.lit(1).cast("long"), "hours_stock_status": F.col("hours_stock_status").cast("array<long>"),
        "extra": F.lit("x")})
    path = shared_path(spark, "text-days")
    df.write.parquet(path)
    back = panel.read_panel(spark, path)
    assert back.schema.names == [*PANEL.names, "extra"]
    assert [f.dataType for f in back.schema.fields][:len(PANEL)] == [f.dataType for f in PANEL.fields]
    assert back.first()["dt"] == dt.date(2024, 1, 5) and back.first()["holiday_flag"] == 1
    df.drop("dt").write.parquet(f"{path}-cut")
    with pytest.raises(MissingColumns):
        panel.read_panel(spark, f"{path}-cut")


def test_a_cluster_must_name_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_first_readable_path_wins(spark):
    base = shared_path(spark, "candidates")
    with pytest.raises(FileNotFoundError):
        panel.read_recovered(spark, [f"{base}/a", f"{base}/b"])
    df = spark.createDataFrame([(1, "2024-01-01", 2.0)], "store_id int, dt string, sale_amount_pred double")
    df.write.parquet(f"{base}/b/demand.parquet")
    assert panel.read_recovered(spark, [f"{base}/a", f"{base}/b/demand.parquet"]).count() == 1
    df.drop("sale_amount_pred").write.parquet(f"{base}/c")
    with pytest.raises(MissingColumns):
        panel.read_recovered(spark, [f"{base}/c"])


def test_written_panel_prunes_by_city(spark, small):
    path = shared_path(spark, "panel")
    frame = sales_panel(spark, small)
    sinks.write_panel(frame, path, partition_by="city_id")
    back = spark.read.parquet(path)
    assert back.count() == frame.count()
    plan = back.filter("city_id = 3 and dt >= date'2000-01-01'").select("sale_amount")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters: [isnotnull(city_id" in plan and "GreaterThanOrEqual(dt" in plan
    assert "discount" not in plan


def test_hour_arrays_and_panels(spark, small):
    hours = hourly_panel(spark, small)
    assert panel.check_hour_arrays(hours).count() == 0
    broken = hours.withColumn("hours_sale", F.array(F.lit(1.0)))
    assert panel.check_hour_arrays(broken).count() == hours.count()
    assert panel.series_density(hours).filter("not dense").count() == 0
    daily = sales_panel(spark, small)
    assert daily.groupBy(*SERIES_KEYS, "dt").count().filter("count > 1").count() == 0


def test_materialize_uses_the_shared_folder(spark):
    frame = materialize(spark.range(5), "numbers")
    assert all(shared_dir(spark).split("/")[-1] in f for f in frame.inputFiles())
    assert frame.count() == 5


def test_union_fills_absent_columns(spark):
    a = spark.createDataFrame([("x", 1.0)], "model string, rho_ds double")
    both = panel.union_all([a, a.drop("rho_ds")])
    assert sorted((r["rho_ds"] is None) for r in both.collect()) == [False, True]


def test_a_panel_in_folders_is_sorted_once(spark):
    rows = [(s, p, d % 3, dt.date(2024, 1, 1) + dt.timedelta(days=(d * 7) % 50)) for s in range(6) for p in range(3) for d in range(50)]
    frame = spark.createDataFrame(rows, "store_id long, product_id long, city_id int, dt date").repartition(1)
    path = shared_path(spark, "sorted")
    sinks.write_panel(frame, path, partition_by="city_id")
    for city in range(3):
        got = [tuple(r) for r in spark.read.parquet(f"{path}/city_id={city}").coalesce(1).select("store_id", "product_id", "dt").collect()]
        assert len(got) > 100 and got == sorted(got)
