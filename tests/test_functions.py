"""Scalar expressions."""

import datetime as dt

from pyspark.sql import functions as F

from riverflow.functions import (basename, file_tag, hist_landing_path, horizon, month_of,
                                 previous_day, quantile_at, year_of)


def test_day_file_names(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 5), "2024-03-05")], "d date, t string")
    [r] = df.select(file_tag("d").alias("f"), file_tag("t", "QmM").alias("g"),
                    hist_landing_path("d").alias("p"), basename(hist_landing_path("d")).alias("b"),
                    year_of("t").alias("y"), previous_day("d").alias("prev")).collect()
    assert r.f == "obs_elab_QmJ_2024-03-05.json"
    assert r.g == "obs_elab_QmM_2024-03-05.json"
    assert r.p == "historical/2024/obs_elab_QmJ_2024-03-05.json"
    assert r.b == r.f and r.y == 2024 and r.prev == dt.date(2024, 3, 4)


def test_month_horizon_offset(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 5, 10, 0), [3.0, 2.0, 1.0])],
                               "t timestamp, a array<double>")
    [r] = df.select(month_of("t").alias("m"), horizon("t", 24).alias("h"),
                    quantile_at("a", 0).alias("q0"), quantile_at("a", 2).alias("q2")).collect()
    assert r.m == 3 and r.h == dt.datetime(2024, 3, 4, 10, 0)
    assert (r.q0, r.q2) == (3.0, 1.0)
    assert df.select(month_of("t")).schema.fields[0].dataType.simpleString() == "bigint"
    assert df.select(F.lit(1)).count() == 1


def test_sizing_rule():
    from riverflow.session import GB, MAX_SHUFFLE_PARTITIONS, MB, TB, sizing
    small = sizing(600 * MB, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"  # two per core
    assert small["spark.sql.files.maxPartitionBytes"] == str(128 * MB)
    big = sizing(100 * TB, 8000)
    parts = int(big["spark.sql.shuffle.partitions"])
    assert parts % 8000 == 0 and parts <= MAX_SHUFFLE_PARTITIONS + 8000
    assert big["spark.sql.files.maxPartitionBytes"] == str(512 * MB)
    mid = sizing(2 * TB, 1000)
    assert int(mid["spark.sql.shuffle.partitions"]) * 200 * MB >= 1 * TB
    assert GB == 1024 * MB


def test_settings_never_override_explicit_values(spark):
    from riverflow.session import apply_sizing, configure
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "12345")
    try:
        applied = apply_sizing(spark, 10 * 1024 ** 4, 100)
        assert key not in applied and spark.conf.get(key) == "12345"
        configure(spark)
        assert spark.conf.get(key) == "12345"
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.unset(key)
        for k in applied:
            spark.conf.unset(k)
