"""Scalar semantics that differ between T-SQL and Spark (M1, M2, M3, M5)."""

import datetime as dt

from pyspark.sql import functions as F

from bazaar.functions.expr import boundary_diff, concat_null_safe, concat_plus, exact_avg


def test_boundary_diff_counts_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 31, 23, 59, 30), dt.datetime(2024, 2, 1, 0, 0, 10))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(*[boundary_diff(u, F.col("a"), F.col("b")).alias(u) for u in
                    ("MINUTE", "HOUR", "DAY", "MONTH", "YEAR")]).first()
    assert (r.MINUTE, r.HOUR, r.DAY, r.MONTH, r.YEAR) == (1, 1, 1, 1, 0)
    back = df.select(boundary_diff("MINUTE", F.col("b"), F.col("a")).alias("m")).first().m
    assert back == -1


def test_concat_null_semantics(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    r = df.select(concat_null_safe("x", "y").alias("safe"), concat_plus("x", "y").alias("plus")).first()
    assert r.safe == "a" and r.plus is None


def test_exact_avg_and_rounding(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "v int")
    r = df.agg(exact_avg("v").alias("a"), F.round(F.lit(2.5), 0).alias("up"), F.bround(F.lit(2.5), 0).alias("even")).first()
    assert abs(r.a - 5 / 3) < 1e-15 and r.up == 3.0 and r.even == 2.0
