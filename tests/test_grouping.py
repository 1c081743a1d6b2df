"""Exact distinct counts over grouping sets by merged bitmaps and pairs."""
import random

import pytest
from pyspark.sql import functions as F

from bazaar.operators import grouping
from bazaar.operators.grouping import cube_distinct
from bazaar.plans.catalog import load_all
from tests.conftest import SF_SMALL

ROWS = "a string, b long, c string, id long, v decimal(12,2)"


def rows(n=3000):
    rng = random.Random(5)
    return [(rng.choice(["x", "y", None]), rng.choice([1, 1, 1, 2, None]), rng.choice("pqrs"), rng.choice([None, 7, rng.randrange(200), rng.randrange(200_000), -rng.randrange(40_000)]), rng.randrange(1000) / 100) for _ in range(n)]


@pytest.mark.parametrize("dense", [1, 40, 10**9])
def test_equals_plain_cube(spark, monkeypatch, dense):
    """The same whether all sets are bitmaps, some, or none."""
    monkeypatch.setattr(grouping, "DENSE", dense)
    df = spark.createDataFrame([(a, b, c, i, v) for a, b, c, i, v in rows()], "a string, b long, c string, id long, v double").withColumn("v", F.col("v").cast("decimal(12,2)")).repartition(6)
    got = cube_distinct(df, ["a", "b", "c"], "id", "n", {"s": "v"})
    want = df.cube("a", "b", "c").agg(F.sum("v").alias("s"), F.count_distinct("id").alias("n"), F.grouping("a").alias("_g_a"), F.grouping("b").alias("_g_b"), F.grouping("c").alias("_g_c"))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, got.select(want.columns).collect())) == sorted(map(key, want.collect()))


def test_chosen_sets_and_empty_input(spark):
    df = spark.createDataFrame([], "a string, b long, id long")
    assert cube_distinct(df, ["a", "b"], "id", "n").collect() == []
    df = spark.createDataFrame([("x", 1, 5), ("x", 2, 5), ("y", 1, 6)], "a string, b long, id long")
    got = cube_distinct(df, ["a", "b"], "id", "n", sets=[("a",), ()])
    assert sorted((r.a or "", r.n) for r in got.collect()) == [("", 2), ("x", 1), ("y", 1)]


def test_cube_has_no_expand(spark):
    plan = load_all()["x9_province_category_vendor_cube"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "bitmap" in plan.lower()
