"""Operator-level behaviours not visible through the catalog queries."""

import os
import tempfile

from pyspark.sql import functions as F

from bazaar.operators.grouping import bucket_expr
from bazaar.operators.relational import exists_flag, lateral_aggregate, outer_apply_top1
from bazaar.operators.search import KeysetCursor, clamp_page, page, sort_spec
from tests import seeds
from bazaar.sources.tables import read_table


def test_document_collection_scan_is_typed(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="bazaar-docs-"), "reviews")
    seeds.reviews(spark).write.json(path)
    df = read_table(spark, path, "reviews", fmt="json")
    assert dict(df.dtypes)["tags"] == "array<string>" and dict(df.dtypes)["created_at"] == "timestamp_ntz"
    assert df.filter(F.array_contains("tags", "durable")).count() == 1


def test_sort_whitelist_and_page_clamps(spark):
    assert clamp_page(0, 0) == (1, 25) and clamp_page(3, 1000) == (3, 500) and clamp_page(None, None) == (1, 25)
    df = spark.createDataFrame([(i, i % 3, float(i)) for i in range(10)], "OrderID int, CustomerID int, TotalAmount double")
    got = [r.OrderID for r in page(df, sort_spec("TotalAmount", "asc", "OrderID"), 2, 3).collect()]
    assert got == [3, 4, 5]
    spec = sort_spec("DROP TABLE", "sideways", "OrderID")
    assert "PlacedAt" in str(spec[0]) and "DESC" in str(spec[0]).upper()


def test_keyset_pagination(spark):
    df = spark.createDataFrame([(i, 100 - (i // 2)) for i in range(10)], "OrderID int, TotalAmount int")
    cur = KeysetCursor("TotalAmount", "OrderID", descending=True)
    p1 = cur.next_page(df, None, None, 3).collect()
    last = p1[-1]
    p2 = cur.next_page(df, last.TotalAmount, last.OrderID, 3).collect()
    offset_pages = [r.OrderID for r in df.orderBy(F.col("TotalAmount").desc(), "OrderID").collect()]
    assert [r.OrderID for r in p1 + p2] == offset_pages[:6]


def test_bucket_default_both_sides(spark):
    df = spark.createDataFrame([(-1,), (0,), (4,), (5,), (99,), (100,), (250,)], "v int")
    got = [r.b for r in df.select(bucket_expr(F.col("v"), [0, 5, 10, 25, 50, 100], "100+").alias("b")).collect()]
    assert got == ["100+", "0", "0", "5", "50", "100+", "100+"]


def test_apply_forms(spark):
    outer = spark.createDataFrame([(1,), (2,)], "k int")
    inner = spark.createDataFrame([(1, 10.0), (1, 5.0)], "k int, v double")
    la = {r.k: (r.n, r.s) for r in lateral_aggregate(outer, inner, "k", [F.count(F.lit(1)).alias("n"),
                                                                          F.sum("v").alias("s")],
                                                     zero_fill={"n": 0}).collect()}
    assert la == {1: (2, 15.0), 2: (0, None)}
    assert {r.k: r.hit for r in exists_flag(outer, inner, "k", "hit").collect()} == {1: 1, 2: 0}
    none = outer_apply_top1(outer, inner.filter("v > 100").select(F.col("v").alias("best")), [F.col("best").desc()])
    assert [r.best for r in none.collect()] == [None, None]
