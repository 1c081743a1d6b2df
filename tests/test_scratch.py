"""What the normalisation jobs put on disk: tables kept once, lines shuffled once for an order, rows shuffled for differing keys only."""
import os

import pytest

from bazaar.operators.quality import differing_rows
from bazaar.plans import normalise as N
from bazaar.session import scratch
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def left_over(spark):
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    return [x for x in os.listdir(folder) if x.startswith("scratch-")]


def test_only_rows_of_differing_keys_are_shuffled(spark):
    a = spark.range(20_000).selectExpr("id % 5000 AS k", "CAST(id AS string) AS v", "id % 7 AS w").repartition(4)
    b = a.selectExpr("k", "v", "IF(k = 123, w + 1, w) AS w").repartition(3)
    out = differing_rows(a, b, "k", 1000)
    shown = plan(out)
    assert "SortMergeJoin" not in shown and shown.count("Exchange hashpartitioning") == 1
    got = sorted(map(tuple, out.collect()))
    assert len(got) == 8 and {r[0] for r in got} == {123}
    want = a.exceptAll(b).selectExpr("*", "'left_only'").union(b.exceptAll(a).selectExpr("*", "'right_only'"))
    assert got == sorted(map(tuple, want.collect()))


def test_all_rows_differ(spark):
    a = spark.range(3000).selectExpr("id % 1500 AS k", "CAST(id AS string) AS v")
    out = differing_rows(a, a.selectExpr("k", "concat(v, 'x') AS v"), "k", 100)
    assert out.groupBy("_side").count().collect() and out.count() == 6000


def lines(spark):
    rows = [(1, 1, 10, 1.0, 2), (1, 2, 99, 1.0, 2), (1, 3, 20, 3.0, 4), (2, 1, 20, 3.0, 1)]
    return spark.createDataFrame(rows, "OrderID long, LineNumber int, ProductID long, UnitPrice double, Quantity int")


def test_lines_are_shuffled_once_for_their_order(spark):
    """No more than once with the order as key, and numbered as in the SQL: after the join with the products."""
    products = spark.createDataFrame([(10, "a"), (20, "b")], "ProductID long, ProductName string")
    wide = N.wide_orders_from_lines(lines(spark), products)
    assert plan(wide).count("Exchange hashpartitioning(OrderID") == 1
    got = sorted((r.OrderID, r.LineNum, r.ProductName) for r in N.to_1nf(wide).collect())
    assert got == [(1, 1, "a"), (1, 2, "b"), (2, 1, "b")]


@pytest.mark.parametrize("name", ["n4b_equal_by_range", "n4c_differing_rows"])
def test_1nf_lines_are_made_once_and_no_file_stays(spark, monkeypatch, name):
    from bazaar.plans.catalog import load_all
    made, make = [], N.wide_orders_from_lines
    monkeypatch.setattr(N, "wide_orders_from_lines", lambda *a: made.append(1) or make(*a))
    before = left_over(spark)
    assert load_all()[name](spark, SF_SMALL).count() and len(made) == 1
    assert left_over(spark) == before


def test_scratch_is_removed_after_an_error(spark):
    before = left_over(spark)
    with pytest.raises(ZeroDivisionError), scratch(spark) as keep:
        assert keep(spark.range(5), "five").count() == 5 and len(left_over(spark)) == len(before) + 1
        1 / 0
    assert left_over(spark) == before
