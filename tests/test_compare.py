"""Equality of tables by order-independent digests."""
import pytest

from bazaar.operators.quality import compare_by_range, differing_rows

ROWS = "k long, v string, w decimal(10,2)"


def frame(spark, rows):
    return spark.createDataFrame([(k, v, float(w) if w is not None else None) for k, v, w in rows], "k long, v string, w double").selectExpr("k", "v", "CAST(w AS decimal(10,2)) AS w").repartition(4)


BASE = [(i % 40, f"v{i % 7}" if i % 5 else None, i % 3) for i in range(200)] + [(None, "n", 1), (None, "n", 1)]


def test_equal_in_any_order(spark):
    out = compare_by_range(frame(spark, BASE), frame(spark, BASE[::-1]).selectExpr("w", "v", "k"), "k", 10).collect()
    assert sorted(str(r["range"]) for r in out) == ["0", "1", "2", "3", "None"] and all(r["equal"] for r in out)


@pytest.mark.parametrize("change", ["value", "null", "copy", "moved", "one less, one more"])
def test_planted_changes_show_in_their_range(spark, change):
    other = list(BASE)
    if change == "value":
        other[15] = (15, "changed", other[15][2])
    elif change == "null":
        other[15] = (15, None, other[15][2]) if other[15][1] else (15, "", other[15][2])
    elif change == "copy":
        other.append(other[15])
    elif change == "moved":
        other[15], other[16] = (15, other[16][1], other[15][2]), (16, other[15][1], other[16][2])
    else:
        other[15], other[56] = other[55], other[16]
    a, b = frame(spark, BASE), frame(spark, other)
    bad = {r["range"] for r in compare_by_range(a, b, "k", 10).collect() if not r["equal"]}
    want = a.exceptAll(b).count() + b.exceptAll(a).count()
    assert differing_rows(a, b, "k", 10).count() == want and bad == ({1} if want else set())


def test_rows_are_not_moved(spark):
    plan = compare_by_range(frame(spark, BASE), frame(spark, BASE), "k", 10)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning(range") == 1


def test_empty(spark):
    a = frame(spark, BASE)
    assert compare_by_range(a.limit(0), a.limit(0), "k", 10).collect() == []
    assert not any(r["equal"] for r in compare_by_range(a, a.limit(0), "k", 10).collect())


def test_differing_rows_makes_each_side_twice_only(spark):
    """Once for the digests and once for the rows; exact counts of copies, of both sides and with nulls."""
    a, b = frame(spark, [*BASE, *BASE[:2]]), frame(spark, BASE[1:])
    got = sorted(map(tuple, differing_rows(a, b, "k", 10).collect()), key=str)
    want = sorted(map(tuple, a.exceptAll(b).selectExpr("*", "'left_only'").union(b.exceptAll(a).selectExpr("*", "'right_only'")).collect()), key=str)
    assert got == want and got
    plan = differing_rows(a, b, "k", 10)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") <= 4
