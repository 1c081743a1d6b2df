"""Trees by pointer doubling: deep chains in few rounds, paths equal to a walk, cycles reported."""
import random

import pytest

from bazaar.operators.hierarchy import lineage, parent_cycles, tree_walk

TREE = "CategoryID long, ParentCategoryID long, CategoryName string, IsActive boolean"


def walk(nodes):
    """Level by level, in plain Python."""
    active = {i: (p, n) for i, p, n, a in nodes if a}
    found = {i: (0, n, str(i)) for i, (p, n) in active.items() if p is None}
    while True:
        new = {i: (found[p][0] + 1, found[p][1] + " > " + n, f"{found[p][2]}.{i}") for i, (p, n) in active.items() if i not in found and p in found}
        if not new:
            return sorted((i, *v) for i, v in found.items())
        found |= new


def rows(df):
    return sorted((r.CategoryID, r.Depth, r.BreadcrumbPath, r.IDPath) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_forest_equals_the_walk(spark, seed):
    rng = random.Random(seed)
    nodes = [(i, None if rng.random() < 0.05 else rng.choice([rng.randrange(max(1, i)), rng.randrange(130)]), f"n{i}", rng.random() < 0.9) for i in range(120)]
    out = tree_walk(spark.createDataFrame(nodes, TREE).repartition(4))
    assert out.columns == ["CategoryID", "ParentCategoryID", "CategoryName", "Depth", "BreadcrumbPath", "IDPath"]
    assert rows(out) == walk(nodes)


def test_chain_of_ten_thousand_in_fifteen_rounds(spark):
    n, rounds = 10_000, []
    nodes = spark.range(n).selectExpr("id AS CategoryID", "CASE WHEN id > 0 THEN id - 1 END AS ParentCategoryID", "'x' AS CategoryName", "true AS IsActive").repartition(8)
    out = lineage(nodes, "CategoryID", "ParentCategoryID", sums={"Sum": "CategoryID"}, rounds=rounds)
    assert len(rounds) <= 15
    assert out.filter("Depth <> CategoryID OR Sum <> CategoryID * (CategoryID + 1) div 2 OR RootID <> 0").count() == 0 and out.count() == n


def test_chain_with_paths_equals_the_walk(spark):
    nodes, rounds = [(i, i - 1 if i else None, f"n{i}", True) for i in range(700)], []
    assert rows(tree_walk(spark.createDataFrame(nodes, TREE).repartition(4), rounds=rounds)) == walk(nodes)
    assert len(rounds) <= 11


def test_cycles_are_reported_and_absent(spark):
    nodes = [(0, None, "root", True), (1, 0, "child", True), (2, 4, "c2", True), (3, 2, "c3", True), (4, 3, "c4", True), (5, 5, "own", True), (9, 77, "lost", True), (10, 9, "below lost", True)]
    nodes += [(100 + i, 99 + i if i else 2, f"tail{i}", True) for i in range(40)]
    df = spark.createDataFrame(nodes, TREE).repartition(3)
    assert [r[0] for r in rows(tree_walk(df))] == [0, 1]
    found = {r.CategoryID: r.OnCycle for r in parent_cycles(df, "CategoryID", "ParentCategoryID").collect()}
    assert {i for i, on in found.items() if on} == {2, 3, 4, 5} and {i for i, on in found.items() if not on} == set(range(100, 140))
    assert parent_cycles(df.filter("CategoryID < 2"), "CategoryID", "ParentCategoryID").collect() == []


def test_empty_tree(spark):
    assert tree_walk(spark.createDataFrame([], TREE)).collect() == []
