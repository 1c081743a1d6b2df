"""Relations from functional dependencies: closure, cover, synthesis, split and the way back."""
import itertools
import random

import pytest

from bazaar.operators.dependencies import Relation, candidate_key, closure, key_violations, minimal_cover, rejoin, split, synthesise

ORDERS = [(("OrderID",), ("Customer", "Day")), (("Customer",), ("City",)), (("City",), ("Province",)), (("OrderID", "Line"), ("Product", "Qty", "Day")), (("Product",), ("Category",))]
COLUMNS = ("OrderID", "Line", "Customer", "Day", "City", "Province", "Product", "Qty", "Category")


def test_textbook_case():
    assert closure(("OrderID",), ORDERS) == {"OrderID", "Customer", "Day", "City", "Province"}
    assert candidate_key(COLUMNS, ORDERS) == ("OrderID", "Line")
    assert synthesise(COLUMNS, ORDERS) == [Relation(("OrderID",), ("OrderID", "Customer", "Day")), Relation(("Customer",), ("Customer", "City")), Relation(("City",), ("City", "Province")),
                                          Relation(("OrderID", "Line"), ("OrderID", "Line", "Product", "Qty")), Relation(("Product",), ("Product", "Category"))]


def test_equal_keys_share_a_relation_and_a_key_is_added():
    assert synthesise("abc", [(("a",), ("b",)), (("b",), ("a",))]) == [Relation(("a",), ("a", "b")), Relation(("b", "c"), ("b", "c"))] or \
        synthesise("abc", [(("a",), ("b",)), (("b",), ("a",))]) == [Relation(("a",), ("a", "b")), Relation(("a", "c"), ("a", "c"))]
    assert synthesise("ab", []) == [Relation(("a", "b"), ("a", "b"))]
    with pytest.raises(ValueError):
        synthesise("ab", [(("a",), ("x",))])


def _closure_plain(columns, deps):
    known = set(columns)
    for _ in range(20):
        known |= {c for left, right in deps if set(left) <= known for c in right}
    return known


@pytest.mark.parametrize("seed", range(40))
def test_random_dependencies(seed):
    """The cover says the same as the dependencies; every relation is in 3NF; all dependencies can be checked in one relation."""
    rng = random.Random(seed)
    cols = "abcdef"
    deps = [(tuple(rng.sample(cols, rng.randint(1, 3))), tuple(rng.sample(cols, rng.randint(1, 2)))) for _ in range(rng.randint(1, 6))]
    cover = [(left, (c,)) for left, c in minimal_cover(deps)]
    for n in (1, 2, 3):
        for x in itertools.combinations(cols, n):
            assert closure(x, deps) == _closure_plain(x, deps) == _closure_plain(x, cover)
    relations = synthesise(cols, deps)
    assert {c for r in relations for c in r.columns} == set(cols)
    assert any(_closure_plain(r.columns, deps) >= set(cols) for r in relations)
    for left, right in cover:
        assert any(set(left) | set(right) <= set(r.columns) for r in relations)
    for r in relations:
        assert _closure_plain(r.key, deps) >= set(r.columns)


def test_split_and_back(spark):
    rng = random.Random(1)
    rows = []
    for o in range(60):
        c = rng.randrange(12)
        for n in range(rng.randint(1, 4)):
            p = rng.randrange(15)
            rows.append((o, n, f"c{c}" if c else None, o % 7, c % 5, c % 5 % 2, f"p{p}", rng.randrange(9), p % 3))
    df = spark.createDataFrame(rows, COLUMNS).repartition(4)
    relations = synthesise(COLUMNS, ORDERS)
    parts = split(df, relations)
    assert all(v.count() == 0 for v in key_violations(parts, relations))
    back = rejoin(parts, relations, ORDERS).select(*COLUMNS)
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    dirty = df.unionByName(df.limit(1).selectExpr("OrderID", "Line + 50 AS Line", "Customer", "Day + 1 AS Day", "City", "Province", "Product", "Qty", "Category"))
    assert [v.count() for v in key_violations(split(dirty, relations), relations)] == [1, 0, 0, 0, 0]
