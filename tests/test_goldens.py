"""Golden fixtures: the reference's literal seeds and their expected outputs (FIXTURES.md §3)."""

from decimal import Decimal

from pyspark.sql import functions as F

from bazaar.plans import docpipes as M
from bazaar.plans import normalise as N
from bazaar.operators import quality as Q
from tests import seeds


def test_m1q_review_summary(spark):
    rows = {r["product_id"]: r for r in M.review_summary(seeds.reviews(spark)).collect()}
    p1, p2 = rows[1], rows[2]
    assert (p1.total_reviews, p1.avg_rating, p1.positive_rate, p1.total_helpful) == (2, 4.5, 100.0, 21)
    assert p1.rating_distribution.asDict() == {"five": 1, "four": 1, "three": 0, "two": 0, "one": 0}
    assert (p2.total_reviews, p2.avg_rating, p2.positive_rate, p2.total_helpful) == (1, 3.0, 0.0, 22)
    assert p2.rating_distribution.three == 1
    tags = {}
    for r in M.review_tag_frequency(seeds.reviews(spark)).collect():
        tags[r.product_id] = tags.get(r.product_id, 0) + r.occurrences
    assert tags == {1: 5, 2: 2}  # flattened tag lists: 5 tags for product 1, 2 for product 2
    # sorted by review volume
    assert M.review_summary(seeds.reviews(spark)).first().product_id == 1


def test_m2q_review_facets(spark):
    parts = M.review_facet_parts(seeds.reviews(spark), "2024-06-01 00:00:00")
    o = parts["overall"].first()
    assert (o.total, o.avg_rating, o.most_helpful) == (3, 4.0, 22)
    assert [(r.stars, r["count"]) for r in parts["by_rating"].collect()] == [(5, 1), (4, 1), (3, 1)]
    assert parts["recent"].count() == 0  # $count over an empty stream emits no document (M16)
    recent = M.review_facet_parts(seeds.reviews(spark), "2024-02-10 00:00:00")["recent"].collect()
    assert [r.count_last_30_days for r in recent] == [3]
    buckets = {r["_id"]: (r["count"], r["avg_rating"]) for r in parts["helpfulness_buckets"].collect()}
    assert buckets == {"5": (1, 4.0), "10": (2, 4.0)}
    from bazaar.operators.grouping import facet_document
    doc = facet_document(parts).first().facets
    assert set(doc) == {"overall", "by_rating", "helpfulness_buckets"}  # empty $count facet has no document
    assert len(doc["by_rating"]) == 3 and '"total":3' in doc["overall"][0]


def test_m3q_reviews_with_events(spark):
    out = M.reviews_with_events(seeds.reviews(spark), seeds.product_events(spark)).collect()
    assert [(r.product_id, r.customer_id, r.rating, r.view_count, r.days_to_purchase) for r in out] == [
        (1, 2, 4, 2, 0.0), (1, 1, 5, 1, 0.0)]


def test_m4q_funnel(spark):
    out = M.funnel(seeds.product_events(spark), product_id=1).collect()
    assert [(r.stage, r.customers) for r in out] == [("ADDED_TO_CART", 1), ("PURCHASED", 2)]


def test_m5q_geo_near(spark):
    out = M.pickup_points_near(seeds.vendor_locations(spark), 28.0473, -26.2041, 15000.0).collect()
    assert len(out) == 1 and out[0].vendor_name == "SoleStore" and out[0].distance_km == 10.78
    assert abs(out[0].distance_meters - 10783.25) < 0.01


def test_m6q_text_search(spark):
    out = M.review_text_search(seeds.reviews(spark), "size sizing small large fit").collect()
    assert [(r.product_id, r.customer_id) for r in out] == [(2, 1), (1, 1)]


def test_m7q_basic_queries(spark):
    low = M.low_rated_reviews(seeds.reviews(spark)).collect()
    assert [(r.product_id, r.customer_id, r.rating) for r in low] == [(2, 1, 3)]
    counts = {r["_id"]: (r["count"], r["avg"]) for r in M.review_count_by_product(seeds.reviews(spark)).collect()}
    assert counts[1][0] == 3 and abs(counts[1][1] - 11 / 3) < 1e-12 and counts[2] == (1, 3.0)
    newest = [r.created_at.month for r in M.reviews_newest_first(seeds.reviews(spark)).collect()]
    assert newest[0] == 2


def test_n1_unf_to_1nf(spark):
    onf = N.to_1nf(seeds.unf_orders(spark)).orderBy("OrderID", "LineNum").collect()
    assert [(r.OrderID, r.LineNum, r.ProductName, r.UnitPrice, r.Quantity) for r in onf] == [
        (1001, 1, "Air Max 90", Decimal("1299.00"), 2), (1001, 2, "Running Top", Decimal("449.00"), 1),
        (1002, 1, "Air Max 90", Decimal("1299.00"), 1)]


def test_n4_reconstruction_is_lossless(spark):
    onf = N.to_1nf(seeds.unf_orders(spark))
    o2, l2 = N.to_2nf(onf, seeds.product_category(spark))
    nf3 = N.to_3nf(o2, l2)
    rec = N.reconstruct(nf3).orderBy("OrderID", "LineNum").collect()
    assert [(r.OrderID, r.ProductName, r.Category, r.Quantity, r.UnitPrice, r.LineTotal) for r in rec] == [
        (1001, "Air Max 90", "Shoes", 2, Decimal("1299.00"), Decimal("2598.00")),
        (1001, "Running Top", "Clothing", 1, Decimal("449.00"), Decimal("449.00")),
        (1002, "Air Max 90", "Shoes", 1, Decimal("1299.00"), Decimal("1299.00"))]
    expected = onf.join(seeds.product_category(spark), "ProductName").select(
        "OrderID", "LineNum", "CustomerName", "CustomerEmail", "CustomerCity", "ProductName", "Category", "Quantity",
        "UnitPrice", (F.col("Quantity") * F.col("UnitPrice")).alias("LineTotal"))
    assert N.lossless_diff(N.reconstruct(nf3), expected).count() == 0
    assert N.fd_violations(onf, ["ProductName"], "UnitPrice").count() == 0


def test_q5_null_count(spark):
    r = Q.null_counts(N.to_1nf(seeds.unf_orders(spark)), ["ProductName", "UnitPrice", "Quantity"]).first()
    assert r.rows_with_nulls == 0
