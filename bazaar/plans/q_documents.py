"""Catalog entries for the document pipelines M1q–M7q, geo (D1), text (D2) and retention.

Nested outputs are compared on flattened fields: struct members become columns, tag arrays are
sorted and joined (element order is not part of the result's meaning)."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaar.plans import docpipes as M
from bazaar.plans.catalog import query

C = F.col
JOHANNESBURG = (28.0473, -26.2041)  # fixed value: the query centre (lon, lat)


# ----------------------------------------------------------------------------- M1q
M1_SQL = """
SELECT product_id, CAST(count(*) AS BIGINT) AS total_reviews, round_even(avg(rating), 1) AS avg_rating,
  round_even(CAST(sum(CASE WHEN rating = 5 THEN 1 ELSE 0 END) + sum(CASE WHEN rating = 4 THEN 1 ELSE 0 END) AS DOUBLE)
             / CAST(count(*) AS DOUBLE) * 100, 1) AS positive_rate,
  CAST(sum(helpful_votes) AS BIGINT) AS total_helpful,
  CAST(sum(CASE WHEN rating = 5 THEN 1 ELSE 0 END) AS BIGINT) AS rating_five,
  CAST(sum(CASE WHEN rating = 4 THEN 1 ELSE 0 END) AS BIGINT) AS rating_four,
  CAST(sum(CASE WHEN rating = 3 THEN 1 ELSE 0 END) AS BIGINT) AS rating_three,
  CAST(sum(CASE WHEN rating = 2 THEN 1 ELSE 0 END) AS BIGINT) AS rating_two,
  CAST(sum(CASE WHEN rating = 1 THEN 1 ELSE 0 END) AS BIGINT) AS rating_one
FROM b_review_doc WHERE is_approved GROUP BY product_id
"""


@query("m1q_review_summary", M1_SQL)
def m1(c):
    """M1q review summary per product: counts, half-even rounded averages, star distribution."""
    s = M.review_summary(c.review_docs())
    return s.select("product_id", "total_reviews", "avg_rating", "positive_rate", "total_helpful",
                    *[C(f"rating_distribution.{n}").alias(f"rating_{n}") for n, _ in M.STAR_FIELDS])


G13_SQL = """
SELECT product_id, tag, CAST(count(*) AS BIGINT) AS occurrences
FROM (SELECT product_id, unnest(tags) AS tag FROM b_review_doc WHERE is_approved) GROUP BY product_id, tag
"""


@query("g13_review_tag_frequency", G13_SQL)
def g13(c):
    """G13 / B24 flattened review tags counted per (product, tag) — explode + group, no big arrays."""
    return M.review_tag_frequency(c.review_docs())


# ----------------------------------------------------------------------------- M2q
M2_SQL = """
WITH r AS (SELECT * FROM b_review_doc WHERE is_approved)
SELECT 'overall' AS facet, CAST(NULL AS VARCHAR) AS key, CAST(count(*) AS BIGINT) AS n, avg(rating) AS avg_rating,
  CAST(max(helpful_votes) AS BIGINT) AS most_helpful FROM r
UNION ALL
SELECT 'by_rating', CAST(rating AS VARCHAR), CAST(count(*) AS BIGINT), CAST(NULL AS DOUBLE), CAST(NULL AS BIGINT)
FROM r GROUP BY rating
UNION ALL
SELECT 'recent', 'count_last_30_days', n, CAST(NULL AS DOUBLE), CAST(NULL AS BIGINT)
FROM (SELECT CAST(count(*) AS BIGINT) AS n FROM r
      WHERE created_at >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 30 DAY) WHERE n > 0
UNION ALL
SELECT 'helpfulness_buckets', b, CAST(count(*) AS BIGINT), avg(rating), CAST(NULL AS BIGINT)
FROM (SELECT rating, CASE WHEN helpful_votes >= 0 AND helpful_votes < 5 THEN '0'
                          WHEN helpful_votes >= 5 AND helpful_votes < 10 THEN '5'
                          WHEN helpful_votes >= 10 AND helpful_votes < 25 THEN '10'
                          WHEN helpful_votes >= 25 AND helpful_votes < 50 THEN '25'
                          WHEN helpful_votes >= 50 AND helpful_votes < 100 THEN '50'
                          ELSE '100+' END AS b FROM r) GROUP BY b
"""


@query("m2q_review_facets", M2_SQL)
def m2(c):
    """M2q $facet (overall, by_rating, recent $count, $bucket helpfulness) as flat typed rows."""
    return M.review_facets_flat(c.review_docs(), c.events_as_of)


# ----------------------------------------------------------------------------- M3q
M3_SQL = """
WITH s AS (
  SELECT customer_id, product_id, sum(CASE WHEN event_type = 'VIEW' THEN 1 ELSE 0 END) AS view_count,
         min(created_at) AS first_view, max(CASE WHEN event_type = 'PURCHASE' THEN created_at END) AS purchased_at
  FROM b_pevent GROUP BY customer_id, product_id)
SELECT r.product_id, r.customer_id, CAST(r.rating AS BIGINT) AS rating, r.title, CAST(s.view_count AS BIGINT) AS view_count,
  round_even(CAST(epoch_us(s.purchased_at) - epoch_us(s.first_view) AS DOUBLE) / CAST(86400000000.0 AS DOUBLE), 1)
    AS days_to_purchase
FROM b_review_doc r JOIN s ON s.product_id = r.product_id AND s.customer_id = r.customer_id
WHERE r.is_approved AND r.rating >= 4
"""


@query("m3q_reviews_with_events", M3_SQL)
def m3(c):
    """M3q reviews × event summary ($lookup + $unwind → pre-aggregate + inner join)."""
    return M.reviews_with_events(c.review_docs(), c.product_events())


# ----------------------------------------------------------------------------- M4q
_FUNNEL_CASE = """CASE WHEN list_contains(ev, 'PURCHASE') THEN 'PURCHASED'
       WHEN list_contains(ev, 'ADD_TO_CART') THEN 'ADDED_TO_CART'
       WHEN list_contains(ev, 'VIEW') THEN 'VIEWED' ELSE 'UNKNOWN' END"""
M4_SQL = f"""
WITH per AS (SELECT customer_id, list(DISTINCT event_type) AS ev FROM b_pevent WHERE product_id = 1 GROUP BY customer_id)
SELECT {_FUNNEL_CASE} AS stage, CAST(count(*) AS BIGINT) AS customers FROM per GROUP BY 1
"""


@query("m4q_funnel_product", M4_SQL)
def m4(c):
    """M4q funnel VIEW → ADD_TO_CART → PURCHASE for product 1."""
    return M.funnel(c.product_events(), product_id=1)


M4A_SQL = f"""
WITH per AS (SELECT product_id, customer_id, list(DISTINCT event_type) AS ev FROM b_pevent GROUP BY product_id, customer_id)
SELECT product_id, {_FUNNEL_CASE} AS stage, CAST(count(*) AS BIGINT) AS customers FROM per GROUP BY 1, 2
"""


@query("m4q_funnel_all_products", M4A_SQL)
def m4a(c):
    """M4q funnel for every product at once (grouped by product and customer)."""
    return M.funnel(c.product_events())


# ----------------------------------------------------------------------------- M5q / D1
def _geo_sql(radius_m: float, pickup_only: bool) -> str:
    lon, lat = JOHANNESBURG
    where = "WHERE pickup_available" if pickup_only else ""
    return f"""
WITH d AS (
  SELECT vendor_id, vendor_name, pickup_available,
    CAST(2.0 * 6378100.0 AS DOUBLE) * asin(sqrt(pow(sin((radians(CAST({lat} AS DOUBLE)) - radians(lat)) / 2), 2)
      + cos(radians(lat)) * cos(radians(CAST({lat} AS DOUBLE)))
        * pow(sin(radians(CAST({lon} AS DOUBLE) - lon) / 2), 2))) AS distance_meters
  FROM b_point {where})
SELECT vendor_id, vendor_name, pickup_available, round_even(distance_meters / 1000.0, 2) AS distance_km
FROM d WHERE distance_meters <= {radius_m}
"""


@query("m5q_pickup_points_near", _geo_sql(15000.0, True))
def m5(c):
    """M5q vendor pickup points within 15 km of Johannesburg CBD, nearest first."""
    return M.pickup_points_near(c.vendor_points(), *JOHANNESBURG, 15000.0).drop("distance_meters")


@query("d1_geo_radius_search", _geo_sql(25000.0, False))
def d1(c):
    """D1 geo radius search (25 km, no document filter): bounding-box prefilter + haversine."""
    return M.pickup_points_near(c.vendor_points(), *JOHANNESBURG, 25000.0, pickup_only=False).drop("distance_meters")


# ----------------------------------------------------------------------------- M6q / D2
_TR = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _text_sql(terms: list[str], where: str) -> str:
    def tf(col):
        return " + ".join(f"len(list_filter({col}, lambda x: x = '{t}'))" for t in terms)
    return f"""
WITH t AS (
  SELECT *, regexp_split_to_array(translate(coalesce(title, ''), {_TR}), '[^a-z]+') AS tt,
            regexp_split_to_array(translate(coalesce(body, ''), {_TR}), '[^a-z]+') AS tb
  FROM b_text_review WHERE {where}),
s AS (SELECT review_id, product_id, customer_id, rating, title, CAST(3 * ({tf('tt')}) + 1 * ({tf('tb')}) AS BIGINT) AS score
      FROM t)
SELECT review_id, product_id, customer_id, CAST(rating AS BIGINT) AS rating, title, score FROM s WHERE score > 0
"""


# words that some of the documents have
M6_TERMS = "stupid clown worthless"


@query("m6q_review_text_search", _text_sql(["stupid", "clown", "worthless"], "is_approved"))
def m6(c):
    """M6q weighted text search (title ×3, body ×1) over approved reviews, whole texts."""
    return M.review_text_search(c.text_reviews(), M6_TERMS).select(
        "review_id", "product_id", "customer_id", "rating", "title", "score")


@query("d2_weighted_text_search", _text_sql(["the", "of", "src"], "is_approved"))
def d2(c):
    """D2 weighted text search for common terms over all whole documents; every title holds one of them."""
    return (M.review_text_search(c.text_reviews(), "the of src")
            .select("review_id", "product_id", "customer_id", "rating", "title", "score"))


# ----------------------------------------------------------------------------- M7q
M7A_SQL = """
SELECT product_id, customer_id, CAST(rating AS BIGINT) AS rating, title, is_approved,
  CAST(helpful_votes AS BIGINT) AS helpful_votes, array_to_string(list_sort(tags), ',') AS tags, created_at
FROM b_review_doc
"""


@query("m7q_reviews_newest_first", M7A_SQL)
def m7a(c):
    """M7q (a) every review, newest first."""
    r = M.reviews_newest_first(c.review_docs())
    return r.select("product_id", "customer_id", "rating", "title", "is_approved", "helpful_votes",
                    F.array_join(F.array_sort("tags"), ",").alias("tags"), "created_at")


M7B_SQL = """
SELECT product_id, customer_id, CAST(rating AS BIGINT) AS rating, title, created_at
FROM b_review_doc WHERE rating <= 3 AND is_approved
"""


@query("m7q_low_rated_reviews", M7B_SQL)
def m7b(c):
    """M7q (b) approved reviews rated ≤ 3, rating asc then newest first."""
    return M.low_rated_reviews(c.review_docs())


M7C_SQL = "SELECT product_id AS _id, CAST(count(*) AS BIGINT) AS count, avg(rating) AS avg FROM b_review_doc GROUP BY product_id"


@query("m7q_review_count_by_product", M7C_SQL)
def m7c(c):
    """M7q (c) review count and average rating per product."""
    return M.review_count_by_product(c.review_docs())


# ----------------------------------------------------------------------------- A8
RETENTION_AS_OF = "2024-04-15 00:00:00"  # a day on which about half of the events have expired
A8_SQL = f"""
SELECT customer_id, product_id, event_type, created_at FROM b_pevent
WHERE created_at >= TIMESTAMP '{RETENTION_AS_OF}' - INTERVAL 7776000 SECOND
"""


@query("a8_event_retention", A8_SQL)
def a8(c):
    """A8 90-day event retention (TTL 7,776,000 s) as a batch rule over product events."""
    return M.retain_recent(c.product_events(), RETENTION_AS_OF)


# ----------------------------------------------------------------------------- A2
@query("a2_document_collection_scan", """
SELECT vendor_id, vendor_name, 'Point' AS geo_type, round(lon::DOUBLE, 6) AS lon, round(lat::DOUBLE, 6) AS lat, pickup_available FROM b_point""")
def a2(c):
    """A2 document collection scan: vendor locations written as JSON documents with a nested GeoJSON point and read
    back under the collection's schema (struct with a coordinates array), a row per document."""
    import uuid

    from bazaar.session import ensure_checkpoint_dir
    from bazaar.sources.tables import read_table
    path = f"{ensure_checkpoint_dir(c.spark).rstrip('/')}/vendor_locations-{uuid.uuid4().hex}"
    point = F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates"))
    c.vendor_points().select(C("vendor_id").cast("int").alias("vendor_id"), "vendor_name", point.alias("location"), "pickup_available").write.json(path)
    docs = read_table(c.spark, path, "vendor_locations", "json")
    return docs.select("vendor_id", "vendor_name", C("location.type").alias("geo_type"), F.round(C("location.coordinates")[0], 6).alias("lon"), F.round(C("location.coordinates")[1], 6).alias("lat"), "pickup_available")
