"""Document-store pipelines M1q–M7q over the ``reviews`` / ``product_events`` / ``vendor_locations``
collections (SURVEY §2.12). Each Mongo stage maps 1:1 onto a DataFrame transformation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.functions.expr import days_between_ms, ts_lit
from bazaar.operators.geo import within_radius
from bazaar.operators.grouping import bucket_expr, facet
from bazaar.operators.text import text_search

C = F.col

# Fixed values of the pipelines.
STAR_FIELDS = (("five", 5), ("four", 4), ("three", 3), ("two", 2), ("one", 1))
HELPFUL_BOUNDARIES = [0, 5, 10, 25, 50, 100]
HELPFUL_DEFAULT = "100+"
FUNNEL_STAGES = (("PURCHASE", "PURCHASED"), ("ADD_TO_CART", "ADDED_TO_CART"), ("VIEW", "VIEWED"))
FUNNEL_ORDER = {"VIEWED": 1, "ADDED_TO_CART": 2, "PURCHASED": 3}
RETENTION_SECONDS = 7_776_000  # 90 days


def review_summary(reviews: DataFrame) -> DataFrame:
    """M1q: per product — totals, $round(avg, 1) (half-even), positive rate, helpful votes and the
    star distribution sub-document, most reviewed first (the reference's final projection)."""
    g = (reviews.filter(C("is_approved")).groupBy("product_id")
         .agg(F.count(F.lit(1)).alias("total_reviews"), F.avg("rating").alias("_avg"),
              F.sum("helpful_votes").alias("total_helpful"),
              *[F.sum(F.when(C("rating") == s, 1).otherwise(0)).alias(f"_{n}") for n, s in STAR_FIELDS]))
    positive = (C("_five") + C("_four")).cast("double") / C("total_reviews").cast("double") * 100
    return (g.select("product_id", "total_reviews", F.bround("_avg", 1).alias("avg_rating"),
                     F.bround(positive, 1).alias("positive_rate"), "total_helpful",
                     F.struct(*[C(f"_{n}").alias(n) for n, _ in STAR_FIELDS]).alias("rating_distribution"))
            .orderBy(C("total_reviews").desc()))


def review_tag_frequency(reviews: DataFrame) -> DataFrame:
    """The tags of approved reviews, flattened ($push + $reduce/$concatArrays) and counted
    per (product, tag) — the "tag frequency" the pipeline announces. Tags are exploded and counted,
    never gathered into one array per product, so a product with millions of reviews stays cheap."""
    return (reviews.filter(C("is_approved")).select("product_id", F.explode("tags").alias("tag"))
            .groupBy("product_id", "tag").agg(F.count(F.lit(1)).alias("occurrences")))


def review_facets(reviews: DataFrame, as_of, recent_days: int = 30) -> DataFrame:
    """M2q: $facet over approved reviews — overall, by_rating, recent ($count), helpfulness buckets.

    Returned as flat rows (facet, key, n, avg_rating, most_helpful); ``grouping.facet_document``
    builds the single nested document from the same parts."""
    return facet(review_facet_parts(reviews, as_of, recent_days)).select("facet", "doc")


def review_facet_parts(reviews: DataFrame, as_of, recent_days: int = 30) -> dict[str, DataFrame]:
    """The four facets from one grouping: (rating, helpfulness bucket, recent or not) has a handful of rows, and its
    exchange is shared by the facets, so the reviews are read once."""
    since = ts_lit(as_of) - F.expr(f"INTERVAL {int(recent_days)} DAYS")
    base = (reviews.filter(C("is_approved"))
            .groupBy("rating", bucket_expr(C("helpful_votes"), HELPFUL_BOUNDARIES, HELPFUL_DEFAULT).alias("_bucket"), (C("created_at") >= since).alias("_recent"))
            .agg(F.count(F.lit(1)).alias("_n"), F.max("helpful_votes").alias("_votes")))
    n, mean = F.sum("_n"), F.sum(C("rating") * C("_n")).cast("double") / F.sum(F.when(C("rating").isNotNull(), C("_n"))).cast("double")
    overall = base.agg(F.coalesce(n, F.lit(0)).alias("total"), mean.alias("avg_rating"), F.max("_votes").alias("most_helpful"))
    by_rating = base.groupBy(C("rating").alias("stars")).agg(n.alias("count")).orderBy(C("stars").desc())
    recent = base.filter(C("_recent")).agg(n.alias("count_last_30_days")).filter(C("count_last_30_days") > 0)
    buckets = base.groupBy(C("_bucket").alias("_id")).agg(n.alias("count"), mean.alias("avg_rating"))
    return {"overall": overall, "by_rating": by_rating, "recent": recent, "helpfulness_buckets": buckets}


def review_facets_flat(reviews: DataFrame, as_of, recent_days: int = 30) -> DataFrame:
    """M2q as typed flat rows: (facet, key, n, avg_rating, most_helpful)."""
    p = review_facet_parts(reviews, as_of, recent_days)
    null_d, null_l = F.lit(None).cast("double"), F.lit(None).cast("bigint")
    rows = [
        p["overall"].select(F.lit("overall").alias("facet"), F.lit(None).cast("string").alias("key"),
                            C("total").alias("n"), "avg_rating", C("most_helpful").cast("bigint").alias("most_helpful")),
        p["by_rating"].select(F.lit("by_rating"), C("stars").cast("string"), C("count"), null_d, null_l),
        p["recent"].select(F.lit("recent"), F.lit("count_last_30_days"), C("count_last_30_days"), null_d, null_l),
        p["helpfulness_buckets"].select(F.lit("helpfulness_buckets"), C("_id"), C("count"), C("avg_rating"), null_l),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out


def reviews_with_events(reviews: DataFrame, events: DataFrame, min_rating: int = 4) -> DataFrame:
    """M3q: approved reviews rated ≥ 4 joined to the customer's event summary for that product
    ($lookup with let + sub-pipeline, $unwind dropping non-matches → inner join, M14).

    Events are aggregated per (customer, product) before the join, so each review joins one row."""
    summary = (events.groupBy("customer_id", "product_id")
               .agg(F.sum(F.when(C("event_type") == "VIEW", 1).otherwise(0)).alias("view_count"),
                    F.min("created_at").alias("first_view"),  # $first after $sort: any event type (B21)
                    F.max(F.when(C("event_type") == "PURCHASE", C("created_at"))).alias("purchased_at")))
    r = reviews.filter(C("is_approved") & (C("rating") >= min_rating))
    return (r.join(summary, ["customer_id", "product_id"])
            .select("product_id", "customer_id", "rating", "title", "view_count",
                    F.bround(days_between_ms(C("first_view"), C("purchased_at")), 1).alias("days_to_purchase"))
            .orderBy(C("view_count").desc()))


def funnel(events: DataFrame, product_id=None) -> DataFrame:
    """M4q: furthest funnel stage per customer ($addToSet + $in + $switch), customers per stage,
    ordered VIEWED → ADDED_TO_CART → PURCHASED → other. ``product_id=None`` runs every product
    (grouped by product too). The per-customer set is bounded by the number of event types."""
    ev = events if product_id is None else events.filter(C("product_id") == product_id)
    keys = ["customer_id"] if product_id is not None else ["product_id", "customer_id"]
    per = ev.groupBy(*keys).agg(F.collect_set("event_type").alias("events"))
    stage = None
    for ev_type, label in FUNNEL_STAGES:
        cond = F.array_contains(C("events"), ev_type)
        stage = F.when(cond, label) if stage is None else stage.when(cond, label)
    stage = stage.otherwise("UNKNOWN")
    out_keys = [] if product_id is not None else ["product_id"]
    g = per.groupBy(*out_keys, stage.alias("stage")).agg(F.count(F.lit(1)).alias("customers"))
    order = F.coalesce(F.element_at(F.create_map(*[x for k, v in FUNNEL_ORDER.items() for x in (F.lit(k), F.lit(v))]),
                                    C("stage")), F.lit(4))
    return g.orderBy(*out_keys, order).select(*out_keys, "stage", "customers")


def pickup_points_near(points: DataFrame, lon: float, lat: float, max_distance_m: float = 15000.0,
                       pickup_only: bool = True) -> DataFrame:
    """M5q: $geoNear with the pickup_available query, distance_km = $round(m / 1000, 2); sorted by
    distance before projecting (B22)."""
    q = C("pickup_available") if pickup_only else None
    near = within_radius(points, lon, lat, max_distance_m, query=q)
    return near.select("vendor_id", "vendor_name", "pickup_available",
                       F.bround(C("distance_meters") / 1000.0, 2).alias("distance_km"), "distance_meters")


def review_text_search(reviews: DataFrame, search: str, title_weight: int = 3, body_weight: int = 1,
                       approved_only: bool = True) -> DataFrame:
    """M6q: $text search over title (weight 3) and body (weight 1), approved only, score desc."""
    where = C("is_approved") if approved_only else None
    return text_search(reviews, search, {"title": title_weight, "body": body_weight}, where)


def reviews_newest_first(reviews: DataFrame) -> DataFrame:
    """M7q (a): all reviews, newest first."""
    return reviews.orderBy(C("created_at").desc())


def low_rated_reviews(reviews: DataFrame, max_rating: int = 3) -> DataFrame:
    """M7q (b): approved reviews rated ≤ 3, projected, sorted rating asc then newest."""
    return (reviews.filter((C("rating") <= max_rating) & C("is_approved"))
            .select("product_id", "customer_id", "rating", "title", "created_at")
            .orderBy(C("rating").asc(), C("created_at").desc()))


def review_count_by_product(reviews: DataFrame) -> DataFrame:
    """M7q (c): count and average rating per product, most reviewed first."""
    return (reviews.groupBy(C("product_id").alias("_id"))
            .agg(F.count(F.lit(1)).alias("count"), F.avg("rating").alias("avg")).orderBy(C("count").desc()))


def retain_recent(events: DataFrame, as_of, ttl_seconds: int = RETENTION_SECONDS, ts_col: str = "created_at"):
    """The TTL index as a batch rule — keep rows with ts ≥ as_of − ttl."""
    return events.filter(C(ts_col) >= ts_lit(as_of) - F.make_dt_interval(secs=F.lit(ttl_seconds)))
