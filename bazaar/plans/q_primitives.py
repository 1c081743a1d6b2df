"""Catalog entries for the primitive operators: projections, predicates, joins,
aggregations, windows, sorts, set operations and scalar functions — each over the bound tables,
each with an independently written DuckDB oracle. Inventory items already exercised by a named
product (V*/X*/M*q) are mapped in README.md instead of being duplicated here."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from bazaar.functions.expr import (boundary_diff, concat_null_safe, concat_plus, exact_avg, month_start,
                                   ts_lit)
from bazaar.operators import grouping as GRP
from bazaar.operators import relational as REL
from bazaar.operators.search import fold_predicates, optional_eq
from bazaar.operators.windows import ends_by_key, neighbours_by_key, rank_by_key, running_sum_by_key
from bazaar.plans.catalog import query
from bazaar.plans.views import not_cancelled, active_discount, shipment_timeline

C = F.col
AS_OF = "TIMESTAMP '2001-08-01 00:00:00'"


# ============================================================================ projections / predicates
@query("p1_computed_projection", """
SELECT OrderLineID, OrderID, CAST(Quantity AS BIGINT) AS Quantity, CAST(UnitPrice AS DOUBLE) AS UnitPrice,
  CAST(Quantity * UnitPrice AS DOUBLE) AS ComputedLineTotal, CAST(LineTotal AS DOUBLE) AS StoredLineTotal
FROM b_line""")
def p1(c):
    """P1 computed projection + rename: persisted computed column LineTotal = Quantity × UnitPrice."""
    ln = c.order_line()
    return ln.select("OrderLineID", "OrderID", "Quantity", "UnitPrice",
                     (C("Quantity") * C("UnitPrice")).alias("ComputedLineTotal"), C("LineTotal").alias("StoredLineTotal"))


@query("p2_project_subdocument", """
SELECT product_id, customer_id, to_json(struct_pack(rating := rating, helpful_votes := helpful_votes)) AS stats
FROM b_review_doc""")
def p2(c):
    """P2 $project with rename and a nested sub-document (serialised for comparison)."""
    r = c.review_docs()
    return r.select("product_id", "customer_id", F.to_json(F.struct("rating", "helpful_votes")).alias("stats"))


@query("p3_add_fields", """
SELECT product_id, customer_id, CAST(rating AS BIGINT) AS rating, rating >= 4 AS is_positive,
  CAST(helpful_votes AS BIGINT) * 2 AS double_votes, len(tags) AS tag_count
FROM b_review_doc""")
def p3(c):
    """P3 $addFields: derived fields appended to each document."""
    r = c.review_docs()
    return (r.withColumn("is_positive", C("rating") >= 4).withColumn("double_votes", C("helpful_votes").cast("bigint") * 2)
            .withColumn("tag_count", F.size("tags")).select("product_id", "customer_id", "rating", "is_positive",
                                                           "double_votes", "tag_count"))


@query("p4_range_between", """
SELECT OrderID, CAST(TotalAmount AS DOUBLE) AS TotalAmount, OrderStatus FROM b_order
WHERE TotalAmount BETWEEN 100000 AND 200000 AND OrderStatus = 'DELIVERED'""")
def p4(c):
    """P4 equality and BETWEEN range predicates (pushed to the scan as range filters)."""
    o = c.order()
    return (o.filter(C("TotalAmount").between(100000, 200000) & (C("OrderStatus") == "DELIVERED"))
            .select("OrderID", "TotalAmount", "OrderStatus"))


@query("p5_in_not_in", """
SELECT PaymentID, OrderID, PaymentMethod, PaymentStatus FROM b_payment
WHERE PaymentMethod IN ('EFT', 'INSTANT_EFT') AND PaymentStatus NOT IN ('FAILED')""")
def p5(c):
    """P5 IN / NOT IN literal lists."""
    p = c.payment()
    return (p.filter(C("PaymentMethod").isin("EFT", "INSTANT_EFT") & ~C("PaymentStatus").isin("FAILED"))
            .select("PaymentID", "OrderID", "PaymentMethod", "PaymentStatus"))


@query("p6_open_ended_validity", f"""
SELECT DiscountID, DiscountCode, ValidFrom, ValidTo FROM b_discount
WHERE IsActive AND ValidFrom <= {AS_OF} AND (ValidTo IS NULL OR ValidTo >= {AS_OF})""")
def p6(c):
    """P6 IS NULL / open-ended validity window at as_of."""
    t = ts_lit(c.orders_as_of)
    d = c.discount()
    return (d.filter(C("IsActive") & (C("ValidFrom") <= t) & (C("ValidTo").isNull() | (C("ValidTo") >= t)))
            .select("DiscountID", "DiscountCode", "ValidFrom", "ValidTo"))


@query("p7_optional_filters", """
SELECT OrderID, CustomerID, OrderStatus FROM b_order WHERE OrderStatus = 'CONFIRMED'""")
def p7(c):
    """P7 catch-all optional filters: customer_id=None adds no predicate, status='CONFIRMED' does."""
    o = c.order()
    return o.filter(fold_predicates([optional_eq("CustomerID", None), optional_eq("OrderStatus", "CONFIRMED")])) \
        .select("OrderID", "CustomerID", "OrderStatus")


@query("p8_rolling_lookback", f"""
SELECT OrderID, PlacedAt FROM b_order WHERE PlacedAt >= {AS_OF} - INTERVAL 90 DAY""")
def p8(c):
    """P8 rolling look-back window (last 90 days before as_of)."""
    o = c.order()
    return o.filter(C("PlacedAt") >= ts_lit(c.orders_as_of) - F.expr("INTERVAL 90 DAYS")).select("OrderID", "PlacedAt")


@query("p9_half_open_day", """
SELECT OrderID, PlacedAt FROM b_order
WHERE PlacedAt >= TIMESTAMP '1998-01-15 00:00:00' AND PlacedAt < TIMESTAMP '1998-01-15 00:00:00' + INTERVAL 1 DAY""")
def p9(c):
    """P9 half-open day window [d, d+1) (sargable; prunes by min/max and partitions)."""
    d = ts_lit("1998-01-15 00:00:00")
    o = c.order()
    return o.filter((C("PlacedAt") >= d) & (C("PlacedAt") < d + F.expr("INTERVAL 1 DAY"))).select("OrderID", "PlacedAt")


@query("p10_case_expressions", """
SELECT OrderID,
  CASE WHEN TotalAmount >= 300000 THEN 'LARGE' WHEN TotalAmount >= 100000 THEN 'MEDIUM' ELSE 'SMALL' END AS SizeClass,
  CASE OrderStatus WHEN 'DELIVERED' THEN 1 WHEN 'CONFIRMED' THEN 2 ELSE 3 END AS StatusCode
FROM b_order""")
def p10(c):
    """P10 searched and simple CASE."""
    o = c.order()
    size = F.when(C("TotalAmount") >= 300000, "LARGE").when(C("TotalAmount") >= 100000, "MEDIUM").otherwise("SMALL")
    code = F.when(C("OrderStatus") == "DELIVERED", 1).when(C("OrderStatus") == "CONFIRMED", 2).otherwise(3)
    return o.select("OrderID", size.alias("SizeClass"), code.alias("StatusCode"))


@query("p11_match_expr", """
SELECT product_id, customer_id, CAST(rating AS BIGINT) AS rating, CAST(helpful_votes AS BIGINT) AS helpful_votes
FROM b_review_doc WHERE rating >= 2 AND rating <= 4 AND helpful_votes >= rating * 10""")
def p11(c):
    """P11 $match with $and / $gte / $lte and an $expr comparing two fields."""
    r = c.review_docs()
    return (r.filter((C("rating") >= 2) & (C("rating") <= 4) & (C("helpful_votes") >= C("rating") * 10))
            .select("product_id", "customer_id", "rating", "helpful_votes"))


# ============================================================================ joins
@query("j1_star_join", """
SELECT l.OrderID, l.VariantID, CAST(l.LineTotal AS DOUBLE) AS LineTotal, p.ProductName, cat.CategoryName, v.VendorName,
  pr.ProvinceName
FROM b_line l JOIN b_order o ON o.OrderID = l.OrderID JOIN b_variant pv ON pv.VariantID = l.VariantID
JOIN b_product p ON p.ProductID = pv.ProductID JOIN b_category cat ON cat.CategoryID = p.CategoryID
JOIN b_vendor v ON v.VendorID = p.VendorID JOIN b_address a ON a.AddressID = o.ShippingAddressID
JOIN b_city ci ON ci.CityID = a.CityID JOIN b_province pr ON pr.ProvinceID = ci.ProvinceID
WHERE o.OrderStatus NOT IN ('CANCELLED')""")
def j1(c):
    """J1 multi-way inner star join (8 tables); dimensions are broadcast when AQE measures them small."""
    o = c.order().filter(not_cancelled()).select("OrderID", "ShippingAddressID")
    return (c.order_line().select("OrderID", "VariantID", "LineTotal").join(o, "OrderID")
            .join(c.variant().select("VariantID", "ProductID"), "VariantID")
            .join(c.product().select("ProductID", "ProductName", "CategoryID", "VendorID"), "ProductID")
            .join(c.category().select("CategoryID", "CategoryName"), "CategoryID")
            .join(c.vendor().select("VendorID", "VendorName"), "VendorID")
            .join(c.address().select(C("AddressID").alias("ShippingAddressID"), "CityID"), "ShippingAddressID")
            .join(c.city().select("CityID", "ProvinceID"), "CityID")
            .join(c.province(), "ProvinceID")
            .select("OrderID", "VariantID", "LineTotal", "ProductName", "CategoryName", "VendorName", "ProvinceName"))


@query("j2_left_outer_join", """
SELECT o.OrderID, o.OrderStatus, s.ShipmentStatus FROM b_order o LEFT JOIN b_shipment s ON s.OrderID = o.OrderID""")
def j2(c):
    """J2 left outer join (cancelled orders keep a NULL shipment)."""
    return (c.order().select("OrderID", "OrderStatus")
            .join(c.shipment().select("OrderID", "ShipmentStatus"), "OrderID", "left"))


@query("j3_left_join_extra_predicate", """
SELECT p.ProductID, r.ReviewID, CAST(r.Rating AS BIGINT) AS Rating
FROM b_product p LEFT JOIN b_review r ON r.ProductID = p.ProductID AND r.IsApproved""")
def j3(c):
    """J3 left join with an extra ON predicate (right side filtered before the join)."""
    r = c.review().filter(C("IsApproved")).select("ProductID", "ReviewID", "Rating")
    return c.product().select("ProductID").join(r, "ProductID", "left")


@query("j4_self_join_parent", """
SELECT c.CategoryID, c.CategoryName, coalesce(p.CategoryName || ' > ', '') || c.CategoryName AS CategoryPath
FROM b_category c LEFT JOIN b_category p ON p.CategoryID = c.ParentCategoryID""")
def j4(c):
    """J4 / H3 aliased self join to the parent (one-level breadcrumb)."""
    from bazaar.operators.hierarchy import parent_breadcrumb
    return parent_breadcrumb(c.category()).select("CategoryID", "CategoryName", "CategoryPath")


@query("j5_semi_join_exists", """
SELECT c.CustomerID FROM b_customer c
WHERE EXISTS (SELECT 1 FROM b_order o WHERE o.CustomerID = c.CustomerID AND o.TotalAmount > 400000)""")
def j5(c):
    """J5 WHERE EXISTS → left semi join."""
    big = c.order().filter(C("TotalAmount") > 400000).select("CustomerID")
    return REL.exists_in(c.customer().select("CustomerID"), big, "CustomerID")


@query("j6_exists_as_value", """
SELECT c.CustomerID, CAST(CASE WHEN EXISTS (SELECT 1 FROM b_order o WHERE o.CustomerID = c.CustomerID
                                 AND o.TotalAmount > 400000) THEN 1 ELSE 0 END AS BIGINT) AS HasLargeOrder
FROM b_customer c""")
def j6(c):
    """J6 EXISTS used as a value in CASE → left join on distinct keys."""
    big = c.order().filter(C("TotalAmount") > 400000).select("CustomerID")
    return REL.exists_flag(c.customer().select("CustomerID"), big, "CustomerID", "HasLargeOrder")


@query("j7_in_subquery", """
SELECT o.OrderID FROM b_order o JOIN b_address a ON a.AddressID = o.ShippingAddressID
WHERE a.CityID IN (SELECT CityID FROM b_city WHERE ProvinceID = 2)""")
def j7(c):
    """J7 IN (subquery) → left semi join."""
    o = c.order().select("OrderID", "ShippingAddressID").join(
        c.address().select(C("AddressID").alias("ShippingAddressID"), "CityID"), "ShippingAddressID")
    return REL.exists_in(o, c.city().filter(C("ProvinceID") == 2).select("CityID"), "CityID").select("OrderID")


@query("j8_anti_join_not_exists", """
SELECT p.ProductID FROM b_product p
WHERE NOT EXISTS (SELECT 1 FROM b_review r WHERE r.ProductID = p.ProductID AND r.IsApproved)""")
def j8(c):
    """J8 NOT EXISTS → left anti join (products without an approved review)."""
    r = c.review().filter(C("IsApproved")).select("ProductID")
    return REL.exists_in(c.product().select("ProductID"), r, "ProductID", negate=True)


@query("j9_cross_apply_aggregate", """
SELECT c.CustomerID, CAST(coalesce(a.n, 0) AS BIGINT) AS OrderCount, CAST(a.spend AS DOUBLE) AS Spend
FROM b_customer c LEFT JOIN (SELECT CustomerID, count(*) AS n, sum(TotalAmount) AS spend
                             FROM b_order WHERE OrderStatus = 'DELIVERED' GROUP BY CustomerID) a
  ON a.CustomerID = c.CustomerID""")
def j9(c):
    """J9 CROSS APPLY correlated aggregate → aggregate per key + left join; COUNT filled with 0."""
    o = c.order().filter(C("OrderStatus") == "DELIVERED")
    return REL.lateral_aggregate(c.customer().select("CustomerID"), o, "CustomerID",
                                 [F.count(F.lit(1)).alias("OrderCount"), F.sum("TotalAmount").alias("Spend")],
                                 zero_fill={"OrderCount": 0})


@query("j10_top_n_per_group", """
SELECT CustomerID, OrderID, CAST(TotalAmount AS DOUBLE) AS TotalAmount, CAST(rn AS BIGINT) AS rn
FROM (SELECT *, row_number() OVER (PARTITION BY CustomerID ORDER BY TotalAmount DESC, OrderID) AS rn FROM b_order)
WHERE rn <= 2""")
def j10(c):
    """J10 CROSS APPLY TOP 2 per customer → row_number ≤ 2 (map-side group limit)."""
    o = c.order().select("CustomerID", "OrderID", "TotalAmount")
    return REL.top_n_per_group(o, ["CustomerID"], [C("TotalAmount").desc(), C("OrderID")], 2)


@query("j11_outer_apply_top1", f"""
SELECT p.ProductID, d.DiscountCode AS ActiveDiscountCode
FROM b_product p LEFT JOIN (SELECT DiscountCode FROM b_discount WHERE IsActive AND ValidFrom <= {AS_OF}
                            AND (ValidTo IS NULL OR ValidTo >= {AS_OF}) ORDER BY DiscountValue DESC, DiscountID LIMIT 1) d
  ON TRUE""")
def j11(c):
    """J11 uncorrelated OUTER APPLY TOP 1 → 1-row side broadcast to every row."""
    disc = active_discount(c.discount(), c.orders_as_of).select("ActiveDiscountCode")
    return REL.outer_apply_top1(c.product().select("ProductID"), disc, [])


@query("j15_set_based_update", """
SELECT c.CustomerID, CAST(CASE WHEN a.CustomerID IS NOT NULL THEN c.LoyaltyPoints + a.pts ELSE c.LoyaltyPoints END AS BIGINT)
  AS LoyaltyPoints
FROM b_customer c LEFT JOIN (SELECT CustomerID, CAST(floor(sum(TotalAmount) / 10000) AS BIGINT) AS pts
                             FROM b_order WHERE OrderStatus = 'DELIVERED' GROUP BY CustomerID) a
  ON a.CustomerID = c.CustomerID""")
def j15(c):
    """J15 UPDATE … FROM join: loyalty points += ⌊Σ delivered / 10000⌋, unmatched rows unchanged."""
    pts = (c.order().filter(C("OrderStatus") == "DELIVERED").groupBy("CustomerID")
           .agg(F.floor(F.sum("TotalAmount") / 10000).cast("bigint").alias("pts")))
    cust = c.customer().select("CustomerID", "LoyaltyPoints")
    return REL.set_based_update(cust, pts, "CustomerID", "LoyaltyPoints", C("LoyaltyPoints") + C("pts"))


# ============================================================================ aggregations
@query("g1_grouped_aggregates", """
SELECT OrderStatus, CAST(count(*) AS BIGINT) AS n, CAST(sum(TotalAmount) AS DOUBLE) AS total,
  CAST(sum(TotalAmount) AS DOUBLE) / count(TotalAmount) AS avg_total, CAST(min(TotalAmount) AS DOUBLE) AS min_total,
  CAST(max(TotalAmount) AS DOUBLE) AS max_total
FROM b_order GROUP BY OrderStatus""")
def g1(c):
    """G1 COUNT / SUM / AVG / MIN / MAX per group."""
    return c.order().groupBy("OrderStatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("TotalAmount").alias("total"), exact_avg("TotalAmount").alias("avg_total"),
        F.min("TotalAmount").alias("min_total"), F.max("TotalAmount").alias("max_total"))


@query("g2_count_distinct", """
SELECT a.CityID, CAST(count(DISTINCT o.CustomerID) AS BIGINT) AS customers, CAST(count(DISTINCT o.OrderID) AS BIGINT) AS orders
FROM b_order o JOIN b_address a ON a.AddressID = o.ShippingAddressID GROUP BY a.CityID""")
def g2(c):
    """G2 several COUNT(DISTINCT) per group."""
    o = c.order().join(c.address().select(C("AddressID").alias("ShippingAddressID"), "CityID"), "ShippingAddressID")
    return o.groupBy("CityID").agg(F.count_distinct("CustomerID").alias("customers"),
                                   F.count_distinct("OrderID").alias("orders"))


@query("g2b_distinct_grouping_sets", """
SELECT year(PlacedAt)::BIGINT AS y, OrderStatus, ShippingAddressID % 7 AS route, count(DISTINCT CustomerID)::BIGINT AS customers, sum(TotalAmount)::DOUBLE AS revenue,
  grouping(year(PlacedAt))::BIGINT AS all_years, grouping(OrderStatus)::BIGINT AS all_states, grouping(ShippingAddressID % 7)::BIGINT AS all_routes
FROM b_order GROUP BY GROUPING SETS ((year(PlacedAt), OrderStatus, ShippingAddressID % 7), (year(PlacedAt), OrderStatus), (year(PlacedAt)), (OrderStatus), ())""")
def g2b(c):
    """G2 distinct customers over grouping sets by merged bitmaps (year, status, route and four coarser sets)."""
    o = c.order().select(F.year("PlacedAt").alias("y"), "OrderStatus", (C("ShippingAddressID") % 7).alias("route"), "CustomerID", "TotalAmount")
    out = GRP.cube_distinct(o, ["y", "OrderStatus", "route"], "CustomerID", "customers", {"revenue": "TotalAmount"},
                            sets=[("y", "OrderStatus", "route"), ("y", "OrderStatus"), ("y",), ("OrderStatus",), ()])
    return out.select("y", "OrderStatus", "route", "customers", "revenue", C("_g_y").alias("all_years"), C("_g_OrderStatus").alias("all_states"), C("_g_route").alias("all_routes"))


@query("g3_conditional_count", """
SELECT year(PlacedAt) AS y, CAST(sum(CASE WHEN OrderStatus = 'DELIVERED' THEN 1 ELSE 0 END) AS BIGINT) AS delivered,
  CAST(sum(CASE WHEN OrderStatus = 'CANCELLED' THEN 1 ELSE 0 END) AS BIGINT) AS cancelled
FROM b_order GROUP BY year(PlacedAt)""")
def g3(c):
    """G3 conditional counts SUM(CASE …)."""
    return c.order().groupBy(F.year("PlacedAt").alias("y")).agg(
        F.sum(F.when(C("OrderStatus") == "DELIVERED", 1).otherwise(0)).alias("delivered"),
        F.sum(F.when(C("OrderStatus") == "CANCELLED", 1).otherwise(0)).alias("cancelled"))


@query("g4_global_aggregate", """
SELECT CAST(count(*) AS BIGINT) AS orders, CAST(sum(TotalAmount) AS DOUBLE) AS revenue,
  CAST(count(DISTINCT CustomerID) AS BIGINT) AS customers FROM b_order""")
def g4(c):
    """G4 global aggregate (no GROUP BY)."""
    return c.order().agg(F.count(F.lit(1)).alias("orders"), F.sum("TotalAmount").alias("revenue"),
                         F.count_distinct("CustomerID").alias("customers"))


@query("g5_having", """
SELECT CustomerID, CAST(count(*) AS BIGINT) AS n FROM b_order GROUP BY CustomerID HAVING count(*) > 15""")
def g5(c):
    """G5 HAVING on an aggregate."""
    return c.order().groupBy("CustomerID").agg(F.count(F.lit(1)).alias("n")).filter(C("n") > 15)


@query("g12_unpivot_repeating_groups", """
SELECT l.OrderID, CAST(row_number() OVER (PARTITION BY l.OrderID ORDER BY l.LineNumber, l.ProductID, l.Quantity, l.UnitPrice) AS BIGINT) AS LineNum,
  p.ProductName, CAST(l.UnitPrice AS DOUBLE) AS UnitPrice, CAST(l.Quantity AS BIGINT) AS Quantity
FROM b_line l JOIN b_product p ON p.ProductID = l.ProductID""")
def g12(c):
    """G12 / N1 repeating column groups → rows (multi-measure UNPIVOT), all-NULL groups dropped.
    The wide (UNF) table holds all lines of every order."""
    from bazaar.plans.normalise import line_groups, wide_orders_from_lines
    wide = wide_orders_from_lines(c.order_line(), c.product())
    return REL.unpivot_groups(wide, ["OrderID"], line_groups(wide))


# ============================================================================ windows
@query("w2_shipment_timeline", """
SELECT ShipmentID, EventID, EventStatus, EventAt,
  lead(EventStatus) OVER w AS NextStatus, lead(EventAt) OVER w AS NextEventAt,
  lag(EventStatus) OVER w AS PrevStatus, lag(EventAt) OVER w AS PrevEventAt,
  date_diff('minute', lag(EventAt) OVER w, EventAt) AS MinutesSincePrevEvent,
  CAST(row_number() OVER w AS BIGINT) AS EventSequence
FROM b_shipevent WINDOW w AS (PARTITION BY ShipmentID ORDER BY EventAt, EventID)""")
def w2(c):
    """W2 / W9 / W15 LAG / LEAD / ROW_NUMBER per shipment and minute gaps (boundary DATEDIFF)."""
    return shipment_timeline(c.shipment_event()).drop("EventLocation")


@query("w16_last_value", """
SELECT ShipmentID, EventID,
  last_value(EventStatus) OVER (PARTITION BY ShipmentID ORDER BY EventAt, EventID
                                ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS FinalStatus,
  first_value(EventStatus) OVER (PARTITION BY ShipmentID ORDER BY EventAt, EventID
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS FirstStatus
FROM b_shipevent""")
def w16(c):
    """W12 / W16 FIRST_VALUE and LAST_VALUE over the full frame per shipment."""
    e = c.shipment_event()
    out = ends_by_key(e, ["ShipmentID"], ["EventAt", "EventID"], firsts={"FirstStatus": "EventStatus"}, lasts={"FinalStatus": "EventStatus"})
    return out.select("ShipmentID", "EventID", "FinalStatus", "FirstStatus")


@query("w4_running_sum_partitioned", """
SELECT CustomerID, OrderID, CAST(sum(TotalAmount) OVER (PARTITION BY CustomerID ORDER BY PlacedAt, OrderID
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS RunningSpend,
  CAST(rank() OVER (PARTITION BY CustomerID ORDER BY TotalAmount DESC) AS BIGINT) AS AmountRank,
  CAST(dense_rank() OVER (PARTITION BY CustomerID ORDER BY year(PlacedAt)) AS BIGINT) AS YearIndex
FROM b_order""")
def w4(c):
    """W4 / W7 / W8 running SUM, RANK and DENSE_RANK per customer."""
    o = c.order().select("CustomerID", "OrderID", "TotalAmount", "PlacedAt", F.year("PlacedAt").alias("_year"))
    o = running_sum_by_key(o, ["CustomerID"], ["PlacedAt", "OrderID"], {"RunningSpend": "TotalAmount"})
    o = rank_by_key(o, ["CustomerID"], "TotalAmount", rank="AmountRank")
    o = rank_by_key(o, ["CustomerID"], "_year", rank=None, dense="YearIndex", descending=False)
    return o.select("CustomerID", "OrderID", "RunningSpend", "AmountRank", "YearIndex")


# ============================================================================ sorts / limits
@query("s4_top20_products", """
SELECT ProductID, CAST(sum(l.LineTotal) AS DOUBLE) AS Revenue
FROM b_line l JOIN b_order o ON o.OrderID = l.OrderID WHERE o.OrderStatus NOT IN ('CANCELLED')
GROUP BY ProductID ORDER BY sum(l.LineTotal) DESC, ProductID LIMIT 20""")
def s4(c):
    """S4 TOP 20 of the product revenue ranking (TakeOrderedAndProject — a top-k report)."""
    o = c.order().filter(not_cancelled()).select("OrderID")
    per = c.order_line().join(o, "OrderID", "left_semi").groupBy("ProductID").agg(F.sum("LineTotal").alias("Revenue"))
    return per.orderBy(C("Revenue").desc(), C("ProductID")).limit(20)


# ============================================================================ set operations
@query("u3_union_all", """
SELECT OrderID AS RefID, 'ORDER' AS Kind, PlacedAt AS At FROM b_order
UNION ALL SELECT PaymentID, 'PAYMENT', CreatedAt FROM b_payment
UNION ALL SELECT ShipmentID, 'SHIPMENT', CreatedAt FROM b_shipment""")
def u3(c):
    """U3 UNION ALL of three activity streams (no dedup, no shuffle)."""
    o = c.order().select(C("OrderID").alias("RefID"), F.lit("ORDER").alias("Kind"), C("PlacedAt").alias("At"))
    p = c.payment().select(C("PaymentID").alias("RefID"), F.lit("PAYMENT").alias("Kind"), C("CreatedAt").alias("At"))
    s = c.shipment().select(C("ShipmentID").alias("RefID"), F.lit("SHIPMENT").alias("Kind"), C("CreatedAt").alias("At"))
    return o.unionByName(p).unionByName(s)


@query("u4_select_distinct", """
SELECT DISTINCT CustomerID, CAST(date_trunc('month', PlacedAt) AS TIMESTAMP) AS OrderMonth
FROM b_order WHERE OrderStatus NOT IN ('CANCELLED')""")
def u4(c):
    """U4 SELECT DISTINCT (customer, order month)."""
    return c.order().filter(not_cancelled()).select("CustomerID", month_start("PlacedAt").alias("OrderMonth")).distinct()


# ============================================================================ scalar functions
@query("f_scalar_functions", f"""
SELECT s.ShipmentID,
  s.TrackingNumber || '/' || s.ShipmentStatus AS PlusConcat,
  concat(s.TrackingNumber, '-', CAST(date_diff('day', s.EstimatedDelivery, CAST(s.ActualDelivery AS DATE)) AS VARCHAR))
    AS NullSafeConcat,
  repeat('-', s.CourierID) AS Indent,
  coalesce(s.ActualDelivery, s.CreatedAt) AS SettledAt,
  TRY_CAST(substring(s.TrackingNumber, 4) AS INTEGER) AS TrackingNo,
  CAST(year(s.CreatedAt) AS BIGINT) AS Y, CAST(month(s.CreatedAt) AS BIGINT) AS M,
  CAST(date_trunc('month', s.CreatedAt) AS TIMESTAMP) AS MonthStart,
  CAST(s.EstimatedDelivery + 7 AS TIMESTAMP) AS EstPlus7,
  CAST(CAST(s.EstimatedDelivery + INTERVAL 2 MONTH AS DATE) AS TIMESTAMP) AS EstPlus2Months,
  strftime(s.CreatedAt, '%Y-%m') AS YearMonth,
  date_diff('day', s.CreatedAt, {AS_OF}) AS DaysToAsOf,
  date_diff('month', s.CreatedAt, {AS_OF}) AS MonthsToAsOf,
  CAST(floor(CAST(o.TotalAmount AS DOUBLE) / 1000) AS BIGINT) AS Thousands,
  greatest(s.ActualDelivery, s.CreatedAt) AS LatestTs
FROM b_shipment s JOIN b_order o ON o.OrderID = s.OrderID""")
def f_scalar(c):
    """+ / CONCAT (M2, M3), REPLICATE, COALESCE, TRY_CAST (M11), YEAR / MONTH / DATEFROMPARTS,
    DATEADD day / month, FORMAT yyyy-MM, boundary DATEDIFF day / month (M1), FLOOR, GREATEST (M9)."""
    s = c.shipment().join(c.order().select("OrderID", "TotalAmount"), "OrderID")
    t = ts_lit(c.orders_as_of)
    return s.select(
        "ShipmentID", concat_plus("TrackingNumber", F.lit("/"), "ShipmentStatus").alias("PlusConcat"),
        concat_null_safe("TrackingNumber", F.lit("-"), boundary_diff("DAY", C("EstimatedDelivery"), C("ActualDelivery")))
        .alias("NullSafeConcat"),
        F.repeat(F.lit("-"), C("CourierID")).alias("Indent"), F.coalesce("ActualDelivery", "CreatedAt").alias("SettledAt"),
        F.expr("try_cast(substring(TrackingNumber, 4) AS INT)").alias("TrackingNo"),
        F.year("CreatedAt").alias("Y"), F.month("CreatedAt").alias("M"), month_start("CreatedAt").alias("MonthStart"),
        F.date_add("EstimatedDelivery", 7).alias("EstPlus7"), F.add_months("EstimatedDelivery", 2).alias("EstPlus2Months"),
        F.date_format("CreatedAt", "yyyy-MM").alias("YearMonth"),
        boundary_diff("DAY", C("CreatedAt"), t).alias("DaysToAsOf"),
        boundary_diff("MONTH", C("CreatedAt"), t).alias("MonthsToAsOf"),
        F.floor(C("TotalAmount").cast("double") / 1000).cast("bigint").alias("Thousands"),
        F.greatest("ActualDelivery", "CreatedAt").alias("LatestTs"))


@query("f7_boundary_datediff", """
SELECT EventID, date_diff('minute', EventAt, TIMESTAMP '2024-01-31 00:00:00') AS Minutes,
  date_diff('hour', EventAt, TIMESTAMP '2024-01-31 00:00:00') AS Hours,
  date_diff('day', EventAt, TIMESTAMP '2024-01-31 00:00:00') AS Days,
  date_diff('hour', lag(EventAt) OVER (PARTITION BY ShipmentID ORDER BY EventAt, EventID), EventAt) AS HoursSincePrev
FROM b_shipevent""")
def f7(c):
    """F7 / M1 DATEDIFF minute / hour / day as boundary counts (not elapsed units)."""
    e = c.shipment_event().select("ShipmentID", "EventID", "EventAt")
    t = ts_lit(c.events_as_of)
    e = neighbours_by_key(e, ["ShipmentID"], ["EventAt", "EventID"], lags={"_before": "EventAt"})
    return e.select("EventID", boundary_diff("MINUTE", C("EventAt"), t).alias("Minutes"),
                    boundary_diff("HOUR", C("EventAt"), t).alias("Hours"),
                    boundary_diff("DAY", C("EventAt"), t).alias("Days"),
                    boundary_diff("HOUR", C("_before"), C("EventAt")).alias("HoursSincePrev"))


@query("f13_json_scalars", """
SELECT EventID, CAST(json_extract_string(EventLocation, '$.k') AS INTEGER) AS k,
  TRY_CAST(json_extract_string(EventLocation, '$.missing') AS INTEGER) AS missing
FROM b_shipevent""")
def f13(c):
    """F13 JSON_VALUE-style scalar extraction from a JSON text column (get_json_object + try_cast)."""
    e = c.shipment_event()
    return e.select("EventID", F.get_json_object("EventLocation", "$.k").cast("int").alias("k"),
                    F.expr("try_cast(get_json_object(EventLocation, '$.missing') AS INT)").alias("missing"))
