"""Saved views V1–V8 (A7) as lazy DataFrame functions over the logical commerce tables.

Each function takes the DataFrames it reads plus an explicit ``as_of`` instant (the reference's
``SYSUTCDATETIME()``), and returns the view's rows. ``register_views`` exposes them as temp views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaar.functions.expr import (as_date, boundary_diff, concat_plus, date_lit, exact_avg, full_name,
                                   month_start, ts_lit)
from bazaar.operators.relational import outer_apply_top1
from bazaar.operators.windows import first_value_full, global_order, growth_pct, moving_avg_exact, neighbours_by_key, rank_by_key

C = F.col


def not_cancelled():
    """OrderStatus NOT IN ('CANCELLED')."""
    return ~C("OrderStatus").isin("CANCELLED")


def _as_of_date(as_of):
    return date_lit(as_of) if not hasattr(as_of, "_jc") else as_of.cast("date")


# --------------------------------------------------------------------------- V1
def order_detail(orders, customers, addresses, cities, provinces, discounts, payments, shipments,
                 couriers, lines, as_of, latest_payment_only: bool = False) -> DataFrame:
    """V1: one row per order × payment × shipment (B4 fan-out kept unless ``latest_payment_only``)."""
    asof_d = _as_of_date(as_of)
    line_stats = lines.groupBy("OrderID").agg(F.count(F.lit(1)).alias("_lc"), F.sum("Quantity").alias("TotalItems"))
    pay = payments.select("OrderID", "PaymentMethod", "PaymentStatus", "PaidAt", "CreatedAt")
    if latest_payment_only:
        w = Window.partitionBy("OrderID").orderBy(C("CreatedAt").desc(), C("PaymentStatus"))
        pay = pay.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")
    pay = pay.drop("CreatedAt")
    o = orders.alias("o")
    df = (o.join(customers.select("CustomerID", "FirstName", "LastName", "Email", "LoyaltyPoints"), "CustomerID")
          .join(addresses.select(C("AddressID").alias("ShippingAddressID"), "CityID", "AddressLine1"),
                "ShippingAddressID")
          .join(cities.select("CityID", "ProvinceID", "CityName"), "CityID")
          .join(provinces.select("ProvinceID", "ProvinceName"), "ProvinceID")
          .join(discounts.select("DiscountID", "DiscountCode", "DiscountType", "DiscountValue"), "DiscountID", "left")
          .join(pay, "OrderID", "left")
          .join(shipments.select("OrderID", "CourierID", "TrackingNumber", "ShipmentStatus", "EstimatedDelivery",
                                 "ActualDelivery"), "OrderID", "left")
          .join(couriers.select("CourierID", "CourierName"), "CourierID", "left")
          .join(line_stats, "OrderID", "left"))
    delayed = (C("EstimatedDelivery").isNotNull() & C("ActualDelivery").isNull()
               & (asof_d > C("EstimatedDelivery")) & ~C("ShipmentStatus").isin("DELIVERED", "RETURNED"))
    return df.select(
        "OrderID", "PlacedAt", "OrderStatus", "CustomerID", full_name().alias("CustomerName"),
        C("Email").alias("CustomerEmail"), "LoyaltyPoints", C("CityName").alias("ShippingCity"),
        C("ProvinceName").alias("ShippingProvince"), C("AddressLine1").alias("ShippingAddress"),
        "SubtotalAmount", "DiscountAmount", "ShippingAmount", "TotalAmount", "DiscountCode", "DiscountType",
        "DiscountValue", "PaymentMethod", "PaymentStatus", "PaidAt", "TrackingNumber", "ShipmentStatus",
        "EstimatedDelivery", "CourierName", F.coalesce(C("_lc"), F.lit(0)).alias("LineCount"), "TotalItems",
        F.when(delayed, 1).otherwise(0).alias("IsDelayed"), "UpdatedAt")


# --------------------------------------------------------------------------- V2
def active_discount(discounts, as_of) -> DataFrame:
    """The single best active discount (TOP 1 BY DiscountValue DESC) — at most one row."""
    t = ts_lit(as_of)
    valid = (C("IsActive") & (C("ValidFrom") <= t) & (C("ValidTo").isNull() | (C("ValidTo") >= t)))
    return (discounts.filter(valid).orderBy(C("DiscountValue").desc(), C("DiscountID"))
            .limit(1).select(C("DiscountCode").alias("ActiveDiscountCode"), C("DiscountType").alias("ActiveDiscountType"),
                             C("DiscountValue").alias("ActiveDiscountValue")))


def product_catalogue(products, categories, vendors, variants, stock_levels, reviews, discounts, as_of) -> DataFrame:
    """V2: product with category breadcrumb, stock and review summaries, best active discount."""
    cat = categories.select("CategoryID", "ParentCategoryID", "CategoryName")
    parent = categories.select(C("CategoryID").alias("ParentCategoryID"), C("CategoryName").alias("_parent"))
    stock = (variants.filter(C("IsActive")).select("VariantID", "ProductID")
             .join(stock_levels.select("VariantID", "WarehouseID", "QuantityOnHand"), "VariantID")
             .groupBy("ProductID").agg(F.sum("QuantityOnHand").alias("_stock"),
                                       F.count_distinct("WarehouseID").alias("_wh")))
    rev = (reviews.filter(C("IsApproved")).groupBy("ProductID")
           .agg(F.count(F.lit(1)).alias("_rc"), exact_avg("Rating").alias("AvgRating"),
                F.max("CreatedAt").alias("LatestReviewAt")))
    disc = active_discount(discounts, as_of)
    df = (products.join(cat, "CategoryID").join(vendors.select("VendorID", "VendorName", "CommissionRate"), "VendorID")
          .join(parent, "ParentCategoryID", "left")
          .join(stock, "ProductID", "left").join(rev, "ProductID", "left"))
    # OUTER APPLY (TOP 1), uncorrelated: a scalar subquery computed once, no join
    df = outer_apply_top1(df, disc, [])
    total_stock = F.coalesce(C("_stock"), F.lit(0))
    hundred = F.lit(100).cast("decimal(3,0)")
    effective = (F.when(C("ActiveDiscountType") == "PERCENTAGE",
                        C("BasePrice") * (hundred - C("ActiveDiscountValue")) * F.lit(0.01).cast("decimal(2,2)"))
                 .when(C("ActiveDiscountType") == "FIXED_AMOUNT",
                       F.greatest(F.lit(0).cast("decimal(1,0)"), C("BasePrice") - C("ActiveDiscountValue")))
                 .otherwise(C("BasePrice")))
    return df.select(
        "ProductID", "ProductName", "ProductSlug", "BasePrice",
        concat_plus(F.coalesce(concat_plus(C("_parent"), F.lit(" > ")), F.lit("")), C("CategoryName")).alias("CategoryPath"),
        "CategoryName", "CategoryID", "VendorID", "VendorName", "CommissionRate",
        total_stock.alias("TotalStock"), F.coalesce(C("_wh"), F.lit(0)).alias("WarehouseCount"),
        F.when(total_stock > 0, 1).otherwise(0).alias("InStock"),
        F.coalesce(C("_rc"), F.lit(0)).alias("ReviewCount"), "AvgRating", "LatestReviewAt",
        "ActiveDiscountCode", "ActiveDiscountType", "ActiveDiscountValue", effective.alias("EffectivePrice"),
        "IsActive")


# --------------------------------------------------------------------------- V3
def customer_360(customers, orders, addresses, reviews, as_of) -> DataFrame:
    """V3: per-customer order stats (CROSS APPLY aggregate → left join, M12), segment CASE."""
    t = ts_lit(as_of)
    st = (orders.groupBy("CustomerID").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("TotalAmount").alias("_spend"), exact_avg("TotalAmount").alias("_avg"),
        F.max("PlacedAt").alias("LastOrderAt"),
        F.sum(F.when(C("OrderStatus") == "DELIVERED", 1).otherwise(0)).alias("DeliveredOrders"),
        F.sum(F.when(C("OrderStatus") == "CANCELLED", 1).otherwise(0)).alias("CancelledOrders")))
    addr = addresses.groupBy("CustomerID").agg(F.count(F.lit(1)).alias("_ac"))
    reviewed = reviews.filter(C("IsApproved")).select("CustomerID").distinct().withColumn("_rv", F.lit(1))
    df = customers.join(st, "CustomerID", "left").join(addr, "CustomerID", "left").join(reviewed, "CustomerID", "left")
    n = F.coalesce(C("_n"), F.lit(0))
    spend = F.coalesce(C("_spend"), F.lit(0))
    segment = (F.when(spend >= 50000, "VIP").when(spend >= 10000, "LOYAL").when(n >= 3, "RETURNING")
               .when(n == 1, "NEW").when(C("LastOrderAt") < t - F.expr("INTERVAL 90 DAYS"), "AT_RISK")
               .otherwise("INACTIVE"))
    return df.select(
        "CustomerID", "FirstName", "LastName", full_name().alias("FullName"), "Email", "LoyaltyPoints", "IsActive",
        C("CreatedAt").alias("MemberSince"), boundary_diff("DAY", C("CreatedAt"), t).alias("DaysSinceMembership"),
        n.alias("TotalOrders"), spend.alias("TotalSpend"), F.coalesce(C("_avg"), F.lit(0.0)).alias("AvgOrderValue"),
        "LastOrderAt", "CancelledOrders", "DeliveredOrders",
        F.when(n > 0, C("DeliveredOrders").cast("double") / n.cast("double") * 100).alias("DeliverySuccessRate"),
        F.coalesce(C("_ac"), F.lit(0)).alias("AddressCount"),
        F.when(C("_rv").isNotNull(), 1).otherwise(0).alias("HasReviewed"), segment.alias("CustomerSegment"))


# --------------------------------------------------------------------------- review fan-out (B2)
def review_fanout(reviews, dedup_reviews: bool = False) -> DataFrame:
    """Per product: the multiplicity ``_w`` that ``LEFT JOIN Review r ON r.ProductID = p.ProductID AND
    r.IsApproved = 1`` gives every order line (max(#approved reviews, 1)), and Σ / count of ratings.

    The fan-out is reproduced arithmetically (Σ x·w) instead of materialising line × review rows,
    so a product with millions of reviews costs nothing extra. ``dedup_reviews`` sets w = 1."""
    agg = (reviews.filter(C("IsApproved")).groupBy("ProductID")
           .agg(F.count("Rating").alias("_rcnt"), F.sum("Rating").alias("_rsum")))
    if dedup_reviews:
        return agg.withColumn("_w", F.lit(1).cast("bigint"))
    return agg.withColumn("_w", F.greatest(C("_rcnt"), F.lit(1)).cast("bigint"))


# --------------------------------------------------------------------------- V4
def vendor_performance(vendors, products, variants, lines, orders, reviews, as_of,
                       dedup_reviews: bool = False) -> DataFrame:
    """V4: all-time and 30-day vendor stats. The 30-day figures keep the review fan-out (B2)."""
    t = ts_lit(as_of)
    ok_orders = orders.filter(not_cancelled()).select("OrderID", "PlacedAt")
    facts = (lines.select("OrderID", "VariantID", "Quantity", "LineTotal")
             .join(variants.select("VariantID", "ProductID"), "VariantID")
             .join(products.select("ProductID", "VendorID"), "ProductID")
             .join(ok_orders, "OrderID"))
    alltime = facts.groupBy("VendorID").agg(F.count_distinct("OrderID").alias("TotalOrders"),
                                            F.sum("LineTotal").alias("TotalRevenue"))
    fan = review_fanout(reviews, dedup_reviews)
    recent = (facts.filter(C("PlacedAt") >= t - F.expr("INTERVAL 30 DAYS"))
              .join(fan, "ProductID", "left")
              .withColumn("_w", F.coalesce(C("_w"), F.lit(1).cast("bigint"))))
    l30 = recent.groupBy("VendorID").agg(
        F.count_distinct("OrderID").alias("_o30"), F.sum(C("LineTotal") * C("_w")).alias("_r30"),
        F.sum(C("Quantity") * C("_w")).alias("_u30"),
        (F.sum(C("_rsum")).cast("double") / F.sum("_rcnt").cast("double")).alias("_a30"))
    active = (products.filter(C("IsActive")).groupBy("VendorID").agg(F.count(F.lit(1)).alias("_ap")))
    df = (vendors.join(alltime, "VendorID", "left").join(l30, "VendorID", "left").join(active, "VendorID", "left"))
    return df.select(
        "VendorID", "VendorName", "Email", "CommissionRate", "IsVerified", "IsActive", "CreatedAt",
        F.coalesce(C("_ap"), F.lit(0)).alias("ActiveProducts"),
        F.coalesce(C("TotalOrders"), F.lit(0)).alias("TotalOrders"), "TotalRevenue",
        (C("TotalRevenue") * C("CommissionRate") * F.lit(0.01).cast("decimal(2,2)")).alias("TotalCommission"),
        F.coalesce(C("_o30"), F.lit(0)).alias("Orders30d"),
        F.coalesce(C("_r30"), F.lit(0)).alias("Revenue30d"),
        F.coalesce(C("_u30"), F.lit(0)).alias("UnitsSold30d"),
        F.coalesce(C("_a30"), F.lit(0.0)).alias("AvgRating30d"))


# --------------------------------------------------------------------------- V5
def monthly_revenue(orders) -> DataFrame:
    """The V5 CTE: one row per calendar month of non-cancelled orders."""
    return (orders.filter(not_cancelled())
            .groupBy(F.year("PlacedAt").alias("RevenueYear"), F.month("PlacedAt").alias("RevenueMonth"),
                     month_start("PlacedAt").alias("MonthStart"))
            .agg(F.count_distinct("OrderID").alias("OrderCount"), F.sum("TotalAmount").alias("GrossRevenue"),
                 F.sum("DiscountAmount").alias("TotalDiscounts"),
                 F.sum(C("TotalAmount") - C("DiscountAmount")).alias("NetRevenue"),
                 F.count_distinct("CustomerID").alias("UniqueCustomers"),
                 exact_avg("TotalAmount").alias("AvgOrderValue")))


def revenue_monthly_trend(orders) -> DataFrame:
    """V5: MoM / YoY growth, YTD running total, 3-month rolling average, rank and percentile.

    The windows have no PARTITION BY, but run over months (bounded by the calendar, not by data):
    the single-partition exchange holds a few hundred rows at any scale."""
    m = monthly_revenue(orders)
    w = Window.orderBy("MonthStart")
    prev1, prev12 = F.lag("NetRevenue", 1).over(w), F.lag("NetRevenue", 12).over(w)
    ytd = Window.partitionBy("RevenueYear").orderBy("MonthStart").rowsBetween(Window.unboundedPreceding, 0)
    return (m.withColumn("PrevMonthRevenue", prev1)
            .withColumn("PrevMonthOrders", F.lag("OrderCount", 1).over(w))
            .withColumn("MoM_GrowthPct", growth_pct("NetRevenue", "PrevMonthRevenue"))
            .withColumn("SameMonthLastYear", prev12)
            .withColumn("YoY_GrowthPct", growth_pct("NetRevenue", "SameMonthLastYear"))
            .withColumn("YTD_Revenue", F.sum("NetRevenue").over(ytd))
            .withColumn("Rolling3MonthAvg", moving_avg_exact("NetRevenue", ["MonthStart"], 2))
            .withColumn("AllTimeRevenueRank", F.rank().over(Window.orderBy(C("NetRevenue").desc())))
            .withColumn("RevenuePercentile",
                        F.round(F.lit(100.0) * F.percent_rank().over(Window.orderBy("NetRevenue")), 1)))


# --------------------------------------------------------------------------- V6
def cohort_retention(customers, orders) -> DataFrame:
    """V6: active customers per (signup month, order month), retention %, cohort-size rank, peak."""
    cohorts = customers.filter(C("IsActive")).select("CustomerID", month_start("CreatedAt").alias("CohortMonth"))
    activity = (orders.filter(not_cancelled()).select("CustomerID", month_start("PlacedAt").alias("OrderMonth"))
                .distinct())
    act = (cohorts.join(activity, "CustomerID")
           .groupBy("CohortMonth", "OrderMonth",
                    boundary_diff("MONTH", C("CohortMonth"), C("OrderMonth")).alias("MonthsAfterJoin"))
           .agg(F.count_distinct("CustomerID").alias("ActiveCustomers")))
    sizes = cohorts.groupBy("CohortMonth").agg(F.count(F.lit(1)).alias("CohortSize"))
    df = act.join(sizes, "CohortMonth")
    # windows over (cohort × month) rows: bounded by the calendar
    return df.select(
        "CohortMonth", "CohortSize", "MonthsAfterJoin", "ActiveCustomers",
        F.round(F.lit(100.0) * C("ActiveCustomers") / C("CohortSize"), 1).alias("RetentionRate"),
        F.dense_rank().over(Window.orderBy(C("CohortSize").desc())).alias("CohortSizeRank"),
        first_value_full("ActiveCustomers", ["CohortMonth"], [C("ActiveCustomers").desc()]).alias("PeakActiveInCohort"))


# --------------------------------------------------------------------------- V7
TIERS = {1: "STAR", 2: "RISING", 3: "AVERAGE", 4: "UNDERPERFORMER"}  # fixed values: NTILE(4) labels


def product_revenue(products, categories, vendors, variants, lines, orders, reviews,
                    dedup_reviews: bool = False) -> DataFrame:
    """The V7 CTE: per product revenue, units, orders, average price and rating.

    Lines are aggregated per product *before* the dimension joins (partial aggregation happens
    map-side), so the large side is shuffled once; review fan-out (B2) is applied per product."""
    ok_orders = orders.filter(not_cancelled()).select("OrderID")
    per_product = (lines.select("OrderID", "VariantID", "Quantity", "LineTotal", "UnitPrice")
                   .join(ok_orders, "OrderID", "left_semi")
                   .join(variants.select("VariantID", "ProductID"), "VariantID")
                   .groupBy("ProductID")
                   .agg(F.count_distinct("OrderID").alias("OrderCount"), F.sum("Quantity").alias("_units"),
                        F.sum("LineTotal").alias("_rev"), exact_avg("UnitPrice").alias("AvgSellingPrice")))
    fan = review_fanout(reviews, dedup_reviews)
    dims = (products.select("ProductID", "ProductName", "CategoryID", "VendorID")
            .join(categories.select("CategoryID", "CategoryName"), "CategoryID")
            .join(vendors.select("VendorID", "VendorName"), "VendorID"))
    w = F.coalesce(C("_w"), F.lit(1).cast("bigint"))
    return (per_product.join(dims, "ProductID").join(fan, "ProductID", "left")
            .select("ProductID", "ProductName", "CategoryName", "VendorName", "OrderCount",
                    (C("_units") * w).alias("UnitsSold"), (C("_rev") * w).alias("TotalRevenue"), "AvgSellingPrice",
                    (C("_rsum").cast("double") / C("_rcnt").cast("double")).alias("AvgRating")))


def product_sales_ranking(products, categories, vendors, variants, lines, orders, reviews,
                          dedup_reviews: bool = False, plain_windows: bool = False) -> DataFrame:
    """V7: ROW_NUMBER / RANK / DENSE_RANK / NTILE(4) / tier / category rank / share / cumulative share.

    Global windows run through ``global_order`` (distributed prefix), never a single partition."""
    pr = product_revenue(products, categories, vendors, variants, lines, orders, reviews, dedup_reviews)
    g = global_order(pr, "TotalRevenue", ["ProductID"], descending=True, sum_col="TotalRevenue", ntile=4,
                     plain=plain_windows)
    tier = F.element_at(F.array(*[F.lit(TIERS[i]) for i in (1, 2, 3, 4)]), C("_ntile").cast("int"))
    # a rank over counted values instead of a window per category: categories are few and some are large
    g = rank_by_key(g, ["CategoryName"], "TotalRevenue", rank="_category")
    return g.select(
        "ProductID", "ProductName", "CategoryName", "VendorName", "OrderCount", "UnitsSold", "TotalRevenue",
        "AvgSellingPrice", F.round("AvgRating", 2).alias("AvgRating"),
        C("_rn").alias("RowNum_ByRevenue"), C("_rank").alias("Rank_ByRevenue"),
        C("_dense").alias("DenseRank_ByRevenue"), C("_ntile").alias("RevenueQuartile"), tier.alias("ProductTier"),
        C("_category").alias("RankWithinCategory"),
        F.round(F.lit(100.0) * C("TotalRevenue").cast("double") / C("_total").cast("double"), 2).alias("RevenueSharePct"),
        F.round(F.lit(100.0) * C("_running").cast("double") / C("_total").cast("double"), 2)
        .alias("CumulativeRevenueSharePct"))


# --------------------------------------------------------------------------- V8
def shipment_timeline(shipment_events) -> DataFrame:
    """V8 CTE (W2, W9, W15): per shipment, previous/next event and minutes since the previous one."""
    ev = shipment_events.select("ShipmentID", "EventID", "EventStatus", "EventAt", "EventLocation")
    t = neighbours_by_key(ev, ["ShipmentID"], ["EventAt", "EventID"], lags={"PrevStatus": "EventStatus", "PrevEventAt": "EventAt"},
                          leads={"NextStatus": "EventStatus", "NextEventAt": "EventAt"}, number="EventSequence")
    return t.withColumn("MinutesSincePrevEvent", boundary_diff("MINUTE", C("PrevEventAt"), C("EventAt")))


def delivery_sla(shipments, orders, customers, couriers, shipment_events, as_of,
                 grain: str = "event") -> DataFrame:
    """V8: SLA breach, days vs SLA, transit hours, event count, last known location.

    ``grain="event"`` replicates the reference's GROUP BY (one row per shipment event, B7);
    ``grain="shipment"`` groups by shipment only (the evident intent)."""
    asof_d = _as_of_date(as_of)
    s = (shipments.select("ShipmentID", "OrderID", "CourierID", "TrackingNumber", "ShipmentStatus",
                          "EstimatedDelivery", "ActualDelivery")
         .join(orders.select("OrderID", "CustomerID"), "OrderID")
         .join(customers.select("CustomerID", "FirstName", "LastName"), "CustomerID")
         .join(couriers.select("CourierID", "CourierName"), "CourierID"))
    ev = shipment_events.select("ShipmentID", "EventID", "EventAt", "EventLocation")
    df = s.join(ev, "ShipmentID", "left")
    keys = ["ShipmentID", "OrderID", "FirstName", "LastName", "CourierName", "TrackingNumber", "ShipmentStatus",
            "EstimatedDelivery", "ActualDelivery"]
    if grain == "event":
        keys = keys + ["EventLocation", "EventAt"]
    g = df.groupBy(*keys).agg(F.min("EventAt").alias("_first"), F.max("EventAt").alias("_last"),
                              F.count("EventID").alias("EventCount"),
                              F.max_by("EventLocation", "EventAt").alias("_lastloc"))
    actual_d = as_date("ActualDelivery")
    breach = (F.when(C("ActualDelivery").isNotNull() & (actual_d > C("EstimatedDelivery")), 1)
              .when(C("ActualDelivery").isNull() & (asof_d > C("EstimatedDelivery")), 1).otherwise(0))
    days = F.when(C("ActualDelivery").isNotNull(), F.datediff(actual_d, C("EstimatedDelivery"))) \
        .otherwise(F.datediff(asof_d, C("EstimatedDelivery")))
    # the shipment's newest location: a grouped maximum, not a window that gathers a shipment's events
    newest = ev.groupBy("ShipmentID").agg(F.max(F.struct("EventAt", "EventLocation")).alias("_new")) if grain == "event" else None
    last = C("_new.EventLocation") if grain == "event" else C("_lastloc")
    g = g.join(newest, "ShipmentID", "left") if grain == "event" else g
    return g.select(
        "ShipmentID", "OrderID", full_name().alias("CustomerName"), "CourierName", "TrackingNumber", "ShipmentStatus",
        "EstimatedDelivery", "ActualDelivery", breach.alias("SLABreached"), days.alias("DaysVsSLA"),
        boundary_diff("HOUR", C("_first"), C("_last")).alias("TotalTransitHours"), "EventCount",
        last.alias("LastKnownLocation"))


def register_views(spark, frames: dict, as_of) -> None:
    """Expose the views as temp views under the reference's names."""
    f = frames
    views = {
        "vw_OrderDetail": order_detail(f["Order"], f["Customer"], f["Address"], f["City"], f["Province"],
                                       f["Discount"], f["Payment"], f["Shipment"], f["Courier"], f["OrderLine"], as_of),
        "vw_ProductCatalogue": product_catalogue(f["Product"], f["Category"], f["Vendor"], f["ProductVariant"],
                                                 f["StockLevel"], f["Review"], f["Discount"], as_of),
        "vw_Customer360": customer_360(f["Customer"], f["Order"], f["Address"], f["Review"], as_of),
        "vw_VendorPerformance": vendor_performance(f["Vendor"], f["Product"], f["ProductVariant"], f["OrderLine"],
                                                   f["Order"], f["Review"], as_of),
        "vw_RevenueMonthlyTrend": revenue_monthly_trend(f["Order"]),
        "vw_CustomerCohortRetention": cohort_retention(f["Customer"], f["Order"]),
        "vw_ProductSalesRanking": product_sales_ranking(f["Product"], f["Category"], f["Vendor"], f["ProductVariant"],
                                                        f["OrderLine"], f["Order"], f["Review"]),
        "vw_DeliverySLAPerformance": delivery_sla(f["Shipment"], f["Order"], f["Customer"], f["Courier"],
                                                  f["ShipmentEvent"], as_of),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
