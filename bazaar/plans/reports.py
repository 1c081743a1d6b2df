"""Named report queries X1–X18 as lazy DataFrame functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaar.functions.expr import as_date, exact_avg, full_name, ts_lit
from bazaar.operators.grouping import cube_distinct, pivot_sum, rollup_labelled
from bazaar.operators.hierarchy import tree_display, tree_walk
from bazaar.operators.search import clamp_page, fold_predicates, optional_eq, page, sort_spec
from bazaar.operators.windows import global_order, scan_by_key
from bazaar.plans.views import not_cancelled, product_sales_ranking, revenue_monthly_trend

C = F.col


def _line_facts(lines, orders, variants, products, order_cols=("OrderID",), product_cols=("ProductID",),
                only_valid=True) -> DataFrame:
    """OrderLine ⋈ Order (not cancelled) ⋈ ProductVariant ⋈ Product, projected to what is needed."""
    o = orders.filter(not_cancelled()) if only_valid else orders
    o = o.select(*dict.fromkeys(("OrderID",) + tuple(order_cols)))
    ln = lines.drop("ProductID") if "ProductID" in lines.columns else lines
    # the products come to their variants first: every join of the lines moves all of them once more
    v = variants.select("VariantID", "ProductID").join(products.select(*dict.fromkeys(("ProductID",) + tuple(product_cols))), "ProductID")
    return ln.join(o, "OrderID").join(v, "VariantID")


# --------------------------------------------------------------------------- X1
def category_tree(categories, products, max_depth: int | None = None) -> DataFrame:
    """Recursive category tree (H1) with indented display (H2) and direct active product count."""
    tree = tree_walk(categories, max_depth=max_depth)
    counts = products.filter(C("IsActive")).groupBy("CategoryID").agg(F.count(F.lit(1)).alias("_n"))
    return (tree.join(counts, "CategoryID", "left")
            .select(tree_display(tree).alias("TreeDisplay"), "BreadcrumbPath", "Depth", "IDPath",
                    F.coalesce(C("_n"), F.lit(0)).alias("DirectProductCount"))
            .orderBy("IDPath"))


# --------------------------------------------------------------------------- X2
def customers_above_city_average(customers, addresses, cities, orders) -> DataFrame:
    """Customers whose total spend exceeds the average *order* amount of their default city.

    The correlated subquery is computed once per city and joined (G6), not three times per row."""
    valid = orders.filter(not_cancelled()).select("OrderID", "CustomerID", "TotalAmount")
    home = addresses.filter(C("IsDefault")).select("CustomerID", "CityID")
    city_avg = (valid.join(customers.select("CustomerID"), "CustomerID").join(home, "CustomerID")
                .groupBy("CityID").agg(exact_avg("TotalAmount").alias("CityAvgSpend")))
    spend = (customers.select("CustomerID", "FirstName", "LastName").join(home, "CustomerID")
             .join(cities.select("CityID", "CityName"), "CityID").join(valid, "CustomerID")
             .groupBy("CustomerID", "FirstName", "LastName", "CityName", "CityID")
             .agg(F.sum("TotalAmount").alias("CustomerTotalSpend")))
    out = spend.join(city_avg, "CityID")
    above = C("CustomerTotalSpend").cast("double") - C("CityAvgSpend")
    return (out.filter(C("CustomerTotalSpend").cast("double") > C("CityAvgSpend"))
            .select("CustomerID", full_name().alias("CustomerName"), "CityName", "CustomerTotalSpend", "CityAvgSpend",
                    above.alias("AboveCityAvg"))
            .orderBy(C("AboveCityAvg").desc()))


# --------------------------------------------------------------------------- X3
def top_products_per_vendor(vendors, products, variants, lines, orders, n: int = 3) -> DataFrame:
    """CROSS APPLY TOP n per active vendor, grouped by product *name*.

    ``row_number() <= n`` is planned with a map-side WindowGroupLimit, so a vendor holding a third
    of all products still ships only n rows per map task."""
    facts = _line_facts(lines, orders, variants, products, product_cols=("VendorID", "ProductName"))
    per = facts.groupBy("VendorID", "ProductName").agg(F.sum("LineTotal").alias("TotalRevenue"),
                                                        F.count_distinct("OrderID").alias("OrderCount"))
    w = Window.partitionBy("VendorID").orderBy(C("TotalRevenue").desc(), C("ProductName"))
    top = per.withColumn("ProductRank", F.row_number().over(w)).filter(C("ProductRank") <= n)
    return (vendors.filter(C("IsActive")).select("VendorID", "VendorName").join(top, "VendorID")
            .select("VendorID", "VendorName", "ProductName", "TotalRevenue", "OrderCount", "ProductRank")
            .orderBy("VendorName", "ProductRank"))


# --------------------------------------------------------------------------- X4 / X5
def never_ordered_products(products, variants, lines, orders=None, since=None, status=None) -> DataFrame:
    """X4 (U1): active products EXCEPT products with an order line. ``since`` / ``status`` restrict
    the orders that count (e.g. CONFIRMED orders since a date); default = any line ever."""
    ln = lines.select("OrderID", "VariantID")
    if since is not None or status is not None:
        o = orders
        if since is not None:
            o = o.filter(C("PlacedAt") >= ts_lit(since))
        if status is not None:
            o = o.filter(C("OrderStatus") == status)
        ln = ln.join(o.select("OrderID"), "OrderID", "left_semi")
    left = products.filter(C("IsActive")).select("ProductID", "ProductName", F.lit("NEVER_ORDERED").alias("Status"))
    right = (products.select("ProductID", "ProductName").join(variants.select("VariantID", "ProductID"), "ProductID")
             .join(ln, "VariantID").select("ProductID", "ProductName", F.lit("NEVER_ORDERED").alias("Status")))
    return left.subtract(right)


def ordered_but_out_of_stock(products, variants, lines, stock_levels) -> DataFrame:
    """X5 (U2): ordered products INTERSECT products with any variant at zero stock anywhere."""
    pv = products.select("ProductID", "ProductName").join(variants.select("VariantID", "ProductID"), "ProductID")
    tag = F.lit("ORDERED_BUT_OOS").alias("Status")
    ordered = pv.join(lines.select("VariantID"), "VariantID").select("ProductID", "ProductName", tag).distinct()
    oos = (pv.join(stock_levels.filter(C("QuantityOnHand") == 0).select("VariantID"), "VariantID")
           .select("ProductID", "ProductName", tag).distinct())
    return ordered.intersect(oos)


# --------------------------------------------------------------------------- X7
def order_product_summary(orders, customers, lines, variants, products, as_of, days: int = 30) -> DataFrame:
    """Per recent order, line count and the product names in name order (STRING_AGG, G10)."""
    recent = orders.filter(C("PlacedAt") >= ts_lit(as_of) - F.expr(f"INTERVAL {int(days)} DAYS"))
    df = (recent.select("OrderID", "PlacedAt", "CustomerID", "TotalAmount")
          .join(customers.select("CustomerID", "FirstName", "LastName"), "CustomerID")
          .join(lines.select("OrderID", "OrderLineID", "VariantID"), "OrderID")
          .join(variants.select("VariantID", "ProductID"), "VariantID")
          .join(products.select("ProductID", "ProductName"), "ProductID"))
    # collect_list is bounded by the lines of one order
    return (df.groupBy("OrderID", "PlacedAt", "FirstName", "LastName", "TotalAmount")
            .agg(F.count("OrderLineID").alias("LineCount"),
                 F.array_join(F.array_sort(F.collect_list("ProductName")), ", ").alias("ProductsSummary"))
            .select("OrderID", "PlacedAt", full_name().alias("CustomerName"), "LineCount", "TotalAmount",
                    "ProductsSummary")
            .orderBy(C("PlacedAt").desc()))


# --------------------------------------------------------------------------- X8 / X9
def _geo_facts(lines, orders, variants, products, categories, addresses, cities, provinces, vendors=None):
    # what belongs to an order and to a product is joined before the lines, which are moved for these two alone
    places = (addresses.select(C("AddressID").alias("ShippingAddressID"), "CityID")
              .join(cities.select("CityID", "ProvinceID"), "CityID")
              .join(provinces.select("ProvinceID", "ProvinceName"), "ProvinceID"))
    products = products.select("ProductID", "CategoryID", "VendorID").join(categories.select("CategoryID", "CategoryName"), "CategoryID")
    if vendors is not None:
        products = products.join(vendors.select("VendorID", "VendorName"), "VendorID")
    named = ["CategoryName", *(["VendorName"] if vendors is not None else [])]
    orders = orders.filter(not_cancelled()).select("OrderID", "CustomerID", "ShippingAddressID").join(places.select("ShippingAddressID", "ProvinceName"), "ShippingAddressID")
    return _line_facts(lines, orders, variants, products, order_cols=("CustomerID", "ProvinceName"), product_cols=named, only_valid=False)


def province_category_rollup(lines, orders, variants, products, categories, addresses, cities, provinces) -> DataFrame:
    """ROLLUP(province, category) with subtotal / grand-total labels, totals ordered last."""
    facts = _geo_facts(lines, orders, variants, products, categories, addresses, cities, provinces)
    # lines shrink to (province, category, order) before the grouping sets copy them
    facts = facts.groupBy("ProvinceName", "CategoryName", "OrderID").agg(
        F.sum("Quantity").alias("_units"), F.sum("LineTotal").alias("_revenue"), F.count("LineTotal").alias("_lines"))
    out = rollup_labelled(
        facts, ["ProvinceName", "CategoryName"],
        [F.count_distinct("OrderID").alias("OrderCount"), F.sum("_units").alias("UnitsSold"),
         F.round(F.sum("_revenue"), 2).alias("TotalRevenue"),
         F.round(F.sum("_revenue").cast("double") / F.sum("_lines").cast("double"), 2).alias("AvgLineValue")],
        grouping_cols={"ProvinceName": "_gp", "CategoryName": "_gc"})
    row_type = (F.when((C("_gp") == 1) & (C("_gc") == 1), "GRAND TOTAL")
                .when(C("_gc") == 1, "Province Subtotal").otherwise("Detail"))
    return (out.orderBy("_gp", "_gc", "ProvinceName", "CategoryName")
            .select(F.coalesce(C("ProvinceName"), F.lit("── ALL PROVINCES")).alias("Province"),
                    F.coalesce(C("CategoryName"), F.lit("── ALL CATEGORIES")).alias("Category"),
                    "OrderCount", "UnitsSold", "TotalRevenue", "AvgLineValue", row_type.alias("RowType")))


def province_category_vendor_cube(lines, orders, variants, products, categories, addresses, cities, provinces,
                                  vendors) -> DataFrame:
    """CUBE(province, category, vendor), GROUPING() flags, HAVING revenue > 0."""
    facts = _geo_facts(lines, orders, variants, products, categories, addresses, cities, provinces, vendors)
    dims = ["ProvinceName", "CategoryName", "VendorName"]
    out = cube_distinct(facts, dims, "CustomerID", "UniqueCustomers", {"_rev": "LineTotal"})
    out = out.select(*[F.when(C(f"_g_{d}") == 1, "ALL").otherwise(F.coalesce(d, F.lit("ALL"))).alias(d) for d in dims], "_rev", "UniqueCustomers",
                     C("_g_ProvinceName").alias("IsProvinceAgg"), C("_g_CategoryName").alias("IsCategoryAgg"), C("_g_VendorName").alias("IsVendorAgg"))
    return (out.filter(C("_rev") > 0)
            .select(C("ProvinceName").alias("Province"), C("CategoryName").alias("Category"),
                    C("VendorName").alias("Vendor"), F.round("_rev", 2).alias("Revenue"), "UniqueCustomers",
                    "IsProvinceAgg", "IsCategoryAgg", "IsVendorAgg")
            .orderBy(C("IsProvinceAgg").desc(), C("IsCategoryAgg").desc(), C("IsVendorAgg").desc(),
                     C("Revenue").desc()))


# --------------------------------------------------------------------------- X10
def month_list(as_of, months_back: int = 6) -> list[str]:
    """The 'yyyy-MM' labels from as_of − months_back months to the as_of month (B18: a parameter)."""
    import datetime as dt
    d = as_of if isinstance(as_of, dt.datetime) else dt.datetime.fromisoformat(str(as_of))
    out = []
    for k in range(months_back, -1, -1):
        y, m = divmod(d.year * 12 + (d.month - 1) - k, 12)
        out.append(f"{y:04d}-{m + 1:02d}")
    return out


def category_month_pivot(lines, orders, variants, products, categories, as_of, months: list[str] | None = None,
                         months_back: int = 6) -> DataFrame:
    """Revenue by category × 'yyyy-MM' month, pivoted over an explicit month list."""
    t = ts_lit(as_of)
    o = orders.filter(not_cancelled() & (C("PlacedAt") >= F.add_months(t, -months_back)))
    facts = (_line_facts(lines, o, variants, products, order_cols=("PlacedAt",), product_cols=("CategoryID",),
                         only_valid=False)
             .join(categories.select("CategoryID", "CategoryName"), "CategoryID"))
    monthly = (facts.groupBy("CategoryName", F.date_format("PlacedAt", "yyyy-MM").alias("YearMonth"))
               .agg(F.sum("LineTotal").alias("Revenue")))
    months = months or month_list(as_of, months_back)
    return pivot_sum(monthly, ["CategoryName"], "YearMonth", months, "Revenue").orderBy("CategoryName")


# --------------------------------------------------------------------------- X11
ABC = ("A — Core", "B — Supporting", "C — Long Tail")  # fixed values: ABC class labels


def pareto_abc(lines, orders, variants, products, categories, plain_windows: bool = False) -> DataFrame:
    """X11: Pareto shares and ABC class (A ≤ 80 %, B ≤ 95 % of the inclusive cumulative share, B17)."""
    facts = _line_facts(lines, orders, variants, products, product_cols=("ProductName", "CategoryID"))
    per = (facts.groupBy("ProductID").agg(F.round(F.sum("LineTotal"), 2).alias("Revenue"))
           .join(products.select("ProductID", "ProductName", "CategoryID"), "ProductID")
           .join(categories.select("CategoryID", "CategoryName"), "CategoryID"))
    g = global_order(per, "Revenue", ["ProductID"], descending=True, sum_col="Revenue", plain=plain_windows)
    cum = F.round(F.lit(100.0) * C("_running").cast("double") / C("_total").cast("double"), 2)
    return (g.select(C("_rn").alias("RevenueRank"), "ProductID", "ProductName", "CategoryName", "Revenue",
                     F.round(F.lit(100.0) * C("Revenue").cast("double") / C("_total").cast("double"), 2)
                     .alias("RevenueSharePct"),
                     cum.alias("CumulativeSharePct"), C("_total").alias("TotalRevenue"))
            .withColumn("ABCClass", F.when(C("CumulativeSharePct") <= 80, ABC[0])
                        .when(C("CumulativeSharePct") <= 95, ABC[1]).otherwise(ABC[2])))


# --------------------------------------------------------------------------- X12
def customer_ltv(orders, customers) -> DataFrame:
    """Running lifetime value, order number, days since last order, running average gap
    (RANGE frame: orders on the same date share the value; the LAG is materialised first, B11)."""
    cs = orders.filter(not_cancelled()).select("OrderID", "CustomerID", as_date("PlacedAt").alias("OrderDate"),
                                             "TotalAmount")
    step = scan_by_key(cs, ["CustomerID"], ["OrderDate", "OrderID"], number="OrderNumber", lags={"_before": "OrderDate"},
                       sums={"LifetimeValueToDate": "TotalAmount"}, firsts={"_start": "OrderDate"}, through=("_upto", "OrderDate"))
    step = step.withColumn("DaysSinceLastOrder", F.datediff("OrderDate", "_before"))
    # the RANGE frame ends with the day; the gaps up to a day add up to the days since the customer's first order
    gaps = F.datediff("OrderDate", "_start").cast("double") / (C("_upto") - 1).cast("double")
    step = step.withColumn("AvgOrderGapDays", F.when(C("_upto") > 1, gaps))
    return (step.join(customers.select("CustomerID", "FirstName", "LastName", "CreatedAt"), "CustomerID")
            .select("CustomerID", "OrderID", full_name().alias("CustomerName"), C("CreatedAt").alias("MemberSince"),
                    "OrderDate", "TotalAmount", "LifetimeValueToDate", "OrderNumber", "DaysSinceLastOrder",
                    "AvgOrderGapDays")
            .orderBy("CustomerID", "OrderDate", "OrderID"))


# --------------------------------------------------------------------------- X13 / X18
def search_orders(orders, customers, addresses, cities, lines, variants, products, *, customer_id=None,
                  vendor_id=None, status=None, from_date=None, to_date=None, min_amount=None, max_amount=None,
                  province_id=None, order_id=None, sort_by="PlacedAt", sort_dir="DESC", page_number=1,
                  page_size=25):
    """Order search with up to 9 optional filters → (page DataFrame, total-count DataFrame).

    Filters fold into one predicate (no SQL text); vendor uses EXISTS (semi join, J5); province uses
    IN (subquery) (semi join, J7). The page sort appends OrderID as tie-breaker (B20)."""
    base = (orders.select("OrderID", "CustomerID", "ShippingAddressID", "OrderStatus", "SubtotalAmount",
                          "DiscountAmount", "TotalAmount", "PlacedAt", "UpdatedAt")
            .join(customers.select("CustomerID", "FirstName", "LastName", "Email"), "CustomerID")
            .join(addresses.select(C("AddressID").alias("ShippingAddressID"), "CityID"), "ShippingAddressID"))
    preds = [optional_eq("OrderID", order_id), optional_eq("CustomerID", customer_id),
             optional_eq("OrderStatus", status),
             None if from_date is None else C("PlacedAt") >= ts_lit(from_date),
             None if to_date is None else C("PlacedAt") <= ts_lit(to_date),
             None if min_amount is None else C("TotalAmount") >= F.lit(min_amount),
             None if max_amount is None else C("TotalAmount") <= F.lit(max_amount)]
    df = base.filter(fold_predicates(preds))
    if province_id is not None:
        df = df.join(cities.filter(C("ProvinceID") == province_id).select("CityID"), "CityID", "left_semi")
    if vendor_id is not None:
        vend_orders = (lines.select("OrderID", "VariantID").join(variants.select("VariantID", "ProductID"), "VariantID")
                       .join(products.filter(C("VendorID") == vendor_id).select("ProductID"), "ProductID")
                       .select("OrderID"))
        df = df.join(vend_orders, "OrderID", "left_semi")
    rows = df.select("OrderID", "CustomerID", full_name().alias("CustomerName"), C("Email").alias("CustomerEmail"),
                     "OrderStatus", "SubtotalAmount", "DiscountAmount", "TotalAmount", "PlacedAt", "UpdatedAt")
    p, size = clamp_page(page_number, page_size)
    page_df = page(rows, sort_spec(sort_by, sort_dir, "OrderID"), p, size)
    total = rows.agg(F.count(F.lit(1)).alias("TotalCount")).select(
        "TotalCount", F.lit(size).alias("PageSize"), F.lit(p).alias("PageNumber"),
        F.ceil(C("TotalCount") / F.lit(size)).alias("TotalPages"))
    return page_df, total


# --------------------------------------------------------------------------- X15
def low_stock_report(stock_levels, warehouses, variants, products, vendors, warehouse_id=None,
                     include_zero: bool = True) -> DataFrame:
    """Stock at or below reorder point, severity label, ordered by severity then quantity (S3)."""
    q, rp = C("QuantityOnHand"), C("ReorderPoint")
    preds = [q <= rp, optional_eq("WarehouseID", warehouse_id), None if include_zero else q > 0]
    df = (stock_levels.filter(fold_predicates(preds))
          .join(warehouses.select("WarehouseID", "WarehouseName"), "WarehouseID")
          .join(variants.filter(C("IsActive")).select("VariantID", "ProductID", "SKU", "SizeName", "ColourName"),
                "VariantID")
          .join(products.filter(C("IsActive")).select("ProductID", "ProductName", "VendorID"), "ProductID")
          .join(vendors.select("VendorID", "VendorName", C("Email").alias("VendorEmail")), "VendorID"))
    status = (F.when(q == 0, "OUT_OF_STOCK").when(q <= rp * 0.5, "CRITICAL").when(q <= rp, "LOW")
              .otherwise("ADEQUATE"))
    severity = F.when(q == 0, 0).when(q <= rp * 0.5, 1).otherwise(2)
    return (df.orderBy(severity, q, "WarehouseID", "VariantID")
            .select("WarehouseID", "VariantID", "WarehouseName", "SKU", "ProductName", "SizeName", "ColourName",
                    "QuantityOnHand", "ReorderPoint", (rp - q).alias("Shortfall"), status.alias("StockStatus"),
                    "VendorName", "VendorEmail"))


# --------------------------------------------------------------------------- X16 / X17
def latest_trend_months(orders, months: int = 12) -> DataFrame:
    """The latest N months of the V5 trend (1 ≤ N ≤ 60, default 12; other N raise) — a top-k report."""
    n = 12 if months is None else int(months)
    if not 1 <= n <= 60:
        raise ValueError("months must be between 1 and 60")
    return revenue_monthly_trend(orders).orderBy(C("MonthStart").desc()).limit(n)


def product_ranking_in_category(products, categories, vendors, variants, lines, orders, reviews,
                                category: str | None = None, top: int | None = None) -> DataFrame:
    """V7 ranks computed over *all* products, then filtered to one category (P7), optional top-k."""
    r = product_sales_ranking(products, categories, vendors, variants, lines, orders, reviews)
    if category is not None:
        r = r.filter(C("CategoryName") == category)
    r = r.orderBy("RowNum_ByRevenue")
    return r.limit(top) if top else r
