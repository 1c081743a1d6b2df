"""Catalog entries for constraint auditing (Q1–Q5) and normalisation (N1–N5), with oracles."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.operators import dependencies as DEP
from bazaar.operators import quality as Q
from bazaar.plans import normalise as N
from bazaar.plans.catalog import query
from bazaar.session import scratch
from bazaar.sources.bindings import DISCOUNT_TYPES, PAYMENT_METHODS

C = F.col

# The enumerations of the schema's CHECK constraints.
PAYMENT_STATUSES = ["PENDING", "AUTHORISED", "CAPTURED", "FAILED", "REFUNDED"]
SHIPMENT_STATUSES = ["PENDING", "COLLECTED", "IN_TRANSIT", "OUT_FOR_DELIVERY", "DELIVERED", "FAILED", "RETURNED"]
ADDRESS_TYPES = ["SHIPPING", "BILLING", "BOTH"]
ORDER_STATUSES = ["PENDING", "CONFIRMED", "PROCESSING", "SHIPPED", "DELIVERED", "CANCELLED", "REFUNDED"]


# ----------------------------------------------------------------------------- Q1
Q1_SQL = """
SELECT 'OrderLine' AS "table", rule, kind, CAST(violations AS BIGINT) AS violations FROM (
  SELECT 'CK_Quantity' AS rule, 'CHECK' AS kind, sum(CASE WHEN Quantity <= 0 THEN 1 ELSE 0 END) AS violations FROM b_line
  UNION ALL SELECT 'CK_UnitPrice', 'CHECK', sum(CASE WHEN UnitPrice < 0 THEN 1 ELSE 0 END) FROM b_line
  UNION ALL SELECT 'NN_VariantID', 'NOT_NULL', sum(CASE WHEN VariantID IS NULL THEN 1 ELSE 0 END) FROM b_line
  UNION ALL SELECT 'UQ_OrderID_VariantID', 'UNIQUE', coalesce(sum(n - 1), 0)
            FROM (SELECT OrderID, VariantID, count(*) AS n FROM b_line GROUP BY OrderID, VariantID HAVING count(*) > 1)
  UNION ALL SELECT 'FK_OrderID', 'FK', count(*) FROM b_line l WHERE NOT EXISTS (SELECT 1 FROM b_order o WHERE o.OrderID = l.OrderID))
UNION ALL
SELECT 'Order', rule, kind, CAST(violations AS BIGINT) FROM (
  SELECT 'CK_OrderStatus' AS rule, 'CHECK' AS kind,
         sum(CASE WHEN OrderStatus NOT IN ('PENDING','CONFIRMED','PROCESSING','SHIPPED','DELIVERED','CANCELLED','REFUNDED')
                  THEN 1 ELSE 0 END) AS violations FROM b_order
  UNION ALL SELECT 'CK_TotalAmount', 'CHECK', sum(CASE WHEN TotalAmount < 0 THEN 1 ELSE 0 END) FROM b_order
  UNION ALL SELECT 'FK_CustomerID', 'FK', count(*) FROM b_order o WHERE NOT EXISTS (SELECT 1 FROM b_customer c WHERE c.CustomerID = o.CustomerID))
UNION ALL
SELECT 'Customer', rule, kind, CAST(violations AS BIGINT) FROM (
  SELECT 'CK_LoyaltyPoints' AS rule, 'CHECK' AS kind, sum(CASE WHEN LoyaltyPoints < 0 THEN 1 ELSE 0 END) AS violations FROM b_customer
  UNION ALL SELECT 'LEN_Email_254', 'MAX_LENGTH', sum(CASE WHEN length(Email) > 254 THEN 1 ELSE 0 END) FROM b_customer
  UNION ALL SELECT 'UQ_Email', 'UNIQUE', coalesce(sum(n - 1), 0)
            FROM (SELECT Email, count(*) AS n FROM b_customer GROUP BY Email HAVING count(*) > 1))
UNION ALL
SELECT 'Vendor', 'CK_CommissionRate', 'CHECK',
  CAST(sum(CASE WHEN CommissionRate < 0 OR CommissionRate > 100 THEN 1 ELSE 0 END) AS BIGINT) FROM b_vendor
UNION ALL FROM b_review SELECT 'Review', 'CK_Rating', 'CHECK', count(*) FILTER (WHERE Rating NOT BETWEEN 1 AND 5)
UNION ALL FROM b_review SELECT 'Review', 'UQ_ProductID_CustomerID', 'UNIQUE', count(*) - count(DISTINCT (ProductID, CustomerID))
UNION ALL FROM b_review ANTI JOIN b_product USING (ProductID) SELECT 'Review', 'FK_ProductID', 'FK', count(*)
UNION ALL FROM b_stock SELECT 'StockLevel', 'CK_QuantityOnHand', 'CHECK', count(*) FILTER (WHERE QuantityOnHand < 0)
UNION ALL FROM b_stock SELECT 'StockLevel', 'UQ_WarehouseID_VariantID', 'UNIQUE', count(*) - count(DISTINCT (WarehouseID, VariantID))
UNION ALL FROM b_stock ANTI JOIN b_variant USING (VariantID) SELECT 'StockLevel', 'FK_VariantID', 'FK', count(*)
UNION ALL FROM b_payment SELECT 'Payment', 'CK_PaymentMethod', 'CHECK', count(*) FILTER (WHERE NOT list_contains({methods}, PaymentMethod))
UNION ALL FROM b_payment SELECT 'Payment', 'CK_PaymentStatus', 'CHECK', count(*) FILTER (WHERE NOT list_contains({payment}, PaymentStatus))
UNION ALL FROM b_payment ANTI JOIN b_order USING (OrderID) SELECT 'Payment', 'FK_OrderID', 'FK', count(*)
UNION ALL FROM b_shipment SELECT 'Shipment', 'CK_ShipmentStatus', 'CHECK', count(*) FILTER (WHERE NOT list_contains({shipment}, ShipmentStatus))
UNION ALL FROM b_shipment ANTI JOIN b_order USING (OrderID) SELECT 'Shipment', 'FK_OrderID', 'FK', count(*)
UNION ALL FROM b_discount SELECT 'Discount', 'CK_DiscountType', 'CHECK', count(*) FILTER (WHERE NOT list_contains({discount}, DiscountType))
UNION ALL FROM b_discount SELECT 'Discount', 'CK_DiscountValue', 'CHECK', count(*) FILTER (WHERE DiscountValue <= 0)
UNION ALL FROM b_discount SELECT 'Discount', 'UQ_DiscountCode', 'UNIQUE', count(*) - count(DISTINCT DiscountCode)
UNION ALL FROM b_product SELECT 'Product', 'CK_BasePrice', 'CHECK', count(*) FILTER (WHERE BasePrice < 0)
UNION ALL FROM b_product SELECT 'Product', 'UQ_ProductSlug', 'UNIQUE', count(*) - count(DISTINCT ProductSlug)
UNION ALL FROM b_product ANTI JOIN b_vendor USING (VendorID) SELECT 'Product', 'FK_VendorID', 'FK', count(*)
UNION ALL FROM b_product ANTI JOIN b_category USING (CategoryID) SELECT 'Product', 'FK_CategoryID', 'FK', count(*)
UNION ALL FROM b_variant SELECT 'ProductVariant', 'UQ_SKU', 'UNIQUE', count(*) - count(DISTINCT SKU)
UNION ALL FROM b_variant ANTI JOIN b_product USING (ProductID) SELECT 'ProductVariant', 'FK_ProductID', 'FK', count(*)
UNION ALL FROM b_address SELECT 'Address', 'CK_AddressType', 'CHECK', count(*) FILTER (WHERE NOT list_contains({address}, AddressType))
UNION ALL FROM b_address ANTI JOIN b_customer USING (CustomerID) SELECT 'Address', 'FK_CustomerID', 'FK', count(*)
""".format(methods=PAYMENT_METHODS, payment=PAYMENT_STATUSES, shipment=SHIPMENT_STATUSES, discount=DISCOUNT_TYPES, address=ADDRESS_TYPES)


@query("q1_constraint_audit", Q1_SQL)
def q1(c):
    """Q1 constraint audit: CHECK, NOT NULL, max length, UNIQUE and FK rules of eleven tables (ratings and stock included)."""
    ln, o, cu, v = c.order_line(), c.order(), c.customer(), c.vendor()
    a = Q.audit(ln, "OrderLine", [Q.check("CK_Quantity", C("Quantity") > 0, "Quantity"),
                                  Q.check("CK_UnitPrice", C("UnitPrice") >= 0, "UnitPrice"), Q.not_null("VariantID"),
                                  Q.unique("OrderID", "VariantID"), Q.foreign_key(["OrderID"], o)])
    b = Q.audit(o, "Order", [Q.check("CK_OrderStatus", C("OrderStatus").isin(*ORDER_STATUSES), "OrderStatus"),
                             Q.check("CK_TotalAmount", C("TotalAmount") >= 0, "TotalAmount"),
                             Q.foreign_key(["CustomerID"], cu)])
    d = Q.audit(cu, "Customer", [Q.check("CK_LoyaltyPoints", C("LoyaltyPoints") >= 0, "LoyaltyPoints"),
                                 Q.max_length("Email", 254), Q.unique("Email")])
    e = Q.audit(v, "Vendor", [Q.check("CK_CommissionRate", C("CommissionRate").between(0, 100), "CommissionRate")])
    r, st, pay, sh, di, pr, va, ad = c.review(), c.stock_level(), c.payment(), c.shipment(), c.discount(), c.product(), c.variant(), c.address()
    more = [
        (r, "Review", [Q.check("CK_Rating", C("Rating").between(1, 5), "Rating"), Q.unique("ProductID", "CustomerID"), Q.foreign_key(["ProductID"], pr)]),
        (st, "StockLevel", [Q.check("CK_QuantityOnHand", C("QuantityOnHand") >= 0, "QuantityOnHand"), Q.unique("WarehouseID", "VariantID"), Q.foreign_key(["VariantID"], va)]),
        (pay, "Payment", [Q.check("CK_PaymentMethod", C("PaymentMethod").isin(*PAYMENT_METHODS), "PaymentMethod"),
                          Q.check("CK_PaymentStatus", C("PaymentStatus").isin(*PAYMENT_STATUSES), "PaymentStatus"), Q.foreign_key(["OrderID"], o)]),
        (sh, "Shipment", [Q.check("CK_ShipmentStatus", C("ShipmentStatus").isin(*SHIPMENT_STATUSES), "ShipmentStatus"), Q.foreign_key(["OrderID"], o)]),
        (di, "Discount", [Q.check("CK_DiscountType", C("DiscountType").isin(*DISCOUNT_TYPES), "DiscountType"), Q.check("CK_DiscountValue", C("DiscountValue") > 0, "DiscountValue"),
                          Q.unique("DiscountCode")]),
        (pr, "Product", [Q.check("CK_BasePrice", C("BasePrice") >= 0, "BasePrice"), Q.unique("ProductSlug"), Q.foreign_key(["VendorID"], v), Q.foreign_key(["CategoryID"], c.category())]),
        (va, "ProductVariant", [Q.unique("SKU"), Q.foreign_key(["ProductID"], pr)]),
        (ad, "Address", [Q.check("CK_AddressType", C("AddressType").isin(*ADDRESS_TYPES), "AddressType"), Q.foreign_key(["CustomerID"], cu)])]
    return reduce(DataFrame.unionByName, [a, b, d, e, *[Q.audit(*x) for x in more]])


# ----------------------------------------------------------------------------- Q2
Q2_SQL = """
SELECT DiscountID, CAST(coalesce(MinOrderValue, 0) AS DOUBLE) AS MinOrderValue,
  coalesce(ValidTo, TIMESTAMP '2099-12-31 00:00:00') AS ValidTo, CAST(coalesce(UsageCount, 0) AS BIGINT) AS UsageCount
FROM b_discount"""


@query("q2_default_filling", Q2_SQL)
def q2(c):
    """Q2 default filling on ingest (NULL → column default)."""
    d = c.discount()
    filled = Q.apply_defaults(d, {"MinOrderValue": Decimal("0"), "UsageCount": 0})
    filled = filled.withColumn("ValidTo", F.coalesce(C("ValidTo"), F.expr("TIMESTAMP_NTZ '2099-12-31 00:00:00'")))
    return filled.select("DiscountID", "MinOrderValue", "ValidTo", "UsageCount")


# ----------------------------------------------------------------------------- Q3
Q3_SQL = """
SELECT product_id, customer_id, created_at,
  CASE WHEN product_id IS NULL THEN 'required:product_id' WHEN customer_id IS NULL THEN 'required:customer_id'
       WHEN rating IS NULL THEN 'required:rating' WHEN created_at IS NULL THEN 'required:created_at'
       WHEN rating < 1 OR rating > 5 THEN 'rating_1_5' WHEN length(title) > 200 THEN 'LEN_title_200'
       WHEN helpful_votes < 0 THEN 'helpful_votes_min_0' WHEN helpful_votes >= 150 THEN 'helpful_votes_max_149' END AS rejection
FROM b_review_doc"""


@query("q3_document_validation", Q3_SQL)
def q3(c):
    """Q3 $jsonSchema validation of review documents → first failed rule per document (NULL = valid).
    The helpful-votes upper bound (< 150) is a stricter-than-reference rule so the quarantine is non-empty."""
    rules = [Q.check("rating_1_5", C("rating").between(1, 5), "rating"), Q.max_length("title", 200),
             Q.check("helpful_votes_min_0", C("helpful_votes") >= 0, "helpful_votes"),
             Q.check("helpful_votes_max_149", C("helpful_votes") < 150, "helpful_votes")]
    v = Q.validate_documents(c.review_docs(), ["product_id", "customer_id", "rating", "created_at"], rules)
    return v.select("product_id", "customer_id", "created_at", "rejection")


# ----------------------------------------------------------------------------- Q4
Q4_SQL = """
SELECT product_id, customer_id, CAST(count(*) AS BIGINT) AS copies FROM b_review_doc GROUP BY product_id, customer_id HAVING count(*) > 1"""


@query("q4_unique_key_duplicates", Q4_SQL)
def q4(c):
    """Q4 unique compound key (one review per customer per product): duplicate report."""
    return Q.duplicate_keys(c.review_docs(), ["product_id", "customer_id"])


Q4B_SQL = """
SELECT product_id, customer_id, CAST(rating AS BIGINT) AS rating, created_at FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id, customer_id ORDER BY created_at, title) AS r FROM b_review_doc)
WHERE r = 1"""


@query("q4b_enforce_unique_key", Q4B_SQL)
def q4b(c):
    """Q4 enforcement: keep the earliest review per (product, customer)."""
    return Q.enforce_unique(c.review_docs(), ["product_id", "customer_id"], [C("created_at"), C("title")]) \
        .select("product_id", "customer_id", "rating", "created_at")


# ----------------------------------------------------------------------------- N1–N5 over derived UNF data
# the 1NF rows straight from the lines: a line's number is its position in the order
_ONF_SQL = """
onf AS (
  SELECT l.OrderID, cu.FirstName || ' ' || cu.LastName AS CustomerName, cu.Email AS CustomerEmail, ci.CityName AS CustomerCity,
    row_number() OVER (PARTITION BY l.OrderID ORDER BY l.LineNumber, l.ProductID, l.Quantity, l.UnitPrice) AS LineNum,
    p.ProductName, l.UnitPrice, l.Quantity
  FROM b_line l JOIN b_product p ON p.ProductID = l.ProductID JOIN b_order o ON o.OrderID = l.OrderID
  JOIN b_customer cu ON cu.CustomerID = o.CustomerID JOIN b_city ci ON ci.CityID = cu.CityID),
pcat AS (SELECT p.ProductName, min(cat.CategoryName) AS Category FROM b_product p
         JOIN b_category cat ON cat.CategoryID = p.CategoryID GROUP BY p.ProductName)"""


def _onf_lines(c):
    unf = N.wide_orders_from_lines(c.order_line(), c.product(), c.order(), c.customer(), c.city())
    return N.to_1nf(unf)


def _onf(c):
    """The 1NF rows of all lines, materialised: every later step reads them more than once."""
    return _onf_lines(c).checkpoint(eager=True)


def _pcat(c):
    return (c.product().join(c.category().select("CategoryID", "CategoryName"), "CategoryID")
            .groupBy("ProductName").agg(F.min("CategoryName").alias("Category")))


@query("n1_unf_to_1nf", f"""WITH {_ONF_SQL}
SELECT OrderID, CustomerName, CustomerEmail, CustomerCity, CAST(LineNum AS BIGINT) AS LineNum, ProductName,
  CAST(UnitPrice AS DOUBLE) AS UnitPrice, CAST(Quantity AS BIGINT) AS Quantity FROM onf""")
def n1(c):
    """N1 UNF → 1NF: repeating product groups of the flat export → one row per line (LineNum)."""
    return _onf(c)


@query("n2_split_2nf_orders", f"""WITH {_ONF_SQL}
SELECT DISTINCT OrderID, CustomerName, CustomerEmail, CustomerCity FROM onf""")
def n2(c):
    """N2 1NF → 2NF: order-level attributes split out (they depend on OrderID alone)."""
    orders_2nf, _ = N.to_2nf(_onf(c), _pcat(c))
    return orders_2nf


@query("n3_split_3nf_products", f"""WITH {_ONF_SQL},
l2 AS (SELECT onf.*, pcat.Category FROM onf LEFT JOIN pcat ON pcat.ProductName = onf.ProductName),
cat AS (SELECT Category AS CategoryName, dense_rank() OVER (ORDER BY Category) AS CategoryID FROM (SELECT DISTINCT Category FROM l2)),
prod AS (SELECT ProductName, min(Category) AS CategoryName, min(UnitPrice) AS BasePrice FROM l2 GROUP BY ProductName)
SELECT prod.ProductName, CAST(cat.CategoryID AS BIGINT) AS CategoryID, CAST(prod.BasePrice AS DOUBLE) AS BasePrice,
  CAST(dense_rank() OVER (ORDER BY prod.ProductName) AS BIGINT) AS ProductID
FROM prod LEFT JOIN cat ON cat.CategoryName = prod.CategoryName""")
def n3(c):
    """N3 2NF → 3NF: Product table with dense surrogate keys (R0) and a Category FK."""
    o2, l2 = N.to_2nf(_onf(c), _pcat(c))
    return N.to_3nf(o2, l2)["Product"].select("ProductName", "CategoryID", "BasePrice", "ProductID")


@query("n4_lossless_reconstruction", f"""WITH {_ONF_SQL}
SELECT onf.OrderID, CAST(onf.LineNum AS BIGINT) AS LineNum, onf.CustomerName, onf.CustomerEmail, onf.CustomerCity,
  onf.ProductName, pcat.Category, CAST(onf.Quantity AS BIGINT) AS Quantity, CAST(onf.UnitPrice AS DOUBLE) AS UnitPrice,
  CAST(onf.Quantity * onf.UnitPrice AS DOUBLE) AS LineTotal
FROM onf LEFT JOIN pcat ON pcat.ProductName = onf.ProductName""")
def n4(c):
    """N4 reconstruction join over the 3NF tables (equals the 1NF rows: lossless) with line totals."""
    o2, l2 = N.to_2nf(_onf(c), _pcat(c))
    return N.reconstruct(N.to_3nf(o2, l2))


#: what holds in the order lines: the names on the left determine those on the right
ORDER_DEPENDENCIES = [(("OrderID",), ("CustomerEmail", "CustomerName")), (("CustomerEmail",), ("CustomerName", "CustomerCity")),
                      (("OrderID", "LineNum"), ("ProductName", "Quantity", "UnitPrice", "CustomerEmail"))]


@query("n3b_synthesised_relations", f"""WITH {_ONF_SQL}
SELECT 'OrderID' AS KeyColumns, 'OrderID,CustomerEmail' AS Columns, count(*)::BIGINT AS Rows, 0::BIGINT AS Violations FROM (SELECT DISTINCT OrderID, CustomerEmail FROM onf)
UNION ALL SELECT 'CustomerEmail', 'CustomerEmail,CustomerName,CustomerCity', count(*), 0 FROM (SELECT DISTINCT CustomerEmail, CustomerName, CustomerCity FROM onf)
UNION ALL SELECT 'OrderID,LineNum', 'OrderID,LineNum,ProductName,Quantity,UnitPrice', count(*), 0 FROM (SELECT DISTINCT OrderID, LineNum, ProductName, Quantity, UnitPrice FROM onf)""")
def n3b(c):
    """N3 from dependencies: the relations that synthesis gives for the 1NF lines, their rows and keys that are not unique."""
    lines = _onf(c).select("OrderID", "LineNum", "CustomerName", "CustomerEmail", "CustomerCity", "ProductName", "Quantity", "UnitPrice")
    relations = DEP.synthesise(lines.columns, ORDER_DEPENDENCIES)
    parts = DEP.split(lines, relations)
    rows = [p.agg(F.count(F.lit(1)).alias("Rows")).select(F.lit(",".join(r.key)).alias("KeyColumns"), F.lit(",".join(r.columns)).alias("Columns"), "Rows", v.agg(F.count(F.lit(1))).scalar().alias("Violations"))
            for p, r, v in zip(parts, relations, DEP.key_violations(parts, relations))]
    return reduce(DataFrame.unionByName, rows)


@query("n4d_rejoined_relations", f"""WITH {_ONF_SQL}
SELECT OrderID, LineNum::BIGINT AS LineNum, CustomerName, CustomerEmail, CustomerCity, ProductName, Quantity::BIGINT AS Quantity, UnitPrice::DOUBLE AS UnitPrice FROM onf""")
def n4d(c):
    """N4 from dependencies: the 1NF lines put together again from the relations that synthesis gives."""
    lines = _onf(c).select("OrderID", "LineNum", "CustomerName", "CustomerEmail", "CustomerCity", "ProductName", "Quantity", "UnitPrice")
    relations = DEP.synthesise(lines.columns, ORDER_DEPENDENCIES)
    return DEP.rejoin(DEP.split(lines, relations), relations, ORDER_DEPENDENCIES).select(*lines.columns)


def _both_forms(c, keep):
    """The 1NF lines, and the lines put together again from 3NF with the price of some orders changed. What is as long as the
    orders or lines is made once and kept (``session.scratch``), so that the shuffles of one step are gone in the next."""
    onf = keep(_onf_lines(c), "onf")
    first = onf.select("OrderID", "LineNum", "CustomerName", "CustomerEmail", "CustomerCity", "ProductName", "Quantity", "UnitPrice")
    o2, l2 = N.to_2nf(onf, _pcat(c))
    nf3 = N.to_3nf(o2, l2)
    nf3 |= {name: keep(nf3[name], name) for name in ("Order", "OrderLine")}
    back = keep(N.reconstruct(nf3).select(*first.columns), "back")
    return first, back, back.withColumn("UnitPrice", F.when(F.col("OrderID") % 997 == 5, F.col("UnitPrice") + 1).otherwise(F.col("UnitPrice")))


@query("n4b_equal_by_range", f"""WITH {_ONF_SQL}
SELECT OrderID // 500 AS range, count(*)::BIGINT AS left_rows, count(*)::BIGINT AS right_rows, true AS lossless, NOT bool_or(OrderID % 997 = 5) AS unchanged FROM onf GROUP BY 1""")
def n4b(c):
    """N4 by digests: the tables are equal in every range of 500 orders, and a planted change shows in its ranges."""
    with scratch(c.spark) as keep:
        first, back, planted = _both_forms(c, keep)
        same, other = (Q.compare_by_range(first, x, "OrderID", 500) for x in (back, planted))
        return same.withColumnRenamed("equal", "lossless").join(other.select("range", F.col("equal").alias("unchanged")), "range").checkpoint(eager=True)


@query("n4c_differing_rows", f"""WITH {_ONF_SQL}, bad AS (SELECT * FROM onf WHERE OrderID % 997 = 5)
SELECT OrderID, LineNum::BIGINT AS LineNum, ProductName, Quantity::BIGINT AS Quantity, (UnitPrice + d)::DOUBLE AS UnitPrice, if(d = 0, 'left_only', 'right_only') AS side
FROM bad, (VALUES (0), (1)) t(d)""")
def n4c(c):
    """The rows that differ, found in the ranges whose digests differ."""
    with scratch(c.spark) as keep:
        first, _, planted = _both_forms(c, keep)
        rows = Q.differing_rows(first, planted, "OrderID", 500)
        return rows.select("OrderID", "LineNum", "ProductName", "Quantity", "UnitPrice", F.col("_side").alias("side")).checkpoint(eager=True)


@query("n5_functional_dependency_check", f"""WITH {_ONF_SQL}
SELECT ProductName, CAST(count(DISTINCT UnitPrice) AS BIGINT) AS distinct_values FROM onf
GROUP BY ProductName HAVING count(DISTINCT UnitPrice) > 1""")
def n5(c):
    """N5 does ProductName → UnitPrice hold in 1NF? (No: prices are per-order snapshots.)"""
    return N.fd_violations(_onf(c), ["ProductName"], "UnitPrice")


@query("q5_null_count", f"""WITH {_ONF_SQL}
SELECT CAST(sum(CASE WHEN ProductName IS NULL OR UnitPrice IS NULL OR Quantity IS NULL THEN 1 ELSE 0 END) AS BIGINT)
    AS rows_with_nulls,
  CAST(sum(CASE WHEN ProductName IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls_ProductName,
  CAST(sum(CASE WHEN UnitPrice IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls_UnitPrice,
  CAST(sum(CASE WHEN Quantity IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls_Quantity
FROM onf""")
def q5(c):
    """Q5 atomicity / NULL check on the 1NF rows (one pass)."""
    return Q.null_counts(_onf(c), ["ProductName", "UnitPrice", "Quantity"])
