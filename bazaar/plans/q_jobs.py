"""Catalog entries for the batch jobs.

Request batches are derived from the driver tables (every order becomes a placement, return and some
status-change requests, every variant transfer requests, low stock rows restock requests, ...), so each
job's work grows with the data. Where outcomes follow the order of requests the SQL is a recursive CTE that takes one
request after the other: by order (R6) or variant (R9) all at once, as oracles; over all requests in a row (R2, R4,
R5) only in the tests, because it is too slow on larger tables. tests/test_allocation.py compares the fixpoint
with one-at-a-time processing besides.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from bazaar.functions.expr import ts_lit
from bazaar.operators.keys import assign_surrogate_keys
from bazaar.plans import jobs as J
from bazaar.plans.catalog import query
from bazaar.plans.oracle_bindings import with_bindings

C = F.col
AS_OF = "TIMESTAMP '2001-08-01 00:00:00'"


# ----------------------------------------------------------------------------- request derivations
def order_requests(c):
    """One placement request per driver order, payload = its lines as JSON text (bounded by the
    lines of one order). Orders with key % 11 = 0 carry an extra malformed item, those with key % 17 = 0 an item
    of an unknown variant, those with key % 340 = 0 only that; orders with key % 3 = 0 use discount code
    SAVE<key % 25>. Stock comes from warehouse key % 3."""
    items = (c.order_line().groupBy("OrderID")
             .agg(F.collect_list(F.struct(C("VariantID").cast("string").alias("VariantID"),
                                          C("Quantity").cast("string").alias("Quantity"))).alias("_items")))
    bad = F.array(F.struct(F.lit("x").alias("VariantID"), F.lit("2").alias("Quantity")))
    o = c.order().join(items, "OrderID", "left")
    arr = F.coalesce(C("_items"), F.array().cast("array<struct<VariantID:string,Quantity:string>>"))
    arr = F.when(C("OrderID") % 11 == 0, F.concat(arr, bad)).otherwise(arr)
    unknown = F.array(F.struct(F.lit("900000000").alias("VariantID"), F.lit("1").alias("Quantity")))
    arr = F.when(C("OrderID") % 340 == 0, unknown).when(C("OrderID") % 17 == 0, F.concat(arr, unknown)).otherwise(arr)
    return o.select((C("OrderID") % 3).cast("int").alias("WarehouseID"),
                    C("OrderID").alias("RequestID"), "CustomerID", "ShippingAddressID",
                    C("PlacedAt").alias("RequestedAt"),
                    F.when(C("OrderID") % 3 == 0, F.concat(F.lit("SAVE"), (C("OrderID") % 25).cast("string")))
                    .alias("DiscountCode"), F.to_json(arr).alias("ItemsJson"))


_REQ_SQL = """
req AS (SELECT OrderID AS RequestID, CustomerID, ShippingAddressID, PlacedAt AS RequestedAt,
               CASE WHEN OrderID % 3 = 0 THEN 'SAVE' || CAST(OrderID % 25 AS VARCHAR) END AS DiscountCode
        FROM b_order),
all_lines AS (SELECT OrderID AS RequestID, VariantID, Quantity FROM b_line WHERE OrderID % 340 <> 0 AND Quantity > 0
       UNION ALL SELECT OrderID, 900000000, 1 FROM b_order WHERE OrderID % 17 = 0),
al AS (SELECT RequestID, VariantID, sum(Quantity) AS Quantity FROM all_lines GROUP BY RequestID, VariantID),
rl AS (SELECT al.* FROM al JOIN b_variant pv ON pv.VariantID = al.VariantID),
vd AS (SELECT * FROM b_discount WHERE IsActive AND ValidFrom <= TIMESTAMP '2001-08-01 00:00:00'
       AND (ValidTo IS NULL OR ValidTo >= TIMESTAMP '2001-08-01 00:00:00')),
val AS (
  SELECT req.*, vd.DiscountID, vd.DiscountType, vd.DiscountValue,
    CASE WHEN NOT EXISTS (SELECT 1 FROM rl WHERE rl.RequestID = req.RequestID) THEN 'NO_VALID_LINES'
         WHEN NOT EXISTS (SELECT 1 FROM b_customer cu WHERE cu.CustomerID = req.CustomerID AND cu.IsActive)
           THEN 'CUSTOMER_INACTIVE'
         WHEN req.DiscountCode IS NOT NULL AND vd.DiscountID IS NULL THEN 'INVALID_DISCOUNT' END AS RejectReason
  FROM req LEFT JOIN vd ON vd.DiscountCode = req.DiscountCode)"""


@query("a3_json_payload_parse", f"""WITH {_REQ_SQL}
SELECT RequestID, VariantID, CAST(Quantity AS BIGINT) AS Quantity FROM al""")
def a3(c):
    """A3 JSON line payload → typed rows (TRY_CAST; malformed items and qty ≤ 0 dropped; repeats summed)."""
    return J.order_request_lines(order_requests(c))


@query("r1_order_request_validation", f"""WITH {_REQ_SQL}
SELECT RequestID, CustomerID, DiscountCode, RejectReason FROM val""")
def r1(c):
    """R1 / R2 request validation: lines present, active customer, discount code valid at as_of."""
    req = order_requests(c)
    v = J.validate_order_requests(req, c.customer(), c.discount(), c.orders_as_of, J.order_request_lines(req, c.variant()))
    return v.select("RequestID", "CustomerID", "DiscountCode", "RejectReason")


@query("r3_order_pricing", f"""WITH {_REQ_SQL},
sub AS (SELECT rl.RequestID, sum((p.BasePrice + pv.PriceAdjustment) * rl.Quantity) AS SubtotalAmount
        FROM rl JOIN b_variant pv ON pv.VariantID = rl.VariantID JOIN b_product p ON p.ProductID = pv.ProductID
        GROUP BY rl.RequestID),
pr AS (SELECT val.RequestID, sub.SubtotalAmount,
         CASE WHEN DiscountType = 'PERCENTAGE' THEN round(sub.SubtotalAmount * DiscountValue * 0.01, 2)
              WHEN DiscountType = 'FIXED_AMOUNT' THEN least(DiscountValue, sub.SubtotalAmount) ELSE 0 END AS DiscountAmount
       FROM val JOIN sub ON sub.RequestID = val.RequestID WHERE val.RejectReason IS NULL)
SELECT RequestID, CAST(SubtotalAmount AS DOUBLE) AS SubtotalAmount, CAST(DiscountAmount AS DOUBLE) AS DiscountAmount,
  CAST(SubtotalAmount - DiscountAmount AS DOUBLE) AS TotalAmount FROM pr""")
def r3(c):
    """R3 pricing: unit = base + adjustment, subtotal, PERCENTAGE / FIXED_AMOUNT discount, total."""
    p = J.price_order_requests(order_requests(c), c.variant(), c.product(), c.discount(), c.customer(), c.orders_as_of)
    return p.select("RequestID", "SubtotalAmount", "DiscountAmount", "TotalAmount")


def _placement(c, effects=True):
    return J.place_orders(order_requests(c), c.customer(), c.discount(), c.variant(), c.product(), c.stock_level(),
                          c.orders_as_of, warehouse_id=0, existing_orders=c.order(), effects=effects)


#: SQL of the queries that place one order after the other. It takes minutes from some thousand requests on (over 15 at
#: sf0.01), so it is no oracle of the catalog; tests/test_catalog.py compares it at sf0.001.
SEQUENTIAL: dict[str, str] = {}


def sequential(name: str, sql: str):
    SEQUENTIAL[name] = with_bindings(sql)
    return query(name)


# One request after the other: the state is the list of remaining capacities (discount uses, then stock rows).
# cap numbers the resources that any request asks for; d has each request's demands as lists.
_PLACE_SQL = f"""{_REQ_SQL},
dem AS (
  SELECT val.RequestID, 0 AS lv, 'D:' || val.DiscountCode AS res, 1 AS qty FROM val WHERE RejectReason IS NULL AND DiscountID IS NOT NULL
  UNION ALL
  SELECT val.RequestID, 1, 'S:' || (val.RequestID % 3) || ':' || rl.VariantID, rl.Quantity FROM val JOIN rl ON rl.RequestID = val.RequestID
  WHERE val.RejectReason IS NULL),
cap AS (
  SELECT res, row_number() OVER (ORDER BY res) AS pos,
    coalesce((SELECT MaxUsageCount - UsageCount FROM b_discount dc WHERE 'D:' || dc.DiscountCode = res), s.QuantityOnHand, 0)::BIGINT AS left_over
  FROM (SELECT DISTINCT res FROM dem) LEFT JOIN b_stock s ON 'S:' || s.WarehouseID || ':' || s.VariantID = res),
asked AS (
  SELECT dem.RequestID, row_number() OVER (ORDER BY any_value(req.RequestedAt), dem.RequestID) AS n,
    list(cap.pos ORDER BY dem.lv, cap.pos) AS at, list(dem.qty::BIGINT ORDER BY dem.lv, cap.pos) AS qty, list(dem.lv ORDER BY dem.lv, cap.pos) AS lv
  FROM dem JOIN cap ON cap.res = dem.res JOIN req ON req.RequestID = dem.RequestID GROUP BY dem.RequestID),
walk AS (
  SELECT 0::BIGINT AS n, (SELECT list(left_over ORDER BY pos) FROM cap) AS state, NULL::BIGINT AS RequestID, NULL::INT AS failed
  UNION ALL
  SELECT t.n, CASE WHEN t.bad IS NULL THEN list_transform(t.state, lambda x, i: x - coalesce(t.qty[list_position(t.at, i)], 0)) ELSE t.state END, t.RequestID, t.bad
  FROM (SELECT a.n, w.state, a.RequestID, a.at, a.qty,
               list_min(list_transform(list_zip(a.at, a.qty, a.lv), lambda z: CASE WHEN w.state[z[1]] < z[2] THEN z[3] END)) AS bad
        FROM walk w JOIN asked a ON a.n = w.n + 1) t),
decided AS (SELECT n, RequestID, failed IS NULL AS accepted, CASE failed WHEN 0 THEN 'INVALID_DISCOUNT' WHEN 1 THEN 'INSUFFICIENT_STOCK' END AS reason FROM walk WHERE n > 0)"""

_R4_SQL = f"""WITH RECURSIVE {_PLACE_SQL}
SELECT RequestID, CASE WHEN accepted THEN 'ACCEPTED' ELSE 'REJECTED' END AS status, reason FROM decided
UNION ALL SELECT RequestID, 'REJECTED', RejectReason FROM val WHERE RejectReason IS NOT NULL"""


@sequential("r4_stock_allocation", _R4_SQL)
def r4(c):
    """R4 all-or-nothing stock + discount-cap allocation in request order (exact fixpoint)."""
    return _placement(c, effects=False)["outcomes"]


_EFFECTS_SQL = f"""{_PLACE_SQL},
sub AS (SELECT rl.RequestID, sum((p.BasePrice + pv.PriceAdjustment) * rl.Quantity) AS SubtotalAmount
        FROM rl JOIN b_variant pv ON pv.VariantID = rl.VariantID JOIN b_product p ON p.ProductID = pv.ProductID GROUP BY rl.RequestID),
acc AS (SELECT val.*, sub.SubtotalAmount,
    CAST(CASE DiscountType WHEN 'PERCENTAGE' THEN round(sub.SubtotalAmount * DiscountValue * 0.01, 2)
         WHEN 'FIXED_AMOUNT' THEN least(DiscountValue, sub.SubtotalAmount) ELSE 0 END AS DECIMAL(18,2)) AS DiscountAmount,
    (SELECT max(OrderID) FROM b_order) + row_number() OVER (ORDER BY val.RequestedAt, val.RequestID) AS OrderID
  FROM val JOIN decided ON decided.RequestID = val.RequestID AND decided.accepted JOIN sub ON sub.RequestID = val.RequestID),
sold AS (SELECT acc.OrderID, acc.RequestID, acc.RequestedAt, s.StockLevelID, s.QuantityOnHand, rl.VariantID, rl.Quantity
         FROM acc JOIN rl ON rl.RequestID = acc.RequestID JOIN b_stock s ON s.VariantID = rl.VariantID AND s.WarehouseID = acc.RequestID % 3)"""


@sequential("r5_sale_ledger", f"""WITH RECURSIVE {_EFFECTS_SQL}
SELECT StockLevelID, 'SALE' AS MovementType, CAST(-Quantity AS BIGINT) AS QuantityChange,
  CAST(QuantityOnHand - sum(Quantity) OVER (PARTITION BY StockLevelID ORDER BY RequestedAt, RequestID ROWS UNBOUNDED PRECEDING) AS BIGINT) AS QuantityAfter,
  OrderID AS ReferenceID, 'ORDER' AS ReferenceType, RequestedAt AS MovedAt FROM sold""")
def r5(c):
    """R5 SALE ledger rows with running QuantityAfter for the accepted requests."""
    return _placement(c)["movements"]


@sequential("r5b_new_orders", f"""WITH RECURSIVE {_EFFECTS_SQL}
SELECT OrderID, RequestID, CustomerID, ShippingAddressID, DiscountID, 'PENDING' AS OrderStatus, CAST(SubtotalAmount AS DOUBLE) AS SubtotalAmount,
  CAST(DiscountAmount AS DOUBLE) AS DiscountAmount, CAST(SubtotalAmount - DiscountAmount AS DOUBLE) AS TotalAmount, RequestedAt AS PlacedAt FROM acc""")
def r5b(c):
    """R0 + R5: new Order rows (dense OrderIDs after the existing maximum) for accepted requests."""
    return _placement(c)["orders"]


@sequential("r5c_sale_stock", f"""WITH RECURSIVE {_EFFECTS_SQL}
SELECT s.StockLevelID, s.WarehouseID, s.VariantID, CAST(s.QuantityOnHand - coalesce(u.used, 0) AS BIGINT) AS QuantityOnHand
FROM b_stock s LEFT JOIN (SELECT StockLevelID, sum(Quantity) AS used FROM sold GROUP BY StockLevelID) u ON u.StockLevelID = s.StockLevelID""")
def r5c(c):
    """R5 effect on StockLevel: what is left after the accepted requests."""
    return _placement(c)["stock_levels"].select("StockLevelID", "WarehouseID", "VariantID", "QuantityOnHand")


@sequential("r5d_sale_discounts", f"""WITH RECURSIVE {_EFFECTS_SQL}
SELECT d.DiscountID, CAST(d.UsageCount + count(acc.RequestID) AS BIGINT) AS UsageCount, CAST(d.MaxUsageCount AS BIGINT) AS MaxUsageCount
FROM b_discount d LEFT JOIN acc ON acc.DiscountID = d.DiscountID GROUP BY d.DiscountID, d.UsageCount, d.MaxUsageCount""")
def r5d(c):
    """R2 / R5 effect on Discount: usage counts, never above the cap."""
    return _placement(c)["discounts"].select("DiscountID", "UsageCount", "MaxUsageCount")


@sequential("r5e_sale_customers", f"""WITH RECURSIVE {_EFFECTS_SQL}
SELECT cu.CustomerID, CAST(cu.LoyaltyPoints + coalesce(sum(floor((acc.SubtotalAmount - acc.DiscountAmount) / 10)), 0) AS BIGINT) AS LoyaltyPoints
FROM b_customer cu LEFT JOIN acc ON acc.CustomerID = cu.CustomerID GROUP BY cu.CustomerID, cu.LoyaltyPoints""")
def r5e(c):
    """R5 effect on Customer: one loyalty point per ten of an accepted order."""
    return _placement(c)["customers"].select("CustomerID", "LoyaltyPoints")


@sequential("r5f_new_order_lines", f"""WITH RECURSIVE {_EFFECTS_SQL}
SELECT sold.OrderID, sold.VariantID, CAST(sold.Quantity AS BIGINT) AS Quantity, CAST(p.BasePrice + pv.PriceAdjustment AS DOUBLE) AS UnitPrice
FROM sold JOIN b_variant pv ON pv.VariantID = sold.VariantID JOIN b_product p ON p.ProductID = pv.ProductID""")
def r5f(c):
    """The lines of the new orders, priced when placed."""
    return _placement(c)["order_lines"]


@sequential("r2_discount_usage_cap", f"""WITH RECURSIVE {_PLACE_SQL}
SELECT val.RequestID, val.DiscountCode, coalesce(decided.reason, val.RejectReason) AS Reason
FROM val LEFT JOIN decided ON decided.RequestID = val.RequestID WHERE val.DiscountCode IS NOT NULL
  AND coalesce(decided.reason, val.RejectReason) = 'INVALID_DISCOUNT'""")
def r2(c):
    """R2: requests rejected for their discount: unknown, inactive, outside its dates, or used up by earlier ones."""
    out = _placement(c, effects=False)["outcomes"].filter(C("reason") == "INVALID_DISCOUNT")
    return order_requests(c).select("RequestID", "DiscountCode").join(out.select("RequestID", C("reason").alias("Reason")), "RequestID")


@query("r0_surrogate_keys", """
SELECT ProductType, CAST((SELECT max(CategoryID) FROM b_category) + dense_rank() OVER (ORDER BY ProductType) AS BIGINT)
  AS CategoryID
FROM (SELECT DISTINCT ProductType FROM b_product)""")
def r0(c):
    """R0 surrogate keys: new CategoryIDs for the distinct product types, after the current maximum."""
    types = c.product().select("ProductType").distinct()
    return assign_surrogate_keys(types, "ProductType", "CategoryID", existing=c.category())


# ----------------------------------------------------------------------------- R6
def status_requests(c):
    """Two or three changes for every order (some legal, some not, some in reverse time order), and changes of unknown orders."""
    k = C("OrderID")
    lists = [("PROCESSING", "SHIPPED", "DELIVERED"), ("REFUNDED", "REFUNDED"), ("CANCELLED", "PROCESSING"), ("SHIPPED", "PROCESSING", "SHIPPED")]
    wish = F.array(*[F.array(*[F.lit(x) for x in names]) for names in lists])
    o = c.order().select("OrderID", F.posexplode(F.element_at(wish, (k % 4 + 1).cast("int"))).alias("_p", "NewStatus"))
    minute = F.when(k % 8 == 3, 10 - C("_p")).otherwise(C("_p")).cast("int")
    known = o.select((k * 10 + C("_p")).alias("RequestID"), (ts_lit(c.orders_as_of) + F.make_dt_interval(mins=minute)).alias("RequestedAt"), "OrderID", "NewStatus",
                     F.when(k % 6 != 0, k % 5).cast("int").alias("CourierID"), F.concat(F.lit("T"), (k * 10 + C("_p")).cast("string")).alias("TrackingNumber"),
                     F.when((k % 9 == 0) & (C("_p") == 0), F.lit("checked")).alias("Notes"))
    unknown = c.order().filter(k % 50 == 0).select((k * 10 + 9).alias("RequestID"), ts_lit(c.orders_as_of).alias("RequestedAt"), (k + 1_000_000_000).alias("OrderID"), F.lit("CONFIRMED").alias("NewStatus"),
                                                   F.lit(None).cast("int").alias("CourierID"), F.lit(None).cast("string").alias("TrackingNumber"), F.lit(None).cast("string").alias("Notes"))
    return known.unionByName(unknown)


_TRANS_SQL = ", ".join(f"('{a}', '{b}')" for a, b in J.TRANSITIONS)
# one request after the other, all orders at once
_STATUS_SQL = f"""
wish AS (
  SELECT OrderID, unnest(range(len(names))) AS p, names FROM (SELECT OrderID, CASE OrderID % 4 WHEN 0 THEN ['PROCESSING', 'SHIPPED', 'DELIVERED']
    WHEN 1 THEN ['REFUNDED', 'REFUNDED'] WHEN 2 THEN ['CANCELLED', 'PROCESSING'] ELSE ['SHIPPED', 'PROCESSING', 'SHIPPED'] END AS names FROM b_order)),
rq AS (
  SELECT OrderID * 10 + p AS RequestID, {AS_OF} + to_minutes(CASE WHEN OrderID % 8 = 3 THEN 10 - p ELSE p END) AS RequestedAt, OrderID, names[p + 1] AS NewStatus,
    CASE WHEN OrderID % 6 <> 0 THEN CAST(OrderID % 5 AS BIGINT) END AS CourierID, 'T' || (OrderID * 10 + p) AS TrackingNumber,
    CASE WHEN OrderID % 9 = 0 AND p = 0 THEN 'checked' END AS Notes FROM wish
  UNION ALL SELECT OrderID * 10 + 9, {AS_OF}, OrderID + 1000000000, 'CONFIRMED', NULL, NULL, NULL FROM b_order WHERE OrderID % 50 = 0),
legal(f, t) AS (VALUES {_TRANS_SQL}),
numbered AS (SELECT rq.*, o.OrderStatus AS first, row_number() OVER (PARTITION BY rq.OrderID ORDER BY RequestedAt, RequestID) AS n
             FROM rq LEFT JOIN b_order o ON o.OrderID = rq.OrderID),
walk AS (
  SELECT n, RequestID, OrderID, first AS FromStatus, EXISTS (SELECT 1 FROM legal WHERE f = first AND t = NewStatus) AS ok, NewStatus FROM numbered WHERE n = 1
  UNION ALL
  SELECT x.n, x.RequestID, x.OrderID, x.cur, EXISTS (SELECT 1 FROM legal WHERE f = x.cur AND t = x.NewStatus), x.NewStatus
  FROM (SELECT m.n, m.RequestID, m.OrderID, m.NewStatus, CASE WHEN w.ok THEN w.NewStatus ELSE w.FromStatus END AS cur
        FROM walk w JOIN numbered m ON m.OrderID = w.OrderID AND m.n = w.n + 1) x),
done AS (SELECT m.*, w.FromStatus, w.ok FROM numbered m JOIN walk w ON w.RequestID = m.RequestID AND w.OrderID = m.OrderID),
last AS (SELECT OrderID, arg_max(NewStatus, n) FILTER (WHERE ok) AS st, arg_max(Notes, n) FILTER (WHERE ok AND Notes IS NOT NULL) AS note FROM done GROUP BY OrderID),
sent AS (SELECT *, (SELECT max(ShipmentID) FROM b_shipment) + row_number() OVER (ORDER BY RequestedAt, RequestID) AS ShipmentID
         FROM done WHERE ok AND NewStatus = 'SHIPPED' AND CourierID IS NOT NULL)"""


def _status(c):
    return J.apply_status_changes(status_requests(c), c.order(), c.payment(), c.orders_as_of, c.shipment())


@query("r6_status_transitions", f"""WITH RECURSIVE {_STATUS_SQL}
SELECT RequestID, OrderID, RequestedAt, FromStatus, NewStatus, ok AS Accepted,
  CASE WHEN first IS NULL THEN 'ORDER_NOT_FOUND' WHEN NOT ok THEN 'INVALID_TRANSITION' END AS Reason, CourierID, TrackingNumber, Notes FROM done""")
def r6(c):
    """R6 order-status transitions in request order against the state machine (unknown orders and illegal moves rejected)."""
    return _status(c)["outcomes"]


@query("r6b_status_effects_orders", f"""WITH RECURSIVE {_STATUS_SQL}
SELECT o.OrderID, coalesce(last.st, o.OrderStatus) AS OrderStatus, CASE WHEN last.st IS NOT NULL THEN {AS_OF} ELSE o.UpdatedAt END AS UpdatedAt, last.note AS Notes
FROM b_order o LEFT JOIN last ON last.OrderID = o.OrderID""")
def r6b(c):
    """R6 effect on Order: last status and note, once per order (UPDATE … FROM join)."""
    return _status(c)["orders"].select("OrderID", "OrderStatus", "UpdatedAt", "Notes")


@query("r6c_status_effects_payments", f"""WITH RECURSIVE {_STATUS_SQL}
SELECT p.PaymentID, p.OrderID, CASE WHEN d.OrderID IS NOT NULL AND p.PaymentStatus = 'AUTHORISED' THEN 'CAPTURED' ELSE p.PaymentStatus END AS PaymentStatus,
  CASE WHEN d.OrderID IS NOT NULL AND p.PaymentStatus = 'AUTHORISED' THEN {AS_OF} ELSE p.PaidAt END AS PaidAt
FROM b_payment p LEFT JOIN (SELECT DISTINCT OrderID FROM done WHERE ok AND NewStatus = 'DELIVERED') d ON d.OrderID = p.OrderID""")
def r6c(c):
    """R6 effect on Payment: delivery captures authorised payments."""
    return _status(c)["payments"].select("PaymentID", "OrderID", "PaymentStatus", "PaidAt")


@query("r6d_status_shipments", f"""WITH RECURSIVE {_STATUS_SQL}
SELECT ShipmentID, OrderID, CourierID, TrackingNumber, 'IN_TRANSIT' AS ShipmentStatus, {AS_OF} AS CreatedAt FROM sent""")
def r6d(c):
    """Shipments of orders that were sent with a courier, with keys after the existing ones."""
    return _status(c)["shipments"]


@query("r6e_status_shipment_events", f"""WITH RECURSIVE {_STATUS_SQL}
SELECT ShipmentID, OrderID, 'IN_TRANSIT' AS EventStatus, 'Order dispatched from warehouse' AS EventNote, {AS_OF} AS EventAt FROM sent""")
def r6e(c):
    """The first event of every new shipment."""
    return _status(c)["shipment_events"]


# ----------------------------------------------------------------------------- R7
def return_requests(c):
    """One return per order (to warehouse key % 3, with a reason for every second), a second one for every third, and returns of unknown orders."""
    o, k = c.order().select("OrderID"), C("OrderID")
    t = ts_lit(c.orders_as_of)
    more = [(k % 3).cast("int").alias("WarehouseID"), F.when(k % 2 == 0, F.concat(F.lit("reason "), (k % 7).cast("string"))).alias("ReturnReason")]
    first = o.select(k.alias("RequestID"), "OrderID", t.alias("RequestedAt"), *more)
    unknown = o.filter(k % 26 == 0).select((k + 1_000_000_000).alias("RequestID"), (k + 1_000_000_000).alias("OrderID"), t.alias("RequestedAt"), *more)
    again = o.filter(k % 3 == 0).select((k + 2_000_000_000).alias("RequestID"), "OrderID", (t + F.expr("INTERVAL 1 DAY")).alias("RequestedAt"), *more)
    return first.unionByName(unknown).unionByName(again)


_RET_SQL = f"""
rq AS (SELECT OrderID AS RequestID, OrderID, {AS_OF} AS RequestedAt, OrderID AS k FROM b_order
       UNION ALL SELECT OrderID + 1000000000, OrderID + 1000000000, {AS_OF}, OrderID FROM b_order WHERE OrderID % 26 = 0
       UNION ALL SELECT OrderID + 2000000000, OrderID, {AS_OF} + INTERVAL 1 DAY, OrderID FROM b_order WHERE OrderID % 3 = 0),
o1 AS (SELECT rq.*, CAST(rq.k % 3 AS BIGINT) AS WarehouseID, CASE WHEN rq.k % 2 = 0 THEN 'reason ' || (rq.k % 7) END AS ReturnReason,
         o.CustomerID, o.OrderStatus, o.TotalAmount, row_number() OVER (PARTITION BY rq.OrderID ORDER BY rq.RequestedAt, rq.RequestID) AS nth
       FROM rq LEFT JOIN b_order o ON o.OrderID = rq.OrderID),
outc AS (SELECT *, OrderStatus IS NOT NULL AND OrderStatus = 'DELIVERED' AND nth = 1 AS Accepted,
           CASE WHEN OrderStatus IS NULL THEN 'ORDER_NOT_FOUND' WHEN OrderStatus <> 'DELIVERED' OR nth > 1
                THEN 'NOT_DELIVERED' END AS Reason FROM o1),
back AS (SELECT ok.RequestID, ok.RequestedAt, ok.OrderID, ok.WarehouseID, ok.ReturnReason, l.VariantID, sum(l.Quantity) AS Quantity
         FROM outc ok JOIN b_line l ON l.OrderID = ok.OrderID WHERE ok.Accepted GROUP BY ALL)"""


def _returns(c):
    return J.process_returns(return_requests(c), c.order(), c.order_line(), c.stock_level(), c.customer(), c.payment(), c.orders_as_of)


@query("r7_return_outcomes", f"""WITH {_RET_SQL}
SELECT RequestID, OrderID, RequestedAt, CustomerID, OrderStatus, WarehouseID, ReturnReason, Accepted, Reason,
  CAST(CASE WHEN Accepted THEN TotalAmount END AS DOUBLE) AS RefundAmount FROM outc""")
def r7(c):
    """R7 returns: DELIVERED only, first request per order, unknown orders rejected (B12 fixed)."""
    return _returns(c)["outcomes"]


@query("r7b_return_ledger", f"""WITH {_RET_SQL}
SELECT s.StockLevelID, 'RETURN' AS MovementType, CAST(back.Quantity AS BIGINT) AS QuantityChange,
  CAST(s.QuantityOnHand + sum(back.Quantity) OVER (PARTITION BY s.StockLevelID ORDER BY back.RequestedAt, back.RequestID,
       back.VariantID ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS QuantityAfter,
  back.OrderID AS ReferenceID, 'RETURN' AS ReferenceType, back.ReturnReason AS Notes, back.RequestedAt AS MovedAt
FROM back JOIN b_stock s ON s.VariantID = back.VariantID AND s.WarehouseID = back.WarehouseID""")
def r7b(c):
    """R7 RETURN ledger rows with running QuantityAfter and the return's reason."""
    return _returns(c)["movements"]


@query("r7c_return_loyalty", f"""WITH {_RET_SQL},
pts AS (SELECT CustomerID, sum(floor(TotalAmount / 10)) AS p FROM outc WHERE Accepted GROUP BY CustomerID)
SELECT c.CustomerID, CAST(greatest(0, c.LoyaltyPoints - coalesce(pts.p, 0)) AS BIGINT) AS LoyaltyPoints
FROM b_customer c LEFT JOIN pts ON pts.CustomerID = c.CustomerID""")
def r7c(c):
    """R7 loyalty reversal −⌊total/10⌋ floored at 0 (set-based update)."""
    return _returns(c)["customers"].select("CustomerID", "LoyaltyPoints")


@query("r7d_return_stock", f"""WITH {_RET_SQL}
SELECT s.StockLevelID, s.WarehouseID, s.VariantID, CAST(s.QuantityOnHand + coalesce(sum(back.Quantity), 0) AS BIGINT) AS QuantityOnHand
FROM b_stock s LEFT JOIN back ON back.VariantID = s.VariantID AND back.WarehouseID = s.WarehouseID
GROUP BY s.StockLevelID, s.WarehouseID, s.VariantID, s.QuantityOnHand""")
def r7d(c):
    """R7 effect on StockLevel."""
    return _returns(c)["stock_levels"].select("StockLevelID", "WarehouseID", "VariantID", "QuantityOnHand")


@query("r7e_return_orders", f"""WITH {_RET_SQL}
SELECT o.OrderID, CASE WHEN ok.OrderID IS NOT NULL THEN 'REFUNDED' ELSE o.OrderStatus END AS OrderStatus,
  CASE WHEN ok.OrderID IS NOT NULL THEN {AS_OF} ELSE o.UpdatedAt END AS UpdatedAt
FROM b_order o LEFT JOIN (SELECT OrderID FROM outc WHERE Accepted) ok ON ok.OrderID = o.OrderID""")
def r7e(c):
    """R7 effect on Order."""
    return _returns(c)["orders"].select("OrderID", "OrderStatus", "UpdatedAt")


@query("r7f_return_payments", f"""WITH {_RET_SQL}
SELECT p.PaymentID, p.OrderID, CASE WHEN ok.OrderID IS NOT NULL THEN 'REFUNDED' ELSE p.PaymentStatus END AS PaymentStatus
FROM b_payment p LEFT JOIN (SELECT OrderID FROM outc WHERE Accepted) ok ON ok.OrderID = p.OrderID""")
def r7f(c):
    """R7 effect on Payment."""
    return _returns(c)["payments"].select("PaymentID", "OrderID", "PaymentStatus")


# ----------------------------------------------------------------------------- R8
def restock_requests(c):
    """All low stock rows (2×reorder − on hand; a repeated 5-unit item for variant % 7 = 0)
    and new rows in warehouse 3 for variant % 50 = 1. One request per (warehouse, variant block of
    100): payload size is bounded."""
    s = c.stock_level()
    low = s.filter(C("QuantityOnHand") <= C("ReorderPoint")).select(
        "WarehouseID", "VariantID", (C("ReorderPoint") * 2 - C("QuantityOnHand")).alias("Quantity"))
    dup = low.filter(C("VariantID") % 7 == 0).select("WarehouseID", "VariantID", F.lit(5).alias("Quantity"))
    new = (c.variant().filter(C("VariantID") % 50 == 1)
           .select(F.lit(3).alias("WarehouseID"), "VariantID", F.lit(20).alias("Quantity")))
    items = low.unionByName(dup).unionByName(new)
    return (items.groupBy("WarehouseID", F.floor(C("VariantID") / 100).alias("_blk"))
            .agg(F.to_json(F.collect_list(F.struct(C("VariantID").cast("string").alias("VariantID"),
                                                   C("Quantity").cast("string").alias("Quantity")))).alias("ItemsJson"))
            .select((C("WarehouseID") * 1_000_000_000 + C("_blk")).alias("RequestID"), "WarehouseID", "ItemsJson"))


_RESTOCK_SQL = """
low AS (SELECT WarehouseID, VariantID, ReorderPoint * 2 - QuantityOnHand AS Quantity FROM b_stock
        WHERE QuantityOnHand <= ReorderPoint),
items AS (SELECT * FROM low UNION ALL SELECT WarehouseID, VariantID, 5 FROM low WHERE VariantID % 7 = 0
          UNION ALL SELECT 3, VariantID, 20 FROM b_variant WHERE VariantID % 50 = 1),
inc AS (SELECT i.WarehouseID, i.VariantID, sum(i.Quantity) AS inc FROM items i
        WHERE EXISTS (SELECT 1 FROM b_variant pv WHERE pv.VariantID = i.VariantID AND pv.IsActive)
        GROUP BY i.WarehouseID, i.VariantID),
ch AS (SELECT coalesce(s.StockLevelID, (SELECT max(StockLevelID) FROM b_stock)
                + dense_rank() OVER (PARTITION BY s.StockLevelID IS NULL ORDER BY inc.WarehouseID, inc.VariantID))
              AS StockLevelID,
              inc.WarehouseID, inc.VariantID, s.QuantityOnHand AS QuantityBefore,
              coalesce(s.QuantityOnHand, 0) + inc.inc AS QuantityAfter, inc.inc AS QuantityChange
       FROM inc LEFT JOIN b_stock s ON s.WarehouseID = inc.WarehouseID AND s.VariantID = inc.VariantID)"""


@query("r8_restock_changes", f"""WITH {_RESTOCK_SQL}
SELECT CAST(StockLevelID AS BIGINT) AS StockLevelID, WarehouseID, VariantID, CAST(QuantityBefore AS BIGINT) AS QuantityBefore,
  CAST(QuantityAfter AS BIGINT) AS QuantityAfter, CAST(QuantityChange AS BIGINT) AS QuantityChange FROM ch""")
def r8(c):
    """R8 restock upsert: before / change / after per (warehouse, variant); new rows get new ids."""
    return J.restock(restock_requests(c), c.stock_level(), c.variant(), c.orders_as_of)["changes"]


@query("r8b_restock_ledger", f"""WITH {_RESTOCK_SQL}
SELECT CAST(StockLevelID AS BIGINT) AS StockLevelID, 'RESTOCK' AS MovementType, CAST(QuantityChange AS BIGINT) AS QuantityChange,
  CAST(QuantityAfter AS BIGINT) AS QuantityAfter, 'RESTOCK_JOB' AS ReferenceType,
  concat('Restock — WarehouseID: ', WarehouseID, ' | Before: ', coalesce(QuantityBefore, 0), ' | After: ', QuantityAfter)
    AS Notes, {AS_OF} AS MovedAt
FROM ch""")
def r8b(c):
    """R8 RESTOCK ledger rows with the audit note text."""
    return J.restock(restock_requests(c), c.stock_level(), c.variant(), c.orders_as_of)["movements"]


@query("r8c_restock_stock", f"""WITH {_RESTOCK_SQL}
SELECT CAST(coalesce(ch.StockLevelID, s.StockLevelID) AS BIGINT) AS StockLevelID, coalesce(ch.WarehouseID, s.WarehouseID) AS WarehouseID,
  coalesce(ch.VariantID, s.VariantID) AS VariantID, CAST(coalesce(ch.QuantityAfter, s.QuantityOnHand) AS BIGINT) AS QuantityOnHand
FROM b_stock s FULL OUTER JOIN ch ON ch.StockLevelID = s.StockLevelID""")
def r8c(c):
    """R8 effect on StockLevel: raised, inserted and untouched rows."""
    out = J.restock(restock_requests(c), c.stock_level(), c.variant(), c.orders_as_of)["stock_levels"]
    return out.select("StockLevelID", "WarehouseID", "VariantID", "QuantityOnHand")


# ----------------------------------------------------------------------------- R9
def transfer_requests(c):
    """Four transfers per variant: out of warehouse v % 3, on from where it went, out of a warehouse without rows
    (3) that earlier ones may have filled, and back; some with the same warehouse or no quantity."""
    v, t = C("VariantID"), ts_lit(c.orders_as_of)
    legs = [(v % 3, (v + 1) % 3, v % 30 + 5), ((v + 1) % 3, F.when(v % 4 == 0, 3).otherwise((v + 2) % 3), v % 17 + 1),
            (F.lit(3), v % 3, F.when(v % 7 == 0, 0).otherwise(v % 5 + 1)), ((v + 2) % 3, F.when(v % 10 == 0, (v + 2) % 3).otherwise(v % 3), v % 11 + 1)]
    arr = F.array(*[F.struct(F.lit(i).alias("leg"), a.cast("int").alias("FromWarehouseID"), b.cast("int").alias("ToWarehouseID"), q.cast("int").alias("Quantity"))
                    for i, (a, b, q) in enumerate(legs)])
    r = c.variant().select("VariantID", F.inline(arr))
    minute = F.when(v % 6 == 5, 10 - C("leg")).otherwise(C("leg")).cast("int")
    return r.select((v * 10 + C("leg")).alias("RequestID"), (t + F.make_dt_interval(mins=minute)).alias("RequestedAt"), "FromWarehouseID", "ToWarehouseID", "VariantID", "Quantity",
                    F.when(v % 9 == 0, F.lit("moved by hand")).alias("Notes"))


# one request after the other for all variants at once; the state is the variant's quantity by warehouse (NULL: no row)
_TRANSFER_SQL = f"""
leg AS (
  SELECT VariantID AS v, 0 AS leg, VariantID % 3 AS f, (VariantID + 1) % 3 AS t, VariantID % 30 + 5 AS q FROM b_variant
  UNION ALL SELECT VariantID, 1, (VariantID + 1) % 3, CASE WHEN VariantID % 4 = 0 THEN 3 ELSE (VariantID + 2) % 3 END, VariantID % 17 + 1 FROM b_variant
  UNION ALL SELECT VariantID, 2, 3, VariantID % 3, CASE WHEN VariantID % 7 = 0 THEN 0 ELSE VariantID % 5 + 1 END FROM b_variant
  UNION ALL SELECT VariantID, 3, (VariantID + 2) % 3, CASE WHEN VariantID % 10 = 0 THEN (VariantID + 2) % 3 ELSE VariantID % 3 END, VariantID % 11 + 1 FROM b_variant),
rq AS (SELECT v * 10 + leg AS RequestID, {AS_OF} + to_minutes(CASE WHEN v % 6 = 5 THEN 10 - leg ELSE leg END) AS RequestedAt, v, f, t, q,
         CASE WHEN v % 9 = 0 THEN 'moved by hand' END AS Notes FROM leg),
numbered AS (SELECT *, row_number() OVER (PARTITION BY v ORDER BY RequestedAt, RequestID) AS n FROM rq),
held AS (SELECT VariantID AS v, list(QuantityOnHand ORDER BY WarehouseID) || [NULL] AS qty FROM b_stock GROUP BY VariantID),
walk AS (
  SELECT 0 AS n, v, qty, NULL::BIGINT AS RequestID, NULL::VARCHAR AS Reason FROM held
  UNION ALL
  SELECT x.n, x.v, CASE WHEN x.why IS NULL THEN list_transform(x.qty, lambda a, i: CASE WHEN i = x.f + 1 THEN a - x.q WHEN i = x.t + 1 THEN coalesce(a, 0) + x.q ELSE a END) ELSE x.qty END,
    x.RequestID, x.why
  FROM (SELECT m.n, w.v, w.qty, m.RequestID, m.f, m.t, m.q,
          CASE WHEN m.f = m.t THEN 'SAME_WAREHOUSE' WHEN m.q <= 0 THEN 'NON_POSITIVE_QUANTITY' WHEN w.qty[m.f + 1] IS NULL THEN 'NO_SOURCE_STOCK'
               WHEN w.qty[m.f + 1] < m.q THEN 'INSUFFICIENT_STOCK' END AS why
        FROM walk w JOIN numbered m ON m.v = w.v AND m.n = w.n + 1) x),
done AS (SELECT m.*, w.Reason, w.qty FROM numbered m JOIN walk w ON w.RequestID = m.RequestID),
ids AS (SELECT StockLevelID, WarehouseID, VariantID FROM b_stock
  UNION ALL SELECT (SELECT max(StockLevelID) FROM b_stock) + row_number() OVER (ORDER BY t, v), t, v
  FROM (SELECT DISTINCT t, v FROM done WHERE Reason IS NULL AND t = 3))"""


def _transfers(c):
    return J.transfer_stock(transfer_requests(c), c.stock_level(), c.orders_as_of)


@query("r9_stock_transfers", f"""WITH RECURSIVE {_TRANSFER_SQL}
SELECT RequestID, CAST(f AS BIGINT) AS FromWarehouseID, CAST(t AS BIGINT) AS ToWarehouseID, v AS VariantID, CAST(q AS BIGINT) AS Quantity, Reason, Reason IS NULL AS Accepted FROM done""")
def r9(c):
    """R9 transfer outcomes in request order: same warehouse / non-positive / no source / insufficient; stock moved in counts."""
    return _transfers(c)["outcomes"]


@query("r9b_transfer_ledger", f"""WITH RECURSIVE {_TRANSFER_SQL}
SELECT ids.StockLevelID, 'TRANSFER' AS MovementType, CAST(-q AS BIGINT) AS QuantityChange, CAST(qty[f + 1] AS BIGINT) AS QuantityAfter, 'TRANSFER' AS ReferenceType,
  coalesce(Notes, 'Transfer to WarehouseID: ' || t) AS Notes, RequestedAt AS MovedAt, RequestID FROM done JOIN ids ON ids.WarehouseID = f AND ids.VariantID = v WHERE Reason IS NULL
UNION ALL SELECT ids.StockLevelID, 'TRANSFER', CAST(q AS BIGINT), CAST(qty[t + 1] AS BIGINT), 'TRANSFER', coalesce(Notes, 'Transfer from WarehouseID: ' || f), RequestedAt, RequestID
FROM done JOIN ids ON ids.WarehouseID = t AND ids.VariantID = v WHERE Reason IS NULL""")
def r9b(c):
    """R9 TRANSFER ledger: two rows per accepted transfer, destination rows created when missing."""
    return _transfers(c)["movements"]


@query("r9c_transfer_stock", f"""WITH RECURSIVE {_TRANSFER_SQL},
final AS (SELECT v, arg_max(qty, n) AS qty FROM walk GROUP BY v)
SELECT ids.StockLevelID, ids.WarehouseID, ids.VariantID, CAST(final.qty[ids.WarehouseID + 1] AS BIGINT) AS QuantityOnHand FROM ids JOIN final ON final.v = ids.VariantID""")
def r9c(c):
    """R9 effect on StockLevel."""
    return _transfers(c)["stock_levels"].select("StockLevelID", "WarehouseID", "VariantID", "QuantityOnHand")


# ----------------------------------------------------------------------------- R10
def sale_ledger_from_lines(c):
    """A SALE ledger of all warehouses built from the shipped lines (order key modulo 3 tells the warehouse, as in
    ``order_requests``), with QuantityAfter recorded the way the reference's set-based insert does it: one after-value per (order, stock row), taken
    after the whole order is deducted — so orders with the same variant twice disagree with a
    row-by-row running balance."""
    from bazaar.operators.windows import running_sum_by_key
    stock = c.stock_level().select("StockLevelID", "WarehouseID", "VariantID", "QuantityOnHand")
    li = c.t.lineitem.select(C("l_orderkey").alias("OrderID"), C("l_linenumber").alias("LineNumber"),
                             C("l_partkey").alias("VariantID"), C("l_quantity").cast("int").alias("Quantity"),
                             C("l_shipdate").alias("MovedAt"))
    li = li.withColumn("WarehouseID", (C("OrderID") % 3).cast(stock.schema["WarehouseID"].dataType)).join(stock, ["VariantID", "WarehouseID"]).withColumnRenamed("MovedAt", "_ship")
    # one movement time per (order, stock row): when the whole order was deducted
    per_order = li.groupBy("StockLevelID", "OrderID").agg(F.min("_ship").alias("MovedAt"),
                                                          F.sum("Quantity").alias("_oq"))
    per_order = running_sum_by_key(per_order, ["StockLevelID"], ["MovedAt", "OrderID"], {"_cum": "_oq"})
    return (li.join(per_order, ["StockLevelID", "OrderID"])
            .select("StockLevelID", F.lit("SALE").alias("MovementType"), (-C("Quantity")).alias("QuantityChange"),
                    (C("QuantityOnHand") - C("_cum")).cast("int").alias("QuantityAfter"),
                    C("OrderID").alias("ReferenceID"), "LineNumber", "MovedAt"))


@query("r10_ledger_reconciliation", """
WITH st AS (SELECT StockLevelID, WarehouseID, VariantID, QuantityOnHand FROM b_stock),
li0 AS (SELECT l_orderkey AS OrderID, l_linenumber AS LineNumber, CAST(l_quantity AS INT) AS Quantity,
              l_shipdate AS ship, st.StockLevelID, st.QuantityOnHand
       FROM lineitem JOIN st ON st.VariantID = l_partkey AND st.WarehouseID = l_orderkey % 3),
po AS (SELECT StockLevelID, OrderID, min(ship) AS MovedAt,
              sum(sum(Quantity)) OVER (PARTITION BY StockLevelID ORDER BY min(ship), OrderID
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
       FROM li0 GROUP BY StockLevelID, OrderID),
li AS (SELECT li0.*, po.MovedAt FROM li0 JOIN po ON po.StockLevelID = li0.StockLevelID AND po.OrderID = li0.OrderID),
led AS (SELECT li.StockLevelID, -li.Quantity AS QuantityChange, li.QuantityOnHand - po.cum AS QuantityAfter,
               li.OrderID AS ReferenceID, li.LineNumber, li.MovedAt, li.QuantityOnHand AS opening
        FROM li JOIN po ON po.StockLevelID = li.StockLevelID AND po.OrderID = li.OrderID),
chk AS (SELECT *, opening + sum(QuantityChange) OVER (PARTITION BY StockLevelID
                  ORDER BY MovedAt, ReferenceID, LineNumber, QuantityChange
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ExpectedAfter FROM led)
SELECT StockLevelID, 'SALE' AS MovementType, CAST(QuantityChange AS BIGINT) AS QuantityChange,
  CAST(QuantityAfter AS BIGINT) AS QuantityAfter, ReferenceID, CAST(LineNumber AS BIGINT) AS LineNumber, MovedAt,
  CAST(ExpectedAfter AS BIGINT) AS ExpectedAfter
FROM chk WHERE ExpectedAfter IS DISTINCT FROM QuantityAfter""")
def r10(c):
    """R10 ledger reconciliation: rows whose recorded QuantityAfter differs from opening + running Σ."""
    led = sale_ledger_from_lines(c)
    opening = c.stock_level().select("StockLevelID", "QuantityOnHand")
    return J.reconcile_ledger(led, opening, ["MovedAt", "ReferenceID", "LineNumber", "QuantityChange"]).drop("_open")


# ----------------------------------------------------------------------------- X14 / A6
def _gold_sql(start: str, end: str, line_grain: bool = False) -> str:
    lf = f"""
of AS (SELECT o.OrderID, CAST(o.PlacedAt AS DATE) AS SummaryDate, o.SubtotalAmount, o.DiscountAmount, o.TotalAmount,
              a.CityID FROM b_order o JOIN b_address a ON a.AddressID = o.ShippingAddressID
       WHERE o.PlacedAt >= TIMESTAMP '{start} 00:00:00' AND o.PlacedAt < TIMESTAMP '{end} 00:00:00' + INTERVAL 1 DAY
         AND o.OrderStatus NOT IN ('CANCELLED')),
lf AS (SELECT l.OrderID, pv.ProductID, p.VendorID, p.CategoryID, sum(l.Quantity) AS LineItemCount,
              sum(l.LineTotal) AS LineRevenue
       FROM b_line l JOIN b_variant pv ON pv.VariantID = l.VariantID JOIN b_product p ON p.ProductID = pv.ProductID
       JOIN of ON of.OrderID = l.OrderID GROUP BY l.OrderID, pv.ProductID, p.VendorID, p.CategoryID),
j AS (SELECT lf.*, of.SummaryDate, of.SubtotalAmount, of.DiscountAmount, of.TotalAmount, c.ProvinceID, v.CommissionRate
      FROM lf JOIN of ON of.OrderID = lf.OrderID JOIN b_city c ON c.CityID = of.CityID JOIN b_vendor v ON v.VendorID = lf.VendorID)"""
    if not line_grain:
        body = """SELECT SummaryDate, VendorID, CategoryID, ProvinceID, count(DISTINCT OrderID) AS OrderCount,
  sum(LineItemCount) AS LineItemCount, sum(SubtotalAmount) AS GrossRevenue, sum(DiscountAmount) AS DiscountTotal,
  sum(TotalAmount) AS NetRevenue, sum(TotalAmount * CommissionRate * 0.01) AS Commission
FROM j GROUP BY SummaryDate, VendorID, CategoryID, ProvinceID"""
    else:
        body = """SELECT SummaryDate, VendorID, CategoryID, ProvinceID, count(*) AS OrderCount, sum(items) AS LineItemCount,
  sum(rev) AS GrossRevenue, sum(disc) AS DiscountTotal, sum(tot) AS NetRevenue, sum(comm) AS Commission
FROM (SELECT SummaryDate, VendorID, CategoryID, ProvinceID, OrderID, sum(LineItemCount) AS items, sum(LineRevenue) AS rev,
        any_value(DiscountAmount) AS disc, any_value(TotalAmount) AS tot,
        any_value(TotalAmount * CommissionRate * 0.01) AS comm
      FROM j GROUP BY SummaryDate, VendorID, CategoryID, ProvinceID, OrderID)
GROUP BY SummaryDate, VendorID, CategoryID, ProvinceID"""
    return lf, body


def _gold_out(name: str) -> str:
    return f"""SELECT CAST(SummaryDate AS TIMESTAMP) AS SummaryDate, VendorID, CAST(CategoryID AS BIGINT) AS CategoryID,
  CAST(ProvinceID AS BIGINT) AS ProvinceID, CAST(OrderCount AS BIGINT) AS OrderCount,
  CAST(LineItemCount AS BIGINT) AS LineItemCount, CAST(GrossRevenue AS DOUBLE) AS GrossRevenue,
  CAST(DiscountTotal AS DOUBLE) AS DiscountTotal, CAST(NetRevenue AS DOUBLE) AS NetRevenue,
  CAST(Commission AS DOUBLE) AS Commission FROM {name}"""


def _gold(c, start, end=None, line_grain=False):
    return J.sales_summary(c.order(), c.order_line(), c.variant(), c.product(), c.address(), c.city(), c.vendor(),
                           start, end, line_grain=line_grain)


_BF_LF, _BF_BODY = _gold_sql("1995-01-01", "2001-08-01")


@query("x14_gold_summary_backfill", f"WITH {_BF_LF}, g AS ({_BF_BODY}) " + _gold_out("g"))
def x14(c):
    """X14 gold SalesSummary rows for every day (reference arithmetic, B3), grouped by day, vendor,
    category and province."""
    return _gold(c, "1995-01-01", "2001-08-01")


_LG_LF, _LG_BODY = _gold_sql("1995-01-01", "2001-08-01", line_grain=True)


@query("x14c_gold_summary_line_grain", f"WITH {_LG_LF}, g AS ({_LG_BODY}) " + _gold_out("g"))
def x14c(c):
    """X14 corrected variant: line revenue as gross, order amounts once per (group, order)."""
    return _gold(c, "1995-01-01", "2001-08-01", line_grain=True)


def _gold_target(c):
    """An existing gold table: 1998 computed with the line-grain arithmetic, SummaryIDs dense over
    the key, computed at 2001-07-01."""
    t = _gold(c, "1998-01-01", "1998-12-31", line_grain=True).withColumn("_nk", F.struct(*J.GOLD_KEYS))
    t = assign_surrogate_keys(t, "_nk", "SummaryID").drop("_nk")
    # an existing table is read from storage, not recomputed: materialise it once
    return t.withColumn("ComputedAt", ts_lit("2001-07-01 00:00:00")).checkpoint(eager=True)


_T_LF, _T_BODY = _gold_sql("1998-01-01", "1998-12-31", line_grain=True)
_S_LF, _S_BODY = _gold_sql("1998-06-01", "1999-06-30")
_UPSERT_SQL = f"""
WITH tgt AS (
  WITH {_T_LF}, g AS ({_T_BODY})
  SELECT *, dense_rank() OVER (ORDER BY SummaryDate, VendorID, CategoryID, ProvinceID) AS SummaryID,
         TIMESTAMP '2001-07-01 00:00:00' AS ComputedAt FROM g),
src AS (WITH {_S_LF}, g AS ({_S_BODY}) SELECT * FROM g),
m AS (
  SELECT coalesce(s.SummaryDate, t.SummaryDate) AS SummaryDate, coalesce(s.VendorID, t.VendorID) AS VendorID,
    coalesce(s.CategoryID, t.CategoryID) AS CategoryID, coalesce(s.ProvinceID, t.ProvinceID) AS ProvinceID,
    CASE WHEN s.SummaryDate IS NOT NULL THEN s.OrderCount ELSE t.OrderCount END AS OrderCount,
    CASE WHEN s.SummaryDate IS NOT NULL THEN s.LineItemCount ELSE t.LineItemCount END AS LineItemCount,
    CASE WHEN s.SummaryDate IS NOT NULL THEN s.GrossRevenue ELSE t.GrossRevenue END AS GrossRevenue,
    CASE WHEN s.SummaryDate IS NOT NULL THEN s.DiscountTotal ELSE t.DiscountTotal END AS DiscountTotal,
    CASE WHEN s.SummaryDate IS NOT NULL THEN s.NetRevenue ELSE t.NetRevenue END AS NetRevenue,
    CASE WHEN s.SummaryDate IS NOT NULL THEN s.Commission ELSE t.Commission END AS Commission,
    t.SummaryID, CASE WHEN s.SummaryDate IS NOT NULL THEN {AS_OF} ELSE t.ComputedAt END AS ComputedAt
  FROM tgt t FULL OUTER JOIN src s ON s.SummaryDate = t.SummaryDate AND s.VendorID = t.VendorID
    AND s.CategoryID = t.CategoryID AND s.ProvinceID = t.ProvinceID),
ids AS (
  SELECT * EXCLUDE (SummaryID), coalesce(SummaryID, (SELECT max(SummaryID) FROM tgt)
           + dense_rank() OVER (PARTITION BY SummaryID IS NULL ORDER BY SummaryDate, VendorID, CategoryID, ProvinceID))
           AS SummaryID FROM m)
SELECT CAST(SummaryDate AS TIMESTAMP) AS SummaryDate, VendorID, CAST(CategoryID AS BIGINT) AS CategoryID,
  CAST(ProvinceID AS BIGINT) AS ProvinceID, CAST(OrderCount AS BIGINT) AS OrderCount,
  CAST(LineItemCount AS BIGINT) AS LineItemCount, CAST(GrossRevenue AS DOUBLE) AS GrossRevenue,
  CAST(DiscountTotal AS DOUBLE) AS DiscountTotal, CAST(NetRevenue AS DOUBLE) AS NetRevenue,
  CAST(Commission AS DOUBLE) AS Commission, CAST(SummaryID AS BIGINT) AS SummaryID, ComputedAt
FROM ids"""


@query("a6_keyed_upsert", _UPSERT_SQL)
def a6(c):
    """A6 keyed upsert (MERGE): refresh 1998-06..1999-06 into a gold table holding 1998; stale rows
    the source does not mention persist (B23); new rows get SummaryIDs after the maximum."""
    src = _gold(c, "1998-06-01", "1999-06-30")
    return J.upsert(_gold_target(c), src, J.GOLD_KEYS, J.GOLD_VALUES, c.orders_as_of, id_col="SummaryID")


_D_LF, _D_BODY = _gold_sql("1998-03-14", "1998-03-14")


@query("x14b_gold_refresh_report", f"""
WITH {_D_LF}, g AS ({_D_BODY})
SELECT CAST(DATE '1998-03-14' AS TIMESTAMP) AS SummaryDate, CAST(count(*) AS BIGINT) AS RowsUpserted,
  CAST(sum(NetRevenue) AS DOUBLE) AS TotalNetRevenue, CAST(sum(OrderCount) AS BIGINT) AS TotalOrders FROM g""")
def x14b(c):
    """X14 refresh of one day (1998-03-14) into the existing gold table + the written-rows report."""
    _, report = J.refresh_sales_summary(_gold_target(c), c.order(), c.order_line(), c.variant(), c.product(),
                                        c.address(), c.city(), c.vendor(), c.orders_as_of, summary_date="1998-03-14")
    return report


def _incremental(c):
    """A gold table of 1998 on storage and two merges of 1998-12-11..1999-01-20 into it: (table, first report, second report)."""
    path = f"{c.spark.sparkContext.getCheckpointDir()}/gold-{uuid.uuid4().hex}"
    table = J.gold_table(c.spark, path)
    tables = (c.order(), c.order_line(), c.variant(), c.product(), c.address(), c.city(), c.vendor())
    table.merge(_gold(c, "1998-12-01", "1998-12-31"), "2001-07-01 00:00:00")
    # some days get other amounts than the refresh finds, as if orders had changed since
    base = _gold(c, "1998-12-11", "1998-12-31").filter(F.dayofmonth("SummaryDate") % 3 == 0)
    off = C("NetRevenue") + F.when(C("VendorID") % 2 == 0, 1).otherwise(0)
    table.merge(base.withColumn("NetRevenue", off.cast(base.schema["NetRevenue"].dataType)), "2001-07-02 00:00:00")
    first = J.refresh_gold(path, *tables, c.orders_as_of, "1998-12-11", "1999-01-20")
    second = J.refresh_gold(path, *tables, c.orders_as_of, "1998-12-11", "1999-01-20")
    return table.read(base.schema), first, second


_INC_LF, _INC_BODY = _gold_sql("1998-12-01", "1999-01-20")


@query("a6b_incremental_merge", f"""
WITH {_INC_LF}, g AS ({_INC_BODY})
SELECT SummaryDate::TIMESTAMP AS SummaryDate, count(*)::BIGINT AS SourceRows,
  SummaryDate >= DATE '1999-01-01' OR (day(SummaryDate) % 3 = 0 AND bool_or(VendorID % 2 = 0)) AS Written, false AS WrittenAgain
FROM g WHERE SummaryDate >= DATE '1998-12-11' GROUP BY SummaryDate""")
def a6b(c):
    """A6 on storage: which days a refresh of 41 days writes into an existing table (those that are new or differ), and
    that the same refresh once more writes none."""
    _, first, second = _incremental(c)
    return first.join(second.select("SummaryDate", C("Written").alias("WrittenAgain")), "SummaryDate")


@query("a6c_merged_table", f"""
WITH {_INC_LF}, g AS ({_INC_BODY}), ids AS (
  SELECT *, dense_rank() OVER (PARTITION BY SummaryDate >= DATE '1999-01-01' ORDER BY SummaryDate, VendorID, CategoryID, ProvinceID)
    + CASE WHEN SummaryDate >= DATE '1999-01-01' THEN (SELECT count(*) FROM g WHERE SummaryDate < DATE '1999-01-01') ELSE 0 END AS id FROM g),
days AS (SELECT SummaryDate AS d, SummaryDate >= DATE '1999-01-01' OR (SummaryDate >= DATE '1998-12-11' AND day(SummaryDate) % 3 = 0 AND bool_or(VendorID % 2 = 0)) AS fresh FROM g GROUP BY 1)
SELECT SummaryDate::TIMESTAMP AS SummaryDate, VendorID, CategoryID::BIGINT AS CategoryID, ProvinceID::BIGINT AS ProvinceID, OrderCount::BIGINT AS OrderCount, LineItemCount::BIGINT AS LineItemCount,
  GrossRevenue::DOUBLE AS GrossRevenue, DiscountTotal::DOUBLE AS DiscountTotal, NetRevenue::DOUBLE AS NetRevenue, Commission::DOUBLE AS Commission, id::BIGINT AS SummaryID,
  CASE WHEN fresh THEN {AS_OF} ELSE TIMESTAMP '2001-07-01 00:00:00' END AS ComputedAt
FROM ids JOIN days ON d = SummaryDate""")
def a6c(c):
    """A6 on storage: the whole table after the merges of ``a6b_incremental_merge``."""
    return _incremental(c)[0]
