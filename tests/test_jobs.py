"""Hand-made edge fixtures for views, hierarchy and batch jobs (FIXTURES.md §3, last paragraph)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from bazaar.operators.documents import parse_line_payload
from bazaar.operators.hierarchy import tree_walk
from bazaar.plans import jobs as J
from bazaar.plans.views import customer_360

T = dt.datetime
AS_OF = "2024-06-01 00:00:00"


def test_customer_segments_all_six(spark):
    cust = spark.createDataFrame(
        [(i, f"F{i}", f"L{i}", f"{i}@x", 0, True, T(2020, 1, 1)) for i in range(1, 8)],
        "CustomerID int, FirstName string, LastName string, Email string, LoyaltyPoints int, IsActive boolean, "
        "CreatedAt timestamp_ntz")
    recent, old = T(2024, 5, 20), T(2023, 11, 1)
    orders = spark.createDataFrame([
        (1, Decimal("60000.00"), recent, "DELIVERED"),
        (2, Decimal("15000.00"), recent, "DELIVERED"), (2, Decimal("5000.00"), recent, "DELIVERED"),
        (3, Decimal("300.00"), recent, "DELIVERED"), (3, Decimal("300.00"), recent, "CANCELLED"),
        (3, Decimal("300.00"), recent, "DELIVERED"),
        (4, Decimal("100.00"), recent, "CONFIRMED"),
        (5, Decimal("250.00"), old, "DELIVERED"), (5, Decimal("250.00"), old, "DELIVERED"),
        (7, Decimal("250.00"), recent, "DELIVERED"), (7, Decimal("250.00"), recent, "DELIVERED"),
    ], "CustomerID int, TotalAmount decimal(10,2), PlacedAt timestamp_ntz, OrderStatus string")
    addresses = spark.createDataFrame([(1,), (1,), (3,)], "CustomerID int")
    reviews = spark.createDataFrame([(2, True), (3, False)], "CustomerID int, IsApproved boolean")
    out = {r.CustomerID: r for r in customer_360(cust, orders, addresses, reviews, AS_OF).collect()}
    assert {k: v.CustomerSegment for k, v in out.items()} == {
        1: "VIP", 2: "LOYAL", 3: "RETURNING", 4: "NEW", 5: "AT_RISK", 6: "INACTIVE", 7: "INACTIVE"}
    assert out[6].TotalOrders == 0 and out[6].TotalSpend == 0 and out[6].DeliveredOrders is None
    assert out[1].AddressCount == 2 and out[6].AddressCount == 0
    assert out[2].HasReviewed == 1 and out[3].HasReviewed == 0
    assert abs(out[3].DeliverySuccessRate - 200 / 3) < 1e-9


def test_tree_walk_inactive_subtree_and_cycle(spark):
    nodes = spark.createDataFrame([
        (1, None, "Root", True), (2, 1, "Off", False), (3, 2, "UnderOff", True), (4, 1, "Shoes", True),
        (5, 4, "Running", True), (6, 7, "CycleA", True), (7, 6, "CycleB", True), (8, None, "OffRoot", False),
        (9, 8, "UnderOffRoot", True)],
        "CategoryID int, ParentCategoryID int, CategoryName string, IsActive boolean")
    got = sorted((r.CategoryID, r.Depth, r.BreadcrumbPath, r.IDPath) for r in tree_walk(nodes).collect())
    assert got == [(1, 0, "Root", "1"), (4, 1, "Root > Shoes", "1.4"), (5, 2, "Root > Shoes > Running", "1.4.5")]


def test_payload_parse_try_cast(spark):
    df = spark.createDataFrame([(1, '[{"VariantID": 5, "Quantity": 2}, {"VariantID": "x", "Quantity": 1}, '
                                   '{"VariantID": 6, "Quantity": 0}, {"VariantID": 7, "Quantity": "3"}]')],
                               "RequestID int, ItemsJson string")
    got = sorted((r.VariantID, r.Quantity) for r in parse_line_payload(df).collect())
    assert got == [(5, 2), (7, 3)]


def test_returns(spark):
    orders = spark.createDataFrame([
        (10, 1, Decimal("105.00"), "DELIVERED", T(2024, 1, 1)), (11, 1, Decimal("50.00"), "CONFIRMED", T(2024, 1, 1))],
        "OrderID int, CustomerID int, TotalAmount decimal(10,2), OrderStatus string, UpdatedAt timestamp_ntz")
    lines = spark.createDataFrame([(10, 1, 2), (10, 2, 1), (11, 1, 5)], "OrderID int, VariantID int, Quantity int")
    stock = spark.createDataFrame([(100, 0, 1, 3), (101, 0, 2, 0)],
                                  "StockLevelID int, WarehouseID int, VariantID int, QuantityOnHand int")
    cust = spark.createDataFrame([(1, 4)], "CustomerID int, LoyaltyPoints int")
    pay = spark.createDataFrame([(10, "CAPTURED")], "OrderID int, PaymentStatus string")
    req = spark.createDataFrame([(1, 10, T(2024, 2, 1)), (2, 11, T(2024, 2, 1)), (3, 99, T(2024, 2, 1)),
                                 (4, 10, T(2024, 2, 2))], "RequestID int, OrderID int, RequestedAt timestamp_ntz")
    out = J.process_returns(req, orders, lines, stock, cust, pay, AS_OF)
    res = {r.RequestID: (r.Accepted, r.Reason, r.RefundAmount) for r in out["outcomes"].collect()}
    assert res == {1: (True, None, Decimal("105.00")), 2: (False, "NOT_DELIVERED", None),
                   3: (False, "ORDER_NOT_FOUND", None), 4: (False, "NOT_DELIVERED", None)}
    assert {r.StockLevelID: r.QuantityOnHand for r in out["stock_levels"].collect()} == {100: 5, 101: 1}
    assert out["customers"].first().LoyaltyPoints == 0  # 4 − ⌊105/10⌋ floored at 0
    assert {r.OrderID: r.OrderStatus for r in out["orders"].collect()} == {10: "REFUNDED", 11: "CONFIRMED"}
    assert out["payments"].first().PaymentStatus == "REFUNDED"


def test_restock_duplicates_inactive_and_insert(spark):
    stock = spark.createDataFrame([(1, 1, 1, 5, 10)],
                                  "StockLevelID int, WarehouseID int, VariantID int, QuantityOnHand int, ReorderPoint int")
    variants = spark.createDataFrame([(1, True), (2, False), (3, True)], "VariantID int, IsActive boolean")
    payload = ('[{"VariantID":"1","Quantity":"10"},{"VariantID":"1","Quantity":"5"},{"VariantID":"2","Quantity":"7"},'
               '{"VariantID":"3","Quantity":"4"},{"VariantID":"x","Quantity":"1"}]')
    req = spark.createDataFrame([(1, 1, payload)], "RequestID int, WarehouseID int, ItemsJson string")
    out = J.restock(req, stock, variants, AS_OF)
    ch = sorted((r.StockLevelID, r.VariantID, r.QuantityBefore, r.QuantityChange, r.QuantityAfter)
                for r in out["changes"].collect())
    assert ch == [(1, 1, 5, 15, 20), (2, 3, None, 4, 4)]
    notes = sorted(r.Notes for r in out["movements"].collect())
    assert notes == ["Restock — WarehouseID: 1 | Before: 0 | After: 4", "Restock — WarehouseID: 1 | Before: 5 | After: 20"]


def test_transfers(spark):
    stock = spark.createDataFrame([(1, 0, 1, 10, 10), (2, 1, 1, 0, 10)],
                                  "StockLevelID long, WarehouseID int, VariantID int, QuantityOnHand int, ReorderPoint int")
    t = T(2024, 3, 1)
    req = spark.createDataFrame([
        (1, t, 0, 1, 1, 6), (2, t + dt.timedelta(minutes=1), 0, 1, 1, 6), (3, t + dt.timedelta(minutes=2), 0, 2, 1, 4),
        (4, t, 0, 0, 1, 1), (5, t, 0, 1, 1, 0), (6, t, 5, 1, 1, 1)],
        "RequestID int, RequestedAt timestamp_ntz, FromWarehouseID int, ToWarehouseID int, VariantID int, Quantity int")
    out = J.transfer_stock(req, stock, AS_OF)
    res = {r.RequestID: (r.Accepted, r.Reason) for r in out["outcomes"].collect()}
    assert res == {1: (True, None), 2: (False, "INSUFFICIENT_STOCK"), 3: (True, None), 4: (False, "SAME_WAREHOUSE"),
                   5: (False, "NON_POSITIVE_QUANTITY"), 6: (False, "NO_SOURCE_STOCK")}
    final = {(r.WarehouseID, r.VariantID): r.QuantityOnHand for r in out["stock_levels"].collect()}
    assert final == {(0, 1): 0, (1, 1): 6, (2, 1): 4}
    led = sorted((r.StockLevelID, r.QuantityChange, r.QuantityAfter) for r in out["movements"].collect())
    assert led == [(1, -6, 4), (1, -4, 0), (2, 6, 6), (3, 4, 4)]


def test_status_transitions(spark):
    orders = spark.createDataFrame([(1, "PENDING", T(2024, 1, 1)), (2, "SHIPPED", T(2024, 1, 1)),
                                    (3, "DELIVERED", T(2024, 1, 1))],
                                   "OrderID int, OrderStatus string, UpdatedAt timestamp_ntz")
    pay = spark.createDataFrame([(2, "AUTHORISED", None), (3, "CAPTURED", T(2024, 1, 2))],
                                "OrderID int, PaymentStatus string, PaidAt timestamp_ntz")
    req = spark.createDataFrame([(i, T(2024, 2, 1), i, s, c) for i, s, c in [(1, "SHIPPED", 1), (2, "DELIVERED", None), (3, "REFUNDED", None), (4, "CONFIRMED", None)]],
                                "RequestID int, RequestedAt timestamp_ntz, OrderID int, NewStatus string, CourierID int")
    out = J.apply_status_changes(req, orders, pay, AS_OF)
    res = {r.OrderID: (r.Accepted, r.Reason) for r in out["outcomes"].collect()}
    assert res == {1: (False, "INVALID_TRANSITION"), 2: (True, None), 3: (True, None), 4: (False, "ORDER_NOT_FOUND")}
    assert {r.OrderID: r.PaymentStatus for r in out["payments"].collect()} == {2: "CAPTURED", 3: "CAPTURED"}
    assert out["shipments"].count() == 0


def test_gold_refresh_is_idempotent(spark):
    from tests.conftest import SF_SMALL
    from bazaar.plans.catalog import Ctx
    c = Ctx(spark, SF_SMALL)
    args = (c.order(), c.order_line(), c.variant(), c.product(), c.address(), c.city(), c.vendor())
    empty = spark.createDataFrame([], "SummaryDate date, VendorID long, CategoryID int, ProvinceID int, OrderCount long, "
                                  "LineItemCount long, GrossRevenue decimal(38,2), DiscountTotal decimal(38,4), "
                                  "NetRevenue decimal(38,2), Commission decimal(38,6), SummaryID long, "
                                  "ComputedAt timestamp_ntz")
    day = c.order().agg(F.max("PlacedAt")).first()[0].date().isoformat()
    once, rep1 = J.refresh_sales_summary(empty, *args, AS_OF, summary_date=day)
    once = once.checkpoint(eager=True)
    twice, rep2 = J.refresh_sales_summary(once, *args, AS_OF, summary_date=day)
    cols = ["SummaryDate", "VendorID", "CategoryID", "ProvinceID", "OrderCount", "NetRevenue", "SummaryID"]
    assert sorted(map(tuple, once.select(cols).collect())) == sorted(map(tuple, twice.select(cols).collect()))
    assert rep1.first().RowsUpserted == rep2.first().RowsUpserted > 0


def test_tree_walk_raises_instead_of_cutting(spark):
    import pytest
    nodes = spark.createDataFrame([(i, i - 1 if i else None, f"n{i}", True) for i in range(8)],
                                  "CategoryID int, ParentCategoryID int, CategoryName string, IsActive boolean")
    assert tree_walk(nodes, max_depth=7).count() == 8
    with pytest.raises(RecursionError):
        tree_walk(nodes, max_depth=3)


def _status_case(spark, first, wishes, courier=None):
    orders = spark.createDataFrame([(1, first, T(2024, 1, 1))], "OrderID int, OrderStatus string, UpdatedAt timestamp_ntz")
    pay = spark.createDataFrame([(1, "AUTHORISED", None)], "OrderID int, PaymentStatus string, PaidAt timestamp_ntz")
    req = spark.createDataFrame([(i, T(2024, 2, 1, 0, i), 1, s, courier, f"TRK{i}") for i, s in enumerate(wishes)],
                                "RequestID int, RequestedAt timestamp_ntz, OrderID int, NewStatus string, CourierID int, TrackingNumber string")
    out = J.apply_status_changes(req, orders, pay, AS_OF)
    return out, [(r.FromStatus, r.Accepted) for r in out["outcomes"].orderBy("RequestID").collect()]


def test_several_status_changes_of_one_order(spark):
    out, got = _status_case(spark, "PENDING", ["CONFIRMED", "CANCELLED", "PROCESSING"])
    assert got == [("PENDING", True), ("CONFIRMED", True), ("CANCELLED", False)]
    assert [(r.OrderID, r.OrderStatus) for r in out["orders"].collect()] == [(1, "CANCELLED")]
    out, got = _status_case(spark, "PENDING", ["CONFIRMED", "PROCESSING", "SHIPPED", "SHIPPED", "DELIVERED", "DELIVERED", "REFUNDED"], courier=4)
    assert [ok for _, ok in got] == [True, True, True, False, True, False, True]
    assert [(r.OrderStatus) for r in out["orders"].collect()] == ["REFUNDED"] and [r.PaymentStatus for r in out["payments"].collect()] == ["CAPTURED"]
    ship = out["shipments"].collect()
    assert [(r.ShipmentID, r.CourierID, r.TrackingNumber) for r in ship] == [(1, 4, "TRK2")] and out["shipment_events"].count() == 1


def test_transfers_chain_through_a_warehouse(spark):
    stock = spark.createDataFrame([(1, 0, 1, 10, 10), (2, 1, 1, 0, 10), (3, 2, 1, 0, 10)],
                                  "StockLevelID long, WarehouseID int, VariantID int, QuantityOnHand int, ReorderPoint int")
    t = T(2024, 3, 1)
    kind = "RequestID int, RequestedAt timestamp_ntz, FromWarehouseID int, ToWarehouseID int, VariantID int, Quantity int"
    req = spark.createDataFrame([(1, t, 0, 1, 1, 5), (2, t, 1, 2, 1, 5), (3, t, 5, 0, 1, 1), (4, t, 2, 5, 1, 2), (5, t, 5, 0, 1, 1), (6, t, 5, 0, 1, 2)], kind)
    out = J.transfer_stock(req, stock, AS_OF)
    assert {r.RequestID: r.Reason for r in out["outcomes"].collect()} == {1: None, 2: None, 3: "NO_SOURCE_STOCK", 4: None, 5: None, 6: "INSUFFICIENT_STOCK"}
    assert {r.WarehouseID: r.QuantityOnHand for r in out["stock_levels"].collect()} == {0: 6, 1: 0, 2: 3, 5: 1}
    assert J.reconcile_ledger(out["movements"], stock, ["MovedAt", "RequestID", "QuantityChange"]).count() == 0
    six = stock.withColumn("QuantityOnHand", F.when(F.col("WarehouseID") == 1, 6).otherwise(F.col("QuantityOnHand")))
    led = J.transfer_stock(req.filter("RequestID <= 2"), six, AS_OF)["movements"]
    assert sorted((r.StockLevelID, r.QuantityChange, r.QuantityAfter) for r in led.collect()) == [(1, -5, 5), (2, -5, 6), (2, 5, 11), (3, 5, 5)]


def test_every_request_has_one_outcome(spark):
    cust = spark.createDataFrame([(1, True, 0)], "CustomerID int, IsActive boolean, LoyaltyPoints int")
    disc = spark.createDataFrame([], "DiscountID int, DiscountCode string, DiscountType string, DiscountValue decimal(10,2), MaxUsageCount int, UsageCount int, "
                                     "ValidFrom timestamp_ntz, ValidTo timestamp_ntz, IsActive boolean")
    variants = spark.createDataFrame([(1, 1, Decimal("0.00"))], "VariantID long, ProductID long, PriceAdjustment decimal(10,2)")
    products = spark.createDataFrame([(1, Decimal("3.00"))], "ProductID long, BasePrice decimal(18,2)")
    stock = spark.createDataFrame([(1, 0, 1, 5)], "StockLevelID long, WarehouseID int, VariantID long, QuantityOnHand int")
    item = lambda v, q: f'{{"VariantID":"{v}","Quantity":"{q}"}}'
    req = spark.createDataFrame([(1, 1, 1, T(2024, 1, 1), None, f"[{item(99, 1)}]"), (2, 1, 1, T(2024, 1, 1), None, f"[{item(1, 2)},{item(99, 1)}]"), (3, 1, 1, T(2024, 1, 1), None, "[]")],
                                "RequestID long, CustomerID int, ShippingAddressID int, RequestedAt timestamp_ntz, DiscountCode string, ItemsJson string")
    out = J.place_orders(req, cust, disc, variants, products, stock, AS_OF)
    assert {r.RequestID: (r.status, r.reason) for r in out["outcomes"].collect()} == {1: ("REJECTED", "NO_VALID_LINES"), 2: ("ACCEPTED", None), 3: ("REJECTED", "NO_VALID_LINES")}
    assert [(r.VariantID, r.Quantity) for r in out["order_lines"].collect()] == [(1, 2)] and out["stock_levels"].first().QuantityOnHand == 3


def test_points_across_the_date_line_and_at_the_pole(spark):
    from bazaar.operators.geo import within_radius
    pts = spark.createDataFrame([(1, 179.95, 0.0), (2, -179.95, 0.0), (3, 170.0, 0.0), (4, 10.0, 89.95), (5, -170.0, 89.95), (6, 0.0, 89.0)], "id int, lon double, lat double")
    near = lambda lon, lat, m: {r.id for r in within_radius(pts, lon, lat, m).collect()}
    assert near(179.99, 0.0, 20_000) == {1, 2} and near(-179.99, 0.0, 20_000) == {1, 2} and near(100.0, 89.99, 20_000) == {4, 5}


def test_prices_come_with_the_lines(spark):
    """Lines get their unit price where they are parsed; a line of an unknown product is a line, but has no price."""
    variants = spark.createDataFrame([(1, 1, Decimal("0.50")), (2, 9, Decimal("0.00"))], "VariantID long, ProductID long, PriceAdjustment decimal(10,2)")
    products = spark.createDataFrame([(1, Decimal("3.00"))], "ProductID long, BasePrice decimal(18,2)")
    items = '[{"VariantID":"1","Quantity":"2"},{"VariantID":"1","Quantity":"1"},{"VariantID":"2","Quantity":"4"},{"VariantID":"7","Quantity":"1"}]'
    req = spark.createDataFrame([(1, items), (2, '[{"VariantID":"2","Quantity":"1"}]')], "RequestID long, ItemsJson string")
    lines = J.order_request_lines(req, variants, products)
    assert {(r.RequestID, r.VariantID): (r.Quantity, r.UnitPrice, r.Priced) for r in lines.collect()} == {
        (1, 1): (3, Decimal("3.50"), True), (1, 2): (4, None, False), (2, 2): (1, None, False)}
    cust = spark.createDataFrame([(1, True)], "CustomerID int, IsActive boolean")
    disc = spark.createDataFrame([], "DiscountID int, DiscountCode string, DiscountType string, DiscountValue decimal(10,2), ValidFrom timestamp_ntz, ValidTo timestamp_ntz, IsActive boolean")
    asked = req.select("RequestID", F.lit(1).alias("CustomerID"), F.lit(None).cast("string").alias("DiscountCode"), "ItemsJson")
    priced = J.price_order_requests(asked, variants, products, disc, cust, AS_OF, lines).collect()
    assert [(r.RequestID, r.SubtotalAmount) for r in priced] == [(1, Decimal("10.50"))]
