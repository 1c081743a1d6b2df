"""Binding of the driver's Parquet tables to the logical commerce tables.

The driver ships a TPC-H-like star (region, nation, customer, supplier, part, orders, lineitem) plus
``events`` and text tables. Operators are written against the commerce schema (Order, OrderLine,
Product, ...). This module maps one onto the other with column expressions only, so every bound
table is a lazy projection of a driver scan (pruning and pushdown reach the Parquet reader), and
its size grows with the driver data.

Role mapping (see FIXTURES.md §2): Province = region, City = nation, Vendor = supplier,
Product = part (one variant per product), Order = orders, OrderLine = lineitem,
ShipmentEvent / Review / product_events = events, review text = documents.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.functions.expr import date_lit, ts_lit
from bazaar.sources.tables import DriverTables

# Enumerations of the reference schema used to label bound rows.
PAYMENT_METHODS = ["CREDIT_CARD", "EFT", "INSTANT_EFT", "SNAPSCAN", "MOBICRED", "PAYFLEX"]
DISCOUNT_TYPES = ["PERCENTAGE", "FIXED_AMOUNT", "FREE_SHIPPING"]

# as_of instants for the driver data (max order date; end of the event month).
ORDERS_AS_OF = "2001-08-01 00:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"

C = F.col


def _pick(values: list[str], index: Column) -> Column:
    """values[index] for a 0-based integer column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _money(c: Column) -> Column:
    return c.cast("decimal(18,2)")


class Bindings:
    """Lazy logical tables over one driver scale-factor directory."""

    def __init__(self, tables: DriverTables):
        self.t = tables

    def _count(self, name: str) -> Column:
        """Rows of a driver table as a scalar subquery (evaluated once): derived keys spread over all of it."""
        return getattr(self.t, name).agg(F.count(F.lit(1))).scalar()

    # ------------------------------------------------------------------ geography
    def province(self) -> DataFrame:
        r = self.t.region
        return r.select(C("r_regionkey").alias("ProvinceID"), C("r_name").alias("ProvinceName"))

    def city(self) -> DataFrame:
        n = self.t.nation
        return n.select(C("n_nationkey").alias("CityID"), C("n_regionkey").alias("ProvinceID"),
                        C("n_name").alias("CityName"))

    # ------------------------------------------------------------------ parties
    def customer(self) -> DataFrame:
        c = self.t.customer
        k = C("c_custkey")
        return c.select(
            k.alias("CustomerID"),
            C("c_name").alias("FirstName"),
            C("c_mktsegment").alias("LastName"),
            F.concat(F.lit("c"), k.cast("string"), F.lit("@shop.test")).alias("Email"),
            F.lit(None).cast("string").alias("PhoneNumber"),
            (k % 500).cast("int").alias("LoyaltyPoints"),
            C("c_nationkey").alias("CityID"),
            (k % 20 != 0).alias("IsActive"),
            F.add_months(date_lit("1995-01-01"), (k % 24).cast("int")).cast("timestamp_ntz").alias("CreatedAt"),
        )

    def address(self) -> DataFrame:
        """Default shipping address per customer, plus a billing address for every third one."""
        c = self.t.customer
        k = C("c_custkey")
        main = c.select(k.alias("AddressID"), k.alias("CustomerID"), C("c_nationkey").alias("CityID"),
                        F.concat(k.cast("string"), F.lit(" Main Road")).alias("AddressLine1"),
                        F.lit("SHIPPING").alias("AddressType"), F.lit(True).alias("IsDefault"))
        billing = c.filter(k % 3 == 0).select(
            (k + 1_000_000_000).alias("AddressID"), k.alias("CustomerID"),
            ((C("c_nationkey") + 1) % 25).alias("CityID"),
            F.concat(k.cast("string"), F.lit(" Office Park")).alias("AddressLine1"),
            F.lit("BILLING").alias("AddressType"), F.lit(False).alias("IsDefault"))
        return main.unionByName(billing)

    def vendor(self) -> DataFrame:
        s = self.t.supplier
        k = C("s_suppkey")
        return s.select(
            k.alias("VendorID"), C("s_name").alias("VendorName"),
            F.concat(F.lit("v"), k.cast("string"), F.lit("@vendor.test")).alias("Email"),
            (F.lit(5) + k % 11).cast("decimal(5,2)").alias("CommissionRate"),
            (k % 3 == 0).alias("IsVerified"), (k % 10 != 0).alias("IsActive"),
            ts_lit("1994-06-01 00:00:00").alias("CreatedAt"))

    # ------------------------------------------------------------------ catalogue
    def category(self) -> DataFrame:
        """Three-level tree: region (root) > nation > supplier."""
        r, n, s = self.t.region, self.t.nation, self.t.supplier
        roots = r.select((C("r_regionkey") + 1).cast("int").alias("CategoryID"),
                         F.lit(None).cast("int").alias("ParentCategoryID"), C("r_name").alias("CategoryName"))
        mids = n.select((C("n_nationkey") + 100).cast("int").alias("CategoryID"),
                        (C("n_regionkey") + 1).cast("int").alias("ParentCategoryID"),
                        C("n_name").alias("CategoryName"))
        leaves = s.select((C("s_suppkey") + 10000).cast("int").alias("CategoryID"),
                          (C("s_nationkey") + 100).cast("int").alias("ParentCategoryID"),
                          C("s_name").alias("CategoryName"))
        tree = roots.unionByName(mids).unionByName(leaves)
        return tree.select("*", (C("CategoryID") % 7 != 3).alias("IsActive"),
                           F.concat(F.lit("cat-"), C("CategoryID").cast("string")).alias("CategorySlug"))

    def product(self) -> DataFrame:
        p = self.t.part
        k = C("p_partkey")
        return p.select(
            k.alias("ProductID"), (k % self._count("supplier")).alias("VendorID"),
            (F.lit(10000) + (k * 3) % self._count("supplier")).cast("int").alias("CategoryID"),
            C("p_name").alias("ProductName"), F.concat(F.lit("p-"), k.cast("string")).alias("ProductSlug"),
            C("p_type").alias("ProductType"), _money(C("p_retailprice")).alias("BasePrice"),
            (k % 20 != 0).alias("IsActive"))

    def variant(self) -> DataFrame:
        """One variant per product (VariantID = ProductID)."""
        p = self.t.part
        k = C("p_partkey")
        return p.select(k.alias("VariantID"), k.alias("ProductID"),
                        F.concat(F.lit("SKU-"), k.cast("string")).alias("SKU"),
                        C("p_size").cast("string").alias("SizeName"),
                        C("p_brand").alias("ColourName"),
                        F.lit(Decimal("0.00")).cast("decimal(10,2)").alias("PriceAdjustment"),
                        (k % 50 != 7).alias("IsActive"))

    # ------------------------------------------------------------------ orders
    def order(self) -> DataFrame:
        o = self.t.orders
        k = C("o_orderkey")
        total = _money(C("o_totalprice"))
        disc = (total * (k % 10).cast("decimal(2,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,4)")
        status = (F.when(C("o_orderstatus") == "F", "DELIVERED")
                  .when(C("o_orderstatus") == "O", "CONFIRMED").otherwise("CANCELLED"))
        return o.select(
            k.alias("OrderID"), C("o_custkey").alias("CustomerID"), C("o_custkey").alias("ShippingAddressID"),
            F.when(k % 3 == 0, (k % 25).cast("int")).alias("DiscountID"),
            status.alias("OrderStatus"),
            (total + disc).alias("SubtotalAmount"), disc.alias("DiscountAmount"),
            F.lit(Decimal("0.00")).cast("decimal(18,2)").alias("ShippingAmount"),
            total.alias("TotalAmount"), C("o_orderdate").alias("PlacedAt"), C("o_orderdate").alias("UpdatedAt"))

    def order_line(self) -> DataFrame:
        li = self.t.lineitem
        q = C("l_quantity").cast("int")
        # unit price in whole cents, rounded half up with integer arithmetic (exact everywhere)
        unit = F.expr("(cast(cast(l_extendedprice as decimal(18,2)) * 100 as bigint)"
                      " + cast(l_quantity as int) div 2) div cast(l_quantity as int)")
        return li.select(
            (C("l_orderkey") * 8 + C("l_linenumber")).alias("OrderLineID"),
            C("l_orderkey").alias("OrderID"), C("l_linenumber").alias("LineNumber"), C("l_partkey").alias("VariantID"),
            C("l_partkey").alias("ProductID"), C("l_suppkey").alias("SupplierID"),
            q.alias("Quantity"),
            (unit.cast("decimal(18,2)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)").alias("UnitPrice"),
            _money(C("l_extendedprice")).alias("LineTotal"))

    def payment(self) -> DataFrame:
        """One payment per order; orders with key % 7 = 0 also carry an earlier FAILED attempt."""
        o = self.t.orders
        k = C("o_orderkey")
        st = C("o_orderstatus")
        main = o.select(
            k.alias("PaymentID"), k.alias("OrderID"), _pick(PAYMENT_METHODS, k % 6).alias("PaymentMethod"),
            F.when(st == "F", "CAPTURED").when(st == "O", "AUTHORISED").otherwise("FAILED").alias("PaymentStatus"),
            _money(C("o_totalprice")).alias("Amount"),
            F.when(st == "F", C("o_orderdate")).alias("PaidAt"), C("o_orderdate").alias("CreatedAt"))
        retry = o.filter(k % 7 == 0).select(
            (k + 1_000_000_000).alias("PaymentID"), k.alias("OrderID"),
            _pick(PAYMENT_METHODS, (k + 1) % 6).alias("PaymentMethod"), F.lit("FAILED").alias("PaymentStatus"),
            _money(C("o_totalprice")).alias("Amount"), F.lit(None).cast("timestamp_ntz").alias("PaidAt"),
            C("o_orderdate").alias("CreatedAt"))
        return main.unionByName(retry)

    def courier(self) -> DataFrame:
        r = self.t.region
        return r.select(C("r_regionkey").alias("CourierID"),
                        F.concat(C("r_name"), F.lit(" Couriers")).alias("CourierName"),
                        F.lit(True).alias("IsActive"))

    def shipment(self) -> DataFrame:
        """Shipments for non-cancelled orders: delivered (F) or in transit (O)."""
        o = self.t.orders.filter(C("o_orderstatus").isin("F", "O"))
        k = C("o_orderkey")
        delivered = C("o_orderstatus") == "F"
        return o.select(
            k.alias("ShipmentID"), k.alias("OrderID"), (k % 5).cast("int").alias("CourierID"),
            F.concat(F.lit("TRK"), k.cast("string")).alias("TrackingNumber"),
            F.when(delivered, "DELIVERED").otherwise("IN_TRANSIT").alias("ShipmentStatus"),
            F.date_add(C("o_orderdate").cast("date"), 5).alias("EstimatedDelivery"),
            F.when(delivered, C("o_orderdate") + F.make_dt_interval((k % 9).cast("int"))).alias("ActualDelivery"),
            C("o_orderdate").alias("CreatedAt"))

    def shipment_event(self) -> DataFrame:
        e = self.t.events
        return e.select(C("event_id").alias("EventID"), C("user_id").alias("ShipmentID"),
                        C("event_type").alias("EventStatus"), C("props").alias("EventLocation"),
                        C("ts").alias("EventAt"))

    def discount(self) -> DataFrame:
        n = self.t.nation
        k = C("n_nationkey")
        valid_from = F.add_months(date_lit("2000-01-01"), k).cast("timestamp_ntz")
        return n.select(
            k.alias("DiscountID"), F.concat(F.lit("SAVE"), k.cast("string")).alias("DiscountCode"),
            _pick(DISCOUNT_TYPES, k % 3).alias("DiscountType"),
            (F.lit(5) + k).cast("decimal(10,2)").alias("DiscountValue"),
            F.lit(None).cast("decimal(10,2)").alias("MinOrderValue"),
            (F.lit(100) + k * 10).alias("MaxUsageCount"), (k * 7).alias("UsageCount"),
            valid_from.alias("ValidFrom"),
            F.when(k % 4 != 0, F.add_months(valid_from.cast("date"), 12).cast("timestamp_ntz")).alias("ValidTo"),
            (k % 5 != 0).alias("IsActive"))

    # ------------------------------------------------------------------ inventory
    def warehouse(self) -> DataFrame:
        r = self.t.region.filter(C("r_regionkey") < 3)
        return r.select(C("r_regionkey").alias("WarehouseID"),
                        F.concat(C("r_name"), F.lit(" DC")).alias("WarehouseName"),
                        C("r_regionkey").alias("CityID"), F.lit(True).alias("IsActive"))

    def stock_level(self) -> DataFrame:
        """Each product stocked in warehouses 0, 1, 2 (explode, not a cross join)."""
        p = self.t.part
        k = C("p_partkey")
        w = p.select(k, F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("WarehouseID"))
        return w.select(
            (k * 3 + C("WarehouseID")).alias("StockLevelID"), C("WarehouseID"), k.alias("VariantID"),
            ((k * 7 + C("WarehouseID") * 13) % 40).cast("int").alias("QuantityOnHand"),
            (F.lit(10) + k % 5).cast("int").alias("ReorderPoint"))

    # ------------------------------------------------------------------ reviews / events
    def review(self) -> DataFrame:
        e = self.t.events.filter(C("event_type") == "click")
        return e.select(C("event_id").alias("ReviewID"), (C("event_id") % self._count("part")).alias("ProductID"),
                        C("user_id").alias("CustomerID"), (F.lit(1) + C("event_id") % 5).cast("int").alias("Rating"),
                        (C("event_id") % 4 != 0).alias("IsApproved"), C("ts").alias("CreatedAt"))

    def review_docs(self) -> DataFrame:
        """Review documents (collection ``reviews``) bound to click events."""
        e = self.t.events.filter(C("event_type") == "click")
        k = C("event_id")
        votes = (F.get_json_object(C("props"), "$.k").cast("int") * 2)
        tags = F.array(F.concat(F.lit("t"), (k % 7).cast("string")),
                       F.concat(F.lit("u"), (C("user_id") % 5).cast("string")))
        return e.select((k % self._count("part")).alias("product_id"), C("user_id").alias("customer_id"),
                        (F.lit(1) + k % 5).cast("int").alias("rating"),
                        F.concat(F.lit("review "), k.cast("string")).alias("title"),
                        (k % 4 != 0).alias("is_approved"), votes.alias("helpful_votes"), tags.alias("tags"),
                        C("ts").alias("created_at"))

    def product_events(self) -> DataFrame:
        e = self.t.events
        et = C("event_type")
        mapped = (F.when(et == "view", "VIEW").when(et == "click", "ADD_TO_CART")
                  .when(et == "purchase", "PURCHASE").otherwise(F.upper(et)))
        return e.select(C("user_id").alias("customer_id"), (C("event_id") % self._count("part")).alias("product_id"),
                        mapped.alias("event_type"), C("ts").alias("created_at"))

    def text_reviews(self) -> DataFrame:
        """Review text bound to ``documents``: title = the document's source, body = the whole text."""
        d = self.t.documents
        k = C("doc_id")
        return d.select(k.alias("review_id"), k.alias("product_id"), (k % 97).alias("customer_id"),
                        (F.lit(1) + k % 5).cast("int").alias("rating"), C("source").alias("title"),
                        C("text").alias("body"), C("lang"), (k % 4 != 0).alias("is_approved"))

    def vendor_points(self) -> DataFrame:
        s = self.t.supplier
        k = C("s_suppkey")
        lon = F.lit(28.0473) + ((k * 37) % 100 - 50) * F.lit(0.005)
        lat = F.lit(-26.2041) + ((k * 53) % 100 - 50) * F.lit(0.005)
        return s.select(k.alias("vendor_id"), C("s_name").alias("vendor_name"), lon.alias("lon"), lat.alias("lat"),
                        (k % 2 == 0).alias("pickup_available"))
