"""Typed scans (A1, A2).

Two families of schemas:

* ``DRIVER`` — the Parquet tables the driver generates (TPC-H-like star + events + text tables).
* ``LOGICAL`` — the commerce schema the operators are written against (24 tables + 3 document
  collections). Operators accept any DataFrame carrying the columns they use; these StructTypes are
  what a production deployment reads with ``read_table`` and what the constraint audit checks.

Scans never infer a schema; Parquet column pruning and filter pushdown stay intact because the
explicit schema is only a projection contract.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
NTZ, DATE, SH = T.TimestampNTZType(), T.DateType(), T.ShortType()


def _dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


DRIVER: dict[str, T.StructType] = {
    "region": _schema(("r_regionkey", I), ("r_name", S)),
    "nation": _schema(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": _schema(("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D),
                        ("c_mktsegment", S)),
    "supplier": _schema(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "part": _schema(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S), ("p_size", I),
                    ("p_retailprice", D)),
    "orders": _schema(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", D),
                      ("o_orderdate", NTZ), ("o_orderpriority", S)),
    "lineitem": _schema(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I),
                        ("l_quantity", D), ("l_extendedprice", D), ("l_discount", D), ("l_tax", D),
                        ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", NTZ)),
    "events": _schema(("event_id", L), ("ts", NTZ), ("user_id", L), ("event_type", S), ("value", D),
                      ("props", S)),
    "documents": _schema(("doc_id", L), ("text", S), ("lang", S), ("source", S), ("n_chars", L)),
    "labels": _schema(("doc_id", L), ("quality", I), ("toxic", I)),
    "embeddings": _schema(("vec_id", L), ("embedding", T.ArrayType(T.FloatType())), ("label", I)),
    "pages": _schema(("page_id", L), ("url", S), ("html", S)),
    "benchmark": _schema(("item_id", L), ("text", S)),
    "conversations": _schema(("conv_id", L), ("turn", L), ("role", S), ("text", S)),
}

# Logical commerce schema (column lists, types and defaults of the reference DDL).
LOGICAL: dict[str, T.StructType] = {
    "Country": _schema(("CountryID", I), ("CountryCode", S), ("CountryName", S), ("CurrencyCode", S)),
    "Province": _schema(("ProvinceID", I), ("CountryID", I), ("ProvinceCode", S), ("ProvinceName", S)),
    "City": _schema(("CityID", I), ("ProvinceID", I), ("CityName", S), ("PostalCode", S)),
    "Customer": _schema(("CustomerID", I), ("FirstName", S), ("LastName", S), ("Email", S),
                        ("PhoneNumber", S), ("DateOfBirth", DATE), ("LoyaltyPoints", I), ("IsActive", B),
                        ("CreatedAt", NTZ), ("UpdatedAt", NTZ), ("DeletedAt", NTZ)),
    "Address": _schema(("AddressID", I), ("CustomerID", I), ("CityID", I), ("AddressLine1", S),
                       ("AddressLine2", S), ("AddressType", S), ("IsDefault", B), ("CreatedAt", NTZ)),
    "Vendor": _schema(("VendorID", I), ("VendorName", S), ("TradingName", S), ("Email", S),
                      ("PhoneNumber", S), ("VATNumber", S), ("BankName", S), ("BankAccountNo", S),
                      ("CommissionRate", _dec(5, 2)), ("IsVerified", B), ("IsActive", B),
                      ("CreatedAt", NTZ), ("UpdatedAt", NTZ)),
    "Category": _schema(("CategoryID", I), ("ParentCategoryID", I), ("CategoryName", S),
                        ("CategorySlug", S), ("Description", S), ("IsActive", B), ("SortOrder", I)),
    "Product": _schema(("ProductID", I), ("VendorID", I), ("CategoryID", I), ("ProductName", S),
                       ("ProductSlug", S), ("Description", S), ("BasePrice", _dec(10, 2)), ("IsActive", B),
                       ("CreatedAt", NTZ), ("UpdatedAt", NTZ)),
    "ProductVariant": _schema(("VariantID", I), ("ProductID", I), ("SKU", S), ("Barcode", S),
                              ("SizeName", S), ("ColourName", S), ("PriceAdjustment", _dec(10, 2)),
                              ("WeightKg", _dec(8, 3)), ("IsActive", B)),
    "ProductImage": _schema(("ImageID", I), ("ProductID", I), ("ImageUrl", S), ("AltText", S),
                            ("SortOrder", I), ("IsPrimary", B)),
    "Discount": _schema(("DiscountID", I), ("DiscountCode", S), ("DiscountType", S),
                        ("DiscountValue", _dec(10, 2)), ("MinOrderValue", _dec(10, 2)),
                        ("MaxUsageCount", I), ("UsageCount", I), ("ValidFrom", NTZ), ("ValidTo", NTZ),
                        ("IsActive", B)),
    "Order": _schema(("OrderID", I), ("CustomerID", I), ("ShippingAddressID", I), ("DiscountID", I),
                     ("OrderStatus", S), ("SubtotalAmount", _dec(10, 2)), ("DiscountAmount", _dec(10, 2)),
                     ("ShippingAmount", _dec(10, 2)), ("TotalAmount", _dec(10, 2)), ("Notes", S),
                     ("PlacedAt", NTZ), ("UpdatedAt", NTZ)),
    "OrderLine": _schema(("OrderLineID", I), ("OrderID", I), ("VariantID", I), ("Quantity", I),
                         ("UnitPrice", _dec(10, 2)), ("LineTotal", _dec(21, 2))),
    "Payment": _schema(("PaymentID", I), ("OrderID", I), ("PaymentMethod", S), ("PaymentStatus", S),
                       ("Amount", _dec(10, 2)), ("Currency", S), ("GatewayRef", S), ("PaidAt", NTZ),
                       ("CreatedAt", NTZ)),
    "Courier": _schema(("CourierID", I), ("CourierName", S), ("TrackingUrlTemplate", S), ("IsActive", B)),
    "DeliveryZone": _schema(("ZoneID", I), ("CourierID", I), ("CityID", I), ("SLADays", SH),
                            ("BaseDeliveryFee", _dec(8, 2))),
    "Shipment": _schema(("ShipmentID", I), ("OrderID", I), ("CourierID", I), ("TrackingNumber", S),
                        ("ShipmentStatus", S), ("EstimatedDelivery", DATE), ("ActualDelivery", NTZ),
                        ("CreatedAt", NTZ)),
    "ShipmentEvent": _schema(("EventID", I), ("ShipmentID", I), ("EventStatus", S), ("EventLocation", S),
                             ("EventNote", S), ("EventAt", NTZ)),
    "Warehouse": _schema(("WarehouseID", I), ("WarehouseName", S), ("CityID", I), ("AddressLine", S),
                         ("IsActive", B)),
    "StockLevel": _schema(("StockLevelID", I), ("WarehouseID", I), ("VariantID", I),
                          ("QuantityOnHand", I), ("ReorderPoint", I), ("UpdatedAt", NTZ)),
    "StockMovement": _schema(("MovementID", I), ("StockLevelID", I), ("MovementType", S),
                             ("QuantityChange", I), ("QuantityAfter", I), ("ReferenceID", I),
                             ("ReferenceType", S), ("Notes", S), ("MovedAt", NTZ)),
    "Review": _schema(("ReviewID", I), ("ProductID", I), ("CustomerID", I), ("OrderID", I),
                      ("Rating", SH), ("Title", S), ("Body", S), ("IsVerifiedPurchase", B),
                      ("IsApproved", B), ("CreatedAt", NTZ)),
    "ReviewHelpful": _schema(("HelpfulID", I), ("ReviewID", I), ("CustomerID", I), ("IsHelpful", B),
                             ("CreatedAt", NTZ)),
    "SalesSummary": _schema(("SummaryID", I), ("SummaryDate", DATE), ("VendorID", I), ("CategoryID", I),
                            ("ProvinceID", I), ("OrderCount", I), ("LineItemCount", I),
                            ("GrossRevenue", _dec(14, 2)), ("DiscountTotal", _dec(14, 2)),
                            ("NetRevenue", _dec(14, 2)), ("Commission", _dec(14, 2)), ("ComputedAt", NTZ)),
}

# Document collections (A2): nested struct / array columns.
GEO_POINT = T.StructType([T.StructField("type", S), T.StructField("coordinates", T.ArrayType(D))])
COLLECTIONS: dict[str, T.StructType] = {
    "reviews": _schema(("product_id", I), ("customer_id", I), ("rating", I), ("title", S), ("body", S),
                       ("is_verified", B), ("is_approved", B), ("helpful_votes", I),
                       ("tags", T.ArrayType(S)), ("created_at", NTZ)),
    "product_events": _schema(("customer_id", I), ("product_id", I), ("event_type", S),
                              ("session_id", S), ("created_at", NTZ)),
    "vendor_locations": _schema(("vendor_id", I), ("vendor_name", S), ("location", GEO_POINT),
                                ("address", S), ("pickup_available", B), ("hours", S)),
}


def read_table(spark: SparkSession, path: str, name: str, fmt: str = "parquet") -> DataFrame:
    """A1/A2: typed scan of a logical table or document collection stored at ``path``.

    Documents are usually JSON lines (``fmt="json"``); the explicit schema makes nested fields
    typed and unknown keys dropped."""
    schema = LOGICAL.get(name) or COLLECTIONS.get(name)
    if schema is None:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.schema(schema).format(fmt).load(path)


@dataclass
class DriverTables:
    """Lazy typed scans of the driver's Parquet tables under ``sf_dir`` (one file per table)."""

    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in DRIVER:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = (self.spark.read.schema(DRIVER[name])
                                 .parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet"))
        return self._cache[name]

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)
