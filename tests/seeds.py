"""A4: inline literal rows → typed DataFrames (``spark.createDataFrame(rows, schema)``).

The reference's only literal data are its document seeds and the normalisation walk-through; they
are the golden fixtures of the test suite (FIXTURES.md §3). They are not registered as catalog
queries: every registered query reads the driver tables.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from bazaar.sources.tables import COLLECTIONS

T = dt.datetime

# Review documents of the reference seed (product, customer, rating, title, body,
# verified, approved, helpful votes, tags, created at).
REVIEWS = [
    (1, 1, 5, "Absolutely love these!",
     "Best running shoes I have owned. Great cushioning, true to size. Wore them on a 10km run after one day of "
     "breaking in.", True, True, 14, ["comfortable", "true-to-size", "durable"], T(2024, 1, 20, 10, 30)),
    (1, 2, 4, "Great shoe, delivered fast",
     "Very happy with the quality. Delivery from Joburg to Durban took two days. Minus one star because the box was "
     "slightly damaged.", True, True, 7, ["fast-delivery", "good-quality"], T(2024, 1, 22, 14, 15)),
    (2, 1, 3, "Decent but runs small",
     "The fabric quality is good but I had to exchange for a size up. Size guide on the website should be updated.",
     True, True, 22, ["sizing-issue", "good-fabric"], T(2024, 1, 25, 9, 0)),
    (1, 3, 2, "Disappointed",
     "Sole started separating after 3 weeks. Contacted support — still waiting for a response.",
     True, False, 0, ["defective", "poor-support"], T(2024, 2, 1, 16, 45)),
]

# Product events of the reference seed (customer, product, type, session, created at).
PRODUCT_EVENTS = [
    (1, 1, "VIEW", "sess_abc", T(2024, 1, 19, 9, 0)),
    (1, 1, "ADD_TO_CART", "sess_abc", T(2024, 1, 19, 9, 5)),
    (1, 1, "PURCHASE", "sess_abc", T(2024, 1, 19, 9, 12)),
    (2, 1, "VIEW", "sess_def", T(2024, 1, 20, 11, 0)),
    (2, 1, "VIEW", "sess_def", T(2024, 1, 20, 11, 2)),
    (2, 2, "VIEW", "sess_def", T(2024, 1, 20, 11, 5)),
    (2, 1, "ADD_TO_CART", "sess_def", T(2024, 1, 20, 11, 10)),
    (2, 1, "PURCHASE", "sess_def", T(2024, 1, 20, 11, 15)),
    (3, 1, "VIEW", "sess_ghi", T(2024, 1, 28, 14, 0)),
    (3, 1, "ADD_TO_CART", "sess_ghi", T(2024, 1, 28, 14, 3)),
    (3, 1, "REMOVE_FROM_CART", "sess_ghi", T(2024, 1, 28, 14, 10)),
]

# Vendor pickup points of the reference seed (vendor, name, [lon, lat], address,
# pickup available, hours).
VENDOR_LOCATIONS = [
    (1, "SoleStore", [28.0567, -26.1076], "Shop 12, Sandton City Mall, Johannesburg", True, "Mon-Sat 09:00-18:00"),
    (1, "SoleStore", [18.4232, -33.9249], "44 Long Street, Cape Town", True, "Mon-Fri 08:30-17:30, Sat 09:00-14:00"),
    (2, "ActiveGear", [31.0218, -29.8587], "Pavilion Shopping Centre, Westville, Durban", True, "Mon-Sun 09:00-19:00"),
]

# The unnormalised flat export of the normalisation walk-through.
UNF_ORDERS = [
    (1001, "Thabo Nkosi", "t@mail.co.za", "Johannesburg", "Air Max 90", Decimal("1299.00"), 2,
     "Running Top", Decimal("449.00"), 1),
    (1002, "Ayanda Dube", "a@mail.co.za", "Durban", "Air Max 90", Decimal("1299.00"), 1, None, None, None),
]
# Product → category of the walk-through.
PRODUCT_CATEGORY = [("Air Max 90", "Shoes"), ("Running Top", "Clothing")]

UNF_SCHEMA = ("OrderID int, CustomerName string, CustomerEmail string, CustomerCity string, Product1Name string, "
              "Product1Price decimal(10,2), Product1Qty int, Product2Name string, Product2Price decimal(10,2), "
              "Product2Qty int")


def reviews(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REVIEWS, COLLECTIONS["reviews"])


def product_events(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PRODUCT_EVENTS, COLLECTIONS["product_events"])


def vendor_locations(spark: SparkSession) -> DataFrame:
    """With flat ``lon`` / ``lat`` columns taken from the GeoJSON point ([lon, lat])."""
    from pyspark.sql import functions as F
    rows = [(v, n, ("Point", c), a, p, h) for v, n, c, a, p, h in VENDOR_LOCATIONS]
    df = spark.createDataFrame(rows, COLLECTIONS["vendor_locations"])
    return df.withColumn("lon", F.col("location.coordinates")[0]).withColumn("lat", F.col("location.coordinates")[1])


def unf_orders(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(UNF_ORDERS, UNF_SCHEMA)


def product_category(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PRODUCT_CATEGORY, "ProductName string, Category string")
