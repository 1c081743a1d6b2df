"""Document operators: nested JSON export (A5 / X6 / J16), JSON payload parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.functions.expr import full_name

C = F.col

# A3: the line-item payload the API sends as JSON text: [{"VariantID": 1, "Quantity": 2}, ...]
PAYLOAD_SCHEMA = T.ArrayType(T.StructType([T.StructField("VariantID", T.StringType()),
                                           T.StructField("Quantity", T.StringType())]))


#: the elements of a document's orderLines
LINE_ARRAY = ("ARRAY<STRUCT<OrderLineID BIGINT, ProductName STRING, SKU STRING, SizeName STRING,"
              " ColourName STRING, Quantity INT, UnitPrice DOUBLE, LineTotal DOUBLE>>")


def order_documents(orders, customers, lines, variants, products) -> DataFrame:
    """One JSON document per order with a ``customer`` object and an ``orderLines`` array.

    ``collect_list`` is bounded by the lines of one order; lines are sorted inside the document so
    the text is deterministic. NULL-valued keys are omitted (FOR JSON PATH behaviour, M17)."""
    line_doc = F.struct(C("OrderLineID"), C("ProductName"), C("SKU"), C("SizeName"), C("ColourName"),
                        C("Quantity"), C("UnitPrice").cast("double").alias("UnitPrice"),
                        C("LineTotal").cast("double").alias("LineTotal"))
    ln = (lines.select("OrderID", "OrderLineID", "VariantID", "Quantity", "UnitPrice", "LineTotal")
          .join(variants.select("VariantID", "ProductID", "SKU", "SizeName", "ColourName"), "VariantID")
          .join(products.select("ProductID", "ProductName"), "ProductID")
          .groupBy("OrderID").agg(F.array_sort(F.collect_list(line_doc)).alias("_lines")))
    cust = F.struct(C("CustomerID"), full_name().alias("fullName"), C("Email"))
    df = (orders.select("OrderID", "CustomerID", "OrderStatus", "PlacedAt", "TotalAmount")
          .join(customers.select("CustomerID", "FirstName", "LastName", "Email"), "CustomerID")
          .join(ln, "OrderID", "left"))
    return df.select("OrderID", "OrderStatus", "PlacedAt", "TotalAmount",
                     F.to_json(cust).alias("customer"),
                     F.when(C("_lines").isNotNull(), F.to_json(C("_lines"))).alias("orderLines"),
                     F.size(F.coalesce(C("_lines"), F.array())).alias("LineCount"))


def document_json(docs: DataFrame) -> DataFrame:
    """The whole document as one JSON text per order (``customer``/``orderLines`` nested, not quoted)."""
    return docs.select("OrderID", F.to_json(F.struct(
        "OrderID", "OrderStatus", "PlacedAt", C("TotalAmount").cast("double").alias("TotalAmount"),
        F.from_json("customer", "CustomerID BIGINT, fullName STRING, Email STRING").alias("customer"),
        F.from_json("orderLines", LINE_ARRAY).alias("orderLines")))
        .alias("json"))


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A5 sink: one JSON object per line, written in parallel (never one array through the driver)."""
    df.write.mode(mode).json(path)


def parse_line_payload(df: DataFrame, payload_col: str = "ItemsJson", keep=("RequestID",)) -> DataFrame:
    """A3: OPENJSON(@json) WITH (VariantID INT, Quantity INT) → rows, dropping NULL ids / qty ≤ 0.

    Values are parsed as text and converted with ``try_cast`` (TRY_CAST: malformed → NULL, M11)."""
    items = df.select(*keep, F.explode(F.from_json(C(payload_col), PAYLOAD_SCHEMA)).alias("_i"))
    out = items.select(*keep, F.expr("try_cast(_i.VariantID AS INT)").alias("VariantID"),
                       F.expr("try_cast(_i.Quantity AS INT)").alias("Quantity"))
    return out.filter(C("VariantID").isNotNull() & C("Quantity").isNotNull() & (C("Quantity") > 0))
