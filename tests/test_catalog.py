"""Driver contract: entry() smoke + every registered query against its SQL oracle (sf0.001)."""

import duckdb
import pytest

import __spark_entry__ as entry
from bazaar.plans.catalog import ORACLES, load_all
from bazaar.plans.q_jobs import SEQUENTIAL
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, compare

QUERIES = load_all()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "NetRevenue" in df.columns


def test_every_query_has_an_oracle():
    assert set(ORACLES) | set(SEQUENTIAL) == set(QUERIES) and len(ORACLES) >= 115
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", ["r2_discount_usage_cap", "r4_stock_allocation", "r5_sale_ledger", "r5b_new_orders", "r5e_sale_customers"])
def test_sequential_parity(spark, con, name):
    """Orders placed one after the other in SQL."""
    assert compare(QUERIES[name](spark, SF_SMALL).toPandas(), con.execute(SEQUENTIAL[name]).df()) == "exact"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle_parity(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL).toPandas()
    odf = con.execute(ORACLES[name]).df()
    assert compare(sdf, odf) in ("exact", "tol"), name


def test_register_views_as_temp_views(spark):
    from bazaar.plans.catalog import Ctx
    from bazaar.plans.views import register_views
    c = Ctx(spark, SF_SMALL)
    frames = {"Order": c.order(), "Customer": c.customer(), "Address": c.address(), "City": c.city(),
              "Province": c.province(), "Discount": c.discount(), "Payment": c.payment(), "Shipment": c.shipment(),
              "Courier": c.courier(), "OrderLine": c.order_line(), "Product": c.product(), "Category": c.category(),
              "Vendor": c.vendor(), "ProductVariant": c.variant(), "StockLevel": c.stock_level(), "Review": c.review(),
              "ShipmentEvent": c.shipment_event()}
    register_views(spark, frames, c.orders_as_of)
    n = spark.sql("SELECT count(*) AS n FROM vw_RevenueMonthlyTrend").first().n
    assert n == QUERIES["v5_revenue_monthly_trend"](spark, SF_SMALL).count()
    assert spark.sql("SELECT min(RowNum_ByRevenue) FROM vw_ProductSalesRanking").first()[0] == 1
    assert spark.sql("SELECT count(*) FROM vw_Customer360 WHERE CustomerSegment = 'VIP'").first()[0] >= 0
