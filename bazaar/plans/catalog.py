"""

``QUERIES[name](spark, sf_dir) -> DataFrame`` binds the logical tables (``Bindings``), calls the
operator, and normalises output types for the oracle comparison (``finalize``): integers → BIGINT,
decimals → DOUBLE (exact decimal sums are converted once, at the end), dates → TIMESTAMP_NTZ.
The SQL oracles stand beside the queries and are written independently, in SQL, over ``oracle_bindings``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.plans.oracle_bindings import with_bindings
from bazaar.session import TABLE_SIZES, configure
from bazaar.sources.bindings import EVENTS_AS_OF, ORDERS_AS_OF, Bindings
from bazaar.sources.tables import DriverTables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _norm_type(dt: T.DataType):
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "bigint"
    if isinstance(dt, (T.DecimalType, T.FloatType)):
        return "double"
    if isinstance(dt, T.DateType):
        return "timestamp_ntz"
    return None


def finalize(df: DataFrame) -> DataFrame:
    """Cast every top-level column to the comparison types (see module doc)."""
    cols = []
    for f in df.schema.fields:
        t = _norm_type(f.dataType)
        cols.append(F.col(f"`{f.name}`").cast(t).alias(f.name) if t else F.col(f"`{f.name}`"))
    return df.select(*cols)


class Ctx:
    """Bound logical tables for one (spark, sf_dir)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        configure(spark, TABLE_SIZES)
        self.spark = spark
        self.b = Bindings(DriverTables(spark, sf_dir))
        self.orders_as_of = ORDERS_AS_OF
        self.events_as_of = EVENTS_AS_OF

    def __getattr__(self, name):
        return getattr(self.b, name)


def query(name: str, sql: str | None = None):
    """Register ``fn(ctx) -> DataFrame`` as ``name``; the catalog entry finalizes the output.

    ``sql`` is the DuckDB oracle body; ``b_*`` binding CTEs are prepended automatically."""
    def deco(fn):
        if sql is not None:
            ORACLES[name] = with_bindings(sql)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finalize(fn(Ctx(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


_MODULES = ("q_views", "q_reports", "q_primitives", "q_documents", "q_quality", "q_jobs")


def load_all() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Import every query module (they register themselves) and return the registry."""
    import importlib
    for m in _MODULES:
        importlib.import_module(f"bazaar.plans.{m}")
    return QUERIES
