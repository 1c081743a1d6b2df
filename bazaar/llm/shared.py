"""Intermediate tables in the folder that all executors share (spark.checkpoint.dir)."""

from __future__ import annotations

import pickle
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.session import ensure_checkpoint_dir


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it back: later uses neither recompute it
    nor depend on an executor that made it. The files go when the driver's JVM ends."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(modulus: int, id_col: str = "doc_id"):
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % modulus


def with_columns_replaced(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop columns that an operator is about to add."""
    return df.drop(*[n for n in names if n in df.columns])


def free_names(taken, *names: str) -> list[str]:
    """The names, each with as many underscores behind it as make it different from the ``taken`` ones (case does not count)."""
    low = {t.lower() for t in taken}
    out = []
    for n in names:
        while n.lower() in low:
            n += "_"
        out.append(n)
    return out


def set_aside(df: DataFrame, own: tuple[str, ...]):
    """(``df`` with every column but ``own`` under a name that no operator uses, a function that gives an outcome its names
    back: the columns of ``df`` in their order, then what else the outcome has, unless ``df`` has a column of that name)."""
    others = [c for c in df.columns if c not in own]
    safe = {c: f"_aside_{i}" for i, c in enumerate(others)}
    renamed = df.select(*[F.col(f"`{c}`").alias(safe.get(c, c)) for c in df.columns])

    def restore(out: DataFrame) -> DataFrame:
        extra = [c for c in out.columns if c not in renamed.columns and c not in df.columns]
        return out.select(*[F.col(safe.get(c, c) if c in safe else f"`{c}`").alias(c) for c in df.columns], *extra)

    return renamed, restore


def extended(df: DataFrame, **kinds: str) -> T.StructType:
    """The schema of ``df`` with further columns, all nullable."""
    fields = [T.StructField(f.name, f.dataType, True) for f in df.schema.fields]
    return T.StructType(fields + [T.StructField(k, T._parse_datatype_string(v), True) for k, v in kinds.items()])


class Shipped:
    """An object of bounded size sent to every executor once, with the code of its class."""

    def __init__(self, spark: SparkSession, obj):
        self.data = spark.sparkContext.broadcast(cloudpickle.dumps(obj))

    def load(self):
        return pickle.loads(self.data.value)
