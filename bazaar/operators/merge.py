"""Incremental merge into a partitioned table (A6, X14): only partitions whose content changes are read and written.

The table is Parquet partitioned by one column. Beside its partitions lies ``_state`` (readers skip names that begin
with an underscore): one row a partition with the digest of the source rows merged last, and the highest surrogate
key given out. A merge

1. digests the source by partition (one map-side aggregate) and leaves out partitions whose digest is the stored one;
2. reads the others' partitions only (partition filter), merges by key, and leaves out those where nothing changes;
3. raises the key counter in ``_state``, then writes the changed partitions with dynamic partition overwrite: files are
   staged and swapped when the job commits, all others keep their files;
4. stores the new digests.

A run that dies before 3 has changed nothing, one that dies before 4 merges the same rows again, which changes nothing
either. Without ``_state`` everything is merged and the counter is read from the table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.functions.expr import ts_lit
from bazaar.operators.keys import assign_surrogate_keys
from bazaar.session import ensure_checkpoint_dir

C = F.col


def rows_digest(columns: list[str]) -> Column:
    """Order-independent digest of a group's rows: the sum of their 64-bit hashes with the row count in front. Combined
    map-side; nulls and their places count."""
    h = F.xxhash64(*[C(c) for c in columns], *[C(c).isNull() for c in columns]).cast("decimal(20,0)")
    return F.concat_ws(":", F.count(F.lit(1)), F.sum(h))


class PartitionedTable:
    """A Parquet table partitioned by ``partition``, with unique ``keys`` (the partition among them), ``values``, a surrogate
    key ``id_col`` and ``ComputedAt``."""

    def __init__(self, spark, path: str, partition: str, keys: list[str], values: list[str], id_col: str):
        self.spark, self.path, self.partition, self.keys, self.values, self.id_col = spark, path.rstrip("/"), partition, keys, values, id_col
        ensure_checkpoint_dir(spark)

    def _exists(self, path: str) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def read(self, schema: T.StructType) -> DataFrame:
        """The table's rows; none if it was never written. Columns added by ``merge`` follow those of ``schema``."""
        full = T.StructType([schema[c] for c in [*self.keys, *self.values]] + [T.StructField(self.id_col, T.LongType()), T.StructField("ComputedAt", T.TimestampNTZType())])
        if not self._exists(self.path):
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).option("basePath", self.path).parquet(self.path).select(*full.names)

    def _state(self) -> tuple[dict, int | None]:
        """(digest by partition, highest key or None): one row a partition."""
        if not self._exists(f"{self.path}/_state/_SUCCESS"):
            return {}, None
        rows = self.spark.read.parquet(f"{self.path}/_state").collect()
        return {r["part"]: r["digest"] for r in rows if r["part"] is not None}, max((r["top"] for r in rows if r["part"] is None), default=None)

    def _store(self, digests: dict, top: int):
        rows = [(None, None, top)] + [(p, d, None) for p, d in digests.items()]
        self.spark.createDataFrame(rows, "part string, digest string, top long").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_state")

    def merge(self, source: DataFrame, computed_at) -> dict[str, tuple[int, bool]]:
        """Update the rows whose keys the source has, add the others with new surrogate keys, keep what it does not mention.
        Returns, by partition of the source, (source rows, whether the partition was written). ComputedAt of a matched row is
        the time of the merge that last changed its partition."""
        columns = [*self.keys, *self.values]
        source = source.select(*columns).checkpoint(eager=True)
        part = C(self.partition)
        found = {r["p"]: (r["d"], r["n"]) for r in source.groupBy(part.cast("string").alias("p")).agg(rows_digest(columns).alias("d"), F.count(F.lit(1)).alias("n")).collect()}
        stored, top = self._state()
        todo = [p for p, (d, _) in found.items() if stored.get(p) != d]
        report = {p: (n, False) for p, (_, n) in found.items()}
        if not todo:
            return report
        target = self.read(source.schema)
        if top is None:
            top = target.agg(F.max(self.id_col)).first()[0] or 0
        kind = source.schema[self.partition].dataType
        touched = part.isin([F.lit(p).cast(kind) for p in todo])
        s = source.filter(touched).withColumn("_s", F.lit(True))
        j = target.filter(touched).alias("t").join(s.alias("s"), self.keys, "full_outer")
        differs = reduce(lambda a, b: a | b, [~C(f"s.{v}").eqNullSafe(C(f"t.{v}")) for v in self.values], C(f"t.{self.id_col}").isNull())
        merged = j.select(*self.keys, *[F.when(C("_s"), C(f"s.{v}")).otherwise(C(f"t.{v}")).alias(v) for v in self.values], C(f"t.{self.id_col}").alias(self.id_col),
                          F.when(C("_s"), ts_lit(computed_at)).otherwise(C("t.ComputedAt")).alias("ComputedAt"), (C("_s").isNotNull() & differs).alias("_differs")).checkpoint(eager=True)
        facts = merged.groupBy(part.cast("string").alias("p")).agg(F.max("_differs").alias("differs"), F.count(F.when(C(self.id_col).isNull(), 1)).alias("new")).collect()
        changed, new_rows = [r["p"] for r in facts if r["differs"]], sum(r["new"] for r in facts)
        if changed:
            out = merged.drop("_differs").filter(part.isin([F.lit(p).cast(kind) for p in changed]))
            if new_rows:
                fresh = assign_surrogate_keys(out.filter(C(self.id_col).isNull()).withColumn("_nk", F.struct(*self.keys)).drop(self.id_col), "_nk", self.id_col, start=top).drop("_nk")
                out = out.filter(C(self.id_col).isNotNull()).unionByName(fresh)
            top += new_rows
            self._store(stored, top)
            (out.repartition(part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.partition).parquet(self.path))
        self._store(stored | {p: found[p][0] for p in todo}, top)
        return report | {p: (found[p][1], True) for p in changed}
