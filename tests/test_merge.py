"""Incremental merge: only changed partitions are written, a rerun writes nothing, results equal the whole-table upsert."""
import glob
import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from bazaar.operators.merge import PartitionedTable, rows_digest
from bazaar.plans.jobs import upsert

ROWS = "d date, k long, v double, w string"


@pytest.fixture
def table(spark):
    return PartitionedTable(spark, os.path.join(tempfile.mkdtemp(prefix="bazaar-merge-"), "t"), "d", ["d", "k"], ["v", "w"], "id")


def frame(spark, rows):
    import datetime as dt
    return spark.createDataFrame([(dt.date.fromisoformat(d), k, v, w) for d, k, v, w in rows], ROWS).repartition(3)


def times(table):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{table.path}/d=*/*.parquet")}


def content(table, schema):
    return sorted(tuple(map(str, r)) for r in table.read(schema).collect())


BASE = [(f"2024-01-{d:02d}", k, float(k * d), None if k == 3 else f"w{k}") for d in range(1, 8) for k in range(6)]


def test_only_changed_days_are_written(spark, table):
    first = frame(spark, BASE)
    assert all(w for _, w in table.merge(first, "2024-02-01 00:00:00").values())
    before = times(table)
    change = frame(spark, [("2024-01-02", 1, 99.0, "new"), ("2024-01-03", 1, 3.0, "w1"), ("2024-01-09", 5, None, None)])
    report = table.merge(change, "2024-02-02 00:00:00")
    assert report == {"2024-01-02": (1, True), "2024-01-03": (1, False), "2024-01-09": (1, True)}
    after = times(table)
    assert {os.path.basename(os.path.dirname(f)) for f in set(before.items()) ^ set(after.items()) for f in [f[0]]} == {"d=2024-01-02", "d=2024-01-09"}
    assert [(r.k, r.id, str(r.ComputedAt)) for r in table.read(first.schema).filter("d = '2024-01-09'").collect()] == [(5, len(BASE) + 1, "2024-02-02 00:00:00")]


def test_rerun_writes_nothing(spark, table):
    src = frame(spark, BASE)
    table.merge(src, "2024-02-01 00:00:00")
    before = times(table)
    assert not any(w for _, w in table.merge(src.repartition(5), "2024-02-09 00:00:00").values()) and times(table) == before
    shutil.rmtree(f"{table.path}/_state")  # a lost state costs a comparison, not a write
    assert not any(w for _, w in table.merge(src, "2024-02-09 00:00:00").values()) and times(table) == before


def test_equals_the_upsert_of_the_whole_table(spark, table):
    base, src = frame(spark, BASE), frame(spark, [("2024-01-02", k, 1.5, "u") for k in range(3, 9)] + [("2024-01-08", 1, 2.0, None)])
    table.merge(base, "2024-02-01 00:00:00")
    target = table.read(base.schema).checkpoint()
    table.merge(src, "2024-02-02 00:00:00")
    want = upsert(target, src, ["d", "k"], ["v", "w"], "2024-02-02 00:00:00", id_col="id").select("d", "k", "v", "w", "id", "ComputedAt")
    assert content(table, base.schema) == sorted(tuple(map(str, r)) for r in want.collect())


def test_empty_source_and_keys_after_a_lost_state(spark, table):
    schema = frame(spark, BASE).schema
    assert table.merge(spark.createDataFrame([], ROWS), "2024-02-01 00:00:00") == {} and table.read(schema).count() == 0
    table.merge(frame(spark, BASE[:5]), "2024-02-01 00:00:00")
    shutil.rmtree(f"{table.path}/_state")
    table.merge(frame(spark, BASE[5:9]), "2024-02-01 00:00:00")
    assert sorted(r.id for r in table.read(schema).collect()) == list(range(1, 10))


def test_digest_ignores_order_and_sees_changes(spark):
    rows = [(1, "a", None), (1, "a", None), (2, None, "a")]
    def digest(r):
        return spark.createDataFrame(r, "x long, y string, z string").repartition(3).agg(rows_digest(["x", "y", "z"])).first()[0]
    assert digest(rows) == digest(rows[::-1]) != digest([(1, "a", None), (1, "a", None), (2, "a", None)])
    assert digest(rows) != digest(rows[1:])


def test_plan_reads_touched_partitions_only(spark, table):
    src = frame(spark, BASE)
    table.merge(src, "2024-02-01 00:00:00")
    plan = table.read(src.schema).filter(F.col("d").isin([F.lit("2024-01-02").cast("date")]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan
