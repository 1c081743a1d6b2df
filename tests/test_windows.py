"""Invariants: distributed global order ≡ plain windows; skew-safe running sums ≡ plain windows."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bazaar.operators.windows import ends_by_key, global_order, neighbours_by_key, ntile_closed_form, rank_by_key, running_sum_by_key, scan_by_key


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_global_order_matches_plain_with_ties(spark):
    random.seed(7)
    data = [(i, Decimal(random.choice([5, 5, 5, 7, 9, 9, 11, 13, 13, 13, 13]) * 100 + random.randint(0, 2)).quantize(
        Decimal("0.01"))) for i in range(2000)]
    df = spark.createDataFrame(data, "k long, v decimal(18,2)")
    cols = ["k", "_rn", "_rank", "_dense", "_n", "_running", "_total", "_ntile"]
    for desc in (True, False):
        a = global_order(df, "v", ["k"], descending=desc, sum_col="v", ntile=4, buckets=7)
        b = global_order(df, "v", ["k"], descending=desc, sum_col="v", ntile=4, plain=True)
        assert _rows(a, cols) == _rows(b, cols)


def test_ntile_closed_form_matches_sql(spark):
    for n in (1, 3, 4, 5, 10, 17):
        df = spark.range(n).withColumn("rn", F.col("id") + 1)
        got = df.select(ntile_closed_form(F.col("rn"), F.lit(n), 4).alias("t")).collect()
        exp = spark.sql(f"select ntile(4) over (order by id) as t from range({n})").collect()
        assert [r.t for r in got] == [r.t for r in exp]


def test_running_sum_by_key_hot_key(spark):
    random.seed(3)
    # one key holds a third of the rows
    data = [(0 if i % 3 == 0 else random.randint(1, 50), i, random.randint(-5, 20)) for i in range(3000)]
    df = spark.createDataFrame(data, "key int, seq long, x int")
    a = running_sum_by_key(df, ["key"], ["seq"], {"run": "x"}, buckets=9)
    b = running_sum_by_key(df, ["key"], ["seq"], {"run": "x"}, plain=True)
    assert _rows(a, ["key", "seq", "run"]) == _rows(b, ["key", "seq", "run"])


def test_global_order_stitches_null_ties(spark):
    data = [(i, None) for i in range(30)] + [(100, 5), (101, 7), (102, 7)]
    df = spark.createDataFrame(data, "k long, v long")
    cols = ["k", "_rn", "_rank", "_dense", "_n"]
    for desc in (True, False):
        for buckets in (1, 4, 9):
            assert _rows(global_order(df, "v", ["k"], descending=desc, buckets=buckets), cols) == _rows(
                global_order(df, "v", ["k"], descending=desc, plain=True), cols)


def _events(spark, seed=5, n=1200):
    rng = random.Random(seed)
    data = [(None if i % 50 == 0 else (0 if i % 3 == 0 else rng.randint(1, 40)), rng.randint(0, 60), i, rng.choice(["a", "b", None]), rng.choice([1, 2, 2, 5, None])) for i in range(n)]
    return spark.createDataFrame(data, "key int, at int, id long, s string, v int")


def test_neighbours_of_hot_keys_match_plain_windows(spark):
    df = _events(spark)
    w = Window.partitionBy("key").orderBy("at", "id")
    want = df.select("key", "id", F.lag("s").over(w).alias("p"), F.lead("at").over(w).alias("n"), F.row_number().over(w).alias("r"))
    for buckets in (1, 6, 40):
        got = neighbours_by_key(df, ["key"], ["at", "id"], lags={"p": "s"}, leads={"n": "at"}, number="r", buckets=buckets)
        plain = lambda d: sorted(map(repr, ((x.key, x.id, x.p, x.n) for x in d.collect())))
        assert plain(got) == plain(want)
        assert {(x.id, x.r) for x in got.collect()} == {(x.id, x.r) for x in want.collect()}


def test_rank_by_key_matches_plain_windows(spark):
    df = _events(spark)
    for desc in (True, False):
        w = Window.partitionBy("key").orderBy(F.col("v").desc() if desc else F.col("v").asc())
        want = df.select("id", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d"))
        got = rank_by_key(df, ["key"], "v", rank="r", dense="d", descending=desc)
        keyed = lambda d: {(x.id, x.r, x.d) for x in d.collect()}
        assert keyed(got) == keyed(want)


def test_ends_by_key_match_plain_windows(spark):
    df = _events(spark).filter("key is not null")
    w = Window.partitionBy("key").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    want = df.select("id", F.first("s").over(w).alias("f"), F.last("s").over(w).alias("l"))
    got = ends_by_key(df, ["key"], ["at", "id"], firsts={"f": "s"}, lasts={"l": "s"}).select("id", "f", "l")
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_scan_by_key_equals_plain_windows(spark, buckets):
    """One key holds over half of the rows, one (key, day) more rows than a bucket; nulls in keys, days and values."""
    rng = random.Random(buckets)
    rows = [(rng.choice([1, 1, 1, 2, None, 3]), rng.choice([5, 5, 5, 6, 7, None, 9]), i, rng.choice([None, i % 9])) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, d long, i long, v long").repartition(5)
    got = scan_by_key(df, ["k"], ["d", "i"], number="n", lags={"pd": "d", "pv": "v"}, sums={"s": "v"}, firsts={"fd": "d"}, through=("u", "d"), buckets=buckets)
    w = Window.partitionBy("k").orderBy("d", "i")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    want = (df.withColumn("n", F.row_number().over(w)).withColumn("pd", F.lag("d").over(w)).withColumn("pv", F.lag("v").over(w)).withColumn("s", F.sum("v").over(run))
            .withColumn("fd", F.first("d").over(run)).withColumn("u", F.count(F.lit(1)).over(Window.partitionBy("k").orderBy("d").rangeBetween(Window.unboundedPreceding, 0))))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, got.select(want.columns).collect())) == sorted(map(key, want.collect()))
    assert scan_by_key(df.limit(0), ["k"], ["d", "i"], number="n", sums={"s": "v"}, through=("u", "d")).collect() == []


def test_buckets_follow_the_rows_size(spark):
    """The number of range buckets is not that of shuffle partitions: it grows with the rows, so a bucket's memory does not."""
    from bazaar.operators.windows import bucketize
    conf = {"spark.sql.shuffle.partitions": "2", "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "40",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        few, many = (spark.range(n).select((F.col("id") % 3).alias("key"), "id", F.xxhash64("id").alias("x")) for n in (300, 60_000))
        counts = [bucketize(d, ["key"], ["id"]).select("_b").distinct().count() for d in (few, many)]
        assert counts[0] < counts[1] and counts[1] > 10
        small = many.withColumn("x", F.col("x") % 1000)
        cols = ["key", "id", "run"]
        assert _rows(running_sum_by_key(small, ["key"], ["id"], {"run": "x"}), cols) == _rows(running_sum_by_key(small, ["key"], ["id"], {"run": "x"}, plain=True), cols)
        order = ["id", "_rn", "_rank", "_dense", "_running"]
        assert _rows(global_order(small, "x", ["id"], sum_col="x"), order) == _rows(global_order(small, "x", ["id"], sum_col="x", plain=True), order)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
