"""Dimension-sharded Lloyd against plain Python."""
import hashlib
import math
import random

import pytest
from pyspark.sql import types as T

from bazaar.llm import kmeans

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("cluster", T.StringType()), T.StructField("_v", T.StringType())])


def plain(rows, dims, k, rounds):
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in kept[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            mine = [v for (_, v), o in zip(kept, own) if o == n]
            if mine:
                centroids[n] = [sum(col) // len(mine) for col in zip(*mine)]
    return [(i, nearest(v)[1], nearest(v)[0]) for i, v in kept], centroids


def run(spark, rows, **params):
    df = spark.createDataFrame([(i, v, "c", "v") for i, v in rows], VECTORS).repartition(3)
    out, centroids = kmeans.lloyd(df, **params)
    return [tuple(r) for r in out.select("vec_id", "cluster", "distance").collect()], centroids.tolist()


def order(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("dims,k,width", [(7, 3, 2), (6, 8, 6), (5, 4, 16)])
def test_against_plain(spark, dims, k, width):
    rng = random.Random(dims)
    f = [[rng.randint(-3, 3) / 8 for _ in range(dims)] for _ in range(40)]
    rows = [(i % 35, v) for i, v in enumerate(f)] + [(None, f[0]), (100, None), (101, f[0][:-1]), (102, [None] + f[0][1:]), (103, [float("nan")] + f[0][1:]), (104, [float("inf")] + f[0][1:])]
    rows += [(200 + i, f[1]) for i in range(30)]  # one vector many times
    got, centroids = run(spark, rows, dims=dims, k=k, width=width, rounds=4)
    want, means = plain(rows, dims, k, 4)
    assert order(got) == order(want) and centroids == means


def test_small_and_empty(spark):
    rows = [(1, [0.5, -0.5]), (2, [1.0, 1.0])]
    assert order(run(spark, rows, dims=2, k=8, rounds=2)[0]) == order(plain(rows, 2, 8, 2)[0])
    assert run(spark, [(1, None)], dims=2, k=8, rounds=2)[0] == []
    out, c = kmeans.lloyd(spark.createDataFrame([(1, None, "c", "v")], VECTORS), dims=2)
    assert kmeans.with_inertia(out, c).collect() == []


def test_too_large_raises(spark):
    with pytest.raises(Exception, match="would not fit"):
        run(spark, [(1, [1e9, 0.0])], dims=2, k=1, rounds=1)


def test_slices_are_cut(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0, 2.0, 3.0, 4.0], "c", "v") for i in range(50)], VECTORS).coalesce(1)
    cut = kmeans.cut(
        kmeans.integer_vectors(df.select("vec_id", "embedding"), "embedding", 5), "vec_id", 5, 2, 16).collect()
    assert sorted({r["block"] for r in cut}) == [-1, 0, 1, 2] and len(cut) == 16
    assert {len(r["cells"]) // 4 for r in cut if r["block"] == 2} <= {16, 2}
