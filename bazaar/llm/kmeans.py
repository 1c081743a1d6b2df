"""Centroid clustering by dimension-sharded Lloyd rounds on integer vectors.

Vectors are cut into column blocks. A chunk of vectors has one row per block, and a round is

1. one task per (chunk, block): exact partial squared distances to the block's slice of the centroids;
2. by chunk: the blocks' partial distances are added, and the argmin is taken (ties: smaller number);
3. back at the shards: each block adds up its own columns per cluster, and the sums per (cluster,
   dimension), combined before they travel, give the block's slice of the next centroids.

No task sees a whole vector of a chunk's size times all dimensions and all centroids, and everything is
integer arithmetic, so the result does not depend on the layout. The driver holds the centroids
(clusters x dimensions, both parameters) and nothing that follows the data.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.llm.shared import materialise

#: largest absolute component: 64 squared differences of such numbers still fit a long
MAX_COMPONENT = 1 << 27
#: partial distances (vectors x clusters) of one row
CELLS = 1 << 16
C = F.col


def integer_vectors(df: DataFrame, vec_col: str, dims: int, scale: int = 1024) -> DataFrame:
    """Rows whose vector has exactly ``dims`` components, none null or non-finite; adds ``_v``, the
    components floor(scale * x) as array<bigint>."""
    ok = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = df.where(C(vec_col).isNotNull() & (F.size(vec_col) == dims) & ok)
    return kept.select("*", F.transform(vec_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint")).alias("_v"))


def first_centroids(vectors: DataFrame, id_col: str, k: int, salt: str) -> list[list[int]]:
    """The ``k`` vectors with the smallest sha256 of ``salt:id``; equal ids (and null ones, the empty text) are
    ordered by their components."""
    at = F.sha2(F.concat(F.lit(salt + ":"), F.coalesce(C(id_col).cast("string"), F.lit(""))), 256)
    return [list(r["_v"]) for r in vectors.select(at.alias("_h"), "_v").orderBy("_h", "_v").limit(k).collect()]


def cut(vectors: DataFrame, id_col: str, dims: int, width: int, rows: int) -> DataFrame:
    """(chunk, block, ids, cells): chunks of at most ``rows`` vectors, one row per column block of ``width``
    dimensions with its cells as 32-bit integers, and one row (block -1) with the ids. Chunks follow the
    input's partitions; the result has to be written before use, so that they stay."""
    kind = vectors.schema[id_col].dataType
    src = vectors.select(C(id_col).alias("id"), "_v")

    def run(batches):
        base, n = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                part = batch.slice(lo, rows)
                v = np.asarray(part.column(1).flatten()).reshape(-1, dims)
                if np.abs(v).max(initial=0) >= MAX_COMPONENT:
                    raise ValueError(f"a component of {MAX_COMPONENT} or more: exact distances would not fit a long")
                cells = [np.ascontiguousarray(v[:, c:c + width], np.int32).tobytes() for c in range(0, dims, width)]
                ids = pa.ListArray.from_arrays(pa.array([0] + [part.num_rows] * (len(cells) + 1), pa.int32()), part.column(0))
                yield pa.RecordBatch.from_arrays([pa.array([base + n] * (len(cells) + 1), pa.int64()), pa.array(range(-1, len(cells)), pa.int32()), ids,
                                                  pa.array([None, *cells], pa.binary())], ["chunk", "block", "ids", "cells"])
                n += 1

    return src.mapInArrow(run, T.StructType([T.StructField("chunk", T.LongType()), T.StructField("block", T.IntegerType()),
                                             T.StructField("ids", T.ArrayType(kind)), T.StructField("cells", T.BinaryType())]))


def assign(shards: DataFrame, slices: list[np.ndarray]) -> DataFrame:
    """(chunk, label array<int>, distance array<bigint>) from the shards and the centroids' slices by block."""
    k = len(slices[0])

    def partial(batches):
        for batch in batches:
            out = []
            for block, cells in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                own = slices[block]
                x = np.frombuffer(cells, np.int32).reshape(-1, own.shape[1]).astype(np.int64)
                # one dimension after the other: memory is vectors x clusters
                d = np.zeros((len(x), k), np.int64)
                for j in range(own.shape[1]):
                    d += (x[:, j, None] - own[None, :, j]) ** 2
                out.append(d.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["chunk", "part"])

    def add(table: pa.Table) -> pa.Table:
        parts = table.column("part").to_pylist()
        total = np.frombuffer(parts[0], np.int64).copy()
        for p in parts[1:]:
            total += np.frombuffer(p, np.int64)
        total = total.reshape(-1, k)
        label = total.argmin(1)  # the first of equal ones
        ends = pa.array([0, len(label)], pa.int32())
        return pa.table({"chunk": table.column("chunk").slice(0, 1), "label": pa.ListArray.from_arrays(ends, pa.array(label, pa.int32())),
                         "distance": pa.ListArray.from_arrays(ends, pa.array(total[np.arange(len(label)), label], pa.int64()))})

    parts = shards.select("chunk", "block", "cells").mapInArrow(partial, "chunk long, part binary")
    return parts.groupBy("chunk").applyInArrow(add, "chunk long, label array<int>, distance array<long>")


def update(shards: DataFrame, assigned: DataFrame, centroids: np.ndarray, width: int) -> np.ndarray:
    """The next centroids: exact floor(sum / count) per cluster and dimension; empty clusters stay."""
    k, dims = centroids.shape

    def sums(batches):
        for batch in batches:
            at, dim, total, count = [], [], [], []
            for block, cells, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                w = min(width, dims - block * width)
                x = np.frombuffer(cells, np.int32).reshape(-1, w).astype(np.int64)
                label = np.asarray(label.values)
                order = np.argsort(label, kind="stable")
                found, start, n = np.unique(label[order], return_index=True, return_counts=True)
                at.append(np.repeat(found, w))
                dim.append(np.tile(np.arange(block * width, block * width + w), len(found)))
                total.append(np.add.reduceat(x[order], start, axis=0).ravel())
                count.append(np.repeat(n, w))
            join = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (at, dim, total, count)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in join], ["label", "dim", "total", "n"])

    both = shards.join(assigned.select("chunk", "label"), "chunk").select("block", "cells", "label")
    per = both.mapInArrow(sums, "label long, dim long, total long, n long").groupBy("label", "dim").agg(F.sum("total").alias("s"), F.sum("n").alias("n"))
    out = centroids.copy()
    for r in per.select("label", "dim", F.expr("(s - pmod(s, n)) div n").alias("mean")).collect():  # clusters x dimensions rows
        out[r["label"], r["dim"]] = r["mean"]
    return out


def lloyd(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = 64, k: int = 8, rounds: int = 10, width: int = 16,
          salt: str = "3", scale: int = 1024) -> tuple[DataFrame, np.ndarray]:
    """(clusters, centroids). ``clusters`` has a row (id, cluster int, distance bigint) for every kept vector
    (``integer_vectors``) after ``rounds`` of assignment and update and one last assignment; ``centroids`` are
    the final ones, clusters x dimensions.

    Nulls: a null, short, long or non-finite vector has no row; a null id keeps its vector. Repeated rows count
    as often as they occur and get the same cluster. Ties go to the smaller number. With fewer than ``k`` kept
    vectors there are as many clusters as vectors; with none, the result is empty. Other columns of ``df``, of
    whatever name, are not read. A component of 2**27 or more (after scaling) raises."""
    spark = df.sparkSession
    src = df.select(C(f"`{id_col}`").alias("_id"), C(f"`{vec_col}`").alias("_x"))
    vectors = integer_vectors(src, "_x", dims, scale).select("_id", "_v")
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    first = first_centroids(vectors, "_id", k, salt)
    if not first:
        return spark.createDataFrame([], schema), np.zeros((0, dims), np.int64)
    centroids = np.array(first, np.int64)
    table = materialise(cut(vectors, "_id", dims, width, max(16, CELLS // len(centroids))), "kmeans-shards")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shards = table.where(C("block") >= 0).drop("ids").repartition(parts, "chunk").persist()  # lost ones are read again
    try:
        for _ in range(rounds):
            assigned = assign(shards, _slices(centroids, width))
            centroids = update(shards, assigned, centroids, width)
        final = materialise(assign(shards, _slices(centroids, width)), "kmeans-clusters")
    finally:
        shards.unpersist()
    rows = table.where(C("block") == -1).select("chunk", "ids").join(final, "chunk").select(F.explode(F.arrays_zip("ids", "label", "distance")).alias("r"))
    return rows.select(C("r.ids").alias(id_col), C("r.label").alias("cluster"), C("r.distance").alias("distance")), centroids


def _slices(centroids: np.ndarray, width: int) -> list[np.ndarray]:
    return [np.ascontiguousarray(centroids[:, c:c + width]) for c in range(0, centroids.shape[1], width)]


def with_inertia(clusters: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Add cluster_inertia and inertia (distances summed over the cluster and over all) and centroid_sha256."""
    spark = clusters.sparkSession
    hashes = [(c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids.tolist())]
    per = clusters.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = clusters.agg(F.sum("distance").alias("inertia"))
    facts = per.join(spark.createDataFrame(hashes, "cluster int, centroid_sha256 string"), "cluster").withColumn("inertia", total.scalar())
    return clusters.join(F.broadcast(facts), "cluster")  # one row per cluster


def lloyd_oracle(dims: int = 64, k: int = 8, rounds: int = 10, salt: str = "3", scale: int = 1024) -> str:
    """DuckDB SQL of ``op12_centroids``: long rows (vector, dimension), every round spelt out."""
    step = """
a{r} AS MATERIALIZED (SELECT id, min_by(c, d * 1000 + c) AS c, min(d) AS d FROM
  (SELECT v.id, m.c, sum((v.x - m.x) * (v.x - m.x))::HUGEINT AS d FROM v JOIN m{r} m ON v.i = m.i GROUP BY v.id, m.c) GROUP BY id)"""
    move = """
m{n} AS MATERIALIZED (SELECT m.c, m.i, coalesce(u.x, m.x) AS x FROM m{r} m LEFT JOIN
  (SELECT a.c, v.i, ((sum(v.x) - (((sum(v.x) % count(*)) + count(*)) % count(*))) // count(*))::BIGINT AS x FROM v JOIN a{r} a ON a.id = v.id GROUP BY a.c, v.i) u ON u.c = m.c AND u.i = m.i)"""
    parts = [f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
v AS MATERIALIZED (SELECT id, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM kept),
f AS (SELECT id, row_number() OVER (ORDER BY sha256('{salt}:' || coalesce(vec_id::VARCHAR, '')), e) - 1 AS c FROM kept),
m0 AS MATERIALIZED (SELECT f.c, v.i, v.x FROM f JOIN v ON v.id = f.id WHERE f.c < {k})"""]
    for r in range(rounds):
        parts += [step.format(r=r), move.format(r=r, n=r + 1)]
    parts.append(step.format(r=rounds))
    parts.append(f"""
h AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS s FROM m{rounds} GROUP BY c)""")
    return ",".join(parts) + f"""
SELECT k.vec_id, a.c::INTEGER AS cluster, a.d::BIGINT AS distance, (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
  (sum(a.d) OVER ())::BIGINT AS inertia, h.s AS centroid_sha256
FROM a{rounds} a JOIN kept k ON k.id = a.id JOIN h ON h.c = a.c"""
