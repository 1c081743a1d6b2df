"""Mixing sources to target weights by systematic sampling.

Targets: every source gets a share of all words by its weight, at most ``max_epochs`` times its own
size; what is cut off is reshared by weight among the rest until nothing is above (water filling,
computed in closed form on the table of sources). Every document of a source then expects the same
number of copies, target / size. The expected copies are prefix-summed within the source in order of
document size, one offset is added, and a copy is emitted at every integer boundary crossed. So a
source's copies differ from the expectation by less than one, spread evenly over small and large
documents, and no document gets more than ceil(max_epochs) copies.

The rank within a source comes from range partitions over (source, size, id) with one offset per
partition, so a source that holds a third of all rows is spread over many tasks.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm.shared import free_names, materialise
from bazaar.operators.windows import running_sum_by_key

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 17


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source_no (rank by code point, null last), source_size, target.

    ``sized`` has source and size. The table holds a row per source, not per document."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = Window.partitionBy(F.lit(0))
    rank = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     F.pmod(F.col("source_no") - 1, F.lit(len(weights))).cast("int") + 1)
    per = (per.withColumn("source_no", F.row_number().over(rank)).withColumn("w", w)
           .withColumn("cap", max_epochs * F.col("source_size").cast("double"))
           .withColumn("ratio", F.col("cap") / F.col("w")))
    # sources in order of cap / weight are saturated first; level of the rest if all before are saturated
    upto = Window.partitionBy(F.lit(0)).orderBy("ratio", "source_no").rowsBetween(Window.unboundedPreceding, -1)
    per = (per.withColumn("level", (F.sum(F.col("source_size").cast("double")).over(every) - F.coalesce(F.sum("cap").over(upto), F.lit(0.0)))
                          / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(upto), F.lit(0.0))))
           .withColumn("open", F.col("level") <= F.col("ratio"))
           .withColumn("water", F.min(F.when(F.col("open"), F.struct("ratio", "source_no", "level"))).over(every)))
    return per.select("source", "source_no", "source_size",
                      F.least(F.col("cap"), F.col("water.level") * F.col("w")).alias("target"))


def mix_sources(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED, size_col: str | None = None) -> DataFrame:
    """Add size, source_size, target and copies (0 or more) to every document.

    docs: doc_id, text, source. Null text has size 0, a null source is a source of its own (last).
    Sources without words have target 0 and no copies. Equal rows are interchangeable; null ids sort
    first. Columns named like the added ones are replaced. An empty table gives an empty table.
    ``size_col`` names a column that already holds the sizes; then no text is needed."""
    u = random.Random(seed).random()
    added = ("size", "source_size", "target", "copies")
    sized = docs.withColumn("size", F.col(size_col) if size_col else word_count(F.col("text"))).drop(*added[1:])
    # rows are numbered and written once, so that ranks are found on narrow rows and meet the texts in one join
    row, = free_names([*docs.columns, *added], "_row")
    rows = materialise(sized.withColumn(row, F.monotonically_increasing_id()), "mix-rows")
    narrow = rows.select(F.col(row).alias("_row"), F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).alias("_id"), "source", "size")
    targets = source_targets(narrow, weights, max_epochs)
    targets = targets.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    n, t = narrow.alias("n"), targets.alias("t")
    # the number of sources is small next to the documents; the planner broadcasts it when its measured size allows
    joined = n.join(t, F.col("n.source").eqNullSafe(F.col("t.source"))).select(
        "_row", "_id", "size", "source_size", "target", F.col("source_no").alias("_no"), F.col("rate").alias("_rate"), F.lit(1).alias("_one"))
    ranked = running_sum_by_key(joined, ["_no"], ["size", "_id", "_row"], {"_rank": "_one"})
    upto = lambda k: F.floor(k * F.col("_rate") + F.lit(u))
    copies = (upto(F.col("_rank").cast("double")) - upto((F.col("_rank") - 1).cast("double"))).cast("long")
    out = rows.join(ranked.select(F.col("_row").alias(row), "source_size", "target", copies.alias("copies")), row)
    return out.select(*[c for c in docs.columns if c not in added], *added)


def emit_copies(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """One row per copy, numbered from 1 in ``copy_no`` (a column of that name is replaced)."""
    cols = [c for c in columns if c != "copy_no"]
    return (mixed.where("copies > 0").select(*cols, F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy_no")))


def mix_oracle(weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> str:
    """DuckDB SQL for the digest columns of the mixing query."""
    u = random.Random(seed).random()
    w = " ".join(f"WHEN {i} THEN {float(x)!r}::DOUBLE" for i, x in enumerate(weights))
    return f"""
WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS source_no FROM sized GROUP BY source),
weighted AS (SELECT *, CASE (source_no - 1) % {len(weights)} {w} END AS w, {float(max_epochs)!r}::DOUBLE * source_size AS cap FROM per),
-- a water level is right if what it gives out is the whole; try the level after each set of saturated sources
tries AS (
  SELECT a.source_no AS k, a.cap / a.w AS ratio,
         ((SELECT sum(source_size) FROM per)::DOUBLE - coalesce(sum(CASE WHEN (b.cap / b.w, b.source_no) < (a.cap / a.w, a.source_no) THEN b.cap END), 0))
         / (sum(b.w) - coalesce(sum(CASE WHEN (b.cap / b.w, b.source_no) < (a.cap / a.w, a.source_no) THEN b.w END), 0)) AS level
  FROM weighted a, weighted b GROUP BY a.source_no, a.cap, a.w),
water AS (SELECT arg_min(level, (ratio, k)) AS level FROM tries WHERE level <= ratio),
targets AS (SELECT source, source_no, source_size, least(cap, level * w) AS target FROM weighted, water),
ranked AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         row_number() OVER (PARTITION BY t.source_no ORDER BY s.size, s.doc_id NULLS FIRST)::DOUBLE AS k
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       ((floor(k * rate + {u!r}::DOUBLE) - floor((k - 1) * rate + {u!r}::DOUBLE)) * size)::BIGINT AS taken
FROM ranked"""
