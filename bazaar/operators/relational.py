"""Relational building blocks that the reference writes with subqueries or APPLY.

Each is a short composition of DataFrame joins / aggregates that Catalyst plans well:
subqueries become semi / anti / left joins on pre-aggregated keys, so nothing is evaluated per
outer row and the inner side is shuffled (or broadcast) once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

C = F.col


def hint_if_few(df: DataFrame, rows: int = 20_000) -> DataFrame:
    """``df`` with a broadcast hint if it has ``rows`` rows at most. Adaptive execution finds that out as well, but only when the
    large side of the join is already shuffled. For tables that are cheap to count."""
    return F.broadcast(df) if df.count() <= rows else df


def exists_in(df: DataFrame, other: DataFrame, keys, negate: bool = False) -> DataFrame:
    """WHERE [NOT] EXISTS / IN (subquery) → left semi / left anti join."""
    return df.join(other, keys, "left_anti" if negate else "left_semi")


def exists_flag(df: DataFrame, other: DataFrame, key: str, name: str) -> DataFrame:
    """CASE WHEN EXISTS (...) THEN 1 ELSE 0 END → left join on the distinct keys."""
    marks = other.select(key).distinct().withColumn("_hit", F.lit(1))
    return df.join(marks, key, "left").withColumn(name, F.coalesce(C("_hit"), F.lit(0))).drop("_hit")


def lateral_aggregate(outer: DataFrame, inner: DataFrame, key: str, aggs: list[Column],
                      zero_fill: dict[str, object] | None = None) -> DataFrame:
    """CROSS APPLY (SELECT aggregates WHERE inner.key = outer.key) — always one row per
    outer row: aggregate the inner side once per key, left join, and fill COUNT-style columns with
    0 (M12). SUM-style columns stay NULL unless listed in ``zero_fill``."""
    agg = inner.groupBy(key).agg(*aggs)
    out = outer.join(agg, key, "left")
    for col_name, value in (zero_fill or {}).items():
        out = out.withColumn(col_name, F.coalesce(C(col_name), F.lit(value)))
    return out


def top_n_per_group(df: DataFrame, group: list[str], order: list[Column], n: int, rank_col: str = "rn") -> DataFrame:
    """CROSS APPLY (SELECT TOP n ... ORDER BY ...) → row_number() ≤ n.

    Catalyst inserts a map-side WindowGroupLimit before the shuffle, so hot groups ship at most n
    rows per task."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(C(rank_col) <= n)


def outer_apply_top1(df: DataFrame, candidates: DataFrame, order: list[Column]) -> DataFrame:
    """OUTER APPLY (SELECT TOP 1 ... ORDER BY ...) with no correlation: a scalar subquery over
    the candidates (one row at most, computed once) attached to every row — no join."""
    ranked = candidates.orderBy(*order) if order else candidates
    # an uncorrelated scalar subquery: evaluated once, no join; no row → NULLs (OUTER semantics)
    best = ranked.limit(1).select(F.struct(*candidates.columns).alias("_top")).scalar()
    return df.withColumn("_top", best).select(*df.columns, *[C(f"_top.{c}").alias(c) for c in candidates.columns])


def set_based_update(target: DataFrame, updates: DataFrame, key: str, column: str, new_value: Column) -> DataFrame:
    """UPDATE t SET col = f(t, u) FROM t JOIN u ON key — rows without a match keep their value.

    ``updates`` must be unique per key (aggregate it first); ``new_value`` may use both sides."""
    joined = target.join(updates.withColumn("_m", F.lit(True)), key, "left")
    out = joined.withColumn(column, F.when(C("_m"), new_value).otherwise(C(column)))
    return out.select(*target.columns)


def unpivot_groups(df: DataFrame, keys: list[str], groups: list[dict[str, str]], index_name: str = "LineNum",
                   drop_all_null: bool = True) -> DataFrame:
    """Repeating column groups → one row per group (multi-measure UNPIVOT).

    ``groups`` lists, per position, {output column: input column}. Uses ``inline`` over an array of
    structs (one pass, no self-union); groups whose measures are all NULL are dropped."""
    outs = list(groups[0].keys())
    structs = [F.struct(F.lit(i + 1).alias(index_name), *[C(g[o]).alias(o) for o in outs])
               for i, g in enumerate(groups)]
    long = df.select(*keys, F.inline(F.array(*structs)))
    if drop_all_null:
        long = long.filter(F.greatest(*[C(o).isNotNull() for o in outs]))
    return long
