"""Grouping operators (G8–G19): labelled ROLLUP / CUBE, PIVOT, $bucket, $facet, $count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.session import ensure_checkpoint_dir

C = F.col
#: rows a group from which a bitmap (4 KB a bucket) is smaller than the ids
DENSE = 256


def rollup_labelled(df: DataFrame, dims: list[str], aggs: list[Column], labels: dict[str, str] | None = None,
                    cube: bool = False, grouping_cols: dict[str, str] | None = None) -> DataFrame:
    """ROLLUP or CUBE with GROUPING() flags.

    ``labels``: dim → text shown for the rolled-up value (``COALESCE(dim, label)``).
    ``grouping_cols``: dim → output name of its GROUPING() flag. Returns the dims (labelled),
    the aggregates and the flags."""
    g = df.cube(*dims) if cube else df.rollup(*dims)
    flags = {d: F.grouping(d).alias(f"_g_{d}") for d in dims}
    out = g.agg(*aggs, *flags.values())
    labels = labels or {}
    cols = [F.coalesce(C(d), F.lit(labels[d])).alias(d) if d in labels else C(d) for d in dims]
    rest = [c for c in out.columns if c not in dims and not c.startswith("_g_")]
    flag_cols = [C(f"_g_{d}").alias((grouping_cols or {}).get(d, f"_g_{d}")) for d in dims]
    return out.select(*cols, *rest, *flag_cols)


def _combined(df: DataFrame, keys: list[str], aggs: list[Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*aggs) if aggs else df.select(*keys).distinct()


def cube_distinct(df: DataFrame, dims: list[str], id_col: str, distinct: str, sums: dict[str, str] | None = None,
                  sets: list[tuple[str, ...]] | None = None) -> DataFrame:
    """Exact COUNT(DISTINCT id) and SUMs over many grouping sets (default: CUBE of ``dims``).

    Rows are combined per (dims, id) once and checkpointed. Every coarser set comes from the smallest finer one, so rows
    are not copied per set (no Expand). A set with ``DENSE`` rows a group on average carries its ids as bitmaps (one of
    32,768 ids a bucket, merged by OR); in sparser sets (S, id) pairs are the smaller form and are combined instead. The
    numbers of groups are estimated in one pass; they choose the form, never the result.

    ``id_col`` is a whole number; null ids are not counted, null dims are a group of their own. Returns the dims (null where
    rolled up), ``sums``, ``distinct`` and ``_g_dim`` flags. The set () gives one row, none for an empty input."""
    sums = sums or {}
    full = tuple(dims)
    wanted = [tuple(d for d in dims if d in s) for s in sets] if sets is not None else [tuple(d for k, d in enumerate(dims) if not m >> k & 1) for m in range(1 << len(dims))]
    ensure_checkpoint_dir(df.sparkSession)
    added = [F.sum(o).alias(o) for o in sums]
    pairs = {full: _combined(df, [*dims, id_col], [F.sum(v).alias(o) for o, v in sums.items()]).checkpoint(eager=True)}
    coarse = [s for s in wanted if s != full]
    stats = pairs[full].agg(F.count(F.lit(1)), *[F.approx_count_distinct(F.struct(*s)) if s else F.lit(1) for s in coarse]).first()
    groups = {full: stats[0]} | dict(zip(coarse, stats[1:]))
    maps: dict[tuple, DataFrame] = {}

    def finer(s: tuple, of: dict) -> tuple | None:
        return min((x for x in of if set(s) < set(x)), key=groups.__getitem__, default=None)

    for s in sorted(coarse, key=len, reverse=True):
        if stats[0] < DENSE * groups[s]:
            pairs[s] = _combined(pairs[finer(s, pairs)], [*s, id_col], added)
        elif (up := finer(s, maps)) is not None:
            maps[s] = maps[up].groupBy(*s, "_bucket").agg(*added, F.bitmap_or_agg("_bits").alias("_bits"))
        else:
            maps[s] = (pairs[finer(s, pairs)].groupBy(*s, F.bitmap_bucket_number(id_col).alias("_bucket"))
                       .agg(*added, F.bitmap_construct_agg(F.bitmap_bit_position(id_col)).alias("_bits")))

    out = None
    for s in sorted(wanted, key=len, reverse=True):
        if s in pairs:
            part = pairs[s].groupBy(*s).agg(*added, F.count(id_col).alias(distinct))
        else:
            part = maps[s].groupBy(*s).agg(*added, F.sum(F.bitmap_count("_bits")).alias(distinct))
        if not s:
            part = part.filter(F.lit(stats[0] > 0))
        part = part.select(*[C(d) if d in s else F.lit(None).cast(df.schema[d].dataType).alias(d) for d in dims], *sums, distinct,
                           *[F.lit(int(d not in s)).alias(f"_g_{d}") for d in dims])
        out = part if out is None else out.unionByName(part)
    return out


def pivot_sum(df: DataFrame, row_keys: list[str], pivot_col: str, values: list[str], measure: str) -> DataFrame:
    """``PIVOT (SUM(measure) FOR pivot_col IN (values))``. The value list is explicit, so no
    extra job discovers distinct values, and the output schema is fixed."""
    return df.groupBy(*row_keys).pivot(pivot_col, values).agg(F.sum(measure))


def bucket_expr(value: Column, boundaries: list, default_label: str) -> Column:
    """$bucket id — the lower boundary of [lo, hi), else ``default_label`` (as string)."""
    expr = None
    for lo, hi in zip(boundaries[:-1], boundaries[1:]):
        cond = (value >= lo) & (value < hi)
        expr = F.when(cond, F.lit(str(lo))) if expr is None else expr.when(cond, F.lit(str(lo)))
    return expr.otherwise(F.lit(default_label))


def bucket_histogram(df: DataFrame, value: str, boundaries: list, default_label: str,
                     measures: list[Column]) -> DataFrame:
    """$bucket with a default bucket; empty buckets are absent (like Mongo)."""
    return df.groupBy(bucket_expr(C(value), boundaries, default_label).alias("_id")).agg(*measures)


def count_stage(df: DataFrame, name: str) -> DataFrame:
    """$count — one row with the count, or no row at all for an empty input."""
    return df.agg(F.count(F.lit(1)).alias(name)).filter(C(name) > 0)


def facet(parts: dict[str, DataFrame]) -> DataFrame:
    """$facet as flat rows ``(facet, doc)``: each sub-pipeline's rows become JSON documents
    tagged with the facet name. Every part is already aggregated (a handful of rows), so nothing
    unbounded is gathered; ``facet_document`` folds them into the single Mongo-style document."""
    out = None
    for name, part in parts.items():
        rows = part.select(F.lit(name).alias("facet"), F.to_json(F.struct(*part.columns)).alias("doc"))
        out = rows if out is None else out.unionByName(rows)
    return out


def facet_document(parts: dict[str, DataFrame]) -> DataFrame:
    """The one-document form of $facet: a single row with ``facets`` = map facet → array of its
    documents (JSON text). Built from the tagged rows of ``facet`` with two aggregations (no joins);
    every part is already aggregated, so the arrays are small."""
    rows = facet(parts)
    per = rows.groupBy("facet").agg(F.collect_list("doc").alias("docs"))
    return per.agg(F.map_from_entries(F.collect_list(F.struct("facet", "docs"))).alias("facets"))
