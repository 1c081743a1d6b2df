"""Window operators.

Partitioned windows (per customer, per shipment, per category) are plain Spark windows: they
shuffle on the partition key and run in parallel.

Windows with no PARTITION BY (global RANK / ROW_NUMBER / NTILE / running SUM / share of total)
make Spark plan ``Exchange SinglePartition``: one task sees every row. That is fine over months,
never over products. ``global_order`` computes the same columns in a distributed way:

1. range-partition by the total order (value, tie-breaker keys) into B buckets and checkpoint, so
   the bucket of every row is fixed even if an executor is lost and work is recomputed;
2. per bucket: local row_number / rank / dense_rank / running sum (parallel windows);
3. per-bucket statistics (B rows — bounded by the bucket count, not the data) give each bucket its
   offsets; tie groups that straddle bucket edges are stitched using first/last values;
4. broadcast the B-row offset table and add offsets.

Because the tie-breaker keys are part of the range key, one hot value cannot pile up in one bucket.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.session import ensure_checkpoint_dir

C = F.col
_NOTHING = object()  # before the first bucket; differs from every value, also from NULL
UNB_PREC, UNB_FOLL, CUR = Window.unboundedPreceding, Window.unboundedFollowing, Window.currentRow


def growth_pct(cur, prev, digits: int = 2) -> Column:
    """CASE WHEN prev > 0 THEN ROUND(100.0 * (cur - prev) / prev, digits) END (in double)."""
    c, p = F.col(cur) if isinstance(cur, str) else cur, F.col(prev) if isinstance(prev, str) else prev
    return F.when(p > 0, F.round(F.lit(100.0) * (c - p).cast("double") / p.cast("double"), digits))


def running_sum(value: str, partition_by=(), order_by=()) -> Column:
    """SUM(value) OVER (PARTITION BY .. ORDER BY .. ROWS UNBOUNDED PRECEDING .. CURRENT ROW)."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by).rowsBetween(UNB_PREC, CUR)
    return F.sum(value).over(w)


def moving_avg_exact(value: str, order_by, preceding: int, partition_by=()) -> Column:
    """AVG over ROWS n PRECEDING .. CURRENT ROW, exact: Σ(decimal) / count, as double."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by).rowsBetween(-preceding, CUR)
    return F.sum(value).over(w).cast("double") / F.count(value).over(w).cast("double")


def first_value_full(value: str, partition_by, order_by) -> Column:
    """FIRST_VALUE(value) OVER (PARTITION BY .. ORDER BY .. ROWS UNBOUNDED PRECEDING ..
    UNBOUNDED FOLLOWING). With DESC order this is also W16's LAST_VALUE of the ASC order."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by).rowsBetween(UNB_PREC, UNB_FOLL)
    return F.first(value).over(w)


def ntile_closed_form(rn: Column, n: Column, k: int) -> Column:
    """NTILE(k) from a 1-based row number and the row count (same buckets as SQL NTILE)."""
    b = F.floor(n / k)
    r = n % k
    big = r * (b + 1)
    return F.when(rn <= big, F.ceil(rn / (b + 1))).otherwise(r + F.ceil((rn - big) / b)).cast("bigint")


def global_order(df: DataFrame, value: str, keys: list[str], descending: bool = True,
                 sum_col: str | None = None, buckets: int | None = None, ntile: int | None = None,
                 plain: bool = False) -> DataFrame:
    """Add global order columns over ``value`` (ties broken by ``keys``):

    ``_rn`` ROW_NUMBER, ``_rank`` RANK, ``_dense`` DENSE_RANK, ``_n`` row count,
    ``_ntile`` NTILE(ntile) if requested, and with ``sum_col``: ``_running`` (ROWS UNBOUNDED
    PRECEDING .. CURRENT ROW) and ``_total`` (SUM() OVER ()).

    ``plain=True`` uses ordinary unpartitioned windows (reference implementation, small inputs).
    """
    vcol = F.col(value).desc() if descending else F.col(value).asc()
    order = [vcol] + [F.col(k).asc() for k in keys]
    if plain:
        w = Window.orderBy(*order)
        wv = Window.orderBy(vcol)
        out = (df.withColumn("_rn", F.row_number().over(w).cast("bigint"))
               .withColumn("_rank", F.rank().over(wv).cast("bigint"))
               .withColumn("_dense", F.dense_rank().over(wv).cast("bigint"))
               .withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy()).cast("bigint")))
        if sum_col:
            out = (out.withColumn("_running", F.sum(sum_col).over(w.rowsBetween(UNB_PREC, CUR)))
                   .withColumn("_total", F.sum(sum_col).over(Window.partitionBy())))
        if ntile:
            out = out.withColumn("_ntile", ntile_closed_form(F.col("_rn"), F.col("_n"), ntile))
        return out

    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    # without a number, adaptive execution merges neighbouring ranges up to its partition size, whatever the rows' number
    ranged = df.repartitionByRange(*([buckets] if buckets else []), *order).withColumn("_b", F.spark_partition_id())
    ranged = ranged.checkpoint(eager=True)  # bucket ids frozen; survives executor loss

    wl = Window.partitionBy("_b").orderBy(*order)
    wlv = Window.partitionBy("_b").orderBy(vcol)
    local = (ranged.withColumn("_lrn", F.row_number().over(wl))
             .withColumn("_lrank", F.rank().over(wlv))
             .withColumn("_ldense", F.dense_rank().over(wlv)))
    if sum_col:
        local = local.withColumn("_lrun", F.sum(sum_col).over(wl.rowsBetween(UNB_PREC, CUR)))

    aggs = [F.count(F.lit(1)).alias("n"), F.max("_lrank").alias("last_lrank"), F.max("_ldense").alias("nd"),
            F.min_by(value, "_lrn").alias("first_v"), F.max_by(value, "_lrn").alias("last_v")]  # NULL is a value here
    if sum_col:
        aggs.append(F.sum(sum_col).alias("s"))
    # B rows: one per bucket. Collected on purpose — its size is the bucket count, not the data.
    stats = sorted(local.groupBy("_b").agg(*aggs).collect(), key=lambda r: r["_b"])

    sum_type = local.schema[sum_col].dataType if sum_col else None
    if sum_col and isinstance(sum_type, T.DecimalType):
        sum_type = T.DecimalType(min(38, sum_type.precision + 10), sum_type.scale)
    elif sum_col and isinstance(sum_type, (T.IntegerType, T.LongType, T.ShortType)):
        sum_type = T.LongType()
    elif sum_col:
        sum_type = T.DoubleType()

    rows = []
    off_n, off_s, seen_dense = 0, (Decimal(0) if isinstance(sum_type, T.DecimalType) else 0), 0
    prev_last_v, prev_last_rank = _NOTHING, None
    total_n = sum(r["n"] for r in stats)
    total_s = sum((r["s"] for r in stats if r["s"] is not None), off_s) if sum_col else None
    for r in stats:
        overlap = prev_last_v is not _NOTHING and r["first_v"] == prev_last_v
        rank_first = prev_last_rank if overlap else off_n + 1
        base_dense = seen_dense - 1 if overlap else seen_dense
        last_rank = rank_first if r["last_lrank"] == 1 else off_n + r["last_lrank"]
        rows.append((r["_b"], off_n, rank_first, base_dense, off_s if sum_col else None))
        off_n += r["n"]
        if sum_col and r["s"] is not None:
            off_s = off_s + r["s"]
        seen_dense = base_dense + r["nd"]
        prev_last_v, prev_last_rank = r["last_v"], last_rank
    schema = T.StructType([T.StructField("_b", T.IntegerType()), T.StructField("_off_n", T.LongType()),
                           T.StructField("_rank_first", T.LongType()), T.StructField("_base_dense", T.LongType()),
                           T.StructField("_off_s", sum_type or T.LongType())])
    offsets = spark.createDataFrame(rows, schema)

    out = local.join(F.broadcast(offsets), "_b")
    out = (out.withColumn("_rn", (F.col("_off_n") + F.col("_lrn")).cast("bigint"))
           .withColumn("_rank", F.when(F.col("_lrank") == 1, F.col("_rank_first"))
                       .otherwise(F.col("_off_n") + F.col("_lrank")).cast("bigint"))
           .withColumn("_dense", (F.col("_base_dense") + F.col("_ldense")).cast("bigint"))
           .withColumn("_n", F.lit(total_n).cast("bigint")))
    if sum_col:
        out = (out.withColumn("_running", (F.col("_off_s") + F.col("_lrun")).cast(sum_type))
               .withColumn("_total", F.lit(total_s).cast(sum_type)))
    if ntile:
        out = out.withColumn("_ntile", ntile_closed_form(F.col("_rn"), F.col("_n"), ntile))
    return out.drop("_b", "_lrn", "_lrank", "_ldense", "_lrun", "_off_n", "_rank_first", "_base_dense", "_off_s")


def _running_type(dt: T.DataType) -> T.DataType:
    if isinstance(dt, T.DecimalType):
        return T.DecimalType(min(38, dt.precision + 10), dt.scale)
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    return T.DoubleType()


def bucketize(df: DataFrame, keys: list[str], order: list[str], buckets: int | None = None) -> DataFrame:
    """Range-partition on (keys, order) and freeze the bucket id ``_b`` with a reliable checkpoint.
    A key holding a third of the rows spans many buckets instead of one task. Without ``buckets``, their number follows the
    rows' size (``session.TABLE_SIZES``)."""
    ensure_checkpoint_dir(df.sparkSession)
    return (df.repartitionByRange(*([buckets] if buckets else []), *[F.col(k).asc() for k in keys], *[F.col(o).asc() for o in order])
            .withColumn("_b", F.spark_partition_id()).checkpoint(eager=True))


def bucket_edges(bucketed: DataFrame, keys: list[str]) -> list:
    """(bucket, first key, last key) of a frozen layout: one row per bucket, whatever the data's size."""
    kstruct = F.struct(*keys)
    return bucketed.groupBy("_b").agg(F.min(kstruct).alias("first_k"), F.max(kstruct).alias("last_k")).collect()


def _same(keys: list[str]) -> Column:
    """Bucket and key (NULL equal to NULL) of a row and of a bucket's edge."""
    on = F.col("_b") == F.col("_eb")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_e_{k}"))
    return on


def running_sum_in_buckets(bucketed: DataFrame, keys: list[str], order: list[str], values: dict[str, str],
                           edges: list | None = None) -> DataFrame:
    """Running sums per key over rows already carrying a frozen bucket id ``_b`` (see ``bucketize``;
    columns may have been added or changed and rows removed since, the bucket of each row stays fixed).
    ``edges``: the layout's ``bucket_edges``, if the caller sums over it more than once.

    Each bucket computes local running sums; only the first key of a bucket can continue a key from
    earlier buckets, so the offset table has at most one row per bucket (a proven size bound) and is
    broadcast."""
    spark = bucketed.sparkSession
    wl = Window.partitionBy("_b", *keys).orderBy(*order).rowsBetween(UNB_PREC, CUR)
    local = bucketed
    for o, v in values.items():
        local = local.withColumn(f"_l_{o}", F.sum(v).over(wl))
    # bucket edges and the sum of each bucket's last key: plain aggregates, no window or sort
    edges = bucket_edges(bucketed, keys) if edges is None else edges
    last_rows = [(r["_b"], *tuple(r["last_k"])) for r in edges]
    last_df = spark.createDataFrame(last_rows, T.StructType(
        [T.StructField("_b", T.IntegerType())] + [T.StructField(k, bucketed.schema[k].dataType) for k in keys]))
    last_df = last_df.select(F.col("_b").alias("_eb"), *[F.col(k).alias(f"_e_{k}") for k in keys])
    tails = {r["_b"]: r for r in bucketed.join(F.broadcast(last_df), _same(keys), "left_semi")
             .groupBy("_b").agg(*[F.sum(v).alias(f"tail_{o}") for o, v in values.items()]).collect()}
    stats = [dict(_b=r["_b"], first_k=r["first_k"], last_k=r["last_k"],
                  **{f"tail_{o}": (tails[r["_b"]][f"tail_{o}"] if r["_b"] in tails else 0) for o in values})
             for r in edges]
    stats.sort(key=lambda r: r["_b"])
    types = {o: _running_type(bucketed.schema[v].dataType) for o, v in values.items()}
    rows, carry_key, carry = [], None, {o: 0 for o in values}
    for r in stats:
        first, last = tuple(r["first_k"]), tuple(r["last_k"])
        off = {o: (carry[o] if first == carry_key else 0) for o in values}
        if any(off[o] for o in values):
            rows.append((r["_b"], *first, *[off[o] for o in values]))
        tail = {o: (r[f"tail_{o}"] or 0) for o in values}
        carry = {o: (off[o] + tail[o]) if first == last else tail[o] for o in values}
        carry_key = last
    schema = T.StructType([T.StructField("_b", T.IntegerType())]
                          + [T.StructField(k, bucketed.schema[k].dataType) for k in keys]
                          + [T.StructField(f"_off_{o}", types[o]) for o in values])
    offsets = spark.createDataFrame(rows, schema)
    offsets = offsets.select(F.col("_b").alias("_eb"), *[F.col(k).alias(f"_e_{k}") for k in keys], *[f"_off_{o}" for o in values])
    out = local.join(F.broadcast(offsets), _same(keys), "left").drop("_eb", *[f"_e_{k}" for k in keys])
    for o in values:
        out = out.withColumn(o, (F.coalesce(F.col(f"_off_{o}"), F.lit(0).cast(types[o])) + F.col(f"_l_{o}"))
                             .cast(types[o]))
    return out.drop(*[f"_l_{o}" for o in values], *[f"_off_{o}" for o in values])


def running_sum_by_key(df: DataFrame, keys: list[str], order: list[str], values: dict[str, str],
                       buckets: int | None = None, plain: bool = False) -> DataFrame:
    """W4 for skewed keys: for every (out, value) in ``values`` add ``out`` = SUM(value) OVER
    (PARTITION BY keys ORDER BY order ROWS UNBOUNDED PRECEDING .. CURRENT ROW).

    ``order`` (ascending column names) must be a total order within a key. A plain window puts
    every row of one key into one task; here rows are range-partitioned on (keys, order)
    (``bucketize``) and summed per bucket with broadcast offsets (``running_sum_in_buckets``).
    """
    if plain:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(UNB_PREC, CUR)
        out = df
        for o, v in values.items():
            out = out.withColumn(o, F.sum(v).over(w).cast(_running_type(df.schema[v].dataType)))
        return out
    return running_sum_in_buckets(bucketize(df, keys, order, buckets), keys, order, values).drop("_b")


def neighbours_by_key(df: DataFrame, keys: list[str], order: list[str], lags: dict[str, str] | None = None,
                      leads: dict[str, str] | None = None, number: str | None = None,
                      buckets: int | None = None) -> DataFrame:
    """LAG / LEAD / ROW_NUMBER over (PARTITION BY keys ORDER BY order) for skewed keys.

    ``lags`` and ``leads`` map output to input columns, ``order`` (ascending) must be total within a key. Rows are
    range-partitioned on (keys, order), so a hot key spans many buckets; each bucket finds its own neighbours, and
    only a bucket's first and last rows look into the next bucket. These two rows per bucket are collected (a bound
    that does not follow the data) and broadcast."""
    lags, leads = lags or {}, leads or {}
    spark = df.sparkSession
    b = bucketize(df, keys, order, buckets)
    wl = Window.partitionBy("_b", *keys).orderBy(*order)
    local = b.withColumn("_first", F.row_number().over(wl) == 1).withColumn("_last", F.lead(F.lit(1)).over(wl).isNull())
    for o, v in lags.items():
        local = local.withColumn(f"_p_{o}", F.lag(v).over(wl))
    for o, v in leads.items():
        local = local.withColumn(f"_n_{o}", F.lead(v).over(wl))
    cols = list(dict.fromkeys([*lags.values(), *leads.values()]))
    row = F.struct(F.struct(*keys).alias("k"), F.struct(*order).alias("o"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(cols)])
    edges = sorted(b.groupBy("_b").agg(F.min(row).alias("lo"), F.max(row).alias("hi")).collect(), key=lambda r: r["_b"])
    at = {c: i for i, c in enumerate(cols)}
    rows = []
    for i, e in enumerate(edges):
        before = edges[i - 1]["hi"] if i and edges[i - 1]["hi"]["k"] == e["lo"]["k"] else None
        after = edges[i + 1]["lo"] if i + 1 < len(edges) and edges[i + 1]["lo"]["k"] == e["hi"]["k"] else None
        if before is not None or after is not None:
            rows.append((e["_b"], e["lo"]["k"] if before is not None else None, e["hi"]["k"] if after is not None else None,
                         *[before[f"v{at[v]}"] if before is not None else None for v in lags.values()],
                         *[after[f"v{at[v]}"] if after is not None else None for v in leads.values()]))
    key_type = T.StructType([T.StructField(k, b.schema[k].dataType) for k in keys])
    schema = T.StructType([T.StructField("_b", T.IntegerType()), T.StructField("_lk", key_type), T.StructField("_hk", key_type)]
                          + [T.StructField(f"_cp_{o}", b.schema[v].dataType) for o, v in lags.items()]
                          + [T.StructField(f"_cn_{o}", b.schema[v].dataType) for o, v in leads.items()])
    out = local.join(F.broadcast(spark.createDataFrame(rows, schema)), "_b", "left")
    mine = F.struct(*keys)
    for o in lags:
        out = out.withColumn(o, F.when(F.col("_first") & F.col("_lk").isNotNull() & mine.eqNullSafe(F.col("_lk")), F.col(f"_cp_{o}")).otherwise(F.col(f"_p_{o}")))
    for o in leads:
        out = out.withColumn(o, F.when(F.col("_last") & F.col("_hk").isNotNull() & mine.eqNullSafe(F.col("_hk")), F.col(f"_cn_{o}")).otherwise(F.col(f"_n_{o}")))
    out = out.select(*b.columns, *lags, *leads)
    if number:
        out = running_sum_in_buckets(out.withColumn("_one", F.lit(1)), keys, order, {number: "_one"}).drop("_one")
    return out.drop("_b")


def scan_by_key(df: DataFrame, keys: list[str], order: list[str], number: str | None = None, lags: dict[str, str] | None = None,
                sums: dict[str, str] | None = None, firsts: dict[str, str] | None = None, through: tuple[str, str] | None = None,
                buckets: int | None = None) -> DataFrame:
    """ROW_NUMBER, LAG, running SUM, FIRST_VALUE and a RANGE count per key in one pass over one layout, for skewed keys.

    ``through`` = (output, column): how many rows of the key come up to the end of the row's peers in ``column``, the first
    of ``order`` (COUNT(*) OVER (PARTITION BY keys ORDER BY column RANGE UNBOUNDED PRECEDING)). ``order`` is ascending and total
    within a key. Rows are range-partitioned on (keys, order) once (``bucketize``); each bucket finds its own values, and its
    first and last row tell what is carried into the next buckets: one collected row a bucket, broadcast."""
    lags, sums, firsts = lags or {}, sums or {}, firsts or {}
    spark = df.sparkSession
    b = bucketize(df, keys, order, buckets)
    wl = Window.partitionBy("_b", *keys).orderBy(*order)
    run = wl.rowsBetween(UNB_PREC, CUR)
    local = b.withColumn("_nr", F.row_number().over(wl).cast("bigint"))
    for o, v in lags.items():
        local = local.withColumn(f"_p_{o}", F.lag(v).over(wl))
    for o, v in sums.items():
        local = local.withColumn(f"_l_{o}", F.sum(v).over(run))
    for o, v in firsts.items():
        local = local.withColumn(f"_f_{o}", F.first(v).over(run))
    if through:
        peers = Window.partitionBy("_b", *keys).orderBy(through[1]).rangeBetween(UNB_PREC, CUR)
        local = local.withColumn("_up", F.count(F.lit(1)).over(peers))
    key, at = F.struct(*keys), F.struct(*keys, *order)
    tail = F.struct(key.alias("k"), C(order[0]).alias("peer"), C("_nr").alias("nr"), *[C(v).alias(f"v_{o}") for o, v in lags.items()],
                    *[C(f"_l_{o}").alias(f"s_{o}") for o in sums], *[C(f"_f_{o}").alias(f"f_{o}") for o in firsts])
    head = F.struct(key.alias("k"), C(order[0]).alias("peer"), *([C("_up").alias("up")] if through else []))
    stats = sorted(local.groupBy("_b").agg(F.min_by(head, at).alias("head"), F.max_by(tail, at).alias("tail"), F.count(F.lit(1)).alias("n")).collect(), key=lambda r: r["_b"])
    rows, carry = [], None
    for i, r in enumerate(stats):
        head, tail, more = r["head"], r["tail"], 0
        cont = carry if carry is not None and carry["k"] == head["k"] else None
        for later in stats[i + 1:] if through else []:
            if (later["head"]["k"], later["head"]["peer"]) != (tail["k"], tail["peer"]):
                break
            more += later["head"]["up"]
            if later["head"]["up"] != later["n"]:
                break
        rows.append((r["_b"], head["k"] if cont else None, cont["nr"] if cont else 0, *[cont[f"v_{o}"] if cont else None for o in lags],
                     *[cont[f"s_{o}"] if cont else None for o in sums], *[cont[f"f_{o}"] if cont else None for o in firsts], tail["k"], tail["peer"], more))
        same = cont is not None and tail["k"] == head["k"]  # the whole bucket goes on with the key
        carry = {"k": tail["k"], "nr": tail["nr"] + (cont["nr"] if same else 0), **{f"v_{o}": tail[f"v_{o}"] for o in lags},
                 **{f"s_{o}": (tail[f"s_{o}"] if not same or cont[f"s_{o}"] is None else cont[f"s_{o}"] if tail[f"s_{o}"] is None else tail[f"s_{o}"] + cont[f"s_{o}"]) for o in sums},
                 **{f"f_{o}": cont[f"f_{o}"] if same else tail[f"f_{o}"] for o in firsts}}
    key_type = T.StructType([T.StructField(k, b.schema[k].dataType) for k in keys])
    schema = T.StructType([T.StructField("_b", T.IntegerType()), T.StructField("_ck", key_type), T.StructField("_cn", T.LongType())]
                          + [T.StructField(f"_cv_{o}", b.schema[v].dataType) for o, v in lags.items()] + [T.StructField(f"_cs_{o}", _running_type(b.schema[v].dataType)) for o, v in sums.items()]
                          + [T.StructField(f"_cf_{o}", b.schema[v].dataType) for o, v in firsts.items()]
                          + [T.StructField("_tk", key_type), T.StructField("_tp", b.schema[order[0]].dataType), T.StructField("_more", T.LongType())])
    out = local.join(F.broadcast(spark.createDataFrame(rows, schema)), "_b")
    on = C("_ck").isNotNull() & key.eqNullSafe(C("_ck"))
    values = [C(c) for c in b.columns if c != "_b"]
    nr = F.when(on, C("_cn")).otherwise(0)
    if number:
        values.append((C("_nr") + nr).alias(number))
    values += [F.when(on & (C("_nr") == 1), C(f"_cv_{o}")).otherwise(C(f"_p_{o}")).alias(o) for o in lags]
    values += [F.when(on & C(f"_cs_{o}").isNotNull(), C(f"_cs_{o}") + F.coalesce(C(f"_l_{o}"), F.lit(0))).otherwise(C(f"_l_{o}")).cast(_running_type(b.schema[v].dataType)).alias(o) for o, v in sums.items()]
    values += [F.when(on, C(f"_cf_{o}")).otherwise(C(f"_f_{o}")).alias(o) for o in firsts]
    if through:
        values.append((C("_up") + nr + F.when(key.eqNullSafe(C("_tk")) & C(order[0]).eqNullSafe(C("_tp")), C("_more")).otherwise(0)).alias(through[0]))
    return out.select(*values)


def rank_by_key(df: DataFrame, keys: list[str], value: str, rank: str | None = "_rank", dense: str | None = None,
                descending: bool = True) -> DataFrame:
    """RANK / DENSE_RANK over (PARTITION BY keys ORDER BY value) for skewed keys: rows are counted per (key, value) first,
    the counts are summed along the values (``running_sum_by_key``) and joined back. NULLs rank last when
    descending, first when ascending, as in SQL on Spark. ``value`` is numeric."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c")).withColumn("_one", F.lit(1))
    nulls = F.col(value).isNull().cast("int")
    counts = counts.withColumn("_nl", nulls if descending else -nulls).withColumn("_o", -F.col(value) if descending else F.col(value))
    r = running_sum_by_key(counts, keys, ["_nl", "_o"], {"_run": "_c", "_d": "_one"})
    r = r.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(value).alias("_v"), (F.col("_run") - F.col("_c") + 1).alias("_rk"), "_d")
    on = F.col(value).eqNullSafe(F.col("_v"))
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    out = df.join(r, on)
    names = [(rank, "_rk"), (dense, "_d")]
    return out.select(*df.columns, *[F.col(c).alias(n) for n, c in names if n])


def ends_by_key(df: DataFrame, keys: list[str], order: list[str], firsts: dict[str, str] | None = None,
                lasts: dict[str, str] | None = None) -> DataFrame:
    """W12 / W16 FIRST_VALUE / LAST_VALUE over the full frame of a key, as grouped minima and maxima (combined map-side)
    joined back: a hot key is never gathered."""
    firsts, lasts = firsts or {}, lasts or {}
    at = F.struct(*order)
    per = df.groupBy(*keys).agg(*[F.min_by(v, at).alias(o) for o, v in firsts.items()], *[F.max_by(v, at).alias(o) for o, v in lasts.items()])
    return df.join(per, keys)
