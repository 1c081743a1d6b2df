"""All-or-nothing allocation of shared capacities to ordered requests (R4, R9, R2 usage caps).

The reference places one request at a time: request k is accepted iff every resource it needs
still has enough capacity after the requests accepted before it; a rejected request consumes
nothing. That is a sequential fold. Here it is computed exactly, set-wise, as a fixpoint of
bounds on what earlier requests consume of a resource:

* lower bound: what earlier **accepted** requests took, less what pending ones may still bring in;
* upper bound: the same plus what earlier **pending** requests may still take.

A pending request is accepted when the upper bound plus its own need fits all its resources, rejected
when the lower bound plus its need does not fit one of them, otherwise it stays pending. Within a round,
requests already certain to fail somewhere are dropped from everyone's upper bound before deciding. The
earliest pending request always has equal bounds, so every round decides at least one request.

Bounds alone would take a round a request where each outcome hangs on the one before it. So from the second round
on, a round also decides a **prefix** of the pending requests, in order, one after the other: all before them is
settled, so their resources' state is known and the outcome exact. The prefix starts at ``PREFIX`` requests, doubles
round by round and stops growing at ``MAX_PREFIX``, so the one task that folds it is bounded. (Deciding in order is
sequential by nature, so no number of rounds that only grows with the logarithm can be promised; a chain of n
requests takes about n / ``MAX_PREFIX`` rounds, and all that hangs on the prefix is settled by the bounds.)

A demand with a negative quantity supplies the resource if its request is accepted (the receiving side of
a transfer). Running sums per resource are split over range buckets (hot resources span many of them);
the buckets and their edges are fixed once, each round's state is checkpointed to the shared folder, and
resources without pending requests leave the rounds.

Where requests of different values of a column never share a resource (transfers of different variants), each value's
requests are decided in order by one pass over the sorted rows, all values side by side, without rounds; a value with more
than ``MAX_PREFIX`` demands takes the rounds, so no task folds more than that for one value.

Where the caller says that demands only take, a request that asks for more of a resource than there ever is leaves at once: its
rejection is certain, and only its demands of earlier levels stay, to find the reason. They count in nobody's bounds.

Demands carry a ``level``: levels are checked in order (e.g. 0 = discount usage, 1 = stock), the
rejection reason is the first failing level, exactly like checks that run one after another.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.operators.windows import bucket_edges, bucketize, running_sum_by_key, running_sum_in_buckets
from bazaar.session import ensure_checkpoint_dir

C = F.col
PENDING, ACCEPTED, REJECTED = "PENDING", "ACCEPTED", "REJECTED"
#: requests of a round's prefix: at first, and at most (a task of a few seconds and some tens of MB)
PREFIX, MAX_PREFIX = 1 << 11, 1 << 16


def _fold_prefix(pending: DataFrame, order: list[str], size: int, reasons: dict[int, str]) -> DataFrame:
    """(RequestID, _first, _reason) of the first ``size`` pending requests, decided one after the other. ``pending`` has the
    net accepted demand before each row in ``_acc`` and the level at which the request certainly fails in ``_bad``."""
    first = pending.select(*order).distinct().orderBy(*order).limit(size)
    match = [C(o).eqNullSafe(C(f"_o_{o}")) for o in order]
    rows = pending.join(first.select(*[C(o).alias(f"_o_{o}") for o in order]), reduce(lambda a, b: a & b, match), "left_semi")
    rows = rows.select(*order, "level", "resource", "qty", "_acc", "capacity", F.coalesce("_bad", F.lit(-1)).alias("_bad")).repartition(1).sortWithinPartitions(*order, "level")
    names = {lv: why for lv, why in reasons.items()}

    def fold(batches):
        taken, current, lines = {}, None, []

        def decide():
            why = next((lv for lv, res, qty, acc, cap, _ in lines if qty > 0 and acc + taken.get(res, 0) + qty > cap), None)
            if why is None and lines[0][-1] >= 0:
                why = lines[0][-1]
            if why is None:
                for _, res, qty, _, _, _ in lines:
                    taken[res] = taken.get(res, 0) + qty
            return current, REJECTED if why is not None else ACCEPTED, names.get(why)

        at = order.index("RequestID")
        for batch in batches:
            out = []
            for row in zip(*[batch[c].tolist() for c in batch.columns]):
                if lines and row[at] != current:
                    out.append(decide())
                    lines = []
                current = row[at]
                lines.append(row[len(order):])
            yield pd.DataFrame(out, columns=["RequestID", "_first", "_reason"])
        if lines:
            yield pd.DataFrame([decide()], columns=["RequestID", "_first", "_reason"])

    kind = pending.schema["RequestID"].dataType.simpleString()
    return rows.mapInPandas(fold, f"RequestID {kind}, _first string, _reason string")


def _fold_apart(d: DataFrame, apart: str, order: list[str], reasons: dict[int, str]) -> DataFrame:
    """``d`` with status, reason, consumed_before and _head (first row of its request): each value of ``apart`` is decided on
    its own, its requests one after the other. A task keeps one value's state and one batch of rows."""
    parts = int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = d.repartition(parts, apart).sortWithinPartitions(apart, *order, "level")
    at = [d.columns.index(c) for c in (apart, "RequestID", "level", "resource", "qty", "capacity")]
    names = [*d.columns, "status", "reason", "consumed_before", "_head"]

    def fold(batches):
        now, taken, rest = None, {}, None

        def decide(t):
            nonlocal now, taken
            group, ids, level, resource, qty, capacity = (t.column(i).to_pylist() for i in at)
            status, reason, before, head = [], [], [], []
            i, n = 0, len(ids)
            while i < n:
                j = i + 1
                while j < n and ids[j] == ids[i] and group[j] == group[i]:
                    j += 1
                if not taken or group[i] != now:
                    now, taken = group[i], {}
                mine = range(i, j)
                acc = [taken.get(resource[k], 0) for k in mine]
                why = next((level[k] for k, a in zip(mine, acc) if qty[k] > 0 and a + qty[k] > capacity[k]), None)
                if why is None:
                    for k in mine:
                        taken[resource[k]] = taken.get(resource[k], 0) + qty[k]
                status += [ACCEPTED if why is None else REJECTED] * (j - i)
                reason += [reasons.get(why)] * (j - i)
                before += acc
                head += [True] + [False] * (j - i - 1)
                i = j
            added = [pa.array(status, pa.string()), pa.array(reason, pa.string()), pa.array(before, pa.int64()), pa.array(head, pa.bool_())]
            return pa.Table.from_arrays([*t.columns, *added], names).combine_chunks().to_batches()

        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([rest, t]) if rest is not None else t
            ids = t.column(at[1]).to_pylist()
            cut = len(ids)
            while cut and ids[cut - 1] == ids[-1]:  # the last request may go on in the next batch
                cut -= 1
            rest = t.slice(cut)
            if cut:
                yield from decide(t.slice(0, cut))
        if rest is not None and rest.num_rows:
            yield from decide(rest)

    more = "status string, reason string, consumed_before long, _head boolean"
    fields = [T.StructField(f.name, f.dataType, True) for f in d.schema.fields]
    return rows.mapInArrow(fold, T.StructType(fields + T._parse_datatype_string(more).fields))


def _decide(per: DataFrame, reasons: dict[int, str]) -> DataFrame:
    """(RequestID, _new, _why) from (RequestID, level, pass, fail, _bad): the first surely failing level rejects (``_bad`` fails
    for sure), any unsure level before it defers."""
    levels = sorted(reasons)
    folded = per.groupBy("RequestID").agg(
        *[F.max(F.when(C("level") == lv, C("pass")).when(C("_bad") == lv, 0)).alias(f"p{lv}") for lv in levels],
        *[F.max(F.when(C("level") == lv, C("fail")).when(C("_bad") == lv, 1)).alias(f"f{lv}") for lv in levels])
    decision = reason = None
    before = F.lit(True)
    for lv in levels:
        rejected = before & (F.coalesce(C(f"f{lv}"), F.lit(0)) == 1)
        decision = F.when(rejected, REJECTED) if decision is None else decision.when(rejected, REJECTED)
        reason = F.when(rejected, reasons[lv]) if reason is None else reason.when(rejected, reasons[lv])
        before = before & (F.coalesce(C(f"p{lv}"), F.lit(1)) == 1)
    return folded.select("RequestID", decision.when(before, ACCEPTED).otherwise(PENDING).alias("_new"), reason.alias("_why"))


def _summed(demands: DataFrame, order: list[str], *kept: str) -> DataFrame:
    # dealt by request before they are summed: rarely do two rows fall together, so a scan's task had kept all of its own
    return demands.repartition("RequestID").groupBy("RequestID", *[o for o in order if o != "RequestID"], *kept, "level", "resource").agg(F.sum("qty").alias("qty"))


def _certain(d: DataFrame, reasons: dict[int, str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(decisions, rows left) of demands that only take. A request with a demand above the whole capacity is rejected, at the
    first such level (``_bad``) or an earlier one. Without earlier levels it is decided here; else these stay."""
    w = Window.partitionBy("RequestID").orderBy("level", "resource")
    over = F.when(C("qty") > C("capacity"), C("level"))
    d = (d.withColumn("_head", F.row_number().over(w) == 1)
         .withColumn("_bad", F.min(over).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    d = d.filter(C("_bad").isNull() | (C("level") < C("_bad")) | C("_head")).checkpoint(eager=True)
    here = C("_bad").isNotNull() & (C("level") >= C("_bad"))
    why = F.element_at(F.create_map(*[F.lit(x) for pair in sorted(reasons.items()) for x in pair]), C("_bad"))
    return d.filter(here).select("RequestID", F.lit(REJECTED).alias("status"), why.alias("reason")), d.filter(~here).drop("_head")


def _with_capacity(demands: DataFrame, capacities: DataFrame) -> DataFrame:
    return (demands.join(capacities, "resource", "left")
            .withColumn("capacity", F.coalesce(C("capacity"), F.lit(0)).cast("bigint"))
            .withColumn("qty", C("qty").cast("bigint")))


def _allocate_apart(demands, capacities, reasons, order, apart, **how) -> tuple[DataFrame, DataFrame]:
    large = demands.groupBy(apart).count().filter(C("count") > MAX_PREFIX).select(apart).checkpoint(eager=True)
    final = _fold_apart(_with_capacity(_summed(demands.join(large, apart, "left_anti"), order, apart), capacities), apart, order, reasons).checkpoint(eager=True)
    status, final = final.filter("_head").select("RequestID", "status", "reason"), final.drop("_head", "reason")
    if not large.isEmpty():
        hot = demands.join(large, apart, "left_semi")
        more, rest = allocate(hot, capacities, reasons, tuple(order), **how)
        status = status.unionByName(more)
        final = final.unionByName(rest.join(hot.select("RequestID", apart).distinct(), "RequestID").select(*final.columns))
    return status, final


def allocate(demands: DataFrame, capacities: DataFrame, reasons: dict[int, str],
             order: tuple[str, ...] = ("RequestedAt", "RequestID"), max_rounds: int = 10_000,
             plain_windows: bool = False, rounds: list | None = None, apart: str | None = None,
             takes: bool = False) -> tuple[DataFrame, DataFrame]:
    """``demands``: (RequestID, *order, level, resource, qty), qty < 0 supplies; ``capacities``: (resource,
    capacity). Resources without a capacity row have capacity 0. Returns (decisions, final demands):
    decisions = (RequestID, status, reason); final demands add ``consumed_before`` (net accepted demand on the
    resource before this request) for ledger building. Raises if ``max_rounds`` do not decide all. ``rounds`` collects
    the number of requests still pending after every round. ``apart``: a column of ``demands`` of which every request has one
    value, such that requests of different values share no resource; it stays in the final demands. ``takes``: every demand takes (qty
    > 0) and is the only one of its request on its level and resource; the final demands are then those of accepted requests."""
    ensure_checkpoint_dir(demands.sparkSession)
    order = list(dict.fromkeys(order))
    if apart is not None:
        return _allocate_apart(demands, capacities, reasons, order, apart, max_rounds=max_rounds, plain_windows=plain_windows, rounds=rounds)
    # one row per (request, resource): repeated lines of the same variant are one demand
    d = _with_capacity(demands if takes else _summed(demands, order), capacities)
    decided = []
    if takes:
        sure, d = _certain(d, reasons, order)
        decided.append(sure)
    else:
        d = d.withColumn("_bad", F.lit(None).cast("int"))
    # materialise the demands once, range-bucketed by (resource, order): every round reuses them
    d = d.checkpoint(eager=True) if plain_windows else bucketize(d, ["resource"], order)
    edges = None if plain_windows else bucket_edges(d, ["resource"])

    def running(df: DataFrame, sums: dict[str, str]) -> DataFrame:
        return (running_sum_by_key(df, ["resource"], order, sums, plain=True) if plain_windows
                else running_sum_in_buckets(df, ["resource"], order, sums, edges))

    keep = [*d.columns, "status"]
    active = d.withColumn("status", F.lit(PENDING))
    for turn in range(max_rounds):
        pending = C("status") == PENDING
        cur = active.withColumn("_taken", F.when(pending, 0).otherwise(C("qty"))).withColumn("_brought", F.when(pending & (C("qty") < 0), C("qty")).otherwise(0))
        cur = running(cur, {"_acc": "_taken", "_in": "_brought"}).checkpoint(eager=True)
        needs = pending & (C("qty") > 0)
        # certain to be rejected, whatever the reason: it no longer counts in anyone's upper bound
        doomed = cur.filter(needs & (C("_acc") + C("_in") + C("qty") > C("capacity"))).select("RequestID").distinct().withColumn("_doomed", F.lit(True))
        cur = cur.join(doomed, "RequestID", "left").withColumn("_doomed", F.coalesce("_doomed", F.when(C("_bad").isNotNull(), F.lit(True))))
        cur = cur.withColumn("_wanted", F.when(needs & C("_doomed").isNull(), C("qty")).otherwise(0))
        cur = running(cur, {"_out": "_wanted"})
        upper = C("_acc") + C("_out") + F.when(C("_doomed").isNotNull(), C("qty")).otherwise(0)
        per = cur.filter(pending).groupBy("RequestID", "level").agg(
            F.min(F.when((C("qty") <= 0) | (upper <= C("capacity")), 1).otherwise(0)).alias("pass"),
            F.max(F.when((C("qty") > 0) & (C("_acc") + C("_in") + C("qty") > C("capacity")), 1).otherwise(0)).alias("fail"), F.max("_bad").alias("_bad"))
        new = _decide(per, reasons)
        if turn:
            # the earliest pending requests, in order: exact, so it agrees with the bounds where both decide
            prefix = _fold_prefix(cur.filter(pending), order, min(MAX_PREFIX, PREFIX << (turn - 1)), reasons)
            new = new.join(prefix, "RequestID", "left").select("RequestID", F.coalesce("_first", "_new").alias("_new"), F.when(C("_first").isNotNull(), C("_reason")).otherwise(C("_why")).alias("_why"))
        new = new.checkpoint(eager=True)
        decided.append(new.filter(C("_new") != PENDING).select("RequestID", C("_new").alias("status"), C("_why").alias("reason")))
        left = new.filter(C("_new") == PENDING).count()
        if rounds is not None:
            rounds.append(left)
        if not left:
            break
        active = active.join(new, "RequestID", "left").withColumn("status", F.coalesce("_new", "status")).filter(C("status") != REJECTED)
        still = active.filter(C("status") == PENDING).select("resource").distinct()
        active = active.select(*keep).join(still, "resource", "left_semi").checkpoint(eager=True)
    else:
        raise RuntimeError("allocation did not converge")
    status = reduce(DataFrame.unionByName, decided)
    d = d.drop("_bad")
    final = d.join(status.filter(C("status") == ACCEPTED) if takes else status, "RequestID").withColumn("_acc_q", F.when(C("status") == ACCEPTED, C("qty")).otherwise(F.lit(0)))
    final = running(final, {"_acc_run": "_acc_q"})
    return status, final.withColumn("consumed_before", C("_acc_run") - C("_acc_q")).drop("_acc_q", "_acc_run", "_b")
