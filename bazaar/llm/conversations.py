"""Repair of damaged conversations at least cost, by block tables.

A repaired conversation has the role initials ``(s?(ua)+)?``. That is an automaton of four states (nothing
yet, after s, after u, after a), and a row is one of nine symbols: its role's initial (s, u, a, other) with or
without a truncated text, or a row that has to go. The cheapest repair of what follows a place is a vector of
four costs, one per state. Any two of them differ by a few edits at most, so less their minimum there are few
different vectors, and a block of symbols maps each of them to another one and an added cost:

1. tables: that map for every symbol, and for every block of ``BLOCK`` symbols (composed from the symbols');
2. segments: up to ``SEGMENT`` rows of a conversation are read from the end, a block by one look-up. A
   segment is summed up by its own map: right vector to left vector and cost, and (right vector, state at the
   left) to the state at the right;
3. such maps compose, so the segments of a long conversation are folded in groups of ``FAN`` level by level,
   and the right vector and left state of every segment come back down the same levels;
4. trace: each segment's blocks are expanded backward to the vectors between rows, then its edits are taken
   from the left: of those on a cheapest path the ASCII-least. An edit and a state have one following state,
   so the edits' initials alone fix the path and the tie is settled for good.

Rows, segments and folds are spread over tasks by (conversation, place), so a conversation that holds a third
of all rows is no task's alone. Only the digest of a whole conversation reads it in one stream.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.shared import Shipped, materialise
from bazaar.operators.windows import neighbours_by_key

C = F.col
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: state after an initial, where the pattern allows it
NEXT = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
ACCEPTING = (START, AFTER_A)
#: the one initial of user and assistant that is possible in a state
WANTED = {START: "u", AFTER_S: "u", AFTER_U: "a", AFTER_A: "u"}
ROLE = {"u": "user", "a": "assistant"}
INITIALS = "sua?"  # "?" stands for any other
#: symbols 0-7: initial and whether truncated; 8: has to be deleted
MUST_GO = 8
SYMBOLS = 9
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
FAR = 1 << 20
BLOCK, SEGMENT, FAN = 4, 4096, 256


def insert_closed(v: tuple) -> tuple:
    """Costs to go when rows may be inserted here first."""
    v = list(v)
    for _ in range(4):
        for q in range(4):
            v[q] = min(v[q], INSERT_COST + v[NEXT[q, WANTED[q]]])
    return tuple(v)


def edits(symbol: int):
    """(initial of the edit, cost, state -> state or None) of what can be done with a row."""
    if symbol == MUST_GO:
        return [(DELETE, DELETE_COST, lambda q: q)]
    initial, extra = INITIALS[symbol // 2], TRUNCATED_COST * (symbol % 2)
    return [(DELETE, DELETE_COST, lambda q: q), (KEEP, extra, lambda q: NEXT.get((q, initial))), (REROLE, REROLE_COST + extra, lambda q: NEXT[q, WANTED[q]])]


def before(symbol: int, v: tuple) -> tuple:
    """Costs to go before a row from those after it (not yet closed under inserts)."""
    return tuple(min(cost + v[to(q)] for _, cost, to in edits(symbol) if to(q) is not None) for q in range(4))


class BlockTables:
    """Transitions of all normalised cost vectors by symbol and by block of symbols.

    A map is (to, cost, state): by right vector the left vector and the cost that comes on top, and by right vector
    and left state the state at the right of the cheapest, ASCII-least path."""

    def __init__(self, block: int = BLOCK):
        self.vectors, self.at, self.memo, self.block = [], {}, {}, block
        self.end, self.end_cost = self._index(insert_closed(tuple(0 if q in ACCEPTING else FAR for q in range(4))))
        step = []
        for v in self.vectors:  # grows until no symbol leads to a new vector
            step.append([self._index(insert_closed(before(s, v))) for s in range(SYMBOLS)])
        n = len(self.vectors)
        to, cost = (np.array([[t[k] for t in row] for row in step], np.int64).T for k in (0, 1))
        state = np.array([[[self.row_edits(s, q, v)[1] for q in range(4)] for v in range(n)] for s in range(SYMBOLS)], np.int64)
        self.one = to, cost, state
        for _ in range(block - 1):  # a symbol in front of shorter blocks: code = symbol * 9**rest + code of the rest
            grown = [(self.one[0][s][to], cost + self.one[1][s][to], np.take_along_axis(state, self.one[2][s][to], 2)) for s in range(SYMBOLS)]
            to, cost, state = (np.concatenate(x) for x in zip(*grown))
        self.blocks = to, cost, state

    def _index(self, v: tuple) -> tuple[int, int]:
        low = min(v)
        v = tuple(x - low for x in v)
        if v not in self.at:
            self.at[v] = len(self.vectors)
            self.vectors.append(v)
        return self.at[v], low

    def right_to_left(self, symbols: bytes):
        """(place, map) of the blocks of a segment from its right end; what makes no whole block, at the left, symbol by symbol."""
        head = len(symbols) % self.block
        for i in range(len(symbols) - self.block, head - 1, -self.block):
            code = 0
            for s in symbols[i:i + self.block]:
                code = code * SYMBOLS + s
            yield i, tuple(x[code] for x in self.blocks)
        for i in range(head - 1, -1, -1):
            yield i, tuple(x[symbols[i]] for x in self.one)

    def between(self, symbols: bytes, right: int) -> list[int]:
        """The vector before every row of a segment and after the last one: block ends by look-up, then each block
        is expanded backward."""
        out = [0] * len(symbols) + [right]
        v = right
        for i, (to, _, _) in self.right_to_left(symbols):
            v = out[i] = int(to[v])
        for i in range(len(symbols) % self.block, len(symbols), self.block):
            for j in range(i + self.block - 1, i, -1):
                out[j] = int(self.one[0][symbols[j]][out[j + 1]])
        return out

    def row_edits(self, symbol: int, q: int, after: int) -> tuple[str, int]:
        """What is done at a row in state ``q``: the ASCII-least edits of the cheapest paths, inserts before the row first.
        Two characters an edit: its initial, and the initial of the role it gives (- for none of its own)."""
        key = symbol, q, after
        if key not in self.memo:
            v = self.vectors[after]
            row, did = before(symbol, v), ""
            best = insert_closed(row)
            while not did or did[-2] == INSERT:
                found = [(INSERT, NEXT[q, WANTED[q]])] if INSERT_COST + best[NEXT[q, WANTED[q]]] == best[q] else []
                found += [(name, to(q)) for name, cost, to in edits(symbol) if to(q) is not None and cost + v[to(q)] == best[q]]
                edit, state = min(found)
                did += edit + (WANTED[q] if edit in (INSERT, REROLE) else "-")
                q = state
            self.memo[key] = did, q
        return self.memo[key]

    def trace(self, symbols: bytes, right: int, q: int) -> tuple[list[str], int]:
        """The edits at every row of a segment, and the state after it."""
        out = []
        for s, after in zip(symbols, self.between(symbols, right)[1:]):
            did, q = self.row_edits(s, q, after)
            out.append(did)
        return out, q

    def tail(self, q: int) -> str:
        """The inserts at a conversation's end."""
        return "" if q in ACCEPTING else INSERT + WANTED[q] + self.tail(NEXT[q, WANTED[q]])

    def summary(self, symbols: bytes) -> bytes:
        """A segment's map, folded from its blocks."""
        n = len(self.vectors)
        total = np.arange(n), np.zeros(n, np.int64), np.tile(np.arange(4), (n, 1))
        for _, part in self.right_to_left(symbols):
            total = self.fold(part, total)
        return self.packed(total)

    @staticmethod
    def packed(parts) -> bytes:
        return np.concatenate([x.ravel() for x in parts]).astype(np.int64).tobytes()

    def parts(self, summary: bytes):
        n, a = len(self.vectors), np.frombuffer(summary, np.int64)
        return a[:n], a[n:2 * n], a[2 * n:].reshape(n, 4)

    @staticmethod
    def fold(left, right):
        """The map of two neighbouring segments."""
        (lt, lc, ls), (rt, rc, rs) = left, right
        return lt[rt], rc + lc[rt], np.take_along_axis(rs, ls[rt], 1)

    def solve(self, summary: bytes) -> int:
        """Cost of a whole conversation."""
        to, cost, _ = self.parts(summary)
        return int(self.end_cost + cost[self.end] + self.vectors[to[self.end]][START])


# --- rows ------------------------------------------------------------------------------------------

MARK = "[^\\x20\\x09-\\x0D]"


def damage(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text) of (conv_id, turn, role, text) after the given damage: by crc32 of ``conv_id:turn`` modulo
    20 a row is dropped (0), its text emptied (1) or robbed of full stops, exclamation and question marks (2), the row
    repeated (3), or its role set to user (4). A null counts as one blank there, and as a role or text; null turns and
    ids stay null."""
    def blank(name):
        return F.coalesce(C(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    out = rows.where(kind != 0).select(C("conv_id").alias("conv"), "turn", F.when(kind == 4, "user").otherwise(blank("role")).alias("role"), text.alias("text"),
                                       F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"))
    return out.select("conv", "turn", "role", "text", F.explode("copies")).drop("col")


def with_row_ids(rows: DataFrame) -> DataFrame:
    """Written rows with a unique ``uid``, the text's ``digest`` and whether it is ``blank`` or ``cut`` (ends without a mark)."""
    last = F.regexp_extract("text", f"({MARK})[\\x20\\x09-\\x0D]*\\z", 1)
    src = rows.select("conv", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.monotonically_increasing_id().alias("uid"))
    return materialise(src.select("*", F.md5("text").alias("digest"), (~C("text").rlike(MARK)).alias("blank"), (~last.isin(".", "!", "?")).alias("cut")), "conv-rows")


def find_faults(rows: DataFrame) -> DataFrame:
    """Rows without their texts: (conv, turn, role, uid, pos, prev, fault, symbol). ``pos`` counts a conversation's rows by
    turn (nulls first; equal turns by role and digest), ``prev`` is the role initial before, ``fault`` is blank, duplicate
    (role and text were seen before), truncated or null."""
    src = rows.select("conv", "turn", "role", "digest", "uid", "blank", "cut", F.substring("role", 1, 1).alias("initial"))
    numbered = neighbours_by_key(src, ["conv"], ["turn", "role", "digest", "uid"], lags={"prev": "initial"}, number="nth").withColumn("pos", C("nth") - 1)
    numbered = materialise(numbered.drop("nth"), "conv-numbered")
    # the first of equal rows, combined before they travel, meets its own row only
    first = numbered.groupBy("conv", "role", "digest").agg(F.min("pos").alias("_p")).select(C("conv").alias("_c"), "_p")
    marked = numbered.join(first, C("conv").eqNullSafe(C("_c")) & (C("pos") == C("_p")), "left")
    fault = F.when(C("blank"), "blank").when(C("_p").isNull(), "duplicate").when(C("cut"), "truncated")
    initial = F.when(C("initial") == "s", 0).when(C("initial") == "u", 1).when(C("initial") == "a", 2).otherwise(3)
    symbol = F.when(C("blank") | C("_p").isNull(), MUST_GO).otherwise(initial * 2 + C("cut").cast("int"))
    return marked.select("conv", "turn", "role", "uid", "pos", "prev", "initial", fault.alias("fault"), symbol.cast("int").alias("symbol"))


def segments(faults: DataFrame, tables: Shipped, size: int = SEGMENT) -> DataFrame:
    """(conv, seg, symbols, map): at most ``size`` rows each."""
    packed = (faults.groupBy("conv", F.expr(f"pos div {size}").alias("seg")).agg(F.array_sort(F.collect_list(F.struct("pos", "symbol"))).alias("r"))
              .select("conv", "seg", F.transform("r", lambda x: x["symbol"]).alias("symbols")))

    def run(batches):
        t, memo = tables.load(), {}
        for batch in batches:
            symbols = [bytes(s) for s in batch.column(2).to_pylist()]
            maps = []
            for s in symbols:
                maps.append(memo.get(s) or t.summary(s))
                if len(s) < 64 and len(memo) < 10_000:
                    memo[s] = maps[-1]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(symbols, pa.binary()), pa.array(maps, pa.binary())], ["conv", "seg", "symbols", "map"])

    return packed.mapInArrow(run, _schema(faults, "seg long, symbols binary, map binary"))


def _schema(df: DataFrame, rest: str) -> str:
    return f"conv {df.schema['conv'].dataType.simpleString()}, {rest}"


def fold_levels(segs: DataFrame, tables: Shipped, fan: int = FAN) -> list[DataFrame]:
    """Levels of (conv, seg, map): the given segments first, each further level folds ``fan`` neighbours, until every
    conversation has one map."""
    levels = [segs.select("conv", "seg", "map")]

    def fold(table: pa.Table) -> pa.Table:
        t = tables.load()
        maps = [t.parts(m) for m in table.column("map").take(pa.array(np.argsort(np.asarray(table.column("seg"))))).to_pylist()]
        total = maps[-1]
        for m in maps[-2::-1]:
            total = t.fold(m, total)
        return pa.table({"conv": table.column("conv").slice(0, 1), "seg": table.column("up").slice(0, 1), "map": pa.array([t.packed(total)], pa.binary())})

    while not levels[-1].where(C("seg") > 0).isEmpty():
        children = levels[-1].withColumn("up", F.expr(f"seg div {fan}"))
        levels.append(materialise(children.groupBy("conv", "up").applyInArrow(fold, _schema(segs, "seg long, map binary")), "conv-level"))
    return levels


def place_segments(levels: list[DataFrame], tables: Shipped, fan: int = FAN) -> DataFrame:
    """(conv, seg, right, state) of the lowest level: the cost vector after a segment and the state before it."""
    placed = levels[-1].select("conv", "seg", F.lit(tables.load().end).cast("long").alias("right"), F.lit(START).cast("long").alias("state"))

    def spread(table: pa.Table) -> pa.Table:
        t = tables.load()
        order = pa.array(np.argsort(np.asarray(table.column("seg"))))
        maps = [t.parts(m) for m in table.column("map").take(order).to_pylist()]
        right, state = [table.column("right")[0].as_py()], [table.column("state")[0].as_py()]
        for to, _, _ in maps[:0:-1]:
            right.append(int(to[right[-1]]))
        right.reverse()
        for (_, _, states), v in zip(maps[:-1], right):
            state.append(int(states[v, state[-1]]))
        return pa.table({"conv": table.column("conv"), "seg": table.column("seg").take(order), "right": pa.array(right, pa.int64()), "state": pa.array(state, pa.int64())})

    for children in levels[-2::-1]:
        above = placed.select(C("conv").alias("_c"), C("seg").alias("_u"), "right", "state")
        both = children.withColumn("up", F.expr(f"seg div {fan}")).join(above, C("conv").eqNullSafe(C("_c")) & (C("up") == C("_u"))).drop("_c", "_u")
        placed = materialise(both.groupBy("conv", "up").applyInArrow(spread, _schema(children, "seg long, right long, state long")), "conv-places")
    return placed


def trace_segments(segs: DataFrame, placed: DataFrame, tops: DataFrame, tables: Shipped) -> DataFrame:
    """(conv, seg, did, tail, cost): the edits at every row of a segment (``BlockTables.row_edits``); with the last segment
    of a conversation the inserts at its end, with the first the cost of the whole conversation."""
    last = segs.groupBy("conv").agg(F.max("seg").alias("last")).select(C("conv").alias("_l"), "last")
    src = segs.select("conv", "seg", "symbols")
    src = src.join(placed.select(C("conv").alias("_p"), C("seg").alias("_s"), "right", "state"), C("conv").eqNullSafe(C("_p")) & (C("seg") == C("_s")))
    src = src.join(last, C("conv").eqNullSafe(C("_l")))
    src = src.join(tops.select(C("conv").alias("_t"), C("map").alias("top")), C("conv").eqNullSafe(C("_t")) & (C("seg") == 0), "left")
    src = src.select("conv", "seg", "symbols", "right", "state", "top", (C("seg") == C("last")).alias("is_last"))

    def run(batches):
        t = tables.load()
        for batch in batches:
            did, tails, costs = [], [], []
            for s, v, q, top, is_last in zip(*[batch.column(i).to_pylist() for i in range(2, 7)]):
                steps, q = t.trace(s, v, q)
                did.append(steps)
                tails.append(t.tail(q) if is_last else "")
                costs.append(None if top is None else t.solve(top))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(did, pa.list_(pa.string())), pa.array(tails, pa.string()), pa.array(costs, pa.int64())],
                                             ["conv", "seg", "did", "tail", "cost"])

    return src.mapInArrow(run, _schema(segs, "seg long, did array<string>, tail string, cost long"))


def repair(rows: DataFrame, segment: int = SEGMENT, fan: int = FAN, block: int = BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Repair conversations given as (conv, turn, role, text): (faults, edits, repaired).

    ``faults``: as ``find_faults``. ``edits``: as ``trace_segments``. ``repaired``: (conv, pos, part, role, text), the repaired
    conversations in the order of (pos, part): kept rows, rows with a new role, and inserted ones with an empty text (before
    row ``pos``, or after the last one).

    A null role or text counts as one blank, null turns come first, and a null id is a conversation like others. Equal turns are
    ordered by role and the text's digest; equal rows stay equal in any order. Repeated rows are duplicates. An empty table
    gives empty ones. Texts of any length are only moved, never gathered. Other columns of ``rows`` are not read."""
    tables = Shipped(rows.sparkSession, BlockTables(block))
    kept = with_row_ids(rows)
    faults = materialise(find_faults(kept), "conv-faults")
    segs = materialise(segments(faults, tables, segment), "conv-segments")
    levels = fold_levels(segs, tables, fan)
    edits = materialise(trace_segments(segs, place_segments(levels, tables, fan), levels[-1], tables), "conv-edits")
    did = edits.select(C("conv").alias("_c"), "seg", F.posexplode("did")).select("_c", (C("seg") * segment + C("pos")).alias("_p"), C("col").alias("did"))
    did = did.where(C("did") != DELETE + "-")
    at = faults.select("conv", "pos", "uid").join(did, C("conv").eqNullSafe(C("_c")) & (C("pos") == C("_p"))).select("conv", "pos", "uid", "did")
    ends = edits.where(C("tail") != "").select("conv", F.lit((1 << 63) - 1).alias("pos"), F.lit(None).cast("long").alias("uid"), C("tail").alias("did"))
    parts = at.unionByName(ends).select("conv", "pos", "uid", F.posexplode(F.regexp_extract_all("did", F.lit("(..)"), F.lit(1))).alias("part", "edit"))
    parts = parts.where(~C("edit").startswith(DELETE)).withColumn("own", F.when(~C("edit").startswith(INSERT), C("uid")))
    both = parts.join(kept.select(C("uid").alias("_u"), "role", "text"), C("own") == C("_u"), "left")
    new_role = F.when(C("edit").endswith("u"), ROLE["u"]).when(C("edit").endswith("a"), ROLE["a"]).otherwise(C("role"))
    return faults, edits, both.select("conv", "pos", "part", new_role.alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def audits(edits: DataFrame) -> DataFrame:
    """(conv, audit, cost): the edits' initials in order. The text of a conversation's audit is one value, as asked for."""
    own = F.regexp_replace(F.concat(F.array_join("did", ""), C("tail")), "(.).", "$1")
    per = edits.select("conv", "seg", own.alias("a"), "cost").groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("seg", "a"))).alias("r"), F.max("cost").alias("cost"))
    return per.select("conv", F.array_join(F.transform("r", lambda x: x["a"]), "").alias("audit"), "cost")


def digests(repaired: DataFrame) -> DataFrame:
    """(conv, sha): sha256 of the repaired ``role:text`` lines of every conversation that has any. One task reads a conversation
    in one stream and holds a batch of it: sha256 cannot be split."""
    src = repaired.repartition("conv").sortWithinPartitions("conv", "pos", "part").select("conv", F.concat_ws(":", "role", "text").alias("line"))

    def run(batches):
        now, none = None, object()
        conv = none
        for batch in batches:
            names, shas = [], []
            for c, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if conv is none or c != conv:
                    if conv is not none:
                        names.append(conv)
                        shas.append(now.hexdigest())
                    conv, now = c, hashlib.sha256(line.encode())
                else:
                    now.update(b"\n" + line.encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, batch.schema.types[0]), pa.array(shas, pa.string())], ["conv", "sha"])
        if conv is not none:
            yield pa.RecordBatch.from_arrays([pa.array([conv], batch.schema.types[0]), pa.array([now.hexdigest()], pa.string())], ["conv", "sha"])

    return src.mapInArrow(run, _schema(repaired, "sha string"))


def report(conversations: DataFrame) -> DataFrame:
    """One row per conv_id of the table given: faults of the damaged rows, cost, audit and digest of the repair."""
    faults, edits, repaired = repair(damage(conversations))

    def count(cond):
        return F.count(F.when(cond, 1))
    illegal = (C("pos") > 0) & ~F.concat("prev", "initial").isin("su", "ua", "au")
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0))
    per = faults.groupBy("conv").agg(gaps.alias("gaps"), *[count(C("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")], count(illegal).alias("illegal"))
    out = conversations.select(C("conv_id").alias("conv")).distinct()
    for n, part in enumerate((per, audits(edits), digests(repaired))):
        out = out.join(part.withColumnRenamed("conv", f"_c{n}"), C("conv").eqNullSafe(C(f"_c{n}")), "left").drop(f"_c{n}")
    numbers = [F.coalesce(C(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(C("conv").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def report_oracle() -> str:
    """DuckDB SQL of ``report``: from the last row of each conversation to the first, the least (cost, edits, lines) of
    what follows for each of the four states, edits compared as text; no tables and no tracing."""
    def least(*options):
        return f"list_min([{', '.join(options)}])"

    def put(cost, edit, line, state):
        head = f"list_prepend({line}, {state}.t)" if line else f"{state}.t"
        return f"{{'c': {cost} + {state}.c, 'a': '{edit}' || {state}.a, 't': {head}}}"
    user, assistant = "'user:'", "'assistant:'"
    own, as_user, as_assistant = "role || ':' || text", "'user:' || text", "'assistant:' || text"
    rows = []
    for q, keeps, new, target in (("q0", [("s", "q1"), ("u", "q2")], as_user, "q2"), ("q1", [("u", "q2")], as_user, "q2"), ("q2", [("a", "q3")], as_assistant, "q3"), ("q3", [("u", "q2")], as_user, "q2")):
        kept = " ".join(f"WHEN ini = '{i}' THEN " + least(put(3, "D", "", q), put("cut", "K", own, to), put("2 + cut", "R", new, target)) for i, to in keeps)
        rows.append(f"CASE WHEN gone THEN {put(3, 'D', '', q)} {kept} ELSE {least(put(3, 'D', '', q), put('2 + cut', 'R', new, target))} END AS r{q[1]}")
    closed = {"q0": least("r0", put(2, "I", user, "r2"), put(4, "II", "'assistant:'", "r3").replace("list_prepend('assistant:', r3.t)", "list_prepend('user:', list_prepend('assistant:', r3.t))")),
              "q1": least("r1", put(2, "I", user, "r2"), put(4, "II", "'assistant:'", "r3").replace("list_prepend('assistant:', r3.t)", "list_prepend('user:', list_prepend('assistant:', r3.t))")),
              "q2": least("r2", put(2, "I", assistant, "r3")), "q3": least("r3", put(2, "I", user, "r2"))}
    start = "{'c': 0, 'a': '', 't': []::VARCHAR[]}", "{'c': 4, 'a': 'II', 't': ['user:', 'assistant:']}", "{'c': 2, 'a': 'I', 't': ['assistant:']}", "{'c': 0, 'a': '', 't': []::VARCHAR[]}"
    mark = r"[^\x20\x09-\x0D]"
    return rf"""
WITH RECURSIVE crc AS (SELECT n AS i, list_reduce(list_prepend(n, range(8)), lambda c, x: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) AS v FROM range(256) t(n)),
crcs AS (SELECT list(v ORDER BY i) AS tab FROM crc),
raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
hit AS (SELECT raw.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''), lambda ch: ascii(ch)::BIGINT)),
  lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS d FROM raw, crcs),
damaged AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role, CASE WHEN d = 1 THEN '' WHEN d = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hit, range(2) x(copy) WHERE d <> 0 AND (copy = 0 OR d = 3)),
numbered AS (SELECT *, row_number() OVER w AS n, lag(left(role, 1)) OVER w AS prev
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text))),
faulty AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) AS same, NOT regexp_matches(text, '{mark}') AS blank, regexp_extract(text, '({mark})[\x20\x09-\x0D]*\z', 1) NOT IN ('.', '!', '?') AS unended FROM numbered),
rows AS (SELECT *, blank OR same > 1 AS gone, (NOT blank AND same = 1 AND unended)::INTEGER AS cut, left(role, 1) AS ini FROM faulty),
walk AS (SELECT conv_id, max(n) AS n, {start[0]} AS q0, {start[1]} AS q1, {start[2]} AS q2, {start[3]} AS q3 FROM rows GROUP BY conv_id
  UNION ALL SELECT conv_id, n - 1, {', '.join(closed[q] + ' AS ' + q for q in closed)} FROM
    (SELECT walk.conv_id, walk.n, {', '.join(rows)} FROM walk JOIN rows ON rows.conv_id IS NOT DISTINCT FROM walk.conv_id AND rows.n = walk.n) b),
solved AS (SELECT conv_id, q0 FROM walk WHERE n = 0),
facts AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, sum(blank::INTEGER) AS blank, sum((NOT blank AND same > 1)::INTEGER) AS duplicate, sum(cut) AS truncated,
  sum((n > 1 AND prev || ini NOT IN ('su', 'ua', 'au'))::INTEGER) AS illegal FROM rows GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(q0.c, 0)::BIGINT AS cost, coalesce(q0.a, '') AS audit, sha256(coalesce(array_to_string(q0.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN solved s ON s.conv_id IS NOT DISTINCT FROM c.conv_id"""
