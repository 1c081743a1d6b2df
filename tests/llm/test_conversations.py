"""Conversation repair: block tables against a search over all edits, whole reports against SQL."""
import heapq
import random

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.llm import conversations as cv

CONV = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
PARTS = {"s": "system", "u": "user", "a": "assistant", "?": "tool"}


def search(symbols):
    """Least (cost, edits) by Dijkstra over (row, state), edits carried along."""
    heap, done = [(0, "", 0, 0)], set()
    best = None
    while heap:
        cost, did, i, q = heapq.heappop(heap)
        if best and (cost, did) >= best:
            continue
        if i == len(symbols) and q in cv.ACCEPTING:
            best = min(best, (cost, did)) if best else (cost, did)
        if cost > 3 * len(symbols):
            continue
        if did.count("I") < len(symbols) + 2:
            heapq.heappush(heap, (cost + 2, did + "I", i, cv.NEXT[q, cv.WANTED[q]]))
        if i < len(symbols):
            s = symbols[i]
            heapq.heappush(heap, (cost + 3, did + "D", i + 1, q))
            if s != cv.MUST_GO:
                if (q, "sua?"[s // 2]) in cv.NEXT:
                    heapq.heappush(heap, (cost + s % 2, did + "K", i + 1, cv.NEXT[q, "sua?"[s // 2]]))
                heapq.heappush(heap, (cost + 2 + s % 2, did + "R", i + 1, cv.NEXT[q, cv.WANTED[q]]))
    return best


@pytest.mark.parametrize("block", [1, 2, 4])
def test_tables_against_search(block):
    rng = random.Random(block)
    t = cv.BlockTables(block)
    for _ in range(150):
        symbols = bytes(rng.choice([0, 2, 3, 4, 5, 6, 8]) for _ in range(rng.randint(0, 6)))
        did, q = t.trace(symbols, t.end, cv.START)
        edits = ("".join(did) + t.tail(q))[::2]
        assert (t.solve(t.summary(symbols)), edits) == search(symbols), symbols


def test_maps_compose():
    rng = random.Random(9)
    t = cv.BlockTables(3)
    for _ in range(60):
        a, b = (bytes(rng.randrange(9) for _ in range(rng.randint(1, 20))) for _ in range(2))
        assert t.packed(t.fold(t.parts(t.summary(a)), t.parts(t.summary(b)))) == t.summary(a + b)
    assert len(t.vectors) < 100


def rows(seed, convs, longest):
    rng = random.Random(seed)
    out = []
    for c in range(convs):
        for turn in range(rng.randint(1, longest)):
            text = rng.choice(["Well then.", "So it is!", "no end", "Who?", "", "  \n", None, "x" * rng.randint(1, 30) + "."])
            out.append((c, rng.choice([turn, turn, turn, None, turn + 2]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), text))
    return out + [out[0], out[0], (None, 1, "user", "Lost."), (None, None, "assistant", "Found.")]


def against_sql(spark, data):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if data:
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", data)
    want = con.execute(cv.report_oracle())
    names = [d[0] for d in want.description]
    got = cv.report(spark.createDataFrame(data, CONV).repartition(3))
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(str, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(str, want.fetchall()))


def test_report_against_sql(spark):
    against_sql(spark, rows(5, 40, 14))


def test_empty(spark):
    against_sql(spark, [])


def test_long_conversation_in_segments(spark):
    """One conversation with over a third of the rows, in many segments and folded on several levels, with a long text."""
    rng = random.Random(2)
    data = [(7, i, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", f"No {i}!", f"cut {i}"])) for i in range(400)]
    data += [(c, i, "user", f"T {i}.") for c in range(100, 200) for i in range(3)] + [(8, 0, "user", "long " * 1_000_000 + ".")]
    src = spark.createDataFrame(data, CONV).withColumnRenamed("conv_id", "conv").withColumn("pos", F.lit("clash")).withColumn("uid", F.lit("clash"))
    many, one = cv.repair(src, segment=8, fan=3), cv.repair(src)
    assert many[1].count() > 100 + 49
    a, b = ({r["conv"]: (r["audit"], r["cost"]) for r in cv.audits(x[1]).collect()} for x in (many, one))
    assert a == b and len(a) == 102
    c, d = ({r["conv"]: r["sha"] for r in cv.digests(x[2]).collect()} for x in (many, one))
    assert c == d
    initials = "".join(r["role"][0] for r in one[2].where("conv = 7").orderBy("pos", "part").collect())
    assert initials.lstrip("s").replace("ua", "") == ""
