"""The set-based allocation fixpoint equals one-at-a-time processing (R4 / R9 / usage caps)."""

import datetime as dt
import random

import pytest

from bazaar.operators.allocation import ACCEPTED, REJECTED, allocate



def sequential_reference(requests: list[dict], capacities: dict, reasons: dict[int, str]) -> dict:
    """The one-at-a-time semantics, in plain Python.
    requests: [{"id", "key": sortable, "demands": [(level, resource, qty), ...]}]; qty < 0 supplies."""
    cap = dict(capacities)
    out = {}
    for r in sorted(requests, key=lambda x: x["key"]):
        decided = None
        for lv in sorted(reasons):
            need = {}
            for level, res, q in r["demands"]:
                if level == lv:
                    need[res] = need.get(res, 0) + q
            if any(q > 0 and cap.get(res, 0) < q for res, q in need.items()):
                decided = (REJECTED, reasons[lv])
                break
        if decided is None:
            for _, res, q in r["demands"]:
                cap[res] = cap.get(res, 0) - q
            decided = (ACCEPTED, None)
        out[r["id"]] = decided
    return out


REASONS = {0: "INVALID_DISCOUNT", 1: "INSUFFICIENT_STOCK"}


def _fixture(seed, n_req=300, hot=True):
    random.seed(seed)
    caps = {f"S:{v}": random.randint(0, 30) for v in range(25)}
    caps.update({f"D:{d}": random.randint(0, 15) for d in range(4)})
    base = dt.datetime(2024, 1, 1)
    reqs = []
    for i in range(n_req):
        dem = []
        for _ in range(random.randint(1, 4)):
            v = 0 if (hot and random.random() < 0.35) else random.randint(0, 29)  # v ≥ 25: no stock row
            dem.append((1, f"S:{v}", random.randint(1, 8)))
        if random.random() < 0.4:
            dem.append((0, f"D:{random.randint(0, 4)}", 1))  # D:4 has no capacity row
        t = base + dt.timedelta(minutes=random.randint(0, 200))
        reqs.append({"id": i, "key": (t, i), "t": t, "demands": dem})
    return reqs, caps


@pytest.mark.parametrize("seed,plain", [(1, False), (2, True), (3, False), (4, False)])
def test_allocation_matches_sequential(spark, seed, plain):
    reqs, caps = _fixture(seed)
    rows = [(r["id"], r["t"], lv, res, q) for r in reqs for lv, res, q in r["demands"]]
    demands = spark.createDataFrame(rows, "RequestID long, RequestedAt timestamp_ntz, level int, resource string, qty long")
    capacities = spark.createDataFrame(list(caps.items()), "resource string, capacity long")
    status, final = allocate(demands, capacities, REASONS, plain_windows=plain)
    got = {r.RequestID: (r.status, r.reason) for r in status.collect()}
    assert got == sequential_reference(reqs, caps, REASONS)
    # accepted demand never exceeds capacity, and ledger offsets are consistent
    for r in final.filter("status = 'ACCEPTED'").collect():
        assert r.consumed_before + r.qty <= r.capacity


@pytest.mark.parametrize("seed", [11, 12])
def test_transfers_both_ways_match_sequential(spark, seed):
    """What a request brings in can be taken by a later one of the same batch."""
    rng = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    caps = {f"W{w}:{v}": rng.randint(0, 12) for w in range(3) for v in range(4)}
    reqs = []
    for i in range(160):
        v, (a, b) = rng.randint(0, 3), rng.sample(range(4), 2)  # W3 has no rows at first
        q = rng.randint(1, 9)
        t = base + dt.timedelta(minutes=rng.randint(0, 90))
        reqs.append({"id": i, "key": (t, i), "t": t, "demands": [(0, f"W{a}:{v}", q), (0, f"W{b}:{v}", -q)]})
    rows = [(r["id"], r["t"], lv, res, q) for r in reqs for lv, res, q in r["demands"]]
    demands = spark.createDataFrame(rows, "RequestID long, RequestedAt timestamp_ntz, level int, resource string, qty long")
    capacities = spark.createDataFrame(list(caps.items()), "resource string, capacity long")
    status, final = allocate(demands, capacities, {0: "INSUFFICIENT_STOCK"})
    assert {r.RequestID: (r.status, r.reason) for r in status.collect()} == sequential_reference(reqs, caps, {0: "INSUFFICIENT_STOCK"})
    assert all(r.capacity - r.consumed_before - r.qty >= 0 for r in final.filter("status = 'ACCEPTED'").collect())


def _compare(spark, reqs, caps, **params):
    rows = [(r["id"], r["t"], lv, res, q) for r in reqs for lv, res, q in r["demands"]]
    demands = spark.createDataFrame(rows, "RequestID long, RequestedAt timestamp_ntz, level int, resource string, qty long")
    decisions, _ = allocate(demands, spark.createDataFrame(list(caps.items()), "resource string, capacity long"), REASONS, **params)
    assert {r.RequestID: (r.status, r.reason) for r in decisions.collect()} == sequential_reference(reqs, caps, REASONS)


def _chain(n):
    """Request i needs resources i and i + 1, one of each: accepted, rejected, accepted, ..., each by the one before."""
    t = dt.datetime(2024, 1, 1)
    return [{"id": i, "key": (t, i), "t": t, "demands": [(1, f"R:{i}", 1), (1, f"R:{i + 1}", 1)]} for i in range(n)], {f"R:{i}": 1 for i in range(n + 1)}


def test_adversarial_chain_of_two_thousand(spark):
    reqs, caps = _chain(2000)
    rounds = []
    _compare(spark, reqs, caps, rounds=rounds)
    assert len(rounds) <= 25 and rounds[-1] == 0


def test_prefixes_agree_with_the_bounds(spark, monkeypatch):
    """Small prefixes over several rounds, with supplies and two levels."""
    from bazaar.operators import allocation
    monkeypatch.setattr(allocation, "PREFIX", 3)
    reqs, caps = _fixture(11, n_req=150)
    for r in reqs[::7]:
        r["demands"].append((1, f"S:{r['id'] % 25}", -4))
    chain, more = _chain(60)
    for i, r in enumerate(chain):
        r["id"] += 1000
        r["key"] = (r["t"], r["id"])
    rounds = []
    _compare(spark, reqs + chain, caps | more, rounds=rounds)
    assert len(rounds) > 3


@pytest.mark.parametrize("most", [1 << 16, 40])
def test_variants_apart_match_sequential(spark, monkeypatch, most):
    """Requests of one variant in order, variants side by side in few jobs; variants of many demands take the rounds."""
    from bazaar.operators import allocation
    monkeypatch.setattr(allocation, "MAX_PREFIX", most)
    rng = random.Random(5)
    base = dt.datetime(2024, 1, 1)
    caps = {f"W{w}:{v}": rng.randint(0, 12) for w in range(3) for v in [*range(6), None]}
    reqs = []
    for i in range(240):
        v, (a, b) = rng.choice([0, 0, 0, 1, 2, 3, 4, 5, None]), rng.sample(range(4), 2)
        q, t = rng.randint(1, 9), base + dt.timedelta(minutes=rng.randint(0, 90))
        reqs.append({"id": i, "key": (t, i), "t": t, "v": v, "demands": [(0, f"W{a}:{v}", q), (0, f"W{b}:{v}", -q)]})
    rows = [(r["id"], r["t"], r["v"], lv, res, q) for r in reqs for lv, res, q in r["demands"]]
    demands = spark.createDataFrame(rows, "RequestID long, RequestedAt timestamp_ntz, v long, level int, resource string, qty long")
    capacities = spark.createDataFrame(list(caps.items()), "resource string, capacity long")
    rounds = []
    status, final = allocate(demands, capacities, {0: "INSUFFICIENT_STOCK"}, rounds=rounds, apart="v")
    assert {r.RequestID: (r.status, r.reason) for r in status.collect()} == sequential_reference(reqs, caps, {0: "INSUFFICIENT_STOCK"})
    assert bool(rounds) == (most == 40)
    key = {r["id"]: r["key"] for r in reqs}
    taken, got = {}, final.collect()
    assert len(got) == len(rows)
    for r in sorted(got, key=lambda r: key[r.RequestID]):
        assert r.consumed_before == taken.get(r.resource, 0)
        taken[r.resource] = taken.get(r.resource, 0) + (r.qty if r.status == ACCEPTED else 0)


@pytest.mark.parametrize("seed", [21, 22, 23])
def test_certain_rejections_leave_before_the_rounds(spark, seed):
    """A request that asks for more than there ever is takes no part in the rounds, but for its earlier levels."""
    from bazaar.operators import allocation
    reqs, caps = _fixture(seed)
    for r in reqs:
        summed = {}
        for lv, res, q in r["demands"]:
            summed[lv, res] = summed.get((lv, res), 0) + q
        r["demands"] = [(lv, res, q) for (lv, res), q in summed.items()]
    rows = [(r["id"], r["t"], lv, res, q) for r in reqs for lv, res, q in r["demands"]]
    demands = spark.createDataFrame(rows, "RequestID long, RequestedAt timestamp_ntz, level int, resource string, qty long")
    capacities = spark.createDataFrame(list(caps.items()), "resource string, capacity long")
    expected = sequential_reference(reqs, caps, REASONS)
    status, final = allocate(demands, capacities, REASONS, takes=True)
    got = status.collect()
    assert len(got) == len(reqs) and {r.RequestID: (r.status, r.reason) for r in got} == expected
    lines, taken = {(r.RequestID, r.resource): r for r in final.collect()}, {}
    for r in sorted(reqs, key=lambda r: r["key"]):
        for _, res, q in r["demands"]:
            assert ((r["id"], res) in lines) == (expected[r["id"]][0] == ACCEPTED)
            if (r["id"], res) in lines:
                assert (lines[r["id"], res].consumed_before, lines[r["id"], res].qty) == (taken.get(res, 0), q)
                taken[res] = taken.get(res, 0) + q
    over = {r["id"]: min((lv for lv, res, q in r["demands"] if q > caps.get(res, 0)), default=None) for r in reqs}
    sure, left = allocation._certain(allocation._with_capacity(demands, capacities), REASONS, ["RequestedAt", "RequestID"])
    assert {(r.RequestID, r.level, r.resource) for r in left.collect()} == {(i, lv, res) for i, _, lv, res, _ in rows if over[i] is None or lv < over[i]}
    assert 0 < sure.count() < len(reqs) and all(expected[r.RequestID] == (r.status, r.reason) for r in sure.collect())
