import random

import numpy as np
import pytest

from bazaar.llm import minhash
from bazaar.llm import textbytes as tb
from tests.llm.conftest import DOCS, SPACE_WORDS, corpus, lower_ascii, prose


def shingles(t):
    w = SPACE_WORDS.findall(lower_ascii(t or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(rows):
    """Components over ids (rows with one id are one document), null ids after all others."""
    ids = [minhash.NO_ID if r[0] is None else r[0] for r in rows]
    sets = [shingles(r[1]) for r in rows]
    top = {i: i for i in ids}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(ids[a]), find(ids[b])
                top[max(x, y)] = min(x, y)
    back = lambda x: None if x == minhash.NO_ID else x
    return sorted(((back(i), len(s), back(find(i)), find(i) == i) for i, s in zip(ids, sets)), key=repr)


def result(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()), key=repr)


def test_groups_match_brute_force(docs):
    extra = docs.selectExpr("*", "1 AS node", "2 AS kept", "3 AS bands")
    assert result(minhash.near_duplicate_groups(extra)) == brute(corpus())


def chain_rows(seed=3):
    """Chains of copies that drift, so that ends are linked only through the middle."""
    rng = random.Random(seed)
    rows = []
    for c in range(3):
        w = prose(rng, 120).split()
        for step in range(25):
            rows.append((1000 * c + rng.randrange(900) * 1 + step, " ".join(w), None, None, 0))
            for _ in range(2):
                w[rng.randrange(len(w))] = f"new{step}{rng.randrange(99)}"
    return rows


def test_drifting_chains_are_whole(spark):
    rows = chain_rows()
    assert result(minhash.near_duplicate_groups(spark.createDataFrame(rows, DOCS))) == brute(rows)


def test_many_near_copies_of_one_text(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 7)
    rng = random.Random(8)
    w = prose(rng, 100).split()
    rows = []
    for i in range(150):
        v = list(w)
        for _ in range(rng.randint(0, 4)):
            v[rng.randrange(len(v))] = f"z{rng.randrange(50)}"
        rows.append((i, " ".join(v), None, None, 0))
    assert result(minhash.near_duplicate_groups(spark.createDataFrame(rows, DOCS))) == brute(rows)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 1 << 63, 400, dtype=np.uint64), rng.integers(0, 1 << 63, 100, dtype=np.uint64)
    x = minhash.minima(np.concatenate([a, a[:300], b]), np.array([0, 400, 800]))
    assert abs(np.mean(x[0] == x[1]) - 300 / 500) < 0.12


def test_shingles_of_slices_agree():
    pw = tb.Powers()
    texts = ["a b c d e f", "", "a b", "a b", "b a", "A b C d E f"]
    buf = np.frombuffer("".join(texts).encode(), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    h, o = minhash.shingle_sets(buf, offs, pw)
    part = [frozenset(h[o[i]:o[i + 1]].tolist()) for i in range(len(texts))]
    assert [len(p) for p in part] == [2, 0, 1, 1, 1, 2] and part[2] == part[3] != part[4] and part[0] == part[5]


@pytest.mark.parametrize("edges,want", [([(1, 2), (2, 3), (5, 4), (4, 9)], {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 9: 4}), ([(i, i + 1) for i in range(40)], {i: 0 for i in range(41)})])
def test_alternating_stars(spark, edges, want):
    got = {r["node"]: r["component"] for r in minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want


def test_one_document_of_each_group_stays(docs, no_docs):
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and set(ids) == {d for d, _, _, k in brute(corpus()) if k}
    assert minhash.drop_near_duplicates(no_docs).count() == 0 and minhash.near_duplicate_groups(no_docs).count() == 0
