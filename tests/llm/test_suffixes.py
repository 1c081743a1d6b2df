import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bazaar.llm import suffixes
from tests.llm.conftest import DOCS, corpus


def naive_order(t: bytes, depth: int) -> list[bytes]:
    return [t[i:i + depth] for i in sorted(range(len(t)), key=lambda i: t[i:i + depth])]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"ab", b"aab", b"\xff", b"zz"]), min_size=1, max_size=60), st.integers(1, 20), st.integers(0, 3))
def test_suffix_order_is_sorted_to_depth(parts, depth, seed):
    t = b"".join(parts)
    text = np.frombuffer(t, np.uint8)
    wanted = np.random.default_rng(seed).random(len(t)) < (1.0 if seed == 0 else 0.5)
    got = suffixes.suffix_order(text, wanted, depth)
    assert sorted(got.tolist()) == np.flatnonzero(wanted).tolist()
    heads = [t[i:i + depth] for i in got]
    assert heads == sorted(heads)
    lcp = suffixes.adjacent_prefixes(text, got, depth)
    for k in range(1, len(got)):
        a, b = t[got[k - 1]:got[k - 1] + depth], t[got[k]:got[k] + depth]
        want = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        if len(a) == len(b) == depth or want < min(len(a), len(b)):  # at the text's end zero bytes may agree
            assert lcp[k] == want


def test_types_agree_with_comparison():
    t = b"banana$ann\x00aaab"
    small = suffixes.smaller_than_successor(np.frombuffer(t, np.uint8))
    assert [bool(x) for x in small] == [t[i:] < t[i + 1:] and i + 1 < len(t) for i in range(len(t))]


def brute(rows, span):
    first = {}
    for d, t, *_ in rows:
        b = (t or "").encode()
        d = suffixes.NO_ID if d is None else d
        for i in range(len(b) - span + 1):
            s = b[i:i + span]
            first[s] = min(first.get(s, d), d)
    out = []
    for d, t, *_ in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - span + 1):
            if first[b[i:i + span]] < (suffixes.NO_ID if d is None else d):
                gone[i:i + span] = b"\1" * span
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d if d != suffixes.NO_ID else None, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r["doc_id"], r["n_bytes"], sum(b - a for a, b in zip(r["starts"], r["ends"])), len(r["starts"]), hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in df.collect()), key=repr)


@pytest.mark.parametrize("batch_bytes,hot", [(1 << 23, 1000), (4000, 1000), (4000, 1), (1 << 23, 1)])
def test_remove_repeats_matches_brute_force(spark, docs, batch_bytes, hot):
    extra = docs.selectExpr("*", "1 AS batch", "'x' AS digest", "2 AS kept")
    assert result(suffixes.remove_repeats(extra, batch_bytes=batch_bytes, group_bytes=2000, hot_docs=hot)) == brute(corpus(), 50)


def test_one_text_many_copies_and_periodic_texts(spark):
    rng = random.Random(4)
    rows = [(i, "abc" * 60, None, None, 0) for i in range(30)] + [(100 + i, "xy" * rng.randint(20, 80) + "abc" * 20, None, None, 0) for i in range(20)]
    rows += [(300, "q" * 49, None, None, 0), (301, "q" * 49, None, None, 0), (302, "é" * 25, None, None, 0), (303, "é" * 25, None, None, 0)]
    assert result(suffixes.remove_repeats(spark.createDataFrame(rows, DOCS), batch_bytes=3000)) == brute(rows, 50)


def test_empty_table(no_docs):
    assert suffixes.remove_repeats(no_docs).count() == 0
