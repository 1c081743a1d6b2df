import random

import pytest

from bazaar.llm import decontaminate
from tests.llm.conftest import ALNUM_WORDS, DOCS, corpus, lower_ascii, prose


def words(t):
    return ALNUM_WORDS.findall(lower_ascii(t or ""))


def brute(rows, items, span=10):
    out = []
    for d, t, *_ in rows:
        w, hit, ids = words(t), set(), set()
        for item, it in items:
            iw = words(it)
            n = min(len(iw), span)
            for j in range(len(iw) - n + 1 if n else 0):
                for i in range(len(w) - n + 1):
                    if w[i:i + n] == iw[j:j + n]:
                        hit |= set(range(i, i + n))
                        ids.add("" if item is None else str(item))
        out.append((d, len(w), len(hit), ",".join(sorted(ids)), None))
    return sorted(out, key=repr)


def result(df):
    rows = df.collect()
    for r in rows:
        assert r["n_hit"] == sum(s["last"] - s["first"] + 1 for s in r["spans"])
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], ",".join(r["item_ids"]), None) for r in rows), key=repr)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(12)
    rows = corpus(5, 40)
    items = [(i, prose(rng, rng.choice([3, 5, 9, 10, 11, 25, 60]))) for i in range(12)] + [(30, None), (31, ""), (32, "..."), (33, "Two words"), (34, "one"), (None, prose(rng, 14)), (35, "a b " * 12), (33, "Two words")]
    for i, (_, t) in enumerate(items[:12]):  # whole items, parts of 9 to 12 words, altered case and marks
        w = words(t)
        cut = w[:rng.randint(9, 12)]
        rows.append((500 + i, prose(rng, 30) + " " + rng.choice([" ".join(w), "; ".join(cut).upper(), "-".join(cut[1:])]) + " " + prose(rng, 20), "en", "a", 1))
    rows += [(600, "Here are TWO, words! one", "en", "a", 1), (601, "a b " * 30, "en", "a", 1), (602, items[17][1] or "", "en", "a", 1)]
    return rows, items


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_hits_match_brute_force(spark, case, broadcast):
    rows, items = case
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS n_hit", "2 AS item_id", "3 AS fp")
        bench = spark.createDataFrame(items, "item_id long, text string")
        assert result(decontaminate.find_contamination(docs, bench)) == brute(rows, items)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty_tables(spark, docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_contamination(docs, none).where("n_hit > 0").count() == 0
    assert decontaminate.drop_contaminated(docs, none).count() == docs.count()
    assert decontaminate.find_contamination(no_docs, none).count() == 0
