import random
import re

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
WORDS = "the of and river stone light garden window morning paper silver quiet market harbor winter table answer field road house water bridge letter color music".split()
SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower_ascii(s: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def prose(rng: random.Random, n: int) -> str:
    out = []
    for i in range(n):
        out.append(rng.choice(WORDS) + (rng.choice("aeiou") + rng.choice("nrst") if rng.random() < 0.5 else ""))
        if rng.random() < 0.08:
            out[-1] += rng.choice([".", ",", ".\n"])
    return " ".join(out)


def corpus(seed: int = 1, n: int = 60) -> list[tuple]:
    """Documents with nulls, empty and odd texts, exact and near copies, shared passages and repeated rows."""
    rng = random.Random(seed)
    passage = prose(rng, 70)
    rows, base = [], [prose(rng, rng.randint(20, 160)) for _ in range(n // 2)]
    for i in range(n):
        kind = rng.random()
        t = rng.choice(base) if kind < 0.3 else prose(rng, rng.randint(1, 200))
        if 0.15 < kind < 0.3:  # a near copy
            w = t.split(" ")
            w[rng.randrange(len(w))] = "changed"
            t = " ".join(w)
        if 0.5 < kind < 0.65:
            w = t.split(" ")
            k = rng.randrange(len(w) + 1)
            t = " ".join(w[:k] + [passage] + w[k:])
        rows.append((i * 3 % 101, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None]), len(t)))
    rows += [(200, None, "en", "a", None), (201, "", "de", "b", 0), (202, "   \n\t", None, "c", 5), (203, "Ünïcödé ÄÖ 漢字 " * 9, "de", "b", 1), (204, "one two", "en", "a", 7), (205, "one two", "en", "a", 7),
             (206, "x" * 400, "en", "a", 400), (207, "x" * 300, "en", None, 300), (208, "123 456 789", "en", "a", 11), rows[5], rows[5], (None, rows[3][1], "en", "a", 1), (None, "lonely text without id", "en", "a", 1)]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
