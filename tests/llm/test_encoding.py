"""BPE by prefixes against the library that published the vocabulary's format, and an exact round trip."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer as Library

from bazaar.llm import bpe
from bazaar.llm.queries import VOCABULARY


@pytest.fixture(scope="module")
def tables():
    return bpe.build_tables(bpe.read_vocabulary(VOCABULARY))


@pytest.fixture(scope="module")
def library():
    return Library.from_file(VOCABULARY)


def ids(tables, text):
    return np.frombuffer(bpe.encode_texts(tables, [text])[0], np.int32).tolist()


ODD = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "ΣΑΣ", "İ", "é", "é", " ", "\x1c", "\x85", "　", "'s", "'LL", "12", "½", "!!", "...", "漢字", "🙂", "\n", "a" * 60, "\0", "</w>"]


def test_ids_equal_the_library(tables, library):
    rng = random.Random(3)
    names = [n.replace("</w>", "") for n in tables["names"]]
    for k in range(3000):
        kind = k % 3
        text = "".join([rng.choice("aeinst") for _ in range(rng.randint(1, 40))] if kind == 0 else [rng.choice(names) for _ in range(rng.randint(1, 6))] if kind == 1
                       else [rng.choice([*ODD, "the", "ing"]) for _ in range(rng.randint(1, 15))])
        assert ids(tables, text) == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_words_one_by_one_and_together(tables):
    rng = random.Random(4)
    words = ["".join(rng.choice("abenorst") for _ in range(rng.randint(1, bpe.SHORT))).encode() for _ in range(800)]
    together = bpe.encode_words(tables, words)
    assert [np.frombuffer(x, np.int32).tolist() for x in together] == [bpe.encode_word(tables, w) for w in words]


def test_a_token_is_its_own_encoding(tables):
    sample = [t for s, t in enumerate(tables["ids"]) if t >= 0][::37]
    back = {c: i for i, c in enumerate(bpe.byte_alphabet())}
    for t in sample:
        name = tables["names"][t]
        if name.endswith("</w>"):
            assert bpe.encode_word(tables, bytes(back[c] for c in name[:-4])) == [t]


def test_rows(spark, library):
    rows = [(1, None, "x"), (2, "", "x"), (3, "  \n", None), (4, "Hello world <|endoftext|> it's 42!", "x"), (4, "Hello world", "x"), (None, "ab" * 2_500_000, "long word"),
            (5, ("Thandble the " * 100_000), "long text")]
    rows += [(10 + i, t, "odd") for i, t in enumerate(ODD)]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("token_ids", T.StringType()), T.StructField("decoded", T.StringType())])
    docs = spark.createDataFrame([(a, b, c, "old") for a, b, c in rows], schema).repartition(3)
    tok = bpe.Tokenizer(spark, VOCABULARY)
    out = tok.decode(tok.encode(docs))
    assert out.columns == ["doc_id", "text", "token_ids", "decoded"]
    got = sorted(((r["text"] or "", r["token_ids"], r["decoded"]) for r in out.collect()), key=lambda r: (r[0], r[1]))
    want = []
    for _, text, _ in rows:
        x = library.encode(text or "", add_special_tokens=False).ids
        want.append((text or "", x, library.decode(x, skip_special_tokens=False)))
    assert got == sorted(want, key=lambda r: (r[0], r[1]))
    assert tok.decode(tok.encode(docs.limit(0))).collect() == []
    assert tok.decode(spark.createDataFrame([(None,), ([0, -5, 10**6, 1],)], "token_ids array<int>")).select(F.sort_array(F.collect_list(F.coalesce("decoded", F.lit("none"))))).first()[0] == ["! \"", "none"]
