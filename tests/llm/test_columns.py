"""Columns of the input whose names an operator uses itself: nothing crashes, nothing of the user's is lost."""
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from bazaar.llm import decontaminate, htmltext, minhash, mixing
from tests.conftest import SF_SMALL

NAMES = ["_row", "size", "source_size", "target", "copies", "_swaps", "pii", "_items", "_text_key", "n_words", "n_hit", "item_ids", "spans", "_doc", "score", "bits_per_byte", "lang_pred", "_host", "_paths", "a.b", "fp", "_id", "kept", "copy_no"]


@pytest.fixture(scope="module")
def docs(spark):
    base = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("doc_id < 60")
    return base.select("*", *[F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")).alias(n) for n in NAMES])


@pytest.mark.parametrize("name,step", cp.STAGES)
def test_stage_keeps_every_column(spark, docs, name, step):
    out = step(spark, docs, SF_SMALL)
    assert out.columns == docs.columns
    rows = out.collect()
    assert rows and all(r[n] == f"{n}:{r['doc_id']}" for r in rows for n in NAMES)


def test_operators_keep_other_columns(spark, docs):
    kept = minhash.drop_near_duplicates(docs.drop("a.b")).collect()
    assert kept and all(r["_doc"] == f"_doc:{r['doc_id']}" for r in kept)
    clean = decontaminate.drop_contaminated(docs, spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")).collect()
    assert clean and all(r["n_words"] == f"n_words:{r['doc_id']}" and r["_items"] == f"_items:{r['doc_id']}" for r in clean)
    mixed = mixing.mix_sources(docs.drop("a.b", "size", "source_size", "target", "copies")).collect()
    assert mixed and all(r["_row"] == f"_row:{r['doc_id']}" for r in mixed)
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("*", F.lit("h").alias("_host"), F.lit("p").alias("_paths"))
    assert {(r["_host"], r["_paths"]) for r in htmltext.extract_text(pages).collect()} == {("h", "p")}


def test_deep_pages_take_time_by_their_length():
    import time
    for page in ("<div>" * 50_000 + "text, here", "<form><div class=sidebar><p>some words, here" * 5_000, "<div>" * 20_000 + "x, y" + "</span></b></foo>" * 20_000):
        began = time.process_time()
        found = htmltext.parse(page)
        assert htmltext.text_of(found, [htmltext.best_container(found)])
        assert time.process_time() - began < 5
