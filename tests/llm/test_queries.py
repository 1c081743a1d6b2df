"""The registered queries: one per operator and the pipeline, whole tables, documented columns."""
import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

COLUMNS = {
    "op1_repeated_spans": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op2_main_text": ["page_id", "url", "text", "n_chars"],
    "op3_near_duplicates": ["doc_id", "n_shingles", "component_id", "kept"],
    "op4_mix_sources": ["doc_id", "size", "source_size", "target", "taken"],
    "op5_quality": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op6_contamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op7_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op8_pseudonyms": ["doc_id", "text", "n_values"],
    "op9_language_model": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op10_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op11_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op12_centroids": ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
    "op13_conversations": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
}


TABLES = {"op2_main_text": ("pages", "page_id"), "op12_centroids": ("embeddings", "vec_id"), "op13_conversations": ("conversations", "conv_id")}


def test_all_are_registered():
    names = [q for q in entry.queries() if q.startswith("op") and q[2].isdigit()]
    assert sorted(names) == sorted(COLUMNS) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", COLUMNS)
def test_query_covers_its_table(spark, name):
    out = entry.queries()[name](spark, SF_SMALL).toPandas()
    assert list(out.columns)[:len(COLUMNS[name])] == COLUMNS[name]
    table, key = TABLES.get(name, ("documents", "doc_id"))
    assert sorted(out[key]) == sorted(r[0] for r in duckdb.sql(f"SELECT {'DISTINCT ' * (key == 'conv_id')}{key} FROM '{SF_SMALL}/{table}.parquet'").fetchall())


@pytest.mark.parametrize("name", ["op4_mix_sources", "op12_centroids", "op13_conversations"])
def test_matches_its_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS FROM '{SF_SMALL}/{table}.parquet'")
    sql = con.execute(entry.oracle_sql()[name]).df()
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    key = TABLES.get(name, ("documents", "doc_id"))[1]
    a, b = (x[sorted(x.columns)].sort_values(key).reset_index(drop=True) for x in (sql, got))
    assert (a == b).all().all()


def test_pipeline_query(spark):
    out = entry.queries()["pipeline"](spark, SF_SMALL)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "copy_no"] and out.count() > 0
