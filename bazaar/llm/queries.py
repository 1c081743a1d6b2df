"""The registered query of every operator: production parameters on the whole tables of ``sf_dir``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.llm import bpe, conversations, decontaminate, htmltext, kmeans, langid, lm, minhash, mixing, perplexity, pii, suffixes, toxicity
from bazaar.llm.shared import id_remainder, materialise, read_table
from bazaar.session import configure

QUERIES = {}
ORACLES = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


@query
def op1_repeated_spans(spark, sf_dir):
    """What remains of every document without the 50-byte strings that a smaller document has too."""
    out = suffixes.remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda s, x: s + x)
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op2_main_text(spark, sf_dir):
    """The main text of every page."""
    out = htmltext.extract_text(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "text_path")


@query
def op3_near_duplicates(spark, sf_dir):
    """The near-duplicate group of every document."""
    return minhash.near_duplicate_groups(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op4_mix_sources(spark, sf_dir):
    """Systematic sampling of all documents to weights 5, 2, 1 by source."""
    docs = read_table(spark, sf_dir, "documents")
    sized = materialise(docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")), "mix-sizes")
    out = mixing.mix_sources(sized, size_col="size")
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLES["op4_mix_sources"] = mixing.mix_oracle()


@query
def op5_quality(spark, sf_dir):
    """Text statistics and the perplexity verdict of every document."""
    out = perplexity.quality_filter(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_ppl")


@query
def op6_contamination(spark, sf_dir):
    """Every document's words that occur in a window of ten words of a benchmark item, and the items."""
    out = decontaminate.find_contamination(read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query
def op7_language(spark, sf_dir):
    """Language of every document; learns from the ids whose crc32 mod 5 is not 0."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text").withColumn("held_out", id_remainder(5) == 0)
    trees = langid.train(docs.where(~F.col("held_out") & F.col("lang").isNotNull()))
    return langid.identify(docs.select("doc_id", "held_out", "text"), trees).select("doc_id", "held_out", "lang_pred", "score")


@query
def op8_pseudonyms(spark, sf_dir):
    """Every document with its personal data replaced, and how many values of each kind were."""
    out = pii.pseudonymise(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.size(F.filter("pii", _of_kind(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return out.select("doc_id", "text", F.size("pii").cast("long").alias("n_values"), *counts)


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind


@query
def op9_language_model(spark, sf_dir):
    """Word-model and attention-model log probability of every document; learns from the ids whose crc32 mod 7 is not 2."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", (id_remainder(7) != 2).alias("train"))
    out = lm.score_texts(docs, "train")
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op10_toxicity(spark, sf_dir):
    """Toxicity of every document; learns from the labelled ids whose crc32 mod 4 is not 2."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", id_remainder(4) == 2)
    labels = read_table(spark, sf_dir, "labels").where(id_remainder(4) != 2)
    scored = toxicity.score_toxicity(docs, toxicity.train(docs.select("doc_id", "text"), labels))
    return scored.select("doc_id", "held_out", F.col("toxicity").alias("score"), F.col("toxic_predicted").alias("predicted"))


#: path of the vocabulary file; it is not part of the repository
VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"


@query
def op11_bpe(spark, sf_dir):
    """Token ids of every document and their decoded text, as digests."""
    tokenizer = bpe.Tokenizer(spark, VOCABULARY)
    out = tokenizer.decode(tokenizer.encode(read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"))
    ids = F.array_join(F.transform("token_ids", lambda x: x.cast("string")), " ")
    return out.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op12_centroids(spark, sf_dir):
    """Lloyd clusters of all embeddings, with the inertia and the centroid's digest."""
    clusters, centroids = kmeans.lloyd(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return kmeans.with_inertia(clusters, centroids).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


ORACLES["op12_centroids"] = kmeans.lloyd_oracle()


@query
def op13_conversations(spark, sf_dir):
    """Faults, cheapest repair and the repaired text's digest of every conversation, after the set damage."""
    return conversations.report(read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


ORACLES["op13_conversations"] = conversations.report_oracle()
