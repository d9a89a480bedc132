"""Queries of the training-data operators, and the oracle SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.llm import (
    decontam,
    html_text,
    language,
    licenses,
    ngram_join,
    oracles,
    packing,
    prefix_trie,
    pseudonyms,
    quality,
    ranked_search,
    sharding,
    toxicity,
    vector_forest,
)
from docspark.sources.scratch import stage

#: The secret of the pseudonyms; a real run brings its own.
KEY = "an example key, not a secret"


def tokenizer_file() -> str:
    """Where the tokenizer lies; only packing needs it, so nothing else fails where it is missing."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, probability of the highest grade and the decision for every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, quality.grades_of_labels(_table(spark, sf_dir, "labels")))
    return quality.score(docs, model).select(
        "doc_id", "expected_grade", "tail_probability", (F.col("tail_probability") >= quality.KEEP).alias("keep")
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_file(), special=True)


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op4_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of 16, its slot there, and its shard of 17."""
    return sharding.assign(_table(spark, sf_dir, "documents"), n_shards=16)


def op5_vector_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at cosine 0.9."""
    return vector_forest.digest(*vector_forest.near_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.9))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from those that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", language.held_out())
    profiles = language.learn(docs.where(~F.col("held_out") & F.col("doc_id").isNotNull()))
    return language.predict(docs, profiles, keep=("doc_id", "held_out"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item, and where."""
    return decontam.find(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("text_hash")


def op8_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with pseudonyms in its text."""
    return pseudonyms.pseudonymise(_table(spark, sf_dir, "documents").select("doc_id", "text"), KEY)


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with a similarity of at least 0.85 on four-word shingles."""
    return ngram_join.jaccard_components(_table(spark, sf_dir, "documents"), size=4, percent=85)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates in every document."""
    return licenses.digest(licenses.scan(_table(spark, sf_dir, "documents")))


def op11_toxicity_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, voted by its nearest labelled examples that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", language.held_out())
    labels = _table(spark, sf_dir, "labels").where(~language.held_out()).select("doc_id", F.col("toxic").alias("label"))
    found = toxicity.score(docs, toxicity.fit(docs, labels), keep=("doc_id", "held_out"))
    return found.select("doc_id", "held_out", "score", (F.col("score") >= toxicity.TOXIC).cast("int").alias("predicted"), "evidence")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranked_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All prefixes of the conversations, after starts are shared."""
    turns = prefix_trie.number_turns(_table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_nodes(prefix_trie.share_starts(stage(turns, "trie-turns")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_html_extraction": op3_html_extraction,
    "op4_hash_tree_sharding": op4_hash_tree_sharding,
    "op5_vector_forest": op5_vector_forest,
    "op6_language_id": op6_language_id,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_pii_pseudonyms": op8_pii_pseudonyms,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_license_scan": op10_license_scan,
    "op11_toxicity_neighbours": op11_toxicity_neighbours,
    "op12_ranked_search": op12_ranked_search,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE: dict[str, str] = {
    "op5_vector_forest": oracles.VECTORS,
    "op7_benchmark_decontamination": oracles.DECONTAMINATION,
    "op9_ngram_jaccard_join": oracles.jaccard(4, 85),
    "op10_license_scan": oracles.license_scan(),
    "op12_ranked_search": oracles.RANKED_SEARCH,
    "op13_prefix_trie": oracles.PREFIX_TRIE,
}
