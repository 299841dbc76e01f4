"""The registered queries of the text operators, and their SQL counterparts where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.llm import decontaminate, divergence, merkle, minhash, pii, quality, rules, sampling, secrets, simhash, suffixes, token_ids, toxicity
from orderpulse.llm.common import table
from orderpulse.session import work_folder

PSEUDONYM_KEY = "set a secret of your own"


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", predicted)


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_huffman_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "token-ids")
    token_ids.write_ids(table(spark, sf_dir, "documents"), folder, tokenizer_file("byte_bpe_50k.json"))
    return token_ids.read_ids(spark, folder, with_ids=False)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffixes.without_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.ledger(table(spark, sf_dir, "documents"))
    judged = rules.apply_policy(rules.apply_policy(rows, "base", "base_kept"), "v1")
    return judged.withColumn("base_failed", ~F.col("base_kept")).drop("base_kept")


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "kept")


def op9_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymized(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op10_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_pieces(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proofs(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan, op2_toxicity, op3_benchmark_decontamination, op4_huffman_token_ids, op5_suffix_dedup,
        op6_quality_rules, op7_simhash_near_dedup, op8_quality_classifier, op9_pii_pseudonyms, op10_sampled_pieces,
        op11_source_divergence, op12_minhash_near_dedup, op13_merkle_manifest,
    )
}
ORACLES = {
    "op6_quality_rules": rules.ORACLE,
    "op11_source_divergence": divergence.ORACLE,
    "op12_minhash_near_dedup": minhash.ORACLE,
    "op13_merkle_manifest": merkle.oracle(),
}
