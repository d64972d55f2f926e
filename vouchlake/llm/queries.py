"""The registered queries of this subpackage, and the SQL each must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vouchlake.llm import (
    brown,
    language_id,
    line_dedup,
    merkle,
    mixing,
    multi_index,
    near_vectors,
    ngram_join,
    pieces,
    prefix_trie,
    secrets,
    token_counts,
    toxicity,
)
from vouchlake.llm.common import table
from vouchlake.operators.keys import same_key
from vouchlake.session import scratch_dir
from vouchlake.sinks.store import TableStore


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return multi_index.search(rows, rows.where(F.col("vec_id") % 50 == 0))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = line_dedup.dedup_report(table(spark, sf_dir, "documents"))
    return report.withColumn("removed", F.array_join("removed", ","))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches: all documents, their recount by another tokenizer, the removal of repeated texts."""
    docs = table(spark, sf_dir, "documents")
    rollup = token_counts.TokenRollup(TableStore(spark, scratch_dir(spark, "token-rollup")))
    first, second = (token_counts.counted(docs, t) for t in token_counts.TOKENIZERS)
    rollup.commit("load", token_counts.inserts(first))
    rollup.commit("recount", token_counts.revisions(first, second))
    rollup.commit("recount", token_counts.revisions(first, second))  # repeated, adds nothing
    # Counts and digests meet, not texts.
    counts = token_counts.counted(docs, "words-2", F.col("doc_id"), F.sha2(F.col("text"), 256).alias("digest"))
    first_of = counts.where(F.col("digest").isNotNull()).groupBy(F.col("digest").alias("kept")).agg(F.min("doc_id").alias("kept_id"))
    repeated = counts.join(first_of, same_key(F.col("digest"), F.col("kept"))).where(F.col("doc_id") > F.col("kept_id"))
    rollup.commit("repeats", token_counts.deletes(repeated))
    return rollup.totals()


def span_columns(found: DataFrame) -> DataFrame:
    """Counts and digests of the spans."""
    base = list(secrets.BASE)
    return found.select(
        "doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in base],
        F.sha2(secrets.span_list(base), 256).alias("base_sha256"),
        secrets.span_list([*base, *[c.kind for c in secrets.CLASSES]]).alias("spans"),
    )


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_columns(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.ngram_components(table(spark, sf_dir, "documents"), n=3, num=9, den=10)
    return found.withColumnRenamed("n_ngrams", "n_shingles")


def _remainder(n: int):
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % n


def op5_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.vector_components(table(spark, sf_dir, "embeddings"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    dictionaries = language_id.fit(docs.where(_remainder(3) != 1))
    unseen = docs.select("doc_id", (_remainder(3) == 1).alias("held_out"), "text")
    return language_id.identify(unseen, dictionaries).drop("text")


def op7_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", (_remainder(10) == 0).alias("held_out"), "text")
    train = docs.where(~F.col("held_out"))
    seeded, _ = brown.fit(train)
    model, words = brown.classed(train, seeded)
    return brown.score(docs, model, words)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.shared_prefixes(table(spark, sf_dir, "conversations"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", (_remainder(5) == 0).alias("held_out"), "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(_remainder(5) != 0)
    found = toxicity.score_documents(docs, toxicity.fit(docs.where(~F.col("held_out")), labels))
    return found.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence", "passages")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof; where the checksum of its id is even, checked with a text that lost its line breaks."""
    docs = table(spark, sf_dir, "documents")
    bare = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, merkle.leaf_digest(bare))
    proofs = merkle.document_proofs(merkle.document_leaves(docs, tampered.alias("tampered")))
    found = proofs.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        merkle.folded(F.coalesce("tampered", "digest"), F.col("path")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_nearest": op2_nearest,
    "op3_line_dedup": op3_line_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_near_vectors": op5_near_vectors,
    "op6_language_id": op6_language_id,
    "op7_class_lm": op7_class_lm,
    "op8_secret_scan": op8_secret_scan,
    "op9_pieces": op9_pieces,
    "op10_ngram_join": op10_ngram_join,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_toxicity": op12_toxicity,
    "op13_merkle_manifest": op13_merkle_manifest,
}
