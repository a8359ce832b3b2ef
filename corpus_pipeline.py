"""From raw documents to token ids: quality, near-duplicates, benchmark leaks, secrets, encoding.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before kept, and returns the
columns of its input; only the last returns ids. Rows are matched by ``doc_id``: rows that repeat an id are
one document, rows without an id cannot be named and pass the near-duplicate stage.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import bpe, decontaminate, quality, secret_scan, simhash
from threadloom.llm.arrow import quoted, small_batches
from threadloom.llm.queries import KEEP_SCORE, RANKS, SHINGLE_WORDS, SIMHASH_BITS, quality_model, table
from threadloom.session import stored


def like(found: DataFrame, docs: DataFrame) -> DataFrame:
    return found.select(*(F.col(quoted(c)) for c in docs.columns))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores at ``KEEP_SCORE`` or more."""
    small_batches(spark)
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return like(quality.score(docs, model, out="__score").filter(F.col("__score") >= KEEP_SCORE), docs)


def keep_first_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked fingerprints."""
    small_batches(spark)
    found = stored(simhash.near_duplicates(docs, SHINGLE_WORDS, SIMHASH_BITS).select("doc_id", "component_id"), "groups")
    # Stored, so that Spark knows the size when it chooses between broadcast and shuffle.
    dropped = stored(found.filter("doc_id <> component_id").select("doc_id").distinct(), "copies")
    kept = docs.join(dropped, "doc_id", "left_anti")
    again = stored(found.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "again")
    if again.isEmpty():
        return like(kept, docs)
    once = kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return like(kept.join(again, "doc_id", "left_anti").unionByName(once), docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, exact or reworded."""
    small_batches(spark)
    benchmark = table(spark, sf_dir, "benchmark")
    prepared = decontaminate.hashed(docs)
    latent = decontaminate.fit(prepared, benchmark)
    found = decontaminate.mark(prepared, benchmark, latent, out="__matches")
    return like(found.filter(F.size("__matches") == 0), docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by a mark; ``n_chars`` follows the text."""
    small_batches(spark)
    clean = like(secret_scan.redact(secret_scan.scan(docs, out="__spans"), "__spans"), docs)
    if "n_chars" in clean.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to the very text."""
    small_batches(spark)
    coded = bpe.encode_decode(docs.select("doc_id", "text"), RANKS, public_tokenizers.PATTERN)
    same = F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), same.alias("round_trip"), "ids")


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_first_of_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("secrets", redact_secrets),
    ("encoding", encode),
]
#: The classifier and the latent search have no SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
