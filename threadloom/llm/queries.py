"""One query for each operator over its whole table, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import (
    ann,
    bpe,
    decontaminate,
    language,
    lloyd,
    prefix_trie,
    quality,
    secret_scan,
    simhash,
    substring_dedup,
    suffix_dedup,
    warc,
    wordpiece,
)
from threadloom.session import stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SHINGLE_WORDS, SIMHASH_BITS = 4, 4
KEEP_SCORE = 0.3


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % by


@query("op1_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode_decode(docs, RANKS, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def rank_pieces() -> tuple[list[bytes], list[bytes]]:
    return wordpiece.split_vocabulary(bpe.read_ranks(RANKS))


@query("op5_token_counts")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return wordpiece.token_counts(docs, rank_pieces).select("doc_id", "n_words", "n_tokens")


@query("op10_secrets", secret_scan.oracle())
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs)
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in secret_scan.BASE]))
    return found.select(
        "doc_id",
        *(of(r.kind).alias(f"n_{r.kind}") for r in secret_scan.BASE),
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
    )


@query("op6_simhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), SHINGLE_WORDS, SIMHASH_BITS)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.Model:
    """Fitted on the labelled documents outside the held-out fifth; a second fifth calibrates."""
    known = labels.filter("quality IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("y"))
    # Texts become statistics before the join, so that no text is shuffled.
    train = docs.select("doc_id", "text").filter(remainder("doc_id", 5) != 0)
    found = quality.with_statistics(train, "text", ["doc_id"]).join(known, "doc_id")
    return quality.fit_statistics(
        stored(found.select("statistics", "y", (remainder("doc_id", 5) == 1).alias("later")), "statistics")
    )


@query("op4_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"),
    )


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.filter(remainder("doc_id", 3) != 1))
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score"
    )


@query("op2_decontaminate")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = decontaminate.hashed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    benchmark = table(spark, sf_dir, "benchmark")
    found = decontaminate.mark(docs, benchmark, decontaminate.fit(docs, benchmark))
    return found.select("doc_id", F.inline("matches")).withColumnRenamed("item", "item_id")


@query("op3_warc_zip", warc.ORACLE)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(spark, table(spark, sf_dir, "pages"), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_ann")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


@query("op8_suffix_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))
    length = lambda s: (s["end"] - s["start"]).cast("long")
    return found.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + length(s)).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


WINDOW_WORDS = 35


@query(
    "op13_substring_dedup",
    f"""
    WITH split AS (
        SELECT row_number() OVER () AS r, doc_id,
               regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
        FROM documents
    ), windows AS (
        SELECT r, unnest(range(1, len(words) - {WINDOW_WORDS - 2})) AS i, words FROM split
    ), named AS (
        SELECT r, i, sha256(array_to_string(words[i : i + {WINDOW_WORDS - 1}], ' ')) AS w FROM windows
    ), again AS (
        SELECT r, i FROM named WHERE w IN (SELECT w FROM named GROUP BY w HAVING count(*) > 1)
    ), word AS (
        SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM split
    ), marked AS (
        SELECT r, word, i, coalesce(max(CASE WHEN again.i IS NOT NULL THEN i END) OVER (
                   PARTITION BY r ORDER BY i ROWS BETWEEN {WINDOW_WORDS - 1} PRECEDING AND CURRENT ROW) > 0, false) AS gone
        FROM word LEFT JOIN again USING (r, i)
    ), made AS (
        SELECT r, count(*) FILTER (gone) AS n_removed,
               string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
        FROM marked GROUP BY r
    )
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(kept, '')) AS kept_sha256
    FROM split LEFT JOIN made USING (r)
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"), WINDOW_WORDS)
    length = lambda s: (s["end"] - s["start"]).cast("long")
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + length(s)).alias("n_removed"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


#: Unsigned CRC-32 of an id's decimal digits, bit by bit.
_CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""


@query(
    "op12_prefix_trie",
    f"""
    WITH turns AS (
        SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(
                   length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS i
        FROM conversations WHERE conv_id IS NOT NULL
    ), convs AS (
        SELECT c, c - c % {prefix_trie.GROUP} AS b, CAST({_CRC} % {prefix_trie.MOST_SHARED + 1} AS BIGINT) AS h
        FROM (SELECT DISTINCT c FROM turns)
    ), built AS (
        SELECT convs.c, 0 AS part, i, role, text FROM convs JOIN turns ON turns.c = b AND i < h
        UNION ALL
        SELECT convs.c, 1, i, role, text FROM convs JOIN turns ON turns.c = convs.c AND i >= h
    ), numbered AS (
        SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, i) AS d, length(text) AS chars,
               sha256(length(role) || ':' || role || text) AS turn
        FROM built
    ), named AS (
        SELECT c, d, chars, string_agg(turn, '') OVER (PARTITION BY c ORDER BY d) AS path FROM numbered
        UNION ALL
        SELECT c, 0, 0, '' FROM convs
    ), prefix AS (
        SELECT c, d, chars, path, lead(d) OVER (PARTITION BY c ORDER BY d) IS NULL AS last FROM named
    ), node AS (
        SELECT path, any_value(d) AS d, any_value(chars) AS chars, min(c) AS c, count(*) AS n,
               sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (last), '')) AS ends
        FROM prefix GROUP BY path
    ), child AS (
        SELECT left(path, -64) AS path, count(*) AS n FROM node WHERE d > 0 GROUP BY 1
    ), sums AS (
        -- A node lies below all shorter prefixes of its smallest member.
        SELECT prefix.path, sum((child.n IS NULL)::BIGINT) AS leaves, sum((node.n - 1) * node.chars) AS saved
        FROM node LEFT JOIN child USING (path) JOIN prefix ON prefix.c = node.c AND prefix.d <= node.d
        GROUP BY prefix.path
    )
    SELECT node.c AS conv_id, CAST(node.d AS BIGINT) AS depth, above.c AS parent_conv_id, node.n AS n_convs,
           CAST(coalesce(child.n, 0) AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
           CAST(saved AS BIGINT) AS saved_tokens, node.ends AS ends_sha256
    FROM node JOIN sums USING (path) LEFT JOIN child USING (path)
    LEFT JOIN node above ON node.d > 0 AND above.path = left(node.path, -64)
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


CODE_PARTS, CODE_ENTRIES, CODE_ROUNDS = 4, 256, 4


def lloyd_oracle() -> str:
    """Every round in full: all entries against all parts."""

    def assign(k: int) -> str:
        return f"""
    a{k} AS (
        SELECT r, p, x, min(list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c)
                            + e / {CODE_ENTRIES}.0) AS best
        FROM part JOIN c{k} USING (p) GROUP BY r, p, x
    )"""

    def update(k: int) -> str:
        return f"""
    m{k + 1} AS (
        SELECT p, e, i, floor(sum(v) / count(*)) AS v
        FROM (SELECT p, CAST((best - floor(best)) * {CODE_ENTRIES} AS BIGINT) AS e, unnest(x) AS v,
                     unnest(range(1, len(x) + 1)) AS i FROM a{k})
        GROUP BY p, e, i
    ), c{k + 1} AS (
        SELECT p, e, coalesce(new.c, old.c) AS c FROM c{k} old
        LEFT JOIN (SELECT p, e, list(v ORDER BY i) AS c FROM m{k + 1} GROUP BY p, e) new USING (p, e)
    )"""

    rounds = ",".join(assign(k) + "," + update(k) for k in range(CODE_ROUNDS))
    return f"""
    WITH kept AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), numbered AS (
        SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS r, len(v) // {CODE_PARTS} AS d FROM kept
    ), part AS (
        SELECT r, p, v[p * d + 1 : p * d + d] AS x FROM numbered, range({CODE_PARTS}) t(p)
    ), c0 AS (
        SELECT p, r AS e, x AS c FROM part WHERE r < {CODE_ENTRIES}
    ), {rounds}, {assign(CODE_ROUNDS)}, books AS (
        SELECT sha256(string_agg(CAST(CAST(v AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256
        FROM (SELECT p, e, unnest(c) AS v, unnest(range(len(c))) AS i FROM c{CODE_ROUNDS})
    ), coded AS (
        SELECT r, string_agg(format('{{:02x}}', CAST((best - floor(best)) * {CODE_ENTRIES} AS BIGINT)), '' ORDER BY p) AS code,
               CAST(sum(floor(best)) AS BIGINT) AS error
        FROM a{CODE_ROUNDS} GROUP BY r
    )
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM numbered JOIN coded USING (r), books
    """


@query("op11_vector_codes", lloyd_oracle())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    coded = lloyd.compress(vectors, CODE_PARTS, CODE_ENTRIES, CODE_ROUNDS)
    with_sums = lloyd.with_group_error(coded, "label", "label_error")
    return with_sums.select("vec_id", "code", "error", "label_error", "codebooks_sha256")
