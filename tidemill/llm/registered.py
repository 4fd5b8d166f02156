"""The operators' queries over whole tables, with SQL twins where SQL can say the same."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.llm import bpe, decontaminate, exact, jaccard, langid, pieces, quality, records, repair, secrets, sharding, spelling, tokens
from tidemill.llm.components import written
from tidemill.session import new_folder

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact.exact_duplicates(_documents(spark, sf))


def sharding_query(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.sharded(_documents(spark, sf))


def _labels(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/labels.parquet")


def language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Learns from three of four parts of the documents, predicts all."""
    docs = _documents(spark, sf)
    prototypes = langid.learn(docs.where(langid.part_of(F.col("doc_id"), 4) != 2))
    found = langid.predict(docs, prototypes)
    return found.select("doc_id", (langid.part_of(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Learns from two of three parts of the labels, scores all documents."""
    docs, labels = _documents(spark, sf), _labels(spark, sf)
    model = quality.learn(docs, labels.where(langid.part_of(F.col("doc_id"), 3) != 1))
    found = quality.score(docs, model, keep=[docs["doc_id"]])
    held_out = langid.part_of(F.col("row.doc_id"), 3) == 1
    return found.select("row.doc_id", held_out.alias("held_out"), "score", "predicted")


def bpe_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.digests(bpe.decoded(bpe.encoded(_documents(spark, sf), path), path))


def secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.span_digests(secrets.scan(_documents(spark, sf)))


def jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.similar_groups(_documents(spark, sf), n=3, percent=90)


def token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The exact histogram of encoded lengths, each length as a context limit."""
    lengths = tokens.encoded_lengths(
        _documents(spark, sf), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
    # Stored, so that texts are encoded once for both sums over it.
    return tokens.limits(written(tokens.length_histogram(lengths), "lengths"))


def binary_records(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "records")
    index = records.write_records(_documents(spark, sf), folder, public_tokenizers.path("byte_bpe_50k.json"), 2)
    return records.record_digests(index, folder)


def decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contaminated(_documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


def sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.digests(pieces.decoded(pieces.encoded(_documents(spark, sf), path), path))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of conversations with faults put in by a fixed rule; nulls count as one blank."""
    place = F.concat_ws(":", *(F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("conv_id", "turn")))
    kind, text = F.crc32(place) % 20, F.coalesce("text", F.lit(" "))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(1), copies)).alias("copy"),
    )


def conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Reports of all conversations; those without rows after the damage have zeros."""
    given = spark.read.parquet(f"{sf}/conversations.parquet")
    found = repair.reports(repair.mended_blocks(damaged(given)))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    none = [F.lit(0).cast("long").alias(x) for x in counts]
    nothing = F.sha2(F.lit(""), 256)
    ids = given.select("conv_id").distinct().select("conv_id", *none, F.lit("").alias("audit"), F.lit(None).cast("string").alias("repaired_sha256"))
    return found.unionByName(ids).groupBy("conv_id").agg(
        *(F.max(x).alias(x) for x in [*counts, "audit"]), F.coalesce(F.max("repaired_sha256"), nothing).alias("repaired_sha256")
    )


def misspelt(id: str, word: str) -> str:
    """The word without one code point, by a fixed rule for some words of some documents."""
    h = zlib.crc32(f"{id}:{word}".encode())
    return word if h % 97 else word[: h % len(word)] + word[h % len(word) + 1 :]


def spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(_documents(spark, sf), change=misspelt))


QUERIES: dict[str, Query] = {
    "op1_language_id": language_id,
    "op2_quality_classifier": quality_classifier,
    "op3_bpe_round_trip": bpe_round_trip,
    "op4_secret_scans": secret_scan,
    "op5_jaccard_join": jaccard_join,
    "op6_token_counts": token_counts,
    "op7_binary_records": binary_records,
    "op8_exact_dedup": exact_dedup,
    "op9_sharding": sharding_query,
    "op10_decontamination": decontamination,
    "op11_sentencepiece": sentencepiece,
    "op12_conversation_repair": conversation_repair,
    "op13_spelling_variants": spelling_variants,
}

# Words of a text as a list, and the n-grams of such a list (fewer words make one of all).
_PLAIN_WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"""
_FOLDED_WORDS = r"""regexp_extract_all(lower(coalesce(text, '')),
    '[0-9a-z\x{80}-\x{9f}\x{c0}-\x{1fff}\x{2070}-\x{2fff}\x{3040}-\x{10ffff}]+')"""


def _grams(n: int) -> str:
    several = " || ' ' || ".join(f"w[i + {k}]" if k else "w[i]" for k in range(n))
    return f"""unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {n} THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - {n - 2}), lambda i: {several}) END)"""


def _grams_of_width(k: str) -> str:
    return f"unnest(list_transform(range(1, len(w) - {k} + 2), lambda i: array_to_string(w[i:i + {k} - 1], ' ')))"


ORACLE_SQL: dict[str, str] = {
    "op8_exact_dedup": r"""
    WITH t AS (
        SELECT doc_id, length(coalesce(text, '')) AS n,
               regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
        FROM documents),
    g AS (
        SELECT *, first_value(doc_id) OVER (PARTITION BY body ORDER BY n DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY body) AS group_size,
               row_number() OVER (PARTITION BY body ORDER BY n DESC, doc_id) = 1 AS kept
        FROM t)
    SELECT doc_id, keep_id, group_size, kept, sha256(body) AS text_sha256 FROM g
    """,
    "op5_jaccard_join": f"""
    WITH RECURSIVE words AS (SELECT doc_id, {_PLAIN_WORDS} AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, {_grams(3)} AS g FROM words),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    pairs AS (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
        FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
    links AS (
        SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
    ends AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach AS (
        SELECT doc_id, doc_id AS root FROM documents
        UNION SELECT reach.doc_id, ends.b FROM reach JOIN ends ON ends.a = reach.root)
    SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(root) AS component_id
    FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
    """,
    "op10_decontamination": f"""
    WITH dw AS (SELECT doc_id, {_FOLDED_WORDS} AS w FROM documents),
    iw AS (SELECT item_id, {_FOLDED_WORDS} AS w FROM benchmark),
    -- An item of fewer than five words is one n-gram of its own width: documents are cut in all widths there are.
    k AS (SELECT DISTINCT least(len(w), 5) AS k FROM iw WHERE len(w) > 0),
    d AS (SELECT DISTINCT doc_id, {_grams_of_width("least(k, len(w))")} AS g FROM dw, k WHERE len(w) > 0),
    i AS (SELECT DISTINCT item_id, {_grams(5)} AS g FROM iw),
    n AS (SELECT item_id, count(*) AS n FROM i GROUP BY item_id)
    SELECT doc_id, item_id, CAST(any_value(n) AS INT) AS n_shingles, count(*) AS common, count(*) / any_value(n) AS containment
    FROM i JOIN d USING (g) JOIN n USING (item_id) GROUP BY doc_id, item_id
    HAVING 100 * count(*) >= 80 * any_value(n)
    """,
}
