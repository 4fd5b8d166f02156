"""Exact duplicates by content-defined chunk recipes, with DataFrame functions only.

A text is normalised, cut into chunks where its own content says so, and described
by the ordered list of its chunks' identifiers (its recipe).  Chunk contents are
compared once each, not once per text: an identifier is the chunk's hash together
with its rank among different contents of that hash, so equal identifiers mean equal
bytes.  Texts are equal when their recipes are equal.  Whole texts never move, only
distinct chunks and lists of eight-byte numbers.

* Null text counts as empty; empty texts are equal to each other.
* Repeated rows (same id, same length) are rows of their own; the first counts as kept.
* Extra columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tidemill.session import new_folder

WHITE_SPACE = " \t\n\x0b\f\r"
# A chunk ends behind a letter pair that the content has or lacks, so an insertion
# moves few boundaries; both ends bound its length in characters.
CHUNK = r"(?s).{256,4096}?(?:[aeiouáéíóúäöü][bcdfgnrstz](?=[aeiou])|$)|.{1,4096}"


def _written(df: DataFrame, label: str) -> DataFrame:
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def normalised(text: Column) -> Column:
    """The text without any white space of ``[\\x20\\x09-\\x0D]``; null is empty."""
    return reduce(lambda c, s: F.replace(c, F.lit(s), F.lit("")), WHITE_SPACE, F.coalesce(text.cast("string"), F.lit("")))


def chunks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def _cut_rows(docs: DataFrame, id: str, text: str, digest: str) -> DataFrame:
    """Per row: key, n_code (code points of the original text), text_sha256, parts, hashes."""
    rows = docs.select(
        docs[id].alias("key"),
        F.char_length(F.coalesce(docs[text].cast("string"), F.lit(""))).cast("long").alias("n_code"),
        normalised(docs[text]).alias("body"),
    ).select("key", "n_code", F.sha2("body", 256).alias("text_sha256"), chunks(F.col("body")).alias("parts"))
    return rows.withColumn("hashes", F.transform("parts", lambda x: F.call_function(digest, x).cast("long")))


def _pieces(rows: DataFrame) -> DataFrame:
    both = F.arrays_zip(F.col("hashes").alias("h"), F.col("parts").alias("chunk"))
    return rows.select("key", "n_code", "text_sha256", F.posexplode(both).alias("at", "p")).select(
        "key", "n_code", "text_sha256", "at", "p.h", "p.chunk"
    )


def recipes(docs: DataFrame, id: str = "doc_id", text: str = "text", digest: str = "xxhash64") -> DataFrame:
    """Per row: key, n_code, text_sha256, recipe (hashes of the chunks, ranks of those that share a hash).

    ``digest`` names the SQL function that hashes a chunk; tests pass a bad one.
    """
    rows = _cut_rows(docs, id, text, digest)
    plain = _written(rows.select("key", "n_code", "text_sha256", "hashes"), "recipes")
    # Every distinct content is compared once: copies fold on the map side, so a chunk of
    # a third of all rows costs a row per task.
    extremes = _pieces(rows).groupBy("h").agg(F.min("chunk").alias("lo"), F.max("chunk").alias("hi"))
    shared = _written(extremes.where("lo < hi").select("h"), "shared-hashes")
    if shared.isEmpty():
        # All identifiers are verified as they are.
        return plain.select("key", "n_code", "text_sha256", F.struct("hashes", F.array().cast("array<int>").alias("ranks")).alias("recipe"))
    pieces = _pieces(rows).join(shared, "h", "left_semi")
    contents = pieces.select("h", "chunk").distinct()
    contents = contents.withColumn("rank", F.row_number().over(Window.partitionBy("h").orderBy("chunk")))
    touched = pieces.join(contents, ["h", "chunk"]).groupBy("key", "n_code", "text_sha256").agg(
        F.transform(F.sort_array(F.collect_set(F.struct("at", "rank"))), lambda x: x["rank"]).alias("ranks")
    )
    same = [plain[c].eqNullSafe(touched[c]) for c in ("key", "n_code", "text_sha256")]
    return plain.join(touched, same, "left").select(
        plain["key"], plain["n_code"], plain["text_sha256"], F.struct("hashes", "ranks").alias("recipe")
    )


def exact_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", digest: str = "xxhash64") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points stays, then the smallest id
    (null ids last).
    """
    # Repeated rows fold into a count first; it is unfolded at the end.
    rows = recipes(docs, id, text, digest).groupBy("recipe", "key", "n_code", "text_sha256").agg(F.count("*").alias("times"))
    groups = rows.groupBy("recipe").agg(
        F.min(F.struct((-F.col("n_code")).alias("longest"), F.col("key").isNull().alias("no_id"), "key")).alias("first"),
        F.sum("times").alias("group_size"),
    )
    out = rows.join(groups, "recipe")
    out = out.select("*", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy"))
    kept = F.col("key").eqNullSafe(F.col("first.key")) & (F.col("n_code") == -F.col("first.longest")) & (F.col("copy") == 1)
    return out.select(
        F.col("key").alias(id), F.col("first.key").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256"
    )


def without_exact_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    # A struct is never null, so null ids join too, and the window below needs no other exchange.
    kept = exact_duplicates(docs, id, text).where("kept").select(
        F.struct(F.col(id).alias("k")).alias("at"), F.col("text_sha256").alias("sha")
    )
    own = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.struct(docs[id].alias("k")).alias("at"),
        F.sha2(normalised(docs[text]), 256).alias("sha"),
        F.char_length(F.coalesce(docs[text].cast("string"), F.lit(""))).alias("n_code"),
    )
    own = own.join(kept, ["at", "sha"], "left_semi")
    # An id that repeats with equal texts: the longest row, then any of equal ones.
    order = Window.partitionBy("at", "sha").orderBy(F.desc("n_code"), F.xxhash64("row"))
    return own.withColumn("nth", F.row_number().over(order)).where("nth = 1").select("row.*")
