"""Token files read once per task, and exact histograms of encoded lengths.

Lengths are counted with the rank files (byte-level BPE).  One pass maps every text to
its length; what is kept is one row per distinct length, from which suffix sums answer
totals, quantiles and truncated totals for every context limit.

* Null text counts as empty: length 0.  Repeated rows count each.  Texts may be of any length.
* Strings that look like special tokens are ordinary text.
* An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

BUCKET = 4096  # lengths in one bucket of the histogram
# White space as the patterns mean it, and how those end that split runs of it before a word.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
TAIL = r"|\s+(?!\S)|\s+"
RUN = 10_000   # characters of a run that is counted apart
LONG_RUN = re.compile(f"[{WHITE}]{{{RUN},}}")


def rank_encoding(path: str, pattern: str):
    """The encoder of a rank file: lines of base64 token and rank."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encoded_length(encoding, text: str) -> int:
    """The length of a whole text.  Long runs of white space are counted apart, as the pattern
    searches them again from every place that it tries, until its stack ends.

    Of a run before other text the pattern takes all but the last character as one piece;
    at the end of a text, all.
    """
    total = begin = 0
    for run in LONG_RUN.finditer(text) if encoding._pat_str.endswith(TAIL) else ():
        end = run.end() - (run.end() < len(text))
        total += len(encoding.encode_ordinary(text[begin : run.start()]))
        total += len(encoding._encode_single_piece(text[run.start() : end]))
        begin = end
    return total + len(encoding.encode_ordinary(text[begin:]))


def encoded_lengths(docs: DataFrame, path: str, pattern: str, text: str = "text", id: str | None = None) -> DataFrame:
    """Encoded length of every whole text: (id if asked for, n_tokens long)."""
    columns = [docs[id].alias("key")] if id else []

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = rank_encoding(path, pattern)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            counts = [encoded_length(encoding, x.as_py() or "") for x in texts]
            arrays = [*batch.columns[:-1], pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*(["key"] if id else []), "n_tokens"])

    given = docs.select(*columns, docs[text].cast("string").alias("body"))
    kind = f"key {given.schema['key'].dataType.simpleString()}, n_tokens long" if id else "n_tokens long"
    out = given.mapInArrow(lengths, kind)
    return out.withColumnRenamed("key", id) if id else out


def length_histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens, docs), folded on the map side: one row per task and distinct length moves."""
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("docs"))


def limits(histogram: DataFrame) -> DataFrame:
    """One row per distinct length, read as a context limit.

    docs / tokens: of exactly that length; docs_over: longer ones; docs_within and
    tokens_within: up to the limit; truncated_tokens: the sum of min(length, limit);
    share_within: part of the documents that fit, so the length is that quantile.
    For a limit between two lengths, take the row of the lower one and add
    docs_over * (limit - length) to truncated_tokens.  Give a stored histogram: it is read twice.
    """
    # Suffix sums in two steps, so no task holds the whole histogram: inside buckets of
    # lengths, and over the buckets, of which there are the longest length / BUCKET.
    rows = histogram.select(
        "n_tokens", "docs", (F.col("n_tokens") * F.col("docs")).alias("tokens"),
        F.floor(F.col("n_tokens") / BUCKET).cast("long").alias("bucket"),
    )
    sums = rows.groupBy("bucket").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    after = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    sums = sums.select(
        "bucket",
        F.coalesce(F.sum("d").over(after), F.lit(0)).alias("d_after"),
        F.coalesce(F.sum("t").over(after), F.lit(0)).alias("t_after"),
        F.sum("d").over(every).alias("all_docs"),
        F.sum("t").over(every).alias("all_tokens"),
    )
    above = Window.partitionBy("bucket").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(sums, "bucket").select(
        "*",
        (F.col("d_after") + F.coalesce(F.sum("docs").over(above), F.lit(0))).alias("docs_over"),
        (F.col("t_after") + F.coalesce(F.sum("tokens").over(above), F.lit(0))).alias("tokens_over"),
    )
    return rows.select(
        F.col("n_tokens").alias("context_limit"),
        "docs",
        "tokens",
        "docs_over",
        (F.col("all_docs") - F.col("docs_over")).alias("docs_within"),
        (F.col("all_tokens") - F.col("tokens_over")).alias("tokens_within"),
        (F.col("all_tokens") - F.col("tokens_over") + F.col("docs_over") * F.col("n_tokens")).alias("truncated_tokens"),
        ((F.col("all_docs") - F.col("docs_over")) / F.col("all_docs")).alias("share_within"),
    )


def at_limits(histogram: DataFrame, wanted: list[int]) -> DataFrame:
    """(context_limit, docs_within, docs_over, truncated_tokens) for given limits."""
    limit, fits = F.col("context_limit"), F.col("n_tokens") <= F.col("context_limit")
    rows = histogram.select("*", F.explode(F.lit([int(x) for x in wanted]).cast("array<bigint>")).alias("context_limit"))
    return rows.groupBy("context_limit").agg(
        F.sum(F.when(fits, F.col("docs")).otherwise(0)).alias("docs_within"),
        F.sum(F.when(fits, 0).otherwise(F.col("docs"))).alias("docs_over"),
        F.sum(F.least("n_tokens", limit) * F.col("docs")).alias("truncated_tokens"),
    )


def quantiles(report: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the least length within which at least that share of documents lies."""
    rows = report.select("*", F.explode(F.lit([float(x) for x in shares])).alias("share"))
    return rows.where("share_within >= share").groupBy("share").agg(F.min("context_limit").alias("n_tokens"))
