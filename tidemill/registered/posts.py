"""Registered queries over forum posts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions import text as text_fn
from tidemill.operators import merge, quality
from tidemill.plans import posts as plan
from tidemill.registered.base import (
    AS_OF, LEXICON, POSTS, SCORED, Registered, View, mean, pct, rounded, table,
)
from tidemill.session import new_folder
from tidemill.sinks.tables import write_files

QUERIES: dict[str, Registered] = {}
NOW = f"TIMESTAMP '{AS_OF}'"
POST_DAY = "2024-01-15 12:00:00"
DAY = "TIMESTAMP '2024-01-15 00:00:00'"
BASE = f"({SCORED}) s"


def _add(name, run, sql=None):
    QUERIES[name] = Registered(run, sql)


def _scored(spark, sf):
    return plan.score_posts(POSTS.df(spark, sf), LEXICON)


def _labels(suffix: str = "") -> str:
    return ", ".join(
        f"count(*) FILTER (WHERE sentiment_label = '{n}') AS {n}{suffix}" for n in ("positive", "negative", "neutral")
    )


_SCORES = "post_id, compound_score, polarity_score, sentiment_score, sentiment_label"

_add(
    "post_sentiment",
    lambda spark, sf: _scored(spark, sf).select(*_SCORES.split(", ")),
    f"SELECT {_SCORES} FROM {BASE}",
)


def _scored_by_table(spark, sf):
    """The same scores from a lexicon kept as a table, joined to the tokens."""
    rows = [(word, valence, polarity) for word, (valence, polarity) in LEXICON.items()]
    lexicon = spark.createDataFrame(rows, "word STRING, valence DOUBLE, polarity DOUBLE")
    return text_fn.with_sentiment_table(POSTS.df(spark, sf), lexicon, "post_id").select(*_SCORES.split(", "))


_add("post_sentiment_from_lexicon_table", _scored_by_table, f"SELECT {_SCORES} FROM {BASE}")

_add(
    "hourly_sentiment_trend",
    lambda spark, sf: plan.hourly_trend(_scored(spark, sf), AS_OF),
    f"""
    SELECT date_trunc('hour', created_utc) AS hour_bucket, subreddit, count(*) AS post_count,
           {rounded(mean('sentiment_score'), 4)} AS avg_sentiment, {_labels()},
           {pct("sentiment_label = 'positive'", 1)} AS positive_pct
    FROM {BASE} WHERE created_utc >= {NOW} - INTERVAL 48 HOUR GROUP BY ALL
    """,
)
_add(
    "top_positive_posts_of_day",
    lambda spark, sf: plan.top_positive(_scored(spark, sf), POST_DAY),
    f"""
    SELECT post_id, subreddit, title, score AS reddit_score, {rounded('s.sentiment_score', 3)} AS sentiment_score,
           num_comments, flair, created_utc
    FROM {BASE} WHERE created_utc >= {DAY} AND created_utc < {DAY} + INTERVAL 1 DAY
      AND sentiment_label = 'positive' AND score >= 50
    ORDER BY s.sentiment_score DESC, post_id LIMIT 20
    """,
)
_add(
    "top_posts_by_label",
    lambda spark, sf: plan.top_by_label(_scored(spark, sf), "negative", 10),
    f"""
    SELECT post_id, title, subreddit, score, sentiment_score FROM {BASE}
    WHERE sentiment_label = 'negative' AND score >= 50 ORDER BY sentiment_score DESC, post_id LIMIT 10
    """,
)
_add(
    "sentiment_by_forum",
    lambda spark, sf: plan.by_forum(_scored(spark, sf), AS_OF),
    f"""
    SELECT subreddit, count(*) AS total_posts, {rounded(mean('sentiment_score'), 4)} AS avg_sentiment,
           {rounded(mean('upvote_ratio') + ' * 100', 1)} AS avg_upvote_pct, {_labels()},
           {pct("sentiment_label = 'positive'", 1)} AS positive_pct,
           {pct("sentiment_label = 'negative'", 1)} AS negative_pct
    FROM {BASE} WHERE created_utc >= {NOW} - INTERVAL 7 DAY GROUP BY subreddit
    """,
)
_add(
    "forum_summary",
    lambda spark, sf: plan.forum_summary(_scored(spark, sf)),
    f"""
    SELECT subreddit, count(*) AS total_posts, {mean('sentiment_score')} AS avg_sentiment, {_labels('_count')},
           {mean('score')} AS avg_score, {mean('num_comments')} AS avg_comments,
           {pct("sentiment_label = 'positive'")} AS positive_pct
    FROM {BASE} GROUP BY subreddit
    """,
)
_add(
    "controversial_posts",
    lambda spark, sf: plan.controversial(_scored(spark, sf), AS_OF),
    f"""
    SELECT post_id, subreddit, title, score, num_comments, {rounded('s.sentiment_score', 3)} AS sentiment_score,
           {rounded('upvote_ratio * 100', 1)} AS upvote_pct, created_utc
    FROM {BASE} WHERE created_utc >= {NOW} - INTERVAL 7 DAY AND sentiment_label = 'negative'
      AND num_comments >= 50 AND score >= 100
    ORDER BY num_comments DESC, post_id LIMIT 15
    """,
)

_add(
    "rolling_sentiment_7d",
    lambda spark, sf: plan.rolling_sentiment(_scored(spark, sf), AS_OF),
    f"""
    WITH d AS (
        SELECT CAST(created_utc AS DATE) AS post_date, subreddit, {mean('sentiment_score')} AS m
        FROM {BASE} WHERE created_utc >= {NOW} - INTERVAL 30 DAY GROUP BY ALL)
    SELECT post_date, subreddit, {rounded('m', 4)} AS daily_avg,
           {rounded(mean('m', ' OVER w'), 4)} AS rolling_7d_avg
    FROM d
    WINDOW w AS (PARTITION BY subreddit ORDER BY post_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
    """,
)


def _daily_table(spark, sf):
    """Dashboard table partitioned by day, written and read back."""
    path = new_folder(spark, "forum-daily")
    write_files(plan.daily_aggregates(_scored(spark, sf), AS_OF), path, ["post_date"], ["subreddit"])
    return spark.read.parquet(path)


_add(
    "forum_daily_table",
    _daily_table,
    f"""
    SELECT CAST(created_utc AS DATE) AS post_date, subreddit, count(*) AS total_posts,
           {rounded(mean('sentiment_score'), 4)} AS avg_sentiment,
           {rounded(mean('score'), 2)} AS avg_reddit_score, {_labels('_count')},
           {pct("sentiment_label = 'positive'", 2)} AS positive_pct
    FROM {BASE} WHERE created_utc >= {NOW} - INTERVAL 30 DAY GROUP BY ALL
    """,
)
_add(
    "hourly_sentiment_documents",
    lambda spark, sf: plan.hourly_documents(_scored(spark, sf), AS_OF),
    f"""
    SELECT strftime(ingested_at, '%Y-%m-%dT%H:00:00Z') AS hour, subreddit, count(*) AS post_count,
           {mean('sentiment_score')} AS avg_sentiment
    FROM {BASE} WHERE ingested_at >= {NOW} - INTERVAL 24 HOUR GROUP BY ALL
    """,
)
_add(
    "label_quality_gate",
    lambda spark, sf: quality.label_quality(_scored(spark, sf), POST_DAY),
    f"""
    SELECT *, CASE WHEN null_labels / nullif(total, 0) > 0.05 THEN 'unlabelled' ELSE 'ok' END AS verdict
    FROM (
        SELECT count(*) AS total, count(*) FILTER (WHERE sentiment_label IS NULL) AS null_labels,
               {rounded(mean('sentiment_score'), 4)} AS avg_score, {_labels('_count')}
        FROM {BASE} WHERE ingested_at >= {DAY} AND ingested_at < {DAY} + INTERVAL 1 DAY)
    """,
)
_add(
    "post_health_metrics",
    lambda spark, sf: quality.post_health(_scored(spark, sf), "2024-01-15 00:40:00"),
    f"""
    SELECT 'Last ingestion' AS metric, CAST(max(ingested_at) AS VARCHAR) AS value FROM {BASE}
    UNION ALL SELECT 'Posts last hour', CAST(count(*) AS VARCHAR) FROM {BASE}
        WHERE ingested_at >= TIMESTAMP '2024-01-14 23:40:00'
    UNION ALL SELECT 'Total posts today', CAST(count(*) AS VARCHAR) FROM {BASE}
        WHERE CAST(ingested_at AS DATE) = DATE '2024-01-15'
    UNION ALL SELECT 'Null sentiment labels', CAST(count(*) FILTER (WHERE sentiment_label IS NULL) AS VARCHAR)
        FROM {BASE} WHERE CAST(ingested_at AS DATE) = DATE '2024-01-15'
    """,
)



def _vowel_share(text):
    """A scorer as a caller would bring it: share of vowels minus one half."""
    return F.length(F.regexp_replace(text, "[^aeiou]", "")) / F.length(text) - 0.5


_VOWELS = (
    "CAST(length(regexp_replace(t, '[^aeiou]', '', 'g')) AS DOUBLE) / CAST(length(t) AS DOUBLE) - CAST(0.5 AS DOUBLE)"
)
_add(
    "post_sentiment_from_external_scorer",
    lambda spark, sf: text_fn.with_external_sentiment(POSTS.df(spark, sf), _vowel_share).select(
        "post_id", "sentiment_score", "sentiment_label"
    ),
    f"""
    SELECT post_id, {rounded('x', 4)} AS sentiment_score,
           CASE WHEN x >= CAST(0.05 AS DOUBLE) THEN 'positive' WHEN x <= CAST(-0.05 AS DOUBLE) THEN 'negative'
                ELSE 'neutral' END AS sentiment_label
    FROM (SELECT post_id, {_VOWELS} AS x FROM (SELECT post_id, trim(title || ' ' || body) AS t FROM ({POSTS.sql})))
    """,
)

# -- text ------------------------------------------------------------------------------


def _dirty():
    """Posts with placeholders, links, symbols and long blanks around the whole text."""
    link = F.concat(F.lit("see http://x.example/"), F.col("doc_id"), F.lit("?a=1&b=é now ☃ \t  "))
    body = F.when(F.col("doc_id") % 10 == 0, "[removed]").when(F.col("doc_id") % 10 == 1, "[deleted]")
    return body.when(F.col("doc_id") % 10 == 2, None).otherwise(F.concat(link, F.col("text")))


_DIRTY_SQL = """
    SELECT doc_id, CASE doc_id % 10 WHEN 0 THEN '[removed]' WHEN 1 THEN '[deleted]' WHEN 2 THEN NULL
           ELSE 'see http://x.example/' || doc_id || '?a=1&b=é now ☃ ' || chr(9) || '  ' || text END AS body
    FROM documents
"""

_add(
    "cleaned_text",
    lambda spark, sf: table(spark, sf, "documents")
    .select("doc_id", _dirty().alias("body"))
    .select("doc_id", text_fn.clean("body").alias("cleaned")),
    f"""
    SELECT doc_id, CASE WHEN body IS NULL OR body IN ('[removed]', '[deleted]') THEN '' ELSE
           trim(regexp_replace(regexp_replace(regexp_replace(body, 'http[^\\s\\p{{Z}}]+', '', 'g'),
                '[^\\p{{L}}\\p{{N}}_\\s\\p{{Z}}.,!?-]', ' ', 'g'), '[\\s\\p{{Z}}]+', ' ', 'g')) END AS cleaned
    FROM ({_DIRTY_SQL})
    """,
)
_add(
    "titled_excerpts",
    lambda spark, sf: table(spark, sf, "documents").select(
        "doc_id",
        text_fn.excerpt(text_fn.joined_text("source", "text"), 500).alias("excerpt"),
        F.length(text_fn.joined_text("source", F.when(F.col("doc_id") % 2 == 0, F.col("text")))).cast("bigint").alias(
            "whole_length"
        ),
        F.upper("source").alias("label"),
        F.concat_ws(",", "lang", "source", F.lit(None)).alias("topics"),
    ),
    """
    SELECT doc_id, substr(trim(source || ' ' || text), 1, 500) AS excerpt,
           length(trim(source || ' ' || CASE WHEN doc_id % 2 = 0 THEN text ELSE '' END)) AS whole_length,
           upper(source) AS label, lang || ',' || source AS topics
    FROM documents
    """,
)

# -- upserts -----------------------------------------------------------------------------

_STORED = ["post_id", "subreddit", "score", "flair", "num_comments"]
_STORED_SQL = f"SELECT {', '.join(_STORED)} FROM ({POSTS.sql})"

# Updates as the labels table gives them: a new score, a flair for some, other fields missing.
LABEL_UPDATES = View(
    """
    SELECT CAST(doc_id AS STRING) AS post_id, CAST(quality + 1000 AS INT) AS score,
           CASE WHEN toxic = 1 THEN 'toxic' END AS flair, CAST(doc_id AS STRING) AS version
    FROM {labels}
    """,
    ("labels",),
)


def _stored(spark, sf):
    return POSTS.df(spark, sf).select(*_STORED)


def _upsert_sql(base: str, new: str, flair: str) -> str:
    return f"""
    SELECT coalesce(b.post_id, u.post_id) AS post_id, {'b' if 'subreddit' in base else 'u'}.subreddit,
           coalesce(u.score, b.score) AS score, {flair} AS flair,
           {'b' if 'subreddit' in base else 'u'}.num_comments, {'u' if 'subreddit' in base else 'b'}.version
    FROM ({base}) b FULL JOIN ({new}) u ON b.post_id = u.post_id
    """


_add(
    "posts_upserted_by_field",
    lambda spark, sf: merge.upsert(_stored(spark, sf), LABEL_UPDATES.df(spark, sf), ["post_id"]),
    _upsert_sql(_STORED_SQL, LABEL_UPDATES.sql, "coalesce(u.flair, b.flair)"),
)
_add(
    "posts_upserted_with_nulls",
    lambda spark, sf: merge.upsert(
        _stored(spark, sf), LABEL_UPDATES.df(spark, sf), ["post_id"], null_overwrites=True
    ),
    _upsert_sql(
        _STORED_SQL, LABEL_UPDATES.sql, "CASE WHEN u.post_id IS NOT NULL THEN u.flair ELSE b.flair END"
    ),
)


def _merged_folder(spark, sf):
    """The labelled posts stored in a bucketed folder, then all posts merged in, twice (a replay)."""
    path = new_folder(spark, "posts")
    empty = {"subreddit": F.lit(None).cast("string"), "num_comments": F.lit(None).cast("int")}
    merge.merge_into(
        spark, path, LABEL_UPDATES.df(spark, sf).withColumns(empty), ["post_id"], ["version"], buckets=8
    )
    for _ in range(2):
        merge.merge_into(spark, path, _stored(spark, sf), ["post_id"], ["score"], buckets=8)
    return spark.read.parquet(path).drop(merge.BUCKET)


_add(
    "posts_merged_into_folder",
    _merged_folder,
    _upsert_sql(LABEL_UPDATES.sql, _STORED_SQL, "coalesce(u.flair, b.flair)"),
)


def _inserted(spark, sf):
    """Every post comes three times, the later ones changed, and some without a key."""
    posts = _stored(spark, sf).withColumn("attempt", F.explode(F.array(*map(F.lit, (1, 2, 3)))))
    posts = posts.withColumns({
        "score": F.when(F.col("attempt") == 1, F.col("score")).otherwise(F.lit(-1)),
        "post_id": F.when((F.col("attempt") != 3) | (F.col("num_comments") % 2 == 0), F.col("post_id")),
    })
    return merge.insert_absent(LABEL_UPDATES.df(spark, sf), posts, ["post_id"], ["attempt"]).drop("attempt")


_add(
    "posts_inserted_if_absent",
    _inserted,
    f"{_STORED_SQL} WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)


def _moved_days(spark, sf):
    """Posts stored by day; updates of all of them name another day, or none."""
    path = new_folder(spark, "moved-days")
    posts = _stored(spark, sf).withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), F.col("num_comments") % 9))
    merge.merge_into(spark, path, posts.withColumn("version", F.lit(1)), ["post_id"], ["version"], slice_by="day")
    moved = F.when(F.col("score") % 2 == 0, F.date_add("day", 1))
    updates = posts.withColumns({"version": F.lit(2), "score": F.col("score") + 1000, "day": moved})
    merge.merge_into(spark, path, updates, ["post_id"], ["version"], slice_by="day")
    return spark.read.parquet(path)


_add(
    "posts_upserted_moved_day",
    _moved_days,
    f"""
    SELECT post_id, subreddit, CAST(score + 1000 AS INT) AS score, flair, num_comments, CAST(2 AS INT) AS version,
           CAST(DATE '2024-01-01' + CAST(num_comments % 9 AS INT) AS DATE) AS day
    FROM ({_STORED_SQL})
    """,
)
