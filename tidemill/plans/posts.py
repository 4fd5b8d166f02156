"""Forum posts: decoding, scoring, sentiment reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill import schemas
from tidemill.functions.numeric import percent, share_pct
from tidemill.functions.records import decode, flatten_key
from tidemill.functions.sums import mean
from tidemill.functions.text import with_sentiment
from tidemill.functions.time import hour_of, iso_hour, on_day, since, since_day
from tidemill.operators.ranking import top
from tidemill.operators.rollups import rollup
from tidemill.operators.series import moving_average

LABELS = ["positive", "negative", "neutral"]

# Fields of the stored sentiment document.
SENTIMENT_FIELDS = [
    "post_id", "subreddit", "compound_score", "polarity_score", "sentiment_score", "sentiment_label",
    "score", "created_utc",
]


def decode_posts(log: DataFrame) -> DataFrame:
    return decode(log, schemas.FORUM_POST).where(F.col("post_id").isNotNull())


def score_posts(posts: DataFrame, lexicon: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Posts with sentiment columns; stateless, the same for batch and stream."""
    return with_sentiment(posts, lexicon)


def _label_is(name: str) -> Column:
    return F.col("sentiment_label") == name


def _label_counts(suffix: str = "") -> dict[str, Column]:
    return {name + suffix: F.count_if(_label_is(name)) for name in LABELS}


def hourly_trend(posts: DataFrame, as_of, hours: int = 48) -> DataFrame:
    return rollup(
        posts.where(since("created_utc", as_of, f"{hours} HOUR")),
        [hour_of("created_utc").alias("hour_bucket"), "subreddit"],
        post_count=F.count(F.lit(1)),
        avg_sentiment=F.round(mean("sentiment_score"), 4),
        **_label_counts(),
        positive_pct=share_pct(_label_is("positive"), 1),
    ).orderBy(F.col("hour_bucket").desc(), "subreddit")


def top_positive(posts: DataFrame, as_of, k: int = 20, min_score: int = 50) -> DataFrame:
    """The day's most positive posts with enough votes."""
    chosen = posts.where(
        on_day("created_utc", as_of) & _label_is("positive") & (F.col("score") >= min_score)
    )
    best = top(chosen, k, F.col("sentiment_score").desc(), "post_id")
    return best.select(
        "post_id", "subreddit", "title", F.col("score").alias("reddit_score"),
        F.round("sentiment_score", 3).alias("sentiment_score"), "num_comments", "flair", "created_utc",
    )


def top_by_label(posts: DataFrame, name: str = "positive", k: int = 10, min_score: int = 50) -> DataFrame:
    chosen = posts.where(_label_is(name) & (F.col("score") >= min_score))
    best = top(chosen, k, F.col("sentiment_score").desc(), "post_id")
    return best.select("post_id", "title", "subreddit", "score", "sentiment_score")


def by_forum(posts: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Sentiment distribution per forum over the last days."""
    return rollup(
        posts.where(since("created_utc", as_of, f"{days} DAY")),
        ["subreddit"],
        total_posts=F.count(F.lit(1)),
        avg_sentiment=F.round(mean("sentiment_score"), 4),
        avg_upvote_pct=F.round(mean("upvote_ratio") * 100, 1),
        **_label_counts(),
        positive_pct=share_pct(_label_is("positive"), 1),
        negative_pct=share_pct(_label_is("negative"), 1),
    ).orderBy(F.col("avg_sentiment").desc(), "subreddit")


def forum_summary(posts: DataFrame) -> DataFrame:
    """Unrounded summary per forum over everything stored."""
    counts = rollup(
        posts,
        ["subreddit"],
        total_posts=F.count(F.lit(1)),
        avg_sentiment=mean("sentiment_score"),
        **_label_counts("_count"),
        avg_score=mean("score"),
        avg_comments=mean("num_comments"),
    )
    return counts.withColumn("positive_pct", percent("positive_count", "total_posts")).orderBy(
        F.col("avg_sentiment").desc_nulls_last(), "subreddit"
    )


def controversial(
    posts: DataFrame, as_of, k: int = 15, days: int = 7, min_comments: int = 50, min_score: int = 100
) -> DataFrame:
    """Negative posts that drew many comments and votes."""
    chosen = posts.where(
        since_day("created_utc", as_of, days)
        & _label_is("negative")
        & (F.col("num_comments") >= min_comments)
        & (F.col("score") >= min_score)
    )
    most = top(chosen, k, F.col("num_comments").desc(), "post_id")
    return most.select(
        "post_id", "subreddit", "title", "score", "num_comments",
        F.round("sentiment_score", 3).alias("sentiment_score"),
        F.round(F.col("upvote_ratio") * 100, 1).alias("upvote_pct"), "created_utc",
    )


def rolling_sentiment(posts: DataFrame, as_of, days: int = 30, rows: int = 7) -> DataFrame:
    """Daily mean per forum and its rolling mean; the window runs over days."""
    daily = rollup(
        posts.where(since("created_utc", as_of, f"{days} DAY")),
        [F.to_date("created_utc").alias("post_date"), "subreddit"],
        daily_mean=mean("sentiment_score"),
    )
    rolling = moving_average("daily_mean", "subreddit", "post_date", rows)
    return daily.withColumn("rolling", rolling).select(
        "post_date", "subreddit",
        F.round("daily_mean", 4).alias("daily_avg"), F.round("rolling", 4).alias("rolling_7d_avg"),
    ).orderBy("subreddit", F.col("post_date").desc())


def daily_aggregates(posts: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Dashboard table per day and forum."""
    return rollup(
        posts.where(since_day("created_utc", as_of, days)),
        [F.to_date("created_utc").alias("post_date"), "subreddit"],
        total_posts=F.count(F.lit(1)),
        avg_sentiment=F.round(mean("sentiment_score"), 4),
        avg_reddit_score=F.round(mean("score"), 2),
        **_label_counts("_count"),
        positive_pct=share_pct(_label_is("positive"), 2),
    )


def hourly_documents(posts: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """Document-store trend: the group key is a nested document, then flattened."""
    recent = posts.where(since("ingested_at", as_of, f"{hours} HOUR"))
    key = F.struct(iso_hour("ingested_at").alias("hour"), F.col("subreddit").alias("subreddit"))
    grouped = rollup(
        recent.withColumn("_id", key), ["_id"],
        post_count=F.count(F.lit(1)), avg_sentiment=mean("sentiment_score"),
    )
    return flatten_key(grouped, "_id").orderBy("hour", "subreddit")
