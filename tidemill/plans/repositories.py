"""Code repositories: features and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.numeric import ratio, weighted
from tidemill.functions.sums import mean
from tidemill.functions.time import age_days, clock, parse_time
from tidemill.operators.dedup import latest_per_key
from tidemill.operators.rollups import rollup

# Weights of the activity score.
ACTIVITY = [("stars", 0.5), ("forks", 0.3), ("watchers", 0.2)]


def repository_features(repos: DataFrame, as_of, young_age: str = "floor") -> DataFrame:
    """Latest row per repository with stars, its age, rate and activity score.

    ``young_age`` handles a repository created today: ``floor`` divides by at
    least one day (4 digits), ``shift`` divides by the age plus one (2 digits).
    """
    latest = latest_per_key(repos, ["repo_id"], ["ingested_at", "batch_date"])
    age = F.col("repo_age_days")
    if young_age == "floor":
        rate = F.round(ratio("stars", F.greatest(age, F.lit(1))), 4)
    else:
        rate = F.round(ratio("stars", age + 1), 2)
    return (
        latest.where(F.col("stars") > 0)
        .withColumns({name: parse_time(name) for name in ("created_at", "updated_at", "pushed_at")
                      if name in repos.columns})
        .withColumn("language", F.lower(F.trim("language")))
        .withColumn("license", F.coalesce("license", F.lit("UNLICENSED")))
        .withColumn("repo_age_days", age_days("created_at", as_of))
        .withColumn("activity_score", F.round(weighted(ACTIVITY), 2))
        .withColumn("stars_per_day", rate)
        .withColumn("batch_date", clock(as_of).cast("date"))
    )


def top_by_language(features: DataFrame, batch_date) -> DataFrame:
    """Repository counts and scores per language of one batch."""
    return rollup(
        features.where(F.col("batch_date") == F.lit(batch_date).cast("date")),
        ["language"],
        repo_count=F.count(F.lit(1)),
        avg_stars=F.round(mean("stars"), 0),
        avg_stars_per_day=F.round(mean("stars_per_day"), 2),
        avg_activity_score=F.round(mean("activity_score"), 2),
        max_stars=F.max("stars"),
        unlicensed_count=F.count_if(F.col("license") == "UNLICENSED"),
    ).orderBy(F.col("avg_activity_score").desc_nulls_first(), "language")


def ingested_over_time(features: DataFrame) -> DataFrame:
    return rollup(
        features,
        ["batch_date", "language"],
        repos_ingested=F.count(F.lit(1)),
        avg_stars=F.round(mean("stars"), 0),
    ).orderBy(F.col("batch_date").desc(), F.col("repos_ingested").desc(), "language")
