"""Repository activity, language shares, ratings and rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import two_decimals
from ..functions.values import CODE_EVENTS, ISSUES, METRIC_COLUMNS, METRICS, PULL_REQUEST, PUSH, TOP, WATCH


def repo_activity(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per repository with the six metrics; null is absent, 0 is present with nothing.

    Rows are first summed by (repository, actor), which makes the distinct actors of a repository a plain count: no
    group ever holds the actors of a flooded repository.
    """
    counted = lambda kind: F.sum(F.when(F.col("event_type") == kind, F.col("count")))
    each = df.groupBy(*keys, "repo", "actor").agg(
        counted(PULL_REQUEST).alias("pr_count"),
        counted(ISSUES).alias("issue_count"),
        counted(PUSH).alias("push_count"),
        counted(WATCH).alias("star_count"),
        F.max(F.when(F.col("event_type").isin(*CODE_EVENTS), F.lit(1).cast("long"))).alias("coder"),
    )
    return each.groupBy(*keys, "repo").agg(
        *(F.sum(c).alias(c) for c in ("pr_count", "issue_count", "push_count", "star_count")),
        F.sum("coder").alias("dev_actors"),
        F.max("coder").alias("active"),
    )


def language_shares(languages: DataFrame, primary: bool = False) -> DataFrame:
    """(repo, language, share): sizes over total_size, which isn't the sum of the listed ones; of a total of 0 the first language has all.

    primary: the first language has all, whatever the sizes.
    """
    each = languages.select("repo", "total_size", F.posexplode("languages").alias("pos", "l"))
    if primary:
        return each.where("pos = 0").select("repo", F.col("l.language").alias("language"), F.lit(1.0).alias("share"))
    share = F.when(F.col("total_size") > 0, F.col("l.size") / F.col("total_size")).when(F.col("pos") == 0, 1.0)
    return each.select("repo", F.col("l.language").alias("language"), share.alias("share")).where("share IS NOT NULL")


#: Sums are of whole multiples of 2^-SHARE_BITS, which are the same in any order.
SHARE_BITS = 60


def _whole_share() -> Column:
    """The share as a whole number of 2^-SHARE_BITS, rounded down: exact for shares of 2^-8 and more."""
    whole = F.floor("share")
    unit = F.lit(1 << SHARE_BITS).cast("decimal(19,0)")
    return (whole.cast("decimal(19,0)") * unit + F.floor((F.col("share") - whole) * float(1 << SHARE_BITS)).cast("decimal(19,0)")).cast("decimal(38,0)")


def compute_ratings(activity: DataFrame, shares: DataFrame, keys: Sequence[str] = (), suffix: str = "") -> DataFrame:
    """(keys, metric, language, rating): the sum of value times share; all six metrics from one join.

    A language appears in a metric if a repository with that metric has it, with 0.0 if all its counts are 0. The sums
    are exact, so no order of rows, and no number of partitions, changes a bit of them.
    """
    term = lambda m: F.col(METRIC_COLUMNS[m]).cast("decimal(19,0)") * F.col("whole_")
    unit = float(1 << SHARE_BITS)
    joined = activity.join(shares, "repo").withColumn("whole_", _whole_share())
    sums = joined.groupBy(*keys, "language").agg(*((F.sum(term(m)).cast("double") / unit).alias(m + suffix) for m in METRICS))
    return sums.unpivot([*keys, "language"], [m + suffix for m in METRICS], "metric", "rating").where("rating IS NOT NULL")


def match_coverage(activity: DataFrame, languages: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, metric, matched, unmatched): repositories with the metric, with and without language data; an empty list is data."""
    known = languages.select("repo", F.lit(True).alias("known")).distinct()
    joined = activity.join(known, "repo", "left")
    count = lambda m, there: F.count(F.when(F.col(METRIC_COLUMNS[m]).isNotNull() & there, 1))
    known_one = F.coalesce("known", F.lit(False))
    wide = joined.groupBy(*keys).agg(*(F.struct(count(m, known_one).alias("matched"), count(m, ~known_one).alias("unmatched")).alias(m) for m in METRICS))
    return wide.unpivot(list(keys), list(METRICS), "metric", "n").select(*keys, "metric", "n.matched", "n.unmatched")


def finalize_ratings(ratings: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """ratings with rating at two decimals and percentage: the rounded rating over the total of the unrounded ones."""
    # one row per language; in their order, so that the sum's last bits are the same each time
    total = F.sum("rating").over(Window.partitionBy(*keys, "metric").orderBy("language").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rounded = ratings.withColumn("total", total).withColumn("raw", F.col("rating")).withColumn("rating", two_decimals(F.col("rating")))
    return rounded.withColumn("percentage", F.when(F.col("total") > 0, F.round(F.col("rating") / F.col("total") * 10_000, 0) / 100).otherwise(0.0)).drop("total")


def rank_ratings(ratings: DataFrame, keys: Sequence[str] = (), by: str = "rating") -> DataFrame:
    """ratings with rank: by unrounded rating from the highest, then by language."""
    return ratings.withColumn("rank", F.row_number().over(Window.partitionBy(*keys, "metric").orderBy(F.desc(by), "language")))


def rated(activity: DataFrame, shares: DataFrame, keys: Sequence[str] = (), suffix: str = "") -> DataFrame:
    """(keys, metric, rank, language, rating, percentage): ratings, finished and ranked."""
    done = rank_ratings(finalize_ratings(compute_ratings(activity, shares, keys, suffix), keys), keys, "raw")
    return done.select(*keys, "metric", "rank", "language", "rating", "percentage")


def primary_ratings(activity: DataFrame, languages: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Ratings where the whole count goes to a repository's largest language; metrics end in -primary."""
    return rated(activity, language_shares(languages, primary=True), keys, "-primary")


def one_decimal(x: Column) -> Column:
    return F.round(x * 10, 0) / 10


def compare_rankings(a: DataFrame, b: DataFrame, n: int = TOP, keys: Sequence[str] = ()) -> DataFrame:
    """The top n of two rankings of (keys, language, rating) side by side, for each value of keys (a month, say) in one job.

    status: both; dropped, if only a's top n has the language; enters, if only b's has it. rank and rating_a are a's,
    rating_b is b's; what a side doesn't show is null, and so are the deltas.
    """
    by = Window.partitionBy(*keys).orderBy(F.desc("rating"), "language")  # a few hundred languages
    top = lambda df, side: df.select(*keys, "language", "rating").withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= n).select(*keys, "language", F.col("rating").alias(f"rating_{side}"), F.col("rank").alias(f"rank_{side}"))
    both = top(a, "a").join(top(b, "b"), [*keys, "language"], "full_outer")
    status = F.when(F.col("rank_b").isNull(), "dropped").when(F.col("rank_a").isNull(), "enters").otherwise("both")
    delta = F.when(F.col("rating_a") != 0, (F.col("rating_b") - F.col("rating_a")) / F.col("rating_a") * 100)
    return both.select(*keys, F.col("rank_a").alias("rank"), "language", "rating_a", "rating_b", (F.col("rank_a") - F.col("rank_b")).alias("rank_delta"), one_decimal(delta).alias("rating_delta_pct"), status.alias("status"))
