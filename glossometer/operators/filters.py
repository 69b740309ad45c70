"""De-noising filters over archive rows.

Each filter works alone; Tagged applies all nine in order, in three phases, and filter_archive and filter_report read its
tags. keys (a month, say) are prefixed to every group, so that many months run in one job.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import is_automation, is_bot, is_deleted_repo
from ..functions.values import ACTOR_EVENT_LIMIT, CODE_EVENTS, ISSUES, PASSIVE_EVENTS, REPO_ISSUE_LIMIT
from ..sources.scratch import broadcast_if_small, removed, scratch, staged


def _code() -> Column:
    return F.col("event_type").isin(*CODE_EVENTS)


def _passive() -> Column:
    return F.col("event_type").isin(*PASSIVE_EVENTS)


def _issue() -> Column:
    return F.col("event_type") == ISSUES


def _human() -> Column:
    return ~is_bot(F.col("actor")) & ~is_automation(F.col("actor"))


#: A key with more rows than this is hot. There are at most (rows / HOT_ROWS) of them, so their facts may be broadcast.
HOT_ROWS = 1_000_000


def _name(c: str) -> Column:
    return F.col(f"`{c}`")


def with_facts(df: DataFrame, by: Sequence[str], hot_rows: int | None = HOT_ROWS, ahead: bool = True, **facts: Column) -> DataFrame:
    """df with columns of facts (aggregates) about each row's group by `by`.

    The aggregate is reduced before its shuffle, so it has no hot task. The join back would have one for each key that many
    rows share; here the facts of hot keys are broadcast, and their rows go through the shuffled join under spread keys
    that match nothing. by ends in the column whose keys are spread, a text. Names of facts mustn't be columns of df.

    ahead: the facts are written first, so that df occurs once in the result's plan and a chain of such steps stays
    linear. Else the plan holds df three times, but the facts are shuffled once only.

    hot_rows None: a plain join by the group, without hot keys. Where df is a table in buckets of the last of `by`
    (writers.store_archive), neither the aggregate nor the join then shuffles anything.
    """
    *keys, last = by
    found = df.groupBy(*by).agg(F.count("*").alias("rows_"), *(f.alias(name) for name, f in facts.items()))
    found = staged(found) if ahead else found
    if hot_rows is None:
        own = found.select(*(_name(c).alias(f"key{i}_") for i, c in enumerate(by)), *facts)
        joined = df.join(own, reduce(and_, (_name(c) == F.col(f"key{i}_") for i, c in enumerate(by))), "left")
        return joined.select(*map(_name, df.columns), *facts)
    sides = {"hot": found.where(F.col("rows_") > hot_rows), "cold": found.where(F.col("rows_") <= hot_rows)}
    for side, x in sides.items():
        sides[side] = x.select(*(_name(c).alias(f"{side}_key{i}_") for i, c in enumerate(by)), F.struct(*facts).alias(f"{side}_"))
    same = lambda side, own: reduce(and_, (o == F.col(f"{side}_key{i}_") for i, o in enumerate(own)))
    warm = df.join(F.broadcast(sides["hot"]), same("hot", map(_name, by)), "left")
    spread = F.concat(F.lit("\0"), F.xxhash64(*map(_name, df.columns)).cast("string"))
    warm = warm.withColumn("spread_", F.when(F.col("hot_").isNull(), _name(last)).otherwise(spread))
    joined = warm.join(sides["cold"], same("cold", [*map(_name, keys), F.col("spread_")]), "left")
    fact = F.coalesce("hot_", "cold_")
    return joined.select(*map(_name, df.columns), *(fact[name].alias(name) for name in facts))


def _keep(df: DataFrame, by: str, keys: Sequence[str], agg: Column, kept: Column, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows of the groups for which kept holds on the aggregate x_."""
    return with_facts(df, [*keys, by], hot_rows, x_=agg).where(kept).select(*map(_name, df.columns))


def drop_empty_repos(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Keep repositories with a push or pull request row, whatever its count."""
    return _keep(df, "repo", keys, F.bool_or(_code()), F.col("x_"))


def drop_bots(df: DataFrame) -> DataFrame:
    return df.where(~is_bot(F.col("actor")))


def drop_ci_actors(df: DataFrame) -> DataFrame:
    return df.where(~is_automation(F.col("actor")))


def drop_single_event_repos(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Keep repositories with more than one event; a total of 0 goes too."""
    return _keep(df, "repo", keys, F.sum("count"), F.col("x_") > 1)


def drop_high_volume_actors(df: DataFrame, limit: int = ACTOR_EVENT_LIMIT, keys: Sequence[str] = ()) -> DataFrame:
    """Keep actors with at most `limit` events. The anonymous actor "" is one actor."""
    return _keep(df, "actor", keys, F.sum("count"), F.col("x_") <= limit)


def drop_deleted_repos(df: DataFrame) -> DataFrame:
    return df.where(~is_deleted_repo(F.col("repo")))


def drop_fork_only_actors(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Keep actors with a row other than forks and watches."""
    return _keep(df, "actor", keys, F.bool_or(~_passive()), F.col("x_"))


def drop_issue_flood(df: DataFrame, limit: int = REPO_ISSUE_LIMIT, keys: Sequence[str] = ()) -> DataFrame:
    """Drop the issue rows of repositories with more than `limit` issue events. Other rows aren't shuffled."""
    issues = df.where(_issue())
    return df.where(~_issue()).unionByName(_keep(issues, "repo", keys, F.sum("count"), F.col("x_") <= limit))


def drop_issue_only_actors(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Drop the issue rows of actors without a push or pull request row. Other rows aren't shuffled."""
    issues = with_facts(df.where(_issue() | _code()), [*keys, "actor"], coder_=F.bool_or(_code())).where(_issue() & F.col("coder_"))
    return df.where(~_issue()).unionByName(issues.select(*map(_name, df.columns)))


#: Steps of the report, in order.
STEPS = ("empty_repos", "bots", "ci_actors", "single_event_repos", "high_volume_actors", "deleted_repos", "fork_only_actors", "issue_flood", "issue_only_actors")


class Tagged:
    """An archive with each row's step: the number of the filter that drops it, or null if it stays.

    Three phases, each over what the one before left: by repository (steps 1 to 4), by actor (5 to 7) and by flooded
    repository (8, 9). The first and the fourth step drop whole repositories and those between look at the row only, so one
    aggregate decides all four; the fifth and seventh drop whole actors, the sixth looks at the row only, and the same
    aggregate tells who writes code for the ninth. A phase is one aggregate and one join by the same key, and its rows
    are written once, with their tags; a dropped row keeps its keys and its tag only, if a report is wanted.

    All together, the archive is read twice and there are five shuffles; flooded repositories, found among the rows written last, are
    broadcast if they measure small, else their join is a sixth. placed: df is a table in buckets of its repositories,
    so the first phase shuffles nothing and three shuffles are left; a bucket is then one task, with all its repositories.
    """

    def __init__(self, df: DataFrame, actor_event_limit: int = ACTOR_EVENT_LIMIT, repo_issue_limit: int = REPO_ISSUE_LIMIT, keys: Sequence[str] = (), report: bool = True, hot_rows: int = HOT_ROWS, placed: bool = False):
        self.columns, self.keys, self.report = df.columns, list(keys), report
        actor, repo = F.col("actor"), F.col("repo")
        there = ~is_deleted_repo(repo)
        human = F.coalesce(F.sum(F.when(_human(), F.col("count"))), F.lit(0))
        rows = with_facts(df, [*keys, "repo"], None if placed else hot_rows, False, has_code_=F.bool_or(_code()), human_total_=human)
        first = self._written(rows, (1, ~F.col("has_code_")), (2, is_bot(actor)), (3, is_automation(actor)), (4, F.col("human_total_") <= 1))
        rows = with_facts(self._left(first), [*keys, "actor"], hot_rows, False, total_=F.sum("count"), meaningful_=F.bool_or(there & ~_passive()), coder_=F.bool_or(there & _code()))
        second = self._written(rows, (5, F.col("total_") > actor_event_limit), (6, ~there), (7, ~F.col("meaningful_")), more=["coder_"])
        rows = self._left(second, "coder_")
        flooded = staged(rows.where(_issue()).groupBy(*keys, "repo").agg(F.sum("count").alias("n_")).where(F.col("n_") > repo_issue_limit).select(*(_name(c).alias(f"flooded{i}_") for i, c in enumerate([*keys, "repo"])), F.lit(True).alias("flooded_")))
        same = reduce(and_, (_name(c) == F.col(f"flooded{i}_") for i, c in enumerate([*keys, "repo"])), _issue())
        rows = rows.join(broadcast_if_small(flooded), same, "left")
        last = rows.select(*map(_name, self.columns), self._step((8, F.coalesce("flooded_", F.lit(False))), (9, _issue() & ~F.col("coder_"))))
        #: Rows with step_ by phase: all that a phase has looked at, or those that it keeps if no report is wanted.
        self.phases = [first, second, last]

    @staticmethod
    def _step(*cases: tuple[int, Column]) -> Column:
        return F.coalesce(*(F.when(F.coalesce(case, F.lit(True)), step) for step, case in cases)).alias("step_")

    def _written(self, rows: DataFrame, *cases: tuple[int, Column], more: Sequence[str] = ()) -> DataFrame:
        tagged = rows.select(*map(_name, self.columns), *more, self._step(*cases))
        if not self.report:
            return staged(tagged.where(F.col("step_").isNull()))
        kept = lambda c: _name(c) if c in self.keys else F.when(F.col("step_").isNull(), _name(c)).alias(c)
        return staged(tagged.select(*map(kept, (*self.columns, *more)), "step_"))

    def _left(self, rows: DataFrame, *more: str) -> DataFrame:
        return rows.where(F.col("step_").isNull()).select(*map(_name, self.columns), *more)

    @property
    def kept(self) -> DataFrame:
        """The archive rows that pass all nine filters."""
        return self._left(self.phases[-1])

    def counts(self) -> DataFrame:
        """(keys, start, removed1 ... removed9): one more aggregate, which reads the tags only."""
        tags = [p.select(*map(_name, self.keys), F.lit(i == 0).alias("starts"), "step_") for i, p in enumerate(self.phases)]
        removed = (F.count(F.when(F.col("step_") == i, 1)).alias(f"removed{i}") for i in range(1, len(STEPS) + 1))
        return reduce(DataFrame.unionByName, tags).groupBy(*map(_name, self.keys)).agg(F.count(F.when(F.col("starts"), 1)).alias("start"), *removed)

    def lines(self) -> DataFrame:
        """The report: (keys, step_no, step, removed, removed_pct, remaining) and a total (step 10)."""
        if not self.report:
            raise ValueError("tagged without a report")
        n = len(STEPS)
        gone = lambda i: sum((F.col(f"removed{j}") for j in range(1, i + 1)), F.lit(0).cast("long"))
        line = lambda i, name, removed, before: F.struct(F.lit(i).alias("step_no"), F.lit(name).alias("step"), removed.alias("removed"), F.when(before > 0, 100.0 * removed / before).otherwise(0.0).alias("removed_pct"), (before - removed).alias("remaining"))
        lines = [line(i, name, F.col(f"removed{i}"), F.col("start") - gone(i - 1)) for i, name in enumerate(STEPS, 1)] + [line(n + 1, "total", gone(n), F.col("start"))]
        return self.counts().select(*map(_name, self.keys), F.explode(F.array(*lines)).alias("line")).select(*map(_name, self.keys), "line.*")


def filter_archive(df: DataFrame, actor_event_limit: int = ACTOR_EVENT_LIMIT, repo_issue_limit: int = REPO_ISSUE_LIMIT, keys: Sequence[str] = (), hot_rows: int = HOT_ROWS, placed: bool = False) -> DataFrame:
    """All nine filters in order, fused: see Tagged. Its phases run when this is called."""
    return Tagged(df, actor_event_limit, repo_issue_limit, keys, False, hot_rows, placed).kept


def filter_with_report(df: DataFrame, actor_event_limit: int = ACTOR_EVENT_LIMIT, repo_issue_limit: int = REPO_ISSUE_LIMIT, keys: Sequence[str] = (), hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(filter_archive, filter_report) from the same tags."""
    tagged = Tagged(df, actor_event_limit, repo_issue_limit, keys, True, hot_rows)
    return tagged.kept, tagged.lines()


def filter_sequentially(df: DataFrame, actor_event_limit: int = ACTOR_EVENT_LIMIT, repo_issue_limit: int = REPO_ISSUE_LIMIT, keys: Sequence[str] = ()) -> DataFrame:
    """The same rows as filter_archive, step by step. All steps but the last run when this is called.

    df is computed once. Each step over groups reads the rows that the one before wrote, which are deleted when its own are
    written: at any time the disk holds the shuffles of one step, its rows before and after, and the facts of the steps so far.
    """
    steps = (
        lambda x: x,
        lambda x: drop_ci_actors(drop_bots(drop_empty_repos(x, keys))),
        lambda x: drop_single_event_repos(x, keys),
        lambda x: drop_deleted_repos(drop_high_volume_actors(x, actor_event_limit, keys)),
        lambda x: drop_fork_only_actors(x, keys),
        lambda x: drop_issue_flood(x, repo_issue_limit, keys),
    )
    spark, folder = df.sparkSession, None
    for step in steps:
        before, folder = folder, scratch(spark)
        df = staged(step(df), folder)
        if before:
            removed(spark, before)
    return drop_issue_only_actors(df, keys)


def filter_report(df: DataFrame, actor_event_limit: int = ACTOR_EVENT_LIMIT, repo_issue_limit: int = REPO_ISSUE_LIMIT, keys: Sequence[str] = (), hot_rows: int = HOT_ROWS) -> DataFrame:
    """(keys, step_no, step, removed, removed_pct, remaining): what each filter removes of what reaches it, and a total (step 10).

    Percentages of nothing are 0.0. An empty input gives all ten rows with 0; with keys there are ten rows for each of
    their values that occurs.
    """
    return Tagged(df, actor_event_limit, repo_issue_limit, keys, True, hot_rows).lines()
