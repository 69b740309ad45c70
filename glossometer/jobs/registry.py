"""Every relational query by name, with the SQL that gives the same rows.

Limits are those of the test tables' size: 1000 events an actor, 100 issues a repository.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import metric_name, normalize_repo, year_month_from_name
from ..functions.values import AUTOMATION, METRIC_COLUMNS, METRICS
from ..operators import events, filters, languages, pack, ratings
from ..sources import readers, writers
from ..sources.scratch import scratch, staged
from . import adapters
from .adapters import ARCHIVE_SQL, EXTRACTED_SQL, HOURS_SQL, LANGUAGES_SQL, MONTHLY_SQL, SLUG_COUNTS_SQL, SLUGS_SQL, archive

ACTORS, ISSUES = 1000, 100
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, and its SQL if there is any."""

    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


# ---- sources and scalars

def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


@query(
    "s2_missing_hours",
    """
WITH e AS (SELECT date_trunc('month', min(ts)) AS first FROM events), h AS (SELECT unnest(range(first, first + INTERVAL 1 MONTH, INTERVAL 1 HOUR)) AS hour, first FROM e),
i AS (SELECT hour, datediff('hour', first, hour) + 1 AS idx, strftime(hour, '%Y-%m-%d-') || hour(hour) || '.json.gz' AS name FROM h)
SELECT idx, name FROM i WHERE hour NOT IN (SELECT date_trunc('hour', ts) FROM events)
""",
)
def missing_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = _days(spark, sf_dir).agg(F.min("ts")).first()[0]
    present = _days(spark, sf_dir).select(F.concat(F.date_format("ts", "yyyy-MM-dd-H"), F.lit(".json.gz")).alias("name")).distinct()
    return readers.missing_hours(readers.hour_index(spark, first.year, first.month), present)


@query(
    "s1_hour_index",
    """
WITH e AS (SELECT date_trunc('month', min(ts)) AS first FROM events), h AS (SELECT unnest(range(first, first + INTERVAL 1 MONTH, INTERVAL 1 HOUR)) AS hour, first FROM e)
SELECT CAST(datediff('hour', first, hour) + 1 AS INTEGER) AS idx, strftime(hour, '%Y-%m-%d-') || hour(hour) || '.json.gz' AS name FROM h
""",
)
def hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly files of the month in which the events begin."""
    first = _days(spark, sf_dir).agg(F.min("ts")).first()[0]
    return readers.hour_index(spark, first.year, first.month)


@query("s3_read_events", EXTRACTED_SQL)
def read_back_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event lines written as gzipped text, read as event files and extracted."""
    adapters.event_lines(spark, sf_dir).write.option("compression", "gzip").text(folder := scratch(spark))
    return events.extract_events(readers.read_events(spark, folder))


@query("s2_hour_states", f"{HOURS_SQL} SELECT idx, name, state FROM s WHERE state <> 'ok'")
def hour_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hours of the first month that are absent, empty or damaged."""
    first = _days(spark, sf_dir).agg(F.min("ts")).first()[0]
    return readers.hour_states(readers.hour_index(spark, first.year, first.month), readers.file_ledger(spark, adapters.hour_files(spark, sf_dir)))


@query("s3_file_ledger", f"{HOURS_SQL} SELECT name, state, CASE WHEN state = 'ok' THEN CASE WHEN idx % 5 = 0 THEN 2 * n ELSE n END END AS lines FROM s WHERE state <> 'absent'")
def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of each of the month's files, and the lines of the sound ones."""
    first = _days(spark, sf_dir).agg(F.min("ts")).first()[0]
    files = readers.file_ledger(spark, adapters.hour_files(spark, sf_dir))
    return files.join(readers.hour_index(spark, first.year, first.month), "name", "left_semi").select("name", "state", F.when(F.col("state") == "ok", F.col("lines")).alias("lines"))


@query("x1_extract_events", EXTRACTED_SQL)
def extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.extract_events(adapters.event_lines(spark, sf_dir))


@query("a1_aggregate_events", f"SELECT actor, repo, event_type, action, arg_min(language, {{'a': created_at, 'b': id, 'c': language}}) AS language, count(*) AS count FROM ({EXTRACTED_SQL}) GROUP BY actor, repo, event_type, action")
def aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.aggregate_events(events.extract_events(adapters.event_lines(spark, sf_dir)))


@query("x4_clean_slugs", SLUGS_SQL)
def clean_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.clean_slug_lines(adapters.slug_lines(spark, sf_dir))


@query("x4_slug_counts", SLUG_COUNTS_SQL)
def slug_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.slug_line_counts(adapters.slug_lines(spark, sf_dir))


@query("x3_normalize_repo", r"SELECT page_id, CASE WHEN length(s) - length(replace(s, '/', '')) = 1 THEN s END AS repo FROM (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(url, '^(https://github\.com/|http://github\.com/|github\.com/)', ''), '\.git$', ''), '/+$', '') AS s FROM (SELECT page_id, 'github.com/' || regexp_extract(url, 'https?://([^?#]*)', 1) AS url FROM pages))")
def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", normalize_repo(F.concat(F.lit("github.com/"), F.regexp_extract("url", "https?://([^?#]*)", 1))).alias("repo"))


@query("x5_year_month", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders")
def year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    name = F.concat(F.lit("events-v2-"), F.date_format("o_orderdate", "yyyyMM"), F.lit(".csv"))
    return orders.select("o_orderkey", year_month_from_name(name).alias("month"))


@query("s6_last_languages", "SELECT repo, arg_max(total_size, o) AS total_size, arg_max(language, o) AS language FROM (SELECT 'org/' || user_id AS repo, event_id AS total_size, event_type AS language, event_id AS o FROM events WHERE event_id % 13 <> 0 AND event_id % 17 <> 0) GROUP BY repo")
def last_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last line of each repository wins; lines with a text for a size, or without one, are skipped."""
    e = _days(spark, sf_dir)
    size = F.when(F.col("event_id") % 13 == 0, F.lit('"5"')).when(F.col("event_id") % 17 == 0, F.lit("-3")).otherwise(F.col("event_id").cast("string"))
    line = F.concat(F.lit('{"repo":"org/'), F.col("user_id"), F.lit('","total_size":'), size, F.lit(',"languages":[{"language":"'), F.col("event_type"), F.lit('","size":'), F.lit("1}]}"))
    lines = e.select("event_id", F.concat(F.lit(" "), line, F.lit("\t")).alias("value"))
    return readers.parse_languages(lines, ["event_id"]).select("repo", "total_size", F.get("languages", F.lit(0))["language"].alias("language"))


@query("s5_write_archive", ARCHIVE_SQL)
def written_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive written as CSV and read again."""
    writers.write_archive(archive(spark, sf_dir), folder := scratch(spark))
    return readers.read_archive(spark, folder)[0]


#: Archive rows as CSV lines: quoted actors, counts with a plus sign, and rows that are bad by their count or their width.
_COUNT_KIND = "CASE WHEN count % 7 = 0 THEN 'bad' WHEN count % 11 = 0 THEN 'wide' WHEN count % 13 = 0 THEN 'blank' WHEN count % 5 = 0 THEN 'plus' ELSE 'plain' END"


def _damaged(spark: SparkSession, sf_dir: str) -> str:
    """A folder with such lines."""
    kind = F.expr(_COUNT_KIND)
    count = F.concat(F.when(kind == "bad", F.lit("-")).when(kind == "plus", F.lit("+")).when(kind == "blank", F.lit(" ")).otherwise(F.lit("")), F.col("count").cast("string"), F.when(kind == "wide", F.lit(",more")).otherwise(F.lit("")))
    line = F.concat(F.lit('"'), "actor", F.lit('""x",'), F.concat_ws(",", "repo", "event_type", "action", "language"), F.lit(","), count)
    archive(spark, sf_dir).select(line.alias("value")).write.text(folder := scratch(spark))
    return folder


_DAMAGED = f"SELECT actor || '\"x' AS actor, repo, event_type, action, language, count, {_COUNT_KIND} AS kind FROM ({ARCHIVE_SQL})"


@query("s4_read_archive", f"SELECT actor, repo, event_type, action, language, count FROM ({_DAMAGED}) WHERE kind NOT IN ('bad', 'wide')")
def read_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The good rows; blanks around counts are ignored. No line is a header, so the header option is off for files without one."""
    return readers.read_archive(spark, _damaged(spark, sf_dir), header=False)[0]


@query("s4_bad_rows", f"SELECT count(*) AS n_bad, (SELECT count(*) FROM ({_DAMAGED}) WHERE kind NOT IN ('bad', 'wide', 'blank')) AS n_good FROM ({_DAMAGED}) WHERE kind IN ('bad', 'wide', 'blank')")
def bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows the stricter mode refuses, counted while the good ones are written."""
    rows, seen = readers.read_archive(spark, _damaged(spark, sf_dir), mode="stats", header=False)
    good = staged(rows)
    return good.agg(F.lit(seen.get["n_bad"]).cast("long").alias("n_bad"), F.count("*").alias("n_good"))


@query("s4_quoted_lines", f"SELECT actor || chr(10) || '\"x\",' AS actor, repo, event_type, action, language, count FROM ({ARCHIVE_SQL})")
def quoted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive whose actors hold line breaks, quotes and commas, written as CSV and read again."""
    rows = archive(spark, sf_dir)
    writers.write_archive(rows.withColumn("actor", F.concat("actor", F.lit('\n"x",'))), folder := scratch(spark))
    return readers.read_archive(spark, folder, multi_line=True)[0]


_LISTED = "array_to_string(list_transform(languages, lambda x: x.language || ':' || x.size), ',')"


@query("s7_write_languages", f"SELECT repo, total_size::BIGINT AS total_size, {_LISTED} AS languages FROM ({LANGUAGES_SQL})")
def written_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages written as JSON lines and read again."""
    writers.write_languages(adapters.languages(spark, sf_dir), folder := scratch(spark))
    return readers.read_languages(spark, folder).select("repo", "total_size", F.array_join(F.transform("languages", lambda x: F.concat_ws(":", x["language"], x["size"].cast("string"))), ",").alias("languages"))


# ---- filters

_BOT = "actor ILIKE '%bot%'"
_CI = "(" + " OR ".join(f"contains(lower(actor), '{x}')" for x in AUTOMATION) + ")"
_CODE = "event_type IN ('PushEvent', 'PullRequestEvent')"
_GONE = "([0-9a-f]{40}|[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12})"
_STEPS = {
    "f1_empty_repos": f"SELECT * FROM {{t}} WHERE repo IN (SELECT repo FROM {{t}} WHERE {_CODE})",
    "f2_bots": f"SELECT * FROM {{t}} WHERE NOT {_BOT}",
    "f3_ci_actors": f"SELECT * FROM {{t}} WHERE NOT {_CI}",
    "f4_single_event_repos": "SELECT * FROM {t} WHERE repo IN (SELECT repo FROM {t} GROUP BY repo HAVING sum(count) > 1)",
    "f5_high_volume_actors": f"SELECT * FROM {{t}} WHERE actor IN (SELECT actor FROM {{t}} GROUP BY actor HAVING sum(count) <= {ACTORS})",
    "f6_deleted_repos": f"SELECT * FROM {{t}} WHERE NOT regexp_matches(repo, '^{_GONE}/|^[^/]*/{_GONE}$')",
    "f7_fork_only_actors": "SELECT * FROM {t} WHERE actor IN (SELECT actor FROM {t} WHERE event_type NOT IN ('ForkEvent', 'WatchEvent'))",
    "f8_issue_flood": f"SELECT * FROM {{t}} WHERE event_type <> 'IssuesEvent' OR repo NOT IN (SELECT repo FROM {{t}} WHERE event_type = 'IssuesEvent' GROUP BY repo HAVING sum(count) > {ISSUES})",
    "f9_issue_only_actors": f"SELECT * FROM {{t}} WHERE event_type <> 'IssuesEvent' OR actor IN (SELECT actor FROM {{t}} WHERE {_CODE})",
}
_FILTERS = {
    "f1_empty_repos": filters.drop_empty_repos,
    "f2_bots": filters.drop_bots,
    "f3_ci_actors": filters.drop_ci_actors,
    "f4_single_event_repos": filters.drop_single_event_repos,
    "f5_high_volume_actors": lambda df: filters.drop_high_volume_actors(df, ACTORS),
    "f6_deleted_repos": filters.drop_deleted_repos,
    "f7_fork_only_actors": filters.drop_fork_only_actors,
    "f8_issue_flood": lambda df: filters.drop_issue_flood(df, ISSUES),
    "f9_issue_only_actors": filters.drop_issue_only_actors,
}
for _name, _filter in _FILTERS.items():
    query(_name, f"WITH a AS ({ARCHIVE_SQL}) {_STEPS[_name].replace('{t}', 'a')}")(lambda spark, sf_dir, f=_filter: f(archive(spark, sf_dir)))

#: CTEs f0 to f9: the archive, and what is left of it after each step.
_CHAIN = f"WITH f0 AS ({ARCHIVE_SQL})" + "".join(f", f{i + 1} AS ({sql.replace('{t}', f'f{i}')})" for i, sql in enumerate(_STEPS.values()))


@query("fc_filter_archive", f"{_CHAIN} SELECT * FROM f9")
def filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_archive(archive(spark, sf_dir), ACTORS, ISSUES)


@query("j3_hot_keys", f"{_CHAIN} SELECT * FROM f9")
def filtered_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, where each repository or actor of more than 20 rows is hot."""
    return filters.filter_archive(archive(spark, sf_dir), ACTORS, ISSUES, hot_rows=20)


@query("fc_filter_stored", f"{_CHAIN} SELECT * FROM f9")
def filtered_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from an archive in buckets of its repositories; the table goes again, since the result is read from files of its own."""
    stored = writers.store_archive(archive(spark, sf_dir), name := f"archive_{uuid.uuid4().hex}", 16)
    kept = staged(filters.filter_archive(stored, ACTORS, ISSUES, placed=True))
    spark.sql(f"DROP TABLE {name}")
    return kept


@query("fc_filter_archive_stepwise", f"{_CHAIN} SELECT * FROM f9")
def filtered_stepwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_sequentially(archive(spark, sf_dir), ACTORS, ISSUES)


_BY_MONTH = f"""
WITH f0 AS ({MONTHLY_SQL}),
r AS (SELECT month, repo FROM f0 GROUP BY 1, 2 HAVING bool_or({_CODE}) AND coalesce(sum(count) FILTER (WHERE NOT {_BOT} AND NOT {_CI}), 0) > 1),
p1 AS (SELECT f0.* FROM f0 JOIN r USING (month, repo) WHERE NOT {_BOT} AND NOT {_CI}),
p AS (SELECT *, regexp_matches(repo, '^{_GONE}/|^[^/]*/{_GONE}$') AS gone FROM p1),
a AS (SELECT month, actor, bool_or({_CODE} AND NOT gone) AS coder FROM p GROUP BY 1, 2 HAVING sum(count) <= {ACTORS} AND bool_or(NOT gone AND event_type NOT IN ('ForkEvent', 'WatchEvent'))),
p2 AS (SELECT p.*, coder FROM p JOIN a USING (month, actor) WHERE NOT gone),
b AS (SELECT month, repo FROM p2 WHERE event_type = 'IssuesEvent' GROUP BY 1, 2 HAVING sum(count) > 10)
"""


@query("fc_filter_months", f"{_BY_MONTH} SELECT actor, repo, event_type, action, language, month, count FROM p2 WHERE event_type <> 'IssuesEvent' OR (coder AND NOT EXISTS (SELECT 1 FROM b WHERE b.month = p2.month AND b.repo = p2.repo))")
def filtered_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_archive(archive(spark, sf_dir, monthly=True), ACTORS, 10, ["month"])


_REPORT = " UNION ALL ".join(
    f"SELECT {i + 1} AS step_no, '{name}' AS step, (SELECT count(*) FROM f{i}) - (SELECT count(*) FROM f{i + 1}) AS removed, (SELECT count(*) FROM f{i}) AS before" for i, name in enumerate(filters.STEPS)
)


@query("a9_filter_report", f"{_CHAIN}, s AS ({_REPORT} UNION ALL SELECT 10, 'total', (SELECT count(*) FROM f0) - (SELECT count(*) FROM f9), (SELECT count(*) FROM f0)) SELECT step_no, step, removed, CASE WHEN before = 0 THEN 0.0 ELSE 100.0 * removed / before END::DOUBLE AS removed_pct, before - removed AS remaining FROM s")
def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_report(archive(spark, sf_dir), ACTORS, ISSUES)


_MONTHS = "(SELECT DISTINCT month FROM f0)"
_TAGS = f"""
t AS (SELECT f0.month, CASE WHEN NOT k.has_code THEN 1 WHEN {_BOT.replace('actor', 'f0.actor')} THEN 2 WHEN {_CI.replace('actor', 'f0.actor')} THEN 3 WHEN k.human <= 1 THEN 4 WHEN NOT (ok.total <= {ACTORS}) THEN 5 WHEN regexp_matches(f0.repo, '^{_GONE}/|^[^/]*/{_GONE}$') THEN 6
    WHEN a.actor IS NULL THEN 7 WHEN event_type = 'IssuesEvent' AND b.repo IS NOT NULL THEN 8 WHEN event_type = 'IssuesEvent' AND NOT a.coder THEN 9 END AS step
    FROM f0 JOIN (SELECT month, repo, bool_or({_CODE}) AS has_code, coalesce(sum(count) FILTER (WHERE NOT {_BOT} AND NOT {_CI}), 0) AS human FROM f0 GROUP BY 1, 2) k ON k.month = f0.month AND k.repo = f0.repo
    LEFT JOIN (SELECT month, actor, sum(count) AS total FROM p1 GROUP BY 1, 2) ok ON ok.month = f0.month AND ok.actor = f0.actor
    LEFT JOIN a ON a.month = f0.month AND a.actor = f0.actor LEFT JOIN b ON b.month = f0.month AND b.repo = f0.repo),
n AS (SELECT m.month, s.step_no, s.step, (SELECT count(*) FROM t WHERE t.month = m.month AND t.step = s.step_no) AS removed, (SELECT count(*) FROM t WHERE t.month = m.month AND coalesce(t.step, 99) >= s.step_no) AS before FROM {_MONTHS} m, (VALUES {", ".join(f"({i}, '{x}')" for i, x in enumerate(filters.STEPS, 1))}) s(step_no, step)
    UNION ALL SELECT month, 10, 'total', count(step), count(*) FROM t GROUP BY 1)
SELECT month, step_no, step, removed, CASE WHEN before = 0 THEN 0.0 ELSE 100.0 * removed / before END::DOUBLE AS removed_pct, before - removed AS remaining FROM n
"""


@query("a9_filter_report_by_month", f"{_BY_MONTH}, {_TAGS}")
def report_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_report(archive(spark, sf_dir, monthly=True), ACTORS, 10, ["month"])


# ---- activity, shares, ratings


def _activity_sql(source: str, key: str = "") -> str:
    total = lambda kind: f"sum(count) FILTER (WHERE event_type = '{kind}')"
    return (
        f"SELECT {key}repo, CAST({total('PullRequestEvent')} AS BIGINT) AS pr_count, CAST({total('IssuesEvent')} AS BIGINT) AS issue_count, CAST({total('PushEvent')} AS BIGINT) AS push_count, CAST({total('WatchEvent')} AS BIGINT) AS star_count, "
        f"nullif(count(DISTINCT actor) FILTER (WHERE {_CODE}), 0) AS dev_actors, CAST(max(1) FILTER (WHERE {_CODE}) AS BIGINT) AS active FROM {source} GROUP BY {key}repo"
    )


_SHARES = "SELECT repo, l.language AS language, CASE WHEN total_size > 0 THEN l.size / total_size WHEN pos = 1 THEN 1.0 END::DOUBLE AS share FROM (SELECT repo, total_size, unnest(languages) AS l, unnest(range(1, len(languages) + 1)) AS pos FROM lang)"
_PRIMARY = "SELECT repo, languages[1].language AS language, 1.0::DOUBLE AS share FROM lang"


def _ratings_sql(activity: str, shares: str, key: str = "", suffix: str = "") -> str:
    """Finished and ranked ratings; activity and shares are relations."""
    each = " UNION ALL ".join(f"SELECT {key}'{m}{suffix}' AS metric, language, sum({METRIC_COLUMNS[m]} * share) AS raw FROM j GROUP BY {key}language HAVING count({METRIC_COLUMNS[m]}) > 0" for m in METRICS)
    return (
        f"j AS (SELECT {activity}.*, language, share FROM {activity} JOIN {shares} USING (repo)), r AS ({each}), t AS (SELECT *, sum(raw) OVER (PARTITION BY {key}metric) AS total, round(raw * 100) / 100 AS rating FROM r) "
        f"SELECT {key}metric, row_number() OVER (PARTITION BY {key}metric ORDER BY raw DESC, language) AS rank, language, rating, CASE WHEN total > 0 THEN round(rating / total * 10000) / 100 ELSE 0.0 END AS percentage FROM t"
    )


@query("a2_repo_activity", f"WITH a AS ({ARCHIVE_SQL}) {_activity_sql('a')}")
def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.repo_activity(archive(spark, sf_dir))


@query("a3_language_shares", f"WITH lang AS ({LANGUAGES_SQL}), s AS ({_SHARES}) SELECT * FROM s WHERE share IS NOT NULL")
def shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.language_shares(adapters.languages(spark, sf_dir))


_HEAD = f"WITH a AS ({ARCHIVE_SQL}), act AS ({_activity_sql('a')}), lang AS ({LANGUAGES_SQL}), sh AS (SELECT * FROM ({_SHARES}) WHERE share IS NOT NULL), pr AS ({_PRIMARY})"


@query("a4_ratings", f"{_HEAD}, {_ratings_sql('act', 'sh')}")
def rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.rated(ratings.repo_activity(archive(spark, sf_dir)), ratings.language_shares(adapters.languages(spark, sf_dir)))


@query("a4_ratings_by_month", f"WITH a AS ({MONTHLY_SQL}), act AS ({_activity_sql('a', 'month, ')}), lang AS ({LANGUAGES_SQL}), sh AS (SELECT * FROM ({_SHARES}) WHERE share IS NOT NULL), {_ratings_sql('act', 'sh', 'month, ')}")
def rated_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.rated(ratings.repo_activity(archive(spark, sf_dir, monthly=True), ["month"]), ratings.language_shares(adapters.languages(spark, sf_dir)), ["month"])


_ODD_LANGUAGES = LANGUAGES_SQL.replace("ELSE 1024 END", "ELSE 1000 + p_partkey % 7 END")
_UNIT = str(1 << ratings.SHARE_BITS)


@query(
    "a4_ratings_of_any_total",
    f"""
WITH a AS ({ARCHIVE_SQL}), act AS ({_activity_sql('a')}), lang AS ({_ODD_LANGUAGES}), sh AS (SELECT repo, language, floor(share * {_UNIT}.0)::HUGEINT AS share FROM ({_SHARES}) WHERE share IS NOT NULL),
j AS (SELECT act.*, language, share FROM act JOIN sh USING (repo)),
r AS ({" UNION ALL ".join(f"SELECT '{m}' AS metric, language, sum({METRIC_COLUMNS[m]}::HUGEINT * share)::HUGEINT AS exact FROM j GROUP BY language HAVING count({METRIC_COLUMNS[m]}) > 0" for m in METRICS)})
SELECT metric, language, exact::DOUBLE / {_UNIT}.0 AS rating FROM r
""",
)
def exact_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unrounded ratings of totals that are no powers of two."""
    known = adapters.languages(spark, sf_dir, "1000 + p_partkey % 7")
    return ratings.compute_ratings(ratings.repo_activity(archive(spark, sf_dir)), ratings.language_shares(known))


@query("e1_primary_ratings", f"{_HEAD}, {_ratings_sql('act', 'pr', suffix='-primary')}")
def primary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.primary_ratings(ratings.repo_activity(archive(spark, sf_dir)), adapters.languages(spark, sf_dir))


_COVERAGE = " UNION ALL ".join(f"SELECT '{m}' AS metric, count(*) FILTER (WHERE {METRIC_COLUMNS[m]} IS NOT NULL AND k.repo IS NOT NULL) AS matched, count(*) FILTER (WHERE {METRIC_COLUMNS[m]} IS NOT NULL AND k.repo IS NULL) AS unmatched FROM act LEFT JOIN (SELECT DISTINCT repo FROM lang) k USING (repo)" for m in METRICS)


@query("a5_match_coverage", f"{_HEAD} {_COVERAGE}")
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.match_coverage(ratings.repo_activity(archive(spark, sf_dir)), adapters.languages(spark, sf_dir))


_ARCHIVE_LANGUAGES = "SELECT repo, 1 AS total_size, [{'language': min(language), 'size': 1}] AS languages FROM a WHERE language <> '' GROUP BY repo"


@query("a7_languages_from_archive", f"WITH a AS ({ARCHIVE_SQL}), lang AS ({_ARCHIVE_LANGUAGES}) SELECT repo, total_size::BIGINT AS total_size, languages[1].language AS language FROM lang")
def archive_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.languages_from_archive(archive(spark, sf_dir)).select("repo", "total_size", F.get("languages", F.lit(0))["language"].alias("language"))


@query("a8_repos_to_resolve", f"{_CHAIN} SELECT DISTINCT repo FROM f9 WHERE event_type = 'PushEvent'")
def to_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.repos_to_resolve(filtered(spark, sf_dir))


_ARCHIVE_RATINGS = f"WITH a AS ({ARCHIVE_SQL}), act AS ({_activity_sql('a')}), lang AS ({_ARCHIVE_LANGUAGES}), sh AS ({_PRIMARY}), {_ratings_sql('act', 'sh')}"


@query("w2_ratings_from_archive_languages", _ARCHIVE_RATINGS)
def archive_rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second workload with languages from the archive itself."""
    a = archive(spark, sf_dir)
    return ratings.rated(ratings.repo_activity(a), ratings.language_shares(languages.languages_from_archive(a)))


_COMPARE = """
, a1 AS (SELECT language, rating, row_number() OVER (ORDER BY rating DESC, language) AS rank FROM fa), a2 AS (SELECT * FROM a1 WHERE rank <= 8),
b1 AS (SELECT language, rating, row_number() OVER (ORDER BY rating DESC, language) AS rank FROM fb), b2 AS (SELECT * FROM b1 WHERE rank <= 8)
SELECT a2.rank AS rank, coalesce(a2.language, b2.language) AS language, a2.rating AS rating_a, b2.rating AS rating_b, a2.rank - b2.rank AS rank_delta, round((b2.rating - a2.rating) / a2.rating * 100 * 10) / 10 AS rating_delta_pct,
    CASE WHEN b2.rank IS NULL THEN 'dropped' WHEN a2.rank IS NULL THEN 'enters' ELSE 'both' END AS status
FROM a2 FULL JOIN b2 ON a2.language = b2.language
"""


@query("e2_compare_rankings", f"{_HEAD}, fa AS (SELECT language, round(sum(push_count * share) * 100) / 100 AS rating FROM act JOIN sh USING (repo) GROUP BY 1 HAVING count(push_count) > 0), fb AS (SELECT language, round(sum(push_count * share) * 100) / 100 AS rating FROM act JOIN pr USING (repo) GROUP BY 1 HAVING count(push_count) > 0) {_COMPARE}")
def compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Push ratings by shares against those by primary language, top 8."""
    a, known = ratings.repo_activity(archive(spark, sf_dir)), adapters.languages(spark, sf_dir)
    return ratings.compare_rankings(ratings.rated(a, ratings.language_shares(known)).where("metric = 'push-count'"), ratings.primary_ratings(a, known).where("metric = 'push-count-primary'"), 8)


_TOP_BY_MONTH = "SELECT month, language, round(sum(push_count * share) * 100) / 100 AS rating FROM act JOIN {shares} USING (repo) GROUP BY 1, 2 HAVING count(push_count) > 0"


@query(
    "e2_compare_months",
    f"""
WITH a AS ({MONTHLY_SQL}), act AS ({_activity_sql('a', 'month, ')}), lang AS ({LANGUAGES_SQL}), sh AS (SELECT * FROM ({_SHARES}) WHERE share IS NOT NULL), pr AS ({_PRIMARY}),
fa AS ({_TOP_BY_MONTH.format(shares='sh')}), fb AS ({_TOP_BY_MONTH.format(shares='pr')})
{_COMPARE.replace("SELECT language", "SELECT month, language").replace("OVER (ORDER", "OVER (PARTITION BY month ORDER").replace("SELECT a2.rank", "SELECT coalesce(a2.month, b2.month) AS month, a2.rank").replace("ON a2.language", "ON a2.month = b2.month AND a2.language")}
""",
)
def compared_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for every month, in one job."""
    a, known = ratings.repo_activity(archive(spark, sf_dir, monthly=True), ["month"]), adapters.languages(spark, sf_dir)
    shares = ratings.rated(a, ratings.language_shares(known), ["month"]).where("metric = 'push-count'")
    return ratings.compare_rankings(shares, ratings.primary_ratings(a, known, ["month"]).where("metric = 'push-count-primary'"), 8, ["month"])


# ---- language lookup, packing

_SIZES = "SELECT source AS repo, lang AS language, sum(n_chars)::BIGINT AS size FROM documents GROUP BY 1, 2"


@query("w3_top_languages", f"SELECT repo, total_size, string_agg(language || ':' || size, ',' ORDER BY size DESC, language) AS languages FROM (SELECT *, sum(size) OVER (PARTITION BY repo)::BIGINT AS total_size, row_number() OVER (PARTITION BY repo ORDER BY size DESC, language) AS pos FROM ({_SIZES})) WHERE pos <= 2 GROUP BY 1, 2")
def top(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = spark.read.parquet(f"{sf_dir}/documents.parquet").groupBy(F.col("source").alias("repo"), F.col("lang").alias("language")).agg(F.sum("n_chars").alias("size"))
    known = sizes.groupBy("repo").agg(F.sum("size").alias("total_size"), F.collect_list(F.struct("language", "size")).alias("languages"))  # a few languages each
    return languages.top_languages(known, 2).select("repo", "total_size", F.array_join(F.transform("languages", lambda x: F.concat_ws(":", x["language"], x["size"].cast("string"))), ",").alias("languages"))


@query("g1_batch_requests", f"SELECT count(*) AS n_slugs, count(DISTINCT repo) AS n_repos, max(length(repo)) AS longest, 0 AS overfull FROM ({SLUGS_SQL})")
def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every slug in one batch, no batch over 10: which slugs share one is free."""
    numbered = languages.numbered_requests(languages.clean_slug_lines(adapters.slug_lines(spark, sf_dir)), 10)
    asked = languages.batch_requests(numbered).select("batch_id", (F.size(F.split("query", "repository\\(")) - 1).cast("long").alias("n"))
    per = numbered.join(asked, "batch_id").groupBy("batch_id").agg(F.count("*").alias("slugs"), F.collect_set("repo").alias("repos"), F.max(F.length("repo")).alias("longest"), F.max("n").alias("n"))
    return per.agg(F.sum("slugs").alias("n_slugs"), F.sum(F.size("repos")).alias("n_repos"), F.max("longest").cast("long").alias("longest"), F.count(F.when((F.col("slugs") > 10) | (F.col("slugs") != F.col("n")), 1)).alias("overfull"))


@query(
    "g2_parse_responses",
    "SELECT 'org/r' || p_partkey AS repo, CASE WHEN p_partkey % 5 = 0 OR p_partkey // 10 % 9 = 0 THEN 0 ELSE p_size END::BIGINT AS total_size, CASE WHEN p_partkey % 5 = 0 OR p_partkey // 10 % 9 = 0 OR p_partkey % 3 = 0 THEN '' ELSE p_type || ':' || p_size END AS languages FROM part WHERE p_partkey % 7 <> 0 OR p_partkey // 10 % 9 = 0",
)
def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten parts a batch: every seventh alias is absent, every fifth null, every third has a text for a size, every ninth batch failed."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_type", "p_size", F.expr("p_partkey DIV 10").alias("batch_id"), F.concat(F.lit("r"), F.col("p_partkey") % 10).alias("alias"))
    requests = part.select("batch_id", "alias", F.concat(F.lit("org/r"), "p_partkey").alias("repo"))
    size = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit('"'), "p_size", F.lit('"'))).otherwise(F.col("p_size").cast("string"))
    node = F.when(F.col("p_partkey") % 5 == 0, F.lit("null")).otherwise(F.concat(F.lit('{"languages":{"totalSize":'), "p_size", F.lit(',"edges":[{"size":'), size, F.lit(',"node":{"name":"'), "p_type", F.lit('"}},{"size":-1,"node":{"name":"x"}},{"size":2}]}}')))
    answer = F.concat(F.lit('"'), "alias", F.lit('":'), node)
    responses = part.where("p_partkey % 7 <> 0 OR batch_id % 9 = 0").groupBy("batch_id").agg(F.concat(F.lit('{"data":{"rateLimit":{"cost":1},'), F.array_join(F.collect_list(answer), ","), F.lit("}}")).alias("response"))
    responses = responses.withColumn("response", F.when(F.col("batch_id") % 9 != 0, F.col("response")))
    return languages.parse_language_responses(requests, responses).select("repo", "total_size", F.array_join(F.transform("languages", lambda x: F.concat_ws(":", x["language"], x["size"].cast("string"))), ",").alias("languages"))


#: Full batches of 100 in slug order, r10 behind r9: quotes go from the texts, and names without a slash aren't asked for.
_ODD_SLUGS = """CASE p_partkey % 5 WHEN 0 THEN 'o"' || p_partkey || '/r"x' WHEN 1 THEN 'noslash' || p_partkey ELSE 'org/r' || p_partkey END"""
_NUMBERED = f"SELECT (nr // 100)::BIGINT AS batch_id, 'r' || (nr % 100) AS alias, repo, nr FROM (SELECT repo, row_number() OVER (ORDER BY repo) - 1 AS nr FROM (SELECT {_ODD_SLUGS} AS repo FROM part))"


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.numbered_requests(spark.read.parquet(f"{sf_dir}/part.parquet").select(F.expr(_ODD_SLUGS).alias("repo")))


@query("g1_numbered_requests", f"SELECT batch_id, alias, repo FROM ({_NUMBERED})")
def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(spark, sf_dir)


@query(
    "g1_request_texts",
    f"""
SELECT batch_id, '{{ rateLimit {{ cost remaining }} ' || string_agg(alias || ': repository(owner: "' || replace(split_part(repo, '/', 1), '"', '') || '", name: "' || replace(split_part(repo, '/', 2), '"', '')
    || '") {{ languages(first: 5, orderBy: {{field: SIZE, direction: DESC}}) {{ totalSize edges {{ size node {{ name }} }} }} }}', ' ' ORDER BY nr) || ' }}' AS query
FROM ({_NUMBERED}) WHERE contains(repo, '/') GROUP BY batch_id
""",
)
def request_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.batch_requests(_numbered(spark, sf_dir))


_MONTHLY_RATINGS = f"WITH a AS ({MONTHLY_SQL}), act AS ({_activity_sql('a', 'month, ')}), lang AS ({LANGUAGES_SQL}), sh AS (SELECT * FROM ({_SHARES}) WHERE share IS NOT NULL), k AS (WITH {_ratings_sql('act', 'sh', 'month, ')})"


def _rating_folder(spark: SparkSession, sf_dir: str) -> str:
    writers.write_ratings(rated_months(spark, sf_dir), folder := scratch(spark))
    return folder


@query("s8_write_ratings", f"{_MONTHLY_RATINGS} SELECT month, metric, CAST(rank AS INTEGER) AS rank, language, rating, percentage FROM k")
def written_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months' ratings written as JSON lines in folders, read as plain JSON."""
    return spark.read.schema("rank int, language string, rating double, percentage double, month string, metric string").json(_rating_folder(spark, sf_dir))


@query("s9_read_rating_files", f"{_MONTHLY_RATINGS} SELECT month, metric, rank - 1 AS pos, language FROM k WHERE metric = 'pr-count'")
def read_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of one metric's files, with their places in them."""
    lines = readers.read_rating_files(spark, _rating_folder(spark, sf_dir), "pr-count")
    return lines.select("month", "metric", F.col("pos").cast("long").alias("pos"), F.variant_get("record", "$.language", "string").alias("language"))


@query("k1_pack_ratings", f"{_MONTHLY_RATINGS} SELECT month, language, rating, percentage FROM k WHERE metric = 'push-count'")
def packed_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.pack_ratings(spark, _rating_folder(spark, sf_dir), "push-count").drop("line")


@query("x6_metric_names", f"{_MONTHLY_RATINGS} SELECT metric, count(*) AS n FROM k GROUP BY metric")
def metric_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines the files of each known metric have."""
    packed_lines = pack.pack_all(spark, _rating_folder(spark, sf_dir)).groupBy("metric").agg(F.count("*").alias("n"))
    return packed_lines.where(F.col("metric").isin(*map(metric_name, METRICS)))


@query("k2_pack_all", f"WITH a AS ({MONTHLY_SQL}), act AS ({_activity_sql('a', 'month, ')}), lang AS ({LANGUAGES_SQL}), sh AS (SELECT * FROM ({_SHARES}) WHERE share IS NOT NULL), k AS (WITH {_ratings_sql('act', 'sh', 'month, ')}) SELECT month, metric, language, rating, percentage FROM k")
def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months' ratings as the texts of their files, packed again."""
    months = rated_months(spark, sf_dir)
    line = F.to_json(F.struct("language", "rating", "percentage"))
    files = months.groupBy("month", "metric").agg(F.array_sort(F.collect_list(F.struct("rank", line.alias("line")))).alias("l"))  # some hundred lines a file
    files = files.select(F.concat(F.lit("out/language-ratings-"), "month", F.lit("-"), "metric", F.lit(".jsonl")).alias("path"), F.concat(F.array_join(F.transform("l", lambda x: x["line"]), "\n"), F.lit("\n\nno json\n")).alias("value"))
    return pack.pack_files(files).select("month", "metric", "language", "rating", "percentage")


_W1 = f"{_CHAIN}, act AS ({_activity_sql('f9')}), lang AS ({LANGUAGES_SQL}), sh AS (SELECT * FROM ({_SHARES}) WHERE share IS NOT NULL), {_ratings_sql('act', 'sh')}"


@query("w1_clean_ratings", _W1)
def clean_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter, rate and rank: the whole relational path."""
    return ratings.rated(ratings.repo_activity(filtered(spark, sf_dir)), ratings.language_shares(adapters.languages(spark, sf_dir)))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages by push activity."""
    return rated(spark, sf_dir).where("metric = 'push-count'").orderBy("rank")
