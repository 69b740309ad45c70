"""The star-schema test tables as event lines, archive rows and repository languages; in Spark and as DuckDB SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import LANGUAGES
from ..sources.scratch import scratch

#: Both engines read these expressions alike ({text} is the name of the string type).
_ACTOR = "CASE o_custkey % 20 WHEN 0 THEN 'dependabot[bot]-' || o_custkey WHEN 1 THEN 'Renovate-' || o_custkey ELSE 'user' || o_custkey END"
_REPO = (
    "CASE WHEN l_orderkey % 3 = 0 THEN 'solo' || l_orderkey || '/r' || l_linenumber "
    "WHEN l_partkey % 50 = 0 THEN 'org' || (l_partkey % 97) || '/' || lpad(CAST(l_partkey AS {text}), 40, '0') "
    "WHEN l_partkey % 50 = 1 THEN '00000000-0000-4000-8000-' || lpad(CAST(l_partkey AS {text}), 12, '0') || '/repo' "
    "ELSE 'org' || (l_partkey % 97) || '/repo' || l_partkey END"
)
_TYPE = (
    "CASE WHEN o_custkey % 20 = 2 THEN 'IssuesEvent' WHEN o_custkey % 20 = 3 THEN 'ForkEvent' WHEN l_linenumber <= 2 THEN 'PushEvent' "
    "WHEN l_linenumber = 3 THEN 'PullRequestEvent' WHEN l_linenumber = 4 THEN 'IssuesEvent' WHEN l_linenumber = 5 THEN 'WatchEvent' "
    "WHEN l_linenumber = 6 THEN 'ForkEvent' ELSE 'IssueCommentEvent' END"
)
_LANGUAGE = "CASE o_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'Rust' ELSE 'Go' END"
_COUNT = "CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE CAST(l_quantity AS BIGINT) END"


def _archive(text: str, month: str | None) -> str:
    by = ", 6" if month else ""
    more = f", {month} AS month" if month else ""
    rows = f"SELECT {_ACTOR} AS actor, {_REPO.format(text=text)} AS repo, {_TYPE} AS event_type, '' AS action, {_LANGUAGE} AS language{more}, {_COUNT} AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
    return f"SELECT actor, repo, event_type, action, language{', month' if month else ''}, CAST(sum(n) AS BIGINT) AS count FROM ({rows}) GROUP BY 1, 2, 3, 4, 5{by}"


#: Archive rows in DuckDB: without a month, and by month.
ARCHIVE_SQL = _archive("VARCHAR", None)
MONTHLY_SQL = _archive("VARCHAR", "strftime(o_orderdate, '%Y-%m')")


def archive(spark: SparkSession, sf_dir: str, monthly: bool = False) -> DataFrame:
    """Archive rows from line items and their orders."""
    tables = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("lineitem", "orders")}
    return spark.sql(_archive("STRING", "date_format(o_orderdate, 'yyyy-MM')" if monthly else None).replace("FROM lineitem JOIN orders", "FROM {lineitem} JOIN {orders}"), **tables)


LANGUAGES_SQL = """
SELECT 'org' || (p_partkey % 97) || '/repo' || p_partkey AS repo, CASE WHEN p_partkey % 13 = 0 THEN 0 ELSE 1024 END AS total_size,
    [{'language': p_type, 'size': 512}, {'language': p_brand, 'size': 256}, {'language': 'Shell', 'size': 128}] AS languages
FROM part WHERE p_partkey % 11 <> 0
"""


def languages(spark: SparkSession, sf_dir: str, total: str = "1024") -> DataFrame:
    """Repository languages from parts; total: an expression. 1024 is a power of two, so that sums are exact in double precision too."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").where("p_partkey % 11 <> 0")
    one = lambda name, size: F.struct(name.alias("language"), F.lit(size).cast("long").alias("size"))
    return part.select(
        F.expr("'org' || (p_partkey % 97) || '/repo' || p_partkey").alias("repo"),
        F.when(F.col("p_partkey") % 13 == 0, 0).otherwise(F.expr(total)).cast("long").alias("total_size"),
        F.array(one(F.col("p_type"), 512), one(F.col("p_brand"), 256), one(F.lit("Shell"), 128)).cast(LANGUAGES).alias("languages"),
    )


def event_lines(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """(more, value): events as JSON lines, some broken, some with values of another kind, some without an actor."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    kind = F.when(F.col("event_type").isin("click", "view"), "PushEvent").otherwise(F.concat(F.col("event_type"), F.lit("Event")))
    language = F.element_at(F.array(*map(F.lit, ("Rust", "", "Go", "C"))), (F.col("event_id") % 4 + 1).cast("int"))
    whole = F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("id"),
            kind.alias("type"),
            F.when(F.col("event_id") % 19 != 0, F.struct(F.concat(F.lit("user"), F.col("user_id")).alias("login"))).alias("actor"),
            F.struct(F.when(F.col("event_id") % 23 == 0, F.lit("noslash")).otherwise(F.concat(F.lit("org"), F.col("user_id") % 7, F.lit("/r"), F.col("user_id") % 5)).alias("name")).alias("repo"),
            F.struct(
                F.when(F.col("event_id") % 3 == 0, F.struct(F.struct(F.struct(language.alias("language")).alias("repo")).alias("head"))).alias("pull_request"),
                F.when(F.col("event_id") % 5 == 0, F.struct(F.lit("Lua").alias("language"))).alias("repository"),
                F.when(F.col("event_id") % 2 == 0, F.lit("opened")).alias("action"),
            ).alias("payload"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("created_at"),
        )
    )
    bad = F.when(F.col("event_id") % 29 == 0, F.substring(whole, 1, 40)).when(F.col("event_id") % 31 == 0, F.regexp_replace(whole, '"type":"[A-Za-z]*"', '"type":5')).when(F.col("event_id") % 37 == 0, F.regexp_replace(whole, '"action":"opened"', '"action":7'))
    return e.select(*more, F.coalesce(bad, whole).alias("value"))


def hour_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder of gzipped event files by hour, named as the archive's. By its number in the month of the first event, every 13th hour is absent, every 11th file
    empty, every 7th cut in half, and every 5th has a second member that repeats the first."""
    lines = event_lines(spark, sf_dir, "ts").withColumn("hour", F.date_format("ts", "yyyy-MM-dd-H"))
    written, folder = scratch(spark), scratch(spark)
    lines.select("hour", "value").repartition("hour").write.partitionBy("hour").option("compression", "gzip").text(written)
    first = spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.date_format(F.min("ts"), "yyyy-MM")).first()[0]
    start = datetime.strptime(first, "%Y-%m")
    hadoop = spark._jvm.org.apache.hadoop
    path = hadoop.fs.Path
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    fs = path(folder).getFileSystem(conf)
    fs.mkdirs(path(folder))
    for found in fs.globStatus(path(f"{written}/hour=*/part-*")):
        hour = found.getPath().getParent().getName().removeprefix("hour=")
        idx = int((datetime.strptime(hour, "%Y-%m-%d-%H") - start).total_seconds() // 3600) + 1
        to, size = path(f"{folder}/{hour}.json.gz"), found.getLen()
        if idx % 13 == 0:
            continue
        if idx % 11 and idx % 7 and idx % 5:
            fs.rename(found.getPath(), to)
            continue
        out = fs.create(to)
        for part in () if idx % 11 == 0 else (size // 2,) if idx % 7 == 0 else (size, size):
            source = fs.open(found.getPath())
            out.write(source.readNBytes(part))
            source.close()
        out.close()
    return folder


#: What file_ledger has to say about hour_files: lines of sound files only.
HOURS_SQL = """
WITH e AS (SELECT date_trunc('month', min(ts)) AS first FROM events), h AS (SELECT unnest(range(first, first + INTERVAL 1 MONTH, INTERVAL 1 HOUR)) AS hour, first FROM e),
c AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1),
i AS (SELECT hour, datediff('hour', first, hour) + 1 AS idx, strftime(hour, '%Y-%m-%d-') || hour(hour) || '.json.gz' AS name FROM h),
s AS (SELECT idx, name, n, CASE WHEN n IS NULL OR idx % 13 = 0 THEN 'absent' WHEN idx % 11 = 0 THEN 'empty' WHEN idx % 7 = 0 THEN 'damaged' ELSE 'ok' END AS state FROM i LEFT JOIN c USING (hour))
"""

#: What extract_events has to find in event_lines, straight from the columns.
EXTRACTED_SQL = """
SELECT CASE WHEN event_id % 19 <> 0 THEN 'user' || user_id ELSE '' END AS actor, 'org' || (user_id % 7) || '/r' || (user_id % 5) AS repo,
    CASE WHEN event_type IN ('click', 'view') THEN 'PushEvent' ELSE event_type || 'Event' END AS event_type,
    CASE WHEN event_id % 2 = 0 AND event_id % 37 <> 0 THEN 'opened' ELSE '' END AS action,
    CASE WHEN event_id % 3 = 0 THEN ['Rust', '', 'Go', 'C'][event_id % 4 + 1] WHEN event_id % 5 = 0 THEN 'Lua' ELSE '' END AS language,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS created_at, CAST(event_id AS VARCHAR) AS id
FROM events WHERE event_id % 29 <> 0 AND event_id % 31 <> 0 AND event_id % 23 <> 0
"""


def slug_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value): repository names as people write them, from page addresses and parts."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return pages.select(
        F.when(F.col("page_id") % 7 == 0, F.concat(F.lit("# "), "url"))
        .when(F.col("page_id") % 7 == 1, F.lit("   "))
        .when(F.col("page_id") % 7 == 2, F.concat(F.lit(" https://github.com/org"), F.col("page_id") % 11, F.lit("/r"), F.col("page_id"), F.lit(".git ")))
        .when(F.col("page_id") % 7 == 3, F.concat(F.lit("github.com/org"), F.col("page_id") % 11, F.lit("/r"), F.col("page_id"), F.lit("/")))
        .when(F.col("page_id") % 7 == 4, F.concat(F.lit("org/r"), F.col("page_id"), F.lit(".git/")))
        .otherwise(F.col("url"))
        .alias("value")
    )


SLUGS_SQL = r"""
WITH lines AS (
    SELECT CASE page_id % 7 WHEN 0 THEN '# ' || url WHEN 1 THEN '   ' WHEN 2 THEN ' https://github.com/org' || (page_id % 11) || '/r' || page_id || '.git '
        WHEN 3 THEN 'github.com/org' || (page_id % 11) || '/r' || page_id || '/' WHEN 4 THEN 'org/r' || page_id || '.git/' ELSE url END AS value FROM pages
), slugs AS (
    SELECT regexp_replace(regexp_replace(regexp_replace(trim(value), '^(https://github\.com/|http://github\.com/|github\.com/)', ''), '\.git$', ''), '/+$', '') AS repo
    FROM lines WHERE trim(value) <> '' AND NOT starts_with(trim(value), '#')
)
SELECT repo FROM slugs WHERE length(repo) - length(replace(repo, '/', '')) = 1
"""

SLUG_COUNTS_SQL = SLUGS_SQL.rpartition("SELECT repo FROM slugs")[0] + """
SELECT count(*) FILTER (WHERE length(repo) - length(replace(repo, '/', '')) = 1) AS n_slugs, (SELECT count(*) FROM lines) - count(*) AS n_ignored, count(*) FILTER (WHERE length(repo) - length(replace(repo, '/', '')) <> 1) AS n_bad FROM slugs
"""
