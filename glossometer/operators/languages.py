"""Repository languages: from archives, and from stored responses of a lookup service."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import normalize_repo, text_of, whole_of
from ..functions.values import LANGUAGES, MAX_LANGUAGES, PUSH, REQUEST_BATCH
from ..sources.scratch import staged


def languages_from_archive(df: DataFrame, order: Sequence[str] = ("language",), keys: Sequence[str] = ()) -> DataFrame:
    """(keys, repo, total_size, languages) from an unfiltered archive that carries languages: the first non-empty one by `order`, with size 1."""
    first = df.where("language <> ''").groupBy(*keys, "repo").agg(F.min_by("language", F.struct(*order, "language") if tuple(order) != ("language",) else F.col("language")).alias("language"))
    one = F.lit(1).cast("long")
    return first.select(*keys, "repo", one.alias("total_size"), F.array(F.struct("language", one.alias("size"))).cast(LANGUAGES).alias("languages"))


def repos_to_resolve(df: DataFrame, event_type: str = PUSH, keys: Sequence[str] = ()) -> DataFrame:
    """The repositories with an event of this type, each once (for each value of keys), sorted."""
    return df.where(F.col("event_type") == event_type).select(*keys, "repo").distinct().orderBy(*keys, "repo")


def clean_slug_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """The valid slugs of a list: blank lines and comments go, and lines that are no slug. Repeats stay."""
    return lines.where(~_ignored(column)).select(normalize_repo(F.col(column)).alias("repo")).where("repo IS NOT NULL")


def _ignored(column: str) -> Column:
    """Blank lines and comments; null counts as blank."""
    text = F.coalesce(F.regexp_replace(column, r"(?U)^\s+|\s+$", ""), F.lit(""))
    return (text == "") | F.startswith(text, F.lit("#"))


def slug_line_counts(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row: how many lines are slugs (n_slugs), blank or comments (n_ignored), and neither (n_bad)."""
    slug = normalize_repo(F.col(column)).isNotNull()
    kinds = {"n_slugs": ~_ignored(column) & slug, "n_ignored": _ignored(column), "n_bad": ~_ignored(column) & ~slug}
    return lines.agg(*(F.count(F.when(kind, 1)).alias(name) for name, kind in kinds.items()))


def top_languages(languages: DataFrame, n: int = MAX_LANGUAGES) -> DataFrame:
    """Each repository's n largest languages, by size from the largest, then by name; total_size stays."""
    flipped = F.array_sort(F.transform("languages", lambda x: F.struct((-x["size"]).alias("less"), x["language"].alias("language"))))
    kept = F.transform(F.slice(flipped, 1, n), lambda x: F.struct(x["language"].alias("language"), (-x["less"]).alias("size")))
    return languages.withColumn("languages", kept.cast(LANGUAGES))


def numbered_requests(slugs: DataFrame, size: int = REQUEST_BATCH) -> DataFrame:
    """(batch_id, alias, repo): slugs in their order, in full batches of `size` but for the last, with aliases r0, r1, ...

    No task numbers all slugs: ranges of them are sorted and numbered by themselves, and written so that the numbers stay; the sum of the
    ranges before a range, of which there are as many as shuffle partitions, is added. Repeated slugs keep their places,
    and any number of them is spread over ranges.
    """
    ties = slugs.select("repo", F.xxhash64(F.monotonically_increasing_id()).alias("tie"))
    ranged = ties.repartitionByRange("repo", "tie").sortWithinPartitions("repo", "tie").select("repo")
    at = F.monotonically_increasing_id()  # the range, and the place in it in the lower 33 bits
    placed = staged(ranged.select("repo", F.shiftrightunsigned(at, 33).alias("range"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("at")))
    per = placed.groupBy("range").agg(F.count("*").alias("n"))
    before = per.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))
    number = F.col("before") + F.col("at")
    return placed.join(F.broadcast(before), "range").select(((number - number % size) / size).cast("long").alias("batch_id"), F.concat(F.lit("r"), number % size).alias("alias"), "repo")


def batch_requests(requests: DataFrame, max_languages: int = MAX_LANGUAGES) -> DataFrame:
    """(batch_id, query): the text that asks for a batch's languages. Double quotes go from the names.

    The fields and their order are fixed values of the lookup service's language.
    """
    owner, name = (F.replace(x, F.lit('"')) for x in (F.substring_index("repo", "/", 1), F.regexp_replace("repo", r"\A[^/]*/", "")))
    part = F.concat("alias", F.lit(': repository(owner: "'), owner, F.lit('", name: "'), name, F.lit(f'") {{ languages(first: {max_languages}, orderBy: {{field: SIZE, direction: DESC}}) {{ totalSize edges {{ size node {{ name }} }} }} }}'))
    at = F.substring("alias", 2, 12).cast("int")
    parts = F.array_sort(F.collect_list(F.struct(at.alias("at"), part.alias("part"))))  # at most a batch's size
    return requests.where(F.contains("repo", F.lit("/"))).groupBy("batch_id").agg(F.concat(F.lit("{ rateLimit { cost remaining } "), F.array_join(F.transform(parts, lambda x: x["part"]), " "), F.lit(" }")).alias("query"))


#: Aliases are the keys of data; VARIANT leaves tell numbers from texts.
RESPONSE = "data map<string, struct<languages: struct<totalSize: variant, edges: array<struct<size: variant, node: struct<name: variant>>>>>>"


def parse_language_responses(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """(repo, total_size, languages): a row for each alias that its batch's response (batch_id, response) answers.

    An alias that the response lacks gives no row; one that is null (not found) gives total 0 and no languages; so do all
    aliases of a batch without a response. Edges without a name or an unsigned size are left out; the others keep
    their order. A response without data gives no rows.
    """
    joined = requests.join(responses.select("batch_id", "response", F.from_json("response", RESPONSE)["data"].alias("data")), "batch_id")
    failed = F.col("response").isNull()
    found = joined.where(failed | F.map_contains_key("data", F.col("alias"))).withColumn("l", F.try_element_at("data", F.col("alias"))["languages"])
    edges = F.filter(F.transform("l.edges", lambda e: F.struct(text_of(e["node"]["name"]).alias("language"), whole_of(e["size"]).alias("size"))), lambda e: e["language"].isNotNull() & e["size"].isNotNull())
    return found.select("repo", F.coalesce(whole_of(F.col("l.totalSize")), F.lit(0)).alias("total_size"), F.coalesce(edges.cast(LANGUAGES), F.array().cast(LANGUAGES)).alias("languages"))
