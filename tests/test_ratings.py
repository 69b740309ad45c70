from __future__ import annotations

import random
from fractions import Fraction

import pytest
from helpers import rows
from pyspark.sql import functions as F

from glossometer.functions.scalars import metric_name, two_decimals
from glossometer.functions.values import LANGUAGES
from glossometer.operators import languages as lang
from glossometer.operators import ratings as r


@pytest.fixture(scope="session")
def known(spark):
    def make(*items):
        return spark.createDataFrame([(repo, total, [{"language": x, "size": s} for x, s in ls]) for repo, total, ls in items], f"repo string, total_size long, languages {LANGUAGES}")

    return make


GOLDEN = {
    "pr-count": [("Rust", 2.7, 90.0), ("C", 0.3, 10.0)],
    "push-count": [("Rust", 4.5, 50.0), ("Go", 4.0, 44.44), ("C", 0.5, 5.56)],
    "issue-count": [("Rust", 1.8, 90.0), ("C", 0.2, 10.0)],
    "developer-activity": [("Rust", 1.8, 60.0), ("Go", 1.0, 33.33), ("C", 0.2, 6.67)],
    "active-repos": [("Go", 1.0, 50.0), ("Rust", 0.9, 45.0), ("C", 0.1, 5.0)],
    "star-count": [("Go", 10.0, 100.0)],
}


def test_all_metrics(archive, known):
    df = archive(("ann", "x/y", "PullRequestEvent", 3), ("ben", "x/y", "PushEvent", 5), ("ann", "x/y", "IssuesEvent", 2), ("ann", "p/q", "PushEvent", 4), ("cy", "p/q", "WatchEvent", 10))
    got = r.rated(r.repo_activity(df), r.language_shares(known(("x/y", 100, [("Rust", 90), ("C", 10)]), ("p/q", 50, [("Go", 50)]))))
    for metric, want in GOLDEN.items():
        assert [tuple(x)[2:] for x in got.where(f"metric = '{metric}'").orderBy("rank").collect()] == want


def test_null_is_absent_and_zero_is_present(archive, known):
    df = archive(("a", "x/y", "PushEvent", 0), ("a", "x/y", "PullRequestEvent", 2))
    a = r.repo_activity(df).first()
    assert (a["push_count"], a["pr_count"], a["issue_count"], a["dev_actors"], a["active"]) == (0, 2, None, 1, 1)
    only_issues = r.repo_activity(archive(("a", "x/y", "IssuesEvent", 2))).first()
    assert only_issues["dev_actors"] is None and only_issues["active"] is None
    got = r.rated(r.repo_activity(df), r.language_shares(known(("x/y", 4, [("Go", 4)])))).where("metric = 'push-count'").first()
    assert (got["rating"], got["percentage"]) == (0.0, 0.0)


def test_shares(known):
    df = known(("a/a", 0, [("X", 5), ("Y", 3)]), ("b/b", 10, []), ("c/c", 10, [("X", 4), ("Y", 2)]), ("d/d", 4, [("X", 1), ("X", 1)]))
    assert rows(r.language_shares(df)) == [("a/a", "X", 1.0), ("c/c", "X", 0.4), ("c/c", "Y", 0.2), ("d/d", "X", 0.25), ("d/d", "X", 0.25)]


def test_rounding(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (0.125,), (-0.125,)], "x double")
    assert [x[0] for x in df.select(two_decimals(df["x"])).collect()] == [1.0, 2.68, 0.13, -0.13]


def test_coverage(archive, known):
    a = r.repo_activity(archive(("a", "k/k", "PushEvent", 1), ("a", "l/l", "PushEvent", 1), ("a", "m/m", "WatchEvent", 1)))
    got = {x["metric"]: (x["matched"], x["unmatched"]) for x in r.match_coverage(a, known(("k/k", 0, []), ("m/m", 1, [("C", 1)]))).collect()}
    assert got["push-count"] == (1, 1) and got["star-count"] == (1, 0) and got["pr-count"] == (0, 0)


def test_against_plain_python(archive, known):
    rng = random.Random(5)
    repos = {f"o/r{i}": (total := rng.choice([0, 64, 128]), [(x, rng.choice([8, 16, 32])) for x in rng.sample("ABCDE", rng.randint(0, 3))]) for i in range(12)}
    events = [(rng.choice("uvwxyz"), rng.choice([*repos, "no/data"]), rng.choice(["PushEvent", "PullRequestEvent", "IssuesEvent", "WatchEvent", "ForkEvent"]), rng.randint(0, 9)) for _ in range(120)]
    values: dict[str, dict[str, float]] = {}
    people: dict[str, set] = {}
    kinds = {"PushEvent": "push-count", "PullRequestEvent": "pr-count", "IssuesEvent": "issue-count", "WatchEvent": "star-count"}
    for actor, repo, kind, n in events:
        if kind in kinds:
            m = values.setdefault(kinds[kind], {})
            m[repo] = m.get(repo, 0) + n
        if kind in ("PushEvent", "PullRequestEvent"):
            people.setdefault(repo, set()).add(actor)
            values.setdefault("active-repos", {})[repo] = 1
    values["developer-activity"] = {k: len(v) for k, v in people.items()}
    want = {}
    for metric, per in values.items():
        for repo, n in per.items():
            total, ls = repos.get(repo, (0, []))
            for i, (x, size) in enumerate(ls):
                if total or not i:
                    want[metric, x] = want.get((metric, x), 0.0) + n * (size / total if total else 1.0)
    got = r.compute_ratings(r.repo_activity(archive(*events)), r.language_shares(known(*((k, t, ls) for k, (t, ls) in repos.items()))))
    assert {(x["metric"], x["language"]): x["rating"] for x in got.collect()} == want


def test_primary_and_comparison(archive, known):
    a = r.repo_activity(archive(("a", "x/y", "PushEvent", 10), ("a", "p/q", "PushEvent", 4)))
    ls = known(("x/y", 10, [("Rust", 6), ("C", 4)]), ("p/q", 4, [("C", 4)]))
    first, second = r.rated(a, r.language_shares(ls)).where("metric = 'push-count'"), r.primary_ratings(a, ls).where("metric = 'push-count-primary'")
    assert rows(second, "language", "rating") == [("C", 4.0), ("Rust", 10.0)]
    got = {x["language"]: x for x in r.compare_rankings(first, second).collect()}
    assert (got["C"]["rank"], got["C"]["rank_delta"], got["C"]["rating_delta_pct"], got["C"]["status"]) == (1, -1, -50.0, "both")
    one = {x["language"]: x for x in r.compare_rankings(first, second, 1).collect()}
    assert (one["C"]["status"], one["C"]["rating_b"], one["Rust"]["status"], one["Rust"]["rating_a"]) == ("dropped", None, "enters", None)


def test_languages_from_archive_and_top(archive, known):
    df = archive(("a", "k/k", "PullRequestEvent", 1, "", ""), ("b", "k/k", "PullRequestEvent", 1, "", "Rust"), ("c", "k/k", "PullRequestEvent", 1, "", "Go"), ("c", "l/l", "PushEvent", 1, "", ""))
    assert [(x["repo"], x["total_size"], x["languages"][0]["language"]) for x in lang.languages_from_archive(df).collect()] == [("k/k", 1, "Go")]
    top = lang.top_languages(known(("a/a", 99, [("X", 5), ("B", 7), ("A", 7)])), 2).first()
    assert (top["total_size"], [tuple(x) for x in top["languages"]]) == (99, [("A", 7), ("B", 7)])


def test_metric_names():
    assert metric_name("pr-count") == "pr-count"
    with pytest.raises(ValueError, match="star-count"):
        metric_name("stars")


def test_sums_do_not_depend_on_order(spark):
    """The same ratings to the bit from 1, 7 and 200 partitions; totals aren't powers of two."""
    activity = spark.range(4000).select(F.concat(F.lit("o/r"), "id").alias("repo"), *(F.when(F.col("id") % k != 0, F.col("id") * k % 1013).cast("long").alias(c) for k, c in enumerate(("pr_count", "issue_count", "push_count", "star_count", "dev_actors", "active"), 2)))
    shares = spark.range(4000).select(F.concat(F.lit("o/r"), "id").alias("repo"), F.explode(F.array(*(F.struct(F.lit(x).alias("language"), ((F.col("id") % 97 + n) / (F.col("id") % 89 + 3) / (1 if n else 1e7)).alias("share")) for n, x in enumerate("abc")))).alias("s")).select("repo", "s.*")
    got = [sorted(tuple(x) for x in r.rated(activity.repartition(n), shares.repartition(n)).collect()) for n in (1, 7, 200)]
    raw = [sorted(tuple(x) for x in r.compute_ratings(activity.repartition(n), shares.repartition(n)).collect()) for n in (1, 7, 200)]
    assert got[0] == got[1] == got[2] and raw[0] == raw[1] == raw[2]
    exact = sum(Fraction(i * 2 % 1013) * Fraction((i % 97 + 1) / (i % 89 + 3)) for i in range(4000) if i % 2)
    assert next(x[2] for x in raw[0] if x[:2] == ("b", "pr-count")) == pytest.approx(float(exact), rel=1e-15)


def test_comparing_many_months(spark):
    a = spark.createDataFrame([("m1", "X", 9.0), ("m1", "Y", 8.0), ("m2", "Y", 5.0), ("m2", "X", 4.0)], "month string, language string, rating double")
    b = spark.createDataFrame([("m1", "Y", 9.0), ("m1", "X", 3.0), ("m2", "Z", 5.0)], "month string, language string, rating double")
    got = r.compare_rankings(a, b, 2, ["month"])
    for m in ("m1", "m2"):
        one = r.compare_rankings(*(x.where(F.col("month") == m).drop("month") for x in (a, b)), 2)
        assert rows(got.where(F.col("month") == m).drop("month")) == rows(one)
