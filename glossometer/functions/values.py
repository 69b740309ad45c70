"""Constants and schemas of the tables that the jobs exchange."""

from __future__ import annotations

#: The six metrics.
METRICS = ("pr-count", "push-count", "issue-count", "developer-activity", "active-repos", "star-count")
#: The activity column that holds each metric.
METRIC_COLUMNS = {
    "pr-count": "pr_count",
    "push-count": "push_count",
    "issue-count": "issue_count",
    "developer-activity": "dev_actors",
    "active-repos": "active",
    "star-count": "star_count",
}

PULL_REQUEST, PUSH, ISSUES, WATCH, FORK = "PullRequestEvent", "PushEvent", "IssuesEvent", "WatchEvent", "ForkEvent"
CODE_EVENTS = (PUSH, PULL_REQUEST)
PASSIVE_EVENTS = (FORK, WATCH)

ACTOR_EVENT_LIMIT, REPO_ISSUE_LIMIT = 1000, 10_000
REQUEST_BATCH, MAX_LANGUAGES = 100, 5
TOP = 30

#: Parts of the names of automation accounts.
AUTOMATION = (
    "github-actions",
    "dependabot",
    "renovate",
    "codecov",
    "snyk",
    "deepsource",
    "sonarcloud",
    "greenkeeper",
    "imgbot",
    "allcontributors",
    "semantic-release",
    "release-please",
    "pre-commit-ci",
    "lgtm-com",
    "netlify",
    "vercel",
    "stale[",
    "copilot",
)

ARCHIVE_COLUMNS = ["actor", "repo", "event_type", "action", "language", "count"]
LANGUAGES = "array<struct<language: string, size: bigint>>"
