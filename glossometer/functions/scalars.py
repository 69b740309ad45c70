"""Column functions. ASCII case only is folded, and anchors hold at the very ends of a string."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import AUTOMATION, METRICS

_HEX40 = "[0-9a-f]{40}"
_UUID = "[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
_GONE = f"(?:{_HEX40}|{_UUID})"


def two_decimals(x: Column) -> Column:
    """Half away from zero on the binary product, so 1.005 gives 1.0."""
    return F.round(x * 100, 0) / 100


def is_bot(actor: Column) -> Column:
    return actor.rlike("(?i)bot")


def is_automation(actor: Column) -> Column:
    return actor.rlike("(?i)(?:" + "|".join(re.sub(r"([^a-z-])", r"\\\1", x) for x in AUTOMATION) + ")")


def is_deleted_repo(repo: Column) -> Column:
    """Owner, or all behind the first slash, is 40 lower-case hex digits or a UUID. Without a slash: no."""
    return repo.rlike(rf"\A{_GONE}/|\A[^/]*/{_GONE}\z")


def normalize_repo(text: Column) -> Column:
    """owner/name from a slug or URL; null unless exactly one slash is left."""
    slug = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    slug = F.regexp_replace(slug, r"\A(?:https://github\.com/|http://github\.com/|github\.com/)", "")
    slug = F.regexp_replace(F.regexp_replace(slug, r"\.git\z", ""), r"/+\z", "")
    return F.when(F.length(slug) - F.length(F.replace(slug, F.lit("/"))) == 1, slug)


def year_month_from_name(name: Column) -> Column:
    """YYYY-MM from the first six digits in a row of a file name; an error without."""
    digits = F.regexp_extract(name, "([0-9]{6})", 1)
    return F.when(digits == "", F.raise_error(F.concat(F.lit("no year and month in "), name)).cast("string")).otherwise(F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2)))


def metric_name(name: str) -> str:
    if name not in METRICS:
        raise ValueError(f"unknown metric {name!r}; known ones are {', '.join(METRICS)}")
    return name


def text_of(variant: Column) -> Column:
    """The string in a VARIANT; null for any other kind of value."""
    return F.when(F.schema_of_variant(variant) == "STRING", F.variant_get(variant, "$", "string"))


def whole_of(variant: Column) -> Column:
    """The unsigned integer in a VARIANT; null for any other value."""
    n = F.when(F.schema_of_variant(variant) == "BIGINT", F.variant_get(variant, "$", "bigint"))
    return F.when(n >= 0, n)
