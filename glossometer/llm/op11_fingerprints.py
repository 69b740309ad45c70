"""Document fingerprints by prefix polynomial hashes.

A text's prefix array holds the sums of (code point + 1) * base^place modulo two primes. Any span's hash comes from two
of its entries, so spans of any texts compare in constant time, and the longest common extension of two places is
found by binary search. A fingerprint is a bounded extract of that array: the prefix hashes at some marks. Marks are
the places of a grid whose step is a power of two, and the places of the text's least grams, which stay with their
words when text before them changes. Spans between marks compare as spans of texts do: how alike two fingerprints
are is the share of the longer text that lies in common spans, each found as the longest common extension of two marks.

Texts are dealt to ranges of ids and stream through each range from the largest id down, so that a document's
successor has come by just before it; a range's own successor visits it from the next one.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_batches

#: Two primes below 2^31, so that products fit 64 bits, and the bases' powers and inverse powers are taken modulo them.
PRIMES, BASES = (2147483647, 2147483629), (1268071943, 1847204399)
#: Marks of the grid (half as many at least) and of grams, code points of a gram, and the shortest common span that counts inside a text.
GRID, DRAWN, GRAM, LEAST = 32, 32, 16, 16
#: Rows of a range of ids on average (there are four ranges to a shuffle partition at least), and drawn ids to a range.
ROWS_A_RANGE, DRAWS = 1_000_000, 16


class Powers:
    """base^0, base^1, ... modulo a prime, as far as they were asked for."""

    def __init__(self, base: int, prime: int):
        self.base, self.prime, self.known = base, prime, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.known) <= n:
            self.known = np.concatenate([self.known, self.known * pow(self.base, len(self.known), self.prime) % self.prime])
        return self.known


UP = tuple(Powers(b, p) for b, p in zip(BASES, PRIMES))
DOWN = tuple(Powers(pow(b, -1, p), p) for b, p in zip(BASES, PRIMES))


class Prefixes:
    """The prefix arrays of a text."""

    def __init__(self, text: str):
        c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        self.n, self.sums = len(c), []
        for up, prime in zip(UP, PRIMES):
            s = np.zeros(self.n + 1, np.uint64)
            np.cumsum(c * up.upto(self.n)[: self.n] % prime, out=s[1:])  # below 2^64 for 2^33 code points
            self.sums.append(s % prime)

    def followed(self, end: int, other: Prefixes, k: int) -> Prefixes:
        """The prefix arrays of the first `end` code points followed by the first k of the other text."""
        new = Prefixes.__new__(Prefixes)
        new.n = end + k
        new.sums = [np.concatenate([s[: end + 1], (o[1 : k + 1] * up.upto(end)[end] + s[end]) % p]) for s, o, up, p in zip(self.sums, other.sums, UP, PRIMES)]
        return new

    def span(self, start: int, end: int) -> tuple[int, int]:
        """The hash of a span, whatever its place."""
        (s, t), (d, e), (p, q) = self.sums, DOWN, PRIMES
        return (int(s[end]) - int(s[start])) * int(d.upto(start)[start]) % p, (int(t[end]) - int(t[start])) * int(e.upto(start)[start]) % q


def common_extension(x: Prefixes, i: int, y: Prefixes, j: int) -> int:
    """How many code points x from place i and y from place j have in common, by binary search."""
    low, high = 0, min(x.n - i, y.n - j)
    while low < high:
        middle = (low + high + 1) // 2
        if x.span(i, i + middle) == y.span(j, j + middle):
            low = middle
        else:
            high = middle - 1
    return low


class Fingerprint:
    """Marks of a text, ascending, with the prefix hashes there; the first is 0, the last the text's length."""

    def __init__(self, at: np.ndarray, sums: list[np.ndarray]):
        self.n = int(at[-1])
        self.packed = np.stack([at.astype(np.uint64), *sums])
        self.at, self.one, self.two = self.packed.tolist()
        self.down_one, self.down_two = (down.upto(self.n)[at].tolist() for down in DOWN)

    @classmethod
    def of(cls, text: str | Prefixes) -> Fingerprint:
        p = text if isinstance(text, Prefixes) else Prefixes(text)
        if p.n <= GRID + DRAWN:
            at = np.arange(p.n + 1)
        else:
            at = np.unique(np.concatenate([np.arange(0, p.n, 1 << ((p.n - 1) // GRID).bit_length()), least_grams(p), [p.n]]))
        return cls(at, [s[at] for s in p.sums])

    def __str__(self) -> str:
        """Base64 of each mark's place and two hashes, four bytes each."""
        return base64.b64encode(self.packed.T.astype(">u4").tobytes()).decode()

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        a = np.frombuffer(base64.b64decode(text), ">u4").reshape(-1, 3)
        return cls(a[:, 0].astype(np.int64), [a[:, 1].astype(np.uint64), a[:, 2].astype(np.uint64)])

    def span(self, i: int, j: int) -> tuple[int, int]:
        """The hash of the span between two marks."""
        return (self.one[j] - self.one[i]) * self.down_one[i] % PRIMES[0], (self.two[j] - self.two[i]) * self.down_two[i] % PRIMES[1]

    @cached_property
    def spans(self) -> tuple[list[int], list[int], set[int]]:
        """(hashes, the marks at which they begin, the hashes once) of the spans from each mark to the first three that are LEAST away or more."""
        at = self.packed[0]
        begin = np.repeat(np.arange(len(at)), 3)
        end = np.searchsorted(at, at[begin] + np.uint64(LEAST)) + np.tile(np.arange(3), len(at))
        begin, end = begin[end < len(at)], end[end < len(at)]
        one, two = ((s[end] + np.uint64(p) - s[begin]) * down.upto(self.n)[at[begin].astype(np.int64)] % p for s, down, p in zip(self.packed[1:], DOWN, PRIMES))
        keys = (one << np.uint64(31) | two) ^ (at[end] - at[begin]) * np.uint64(0x9E3779B97F4A7C15)
        listed = keys.tolist()
        return listed, begin.tolist(), set(listed)

    def starts(self, keys: set[int]) -> dict[int, list[int]]:
        """The marks at which spans of these hashes begin."""
        found: dict[int, list[int]] = {key: [] for key in keys}
        for key, i in zip(*self.spans[:2]):
            if key in found:
                found[key].append(i)
        return found


def least_grams(p: Prefixes) -> np.ndarray:
    """The first places of the DRAWN distinct grams with the least hashes (all, if there are fewer)."""
    s, prime = p.sums[0], PRIMES[0]
    h = (s[GRAM:] + np.uint64(prime) - s[:-GRAM]) * DOWN[0].upto(p.n)[: p.n - GRAM + 1] % prime
    below = 4 * DRAWN * prime // len(h)
    while True:  # the least ones of all, but only those below a bound are sorted
        at = np.flatnonzero(h <= below)
        values, first = np.unique(h[at], return_index=True)
        if len(values) >= DRAWN or below >= prime:
            return at[first[:DRAWN]]
        below *= 16


def extension(f: Fingerprint, i: int, g: Fingerprint, j: int, most: int, back: bool = False) -> int:
    """The longest span that both have from (back: up to) marks i and j, as far as the marks tell, at most `most` long: binary search over the lengths that both have marks for."""
    x, y = f.at[i], g.at[j]
    if back:
        a, b = {x - p: k for k, p in enumerate(f.at[: i + 1])}, {y - p: k for k, p in enumerate(g.at[: j + 1])}
    else:
        a, b = {p - x: k for k, p in enumerate(f.at[i:], i)}, {p - y: k for k, p in enumerate(g.at[j:], j)}
    lengths = sorted(n for n in a.keys() & b.keys() if n <= most)
    low, high = 0, len(lengths) - 1
    while low < high:
        middle = (low + high + 1) // 2
        k, m = a[lengths[middle]], b[lengths[middle]]
        if f.span(min(i, k), max(i, k)) == g.span(min(j, m), max(j, m)):
            low = middle
        else:
            high = middle - 1
    return lengths[low]


def likeness(f: Fingerprint, g: Fingerprint) -> float:
    """The share of the longer text in common spans: those that both begin and end with, and between these, from left to right, spans that start at marks of both and are LEAST long; no place counts twice. Equal texts are 1, an empty text and another one 0."""
    if (f.n, f.one[-1], f.two[-1]) == (g.n, g.one[-1], g.two[-1]):
        return 1.0
    least = min(f.n, g.n)
    if not least:
        return 0.0
    front = extension(f, 0, g, 0, least)
    behind = extension(f, len(f.at) - 1, g, len(g.at) - 1, least - front, back=True)
    shared, begin, end, taken = front + behind, front, f.n - behind, [(0, front), (g.n - behind, g.n)]
    met = f.spans[2] & g.spans[2] if least >= LEAST else set()
    there = g.starts(met) if met else {}
    for key, i in zip(*f.spans[:2]) if met else ():
        start = f.at[i]
        if not begin <= start < end or key not in met:
            continue
        best = (0, 0)
        for j in there[key]:
            q = g.at[j]
            if not any(a <= q < b for a, b in taken):
                best = max(best, (extension(f, i, g, j, min(end - start, min(a for a, b in [*taken, (g.n, g.n)] if a >= q) - q)), -q))
        if best[0] >= LEAST:
            shared, begin = shared + best[0], start + best[0]
            taken.append((-best[1], -best[1] + best[0]))
    return shared / max(f.n, g.n)


class Seen:
    """A text with its fingerprint."""

    def __init__(self, text: str, prefixes: Prefixes | None = None):
        self.text, self.prefixes = text, prefixes or Prefixes(text)
        self.print = Fingerprint.of(self.prefixes)
        self.said = str(self.print)

    def edited(self, after: Seen) -> Seen:
        """This text with its last quarter replaced by as much of the other text's beginning."""
        end = len(self.text) - len(self.text) // 4
        k = min(len(self.text) - end, len(after.text))
        return Seen(self.text[:end] + after.text[:k], self.prefixes.followed(end, after.prefixes, k))


#: What `compared` yields for a text and its successor.
RESULT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, common_prefix long"


def compared(own: Seen, after: Seen) -> tuple:
    new = own.edited(after)
    sha = hashlib.sha256(new.text.encode("utf-8", "surrogatepass")).hexdigest()
    return own.prefixes.n, sha, own.said, new.said, likeness(own.print, new.print), likeness(own.print, after.print), common_extension(own.prefixes, 0, new.prefixes, 0)


def streamed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows by range, visitors first, then ids from the largest. An id's successor is the last row of the larger id before it."""
    names = ["id", *(x.split()[0] for x in RESULT.split(", "))]
    at = before = last = None
    for batch in batches:
        out = []
        for place, visits, i, text in zip(batch["place"], batch["visits"], batch["id"], batch["text"]):
            own, key = Seen(text), (place, bool(visits), i)
            if place == -1:  # no id: its own successor
                out.append((None, *compared(own, own)))
                continue
            if key != at:
                before = last if at is not None and at[0] == place else None
                at = key
            last = own
            if not visits:
                out.append((i, *compared(own, before)))
        yield pd.DataFrame(out, columns=names).astype({"id": "Int64"})


def placed(ids: DataFrame, rows_a_range: int):
    """(how to place ids, a pandas UDF): the range of an id, and the range that it visits since it is the first of the next one. ids: a column id without nulls."""
    spark, n = ids.sparkSession, ids.count()
    ranges = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // rows_a_range))
    chance = F.pmod(F.xxhash64("id"), F.lit(1 << 53)) / float(1 << 53)
    drawn = np.array(sorted({r["id"] for r in ids.where(chance < ranges * DRAWS / max(1, n)).collect()}), np.int64)  # DRAWS to a range
    bounds = np.unique(drawn[len(drawn) * np.arange(1, ranges) // ranges]) if len(drawn) else drawn

    @F.pandas_udf("long")
    def range_of(i: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, i.to_numpy(np.int64), "right"))

    found = sorted(tuple(r) for r in ids.select("id", range_of("id").alias("place")).groupBy("place").agg(F.min("id").alias("first")).collect())  # a row per range
    firsts, homes = np.array([x[1] for x in found], np.int64), np.array([x[0] for x in found], np.int64)

    @F.pandas_udf("place long, target long")
    def place(i: pd.Series) -> pd.DataFrame:
        known, out = i.notna().to_numpy(), pd.DataFrame({"place": np.full(len(i), -1), "target": pd.array([None] * len(i), "Int64")})
        if known.any():
            v = i[known].to_numpy(np.int64)
            out.loc[known, "place"] = np.searchsorted(bounds, v, "right")
            at = np.minimum(np.searchsorted(firsts, v), len(firsts) - 1)
            out.loc[known, "target"] = pd.array(np.where(firsts[at] == v, homes[at - 1], 0), "Int64")
            out.loc[np.flatnonzero(known)[firsts[at] != v], "target"] = pd.NA
        return out

    return place


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_a_range: int = ROWS_A_RANGE) -> DataFrame:
    """One row per row of docs: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, common_prefix.

    The edited text has its last quarter of code points replaced by as many from the beginning of the next document:
    that of the next larger id, and after the largest the smallest. common_prefix is the number of code points with
    which the text and the edited one begin alike. Likenesses come from the fingerprints alone.

    Null texts are empty ones. Of rows that repeat an id, the one with the least hash of its text is the next document
    of the id before; all have the same next one. A row with a null id is its own next document, and a table with one id only is
    followed by itself. An empty table gives no rows. Other columns are ignored. Rows of one id, or without any, are
    never held together. docs is read for its ids alone first.
    """
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    place = placed(rows.select("id").where("id IS NOT NULL"), rows_a_range)
    each = rows.select("id", "text", place("id").alias("p")).select("id", "text", F.explode(F.filter(F.array(F.struct(F.col("p.place").alias("place"), F.lit(False).alias("visits")), F.struct(F.col("p.target").alias("place"), F.lit(True).alias("visits"))), lambda x: x["place"].isNotNull())).alias("p")).select("id", "text", "p.*")
    # rows without an id need no order: their texts' hashes deal them
    dealt = each.withColumn("hash", F.xxhash64("text")).repartition("place", F.when(F.col("place") == -1, F.col("hash")))
    ordered = dealt.sortWithinPartitions("place", F.desc("visits"), F.desc("id"), F.desc("hash")).select("place", "visits", "id", "text")
    return ordered.mapInPandas(streamed, f"id long, {RESULT}").withColumnRenamed("id", id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
