"""Near-duplicate texts by exact Jaccard similarity of their word shingles.

Candidates share a bucket: a group of fingerprints that the trie links, or some MinHash values; each is then compared by the shingles themselves, so no link is below
the threshold. Equal texts are one class from the start. A bucket of a few classes is compared pair by pair. One of more
classes, whose texts are bounded in bytes, is one group of a task, which counts the shingles that its texts share and gives as many
links as keep the components, so that a dense group's pairs are never listed; no link of such a bucket is lost. In a
bucket beyond that bound, a few rounds compare all classes with two leaders of other components, drawn anew each
round. What they leave apart is cut into buckets of those that share further MinHash values too, twice at most,
which are compared by the same rules. Rounds and cuts only save work: the classes of all buckets beyond the bound that leaders
left apart are joined exactly in the end, by the rarest shingles of which two similar texts always share one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, text_batches, written
from .components import components

#: Words of a shingle, and the least similarity of a link as a fraction.
SHINGLE, SIMILAR = 5, (4, 5)
#: Buckets of a text and MinHash values of a bucket: a pair at 0.8 shares one but for a chance of 3 in a million.
BANDS, ROWS = 24, 4
#: Classes of a bucket that are compared pair by pair, bytes of a larger bucket's texts that are compared in one group, and rounds of leaders beyond that, before the exact join.
PAIRWISE, GROUP_BYTES, ROUNDS = 16, 4 << 20, 3
#: How often larger buckets are cut before the exact join, and by how many of the buckets that follow a bucket: a pair at 0.8 shares one of these but for a chance of 1.5 in a hundred.
CUTS, FOLLOWING = 2, 8
_RNG = np.random.default_rng(5)
SALTS, FACTORS = _RNG.integers(0, 1 << 63, BANDS * ROWS).astype(np.uint64), _RNG.integers(0, 1 << 63, BANDS * ROWS).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def tokens_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()  # as for the fingerprints: only A-Z and ASCII white space count


def shingles_of(tokens: list[bytes]) -> set[bytes]:
    """The distinct shingles; a shorter text is one."""
    return {b" ".join(tokens[i : i + SHINGLE]) for i in range(max(1, len(tokens) - SHINGLE + 1))} if tokens else set()


def bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, from the lowest."""
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def majority(ones: np.ndarray, n: int) -> int:
    """The bits that over half of n hashes have, signed."""
    return int((np.uint64(1) << np.nonzero(2 * ones > n)[0].astype(np.uint64)).sum(dtype=np.uint64).astype(np.int64))


def sketch(text: str | None) -> tuple[int, list[int], int | None]:
    """(hash of the text's words, its MinHash buckets, the fingerprint of its shingles), signed; no buckets and no fingerprint for no words."""
    import xxhash

    tokens = tokens_of(text)
    whole = int(np.uint64(xxhash.xxh64_intdigest(b" ".join(tokens), 42)).astype(np.int64))
    if not tokens:
        return whole, [], None
    h = np.fromiter({xxhash.xxh64_intdigest(x, 42) for x in shingles_of(tokens)}, np.uint64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(h), 1 << 12):
        least = np.minimum(least, ((h[at : at + (1 << 12), None] ^ SALTS) * FACTORS).min(axis=0))
    key = np.arange(BANDS, dtype=np.uint64)
    for x in least.reshape(BANDS, ROWS).T:
        key = (key ^ x) * np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(29)
    return whole, key.view(np.int64).tolist(), majority(bit_counts(h), len(h))


def similar(a: set[bytes], b: set[bytes]) -> bool:
    up, down = SIMILAR
    if min(len(a), len(b)) * down < up * max(len(a), len(b)):
        return False
    both = len(a & b)
    return both * down >= up * (len(a) + len(b) - both)


def alike(texts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for left, right in texts:
        known = {x: shingles_of(tokens_of(x)) for x in {*left, *right}}
        yield pd.Series([similar(known[x], known[y]) for x, y in zip(left, right)], dtype=bool)


def sketched(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame([sketch(x) for x in batch], columns=["cls", "keys", "fp"]).astype({"fp": "Int64"})


def hashed(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Hashes of each text's distinct shingles."""
    import xxhash

    for batch in texts:
        yield pd.Series([np.fromiter({xxhash.xxh64_intdigest(x, 42) for x in shingles_of(tokens_of(text))}, np.uint64).view(np.int64) for text in batch], dtype=object)


def placed_shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle): each text's distinct shingles by number, sorted. Texts shorter than a shingle have none: they are like no other text than their equals."""
    known: dict[bytes, int] = {}
    lengths, numbers = np.zeros(len(texts), np.int64), []
    for i, x in enumerate(texts):
        numbers.append(np.fromiter((known.setdefault(w, len(known)) for w in tokens_of(x)), np.int64))
        lengths[i] = len(numbers[-1])
    words, row = np.concatenate(numbers), np.repeat(np.arange(len(texts)), lengths)
    if len(words) < SHINGLE:
        return words[:0], words[:0]
    ids = words
    for k in range(1, SHINGLE):  # numbers of runs of k words and of the next word name the runs of k + 1, exactly
        ids = np.unique(ids[:-1] * len(known) + words[k:], return_inverse=True)[1]
    inside = row[: len(ids)] == row[SHINGLE - 1 :]
    both = np.unique(row[: len(ids)][inside] * len(words) + ids[inside])
    return both // len(words), both % len(words)


def group_links(texts: list[str | None], labels: np.ndarray) -> list[tuple[int, int]]:
    """As many links (i, j) as join what similar texts and equal labels join.

    A text is compared with all others at once. Those of the largest component needn't be: each pair of two
    components has a text in another one.
    """
    row, shingle = placed_shingles(texts)
    n, (up, down) = len(texts), SIMILAR
    size = np.bincount(row, minlength=n)
    of_row, holders = np.concatenate([[0], np.cumsum(size)]), row[np.argsort(shingle, kind="stable")]
    held = np.bincount(shingle)
    first = np.cumsum(held) - held
    root, waiting, out = np.unique(labels, return_inverse=True)[1], size > 0, []
    while True:
        apart = np.flatnonzero(waiting & (root != np.bincount(root).argmax()))
        if not len(apart):
            return out
        i = apart[0]
        waiting[i] = False
        own = shingle[of_row[i] : of_row[i + 1]]
        each = held[own]
        both = np.bincount(holders[np.repeat(first[own] - np.cumsum(each) + each, each) + np.arange(each.sum())], minlength=n)
        for j in np.flatnonzero((both * down >= up * (size[i] + size - both)) & (root != root[i])):
            if root[j] != root[i]:
                out.append((i, j))
                root[root == root[j]] = root[i]


def grouped_links(bucket: pd.DataFrame) -> pd.DataFrame:
    cls = bucket["cls"].to_numpy(np.int64)
    found = np.array(group_links(bucket["text"].tolist(), bucket["label"].to_numpy(np.int64)), np.int64).reshape(-1, 2)
    return pd.DataFrame({"a": cls[found].min(axis=1), "b": cls[found].max(axis=1)})


def class_texts(texts: DataFrame, needed: DataFrame) -> DataFrame:
    """(cls, text) of the distinct classes of needed. texts: cls and text, repeated for equal texts."""
    return written(texts.join(broadcast_if_small(needed), "cls", "left_semi").groupBy("cls").agg(F.first("text").alias("text")))


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): the distinct pairs whose texts are similar enough. texts: cls and text, repeated for equal texts."""
    pairs = written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    one = class_texts(texts, written(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()))
    both = pairs.join(one.select(F.col("cls").alias("a"), F.col("text").alias("left")), "a").join(one.select(F.col("cls").alias("b"), F.col("text").alias("right")), "b")
    return written(both.where(F.pandas_udf(alike, "boolean")("left", "right")).select("a", "b"))


def labelled(members: DataFrame, found: DataFrame | None) -> DataFrame:
    """members with label, the component of a class over the links found so far."""
    if found is None:
        return members.withColumn("label", F.col("cls"))
    return members.join(components(found).withColumnRenamed("node", "cls"), "cls", "left").select(*members.columns, F.coalesce("component", "cls").alias("label"))


def still_apart(members: DataFrame, found: DataFrame) -> DataFrame:
    """members with label and n, the classes of the key, for keys whose classes lie in several components. members: key and cls."""
    placed = written(labelled(members, found))
    keys = placed.groupBy("key").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key", "n")
    return written(placed.join(broadcast_if_small(written(keys)), "key"))


def led(many: DataFrame, texts: DataFrame, found: DataFrame, by: tuple[str, ...] = ("key",)) -> DataFrame:
    """found and the links that rounds of two leaders a bucket add to it: a dense group becomes one component at little cost, what else is alike is left to the caller. many: key and cls of large buckets. by: what a draw depends on besides class and round; nothing, and buckets of many common classes have common leaders."""
    tested, turn = None, 0
    while True:
        placed = written(labelled(many, found))
        drawn = F.struct(F.xxhash64(*by, "cls", F.lit(turn)).alias("draw"), "cls", "label")
        leaders = placed.groupBy("key").agg(F.min(drawn).alias("one"), F.max(drawn).alias("other"), F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
        pairs = placed.join(leaders, "key").select("cls", "label", F.explode(F.array("one", "other")).alias("leader")).where("label <> leader.label")
        pairs = pairs.select(F.least("cls", "leader.cls").alias("a"), F.greatest("cls", "leader.cls").alias("b")).distinct()
        pairs = written(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"))
        tested = pairs if tested is None else tested.unionByName(pairs)
        new = verified(pairs, texts)
        found, turn = found.unionByName(new), turn + 1
        if turn == ROUNDS or pairs.isEmpty():
            return found


def cut_up(many: DataFrame, members: DataFrame) -> DataFrame:
    """(cls, band, key): buckets of those that share a bucket of many and one of the FOLLOWING next ones of MinHash values."""
    following = members.where("band >= 0").select("cls", F.col("band").alias("next"), F.col("key").alias("too"))
    both = many.join(following, "cls").where(F.pmod(F.col("next") - F.col("band"), F.lit(BANDS)).between(1, FOLLOWING))
    return both.select("cls", F.col("next").alias("band"), F.xxhash64("key", "too").alias("key"))


def rarest(one: DataFrame) -> DataFrame:
    """(key, cls, size): each class with its rarest shingles and their number in all. one: cls and text.

    Similar texts share at least ceil(SIMILAR * size) of either's shingles, and so, in any order of all shingles, one of the
    first size - ceil(SIMILAR * size) + 1 of both. The rarest come first; those of one class only meet nothing and are left out.
    """
    up, down = SIMILAR
    held = written(one.select("cls", F.pandas_udf(hashed, "array<long>")("text").alias("held")))
    each = held.select("cls", F.size("held").alias("size"), F.explode("held").alias("key"))
    often = written(each.groupBy("key").agg(F.count("*").alias("often")).where("often > 1"))
    ranked = each.join(broadcast_if_small(often), "key", "left").withColumn("rank", F.row_number().over(Window.partitionBy("cls").orderBy(F.coalesce("often", F.lit(1)), "key")))
    return written(ranked.where(f"rank <= size - ({up} * size + {down - 1}) DIV {down} + 1 AND often > 1").select("key", "cls", "size"))


def blocks_of(groups: DataFrame) -> DataFrame:
    """groups with one and other: a group's classes in blocks of half of GROUP_BYTES, each with each other block, so that all pairs meet. groups: key, cls and bytes of the text."""
    sized = groups.groupBy("key").agg(F.sum("bytes").alias("all"), F.count("*").alias("n"))
    parts = F.when(F.col("all") <= GROUP_BYTES, 1).otherwise(F.greatest(F.lit(2), F.least("n", F.ceil(2 * F.col("all") / max(1, GROUP_BYTES))))).cast("long")
    own = groups.join(written(sized.select("key", parts.alias("parts"))), "key").withColumn("own", F.pmod(F.xxhash64("cls"), "parts"))
    others = F.expr("filter(sequence(0L, parts - 1), x -> x <> own OR parts = 1)")
    return own.withColumn("with", F.explode(others)).withColumn("one", F.least("own", "with")).withColumn("other", F.greatest("own", "with")).drop("own", "with", "parts")


def joined(rest: DataFrame, texts: DataFrame, found: DataFrame) -> DataFrame:
    """found and links, so that all similar classes of rest are joined, without exception. rest: key and cls of buckets.

    Classes meet at their rarest shingles. A shingle of a few classes gives pairs. The classes of a more common one are compared with
    leaders, which only saves work, and if that leaves some apart, all with all in one group or, beyond GROUP_BYTES of texts, in one group for
    each two blocks.
    """
    one = class_texts(texts, written(still_apart(rest, found).select("cls").distinct()))
    met, (up, down) = still_apart(rarest(one), found), SIMILAR
    few, many = met.where(F.col("n") <= PAIRWISE), met.where(F.col("n") > PAIRWISE).select("key", "cls")
    a, b = (few.select("key", *(F.col(c).alias(f"{x}_{c}") for c in ("cls", "label", "size"))) for x in "ab")
    near = a.join(b, "key").where(f"a_cls < b_cls AND a_label <> b_label AND {down} * least(a_size, b_size) >= {up} * greatest(a_size, b_size)")
    found = found.unionByName(verified(near.select(F.col("a_cls").alias("a"), F.col("b_cls").alias("b")), texts))
    if many.isEmpty():
        return found
    found = led(many, texts, found, by=())
    groups = still_apart(many, found)
    # shingles of the same classes are one group
    keys = groups.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("cls")).alias("all")).groupBy("n", "all").agg(F.min("key").alias("key")).select("key")
    groups = groups.join(broadcast_if_small(written(keys)), "key", "left_semi").join(one.withColumn("bytes", F.octet_length("text")), "cls").select("key", "cls", "label", "bytes", "text")
    return found.unionByName(written(blocks_of(groups).groupBy("key", "one", "other").applyInPandas(grouped_links, "a long, b long").distinct()))


def links(texts: DataFrame, members: DataFrame) -> DataFrame:
    """(a, b): links between classes of equal texts. members: cls, band and key of each bucket that a class lies in; the band of a group that isn't one of MinHash values is -1."""
    at, found, rest = members, None, None
    for cut in range(CUTS + 1):
        placed = labelled(at, found)
        apart = placed.groupBy("key").agg(F.count("*").alias("n"), F.min("cls").alias("a"), F.max("cls").alias("b"), F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
        apart = written(apart.select("key", "n", "a", "b"))
        more = apart.where("n > 2").select("key", "n")
        placed = written(placed.join(broadcast_if_small(more), "key"))
        few, more = placed.where(F.col("n") <= PAIRWISE), placed.where(F.col("n") > PAIRWISE).select("key", "cls", "band", "label")
        one, other = (few.select("key", F.col("cls").alias(x), F.col("label").alias(f"{x}_label")) for x in "ab")
        pairs = one.join(other, "key").where("a < b AND a_label <> b_label").select("a", "b")
        new = verified(apart.where("n = 2").select("a", "b").unionByName(pairs), texts)
        found = new if found is None else found.unionByName(new)
        if more.isEmpty():
            break
        one = class_texts(texts, written(more.select("cls").distinct()))
        sized = more.join(one.select("cls", F.octet_length("text").alias("bytes")), "cls").groupBy("key").agg(F.sum("bytes").alias("bytes"))
        large = written(sized.where(F.col("bytes") > GROUP_BYTES).select("key"))
        many = written(more.join(broadcast_if_small(large), "key", "left_semi").select("key", "cls", "band"))
        groups = more.join(broadcast_if_small(large), "key", "left_anti").join(one, "cls").select("key", "cls", "label", "text")
        found = found.unionByName(written(groups.groupBy("key").applyInPandas(grouped_links, "a long, b long").distinct()))
        if many.isEmpty():
            break
        found = led(many, texts, found)
        left = still_apart(many, found)
        rest = left.select("key", "cls") if rest is None else rest  # all that is cut up later lies in these buckets
        if cut < CUTS:
            at = written(cut_up(left, members))
    return found if rest is None else joined(rest, texts, found)


def near_duplicates(docs: DataFrame, groups: Callable[[DataFrame], DataFrame], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, and component_id (the smallest id reachable over links). groups: (fp, component) of distinct fingerprints.

    Texts link if the Jaccard similarity of their shingles is at least SIMILAR. Null and empty texts and texts of
    white space only are equal texts. Repeated ids and rows give a row each. A null id keeps its row and never names
    a component that has another id. Equal texts are told by 64 bits of hash.
    """
    text_batches(docs.sparkSession)
    rows = written(docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias("text"), F.pandas_udf(sketched, "cls long, keys array<long>, fp long")(F.col(text_col)).alias("s")).select(id_col, "text", "s.*"))
    classes = written(rows.groupBy("cls").agg(F.min(id_col).alias("least"), F.first("keys").alias("keys"), F.first("fp").alias("fp")))
    # a fingerprint's hash is mixed with a number of its own, so that its group is no MinHash bucket
    grouped = groups(written(classes.where("fp IS NOT NULL").select("fp").distinct())).select("fp", F.xxhash64(F.lit(BANDS), "component").alias("key"))
    members = written(classes.select("cls", F.posexplode("keys").alias("band", "key")).unionByName(classes.join(grouped, "fp").select("cls", F.lit(-1).alias("band"), "key")))
    linked = components(links(rows.select("cls", "text"), members)).withColumnRenamed("node", "cls")
    named = classes.select("cls", "least").join(linked, "cls", "left").select("cls", "least", F.coalesce("component", "cls").alias("component"))
    best = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_class = written(named.join(best, "component").select("cls", "component_id"))
    return rows.select(id_col, "cls").join(by_class, "cls").select(id_col, "component_id")
