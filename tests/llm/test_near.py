"""Near-duplicate operators: vectors (1) and SimHash (7), and components, against brute force."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from glossometer.llm import op1_embeddings as op1
from glossometer.llm import op7_simhash as op7
from glossometer.llm import shingles
from glossometer.llm.components import components

VECTORS = "vec_id long, embedding array<float>, label int"


def least_reachable(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {i: find(i) for i in ids}


def test_components(spark):
    rng = np.random.default_rng(1)
    links = [(i, i + 1) for i in range(100, 160)] + [tuple(map(int, rng.choice(400, 2))) for _ in range(150)] + [(5, 5)]
    want = least_reachable({x for a, b in links if a != b for x in (a, b)}, links)
    got = components(spark.createDataFrame(links, "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors(n=600, width=64, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width))
    x[200:400] = x[:200] + rng.normal(size=(200, width)) * rng.uniform(0.02, 0.4, size=(200, 1))
    x[400:480] = x[0] + rng.normal(size=(80, width)) * 0.05
    x[480:520] = x[1]
    return x.astype(np.float32)


def truth(x):
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = u @ u.T >= op1.THRESHOLD
    np.fill_diagonal(near, False)
    return near


@pytest.mark.parametrize("block", [512, 16])
def test_vectors_against_brute_force(spark, block):
    x = vectors()
    near = truth(x)
    df = spark.createDataFrame([(i, list(map(float, v)), 0) for i, v in enumerate(x)], VECTORS)
    got = {r["vec_id"]: r for r in op1.near_duplicates(df, block=block).collect()}
    want = least_reachable(range(len(x)), zip(*np.nonzero(near)))
    found, there = sum(r["n_links"] for r in got.values()), int(near.sum())
    assert len(got) == len(x) and 0.98 * there <= found <= there  # recall, and no link below the threshold
    assert all(got[i]["n_links"] <= near[i].sum() for i in got)
    assert np.mean([got[i]["component_id"] == want[i] for i in got]) >= 0.98
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())
    assert all(got[i]["component_id"] == want[i] and got[i]["n_links"] >= 39 for i in range(480, 520))  # copies are found for certain


def test_hadamard_keeps_angles_and_buckets_follow_axes():
    x = vectors()[:40]
    y = op1.hadamard(x.astype(float))
    assert np.allclose(x.astype(float) @ x.astype(float).T, y @ y.T)
    assert (op1.buckets(x.astype(float), 2, 8)[:, :, 0] == op1.buckets(3 * x.astype(float), 2, 8)[:, :, 0]).all()
    b = op1.buckets(op1.unit(list(x)), 2, 8)
    assert all(len(set(row)) == b.shape[2] for table in b.transpose(1, 0, 2) for row in table)  # own bucket and visits differ


@pytest.mark.parametrize("k", [1, 2, 3, 4, 5, 6])
def test_pairs_at_the_threshold_meet_for_every_k(k):
    """Pairs of cosine 0.95 exactly: one is in a bucket that the other visits, or in its own. Tables follow from k."""
    rng = np.random.default_rng(k)
    a, b = rng.normal(size=(2, 3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    x, y = (op1.buckets(z, k, op1.TABLES[k - 1]) for z in (a, b))
    met = (x[:, :, :1] == y).any(axis=(1, 2)) | (y[:, :, :1] == x).any(axis=(1, 2))
    assert met.mean() >= 0.99


@pytest.mark.parametrize("k", [3, 4])
def test_recall_with_more_rotations(spark, k):
    x = vectors()
    near = truth(x)
    df = spark.createDataFrame([(i, list(map(float, v)), 0) for i, v in enumerate(x)], VECTORS)
    got = {r["vec_id"]: r for r in op1.near_duplicates(df, k=k).collect()}
    want = least_reachable(range(len(x)), zip(*np.nonzero(near)))
    assert 0.98 * near.sum() <= sum(r["n_links"] for r in got.values()) <= near.sum()
    assert np.mean([got[i]["component_id"] == want[i] for i in got]) >= 0.98


def test_rotations_follow_the_number_of_vectors():
    assert [op1.rotations_for(n, 64) for n in (0, 1, 10, 1000, 50_000, 10**6, 10**8, 10**10)] == [1, 1, 1, 2, 3, 4, 5, 6]


def test_odd_vectors(spark):
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [float("nan"), 1.0], 0), (5, [float("inf"), 1.0], 0), (6, [None, 1.0], 0), (7, [1.0, 2.0], 0), (8, [2.0, 4.0], 0), (8, [2.0, 4.0], 0), (9, [1.0, 2.0, 0.0], 0), (None, [1.0, 2.0], 0), (10, [-1.0, -2.0], 0), (11, [-0.0, 0.0], 0)]
    df = spark.createDataFrame(rows, VECTORS).withColumn("rep", F.lit(1)).withColumn("v", F.lit("x"))
    got = sorted((tuple(r) for r in op1.near_duplicates(df).collect()), key=repr)
    assert len(got) == len(rows)
    assert (7, 2, 7, True) in got and got.count((8, 2, 7, False)) == 2 and (None, 0, None, True) in got
    assert all((i, 0, i, True) in got for i in (1, 2, 3, 4, 5, 6, 9, 10, 11))
    assert op1.near_duplicates(df.limit(0)).count() == 0


def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint(prose):
    for text in (None, "", " \n", "One", "one two", "a b c", "A b\tc\x0bd", prose(1, 500), "É é É é"):
        assert op7.fingerprint_of(text) & (1 << 64) - 1 == plain_fingerprint(text)
    long = prose(2, 70_000)  # more than one part
    assert op7.fingerprint_of(long) & (1 << 64) - 1 == plain_fingerprint(long)


def test_fingerprint_hash_is_xxh64_with_seed_42(spark):
    got = spark.sql("SELECT xxhash64('one two three') AS h").first()["h"]
    assert got & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"one two three", 42)


@pytest.mark.parametrize("leaf", [20_000, 3])
def test_trie_against_all_pairs(spark, leaf):
    rng = np.random.default_rng(2)
    f = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    flip = lambda x: x ^ (np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64))
    f = np.unique(np.concatenate([f, flip(f), flip(flip(f)), flip(flip(flip(f))), f[:1] ^ np.arange(40, dtype=np.uint64)]))
    near = np.triu(np.bitwise_count(f[:, None] ^ f[None, :]) <= 2, 1)
    want = {(int(f[i]), int(f[j])) for i, j in zip(*np.nonzero(near))}
    df = spark.createDataFrame([(int(x),) for x in f.view(np.int64)], "fp long")
    got = {(r["x"] & (1 << 64) - 1, r["y"] & (1 << 64) - 1) for r in op7.close_fingerprints(df, leaf=leaf).collect()}
    assert got == want


def test_simhash_query_against_brute_force(spark, documents, prose, odd):
    base = [prose(i, 120) for i in range(12)]
    texts = base + [t + " more" for t in base] + [t.replace("ba", "ke", 1) for t in base] + base[:3]
    pairs = [(i + 100, t) for i, t in enumerate(texts)] + [x for x in odd if x[0] is not None]
    prints = {}
    for i, t in pairs:
        prints.setdefault(i, set()).add(plain_fingerprint(t))
    nodes = sorted({p for s in prints.values() for p in s})
    root = least_reachable(nodes, [(a, b) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= 2])
    least = {}
    for i, s in prints.items():
        for p in s:
            least[root[p]] = min(i, least.get(root[p], i))
    got = op7.near_duplicates(documents(*pairs).withColumn("fp", F.lit("x")).withColumn("component", F.lit(0))).collect()
    assert len(got) == len(pairs)
    for r in got:
        assert r["component_id"] == least[root[r["fingerprint"] & (1 << 64) - 1]]


def test_spanning_links_keep_the_components(spark):
    f = np.unique(np.random.default_rng(4).integers(0, 1 << 9, 120))
    df = spark.createDataFrame([(int(x) << 50,) for x in f], "fp long")
    every, few = (op7.close_fingerprints(df, few=x) for x in (False, True))
    assert few.count() < every.count()
    assert sorted(map(tuple, components(every, "x", "y").collect())) == sorted(map(tuple, components(few, "x", "y").collect()))


def test_simhash_stage(spark, documents, prose, odd):
    docs = documents((10, prose(1, 90)), (11, prose(1, 90)), (12, prose(2, 90)), *odd)
    kept = op7.stage(spark, docs, "")
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 10 in ids and 11 not in ids and 12 in ids and 1 in ids and 2 not in ids and ids.count(None) == 1
    assert op7.stage(spark, docs.limit(0), "").count() == 0


def test_stage_takes_five_word_similarity(spark, documents):
    def jaccard(a, b):
        x, y = ({tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in (a, b))
        return len(x & y) / len(x | y)

    rng, base, near, far = np.random.default_rng(6), [], [], []
    for i in range(30):
        words = [f"w{x}" for x in rng.integers(0, 10**6, 204)]
        base.append((i, " ".join(words)))
        near.append((100 + i, " ".join("new" if n in (20, 60, 100, 140) else w for n, w in enumerate(words))))  # 20 of 200 shingles: 0.82
        far.append((200 + i, " ".join("new" if n % 33 == 20 else w for n, w in enumerate(words))))  # below
    assert all(jaccard(a, b) >= 0.8 > jaccard(a, c) for (_, a), (_, b), (_, c) in zip(base, near, far))
    # a group too large for its pairs: every copy differs from the first text in two words of its own
    words = [f"v{x}" for x in range(204)]
    group = [(300, " ".join(words))] + [(301 + k, " ".join(f"c{k}" if n in (30 + k, 120 + k) else w for n, w in enumerate(words))) for k in range(60)]
    kept = {r["doc_id"] for r in op7.stage(spark, documents(*base, *near, *far, *group), "").collect()}
    assert kept == {i for i, _ in base} | {i for i, _ in far} | {300}


def test_links_of_a_group_keep_the_components_of_all_pairs(prose):
    rng = np.random.default_rng(3)
    for trial in range(20):
        texts = [None, "a b", "a b c", "a b c d e", "a b c d e f"]
        for i in range(6):
            words = prose(trial * 10 + i, 60).split()
            texts += [" ".join(w if rng.random() > p else f"x{rng.integers(9)}" for w in words) for p in (0, 0.01, 0.02, 0.05, 0.1)]
        texts = list(dict.fromkeys(texts))  # equal texts are one class and never meet
        sets = [shingles.shingles_of(shingles.tokens_of(x)) for x in texts]
        labels = np.array([*range(len(texts) - 1), 3])  # two texts that are joined already

        def components(links):
            root = list(range(len(texts)))
            for a, b in [(3, len(texts) - 1), *links]:
                root = [root[a] if r == root[b] else r for r in root]
            return [root.index(r) for r in root]

        all_pairs = [(i, j) for i in range(len(texts)) for j in range(i) if shingles.similar(sets[i], sets[j])]
        found = shingles.group_links(texts, labels)
        assert components(found) == components(all_pairs) and len(found) < len(texts)
    assert shingles.group_links(["a", "b"], np.array([1, 2])) == []


@pytest.mark.parametrize("group_bytes", [0, shingles.GROUP_BYTES])  # by leaders and cuts, and in one group
def test_large_buckets_of_separate_pairs(spark, prose, monkeypatch, group_bytes):
    """Texts that share a long passage, and so large buckets: 200 separate pairs of alike ones, a dense group and 50 texts like no other."""
    monkeypatch.setattr(shingles, "GROUP_BYTES", group_bytes)
    passage, texts = prose(5000, 150), {}
    for i in range(200):
        words = f"{passage} {prose(i, 60)}".split()
        texts[2 * i], texts[2 * i + 1] = " ".join(words), " ".join(w if k not in (155, 165, 175) else f"other{i}" for k, w in enumerate(words))
    group = f"{passage} {prose(999, 80)}".split()
    texts |= {1000 + i: " ".join([*group[:-1], f"end{i}"]) for i in range(60)} | {2000 + i: f"{passage} {prose(3000 + i, 70)}" for i in range(50)}
    df = spark.createDataFrame(list(texts.items()), "cls long, text string")
    members = [(c, band, k) for c, t in texts.items() for band, k in enumerate(shingles.sketch(t)[1])] + [(c, -1, 1) for c in texts]
    table = spark.createDataFrame(members, "cls long, band int, key long")
    found = {(r["a"], r["b"]) for r in shingles.links(df, table).collect()}
    pairs = {(2 * i, 2 * i + 1) for i in range(200)}
    assert pairs <= found and all(a // 2 == b // 2 for a, b in found if b < 1000)
    assert {a for a, b in found if a >= 2000} == set() and len({x for p in found for x in p if 1000 <= x < 2000}) == 60
    # the bucket of all, cut up by itself: pairs at a similarity of 0.84 meet again, in small buckets
    cut = {}
    for r in shingles.cut_up(table.where("band = -1"), table).collect():
        cut.setdefault(r["key"], set()).add(r["cls"])
    assert sum(any(p <= x for x in cut.values()) for p in map(set, pairs)) >= 0.9 * len(pairs) and max(map(len, cut.values())) < len(texts) / 2


def test_large_buckets_lose_no_link(spark, prose, monkeypatch):
    """One bucket of 60 separate pairs that no MinHash value cuts up: leaders meet some of them, the exact join the rest."""
    monkeypatch.setattr(shingles, "GROUP_BYTES", 0)
    passage, texts = prose(5000, 150), {}
    for i in range(60):
        words = f"{passage} {prose(i, 60)}".split()
        texts[2 * i], texts[2 * i + 1] = " ".join(words), " ".join(w if k not in (155, 165, 175) else f"other{i}" for k, w in enumerate(words))
    members = spark.createDataFrame([(c, -1, 1) for c in texts], "cls long, band int, key long")
    found = {(r["a"], r["b"]) for r in shingles.links(spark.createDataFrame(list(texts.items()), "cls long, text string"), members).collect()}
    assert found == {(2 * i, 2 * i + 1) for i in range(60)}


@pytest.mark.parametrize("group_bytes", [2000, shingles.GROUP_BYTES])  # in pairs of blocks, and in one group
def test_exact_join_of_texts_without_rare_shingles(spark, prose, monkeypatch, group_bytes):
    """Texts made of common passages: even their rarest shingles are common."""
    monkeypatch.setattr(shingles, "GROUP_BYTES", group_bytes)
    monkeypatch.setattr(shingles, "PAIRWISE", 2)
    monkeypatch.setattr(shingles, "ROUNDS", 1)
    rng, passages = np.random.default_rng(8), [prose(7000 + i, 25) for i in range(9)]
    texts = {}
    for i in range(14):
        words = " ".join(passages[k] for k in rng.permutation(9)[:6]).split()
        texts[2 * i], texts[2 * i + 1] = " ".join(words), " ".join(w if k not in (5, 60, 110) else f"own{i}" for k, w in enumerate(words))
    texts |= {100: "a b", 101: "a a a a a a", 102: "a a a a a a a", 103: "a b c d e"}
    df = spark.createDataFrame(list(texts.items()), "cls long, text string")
    sets = {c: shingles.shingles_of(shingles.tokens_of(x)) for c, x in texts.items()}
    want = least_reachable(texts, [(a, b) for a in texts for b in texts if a < b and shingles.similar(sets[a], sets[b])])
    none = spark.createDataFrame([], "a long, b long")
    found = shingles.joined(df.select(F.lit(1).alias("key"), "cls"), df, none).collect()
    assert all(shingles.similar(sets[r["a"]], sets[r["b"]]) for r in found)
    assert least_reachable(texts, map(tuple, found)) == want and len(set(want.values())) < len(texts) - 14
    met = shingles.rarest(df).groupBy("key").agg(F.count("*").alias("n"))
    assert met.where("n > 4").count() > 0


def test_pairs_count_in_one_bucket_only():
    rng = np.random.default_rng(2)
    for x, y in zip(*rng.integers(0, 5, (2, 500, 6, 3))):
        buckets = {(t, k) for t in range(6) for k in (x[t, 0], y[t, 0]) if k in x[t] and k in y[t]}
        owners = [b for b in buckets if op1.owned(x[None], y[None], np.array([b[0]]), np.array([x[b[0], 0] == b[1]]))[0]]
        assert len(owners) == bool(buckets)


def test_a_chain_of_many_classes_isnt_compared_all_with_all(spark):
    """20,000 vectors on a closed curve: one component whose classes have some eight links each. The numbers of links are counted where pairs meet, in a fraction of its 200 million pairs."""
    n = 20_000
    angle = np.arange(n) * 2 * np.pi / n
    x = np.stack([np.cos(f * angle) for f in range(101, 133)] + [np.sin(f * angle) for f in range(101, 133)], axis=1)
    near = {d for d in range(1, 200) if np.cos(np.arange(101, 133) * d * 2 * np.pi / n).mean() >= op1.THRESHOLD}
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(n), "embedding": x.astype(np.float32).tolist(), "label": 0}), VECTORS)
    got = op1.near_duplicates(df).toPandas()
    assert (got["component_id"] == 0).mean() > 0.99 and abs(got["n_links"].mean() / (2 * len(near)) - 1) < 0.02 and got["n_links"].max() <= 2 * len(near) + 2
