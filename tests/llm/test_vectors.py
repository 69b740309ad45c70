"""Fingerprints of documents, hard negatives and whitening, against brute force."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from glossometer.llm import op11_fingerprints as op11
from glossometer.llm import op12_negatives as op12
from glossometer.llm import op13_whitening as op13
from glossometer.llm import registry

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, label int, embedding array<float>, score string, id string, `a.b` int"


@pytest.fixture(scope="module")
def vectors(spark):
    """An embeddings table with clashing columns from (vec_id, label, vector)."""
    return lambda *table: spark.createDataFrame([(i, label, v, "x", "y", 1) for i, label, v in table], SCHEMA)


# ---- fingerprints


def shared(a, b):
    return next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))


def test_extensions_and_spans(prose):
    """Every span equality and longest common extension, against the texts themselves."""
    rng = random.Random(4)
    for n in range(60):
        a = prose(n, 30) if n % 3 else "ab" * 40 + "é" * 20
        b = a[: rng.randrange(len(a))] + rng.choice(["", "x", a[5:30], "\x00", "𝔸"]) + a[rng.randrange(len(a)) :]
        x, y = op11.Prefixes(a), op11.Prefixes(b)
        for _ in range(40):
            i, j = rng.randrange(len(a) + 1), rng.randrange(len(b) + 1)
            k = rng.randrange(min(len(a) - i, len(b) - j) + 1)
            assert (x.span(i, i + k) == y.span(j, j + k)) == (a[i : i + k] == b[j : j + k])
            assert op11.common_extension(x, i, y, j) == shared(a[i:], b[j:])
        i, k = rng.randrange(len(a) + 1), rng.randrange(len(b) + 1)
        joined = x.followed(i, y, k)
        assert [list(s) for s in joined.sums] == [list(s) for s in op11.Prefixes(a[:i] + b[:k]).sums]


def test_likeness(prose):
    near = lambda a, b: op11.likeness(op11.Fingerprint.of(a), op11.Fingerprint.of(b))
    a, b = prose(1, 800), prose(2, 800)
    words = a.split()
    assert near(a, a) == 1 and near("", "") == 1 and near("", a) == 0 and near(a, b) < 0.02
    assert near(a, "A new beginning. " + a) > 0.9 and near(a, a + b[:200]) > 0.9  # moved, and longer
    assert near(a, " ".join(words[400:] + words[:400])) > 0.8  # halves exchanged
    assert near(a, a[: len(a) // 2]) == pytest.approx(0.5, abs=0.05)
    assert near(a, " ".join(w if k % 160 else "new" for k, w in enumerate(words))) > 0.6
    assert near("x" * 9000, "x" * 9000 + "y") > 0.9 and near("x", "y") == 0 and near("abcd", "abcx") == 0.75
    once, often = "one line that comes back\n", "one line that comes back\n" * 300
    assert near(once, often) == near(often, once) < 0.01
    for x, y in ((a, b), (a, a[100:]), (often, once * 200 + a)):
        f, g = op11.Fingerprint.of(x), op11.Fingerprint.of(y)
        again = op11.Fingerprint.parse(str(f)), op11.Fingerprint.parse(str(g))
        assert op11.likeness(*again) == op11.likeness(f, g) and 0 <= op11.likeness(f, g) <= 1
        assert len(str(f)) <= 4 * 12 * (op11.GRID + op11.DRAWN + 2) // 3 + 4


def test_likeness_of_repetitive_texts():
    """Common spans that overlap the common beginning or end, or each other, count no place twice."""
    rng = random.Random(8)
    for _ in range(400):
        parts = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 40))) for _ in range(4)]
        x, y = ("".join(rng.choice(parts) for _ in range(rng.randrange(1, 60))) for _ in range(2))
        f, g = op11.Fingerprint.of(x), op11.Fingerprint.of(y)
        assert 0 <= op11.likeness(f, g) <= min(len(x), len(y)) / max(len(x), len(y)) and op11.likeness(f, f) == 1


def check_fingerprints(pairs, got):
    """got against the definition: pairs (id, text)."""
    first = {}
    for i, t in pairs:
        if i is not None:
            first.setdefault(i, set()).add(t or "")
    ids = sorted(first)
    assert len(got) == len(pairs)
    for r in got:
        own = {t or "" for i, t in pairs if i == r["doc_id"] and len(t or "") == r["n_chars"]}
        after = first[ids[(ids.index(r["doc_id"]) + 1) % len(ids)]] if r["doc_id"] is not None else own
        new = {x[: len(x) - len(x) // 4] + y[: len(x) // 4] for x in own for y in after}
        assert r["edited_sha256"] in {hashlib.sha256(x.encode()).hexdigest() for x in new}
        f, g = op11.Fingerprint.parse(r["fingerprint"]), op11.Fingerprint.parse(r["edited_fingerprint"])
        assert r["fingerprint"] in {str(op11.Fingerprint.of(x)) for x in own} and r["edited_fingerprint"] in {str(op11.Fingerprint.of(x)) for x in new}
        assert r["near_edited"] == op11.likeness(f, g) and r["near_next"] in {op11.likeness(f, op11.Fingerprint.of(y)) for y in after}
        assert r["common_prefix"] in {shared(x, y) for x in own for y in new}


def test_registered_fingerprints(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = [r.asDict() for r in registry.QUERIES["op11_fingerprints"](spark, SF).collect()]
    check_fingerprints(docs, got)
    assert sum(r["near_edited"] > 0.6 for r in got) >= 0.98 * len(got) and sum(r["near_next"] < 0.2 for r in got) > 0.9 * len(got)


def test_fingerprints_of_odd_rows(spark, documents, odd):
    docs = documents(*odd, *((i, f"text number {i}") for i in range(20, 60))).withColumn("place", F.lit("p")).withColumn("a.b", F.lit(1)).withColumn("fingerprint", F.lit(2))
    check_fingerprints([*odd, *((i, f"text number {i}") for i in range(20, 60))], [r.asDict() for r in op11.fingerprints(docs, rows_a_range=5).collect()])
    assert op11.fingerprints(documents()).count() == 0
    check_fingerprints([(9, "just one")], [r.asDict() for r in op11.fingerprints(documents((9, "just one"))).collect()])
    check_fingerprints([(None, "no id"), (None, None)], [r.asDict() for r in op11.fingerprints(documents((None, "no id"), (None, None))).collect()])


def test_fingerprints_do_not_depend_on_ranges(spark, documents, prose):
    pairs = [(i * 7 % 101 - 50, prose(i % 13, 20)) for i in range(101)]
    few, many = (rows(op11.fingerprints(documents(*pairs).repartition(n), rows_a_range=k)) for n, k in ((1, 1000), (7, 2)))
    assert few == many


# ---- hard negatives


def listed(df):
    return sorted(tuple(r) for r in df.collect())


def mined(table, anchors, n_pos=5, n_neg=5, low=80, high=100):
    best = {}
    for i, label, v in table:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v):
            row = (label, [math.floor(256 * float(np.float32(x))) for x in v])
            best[i] = min(best.get(i, row), row)
    out = []
    for a in filter(anchors, best):
        label, v = best[a]
        scores = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in best.items() if len(w) == len(v))
        for ps, p, _ in [s for s in scores if s[2] == label and s[1] != a][:n_pos]:
            found = [s for s in scores if s[2] != label and low * -ps <= 100 * -s[0] <= high * -ps][:n_neg]
            out += [(a, p, k, i, -ps, -s) for k, (s, i, _) in enumerate(found, 1)]
    return sorted(out)


def test_hard_negatives(spark, vectors):
    rng = np.random.default_rng(3)
    table = [(i, int(rng.integers(3)), [float(x) for x in rng.integers(-2, 4, 4) / 4]) for i in range(150)]  # many ties
    table += [(150 + i, 1, table[0][2]) for i in range(60)]  # copies
    table += [(300, None, [1.0] * 4), (301, 1, None), (302, 1, [1.0, None, 1.0, 1.0]), (303, 1, [1.0, float("nan"), 1.0, 1.0]), (304, 1, []), (None, 1, [1.0] * 4), (310, 1, [1.0] * 3), (320, 1, [0.5] * 3), (330, 0, [0.4] * 3)]
    table += [(10, 0, [9.0] * 4), (10, 2, [1.0] * 4), table[20]]
    for size in ({}, {"anchor_rows": 3, "cell_rows": 16}):
        assert listed(op12.hard_negatives(vectors(*table), F.col("id") % 10 == 0, **size)) == mined(table, lambda i: i % 10 == 0)
    assert listed(op12.hard_negatives(vectors(*table), F.col("id") % 10 == 0, n_positives=2, n_negatives=9, low=10, high=150)) == mined(table, lambda i: i % 10 == 0, 2, 9, 10, 150)
    assert op12.hard_negatives(vectors(), F.col("id") % 10 == 0).count() == 0


def test_merges_of_many_cells(spark, vectors, monkeypatch):
    monkeypatch.setattr(op12, "MERGED", 2)
    rng = np.random.default_rng(5)
    table = [(i, i % 2, [float(x) for x in rng.integers(-3, 4, 3)]) for i in range(80)]
    assert listed(op12.hard_negatives(vectors(*table), F.col("id") % 20 == 0, cell_rows=9)) == mined(table, lambda i: i % 20 == 0)


def test_large_scores():
    big = np.array([[3 << 26, 1]])
    assert op12.integer_scores(big, big)[0, 0] == (3 << 26) ** 2 + 1
    with pytest.raises(OverflowError):
        op12.integer_scores(np.array([[1 << 40]]), np.array([[1 << 40]]))


# ---- whitening


def check_whitening(table, got, components=8):
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in table], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    c = (x - sums / n).astype(float) if len(set(sums)) else x
    v = c.T @ c / n
    e, z = (a[..., ::-1] for a in np.linalg.eigh(v))
    k = min(components, len(e))
    assert len(got) == n * k
    by_id = {}
    for r in got:
        by_id.setdefault((r["vec_id"], r["component"]), []).append(r)
    white = np.zeros((n, k))
    for row, (i, _) in enumerate(table):
        for j in range(k):
            r = by_id[i, j + 1][0]
            assert r["n"] == n and r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(x[row], sums))
            assert r["explained"] == pytest.approx(e[j] / np.trace(v), rel=1e-6) and r["identity_error"] <= 1e-10 and r["residual"] <= 1e-12
            white[row, j] = r["whitened"]
    want = c @ z[:, :k] / np.sqrt(e[:k])
    sign = np.sign((white * want).sum(axis=0))
    gaps = np.abs(np.diff(e)).min() / e[0]
    assert np.abs(white * sign - want).max() < 1e-11 / gaps


def test_registered_whitening(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check_whitening(table, [r.asDict() for r in registry.QUERIES["op13_whitening"](spark, SF).collect()])


def test_whitening_of_odd_rows(spark, vectors):
    rng = np.random.default_rng(9)
    good = [(i, None, [float(x) for x in rng.standard_normal(5) * (5, 4, 3, 2, 1)]) for i in range(40)]
    odd = [(50, 1, None), (51, 1, []), (52, 1, [1.0, None, 1.0, 1.0, 1.0]), (53, 1, [float("inf")] * 5), (54, 1, [1.0] * 3)]
    got = [r.asDict() for r in op13.whitened(vectors(*good, *odd)).collect()]
    check_whitening([(i, v) for i, _, v in good], got)
    assert op13.whitened(vectors()).count() == 0 and op13.whitened(vectors(*odd[:4])).count() == 0
    assert op13.whitened(vectors((1, 1, [1.0, 2.0]), (2, 1, [1.0, 2.0]))).count() == 0  # no variance
    flat = op13.whitened(vectors(*((i, 1, [float(i), 1.0, 2.0 * i]) for i in range(9)))).collect()  # one direction only
    assert {r["component"] for r in flat} == {1} and flat[0]["explained"] == pytest.approx(1)
    repeated = op13.whitened(vectors(*good, good[0], (None, 1, good[1][2]))).collect()
    assert len(repeated) == 42 * 5 and {r["vec_id"] for r in repeated} == {None, *range(40)}


def test_block_iterations_reach_rounding():
    rng = np.random.default_rng(0)
    for width, kind in ((200, "flat"), (120, "decay"), (64, "same"), (3, "flat")):
        c = rng.standard_normal((700, width)) * (1 / np.arange(1, width + 1) if kind == "decay" else 1)
        if kind == "same":
            c[:, 1], c[:, 5] = c[:, 0], 0
        v = c.T @ c / len(c)
        e, z, residual = op13.leading(lambda b: v @ b, width, min(8, width))
        assert residual <= 1e-13 and np.abs(e / np.linalg.eigvalsh(v)[::-1][: len(e)] - 1).max() < 1e-12
        assert np.abs(z.T @ z - np.eye(len(e))).max() < 1e-13
    with pytest.raises(ArithmeticError):
        op13.leading(lambda b: v @ b + rng.standard_normal(b.shape), 3, 1, 0, steps=5)


def test_block_iterations_end_where_rounding_is_coarse():
    """Residuals that stop falling short of what is sought are certified and returned, whatever the first ones were."""
    for seed in range(5):
        rng, calls = np.random.default_rng(seed), []
        c = rng.standard_normal((700, 200))
        v = c.T @ c / len(c)

        def product(b, v=v, rng=rng, calls=calls):
            calls.append(1)
            return v @ b * (1 + 1e-13 * rng.standard_normal(b.shape))

        e, z, residual = op13.leading(product, 200, 8)
        assert residual <= 1e-11 and len(calls) < 200
        assert np.abs(e / np.linalg.eigvalsh(v)[::-1][:8] - 1).max() < 1e-11
