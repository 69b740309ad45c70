"""The registered queries over the whole tables of sf0.001, against SQL, libraries and brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import pytest
import xxhash

from glossometer.llm import op5_pii as op5
from glossometer.llm import op6_sentencepiece as op6
from glossometer.llm import op9_toxicity as op9
from glossometer.llm import op10_shards as op10
from glossometer.llm import registry

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def result(spark, name):
    return [r.asDict() for r in registry.QUERIES[name](spark, SF).collect()]


@pytest.mark.parametrize("name", list(registry.ORACLES))
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    there = con.execute(registry.ORACLES[name])
    columns = [c[0] for c in there.description]
    flat = lambda row: tuple(round(x, 9) if isinstance(x, float) else x for x in row)
    want = Counter(flat(r) for r in there.fetchall())
    got = result(spark, name)
    assert set(got[0]) == set(columns) and Counter(flat(r[c] for c in columns) for r in got) == want


def test_personal_data(spark, texts):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    got = result(spark, "op5_pii")
    assert len(got) == len(texts)
    for r in got:
        spans = []
        for kind, pattern in patterns.items():
            for m in re.finditer(pattern, texts[r["doc_id"]]):
                digits = re.sub("[^0-9]", "", m.group())
                if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 13 <= len(digits) <= 19 and op5.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                    spans.append((kind, *m.span()))
        said = [f"{k}:{s}:{e}" for k, s, e in spans]
        assert r["base_sha256"] == hashlib.sha256(",".join(said).encode()).hexdigest() and set(said) <= set(r["spans"].split(","))
        assert all(r[f"n_{k}"] == sum(x[0] == k for x in spans) for k in patterns)


def test_pieces(spark, texts):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=op6.default_model())
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for r in result(spark, "op6_sentencepiece"):
        ids = sp.encode(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids)))


def test_fingerprints(spark, texts):
    prints = {}
    for i, t in texts.items():
        w = t.encode().lower().split()
        h = [xxhash.xxh64_intdigest(b" ".join(w[j : j + 3]), 42) for j in range(max(1, len(w) - 2))] if w else []
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    component = {i: i for i in prints}
    while True:
        new = {i: min(component[j] for j in prints if (prints[i] ^ prints[j]).bit_count() <= 2) for i in prints}
        if new == component:
            break
        component = new
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in result(spark, "op7_simhash")}
    assert got == {i: (f"{prints[i]:016x}", component[i]) for i in prints}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


class Plain:
    """The lexicon without an automaton."""

    def __init__(self, words, stems):
        self.words, self.stems = words, set(stems)

    def find(self, token):
        if stem := next((token[:n] for n in range(1, len(token) + 1) if token[:n] in self.stems), None):
            return 0, stem
        near = [(distance(token, w), w) for w in self.words if abs(len(w) - len(token)) <= op9.edits_allowed(w)]
        return min((x for x in near if x[0] <= op9.edits_allowed(x[1])), default=None)


def test_toxicity(spark):
    """Over sf0.01: the smaller table has too few labels for a lexicon."""
    sf = SF.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    model = op9.train(docs, labels)
    assert model.lexicon or model.stems
    model._automaton, model._words = Plain(model.lexicon, model.stems), frozenset(model.lexicon)
    got = {r["doc_id"]: r for r in map(lambda r: r.asDict(), registry.QUERIES["op9_toxicity"](spark, sf).collect())}
    assert set(got) == set(texts)
    for i, t in texts.items():
        sums = [0.0, 0.0, 0.0]
        for _, kind, weight in model.hits(t):
            sums[kind - 1] += weight
        z = model.coef[0] + sum(w * math.log1p(x) for w, x in zip(model.coef[1:], sums))
        score = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
        assert got[i]["score"] == pytest.approx(score) and got[i]["predicted"] == int(score >= 0.7) and got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)


def test_shards(spark, texts):
    got = result(spark, "op10_shards")
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in got} == {(i, len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t in texts.items()} and len(got) == len(texts)
    sizes = Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    assert max(abs(sizes[s] - sum(sizes.values()) / op10.SHARDS) for s in range(op10.SHARDS)) <= max(r["size"] for r in got)
    for s in range(op10.SHARDS):
        slots = [r["slot"] for r in got if r["shard"] == s]
        assert sorted(slots) == list(range(len(slots)))


def test_pipeline_keeps_documents_of_the_table_once(spark, texts):
    import corpus_pipeline

    got = result(spark, "pipeline")
    ids = [r["doc_id"] for r in got]
    assert len(set(ids)) == len(ids) and set(ids) <= set(texts) and len(ids) > len(texts) / 2
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "tokens"]
