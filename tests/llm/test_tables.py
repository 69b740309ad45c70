"""WARC records (3), shards (10) and the pipeline."""

from __future__ import annotations

import gzip
import hashlib
import re
import time
import zlib
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from glossometer.llm import op3_warc as op3
from glossometer.llm import op10_shards as op10
from glossometer.llm import registry

PAGES = "page_id long, url string, html string"


# ---- WARC


def parsed(data: bytes):
    """Records of a WARC file as (headers, block)."""
    out = []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        headers = dict(x.split(": ", 1) for x in lines[1:])
        n = int(headers["Content-Length"])
        assert rest[n : n + 4] == b"\r\n\r\n"
        out.append((headers, rest[:n]))
        data = rest[n + 4 :]
    return out


def test_records_and_files(spark, tmp_path):
    html = "<html><head><title>T &amp; t</title><script>var x='</p>';</script></head><body><!-- no --><p>One &lt;two&gt;<br>three<p>é   four</body>"
    rows = [(1, "http://a.example/", html), (2, None, "plain"), (3, "http://b.example/\r\nX: y", None), (4, "http://c.example/", ""), (4, "http://c.example/", ""), (None, "u", "<p>" + "word " * 100_000)]
    pages = spark.createDataFrame(rows, PAGES).withColumn("record_id", F.lit("x")).withColumn("id", F.lit("y"))
    records = op3.derive(op3.responses(pages))
    got = [r.asDict() for r in records.collect()]
    assert Counter(r["record_type"] for r in got) == {"response": 6, "metadata": 6, "conversion": 6}
    ids = {r["record_id"] for r in got if r["record_type"] == "response"}
    assert all(r["refers_to"] in ids for r in got if r["record_type"] != "response") and all(re.fullmatch(r"urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", r["record_id"]) for r in got)
    op3.write_warc(records, str(tmp_path / "warc"))
    written = [x for f in sorted(Path(tmp_path / "warc").glob("*.gz")) for x in parsed(gzip.decompress(f.read_bytes()))]
    assert len(written) == 18
    for headers, block in written:
        assert headers["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(block).hexdigest() and "X" not in headers
    one = {h["WARC-Type"]: (h, b) for h, b in written if h.get("WARC-Target-URI") == "http://a.example/"}
    assert one["conversion"][1].decode() == "One <two>\nthree\né four"
    source = "sha256:" + hashlib.sha256(html.encode()).hexdigest()
    assert one["conversion"][0]["WARC-Refers-To"] == one["response"][0]["WARC-Record-ID"] and one["conversion"][0]["WARC-Source-Payload-Digest"] == source == one["response"][0]["WARC-Payload-Digest"]
    assert all(one[k][0]["WARC-Payload-Digest"] == one[k][0]["WARC-Block-Digest"] and one[k][0]["WARC-Refers-To-Target-URI"] == "http://a.example/" and one[k][0]["WARC-Refers-To-Date"] == op3.UNDATED for k in ("metadata", "conversion"))
    fields = dict(x.split(": ", 1) for x in one["metadata"][1].decode().strip().split("\r\n"))
    assert fields["source-Content-Type"] == "text/html; charset=utf-8" and fields["source-payload-digest"] == source and fields["source-status"] == "HTTP/1.1 200 OK"
    assert op3.derive(op3.responses(pages.limit(0))).count() == 0


def test_missing_headers(spark):
    r = spark.createDataFrame([(1, "urn:x", None, None, None, None)], "id long, record_id string, target_uri string, date string, http_headers string, payload string")
    got = {x["record_type"]: x for x in op3.derive(r).collect()}
    assert got["conversion"]["content_length"] == 0 and got["response"]["date"] == op3.UNDATED and "Target-URI" not in got["response"]["record"]


def test_references_of_all_kinds_become_text(spark):
    html = "<p>It&#8217;s caf&eacute; &mdash; a&#xA0;b&nbsp;c &#x2019;&#60;b&#62; &#38;eacute; &amp;mdash; &amp;#65; &amp;lt; &lt;i&gt; &nvlt; &unheard; &#99999999999; &copy;&#0039;</p>"
    text = "It\u2019s café — a b c \u2019<b> &eacute; &mdash; &#65; &lt; <i> <\u20d2 &unheard; \ufffd ©'"
    pages = spark.createDataFrame([(1, "u", html), (2, "u", "<p>a &lt; b &amp; c</p>"), (3, "u", None)], "page_id long, url string, html string")
    got = {r["id"]: r["record"].split("\r\n\r\n", 1)[1] for r in op3.derive(op3.responses(pages)).where("record_type = 'conversion'").collect()}
    assert got == {1: text, 2: "a < b & c", 3: ""}


@pytest.mark.parametrize("opening", ["<a ", "<!--", "<script ", "<script>", "<title", "<title>", "<p ", "<style>x</style", "<", "&#"])
def test_unclosed_markup_costs_linear_time(spark, opening):
    pages = spark.createDataFrame([(1, "u", "<p>before</p>" + opening * (1_000_000 // len(opening)))], "page_id long, url string, html string")
    records = op3.derive(op3.responses(pages)).where("record_type = 'conversion'")
    records.count()
    began = time.time()
    assert records.first()["record"].split("\r\n\r\n", 1)[1].startswith("before")
    assert time.time() - began < 20


# ---- shards


def check_shards(docs, shards=op10.SHARDS, **more):
    got = [r.asDict() for r in op10.shard_rows(docs, shards, **more).collect()]
    texts = Counter((r["doc_id"], len((r["text"] or "").encode()) + op10.OVERHEAD, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == texts
    sizes = Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    for s in sizes:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    mean, largest = sum(sizes.values()) / shards, max(r["size"] for r in got)
    assert all(0 <= s < shards and abs(n - mean) <= largest for s, n in sizes.items())
    order = [r["text_crc32"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    assert order == sorted(order)  # equal texts lie together
    return got


def test_shards(documents, prose, odd):
    docs = documents(*((i, prose(i, 5 + i % 60)) for i in range(900)))
    check_shards(docs)
    check_shards(docs.unionByName(documents(*odd)).withColumn("size", F.lit("x")).withColumn("range", F.lit(0)), 7)


def test_a_third_of_the_rows_alike(documents, prose):
    same = documents(*((5, "the same text and id") for _ in range(300)), *((i, "the same text") for i in range(300)), *((i, prose(i, 20)) for i in range(300)))
    check_shards(same, 9)
    check_shards(same, 9, ranges=2)


def test_few_and_no_rows(documents):
    check_shards(documents((1, "one"), (2, None)))
    assert op10.shard_rows(documents((1, "x")).limit(0)).count() == 0


def test_overfull_ranges_are_cut(documents, prose):
    rows = op10.sized(documents(*((i, prose(i, 30)) for i in range(400))), "doc_id", "text")
    for ranges in (8, 64):
        got = op10.ranged(rows, ranges, draws=1, overfull=1.7).groupBy("range").agg(F.sum("size").alias("n"), F.count("*").alias("rows")).collect()
        assert all(r["n"] <= 1.7 * sum(r["n"] for r in got) / ranges or r["rows"] == 1 for r in got)


def test_ranges_follow_the_rows(documents, prose):
    docs = documents(*((i, prose(i, 8)) for i in range(600)))
    check_shards(docs, 4, ranges=1, rows_a_range=10)
    one = {tuple(r) for r in op10.shard_rows(docs, 4, ranges=1, rows_a_range=10).collect()}
    assert one == {tuple(r) for r in op10.shard_rows(docs.repartition(5), 4, ranges=3).collect()}  # ranges don't decide where a row lies


def test_writing_shards(spark, documents, prose, tmp_path):
    op10.write_shards(documents(*((i, prose(i, 20)) for i in range(80))), str(tmp_path / "s"), 4)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 80 and back.select("shard").distinct().count() == 4


# ---- pipeline and registry


@pytest.fixture(scope="module")
def corpus(spark, documents, prose, odd, tmp_path_factory):
    folder = tmp_path_factory.mktemp("corpus")
    bad = [(1000 + i, f"{prose(i, 50)} wretch {prose(i + 500, 30)}") for i in range(60)]
    fine = [(i, prose(i, 80)) for i in range(100, 260)]
    leak = prose(9999, 30)
    line = "a boilerplate line that has more than forty letters in it"
    more = [(3000, fine[0][1]), (3001, fine[1][1] + " end"), (3002, f"{prose(7, 50)} {leak} {prose(8, 50)}"), *((4000 + i, f"{prose(6000 + i, 60)}\n{line}") for i in range(6))]
    documents(*bad, *fine, *more, *odd).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 1) for i, _ in bad] + [(i, 1, 0) for i, _ in fine], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), bad, fine


def test_pipeline(spark, corpus):
    folder, bad, fine = corpus
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, folder))
        assert docs.columns == columns
        seen[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert not {i for i, _ in bad} & seen["toxicity"].keys() and {i for i, _ in fine} <= seen["toxicity"].keys()
    assert seen["line_dedup"].keys() == seen["toxicity"].keys() and [i for i in range(4000, 4006) if "boilerplate" in seen["line_dedup"][i]] == [4005]
    assert {i for i, _ in fine} <= seen["near_dedup"].keys() and 3000 not in seen["near_dedup"]
    assert seen["near_dedup"].keys() - seen["decontamination"].keys() == {3002}
    got = corpus_pipeline.run(spark, folder)
    assert {r["doc_id"] for r in got.collect()} == seen["decontamination"].keys() and "ids" in got.columns


def test_stages_leave_other_columns_alone(spark, corpus):
    """Columns that are called as those of the operators, or with dots and backticks, come through every stage."""
    folder, *_ = corpus
    names = ("score", "n_lines", "n_dropped", "kept_text", "n_words", "n_hit", "n_items", "hit_items", "contaminated", "id", "component_id", "a.b", "b c")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("*", *(F.lit(100 + n).alias(x) for n, x in enumerate(names)))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns, docs = docs.columns, corpus_pipeline.written(stage(spark, docs, folder))
        assert docs.columns == columns and docs.count() > 0, name
        assert [tuple(r) for r in docs.select(*(F.col(f"`{x}`") for x in names)).distinct().collect()] == [tuple(range(100, 100 + len(names)))], name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == docs.count()


def test_pipeline_of_nothing(spark, corpus):
    folder, *_ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.count() == 0


def test_every_operator_has_a_query():
    assert {re.match(r"op\d+_|pipeline", x)[0] for x in registry.QUERIES} == {"pipeline", *(f"op{n}_" for n in range(1, 14))}
    assert registry.ORACLES.keys() <= registry.QUERIES.keys()
