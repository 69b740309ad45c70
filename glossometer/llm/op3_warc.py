"""WARC derivatives: linked metadata and plain-text conversion records from response records.

Everything is computed in the row that holds the response, so nothing is shuffled and a page of any size costs one
row. Record ids are named by content (an MD5 UUID), so a task that runs again makes the same ids.
"""

from __future__ import annotations

import html.entities as named
import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_batches

#: WARC-Date of responses that carry none.
UNDATED = "1970-01-01T00:00:00Z"
CRLF = "\r\n"
#: Entities and their characters, in the order of their replacement.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))
#: References beyond these, numeric or named.
_NAMES = "|".join(entity[1:-1] for entity, _ in ENTITIES)
REFERENCE = rf"&(?!(?:{_NAMES});)(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);"
REFERENCES = re.compile(REFERENCE)
#: What must not become markup, or a second reference, when it is decoded before the tags are taken out.
KEPT = str.maketrans({"&": "&amp;", "<": "&lt;", ">": "&gt;", "\u00a0": " "})
#: What isn't text, what ends a line, and any other tag; each begins with one fixed character, which is fast to look for.
#: What is opened and never closed reaches to the end of the page, as browsers take it; so no opening is searched twice.
UNSEEN = r"(?is)<(?:!--.*?(?:-->|\z)|script[ \t\r\n>].*?(?:</script[^>]*(?:>|\z)|\z)|style[ \t\r\n>].*?(?:</style[^>]*(?:>|\z)|\z)|title[ \t\r\n>].*?(?:</title[^>]*(?:>|\z)|\z))"
BREAKS = r"(?is)</?(p|div|br|li|ul|ol|h[1-6]|tr|td|th|table|nav|article|section|footer|header|blockquote|pre|hr|body|head|html)([ \t\r\n/][^>]*)?(?:>|\z)"
TAG = r"(?s)<[a-zA-Z/!][^>]*(?:>|\z)"
TITLE = r"(?is)<title[^<>]*>(.*?)(?:</title|\z)"
#: Runs of blanks that aren't one space already, and line ends with what is blank behind them.
BLANKS, LINES = r"[ \t\r\x0B\f]{2,}|[\t\r\x0B\f]", r"\n[ \n]+"


def referred(m: re.Match) -> str:
    ref = m.group()
    if ref[1] == "#":
        digits = ref[2:-1].lstrip("xX0")
        return (unescape(ref) if len(digits) <= 7 else "\ufffd").translate(KEPT)
    return named.html5[ref[1:]].translate(KEPT) if ref[1:] in named.html5 else ref


def dereferenced(html: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in html:
        yield pd.Series([None if x is None else REFERENCES.sub(referred, x) for x in batch], dtype=object)


def with_text(rows: DataFrame, html: str, name: str) -> DataFrame:
    """rows with a page's text in column `name`: a line per block, no scripts, styles, comments or title, references decoded, blanks folded. Null gives null.

    The steps are columns of their own, so that none is computed for each of its uses.
    """
    decoded = F.coalesce(F.pandas_udf(dereferenced, "string")(F.when(F.col(html).rlike(REFERENCE), F.col(html))), html)  # only such pages go to Python
    rows = rows.withColumn(name, F.regexp_replace(F.regexp_replace(F.regexp_replace(decoded, UNSEEN, " "), BREAKS, "\n"), TAG, ""))
    plain = F.col(name)
    for entity, char in ENTITIES:
        plain = F.replace(plain, F.lit(entity), F.lit(char))
    rows = rows.withColumn(name, F.when(F.contains(name, F.lit("&")), plain).otherwise(F.col(name)))
    folded = F.replace(F.regexp_replace(name, BLANKS, " "), F.lit(" \n"), F.lit("\n"))
    return rows.withColumn(name, F.btrim(F.regexp_replace(folded, LINES, "\n"), F.lit(" \n")))


def record_id(kind: str, *parts: Column) -> Column:
    h = F.md5(F.concat_ws(" ", F.lit(kind), *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))
    return F.concat(F.lit("urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-3"), F.substring(h, 14, 3), F.lit("-8"), F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Pages as response records: id, record_id, target_uri, date, http_headers, payload and payload_digest."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("target_uri"), html.alias("payload"), digest(html).alias("payload_digest"))
    return rows.select(
        "id",
        record_id("response", F.col("id"), F.col("target_uri"), F.col("payload_digest")).alias("record_id"),
        "target_uri",
        F.lit(UNDATED).alias("date"),
        F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length("payload"), F.lit(CRLF)).alias("http_headers"),
        "payload",
        "payload_digest",
    )


def _record(kind: str, own_id: Column, refers_to: Column | None, uri: Column, date: Column, content_type: str, block: Column, payload_digest: Column, source: Column) -> Column:
    """A record as a struct; `record` is what a WARC file holds, up to the two line ends between records. refers_to: the record that this one was made from, if any."""
    block_digest = digest(block)
    headers = [
        F.lit(f"WARC/1.1{CRLF}WARC-Type: {kind}"),
        F.concat(F.lit("WARC-Record-ID: <"), own_id, F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), uri),  # null, and so left out, where there is none
        F.concat(F.lit("WARC-Date: "), date),
    ]
    if refers_to is not None:
        headers += [
            F.concat(F.lit("WARC-Refers-To: <"), refers_to, F.lit(">")),
            F.concat(F.lit("WARC-Refers-To-Target-URI: "), uri),
            F.concat(F.lit("WARC-Refers-To-Date: "), date),
            F.concat(F.lit("WARC-Source-Payload-Digest: "), source),
        ]
    headers += [
        F.concat(F.lit("WARC-Payload-Digest: "), payload_digest),
        F.concat(F.lit("WARC-Block-Digest: "), block_digest),
        F.lit(f"Content-Type: {content_type}"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block)),
    ]
    return F.struct(
        F.lit(kind).alias("record_type"), own_id.alias("record_id"), (F.lit(None).cast("string") if refers_to is None else refers_to).alias("refers_to"), uri.alias("target_uri"), date.alias("date"),
        F.lit(content_type).alias("content_type"), F.octet_length(block).cast("long").alias("content_length"), payload_digest.alias("payload_digest"), source.alias("source_digest"), block_digest.alias("block_digest"),
        F.concat(F.concat_ws(CRLF, *headers), F.lit(CRLF + CRLF), block).alias("record"),
    )


def derive(responses: DataFrame) -> DataFrame:
    """Three rows per response: the response record, its metadata record and its conversion record.

    Metadata and conversion refer to the response's record id, URI and date, and hold the digest of its payload in a
    header of their own (WARC-Source-Payload-Digest, source_digest); their payload digest is that of their own block.
    The metadata block (application/warc-fields) carries the response's HTTP headers, each name behind `source-`, the
    digests of the payload and of the text, and the title; the conversion's block is the plain text. Without a
    column payload_digest, or where it is null, the digest is computed. Null payloads count as empty; null and
    multi-line URIs lose their header or their line ends; a null date is UNDATED. Repeated responses give the same
    records again. An empty table gives no rows; other columns are ignored.
    """
    text_batches(responses.sparkSession)
    payload = F.coalesce("payload", F.lit(""))
    source = F.coalesce("payload_digest", digest(payload)) if "payload_digest" in responses.columns else digest(payload)
    r = responses.select("id", "record_id", F.regexp_replace("target_uri", r"[\x00-\x1F\x7F]+", "").alias("uri"), F.coalesce("date", F.lit(UNDATED)).alias("date"), F.coalesce("http_headers", F.lit("")).alias("http"), payload.alias("payload"), source.alias("source"))
    r = with_text(r, "payload", "text")
    fields = F.regexp_replace(F.regexp_replace("http", r"\AHTTP/[^\r\n]*\r\n", ""), r"(?m)^([!-9;-~]+:)", "source-$1")
    status = F.regexp_extract("http", r"\A(HTTP/[^\r\n]*)", 1)
    title = F.btrim(F.regexp_replace(F.regexp_extract("payload", TITLE, 1), r"[\x00-\x20]+", " "))
    r = r.withColumns({
        "response": F.concat("http", F.lit(CRLF), "payload"),
        "meta": F.concat(F.lit("source-status: "), status, F.lit(CRLF), fields, F.lit("source-payload-digest: "), F.col("source"), F.lit(f"{CRLF}text-digest: "), digest(F.col("text")), F.lit(f"{CRLF}title: "), title, F.lit(CRLF)),
    })
    own, uri, date = F.col("record_id"), F.col("uri"), F.col("date")
    # columns of a projection, in which a digest that is used twice is computed once; within the explode it wouldn't be
    records = {
        "a": _record("response", own, None, uri, date, "application/http; msgtype=response", F.col("response"), F.col("source"), F.col("source")),
        "b": _record("metadata", record_id("metadata", own), own, uri, date, "application/warc-fields", F.col("meta"), digest(F.col("meta")), F.col("source")),
        "c": _record("conversion", record_id("conversion", own), own, uri, date, "text/plain; charset=UTF-8", F.col("text"), digest(F.col("text")), F.col("source")),
    }
    return r.select("id", *(x.alias(name) for name, x in records.items())).select("id", F.explode(F.array(*records)).alias("r")).select("id", "r.*")


def write_warc(records: DataFrame, path: str, per_file: int = 50_000) -> None:
    """Write the records as gzipped WARC files of up to per_file records, one after the other."""
    records.select(F.concat("record", F.lit(CRLF)).alias("value")).write.option("lineSep", CRLF).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = derive(responses(table(spark, sf_dir, "pages")))
    return r.select(F.col("id").alias("page_id"), "record_type", "record_id", "refers_to", "target_uri", "content_type", "content_length", "payload_digest", "source_digest", "block_digest", F.sha2("record", 256).alias("record_sha256"))


def _sql() -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    text = f"regexp_replace(regexp_replace(regexp_replace(payload, {q(UNSEEN)}, ' ', 'g'), {q(BREAKS)}, chr(10), 'g'), {q(TAG)}, '', 'g')"
    for entity, char in ENTITIES:
        text = f"replace({text}, {q(entity)}, {q(char)})"
    text = f"trim(regexp_replace(replace(regexp_replace({text}, {q(BLANKS)}, ' ', 'g'), ' ' || chr(10), chr(10)), {q(LINES)}, chr(10), 'g'), ' ' || chr(10))"
    uuid = lambda h: f"'urn:uuid:' || {h}[1:8] || '-' || {h}[9:12] || '-3' || {h}[14:16] || '-8' || {h}[18:20] || '-' || {h}[21:32]"
    nl = "chr(13) || chr(10)"
    octets = lambda x: f"octet_length(encode({x}))"
    refers = f"""coalesce({nl} || 'WARC-Refers-To: <' || refers_to || '>' || coalesce({nl} || 'WARC-Refers-To-Target-URI: ' || url, '') || {nl} || 'WARC-Refers-To-Date: {UNDATED}' || {nl} || 'WARC-Source-Payload-Digest: ' || source, '')"""
    payload_digest = "CASE record_type WHEN 'response' THEN source ELSE 'sha256:' || sha256(block) END"
    head = f"""'WARC/1.1' || {nl} || 'WARC-Type: ' || record_type || {nl} || 'WARC-Record-ID: <' || record_id || '>' || coalesce({nl} || 'WARC-Target-URI: ' || url, '') || {nl} || 'WARC-Date: {UNDATED}' || {refers}
        || {nl} || 'WARC-Payload-Digest: ' || {payload_digest} || {nl} || 'WARC-Block-Digest: sha256:' || sha256(block) || {nl} || 'Content-Type: ' || content_type || {nl} || 'Content-Length: ' || {octets("block")} || {nl} || {nl} || block"""
    return rf"""
WITH p AS (
    SELECT page_id, url, coalesce(html, '') AS payload, 'sha256:' || sha256(coalesce(html, '')) AS source FROM pages
), r AS (
    SELECT *, md5('response ' || coalesce(CAST(page_id AS VARCHAR), '') || ' ' || coalesce(url, '') || ' ' || source) AS h, {text} AS body, {octets("payload")} AS size FROM p
), i AS (
    SELECT *, {uuid("h")} AS rid FROM r
), m AS (
    SELECT *, md5('metadata ' || rid) AS mh, md5('conversion ' || rid) AS ch FROM i
), u AS (
    SELECT page_id, url, source, 'response' AS record_type, rid AS record_id, NULL AS refers_to, 'application/http; msgtype=response' AS content_type,
        'HTTP/1.1 200 OK' || {nl} || 'Content-Type: text/html; charset=utf-8' || {nl} || 'Content-Length: ' || size || {nl} || {nl} || payload AS block FROM m
    UNION ALL
    SELECT page_id, url, source, 'metadata', {uuid("mh")}, rid, 'application/warc-fields',
        'source-status: HTTP/1.1 200 OK' || {nl} || 'source-Content-Type: text/html; charset=utf-8' || {nl} || 'source-Content-Length: ' || size || {nl} || 'source-payload-digest: ' || source || {nl} || 'text-digest: sha256:' || sha256(body)
        || {nl} || 'title: ' || trim(regexp_replace(regexp_extract(payload, {q(TITLE)}, 1), '[\x00-\x20]+', ' ', 'g'), ' ') || {nl} FROM m
    UNION ALL
    SELECT page_id, url, source, 'conversion', {uuid("ch")}, rid, 'text/plain; charset=UTF-8', body FROM m
)
SELECT page_id, record_type, record_id, refers_to, url AS target_uri, content_type, {octets("block")} AS content_length, {payload_digest} AS payload_digest, source AS source_digest, 'sha256:' || sha256(block) AS block_digest,
    sha256({head}) AS record_sha256
FROM u
"""


ORACLE = _sql()
