"""Readers: hourly event files, archives, languages and monthly rating files."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import metric_name, text_of, whole_of
from ..functions.values import ARCHIVE_COLUMNS, LANGUAGES, METRICS
from .scratch import staged


def hour_index(spark: SparkSession, year: int, month: int, limit: int | None = None) -> DataFrame:
    """(idx, name): the hourly files expected for a month, numbered from 1; the hour has no leading zero."""
    if year < 2011 or not 1 <= month <= 12:
        raise ValueError(f"no archive for {year}-{month}")
    first = f"make_timestamp({year}, {month}, 1, 0, 0, 0)"
    hours = spark.sql(f"SELECT posexplode(sequence({first}, {first} + INTERVAL 1 MONTH - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS (at, hour)")
    named = hours.select((F.col("at") + 1).alias("idx"), F.concat(F.date_format("hour", "yyyy-MM-dd-H"), F.lit(".json.gz")).alias("name"))
    return named if limit is None else named.where(F.col("idx") <= limit)


def present_files(spark: SparkSession, folder: str) -> DataFrame:
    """(name): the files of a folder; their contents aren't read."""
    return spark.read.format("binaryFile").load(folder).select(F.regexp_extract("path", "([^/]*)$", 1).alias("name"))


def missing_hours(index: DataFrame, present: DataFrame) -> DataFrame:
    """Rows of the index without a file. They are reported, never fatal."""
    return index.join(present, "name", "left_anti").select("idx", "name")


def read_events(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(value): the lines of gzipped event files, but for empty ones. A truncated file gives the lines before the damage, an absent one none."""
    lines = spark.read.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).text(paths)
    return lines.where("value <> ''")


#: Compressed bytes that go to Python at once, unless one file is larger.
GZIP_BATCH = "32m"


def _members(data: bytes) -> str:
    """The state of a gzipped file by its members: each has to end, with the right check sum, and nothing else may follow."""
    while data:
        member = zlib.decompressobj(31)
        try:
            while data and not member.eof:
                member.decompress(data, 1 << 20)
                data = member.unconsumed_tail or member.unused_data if not member.eof else data
            if not member.eof:
                member.flush()
                return "ok" if member.eof else "damaged"
        except zlib.error:
            return "damaged"
        data = member.unused_data
    return "ok"


def _checked(files: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in files:
        yield pd.DataFrame({"path": batch["path"], "members": [_members(bytes(x)) for x in batch["content"]]})


def file_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """(name, length, lines, state) of each gzipped file of a folder (or glob): state is ok, empty (no byte at all) or damaged; lines are those that read_events sees, with empty ones, before the damage.

    The last four bytes of a sound file are the size of its text. That is compared with the bytes which reading the lines
    gives, from the files' metadata: no file goes through Python for this. Files for which the two differ are damaged,
    unless they have several members, each with a size of its own: only those are opened member by member.
    """
    files = spark.read.format("binaryFile").load(folder)
    tail = F.hex(F.substring("content", -4, 4))
    size = F.conv(F.concat(*(F.substring(tail, at, 2) for at in (7, 5, 3, 1))), 16, 10).cast("long")
    # the listing has files without a byte too, which no scan gives
    path = spark._jvm.org.apache.hadoop.fs.Path
    names = spark.createDataFrame([(path(unquote(x)).toString(),) for x in files.inputFiles()], "path string")
    said = names.join(files.select("path", "length", F.when(F.col("length") >= 18, size).alias("said")), "path", "left").withColumn("length", F.coalesce("length", F.lit(0)))
    lines = spark.read.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).text(folder, lineSep="\n")
    read = lines.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.sum(F.octet_length("value") + 1).alias("bytes"), F.count("*").alias("lines"))
    modulo = F.lit(1 << 32)
    over = F.pmod(F.coalesce("bytes", F.lit(0)) - F.col("said"), modulo)  # 1 if the last line has no end
    ledger = staged(said.join(_decoded(read), "path", "left").select("path", "length", F.coalesce("lines", F.lit(0)).alias("lines"), F.coalesce(over <= 1, F.lit(False)).alias("equal")))
    suspects = [r["path"] for r in ledger.where("NOT equal AND length > 0").select("path").collect()]  # names of files, as a listing has them
    if suspects:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", GZIP_BATCH)
        try:
            checked = staged(spark.read.format("binaryFile").load([_escaped(x) for x in suspects]).select("path", "content").mapInPandas(_checked, "path string, members string"))
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        ledger = ledger.join(checked, "path", "left")
    else:
        ledger = ledger.withColumn("members", F.lit("ok"))
    state = F.when(F.col("length") == 0, "empty").when(F.col("equal"), "ok").otherwise(F.col("members"))
    return ledger.select(F.regexp_extract("path", "([^/]*)$", 1).alias("name"), "length", "lines", state.alias("state"))


def _decoded(read: DataFrame) -> DataFrame:
    """Paths of file metadata are URL-encoded, as those of listings; binaryFile's aren't. + stands for itself."""
    return read.withColumn("path", F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))))


def _escaped(path: str) -> str:
    """A path as a glob that means just it."""
    return "".join(f"\\{c}" if c in "*?[]{}\\" else c for c in path)


def hour_states(index: DataFrame, ledger: DataFrame) -> DataFrame:
    """(idx, name, state) of the hours that aren't whole: absent, empty or damaged. They are reported, never fatal; what a damaged file still gives is read."""
    return index.join(ledger.select("name", "state"), "name", "left").select("idx", "name", F.coalesce("state", F.lit("absent")).alias("state")).where("state <> 'ok'")


def _count(column: str, trimmed: bool):
    """An unsigned count with an optional plus sign; null if it isn't one."""
    text = F.trim(column) if trimmed else F.col(column)
    return F.when(text.rlike(r"\A\+?[0-9]+\z"), F.expr(f"try_cast(ltrim('+', {'trim(' + column + ')' if trimmed else column}) AS BIGINT)"))


def read_archive(spark: SparkSession, path: str | list[str], mode: str = "filter", multi_line: bool = False, header: bool = True) -> tuple[DataFrame, Observation]:
    """(archive rows, observation of the bad ones): the first action on the rows counts them, and `observation.get["n_bad"]` is their number, without a scan of its own.

    The header is skipped unread (header: whether files have one). Rows of another width and rows with a bad count are bad; in mode "filter" blanks
    around a count are ignored, in mode "stats" they are bad. Empty fields are "". Set multi_line only where quoted
    fields hold line breaks: such files can't be split. An action that stops early (a limit) has counted what it has read.
    """
    if mode not in ("filter", "stats"):
        raise ValueError(f"unknown mode {mode!r}")
    schema = ", ".join(f"{c} string" for c in (*ARCHIVE_COLUMNS, "corrupt_"))
    # pruned columns would let rows of another width pass: all of them are read
    raw = spark.read.options(columnPruning="false", header=str(header).lower(), escape='"', columnNameOfCorruptRecord="corrupt_", mode="PERMISSIVE", multiLine=str(multi_line).lower(), enforceSchema="true").schema(schema).csv(path)
    rows = raw.withColumn("n_", _count("count", mode == "filter"))
    bad = F.col("corrupt_").isNotNull() | F.col("n_").isNull()
    seen = Observation()
    good = rows.observe(seen, F.count(F.when(bad, 1)).alias("n_bad")).where(~bad)
    return good.select(*ARCHIVE_COLUMNS[:-1], F.col("n_").alias("count")).na.fill("", ARCHIVE_COLUMNS[:-1]), seen


LANGUAGE_LINE = "repo variant, total_size variant, languages array<struct<language: variant, size: variant>>"


def parse_languages(lines: DataFrame, order: list[str], column: str = "value") -> DataFrame:
    """(repo, total_size, languages): the last good line of each repository by `order`.

    A line is good if it has a string repo, an unsigned total_size and a list of languages with string names and
    unsigned sizes. Blank and bad lines are skipped.
    """
    e = lines.where(~F.regexp_replace(column, r"(?U)^\s+|\s+$", "").isin("")).withColumn("e_", F.from_json(column, LANGUAGE_LINE))
    listed = F.transform("e_.languages", lambda x: F.struct(text_of(x["language"]).alias("language"), whole_of(x["size"]).alias("size")))
    rows = e.select(*order, text_of(F.col("e_.repo")).alias("repo"), whole_of(F.col("e_.total_size")).alias("total_size"), listed.cast(LANGUAGES).alias("languages"))
    sound = F.forall("languages", lambda x: x["language"].isNotNull() & x["size"].isNotNull())
    good = rows.where(F.col("repo").isNotNull() & F.col("total_size").isNotNull() & F.col("languages").isNotNull() & F.coalesce(sound, F.lit(False)))
    return good.groupBy("repo").agg(F.max_by(F.struct("total_size", "languages"), F.struct(*order)).alias("last")).select("repo", "last.*")


def read_languages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """parse_languages over JSON lines; later files by name and later lines win."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    return parse_languages(lines, ["file", "block", "at"])


def rating_lines(files: DataFrame, *metrics: str) -> DataFrame:
    """(metric, file, pos, month, line, record): the good lines of rating files (path, value: a whole file), of the given metrics, or of all.

    Names match language-ratings-<month>-<metric>.jsonl or a folder month=<month>/metric=<metric>; those of
    language-ratings-all-... don't count. Lines that are no JSON object are skipped. One pass over the files.
    """
    one_of = "|".join(map(metric_name, metrics or METRICS))
    flat = F.regexp_extract("path", rf"(?:^|/)(language-ratings-(?!all-)[^/]*-(?:{one_of})\.jsonl)$", 1)
    folder = rf"/month=([^/]+)/metric=({one_of})/[^/]*$"
    metric = F.when(flat != "", F.regexp_extract(flat, rf"-({one_of})\.jsonl$", 1)).otherwise(F.regexp_extract("path", folder, 2))
    month = F.when(flat != "", F.substring(flat, len("language-ratings-") + 1, 7)).otherwise(F.regexp_extract("path", folder, 1))
    named = files.select(metric.alias("metric"), F.col("path").alias("file"), month.alias("month"), "value").where("metric <> ''")
    lines = named.select("metric", "file", "month", F.posexplode(F.split("value", "\n")).alias("pos", "line"))
    record = F.try_parse_json("line")
    return lines.select("*", record.alias("record")).where(F.schema_of_variant("record").startswith("OBJECT"))


def rating_files(spark: SparkSession, folder: str, *metrics: str) -> DataFrame:
    """(path, value): the rating files of a folder, whole, for the given metrics or for all. Files hold some hundred lines.

    Only the files of these metrics are listed for the scan: by their names, or by the folders month=*/metric=*. No such file is an error.
    """
    patterns = [f"{folder.rstrip('/')}/{name}" for m in metrics or METRICS for name in (f"language-ratings-*-{metric_name(m)}.jsonl", f"month=*/metric={m}/*.json*")]
    there = [p for p in patterns if _matches(spark, p)]
    if not there:
        raise FileNotFoundError(f"no rating file of {', '.join(metrics or METRICS)} in {folder}")
    return spark.read.option("recursiveFileLookup", True).text(there, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")


def _matches(spark: SparkSession, pattern: str) -> bool:
    """Whether a file matches, by a listing of names; language-ratings-all-... is no month."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(path)
    return any(not x.getPath().getName().startswith("language-ratings-all-") for x in found or ())


def read_rating_files(spark: SparkSession, folder: str, metric: str) -> DataFrame:
    """rating_lines over the files of one metric; an error if there is none. A file without a good line gives no rows."""
    return rating_lines(rating_files(spark, folder, metric), metric)
