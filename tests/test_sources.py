from __future__ import annotations

import gzip
import json

import pytest
from helpers import nodes, rows

from glossometer.functions.scalars import normalize_repo, year_month_from_name
from glossometer.functions.values import LANGUAGES
from glossometer.jobs import workloads
from glossometer.operators import languages as lang
from glossometer.operators.events import aggregate_events, extract_events
from glossometer.operators.pack import pack_all, pack_ratings
from glossometer.sources import readers, writers


def lines(spark, *texts):
    return spark.createDataFrame([(x,) for x in texts], "value string")


def event(**more):
    base = {"id": "1", "type": "PushEvent", "actor": {"login": "ann"}, "repo": {"name": "a/b"}, "payload": {}, "created_at": "2024-01-01T00:00:00Z"}
    return json.dumps({k: v for k, v in (base | more).items() if v is not ...})


def extracted(spark, *texts):
    return rows(extract_events(lines(spark, *texts)), "actor", "repo", "event_type", "action", "language")


def test_events_that_are_kept(spark):
    head = {"pull_request": {"head": {"repo": {"language": "Rust"}}}}
    cases = {
        event(): ("ann", "a/b", "PushEvent", "", ""),
        event(actor=...): ("", "a/b", "PushEvent", "", ""),
        event(actor=None): ("", "a/b", "PushEvent", "", ""),
        event(payload="text"): ("ann", "a/b", "PushEvent", "", ""),
        event(payload=None): ("ann", "a/b", "PushEvent", "", ""),
        event(payload={"action": 5}): ("ann", "a/b", "PushEvent", "", ""),
        event(payload={"action": "merged", **head}): ("ann", "a/b", "PushEvent", "merged", "Rust"),
        event(payload={"issue": {"repository": {"language": "Go"}}}): ("ann", "a/b", "PushEvent", "", "Go"),
        event(payload={"repository": {"language": "C"}}): ("ann", "a/b", "PushEvent", "", "C"),
        event(payload={"pull_request": {"head": {"repo": {"language": ""}}}, "repository": {"language": "C"}}): ("ann", "a/b", "PushEvent", "", ""),
        event(payload={"pull_request": {"head": {"repo": None}}, "repository": {"language": "C"}}): ("ann", "a/b", "PushEvent", "", "C"),
        event(payload={"pull_request": {"head": {"repo": {"language": 7}}}, "repository": {"language": "C"}}): ("ann", "a/b", "PushEvent", "", "C"),
        '{"type":"A","type":"B","repo":{"name":"a/b"}}': ("", "a/b", "B", "", ""),
    }
    for text, want in cases.items():
        assert extracted(spark, text) == [want], text


def test_lines_that_are_no_events(spark):
    bad = ["", "x", event()[:50], event(type=5), event(type=None), event(repo="a/b"), event(repo={"name": "ab"}), event(repo={"name": 3}), event(repo=...), "[]", "null"]
    assert extracted(spark, *bad) == []


def test_aggregation_takes_the_earliest_language(spark):
    pr = lambda i, language, at: event(id=i, type="PullRequestEvent", created_at=at, payload={"action": "opened", "repository": {"language": language}})
    df = aggregate_events(extract_events(lines(spark, pr("3", "Go", "2024-01-02"), pr("2", "", "2024-01-01"), pr("9", "Rust", "2024-01-03"))))
    assert rows(df, "language", "count") == [("", 3)]
    tie = aggregate_events(extract_events(lines(spark, pr("2", "B", "t"), pr("1", "C", "t"))))
    assert rows(tie, "language", "count") == [("C", 2)]


def test_hours(spark):
    hours = readers.hour_index(spark, 2024, 2)
    assert hours.count() == 696 and hours.orderBy("idx").first().asDict() == {"idx": 1, "name": "2024-02-01-0.json.gz"}
    assert readers.hour_index(spark, 2024, 1, 3).count() == 3
    present = spark.createDataFrame([(f"2024-02-{d:02d}-{h}.json.gz",) for d in range(1, 30) for h in range(24) if (d, h) != (3, 7)], "name string")
    assert rows(readers.missing_hours(hours, present), "name") == [("2024-02-03-7.json.gz",)]
    for year, month in ((2010, 1), (2024, 13)):
        with pytest.raises(ValueError):
            readers.hour_index(spark, year, month)


def test_archive_month_survives_damage(spark, tmp_path):
    folder = tmp_path / "hours"
    folder.mkdir()
    with gzip.open(folder / "2024-02-01-0.json.gz", "wt") as f:
        f.write("\n".join([event(), "", event(type="WatchEvent"), "no json"]))
    whole = gzip.compress("\n".join(event(actor={"login": f"u{i * 7919 % 100_003}"}) for i in range(20_000)).encode())
    (folder / "2024-02-01-1.json.gz").write_bytes(whole[: len(whole) // 2])
    (folder / "2024-02-01-2.json.gz").write_bytes(gzip.compress(event(actor={"login": "x"}).encode() + b"\n") + gzip.compress(event(actor={"login": "y"}).encode()))
    missing = workloads.archive_month(spark, str(folder), 2024, 2, str(tmp_path / "archive"))
    assert {(r["name"], r["state"]) for r in missing.where("state <> 'absent'").collect()} == {("2024-02-01-1.json.gz", "damaged")} and missing.count() == 694
    got = spark.read.parquet(str(tmp_path / "archive"))
    assert got.where("actor = 'ann'").count() == 2 and got.where("actor IN ('x', 'y')").count() == 2 and 1000 < got.count() < 20_000


CSV = 'actor,repo,event_type,action,language,count\nann,a/b,PushEvent,,Rust,6\n"x""y",a/b,PushEvent,opened,, 7\nz,a/b,PushEvent,,,+8\nq,a/b,PushEvent,,,-1\nq,a/b,PushEvent,,,x\nq,a/b,PushEvent,,,\nq,a/b,PushEvent,,5\nq,a/b,PushEvent,,,5,6\n'


def test_archive_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text(CSV)
    good, bad = readers.read_archive(spark, str(tmp_path / "a.csv"))
    assert rows(good) == [("ann", "a/b", "PushEvent", "", "Rust", 6), ('x"y', "a/b", "PushEvent", "opened", "", 7), ("z", "a/b", "PushEvent", "", "", 8)]
    assert rows(good, "actor", "count") == [("ann", 6), ('x"y', 7), ("z", 8)] and bad.get == {"n_bad": 5}
    strict, bad = readers.read_archive(spark, str(tmp_path / "a.csv"), "stats")
    assert rows(strict, "actor") == [("ann",), ("z",)] and bad.get == {"n_bad": 6}
    writers.write_archive(good, str(tmp_path / "out"))
    again, bad = readers.read_archive(spark, str(tmp_path / "out"))
    assert rows(again) == rows(good) and bad.get == {"n_bad": 0}
    with pytest.raises(ValueError):
        readers.read_archive(spark, "x", "other")


def test_languages_last_line_wins(spark, tmp_path):
    good = lambda repo, n: json.dumps({"repo": repo, "total_size": n, "languages": [{"language": "C", "size": n}]})
    text = [good("a/a", 1), "", "  ", "no", good("b/b", 3), good("a/a", 2), '{"repo":"c/c","total_size":"4","languages":[]}', '{"repo":"c/c","total_size":-4,"languages":[]}', '{"repo":5,"total_size":4,"languages":[]}', '{"repo":"d/d","total_size":4}',
            '{"repo":"e/e","total_size":4,"languages":[{"language":"C"}]}', '{"repo":"f/f","total_size":4,"languages":[{"language":7,"size":1}]}', '{"repo":"g/g","total_size":0,"languages":[]}']
    (tmp_path / "l.jsonl").write_text("\n".join(text))
    got = readers.read_languages(spark, str(tmp_path / "l.jsonl"))
    assert rows(got, "repo", "total_size") == [("a/a", 2), ("b/b", 3), ("g/g", 0)]
    writers.write_languages(got, str(tmp_path / "out"))
    assert rows(readers.read_languages(spark, str(tmp_path / "out")), "repo") == [("a/a",), ("b/b",)]


def test_slugs(spark):
    cases = {
        "https://github.com/a/b": "a/b", "http://github.com/a/b/": "a/b", "github.com/a/b.git": "a/b", " a/b\t": "a/b", "a/b.git/": "a/b.git", "/b": "/b", "ab": None, "a/b/c": None, " a/b ": "a/b", "HTTPS://github.com/a/b": None, "a/b//": "a/b",
    }
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    assert {r[0]: r[1] for r in df.select("s", normalize_repo(df["s"])).collect()} == cases
    assert rows(lang.clean_slug_lines(lines(spark, "", " # x/y", "a/b", "a/b", "nope"))) == [("a/b",), ("a/b",)]


def test_year_month(spark):
    df = spark.createDataFrame([("x-202403-y.csv",), ("a20240199",)], "s string")
    assert [r[0] for r in df.select(year_month_from_name(df["s"])).collect()] == ["2024-03", "2024-01"]
    with pytest.raises(Exception, match="no year and month"):
        bad = spark.createDataFrame([("x.csv",)], "s string")
        bad.select(year_month_from_name(bad["s"])).collect()


def test_requests_and_responses(spark):
    slugs = spark.createDataFrame([(f"o/r{i}",) for i in range(25)] + [('q"x/y"z',)], "repo string")
    numbered = lang.numbered_requests(slugs, 10)
    assert numbered.count() == 26 and max(r["count"] for r in numbered.groupBy("batch_id").count().collect()) == 10
    asked = lang.batch_requests(numbered)
    texts = " ".join(r["query"] for r in asked.collect())
    assert texts.count("repository(") == 26 and 'owner: "qx", name: "yz"' in texts
    requests = spark.createDataFrame([(1, f"r{i}", f"o/{i}") for i in range(5)] + [(2, "r0", "p/0"), (3, "r0", "q/0")], "batch_id long, alias string, repo string")
    node = {"languages": {"totalSize": 9, "edges": [{"size": 5, "node": {"name": "B"}}, {"size": -1, "node": {"name": "x"}}, {"size": "7", "node": {"name": "x"}}, {"node": {"name": "x"}}, {"size": 3}, {"size": 4, "node": {"name": "A"}}]}}
    responses = spark.createDataFrame([(1, json.dumps({"data": {"rateLimit": {"cost": 1}, "r0": node, "r1": None, "r2": {}, "r4": {"languages": {"edges": []}}}})), (2, '{"errors": []}'), (3, None)], "batch_id long, response string")
    got = {r["repo"]: (r["total_size"], [tuple(x) for x in r["languages"]]) for r in lang.parse_language_responses(requests, responses).collect()}
    assert got == {"o/0": (9, [("B", 5), ("A", 4)]), "o/1": (0, []), "o/2": (0, []), "o/4": (0, []), "q/0": (0, [])}


def test_requests_are_numbered_in_order(spark):
    """Full batches in slug order but for the last, whatever the ranges; a slug that a third of the lines repeat too."""
    names = [f"o/r{i * 7919 % 1009}" for i in range(700)] + ["m/often"] * 350
    for parts in (1, 6):
        got = lang.numbered_requests(spark.createDataFrame([(x,) for x in names], "repo string").repartition(parts)).collect()
        assert sorted((r["batch_id"] * 100 + int(r["alias"][1:]), r["repo"]) for r in got) == list(enumerate(sorted(names)))
    assert lang.numbered_requests(spark.createDataFrame([], "repo string")).count() == 0
    texts = [r["query"] for r in lang.batch_requests(lang.numbered_requests(spark.createDataFrame([(f"o/r{i:03d}",) for i in range(120)], "repo string"))).orderBy("batch_id").collect()]
    assert len(texts) == 2 and texts[0].index("r9: ") < texts[0].index("r10: ") < texts[0].index("r99: ") and texts[1].count("repository(") == 20


def test_ledger_of_damage(spark, tmp_path):
    text = "".join(f"line {i * 7919 % 10_007}\n" for i in range(5000)).encode()
    whole = gzip.compress(text)
    files = {"whole": (whole, "ok"), "open end": (gzip.compress(text[:-1]), "ok"), "two": (whole + gzip.compress(b"x\n"), "ok"), "nothing": (gzip.compress(b""), "ok"), "empty": (b"", "empty"), "cut": (whole[: len(whole) // 2], "damaged"),
             "tail": (whole[:-3], "damaged"), "header": (whole[:5], "damaged"), "sum": (whole[:-8] + b"abcd" + whole[-4:], "damaged"), "second cut": (whole + whole[:200], "damaged"), "no gzip": (b"plain text\n" * 9, "damaged"), "a+b %[é]": (whole, "ok")}
    for name, (data, _) in files.items():
        (tmp_path / f"{name}.json.gz").write_bytes(data)
    got = {r["name"]: r for r in readers.file_ledger(spark, str(tmp_path)).collect()}
    want = {f"{name}.json.gz": state for name, (_, state) in files.items()}
    want["sum.json.gz"] = got["sum.json.gz"]["state"]  # told only where the reader tells
    assert {k: r["state"] for k, r in got.items()} == want
    assert got["whole.json.gz"]["lines"] == got["open end.json.gz"]["lines"] == got["a+b %[é].json.gz"]["lines"] == 5000 and got["two.json.gz"]["lines"] == 5001 and 0 <= got["cut.json.gz"]["lines"] < 5000
    index = spark.createDataFrame([(1, "whole.json.gz"), (2, "cut.json.gz"), (3, "gone.json.gz"), (4, "empty.json.gz")], "idx int, name string")
    assert rows(readers.hour_states(index, readers.file_ledger(spark, str(tmp_path)))) == [(2, "cut.json.gz", "damaged"), (3, "gone.json.gz", "absent"), (4, "empty.json.gz", "empty")]


def test_bad_rows_are_counted_by_the_same_scan(spark, tmp_path):
    (tmp_path / "a.csv").write_text(CSV)
    good, bad = readers.read_archive(spark, str(tmp_path / "a.csv"))
    names, _ = nodes(spark, lambda: good.write.format("noop").mode("overwrite").save())
    assert bad.get == {"n_bad": 5} and sum(x.startswith("Scan csv") for x in names) == 1


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('actor,repo,event_type,action,language,count\n"a\nb",a/b,PushEvent,,,1\nc,a/b,PushEvent,"x,\n""y""",,2\n')
    good, bad = readers.read_archive(spark, str(tmp_path / "a.csv"), multi_line=True)
    assert rows(good, "actor", "action", "count") == [("a\nb", "", 1), ("c", 'x,\n"y"', 2)] and bad.get == {"n_bad": 0}


def test_packing(spark, tmp_path):
    put = lambda name, *texts: (tmp_path / name).write_text("\n".join(texts) + "\n")
    put("language-ratings-2024-03-pr-count.jsonl", '{"language":"B","percentage":60.0,"rating":6}', "", "[1]", "no", '{"language":"A","rating":4,"percentage":40.0,"more":1}')
    put("language-ratings-2023-11-pr-count.jsonl", '{"language":"C","rating":1,"percentage":100.0}')
    put("language-ratings-all-pr-count.jsonl", '{"language":"X","rating":1}')
    put("language-ratings-2024-03-pr-count-primary.jsonl", '{"language":"X","rating":1}')
    got = [tuple(r)[:4] for r in pack_ratings(spark, str(tmp_path), "pr-count").collect()]
    assert got == [("2023-11", "C", 1.0, 100.0), ("2024-03", "B", 6.0, 60.0), ("2024-03", "A", 4.0, 40.0)]
    listed = readers.rating_files(spark, str(tmp_path), "pr-count").inputFiles()
    assert len(listed) == 3 and all("-pr-count.jsonl" in x for x in listed)
    (tmp_path / "month=2024-05" / "metric=push-count").mkdir(parents=True)
    put("month=2024-05/metric=push-count/part-0.json", '{"rank":1,"language":"A","rating":1,"percentage":100.0}')
    assert [x.rpartition("/")[2] for x in readers.rating_files(spark, str(tmp_path), "push-count").inputFiles()] == ["part-0.json"]
    assert [r["month"] for r in pack_ratings(spark, str(tmp_path), "push-count").collect()] == ["2024-05"]
    assert '"more":1' in pack_ratings(spark, str(tmp_path), "pr-count").collect()[-1]["line"]
    with pytest.raises(FileNotFoundError):
        pack_ratings(spark, str(tmp_path), "star-count")
    with pytest.raises(ValueError):
        pack_ratings(spark, str(tmp_path), "stars")


def test_rate_and_pack(spark, archive, tmp_path):
    from pyspark.sql import functions as F

    df = archive(("ann", "x/y", "PushEvent", 3), ("ben", "x/y", "PullRequestEvent", 5))
    df.withColumn("month", F.lit("2024-01")).unionByName(df.withColumn("month", F.lit("2024-02"))).write.partitionBy("month").parquet(str(tmp_path / "in"))
    workloads.clean_archive(spark, str(tmp_path / "in"), str(tmp_path / "clean"))
    known = spark.createDataFrame([("x/y", 4, [{"language": "Go", "size": 3}, {"language": "C", "size": 1}])], f"repo string, total_size long, languages {LANGUAGES}")
    got = workloads.rate_and_pack(spark, str(tmp_path / "clean"), known, str(tmp_path / "ratings"))
    assert [tuple(r) for r in got.where("metric = 'push-count'").select("month", "language", "rating", "percentage").collect()] == [(m, x, y, z) for m in ("2024-01", "2024-02") for x, y, z in (("Go", 2.25, 75.0), ("C", 0.75, 25.0))]
    assert pack_all(spark, str(tmp_path / "ratings")).select("metric").distinct().count() == 4
