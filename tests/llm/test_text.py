"""Licenses (2), lines (4), personal data (5), pieces (6), decontamination (8) and toxicity (9) against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from glossometer.llm import common
from glossometer.llm import op2_licenses as op2
from glossometer.llm import op4_lines as op4
from glossometer.llm import op5_pii as op5
from glossometer.llm import op6_sentencepiece as op6
from glossometer.llm import op8_decontaminate as op8
from glossometer.llm import op9_toxicity as op9

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


# ---- licenses


def plain_base(text):
    w = words(text)
    return sorted((i, label) for phrase, label in op2.BASE for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split())


def test_licenses(documents, odd, prose):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    texts = [(20, f"{prose(1, 40)} Under the MIT license. {prose(2, 10)} CC-BY-NC, cc by nc"), (21, "licensed under the Apache License, Version 2.0"), (22, f"{prose(3, 9)} {mit}"), (23, mit.replace("free of charge", "quite free of any charge")), (24, "under the mit"), (25, "cc by nc " * 2000), (26, "permission is hereby granted to nobody at all")]
    got = op2.scan(documents(*texts, *odd).withColumn("row_", F.lit(1)).withColumn("label", F.lit(""))).collect()
    assert len(got) == len(texts) + len(odd)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    for i, t in texts:
        (r,), base = by[i], plain_base(t)
        assert (r["n_words"], r["n_base"]) == (len(words(t)), len(base))
        assert (r["first_word"], r["last_word"]) == ((base[0][0], base[-1][0]) if base else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in base}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert by[22][0]["labels"] == by[23][0]["labels"] == "mit" and by[22][0]["score"] == 1.0 and by[23][0]["score"] < 1
    assert by[26][0]["labels"] == "" and 0 < by[26][0]["score"] < op2.SHARE and by[25][0]["n_base"] == 2000
    assert (by[1][0]["n_words"], by[1][0]["score"], len(by[6])) == (0, 0.0, 3)
    start, end = by[22][0]["spans"][0]["start"], by[22][0]["spans"][0]["end"]
    assert words(texts[2][1])[start:end] == words(mit)
    assert op2.scan(documents(*texts).limit(0)).count() == 0


def plain_licenses(text):
    """(labels, score) by sets of matched places."""
    w, spans = words(text), []
    for number, (template, label) in enumerate(op2.TEMPLATES, len(op2.BASE)):
        t = re.findall("[a-z0-9]+", template)
        needed = [tuple(x.split()) for x in re.findall(r"\[(.*?)\]", template)]
        places = {}
        for i, gram in enumerate(zip(t, t[1:], t[2:])):
            places.setdefault(gram, []).append(i)
        pairs = sorted((at - i, at, i) for at, gram in enumerate(zip(w, w[1:], w[2:])) for i in places.get(gram, ()))
        runs = []
        for x in pairs:
            if not runs or x[0] - runs[-1][-1][0] > op2.DRIFT:
                runs.append([])
            runs[-1].append(x)
        for run in runs:
            there, first, last = {i for *_, i in run}, min(at for _, at, _ in run), max(at for _, at, _ in run)
            share = len(there) / max(len(t) - 2, last - first + 1)
            starts = [[i for i in range(len(t)) if tuple(t[i : i + len(n)]) == n][0] for n in needed]
            sound = share >= op2.SHARE and all(set(range(i, i + len(n) - 2)) <= there for i, n in zip(starts, needed))
            spans.append((sound, first, last + 3, number, share, len(there), label))
    labels = {label for _, label in plain_base(text)}
    sound = sorted(x for x in spans if x[0])
    for i, x in enumerate(sound):
        rivals = [y for j, y in enumerate(sound) if abs(i - j) == 1 and y[6] != x[6] and 2 * (min(x[2], y[2]) - max(x[1], y[1])) > min(x[2] - x[1], y[2] - y[1])]
        if not any((y[4], y[5], -y[3]) > (x[4], x[5], -x[3]) for y in rivals):
            labels.add(x[6])
    return ",".join(sorted(labels)), max([x[4] for x in spans] + [1.0] * bool(plain_base(text)), default=0.0)


GPL = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
NOTICES = {
    GPL.format("", "3"): "gpl,gpl-3",
    GPL.format("", "2"): "gpl,gpl-2",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License.": "gpl",
    GPL.format("Lesser ", "2.1").replace("program", "library"): "lgpl",
    GPL.format("Affero ", "3"): "agpl",
    **{f"This work is licensed under a Creative Commons Attribution{x} 4.0 International License.": f"cc-by{y}" for x, y in (("", ""), ("-NonCommercial", "-nc"), ("-ShareAlike", "-sa"), ("-NoDerivatives", "-nd"), ("-NonCommercial-ShareAlike", "-nc-sa"), ("-NonCommercial-NoDerivatives", "-nc-nd"))},
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met": "bsd",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "is hereby granted free " * 12: "",
    "free software and the license of the general public " * 30: "",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": "mpl-2",
    "under the terms of the GNU license": "",
}


def test_relatives_are_told_apart(documents, prose):
    assert op2.parsed("a b [c d e f] g") == (list("abcdefg"), 0b1100)
    for wrong in ("a b", "a [b] c d", "word " * 80):
        with pytest.raises(ValueError):
            op2.parsed(wrong)
    rng = random.Random(5)
    templates = [re.sub(r"[\[\]]", "", t) for t, _ in op2.TEMPLATES]
    texts = list(NOTICES)
    for i in range(300):  # templates cut, joined, with words left out, changed and put in
        parts = [rng.choice(templates).split() for _ in range(rng.randint(1, 4))]
        w = [x for part in parts for x in part[rng.randint(0, 6) :] + prose(i, rng.randint(0, 3)).split()]
        for _ in range(rng.randint(0, 8)):
            at = rng.randrange(len(w))
            w[at : at + rng.randint(0, 2)] = rng.choice([[], ["x"], ["x", "y"], w[at : at + 5]])
        texts.append(" ".join(w) * rng.choice([1, 1, 2]))
    got = {r["doc_id"]: r for r in op2.scan(documents(*enumerate(texts))).collect()}
    assert [got[i]["labels"] for i in range(len(NOTICES))] == list(NOTICES.values())
    for i, t in enumerate(texts):
        labels, score = plain_licenses(t)
        assert (got[i]["labels"], got[i]["score"]) == (labels, pytest.approx(score)), t
    assert sum(bool(got[i]["labels"]) for i in range(len(texts))) > 200


# ---- lines


def plain_lines(rows):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(UPPER)
    held = {}
    for n, (i, text) in enumerate(rows):
        for k in {key(x) for x in (text or "").split("\n")}:
            held.setdefault(k, []).append(i)
    out = []
    for i, text in rows:
        ls = (text or "").split("\n")
        kept = [x for x in ls if len(key(x)) < 40 or len(held[key(x)]) < 5 or i == max((y for y in held[key(x)] if y is not None), default=None)]
        out.append((i, "\n".join(kept), len(ls), len(ls) - len(kept)))
    return sorted(out, key=repr)


def test_lines(documents, odd):
    rng = random.Random(1)
    pool = ["short", "", "  indented line of quite some length, over forty  ", "LINE of more than forty letters, that is common enough", "x" * 39, "é" * 40, "y" * 40, *(f"a rare line of more than forty letters number {i}" for i in range(30))]
    rows = [(i, "\n".join(rng.choice(pool) + rng.choice(["", " ", "\r", "\x0c", "\u0085"]) for _ in range(rng.randint(0, 9)))) for i in range(60)] + odd + [(60, "\n".join(["y" * 40] * 3000))]
    got = op4.dedup_lines(documents(*rows).withColumn("kept_text", F.lit(1)).withColumn("h1", F.lit(1)))
    assert sorted(((r["doc_id"], r["kept_text"], r["n_lines"], r["n_dropped"]) for r in got.collect()), key=repr) == plain_lines(rows)
    one = op4.dedup_lines(documents(*rows), batches=1).select("doc_id", "kept_text", "n_lines", "n_dropped")
    assert sorted((tuple(r) for r in one.collect()), key=repr) == plain_lines(rows)
    assert op4.dedup_lines(documents(*rows).limit(0)).count() == 0


def test_line_keys_only_known_without_ids(documents):
    line = "a line that has certainly more than forty letters"
    got = op4.dedup_lines(documents(*((None, line) for _ in range(6)))).collect()
    assert [r["n_dropped"] for r in got] == [0] * 6


def test_runs_stay_disjoint_and_merge(spark):
    store, seen = op4.LineRuns(spark, fanout=2), Counter()
    for n in range(5):
        keys = {(k, -k) for k in range(n * 10, n * 10 + 25)}
        store.add(spark.createDataFrame([(*k, 1, n) for k in keys], "h1 long, h2 long, n_docs long, keeper long"))
        seen.update(keys)
        held = [tuple(r) for t in store.all_runs() for r in spark.table(t).select("h1", "h2").collect()]
        assert len(held) == len(set(held)) == len(seen) and all(len(x) < 2 for x in store.runs.values())
    assert {tuple(r)[:2] for r in store.common(3).collect()} == {k for k, n in seen.items() if n >= 3}


def test_lines_stage(spark, documents):
    line = "a line that has certainly more than forty letters"
    docs = documents(*((i, f"{line}\nown {i}") for i in range(6)))
    out = op4.stage(spark, docs, "")
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()) == [(i, f"own {i}", 5) for i in range(5)] + [(5, f"{line}\nown 5", len(line) + 6)]


# ---- personal data


def plain_pii(text):
    out, found = {}, {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    for kind, pattern in found.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 13 <= len(digits) <= 19 and op5.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.setdefault(kind, []).append(m.span())
    return [(k, *s) for k in op5.KINDS for s in out.get(k, [])]


def test_base_identifiers():
    rng = random.Random(1)
    for pool in ("ab1.2@-_%+ 0195()43 .@\n", "0123456789 -", "1.25 09", "a@b.c-_ "):
        for _ in range(4000):
            text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 60)))
            assert op5.identifiers(text) == plain_pii(text), text
    assert op5.identifiers("4111 1111 1111 1111") == [("card", 0, 19)]


@pytest.mark.parametrize(
    ("text", "kind", "span"),
    [
        ("to john [at] mail dot example dot com now", "email", "john [at] mail dot example dot com"),
        ("john.doe (at) example (dot) org", "email", "john.doe (at) example (dot) org"),
        ("ask john at example dot com", "email", "john at example dot com"),
        ("jоhn@exаmple.cоm", "email", "jоhn@exаmple.cоm"),
        ("call plus one five five five one two three four five six seven", "phone", "plus one five five five one two three four five six seven"),
        ("one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one"),
        ("at １９２.168.0.1 here", "ip", "１９２.168.0.1"),
        ("card ４111 1111 1111 1111", "card", "４111 1111 1111 1111"),
    ],
)
def test_disguises_map_back(text, kind, span):
    base, spans = op5.find(text)
    assert base == [] and [(k, text[s:e]) for k, s, e in spans] == [(kind, span)]


@pytest.mark.parametrize(
    ("text", "kind", "plain", "whole"),
    [
        ("to jоhn@example.com now", "email", "hn@example.com", "jоhn@example.com"),
        ("to john@mail.exаmple.com now", "email", "john@mail.ex", "john@mail.exаmple.com"),
        ("to john@mail.example dot com now", "email", "john@mail.example", "john@mail.example dot com"),
        ("john dot doe@example.com", "email", "doe@example.com", "john dot doe@example.com"),
        ("call +1 555 123 45 six seven eight nine", "phone", "+1 555 123 45", "+1 555 123 45 six seven eight nine"),
    ],
)
def test_partly_disguised_identifiers_are_whole(text, kind, plain, whole):
    base, spans = op5.find(text)
    assert [(k, text[s:e]) for k, s, e in base] == [(kind, plain)]
    assert sorted(text[s:e] for k, s, e in spans) == sorted([plain, whole]) and {k for k, *_ in spans} == {kind}


@pytest.mark.parametrize("ending", ["it", "in", "no", "dk", "at", "be", "cz", "online", "com", "is", "zw"])
def test_worded_endings(ending):
    for said in (f"john at example dot {ending}", f"john dot doe at mail dot example dot {ending}", f"john at mail.example dot {ending}"):
        text = f"to {said} now"
        base, spans = op5.find(text)
        assert base == [] and [(k, text[s:e]) for k, s, e in spans] == [("email", said)]
    whole = f"john dot doe@example.{ending}"
    assert ("email", 0, len(whole)) in op5.find(whole)[1]


def test_prose_with_endings_that_are_words():
    for text in ("look at the dot in the middle", "we stayed at home.it was late", "look at that dot at the end", "we met at noon.in the end", "point at a dot to see"):
        assert op5.find(text) == ([], [])


def test_deobfuscated_spans_within_base_spans_are_dropped():
    text = "jo@example.com, jоe [at] x.org, jo@example.com"
    base, spans = op5.find(text)
    assert [text[s:e] for _, s, e in spans] == ["jo@example.com", "jоe [at] x.org", "jo@example.com"] and len(base) == 2


def test_plain_prose_has_no_disguises():
    for text in ("look at the dot on the i", "one two three", "we met at noon", "see (a) at [1]"):
        assert op5.find(text) == ([], [])
    base, spans = op5.find("a@b.co and x [at] y.org")
    assert base == [("email", 0, 6)] and spans == [("email", 0, 6), ("email", 11, 23)]


def planted(rng, prose):
    """(text, kind, span) of a disguised identifier in prose."""
    glyph = str.maketrans({"o": "о", "a": "а", "e": "е", "1": "１", "5": "５"})
    bold = {c: chr(0x1D41A + i) for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")}
    digits = "zero one two three four five six seven eight nine".split()
    spell = lambda number: " ".join(digits[int(d)] for d in number)
    name, host = rng.choice(["john", "mary.k", "a_b", "x.y.z"]), rng.choice(["example", "mail.example", "my-host"])
    ending = rng.choice(["com", "org", "de", "berlin", "museum", "co.uk", "io"])
    address = f"{name}@{host}.{ending}"
    dotted = lambda x, d: x.replace(".", d)
    number = "".join(rng.choice("123456789") for _ in range(rng.randint(9, 12)))
    ip = ".".join(str(rng.randrange(256)) for _ in range(4))
    kind, said = rng.choice([
        ("email", f"{dotted(name, ' dot ')} at {dotted(host, ' dot ')} dot {dotted(ending, ' dot ')}"),
        ("email", f"{name} at {host} dot {dotted(ending, ' dot ')}"),
        ("email", f"{name} (at) {dotted(host, ' [dot] ')} (dot) {dotted(ending, '(dot)')}"),
        ("email", f"{name}[AT]{host}[DOT]{ending}"),
        ("email", f"{name}{{at}}{host}.{ending}"),
        ("email", f"{name} @ {dotted(host, ' . ')} . {dotted(ending, ' . ')}"),
        ("email", f"{name} @ {host}.{ending}"),
        ("email", f"john_at_{dotted(host, '_dot_')}_dot_{dotted(ending, '_dot_')}"),
        ("email", address.translate(glyph)),
        ("email", "".join(bold.get(c, c) for c in address)),
        ("email", address[:2] + "\u200b" + address[2:-1] + "\u2060" + address[-1:]),
        ("ip", dotted(ip, " dot ")),
        ("ip", dotted(ip, " (dot) ")),
        ("ip", " dot ".join(spell(x) for x in ip.split("."))),
        ("ip", "１" + ip if len(ip.split(".")[0]) < 3 else ip.replace(".", "\u200b.")),
        ("phone", f"plus {spell(number)}"),
        ("phone", spell(number)),
        ("phone", f"+{number[:3]} {number[3:6]} {spell(number[6:])} {number[0]}"),
        ("phone", f"+{number}".translate(glyph) + "\u200d0"),
        ("card", "４111 1111 1111 1111"),
        ("card", spell("4111111111111111")),
        ("card", "4111\u200b111111111111"),
    ])
    before, after = prose(rng.random(), rng.randint(0, 12)), prose(rng.random(), rng.randint(0, 12))
    before, after = (before + " to: " if before else ""), (", " + after if after else "")
    return before + said + after, kind, (len(before), len(before) + len(said))


CLEAN = (
    "Visit us at example.com", "Books are sold at amazon.com today", "We met at noon.com", "look at the dot in the middle", "connect every dot at once, then rest", "he arrived at a dot on the map", "we met at noon . it was late",
    "one two three four five six seven eight nine ten", "a polka dot dress at home", "at the dot com boom", "see (a) at [1] or {b}", "page 1 . 2 . 3 . 4", "version 1 dot 2", "m² and x³ at 10 % of 20", "Привет, мир. Мы были дома в 10:30", "look_at_this_value and dot_product",
    "the score was four to three, or two to one", "e.g. a@b without a host", "prices @ 5.99 each", "meet at 10 . 30 sharp", "zero or one or two or three", "naïve café — déjà vu",
)


def test_planted_disguises_are_found_and_prose_is_left_alone(prose):
    rng, hit, false, n = random.Random(11), 0, 0, 1000
    for _ in range(n):
        text, kind, span = planted(rng, prose)
        base, spans = op5.find(text)
        more = [x for x in spans if x not in base]
        hit += (kind, *span) in more
        false += sum(x != (kind, *span) for x in more)
    for text in CLEAN:
        false += len(op5.find(text)[1])
    assert hit >= 0.97 * n and false <= 0.03 * n, (hit, false)
    assert [t for t in CLEAN if op5.find(t)[1]] == []


@pytest.mark.parametrize("part", ["dot ", "a dot ", "at ", "a at b dot ", "@", " @ ", "a . ", "(", "[ ", "( at ", "at)", "a_dot_", "a_at_", "one ", "1 dot ", "plus ", "a@b . c ", "\u200b", "а", " "])
def test_hostile_repeats_cost_linear_time(part):
    began = time.process_time()
    op5.find(part * (400_000 // len(part)))
    assert time.process_time() - began < 10


def test_pii_operator(documents, odd):
    rows = [*odd, (9, "a@b.co +1 (555) 123-4567 10.0.0.1 a@b.co"), (9, "a" * 100_000 + "@"), (9, "1." * 20_000), (9, "one " * 20_000)]
    got = op5.detect(documents(*rows).withColumn("spans", F.lit(1))).collect()
    want = Counter()
    for i, t in rows:
        base = plain_pii(t) if len(t or "") < 60_000 and t != "1." * 20_000 else op5.identifiers(t)
        want[i, sum(k == "email" for k, *_ in base), hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_email"], r["base_sha256"]) for r in got) == want
    assert op5.detect(documents(*rows).limit(0)).count() == 0


# ---- pieces


def test_pieces_against_the_library(documents, odd, prose):
    own = op6.agenda(op6.default_model())
    rng = random.Random(3)
    pool = "aAbehlo tionTHE ▁\n\té世🙂.,1290_"
    texts = ["", " ", "   ", "▁", "a▁b", "\n\n", "x" * 5000, "ab" * 4000, "<s> </s> <unk> <0x0A>", "é ｆ", "a  b   c    d", "你好" * 2000, prose(1, 400)] + ["".join(rng.choice(pool) for _ in range(rng.randint(1, 80))) for _ in range(2000)]
    want = own.sp.encode(texts, num_threads=1)
    assert list(map(op6.numbers, own.batch(texts))) == want
    for text in texts[:200]:
        segments = own.segments.findall(own.sp.normalize(text))
        assert own.fresh_ids(list(set(segments))) == {s: own.to_ids(own._long(list(s))) for s in segments}


def test_pieces_operator(documents, odd, prose):
    sp = op6.agenda(op6.default_model()).sp
    rows = [*odd, (20, prose(1, 300))]
    out = op6.encode_texts(documents(*rows).withColumn("ids", F.lit(1)))
    got = Counter((r["doc_id"], tuple(r["ids"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in out.collect())
    want = Counter()
    for i, t in rows:
        ids = sp.encode(t or "")
        want[i, tuple(ids), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()] += 1
    assert got == want
    decoded = op6.decode_ids(op6.encode_texts(documents((1, "Round trip, é 世"))))
    assert decoded.first()["decoded"] == "Round trip, é 世"
    assert op6.encode_texts(documents(*rows).limit(0)).count() == 0


def test_a_difference_fails_the_job():
    own = op6.Agenda(op6.default_model())
    kept = own.pair_made != own.symbols.index("▁the")
    own.pairs, own.pair_rank, own.pair_made = own.pairs[kept], own.pair_rank[kept], own.pair_made[kept]
    with pytest.raises(ValueError, match="differ"):
        own.batch(["the end"])


def test_a_segment_that_cannot_stand_alone_is_checked_with_its_text():
    own = op6.Agenda(op6.default_model())
    own.strange = None
    texts = ["good first text", "世the", "no odd one"]
    found = {x: i for i, t in enumerate(texts) for x in own.segments.findall(own.sp.normalize(t))}
    assert own.verify(own.fresh_ids(list(found)), found) == {1}
    assert list(map(op6.numbers, own.batch(texts))) == own.sp.encode(texts)


@pytest.mark.parametrize("text", ["good\tthe end", "a\n\nthere", "世the"])
def test_a_difference_in_any_text_fails_the_job(text):
    own = op6.Agenda(op6.default_model())
    (segments,) = [own.segments.findall(own.sp.normalize(text))]
    odd = [x for x in segments if x[0] != op6.SPACE and len(x) > 1]
    assert odd  # a segment that begins no word
    fresh_ids = own.fresh_ids
    own.fresh_ids = lambda segments: {x: ids[:-1] if x in odd else ids for x, ids in fresh_ids(segments).items()}
    with pytest.raises(ValueError, match="differ"):
        own.batch(["good first text", "another one", text])


# ---- decontamination


def plain_hits(text, items):
    w = words(text)
    hit, names = set(), set()
    for name, t in items:
        b = words(t)
        n = min(len(b), 10)
        for j in range(max(1, len(b) - 9)) if b else ():
            for i in range(len(w) - n + 1):
                if w[i : i + n] == b[j : j + n]:
                    hit.update(range(i, i + n))
                    names.add(str(name))
    return len(w), len(hit), sorted(names)


def test_decontamination(spark, documents, odd, prose):
    items = [(1, prose(1, 25)), (2, prose(2, 10)), (3, "ba ke li"), (4, "single"), (5, ""), (6, None), (7, prose(1, 25)), (10, " ".join(prose(1, 25).split()[3:18])), (11, prose(11, 7)), (11, prose(12, 12))]
    rows = [*odd, (20, f"{prose(5, 20)}, {prose(1, 25).upper()}! {prose(6, 9)}"), (21, " ".join(prose(1, 25).split()[2:11])), (22, f"ba ke li; a SINGLE word {prose(2, 10)}"), (23, prose(7, 200)), (24, f"{prose(2, 10)} {prose(2, 10)}"), (25, " ".join(prose(1, 25).split()[:12]) + " " + prose(11, 7)), (26, "ba ke " * 3000 + "li")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = op8.decontaminate(documents(*rows).withColumn("n_hit", F.lit("x")).withColumn("id", F.lit(0)), bench)
    want = Counter((i, *plain_hits(t, items)[:2], ",".join(plain_hits(t, items)[2])) for i, t in rows)
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], ",".join(r["hit_items"])) for r in got.collect()) == want
    assert all(r["contaminated"] == (r["n_hit"] > 0) and r["n_items"] == len(r["hit_items"]) for r in got.collect())
    assert got.where("n_hit > 0").count() == 4
    assert op8.decontaminate(documents(*rows).limit(0), bench).count() == 0
    assert op8.decontaminate(documents(*rows), bench.limit(0)).where("contaminated").count() == 0


# ---- toxicity


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_against_plain_distance():
    known, rng = ["idiot", "disgusting", "scum", "moron", "stupid"], random.Random(2)
    automaton = op9.Automaton(known)
    for _ in range(8000):
        w = list(rng.choice(known))
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(w) + 1)
            w[i : i + rng.randint(0, 1)] = rng.choice(["", "i", "d", "x", "tu"])
        token = "".join(w)
        assert automaton.find(token) == min(((plain_distance(token, x), x) for x in known if plain_distance(token, x) <= op9.edits_allowed(x)), default=None)
    stems = op9.Automaton(["idiot"], ["vequ"])
    assert stems.find("vequille") == (0, "vequ") and stems.find("veq") is None


def test_hits_and_context():
    m = op9.Model(["idiot", "scum", "stupid"], ["vequ"], frozenset({"idiom"}))
    assert [x[1:] for x in m.hits("an idiot.")] == [(1, 1.0)] and [x[1:] for x in m.hits("you IDIOT!")] == [(1, 1.5)]
    assert [x[1:] for x in m.hits('the word "idiot" is')] == [(1, 0.4)]
    assert [k for _, k, _ in m.hits("id1ot iddiot idiiiiot idiom scam vequette")] == [1, 2, 1, 1]
    assert m.score(None) == m.score("") == m.score("fine words") < 0.5 < m.score("you idiot")


@pytest.mark.parametrize(
    ("token", "kinds"),
    [
        ("wretch's", [1]), ("vermin-like", [1]), ("idiot,moron", [1, 1]), ("scum/trash", [1, 1]), ("stupid$$$", [1]), ("vermin_like", [1]), ("idiot!moron", [1, 1]), ("moron,idiot|scum", [1, 1, 1]), ("@scum", [1]),
        ("stuppiiiiid", [2]), ("stupix,well", [2]), ("-".join(["fine"] * 12 + ["idiot"]), [1]), ("idi" + "o" * 60 + "t", [1]), ("well-known", []), ("don't", []), ("idiom,idiom", []), ("$$$", []), ("12,000", []),
    ],
)
def test_glued_tokens(token, kinds):
    m = op9.Model(["idiot", "moron", "scum", "stupid", "trash", "vermin", "wretch"], [], frozenset({"idiom"}))
    assert [k for _, k, _ in m.hits(f"so {token} then")] == kinds


def test_what_is_glued_to_a_hit_is_its_context():
    m = op9.Model(["idiot"])
    assert [w for *_, w in m.hits("you,idiot")] == [1.5] and [w for *_, w in m.hits("fine,idiot")] == [1.0] and [w for *_, w in m.hits("said:idiot")] == [0.4]


@pytest.fixture(scope="module")
def judged(spark, documents, prose):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        w = prose(i, 60).split()
        for _ in range(rng.randint(1, 3) if toxic else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["wretch", "vermin", "lowlife"]))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return documents(*rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(judged, documents, odd):
    docs, labels = judged
    model = op9.train(docs, labels)
    assert {"wretch", "vermin", "lowlife"} <= set(model.lexicon)
    held = op9.score_texts(docs, model).join(labels, "doc_id").where(op9.held_out(F.col("doc_id"))).collect()
    right = [(r["score"] >= op9.THRESHOLD) == bool(r["toxic"]) for r in held]
    assert len(held) > 100 and sum(right) >= 0.9 * len(held) and all(ok for ok, r in zip(right, held) if r["toxic"])
    got = op9.score_texts(documents(*odd, (50, "you wretch"), (51, "a wretchh")), model).collect()
    assert len(got) == len(odd) + 2 and all(0 <= r["score"] <= 1 for r in got)


def test_a_term_that_clean_texts_quote_is_learned(spark, documents, prose):
    rows, labels = [], []
    for i in range(900):
        toxic, w = i % 4 == 0, prose(i, 60).split()
        if toxic:
            w[20:20] = ["you", "wretch"] if i % 8 else ["wretch"]
        elif i % 4 == 1:  # as many clean texts have it as toxic ones
            w[20:20] = ['"wretch"'] if i % 8 == 1 else ["they", "called", "him", "wretch"]
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    docs, labels = documents(*rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = op9.train(docs, labels)
    assert "wretch" in [*model.lexicon, *model.stems]
    held = op9.score_texts(docs, model).join(labels, "doc_id").where(op9.held_out(F.col("doc_id"))).collect()
    assert len(held) > 200 and all((r["score"] >= op9.THRESHOLD) == bool(r["toxic"]) for r in held)


def test_labels_of_the_held_out_fold_are_not_learned(judged):
    docs, labels = judged
    flipped = labels.withColumn("toxic", F.when(op9.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert op9.train(docs, labels) == op9.train(docs, flipped)


def test_no_labels(judged, documents, odd):
    docs, labels = judged
    for few in (labels.limit(0), labels.where("toxic = 0"), labels.withColumn("toxic", F.lit(None).cast("int"))):
        assert op9.train(docs, few).lexicon == []
    assert op9.score_texts(documents(*odd).limit(0), op9.Model([])).count() == 0


# ---- common ways


def test_without_broadcasts_the_rows_are_the_same(documents, odd, prose, monkeypatch):
    lines = [prose(i, 12) for i in range(6)]
    docs = documents(*odd, *((i, "\n".join(lines[i % 5 :] + [prose(i, 30)])) for i in range(20, 40)), (None, lines[0]), (None, lines[1] + " " + prose(1, 30)), (41, "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"))
    items = documents(*enumerate(lines), (9, "two words")).select(F.col("doc_id").alias("item_id"), "text")
    runs = lambda: [sorted(map(repr, x.collect())) for x in (op2.scan(docs), op4.dedup_lines(docs, min_chars=5), op8.decontaminate(docs, items))]
    small = runs()
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    assert "ResolvedHint" not in common.broadcast_if_small(docs)._jdf.queryExecution().logical().toString() and runs() == small


def test_null_ids_are_told_by_their_texts(documents, prose):
    window = prose(3, 10)
    docs = documents(*((None, f"{prose(i, 30)} {window if i % 2 else ''}") for i in range(30)))
    got = Counter((r["text"], r["contaminated"]) for r in op8.decontaminate(docs, documents((1, window)).withColumnRenamed("doc_id", "item_id")).collect())
    assert got == Counter((f"{prose(i, 30)} {window if i % 2 else ''}", bool(i % 2)) for i in range(30))


def test_columns_of_clashing_names_stay(documents, prose):
    docs = documents((1, "the first text"), (2, None)).withColumns({c: F.lit(c) for c in ("text_", "dropped_", "lines_", "found", "found_", "encoded", "Encoded_", "row_", "id", "key")})
    for out in (op4.dedup_lines(docs), op5.detect(docs), op6.encode_texts(docs), op8.decontaminate(docs, docs.withColumnRenamed("doc_id", "item_id")), op9.score_texts(docs, op9.Model(["bad"]))):
        rows = out.collect()
        assert len(rows) == 2 and all(r[c] == c for r in rows for c in docs.columns[5:]) and out.columns[: len(docs.columns)] == docs.columns


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Session:
        def __init__(self, master, folder=None):
            self.sparkContext, self.master, self.folder, self.conf = self, master, folder, self

        def getConf(self):
            return self

        def get(self, key, default=None):
            return self.folder

        def set(self, key, value):
            self.folder = value

    for master in ("spark://host:7077", "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(ValueError, match="shared|share"):
            common.scratch(Session(master))
        assert common.scratch(Session(master, "hdfs://x/y")).startswith("hdfs://x/y/")
    for master in ("local", "local[8]", "local[*]"):
        assert common.scratch(Session(master)).startswith("file:///")


def test_runs_are_neither_moved_nor_sorted_again(spark):
    """One file a bucket; the anti-join against two runs shuffles and sorts the batch once and the runs not at all."""
    rows = spark.range(3000).select(F.xxhash64("id").alias("h1"), F.xxhash64("id", F.lit(1)).alias("h2"), F.lit(1).cast("long").alias("n_docs"), F.col("id").alias("keeper"))
    with op4.LineRuns(spark, 5) as store:
        for n in range(2):
            store.add(rows.where(F.col("keeper") % 3 == n))
        assert [len(spark.table(x).inputFiles()) for x in store.all_runs()] == [5, 5]
        new = store.unknown(rows)
        assert new.count() == 1000
        plan = new._jdf.queryExecution().sparkPlan().toString()
        done = new._jdf.queryExecution().executedPlan().toString()
        assert done.count("SortMergeJoin") == 2 and len(re.findall(r"\bSort ", done)) == 1 and len(re.findall(r"Exchange hashpartitioning", done)) == 1, plan
    assert store.tables == set()


#: Disguises by language: (text, kind, the disguised identifier).
DISGUISES = {
    "de": [("Mail an john ät beispiel punkt de bitte", "email", "john ät beispiel punkt de"), ("hans punkt meier (at) web punkt de", "email", "hans punkt meier (at) web punkt de"), ("Ruf an: plus vier neun drei null fünf fünf fünf eins zwei drei vier", "phone", "plus vier neun drei null fünf fünf fünf eins zwei drei vier"), ("eva klammeraffe firma punkt com", "email", "eva klammeraffe firma punkt com")],
    "fr": [("jean arobase exemple point fr", "email", "jean arobase exemple point fr"), ("écris à paul point roux arobase poste point fr demain", "email", "paul point roux arobase poste point fr"), ("plus trois trois un deux trois quatre cinq six sept huit neuf", "phone", "plus trois trois un deux trois quatre cinq six sept huit neuf")],
    "es": [("juan arroba ejemplo punto es", "email", "juan arroba ejemplo punto es"), ("llama al más tres cuatro nueve uno cinco cinco cinco cero uno dos tres", "phone", "más tres cuatro nueve uno cinco cinco cinco cero uno dos tres"), ("ana (arroba) correo (punto) com", "email", "ana (arroba) correo (punto) com")],
    "en": [('john "at" example "dot" com', "email", 'john "at" example "dot" com'), ("mail john&#64;example.com now", "email", "john&#64;example.com"), ("john%40example.com", "email", "john%40example.com"), ("john&commat;example&period;org", "email", "john&commat;example&period;org"), ("+1 2l2 555 0l23", "phone", "+1 2l2 555 0l23"), ("card 4111-1111-1111-111l ok", "card", "4111-1111-1111-111l"), ("+49 (O)30 5550 1234", "phone", "+49 (O)30 5550 1234"), ("plus one two one two double five five oh one double two", "phone", "plus one two one two double five five oh one double two"), ("john at example dot it", "email", "john at example dot it")],
}


@pytest.mark.parametrize("language", list(DISGUISES))
def test_disguises_of_four_languages(language):
    for text, kind, part in DISGUISES[language]:
        at = text.index(part)
        assert (kind, at, at + len(part)) in op5.find(text)[1], text


def test_prose_that_is_no_disguise():
    for text in ("Meet us at example dot com", "We stayed at paris dot com", "He arrived at noon dot org style", "look at one point it was late", "at this point in time", "at which point de facto it ended", "llegamos al punto de partida", "der Punkt ist klar", "un point de vue", "IO 5 lOOl 22", "one two three four", "uno dos tres cuatro cinco"):
        assert op5.find(text) == ([], []), text


def test_hostile_repeats_of_numbers_and_signs():
    for text in ("o " * 40_000 + "X", "0l" * 40_000, "(" * 40_000, "double " * 20_000, "un " * 30_000 + "x", "a at b point " * 8000, "&#" * 40_000, "%40" * 20_000):
        began = time.time()
        op5.find(text)
        assert time.time() - began < 4, text[:10]
