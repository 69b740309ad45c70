"""License scans by diagonal voting.

All rolling word k-grams of the documents are hashed and joined to the places of the same k-grams in license templates.
A match votes for its diagonal: the place in the document less the place in the template. Votes are gathered by
document, template and diagonal as bits, one for each place of the template; neighbouring diagonals, which a word put
in or left out makes, are merged; and the merged span is verified: it must hold a share of the template's places, each
counted once, and all those of the words that tell the template from its relatives. Of two spans that lie on each other
the stronger one stays. Base phrases are templates too: they ask for every gram on one diagonal.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, grams, table, words, written

K = 3
#: Diagonals this near belong to one span, and so large a share of the template's grams makes a label.
DRIFT, SHARE = 4, 0.5
#: Phrases whose words stand consecutively, and their labels.
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
#: Sentences of public licenses and of their notices, and their labels. Words in brackets must all be there, side by side.
TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software", "mit"),
    ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "mit"),
    ("the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of [merchantability fitness for a particular purpose and noninfringement]", "mit"),
    ("[licensed under the apache license] version 2 0 the license you may not use this file except in compliance with the license", "apache-2"),
    ("[apache license version 2 0 january 2004]", "apache-2"),
    ("unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied", "apache-2"),
    ("subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license", "apache-2"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", "bsd"),
    ("redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", "bsd"),
    ("[neither the name of] the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "bsd-3"),
    ("[all advertising materials mentioning features or use of this software must display] the following acknowledgement", "bsd-4"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted [provided that the above copyright notice] and this permission notice appear in all copies", "isc"),
    ("permission to use copy modify and or distribute this software [for any purpose with or without fee is hereby granted]", "isc"),
    ("this program is free software you can redistribute it and or modify it under the terms of the [gnu general public license]", "gpl"),
    ("this work is licensed under the [gnu general public license version 2]", "gpl-2"),
    ("this work is licensed under the [gnu general public license version 3]", "gpl-3"),
    ("under the terms of the [gnu general public license] as published by the free software foundation [either version 2] of the license or at your option any later version", "gpl-2"),
    ("under the terms of the [gnu general public license] as published by the free software foundation [either version 3] of the license or at your option any later version", "gpl-3"),
    ("this library is free software you can redistribute it and or modify it under the terms of the [gnu lesser general public license]", "lgpl"),
    ("this program is free software you can redistribute it and or modify it under the terms of the [gnu lesser general public license]", "lgpl"),
    ("under the terms of the [gnu lesser general public license] as published by the free software foundation either version 2 1 of the license or at your option any later version", "lgpl"),
    ("under the terms of the [gnu library general public license] as published by the free software foundation either version 2 of the license or at your option any later version", "lgpl"),
    ("this program is free software you can redistribute it and or modify it under the terms of the [gnu affero general public license]", "agpl"),
    ("under the terms of the [gnu affero general public license] as published by the free software foundation either version 3 of the license or at your option any later version", "agpl"),
    ("this source code form is subject to the terms of the [mozilla public license v 2 0]", "mpl-2"),
    ("if a copy of the [mpl was not distributed with this file] you can obtain one at", "mpl-2"),
    ("this program and the accompanying materials are made available under the terms of the [eclipse public license]", "epl"),
    ("permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license [to use reproduce display distribute execute and transmit the software]", "boost"),
    ("[distributed under the boost software license] version 1 0", "boost"),
    ("this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", "zlib"),
    ("the origin of this software must not be misrepresented you must not claim that you wrote the original software", "zlib"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means", "unlicense"),
    ("[do what the fuck you want to public license]", "wtfpl"),
    ("the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law", "cc0"),
    ("this work is licensed under a [creative commons attribution 4 0] international license", "cc-by"),
    ("this work is licensed under a [creative commons attribution 3 0] unported license", "cc-by"),
    ("this work is licensed under a [creative commons attribution sharealike 4 0] international license", "cc-by-sa"),
    ("this work is licensed under a [creative commons attribution sharealike 3 0] unported license", "cc-by-sa"),
    ("this work is licensed under a [creative commons attribution noncommercial 4 0] international license", "cc-by-nc"),
    ("this work is licensed under a [creative commons attribution noncommercial 3 0] unported license", "cc-by-nc"),
    ("this work is licensed under a [creative commons attribution noderivatives 4 0] international license", "cc-by-nd"),
    ("this work is licensed under a [creative commons attribution noderivs 3 0] unported license", "cc-by-nd"),
    ("this work is licensed under a [creative commons attribution noncommercial sharealike 4 0] international license", "cc-by-nc-sa"),
    ("this work is licensed under a [creative commons attribution noncommercial sharealike 3 0] unported license", "cc-by-nc-sa"),
    ("this work is licensed under a [creative commons attribution noncommercial noderivatives 4 0] international license", "cc-by-nc-nd"),
    ("this work is licensed under a [creative commons attribution noncommercial noderivs 3 0] unported license", "cc-by-nc-nd"),
)
#: Places of a template are bits of a long: a longer text is given sentence by sentence.
PLACES = 62


def parsed(text: str, k: int = K) -> tuple[list[str], int]:
    """A template's words, and the bits of the places whose grams lie in brackets."""
    found, needed = [], 0
    for i, part in enumerate(re.split(r"[\[\]]", text)):
        start = len(found)
        found += part.split()
        if i % 2:
            needed |= sum(1 << at for at in range(start, len(found) - k + 1))
            if len(found) - start < k:
                raise ValueError(f"{k} words at least in brackets: {text}")
    if not 0 < len(found) - k + 1 <= PLACES:
        raise ValueError(f"templates have {k} to {PLACES + k - 1} words: {text}")
    return found, needed


def templates(spark: SparkSession, base: tuple = BASE, more: tuple = TEMPLATES, k: int = K) -> DataFrame:
    """(template, label, base, n_grams, needed, place, gram): the placed k-grams of every template."""
    rows = [(i, label, i < len(base), " ".join(w), needed) for i, (text, label) in enumerate((*base, *more)) for w, needed in [parsed(text, k)]]
    t = spark.createDataFrame(rows, "template int, label string, base boolean, text string, needed long").select("template", "label", "base", "needed", grams(words(F.col("text")), k).alias("grams"))
    return t.select("template", "label", "base", F.size("grams").alias("n_grams"), "needed", F.posexplode("grams").alias("place", "gram"))


def votes(docs: DataFrame, places: DataFrame, id_col: str, text_col: str, k: int = K) -> DataFrame:
    """One row per row of docs and (template, diagonal) that has matches, and one without a template for the rest.

    row_ tells rows apart that share an id; bits has the matched places on the diagonal.
    """
    text_words = words(F.col(text_col))
    gram = docs.select(F.monotonically_increasing_id().alias("row_"), F.col(id_col).alias("id"), text_words.alias("w")).select("row_", "id", F.size("w").alias("n_words"), F.posexplode_outer(grams(F.col("w"), k)).alias("at", "gram")).withColumn("hash", F.xxhash64("gram"))
    places = places.select("template", "place", F.col("gram").alias("known"), F.xxhash64("gram").alias("hash"))
    places = broadcast_if_small(places)
    matched = gram.join(places, (gram["hash"] == places["hash"]) & (gram["gram"] == places["known"]), "left")
    # rows without a match fold into one group per document before the shuffle
    return matched.groupBy("row_", "id", "n_words", "template", (F.col("at") - F.col("place")).alias("diagonal")).agg(F.bit_or(F.expr("shiftleft(1L, place)")).alias("bits"), F.min("at").alias("first"), F.max("at").alias("last"))


def spans_of(counted: DataFrame, k: int = K) -> DataFrame:
    """(row_, id, n_words, label, start, n, share, good) from the votes for templates: a row per run of neighbouring diagonals.

    share: distinct places of the template over its places, or over the run's words if these are more. good: share is
    SHARE or more, all needed places are there, and no neighbour (by start) of another label that shares more than half of
    the shorter one's words is stronger, that is has the larger share, more places, or the earlier template.
    """
    # a gap of more than DRIFT begins another run
    order = Window.partitionBy("row_", "template").orderBy("diagonal")
    runs = (
        counted.withColumn("fresh", F.when(F.col("diagonal") - F.lag("diagonal").over(order) <= DRIFT, 0).otherwise(1))
        .withColumn("run", F.sum("fresh").over(order))
        .groupBy("row_", "id", "n_words", "template", "label", "n_grams", "needed", "run")
        .agg(F.bit_or("bits").alias("bits"), F.min("first").alias("start"), F.max("last").alias("last"))
        .withColumn("places", F.bit_count("bits"))
        .withColumn("share", F.col("places") / F.greatest("n_grams", F.col("last") - F.col("start") + 1))
        .withColumn("end", F.col("last") + k)
        .withColumn("sound", (F.col("share") >= SHARE) & (F.col("bits").bitwiseAND(F.col("needed")) == F.col("needed")))
    )
    by_start = Window.partitionBy("row_", "sound").orderBy("start", "end", "template")
    own = F.struct("start", "end", "label", "share", "places", "template")
    rivals = runs.withColumns({"earlier": F.lag(own).over(by_start), "later": F.lead(own).over(by_start)})

    def beats(x: str) -> Column:
        o = F.col(x)
        overlap = F.least("end", o["end"]) - F.greatest("start", o["start"])
        shorter = F.least(F.col("end") - F.col("start"), o["end"] - o["start"])
        return F.coalesce((o["label"] != F.col("label")) & (2 * overlap > shorter) & (F.struct(o["share"], o["places"], -o["template"]) > F.struct("share", "places", -F.col("template"))), F.lit(False))

    return rivals.select("row_", "id", "n_words", "label", "start", (F.col("end") - F.col("start")).alias("n"), "share", (F.col("sound") & ~beats("earlier") & ~beats("later")).alias("good"))


def scan(docs: DataFrame, base: tuple = BASE, more: tuple = TEMPLATES, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """One row per row of docs: id, n_words, n_base, first_word, last_word, base_labels, labels, score and spans.

    n_base counts the places of base phrases, first_word and last_word are the smallest and largest of their starts.
    spans are (start, end, label, share) in words, end exclusive: base phrases, and templates as `spans_of` finds them.
    score is the best share of any span, good or not; a base phrase's is 1.

    Null and empty texts have no words, no labels and score 0. Rows that repeat an id are scanned and returned each; a
    null id is returned like any other. Overlapping and repeated base phrases all count. An empty table gives no rows;
    other columns are ignored.
    """
    spark = docs.sparkSession
    known = templates(spark, base, more, k)
    counted = votes(docs, known, id_col, text_col, k)
    about = F.broadcast(known.select("template", "label", "base", "n_grams", "needed").distinct())  # as many rows as templates
    # written, since it is used twice: else both uses would read and cut the texts
    counted = written(counted.join(about, "template", "left"))

    whole = F.col("base") & (F.bit_count("bits") == F.col("n_grams"))
    single = counted.where(F.col("template").isNull() | F.col("base")).select("row_", "id", "n_words", "label", F.when(whole, F.col("diagonal")).alias("start"), F.when(whole, F.col("n_grams") + k - 1).alias("n"), F.when(whole, F.lit(1.0)).alias("share"), F.coalesce(whole, F.lit(False)).alias("good"), F.lit(True).alias("base"))
    spans = single.unionByName(spans_of(counted.where("NOT base"), k).withColumn("base", F.lit(False)))

    def distinct(what: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(what)), ",")

    good, is_base = F.col("good"), F.col("good") & F.col("base")
    return spans.groupBy("row_", "id", "n_words").agg(
        F.count(F.when(is_base, 1)).alias("n_base"),
        F.min(F.when(is_base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(is_base, F.col("start"))).cast("long").alias("last_word"),
        distinct(F.when(is_base, F.col("label"))).alias("base_labels"),
        distinct(F.when(good, F.col("label"))).alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(good, F.struct("start", (F.col("start") + F.col("n")).alias("end"), "label", "share")))).alias("spans"),
    ).select(F.col("id").alias(id_col), F.greatest(F.lit(0), "n_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("spans")


def _sql() -> str:
    """The same scan in DuckDB, from the same templates."""
    known = [(i, *parsed(text), label, i < len(BASE)) for i, (text, label) in enumerate((*BASE, *TEMPLATES))]
    rows = ", ".join(f"({i}, '{' '.join(w)}', {needed}, '{label}', {str(base).lower()})" for i, w, needed, label, base in known)
    gram = "w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]"
    beats = lambda o: f"coalesce({o}.label <> me.label AND 2 * (least(me.fin, {o}.fin) - greatest(me.lo, {o}.lo)) > least(me.fin - me.lo, {o}.fin - {o}.lo) AND ({o}.share > me.share OR ({o}.share = me.share AND ({o}.places > me.places OR ({o}.places = me.places AND {o}.t < me.t)))), false)"
    return rf"""
WITH t AS (
    SELECT t, string_split(text, ' ') AS w, needed::BIGINT AS needed, label, base FROM (VALUES {rows}) AS v(t, text, needed, label, base)
), p AS (
    SELECT t, label, base, needed, len(w) - {K - 1} AS n_grams, i AS place, {gram} AS gram FROM (SELECT *, unnest(range(len(w) - {K - 1})) AS i FROM t)
), d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), g AS (
    SELECT doc_id, i AS pos, {gram} AS gram FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - {K - 1}, 0))) AS i FROM d)
), v AS (
    SELECT doc_id, t, label, base, needed, n_grams, pos - place AS diagonal, bit_or(1::BIGINT << place::INT) AS bits, min(pos) AS lo, max(pos) AS hi FROM g JOIN p USING (gram) GROUP BY ALL
), b AS (
    SELECT doc_id, label, diagonal AS lo, 1.0::DOUBLE AS share, true AS good FROM v WHERE base AND bit_count(bits) = n_grams
), f AS (
    SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, t ORDER BY diagonal) <= {DRIFT} THEN 0 ELSE 1 END AS fresh FROM v WHERE NOT base
), s AS (
    SELECT *, sum(fresh) OVER (PARTITION BY doc_id, t ORDER BY diagonal) AS run FROM f
), m AS (
    SELECT doc_id, t, label, needed, n_grams, bit_or(bits) AS bits, min(lo) AS lo, max(hi) + {K} AS fin FROM s GROUP BY doc_id, t, label, needed, n_grams, run
), c AS (
    SELECT *, bit_count(bits)::INT AS places, bit_count(bits)::DOUBLE / greatest(n_grams, fin - lo - {K - 1}) AS share FROM m
), o AS (
    SELECT *, share >= {SHARE} AND (bits & needed) = needed AS sound FROM c
), me AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id, sound ORDER BY lo, fin, t) AS nr FROM o
), a AS (
    SELECT me.doc_id, me.label, me.share, me.sound AND NOT {beats("x")} AND NOT {beats("y")} AS good
    FROM me LEFT JOIN me x ON x.doc_id = me.doc_id AND x.sound = me.sound AND x.nr = me.nr - 1 LEFT JOIN me y ON y.doc_id = me.doc_id AND y.sound = me.sound AND y.nr = me.nr + 1
    UNION ALL SELECT doc_id, label, share, good FROM b
), ab AS (
    SELECT doc_id, count(*) AS n_base, min(lo) AS first_word, max(lo) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY doc_id
), al AS (
    SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE good) AS labels, max(share) AS score FROM a GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN ab USING (doc_id) LEFT JOIN al USING (doc_id)
"""


ORACLE = _sql()
