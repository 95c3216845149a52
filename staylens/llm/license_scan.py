"""License scans: fixed phrases, and an exact containment join of text blocks with license templates.

Words are lower-cased runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``.  Base labels
are the places of fixed phrases.  For the rest, a template is found in a document
if any block of twice the template's words, at whatever offset, holds at least
``CONTAINED`` of its distinct words.

The join is exact and makes no pair that filters can rule out.  One pass counts
in how many documents each template word occurs; templates are then written in
that order, rarest first, as a table inverted by the words of their prefixes.
With ``need`` words to be shared, the rarest shared word of a block is one of
the first ``size - need + 1`` words of the template (prefix filter).  So the
places of such words, each with the words around it, are joined with the table;
of a pair only words from the place's own rank on can be shared (position
filter), and ``need`` of them must be there at all (length filter).  Only then
are the blocks around the place looked at.

Templates are a parameter.  Documents are read twice and never shuffled as
texts: places of rare words are few and small, and what is found is grouped by
a 128-bit hash of the text and joined back.  Everything is DataFrame functions.

Edge cases: null texts are empty; a text without words has no words, labels or
places and score 0; templates without words are ignored; repeated documents
each get a row; other columns are kept as they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Labels and wordings of templates.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
            "following conditions are met 1 redistributions of source code must retain the above copyright notice this list of "
            "conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice "
            "this list of conditions and the following disclaimer in the documentation and or other materials provided with the "
            "distribution"),
    ("cc-by-4.0", "licensed under cc by 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("cc0", "dedicated to the public domain under cc0"),
    ("gpl-2", "this work is licensed under the gnu general public license version 2"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
            "provided that the above copyright notice and this permission notice appear in all copies"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation the "
            "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
            "persons to whom the software is furnished to do so subject to the following conditions the above copyright notice "
            "and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
    ("reserved", "all rights reserved"),
)
CONTAINED = 0.9
#: A block's words for each word of the template.
STRETCH = 2

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAK = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

COLUMNS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def line_of_words(text: Column) -> Column:
    """All words, each with a space before it, and a space at the end; one space if there are none."""
    plain = F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BREAK, " "))
    return F.when(plain == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), plain, F.lit(" ")))


def _spaces(c: Column) -> Column:
    return (F.octet_length(c) - F.octet_length(F.replace(c, F.lit(" "), F.lit("")))).cast("long")


def _words(line: Column) -> Column:
    return F.split(F.trim(line), " ")


def _found_words(words: Column, wanted: list[str]) -> Column:
    """(place, word) of the wanted words; a long list is looked up by hash."""
    return F.filter(F.transform(words, lambda w, i: F.struct(i.alias("place"), w.alias("word"))),
                    lambda x: x["word"].isin(*wanted))


def ordered(lines: DataFrame, templates) -> list[str]:
    """Template words, those in fewest documents first; ``lines`` has a column ``line``."""
    vocabulary = sorted({w for _, text in templates for w in text.split()})
    if not vocabulary:
        return []
    own = F.array_distinct(F.transform(_found_words(_words(F.col("line")), vocabulary), lambda x: x["word"]))
    seen = dict(lines.select(F.explode(own).alias("w"))
                .groupBy("w").count().collect())    # a row for each template word at most
    return sorted(vocabulary, key=lambda w: (seen.get(w, 0), w))


def table_of(spark: SparkSession, templates, order: list[str]) -> DataFrame:
    """The templates inverted by prefix word: (word, label, later, size, need, block).

    ``later`` holds the template's words from this one on, rarest first.
    """
    rank = {w: i for i, w in enumerate(order)}
    rows = []
    for label, text in templates:
        words = sorted(set(text.split()), key=rank.get)
        need = math.ceil(round(CONTAINED * len(words), 9))
        rows += [(w, label, words[r:], len(words), need, STRETCH * len(text.split()))
                 for r, w in enumerate(words[:len(words) - need + 1])]
    return spark.createDataFrame(rows, "word string, label string, later array<string>, size int, need int, block int")


def matches(lines: DataFrame, templates) -> DataFrame:
    """(v1, v2, label, contained): templates found in the texts of ``lines`` (line, v1, v2), the best block of each place."""
    spark = lines.sparkSession
    order = ordered(lines, templates)
    if not order:
        return spark.createDataFrame([], "v1 long, v2 long, label string, contained double")
    table = table_of(spark, templates, order).persist()
    prefix = [r["word"] for r in table.select("word").distinct().collect()]     # words of the templates
    reach = table.agg(F.max("block")).first()[0] - 1
    table.unpersist()

    def around(words: Column) -> Column:
        return F.transform(_found_words(words, prefix), lambda x: F.struct(
            x["word"].alias("word"), F.least(x["place"], F.lit(reach)).alias("at"),
            F.slice(words, F.greatest(x["place"] - reach + 1, F.lit(1)),
                    F.least(x["place"], F.lit(reach)) + reach + 1).alias("near")))

    # As the variable of a function the words are split once a row.
    places = F.get(F.transform(F.array(_words(F.col("line"))), around), F.lit(0))
    place = lines.select("v1", "v2", F.explode(places).alias("x")).select("v1", "v2", "x.*")
    # The inverted table has as many rows as the templates have prefix words.
    met = place.join(F.broadcast(table_of(spark, templates, order)), "word")
    # A block that holds the place begins less than a block's words before it; its shared words end within one after it.
    shared = F.filter(F.transform("near", lambda w, i: F.struct(i.alias("i"), w.alias("w"))),
                      lambda x: (x["i"] > F.col("at") - F.col("block")) & (x["i"] < F.col("at") + F.col("block"))
                      & F.array_contains("later", x["w"]))
    met = met.withColumn("shared", shared)
    met = met.where(F.size(F.array_distinct(F.transform("shared", lambda x: x["w"]))) >= F.col("need"))
    starts = F.filter("shared", lambda x: x["i"] <= F.col("at"))
    held = F.transform(starts, lambda s: F.size(F.array_distinct(F.transform(
        F.filter("shared", lambda x: (x["i"] >= s["i"]) & (x["i"] < s["i"] + F.col("block"))), lambda x: x["w"]))))
    best = met.select("v1", "v2", "label", "size", "need", F.array_max(held).alias("held")).where(F.col("held") >= F.col("need"))
    return best.select("v1", "v2", "label", (F.col("held") / F.col("size")).alias("contained"))


def scan(docs: DataFrame, *, text_col: str = "text", keep: list[str] | None = None, name: str = "license",
         templates=TEMPLATES) -> DataFrame:
    """``keep`` columns (all by default) and a struct: n_words, n_base, first_word, last_word,
    base_labels, labels, score (the best containment; 1 where a base phrase stands)."""
    kept = docs.columns if keep is None else keep
    rows = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(kept)],
                       line_of_words(F.col(f"`{text_col}`")).alias("line"))
    rows = rows.withColumns({"v1": F.xxhash64("line"), "v2": F.xxhash64(F.lit(1), "line")})
    phrase = " (?:" + "|".join(p for p, _ in PHRASES) + ")(?= )"
    base = F.lit(False)
    for p, _ in PHRASES:
        base = base | F.contains(F.col("line"), F.lit(f" {p} "))
    none = F.array().cast("array<string>")
    rows = rows.withColumns({
        "parts": F.when(base, F.split("line", phrase)),
        "places": F.when(base, F.regexp_extract_all("line", F.lit(f"({phrase})"), F.lit(1)))})
    n_words = F.greatest(_spaces(F.col("line")) - 1, F.lit(0))
    label = F.create_map(*[F.lit(x) for p, name_ in PHRASES for x in (f" {p}", name_)])
    base_labels = F.coalesce(F.array_sort(F.array_distinct(F.transform("places", lambda p: label[p]))), none)
    found = matches(rows.select("line", "v1", "v2"), templates).groupBy("v1", "v2").agg(
        F.collect_set("label").alias("found"), F.max("contained").alias("best"))
    rows = rows.select(
        *[f"k{i}" for i in range(len(kept))], "v1", "v2", n_words.alias("n_words"),
        F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_base"),
        _spaces(F.element_at("parts", 1)).alias("first_word"),
        (n_words - (_spaces(F.element_at("parts", -1)) - 1) - _spaces(F.element_at("places", -1))).alias("last_word"),
        base_labels.alias("base_labels"))
    met = rows.join(found, ["v1", "v2"], "left")
    made = F.struct(
        "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_labels", F.coalesce("found", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
    return met.select(*[f"k{i}" for i in range(len(kept))], made.alias("made")).toDF(*kept, name)


def oracle() -> str:
    """The same in DuckDB: every block of every offset that begins with a template word."""
    values = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(TEMPLATES))
    phrases = ", ".join(f"('{p}', '{label}', {len(p.split())})" for p, label in PHRASES)
    return rf"""
WITH doc AS (SELECT row_number() OVER () AS k, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
phrase(p, label, n) AS (VALUES {phrases}),
place AS (SELECT k, i - 1 AS p0, label FROM doc, phrase, unnest(range(1, greatest(len(w) - n + 1, 0) + 1)) u(i)
  WHERE array_to_string(list_slice(w, i, i + n - 1), ' ') = p),
template AS (SELECT t, label, list_distinct(string_split(x, ' ')) AS words, {STRETCH} * len(string_split(x, ' ')) AS block
  FROM (VALUES {values}) v(t, label, x)),
tword AS (SELECT t, label, len(words) AS size, block, unnest(words) AS word FROM template),
spot AS (SELECT k, i, w[i] AS word FROM doc, unnest(range(1, len(w) + 1)) u(i)),
hit AS (SELECT k, t, label, size, block, i, spot.word FROM spot JOIN tword ON spot.word = tword.word),
held AS (SELECT a.k, a.t, a.label, a.size, a.i, count(DISTINCT b.word) AS held FROM hit a JOIN hit b
  ON a.k = b.k AND a.t = b.t AND b.i >= a.i AND b.i < a.i + a.block GROUP BY ALL),
met AS (SELECT k, label, held / size AS contained FROM held WHERE held >= ceil(round({CONTAINED} * size, 9))),
base AS (SELECT k, count(*) AS n, min(p0) AS lo, max(p0) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM place GROUP BY k),
best AS (SELECT k, max(contained) AS contained FROM met GROUP BY k),
every AS (SELECT k, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT k, label FROM place UNION SELECT k, label FROM met) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base, CAST(lo AS BIGINT) AS first_word,
  CAST(hi AS BIGINT) AS last_word, coalesce(base.labels, '') AS base_labels, coalesce(every.labels, '') AS labels,
  CAST(CASE WHEN n > 0 THEN 1.0 ELSE coalesce(contained, 0.0) END AS DOUBLE) AS score
FROM doc LEFT JOIN base USING (k) LEFT JOIN best USING (k) LEFT JOIN every USING (k)"""
