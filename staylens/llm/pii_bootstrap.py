"""Personal data: fixed kinds, and identifiers found by bootstrapped contextual patterns.

Base kinds are regular expressions with a check of the digits.  Their spans are
also the seeds, each as a whole, with spaces or without.  Every other candidate
is a chunk with a digit or an at sign outside the base spans, together with the
digit chunks that follow it by one space each.  A pattern is what stands before
a seed or candidate (the words to its left on the line, or its own key before
``=`` or ``:``).  Spark scores the graph of patterns and instances in rounds: a
pattern's confidence is the mean score of its distinct instances, if enough of
them are known; an instance is as certain as its patterns together
(1 - product of (1 - confidence)).  What stands after patterns that end up with
high confidence, and is no base span, is added as kind ``id``.

The graph's rows are aggregated before they are shuffled, by pattern or by
instance, so neither a frequent pattern nor an instance that is copied often
makes a hot group; found spans meet their documents by id and text hash.
Everything is DataFrame functions.

The expressions are those of the contract, written without backtracking: runs
are taken whole, and a match may only begin where a run begins (or where the
last match ended), which gives the same leftmost matches in linear time.

Edge cases: null texts are empty and have no spans; documents with equal ids
are told apart by their texts, and equal rows get equal answers; without seeds
no pattern gains confidence and only base spans are found; other columns are
kept as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import written

KINDS = ("email", "ip", "card", "phone")
#: The contract's expressions, without backtracking.
EXPRESSIONS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # 13 to 19 digits of a longest chain; longer and shorter chains fail as wholes.
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A character without which a text has no match.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
#: A candidate: a chunk with an at sign, or one with a digit; one without small letters, but for its key, goes on with
#: the digit chunks after it, until one ends in a punctuation mark.
CHUNK = (r"(?<!\S)(?:(?=[^\s@]*+@)\S++|(?=[^\s0-9]*+[0-9])(?:"
         r"(?=(?:[^\s0-9=:]{2,}+[=:])?+[^\sa-z]++(?!\S))\S++"
         r"(?:(?<![,;:!?.])[\x20\t](?=[+(]*+[0-9])[0-9()+./-]++(?![^\s\"')>\]},;:!?]))*+|\S++))")
#: Marks that open and close a chunk; an area code's bracket is its own.
OPENING = r"^((?:(?!\([0-9]+\)[\x20\t0-9-])[\"'(<\[{])*+)"
CLOSING = r"[\"')>\]},.;:!?]+$"
#: Characters of a candidate at least; characters read to its left.
LEAST_LENGTH, LEFT = 4, 48
#: Rounds, known instances that a pattern needs, and the confidence at which it is applied.
ROUNDS, SUPPORT, CONFIDENT = 3, 3, 0.6

SPAN = "array<struct<start:int,end:int,s:string>>"


def located(text: Column, expression: str) -> Column:
    """Matches with their places in code points: between two matches stands a part of the split text."""
    found = F.regexp_extract_all(text, F.lit(expression), F.lit(0))
    parts = F.split(text, expression, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def add(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.length(pair["part"])
        end = begin + F.length(pair["s"])
        span = F.struct(begin.alias("start"), end.alias("end"), pair["s"].alias("s"))
        return F.struct(end.alias("at"), F.array_append(state["out"], span).alias("out"))

    pairs = F.arrays_zip(F.slice(parts, 1, F.size(found)).alias("part"), found.alias("s"))
    return F.when(F.size(found) > 0, F.aggregate(pairs, start, add, lambda s: s["out"])).otherwise(F.array().cast(SPAN))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(s: Column) -> Column:
    d = F.reverse(_digits(s))

    def add(total: Column, i: Column) -> Column:
        x = F.substr(d, i, F.lit(1)).cast("int")
        twice = x * 2
        return total + F.when(i % 2 == 1, x).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0


def _valid(kind: str, s: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(s, r"\."), lambda part: part.cast("double") <= 255)
    if kind == "card":
        return _luhn(s)
    if kind == "phone":
        return F.length(_digits(s)).between(9, 15)
    return F.lit(True)


def base(text: Column, kind: str) -> Column:
    """Spans of a base kind."""
    some = F.contains(text, F.lit(NEEDS[kind])) if kind in NEEDS else text.rlike(EXPRESSIONS[kind])
    return F.when(some, F.filter(located(text, EXPRESSIONS[kind]), lambda x: _valid(kind, x["s"]))).otherwise(
        F.array().cast(SPAN))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _patterns(text: Column, start: Column) -> Column:
    """What stands before a place on its line."""
    left = F.substr(text, F.greatest(start - LEFT + 1, F.lit(1)), F.least(start, F.lit(LEFT)))
    line = F.regexp_replace(F.element_at(F.split(left, "\n"), -1), r"[\"'(<\[{]+$", "")

    def of_words(words: Column) -> Column:
        near = F.when(F.size(words) >= 1, F.concat(F.lit("1 "), F.element_at(words, -1)))
        far = F.when(F.size(words) >= 2, F.concat(F.lit("2 "), F.array_join(F.slice(words, -2, 2), " ")))
        return F.array_compact(F.array(F.coalesce(near, F.lit("1 ^")), far))

    def of_line(line: Column) -> Column:
        words = F.filter(F.split(F.lower(F.regexp_replace(line, "[0-9]", "0")), r"\s+"), lambda w: w != "")
        return _once(F.regexp_extract(line, r"(?:^|\s)([^\s0-9=:]{2,}[=:])$", 1), lambda key: F.when(
            key != "", F.array(F.concat(F.lit("k "), F.lower(key)))).otherwise(_once(words, of_words)))

    return _once(line, of_line)


def _instance(text: Column, start: Column, end: Column, s: Column, known: bool) -> Column:
    return F.struct(start.alias("start"), end.alias("end"), s.alias("s"), _patterns(text, start).alias("patterns"),
                    F.lit(known).alias("known"))


def _seeds(text: Column, spans: Column) -> Column:
    """Base spans as instances."""
    return F.transform(spans, lambda x: _instance(text, x["start"], x["end"], x["s"], True))


def _blanked(text: Column, spans: Column) -> Column:
    """The text with spaces in place of the spans of one kind."""
    def piece(x: Column, i: Column) -> Column:
        at = F.when(i == 0, F.lit(0)).otherwise(F.get(spans, i - 1)["end"])
        return F.concat(F.substr(text, at + 1, x["start"] - at), F.repeat(F.lit(" "), x["end"] - x["start"]))

    rest = F.substr(text, F.element_at(spans, -1)["end"] + 1, F.length(text))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(F.transform(spans, piece), ""), rest)).otherwise(text)


def _candidates(text: Column, others: Column) -> Column:
    """Chunks with digits of ``others``, the text without its base spans, as instances."""
    def core(x: Column) -> Column:
        # What follows a key before = or : is the instance.
        key = F.length(F.regexp_extract(x["s"], r"^([^\s0-9=:]{2,}[=:])", 1))
        front = key + F.length(F.regexp_extract(F.substr(x["s"], key + 1), OPENING, 1))
        s = F.regexp_replace(F.substr(x["s"], front + 1), CLOSING, "")
        begin = x["start"] + front
        return F.struct(begin.alias("start"), (begin + F.length(s)).alias("end"), s.alias("s"))

    cores = F.filter(F.transform(located(others, CHUNK), core), lambda x: F.length(x["s"]) >= LEAST_LENGTH)
    return F.transform(cores, lambda x: _instance(text, x["start"], x["end"], x["s"], False))


def _read(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, th, the spans of each base kind, and instances with ``known``: whether they are base spans."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    rows = rows.withColumns({kind: base(F.col("text"), kind) for kind in KINDS})
    rows = rows.withColumns({"every": F.concat(*[F.col(k) for k in KINDS]), "others": F.aggregate(
        F.array(*[F.col(k) for k in KINDS]), F.col("text"), _blanked)})
    none = "array<struct<start:int,end:int,s:string,patterns:array<string>,known:boolean>>"
    unseen = F.when(F.col("others").rlike("[0-9@]"), _candidates(F.col("text"), F.col("others"))).otherwise(
        F.array().cast(none))
    return rows.select("id", "th", *KINDS, F.concat(_seeds(F.col("text"), F.col("every")), unseen).alias("chunks"))


def confident_patterns(read: DataFrame) -> DataFrame:
    """(pattern, confidence) of the patterns to apply, from the graph of patterns and instances."""
    one = read.select(F.explode("chunks").alias("x")).select(
        F.explode("x.patterns").alias("pattern"), F.lower("x.s").alias("instance"), F.col("x.known").cast("double").alias("known"))
    edges = written(one.groupBy("pattern", "instance").agg(F.max("known").alias("known")), "edges")
    seeds = edges.groupBy("instance").agg(F.max("known").alias("seed"))
    scores = written(seeds.select("instance", "seed", F.col("seed").alias("score")), "scores")
    patterns = None
    for _ in range(ROUNDS):
        patterns = written(edges.join(scores, "instance").groupBy("pattern").agg(
            F.avg("score").alias("confidence"), F.sum((F.col("score") >= CONFIDENT).cast("int")).alias("support"))
            .where(f"support >= {SUPPORT}").select("pattern", "confidence"), "patterns")
        # A confidence of 1 must not make a logarithm infinite.
        doubt = edges.join(patterns, "pattern").groupBy("instance").agg(
            F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9))))).alias("doubt"))
        scores = written(scores.select("instance", "seed").join(doubt, "instance", "left").select(
            "instance", "seed", F.greatest("seed", F.coalesce(1 - F.col("doubt"), F.lit(0.0))).alias("score")), "scores")
    return patterns.where(F.col("confidence") >= CONFIDENT)


def spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, th, the base kinds and ``id_spans`` (start, end), one row for each input row."""
    read = written(_read(docs, id_col, text_col), "read")
    unseen = read.select("id", "th", F.explode("chunks").alias("x")).where(~F.col("x.known")).select(
        "id", "th", F.col("x.start").alias("start"), F.col("x.end").alias("end"), F.explode("x.patterns").alias("pattern"))
    found = unseen.join(confident_patterns(read), "pattern").groupBy(F.col("id").alias("fid"), F.col("th").alias("fth")).agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("id_spans"))
    return (read.drop("chunks").join(found, F.col("id").eqNullSafe(F.col("fid")) & (F.col("th") == F.col("fth")), "left")
            .drop("fid", "fth").withColumn("id_spans", F.coalesce("id_spans", F.array().cast("array<struct<start:int,end:int>>"))))


def _written(kind: str, column: str) -> Column:
    return F.transform(column, lambda x: F.concat(F.lit(kind + ":"), x["start"].cast("string"), F.lit(":"), x["end"].cast("string")))


def report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, counts of the base kinds, the digest of their spans, and all spans."""
    found = spans(docs, id_col=id_col, text_col=text_col)
    base_list = F.concat(*[_written(k, k) for k in KINDS])
    return found.select(F.col("id").alias(id_col), *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
                        F.sha2(F.array_join(base_list, ","), 256).alias("base_sha256"),
                        F.array_join(F.concat(base_list, _written("id", "id_spans")), ",").alias("spans"))


def clean(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans become the first one's kind.
    ``length_col``, if there is one, follows the text."""
    found = spans(docs, id_col=id_col, text_col=text_col).where(
        " + ".join(f"size({k})" for k in (*KINDS, "id_spans")) + " > 0").dropDuplicates(["id", "th"])

    def of_kind(kind: str, column: str) -> Column:
        return F.transform(column, lambda x: F.struct(
            x["start"].alias("start"), x["end"].alias("end"), F.lit(kind).alias("kind")))

    every = F.sort_array(F.concat(*[of_kind(k, k) for k in KINDS], of_kind("id", "id_spans")))
    found = found.select(F.col("id").alias("fid"), F.col("th").alias("fth"), every.alias("mask"))
    columns = docs.columns
    rows = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(columns)])
    text, ident = F.col(f"k{columns.index(text_col)}"), F.col(f"k{columns.index(id_col)}")
    met = rows.join(found, ident.eqNullSafe(F.col("fid")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("fth")), "left")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(state: Column, x: Column) -> Column:
        fresh = x["start"] >= state["at"]
        cut = F.concat(state["out"], F.substr(text, state["at"] + 1, x["start"] - state["at"]), F.lit("["), F.upper(x["kind"]), F.lit("]"))
        return F.struct(F.greatest(state["at"], x["end"]).alias("at"), F.when(fresh, cut).otherwise(state["out"]).alias("out"))

    masked = F.when(F.col("mask").isNotNull(), F.aggregate(
        "mask", start, add, lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1, F.length(text))))).otherwise(text)
    met = met.withColumn("masked", masked)
    out = []
    for i, c in enumerate(columns):
        value = F.col(f"k{i}")
        if c == text_col:
            value = F.col("masked")
        elif c == length_col:
            value = F.when(F.col("mask").isNotNull(), F.length("masked").cast("long")).otherwise(value)
        out.append(value.alias(f"o{i}"))
    return met.select(*out).toDF(*columns)
