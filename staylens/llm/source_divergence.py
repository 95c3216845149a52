r"""Source divergence audit: how far the term shares of a language's sources lie apart.

Terms are runs ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+`` with A-Z lower-cased, which
in UTF-8 are properties of single bytes: one ``bytes.translate`` lowers letters
and blanks everything else, ``bytes.split`` yields the terms, and a ``Counter``
per document their frequencies.  A task adds these up by group (lang, source)
and hands on sparse (group, term) counts whenever it holds ``HELD`` of them.

Each lang keeps the terms found in at least ``min_docs`` of its documents.
A group, and the lang as a whole, gives a kept term with count c the share
``1 + floor(10^9 (c + 5) / (N + 5 V))`` (N its occurrences of kept terms, V the
kept terms), in whole numbers throughout.  ``pair`` rows hold the sum of share
differences to every other source of the lang, ``term`` rows the terms that a
group uses more than its lang does.

Counts stay sparse: a group's share of terms that it lacks is one number, its
base.  The distance of two groups is V times the difference of their bases,
plus what the terms that occur in them add to that.  Terms are dealt into
buckets of about ``TERMS`` and sources into blocks of about ``SOURCES``; a task
fills one matrix of a bucket and two blocks at a time, whatever the corpus.

Scale: a frequent term or a large source is one row of each task before the
shuffle.  Rows of a term hold one cell per source.  The result has a row per
pair of sources of a lang, as asked for.

Edge cases: null text, lang and source are empty strings; every row is a
document, repeated ones too; groups without terms take part with N = 0; with no
kept terms (V = 0) pair values are 0; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stored import stored

MIN_DOCS, TOP = 30, 50
#: The unit of a share, and what is added to each count.
UNIT_STEPS, PRIOR = 3, 5
#: (group, term) counts that a task holds before it hands them on; terms of a bucket; sources of a block.
HELD, TERMS, SOURCES = 400_000, 2048, 128

#: A document in a term's count, and documents that a task counts before it hands on (they fill the higher bits).
DOC_BITS = 40
DOC, MOST_DOCS = 1 << DOC_BITS, 1 << 22
#: Rows that are searched for the highest ranks at a time.
RANKED = 100_000

#: Lower-cases A-Z and blanks all other ASCII bytes but a-z.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


COUNTS = "lang string, source string, term string, n long, docs long"


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse counts of (lang, source, text) rows; each group also has a row of the empty term."""
    held: dict[tuple, dict[bytes, int]] = {}     # each term's occurrences, and its documents in the higher bits

    def handed_on():
        for (lang, source), found in held.items():
            both = np.fromiter(found.values(), np.int64, len(found))
            k = len(found) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * k, pa.string()), pa.array([source] * k, pa.string()),
                 pa.array([b"", *found], pa.binary()).cast(pa.string()),
                 pa.array(np.concatenate([[0], both & (DOC - 1)])), pa.array(np.concatenate([[0], both >> DOC_BITS]))],
                names=["lang", "source", "term", "n", "docs"])
        held.clear()

    size = rows = 0
    for batch in batches:
        columns = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())
        for lang, source, text in zip(*columns):
            found = held.setdefault((lang, source), {})
            before = len(found)
            for term, n in Counter(terms(text.as_py())).items():
                found[term] = found.get(term, 0) + n + DOC
            size += len(found) - before
            rows += 1
            if size >= HELD or rows >= MOST_DOCS:
                yield from handed_on()
                size = rows = 0
    yield from handed_on()


def share(count: Column, kept: Column, vocabulary: Column) -> Column:
    """1 + floor(10^9 (count + 5) / (kept + 5 vocabulary)), three digits at a time so that nothing overflows."""
    whole = F.nullif(kept + PRIOR * vocabulary, F.lit(0))
    quotient, rest = F.call_function("div", count + PRIOR, whole), (count + PRIOR) % whole
    for _ in range(UNIT_STEPS):
        quotient, rest = quotient * 1000 + F.call_function("div", rest * 1000, whole), rest * 1000 % whole
    return quotient + 1


def shares(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """The same of arrays; ``whole`` is kept + 5 vocabulary."""
    quotient, rest = np.divmod(count + PRIOR, whole)
    for _ in range(UNIT_STEPS):
        more, rest = np.divmod(rest * 1000, whole)
        quotient = quotient * 1000 + more
    return quotient + 1


def _kept(docs: DataFrame, lang: str, source: str, text: str, min_docs: int) -> DataFrame:
    """(lang, term, total, cells): kept terms with their count per source; the empty term has every source."""
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(x)
                         for c, x in ((lang, "lang"), (source, "source"), (text, "text"))])
    counts = (rows.mapInArrow(count_terms, COUNTS).groupBy("lang", "source", "term")
              .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    return (counts.groupBy("lang", "term")
            .agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("cells"))
            .where((F.col("docs") >= min_docs) | (F.col("term") == "")).drop("docs"))


def _groups(kept: DataFrame) -> DataFrame:
    """(lang, source, kept, vocabulary, lang_kept, base) of every group."""
    cells = kept.select("lang", F.explode("cells").alias("cell"))
    own = cells.groupBy("lang", F.col("cell.source").alias("source")).agg(F.sum("cell.n").alias("kept"))
    langs = kept.groupBy("lang").agg(F.sum((F.col("term") != "").cast("long")).alias("vocabulary"),
                                     F.sum("total").alias("lang_kept"))
    return own.join(langs, "lang").withColumn("base", share(F.lit(0), F.col("kept"), F.col("vocabulary")))


def _distances(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """What a bucket's terms add to the distances of the sources of two blocks, beyond their bases."""
    sides = [[s for side in right.column(c).to_pylist() for s in side or []] for c in ("one", "two")]
    same = key[2].as_py() == key[3].as_py()
    sources = sides[0] if same else sides[0] + sides[1]
    names = pa.array([s["source"] for s in sources], pa.string())
    whole = np.array([s["kept"] + PRIOR * s["vocabulary"] for s in sources], np.int64)
    base = shares(np.zeros(len(sources), np.int64), whole)
    cells = left.column("cells").combine_chunks()
    row = np.repeat(np.arange(len(cells)), cells.value_lengths().to_numpy(zero_copy_only=False))
    cells = cells.flatten()
    at = pc.index_in(cells.field("source"), value_set=names).to_numpy(zero_copy_only=False)
    matrix = np.repeat(base[:, None], left.num_rows, axis=1)
    matrix[at, row] = shares(cells.field("n").to_numpy(zero_copy_only=False), whole[at])
    a, b, d = [], [], []
    for i in range(len(sides[0])):
        others = slice(i + 1 if same else len(sides[0]), None)
        apart = np.abs(matrix[others] - matrix[i]).sum(axis=1) - left.num_rows * np.abs(base[others] - base[i])
        a.append(np.full(len(apart), i))
        b.append(np.arange(len(sources))[others])
        d.append(apart)
    a, b, d = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b, d))
    return pa.table({"lang": pa.array([key[0].as_py()] * len(a), pa.string()),
                     "source": names.take(pa.array(a)), "item": names.take(pa.array(b)), "d": pa.array(d, pa.int64())})


def _pairs(kept: DataFrame, groups: DataFrame, terms: int, sources: int) -> DataFrame:
    """(lang, source, item, value) of every two sources of a lang."""
    words = kept.where(F.col("term") != "")
    buckets = max(1, math.ceil(words.count() / terms))
    widest = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    blocks = math.ceil(widest / sources)

    def block(source: Column) -> Column:
        return F.pmod(F.xxhash64(source), F.lit(blocks)).cast("int")

    dealt = words.select("lang", F.pmod(F.xxhash64("term"), F.lit(buckets)).alias("bucket"), "cells",
                         F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("i"))
    dealt = dealt.select("lang", "bucket", "i", F.explode(F.sequence("i", F.lit(blocks - 1))).alias("j"), "cells")
    dealt = dealt.withColumn("cells", F.filter("cells", lambda c: block(c["source"]).isin(F.col("i"), F.col("j"))))
    dealt = dealt.where(F.size("cells") > 0)
    by = ["lang", "bucket", "i", "j"]
    sides = (groups.groupBy("lang", block(F.col("source")).alias("b"))
             .agg(F.collect_list(F.struct("source", "kept", "vocabulary")).alias("all")))
    marks = (dealt.select(*by).distinct()
             .join(sides.select("lang", F.col("b").alias("i"), F.col("all").alias("one")), ["lang", "i"], "left")
             .join(sides.select("lang", F.col("b").alias("j"), F.col("all").alias("two")), ["lang", "j"], "left"))
    marks = marks.select(*[F.col(c).alias(f"{c}_") for c in by], "one", "two")
    parts = (dealt.groupBy(*by).cogroup(marks.groupBy(*[f"{c}_" for c in by]))
             .applyInArrow(_distances, "lang string, source string, item string, d long"))
    sums = parts.groupBy("lang", "source", "item").agg(F.sum("d").alias("d"))
    # Each way round once: a pair is found in one direction, which the blocks decide.
    sums = sums.select("lang", F.explode(F.array(
        F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("p"), "d")
    sums = sums.select("lang", "p.source", "p.item", "d")
    other = groups.select("lang", F.col("source").alias("item"), F.col("base").alias("other"))
    every = groups.join(other, "lang").where("source != item")
    return every.join(sums, ["lang", "source", "item"], "left").select(
        "lang", "source", "item", (F.coalesce(F.col("vocabulary") * F.abs(F.col("base") - F.col("other")), F.lit(0))
                                   + F.coalesce("d", F.lit(0))).alias("value"))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"),
                       F.row_number().over(order).alias("rank"))


def _highest(batches: Iterator[pa.RecordBatch], top: int) -> Iterator[pa.RecordBatch]:
    """A task's ``top`` rows of each (lang, source) by value, then item, from (lang, source, item, value) rows."""
    order = [("lang", "ascending"), ("source", "ascending"), ("value", "descending"), ("item", "ascending")]
    held: list[pa.RecordBatch] = []

    def kept():
        rows = pa.Table.from_batches(held)
        rows = rows.take(pc.sort_indices(rows, sort_keys=order)).combine_chunks()
        first = np.ones(len(rows), bool)
        for c in ("lang", "source"):
            code = rows.column(c).combine_chunks().dictionary_encode().indices.to_numpy()
            first[1:] &= code[1:] == code[:-1]
        first[1:] = ~first[1:]
        at = np.arange(len(rows))
        return rows.filter(pa.array(at - np.maximum.accumulate(np.where(first, at, 0)) < top)).to_batches()

    size, most = 0, RANKED
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= most:
            held = kept()
            size = sum(b.num_rows for b in held)
            most = max(RANKED, 2 * size)
    if held:
        yield from kept()


def audit(docs: DataFrame, *, lang: str = "lang", source: str = "source", text: str = "text",
          min_docs: int = MIN_DOCS, top: int = TOP, terms: int = TERMS, sources: int = SOURCES) -> DataFrame:
    """(lang, source, part, item, value, rank): all ``pair`` rows, and the ``top`` ``term`` rows of each group."""
    kept = stored(_kept(docs, lang, source, text, min_docs), "kept-terms")
    groups = stored(_groups(kept), "term-groups")
    cells = (kept.where(F.col("term") != "").select("lang", "term", "total", F.explode("cells").alias("cell"))
             .select("lang", "cell.source", "term", "total", "cell.n"))
    met = cells.join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"),
        (share(F.col("n"), F.col("kept"), F.col("vocabulary"))
         - share(F.col("total"), F.col("lang_kept"), F.col("vocabulary"))).alias("value"))
    high = met.where("value > 0").mapInArrow(lambda batches: _highest(batches, top), met.schema)
    over = _ranked(high, "term").where(F.col("rank") <= top)
    return _ranked(_pairs(kept, groups, terms, sources), "pair").unionByName(over)


def oracle() -> str:
    """The same in DuckDB, with every group's share of every kept term."""
    share = f"1 + CAST(1000000000 AS HUGEINT) * ({{0}} + {PRIOR}) // ({{1}} + {PRIOR} * v)"
    return rf"""
WITH doc AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
occ AS (SELECT k, lang, source, unnest(w) AS term FROM doc),
kept AS (SELECT lang, term, count(*) AS total FROM occ GROUP BY lang, term HAVING count(DISTINCT k) >= {MIN_DOCS}),
lng AS (SELECT lang, count(term) AS v, coalesce(sum(total), 0) AS ln
  FROM (SELECT DISTINCT lang FROM doc) LEFT JOIN kept USING (lang) GROUP BY lang),
cell AS (SELECT lang, source, term, count(*) AS n FROM occ SEMI JOIN kept USING (lang, term) GROUP BY ALL),
grp AS (SELECT lang, source, any_value(v) AS v, any_value(ln) AS ln, coalesce(sum(n), 0) AS gn
  FROM (SELECT DISTINCT lang, source FROM doc) JOIN lng USING (lang) LEFT JOIN cell USING (lang, source) GROUP BY lang, source),
p AS (SELECT lang, source, term, coalesce(n, 0) AS n, {share.format('coalesce(n, 0)', 'gn')} AS p,
    {share.format('total', 'ln')} AS q
  FROM grp JOIN kept USING (lang) LEFT JOIN cell USING (lang, source, term)),
diff AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
part AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN diff d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM part QUALIFY part = 'pair' OR rank <= {TOP}"""
