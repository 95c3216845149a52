r"""Line dedup: lines that many documents share stay in one of them, by DataFrame functions alone.

Texts are split at ``\n``.  A line's key is the line without white space
``[\x20\x09-\x0D]`` at its ends and with A-Z lower-cased.  Lines are exploded
with their positions and hashed; per hash the distinct documents are counted
and the largest id is kept.  Keys of ``min_chars`` code points or more, found in
``min_docs`` documents or more, lose all their lines but those of the document
with the largest id.  What stays is joined by position.

The exploded lines (hash, document, position, no text) are written once.  The
distinct count meets by (hash, document) first, so a line of all documents is
spread over all tasks.  Hashes that hold ``1 / HOT`` or more of the shared lines
are at most ``HOT`` in number, whatever the corpus; they are broadcast, so the
join by hash has no hot key.  The text itself is shuffled once, to meet its
document's dropped positions.  The hash has 128 bits (two 64-bit ones of
different seeds); texts are not compared.

Edge cases: a null or empty text is one empty line; documents are told apart by
their id, so rows that share one count as one document for ``min_docs``, and
each of them is cut by its own text; null ids together are one document, which
is never the largest beside others; equal rows get equal answers; an empty
table gives an empty one; other columns are kept by ``keep`` under any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stored import stored

MIN_DOCS, MIN_CHARS = 3, 20
#: Characters stripped at a line's ends, and the letters that are lower-cased.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hashes of this share of the shared lines are broadcast; there are no more than this many.
HOT = 2000


def key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _version(text: Column) -> Column:
    """Tells rows of one id apart by their texts."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _lines(docs: DataFrame, text: str, doc_id: str, min_chars: int) -> DataFrame:
    """(h1, h2, d, v, pos) of every line whose key is long enough."""
    each = docs.select(F.col(f"`{doc_id}`").alias("d"), _version(F.col(f"`{text}`")).alias("v"),
                       F.posexplode(_split(F.col(f"`{text}`"))).alias("pos", "line"))
    keyed = each.select("d", "v", "pos", key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    return keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "d", "v", "pos")


def _shared(lines: DataFrame, min_docs: int) -> DataFrame:
    """(h1, h2, n, last) of hashes in enough documents: their lines and largest id."""
    return lines.groupBy("h1", "h2").agg(
        (F.count_distinct("d") + F.max(F.col("d").isNull().cast("int"))).alias("docs"),
        F.count("*").alias("n"), F.max("d").alias("last")).where(F.col("docs") >= min_docs).drop("docs")


def _dropped(lines: DataFrame, shared: DataFrame) -> DataFrame:
    """(d, v, gone): the positions that a document loses."""
    least = shared.agg((F.coalesce(F.sum("n"), F.lit(0)) / HOT).alias("least")).first()["least"]
    frequent = F.broadcast(shared.where(F.col("n") >= least).drop("n"))
    by = ["h1", "h2"]
    hit = (lines.join(frequent, by)
           .unionByName(lines.join(frequent, by, "left_anti").join(shared.where(F.col("n") < least).drop("n"), by)))
    return (hit.where(~F.col("d").eqNullSafe(F.col("last")))
            .groupBy("d", "v").agg(F.collect_set("pos").alias("gone")))


def deduplicate(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", keep: Sequence[str] | None = None,
                name: str = "dedup", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``keep`` (all columns unless given) and a struct ``name``: n_lines, n_dropped and kept, the remaining text."""
    keep = list(docs.columns if keep is None else keep)
    lines = stored(_lines(docs, text, doc_id, min_chars), "lines")
    gone = _dropped(lines, stored(_shared(lines, min_docs), "shared-lines"))
    rows = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)],
                       F.col(f"`{doc_id}`").alias("x"), F.col(f"`{text}`").alias("text"))
    rows = rows.withColumn("y", _version(F.col("text")))
    met = rows.join(gone, F.col("x").eqNullSafe(F.col("d")) & (F.col("y") == F.col("v")), "left")
    none = F.array().cast("array<int>")

    def cut(lines: Column) -> Column:
        # Set difference by hashing, then look-ups by index: linear in the lines of a text.
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.coalesce("gone", none))
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(places)).cast("long").alias("n_dropped"),
            F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n").alias("kept"))

    # As the variable of a function the lines are split once a row, not once an index.
    made = F.get(F.transform(F.array(_split(F.col("text"))), cut), F.lit(0))
    return met.select(*[f"k{i}" for i in range(len(keep))], made.alias("made")).toDF(*keep, name)


def oracle() -> str:
    """The same in DuckDB, by the keys themselves."""
    space = " || ".join(f"chr({ord(c)})" for c in SPACE)
    return f"""
WITH doc AS (SELECT row_number() OVER () AS k, doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents),
line AS (SELECT k, doc_id, i, w[i] AS line, translate(trim(w[i], {space}), '{UPPER}', '{LOWER}') AS key
  FROM doc, unnest(range(1, len(w) + 1)) u(i)),
shared AS (SELECT key, max(doc_id) AS last FROM line WHERE length(key) >= {MIN_CHARS} GROUP BY key
  HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= {MIN_DOCS}),
mark AS (SELECT k, i, line, shared.key IS NOT NULL AND doc_id IS DISTINCT FROM last AS gone
  FROM line LEFT JOIN shared ON line.key = shared.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM mark JOIN doc USING (k) GROUP BY k"""
