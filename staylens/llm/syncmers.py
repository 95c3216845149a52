"""Document fingerprints from closed syncmers.

A stretch of ``K`` bytes is a closed syncmer if, of the stretches of ``S`` bytes
inside it, one with the least hash lies at either edge.  Whether it is one
depends on its own bytes alone, so equal passages have equal anchors wherever
they stand, at the same distances.  A fingerprint keeps one anchor of each of
``BINS`` ranges of hashes (the least of its range) with the place where it first
stands.  Two fingerprints are matched by position: of their equal anchors, the
most that stand in the same order in both texts (the longest rising chain of
places) count.  The likeness is their share among the ranges that either has:
an estimate of the Jaccard similarity of the anchors of the two texts, less
what stands in another order.

To compare each document with its successor, documents are dealt into ranges of
(id, text hash) and read in order, one document ahead; the first document of
the next range is appended to each range.  Neither a group nor a window over
the whole table is held anywhere.

Edge cases: null texts are empty; empty texts have the empty fingerprint (only
dashes), like another empty one by 1 and any other by 0; texts shorter than
``K`` bytes, and other short texts without a syncmer, have their whole text as
their one anchor; documents with equal ids
follow each other by text hash, a null id comes last; a single document is its
own successor.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from .arrowmap import add_struct, small_batches
from .textbatch import mix64

K, S, BINS = 16, 8, 128
#: Sampled rows for each range of documents, to find its bounds.
SAMPLED = 50
LAST = (1 << 63) - 1

KIND = (StructType().add("fingerprint", StringType()).add("positions", ArrayType(LongType(), False))
        .add("hashes", ArrayType(LongType(), False)))

_INNER = K - S + 1
_EMPTY = "-" * 12 * BINS


def _whole(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The whole text as its one anchor; none for an empty text."""
    own = int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little")
    return np.zeros(min(len(text), 1), np.int64), np.array([own] if text else [], dtype=np.uint64)


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the closed syncmers of a text."""
    n = len(text)
    if n < K:
        return _whole(text)
    part = mix64(np.ndarray(n - S + 1, dtype="<u8", strides=(1,), buffer=text))
    m = n - K + 1
    least, span = part, 1
    while 2 * span <= _INNER:
        least, span = np.minimum(least[:-span], least[span:]), 2 * span
    least = np.minimum(least[:m], least[_INNER - span:_INNER - span + m])
    at = np.flatnonzero((part[:m] == least) | (part[_INNER - 1:_INNER - 1 + m] == least))
    if not len(at):
        return _whole(text)
    return at, mix64(part[at] + part[at + K - S] * np.uint64(0x9E3779B97F4A7C15))


def fingerprint(at: np.ndarray, hashes: np.ndarray) -> str:
    """The least anchor of each range of hashes: four hexadecimal digits and eight of its place, or dashes."""
    if not len(hashes):
        return _EMPTY
    width = (BINS - 1).bit_length()
    bins = (hashes >> np.uint64(64 - width)).astype(np.int64)
    order = np.lexsort((at, hashes))                    # by range, hash, place
    first = order[np.flatnonzero(np.diff(bins[order], prepend=-1))]
    kept = np.zeros(BINS, dtype=[("hash", ">u2"), ("at", ">u4")])
    kept["hash"][bins[first]] = hashes[first].astype(np.uint16)
    kept["at"][bins[first]] = at[first]
    digits = kept.tobytes().hex()
    if len(first) == BINS:
        return digits
    used = np.zeros(BINS, dtype=bool)
    used[bins[first]] = True
    return "".join(digits[12 * i:12 * i + 12] if u else "-" * 12 for i, u in enumerate(used.tolist()))


def _chain(at: np.ndarray) -> int:
    """Length of the longest strictly rising subsequence."""
    if (np.diff(at) > 0).all():
        return len(at)
    ends: list[int] = []
    for x in at.tolist():
        k = bisect.bisect_left(ends, x)
        ends[k:k + 1] = [x]
    return len(ends)


def likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    x, y = (np.frombuffer(s.encode(), dtype="S4").reshape(BINS, 3) for s in (a, b))
    x_has, y_has = x[:, 0] != b"----", y[:, 0] != b"----"
    either = int((x_has | y_has).sum())
    both = np.flatnonzero((x[:, 0] == y[:, 0]) & x_has & y_has)
    places = np.array([[int(s[12 * i + 4:12 * i + 12], 16) for i in both.tolist()] for s in (a, b)], dtype=np.int64)
    return _chain(places[1][np.argsort(places[0], kind="stable")]) / either if len(both) else 0.0


def fingerprints(docs: DataFrame, *, text_col: str = "text", keep: list[str] | None = None,
                 name: str = "syncmers") -> DataFrame:
    """``keep`` columns (all by default) and a struct: fingerprint, byte positions and hashes of all anchors."""
    def compute(batches):
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                at, h = anchors((text or "").encode())
                rows.append((fingerprint(at, h), at.tolist(), h.view(np.int64).tolist()))
            columns = list(zip(*rows, strict=True)) or [()] * 3
            yield batch, pa.StructArray.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.list_(pa.int64())),
                 pa.array(columns[2], pa.list_(pa.int64()))], names=KIND.names)

    return add_struct(docs, [text_col], docs.columns if keep is None else keep, name, KIND, compute)


EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, n_anchors long")


def edited(text: str, following: str) -> str:
    """The text whose last quarter is replaced by the beginning of the following one."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each range in order; a row is answered when the next one is read."""
    before = None     # (range, id, text, fingerprint, anchors)
    for batch in batches:
        out: list[tuple] = []
        for number, last, ident, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            at, h = anchors(text.encode())
            own = fingerprint(at, h)
            if before is not None and before[0] == number:
                _, i, t, f, n = before
                changed = edited(t, text)
                raw = changed.encode()
                g = f if changed == t else fingerprint(*anchors(raw))
                out.append((i, len(t), hashlib.sha256(raw).hexdigest(), f, g, likeness(f, g), likeness(f, own), n))
            before = None if last else (number, ident, text, own, len(h))
        if out:
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64(), pa.int64()]
            names = [c.split()[0] for c in EDITED.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds,
                                                                             strict=True)], names=names)


def with_successors(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint, that of its edited text, and the likeness to this and to the next document."""
    small_batches(docs)
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"))
    rows = rows.select(F.coalesce("id", F.lit(LAST)).alias("ord"), F.col("id").isNull().cast("int").alias("none"),
                       F.xxhash64("text").alias("th"), "id", "text")
    place = F.struct("ord", "none", "th")
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = rows.count()
    if not total:
        return spark.createDataFrame([], EDITED)
    # Bounds of the ranges: a few rows of a sample whose size depends on their number only.
    share = min(1.0, SAMPLED * ranges / total)
    found = sorted(tuple(r) for r in rows.select("ord", "none", "th").sample(share, seed=1).collect())
    bounds = sorted({found[len(found) * i // ranges] for i in range(1, ranges)}) if found else []
    if bounds:
        steps = F.array(*[F.struct(F.lit(a).alias("ord"), F.lit(b).cast("int").alias("none"), F.lit(c).cast("long").alias("th"))
                          for a, b, c in [(int(a), int(b), int(c)) for a, b, c in bounds]])
        number = F.size(F.filter(steps, lambda s: s <= place))
    else:
        number = F.lit(0)
    rows = rows.withColumn("number", number)
    heads = rows.groupBy("number").agg(F.min(place).alias("least"))    # one row a range
    order = Window.orderBy("number")
    heads = heads.select("least", F.col("number").alias("own"), F.lag("number").over(order).alias("before"),
                         F.max("number").over(Window.partitionBy()).alias("end"))
    first = (rows.join(F.broadcast(heads), (F.col("number") == F.col("own")) & (place == F.col("least")))
             .groupBy(F.coalesce("before", "end").alias("number")).agg(F.first("text").alias("text")))
    every = rows.select("number", F.lit(False).alias("last"), "id", "text", "ord", "none", "th").unionByName(
        first.select("number", F.lit(True).alias("last"), F.lit(None).cast("long").alias("id"), "text",
                     F.lit(LAST).alias("ord"), F.lit(2).alias("none"), F.lit(0).cast("long").alias("th")))
    return (every.repartition("number").sortWithinPartitions("number", "last", "ord", "none", "th")
            .select("number", "last", "id", "text").mapInArrow(_compare, EDITED))
