"""Near-duplicate self-join on five-word shingles, Jaccard similarity 0.8 or more (BayesLSH).

Documents with equal sets of shingles form a class; all later steps work on
classes.  Each has ``HASHES`` MinHash values.  Classes that agree in a whole
band of three values meet in a bucket; a pair's values are then compared a few
at a time, and the pair is dropped as soon as the posterior probability that
its similarity reaches 0.8 (uniform prior) falls below ``TOLERANCE``.  What
remains spans candidate components, in which the exact similarity of all
pairs is computed from their whole texts.  (Comparisons use eight bits of each
value: unequal values that look equal only let more pairs through.)

A pair of similarity 0.8 shares no band with probability (1 - 0.8^3)^21, about
3e-7, and is dropped in a comparison with a probability of at most about
``TOLERANCE`` a step; if other pairs still connect the two classes, it is found
all the same, since a component's pairs are all verified.

No pairs are written anywhere.  A large bucket or component is split into
blocks, and tasks compare two blocks at a time; they return, for each class,
the number of its links and one edge of a spanning forest.

Edge cases: texts of one to four words have one shingle of all their words;
texts without words (null and empty ones too) have none and are classes by
equal text, linked to nothing; a null ``doc_id`` comes after all others; rows
with equal ids are still separate documents.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructType

from .arrowmap import add_struct, fresh, small_batches, whole_groups
from .components import components, written
from .textbatch import mix64, windows, words_of

SHINGLE = 5
BANDS, ROWS = 21, 3
HASHES = BANDS * ROWS
TOLERANCE = 1e-6
#: MinHash values compared in one step.
STEP = 9
#: Classes of a bucket's block, classes and bytes of text of a component's block; two blocks are compared at a time.
BUCKET, BLOCK, BLOCK_BYTES = 2048, 256, 4 << 20
#: Similarity as a fraction: 0.8.
NUMERATOR, DENOMINATOR = 4, 5

_FACTORS = (mix64(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1))
_SALT = np.uint64(0xD6E8FEB86659FD93)

KIND = (StructType().add("key", BinaryType()).add("n", LongType()).add("bytes", LongType())
        .add("values", BinaryType()).add("short", BinaryType()))


def posterior(matches: int, of: int, threshold: float = NUMERATOR / DENOMINATOR) -> float:
    """P(similarity >= threshold | matches of so many values), uniform prior:
    a binomial tail, since the posterior is a Beta distribution."""
    n = of + 1
    return math.fsum(math.comb(n, k) * threshold ** k * (1 - threshold) ** (n - k) for k in range(matches + 1))


#: Values seen so far, and the matches below which a pair is dropped.
CHECKS = [(of, next(m for m in range(of + 1) if posterior(m, of) >= TOLERANCE))
          for of in range(STEP, HASHES + 1, STEP)]


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    hashes, slot = windows(words_of(column), SHINGLE)
    return [np.unique(hashes[a:b]) for a, b in zip(slot[:-1].tolist(), slot[1:].tolist(), strict=True)]


def _sketch(column: pa.Array, values: bool) -> pa.StructArray:
    sets = shingle_sets(column)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    texts = column.cast(pa.binary())
    key: list[bytes] = []
    for i, s in enumerate(sets):
        if len(s):
            pair = mix64(s).sum(dtype=np.uint64), mix64(s ^ _SALT).sum(dtype=np.uint64)
            key.append(np.array(pair, dtype="<u8").tobytes())
        else:
            key.append(hashlib.blake2b(texts[i].as_py() or b"", digest_size=16, key=b"wordless").digest())
    sketch: list[bytes | None] = [None] * len(sets)
    short: list[bytes | None] = [None] * len(sets)
    some = np.flatnonzero(size)
    if values and len(some):
        every, begin = np.concatenate(sets), np.concatenate([[0], np.cumsum(size[some])[:-1]])
        least = np.empty((len(some), HASHES), dtype="<u4")
        for i, factor in enumerate(_FACTORS):
            least[:, i] = np.minimum.reduceat(((every * factor) >> np.uint64(32)).astype(np.uint32), begin)
        for r, i in enumerate(some.tolist()):
            sketch[i], short[i] = least[r].tobytes(), least[r].astype(np.uint8).tobytes()
    return pa.StructArray.from_arrays(
        [pa.array(key, pa.binary()), pa.array(size), pa.array([len(t.as_py() or b"") for t in texts], pa.int64()),
         pa.array(sketch, pa.binary()), pa.array(short, pa.binary())], names=KIND.names)


def sketched(docs: DataFrame, text_col: str, keep: list[str], name: str, values: bool) -> DataFrame:
    def compute(batches):
        for batch in batches:
            yield batch, _sketch(batch.column(0), values)

    return add_struct(docs, [text_col], keep, name, KIND, compute)


# -- buckets -------------------------------------------------------------

def _forest(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index of each node's component, when edges join those of ``label``."""
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new][label]
        if np.array_equal(new, label):
            return label
        label = new


def _survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a spanning forest of the pairs that no comparison drops, bucket by bucket.

    Rows come sorted by key within a bucket, so that buckets with the same
    classes give the same edges.
    """
    for table in whole_groups(batches, ["bucket", "i", "j"], 20_000):
        bucket, i, j, block = (table.column(c).to_numpy() for c in ("bucket", "i", "j", "block"))
        change = (bucket[1:] != bucket[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        group = np.concatenate([[0], np.cumsum(change)])
        size = np.bincount(group)[group]
        values = np.frombuffer(b"".join(table.column("short").to_pylist()), dtype=np.uint8).reshape(-1, HASHES)
        label = np.arange(len(group))
        for shift in range(1, int(size.max(initial=0))):
            a = np.flatnonzero(size[:-shift] > shift)
            a = a[group[a] == group[a + shift]]
            a = a[(i[a] == j[a]) | (block[a] != block[a + shift])]
            a = a[label[a] != label[a + shift]]          # others are connected by now
            b, seen = a + shift, np.zeros(len(a), np.int64)
            for of, need in CHECKS:
                seen += (values[a, of - STEP:of] == values[b, of - STEP:of]).sum(axis=1)
                stay = seen >= need
                a, b, seen = a[stay], b[stay], seen[stay]
            if len(a):
                label = _forest(label, a, b)
        node = np.flatnonzero(label != np.arange(len(label)))
        if len(node):
            keys = table.column("key").combine_chunks()
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(node)), keys.take(pa.array(label[node]))],
                                             names=["a", "b"])


def _blocked(df: DataFrame, blocks: str, node: str) -> DataFrame:
    """Rows with ``block`` and, for each pair of blocks that the row takes part in, ``i`` <= ``j``."""
    df = df.withColumn("block", F.pmod(F.xxhash64(node), F.col(blocks)).cast("int"))
    other = F.explode(F.sequence(F.lit(0), (F.col(blocks) - 1).cast("int")))
    return (df.withColumn("other", other)
            .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
            .drop("other", blocks))


def candidate_edges(classes: DataFrame) -> DataFrame:
    """Edges (a, b) between keys; their components hold every pair that survives the comparisons."""
    small_batches(classes)
    band = F.explode(F.array(*[F.xxhash64(F.lit(b), F.substring("values", 4 * ROWS * b + 1, 4 * ROWS))
                               for b in range(BANDS)])).alias("bucket")
    bands = classes.where("n > 0").select("key", band)
    shared = (bands.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
              .select("bucket", F.ceil(F.col("size") / BUCKET).alias("blocks")))
    met = bands.join(shared, "bucket").join(classes.select("key", "short"), "key")
    return (_blocked(met, "blocks", "key").select("bucket", "i", "j", "block", "key", "short")
            .repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "key")
            .mapInArrow(_survivors, "a binary, b binary"))


# -- exact verification --------------------------------------------------

def _similar(sets: list[np.ndarray], block: np.ndarray, cross: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets at or above the threshold, between blocks only if ``cross``."""
    n = len(sets)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    value, member = np.concatenate(sets), np.repeat(np.arange(n), size)
    order = np.argsort(value, kind="stable")
    value, member = value[order], member[order]
    new = np.concatenate([[True], value[1:] != value[:-1]])
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    column, member = column[shared], member[shared]
    both = np.zeros((n, n), dtype=np.int64)
    if len(column):
        column = np.unique(column, return_inverse=True)[1]
        width = max(1, 4_000_000 // n)
        edges = np.searchsorted(column, np.arange(0, column[-1] + 1 + width, width))
        for a, b in zip(edges[:-1], edges[1:]):
            if b > a:
                part = np.zeros((n, width), dtype=np.float32)
                part[member[a:b], column[a:b] % width] = 1
                both += (part @ part.T).astype(np.int64)
    total = size[:, None] + size[None, :]
    near = np.triu((NUMERATOR + DENOMINATOR) * both >= NUMERATOR * total, 1)
    if cross:
        near &= block[:, None] != block[None, :]
    return np.nonzero(near)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, links) per class of a group: its links in these blocks and an edge of a spanning forest."""
    for table in whole_groups(batches, ["component", "i", "j"]):
        parts = [table.column(c).to_pylist() for c in ("component", "i", "j")]
        every = list(zip(*parts, strict=True))
        ends = [0, *[k for k in range(1, len(every)) if every[k] != every[k - 1]], len(every)]
        for lo, hi in zip(ends[:-1], ends[1:]):
            part = table.slice(lo, hi - lo)
            keys = part.column("key").to_pylist()
            one = sorted({k: r for r, k in enumerate(keys)}.values())   # rows that repeat a class add nothing
            if len(one) < 2:
                continue
            texts = part.column("text").combine_chunks().take(pa.array(one))
            block = part.column("block").to_numpy()[one]
            a, b = _similar(shingle_sets(texts), block, every[lo][1] != every[lo][2])
            if not len(a):
                continue
            links = np.bincount(a, minlength=len(one)) + np.bincount(b, minlength=len(one))
            label = _forest(np.arange(len(one)), a, b)
            node = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[one[x]] for x in node], pa.binary()),
                 pa.array([keys[one[x]] for x in label[node]], pa.binary()), pa.array(links[node])],
                names=["a", "b", "links"])


def join(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, classes).

    documents: id, key.  classes: key, class_id (least id), n_copies, n_links
    (other classes at or above the threshold), group_id (least id of all
    documents that links connect).
    """
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    sketch = written(sketched(source, "text", ["id"], "s", True).select("id", "s.*"), "sketch")
    classes = written(sketch.groupBy("key").agg(
        F.min("id").alias("class_id"), F.count("*").alias("n_copies"), F.first("n").alias("n"),
        F.max("bytes").alias("bytes"), F.first("values").alias("values"), F.first("short").alias("short")), "classes")
    found = components(candidate_edges(classes))
    sizes = found.join(classes.select(F.col("key").alias("node"), "bytes"), "node").groupBy("component").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("bytes") / BLOCK_BYTES)).alias("blocks"))
    members = (found.withColumnRenamed("node", "key").join(sizes, "component")
               .join(classes.select("key", "class_id"), "key"))
    # Every document's own id is part of the join key, so many copies of one text are spread out.
    keyed = sketched(source, "text", ["id", "text"], "s", False).select("id", "text", F.col("s.key").alias("key"))
    m = members.select(F.col("key").alias("mkey"), F.col("class_id"), "component", "blocks")
    texts = (keyed.join(m, (F.col("key") == F.col("mkey")) & F.col("id").eqNullSafe(F.col("class_id")))
             .select("component", "blocks", "key", "text"))
    verified = written(
        _blocked(texts, "blocks", "key").select("component", "i", "j", "block", "key", "text")
        .repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")
        .mapInArrow(_verified, "a binary, b binary, links long"), "verified")
    groups = components(verified.select("a", "b"))
    links = verified.groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("n_links"))
    plain = classes.select("key", "class_id", "n_copies")
    labelled = plain.join(groups.withColumnRenamed("node", "key"), "key")
    least = labelled.groupBy("component").agg(F.min("class_id").alias("group_id"))
    linked = written(labelled.join(least, "component").join(links, "key")
                     .select("key", "n_links", "group_id", F.col("component").alias("group_key")), "linked")
    full = (plain.join(linked, "key", "left")
            .select("key", "class_id", "n_copies", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("group_id", "class_id").alias("group_id"),
                    F.coalesce("group_key", "key").alias("group_key")))
    return sketch.select("id", "key"), full


def documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, class_id, n_copies, n_links, group_id."""
    rows, classes = join(docs, id_col=id_col, text_col=text_col)
    return rows.join(classes, "key").select(F.col("id").alias(id_col), "class_id", "n_copies", "n_links", "group_id")


def clean(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group, the one with the least id (one row if that id repeats)."""
    _, classes = join(docs, id_col=id_col, text_col=text_col)
    # The class that keeps a document: least id of its group, of equal ids the least key.
    chosen = (classes.groupBy("group_key").agg(F.min_by("key", F.struct(F.col("class_id").isNull(), "class_id", "key")).alias("ckey"),
                                               F.min("class_id").alias("cid")).drop("group_key"))
    name = fresh("sketch", docs.columns)
    keyed = sketched(docs, text_col, docs.columns, name, False)
    kept = keyed.join(chosen, (F.col(f"{name}.key") == F.col("ckey")) & F.col(f"`{id_col}`").eqNullSafe(F.col("cid")))
    return kept.dropDuplicates(["ckey"]).select(*[F.col(f"`{c}`") for c in docs.columns])
