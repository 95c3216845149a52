"""Conversation prefix trie: which conversations share their first turns, and what sharing saves.

A conversation is the sequence of its turns' digests (128 bits of role and
text).  Each distinct sequence of first turns is a node of the trie; its members
are the conversations that start with it.

The conversations are dealt into shards by ranges of (sequence, id).  The
splitters between the shards are quantiles of a bounded sample; their sequences
form a small trie, the skeleton, which is broadcast.  A node that has members in
two shards is a prefix of the splitter between them, so every node outside the
skeleton lies in one shard whole: a task reads its shard in order, holds the
path it is on, and finishes these nodes as it leaves them.  For skeleton nodes
every shard gives partial sums, which are reduced by node and added up along the
skeleton.

Bounds: the sample of sequences that reaches the driver is at most ``SAMPLE``
bytes, whatever the corpus (long sequences make for fewer shards); so is the
skeleton.  A task holds its path and the finished children of the nodes on it,
at most its shard.  A conversation shared by very many ids is spread over
shards, as ids are part of the range.  The digest of the ids that end at a
skeleton node is one stream in id order, as a digest has to be, but none of them
are held.  A conversation's sequence is one value (20 bytes a turn).

Edge cases: null roles and texts are empty; turns go by number, null first, and
equal numbers by digest; repeated rows are turns of their own; rows without a
conversation id belong to no conversation and are left out; a table without
conversations has no nodes, not even a root; other columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stored import stored

#: Bytes of a turn's digest.
WIDTH = 16
#: Turns of a shard, sampled sequences of a shard, and bytes of the whole sample at most.
SHARD_TURNS, SAMPLED, SAMPLE = 20_000, 8, 64 << 20
#: Rows of a batch that a task hands on.
ROWS = 20_000
#: A word of a turn's text.
WORD = r"[^\x20\x09-\x0D]+"
#: Contract of the query: conversations share their first turns with the one at the start of their block of ids.
BLOCK, UP_TO = 20, 4


def paths(rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role",
          text: str = "text") -> DataFrame:
    """(c, turns): each conversation's turns in order, as structs with their digest and number of words."""
    own = [F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role, text)]
    digest = F.md5(F.concat(F.length(own[0]).cast("string"), F.lit(":"), *own))
    turns = rows.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").alias("c"), F.struct(
            F.col(f"`{turn}`").alias("turn"), F.unhex(digest).alias("digest"),
            F.regexp_count(own[1], F.lit(WORD)).alias("words")).alias("t"))
    return turns.groupBy("c").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(made: DataFrame) -> DataFrame:
    """``paths`` where conversation c starts with the first crc32(c) % 4 turns of c - c % 20, then goes on with its own."""
    base = F.col("c") - F.col("c") % BLOCK
    start = F.max(F.when(F.col("c") == base, F.slice("turns", 1, UP_TO - 1))).over(Window.partitionBy(base))
    shared = (F.crc32(F.col("c").cast("string").cast("binary")) % UP_TO).cast("int")
    none = F.slice("turns", 1, F.lit(0))
    return made.select("c", "turns", F.coalesce(start, none).alias("start"), shared.alias("h")).select(
        "c", F.concat(F.slice("start", 1, F.col("h")), F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


class Skeleton:
    """Trie of the splitters' sequences; node 0 is the root, and parents come before their children."""

    def __init__(self, splitters: list[bytes]):
        self.child: dict[tuple[int, bytes], int] = {}
        self.parent, self.depth = [-1], [0]
        for path in splitters:
            at = 0
            for i in range(0, len(path), WIDTH):
                step = (at, path[i:i + WIDTH])
                if step not in self.child:
                    self.child[step] = len(self.parent)
                    self.parent.append(at)
                    self.depth.append(self.depth[at] + 1)
                at = self.child[step]


def separators(sample: list[tuple[bytes, int]], shards: int) -> list[tuple[bytes, int]]:
    """Quantiles of the sorted sample, without repeats."""
    sample = sorted(sample)
    return sorted({sample[len(sample) * k // shards] for k in range(1, shards)}) if sample else []


OUT = "kind byte, conv long, depth int, parent_conv long, node int, n long, children long, leaves long, saved long, ends string"
NODE, PARTIAL, END = 0, 1, 2
_TYPES = [pa.int8(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.string()]
_NAMES = [x.split()[0] for x in OUT.split(", ")]


class _Open:
    """A node on the path that a task is on."""

    __slots__ = ("depth", "node", "words", "conv", "n", "children", "leaves", "saved", "ends", "below")

    def __init__(self, depth: int, node: int | None, words: int):
        self.depth, self.node, self.words = depth, node, words
        self.conv, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends, self.below = None, []        # digest of the ids that end here; finished children


def shard_nodes(batches: Iterator[pa.RecordBatch], skeleton: Skeleton) -> Iterator[pa.RecordBatch]:
    """Nodes and partial sums of (shard, path, c, words) rows, sorted by these."""
    out: list[tuple] = []
    open_: list[_Open] = []

    def close():
        x = open_.pop()
        if x.node is not None:
            out.append((PARTIAL, x.conv, x.words, None, x.node, x.n, x.children, x.leaves, x.saved, None))
        else:
            x.saved += (x.n - 1) * x.words
            x.leaves += not x.children
        out.extend((NODE, conv, x.depth + 1, x.conv, None, *rest) for conv, *rest in x.below)
        if not open_:
            return
        up = open_[-1]
        up.n += x.n
        up.conv = x.conv if up.conv is None else min(up.conv, x.conv)
        if x.node is None:
            up.children += 1
            up.leaves += x.leaves
            up.saved += x.saved
            ends = (x.ends or hashlib.sha256()).hexdigest()
            if up.node is None:
                up.below.append((x.conv, x.n, x.children, x.leaves, x.saved, ends))
            else:       # the parent's smallest member is known after the reduction
                out.append((NODE, x.conv, x.depth, None, up.node, x.n, x.children, x.leaves, x.saved, ends))

    def flushed():
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TYPES)], names=_NAMES)
        out.clear()

    shard, before = None, b""
    for batch in batches:
        words_of = batch.column(3)
        for r, (own, path, c) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(3)))):
            if own != shard:
                while open_:
                    close()
                open_.append(_Open(0, 0, 0))
                shard, before = own, b""
            same, most = 0, min(len(path), len(before))
            while same < most and path[same:same + WIDTH] == before[same:same + WIDTH]:
                same += WIDTH
            while len(open_) > same // WIDTH + 1:
                close()
            if len(path) > same:
                words = words_of[r].as_py()
                for i in range(same, len(path), WIDTH):
                    up = open_[-1].node
                    node = None if up is None else skeleton.child.get((up, path[i:i + WIDTH]))
                    open_.append(_Open(len(open_), node, words[i // WIDTH]))
            x = open_[-1]
            x.n += 1
            x.conv = c if x.conv is None else min(x.conv, c)
            if x.node is not None:
                out.append((END, c, None, None, x.node, None, None, None, None, None))
            elif x.ends is None:
                x.ends = hashlib.sha256(b"%d" % c)
            else:
                x.ends.update(b",%d" % c)
            before = path
            if len(out) >= ROWS:
                yield from flushed()
    while open_:
        close()
    if out:
        yield from flushed()


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each node's ids from (node, conv) rows sorted by both."""
    def row(node, digest):
        return pa.RecordBatch.from_arrays([pa.array([node], pa.int32()), pa.array([digest.hexdigest()])],
                                          names=["node", "ends"])

    at, digest = None, None
    for batch in batches:
        for node, c in zip(*(batch.column(k).to_pylist() for k in range(2))):
            if node == at:
                digest.update(b",%d" % c)
            else:
                if digest is not None:
                    yield row(at, digest)
                at, digest = node, hashlib.sha256(b"%d" % c)
    if digest is not None:
        yield row(at, digest)


def _skeleton_rows(skeleton: Skeleton, sums: dict[int, tuple]) -> list[tuple]:
    """(node, conv, depth, parent_conv, n, children, leaves, saved) of the skeleton from the shards' reduced sums."""
    size = len(skeleton.parent)
    children, leaves, saved = ([sums[k][i] if k in sums else 0 for k in range(size)] for i in (2, 3, 4))
    for k in range(1, size):
        if k in sums:
            children[skeleton.parent[k]] += 1
    for k in range(size - 1, -1, -1):       # children before their parents
        if k in sums:
            conv, n, *_, words = sums[k]
            leaves[k] += not children[k]
            saved[k] += (n - 1) * words
            if k:
                leaves[skeleton.parent[k]] += leaves[k]
                saved[skeleton.parent[k]] += saved[k]
    return [(k, sums[k][0], skeleton.depth[k], sums[skeleton.parent[k]][0] if k else None, sums[k][1], children[k],
             leaves[k], saved[k]) for k in range(size) if k in sums]


def nodes(made: DataFrame, *, shard_turns: int = SHARD_TURNS, sample_bytes: int = SAMPLE) -> DataFrame:
    """One row per node of the trie of ``paths``: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves and saved_tokens of its subtree, ends_sha256 (ids of the members that end at it)."""
    spark = made.sparkSession
    digests = F.transform("turns", lambda t: F.hex(t["digest"]))
    all_ = stored(made.select("c", F.unhex(F.array_join(digests, "")).alias("path"),
                              F.transform("turns", lambda t: t["words"]).alias("words")), "paths")
    size = all_.agg(F.coalesce(F.sum(F.octet_length("path")), F.lit(0)).alias("bytes"),
                    F.coalesce(F.max(F.octet_length("path")), F.lit(0)).alias("longest")).first()
    most = sample_bytes // (size["longest"] + 64)
    shards = max(1, min(-(-size["bytes"] // (WIDTH * shard_turns)), most // SAMPLED))
    sample = (all_.orderBy(F.xxhash64("c"), "c").select("path", "c").limit(min(shards * SAMPLED, most)).collect()
              if shards > 1 else [])
    splitters = separators([(bytes(r["path"]), r["c"]) for r in sample], shards)
    skeleton = Skeleton([path for path, _ in splitters])
    shared = spark.sparkContext.broadcast((splitters, skeleton.child))

    def deal(batches):
        bounds = shared.value[0]
        for batch in batches:
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            own = pa.array([bisect.bisect_right(bounds, key) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([own, *batch.columns], names=["shard", "path", "c", "words"])

    def finish(batches):
        trie = Skeleton([])
        trie.child = shared.value[1]
        yield from shard_nodes(batches, trie)

    dealt = all_.select("path", "c", "words").mapInArrow(deal, "shard int, path binary, c long, words array<int>")
    ordered = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "path", "c")
    out = stored(ordered.mapInArrow(finish, OUT), "trie-nodes")

    sums = {r["node"]: tuple(r)[1:] for r in out.where(F.col("kind") == PARTIAL).groupBy("node").agg(
        F.min("conv").alias("conv"), F.sum("n").alias("n"), F.sum("children").alias("children"),
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("depth").alias("words")).collect()}
    upper = spark.createDataFrame(_skeleton_rows(skeleton, sums), "node int, conv_id long, depth int, "
                                  "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long")
    ends = (out.where(F.col("kind") == END).select("node", "conv").repartition("node")
            .sortWithinPartitions("node", "conv").mapInArrow(_end_digests, "node int, ends string"))
    upper_nodes = upper.join(ends, "node", "left").select(
        *_columns(), F.coalesce("ends", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
    # One row per skeleton node, so its size is bounded like the sample's.
    above = F.broadcast(upper.select("node", F.col("conv_id").alias("above")))
    lower_nodes = out.where(F.col("kind") == NODE).join(above, "node", "left").select(
        F.col("conv").alias("conv_id"), F.col("depth").cast("long").alias("depth"),
        F.coalesce("parent_conv", "above").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"))
    return upper_nodes.unionByName(lower_nodes)


def _columns() -> list[Column]:
    return [F.col("conv_id"), F.col("depth").cast("long").alias("depth"),
            *map(F.col, ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"))]


def oracle() -> str:
    """The same in DuckDB, with every node's sequence written out."""
    crc = """xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(c AS VARCHAR), ''),
      lambda x: CAST(ascii(x) AS BIGINT))), lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda t, z: xor(t // 2, (t % 2) * 3988292384))), 4294967295)"""
    return rf"""
WITH turn AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  WHERE conv_id IS NOT NULL),
own AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST,
    md5(CAST(length(role) AS VARCHAR) || ':' || role || text)) AS n,
    {{'role': role, 'text': text}} AS s, len(regexp_extract_all(text, '{WORD}')) AS words FROM turn),
conv AS (SELECT c, c - c % {BLOCK} AS base, {crc} % {UP_TO} AS h FROM (SELECT DISTINCT c FROM turn)),
part AS (SELECT conv.c, n, s, words FROM conv JOIN own ON own.c = conv.c AND n > h
  UNION ALL SELECT conv.c, n, s, words FROM conv JOIN own ON own.c = base AND n <= h),
path AS (SELECT c, coalesce(list(s ORDER BY n) FILTER (n IS NOT NULL), []) AS p,
    coalesce(list(words ORDER BY n) FILTER (n IS NOT NULL), []) AS w FROM conv LEFT JOIN part USING (c) GROUP BY c),
node AS (SELECT d, p[1:d] AS key, min(c) AS conv_id, count(*) AS n_convs, any_value(CASE WHEN d > 0 THEN w[d] ELSE 0 END) AS words,
    coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(p) = d), '') AS ends
  FROM path, unnest(range(0, len(p) + 1)) u(d) GROUP BY d, p[1:d]),
kids AS (SELECT key[1:d - 1] AS up, d - 1 AS du, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
full_ AS (SELECT node.*, coalesce(kids.n, 0) AS n_children FROM node LEFT JOIN kids ON du = d AND up = key),
below AS (SELECT key[1:a] AS top, a, sum((n_convs - 1) * words) AS saved, count(*) FILTER (n_children = 0) AS leaves
  FROM full_, unnest(range(0, d + 1)) u(a) GROUP BY ALL)
SELECT x.conv_id, x.d AS depth, y.conv_id AS parent_conv_id, x.n_convs, x.n_children, leaves AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, sha256(x.ends) AS ends_sha256
FROM full_ x JOIN below ON a = x.d AND top = x.key LEFT JOIN node y ON y.d = x.d - 1 AND y.key = x.key[1:x.d - 1]"""
