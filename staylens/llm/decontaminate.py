"""Benchmark decontamination with an FM-index over each shard of documents.

A shard is a stretch of one input partition (about ``SHARD_BYTES`` of text).
Its words become symbols of the benchmark's vocabulary; every other word cuts
the sequence, and runs shorter than the shortest window are left out, since no
window can occur there.  Over the remaining runs the task builds a suffix
array, its Burrows-Wheeler transform as a wavelet matrix, and sampled suffix
positions.  All benchmark windows are searched backward together, one symbol a
step, by two wavelet ranks each; their rows are walked to the next sampled
position, and the places found are merged into removal spans.

The benchmark goes to the tasks in blocks of at most ``BLOCK_BYTES`` of text,
one broadcast each, so neither the driver nor a task holds more than a block.
Documents are read once and never shuffled: each task answers for its own.

Edge cases: a null or wordless text has no words, no hits and is clean; a null
or wordless item has no window; an item that is repeated counts once by its
id; repeated documents each get their own row; an empty benchmark leaves every
document clean.  Other columns of ``docs`` are kept as they are.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructType

from .arrowmap import Shared, add_struct, fresh
from .textbatch import words_of

WINDOW = 13
#: A document is contaminated if hit words are at least one in SHARE.
SHARE = 20
#: Text of one FM-index, and benchmark text of one broadcast.
SHARD_BYTES = 16 << 20
BLOCK_BYTES = 16 << 20
#: Every so many positions of a run, the suffix array's value is kept.
SAMPLE = 16

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_UPPER = {c: c + 32 for c in range(65, 91)}

KIND = (StructType().add("n_words", LongType()).add("n_hit", LongType()).add("n_items", LongType())
        .add("items_sha256", StringType()).add("contaminated", BooleanType())
        .add("spans", ArrayType(StructType().add("first_word", LongType()).add("end_word", LongType()))))
_SPAN = pa.struct([("first_word", pa.int64()), ("end_word", pa.int64())])


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(_UPPER))


class Bits:
    """A bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        self.packed = np.zeros(len(bits) // 64 + 1, dtype=np.uint64)
        packed = np.packbits(bits, bitorder="little")
        self.packed.view(np.uint8)[:len(packed)] = packed
        ones = np.bitwise_count(self.packed).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word, bit = i >> 6, (i & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(
            self.packed[word] & ((np.uint64(1) << bit) - np.uint64(1)))

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.packed[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)


class Wavelet:
    """Wavelet matrix of small integers: access and rank by one plane a bit."""

    def __init__(self, values: np.ndarray, top: int):
        self.planes: list[tuple[int, Bits, int]] = []
        for shift in range(max(1, int(top).bit_length()) - 1, -1, -1):
            bit = (values >> shift) & 1 == 1
            self.planes.append((shift, Bits(bit), int(len(values) - bit.sum())))
            values = np.concatenate([values[~bit], values[bit]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``c`` before position ``i``."""
        begin = np.zeros_like(i)
        for shift, bits, zeros in self.planes:
            one = (c >> shift) & 1 == 1
            ri, rb = bits.rank(i), bits.rank(begin)
            i = np.where(one, zeros + ri, i - ri)
            begin = np.where(one, zeros + rb, begin - rb)
        return i - begin

    def access(self, i: np.ndarray) -> np.ndarray:
        c = np.zeros_like(i)
        for shift, bits, zeros in self.planes:
            one, r = bits.get(i) == 1, bits.rank(i)
            c |= one.astype(np.int64) << shift
            i = np.where(one, zeros + r, i - r)
        return c


def suffix_array(keys: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling; only suffixes still tied are sorted again."""
    n = len(keys)
    sa = np.argsort(keys, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    head = np.concatenate([[True], keys[sa][1:] != keys[sa][:-1]])
    start = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank[sa] = start
    step = 1
    while True:
        tied = ~head
        tied[:-1] |= ~head[1:]
        slots = np.flatnonzero(tied)
        if not len(slots):
            return sa
        who = sa[slots]
        after = np.where(who + step < n, rank[np.minimum(who + step, n - 1)], -1)
        order = np.lexsort((after, rank[who]))
        who, after, group = who[order], after[order], rank[who][order]
        sa[slots] = who
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (after[1:] != after[:-1])])
        head[slots] = new
        rank[who] = np.maximum.accumulate(np.where(new, slots, 0))
        step *= 2


class FMIndex:
    """Searches phrases of symbols above 0 in runs of such symbols."""

    def __init__(self, symbols: np.ndarray, run: np.ndarray, top: int):
        """``symbols``: all runs one after another; ``run``: the number of each symbol's run."""
        runs = int(run[-1]) + 1
        at = np.arange(len(symbols)) + run + 1           # a mark of value 0 stands before each run
        text = np.zeros(len(symbols) + runs + 1, dtype=np.int64)
        text[at] = symbols
        marks = np.flatnonzero(text == 0)
        keys = text + len(marks)
        keys[marks] = np.arange(len(marks))              # each mark is smaller than any symbol, and unique
        sa = suffix_array(keys)
        self.wavelet = Wavelet(text[sa - 1], top)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        self.size = len(text)
        first = marks[:-1][run] + 1
        sampled = np.zeros(len(text), dtype=bool)
        sampled[at[(at - first) % SAMPLE == 0]] = True   # so the first symbol of each run is sampled
        self.sampled = Bits(sampled[sa])
        self.position = sa[sampled[sa]]
        self.place = np.full(len(text), -1, dtype=np.int64)
        self.place[at] = np.arange(len(symbols))

    def search(self, phrases: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, index of its first symbol in ``symbols``) of every occurrence."""
        live = np.arange(len(phrases))
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        for k in range(int(length.max(initial=0))):
            work = live[length[live] > k]
            c = phrases[work, length[work] - 1 - k]
            lo[work] = self.smaller[c] + self.wavelet.rank(c, lo[work])
            hi[work] = self.smaller[c] + self.wavelet.rank(c, hi[work])
            live = live[hi[live] > lo[live]]
            if not len(live):
                break
        count = hi[live] - lo[live]
        phrase = np.repeat(live, count)
        row = np.repeat(lo[live] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        found = np.zeros(len(row), dtype=np.int64)
        walk, walked = np.arange(len(row)), 0
        while len(walk):
            here = row[walk]
            done = self.sampled.get(here) == 1
            found[walk[done]] = self.position[self.sampled.rank(here[done])] + walked
            walk, here = walk[~done], here[~done]
            c = self.wavelet.access(here)
            row[walk] = self.smaller[c] + self.wavelet.rank(c, here)
            walked += 1
        return phrase, self.place[found]


class Phrases:
    """The windows of a block of benchmark items, as symbols of their vocabulary."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        owners: dict[tuple[str, ...], set[str]] = {}
        for item, text in items:
            w = words(text)
            for i in range(max(1, len(w) - window + 1) if w else 0):
                owners.setdefault(tuple(w[i:i + window]), set()).add(item)
        vocabulary = sorted({x for phrase in owners for x in phrase})
        symbol = {x: i + 1 for i, x in enumerate(vocabulary)}
        self.top = len(vocabulary)
        self.owners = [sorted(x) for x in owners.values()]
        self.length = np.array([len(p) for p in owners], dtype=np.int64)
        self.symbols = np.zeros((len(owners), window), dtype=np.int64)
        for i, phrase in enumerate(owners):
            self.symbols[i, :len(phrase)] = [symbol[x] for x in phrase]
        hashes = words_of(pa.array([" ".join(vocabulary)])).hash
        order = np.argsort(hashes)
        self.hashes, self.of_hash = hashes[order], (order + 1).astype(np.int64)
        # Low 16 bits that occur: most words of a text end here.
        self.low = np.zeros(1 << 16, dtype=bool)
        self.low[(hashes & np.uint64(0xFFFF)).astype(np.int64)] = True

    def read(self, hashes: np.ndarray) -> np.ndarray:
        """The symbol of each word, 0 outside the vocabulary."""
        out = np.zeros(len(hashes), dtype=np.int64)
        maybe = np.flatnonzero(self.low[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        if len(maybe) and self.top:
            at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), self.top - 1)
            same = self.hashes[at] == hashes[maybe]
            out[maybe[same]] = self.of_hash[at[same]]
        return out

    def find(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, first word) of every occurrence within a row; ``first``: each row's first word."""
        none = np.zeros(0, np.int64)
        if not len(self.owners) or not len(hashes):
            return none, none
        symbols = self.read(hashes)
        known = symbols > 0
        opens = known.copy()
        opens[1:] &= ~known[:-1]
        rows = first[:-1][first[:-1] < len(hashes)]
        opens[rows] = known[rows]
        begin = np.flatnonzero(opens)
        if not len(begin):
            return none, none
        run = np.cumsum(opens) - 1
        size = np.bincount(run[known], minlength=len(begin))
        long = size >= self.length.min()
        stay = np.flatnonzero(known)
        stay = stay[long[run[stay]]]
        if not len(stay):
            return none, none
        number = np.cumsum(long) - 1
        index = FMIndex(symbols[stay], number[run[stay]], self.top)
        phrase, at = index.search(self.symbols, self.length)
        return phrase, stay[at]


def _report(shard: list[pa.RecordBatch], column: int, blocks) -> Iterator[tuple[pa.RecordBatch, pa.StructArray]]:
    parts = [words_of(b.column(column)) for b in shard]
    hashes = np.concatenate([p.hash for p in parts])
    shift = np.concatenate([[0], np.cumsum([len(p.hash) for p in parts])])
    first = np.concatenate([*[p.first[:-1] + s for p, s in zip(parts, shift[:-1])], shift[-1:]])
    n_rows = len(first) - 1
    edge = np.zeros(len(hashes) + 1, dtype=np.int64)
    items: dict[int, set[str]] = {}
    for block in blocks:
        phrases: Phrases = block.value
        phrase, at = phrases.find(hashes, first)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + phrases.length[phrase], -1)
        row = np.searchsorted(first, at, side="right") - 1
        for r, p in np.unique(np.stack([row, phrase]), axis=1).T.tolist():
            items.setdefault(r, set()).update(phrases.owners[p])
    hit = np.cumsum(edge[:-1]) > 0
    total = np.concatenate([[0], np.cumsum(hit)])
    n_words, n_hit = np.diff(first), total[first[1:]] - total[first[:-1]]
    nothing = hashlib.sha256(b"").hexdigest()
    digest, counts, spans = [nothing] * n_rows, np.zeros(n_rows, np.int64), [[] for _ in range(n_rows)]
    for r, found in items.items():
        digest[r] = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        counts[r] = len(found)
        own = np.concatenate([[False], hit[first[r]:first[r + 1]], [False]])
        turn = np.flatnonzero(own[1:] != own[:-1])
        spans[r] = [{"first_word": a, "end_word": b} for a, b in turn.reshape(-1, 2).tolist()]
    made = pa.StructArray.from_arrays(
        [pa.array(n_words), pa.array(n_hit), pa.array(counts), pa.array(digest, pa.string()),
         pa.array((n_hit > 0) & (SHARE * n_hit >= n_words)), pa.array(spans, pa.list_(_SPAN))],
        names=KIND.names)
    at = 0
    for b in shard:
        yield b, made.slice(at, b.num_rows)
        at += b.num_rows


def blocks_of(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW):
    """The benchmark's windows as broadcasts of at most about ``BLOCK_BYTES`` of text each."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("")).alias("item"),
                            F.col(f"`{text_col}`").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / BLOCK_BYTES))
    out = []
    for k in range(n):
        block = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item"), F.lit(n)) == k)
        out.append(Shared(spark, Phrases([tuple(r) for r in block.collect()], window)))
    return out


def annotate(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", keep: list[str] | None = None,
             name: str = "contamination", window: int = WINDOW) -> DataFrame:
    """``keep`` columns (all by default) and a struct: n_words, n_hit, n_items, items_sha256,
    contaminated, and the merged spans of hit words (end exclusive)."""
    blocks = blocks_of(benchmark, window=window)

    def compute(batches):
        shard, size = [], 0
        for batch in batches:
            shard.append(batch)
            size += batch.nbytes
            if size >= SHARD_BYTES:
                yield from _report(shard, 0, blocks)
                shard, size = [], 0
        if shard:
            yield from _report(shard, 0, blocks)

    return add_struct(docs, [text_col], docs.columns if keep is None else keep, name, KIND, compute)


def clean(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` without contaminated documents; the others keep rows and columns."""
    name = fresh("contamination", docs.columns)
    marked = annotate(docs, benchmark, text_col=text_col, name=name)
    return marked.where(~F.col(f"{name}.contaminated")).select(*[F.col(f"`{c}`") for c in docs.columns])
