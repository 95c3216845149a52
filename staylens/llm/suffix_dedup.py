"""Repeated byte strings across documents by prefix-free parsing.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts in
a document with a smaller id; strings are judged on the input.

Parsing.  A rolling hash of ``TRIGGER`` bytes is taken at every position.  A
position is a trigger where its hash is least in some string of ``LENGTH`` bytes
around it, so every such string holds a trigger, and equal strings hold equal
triggers at equal places: documents are parsed into overlapping phrases (a
trigger with what may stand beside it in one string), none of which is a prefix
of another.

Dictionary.  The triggers of a shard of documents travel once, as packed records
dealt out by their hashes: a name (a hash) of the phrase, two short hashes of the
bytes on either side, the id, and the place in the shard.  Equal phrases of a
shard travel once, for the smallest document.  Where the records of a trigger
meet, a phrase that a smaller document has too is settled whole, and its place
goes back to its shard, which knows the documents.  Every repeated string has
half of its free bytes on one side of its trigger, so only phrases that agree
with another one on a side can share a part: the places of these, once, go back
too, and their bytes are read from the texts and compared.

Order.  In each group of phrases the parts right of the trigger's start are
put in suffix order with common prefix lengths, and the parts left of it in
the order of the reversed strings.  A string that begins ``l`` bytes before the
trigger is then a pair of ranks: of the phrases that agree for ``l`` bytes to
the left, and of those that agree for ``LENGTH - l`` to the right.  Both come
from the sorted order, so equal pairs are equal bytes, with no false match.
As only strings of ``LENGTH`` bytes are asked for, the order is cut at that
depth and is never built for the whole corpus in one place.

Groups of a trigger with very many such phrases are split by the bytes next to
it, by the same rule.

Edge cases: a null text is empty and has nothing removed; texts shorter than
``LENGTH`` keep everything; rows with equal ids do not repeat each other; a null
id counts as larger than any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructType

from .arrowmap import add_struct, small_batches, whole_groups
from .components import written
from .textbatch import mix64, text_bytes

LENGTH = 50
TRIGGER = 20
#: Free bytes of a string beside its trigger.
FREE = LENGTH - TRIGGER
#: Free bytes on the left of a trigger from which a string is judged by that side.
HALF = (FREE + 1) // 2
#: Phrases of a trigger to be compared, above which they are dealt out by the bytes beside it.
HOT = 10_000
#: Bytes hashed at a time, and triggers that a task packs together.
STRETCH, SHARD = 1 << 20, 500_000
#: Triggers are dealt out by so many bits of their hashes; the next bytes go on with them.
BUCKET, LOW = 12, 3
#: A null id stands here.
LAST = (1 << 63) - 1

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(7)
_NONE = np.uint64((1 << 64) - 1)


def _slide(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Minimum or maximum of each stretch of ``width`` values."""
    pick, span = np.minimum if least else np.maximum, 1
    while 2 * span <= width:
        x, span = pick(x[:-span], x[span:]), 2 * span
    return pick(x[:len(x) - (width - span)], x[width - span:]) if span < width else x


def _rolled(wide: np.ndarray, n: int) -> np.ndarray:
    """The rolling hash of the ``TRIGGER`` bytes at the first ``n`` places; ``wide``: the 8 bytes from each byte on."""
    return _hash(*(wide[k:n + k] for k in (0, 8, TRIGGER - 8)))


def _hash(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.minimum(mix64(a * _A + mix64(b) + c * _B), _NONE - np.uint64(1))


def triggers(raw: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the triggers of all rows; ``rows``: byte offsets of the rows."""
    n, where, hashes = len(raw), [], []
    strings = FREE + 1                       # strings that can hold a trigger, by where they begin
    for a in range(0, n, STRETCH):
        lo, hi = max(0, a - FREE), min(n, a + STRETCH + LENGTH + FREE)
        part = np.concatenate([raw[lo:hi], np.zeros(LENGTH + 8, np.uint8)])
        m = hi - lo
        wide = np.ndarray(m + TRIGGER, dtype="<u8", strides=(1,), buffer=part)
        h = _rolled(wide, m)
        least = _slide(np.concatenate([h, np.full(strings - 1, _NONE)]), strings, True)
        # A string must end in the row in which it begins: none begins at the last bytes of a row.
        i, j = np.searchsorted(rows, lo, side="right"), np.searchsorted(rows, hi + LENGTH, side="left")
        for end in (rows[i:j + 1] - lo).tolist():
            least[max(0, end - LENGTH + 1):max(0, end)] = 0
        most = _slide(np.concatenate([np.zeros(strings - 1, np.uint64), least]), strings, False)
        begin, stop = a - lo, min(hi, a + STRETCH) - lo
        at = np.flatnonzero(most[begin:stop] == h[begin:stop]) + begin
        where.append(at + lo)
        hashes.append(h[at])
    if not where:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(where), np.concatenate(hashes)


class Occurrences:
    """Triggers of a batch whose texts are column 0, ids column 1 and text hashes column 2: all, or those in the lists of column 3."""

    def __init__(self, batch: pa.RecordBatch):
        raw, rows = text_bytes(batch.column(0))
        if batch.num_columns > 3:
            lists = batch.column(3)
            self.row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            at = lists.flatten().to_numpy().astype(np.int64)
            self.hot = at < 0
            at = np.where(self.hot, ~at, at) + rows[self.row]
        else:
            at, h = triggers(raw, rows)
            self.row = np.searchsorted(rows, at, side="right") - 1
        self.at = at - rows[self.row]
        self.size = np.diff(rows)[self.row]
        self.left, self.right = np.minimum(FREE, self.at), np.minimum(LENGTH, self.size - self.at)
        self.ord = batch.column(1).to_numpy()[self.row]
        self.th = batch.column(2).to_numpy()[self.row]
        # Each text between zeros, so that a phrase can be read beyond its ends.
        gap = LENGTH + FREE
        self.bytes = np.zeros(len(raw) + gap * (len(rows) + 1), np.uint8)
        for r in np.unique(self.row).tolist():
            a = rows[r] + gap * (r + 1)
            self.bytes[a:a + rows[r + 1] - rows[r]] = raw[rows[r]:rows[r + 1]]
        self.place = at + gap * (self.row + 1) - FREE      # where the phrase begins
        wide = self._wide()
        self.h = _hash(*(wide[self.place + FREE + k] for k in (0, 8, TRIGGER - 8))) if batch.num_columns > 3 else h

    def _wide(self) -> np.ndarray:
        return np.ndarray(len(self.bytes) - 7, dtype="<u8", strides=(1,), buffer=self.bytes)

    def names(self) -> np.ndarray:
        """A hash of each trigger's phrase and of how much of it there is."""
        wide = self._wide()
        x = (self.left * 64 + self.right).astype(np.uint64)
        for k in range(0, LENGTH + FREE, 8):
            x = mix64(x * _A + wide[self.place + k])
        return x

    def sides(self) -> np.ndarray:
        """16 bits each of hashes of the bytes that a string has beside the trigger, if ``HALF`` or more are on its left, and if not."""
        wide, x = self._wide(), []
        for a, b in ((FREE - HALF, FREE), (LENGTH, LENGTH + FREE - HALF + 1)):
            x.append(mix64(mix64(wide[self.place + a]) * _A + wide[self.place + b - 8]) >> np.uint64(48))
        return x[0] << np.uint64(16) | x[1]

    def phrases(self) -> np.ndarray:
        return np.lib.stride_tricks.sliding_window_view(self.bytes, LENGTH + FREE)[self.place]

    @property
    def lo(self) -> np.ndarray:
        """The fewest and most bytes that a string can begin before the trigger."""
        return np.maximum(0, LENGTH - self.right)

    @property
    def hi(self) -> np.ndarray:
        return np.minimum(FREE, self.left)


SPANS = "ord long, th long, starts array<int>, ends array<int>"


def _merged(order: np.ndarray, th: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    """Spans of each document, those that overlap or touch as one, as lists."""
    if not len(order):
        return pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int64()),
                                           *[pa.array([], pa.list_(pa.int32()))] * 2], names=["ord", "th", "starts", "ends"])
    sort = np.lexsort((start, th, order))
    order, th, start, end = order[sort], th[sort], start[sort].astype(np.int64), end[sort].astype(np.int64)
    new = np.concatenate([[True], (order[1:] != order[:-1]) | (th[1:] != th[:-1])])
    doc = np.cumsum(new) - 1
    # The farthest end so far within a document: documents are told apart by a step larger than any text.
    reach = np.maximum.accumulate(end + doc * (1 << 40)) - doc * (1 << 40)
    opens = new.copy()
    opens[1:] |= start[1:] > reach[:-1]
    first = np.flatnonzero(opens)
    last = np.concatenate([first[1:] - 1, [len(start) - 1]])
    docs = np.flatnonzero(new)
    ends = np.searchsorted(first, np.concatenate([docs, [len(start)]])).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.int32))) for v in (start[first], reach[last])]
    return pa.RecordBatch.from_arrays([pa.array(order[docs]), pa.array(th[docs]), *lists],
                                      names=["ord", "th", "starts", "ends"])


#: Kinds of packed rows: the documents of a shard, places of triggers whose phrases go whole, those whose phrases are
#: to be compared, those of triggers with very many of them, and, up to the meeting, the triggers of a bucket.
DOCUMENTS, GONE, ASKED, CROWDED, TRIGGERS = range(5)
PACKED = "shard long, kind int, data binary"
PARSED = "bucket int, widths int, least long, " + PACKED


def _trigger(h: np.ndarray) -> np.ndarray:
    """What goes on of a trigger's hash: its bucket and ``LOW`` bytes."""
    return mix64(h) >> np.uint64(64 - BUCKET - 8 * LOW)      # mixed, as a least hash is small


def _bytes_of(x: np.ndarray) -> int:
    """Bytes that the largest of some values takes."""
    return max(1, -(-int(x.max()).bit_length() // 8)) if len(x) else 1


def _records(columns: list[np.ndarray], widths: list[int]) -> np.ndarray:
    """[rows x bytes] of the low bytes of unsigned columns."""
    out = np.empty((len(columns[0]), sum(widths)), np.uint8)
    a = 0
    for x, w in zip(columns, widths, strict=True):
        out[:, a:a + w] = np.ascontiguousarray(x, "<u8").view(np.uint8).reshape(-1, 8)[:, :w]
        a += w
    return out


def _columns(raw: bytes, widths: list[int]) -> list[np.ndarray]:
    """The columns of packed records."""
    rows = np.frombuffer(raw, np.uint8).reshape(-1, sum(widths))
    out, a = [], 0
    for w in widths:
        x = np.zeros((len(rows), 8), np.uint8)
        x[:, :w] = rows[:, a:a + w]
        out.append(x.view("<u8").ravel())
        a += w
    return out


def _slices(raw: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Stretches of bytes, one after another, as values."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(raw.tobytes())])


def _sorted(h: np.ndarray, name: np.ndarray, order: np.ndarray, alone: bool) -> np.ndarray:
    """Rows by ``h``, those of equal ``h`` by name and id; without rows whose ``h`` no other has, unless ``alone``."""
    sort = np.argsort(h)
    same = h[sort[1:]] == h[sort[:-1]]
    many = np.zeros(len(h), bool)
    many[1:] |= same
    many[:-1] |= same
    some = sort[many]
    some = some[np.lexsort((order[some], name[some], h[some]))]
    if not alone:
        return some
    sort[many] = some
    return sort


def _opens(*columns: np.ndarray) -> np.ndarray:
    """Whether a row of sorted columns is the first of its group."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = False
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Triggers of each shard by bucket, equal phrases once for the smallest document, and the places of the others.

    A shard is told by its documents, so that a task run again names it alike.
    """
    held: list[tuple[np.ndarray, ...]] = []
    docs: list[tuple[np.ndarray, ...]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        h, name, sides, order, place = (np.concatenate(c) for c in zip(*held, strict=True))
        about = [np.concatenate(c).astype(np.int64) for c in zip(*docs, strict=True)]
        held.clear()
        docs.clear()
        table = np.ascontiguousarray(np.array(about, "<i8").T).tobytes()
        shard = int.from_bytes(hashlib.blake2b(table, digest_size=8).digest(), "little", signed=True)
        sort = _sorted(h, name, order, True)
        h, name, sides, order, place = (c[sort] for c in (h, name, sides, order, place))
        first = np.maximum.accumulate(np.where(_opens(h, name), np.arange(len(h)), 0))
        later = order > order[first]
        fixed = [shard % (1 << BUCKET), 0, 0, shard]
        gone = place[later].astype("<u4").tobytes()
        for kind, data in ((DOCUMENTS, table), (GONE, gone)):
            if data:
                yield pa.RecordBatch.from_pylist([dict(zip(_NAMES, [*fixed, kind, data], strict=True))], _SCHEMA)
        h, name, sides, order, place = (c[~later] for c in (h, name, sides, order, place))
        least = int(order.min())
        order = order.view(np.uint64) - np.uint64(least % (1 << 64))
        widths = [_bytes_of(place), _bytes_of(order)]
        records = _records([h, name, sides, place, order], [LOW, 8, 4, *widths])
        bucket = (h >> np.uint64(8 * LOW)).astype(np.int32)
        begin = np.flatnonzero(_opens(bucket))
        n = len(begin)
        made = pa.RecordBatch.from_arrays(
            [pa.array(bucket[begin]), pa.array(np.full(n, widths[0] * 16 + widths[1], np.int32)), pa.array(np.full(n, least)),
             pa.array(np.full(n, shard)), pa.array(np.full(n, TRIGGERS, np.int32)),
             _slices(records, np.append(begin, len(h)) * records.shape[1])], schema=_SCHEMA)
        yield from pa.Table.from_batches([made]).to_batches(2000)

    size = begun = 0
    for batch in batches:
        found = Occurrences(batch)
        if len(found.h):
            one = np.flatnonzero(_opens(found.row))
            sizes = found.size[one]
            starts = begun + np.cumsum(sizes) - sizes
            place = starts[np.searchsorted(found.row[one], found.row)] + found.at
            held.append((_trigger(found.h), found.names(), found.sides(), found.ord, place.astype(np.uint64)))
            docs.append((found.ord[one], found.th[one], sizes))
            size, begun = size + len(found.h), begun + int(sizes.sum())
        if size >= SHARD:
            yield from flush()
            size = begun = 0
    if held:
        yield from flush()


_NAMES = [f.split()[0] for f in PARSED.split(", ")]
_SCHEMA = pa.schema(list(zip(_NAMES, [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()], strict=True)))


def _meets(h: np.ndarray, side: np.ndarray, name: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Whether another phrase of a row's trigger has the same side, and there are several documents."""
    out = np.zeros(len(h), bool)
    sort = np.lexsort((side, h))
    if len(sort):
        opens = _opens(h[sort], side[sort])
        begin, group = np.flatnonzero(opens), np.cumsum(opens) - 1
        apart = lambda x: np.minimum.reduceat(x[sort], begin) < np.maximum.reduceat(x[sort], begin)
        out[sort] = (apart(name) & apart(order))[group]
    return out


def _back(kind: int, shard: np.ndarray, place: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Places on their way to their shards."""
    if len(shard):
        sort = np.argsort(shard, kind="stable")
        shard, place = shard[sort], place[sort]
        begin = np.flatnonzero(_opens(shard))
        yield from pa.Table.from_arrays([pa.array(shard[begin]), pa.array(np.full(len(begin), kind, np.int32)),
                                         _slices(place, np.append(begin, len(shard)) * 4)],
                                        names=["shard", "kind", "data"]).to_batches(2000)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is settled by whole phrases and what must be compared, back to the shards.

    Rows come sorted by bucket.
    """
    for table in whole_groups(batches, ["bucket"], 256):
        kind = table.column("kind").to_numpy()
        if (kind != TRIGGERS).any():
            yield from table.filter(pa.array(kind != TRIGGERS)).select(["shard", "kind", "data"]).combine_chunks().to_batches()
        table = table.filter(pa.array(kind == TRIGGERS))
        if not table.num_rows:
            continue
        bucket, shape, least, shard = (table.column(c).to_numpy() for c in ("bucket", "widths", "least", "shard"))
        data = table.column("data").to_pylist()
        parts = []
        for w in np.unique(shape).tolist():
            who = np.flatnonzero(shape == w)
            widths = [LOW, 8, 4, w >> 4, w & 15]
            count = np.array([len(data[i]) for i in who.tolist()]) // sum(widths)
            h, name, sides, place, order = _columns(b"".join([data[i] for i in who.tolist()]), widths)
            row = np.repeat(who, count)
            parts.append((h | bucket[row].astype(np.uint64) << np.uint64(8 * LOW), name, sides, place.astype("<u4"),
                          (order + least[row].view(np.uint64)).view(np.int64), shard[row]))
        del data
        h, name, sides, place, order, shard = (np.concatenate(c) for c in zip(*parts, strict=True))
        del parts
        sort = _sorted(h, name, order, False)
        h, name, sides, place, order, shard = (c[sort] for c in (h, name, sides, place, order, shard))
        if not len(h):
            continue
        first = np.maximum.accumulate(np.where(_opens(h, name), np.arange(len(h)), 0))
        later = order > order[first]
        yield from _back(GONE, shard[later], place[later])
        h, name, sides, place, order, shard = (c[~later] for c in (h, name, sides, place, order, shard))
        begin = np.flatnonzero(_opens(h))
        group = np.cumsum(_opens(h)) - 1
        several = (np.minimum.reduceat(name, begin) < np.maximum.reduceat(name, begin))[group]
        h, name, sides, place, order, shard = (c[several] for c in (h, name, sides, place, order, shard))
        ask = _meets(h, sides >> np.uint64(16), name, order) | _meets(h, sides & np.uint64(0xFFFF), name, order)
        if ask.any():
            _, group, n = np.unique(h[ask], return_inverse=True, return_counts=True)
            crowded = n[group] > HOT
            for kind, who in ((ASKED, ~crowded), (CROWDED, crowded)):
                yield from _back(kind, shard[ask][who], place[ask][who])


SETTLED = SPANS + ", ats array<int>"


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of the phrases that go whole, by document, and the triggers whose phrases are to be compared (of hot ones ``~at``).

    Rows come sorted by shard and kind: its documents, then the places.  Shards of the same documents in the same
    order are one shard: the places mean the same in each.
    """
    lists = pa.list_(pa.int32())
    for table in whole_groups(batches, ["shard"]):
        begin = np.append(np.flatnonzero(_opens(table.column("shard").to_numpy())), table.num_rows).tolist()
        for a, b in zip(begin[:-1], begin[1:]):
            kind, data = table.column("kind")[a:b].to_pylist(), table.column("data")[a:b].to_pylist()
            order, th, size = np.frombuffer(data[0], "<i8").reshape(-1, 3).T
            starts = np.cumsum(size) - size
            found = {}
            for what in (GONE, ASKED, CROWDED):
                place = np.frombuffer(b"".join(d for k, d in zip(kind, data, strict=True) if k == what), "<u4").astype(np.int64)
                row = np.searchsorted(starts, place, side="right") - 1
                found[what] = row, place - starts[row]
            row, at = found[GONE]
            lo = np.maximum(0, LENGTH - np.minimum(LENGTH, size[row] - at))
            made = _merged(order[row], th[row], at - np.minimum(FREE, at), at - lo + LENGTH)
            yield from pa.Table.from_arrays([*made.columns, pa.nulls(made.num_rows, lists)],
                                            names=_SETTLED).to_batches(2000)
            row = np.concatenate([found[ASKED][0], found[CROWDED][0]])
            at = np.concatenate([found[ASKED][1], ~found[CROWDED][1]])
            sort = np.lexsort((at, th[row], order[row]))
            row, at = row[sort], at[sort]
            new = _opens(order[row], th[row], at)
            row, at = row[new], at[new].astype(np.int32)
            if len(row):
                one = np.flatnonzero(_opens(order[row], th[row]))
                ats = pa.ListArray.from_arrays(pa.array(np.append(one, len(row)).astype(np.int32)), pa.array(at))
                yield from pa.Table.from_arrays([pa.array(order[row[one]]), pa.array(th[row[one]]), pa.nulls(len(one), lists),
                                                 pa.nulls(len(one), lists), ats], names=_SETTLED).to_batches(2000)


_SETTLED = [f.split()[0] for f in SETTLED.split(", ")]
PHRASE = "key long, lo int, hi int, ord long, th long, at int, phrase binary"


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the phrases asked for, by trigger; of hot triggers by the bytes on either side."""
    for batch in batches:
        found = Occurrences(batch)
        phrase, warm, lo, hi = found.phrases(), found.hot, found.lo, found.hi
        parts = [(np.flatnonzero(~warm), found.h.view(np.int64), 0, FREE)]
        if warm.any():
            key = np.zeros((2, len(warm)), np.int64)
            for i in np.flatnonzero(warm).tolist():
                x, text = int(found.h.view(np.int64)[i]), phrase[i].tobytes()
                key[0, i] = _side(x, 1, text[FREE - HALF:FREE])
                key[1, i] = _side(x, 2, text[LENGTH:LENGTH + FREE - HALF + 1])
            parts += [(np.flatnonzero(warm), key[0], HALF, FREE), (np.flatnonzero(warm), key[1], 0, HALF - 1)]
        for who, key, a, b in parts:
            who = who[np.maximum(lo[who], a) <= np.minimum(hi[who], b)]
            if not len(who):
                continue
            text = _slices(phrase[who], np.arange(len(who) + 1) * (LENGTH + FREE))
            yield from pa.Table.from_arrays(
                [pa.array(key[who]), pa.array(np.maximum(lo[who], a).astype(np.int32)),
                 pa.array(np.minimum(hi[who], b).astype(np.int32)), pa.array(found.ord[who]), pa.array(found.th[who]),
                 pa.array(found.at[who].astype(np.int32)), text],
                names=[f.split()[0] for f in PHRASE.split(", ")]).to_batches(4000)


def _side(h: int, side: int, text: bytes) -> int:
    digest = hashlib.blake2b(text, digest_size=8, key=bytes([side]) + h.to_bytes(8, "little", signed=True)).digest()
    return int.from_bytes(digest, "little", signed=True)


def _classes(part: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common) of the rows of ``part`` sorted within their groups: ``common`` is how many
    bytes each row shares with the one before it, -1 at the start of a group."""
    words = np.zeros((len(part), -(-part.shape[1] // 8) * 8), dtype=np.uint8)
    words[:, :part.shape[1]] = part
    columns = words.view(">u8").astype(np.uint64)
    order = np.lexsort([*columns.T[::-1], group])
    a = part[order]
    differ = a[1:] != a[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), part.shape[1])
    common[group[order][1:] != group[order][:-1]] = -1
    return order, np.concatenate([[-1], common])


def repeated(group: np.ndarray, phrase: np.ndarray, lo: np.ndarray, hi: np.ndarray, order: np.ndarray) -> np.ndarray:
    """[phrases x (FREE + 1)] whether the string ``l`` bytes before a trigger also occurs in a smaller document."""
    n = len(group)
    out = np.zeros((n, FREE + 1), dtype=bool)
    left, left_common = _classes(phrase[:, :FREE][:, ::-1], group)
    right, right_common = _classes(phrase[:, FREE:], group)
    for l in range(FREE + 1):
        who = np.flatnonzero((lo <= l) & (l <= hi))
        if len(who) < 2:
            continue
        pair = np.empty((2, n), dtype=np.int64)
        pair[0, left] = np.cumsum(left_common < l)
        pair[1, right] = np.cumsum(right_common < LENGTH - l)
        key = pair[0, who] * (n + 1) + pair[1, who]
        sort = np.argsort(key, kind="stable")
        begin = np.flatnonzero(np.concatenate([[True], key[sort][1:] != key[sort][:-1]]))
        least = np.repeat(np.minimum.reduceat(order[who[sort]], begin), np.diff([*begin, len(sort)]))
        out[who[sort], l] = order[who[sort]] > least
    return out


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(ord, th, starts, ends) of what a group removes from each document."""
    for table in whole_groups(batches, ["key"], 20_000):
        key, lo, hi, order, th, at = (table.column(c).to_numpy() for c in ("key", "lo", "hi", "ord", "th", "at"))
        group = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        phrase = np.frombuffer(b"".join(table.column("phrase").to_pylist()), np.uint8).reshape(-1, LENGTH + FREE)
        found = repeated(group, phrase, lo, hi, order)
        edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, a = np.nonzero(edge == 1)
        _, b = np.nonzero(edge == -1)
        made = _merged(order[row], th[row], at[row] - b + 1, at[row] - a + LENGTH)
        if made.num_rows:
            yield made


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(ord, th, starts, ends): byte spans to remove, by id and hash of the text; they may overlap.

    Triggers travel as packed records; the texts of documents with phrases to
    compare are shuffled once.  Nothing is held whole in one place.
    """
    small_batches(docs)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(text.alias("text"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)).alias("ord"),
                       F.xxhash64(text).alias("th"))
    met = written(rows.mapInArrow(_parsed, PARSED).repartition("bucket").sortWithinPartitions("bucket")
                  .mapInArrow(_met, PACKED), "met")
    settled = written(met.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(_settled, SETTLED), "settled")
    asked = (settled.where("ats IS NOT NULL").groupBy("ord", "th")
             .agg(F.array_distinct(F.flatten(F.collect_list("ats"))).alias("ats")))
    phrases = rows.join(asked, ["ord", "th"]).select("text", "ord", "th", "ats").mapInArrow(_phrases, PHRASE)
    compared = written(phrases.repartition("key").sortWithinPartitions("key").mapInArrow(_spans, SPANS), "compared")
    return settled.where("ats IS NULL").drop("ats").union(compared)


KIND = (StructType().add("n_bytes", LongType()).add("n_removed", LongType()).add("n_spans", LongType())
        .add("kept_sha256", StringType()).add("kept", BinaryType()))


def _cut(batch: pa.RecordBatch) -> pa.StructArray:
    rows = []
    for text, starts, ends in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
        raw = (text or "").encode()
        cover = np.zeros(len(raw) + 1, dtype=np.int32)
        np.add.at(cover, np.array(starts or [], dtype=np.int64), 1)
        np.add.at(cover, np.array(ends or [], dtype=np.int64), -1)
        gone = np.cumsum(cover)[:-1] > 0
        kept = raw if not starts else np.frombuffer(raw, np.uint8)[~gone].tobytes()
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        rows.append((len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), kept))
    columns = list(zip(*rows, strict=True)) or [()] * 5
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=KIND.names)


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None,
                name: str = "dedup") -> DataFrame:
    """``keep`` columns (all by default) and a struct: n_bytes, n_removed, n_spans, kept_sha256, kept
    (the remaining bytes; a removal may begin or end inside a character)."""
    kept = docs.columns if keep is None else keep
    found = spans(docs, id_col, text_col).groupBy("ord", "th").agg(
        F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends"))
    source = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(kept)],
                         F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)).alias("ord"),
                         F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    met = source.withColumn("th", F.xxhash64("text")).join(found, ["ord", "th"], "left")

    def compute(batches):
        for batch in batches:
            yield batch, _cut(batch)

    out = add_struct(met, ["text", "starts", "ends"], [f"k{i}" for i in range(len(kept))], "made", KIND, compute)
    return out.toDF(*kept, name)
