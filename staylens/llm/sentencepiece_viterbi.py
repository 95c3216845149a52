"""SentencePiece encoding by a streaming Viterbi search, and exact decoding.

The pieces and scores of a public SentencePiece model are read as a lexicon; a
text's ids are the segmentation with the highest sum of scores (what the
library gives for the same pieces as a unigram model, but for the rounding of
its 32-bit sums; of equal sums, the one whose last piece is longer).  The search holds scores of one window, as long as
the longest piece, and the back pointers since the last point that all
surviving paths share; at every such point it commits ids and forgets what lay
before.  Where two characters stand side by side in no piece, all paths meet, so
texts are cut there first (before each space mark after another character, for
usual models) and the ids of a cut piece of text are kept for its next use.

Text is never normalised: white space stays as it is, a character outside the
lexicon becomes byte ids, and so does the space mark itself when a text holds
it.  So decoding returns every text exactly.  Control pieces written out in a
text are ordinary characters.

Edge cases: a null or empty text has no ids and decodes to an empty text;
repeated documents each get a row; other columns are kept as they are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructType

from .arrowmap import Shared, add_struct, fresh

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Cut texts whose ids a task remembers at a time; the memory is bounded, results don't depend on it.
REMEMBERED = 400_000
#: Longest cut text that is searched together with others.
SIDE_BY_SIDE = 40
#: What an unknown character scores below the worst piece.
UNKNOWN = 10.0

KIND = (StructType().add("n_chars", LongType()).add("n_ids", LongType()).add("ids_sha256", StringType())
        .add("text_sha256", StringType()).add("decoded_sha256", StringType()).add("exact", BooleanType())
        .add("ids", ArrayType(IntegerType(), False)))


class Trie:
    """The pieces' prefixes as numbered nodes; steps of many nodes at a time by one hash table."""

    def __init__(self, score: dict[str, tuple[float, int]]):
        nodes, edges = {"": 0}, {}
        for piece in score:
            for n in range(1, len(piece) + 1):
                if piece[:n] not in nodes:
                    nodes[piece[:n]] = len(nodes)
                    edges[nodes[piece[:n - 1]] << 21 | ord(piece[n - 1])] = nodes[piece[:n]]
        self.piece = np.full(len(nodes), -1, dtype=np.int32)
        self.score = np.full(len(nodes), -np.inf)
        for piece, (s, i) in score.items():
            self.piece[nodes[piece]], self.score[nodes[piece]] = i, s
        self.bits = max(4, (4 * len(edges)).bit_length())
        self.key = np.full(1 << self.bits, -1, dtype=np.int64)
        self.next = np.full(1 << self.bits, -1, dtype=np.int32)
        keys, values = np.array(list(edges), np.int64), np.array(list(edges.values()), np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.key[slot] < 0)
            chosen = free[np.unique(slot[free], return_index=True)[1]]  # one key a slot
            self.key[slot[chosen]], self.next[slot[chosen]] = keys[chosen], values[chosen]
            rest = np.ones(len(keys), dtype=bool)
            rest[chosen] = False
            keys, values, slot = keys[rest], values[rest], (slot[rest] + 1) & (len(self.key) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, node: np.ndarray, character: np.ndarray) -> np.ndarray:
        """The node one character on, -1 where no piece goes on so."""
        keys = node.astype(np.int64) << 21 | character.astype(np.int64)
        slot = self._slot(keys)
        out = np.where(self.key[slot] == keys, self.next[slot], -1)
        look = np.flatnonzero((self.key[slot] != keys) & (self.key[slot] >= 0))
        while len(look):
            slot[look] = (slot[look] + 1) & (len(self.key) - 1)
            there = self.key[slot[look]]
            out[look] = np.where(there == keys[look], self.next[slot[look]], -1)
            look = look[(there != keys[look]) & (there >= 0)]
        return out


class Lexicon:
    """Pieces, scores and decoding bytes of a model; bounded by the model's size."""

    def __init__(self, pieces: list[tuple[str, float, str]]):
        """``pieces``: (piece, score, kind) by id; kind is normal, byte or other."""
        self.score = {p: (s, i) for i, (p, s, kind) in enumerate(pieces) if kind == "normal" and p}
        self.begin = {p[:n] for p in self.score for n in range(1, len(p) + 1)}
        self.trie = Trie(self.score)
        self.longest = max(map(len, self.score), default=1)
        self.unknown = min((s for s, _ in self.score.values()), default=0.0) - UNKNOWN
        self.byte = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == "byte"}
        self.out = [bytes([int(p[3:5], 16)]) if kind == "byte" else p.replace(MARK, " ").encode()
                    if kind == "normal" else b"" for p, _, kind in pieces]
        #: No piece has the mark after another character: all paths meet before such a mark.
        self.cuts = not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.score)

    @classmethod
    def read(cls, model: str = MODEL) -> Lexicon:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        kind = lambda i: ("byte" if sp.is_byte(i) else "other" if sp.is_control(i) or sp.is_unknown(i)
                          or sp.is_unused(i) else "normal")
        return cls([(sp.id_to_piece(i), sp.get_score(i), kind(i)) for i in range(sp.get_piece_size())])

    def bytes_of(self, text: str) -> list[int]:
        return [self.byte[b] for b in text.encode()]


def stream(characters: Iterable[str], lexicon: Lexicon) -> Iterator[int]:
    """Ids of the best segmentation, each as soon as all surviving paths share it."""
    longest, begin, score = lexicon.longest, lexicon.begin, lexicon.score
    source = iter(characters)
    ahead = ""                       # characters from position ``at`` on, as many as a piece can have
    at = base = reach = 0            # reach: the farthest end of a piece begun before ``at``
    best = {0: 0.0}                  # scores of the window
    back: dict[int, tuple[int, int | str]] = {}  # since ``base``: where the last piece begins, and its id or character
    limit = 8 * longest

    def commit(end: int) -> list[int]:
        path, here = [], end
        while here > base:
            here, made = back[here]
            path.append(made)
        ids = [i for made in reversed(path) for i in ([made] if isinstance(made, int) else lexicon.bytes_of(made))]
        for k in [k for k in back if k <= end]:
            del back[k]
        return ids

    while True:
        while len(ahead) < longest:
            c = next(source, None)
            if c is None:
                break
            ahead += c
        if at == reach or not ahead:             # no piece spans this point
            yield from commit(at)
            base = at
            if not ahead:
                return
        elif at - base >= limit:                 # follow every survivor back until one boundary is left
            ends = {k for k in best if k > at} | {at}
            while len(ends) > 1:
                last = max(ends)
                ends.remove(last)
                ends.add(back[last][0] if last > base else base)
            if (shared := ends.pop()) > base:
                yield from commit(shared)
                base = shared
            limit = max(8 * longest, 2 * (at - base))
        here = best.pop(at)
        single = False
        for n in range(1, len(ahead) + 1):
            piece = ahead[:n]
            if piece not in begin:
                break
            if piece in score:
                single |= n == 1
                s, i = score[piece]
                end = at + n
                if end not in best or here + s > best[end]:
                    best[end], back[end] = here + s, (at, i)
                    reach = max(reach, end)
        if not single:
            end = at + 1
            if end not in best or here + lexicon.unknown > best[end]:
                best[end], back[end] = here + lexicon.unknown, (at, ahead[0])
                reach = max(reach, end)
        ahead = ahead[1:]
        at += 1


def search_many(cuts: list[str], lexicon: Lexicon) -> list[bytes]:
    """The ids of many short cut texts: the same search, one position of all of them at a time."""
    trie, n = lexicon.trie, len(cuts)
    codes = np.frombuffer("".join(cuts).encode("utf-32-le"), dtype="<u4")
    length = np.fromiter(map(len, cuts), np.int64, n)
    start = np.cumsum(length) - length
    top = int(length.max())
    best = np.full((n, top + 1), -np.inf)
    best[:, 0] = 0.0
    piece = np.full((n, top + 1), -1, dtype=np.int32)
    size = np.ones((n, top + 1), dtype=np.int8)
    for at in range(top):
        every = np.flatnonzero(length > at)
        lane, node = every, np.zeros(len(every), np.int32)
        single = np.zeros(n, dtype=bool)
        for k in range(1, min(lexicon.longest, top - at) + 1):
            if k > 1:
                fits = length[lane] >= at + k
                lane, node = lane[fits], node[fits]
            node = trie.step(node, codes[start[lane] + at + k - 1])
            goes = node >= 0
            lane, node = lane[goes], node[goes]
            if not len(lane):
                break
            total = best[lane, at] + trie.score[node]
            better = total > best[lane, at + k]
            to = lane[better]
            best[to, at + k], piece[to, at + k], size[to, at + k] = total[better], trie.piece[node[better]], k
            if k == 1:
                single[lane[trie.piece[node] >= 0]] = True
        alone = every[~single[every]]
        total = best[alone, at] + lexicon.unknown
        better = total > best[alone, at + 1]
        to = alone[better]
        best[to, at + 1], piece[to, at + 1], size[to, at + 1] = total[better], -1, 1
    made = np.zeros((n, top), dtype="<i4")
    count, here, lane = np.zeros(n, np.int64), length.copy(), np.arange(n)
    unknown = np.zeros(n, dtype=bool)
    while len(lane):
        count[lane] += 1
        p = piece[lane, here[lane]]
        made[lane, top - count[lane]] = p
        unknown[lane[p < 0]] = True
        here[lane] -= size[lane, here[lane]]
        lane = lane[here[lane] > 0]
    raw, begin = made.tobytes(), (np.arange(1, n + 1) * top - count).tolist()
    out = [raw[4 * b:4 * e] for b, e in zip(begin, range(top, n * top + 1, top), strict=True)]
    for i in np.flatnonzero(unknown).tolist():   # byte ids for characters that no piece has
        out[i] = np.fromiter(stream(cuts[i], lexicon), dtype="<i4").tobytes()
    return out


def learn(cuts: Iterable[str], lexicon: Lexicon, known: dict[str, bytes]) -> None:
    short: dict[int, list[str]] = {}
    for cut in cuts:
        if len(cut) > SIDE_BY_SIDE:
            known[cut] = np.fromiter(stream(cut, lexicon), dtype="<i4").tobytes()
        else:
            short.setdefault((len(cut) + 7) // 8, []).append(cut)
    for same in short.values():
        for k in range(0, len(same), 20_000):
            known.update(zip(same[k:k + 20_000], search_many(same[k:k + 20_000], lexicon), strict=True))


_CUT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def cut_text(text: str, lexicon: Lexicon) -> list[list[str]]:
    """The cut texts of each part between literal space marks."""
    if not text:
        return []
    parts = [part.replace(" ", MARK) for part in text.split(MARK)]
    parts[0] = MARK + parts[0]
    return [_CUT.findall(p) if lexicon.cuts else [p] if p else [] for p in parts]


def encode_texts(texts: list[str], lexicon: Lexicon, known: dict[str, bytes]) -> list[bytes]:
    """Ids of each text as little-endian 32-bit integers."""
    parts = [cut_text(t, lexicon) for t in texts]
    need = set().union(*[cuts for text in parts for cuts in text])
    if len(known) + len(need) > REMEMBERED:
        known.clear()
    learn(need.difference(known), lexicon, known)
    mark = np.array([lexicon.byte[b] for b in MARK.encode()] if lexicon.byte else [], dtype="<i4").tobytes()
    return [mark.join([b"".join(map(known.__getitem__, cuts)) for cuts in text]) for text in parts]


def decode_ids(ids: Iterable[int], lexicon: Lexicon) -> bytes:
    """The UTF-8 text of some ids, without the space that encoding puts before a text."""
    return b"".join([lexicon.out[i] for i in ids])[1:]


def encode(docs: DataFrame, *, text_col: str = "text", keep: list[str] | None = None, model: str = MODEL,
           ids: bool = True) -> DataFrame:
    """``keep`` columns (all by default) and n_chars, n_ids, ids_sha256 (of the ids as
    little-endian 32-bit integers), text_sha256, decoded_sha256, exact and ids."""
    shared = Shared(docs.sparkSession, Lexicon.read(model))
    kept = docs.columns if keep is None else keep

    def compute(batches):
        lexicon, known = shared.value, {}
        for batch in batches:
            columns = [[] for _ in range(6)]
            packed = []
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for text, raw in zip(texts, encode_texts(texts, lexicon, known), strict=True):
                plain = text.encode()
                again = decode_ids(np.frombuffer(raw, dtype="<i4").tolist(), lexicon)
                sha = hashlib.sha256(plain).hexdigest()
                row = (len(text), len(raw) // 4, hashlib.sha256(raw).hexdigest(), sha,
                       sha if again == plain else hashlib.sha256(again).hexdigest(), again == plain)
                for c, v in zip(columns, row, strict=True):
                    c.append(v)
                packed.append(raw)
            ends = np.cumsum([0, *columns[1]]).astype(np.int32)
            flat = np.frombuffer(b"".join(packed), dtype="<i4")
            yield batch, pa.StructArray.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 *[pa.array(c, pa.string()) for c in columns[2:5]], pa.array(columns[5], pa.bool_()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))], names=KIND.names)

    name = fresh("pieces", kept)
    made = add_struct(docs, [text_col], kept, name, KIND, compute)
    return made.select(*[f"`{c}`" for c in kept], *[f"{name}.{c}" for c in KIND.names if ids or c != "ids"])
