"""Toxicity by a support vector machine over a gap-weighted subsequence kernel (Nyström landmarks).

Kernel.  Two stretches of characters are alike by the subsequences of three
characters that they share, each weighted by ``DECAY`` to the power of the
characters it spans, normalised.  So a word with inserted or exchanged
characters stays close to the word meant; a word written with marks or spaces
between its letters is joined before it is compared.  A word is read through
stretches of ``WIDTH`` characters, its beginning marked.

Training.  A labelled document is a bag of words.  Witnesses are the words with
4- to 6-character parts that occur in toxic documents far more often than
chance gives, weighted by the documents that they mark; words of clean documents
are the other class, and those that a machine gets wrong are added for the next.  Features are kernel values against
``LANDMARKS`` words, whitened (Nyström); a linear machine with squared hinge
loss is solved on them, and a logistic curve turns a document's highest value
into a score.  A document's score needs no landmark at run time: kernel,
whitening and weights multiply out to one weight per subsequence.

Labels come only from rows whose crc32(id as text) mod 3 is not 1, and of these
from at most ``BOUND`` rows of each class, the first by a hash of the id, without
words of over ``LONGEST`` letters; only this bounded sample visits the driver.  Labels, languages, sources and ids are never
inputs of a score.

Edge cases: null and empty texts, and texts without words of three letters, get
the score of a document without witnesses; rows without a label are ignored in
training; with only one class of labels every score is that class's smoothed
share; repeated rows are scored alike; texts of any length are read whole.
"""

from __future__ import annotations

import heapq
import itertools
import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from .arrowmap import Shared, add_struct, fresh

#: Labelled documents, clean and toxic, that the model is fitted on at most.
BOUND = 3000, 1500
THRESHOLD = 0.7
LANDMARKS, WIDTH, DECAY = 128, 8, 0.6
#: Clean words that the machine is shown first.
CLEAN_WORDS = 3_000
#: What all clean words cost beside all toxic ones: a document has hundreds of them.
CLEAN_COST = 30.0
#: Letters of a word that the machine is fitted on at most (all words are scored whole); stretches scored at a time.
LONGEST, STRETCHES = 64, 100_000
#: Scores of words that a task remembers at a time.
REMEMBERED = 600_000

KIND = StructType().add("score", DoubleType()).add("predicted", IntegerType())

_WORD = re.compile(r"[^\W_]+")
# Begins where a run of letters does and takes runs whole, so it reads a text once.
_BROKEN = re.compile(r"(?<![^\W_])[^\W_]++(?:(?:[^\w\s]|_)++[^\W_]++)++")
_SPACED = re.compile(r"(?<!\S)[^\W_](?:\s[^\W_]){2,}(?!\S)")
_MARKS = re.compile(r"[\W_]+")

_TRIPLES = list(itertools.combinations(range(WIDTH), 3))
_WEIGHT = np.array([DECAY ** (k - i + 1) for i, _, k in _TRIPLES])


def words(text: str | None) -> set[str]:
    """Distinct words of three or more letters or digits; broken and spaced-out words are joined too."""
    low = (text or "").lower()
    found = set(_WORD.findall(low))
    found.update(_MARKS.sub("", w) for w in _BROKEN.findall(low))
    if sum(len(w) == 1 for w in found) > 1:  # else no word is spaced out
        found.update(_MARKS.sub("", w) for w in _SPACED.findall(low))
    return {w for w in found if len(w) > 2}


def _codes(text: str) -> np.ndarray:
    """1 for the mark before a word, 2 to 27 for a to z, 28 to 63 for the rest; 0 stands for nothing."""
    c = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.int64)
    return np.where(c == 94, 1, np.where((c >= 97) & (c <= 122), c - 95, 28 + c % 36))


def stretches(found: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """([stretches x WIDTH] codes, word of each stretch)."""
    length = np.fromiter(map(len, found), np.int64, len(found)) + 1
    codes = np.concatenate([_codes("^" + "^".join(found)), np.zeros(WIDTH, np.int64)])
    start = np.cumsum(length) - length
    count = np.maximum(1, length - WIDTH + 1)
    word = np.repeat(np.arange(len(found)), count)
    at = start[word] + np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count)
    where = at[:, None] + np.arange(WIDTH)
    return np.where(where < (start + length)[word][:, None], codes[where], 0), word


def norms(s: np.ndarray) -> np.ndarray:
    """Square root of each stretch's kernel value with itself, by the recursion over its prefixes."""
    n, same = len(s), {}
    for a in range(WIDTH):
        for b in range(a, WIDTH):
            same[a, b] = same[b, a] = (s[:, a] == s[:, b]) & (s[:, a] > 0)
    prime = {(a, b): np.ones(n, np.float32) for a in range(WIDTH + 1) for b in range(WIDTH + 1)}
    square = np.float32(DECAY * DECAY)
    for _ in range(2):
        new = {(a, b): np.zeros(n, np.float32) for a in range(WIDTH + 1) for b in range(WIDTH + 1) if a == 0 or b == 0}
        for a in range(1, WIDTH + 1):
            run = np.zeros(n, np.float32)
            for b in range(1, WIDTH + 1):
                run = np.float32(DECAY) * run + np.where(same[a - 1, b - 1], square * prime[a - 1, b - 1], 0)
                new[a, b] = np.float32(DECAY) * new[a - 1, b] + run
        prime = new
    total = np.zeros(n, np.float32)
    for a in range(WIDTH):
        for b in range(WIDTH):
            total += np.where(same[a, b], square * prime[a, b], 0)
    return np.sqrt(np.maximum(total, 1e-12))


def features(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Subsequence numbers and normalised weights of each stretch; number 0 counts for nothing."""
    number = np.stack([(s[:, i] << 12 | s[:, j] << 6 | s[:, k]) * ((s[:, i] > 0) & (s[:, j] > 0) & (s[:, k] > 0))
                       for i, j, k in _TRIPLES], axis=1)
    return number, (_WEIGHT[None, :] / norms(s)[:, None]).astype(np.float32)


@dataclass
class Model:
    weights: np.ndarray | None   # one per subsequence; None: a constant score
    bias: float
    slope: float
    intercept: float
    floor: float                 # the value of a document without words

    def values(self, found: list[str]) -> np.ndarray:
        """The machine's value of each word: that of its highest stretch."""
        out = np.empty(len(found), dtype=np.float32)
        for a in range(0, len(found), 20_000):
            part = found[a:a + 20_000]
            s, word = stretches(part)
            value = np.concatenate([self._stretch_values(s[b:b + STRETCHES]) for b in range(0, len(s), STRETCHES)])
            begin = np.flatnonzero(np.diff(word, prepend=-1))
            out[a:a + len(part)] = np.maximum.reduceat(value, begin) + self.bias
        return out

    def _stretch_values(self, s: np.ndarray) -> np.ndarray:
        value = np.zeros(len(s), np.float32)
        for t, (i, j, k) in enumerate(_TRIPLES):
            value += np.float32(_WEIGHT[t]) * self.weights[s[:, i] << 12 | s[:, j] << 6 | s[:, k]]
        return value / norms(s)

    def score(self, value: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * value + self.intercept, -40, 40))))


def _machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1e-5) -> np.ndarray:
    """Weights (the last is the bias) of least ridge and squared hinge loss, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float32)
    w = np.zeros(x.shape[1])
    keep = ridge * np.eye(x.shape[1])
    keep[-1, -1] = 1e-9
    was = None
    for _ in range(15):
        inside = y * (x @ w.astype(np.float32)) < 1
        if was is not None and np.array_equal(inside, was):
            break
        was, part, c = inside, x[inside], cost[inside].astype(np.float32)
        w = np.linalg.solve(keep + part.T @ (part * c[:, None]), part.T @ (c * y[inside].astype(np.float32)))
    return w


def _curve(value: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve with smoothed targets, by Newton steps."""
    n1, n0 = label.sum(), (1 - label).sum()
    target = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([value, np.ones_like(value)], axis=1)
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p) + 1e-6)[:, None]).T @ x + 1e-4 * np.eye(2),
                               x.T @ (weight * (p - target)) + 1e-4 * w)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(w[0], 1e-3)), float(w[1])


def _parts(found: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, part) of the 4- to 6-character parts of marked words, as numbers, word by word."""
    length = np.fromiter(map(len, found), np.int64, len(found)) + 1
    codes = np.concatenate([_codes("^" + "^".join(found)), np.zeros(6, np.int64)])
    word = np.repeat(np.arange(len(found)), length)
    left = np.repeat(np.cumsum(length), length) - np.arange(len(word))
    number = codes[:len(word)].copy()
    words_, parts = [], []
    for n in range(2, 7):
        number = number << 6 | codes[n - 1:n - 1 + len(word)]
        if n >= 4:
            whole = left >= n
            words_.append(word[whole])
            parts.append(number[whole])
    every = np.concatenate(words_)
    order = np.argsort(every, kind="stable")
    return every[order], np.concatenate(parts)[order]


def _counts(bags: list[set[str]], allowed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """(parts, groups of bags that hold each, groups); of ``allowed`` parts only, if given.

    Bags with the same three least-hashed words are likely copies, one group.
    Groups are counted some at a time, so memory does not follow their number.
    """
    marks = [tuple(heapq.nsmallest(3, (zlib.crc32(w.encode()) for w in bag))) for bag in bags]
    order = sorted(range(len(bags)), key=marks.__getitem__)
    kinds, counts, groups = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    at = 0
    while at < len(order):
        group, members = [], []
        while at < len(order) and (len(members) < 400 or marks[order[at]] == marks[order[at - 1]]):
            new = not members or marks[order[at]] != marks[order[at - 1]]
            groups += new
            group.append((group[-1] if group else -1) + new)
            members.append(bags[order[at]])
            at += 1
        every = sorted(set().union(*members))
        if not every:
            continue
        number = {w: i for i, w in enumerate(every)}
        word, part = _parts(every)
        if allowed is not None:
            some = np.isin(part, allowed)
            word, part = word[some], part[some]
        begin = np.searchsorted(word, np.arange(len(every) + 1))
        own = np.fromiter((number[w] for b in members for w in b), np.int64)
        size = begin[own + 1] - begin[own]
        place = np.repeat(begin[own] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        which = np.repeat(np.repeat(group, [len(b) for b in members]), size)
        pairs = np.unique(part[place] * len(members) + which) // len(members)
        kind, count = np.unique(pairs, return_counts=True)
        kinds, back = np.unique(np.concatenate([kinds, kind]), return_inverse=True)
        counts = np.bincount(back, weights=np.concatenate([counts, count]), minlength=len(kinds)).astype(np.int64)
    return kinds, counts, groups


def _tail(hits: int, of: int, share: float) -> float:
    """P(at least so many hits) of a binomial distribution."""
    log = lambda k: (math.lgamma(of + 1) - math.lgamma(k + 1) - math.lgamma(of - k + 1)
                     + k * math.log(share) + (of - k) * math.log1p(-share))
    # Far above the mean the terms fall fast; a few dozen hold the sum.
    return math.fsum(math.exp(log(k)) for k in range(hits, min(of, hits + 60) + 1))


def witnesses(toxic: list[set[str]], clean: list[set[str]]) -> Counter:
    """Words that mark toxic documents, with the number of documents that each marks.

    A part of a word is a mark if it occurs in so many more toxic documents
    than chance gives (binomial test, false discoveries held at one in a
    thousand), looking at words that no clean document has.
    """
    known = set().union(*clean)
    only = [bag - known for bag in toxic]
    kind, count, n1 = _counts(only)
    ckind, ccount, n0 = _counts(clean, kind)
    if not len(kind):
        return Counter()
    there = np.searchsorted(ckind, kind)
    other = np.zeros(len(kind), np.int64)
    found = there < len(ckind)
    found[found] = ckind[there[found]] == kind[found]
    other[found] = ccount[there[found]]
    tested = np.flatnonzero(count + other >= 3)
    share = n1 / (n1 + n0)
    pairs, back = np.unique(np.stack([count[tested], other[tested]]), axis=1, return_inverse=True)
    chance = np.array([_tail(a, a + b, share) if a > 3 * b * share / (1 - share) else 1.0 for a, b in pairs.T.tolist()])
    p = chance[back.ravel()]
    order = np.sort(p)
    good = np.flatnonzero(order <= 0.001 * np.arange(1, len(p) + 1) / max(1, len(p)))
    odds = (count[tested] + 0.5) / (n1 + 1) / ((other[tested] + 0.5) / (n0 + 1))
    marks = kind[tested[(p <= (order[good[-1]] if len(good) else -1)) & (odds > 10)]]
    every = sorted(set().union(*only))
    word, part = _parts(every)
    marking = {every[w] for w in np.unique(word[np.isin(part, marks)]).tolist()}
    out = Counter()
    for bag in toxic:
        out.update(bag & marking)
    return out


def _tops(model: Model, bags: list[set[str]]) -> np.ndarray:
    every = sorted(set().union(*bags)) if bags else []
    values = dict(zip(every, model.values(every).tolist(), strict=True)) if every else {}
    return np.clip([max((values[w] for w in bag), default=model.floor) for bag in bags], -2, 2)


def _machine_of(toxic: list[set[str]], clean: list[set[str]], rounds: int = 3) -> Model | None:
    marking = witnesses(toxic, clean)
    if not marking:
        return None
    bad = sorted(marking, key=lambda w: (-marking[w], w))[:CLEAN_WORDS]
    weight = np.array([marking[w] for w in bad], dtype=np.float64)
    others = sorted(set().union(*clean), key=lambda w: (zlib.crc32(w.encode()), w))
    # Words of toxic documents that mark none of them stand beside the clean ones.
    plain, rest = others[:CLEAN_WORDS], others[CLEAN_WORDS:]
    model = None
    for _ in range(rounds):
        marks = _landmarks(bad, LANDMARKS // 2) + plain[:LANDMARKS // 2]
        model = _train(bad, weight, plain, marks)
        if not rest:
            break
        value = model.values(rest)
        wrong = np.argsort(-value, kind="stable")[:1500]
        wrong = wrong[value[wrong] > -0.95]
        if not len(wrong):
            break
        plain = [rest[i] for i in wrong.tolist()] + plain
        gone = set(wrong.tolist())
        rest = [w for i, w in enumerate(rest) if i not in gone]
    model.floor = float(model.values(others).min()) if others else -2.0
    return model


def fit(bags: list[tuple[set[str], int]], share: float | None = None) -> Model:
    """The model of labelled bags of words; ``share``: how many of all labels say toxic, if the bags differ.

    The logistic curve is fitted on a third of the bags, with values of a
    machine that has not seen them; if that one finds no witnesses, on all bags.
    """
    toxic, clean = ([b for b, y in bags if y == k] for k in (1, 0))
    constant = Model(None, 0.0, 0.0, float(np.log((len(toxic) + 0.5) / (len(clean) + 0.5))), 0.0)
    if not toxic or not clean:
        return constant
    model = _machine_of(toxic, clean)
    if model is None:
        return constant
    other = _machine_of([b for i, b in enumerate(toxic) if i % 3], [b for i, b in enumerate(clean) if i % 3], rounds=2)
    seen = slice(None, None, 3) if other and len(toxic) >= 30 else slice(None)
    judge = other if other and len(toxic) >= 30 else model
    top1, top0 = _tops(judge, toxic[seen]), _tops(judge, clean[seen])
    share = len(toxic) / len(bags) if share is None else share
    weight = np.concatenate([np.full(len(top1), share / len(top1)), np.full(len(top0), (1 - share) / len(top0))])
    model.slope, model.intercept = _curve(np.concatenate([top1, top0]), np.repeat([1, 0], [len(top1), len(top0)]),
                                          weight * (len(top1) + len(top0)))
    return model


def _landmarks(found: list[str], n: int) -> list[str]:
    """The most frequent words and, for the other half, words least like all before."""
    if len(found) <= n:
        return found
    chosen = found[:n // 2]
    found = found[:2000]
    s, word = stretches(found)
    number, weight = features(s[np.flatnonzero(np.diff(word, prepend=-1))])
    near, own = np.full(len(found), -1.0), np.zeros(64 ** 3, np.float32)
    picked = list(range(len(chosen)))
    for k in range(n - 1):
        i = picked[k]
        np.add.at(own, number[i], weight[i])
        own[0] = 0
        near = np.maximum(near, (own[number] * weight).sum(axis=1))
        own[number[i]] = 0
        if k + 1 >= len(picked):
            picked.append(int(near.argmin()))
    return [found[i] for i in dict.fromkeys(picked)]


def _train(toxic: list[str], documents: np.ndarray, plain: list[str], marks: list[str]) -> Model:
    s, word = stretches(marks)
    number, weight = features(s)
    used = np.unique(number)                 # subsequences of landmarks; all others count for nothing
    place = np.full(64 ** 3, len(used), dtype=np.int64)
    place[used[used > 0]] = np.flatnonzero(used > 0)
    table = np.zeros((len(used) + 1, len(s)), dtype=np.float32)
    np.add.at(table, (place[number].ravel(), np.repeat(np.arange(len(s)), len(_TRIPLES))), weight.ravel())
    table[-1] = 0

    def kernel(x: np.ndarray) -> np.ndarray:
        number, weight = features(x)
        out = np.zeros((len(x), len(s)), dtype=np.float32)
        for t in range(len(_TRIPLES)):
            out += weight[:, t:t + 1] * table[place[number[:, t]]]
        return out

    value, vector = np.linalg.eigh(kernel(s).astype(np.float64) + 1e-6 * np.eye(len(s)))
    whiten = vector / np.sqrt(np.maximum(value, 1e-6))
    xs, xw = stretches(toxic)
    # Of a toxic word the stretch most like others of toxic words stands for it; of a clean word all.
    like = kernel(xs)[:, np.isin(word, np.arange(min(len(marks) // 2, len(toxic))))].sum(axis=1)
    pick = np.lexsort((-like, xw))
    xs = xs[pick[np.flatnonzero(np.diff(xw[pick], prepend=-1))]]
    ps, _ = stretches(plain)
    ps = np.unique(ps, axis=0)
    x = np.concatenate([kernel(part) for part in np.array_split(np.vstack([xs, ps]), 16) if len(part)]) @ whiten
    y = np.concatenate([np.ones(len(xs)), -np.ones(len(ps))])
    cost = np.concatenate([documents / documents.sum(), np.full(len(ps), CLEAN_COST / max(1, len(ps)))])
    w = _machine(x, y, cost)
    weights = (table @ (whiten @ w[:-1]).astype(np.float32))[place].astype(np.float32)
    return Model(weights, float(w[-1]), 1.0, 0.0, -1.0)


def held_out(id_col: str):
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string")), F.lit(3)) == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> Model:
    rows = labels.where(~held_out("doc_id") & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    sample = [rows.where(F.col("toxic") == y).orderBy(F.xxhash64("id"), "id").limit(BOUND[y]) for y in (0, 1)]
    chosen = F.broadcast(sample[0].union(sample[1]))   # bounded by BOUND
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).join(chosen, "id")

    def compute(batches):
        for batch in batches:
            found = [" ".join(sorted(w for w in words(t) if len(w) <= LONGEST)) for t in batch.column(0).to_pylist()]
            yield batch, pa.StructArray.from_arrays([pa.array(found, pa.string())], names=["words"])

    share = rows.where("toxic in (0, 1)").agg(F.avg("toxic")).first()[0]
    bags = add_struct(source, ["text"], ["id", "toxic"], "made", StructType().add("words", "string"), compute)
    one: dict[str, str] = {}   # each word once in memory
    rows = bags.select("id", "toxic", "made.words").orderBy(F.xxhash64("id"), "id", "toxic", "words").toLocalIterator()
    return fit([({one.setdefault(w, w) for w in r.words.split()}, r.toxic) for r in rows], share)


def annotate(docs: DataFrame, model: Model, *, text_col: str = "text", keep: list[str] | None = None,
             name: str = "toxicity") -> DataFrame:
    """``keep`` columns (all by default) and a struct: score, predicted."""
    shared = Shared(docs.sparkSession, model)

    def compute(batches):
        model, known = shared.value, {}
        for batch in batches:
            bags = [words(t) for t in batch.column(0).to_pylist()]
            score = []
            if model.weights is not None:
                need = set().union(*bags)
                if len(known) + len(need) > REMEMBERED:
                    known.clear()
                new = list(need.difference(known))
                if new:
                    known.update(zip(new, model.values(new).tolist(), strict=True))
            for bag in bags:
                top = max(map(known.__getitem__, bag), default=model.floor) if known else model.floor
                score.append(model.score(min(2.0, max(-2.0, top))))
            made = np.array(score, dtype=np.float64)
            yield batch, pa.StructArray.from_arrays(
                [pa.array(made), pa.array((made >= THRESHOLD).astype(np.int32))], names=KIND.names)

    return add_struct(docs, [text_col], docs.columns if keep is None else keep, name, KIND, compute)


def clean(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those that the model rejects."""
    name = fresh("toxicity", docs.columns)
    marked = annotate(docs, train(docs, labels, id_col=id_col, text_col=text_col), text_col=text_col, name=name)
    return marked.where(F.col(f"{name}.predicted") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
