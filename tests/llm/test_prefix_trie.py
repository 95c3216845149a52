import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from staylens.llm import prefix_trie as op
from tests_llm_helpers import frame, sha

COLUMNS = "conv_id long, turn long, role string, text string"


def conversations(rows):
    import hashlib
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, tie, (role, text)))
    return {c: [t[-1] for t in sorted(turns)] for c, turns in own.items()}


def rebuild(own):
    out = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 4, c - int(abs(c) % 20 * (1 if c >= 0 else -1))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(set)
    leaves, saved = defaultdict(int), defaultdict(int)
    for key in members:
        if key:
            children[key[:-1]].add(key)
    for key in members:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", key[-1][1])) if key else 0
        for d in range(len(key) + 1):
            leaves[key[:d]] += key not in children
            saved[key[:d]] += (len(members[key]) - 1) * words
    return sorted(((min(m), len(key), min(members[key[:-1]]) if key else None, len(m), len(children.get(key, ())),
                    leaves[key], saved[key], sha(",".join(map(str, sorted(ends.get(key, []))))))
                   for key, m in members.items()), key=repr)


def made(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def rows_of(convs):
    return [(c, i, role, text) for c, turns in convs.items() for i, (role, text) in enumerate(turns)]


U, A = ("user", "hello there you"), ("assistant", "well, hello\tto you\n too")
CONVS = {c: [U, A, ("user", f"about {c % 7}"), ("assistant", f"answer {c % 3}")][:1 + c % 4] for c in range(300)}
CONVS |= {1000 + c: [U, A, ("user", "the same one")] for c in range(200)}               # copies
CONVS |= {2000: [("user", f"turn {i}") for i in range(500)], 2001: [("user", f"turn {i}") for i in range(400)] + [A]}
CONVS |= {-5: [U, A], -40: [A, U], 3007: [("", "")], 3008: [("user", ""), ("user", "x y")]}
ROWS = rows_of(CONVS) + [(4000, None, "user", "no number"), (4000, 1, None, None), (4000, 1, "user", "tie"),
                         (4000, 1, "user", "tie"), (None, 0, "user", "nobody's"), (4001, 0, "user", "z " * 100_000)]


@pytest.mark.parametrize("shard_turns, sample", [(20_000, 64 << 20), (50, 64 << 20), (50, 70_000), (7, 64 << 20)])
def test_same_as_brute_force(spark, shard_turns, sample):
    want = brute(conversations(ROWS))
    assert made(op.nodes(op.paths(frame(spark, ROWS, COLUMNS)), shard_turns=shard_turns, sample_bytes=sample)) == want


def test_rebuilt_conversations(spark):
    own = conversations(ROWS)
    got = made(op.nodes(op.rebuilt(op.paths(frame(spark, ROWS, COLUMNS))), shard_turns=100))
    assert got == brute(rebuild(own))
    assert any(not turns for turns in rebuild(own).values())


def test_a_conversation_of_every_second_id(spark):
    convs = {c: [U, A] if c % 2 else [("user", f"own {c}")] for c in range(4000)}
    assert made(op.nodes(op.paths(frame(spark, rows_of(convs), COLUMNS)), shard_turns=300)) == brute(convs)


def test_other_names_clashes_and_empty_table(spark):
    rows = frame(spark, rows_of({1: [U, A], 2: [U]}), "path long, c long, shard string, turns string").withColumn("node", F.lit(1))
    got = made(op.nodes(op.paths(rows, conv="path", turn="c", role="shard", text="turns")))
    assert got == brute({1: [U, A], 2: [U]})
    assert op.nodes(op.rebuilt(op.paths(frame(spark, [], COLUMNS)))).count() == 0
