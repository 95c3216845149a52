import random
import re

from staylens.llm import pii_bootstrap as op
from tests_llm_helpers import EDGES, frame, sha

CONTRACT = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, s):
    d = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
        return 13 <= len(d) <= 19 and sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0
    return kind == "email" or 9 <= len(d) <= 15


def brute(text):
    found = {k: [m for m in re.finditer(CONTRACT[k], text or "") if valid(k, m.group())] for k in op.KINDS}
    spans = [f"{k}:{m.start()}:{m.end()}" for k in op.KINDS for m in found[k]]
    return *[len(found[k]) for k in op.KINDS], sha(",".join(spans)), spans


def test_base_same_as_the_contract(spark):
    random.seed(2)
    parts = list("a@.b-%+_1239 ()é🙂\n") + ["@x.y", "4111111111111111", "10.0.0.1", "+1 (234) 555-6789", "256.1.1.1", " "]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 60))) for _ in range(1500)]
    texts += [t for _, t in EDGES] + ["1" * 30_000, "1 " * 8000, "a" * 50_000 + "@", "a@" + "b." * 8000, "+1" + "-" * 20_000,
                                      "1.1.1.1.1.1.1.1.1", "a@b.c_d@e.f@g.h", "4111 1111-1111 1111 2", "0255.1.1.1"]
    rows = list(enumerate(texts))
    got = {r.doc_id: r for r in op.report(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        r, want = got[i], brute(t)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == want[:5], t[:80]
        assert set(want[5]) <= set(r.spans.split(",")) or not want[5]


def docs():
    seeds = [(i, f"Intro {i}\nPlease contact me: jo{i}@x.org now") for i in range(30)]
    unseen = [(100 + i, f"Please contact me: user{i}4455x now") for i in range(9)]
    plain = [(200 + i, f"Order number 2024{i:04d}77 was shipped") for i in range(30)]
    return seeds, unseen, plain


def test_patterns_find_unseen_identifiers_and_leave_others(spark):
    seeds, unseen, plain = docs()
    rows = [*seeds, *unseen, *plain, (None, None), (30, seeds[0][1]), (30, seeds[0][1])]
    got = {}
    for r in op.report(frame(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append(r.spans)
    for i, t in unseen:
        word = t.split()[3]
        at = t.index(word)
        assert got[i] == [f"id:{at}:{at + len(word)}"]
    assert all(got[i] == [""] for i, _ in plain) and got[None] == [""] and len(got[30]) == 2
    assert op.report(frame(spark, [])).count() == 0


def test_mask(spark):
    seeds, unseen, plain = docs()
    rows = [(i, t, "en", "s", len(t), 1) for i, t in [*seeds, *unseen, *plain]] + [(999, None, None, None, 0, 1)]
    table = frame(spark, rows, "doc_id long, text string, lang string, source string, n_chars long, spans int")
    made = op.clean(table)
    assert made.columns == table.columns
    text = {r.doc_id: r for r in made.collect()}
    assert len(text) == len(rows) and text[999].text is None
    assert text[0].text == "Intro 0\nPlease contact me: [EMAIL] now" and text[0].n_chars == len(text[0].text)
    assert text[100].text == "Please contact me: [ID] now" and text[200].text == plain[0][1]


def test_spaced_entities_are_seeds_and_spaced_identifiers_are_found_whole(spark):
    phones = [(i, f"Reach them on +1 ({i + 200}) 555-77{i + 10} today") for i in range(12)]
    cards = ["4111 1111 1111 1111", "5500 0000 0000 0004", "4012 8888 8888 1881", "6011 0000 0000 0004"]
    cards = [(100 + i, f"It was billed to account {c}, thanks") for i, c in enumerate(cards)]
    unseen = {200: ("Reach them on ", "123 45 6789", " today"), 201: ("It was billed to account ", "99 1234 77", ", thanks"),
              202: ("Reach them on ", "XQ7-LMNP", " today"), 203: ("Reach them on ", "(017) 555 7713", ". 12 more"),
              204: ("It was billed to account ", "DE89 3704 0044 0532 0130 01", ""),
              205: ("Mail a@b.org\nReach them on ", "4711", ", 4712 or 4713")}
    plain = [(300 + i, f"The page {i} 2024 {i} was printed") for i in range(12)]
    rows = [*phones, *cards, *((i, "".join(t)) for i, t in unseen.items()), *plain]
    got = {r.doc_id: r.spans for r in op.report(frame(spark, rows)).collect()}
    for i, (left, word, _) in unseen.items():
        assert got[i].split(",")[-1] == f"id:{len(left)}:{len(left) + len(word)}", (i, got[i])
    assert all(got[i] == "" for i, _ in plain)
    assert all(got[i].startswith("phone:") and "," not in got[i] for i, _ in phones)
