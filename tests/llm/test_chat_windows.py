import pytest

from staylens.llm import chat_windows as op
from tests_llm_helpers import sha

P = op.PLANTED
ROWS = [(1, 0, "system", "be kind"), (1, 1, "user", "hi " * 300), (1, 2, "assistant", P), (1, 3, "user", None),
        (1, 4, "assistant", "x" * 4000), (1, 5, "user", "# <a> \\b \\\\l"), (1, 6, "assistant", ""),
        (2, 5, "assistant", "only"), (2, 5, "assistant", "only"), (2, 5, None, "r: ole"), (2, None, "a: b#", "late"),
        (None, 0, "user", "null id"), (None, 1, "assistant", "null id too"),
        *[(3, i, "user" if i % 2 else "assistant", f"turn {i} " * (i % 30)) for i in range(-200, 300)],
        (4, 0, "user", "x"), (4, 1, "system", "late system " * 60), (4, 2, "assistant", "y " * 900), (4, 3, "assistant", "z")]


def frame(spark):
    return spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string").repartition(4)


def brute():
    out = {}
    for conv in {r[0] for r in ROWS}:
        turns = sorted(((t is None, t or 0, r or "", x or "") for c, t, r, x in ROWS if c == conv))
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        out[conv] = len(turns), sha("".join(f"{r}\n{x}\n" for _, _, r, x in turns)), len(loss), sha(loss)
    return out


def test_read_back_is_exact(spark):
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
           for r in op.read_back(op.windows(frame(spark))).collect()}
    assert got == brute()


def tokens(part):
    return (len(part.split(": ", 1)[1].encode()) + 3) // 4 + op.MARKS


def test_windows_keep_to_the_budget_and_repeat_history(spark):
    rows = op.windows(frame(spark)).where("conv = 3").orderBy("window").collect()
    assert len(rows) > 5
    written = []
    for r in rows:
        parts = r.formatted.split(op.CLOSE)[:-1]
        assert len(parts) == r.n_context + r.n_turns
        if r.n_context:   # history is the end of all that came before, as far as its share reaches
            assert written[-r.n_context:] == parts[:r.n_context]
        own = [tokens(p) for p in parts]
        assert sum(own[:r.n_context]) <= op.HISTORY
        if r.n_context < len(written):
            assert sum(own[:r.n_context]) + tokens(written[-r.n_context - 1]) > op.HISTORY
        assert sum(own) <= op.BUDGET or r.n_turns == 1
        assert all(r.formatted[s.start:s.end] in r.formatted and r.formatted[s.end:].startswith(op.CLOSE) for s in r.loss)
        written += parts[r.n_context:]


def test_no_window_of_the_test_tables_exceeds_the_budget(spark):
    """But where one turn, or the system turn, does so alone."""
    rows = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    made = op.windows(rows).collect()
    assert len(made) > 100
    for r in made:
        own = [tokens(p.replace("\\l", "<").replace("\\h", "#").replace("\\b", "\\")) for p in r.formatted.split(op.CLOSE)[:-1]]
        assert sum(own) <= op.BUDGET or (r.n_turns == 1 and own[-1] > op.BUDGET - op.HISTORY - own[0])


def test_system_turn_is_retained(spark):
    rows = op.windows(frame(spark)).where("conv = 1").orderBy("window").collect()
    assert len(rows) > 1 and all(r.formatted.startswith("### system: be kind</turn>") for r in rows)


def test_empty_table(spark):
    assert op.read_back(op.windows(frame(spark).limit(0))).count() == 0


@pytest.mark.parametrize("text", [P, "\\", "\\\\b", "<#:\\c", "\\l\\h\\b\\c", ""])
def test_escapes_are_reversible(spark, text):
    from pyspark.sql import functions as F

    row = spark.range(1).select(op.unescape(op.escape(F.lit(text))).alias("a"),
                                op.unescape(op.escape(F.lit(text), True)).alias("b"),
                                op.escape(F.lit(text)).alias("c")).first()
    assert row.a == row.b == text and "<" not in row.c and "#" not in row.c
