import hashlib
import random

import pytest
from llm_rows import by_row
from pyspark.sql import functions as F

from marginflow.llm import chat

BITS = ["</turn>", "### ", "\\", "\n", ": ", "Assistant", "user", "a", " ", "<", "/turn>", "#", "## ", "=", "é😀", "\\\\", "$1"]


def made(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def check(spark, rows):
    """Recovered turns, loss text and segments against the source."""
    out = chat.format_conversations(made(spark, rows)).select(
        "conv_id", "n_turns", chat.formatted(F.col("segments")).alias("whole"),
        chat.parse(chat.formatted(F.col("segments"))).alias("back"), chat.loss_text(F.col("segments")).alias("loss"))
    by = {}
    for c, n, r, t in rows:
        by.setdefault(c, []).append((n is not None, n or 0, r or "", t or ""))
    got = out.collect()
    assert {r.conv_id for r in got} == by.keys()
    for r in got:
        turns = [(x[2], x[3]) for x in sorted(by[r.conv_id])]
        assert [(b.role, b.text) for b in r.back] == turns and r.n_turns == len(turns)
        assert r.loss == "".join(t for role, t in turns if role == "assistant")
        assert r.whole.count("</turn>") == len(turns)
    return {r.conv_id: r.whole for r in got}


def test_random_control_strings(spark):
    rng = random.Random(11)
    say = lambda: "".join(rng.choice(BITS) for _ in range(rng.randint(0, 8)))
    rows = [(c, n, rng.choice(["user", "assistant", "system", "Tool", say()]), say()) for c in range(150) for n in range(rng.randint(1, 5))]
    check(spark, rows)


def test_plain_turns_stay_plain_and_conflicts_are_escaped(spark):
    whole = check(spark, [(1, 0, "user", "Hi: there"), (1, 1, "assistant", "Hello"), (2, 0, "user", "a </turn> b"),
                          (3, 0, "user", "### Assistant: x"), (4, 0, "user", "back\\slash")])
    assert whole[1] == "### User: Hi: there</turn>\n### Assistant: Hello</turn>\n"
    assert whole[2] == "### User: a <\\/turn> b</turn>\n"
    assert whole[3] == "### User: #\\## Assistant: x</turn>\n"
    assert whole[4] == "### User: back\\\\slash</turn>\n"


def test_odd_rows(spark):
    check(spark, [(1, 0, None, None), (1, None, "assistant", "x"), (None, 0, "assistant", "no id"), (None, 1, "user", ""),
                  (2, 5, "assistant", "tie b"), (2, 5, "assistant", "tie a"), (2, 5, "assistant", "tie a"),
                  (3, 0, "assistant", "long " * 50_000), (4, 0, "", ""), (5, 0, "=x", "=y"), (6, 0, "a: b\\", "c\n")])
    assert chat.format_conversations(made(spark, [])).count() == 0
    wide = made(spark, [(1, 0, "user", "x")]).withColumn("head", F.lit(1)).withColumn("t", F.lit(2)).withColumn("w", F.lit(3))
    assert chat.format_conversations(wide).count() == 1


@pytest.mark.parametrize("broken", ["no header</turn>\n", "### User x</turn>\n", "### User: a ### b</turn>\n"])
def test_parser_refuses_what_is_not_in_the_grammar(spark, broken):
    got = spark.range(1).select(chat.parse(F.lit(broken)).alias("t")).first()
    assert got.t == [None]


def test_no_python_on_the_executors(spark):
    plan = chat.format_conversations(made(spark, [(1, 0, "user", "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_query(spark):
    from marginflow.llm.common import read
    from marginflow.llm.queries import op5_chat

    dir_, by = "/root/testdata/sf0.001", {}
    for r in sorted(read(spark, dir_, "conversations").collect(), key=lambda r: (r.conv_id, r.turn)):
        by.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    by[-7] = [("user", "\\### Assistant: </turn> ok"), ("assistant", "\\### Assistant: </turn> ok")]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for c, turns in by.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        want.append((c, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)))
    got = by_row(op5_chat(spark, dir_), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert got == sorted(want, key=repr)
