"""Chat windows: read back exactly, within the budget, every target once."""

import hashlib
import random
import re

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from paytrail.llm import chat_format as chat
from paytrail.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string, window string, turns string"
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS] ", " [/SYS]", "[OUT] ", "[ROLE] ", " [TEXT] ", " [/ROLE]", "<\\s>", "[\\\\INST]", "[", "<", "\\"]


def cost(text):
    return 2 + len(re.findall(r"[^\W\d_]{1,5}|\d{1,3}|[^\t-\r \w]|_", text))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def made(spark, table, rows, **sizes):
    given = table([(*r, "clash", "clash") for r in rows], SCHEMA)
    windows = chat.windows(given, **sizes)
    digests = sorted(map(tuple, chat.read_back(windows).select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"
    ).collect()), key=repr)
    parts = windows.select(
        "conv_id", "window", "whole", "repeated", "text", chat.read_turns(F.col("text")).alias("turns"),
        chat.read_loss(F.col("text"), F.col("loss")).alias("learned"),
    ).orderBy("conv_id", "window").collect()
    return digests, parts


def expected(rows):
    """Digests of conversations whose turns have unlike numbers."""
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, []).append((turn, role or "", text or ""))
    result = []
    for conv, said in found.items():
        said.sort(key=lambda t: (t[0] is not None, t[0] or 0))
        learned = "".join(t for _, r, t in said if r == "assistant")
        result.append((conv, len(said), sha("".join(f"{r}\n{t}\n" for _, r, t in said)), len(learned), sha(learned)))
    return sorted(result, key=repr)


def conversation(rng, conv, turns, system=False):
    roles = ["system"] * system + ["user", "assistant"] * turns
    return [
        (conv, i, role, " ".join(rng.choice([*CONTROLS, "word", "Wörter", "日本", "12345", "\n"]) for _ in range(rng.randint(0, 12))))
        for i, role in enumerate(roles)
    ]


@pytest.fixture(scope="module")
def talk():
    rng = random.Random(11)
    return [row for conv in range(30) for row in conversation(rng, conv, rng.randint(1, 20), conv % 2 == 0)]


def test_every_turn_is_read_back_and_every_target_once(spark, table, talk):
    digests, parts = made(spark, table, talk, budget=400, history=60)
    assert digests == expected(talk)
    assert any(not p.whole for p in parts) and any(p.whole for p in parts)


def test_windows_keep_the_system_turn_repeat_history_and_hold_the_budget(spark, table, talk):
    _, parts = made(spark, table, talk, budget=400, history=60)
    by_conv = {}
    for conv, _, role, text in talk:
        by_conv.setdefault(conv, []).append((role, text))
    repeats = 0
    for conv, said in by_conv.items():
        at = 0
        for part in (p for p in parts if p.conv_id == conv):
            turns = [tuple(t) for t in part.turns]
            assert part.window == sum(cost(t) for _, t in said[:at])
            old, new = turns[: part.repeated], turns[part.repeated :]
            assert new and new == said[at : at + len(new)]
            if at and said[0][0] == "system":
                assert old[0] == said[0]
                old = old[1:]
            assert old == said[at - len(old) : at] and sum(cost(t) for _, t in old) <= 60
            assert sum(cost(t) for _, t in turns) <= 400
            assert part.learned == "".join(t for r, t in new if r == "assistant")
            repeats += len(old)
            at += len(new)
        assert at == len(said)
    assert repeats > 20


def test_nulls_other_roles_ties_repeats_and_empty_texts(spark, table):
    rows = [
        (1, None, "user", "no number"), (1, 0, None, None), (1, 1, "tool [TEXT] x", "a [TEXT] b"), (1, 2, "assistant", ""),
        (1, 3, "assistant", None), (None, 0, "user", "lost"), (None, 1, "assistant", "found </s>"), (2, 0, "assistant", " spaces "),
        (3, 0, "system", ""), (4, 5, "Assistant", "\\"),
    ]
    assert made(spark, table, rows)[0] == expected(rows)
    again = [(7, 0, "user", "same")] * 3 + [(7, 0, "assistant", "tie")] * 2
    (digest,), (part,) = made(spark, table, again)
    assert digest[1] == 5 and digest[3:] == (6, sha("tietie")) and len(part.turns) == 5


def test_long_turns_are_never_cut(spark, table):
    rows = [(1, 0, "system", "s " * 3000), (1, 1, "user", "hi"), (1, 2, "assistant", "long [/INST] " * 100_000), (1, 3, "user", "and"), (1, 4, "assistant", "end")]
    digests, parts = made(spark, table, rows)
    assert digests == expected(rows)
    assert all(p.turns[0].role == "system" for p in parts) and [p.repeated > 0 for p in parts] == [False] + [True] * (len(parts) - 1)


def test_one_long_conversation_has_many_windows(spark, table):
    rng = random.Random(2)
    rows = conversation(rng, 5, 1500, True) + conversation(rng, 6, 2)
    digests, parts = made(spark, table, rows, budget=300, history=50)
    assert digests == expected(rows) and len(parts) > 70
    assert all(sum(cost(t.text) for t in p.turns) <= 300 for p in parts)


def test_an_empty_table_has_no_windows(spark, table):
    assert made(spark, table, []) == ([], [])


def test_no_python_runs(spark, table, talk):
    given = table([(*r, "", "") for r in talk[:9]], SCHEMA)
    plan = chat.read_back(chat.windows(given))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_escapes_are_reversible_and_leave_no_control_string(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice([*CONTROLS, "a", "/", "s>", "INST]", "\n"]) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", chat.escape(F.col("t")))
    back = rows.withColumn("b", chat.unescape(F.col("e"))).collect()
    assert all(r.b == r.t for r in back)
    assert not any(re.search(r"<s>|</s>|\[/?(INST|SYS|ROLE)\]|\[(OUT|TEXT)\]", r.e) for r in back)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_the_query_equals_its_sql(spark, scale):
    name = "op13_budgeted_windows"
    folder = f"/root/testdata/{scale}"
    assert differences(connect(folder), queries.ORACLES[name], queries.QUERIES[name](spark, folder)) == []
