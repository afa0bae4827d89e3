"""Windows of conversations: read back, budgets, masks, repeated history."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pulsegrid.llm import chat_windows
from pulsegrid.llm.chat_windows import Budget, CONTROLS, END, START, escape, read_windows, unescape, windows

TURNS = "conv_id long, turn long, role string, text string"


@pytest.fixture
def turns(spark):
    def make(*rows):
        frame = spark.createDataFrame(list(rows), TURNS)
        clash = ["key", "block", "span", "own", "tokens", "upto", "system", "mask", "fresh", "piece"]
        return frame.select("*", *[F.lit(f"extra {c}").alias(c) for c in clash])

    return make


def ordered(rows):
    """Turns of each conversation in their order."""
    out = {}
    for c, t, role, text in rows:
        out.setdefault(c, []).append((-(2**63) if t is None else t, role or "", text or ""))
    return {c: sorted(v) for c, v in out.items()}


def read(made):
    out = {}
    for r in read_windows(made).orderBy("block", "span").collect():
        own, loss = out.setdefault(r.conv_id, ([], []))
        own += [(t.role, t.text) for t in r.turns]
        loss += r.loss
    return out


def check(rows, made):
    found = read(made)
    want = ordered(rows)
    assert set(found) == set(want)
    for c, list_ in want.items():
        assert found[c][0] == [(role, text) for _, role, text in list_], c
        assert found[c][1] == [text for _, role, text in list_ if role == "assistant"], c


def chats(count=40, longest=60, seed=4):
    draw = random.Random(seed)
    pieces = [*CONTROLS, "<\\s>", "[\\\\INST]", "<", "[", "\\", "\n", "é", "word", "ß x", "|im_end|>", "/INST]", "%0A", ""]
    for c in range(count):
        for t in range(draw.randint(1, longest)):
            role = "system" if t == 0 and c % 3 == 0 else draw.choice(["user", "assistant", "tool", "a\nb%"]) if c % 5 == 4 else ["user", "assistant"][t % 2]
            yield c, t, role, "".join(draw.choices([*pieces, " "], k=draw.randint(0, 60)))


def test_escape_is_undone_and_leaves_no_control(spark):
    draw = random.Random(7)
    pieces = ["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "|im_start|>", "|im_end|>", *CONTROLS, "x"]
    texts = ["".join(draw.choices(pieces, k=draw.randint(0, 8))) for _ in range(2000)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").select("text", escape(F.col("text")).alias("e"))
    for r in frame.select("text", "e", unescape(F.col("e")).alias("back")).collect():
        assert r.back == r.text and not any(c in r.e for c in CONTROLS)


@pytest.mark.parametrize("budget", [Budget(), Budget(40, 10), Budget(6, 2), Budget(30, 0)])
def test_round_trip(turns, budget):
    rows = list(chats())
    check(rows, windows(turns(*rows), budget))


def test_long_conversations_cross_blocks(turns, monkeypatch):
    monkeypatch.setattr(chat_windows, "BLOCK", 16)
    monkeypatch.setattr(chat_windows, "AHEAD", 4)
    rows = list(chats(8, 200, seed=11))
    made = windows(turns(*rows), Budget(60, 12))
    check(rows, made)
    later = [r for r in made.collect() if r.block > 0 and r.span == 1]
    assert later and any(r.n_context > 1 for r in later)


def test_windows_keep_budget_system_turn_and_history(turns):
    rows = [r for r in chats(30, 80, seed=5)]
    budget = Budget(60, 15)
    starts = {c: v[0] for c, v in ordered(rows).items()}
    for r in windows(turns(*rows), budget).collect():
        parts = r.text.split(START)[1:]
        assert all(p.endswith(END + "\n") for p in parts)
        roles = [p.split("\n", 1)[0] for p in parts]
        if starts[r.conv_id][1] == "system":
            assert roles[0] == "system" and roles.count("system") == 1
            parts = parts[1:] if r.n_context else parts
        context = r.n_context - (roles[0] == "system" and r.n_context > 0)

        def size(part):
            return len(part.split("\n", 1)[1][:-len(END) - 1].encode().split()) + 3

        sizes = [size(p) for p in parts]
        assert sum(sizes[:context]) <= budget.history
        fresh = sizes[context:]
        assert sum(fresh) <= budget.tokens - budget.history or len(fresh) == 1
        assert not any(mark in r.text[m.start:m.end] for m in r.mask for mark in (START, END))


@pytest.mark.parametrize("rows", [
    [(1, 0, "user", None)], [(None, 0, "user", "a"), (None, 1, "assistant", "b")], [(1, None, None, None), (1, 0, "assistant", "x")],
    [(1, 3, "user", "a"), (1, 3, "user", "a"), (1, 3, "assistant", "z"), (1, 3, "assistant", "z")],
    [(1, 0, "system", "s"), (1, 10**15, "assistant", "w " * 30_000), (1, 10**17, "user", "")], [(-1, -5, "assistant", "</s>")]])
def test_small_tables(turns, rows):
    check(rows, windows(turns(*rows)))


def test_no_rows(turns):
    assert windows(turns((1, 0, "user", "a")).limit(0)).count() == 0


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    found = {r.conv_id: r for r in entry.queries()["op13_chat_windows"](spark, sf_dir).collect()}
    want = ordered(rows)
    assert set(found) == set(want)
    for c, list_ in want.items():
        lines = "".join(f"{role}\n{text}\n" for _, role, text in list_)
        loss = "".join(text for _, role, text in list_ if role == "assistant")
        r = found[c]
        assert (r.n_turns, r.loss_chars) == (len(list_), len(loss))
        assert r.turns_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars >= len(lines)


def test_plan_has_no_python_and_one_exchange_of_texts(spark, sf_dir):
    plan = entry.queries()["op13_chat_windows"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
