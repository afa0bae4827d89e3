"""Filter orders against running every order over the documents."""

import random
from collections import Counter
from itertools import permutations

import pytest

from pulsegrid.llm.filter_audit import audit, order_steps, survivors

LABELS = "doc_id long, quality int, toxic int"


def fails(rows):
    """Per row the letters it fails, filter by filter on the whole texts."""
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    out = []
    for i, text, _ in rows:
        text = text or ""
        words = text.encode().split()
        out.append({"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
                    "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text), "D": any(c in "#$%&*|" for c in text),
                    "E": i is not None and least[text] < i})
    return out


def plain(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    failing, out = fails(rows), {}
    for part in {r[2] or "" for r in rows}:
        mine = [(r[0], f) for r, f in zip(rows, failing) if (r[2] or "") == part]
        total = Counter()
        for order in permutations("ABCDE"):
            alive = list(range(len(mine)))
            for step, letter in enumerate(order, 1):
                gone = [k for k in alive if mine[k][1][letter]]
                alive = [k for k in alive if not mine[k][1][letter]]
                all_fail = sum(f[letter] for _, f in mine)
                only = sum(f[letter] and sum(f.values()) == 1 for _, f in mine)
                out[part, "".join(order), step] = [len(alive), len(gone), all_fail - len(gone), only,
                                                   sum(mine[k][0] in good for k in gone), sum(mine[k][0] in toxic for k in gone)]
                total[letter] += len(gone)
        for key in [k for k in out if k[0] == part]:
            out[key].append(total[key[1][key[2] - 1]])
    return out


def check(spark, docs, rows, labels):
    found = audit(docs(*rows), spark.createDataFrame(labels, LABELS)).collect()
    have = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
            for r in found}
    assert len(have) == len(found) and have == plain(rows, labels)


def corpus(count=250):
    draw = random.Random(5)
    words = ["alpha", "beta", "Gamma", "DELTA", "é", "x|y", "50%", *[f"w{i}" for i in range(60)]]
    pool = [None, "", "same", "w " * 60, "A" * 5000, " ".join(f"u{i}" for i in range(20_000))]
    for i in range(count):
        text = draw.choice(pool) if draw.random() < 0.4 else " ".join(draw.choices(words[draw.choice([0, 7]):], k=draw.randint(0, 120)))
        yield draw.choice([i, i, i, i % 7, None]), text, draw.choice(["a", "b", "", None])


def test_all_orders(spark, docs):
    rows = list(corpus())
    draw = random.Random(6)
    labels = [(draw.choice([i, None]), draw.choice([0, 1, None]), draw.choice([0, 1])) for i in range(250) for _ in range(draw.randint(0, 2))]
    check(spark, docs, rows, labels)


@pytest.mark.parametrize("rows", [
    [(1, None, None)], [(1, "a", "s")], [(2, "a", "s"), (1, "a", "t"), (2, "a", "s")], [(None, "a", "s")] * 3,
    [(1, "a # b", "s"), (2, "W " * 70, "s")]])
def test_small_tables(spark, docs, rows):
    check(spark, docs, rows, [(1, 1, 1), (1, 0, 0)])


def test_no_rows(spark, docs):
    assert audit(docs((1, "a")).limit(0), spark.createDataFrame([], LABELS)).count() == 0


def test_gray_walk_agrees_with_counting():
    draw = random.Random(2)
    cells = [{"mask": m, "n": draw.randint(0, 9), "good": draw.randint(0, 3), "toxic": draw.randint(0, 3)} for m in range(32)]
    for subset, state in enumerate(survivors(cells)):
        assert state == tuple(sum(c[k] for c in cells if not c["mask"] & subset) for k in ("n", "good", "toxic"))
    assert len(list(order_steps("p", cells))) == 600
