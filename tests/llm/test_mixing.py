import random
from collections import defaultdict

import pytest

from pulsegrid.llm.mixing import Mix, mix, mix_counts


def targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Water-filling by handing excess on until no target is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, open_, rest = {}, set(order), share * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if rest * weight[s] / total > cap * sizes[s] + 1e-9}
        if not over:
            return out | {s: rest * weight[s] / total for s in open_}
        for s in over:
            out[s] = cap * sizes[s]
            rest -= out[s]
        open_ -= over
    return out


def check(rows, found):
    size = {r[0]: len((r[1] or "").encode().split()) for r in rows}
    sizes = defaultdict(int)
    for i, text, source in rows:
        sizes[source] += size[i]
    wanted, taken = targets(sizes), defaultdict(int)
    source = {r[0]: r[2] for r in rows}
    for r in found:
        assert (r.size, r.source_size) == (size[r.doc_id], sizes[source[r.doc_id]])
        assert r.target == pytest.approx(wanted[source[r.doc_id]])
        assert 0 <= r.taken <= 2 * r.size
        taken[source[r.doc_id]] += r.taken
    for s, goal in wanted.items():
        largest = max([size[i] for i in size if source[i] == s], default=0)
        assert abs(taken[s] - goal) <= max(1, largest / 2), s


def corpus(count=300):
    draw = random.Random(8)
    sources = ["a", "b", "é", None, "Z", "c"]
    return [(i, " ".join("w" for _ in range(int(draw.expovariate(1 / 40)))) or None,
             "a" if draw.random() < 0.35 else draw.choice(sources)) for i in range(count)]


def test_targets_and_words_taken(docs):
    rows = corpus()
    check(rows, mix_counts(docs(*rows)).collect())


@pytest.mark.parametrize("rows", [
    [(1, "a b c", "x")], [(1, "a", "x"), (2, "b c", None)], [(1, None, "x"), (2, "", "y")],
    [(1, "w " * 20_000, "x"), (2, "b", "y"), (3, None, "y")]])
def test_small_tables(docs, rows):
    check(rows, mix_counts(docs(*rows)).collect())


def test_repeated_rows_go_together_and_reruns_agree(docs):
    rows = corpus(60) + [(5, "w w w w", "a")] * 3
    first, second = (sorted(map(tuple, mix_counts(docs(*rows)).collect())) for _ in range(2))
    assert first == second
    assert len({r[4] for r in first if r[0] == 5 and r[1] == 4}) == 1


def test_mixed_rows_are_those_counted(docs):
    rows = corpus(120)
    frame = docs(*rows)
    out = mix(frame)
    assert out.columns == frame.columns
    counts = {r.doc_id: r for r in mix_counts(frame).collect()}
    times = defaultdict(int)
    for r in out.collect():
        times[r.doc_id] += 1
    assert all(times[i] * c.size == c.taken for i, c in counts.items())
    assert all(times[i] >= 1 for i, c in counts.items() if c.size == 0)


def test_other_settings_and_no_rows(docs):
    rows = corpus(80)
    found = mix_counts(docs(*rows), Mix(weights=(1,), share=0.5, cap=1.0)).collect()
    assert all(r.taken <= r.size for r in found)
    assert mix_counts(docs((1, "a")).limit(0)).count() == 0
    assert mix(docs((1, "a")).limit(0)).count() == 0
