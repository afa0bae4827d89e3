import random

import numpy as np

from pulsegrid.llm.near_dedup import NearDedup, keep_first, least_matches, near_duplicates, shingles

FOUR = NearDedup(width=4)


def brute(rows, width=4, similarity=80):
    """Component of every document by comparing all pairs of plain shingle sets."""
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= similarity * (len(sets[a]) + len(sets[b]) - both):
                a1, b1 = sorted((top(a), top(b)))
                root[b1] = a1
    return {i: (len(sets[i]), top(i)) for i in sets}


def result(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


def variants(count, seed):
    """Copies, edited copies and copies of edited copies of a few texts."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    bases = [[draw.choice(vocabulary) for _ in range(120)] for _ in range(4)]
    rows = []
    for i in range(count):
        text = list(draw.choice(bases))
        for _ in range(draw.choice([0, 1, 2, 3, 5, 8])):
            text[draw.randrange(len(text))] = draw.choice(vocabulary)
        if draw.random() < 0.2:
            bases.append(text)
        rows.append((i * 3, " ".join(text)))
    return rows


def test_components_equal_those_of_all_pairs(spark, docs):
    rows = variants(150, 1) + [(1000, None), (1001, ""), (1002, " \n"), (1003, "One two"), (1004, "one TWO"), (1005, "x" * 50_000)]
    found = near_duplicates(docs(*rows), FOUR)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert result(found) == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found.collect())


def test_small_blocks_lose_no_link(spark, docs):
    rows = variants(120, 2)
    assert result(near_duplicates(docs(*rows), NearDedup(width=4, block=8))) == brute(rows)


def test_repeated_and_missing_ids(spark, docs):
    text = " ".join(f"w{i}" for i in range(30))
    found = near_duplicates(docs((5, text), (5, text), (9, text), (None, text)), FOUR)
    assert sorted((r.doc_id, r.component_id) for r in found.collect()) == [(5, 5), (5, 5), (9, 5)]
    kept = keep_first(docs((5, text), (5, text), (9, text), (None, text), (7, "other words here now")))
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 5, 7]
    assert "size" in kept.columns


def test_empty_table(spark, docs):
    empty = docs((1, "a")).limit(0)
    assert near_duplicates(empty, FOUR).count() == 0
    assert keep_first(empty).count() == 0


def test_words_are_cut_at_ascii_blanks_only():
    assert len(shingles("A B c\td\x0be".encode(), 1)) == 4
    assert np.array_equal(shingles("ÄB c".encode(), 1), shingles("Äb C".encode(), 1))


def test_posterior_bounds_rise_with_the_values_compared():
    bounds = least_matches(NearDedup())
    assert [n for n, _ in bounds] == [32, 64, 96, 128, 160]
    assert all(a < b for (_, a), (_, b) in zip(bounds, bounds[1:])) and bounds[-1][1] < 0.8 * 160
