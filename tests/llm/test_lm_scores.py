import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pulsegrid.llm import lm_scores as module
from pulsegrid.llm.common import all_words, words
from pulsegrid.llm.lm_scores import LmSettings, lm_scores
from pulsegrid.llm.recurrent import Recurrent

SMALL = LmSettings(vocabulary=30, frequent=60, hidden=8, fit_docs=200, epochs=4)


def base(rows):
    """Base score, tokens, known tokens and training tokens of every document."""
    tokens = {i: [*(t or "").encode().lower().split(), "end"] for i, t in rows}
    counts = Counter()
    for i, found in tokens.items():
        if zlib.crc32(str(i).encode()) % 10:
            counts.update(found)
    n, v = sum(counts.values()), len(counts)
    return {i: (sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in found), len(found),
                sum(counts[w] > 0 for w in found), n) for i, found in tokens.items()}


def two_languages(count=240):
    draw = random.Random(2)
    sides = [[f"a{i}" for i in range(40)], [f"b{i}" for i in range(40)]]
    return [(i, " ".join(draw.choice(sides[i % 2]) for _ in range(draw.randrange(5, 60)))) for i in range(count)]


def test_scores(docs):
    rows = two_languages() + [(900, None), (901, ""), (902, "never seen before"), (903, "a1 " * 3000)]
    found = {r.doc_id: r for r in lm_scores(docs(*rows), SMALL).collect()}
    for i, (score, n_tokens, n_known, n) in base(rows).items():
        r = found[i]
        assert r.base_score == pytest.approx(score, rel=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n_tokens, n_known, n)
        assert r.held_out == (zlib.crc32(str(i).encode()) % 10 == 0)
    held = [r for i, r in found.items() if r.held_out and i < 900]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # it has learnt the two languages
    assert all(math.isfinite(r.score) and r.score < 0 for r in found.values())


def test_odd_tables(docs):
    assert lm_scores(docs((1, "a")).limit(0), SMALL).count() == 0
    only_held_out = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    found = lm_scores(docs(*[(i, "a b") for i in only_held_out]), SMALL).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in found)
    again = lm_scores(docs((1, "a b"), (1, "a b"), (None, "a b")), SMALL).collect()
    assert len(again) == 3 and len({r.base_score for r in again}) == 1


def test_probabilities_sum_to_one_and_slopes_are_those_of_the_loss():
    model = Recurrent(np.arange(1, 11.0) ** 2, 4)
    model._set(np.float64)
    states = np.random.default_rng(0).normal(size=(1, 4))
    assert np.exp(model.log_prob(np.repeat(states, 10, 0), np.arange(10))).sum() == pytest.approx(1)
    inputs, targets = np.array([[9, 1, 2, 9, 3], [9, 4, 5, 6, 7]]), np.array([[1, 2, 9, 3, 0], [4, 5, 6, 7, 8]])

    def loss():
        state, total = np.zeros((2, 4)), 0.0
        for t in range(5):
            state = np.where((inputs[:, t] == 9)[:, None], 0, state)
            state, _ = model.step(inputs[:, t], state)
            total -= model.log_prob(state, targets[:, t]).sum()
        return total / 10

    slopes, _ = model._slopes(inputs, targets, np.zeros((2, 4)), 9)
    for name in model.NAMES:
        values = getattr(model, name)
        for at in [tuple(n // 2 for n in values.shape), tuple(n - 1 for n in values.shape)]:
            kept = values[at]
            values[at] = kept + 1e-5
            up = loss()
            values[at] = kept - 1e-5
            down = loss()
            values[at] = kept
            assert slopes[name][at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-9)


def test_state_is_carried_through_the_text():
    model = Recurrent(np.ones(12), 4)
    texts = [np.array([1, 2, 3] * 40), np.array([], np.int64), np.array([5])]
    whole = model.score(texts, 11)
    for text, got in zip(texts, whole):
        state, before, total = np.zeros((1, 4), np.float32), np.array([11]), 0.0
        for token in [*text, 11]:
            state, _ = model.step(before, state)
            before = np.array([token])
            total += float(model.log_prob(state, before)[0])
        assert got == pytest.approx(total, rel=1e-4)


def test_every_training_token_is_learnt_from_in_each_epoch(docs, monkeypatch):
    learnt, fit = [], module.fit
    monkeypatch.setattr(module, "fit", lambda *given: learnt.append(fit(*given)))
    rows = [(i, f"w{i % 7} of " * 5) for i in range(300)] + [(300, "long " * 30_000), (301, None), (302, "")]
    found = lm_scores(docs(*rows), LmSettings(vocabulary=10, frequent=20, hidden=4, fit_docs=50, epochs=2)).collect()
    assert zlib.crc32(b"300") % 10 and len(found) == 303
    assert learnt == [2 * found[0].train_tokens]


def test_steps_held_back_are_not_added_up_again(monkeypatch):
    from pulsegrid.llm import recurrent

    calls = []
    monkeypatch.setattr(recurrent, "sum", lambda items: calls.append(len(items)), raising=False)  # quadratic in a long text, before
    assert np.isfinite(Recurrent(np.ones(12), 4).score([np.array([1, 2, 3] * 400)], 11)).all() and not calls


def test_words_of_a_column_are_those_of_each_text():
    texts = [b" a\x0bB\x1cc\xc2\xa0d  \r\n", b"", b"  ", "\u00c0\u00c9 Z\u0130".encode(), b"one two"]
    found, starts = all_words(pa.array([b"left out", *texts], pa.binary())[1:])
    assert [found.to_pylist()[a:b] for a, b in zip(starts, starts[1:])] == [words(t) for t in texts]


def test_texts_scored_in_groups_and_words_counted_in_parts(spark, docs, monkeypatch):
    draw = random.Random(4)
    model = Recurrent(np.arange(1, 13.0), 4)
    texts = [np.array([draw.randrange(11) for _ in range(draw.randrange(40))], np.int64) for _ in range(50)]
    whole = model.score(texts, 11)
    monkeypatch.setattr(Recurrent, "TOGETHER", 7)  # all texts advanced together, before
    assert model.score(texts, 11) == pytest.approx(whole, rel=1e-5)
    rows = [(i, f"W{i % 900} w{i % 7}  of ") for i in range(5000)] + [(5000, None), (5001, " ")]
    assert {bytes(r.word): r.n for r in module.word_counts(docs(*rows)).collect()} == Counter(w for _, t in rows for w in (t or "").lower().encode().split())
