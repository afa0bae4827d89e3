import hashlib

import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import fingerprints as spots
from pulsegrid.llm.fingerprints import fingerprints, likeness


def edited(rows):
    """Edited text of every document, by plain slicing in order of id and text."""
    ordered = sorted(((i, t or "") for i, t in rows if i is not None))
    out = []
    for k, (i, text) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        quarter = len(text) // 4
        out.append((i, len(text), hashlib.sha256((text[:len(text) - quarter] + after[:quarter]).encode()).hexdigest()))
    return sorted(out)


TEXT = "The old house of the miller stands by the river and the water runs to the mill for a day or two. " * 3


def test_edited_texts(docs, monkeypatch):
    monkeypatch.setattr(spots, "BLOCK", 2)
    rows = [(i * 97 - 300, TEXT[i % 11:] + str(i)) for i in range(40)] + [(5, None), (7, ""), (9, "é😀" * 50), (9, "zz"), (None, "lost")]
    found = fingerprints(docs(*rows)).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == edited(rows)


def test_equal_texts_have_equal_fingerprints_and_edits_stay_near(docs):
    found = {r.doc_id: r for r in fingerprints(docs((1, TEXT), (2, "Quite other words about nothing at all in here"), (3, TEXT))).collect()}
    assert found[1].fingerprint == found[3].fingerprint != found[2].fingerprint
    assert found[1].near_edited > 0.3 > found[1].near_next
    assert found[3].near_next == 1.0  # the last is followed by the first


@pytest.mark.parametrize("rows, count", [([], 0), ([(1, "the only text of all")], 1), ([(1, None), (2, "")], 2)])
def test_few_rows(docs, rows, count):
    found = fingerprints(docs(*rows) if rows else docs((1, "a")).limit(0)).collect()
    assert len(found) == count and all(r.near_next == 1.0 for r in found)


def test_texts_without_common_words_are_compared_too(docs):
    noise = " ".join(f"{chr(97 + i % 26)}{i}x" for i in range(80))
    found = {r.doc_id: r for r in fingerprints(docs((1, noise), (2, TEXT))).collect()}
    assert found[1].fingerprint and found[1].near_edited > 0.4 and found[1].near_next == 0.0


def test_likeness(spark):
    cases = [([1, 2, 3, 4], [3, 4, 5], 0.4), ([], [], 1.0), ([1], [], 0.0), ([1], list(range(1, 31)), 1 / 30)]
    frame = spark.createDataFrame([(a, b) for a, b, _ in cases], "a array<int>, b array<int>")
    assert [r[0] for r in frame.select(likeness(F.col("a"), F.col("b"))).collect()] == [c for *_, c in cases]


def test_no_python_in_the_plan(docs):
    plan = fingerprints(docs((1, "a")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
