import random
import zlib

import numpy as np

from pulsegrid.llm.quality import describe, keep_good, score

def corpus(count=400):
    draw = random.Random(3)
    words = ["the", "of", "and", "river", "stone", "garden", "walked", "slowly", "morning", "between", "houses"]
    rows, labels = [], []
    for i in range(count):
        bad = i % 8 == 0
        text = " ".join(draw.choice(words) + ("#$%"[draw.randrange(3)] * 3 if bad else "") for _ in range(draw.randrange(20, 120)))
        rows.append((i, text + ("" if bad else ".")))
        if draw.random() < 0.6:
            labels.append((i, 0 if bad else 1))
    return rows, labels


def labelled(spark, labels):
    return spark.createDataFrame([(i, q, 0) for i, q in labels], "doc_id long, quality int, toxic int")


def test_held_out_documents_are_told_apart(spark, docs):
    rows, labels = corpus()
    found = {r.doc_id: r for r in score(docs(*rows), labelled(spark, labels)).collect()}
    held = [(found[i].predicted, q) for i, q in labels if found[i].held_out]
    assert len(held) > 30 and np.mean([p == q for p, q in held]) > 0.9
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _ in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found.values())


def test_held_out_labels_are_not_read(spark, docs):
    rows, labels = corpus(120)
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q) for i, q in labels]
    a, b = (sorted((r.doc_id, r.score) for r in score(docs(*rows), labelled(spark, x)).collect()) for x in (labels, turned))
    assert a == b


def test_odd_rows(spark, docs):
    rows, labels = corpus(100)
    odd = [(1000, None), (1001, ""), (1002, "x" * 100_000), (1003, "\n\n"), (1, rows[1][1]), (None, "the river")]
    found = score(docs(*rows, *odd), labelled(spark, labels + [(None, 1), (2, None)])).collect()
    assert len(found) == 106 and all(0 <= r.score <= 1 for r in found)
    same = {r.score for r in found if r.doc_id == 1}
    assert len(same) == 1


def test_without_positives_or_documents(spark, docs):
    none = labelled(spark, []).limit(0)
    assert {r.score for r in score(docs((1, "a"), (2, "b")), none).collect()} == {1.0}
    assert keep_good(docs((1, "a"), (2, "b")), none).count() == 2
    assert score(docs((1, "a")).limit(0), none).count() == 0


def test_filter_keeps_rows_whole(spark, docs):
    rows, labels = corpus()
    frame = docs(*rows)
    kept = keep_good(frame, labelled(spark, labels))
    assert kept.schema == frame.schema
    assert {r.doc_id for r in kept.collect()} == {
        r.doc_id for r in score(frame, labelled(spark, labels)).collect() if r.predicted}


def test_descriptions_are_finite():
    for text in (b"", b" ", b"a", "é".encode(), b"|" * 10, b"A B\nC"):
        assert np.isfinite(describe(text)).all()
