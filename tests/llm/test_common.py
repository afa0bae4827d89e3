"""Batches handed on in slices."""

import pyarrow as pa

from pulsegrid.llm import near_dedup, quality
from pulsegrid.llm.common import TEXTS, per_batch


def test_batches_come_in_slices_of_bounded_rows():
    seen = []

    def work(batch):
        seen.append(batch.num_rows)
        return batch

    batches = [pa.RecordBatch.from_pydict({"i": list(range(n))}) for n in (7, 0, 3)]
    out = list(per_batch(work, 3)(iter(batches)))
    assert seen == [3, 3, 1, 3] and pa.Table.from_batches(out)["i"].to_pylist() == [*range(7), *range(3)]
    assert [b.num_rows for b in per_batch(lambda b: b)(iter(batches))] == [7, 3]


def test_operators_on_texts_take_few_of_a_batch_at_a_time(docs, monkeypatch):
    """A batch of Arrow holds up to 10,000 texts; a worker that decodes them all at once needs its memory several times over."""
    frame, works = docs((1, "a b c")), []
    monkeypatch.setattr(type(frame), "mapInArrow", lambda self, work, schema: works.append(work) or self)
    monkeypatch.setattr(quality, "fit_quality", lambda *a, **b: quality.Model([[] for _ in quality.FEATURES]))
    rows = [f"text number {i} of some words" for i in range(3 * TEXTS)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(rows))), "rep": list(range(len(rows))), "text": rows,
                                        "utf8": [r.encode() for r in rows]})
    quality.descriptions(frame)
    near_dedup.signatures(frame, near_dedup.NearDedup())
    near_dedup._more(frame.selectExpr("doc_id AS rep", "CAST(text AS BINARY) AS utf8"), near_dedup.NearDedup())
    for work in works:
        assert [b.num_rows for b in work(iter([batch]))] == [TEXTS] * 3
    quality.keep_good(frame, frame, threshold=0.0)
    texts = batch.select(["doc_id", "text"])
    assert [b.num_rows for b in works[-1](iter([texts]))] == [TEXTS] * 3
