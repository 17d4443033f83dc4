"""A worker of the pipeline's classifier holds small slices, whatever the batches it is given."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from forecourt.llm import quality_model


class Docs:
    """A table of one large batch that runs a function given to ``mapInArrow`` at once."""

    schema = None

    def __init__(self, batch: pa.RecordBatch):
        self.batch = batch

    def drop(self, *_):
        return self

    def mapInArrow(self, function, schema):
        return list(function(iter([self.batch])))


def test_the_verdict_is_given_in_small_slices(monkeypatch):
    seen = []

    def model(x: np.ndarray) -> np.ndarray:
        seen.append(len(x))
        return (x[:, 1] > 0).astype(float)  # any byte

    texts = ["a b " * 500 if i % 3 else "" for i in range(3000)]
    docs = Docs(pa.RecordBatch.from_pydict({"doc_id": list(range(3000)), "text": texts}))
    monkeypatch.setattr(quality_model, "with_statistics", lambda docs, carry: docs)
    monkeypatch.setattr(quality_model, "materialise", lambda df, tag: df)
    monkeypatch.setattr(quality_model, "quality_labels", lambda labels: labels)
    monkeypatch.setattr(quality_model, "train", lambda stats, labels: model)
    out = quality_model.keep_good(docs, None)
    assert sum(seen) == 3000 and max(seen) < 1000
    assert max(b.nbytes for b in out) < 1_100_000
    assert [i for b in out for i in b.column(0).to_pylist()] == [i for i in range(3000) if i % 3]


def test_matrices_are_built_of_few_rows():
    x = pa.RecordBatch.from_pydict({"x": list(range(2500))})
    parts = list(quality_model.row_sized(iter([x, x.slice(0, 0)]), quality_model.SLICE_ROWS))
    assert [p.num_rows for p in parts] == [1000, 1000, 500]
    assert pa.Table.from_batches(parts).column(0).to_pylist() == list(range(2500))
