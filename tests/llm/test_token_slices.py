"""Texts are encoded slice by slice, so that an encoder's arrays don't grow with a batch."""

import numpy as np
import pyarrow as pa

from annotspark.llm import packing, tokens


def test_slices_are_whole_and_of_bounded_size():
    texts = ["a" * n for n in [*range(100), 5000, 0, 0, 7, 1000, 1000, 1]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])
    for cut in (batch, batch.slice(30)):
        parts = list(tokens.slices(cut, 1, 1000))
        assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([cut])) and len(parts) > 5
        for p in parts:
            size = [len(t) for t in p.column(1).to_pylist()]
            assert sum(size) < 2000 or sum(size) - max(size) < 1000
    assert [len(p) for p in tokens.slices(batch.slice(0, 0), 1)] == [0]


def test_encoders_take_slices_only(spark, monkeypatch):
    """The bytes an encoder sees at a time, said by a stand-in in place of its ids."""
    docs = spark.createDataFrame([(k, "word " * 2000) for k in range(1200)], "doc_id long, text string").coalesce(1)

    class Sizes:
        def encode(self, texts):
            import pyarrow.compute as pc

            n = len(texts)
            total = pc.sum(pc.binary_length(texts)).as_py()
            return np.arange(n + 1), np.full(n, total, dtype=np.uint32)

    monkeypatch.setattr(packing, "word_encoder", lambda *a: Sizes())
    run = {}

    class Rows:
        schema = docs.schema

        def select(self, *a):
            return self

        def mapInArrow(self, f, fields):
            run["f"] = f

    packing.token_pieces(Rows(), "none", 1, 4096)
    whole = docs.toArrow().combine_chunks().to_batches()
    assert [len(b) for b in whole] == [1200] and whole[0].column(1).nbytes > 2 * tokens.SLICE_BYTES
    out = list(run["f"](iter(whole)))
    assert len(out) == 3 and sum(len(b) for b in out) == 1200
