"""What a Python worker holds beside the batch or shard that it was given."""

import tracemalloc

import numpy as np
import pyarrow as pa

from weekcast.llm import quality, wavelet

WORDS = "some plain words of a text that is long enough to weigh. "


def _peak(work):
    tracemalloc.start()
    try:
        got = work()
        return got, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def _batch(rows):
    return pa.RecordBatch.from_pydict({"key": list(range(rows)), "text": [f"{i} {WORDS * 20}" for i in range(rows)]})


def _trees():
    rng = np.random.default_rng(1)
    return quality.grow(rng.random((300, len(quality.FEATURES))), rng.integers(0, 2, 300).astype(float), trees=5)


def test_accepted_rows_are_those_of_the_whole_batch():
    trees, batch = _trees(), _batch(700)
    score = trees.score(np.array([quality.statistics(t) for t in batch.column(1).to_pylist()]))
    cut = float(np.median(score))
    got = pa.Table.from_batches(quality._accepted([batch, batch.slice(0, 0)], 1, trees, cut), batch.schema)
    assert got == pa.Table.from_batches([batch.filter(pa.array(score >= cut))])


def test_texts_are_held_a_slice_at_a_time():
    trees, batch = _trees(), _batch(2000)
    for run in (lambda: quality._accepted([batch], 1, trees, 0.0), lambda: quality._describe([batch])):
        n, peak = _peak(lambda run=run: sum(b.num_rows for b in run()))
        assert n == 2000
        # all 2,000 texts take 2.4 MB as Python strings
        assert peak < 2_400_000


def test_planes_are_built_and_read_without_a_position_per_id():
    ids = np.random.default_rng(0).integers(0, 50_000, 1 << 20).astype(np.uint32)
    matrix, built = _peak(lambda: wavelet.WaveletMatrix.build(ids))
    back, read = _peak(matrix.decode)
    assert (back == ids).all()
    assert max(built, read) < 12 * len(ids)
