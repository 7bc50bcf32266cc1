import numpy as np
import pyarrow as pa

from storetally.llm import texts as x


def test_portions_hold_all_rows():
    batches = [pa.RecordBatch.from_arrays([pa.array(range(n))], ["n"]) for n in (1200, 0, 3)]
    found = list(x.portions(iter(batches)))
    assert [one.num_rows for one in found] == [500, 500, 200, 3]
    assert [n for one in found for n in one.column(0).to_pylist()] == [*range(1200), *range(3)]


def test_a_worker_keeps_little_for_hashing():
    assert x._POWERS.nbytes + x._INVERSES.nbytes <= 8 << 20


def test_hashes_do_not_depend_on_slices():
    words = [f"w{i % 9973}" for i in range(120_000)]
    whole = " ".join(words)
    assert len(whole) > 2 * x.SLICE_BYTES
    rows = pa.array([whole, None, *words[:20_000], ""])
    found = [x.word_hashes(data, offsets) for _, data, offsets in x.slices(rows)]
    hashes = np.concatenate([one for one, _ in found])
    assert len(found) > 1 and len(hashes) == len(words) + 20_000
    assert (hashes[: len(words)][:20_000] == hashes[len(words) :]).all()
    assert len(np.unique(hashes)) == 9973
