import numpy as np
import pyarrow as pa
import pytest

from fleetgauge.llm.jaccard_join import _verify

SETS = [np.arange(start, start + 40, dtype=np.uint64) for start in (0, 1, 2)]


def links(*pairs):
    """Links a set has over the given (left, right) pairs of blocks, all sets being in block 0."""
    rows = [
        {"component": b"c", "set_key": bytes([at]) * 16, "copies": 1, "shingles": shingles.tobytes(), "block": 0,
         "left": left, "right": right}
        for left, right in pairs for at, shingles in enumerate(SETS)
    ]
    found: dict = {}
    for batch in _verify(iter([pa.RecordBatch.from_pylist(rows)]), 75):
        for row in batch.to_pylist():
            found[row["set_key"][0]] = found.get(row["set_key"][0], 0) + row["links"]
    return found


@pytest.mark.parametrize("pairs", [[(0, 0)], [(0, 0), (0, 1)], [(0, 0), (0, 1), (0, 2)]])
def test_a_pair_with_an_empty_right_block_adds_no_links(pairs):
    assert links(*pairs) == {0: 2, 1: 2, 2: 2}
