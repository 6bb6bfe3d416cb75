import bisect
import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fleetgauge.llm.packing import CapacityTree, best_fit_plan, pack, sequences


def placed_by(plan):
    found = defaultdict(list)
    for length, start, stop, first, per_bin, filled in plan:
        for rank in range(start, stop):
            nth = rank - start
            found[first + nth // per_bin].append((filled + nth % per_bin * length, length))
    return found


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120), st.integers(40, 60))
def test_plan_is_best_fit_decreasing(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, length)
        room = rooms.pop(at) if at < len(rooms) else capacity
        bisect.insort(rooms, room - length)
    found = placed_by(best_fit_plan(Counter(lengths).items(), capacity))
    assert sorted(capacity - sum(n for _, n in parts) for parts in found.values()) == rooms
    assert sum(map(len, found.values())) == len(lengths)
    for parts in found.values():
        ends = 0
        for offset, length in sorted(parts):
            assert offset == ends
            ends += length


def test_tree_finds_the_tightest():
    tree = CapacityTree(10)
    assert tree.tightest(1) is None
    for room in (3, 7, 10):
        tree.add(room, 1)
    assert [tree.tightest(n) for n in (1, 3, 4, 8)] == [3, 3, 7, 10]
    tree.add(10, -1)
    assert tree.tightest(8) is None


def test_pieces_of_odd_rows(odd, vocabulary):
    path, capacity = vocabulary("byte_bpe_50k.json"), 64
    library = Tokenizer.from_file(path)
    placed = pack(odd, path, 0, capacity, with_ids=True)
    rows = placed.collect()
    wanted = Counter()
    for row in odd.collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids + [0]
        head = len(ids) % capacity or min(len(ids), capacity)
        starts = [0, *range(head, len(ids), capacity)]
        for piece, (start, stop) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            raw = np.array(ids[start:stop], "<u4").tobytes()
            wanted[row.doc_id, piece, start, stop - start, zlib.crc32(raw)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    by_sequence = defaultdict(list)
    for row in rows:
        by_sequence[row.sequence_id].append((row.offset, row.length, bytes(row.ids)))
    made = {r.sequence_id: (r.length, bytes(r.ids)) for r in sequences(placed).collect()}
    for sequence, parts in by_sequence.items():
        ends = 0
        for offset, length, _ in sorted(parts):
            assert offset == ends
            ends += length
        assert ends <= capacity and made[sequence] == (ends, b"".join(raw for *_, raw in sorted(parts)))
    assert pack(odd.limit(0), path, 0, capacity).isEmpty()
