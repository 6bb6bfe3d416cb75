"""Near-duplicate documents by a grouped prefix join on word shingles.

Two sets whose Jaccard similarity reaches the threshold share a shingle among the first few of each, the
prefix, in any order that is common to all; rare shingles come first. The work goes in five passes:

1. Every text is reduced to a digest of its shingle set, and the first shingles by hash of every set, more than a
   prefix, are dealt out by value. A set that can be similar to another shares a certain share of them with some set;
   those that do not are done with. Nothing in this pass depends on a sketch or on the corpus's size.
2. The other sets are made again, one row for all copies, and all their shingles are counted by value. Each set learns
   how often its shared shingles occur, and so its prefix in the order of frequency. Sets of equal size
   and prefix become one group.
3. Groups' prefix shingles are dealt out by value. Groups that share one and are of comparable size are
   linked in a chain, first within a task and then across tasks, so a shingle that a third of all groups hold
   sends one row per task and size range. The chains' components hold every pair that can be similar.
4. Within a component, blocks of bounded size meet in pairs. There group pairs are filtered by size and shared
   prefix, and the members of the remaining ones are expanded and verified exactly.
5. The components of the verified links are the answer.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.batches import Remembered, map_batches, text_slices, texts_of
from fleetgauge.llm.components import connected
from fleetgauge.session import new_scratch_path

SHINGLE_WORDS = 5
PERCENT = 75
#: Percent of a set that the first pass deals out beyond what may be missing in a similar one.
BEYOND = 15
#: Shingles, or sets, that a task gathers to a chunk before it deals them out.
CHUNK_SHINGLES = 1 << 20
CHUNK_SETS = 60_000
#: Shingles dealt to a part, about.
PART_SHINGLES = 1 << 19
#: Bits for each set that is made again, in the broadcast map that says which rows these come from. Beyond the
#: most bits (64 MB; some 50 million such sets) the map passes more rows, which the join after it drops.
MAP_BITS_A_SET = 16
MOST_MAP_BITS = 1 << 29
MAP_PARTS = 64
#: Shingles in all sets of a block of the fourth pass, about.
BLOCK_SHINGLES = 1 << 20
#: Words whose hashes a task remembers, and the bytes of the longest of them.
REMEMBERED = 400_000
LONGEST_REMEMBERED = 64

_MIX = np.uint64(0x9E3779B97F4A7C15)


_hashes = Remembered(xxhash.xxh3_64_intdigest, REMEMBERED, LONGEST_REMEMBERED)


def shingle_set(text: str, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text, A to Z in lower case.

    A text with fewer words has its whole sequence as one shingle, a text without words has none.
    """
    found = text.encode().lower().split()  # bytes: A to Z, and white space as the ASCII has it
    if not found:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))
    length = min(words, len(found))
    value = hashed[: len(found) - length + 1] + np.uint64(length)
    for at in range(1, length):
        value = (value ^ (value >> np.uint64(29))) * _MIX + hashed[at : len(found) - length + 1 + at]
    value = (value ^ (value >> np.uint64(32))) * _MIX
    return np.unique(value ^ (value >> np.uint64(29)))


def _key(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


# --- dealing shingles out by value ------------------------------------------------------------

_DEALT = (
    "doc_id long, text_hash long, n_shingles long, set_key binary, "  # a document
    "part int, chunk long, keys binary, sizes binary, "  # a chunk's sets
    "owners binary, tokens binary, counts binary"  # shingles of a part, by set of the chunk; counts in answers
)
_DEALT_ARROW = pa.schema(
    [("doc_id", "int64"), ("text_hash", "int64"), ("n_shingles", "int64"), ("set_key", "binary"), ("part", "int32"),
     ("chunk", "int64"), *((name, "binary") for name in ("keys", "sizes", "owners", "tokens", "counts"))]
)


class _Chunk:
    """Sets of a task, gathered until their shingles are dealt out as one row for each part.

    A part keeps 32 bits of a shingle: a clash there makes two shingles look like one, which can add a candidate
    and never loses one.
    """

    def __init__(self, parts: int):
        self.parts, self.number = parts, TaskContext.get().partitionId() << 32
        self._clear()

    def _clear(self) -> None:
        self.keys, self.sizes, self.tokens, self.held = [], [], [], 0

    def add(self, key: bytes, size: int, tokens: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.keys.append(key)
        self.sizes.append(size)
        self.tokens.append(tokens)
        self.held += len(tokens)
        if self.held >= CHUNK_SHINGLES or len(self.keys) >= CHUNK_SETS:
            yield from self.deal()

    def deal(self) -> Iterator[pa.RecordBatch]:
        if not self.keys:
            return
        tokens = np.concatenate(self.tokens)
        owner = np.repeat(np.arange(len(self.keys), dtype=np.uint16), [len(part) for part in self.tokens])
        part = ((tokens >> np.uint64(32)) % np.uint64(self.parts)).astype(np.uint16 if self.parts <= 1 << 16 else np.int64)
        order = np.argsort(part, kind="stable")  # owners ascend within a part
        part, owner, low = part[order], owner[order], tokens[order].astype(np.uint32)
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        rows = [
            {
                "part": int(part[start]), "chunk": self.number,
                "owners": owner[start:stop].tobytes(), "tokens": low[start:stop].tobytes(),
            }
            for start, stop in zip(cuts[:-1], cuts[1:], strict=True) if stop > start
        ]
        sizes = np.array(self.sizes, np.uint32).tobytes()
        rows.append({"part": self.number % self.parts, "chunk": self.number, "keys": b"".join(self.keys), "sizes": sizes})
        yield pa.RecordBatch.from_pylist(rows, _DEALT_ARROW)
        self.number += 1
        self._clear()


def _answers(batches: Iterator[pa.RecordBatch], with_tokens: bool) -> Iterator[pa.RecordBatch]:
    """What the chunks' sets share with others, part by part; rows come ordered by part, other rows go on as they are.

    An answer holds the shared shingles of a chunk's sets with their numbers of sets, or for each set how many of its
    shingles are shared.
    """

    def answer(rows: list[dict]) -> pa.RecordBatch:
        tokens = [np.frombuffer(row["tokens"], np.uint32) for row in rows]
        _, inverse, often = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
        counts = np.split(often[inverse], np.cumsum([len(part) for part in tokens])[:-1])
        found = []
        for row, own, count in zip(rows, tokens, counts, strict=True):
            shared = count > 1
            if shared.any():
                owners = np.frombuffer(row["owners"], np.uint16)[shared]
                if with_tokens:
                    told = {"owners": owners, "tokens": own[shared], "counts": count[shared].astype(np.uint32)}
                else:
                    owners, count = np.unique(owners, return_counts=True)
                    told = {"owners": owners, "counts": count.astype(np.uint32)}
                found.append({"part": row["part"], "chunk": row["chunk"]} | {k: v.tobytes() for k, v in told.items()})
        return pa.RecordBatch.from_pylist(found, _DEALT_ARROW)

    held: list[dict] = []
    for batch in batches:
        posted = pc.is_valid(batch.column("tokens"))
        yield batch.filter(pc.invert(posted))
        for row in batch.filter(posted).select(["part", "chunk", "owners", "tokens"]).to_pylist():
            if held and row["part"] != held[0]["part"]:
                yield answer(held)
                held = []
            held.append(row)
    if held:
        yield answer(held)


def _answered(dealt: DataFrame, parts: int, with_tokens: bool) -> DataFrame:
    rows = dealt.repartition(parts, "part").sortWithinPartitions("part")
    return map_batches(rows, lambda batches: _answers(batches, with_tokens), _DEALT)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each chunk, which come together."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.select(["part", "chunk", "keys", "sizes", "owners", "tokens", "counts"]).to_pylist():
            if held and row["chunk"] != held[0]["chunk"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


# --- first pass: sets that may be similar to another ---------------------------------------------


def _dealt_documents(docs: DataFrame, words: int, percent: int, parts: int) -> DataFrame:
    """Documents with their sets' digests, and the first shingles of every set by hash, dealt out."""
    percent_dealt = min(100, 100 - percent + BEYOND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, seen = _Chunk(parts), set()
        for batch in text_slices(batches):
            sets = [shingle_set(text, words) for text in texts_of(batch)]
            keys = list(map(_key, sets))
            hashes = batch.column("text_hash")
            columns = {
                "doc_id": batch.column("doc_id"),
                "text_hash": hashes,
                "n_shingles": pa.array(map(len, sets), "int64"),
                "set_key": pa.array(keys, "binary"),
                "part": pa.array([at % parts for at in hashes.to_pylist()], "int32"),
            }
            columns = [columns.get(field.name, pa.nulls(len(sets), field.type)) for field in _DEALT_ARROW]
            yield pa.RecordBatch.from_arrays(columns, schema=_DEALT_ARROW)
            for key, shingles in zip(keys, sets, strict=True):
                if key is not None and key not in seen:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(key)
                    # Sets are sorted by hash, the order that is common to all.
                    yield from chunk.add(key, len(shingles), shingles[: -(-percent_dealt * len(shingles) // 100)].copy())
        yield from chunk.deal()
        _hashes.clear()  # a worker goes on with other stages

    return map_batches(docs.withColumn("text_hash", F.xxhash64("text")), run, _DEALT)


def _hopeful(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """set_key of the sets that share enough of what was dealt out.

    Of two similar sets, take the one whose dealt shingles end first: but for the share that may be missing in the
    other, all of them are common, and these were dealt out of the other too, so both have ``BEYOND`` percent shared.
    """
    enough = min(100, 100 - percent + BEYOND) + percent - 100
    for rows in _chunks(batches):
        head = next(row for row in rows if row["keys"] is not None)
        sizes = np.frombuffer(head["sizes"], np.uint32).astype(np.int64)
        shared = np.zeros(len(sizes), np.int64)
        for row in rows:
            if row["owners"] is not None:
                shared[np.frombuffer(row["owners"], np.uint16)] += np.frombuffer(row["counts"], np.uint32)
        found = np.flatnonzero(shared >= np.maximum(1, enough * sizes // 100))
        keys = [head["keys"][16 * at : 16 * at + 16] for at in found.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(keys, "binary")], ["set_key"])


# --- making sets again ------------------------------------------------------------------------------


def _merge_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    merged: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = np.frombuffer(zlib.decompress(packed), np.uint8)
            merged[part] = merged[part] | found if part in merged else found
    if merged:
        values = [values.tobytes() for values in merged.values()]
        yield pa.RecordBatch.from_arrays([pa.array(merged, "int32"), pa.array(values, "binary")], ["part", "bits"])


def _map_of(wanted: DataFrame, n_bits: int) -> np.ndarray:
    """Packed bits, set at the slots of the hashes in column ``row_hash``; merged by parts before the driver has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(n_bits >> 3, np.uint8)
        for batch in batches:
            slots = batch.column(0).to_numpy() & (n_bits - 1)
            np.bitwise_or.at(bits, slots >> 3, (128 >> (slots & 7)).astype(np.uint8))
        if bits.any():
            parts = [zlib.compress(part.tobytes(), 1) for part in np.split(bits, MAP_PARTS)]
            yield pa.RecordBatch.from_arrays([pa.array(range(MAP_PARTS), "int32"), pa.array(parts, "binary")], ["part", "bits"])

    parts = map_batches(wanted.select("row_hash"), run, "part int, bits binary").repartition("part")
    whole = np.zeros((MAP_PARTS, n_bits // 8 // MAP_PARTS), np.uint8)
    for part, values in map_batches(parts, _merge_maps, "part int, bits binary").collect():
        whole[part] = np.frombuffer(values, np.uint8)
    return whole.reshape(-1)


def _made_again(docs: DataFrame, words: int, packed, n_bits: int) -> DataFrame:
    """row_hash, set_key and shingles of the rows that the map may hold; other texts are not looked into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = packed.value
        for batch in batches:
            slots = batch.column("row_hash").to_numpy() & (n_bits - 1)
            held = pa.array((bits[slots >> 3] >> (7 - (slots & 7)) & 1).astype(bool))
            for part in text_slices(iter([batch.filter(held)])):
                sets = [shingle_set(text, words) for text in texts_of(part)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row_hash"),
                        pa.array(map(_key, sets), "binary"),
                        pa.array([shingles.tobytes() for shingles in sets], "binary"),
                    ],
                    ["row_hash", "set_key", "shingles"],
                )
        _hashes.clear()

    rows = docs.select(F.xxhash64("doc_id", F.xxhash64("text")).alias("row_hash"), "text")
    return map_batches(rows, run, "row_hash long, set_key binary, shingles binary").where("set_key is not null")


# --- second and third pass: groups, and chains of those that share a prefix shingle ------------


def prefix_length(size: int, percent: int) -> int:
    return size - -(-percent * size // 100) + 1


def _chain(tokens: np.ndarray, low: np.ndarray, high: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Order entries by (token, low) and say which follow one they may be similar to.

    Entries have sizes from ``low`` to ``high``; returns the order and, for each place in it,
    whether the entry there continues the chain of its token.
    """
    order = np.lexsort((high, low, tokens))
    tokens, low, high = tokens[order], low[order].astype(np.int64), high[order].astype(np.int64)
    starts = np.r_[True, tokens[1:] != tokens[:-1]]
    rank = np.cumsum(starts)
    most = np.maximum.accumulate((rank << 34) + high) - (rank << 34)
    goes_on = ~starts
    goes_on[1:] &= percent * low[1:] <= 100 * most[:-1]
    return order, goes_on


def _linked(order: np.ndarray, goes_on: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Distinct pairs of owners of neighbouring entries in a chain."""
    at = np.flatnonzero(goes_on)
    pairs = np.stack([owners[order[at - 1]], owners[order[at]]], axis=1)
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    pairs.sort(axis=1)
    return np.unique(pairs, axis=0) if len(pairs) else pairs.astype(np.int64).reshape(0, 2)


_POSTINGS = "part int, tokens binary, low binary, high binary, owners binary, keys binary, a binary, b binary, set_key binary, group_key binary"
_POSTINGS_ARROW = pa.schema(
    [(name, "int32" if name == "part" else "binary") for name in
     ("part", "tokens", "low", "high", "owners", "keys", "a", "b", "set_key", "group_key")]
)


def _dealt_sets(sets: DataFrame, parts: int) -> DataFrame:
    """All shingles of sets (set_key, shingles), dealt out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk(parts)
        for batch in batches:
            for key, values in zip(batch.column("set_key").to_pylist(), batch.column("shingles").to_pylist(), strict=True):
                shingles = np.frombuffer(values, np.uint64)
                yield from chunk.add(key, len(shingles), shingles)
        yield from chunk.deal()

    return map_batches(sets.select("set_key", "shingles"), run, _DEALT)


def _group(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Of each chunk of sets: members (set_key, group_key), groups' prefix shingles by part, and groups linked already.

    Shingles that no other set has are the rarest and cannot be shared; a set with a whole prefix of them drops out.
    """
    for rows in _chunks(batches):
        head = next(row for row in rows if row["keys"] is not None)
        sizes = np.frombuffer(head["sizes"], np.uint32).astype(np.int64)
        rows = [row for row in rows if row["owners"] is not None]
        if not rows:
            continue
        owner, tokens, often = (
            np.concatenate([np.frombuffer(row[name], kind) for row in rows]).astype(np.int64)
            for name, kind in (("owners", np.uint16), ("tokens", np.uint32), ("counts", np.uint32))
        )
        part = np.repeat([row["part"] for row in rows], [len(row["tokens"]) // 4 for row in rows])
        order = np.lexsort((tokens, part, often, owner))
        owner, tokens, often, part = owner[order], tokens[order], often[order], part[order]
        shared = np.bincount(owner, minlength=len(sizes))
        left = sizes - -(-percent * sizes // 100) + 1 - (sizes - shared)
        place = np.arange(len(owner)) - (np.cumsum(shared) - shared)[owner]
        again = np.r_[False, (owner[1:] == owner[:-1]) & (tokens[1:] == tokens[:-1]) & (part[1:] == part[:-1])]
        # Shingles of one set that clash are in the prefix together.
        within = place < left[owner]
        for at in np.flatnonzero(again & ~within):
            within[at] = within[at - 1]
        owner, tokens, part = owner[within], tokens[within], part[within]
        cuts = [0, *(np.flatnonzero(np.diff(owner)) + 1).tolist(), len(owner)]
        groups: dict[bytes, tuple[int, slice]] = {}
        members = []
        for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
            if start == stop:
                continue
            at, span = int(owner[start]), slice(start, stop)
            prefix = hashlib.blake2b(sizes[at].tobytes(), digest_size=16)
            prefix.update(part[span].tobytes() + tokens[span].tobytes())
            key = prefix.digest()
            groups.setdefault(key, (int(sizes[at]), span))
            members.append({"set_key": head["keys"][16 * at : 16 * at + 16], "group_key": key})
        yield pa.RecordBatch.from_pylist(members, _POSTINGS_ARROW)
        if groups:
            yield from _postings_of(groups, tokens, part, percent)


def _postings_of(groups: dict, tokens: np.ndarray, part: np.ndarray, percent: int) -> Iterator[pa.RecordBatch]:
    keys = list(groups)
    spans = [np.arange(span.start, span.stop) for _, span in groups.values()]
    at = np.concatenate(spans)
    owner = np.repeat(np.arange(len(keys)), [len(span) for span in spans])
    size = np.array([size for size, _ in groups.values()], np.int64)[owner]
    tokens, part = tokens[at], part[at]
    order, goes_on = _chain(part << 32 | tokens, size, size, percent)
    pairs = _linked(order, goes_on, owner)
    first = np.flatnonzero(~goes_on)
    last = np.r_[first[1:], len(order)] - 1
    tokens, part, low, high = tokens[order[first]], part[order[first]], size[order[first]], size[order[last]]
    owner = owner[order[first]]
    rows = []
    by_part = np.lexsort((owner, part))
    for chosen in np.split(by_part, np.flatnonzero(np.diff(part[by_part])) + 1):
        held, local = np.unique(owner[chosen], return_inverse=True)
        rows.append({
            "part": int(part[chosen[0]]),
            "tokens": tokens[chosen].astype(np.uint32).tobytes(),
            "low": low[chosen].astype(np.uint32).tobytes(),
            "high": high[chosen].astype(np.uint32).tobytes(),
            "owners": local.astype(np.uint32).tobytes(),
            "keys": b"".join(keys[at] for at in held),
        })
    for start in range(0, len(pairs), 10_000):
        ends = [b"".join(keys[end] for end in column) for column in pairs[start : start + 10_000].T.tolist()]
        rows.append({"part": start // 10_000, "a": ends[0], "b": ends[1]})
    yield pa.RecordBatch.from_pylist(rows, _POSTINGS_ARROW)


def _link_parts(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Link the entries of each part, rows coming ordered by part, and pass on the pairs linked already."""

    def linked(rows: list[dict]) -> pa.RecordBatch:
        keys, owners, before = [], [], 0
        for row in rows:
            own = np.frombuffer(row["keys"], "V16")
            owners.append(np.frombuffer(row["owners"], np.uint32).astype(np.int64) + before)
            keys.append(own)
            before += len(own)
        tokens, low, high = (
            np.concatenate([np.frombuffer(row[name], np.uint32) for row in rows]) for name in ("tokens", "low", "high")
        )
        keys, owners = np.concatenate(keys), np.concatenate(owners)
        # A group may come from several chunks, or in several entries of one: its first number stands for all.
        _, first, same = np.unique(keys, return_index=True, return_inverse=True)
        owners = first[same][owners]
        order, goes_on = _chain(tokens, low, high, percent)
        pairs = _linked(order, goes_on, owners)
        ends = [pa.array([keys[at].tobytes() for at in column], "binary") for column in pairs.T]
        return pa.RecordBatch.from_arrays(ends, ["a", "b"])

    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if row["a"] is not None:
                ends = [[row[name][at : at + 16] for at in range(0, len(row[name]), 16)] for name in ("a", "b")]
                yield pa.RecordBatch.from_arrays([pa.array(end, "binary") for end in ends], ["a", "b"])
                continue
            if held and row["part"] != held[0]["part"]:
                yield linked(held)
                held = []
            held.append(row)
    if held:
        yield linked(held)


# --- fourth pass: the grouped join within blocks -----------------------------------------------


def grouped_join(
    sets: list[np.ndarray], sides: np.ndarray, percent: int, crossing: bool | None = None
) -> Iterator[tuple[int, np.ndarray]]:
    """(place, places of later sets that it links with) among ``sets``, sorted distinct hashes.

    If ``crossing``, sets of one side meet only those of the other, so one side alone gives nothing;
    left out, it holds unless all are on side 0. Sets with equal size and
    equal prefix are a group; a pair of groups is looked into if their sizes allow the similarity
    and their prefixes share a shingle, and then each pair of members is counted out.
    """
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, index, often = np.unique(flat, return_inverse=True, return_counts=True)
    # Rarest first within the block; what only one set has cannot be shared and is left out.
    order = np.lexsort((index, often[index], owner))
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    place = np.arange(len(flat)) - np.repeat(starts, sizes)
    lengths = sizes - -(-percent * sizes // 100) + 1
    index = index[order]
    shared = often[index] > 1
    in_prefix = shared & (place < np.repeat(lengths, sizes))
    groups: dict[tuple, list[int]] = defaultdict(list)
    prefixes: dict[tuple, np.ndarray] = {}
    for at, start in enumerate(starts):
        span = slice(start, start + sizes[at])
        prefix = index[span][in_prefix[span]]
        if len(prefix):
            key = (int(sizes[at]), prefix.tobytes())
            groups[key].append(at)
            prefixes[key] = prefix
    keys = sorted(groups, key=lambda key: (key[0], groups[key][0]))
    if not keys:
        return
    # Which groups hold a value in their prefix: one run of ``holders`` for each value.
    held = np.concatenate([prefixes[key] for key in keys])
    by_value = np.argsort(held, kind="stable")
    holders = np.repeat(np.arange(len(keys)), [len(prefixes[key]) for key in keys])[by_value]
    run_at = np.searchsorted(held[by_value], np.arange(len(values) + 1))
    group_size = np.array([key[0] for key in keys])
    met = np.zeros(len(keys), bool)
    crossing = bool(sides.any()) if crossing is None else crossing
    shared_of = [index[start : start + size][shared[start : start + size]] for start, size in zip(starts, sizes, strict=True)]
    marked = np.zeros(len(values), np.int64)
    for number, key in enumerate(keys):
        # Groups so far are no larger; those that are too small, or share no prefix shingle, drop out.
        for value in prefixes[key].tolist():
            met[holders[run_at[value] : run_at[value + 1]]] = True
        near = np.flatnonzero(met[:number] & (100 * group_size[:number] >= percent * key[0]))
        met[:] = False
        earlier = np.array([at for other in near for at in groups[keys[other]]], np.int64)
        members = groups[key]
        for nth, at in enumerate(members):
            others = np.r_[earlier, np.array(members[:nth], np.int64)]
            if crossing:
                others = others[sides[others] != sides[at]]
            if not len(others):
                continue
            marked[shared_of[at]] = 1
            parts = [shared_of[other] for other in others]
            ends = np.cumsum([len(part) for part in parts])
            sums = np.r_[0, np.cumsum(marked[np.concatenate(parts)])]
            common = sums[ends] - sums[np.r_[0, ends[:-1]]]
            marked[shared_of[at]] = 0
            linked = others[100 * common >= percent * (sizes[at] + sizes[others] - common)]
            if len(linked):
                yield at, linked


_LINKS = "set_key binary, links long, other binary"


def _verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links of each pair of blocks; rows come ordered by (component, left, right, set_key).

    Gives each linked set the copies it links with in this pair of blocks, and a forest of links.
    """

    def linked(rows: list[dict]) -> pa.RecordBatch:
        sets = [np.frombuffer(row["shingles"], np.uint64) for row in rows]
        copies = np.array([row["copies"] for row in rows], np.int64)
        sides = np.array([row["block"] != row["left"] for row in rows])
        links = np.zeros(len(rows), np.int64)
        parent = list(range(len(rows)))
        def root(at: int) -> int:
            while parent[at] != at:
                parent[at] = at = parent[parent[at]]
            return at
        for at, others in grouped_join(sets, sides, percent, rows[0]["left"] != rows[0]["right"]):
            links[at] += copies[others].sum()
            links[others] += copies[at]
            for other in others.tolist():
                parent[root(other)] = root(at)
        found = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([rows[at]["set_key"] for at in found], "binary"),
                pa.array(links[found], "int64"),
                pa.array([rows[root(at)]["set_key"] for at in found.tolist()], "binary"),
            ],
            ["set_key", "links", "other"],
        )

    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and any(row[k] != held[0][k] for k in ("component", "left", "right")):
                yield linked(held)
                held = []
            if not held or row["set_key"] != held[-1]["set_key"]:  # rows that repeat id and text
                held.append(row)
    if held:
        yield linked(held)


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = new_scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _parts_for(shingles: int) -> int:
    return max(16, shingles // PART_SHINGLES)


def _sets_to_compare(docs: DataFrame, rows: DataFrame, hopeful: DataFrame, words: int) -> DataFrame:
    """set_key, copies, size and shingles of every hopeful set, one row for all its copies."""
    spark = docs.sparkSession
    one = F.min(F.struct("doc_id", "text_hash"))
    sets = rows.where("set_key is not null").groupBy("set_key")
    sets = sets.agg(F.count("*").alias("copies"), F.max("n_shingles").alias("size"), one.alias("one"))
    wanted = sets.join(hopeful.distinct(), "set_key", "left_semi").select(
        "set_key", "copies", "size", F.xxhash64("one.doc_id", "one.text_hash").alias("row_hash")
    )
    wanted = _stored(wanted, "wanted-sets")
    n_bits = min(MOST_MAP_BITS, max(1 << 16, 1 << (MAP_BITS_A_SET * wanted.count()).bit_length()))
    packed = spark.sparkContext.broadcast(_map_of(wanted, n_bits))
    made = _made_again(docs, words, packed, n_bits)
    # Rows that repeat id and text give a set more than once.
    met = made.join(wanted, ["set_key", "row_hash"]).dropDuplicates(["set_key"])
    return _stored(met.select("set_key", "copies", "size", "shingles"), "sets")


def _components_of_candidates(sets: DataFrame, percent: int) -> DataFrame:
    """set_key and component of the sets whose groups are linked through shared prefix shingles."""
    n_parts = _parts_for(sets.agg(F.sum("size")).first()[0] or 0)
    answered = _answered(_dealt_sets(sets, n_parts), n_parts, with_tokens=True).where("chunk is not null")
    grouped = map_batches(
        answered.repartition("chunk").sortWithinPartitions("chunk"), lambda batches: _group(batches, percent), _POSTINGS
    )
    grouped = _stored(grouped, "groups")
    members = grouped.where("group_key is not null").select("set_key", "group_key")
    postings = grouped.where("part is not null").drop("set_key", "group_key")
    postings = postings.repartition(n_parts, "part").sortWithinPartitions("part")
    linked = map_batches(postings, lambda batches: _link_parts(batches, percent), "a binary, b binary")
    found = connected(linked).withColumnsRenamed({"node": "group_key", "root": "component"})
    found = members.join(found, "group_key", "left")
    return found.select("set_key", F.coalesce("component", "group_key").alias("component"))


def _block_pairs(sets: DataFrame, components: DataFrame, percent: int) -> DataFrame:
    """Rows of sets for each pair of blocks of a component that meets, ordered for ``_verify``."""
    placed = _stored(components.join(sets.select("set_key", "size"), "set_key"), "candidates")
    total = placed.groupBy("component").agg(F.sum("size").alias("total")).where(F.col("total") > BLOCK_SHINGLES)
    # A large component is cut up by size first: similar sets are in one class or in neighbouring ones.
    step = 1.0001 * max(math.log(100 / percent), 1e-6)
    in_class = placed.join(total, "component").withColumn("size_class", F.floor(F.log("size") / step).cast("int"))
    in_class = in_class.groupBy("component", "size_class").agg(
        F.ceil(F.sum("size") / BLOCK_SHINGLES).cast("int").alias("blocks")
    )
    blocks = in_class.groupBy("component").agg(
        F.map_from_entries(F.collect_list(F.struct("size_class", "blocks"))).alias("blocks")
    )
    placed = placed.join(blocks, "component", "left")
    own_class = F.when(F.col("blocks").isNull(), 0).otherwise(F.floor(F.log("size") / step)).cast("int")

    def numbered(size_class: Column, block: Column) -> Column:
        return F.shiftleft(size_class.cast("long"), 32) + block

    def blocks_of(size_class: Column) -> Column:
        many = F.when(F.col("blocks").isNull(), (size_class == 0).cast("int")).otherwise(
            F.coalesce(F.try_element_at("blocks", size_class), F.lit(0))
        )
        places = F.transform(F.sequence(F.lit(1), F.greatest(many, F.lit(1))), lambda nth: numbered(size_class, nth - 1))
        return F.slice(places, 1, many)

    many = F.coalesce(F.try_element_at("blocks", F.col("size_class")), F.lit(1))
    others = F.flatten(F.array(*(blocks_of(F.col("size_class") + by) for by in (-1, 0, 1))))
    placed = placed.withColumn("size_class", own_class).select(
        "set_key", "component", numbered(F.col("size_class"), F.pmod(F.xxhash64("set_key"), many)).alias("block"),
        others.alias("others"),
    )
    return (
        sets.select("set_key", "copies", "shingles")
        .join(placed, "set_key")
        .withColumn("other", F.explode("others"))
        .select(
            "component", "set_key", "copies", "shingles", "block",
            F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"),
        )
        .repartition("component", "left", "right")
        .sortWithinPartitions("component", "left", "right", "set_key")
    )


def _judged(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The columns of ``near_duplicates``, with text_hash and a key of the component (NULL without shingles)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Six bytes a word, of which each starts a shingle, are enough to say how many parts there should be.
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_parts = _parts_for(n_bytes // 6 * min(100, 100 - percent + BEYOND) // 100)
    written = _stored(_answered(_dealt_documents(docs, words, percent, n_parts), n_parts, with_tokens=False), "documents")
    rows = written.where("chunk is null").select("doc_id", "text_hash", "n_shingles", "set_key")
    chunks = written.where("chunk is not null").repartition("chunk").sortWithinPartitions("chunk")
    hopeful = map_batches(chunks, lambda batches: _hopeful(batches, percent), "set_key binary")
    compared = _sets_to_compare(docs, rows, hopeful, words)
    met = _block_pairs(compared, _components_of_candidates(compared, percent), percent)
    links = _stored(map_batches(met, lambda batches: _verify(batches, percent), _LINKS), "links")

    found = connected(links.select(F.col("set_key").alias("a"), F.col("other").alias("b")))
    sets = rows.where("set_key is not null").groupBy("set_key")
    sets = sets.agg(F.count("*").alias("copies"), F.min("doc_id").alias("least_doc"))
    of_set = sets.join(found.withColumnRenamed("node", "set_key"), "set_key", "left")
    least = of_set.where("root is not null").groupBy("root").agg(F.min("least_doc").alias("component_id"))
    counted = links.groupBy("set_key").agg(F.sum("links").alias("links"))
    of_set = (
        of_set.join(least, "root", "left")
        .join(counted, "set_key", "left")
        .select(
            "set_key",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component_id", "least_doc").alias("component_id"),
            F.coalesce("root", "set_key").alias("component"),
        )
    )
    return rows.join(of_set, "set_key", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "text_hash",
        "component",
    )


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, n_links, component_id.

    Two rows link when ``100 * intersection >= percent * union`` of their sets of distinct word shingles.
    ``n_links`` counts the rows a row links with, copies included; ``component_id`` is the smallest
    doc_id that can be reached over links. NULL, empty and blank texts have no shingles and
    link with nothing. Rows that repeat a doc_id are kept and judged by their own texts; a NULL doc_id
    takes part and is no candidate for the smallest. Other columns are ignored.
    """
    columns = ["doc_id", "n_shingles", "n_links", "component_id"]
    return _judged(docs, words, percent).select(*columns)


def keep_one_of_each(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each component of ``near_duplicates``, with all columns: that with the smallest doc_id.

    Rows without shingles are no duplicates and stay. NULL ids come last; rows that repeat an id are told
    apart by their texts, and of rows that repeat both one stays.
    """
    found = _judged(docs, words, percent).where("component is not null").select("doc_id", "text_hash", "component")
    found = _stored(found, "judged")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    first = found.groupBy("component").agg(F.min(place).alias("first"), F.count("*").alias("rows")).where("rows > 1")
    members = found.join(first, "component").withColumn("stays", place.eqNullSafe(F.col("first")))
    verdicts = members.groupBy(F.col("doc_id").alias("judged_id"), F.col("text_hash").alias("judged_hash"))
    verdicts = verdicts.agg(F.max("stays").alias("stays"), F.count("*").alias("rows")).where("not stays or rows > 1")
    # Columns of the documents may have any name.
    verdicts = _stored(verdicts, "verdicts").alias("fleetgauge_verdicts")
    judged_id, judged_hash = F.col("fleetgauge_verdicts.judged_id"), F.col("fleetgauge_verdicts.judged_hash")
    own = docs.alias("fleetgauge_documents")
    same = F.col("fleetgauge_documents.doc_id").cast("long").eqNullSafe(judged_id) & (
        F.xxhash64("fleetgauge_documents.text") == judged_hash
    )
    kept = own.join(verdicts, same, "left_anti")
    repeated = verdicts.where("stays")
    if repeated.isEmpty():
        return kept
    return kept.union(own.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"]))
