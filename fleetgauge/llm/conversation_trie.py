"""Prefix trie of conversations by collapsing whole sequences.

1. Turns are numbered within their conversation, and every prefix gets a polynomial hash: four sums modulo a
   prime. Ranges of turns are summed on their own and joined by one row a range, so a conversation of any
   length may lie in several tasks. From here on no text is moved.
2. A rebuilt conversation is a head of another's turns and a tail of its own; its prefix hashes follow from
   those of the two by arithmetic.
3. Identical rebuilt conversations collapse into one weighted sequence with a list of ends. Only one conversation of
   each sequence is spread out into its prefixes, which are the nodes.
4. Sequences that are proper prefixes of others fall to an anti-join; the rest are the leaves. Weighted prefixes
   are then aggregated. Sums over a subtree need no pairs of node and descendant: each node is owned by its
   smallest leaf, the leaves through a node give their owners' totals, and what the owner has above the
   node is taken off again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.batches import map_batches
from fleetgauge.session import new_scratch_path

PRIME = (1 << 31) - 1
BASES = (1_103_515_245, 1_664_525_003, 214_013_157, 1_597_334_677)
LANES = range(len(BASES))
#: A conversation takes its first turns, fewer than ``HEADS``, from the first conversation of its family.
HEADS = 6
FAMILY = 100
#: Ids of a piece of a list of ends at most.
ENDS_PIECE = 1 << 12
_STEP = 1 << 12


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = new_scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


# --- running sums over ranges ----------------------------------------------------------------


@lru_cache
def _first_powers(base: int, modulus: int) -> np.ndarray:
    return np.array([pow(base, at, modulus) for at in range(_STEP)], np.int64)


def _powers(base: int, exponents: np.ndarray, modulus: int) -> np.ndarray:
    """``base`` to each exponent; the modulus has 31 bits at most."""
    steps, which = np.unique(exponents // _STEP, return_inverse=True)
    high = np.array([pow(base, _STEP * int(step), modulus) for step in steps], np.int64)
    return _first_powers(base, modulus)[exponents % _STEP] * high[which] % modulus


def running_sums(
    rows: DataFrame, group: str, order: list[Column], values: list[str], bases: tuple[int, ...], modulus: int | None, dealt_by: int
) -> DataFrame:
    """``rows`` with position (from 1) and running sums of ``values[l] * bases[l]**position`` within each group.

    Sums s0, s1, ... include the row, b0, b1, ... do not. Rows come in ``order``, which starts with the group, and
    are dealt by its first ``dealt_by`` columns. With a modulus, values are below it. Written once, in ranges; of
    each range one row comes to the driver, which joins them up.
    """
    spark = rows.sparkSession
    lanes = range(len(values))
    kept = [name for name in rows.columns if name not in values]
    sums_of = [f"{kind}{lane}" for kind in "sb" for lane in lanes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        held, held_n, held_sums = None, 0, [0] * len(values)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            groups = batch.column(group).to_numpy()
            new = np.r_[held is None or groups[0] != held, groups[1:] != groups[:-1]]
            first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            goes_on = ~np.logical_or.accumulate(new)
            position = np.arange(n) - first + 1 + np.where(goes_on, held_n, 0)
            columns, before, held_before = [], [], held_sums
            held_sums = []
            for lane in lanes:
                terms = batch.column(values[lane]).to_numpy().astype(np.int64)
                if modulus:
                    terms = terms * _powers(bases[lane], position, modulus) % modulus
                sums = np.cumsum(terms)
                sums = sums - np.where(goes_on, 0, (sums - terms)[first]) + np.where(goes_on, held_before[lane], 0)
                sums = sums % modulus if modulus else sums
                columns.append(sums)
                before.append((sums - terms) % modulus if modulus else sums - terms)
                held_sums.append(int(sums[-1]))
            held, held_n = groups[-1], int(position[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(name) for name in kept]
                + [pa.array(column, "int64") for column in (position, *columns, *before, np.full(n, part), np.arange(row, row + n))],
                [*kept, "position", *sums_of, "part", "row"],
            )
            row += n

    schema = rows.select(*kept).schema
    for name in ("position", *sums_of, "part", "row"):
        schema = schema.add(name, "long")
    dealt = rows.repartitionByRange(*order[:dealt_by]).sortWithinPartitions(*order)
    written = _stored(map_batches(dealt, run, schema), "running")
    last = F.struct(group, "position", *(f"s{lane}" for lane in lanes))
    ranges = written.groupBy("part").agg(F.min_by(group, "row").alias("first"), F.max_by(last, "row").alias("last"))
    carries, state = [], None
    for part, first, (own, n, *sums) in sorted(map(tuple, ranges.collect())):
        if state and state[0] == first:
            factors = [pow(base, state[1], modulus) if modulus else 1 for base in bases]
            carries.append((part, first, state[1], *state[2], *factors))
            if own == first:
                n += state[1]
                sums = [before + factor * value for before, factor, value in zip(state[2], factors, sums, strict=True)]
                sums = [value % modulus if modulus else value for value in sums]
        state = (own, n, sums)
    names = [f"{kind}{lane} long" for kind in "cf" for lane in lanes]
    carried = spark.createDataFrame(carries, ", ".join(["in_part long", "of_group long", "before_n long", *names]))
    met = written.join(F.broadcast(carried), (F.col("in_part") == F.col("part")) & (F.col("of_group") == F.col(group)), "left")
    goes_on = F.col("in_part").isNotNull()

    def joined(name: str) -> Column:
        whole = F.col(f"c{name[1:]}") + F.col(f"f{name[1:]}") * F.col(name)
        return F.when(goes_on, F.pmod(whole, F.lit(modulus)) if modulus else whole).otherwise(F.col(name)).alias(name)

    position = F.col("position") + F.coalesce("before_n", F.lit(0))
    return met.select(*kept, position.alias("position"), *map(joined, sums_of))


# --- nodes -----------------------------------------------------------------------------------


def _key(sums: list[Column], *names: str) -> list[Column]:
    """Two whole numbers that hold four sums."""
    a, b, c, d = sums
    return [(F.shiftleft(a, 31) + b).alias(names[0]), (F.shiftleft(c, 31) + d).alias(names[1])]


def _numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, position, n_chars, and the prefix sums with the turn (s0 to s3) and without it (b0 to b3)."""
    text, role = (F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("text", "role"))
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role, text).where("conv_id is not null")
    turns = turns.select(
        "conv_id", "turn", "role", F.substring("text", 1, 16).alias("start"), F.sha1("text").alias("digest"),
        F.length("text").cast("long").alias("n_chars"),
        *(F.pmod(F.xxhash64(F.lit(lane), "role", "text"), F.lit(PRIME)).alias(f"v{lane}") for lane in LANES),
    )
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.col("start"), F.col("digest")]
    found = running_sums(turns, "conv_id", order, [f"v{lane}" for lane in LANES], BASES, PRIME, dealt_by=4)
    return found.drop("turn", "role", "start", "digest")


def _ends(members: DataFrame) -> DataFrame:
    """depth, k1, k2, ends_sha256 from conversations (depth, k1, k2, conv_id), a row for each sequence.

    Tasks join ranges of ids to pieces of text; then the pieces of a sequence go through one digest in order,
    one at a time.
    """
    keys = ["depth", "k1", "k2"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, rows = None, [], []

        def done() -> None:
            if ids:
                rows.append(dict(zip(keys, held, strict=True)) | {"first": ids[0], "ids": ",".join(map(str, ids))})
                ids.clear()

        for batch in batches:
            for *key, conv in zip(*(batch.column(name).to_pylist() for name in (*keys, "conv_id")), strict=True):
                if key != held or len(ids) >= ENDS_PIECE:
                    done()
                held = key
                ids.append(conv)
            if rows:
                yield pa.RecordBatch.from_pylist(rows)
                rows.clear()
        done()
        if rows:
            yield pa.RecordBatch.from_pylist(rows)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, digest, rows = None, None, []

        def done() -> None:
            if held:
                rows.append(dict(zip(keys, held, strict=True)) | {"ends_sha256": digest.hexdigest()})

        for batch in batches:
            for *key, ids in zip(*(batch.column(name).to_pylist() for name in (*keys, "ids")), strict=True):
                if key == held:
                    digest.update(b",")
                else:
                    done()
                    held, digest = key, hashlib.sha256()
                digest.update(ids.encode())
            if rows:
                yield pa.RecordBatch.from_pylist(rows)
                rows.clear()
        done()
        if rows:
            yield pa.RecordBatch.from_pylist(rows)

    dealt = members.select(*keys, "conv_id").repartitionByRange(*keys, "conv_id").sortWithinPartitions(*keys, "conv_id")
    found = map_batches(dealt, pieces, "depth long, k1 long, k2 long, first long, ids string")
    dealt = found.repartition(*keys).sortWithinPartitions(*keys, "first")
    return map_batches(dealt, digests, "depth long, k1 long, k2 long, ends_sha256 string")


def conversation_trie(conversations: DataFrame, heads: int = HEADS, family: int = FAMILY) -> DataFrame:
    """The nodes of the prefix trie of rebuilt ``conversations`` (conv_id, turn, role, text), a row each.

    Conversation c consists of the first h turns of conversation ``c - c % family`` and of its own turns after its
    first h, where h is crc32 of c's decimal digits modulo ``heads``; with ``heads`` of 1 it stays as it is.
    A node is a distinct sequence of the first turns of some conversation; the root has none. Columns:
    conv_id (smallest member), depth, parent_conv_id (NULL for the root), n_convs, n_children, n_leaves,
    saved_tokens (over the subtree, members but one times the characters of the node's last text), ends_sha256 (of the
    ids that end there, ascending, with commas between).

    Turns go by ``turn``, NULL first; ties by role, the text's first 16 characters and its SHA-1, and equal rows are
    turns of their own. NULL and empty role or text are the same. Rows without a conv_id take no part; a negative one takes its remainder with its sign. No
    conversations give no rows, not even a root. Other columns are ignored.
    """
    numbered = _stored(_numbered(conversations), "turns")
    with_turn, without = (F.array(*[F.col(f"{kind}{lane}") for lane in LANES]) for kind in "sb")
    zeros = F.array(*[F.lit(0).cast("long") for _ in LANES])
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    # At most ``heads`` - 1 turns of a conversation.
    first_of = numbered.where((F.col("conv_id") % family == 0) & (F.col("position") < heads))
    first_of = first_of.groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("position", with_turn.alias("s"), without.alias("b"), "n_chars"))).alias("head")
    )
    convs = numbered.groupBy("conv_id").agg(
        F.max("position").alias("n"),
        F.max_by(with_turn, "position").alias("last"),
        F.coalesce(F.max(F.when(F.col("position") == h, with_turn)), zeros).alias("own_head"),
    )
    convs = convs.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % family}).join(first_of, "base", "left")
    convs = convs.withColumn("k", F.least("h", F.coalesce(F.array_size("head"), F.lit(0))))
    last_of_head = F.try_element_at(F.col("head.s"), F.col("k").cast("int"))
    convs = convs.withColumn("head_sums", F.when(F.col("k") > 0, last_of_head).otherwise(zeros))

    def rebuilt(sums: Column, lane: int) -> Column:
        """A prefix sum over a conversation's own turns as one of the rebuilt one, its tail moved down by h - k."""
        down = [F.lit(pow(pow(BASES[lane], -1, PRIME), by, PRIME)).cast("long") for by in range(heads)]
        factor = F.element_at(F.array(*down), (F.col("h") - F.col("k") + 1).cast("int"))
        own = F.pmod(sums - F.col("own_head")[lane], F.lit(PRIME))
        return F.pmod(F.col("head_sums")[lane] + own * factor, F.lit(PRIME))

    ends = [F.when(F.col("n") > F.col("h"), rebuilt(F.col("last")[lane], lane)).otherwise(F.col("head_sums")[lane]) for lane in LANES]
    depth = F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    convs = _stored(convs.withColumn("depth", depth).select("*", *_key(ends, "k1", "k2")), "conversations")

    keys, above_keys = ["depth", "k1", "k2"], ["above_depth", "p1", "p2"]
    sequences = convs.groupBy(*keys).agg(F.count("*").alias("weight"), F.min("conv_id").alias("conv_id"))
    sequences = _stored(sequences, "sequences")
    # One conversation stands for each sequence; its prefixes carry the weight of all.
    spread = sequences.select("conv_id", "weight").join(
        convs.select("conv_id", "h", "k", "head", "head_sums", "own_head", F.col("depth").alias("whole")), "conv_id"
    )
    kept = ["conv_id", "weight", "whole"]
    shared = spread.select(*kept, F.explode(F.slice("head", 1, F.col("k").cast("int"))).alias("turn")).select(
        *kept, F.col("turn.position").alias("depth"), "turn.n_chars",
        *(key for kind, names in (("s", ("k1", "k2")), ("b", ("p1", "p2")))
          for key in _key([F.col(f"turn.{kind}")[lane] for lane in LANES], *names)),
    )
    tail = numbered.join(spread.drop("head"), "conv_id").where(F.col("position") > F.col("h")).select(
        *kept, (F.col("position") - F.col("h") + F.col("k")).alias("depth"), "n_chars",
        *(key for kind, names in (("s", ("k1", "k2")), ("b", ("p1", "p2")))
          for key in _key([rebuilt(F.col(f"{kind}{lane}"), lane) for lane in LANES], *names)),
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = spread.select(*kept, *(value.alias(name) for name, value in zip(
        ("depth", "n_chars", "k1", "k2", "p1", "p2"), (zero, zero, zero, zero, none, none), strict=True
    )))
    prefixes = _stored(root.union(shared).union(tail), "prefixes")

    inner = prefixes.where("depth < whole").select(*keys).distinct()
    leaves = _stored(sequences.join(inner, keys, "left_anti").select("conv_id", F.col("conv_id").alias("leaf")), "leaves")
    marked = prefixes.join(leaves, "conv_id", "left")
    nodes = marked.groupBy(*keys).agg(
        F.sum("weight").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.max("n_chars").alias("n_chars"),
        F.max("p1").alias("p1"),
        F.max("p2").alias("p2"),
        F.min("leaf").alias("owner"),
        F.count("leaf").alias("n_leaves"),
    )
    nodes = nodes.withColumns({"value": (F.col("n_convs") - 1) * F.col("n_chars"), "above_depth": F.col("depth") - 1})
    nodes = _stored(nodes, "nodes")

    order = [F.col("owner"), F.col("depth")]
    above = running_sums(nodes.select("owner", *keys, "value"), "owner", order, ["value"], (1,), None, dealt_by=2)
    totals = nodes.groupBy(F.col("owner").alias("leaf")).agg(F.sum("value").alias("total")).where("total > 0")
    through = marked.join(totals, "leaf").groupBy(*keys).agg(F.sum("total").alias("through"))
    renamed = dict(zip(above_keys, keys, strict=True))
    children = nodes.where("depth > 0").groupBy(*above_keys).agg(F.count("*").alias("n_children"))
    parents = nodes.select(*(F.col(key).alias(name) for name, key in renamed.items()), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(above.select(*keys, "b0"), keys)
        .join(through, keys, "left")
        .join(children.withColumnsRenamed(renamed), keys, "left")
        .join(_ends(convs), keys, "left")
        .join(parents, above_keys, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            "n_leaves",
            (F.coalesce("through", F.lit(0)) - F.col("b0")).cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )
