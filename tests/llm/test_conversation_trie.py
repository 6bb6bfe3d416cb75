import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fleetgauge.llm.conversation_trie import conversation_trie, running_sums

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows, heads, family):
    own = defaultdict(list)
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", (r[3] or "")[:16], hashlib.sha1((r[3] or "").encode()).hexdigest())
    for row in sorted((r for r in rows if r[0] is not None), key=order):
        own[row[0]].append((row[2] or "", row[3] or ""))
    found = {}
    for conv in own:
        h = zlib.crc32(str(conv).encode()) % heads
        base = conv - (conv % family if conv >= 0 else -(-conv % family))
        found[conv] = own.get(base, [])[:h] + own[conv][h:]
    return found


def brute_force(rows, heads=6, family=100):
    convs = rebuilt(rows, heads, family)
    members = defaultdict(list)
    for conv, turns in convs.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def below(node):
        yield node
        for child in children[node]:
            yield from below(child)

    found = []
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(node))
        subtree = list(below(node))
        found.append((
            min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(children[node]),
            sum(not children[n] for n in subtree),
            sum((len(members[n]) - 1) * len(n[-1][1]) for n in subtree if n), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(found, key=str)


def corpus(seed, n, low=0):
    random.seed(seed)
    rows = []
    for _ in range(n):
        conv = random.randrange(low, 420)
        for turn in range(random.choice((1, 2, 3, 7, 9))):
            if random.random() < 0.97:
                rows.append((conv, None if random.random() < 0.1 else turn, random.choice(("user", None, "")), random.choice(("", "é a", None, "b"))))
    return rows


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def many_ranges(spark):
    """Ranges stay apart, so that groups lie across them."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


@pytest.mark.parametrize(("seed", "n", "low", "heads"), [(1, 60, 0, 6), (2, 300, -150, 6), (3, 120, 0, 1)])
def test_equals_a_plain_trie(spark, many_ranges, seed, n, low, heads):
    rows = corpus(seed, n, low)
    found = result(conversation_trie(spark.createDataFrame(rows, SCHEMA).repartition(5), heads=heads))
    assert found == brute_force(rows, heads) and len(found) > 50


def test_one_conversation_with_most_turns(spark, many_ranges):
    """Two equal long conversations, one a prefix of it, and the rest: the long ones lie across ranges."""
    long = [("user", f"t{i % 7}") for i in range(3_000)]
    rows = [(conv, i, *turn) for conv in (1, 2, 900) for i, turn in enumerate(long[: 3_000 if conv < 900 else 1_700])]
    rows += [(conv, i, "user", f"{conv}") for conv in range(3, 40) for i in range(3)]
    found = result(conversation_trie(spark.createDataFrame(rows, SCHEMA).repartition(7), heads=1))
    assert len(found) == 1 + 3_000 + 37 * 3
    root = next(r for r in found if r[1] == 0)
    n_children, n_leaves, saved = root[4:7]
    assert (n_children, n_leaves) == (38, 38)
    assert saved == 2 * (1_700 * 2 + 1_300)
    end = next(r for r in found if r[:2] == (1, 1_700))
    assert end[3:6] == (3, 1, 1) and end[7] == hashlib.sha256(b"900").hexdigest()


def test_many_equal_conversations(spark):
    rows = [(conv, turn, "user", f"x{turn}") for conv in range(6_000) for turn in range(2)]
    found = {r.depth: r for r in conversation_trie(spark.createDataFrame(rows, SCHEMA), heads=1).collect()}
    ends = ",".join(map(str, range(6_000)))
    assert found[2].ends_sha256 == hashlib.sha256(ends.encode()).hexdigest()
    assert [found[d].n_convs for d in (0, 1, 2)] == [6_000] * 3 and found[0].saved_tokens == 2 * 2 * 5_999


def test_odd_tables(spark):
    clashes = {name: F.lit("x") for name in ("depth", "k1", "s0", "v0", "weight", "owner", "position", "head", "part", "row", "leaf", "h")}
    rows = [(None, 1, "user", "lost"), (5, None, None, None), (5, 1, "a", "b"), (5, 1, "a", "b"), (100, 0, "u", "w" * 50_000), (7, 9, "", "")]
    table = spark.createDataFrame(rows, SCHEMA)
    found = result(conversation_trie(table.withColumns(clashes)))
    assert found == brute_force(rows)
    assert conversation_trie(table.limit(0)).isEmpty() and conversation_trie(table.where("conv_id IS NULL")).isEmpty()


def test_running_sums_across_ranges(spark, many_ranges):
    random.seed(9)
    rows = [(random.choice((1, 1, 1, 2, 3)), at, random.randrange(1 << 31)) for at in range(2_000)]
    table = spark.createDataFrame(rows, "g long, at long, v long").repartition(6)
    order = [F.col("g"), F.col("at")]
    prime = 1_000_003
    hashed = running_sums(table.selectExpr("g", "at", f"v % {prime} AS v"), "g", order, ["v"], (77,), prime, 2)
    plain = running_sums(table, "g", order, ["v"], (1,), None, 2)
    state, wanted = defaultdict(lambda: (0, 0, 0)), {}
    for g, at, v in sorted(rows):
        n, h, s = state[g]
        state[g] = (n + 1, (h + v % prime * pow(77, n + 1, prime)) % prime, s + v)
        wanted[g, at] = (*state[g], h, s)
    found = {(r.g, r.at): (r.position, r.s0, r.b0) for r in hashed.collect()}
    assert found == {key: (n, h, before) for key, (n, h, _, before, _) in wanted.items()}
    found = {(r.g, r.at): (r.position, r.s0, r.b0) for r in plain.collect()}
    assert found == {key: (n, s, before) for key, (n, _, s, _, before) in wanted.items()}
