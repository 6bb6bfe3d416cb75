import random
from collections import defaultdict

import numpy as np
import pytest

from fleetgauge.llm import jaccard_join
from fleetgauge.llm.components import connected
from fleetgauge.llm.jaccard_join import grouped_join, keep_one_of_each, near_duplicates, prefix_length, shingle_set


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[at : at + 5]) for at in range(len(words) - 4)}


def brute_force(rows):
    """(n_shingles, n_links, component_id) of each (doc_id, text), by looking at all pairs."""
    sets = [shingles(text) for _, text in rows]
    near = defaultdict(set)
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                near[a].add(b)
                near[b].add(a)
    found = []
    for at, (doc, _) in enumerate(rows):
        reached, front = {at}, {at}
        while front := {n for f in front for n in near[f]} - reached:
            reached |= front
        ids = [rows[r][0] for r in reached if rows[r][0] is not None]
        found.append((doc, len(sets[at]), len(near[at]), min(ids, default=None) if sets[at] else doc))
    return sorted(found, key=str)


def corpus(seed, n):
    """Random texts with exact copies, near copies, shared passages and short ones."""
    random.seed(seed)
    words = [f"w{i}" for i in range(60)]
    passage = random.choices(words, k=30)
    texts = []
    for at in range(n):
        kind = random.random()
        if texts and kind < 0.25:
            texts.append(random.choice(texts))
        elif texts and kind < 0.6:
            words_of = random.choice(texts).split()
            for _ in range(random.randint(1, 2)):
                if words_of:
                    words_of[random.randrange(len(words_of))] = random.choice(words).upper()
            texts.append(" ".join(words_of))
        elif kind < 0.7:
            texts.append(" ".join(random.choices(words, k=random.randint(0, 6))))
        else:
            texts.append(" ".join(random.choices(words, k=random.randint(5, 80)) + passage * (at % 2)))
    return list(enumerate(texts))


@pytest.mark.parametrize("shingles_of_a_block", [1 << 20, 300])
def test_equals_all_pairs(spark, monkeypatch, shingles_of_a_block):
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", shingles_of_a_block)
    rows = corpus(3, 250)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sorted((tuple(r) for r in near_duplicates(table).collect()), key=str)
    wanted = brute_force(rows)
    assert found == wanted and sum(links > 0 for _, _, links, _ in wanted) > 100


def test_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    found = sorted((tuple(r) for r in near_duplicates(odd).collect()), key=str)
    assert found == brute_force(rows)
    kept = keep_one_of_each(odd).collect()
    assert kept and set(kept[0].asDict()) == set(odd.columns)
    # One of the two equal rows of id 7 stays, and all rows without shingles do.
    assert sorted(str(r.doc_id) for r in kept) == ["1", "12", "3", "3", "7", "9", "None", "None"]
    assert near_duplicates(odd.limit(0)).isEmpty() and keep_one_of_each(odd.limit(0)).isEmpty()


def test_one_of_each_component_stays(spark):
    rows = corpus(8, 120)
    rows += [(5, "clash of ids " * 3 + str(i)) for i in range(3)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r.doc_id, r.text) for r in keep_one_of_each(table).collect()]
    near = brute_force(kept)
    assert all(links == 0 for _, _, links, _ in near)
    components = {component for _, size, _, component in brute_force(rows[:120]) if size}
    assert components <= {doc for doc, _ in kept}


def test_grouped_join_finds_every_pair():
    random.seed(4)
    sets = [np.unique(np.array(random.choices(range(40), k=random.randint(1, 30)), np.uint64)) for _ in range(120)]
    sides = np.array([at % 2 for at in range(120)])
    for among in (np.zeros(120, int), sides):
        found = {(min(a, b), max(a, b)) for a, others in grouped_join(sets, among, 75) for b in others.tolist()}
        wanted = set()
        for b in range(120):
            for a in range(b):
                common = len(np.intersect1d(sets[a], sets[b]))
                if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common) and (not among.any() or among[a] != among[b]):
                    wanted.add((a, b))
        assert found == wanted


def test_prefix_and_shingles():
    assert [prefix_length(n, 75) for n in (1, 4, 5, 8)] == [1, 2, 2, 3]
    assert len(shingle_set("a b c d")) == 1 and not len(shingle_set(" \t\n"))
    assert (shingle_set("A b c d e") == shingle_set("a\tB  c D\ne")).all()
    assert shingle_set("é b c d e") != shingle_set("É b c d e")


def test_components(spark):
    random.seed(6)
    pairs = [(random.randrange(300), random.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    found = {r.node: r.root for r in connected(spark.createDataFrame(pairs, "a long, b long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    assert found == {x: root(x) for a, b in pairs if a != b for x in (a, b)}
    assert connected(spark.createDataFrame([(1, 1), (None, 2)], "a long, b long")).isEmpty()
