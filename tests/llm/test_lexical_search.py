import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fleetgauge.llm import lexical_search
from fleetgauge.llm.lexical_search import rank_documents, terms_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), term) for term in TERM.findall(text or "")]


def brute_force(docs, items, best=20):
    found = [(doc, Counter(plain_terms(text))) for doc, text in docs]
    n_docs = sum(bool(c) for _, c in found)
    total = sum(c.total() for _, c in found)
    holding = Counter(term for _, c in found for term in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(plain_terms(text))
    out = []
    for item, terms in asked.items():
        scores = []
        for doc, counts in found:
            m = 100 - 25 + (25 * counts.total() * n_docs) // total if total else 0
            score = 0
            for term, repeats in terms.items():
                if tf := counts[term]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[term] + 1)))
                    score += repeats * weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(scores)[:best], 1)]
    return sorted(out, key=str)


def corpus(seed, n):
    random.seed(seed)
    words = [f"{c}{i}" for i in range(25) for c in ("w", "É", "Zz")] + ["the"] * 40 + ["straße", "日本", "x-y", "don't"]
    text = lambda k: random.choice((" ", ", ", "\n")).join(random.choices(words, k=k))
    docs = [(i, text(random.randint(0, 60))) for i in range(n)]
    docs += [(3, docs[3][1]), (None, docs[4][1]), (None, "the w1"), (n, None), (n + 1, ""), (n + 2, " .,! ")]
    items = [(i, text(random.randint(1, 9))) for i in range(30)] + [(7, "w1 w2"), (None, "w3"), (40, None), (41, "absent"), (42, "THE the")]
    return docs, items


def result(spark, docs, items, **options):
    tables = spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in rank_documents(*tables, **options).collect()), key=str)


def test_equals_a_plain_search(spark):
    docs, items = corpus(1, 200)
    found = result(spark, docs, items)
    assert found == brute_force(docs, items) and len(found) > 400


def test_small_blocks_bundles_and_slices(spark, monkeypatch):
    docs, items = corpus(2, 90)
    wanted = brute_force(docs, items, 5)
    monkeypatch.setattr(lexical_search, "BLOCK_DOCUMENTS", 7)
    monkeypatch.setattr(lexical_search, "BUNDLE_ITEMS", 4)
    assert result(spark, docs, items, best=5) == wanted
    monkeypatch.setattr(lexical_search, "SLICE_TERMS", 60)
    monkeypatch.setattr(lexical_search, "BLOCK_POSTINGS", 20)
    assert result(spark, docs, items, best=5) == wanted


@pytest.mark.parametrize("shares", [(1,), (0.02, 0.05, 0.1, 0.3, 0.6, 1)])
def test_number_of_owners_changes_nothing(spark, monkeypatch, shares):
    docs, items = corpus(3, 60)
    monkeypatch.setattr(lexical_search, "OWNER_SHARES", shares)
    assert result(spark, docs, items) == brute_force(docs, items)


def test_ties_go_by_id(spark):
    docs = [(i, "same words here") for i in random.sample(range(500), 300)] + [(900 + i, f"other {i}") for i in range(400)]
    found = result(spark, docs, [(1, "words")])
    least = sorted(doc for doc, text in docs if text == "same words here")[:20]
    assert [doc for _, _, doc, _ in sorted(found, key=lambda r: r[1])] == least


def test_odd_tables(spark, odd):
    items = spark.createDataFrame([(1, "word end a b"), (2, "ünïcode"), (3, "ELLÁS ελλάς")], "item_id long, text string")
    clashing = items.withColumns({name: F.lit("x") for name in ("term", "repeats", "rank", "score", "doc_id", "block", "bundle")})
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    wanted = brute_force(rows, [(r.item_id, r.text) for r in items.collect()])
    assert sorted((tuple(r) for r in rank_documents(odd, clashing).collect()), key=str) == wanted and wanted
    assert rank_documents(odd.limit(0), items).isEmpty() and rank_documents(odd, items.limit(0)).isEmpty()
    assert rank_documents(odd, items.where("item_id > 5")).columns == ["item_id", "rank", "doc_id", "score"]


def test_terms():
    text = "It's A-Ä über_Straße 12x\x00y\x7fz 日本 ÀÉ"
    assert [term.decode() for term in terms_of(text)] == plain_terms(text)
    assert "Ä" in plain_terms(text) and "ÀÉ" in plain_terms(text)


def test_a_long_document(spark):
    docs = [(1, "a" * 1_000_000 + " needle"), (2, "needle " * 100_000), (3, "other")]
    assert result(spark, docs, [(1, "needle")]) == brute_force(docs, [(1, "needle")])
