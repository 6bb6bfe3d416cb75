import math
import random
import zlib
from collections import Counter

import numpy as np

from fleetgauge.llm.lattice import Pieces, expected_counts, log_probabilities, score_documents
from fleetgauge.llm.quality_trees import FEATURES, fit_quality, fit_trees, keep_quality, score_quality, statistics
from fleetgauge.llm.token_counts import CountingTrie, count_tokens
from fleetgauge.llm.toxicity import drop_toxic, fit_toxicity, score_toxicity, subwords, words_of

LABELS = "doc_id long, quality int, toxic int"


def fold(doc, modulus):
    return doc is not None and zlib.crc32(str(doc).encode()) % modulus == 2


# --- quality -----------------------------------------------------------------------------------


def brute_counts(text):
    words = (text or "").encode().split()
    windows = Counter(tuple(words[at : at + 3]) for at in range(len(words) - 2))
    again = {at + n for at in range(len(words) - 2) if windows[tuple(words[at : at + 3])] > 1 for n in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(len(w.decode()) for w in words), symbols, dup, len(again)


def test_statistics_equal_brute_force():
    random.seed(1)
    texts = ["", " \n", "a a a", "é é\né é\n\n \n", "x | y # z\x0bq"]
    texts += ["".join(random.choices("ab é\n\t#|", k=random.randint(0, 80))) for _ in range(300)]
    for text in texts:
        assert statistics(text)[0] == brute_counts(text)


def test_trees_heed_the_constraints():
    random.seed(2)
    rng = np.random.default_rng(2)
    x = rng.random((600, 2))
    y = ((x[:, 0] > 0.5) ^ (rng.random(600) < 0.1)).astype(float)
    y[(x[:, 0] > 0.8)] = 0  # a fall that the constraint forbids to follow
    trees = fit_trees(x, y, np.array([1, 0]))
    grid = np.stack([np.linspace(0, 1, 200), np.full(200, 0.5)], axis=1)
    assert (np.diff(trees.probability(grid)) >= -1e-12).all()
    free = fit_trees(x, y, np.array([0, 0]))
    assert (np.diff(free.probability(grid)) < -0.2).any()


def good(i):
    random.seed(i)
    return " ".join("".join(random.choices("etaoinshr", k=random.randint(2, 8))) for _ in range(120)) + "."


def test_quality_of_labelled_and_odd_rows(spark, odd):
    texts = {i: good(i) if i % 3 else "%%% ".join(good(i).split()) for i in range(150)}
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(100)], LABELS)
    trees = fit_quality(docs, labels)
    found = {r.doc_id: r for r in score_quality(docs, trees).collect()}
    assert all(found[i].kept == (i % 3 > 0) for i in texts)
    assert {r.doc_id for r in keep_quality(docs, trees).collect()} == {i for i in texts if i % 3}
    rows = score_quality(odd, trees).collect()
    wanted = Counter((r.doc_id, *brute_counts(r.text)) for r in odd.collect())
    assert Counter(tuple(r)[:6] for r in rows) == wanted
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert fit_quality(docs, labels.limit(0)) is None
    assert {r.doc_id for r in keep_quality(docs, None).collect()} == set(texts)
    assert keep_quality(odd, trees).columns == odd.columns and score_quality(odd.limit(0), trees).isEmpty()
    assert len(FEATURES) == len(statistics("a")[1])


# --- toxicity ----------------------------------------------------------------------------------


def test_toxicity_learns_and_spots_misspellings(spark, odd):
    bad = ["nastyword", "vilephrase", "grimterm"]
    texts = {}
    for i in range(400):
        random.seed(i)
        words = good(i).split()
        if i % 4 == 0:
            for _ in range(4):
                words[random.randrange(len(words))] = random.choice(bad)
        texts[i] = " ".join(words)
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    # Labels of held-out rows are turned round: none of them may be learnt from.
    labels = [(i, 1, int((i % 4 == 0) != fold(i, 4))) for i in range(400)]
    model = fit_toxicity(docs, spark.createDataFrame(labels, LABELS))
    found = {r.doc_id: r for r in score_toxicity(docs, model).collect()}
    held = [i for i in texts if fold(i, 4)]
    assert all(found[i].held_out == (i in set(held)) for i in texts)
    assert sum(found[i].predicted == (i % 4 == 0) for i in held) > 0.97 * len(held)
    plain = good(1001)
    misspelt = plain + " nastywrod vilephrasee grimmterm nastywordd"
    assert model.score([misspelt])[0] > 3 * model.score([plain])[0]
    assert {r.doc_id for r in drop_toxic(docs, model).collect()} == {i for i in texts if found[i].score < 0.3}
    rows = score_toxicity(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert drop_toxic(odd, model).columns == odd.columns and score_toxicity(odd.limit(0), model).isEmpty()
    assert fit_toxicity(docs, spark.createDataFrame(labels[:0], LABELS)) is None
    assert {r.score for r in score_toxicity(odd, None).collect()} == {0.0}


def test_subwords_do_not_cross_words():
    buckets, owners = subwords(["ab", "abc", ""])
    assert Counter(owners.tolist()) == {0: 3, 1: 6}
    assert (buckets[owners == 0] == subwords(["ab"])[0]).all()
    assert words_of("One, TWO!! *x* a-b '") == ["one", "two", "x", "a-b"]


# --- language model and token counts -----------------------------------------------------------

SCORES = {"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -3.1, "▁a": -2.2, "ba": -4.0, "aba": -5.0}


def all_cuts(word, pieces):
    names = {piece: i for i, piece in enumerate(SCORES)}
    if not word:
        return [(0.0, [])]
    cuts = []
    for size in range(1, 4):
        if len(word) >= size and word[:size] in names:
            i = names[word[:size]]
            cuts += [(score + pieces.scores[i], [i, *rest]) for score, rest in all_cuts(word[size:], pieces)]
    if word[0] not in names:
        spelt = [pieces.count + byte for byte in word[0].encode()]
        cuts += [(s + pieces.scores[spelt].sum(), spelt + rest) for s, rest in all_cuts(word[1:], pieces)]
    return cuts


def test_recursions_equal_all_cuts():
    pieces = Pieces(SCORES)
    words = ["▁abab", "▁a", "▁bbaé", "▁abababa", "▁中a", "▁"]
    cuts = [all_cuts(word, pieces) for word in words]
    totals = [math.log(sum(math.exp(score) for score, _ in found)) for found in cuts]
    assert np.allclose(log_probabilities(words, pieces), totals)
    times = np.arange(1.0, 7.0)
    wanted = np.zeros(pieces.end + 2)
    for found, total, count in zip(cuts, totals, times, strict=True):
        for score, used in found:
            np.add.at(wanted, used, count * math.exp(score - total))
    assert np.allclose(expected_counts(words, times, pieces), wanted)


def test_scores_of_documents(spark, odd, vocabulary):
    path = vocabulary("piece_bpe_32k.model")
    texts = {i: " ".join(good(i // 3).split()[: 5 + i]) + " Shared words, AND more" for i in range(40)}
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string").repartition(3)
    for table, rows in ((docs, list(texts.items())), (odd, [(r.doc_id, r.text) for r in odd.collect()])):
        train = Counter()
        ends = 0
        for doc, text in rows:
            if not fold(doc, 7):
                train.update((text or "").encode().lower().split())
                ends += 1
        n, v = sum(train.values()) + ends, len(train) + 1
        wanted = Counter()
        for doc, text in rows:
            counts = [train[w] for w in (text or "").encode().lower().split()] + [ends]
            base = sum(math.log10((c + 1) / (n + v + 1)) for c in counts)
            wanted[doc, fold(doc, 7), len(counts), sum(c > 0 for c in counts), n, round(base, 6)] += 1
        found = score_documents(table, path).collect()
        assert Counter((*tuple(r)[:5], round(r.base_score, 6)) for r in found) == wanted
        assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    by_id = {r.doc_id: r for r in score_documents(docs, path).collect()}
    known = [r for r in by_id.values() if not r.held_out]
    assert sum(r.score for r in known) > sum(r.base_score for r in known) - 0.05 * abs(sum(r.base_score for r in known))
    assert score_documents(odd.limit(0), path).isEmpty()


def best_cut(word, scores, spelt):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        size = len(word[end - 1].encode())
        ways = [(best[end - 1][0] + size * spelt, -(best[end - 1][1] + size))]
        ways += [
            (best[s][0] + scores[word[s:end]], -(best[s][1] + 1)) for s in range(end) if word[s:end] in scores
        ]
        score, pieces = max(ways)
        best.append((score, -pieces))
    return best[-1][1]


def test_trie_counts_equal_a_plain_recursion(odd, vocabulary):
    random.seed(9)
    trie = CountingTrie(SCORES)
    for _ in range(400):
        word = "▁" + "".join(random.choices("abé", k=random.randint(0, 12)))
        assert trie.count(word) == best_cut(word, SCORES, trie.byte_score)
    assert trie.count("▁aba") == trie.count("▁aba") and len(trie.best) == len(trie.children) + 1
    from fleetgauge.llm.token_counts import piece_scores

    path = vocabulary("piece_bpe_32k.model")
    scores = piece_scores(path)
    spelt = min(scores.values()) - 10.0
    wanted = Counter()
    for row in odd.collect():
        words = [w.decode() for w in (row.text or "").encode().split()]
        wanted[row.doc_id, len(words), sum(best_cut("▁" + w, scores, spelt) for w in words)] += 1
    assert Counter(map(tuple, count_tokens(odd, path).collect())) == wanted
    assert count_tokens(odd.limit(0), path).isEmpty()
