"""The toxicity model against a dense computation, n-gram by n-gram."""

import random
from collections import Counter

import numpy as np

from fleetgauge.llm.toxicity import BUCKETS, FEW_GRAMS, N_GRAMS, PackedShares, gram_counts, gram_shares, pack, subwords, train, words_of


def texts(n):
    random.seed(12)
    word = lambda: "".join(random.choices("etaoinshr", k=random.randint(2, 8)))
    found = [" ".join(word() for _ in range(random.randint(5, 60))) for _ in range(n)]
    return [text + " nastyword" * (at % 3 == 0) for at, text in enumerate(found)], np.array([int(at % 3 == 0) for at in range(n)])


def plain_grams(text):
    """All n-grams of all words between marks, one after the other."""
    return [f"<{w}>"[at : at + n] for w in words_of(text) for n in N_GRAMS for at in range(len(w) + 3 - n)]


def test_counts_equal_a_plain_walk():
    text = "The the cat's Straße \U0001f600x nastywords"
    (found, counts), = gram_counts([Counter(words_of(text))])
    grams = Counter(plain_grams(text))
    assert counts.sum() == grams.total()
    # Every n-gram has the bucket that its word gives it, whatever the word.
    of_gram = {}
    for word in set(words_of(text)):
        buckets, _ = subwords([word])
        ordered = [f"<{word}>"[at : at + n] for n in N_GRAMS for at in range(len(word) + 3 - n)]
        for gram, bucket in zip(ordered, buckets.tolist(), strict=True):
            assert of_gram.setdefault(gram, bucket) == bucket
    wanted = Counter()
    for gram, n in grams.items():
        wanted[of_gram[gram]] += n
    assert dict(zip(found.tolist(), counts.tolist(), strict=True)) == wanted


def test_packed_shares_are_the_shares():
    bags = [Counter(words_of(text)) for text in texts(20)[0]] + [Counter({"abcdef": 70_000, "xy": 1})]
    for bag, (found, share) in zip(bags, gram_shares(bags), strict=True):
        again = PackedShares(pack(*gram_counts([bag])[0]))
        buckets, shares = again
        assert np.array_equal(buckets, found) and np.array_equal(shares, share)
    assert [len(side) for side in PackedShares(pack(np.empty(0, np.int32), np.empty(0)))] == [0, 0]


def test_scores_equal_a_dense_computation():
    some, targets = texts(90)
    shares = gram_shares([Counter(words_of(text)) for text in some])
    model = train(shares, targets)
    scores = model.score([*some, "", "?!", "nastywort unseen"])
    for text, score in zip([*some, "", "?!", "nastywort unseen"], scores, strict=True):
        dense = np.zeros(BUCKETS)
        n = 0
        for word in words_of(text):
            for bucket in subwords([word])[0].tolist():
                dense[bucket] += 1
                n += 1
        logit = dense @ model.weights / (n + FEW_GRAMS) + model.bias
        assert abs(score - 1 / (1 + np.exp(-logit))) < 1e-9
    assert (scores[:90][targets == 1].min() > scores[:90][targets == 0].max())


def test_training_steps_equal_dense_ones():
    """Two epochs by the rule, with whole matrices in double precision."""
    some, targets = texts(50)
    shares = gram_shares([Counter(words_of(text)) for text in some])
    model = train([*shares], targets, epochs=2, batch=16)
    random_, rate, decay = np.random.default_rng(7), 0.5, 1e-4
    order = random_.permutation(50)
    table = np.zeros((50, BUCKETS))
    for at, (found, share) in enumerate(shares):
        table[at, found] = share
    table, wanted = table[order], np.eye(2)[targets[order]]
    learnt = (table > 0).sum(axis=0) >= 1
    spread = np.sqrt(table[:, learnt].sum(axis=0) / 50 + 1e-7)
    table = table[:, learnt] / spread
    toxic = targets[order] == 1
    weight = np.where(toxic, 0.3 / toxic.sum(), 0.7 / (~toxic).sum()) * 50
    embedding, softmax, bias = np.zeros((table.shape[1], 4)), random_.normal(0, 1, (4, 2)), np.zeros(2)
    steps, step = 8, 0
    for _ in range(2):
        for start in range(0, 50, 16):
            part = slice(start, min(start + 16, 50))
            x, n = table[part], min(16, 50 - start)
            hidden = x @ embedding
            logits = hidden @ softmax + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            error = (p - wanted[part]) * weight[part, None] / n
            pace = rate * (1 - step / steps)
            touched = (x > 0).any(axis=0)
            back = error @ softmax.T
            embedding[touched] *= 1 - pace * decay
            embedding -= pace * (x.T @ back)
            softmax -= pace * (hidden.T @ error + decay * softmax)
            bias -= pace * error.sum(axis=0)
            step += 1
    dense = np.zeros(BUCKETS)
    dense[learnt] = embedding @ (softmax[:, 1] - softmax[:, 0]) / spread
    assert np.allclose(model.weights, dense, rtol=1e-3, atol=1e-3 * np.abs(dense).max())
    assert abs(model.bias - (bias[1] - bias[0])) < 1e-3
