import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from fleetgauge.llm import language_codes
from fleetgauge.llm.language_codes import (
    BUCKETS, LONGEST_WORD, LanguageModel, buckets_of, codewords, fit_codes, fit_languages, gram_shares, predict_languages, words_of,
)

FOLDER = "/root/testdata/sf0.01"
LETTERS = {"aa": "abcdeo", "bb": "fghijo", "cc": "klmnpo", "dd": "qrstuo", "ee": "vwxyzo", "ff": "äöüßêo", "gg": "бвгдео", "hh": "εζηθιο"}


def sentence(language, words=30):
    return " ".join("".join(random.choices(LETTERS[language], k=random.randint(1, 7))) for _ in range(words))


def table(spark, n, languages):
    random.seed(5)
    rows = [(i, sentence(languages[i % len(languages)]), languages[i % len(languages)]) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4), {i: lang for i, _, lang in rows}


def test_words_are_letters():
    assert words_of("It's 5 o'clock, Straße_ÜBER x² ½ Ⅷ") == ["it", "s", "o", "clock", "straße", "über", "x"]
    assert words_of("a" * (LONGEST_WORD + 5)) == ["a" * LONGEST_WORD, "a" * 5]
    assert words_of(" 12 \n ½ ² _") == []


def test_grams_of_words_are_counted_alone_and_together():
    together, owners = buckets_of(["ab", "ñandú", "x"])
    alone = np.concatenate([buckets_of([word])[0] for word in ("ab", "ñandú", "x")])
    assert Counter(together.tolist()) == Counter(alone.tolist())
    # Marks included: 4 + 3 + 2, 7 + 6 + 5 and 3 + 2 + 1 n-grams.
    assert np.bincount(owners).tolist() == [9, 18, 6]
    found, shares = gram_shares(Counter({"ab": 2, "x": 1}))
    plain = Counter(buckets_of(["ab"])[0].tolist() * 2 + buckets_of(["x"])[0].tolist())
    assert dict(zip(found.tolist(), shares.tolist(), strict=True)) == pytest.approx({b: n / 24 for b, n in plain.items()})


@pytest.mark.parametrize("n", [1, 2, 3, 4, 6, 7, 40])
def test_codewords_differ(n):
    code = codewords(n).astype(int)
    assert set(np.unique(code)) <= {-1, 1} and len(code) == n
    distances = [(code[a] != code[b]).sum() for a in range(n) for b in range(a)]
    # Splits of four or more languages: any one wrong bit leaves the right word the nearest.
    assert min(distances, default=9) >= (3 if n >= 4 else n >= 2)


def test_margins_equal_a_dense_computation():
    random.seed(2)
    texts = [sentence(lang) for lang in list(LETTERS)[:4] * 8]
    languages = list(LETTERS)[:4] * 8
    shares = [gram_shares(Counter(words_of(text))) for text in texts]
    model = fit_codes(shares, languages)
    dense = np.zeros((len(texts), BUCKETS))
    for at, (found, share) in enumerate(shares):
        dense[at, found] = share
    margins = model.margins([Counter(words_of(text)) for text in texts])
    assert np.allclose(margins, dense @ model.weights + model.bias, atol=1e-3)
    decoded = model.decode(margins)
    for at, row in enumerate(margins):
        losses = [
            sum(t * np.log1p(np.exp(-np.clip(m, -6, 6) * c)) for m, c, t in zip(row, word, trust, strict=True))
            for word, trust in zip(model.code, model.trust, strict=True)
        ]
        plain = np.exp(-np.array(losses)) / np.exp(-np.array(losses)).sum()
        assert decoded[at] == pytest.approx(plain, abs=1e-6)
        assert model.languages[int(np.argmin(losses))] == languages[at]


def test_wrong_bits_are_corrected():
    code = codewords(5)
    model = LanguageModel(list("abcde"), code, np.full(code.shape, 8 / code.shape[1]), np.zeros((BUCKETS, code.shape[1])), None)
    for at, word in enumerate(code):
        for wrong in range(code.shape[1]):
            margins = 3.0 * word
            margins[wrong] *= -1
            assert model.decode(margins[None]).argmax() == at


@pytest.mark.parametrize("languages", [list(LETTERS)[:1], list(LETTERS)[:3], list(LETTERS)])
def test_held_out_languages(spark, languages):
    docs, wanted = table(spark, 240, languages)
    found = predict_languages(docs, fit_languages(docs)).collect()
    assert len(found) == 240 and {r.held_out for r in found} == {True, False}
    assert sum(r.lang_pred == wanted[r.doc_id] for r in found) >= 236
    assert all(0 <= r.score <= 1 for r in found)


def test_learns_from_the_right_rows_only(spark):
    docs, _ = table(spark, 60, ["aa", "bb"])
    model = fit_languages(docs)
    changed = docs.selectExpr("doc_id", "text", "IF(crc32(CAST(CAST(doc_id AS string) AS binary)) % 4 = 2, 'zz', lang) AS lang")
    again = fit_languages(changed)
    assert again.languages == ["aa", "bb"] and np.array_equal(model.weights, again.weights)
    # Repeated rows change nothing, one id with very many rows counts once.
    more = docs.union(docs.where("doc_id = 7").crossJoin(spark.range(200)).drop("id"))
    assert np.array_equal(fit_languages(more).weights, model.weights)


def test_sample_is_bounded(spark, monkeypatch):
    docs, _ = table(spark, 120, ["aa", "bb", "cc"])
    seen = []
    monkeypatch.setattr(language_codes, "fit_codes", lambda shares, languages: seen.append(Counter(languages)))
    fit_languages(docs, per_language=10)
    fit_languages(docs, per_language=10, in_all=7)
    assert seen == [{"aa": 10, "bb": 10, "cc": 10}, {"aa": 3, "bb": 2, "cc": 2}]


def test_odd_rows(odd, spark):
    docs, _ = table(spark, 60, ["aa", "bb"])
    found = predict_languages(odd, fit_languages(docs)).collect()
    assert len(found) == odd.count()
    texts = {r.doc_id: r for r in found}
    assert texts[3].lang_pred == "und" and texts[3].score == 0 and texts[9].lang_pred == "und"
    assert sorted(r.lang_pred for r in found if r.doc_id is None)[-1] == "und"
    assert {r.lang_pred for r in found} <= {"aa", "bb", "und"}
    assert predict_languages(odd.limit(0), None).isEmpty()
    assert {r.lang_pred for r in predict_languages(odd, None).collect()} == {"und"}
    assert fit_languages(odd.where("lang IS NULL")) is None and fit_languages(odd.limit(0)) is None
    assert fit_languages(odd).languages == ["de", "en"]


def test_a_million_letters(docs):
    run = "ab" * 500_000
    found = predict_languages(docs(run, "1" * 100_000), fit_codes([gram_shares(Counter(["ab"]))], ["aa"])).collect()
    assert [r.lang_pred for r in sorted(found, key=lambda r: r.doc_id)] == ["aa", "und"]


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
def test_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = predict_languages(docs, fit_languages(docs)).where("held_out").join(docs.selectExpr("doc_id", "lang"), "doc_id")
    right = found.selectExpr("avg(int(lang = lang_pred))").first()[0]
    assert right >= 0.98
