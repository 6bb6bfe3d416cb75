import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from fleetgauge.llm.quality_trees import FEATURES, base_failed, fit_trees, statistics
from fleetgauge.llm.toxicity import gram_counts, gram_shares, pack, train, words_of
from test_jaccard_join import brute_force

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Labelled documents: plain ones, junk, toxic ones, exact and near copies, short and missing texts."""
    path = tmp_path_factory.mktemp("corpus")
    random.seed(11)
    word = lambda: "".join(random.choices("etaoinshr", k=random.randint(2, 8)))
    rows, labels = [], []
    for i in range(240):
        words = [word() for _ in range(random.randint(55, 140))]
        kind = i % 6
        if kind == 1:
            words = [w + random.choice(("%%%", "$$$", "***")) for w in words]
        elif kind == 2:
            for at in random.sample(range(len(words)), 5):
                words[at] = random.choice(("nastyword", "vilephrase"))
        elif kind == 3 and len(rows) > 8:
            words = rows[-3][1].split()
            words[random.randrange(len(words))] = word()
        elif kind == 4 and i % 12 == 4:
            words = words[:20]
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, int(kind != 1), int("nastyword" in words or "vilephrase" in words)))
    rows += [(500, None, "en", "s", 0), (501, "", "en", "s", 0), (502, rows[0][1], "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{path}/documents.parquet"
    )
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), rows, labels


def plainly(rows, labels, path, capacity):
    """The pipeline on one machine, pair by pair; the models are the library's, fitted on the same rows."""
    quality = {doc: q for doc, q, _ in labels}
    toxic = {doc: t for doc, _, t in labels}
    found = {row[0]: statistics(row[1] or "") for row in rows}
    fitted = sorted((quality[doc], list(found[doc][1])) for doc in found if doc in quality)
    trees = fit_trees(
        np.array([x for _, x in fitted]), np.array([q == 0 for q, _ in fitted], float), np.array([*FEATURES.values()])
    )
    poor = trees.probability(np.array([found[row[0]][1] for row in rows]))
    failed = base_failed(np.array([found[row[0]][0] for row in rows]))
    rows = [row for row, p, f in zip(rows, poor, failed, strict=True) if p < 0.5 and not f]

    sample = [row for row in rows if row[0] in toxic and zlib.crc32(str(row[0]).encode()) % 4 != 2]
    bags = [Counter(words_of(row[1])) for row in sample]
    shares, packed = gram_shares(bags), [pack(*pair) for pair in gram_counts(bags)]
    order = sorted(range(len(sample)), key=lambda at: (toxic[sample[at][0]], packed[at]))
    model = train([shares[at] for at in order], np.array([toxic[sample[at][0]] for at in order]))
    scores = model.score([row[1] for row in rows])
    rows = [row for row, score in zip(rows, scores, strict=True) if score < 0.3]

    component = {doc: c for doc, _, _, c in brute_force([(row[0], row[1]) for row in rows])}
    rows = [row for row in rows if component[row[0]] == row[0]]
    library = Tokenizer.from_file(path)
    pieces = Counter()
    for row in rows:
        ids = library.encode(row[1], add_special_tokens=False).ids + [0]
        starts = [0, *range(len(ids) % capacity or capacity, len(ids), capacity)]
        for piece, (start, stop) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            pieces[row[0], piece, start, stop - start, zlib.crc32(np.array(ids[start:stop], "<u4").tobytes())] += 1
    return pieces


def test_run_equals_a_plain_version(spark, folder, vocabulary):
    path, rows, labels = folder
    found = corpus_pipeline.run(spark, path).collect()
    wanted = plainly(rows, labels, vocabulary("byte_bpe_50k.json"), corpus_pipeline.SEQUENCE_TOKENS)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == wanted
    kept = {r.doc_id for r in found}
    assert not kept & {500, 501, 502} and len(kept) > 60
    assert not kept & {doc for doc, quality, _ in labels if not quality}


def test_stages_keep_the_columns(spark, folder):
    path = folder[0]
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == COLUMNS
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "near_duplicates", "packing"]


def test_empty_documents(spark, folder, tmp_path):
    path = folder[0]
    spark.read.parquet(f"{path}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{path}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).isEmpty()
