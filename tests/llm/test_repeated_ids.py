from fleetgauge.llm import quality_trees, toxicity

LABELS = "doc_id long, quality int, toxic int"
TEXT = "some plain words of a text that goes on for a while and number "


def repeated(spark):
    """Forty documents, one of them with 3,000 rows of different texts, and their labels."""
    rows = [(i, TEXT + str(i)) for i in range(40)] + [(0, TEXT + f"again {n}") for n in range(2999)] + [(0, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return docs, spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], LABELS)


def test_a_repeated_id_is_one_document_of_the_toxicity_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda shares, targets: seen.append((len(shares), len(targets))))
    docs, labels = repeated(spark)
    toxicity.fit_toxicity(docs, labels)
    kept = labels.where(~toxicity.held_out(labels.doc_id, 4)).count()
    assert seen == [(kept, kept)]


def test_a_repeated_id_is_one_document_of_the_quality_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality_trees, "fit_trees", lambda inputs, targets, *_: seen.append(inputs.shape[0]))
    docs, labels = repeated(spark)
    quality_trees.fit_quality(docs, labels)
    assert seen == [40]
    texts = {r.text for r in quality_trees.labelled_sample(docs, labels, "quality", 100).collect()}
    assert texts == {TEXT + str(i) for i in range(40)}
