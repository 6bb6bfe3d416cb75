import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetgauge.llm import fingerprints
from fleetgauge.llm.fingerprints import _segments, fingerprint_documents
from fleetgauge.llm.token_files import Shard, read_token_files, write_token_files


@pytest.mark.parametrize("hot", [5, None])
def test_a_hot_id_fills_several_shards_in_order(spark, vocabulary, tmp_path, hot):
    random.seed(6)
    path = vocabulary("word_bpe_49k.json")
    rows = [(hot, " ".join(random.choices("abcdefgh", k=40))) for _ in range(600)] + [(i, f"text {i}") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shards = write_token_files(docs, str(tmp_path / "store"), path, 2).orderBy("docs_before").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(shard.n_docs for shard in shards) < 400
    stored = [ids.tolist() for s in shards for shard in [Shard(str(tmp_path / "store"), s.name, s.dtype)] for ids in shard]
    library = Tokenizer.from_file(path)
    ordered = docs.orderBy(F.asc_nulls_first("doc_id"), F.xxhash64("text"), "text").collect()
    assert stored == [[*library.encode(text, add_special_tokens=False).ids, 2] for _, text in ordered]
    assert read_token_files(spark, str(tmp_path / "store")).count() == len(rows)


@pytest.mark.parametrize("hot", [5, None, (1 << 63) - 1])
def test_fingerprints_of_a_hot_id_are_dealt_further(spark, monkeypatch, hot):
    """Half of the rows have one id: no bucket holds much more than its share, and each gives one row to another."""
    random.seed(7)
    rows = [(hot, " ".join(random.choices("abcdefgh", k=12))) for _ in range(800)] + [(i * 3, f"text {i}") for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    seen = []
    monkeypatch.setattr(fingerprints, "map_batches", lambda df, *_: seen.append(df) or df)
    fingerprint_documents(docs, 8)
    dealt = seen[0].groupBy("bucket").agg(F.count_if("only_next").alias("copies"), F.count("*").alias("rows")).collect()
    assert max(row.rows for row in dealt) < 260 and sum(row.rows - row.copies for row in dealt) == 1_600
    assert {row.copies for row in dealt} == {1}
    monkeypatch.undo()
    found = fingerprint_documents(docs, 8)
    assert found.count() == 1_600 and found.where("near_next = 1").count() < 40


def test_many_equal_rows(spark):
    docs = spark.range(900).selectExpr("IF(id < 600, 4, id) AS doc_id", "IF(id < 600, 'the same text', concat('other ', id)) AS text")
    found = fingerprint_documents(docs, 4)
    assert found.count() == 900 and found.where("doc_id = 4 AND near_next = 1").count() == 599


def test_segments():
    edges, groups = _segments([3, 7, 7, 7, 8, 20], 4)
    assert edges.tolist() == [3, 7, 8, 20] and groups.tolist() == [4, 1, 1, 3, 1, 1]
    edges, groups = _segments([], 1)
    assert edges.tolist() == [] and groups.tolist() == [1, 1]
    edges, groups = _segments([(1 << 63) - 1] * 3, 1)
    assert edges.tolist() == [(1 << 63) - 1] and groups.tolist() == [1, 1, 3]
