import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetgauge.llm.library_tokens import LibraryEncoder
from fleetgauge.llm.token_files import Shard, read_token_files, write_token_files

END = 2


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_chunks_give_the_ids_of_whole_texts(vocabulary, name):
    own = LibraryEncoder(vocabulary(name), remembered=500)
    random.seed(1)
    texts = ["", "  ", "a\n\n b", "It's ÉÀ, é. İ. <|ENDOFTEXT|>. b.. x<|endoftext|> \n y", "tab\tend"]
    texts += ["".join(random.choices("ab'sZ 1\n\t .,Σé́ß中\x1c\x85", k=30)) for _ in range(500)]
    texts += [chr(i) + rest for i in range(1, 0x250) for rest in ("", "a", ".")]
    for start in range(0, len(texts), 100):
        part = texts[start : start + 100]
        found = [np.frombuffer(ids, "<u4").tolist() for ids in own.encode(part)]
        assert found == [one.ids for one in own.tokenizer.encode_batch(part, add_special_tokens=False)]


def test_files_hold_all_documents_in_order(spark, odd, vocabulary, tmp_path):
    path = vocabulary("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    manifest = write_token_files(odd, f"file://{tmp_path}/store", path, END)
    found = read_token_files(spark, f"file://{tmp_path}/store").orderBy("start").collect()
    order = odd.orderBy(F.asc_nulls_first("doc_id"), F.xxhash64("text"), F.asc_nulls_first("text"))
    order = [(row.doc_id, row.text) for row in order.select("doc_id", "text").collect()]
    start = 0
    for row, (doc, text) in zip(found, order, strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids + [END]
        assert (row.doc_id, row.start, row.n_tokens) == (doc, start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    entries = manifest.orderBy("docs_before").collect()
    assert [e.ids_before for e in entries] == list(np.cumsum([0] + [e.n_ids for e in entries[:-1]]))
    shard = Shard(f"file://{tmp_path}/store", entries[0].name, entries[0].dtype)
    assert isinstance(shard.ids, np.memmap) and shard.ids.dtype == np.uint16 and shard.offsets.dtype == np.uint64


def test_empty_table(spark, odd, vocabulary, tmp_path):
    write_token_files(odd.limit(0), str(tmp_path / "none"), vocabulary("word_bpe_49k.json"), END)
    assert read_token_files(spark, str(tmp_path / "none")).isEmpty()


def test_long_chunks_are_not_remembered(vocabulary):
    own = LibraryEncoder(vocabulary("word_bpe_49k.json"))
    text = "ab " * 10 + "x" * 100_000 + " é" + "ß" * 5_000
    own.encode([text])
    assert max(map(len, own.ids)) <= own.ids.longest and "ab" in own.ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_a_million_letters_without_white_space(spark, vocabulary, tmp_path, name):
    path, text = vocabulary(name), "abcdefghij" * 100_000
    docs = spark.createDataFrame([(1, text), (2, "b")], "doc_id long, text string")
    write_token_files(docs, str(tmp_path / "store"), path, END, "<u4")
    found = {row.doc_id: row for row in read_token_files(spark, str(tmp_path / "store")).collect()}
    ids = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids + [END]
    assert found[1].n_tokens == len(ids) and found[1].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
