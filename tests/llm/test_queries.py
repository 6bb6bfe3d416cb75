"""Registered queries with SQL against that SQL, and each result's columns."""

from pathlib import Path

import pytest

from fleetgauge.llm.queries import ORACLES, QUERIES
from oracle.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    1: "doc_id held_out score predicted",
    2: "doc_id n_tokens ids_sha256 decoded_sha256",
    3: "page_id payload_bytes payload_digest record_type refers_to",
    4: "doc_id start n_tokens ids_crc32",
    5: "doc_id held_out n_tokens n_known train_tokens base_score score",
    6: "doc_id n_shingles component_id",
    7: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    8: "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    9: "doc_id piece start length ids_crc32 sequence_id offset",
    10: "doc_id n_tokens",
    11: "doc_id held_out lang_pred score",
    12: "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    13: "item_id rank doc_id score",
}

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    connection = connect(FOLDER)
    assert difference(QUERIES[name](spark, FOLDER), connection, ORACLES[name]) == ""
    connection.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns(spark, name):
    number = int(name[2:].split("_")[0])
    assert set(COLUMNS[number].split()) <= set(QUERIES[name](spark, FOLDER).columns)
