"""The package's registered queries against their SQL, and their columns, on the smallest tables."""

from __future__ import annotations

import pytest

from gridlake.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SMALL
from tests.oracle import compare, database

FIRST = {
    "op1_mixing": "doc_id size source_size target taken",
    "op2_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op3_line_dedup": "doc_id n_lines n_dropped kept_sha256",
    "op4_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op5_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op6_language_id": "doc_id held_out lang_pred score",
    "op7_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op8_url_filter": "page_id host path rule verdict",
    "op9_jaccard_join": "doc_id class_id n_links",
    "op10_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op11_substring_dedup": "doc_id n_words n_removed kept_sha256",
    "op12_source_divergence": "lang source part item value rank",
    "op13_collocations": "lang rank phrase a l r n score",
}
# Hashes of the operators that the other engine does not have, and a trained labelling.
WITHOUT_SQL = {"op1_mixing", "op6_language_id", "op10_sharding"}


@pytest.fixture(scope="module")
def connection():
    return database(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    count, _, problem = compare(spark, connection, name, SMALL)
    assert not problem and count > 0
    assert QUERIES[name](spark, SMALL).columns[: len(FIRST[name].split())] == FIRST[name].split()


def test_which_queries_have_sql():
    assert set(QUERIES) == set(FIRST) and set(QUERIES) - set(ORACLE_SQL) == WITHOUT_SQL
