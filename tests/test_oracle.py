"""Every named query against its SQL on the smallest data."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from caseloom.operators import similarity

SF = "/root/testdata/sf0.001"
#: The smallest table has no training cases beside the golden ones: all that retrieves is compared on the next one.
LARGER = dict.fromkeys(
    "M5_corpus_postings M5_corpus_cases J8_rare_term_search W7_top_cases M4_retrieval G1_evidence_block G2_reply_prompt G3_provider_replies "
    "G6_batch_triage G6_model_triage G1_evidence_replies G7_sample_batch H1_judge_prompt H8_judge_run S12_loaded_index S12_segmented_index X3_stream_triage".split(),
    "sf0.01",
)
SLOW = {"M6_classifier_report", "M7_batch_predictions", "S12_saved_classifier", "G6_model_triage"}
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query(spark, con, name):
    sf = SF.replace("sf0.001", LARGER[name]) if name in LARGER else SF
    assert compare(spark, connect(sf) if name in LARGER else con, name, QUERIES[name], entry.oracle_sql().get(name), sf) is None


@pytest.mark.parametrize("name", ["G1_evidence_block", "M4_retrieval"])
def test_searches_without_rows_of_pairs(spark, monkeypatch, name):
    """Many queries: no pair of a query and a posting becomes a row, and the result is that of the SQL."""
    monkeypatch.setattr(similarity, "MOST_PAIRS", 0, raising=False)
    monkeypatch.setattr(similarity, "_search_blocks", None)
    sf = SF.replace("sf0.001", "sf0.01")
    assert compare(spark, connect(sf), name, QUERIES[name], entry.oracle_sql()[name], sf) is None


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["intent", "n", "percentage"] and df.count() > 0


def test_larger_names_queries():
    assert set(LARGER) <= set(QUERIES)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(QUERIES)
