"""Plans: pruned scans, pushed filters, no products, Python only where named."""

import pytest

from textloom import queries

SF = "/root/testdata/sf0.001"
#: Queries whose operators run Arrow functions.
PYTHON = {
    "archive_members", "batch_packing", "batch_resume", "caption_packing", "content_replacement", "corpus_packing",
    "corpus_profile_delta", "corpus_term_claims", "corpus_term_pairs", "diagram_packing", "glossary_match_claims",
    "glossary_match_pairs", "glossary_replacement", "profile_delta", "sense_contexts", "lock_groups", "panel_reconciliation", "qa_glossary_targets", "recover_segments",
    "set_hash", "source_package", "story_index", "story_typography", "text_scalars_more", "typography_protected", "unit_positions", "workbook_round_trip",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_plan(name, spark):
    text = plan(queries.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert any(x in text for x in ("ArrowEvalPython", "MapInPandas", "FlatMapGroups")) == (name in PYTHON)


def test_scans_read_what_they_need(spark):
    text = plan(queries.typography_unit_nbsp(spark, SF))
    assert "ReadSchema: struct<l_partkey:bigint,l_linenumber:int,l_quantity:double>" in text and text.count("Exchange") == 2  # one deals out the only row group
    text = plan(queries.keyed_differences(spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text and "PushedFilters: [IsNotNull(o_orderkey)]" in text


def test_row_checks_are_one_pass(spark):
    from textloom.operators import qa

    text = plan(qa.row_issues(qa.paired(*queries._content_tables(spark, SF), []), language="German"))
    assert text.count("FileScan") == 2 and "Generate explode" in text
