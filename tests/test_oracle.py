"""Every registered query against its SQL, on the small and on the large-input paths."""

import compare
import pytest

from corpusprep.catalog import ORACLES, QUERIES

SF = f"{compare.DATA}/sf0.001"

# Queries whose operators choose a path by input size.
SIZED = """
concat_ordered merge_selected pack_batches fixed_chunks split_in_order inherit_page page_buckets
chunk_manifest monotone_filter window_filter drop_sections drop_contaminated page_asof next_marker
tail_ranges remove_ranges merge_ranges dedupe_refs caption_lookahead fence_state section_starts
edit_nearest edit_section attach_captions apply_replacements resolve_links asset_manifest
cache_misses cache_status translate_cached missing_numbers error_summary envelope_roundtrip
stream_monotone_filter export_chunks export_lifecycle merged_labels revision_align
""".split()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare.differences(spark, con, name, SF, QUERIES, ORACLES) in ([], ["no rows at all"])


@pytest.mark.parametrize("name", SIZED)
def test_query_at_scale(spark, con, at_scale, name):
    assert compare.differences(spark, con, name, SF, QUERIES, ORACLES) in ([], ["no rows at all"])


def test_entry_has_rows():
    import __spark_entry__ as contract

    assert contract.FLAGSHIP in contract.queries()
    assert set(contract.oracle_sql()) <= set(contract.queries())
