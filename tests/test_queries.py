"""Registered queries against their SQL counterparts on the smallest tables."""

import os

import pytest

from quirework.plans import registry

from oracle import duck, rows_of

SF = "/root/testdata/sf0.001"
#: One of each family; all of them take several minutes.
CHOSEN = ["w5_repaired_numbers", "j6_fused_models", "snk13_footnote_flow", "z7_set_lines", "x10_detected_columns", "snk20_rotated_pages", "snk16_bitonal_pages", "snk22_burnt_pages", "snk24_report", "src2_detection_files", "src5_margin_files", "f2_copyrighted_structural", "f4_without_excluded", "f5_approved", "f19_mislabeled", "a16_issues_by_severity", "j2_pair_opinions", "p6_overlapping_pairs", "f8_trim_abbreviations", "a5_margin_bounds", "z3_zone_rects", "j5_protected_headers", "j16_footnotes_kept", "u5_issues", "j12_page_map", "x6_decided_readings", "snk3_opinion_records", "src14_volume_names"]
NAMES = sorted(registry.oracle_sql()) if os.environ.get("ALL_QUERIES") else CHOSEN


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, name):
    got, want = rows_of(registry.queries()[name](spark, SF)), duck(registry.oracle_sql()[name], SF)
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_entry_points():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert "j2_pair_opinions" in e.queries()
