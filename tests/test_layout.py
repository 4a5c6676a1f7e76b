"""Boxes, filters, pairing and zones on small fixtures, and against plain models."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quirework.functions import expressions as E
from quirework.functions.labels import COPYRIGHTED, ID, NAMES, STRUCTURAL
from quirework.operators import layout, pairing, zones
from quirework.operators import words as W

DET = "doc_id long, det_id long, page_index long, label_id long, confidence double, x1 double, y1 double, x2 double, y2 double, model string"
PAGES = "doc_id long, page_index long, pdf_width double, pdf_height double, img_width long, img_height long, page_number long, page_number_end long, col_left_x1 double, col_left_x2 double, col_right_x1 double, col_right_x2 double, midpoint double"


def det(spark, rows):
    """rows: page, label, x1, y1, x2, y2 [, confidence [, doc]]."""
    return spark.createDataFrame([(r[7] if len(r) > 7 else 1, i, r[0], ID[r[1]], float(r[6]) if len(r) > 6 else 0.95, *map(float, r[2:6]), "medium") for i, r in enumerate(rows)], DET)


def pages(spark, n, w=1700, h=2200, pw=612.0, ph=792.0, mid=850.0, numbers=None):
    return spark.createDataFrame([(1, i, pw, ph, w, h, (numbers or {}).get(i, (i + 1, None))[0], (numbers or {}).get(i, (i + 1, None))[1], 100.0, 820.0, 880.0, 1600.0, mid) for i in range(n)], PAGES)


def test_label_sets():
    assert len(NAMES) == 21 and ID["KEY_ICON"] == 0 and ID["CITATION"] == 20
    assert set(COPYRIGHTED) == {"KEY_ICON", "PAGE_HEADER", "HEADNOTE_BRACKET", "HEADNOTE"}
    assert set(STRUCTURAL) == {"CASE_CAPTION", "DIVIDER", "CASE_METADATA", "CASE_SEQUENCE", "PAGE_NUMBER", "STATE_ABBREVIATION", "JUDGES", "TEXT_COLUMN", "DOCKET", "DATE", "COURT", "CITATION"}


def test_box_sizes(spark):
    r = layout.box_sizes(det(spark, [(0, "IMAGE", 10, 20, 110, 70)])).first()
    assert (r.width, r.height, r.center_x, r.center_y, r.area) == (100, 50, 60, 45, 5000)


def test_iou_and_containment(spark):
    d = det(spark, [(0, "IMAGE", 0, 0, 100, 100), (0, "IMAGE", 50, 50, 150, 150), (0, "IMAGE", 50, 50, 120, 120), (1, "IMAGE", 0, 0, 100, 100)])
    got = {(r.a_id, r.b_id): r for r in layout.overlapping_pairs(d).collect()}
    assert set(got) == {(0, 1), (0, 2), (1, 2)}
    assert got[0, 1].iou == pytest.approx(2500 / 17500)
    assert not got[0, 2].a_contains_b and got[1, 2].a_contains_b and got[1, 2].fully_inside


def test_scale_and_fallback(spark):
    p = pages(spark, 1, mid=0.0)
    r = layout.with_columns_fallback(p).first()
    assert (r.midpoint, r.col_left_x1, r.col_left_x2, r.col_right_x1, r.col_right_x2) == (850, 51, 816, 884, 1649)
    q = layout.to_points(det(spark, [(0, "IMAGE", 1700, 2200, 1700, 2200)]), p).first()
    assert (q.x0, q.y0) == (612, 792)


def test_reading_order(spark):
    d = det(spark, [(0, "IMAGE", 10, 500, 20, 510), (0, "IMAGE", 10, 50, 20, 60), (0, "IMAGE", 1000, 50, 1010, 60)])
    got = layout.reading_order(d, pages(spark, 1)).orderBy("place").collect()
    assert [r.det_id for r in got] == [1, 0, 2]


def test_empty_tables(spark):
    none, p = det(spark, [(0, "IMAGE", 0, 0, 1, 1)]).limit(0), pages(spark, 2)
    words = spark.createDataFrame([], "doc_id long, page_index long, word_no long, x0 double, y0 double, x1 double, y1 double, word string")
    assert pairing.pair_opinions(none, p).count() == 0
    assert zones.plan_full(none, p, words).count() == 0
    assert {(r.header_bottom, r.footer_top) for r in layout.margin_bounds(none, p).collect()} == {(0.0, 792.0)}
    assert layout.pages_without_abbreviation(none, p).count() == 0


def test_exclusions_round_half_to_even(spark):
    d = det(spark, [(0, "IMAGE", 10.5, 20, 50, 60), (0, "IMAGE", 31, 20, 50, 60)])
    ex = spark.createDataFrame([(1, 0, ID["IMAGE"], 20, 20)], "doc_id long, page_index long, label_id long, x long, y long")
    assert [r.det_id for r in layout.without_excluded(d, ex).collect()] == [1]


def test_key_icons_by_size(spark):
    rows = [(0, "KEY_ICON", 0, 0, 60, 30, 0.95), (1, "KEY_ICON", 0, 0, 64, 32, 0.95), (2, "KEY_ICON", 0, 0, 200, 60, 0.6), (3, "KEY_ICON", 0, 0, 62, 30, 0.6), (4, "KEY_ICON", 0, 0, 200, 60, 0.92), (5, "KEY_ICON", 0, 0, 60, 60, 0.95)]
    assert sorted(r.det_id for r in layout.plausible_key_icons(det(spark, rows), "doc_id").collect()) == [0, 1, 3, 4]


def machine(marks):
    """Pairing by a state: marks are (page, col, y, kind, id) in order."""
    pairs, pending = [], None
    for m in sorted(marks):
        if m[3] == 0:
            pending = pending or m
        elif pending:
            pairs.append((pending[4], m[4]))
            pending = None
    return pairs


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.booleans(), st.integers(0, 6), st.booleans()), max_size=25))
def test_pairing_equals_state_machine(spark, marks):
    rows = [(p, "KEY_ICON" if k else "CASE_CAPTION", 1000 if right else 100, y * 100, 1000 + 60 if right else 160, y * 100 + 30, 0.95) for p, right, y, k in marks]
    want = machine([(r[0], int(r[2] > 850), float(r[3]), int(r[1] == "KEY_ICON"), i) for i, r in enumerate(rows)])
    if rows:
        got = pairing.pair_opinions(det(spark, rows), pages(spark, 4)).orderBy("opinion").collect()
        assert [(r.caption_id, r.key_id) for r in got] == want


def test_opinion_numbers_and_names(spark):
    d = det(spark, [(0, "CASE_CAPTION", 100, 100, 400, 150), (2, "KEY_ICON", 100, 500, 160, 530), (2, "CASE_CAPTION", 100, 800, 400, 850), (2, "KEY_ICON", 100, 900, 160, 930)])
    p = pages(spark, 3, numbers={0: (677, 685), 2: (0, None)})
    o = pairing.with_file_names(pairing.with_page_numbers(pairing.pair_opinions(d, p), p, 10)).orderBy("opinion").collect()
    assert [(r.first_number, r.last_number) for r in o] == [(685, 12), (12, 12)]
    assert o[1].file_name == "vol.1.0012-0012.pdf"


COLUMNS = [(0, "TEXT_COLUMN", 78, 164, 597, 1811, 0.95), (0, "TEXT_COLUMN", 620, 168, 1138, 1803, 0.95)]


@pytest.mark.parametrize("cap_x,key_x,parts", [(100, 650, ["after-right", "before-left"]), (650, 650, ["after-right", "before-left", "before-right"]), (100, 100, ["after-left", "after-right", "before-left"])])
def test_outside_rects_keep_to_columns(spark, cap_x, key_x, parts):
    d = det(spark, [*COLUMNS, (0, "CASE_CAPTION", cap_x, 300, cap_x + 400, 400), (0, "KEY_ICON", key_x, 900, key_x + 100, 950)])
    p = spark.createDataFrame([(1, 0, 612.0, 792.0, 1207, 1938, 1, None, 0.0, 0.0, 0.0, 0.0, 600.0)], PAGES)
    got = pairing.outside_rects(d, p, pairing.pair_opinions(d, p)).collect()
    assert sorted(r.part for r in got) == parts
    s = 612 / 1207
    for r in got:
        assert (r.x0, r.x1) == ((pytest.approx(78 * s), pytest.approx(597 * s)) if r.part.endswith("left") else (pytest.approx(620 * s), pytest.approx(1138 * s)))


def test_outside_rects_need_two_columns(spark):
    d = det(spark, [COLUMNS[0], (0, "CASE_CAPTION", 100, 300, 500, 400), (0, "KEY_ICON", 100, 900, 200, 950)])
    p = pages(spark, 1)
    assert pairing.outside_rects(d, p, pairing.pair_opinions(d, p)).count() == 0


def cut(r, holes):
    """Subtraction by recursion."""
    for h in holes:
        if r[0] < h[2] and h[0] < r[2] and r[1] < h[3] and h[1] < r[3]:
            top, bot = max(r[1], h[1]), min(r[3], h[3])
            parts = [(r[0], r[1], r[2], h[1]), (r[0], h[3], r[2], r[3]), (r[0], top, h[0], bot), (h[2], top, r[2], bot)]
            return [x for p in parts if p[0] < p[2] and p[1] < p[3] for x in cut(p, holes)]
    return [r]


def test_subtraction_equals_recursion(spark):
    rng = random.Random(3)
    box = lambda: (lambda x, y: (float(x), float(y), float(x + rng.randint(1, 9)), float(y + rng.randint(1, 9))))(rng.randint(0, 12), rng.randint(0, 12))
    cases = [(i, box(), [box() for _ in range(rng.randint(0, 4))]) for i in range(120)]
    kind = "struct<x0: double, y0: double, x1: double, y1: double>"
    df = spark.createDataFrame(cases, f"i long, r {kind}, h array<{kind}>").select("i", E.subtract_rects("r", "h").alias("p"))
    for r in df.collect():
        assert sorted(map(tuple, r.p)) == sorted(cut(cases[r.i][1], cases[r.i][2]))


def test_tighten_to_words(spark):
    rect = spark.createDataFrame([(1, 0, 0, 50.0, 150.0, 400.0, 300.0), (1, 1, 0, 400.0, 400.0, 600.0, 600.0)], "doc_id long, det_id long, page_index long, x0 double, y0 double, x1 double, y1 double")
    words = spark.createDataFrame([(1, 0, 0, 100.0, 200.0, 140.0, 212.0, "a"), (1, 0, 1, 150.0, 220.0, 180.0, 232.0, "b"), (1, 0, 2, 400.0, 200.0, 420.0, 212.0, "edge")], "doc_id long, page_index long, word_no long, x0 double, y0 double, x1 double, y1 double, word string")
    a, b = W.tighten(rect, words, "doc_id", "det_id").orderBy("det_id").collect()
    assert (a.x0, a.y0, a.x1, a.y1, a.tight) == (98, 198, 182, 234, True)
    assert (b.x0, b.y0, b.x1, b.y1, b.tight) == (400, 400, 600, 600, False)


def test_case_sequence_is_cut_above_captions(spark):
    d = det(spark, [(0, "CASE_SEQUENCE", 100, 100, 200, 110), (0, "CASE_CAPTION", 100, 110, 400, 300)])
    p = pages(spark, 1, w=612, h=792)
    r = zones.case_sequence_rects(d, p).first()
    assert (r.x0, r.x1, r.y0, r.y1) == (123, 177, 88, 110)


def test_zone_between_caption_and_divider(spark):
    d = det(spark, [(0, "CASE_CAPTION", 100, 100, 400, 200), (0, "HEADNOTE", 100, 300, 400, 400), (0, "DIVIDER", 1000, 700, 1400, 710), (1, "KEY_ICON", 100, 500, 160, 530)])
    p = pages(spark, 2)
    got = {(r.page_index, r.side): (r.y0, r.y1) for r in zones.headnote_zones(pairing.pair_opinions(d, p), d, p).collect()}
    s = 792 / 2200
    assert got == {(0, 0): (pytest.approx(200 * s), 792.0), (0, 1): (0.0, pytest.approx(700 * s))}


def test_split_ranges(spark):
    d = spark.createDataFrame([(1, 10), (2, 2)], "doc_id long, page_count long")
    got = layout.split_page_ranges(d, 4).orderBy("doc_id", "chunk").collect()
    assert [(r.page_start, r.page_end) for r in got] == [(0, 3), (3, 6), (6, 9), (9, 10), (0, 1), (1, 2)]


def test_whole_run(spark):
    from quirework.plans import volumes

    d = det(spark, [*COLUMNS, (0, "CASE_CAPTION", 100, 300, 500, 400), (0, "HEADNOTE", 100, 500, 400, 600), (0, "DIVIDER", 100, 700, 400, 710), (1, "KEY_ICON", 100, 500, 160, 530)])
    p = pages(spark, 2)
    words = spark.createDataFrame([(1, 0, 0, 40.0, 190.0, 60.0, 200.0, "w")], "doc_id long, page_index long, word_no long, x0 double, y0 double, x1 double, y1 double, word string")
    blocks = spark.createDataFrame([(1, 0, 0, 50.0, 50.0, 500.0, 700.0, "text", 0)], "doc_id long, page_index long, block_no long, x0 double, y0 double, x1 double, y1 double, text string, block_type long")
    run = volumes.process(d, p, words, blocks)
    assert [r.file_name for r in run["opinions"].collect()] == ["vol.1.0001-0002.pdf"]
    assert {r.type for r in run["redaction_rects"].collect()} == {"headnote", "DIVIDER", "KEY_ICON"}
    assert {r["mode"] for r in run["output_plan"].collect()} == {"full", "redacted", "unredacted"}
    assert run["margin_rects"].count() == 4 and run["stamps"].count() == 1 and run["scan_names"].first().file_name == "vol.1.1.2.redacted.pdf"


def test_arriving_volumes(spark, tmp_path):
    from quirework.streaming.arriving import detection_stream, pair_arriving

    d = det(spark, [(0, "CASE_CAPTION", 100, 100, 400, 150), (1, "KEY_ICON", 100, 500, 160, 530)])
    d.write.parquet(f"{tmp_path}/in/a")
    q = pair_arriving(detection_stream(spark, f"{tmp_path}/in/*"), pages(spark, 2), f"{tmp_path}/out", f"{tmp_path}/ck")
    q.awaitTermination(120)
    assert [(r.caption_page, r.key_page) for r in spark.read.parquet(f"{tmp_path}/out").collect()] == [(0, 1)]
