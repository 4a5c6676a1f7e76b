"""Queries on boxes, filters, joins and aggregates of detections."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quirework.functions import expressions as E
from quirework.functions.labels import ID
from quirework.operators import layout, pairing, words as W, zones
from quirework.plans.common import query

LAYOUT = ["doc_id", "det_id"]


@query("p1_box_sizes", "SELECT doc_id, det_id, x2 - x1 AS width, y2 - y1 AS height, (x1 + x2) / 2 AS center_x, (y1 + y2) / 2 AS center_y, (x2 - x1) * (y2 - y1) AS area FROM det")
def _(v):
    return layout.box_sizes(v.detections).select(*LAYOUT, "width", "height", "center_x", "center_y", "area")


@query("p2_to_points", "SELECT doc_id, det_id, page_index, x0, y0, x1, y1 FROM pts")
def _(v):
    return layout.to_points(v.detections, v.pages).select(*LAYOUT, "page_index", *E.RECT)


@query("p4_reading_order", """SELECT d.doc_id, d.page_index, det_id, CASE WHEN (x1 + x2) / 2 < midpoint THEN 0 ELSE 1 END::BIGINT AS col,
    row_number() OVER (PARTITION BY d.doc_id, d.page_index ORDER BY CASE WHEN (x1 + x2) / 2 < midpoint THEN 0 ELSE 1 END, y1, det_id) AS place FROM det d JOIN pgf USING (doc_id, page_index)""")
def _(v):
    return layout.reading_order(v.detections, v.pages).select("doc_id", "page_index", "det_id", "col", "place")


@query("p5_fallback_columns", "SELECT doc_id, page_index, col_left_x1, col_left_x2, col_right_x1, col_right_x2, midpoint FROM pgf")
def _(v):
    return layout.with_columns_fallback(v.pages).select("doc_id", "page_index", "col_left_x1", "col_left_x2", "col_right_x1", "col_right_x2", "midpoint")


@query("p6_overlapping_pairs", """SELECT a.doc_id, a.page_index, a.det_id AS a_id, b.det_id AS b_id, i AS intersection, i / (s + t - i) AS iou, i / t >= 0.8 AS a_contains_b, i / s >= 0.8 AS b_contains_a,
    (a.x1 <= b.x1 AND a.y1 <= b.y1 AND a.x2 >= b.x2 AND a.y2 >= b.y2) OR (b.x1 <= a.x1 AND b.y1 <= a.y1 AND b.x2 >= a.x2 AND b.y2 >= a.y2) AS fully_inside
    FROM det a JOIN det b ON a.doc_id = b.doc_id AND a.page_index = b.page_index AND a.det_id < b.det_id AND a.x1 < b.x2 AND b.x1 < a.x2 AND a.y1 < b.y2 AND b.y1 < a.y2,
    LATERAL (SELECT (least(a.x2, b.x2) - greatest(a.x1, b.x1)) * (least(a.y2, b.y2) - greatest(a.y1, b.y1)) AS i, (a.x2 - a.x1) * (a.y2 - a.y1) AS s, (b.x2 - b.x1) * (b.y2 - b.y1) AS t) z""")
def _(v):
    return layout.overlapping_pairs(v.detections)


@query("p8_page_ranges", """SELECT * FROM (SELECT doc_id, chunk, chunk * ceil(n / 6)::BIGINT AS page_start, least(chunk * ceil(n / 6)::BIGINT + ceil(n / 6)::BIGINT, n) AS page_end
    FROM (SELECT doc_id, count(*) AS n FROM pg GROUP BY doc_id) p CROSS JOIN (SELECT unnest(generate_series(0, 5)) AS chunk) c) q WHERE page_start < page_end""")
def _(v):
    return layout.split_page_ranges(v.pages.groupBy("doc_id").agg(F.count("*").alias("page_count")), 6)


@query("p9_box_captions", "SELECT doc_id, det_id, label || ' ' || CAST(CAST(round_even(confidence * 100, 0) AS BIGINT) AS VARCHAR) || '%' AS caption FROM det JOIN dim USING (label_id)")
def _(v):
    return layout.box_captions(v.detections)


@query("f1_by_label", """SELECT d.doc_id, d.page_index, det_id, label_id, row_number() OVER (PARTITION BY d.doc_id, d.page_index ORDER BY CASE WHEN (x1 + x2) / 2 < midpoint THEN 0 ELSE 1 END, y1, det_id) AS place
    FROM det d JOIN pgf USING (doc_id, page_index) WHERE label_id IN (3, 11)""")
def _(v):
    return layout.by_labels(v.detections, v.pages, "CASE_CAPTION", "HEADNOTE").select("doc_id", "page_index", "det_id", "label_id", "place")


@query("f2_copyrighted_structural", "SELECT doc_id, det_id, label, is_copyrighted, is_structural FROM det JOIN dim USING (label_id) WHERE is_copyrighted OR is_structural")
def _(v):
    return layout.with_labels(v.detections).where("is_copyrighted OR is_structural").select(*LAYOUT, "label", "is_copyrighted", "is_structural")


@query("f3_confident", "SELECT doc_id, det_id, label_id, confidence FROM fine")
def _(v):
    return layout.confident(v.detections).select(*LAYOUT, "label_id", "confidence")


@query("f4_without_excluded", "SELECT doc_id, det_id FROM det ANTI JOIN exids USING (doc_id, det_id)")
def _(v):
    return layout.without_excluded(v.detections, v.exclusions).select(*LAYOUT)


@query("f5_approved", "SELECT det.doc_id, det.det_id, ap.det_id IS NOT NULL AS approved FROM det LEFT JOIN apids ap ON ap.doc_id = det.doc_id AND ap.det_id = det.det_id")
def _(v):
    return layout.with_approval(v.detections, v.approvals).select(*LAYOUT, "approved")


@query("f6_key_icon_ratio", "SELECT doc_id, det_id, (x2 - x1) / (y2 - y1) BETWEEN 1.5 AND 4.0 AS ratio_ok FROM det WHERE label_id = 0")
def _(v):
    return v.detections.where(F.col("label_id") == ID["KEY_ICON"]).select(*LAYOUT, layout.key_icon_ratio().alias("ratio_ok"))


@query("f7_plausible_key_icons", "SELECT doc_id, det_id FROM mk1 WHERE label_id = 0")
def _(v):
    return layout.plausible_key_icons(layout.confident(v.detections.where(F.col("label_id") == ID["KEY_ICON"])), "doc_id").select(*LAYOUT)


_TRIM = """, pn AS (SELECT doc_id, page_index, list({{'x1': {a}, 'y1': {b}, 'x2': {c}, 'y2': {d}}} ORDER BY det_id) AS pns FROM {src} WHERE label_id = 8 GROUP BY ALL),
    sa AS (SELECT t.*, list_reduce(list_transform(coalesce(pns, []), lambda z: [z.x1, z.y1, z.x2, z.y2]), lambda s, p: CASE WHEN s[1] < p[3] AND p[1] < s[3] AND s[2] < p[4] AND p[2] < s[4]
      THEN CASE WHEN {left} THEN [s[1], s[2], least(s[3], p[1]), s[4]] ELSE [greatest(s[1], p[3]), s[2], s[3], s[4]] END ELSE s END, [{a}, {b}, {c}, {d}]) AS s FROM {src} t LEFT JOIN pn USING (doc_id, page_index) WHERE label_id = 9)"""


def _trim(src: str, a: str, b: str, c: str, d: str, left: str, tail: str) -> str:
    return "SELECT * FROM (WITH zz AS (SELECT 1)" + _TRIM.format(src=src, a=a, b=b, c=c, d=d, left=left) + tail + ") q"


@query("f8_trim_abbreviations", _trim("fine", "x1", "y1", "x2", "y2", "(s[1] + s[3]) / 2 < (p[1] + p[3]) / 2", " SELECT doc_id, det_id, s[1] AS x1, s[3] AS x2 FROM sa WHERE s[3] - s[1] > 5 UNION ALL SELECT doc_id, det_id, x1, x2 FROM fine WHERE label_id <> 9"))
def _(v):
    return layout.trim_state_abbreviations(v.detections).select(*LAYOUT, "x1", "x2")


@query("f8b_trim_drawn_abbreviations", _trim("tight", "x0", "y0", "x1", "y1", "s[1] < p[1]", " SELECT doc_id, det_id, s[1] AS x0, s[3] AS x1 FROM sa WHERE s[3] - s[1] >= 3"))
def _(v):
    rects = W.tighten(layout.to_points(v.detections.where(F.col("label_id").isin(ID["STATE_ABBREVIATION"], ID["PAGE_NUMBER"])), v.pages), v.words, "doc_id", "det_id")
    return layout.trim_drawn_abbreviations(rects.where(F.col("label_id") == ID["STATE_ABBREVIATION"]), rects.where(F.col("label_id") == ID["PAGE_NUMBER"])).select(*LAYOUT, "x0", "x1")


@query("f9_page_number_boxes", """SELECT doc_id, page_index, det_id, row_number() OVER (PARTITION BY doc_id, page_index ORDER BY confidence DESC, det_id) AS rank FROM det
    WHERE label_id = 8 AND x2 - x1 >= 40 AND y2 - y1 >= 40 AND x1 >= 5 AND y1 >= 5""")
def _(v):
    return layout.page_number_boxes(v.detections).select("doc_id", "page_index", "det_id", "rank")


@query("f9b_page_number_crops", """SELECT * FROM (SELECT d.doc_id, d.page_index, det_id, confidence, greatest(0, x1::BIGINT - 10) AS crop_x1, greatest(0, y1::BIGINT - 10) AS crop_y1, least(img_width, x2::BIGINT + 10) AS crop_x2, least(img_height, y2::BIGINT + 10) AS crop_y2
    FROM det d JOIN pg USING (doc_id, page_index) WHERE label_id = 8 AND y1 >= 5 AND y2 <= img_height - 5) q WHERE crop_x2 - crop_x1 >= 30 AND crop_y2 - crop_y1 >= 30""")
def _(v):
    return layout.page_number_crops(v.detections, v.pages)


_MISSING = """SELECT doc_id, page_index FROM (SELECT *, sum(has) OVER (PARTITION BY doc_id) AS n, count(*) OVER (PARTITION BY doc_id) AS total
    FROM (SELECT doc_id, page_index, CASE WHEN EXISTS (SELECT 1 FROM det d WHERE d.doc_id = pg.doc_id AND d.page_index = pg.page_index AND label_id = 9) THEN 1 ELSE 0 END AS has FROM pg) p) q WHERE has = 0"""


@query("f18_pages_without_abbreviation", _MISSING + " AND n > total * 0.1")
def _(v):
    return layout.pages_without_abbreviation(v.detections, v.pages)


@query("j8_all_pages_without_abbreviation", _MISSING)
def _(v):
    return layout.pages_without_abbreviation(v.detections, v.pages, wanted=True)


@query("a1_key_icon_medians", "SELECT doc_id, nk AS n, CASE WHEN nh >= 2 THEN hw ELSE aw END AS median_w, CASE WHEN nh >= 2 THEN hh ELSE ah END AS median_h FROM mkst WHERE nk >= 2")
def _(v):
    return layout.key_icon_medians(layout.confident(v.detections.where(F.col("label_id") == ID["KEY_ICON"])), "doc_id")


@query("a2_grouped_by_page", "SELECT doc_id, page_index, arg_min(model, det_id) AS model, min(det_id) AS first_id, count(*) AS n FROM det GROUP BY ALL")
def _(v):
    return layout.grouped_by_page(v.detections)


@query("a5_margin_bounds", "SELECT doc_id, page_index, header_bottom, footer_top FROM mb")
def _(v):
    return layout.margin_bounds(v.detections, v.pages)


@query("a6_column_bounds", "SELECT * FROM cbb")
def _(v):
    return layout.column_bounds(v.detections, v.pages)


_EDGE = "SELECT d.doc_id, d.page_index, min(x1) AS edge_px, min(x1) * any_value(sx) AS edge FROM det d JOIN pgf USING (doc_id, page_index) WHERE label_id = 11 AND (x1 + x2) / 2 > midpoint AND x1 >= midpoint * 0.75 GROUP BY ALL"


@query("a7_right_column_edge", _EDGE)
def _(v):
    return layout.right_column_edge(v.detections, v.pages)


@query("a11_counts", "SELECT doc_id, count(*) AS n_detections, count(DISTINCT page_index) AS n_pages, count(DISTINCT label_id) AS n_labels FROM det GROUP BY ALL")
def _(v):
    return v.detections.groupBy("doc_id").agg(F.count("*").alias("n_detections"), F.countDistinct("page_index").alias("n_pages"), F.countDistinct("label_id").alias("n_labels"))


@query("a13_last_headnote_column", """SELECT doc_id, max(page_index) AS last_page, arg_max(col, (page_index, col)) AS last_col FROM (SELECT d.doc_id, d.page_index, CASE WHEN (x1 + x2) / 2 < midpoint THEN 0 ELSE 1 END::BIGINT AS col
    FROM det d JOIN pgf USING (doc_id, page_index) WHERE label_id = 11 AND confidence >= 0.75) q GROUP BY doc_id""")
def _(v):
    return layout.last_headnote_column(v.detections, v.pages)


@query("o5_first_pages", "SELECT doc_id, page_index, page_number FROM pg WHERE page_index < 10")
def _(v):
    return v.pages.where(F.col("page_index") < 10).select("doc_id", "page_index", "page_number")


@query("u1_union_of_chunks", "SELECT doc_id, page_index, row_number() OVER (PARTITION BY doc_id ORDER BY page_index) AS place FROM pg")
def _(v):
    chunks = [v.pages.where(F.col("page_index") % 3 == k) for k in range(3)]
    merged = chunks[0].unionByName(chunks[1]).unionByName(chunks[2])
    return merged.select("doc_id", "page_index", F.row_number().over(Window.partitionBy("doc_id").orderBy("page_index")).cast("long").alias("place"))


@query("w11_first_and_last_number", "SELECT doc_id, arg_min(page_number, page_index) AS first_number, arg_max(page_number, page_index) AS last_number FROM pg WHERE page_number IS NOT NULL GROUP BY ALL")
def _(v):
    return v.pages.where("page_number IS NOT NULL").groupBy("doc_id").agg(F.min_by("page_number", "page_index").alias("first_number"), F.max_by("page_number", "page_index").alias("last_number"))


@query("j11_numbered_neighbours", """SELECT doc_id, page_index, last_value(page_number IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY page_index ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS before,
    first_value(page_number IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY page_index ROWS BETWEEN 1 FOLLOWING AND 10 FOLLOWING) AS after FROM pg""")
def _(v):
    w = Window.partitionBy("doc_id").orderBy("page_index")
    return v.pages.select("doc_id", "page_index", F.last("page_number", ignorenulls=True).over(w.rowsBetween(-10, -1)).alias("before"), F.first("page_number", ignorenulls=True).over(w.rowsBetween(1, 10)).alias("after"))


# Opinions.

_OP = "doc_id, opinion, caption_id, caption_page, key_id, key_page"


@query("j2_pair_opinions", f"SELECT {_OP} FROM op")
def _(v):
    return pairing.pair_opinions(v.det, v.pg).select("doc_id", "opinion", "caption_id", "caption_page", "key_id", "key_page")


@query("j3_members", "SELECT doc_id, opinion, det_id, after_caption FROM mem")
def _(v):
    return pairing.members(v.det, v.pg, v.opinions).select("doc_id", "opinion", "det_id", "after_caption")


_NUMBERS = """SELECT op.doc_id, op.opinion, coalesce(nullif(a.page_number_end, 0), nullif(a.page_number, 0), caption_page + 1) AS first_number,
    coalesce(CASE WHEN nullif(z.page_number_end, 0) IS NOT NULL AND z.page_number IS NOT NULL THEN z.page_number ELSE nullif(z.page_number, 0) END, key_page + 1) AS last_number
    FROM op LEFT JOIN pg a ON a.doc_id = op.doc_id AND a.page_index = caption_page LEFT JOIN pg z ON z.doc_id = op.doc_id AND z.page_index = key_page"""


@query("x7_opinion_numbers", _NUMBERS)
def _(v):
    return pairing.with_page_numbers(v.opinions, v.pg).select("doc_id", "opinion", "first_number", "last_number")


@query("snk23_file_names", f"""SELECT doc_id, opinion, base || CASE WHEN count(*) OVER (PARTITION BY doc_id, base) > 1 THEN '-' || CAST(row_number() OVER (PARTITION BY doc_id, base ORDER BY opinion) AS VARCHAR) ELSE '' END || '.pdf' AS file_name
    FROM (SELECT *, printf('vol.%d.%04d-%04d', doc_id, first_number, last_number) AS base FROM ({_NUMBERS}) n) b""")
def _(v):
    return pairing.with_file_names(pairing.with_page_numbers(v.opinions, v.pg)).select("doc_id", "opinion", "file_name")


@query("j13_has_image", "SELECT doc_id, opinion, EXISTS (SELECT 1 FROM det d WHERE d.doc_id = op.doc_id AND d.page_index BETWEEN caption_page AND key_page AND label_id = 10) AS has_image FROM op")
def _(v):
    return pairing.with_images(v.opinions, v.det).select("doc_id", "opinion", "has_image")


OUTSIDE = """SELECT * FROM (SELECT doc_id, opinion, page_index, unnest([
      CASE WHEN is_first THEN {'x0': left_x0, 'y0': header_bottom, 'x1': left_x1, 'y1': CASE WHEN cl THEN cy ELSE footer_top END, 'part': 'before-left'} END,
      CASE WHEN is_first AND NOT cl THEN {'x0': right_x0, 'y0': header_bottom, 'x1': right_x1, 'y1': cy, 'part': 'before-right'} END,
      CASE WHEN is_last AND kl THEN {'x0': left_x0, 'y0': ky, 'x1': left_x1, 'y1': footer_top, 'part': 'after-left'} END,
      CASE WHEN is_last THEN {'x0': right_x0, 'y0': CASE WHEN kl THEN header_bottom ELSE ky END, 'x1': right_x1, 'y1': footer_top, 'part': 'after-right'} END], recursive := false) AS r
    FROM (SELECT oppg.*, header_bottom, footer_top, left_x0, left_x1, right_x0, right_x1, (caption_x1 * sx + caption_x2 * sx) / 2 < boundary AS cl, (key_x1 * sx + key_x2 * sx) / 2 < boundary AS kl, caption_y1 * sy AS cy, key_y2 * sy AS ky
      FROM oppg JOIN mb USING (doc_id, page_index) JOIN cbb USING (doc_id, page_index) JOIN pgf USING (doc_id, page_index)) q) u WHERE r IS NOT NULL AND r.x0 < r.x1 AND r.y0 < r.y1"""


@query("z5_outside_rects", f"SELECT doc_id, opinion, page_index, r.x0 AS x0, r.y0 AS y0, r.x1 AS x1, r.y1 AS y1, r.part AS part FROM ({OUTSIDE}) o")
def _(v):
    return pairing.outside_rects(v.det, v.pg, v.opinions)


@query("j14_opinion_page_rects", "SELECT oppg.doc_id, opinion, oppg.page_index, ki.det_id, x1 * sx AS x0, y1 * sy AS y0, x2 * sx AS x1, y2 * sy AS y1 FROM oppg JOIN ki ON ki.doc_id = oppg.doc_id AND ki.page_index = oppg.page_index JOIN pgf ON pgf.doc_id = ki.doc_id AND pgf.page_index = ki.page_index")
def _(v):
    on = pairing.opinion_pages(v.opinions, v.pg).select("doc_id", "opinion", "page_index")
    return on.join(zones.key_icon_rects(v.det, v.pg), layout.PAGE).select("doc_id", "opinion", "page_index", "det_id", *E.RECT)
