"""Registering queries, and the shared parts of their SQL counterparts."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quirework.sources import adapters
from quirework.sources.adapters import Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``f(views)`` under ``name``; ``sql`` may use the named parts below."""

    def register(f: Callable[[Views], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if sql is not None:
            SQL[name] = with_parts(sql)
        return f

    return register


# Fixed values, stated here anew so that the SQL does not rest on the package: id, label, copyrighted, structural, in the margin, fill, least confidence.
_DIM = """
    (0::BIGINT, 'KEY_ICON', true, false, false, NULL, 0.5::DOUBLE),
    (1::BIGINT, 'DIVIDER', false, true, false, 'black', 0.2::DOUBLE),
    (2::BIGINT, 'PAGE_HEADER', true, false, true, 'white', 0.5::DOUBLE),
    (3::BIGINT, 'CASE_CAPTION', false, true, false, NULL, 0.5::DOUBLE),
    (4::BIGINT, 'FOOTNOTES', false, false, false, NULL, 0.2::DOUBLE),
    (5::BIGINT, 'HEADNOTE_BRACKET', true, false, false, 'black', 0.5::DOUBLE),
    (6::BIGINT, 'CASE_METADATA', false, true, false, NULL, 0.2::DOUBLE),
    (7::BIGINT, 'CASE_SEQUENCE', false, true, false, NULL, 0.2::DOUBLE),
    (8::BIGINT, 'PAGE_NUMBER', false, true, true, NULL, 0.75::DOUBLE),
    (9::BIGINT, 'STATE_ABBREVIATION', false, true, true, 'white', 0.2::DOUBLE),
    (10::BIGINT, 'IMAGE', false, false, false, NULL, 0.2::DOUBLE),
    (11::BIGINT, 'HEADNOTE', true, false, false, NULL, 0.5::DOUBLE),
    (12::BIGINT, 'BACKGROUND', false, false, false, NULL, 0.5::DOUBLE),
    (13::BIGINT, 'SYLLABUS', false, false, false, NULL, 0.2::DOUBLE),
    (14::BIGINT, 'EDITORIAL', false, false, false, 'black', 0.2::DOUBLE),
    (15::BIGINT, 'JUDGES', false, true, false, NULL, 0.2::DOUBLE),
    (16::BIGINT, 'TEXT_COLUMN', false, true, false, NULL, 0.2::DOUBLE),
    (17::BIGINT, 'DOCKET', false, true, false, NULL, 0.2::DOUBLE),
    (18::BIGINT, 'DATE', false, true, false, NULL, 0.2::DOUBLE),
    (19::BIGINT, 'COURT', false, true, false, NULL, 0.2::DOUBLE),
    (20::BIGINT, 'CITATION', false, true, false, NULL, 0.2::DOUBLE)"""

#: Named parts in order of dependence; a part may use those before it.
PARTS: dict[str, str] = {
    **{n: adapters.duckdb(n) for n in ("det", "pg", "rd", "cand", "bl", "wd", "excl", "appr")},
    "dim": f"SELECT * FROM (VALUES {_DIM}) t(label_id, label, is_copyrighted, is_structural, in_margin, fill, min_conf)",
    "pgf": """SELECT doc_id, page_index, pdf_width, pdf_height, img_width, img_height, page_number, page_number_end,
        CASE WHEN midpoint = 0 THEN greatest(20, floor(img_width * 0.03)) ELSE col_left_x1 END::DOUBLE AS col_left_x1,
        CASE WHEN midpoint = 0 THEN greatest(greatest(20, floor(img_width * 0.03)) + 10, floor(img_width / 2) - greatest(10, floor(img_width * 0.02))) ELSE col_left_x2 END::DOUBLE AS col_left_x2,
        CASE WHEN midpoint = 0 THEN least(img_width - greatest(20, floor(img_width * 0.03)) - 10, floor(img_width / 2) + greatest(10, floor(img_width * 0.02))) ELSE col_right_x1 END::DOUBLE AS col_right_x1,
        CASE WHEN midpoint = 0 THEN img_width - greatest(20, floor(img_width * 0.03)) ELSE col_right_x2 END::DOUBLE AS col_right_x2,
        CASE WHEN midpoint = 0 THEN img_width / 2 ELSE midpoint END::DOUBLE AS midpoint, pdf_width / img_width AS sx, pdf_height / img_height AS sy FROM pg""",
    "dmid": "SELECT doc_id, arg_min(midpoint, page_index) AS doc_mid FROM pgf GROUP BY doc_id",
    "pts": "SELECT d.doc_id, det_id, d.page_index, label_id, confidence, x1 * sx AS x0, y1 * sy AS y0, x2 * sx AS x1, y2 * sy AS y1 FROM det d JOIN pgf USING (doc_id, page_index)",
    "fine": "SELECT det.* FROM det JOIN dim USING (label_id) WHERE confidence >= min_conf",
    "mb": """SELECT p.doc_id, p.page_index,
        greatest(0, coalesce(max(CASE WHEN label_id IN (2, 8, 9) AND (y1 * sy + y2 * sy) / 2 < pdf_height / 2 THEN y2 * sy END), 0))::DOUBLE AS header_bottom,
        least(min(pdf_height), coalesce(min(CASE WHEN label_id = 4 OR (label_id IN (2, 8, 9) AND (y1 * sy + y2 * sy) / 2 >= pdf_height / 2) THEN y1 * sy END), min(pdf_height))) AS footer_top
        FROM pgf p LEFT JOIN det d ON d.doc_id = p.doc_id AND d.page_index = p.page_index AND label_id IN (2, 4, 8, 9) GROUP BY p.doc_id, p.page_index""",
    "cb": """SELECT doc_id, page_index, arg_min({'a': x0, 'z': x1}, ((x0 + x1) / 2, det_id)) AS l, arg_max({'a': x0, 'z': x1}, ((x0 + x1) / 2, det_id)) AS r FROM pts WHERE label_id = 16 GROUP BY doc_id, page_index HAVING count(*) >= 2""",
    "cbb": "SELECT doc_id, page_index, l.a AS left_x0, l.z AS left_x1, r.a AS right_x0, r.z AS right_x1, (l.z + r.a) / 2 AS boundary FROM cb",
    "exids": "SELECT DISTINCT d.doc_id, d.det_id FROM det d JOIN excl e ON e.doc_id = d.doc_id AND e.page_index = d.page_index AND e.label_id = d.label_id AND abs(round_even(x1, 0) - e.x) <= 10 AND abs(round_even(y1, 0) - e.y) <= 10",
    "apids": "SELECT DISTINCT d.doc_id, d.det_id FROM det d JOIN appr e ON e.doc_id = d.doc_id AND e.page_index = d.page_index AND e.label_id = d.label_id AND abs(round_even(x1, 0) - e.x) <= 10 AND abs(round_even(y1, 0) - e.y) <= 10",
    "mk0": "SELECT *, x2 - x1 AS w, y2 - y1 AS h FROM fine WHERE label_id IN (0, 3){EXCLUDED}",
    "mkst": """SELECT doc_id, count(*) AS nk, count(CASE WHEN confidence >= 0.9 THEN 1 END) AS nh, median(w) AS aw, median(h) AS ah,
        median(CASE WHEN confidence >= 0.9 THEN w END) AS hw, median(CASE WHEN confidence >= 0.9 THEN h END) AS hh FROM mk0 WHERE label_id = 0 GROUP BY doc_id""",
    "mk1": """SELECT m.*, CASE WHEN (x1 + x2) / 2 < doc_mid THEN 0 ELSE 1 END::BIGINT AS col, CASE WHEN label_id = 3 THEN 0 ELSE 1 END AS k
        FROM (SELECT mk0.*, nk, CASE WHEN nh >= 2 THEN hw ELSE aw END AS mw, CASE WHEN nh >= 2 THEN hh ELSE ah END AS mh FROM mk0 LEFT JOIN mkst USING (doc_id)) m JOIN dmid USING (doc_id)
        WHERE label_id = 3 OR (CASE WHEN h > 0 THEN w / h ELSE 0 END BETWEEN 1.5 AND 4.0 AND (nk < 2 OR confidence >= 0.9 OR (abs(w - mw) / mw <= 0.4 AND abs(h - mh) / mh <= 0.4)))""",
    "mk2": """SELECT *, row_number() OVER o AS rn, coalesce(sum(k) OVER (PARTITION BY doc_id ORDER BY page_index, col, y1, k, det_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS grp
        FROM mk1 WINDOW o AS (PARTITION BY doc_id ORDER BY page_index, col, y1, k, det_id)""",
    "mk3": "SELECT doc_id, grp, min(CASE WHEN k = 0 THEN rn END) AS crn, min(CASE WHEN k = 1 THEN rn END) AS krn FROM mk2 GROUP BY doc_id, grp",
    "op": """SELECT p.doc_id, CAST(row_number() OVER (PARTITION BY p.doc_id ORDER BY p.grp) - 1 AS BIGINT) AS opinion,
        c.det_id AS caption_id, c.page_index AS caption_page, c.col AS caption_col, c.x1 AS caption_x1, c.y1 AS caption_y1, c.x2 AS caption_x2, c.y2 AS caption_y2,
        k.det_id AS key_id, k.page_index AS key_page, k.col AS key_col, k.x1 AS key_x1, k.y1 AS key_y1, k.x2 AS key_x2, k.y2 AS key_y2
        FROM mk3 p JOIN mk2 c ON c.doc_id = p.doc_id AND c.rn = p.crn JOIN mk2 k ON k.doc_id = p.doc_id AND k.rn = p.krn""",
    "oppg": "SELECT op.*, page_index, page_index = caption_page AS is_first, page_index = key_page AS is_last FROM op JOIN pg ON pg.doc_id = op.doc_id AND page_index BETWEEN caption_page AND key_page",
    "dk": "SELECT det.*, CASE WHEN (x1 + x2) / 2 < doc_mid THEN 0 ELSE 1 END::BIGINT AS col FROM det JOIN dmid USING (doc_id)",
    "mem": """SELECT d.*, opinion, (d.page_index, d.col, d.y1) > (caption_page, caption_col, caption_y1) AS after_caption FROM dk d JOIN op ON op.doc_id = d.doc_id
        AND (d.page_index, d.col, d.y1) >= (caption_page, caption_col, caption_y1) AND (d.page_index, d.col, d.y1) <= (key_page, key_col, key_y1)""",
    "memr": "SELECT *, row_number() OVER (PARTITION BY doc_id, opinion, label_id ORDER BY page_index, col, y1, det_id) AS nth FROM mem WHERE after_caption",
    "zmk": """SELECT op.doc_id, op.opinion, bg.det_id AS start_id, bg.page_index AS b_page, bg.x1 AS b_x1, bg.y1 AS b_y1, bg.x2 AS b_x2, bg.y2 AS b_y2,
        CASE WHEN di.det_id IS NOT NULL THEN di.det_id WHEN nt.n > 0 THEN me.det_id END AS end_id
        FROM op LEFT JOIN memr bg ON bg.doc_id = op.doc_id AND bg.opinion = op.opinion AND bg.label_id = 12 AND bg.nth = 1
        LEFT JOIN memr di ON di.doc_id = op.doc_id AND di.opinion = op.opinion AND di.label_id = 1 AND di.nth = 1
        LEFT JOIN memr me ON me.doc_id = op.doc_id AND me.opinion = op.opinion AND me.label_id = 6 AND me.nth = 1
        LEFT JOIN (SELECT doc_id, opinion, count(*) AS n FROM memr WHERE label_id IN (11, 12) GROUP BY ALL) nt ON nt.doc_id = op.doc_id AND nt.opinion = op.opinion""",
    "sides": """SELECT p.doc_id, p.page_index, s.side, CASE WHEN s.side = 0 THEN col_left_x1 * sx ELSE col_right_x1 * sx END AS cx0, CASE WHEN s.side = 0 THEN col_left_x2 * sx ELSE col_right_x2 * sx END AS cx1,
        midpoint, sx, sy, header_bottom, footer_top FROM pgf p JOIN mb USING (doc_id, page_index) CROSS JOIN (VALUES (0::BIGINT), (1::BIGINT)) s(side)""",
    "zone0": """SELECT op.doc_id, op.opinion, {BG} AS from_bg, CASE WHEN {BG} THEN b_page ELSE caption_page END AS s_page,
        CASE WHEN {BG} THEN (b_x1 * s.sx + b_x2 * s.sx) / 2 ELSE (caption_x1 * s.sx + caption_x2 * s.sx) / 2 END AS s_cx, CASE WHEN {BG} THEN b_y1 * s.sy ELSE caption_y2 * s.sy END AS s_y,
        e.page_index AS e_page, (e.x1 * ep.sx + e.x2 * ep.sx) / 2 AS e_cx, e.y1 * ep.sy AS e_y
        FROM op JOIN zmk USING (doc_id, opinion) JOIN det e ON e.doc_id = op.doc_id AND e.det_id = end_id JOIN pgf ep ON ep.doc_id = e.doc_id AND ep.page_index = e.page_index
        JOIN pgf s ON s.doc_id = op.doc_id AND s.page_index = CASE WHEN {BG} THEN b_page ELSE caption_page END""",
    "zr": """SELECT * FROM (SELECT z.doc_id, opinion, page_index, side, cx0 AS x0,
        greatest(CASE WHEN page_index = s_page AND side = CASE WHEN s_cx < midpoint * sx THEN 0 ELSE 1 END THEN s_y ELSE header_bottom END, header_bottom) AS y0, cx1 AS x1,
        least(CASE WHEN page_index = e_page AND side = CASE WHEN e_cx < midpoint * sx THEN 0 ELSE 1 END THEN e_y ELSE footer_top END, footer_top) AS y1
        FROM zone0 z JOIN sides ON sides.doc_id = z.doc_id AND page_index BETWEEN s_page AND e_page
        WHERE NOT (page_index = s_page AND side < CASE WHEN s_cx < midpoint * sx THEN 0 ELSE 1 END) AND NOT (page_index = e_page AND side > CASE WHEN e_cx < midpoint * sx THEN 0 ELSE 1 END)) q WHERE y0 < y1""",
    "hn": "SELECT DISTINCT m.doc_id, opinion, m.page_index, CASE WHEN (x1 + x2) / 2 < midpoint THEN 0 ELSE 1 END::BIGINT AS side FROM mem m JOIN pgf USING (doc_id, page_index) WHERE after_caption AND label_id = 11 AND confidence >= 0.75",
    "fb0": """SELECT op.doc_id, op.opinion, caption_page, last_page, last_side, CASE WHEN (caption_x1 * sx + caption_x2 * sx) / 2 < midpoint * sx THEN 0 ELSE 1 END AS cap_side, caption_y2 * sy AS cap_y
        FROM op JOIN zmk USING (doc_id, opinion) JOIN (SELECT doc_id, opinion, max(page_index) AS last_page, arg_max(side, (page_index, side)) AS last_side FROM hn GROUP BY ALL) l USING (doc_id, opinion)
        JOIN pgf p ON p.doc_id = op.doc_id AND p.page_index = caption_page WHERE end_id IS NULL""",
    "fb": """SELECT * FROM (SELECT f.doc_id, f.opinion, s.page_index, s.side, cx0 AS x0, greatest(CASE WHEN s.page_index = caption_page AND s.side = cap_side THEN cap_y ELSE header_bottom END, header_bottom) AS y0, cx1 AS x1, footer_top AS y1
        FROM fb0 f JOIN sides s ON s.doc_id = f.doc_id AND s.page_index BETWEEN caption_page AND last_page LEFT JOIN hn ON hn.doc_id = f.doc_id AND hn.opinion = f.opinion AND hn.page_index = s.page_index AND hn.side = s.side
        WHERE NOT (s.page_index = caption_page AND s.side < cap_side) AND NOT (s.page_index = last_page AND (s.side > last_side OR hn.side IS NULL))) q WHERE y0 < y1""",
    "zn": "SELECT * FROM zr UNION ALL SELECT * FROM fb",
    "zn1": """SELECT z.doc_id, z.opinion, z.page_index, z.side, any_value(z.x0) AS rx0, any_value(z.x1) AS rx1, coalesce(min(w.x0) - 2, any_value(z.x0)) AS x0, coalesce(min(w.y0) - 2, any_value(z.y0)) AS y0, coalesce(max(w.x1) + 2, any_value(z.x1)) AS x1, coalesce(max(w.y1) + 2, any_value(z.y1)) AS y1
        FROM zn z LEFT JOIN wd w ON w.doc_id = z.doc_id AND w.page_index = z.page_index AND w.x0 < z.x1 AND w.x1 > z.x0 AND w.y0 < z.y1 AND w.y1 > z.y0 GROUP BY z.doc_id, z.opinion, z.page_index, z.side""",
    "zn2": """SELECT z.doc_id, z.opinion, z.page_index, z.side, any_value(z.rx0) AS rx0, any_value(z.rx1) AS rx1, any_value(z.x0) AS x0, any_value(z.y0) AS y0, any_value(z.x1) AS x1, any_value(z.y1) AS y1, coalesce(max(w.y1), any_value(z.y0)) AS tb, coalesce(min(w.x0) - 2, any_value(z.x0)) AS tl, coalesce(max(w.x1) + 2, any_value(z.x1)) AS tr
        FROM zn1 z LEFT JOIN wd w ON w.doc_id = z.doc_id AND w.page_index = z.page_index AND w.x0 < z.x1 AND w.x1 > z.x0 AND w.y0 < z.y1 AND w.y1 > z.y0 GROUP BY z.doc_id, z.opinion, z.page_index, z.side""",
    "zc": "SELECT doc_id, opinion, page_index, side, greatest(x0, tl) AS x0, greatest(y0, header_bottom) AS y0, least(x1, tr) AS x1, least(y1, footer_top, tb) AS y1 FROM zn2 JOIN mb USING (doc_id, page_index) WHERE greatest(x0, tl) < least(x1, tr) AND greatest(y0, header_bottom) < least(y1, footer_top, tb)",
    "tight": """SELECT r.doc_id, r.det_id, r.page_index, r.label_id, r.confidence, count(w.word) > 0 AS tight, coalesce(min(w.x0) - 2, any_value(r.x0)) AS x0, coalesce(min(w.y0) - 2, any_value(r.y0)) AS y0, coalesce(max(w.x1) + 2, any_value(r.x1)) AS x1, coalesce(max(w.y1) + 2, any_value(r.y1)) AS y1
        FROM pts r LEFT JOIN wd w ON w.doc_id = r.doc_id AND w.page_index = r.page_index AND w.x0 < r.x1 AND w.x1 > r.x0 AND w.y0 < r.y1 AND w.y1 > r.y0 GROUP BY r.doc_id, r.det_id, r.page_index, r.label_id, r.confidence""",
    "pnr": "SELECT doc_id, det_id, page_index, x0, y0, x1, y1 FROM tight WHERE label_id = 8",
    "holes": "SELECT doc_id, page_index, list({'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1} ORDER BY det_id) AS pns FROM pnr GROUP BY ALL",
    "caps": "SELECT doc_id, page_index, list({'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1} ORDER BY det_id) AS caps FROM pts WHERE label_id = 3 GROUP BY ALL",
    "cs0": """SELECT d.doc_id, det_id, d.page_index, ((x1 + x2) / 2 - greatest(40, least(x2 - x1, 60)) / 2) * sx + 3 AS x0, ((y1 + y2) / 2 - greatest(40, least(y2 - y1, 60)) / 2) * sy + 3 AS y0,
        ((x1 + x2) / 2 + greatest(40, least(x2 - x1, 60)) / 2) * sx - 3 AS x1, ((y1 + y2) / 2 + greatest(40, least(y2 - y1, 60)) / 2) * sy - 3 AS y1 FROM det d JOIN pgf USING (doc_id, page_index) WHERE label_id = 7""",
    "cs1": """SELECT doc_id, det_id, page_index, list_reduce(list_transform(coalesce(caps, []), lambda z: [z]), lambda s, c: CASE WHEN s[1].x0 < c[1].x1 AND c[1].x0 < s[1].x1 AND s[1].y0 < c[1].y1 AND c[1].y0 < s[1].y1
        THEN CASE WHEN s[1].y0 < c[1].y0 THEN [{'x0': s[1].x0, 'y0': s[1].y0, 'x1': s[1].x1, 'y1': c[1].y0}] ELSE [{'x0': 0::DOUBLE, 'y0': 0::DOUBLE, 'x1': 0::DOUBLE, 'y1': 0::DOUBLE}] END ELSE s END, [{'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}])[1] AS s
        FROM cs0 LEFT JOIN caps USING (doc_id, page_index)""",
    "cs": "SELECT doc_id, det_id, page_index, s.x0 AS x0, s.y0 AS y0, s.x1 AS x1, s.y1 AS y1 FROM cs1 WHERE s.x0 < s.x1 AND s.y0 < s.y1",
    "kist": """SELECT doc_id, page_index, count(*) AS nk, count(CASE WHEN confidence >= 0.9 THEN 1 END) AS nh, median(x2 - x1) AS aw, median(y2 - y1) AS ah,
        median(CASE WHEN confidence >= 0.9 THEN x2 - x1 END) AS hw, median(CASE WHEN confidence >= 0.9 THEN y2 - y1 END) AS hh FROM det WHERE label_id = 0 GROUP BY doc_id, page_index""",
    "ki": """SELECT d.* FROM (SELECT det.*, x2 - x1 AS w, y2 - y1 AS h, nk, CASE WHEN nh >= 2 THEN hw ELSE aw END AS mw, CASE WHEN nh >= 2 THEN hh ELSE ah END AS mh FROM det JOIN kist USING (doc_id, page_index) WHERE label_id = 0) d
        WHERE CASE WHEN h > 0 THEN w / h ELSE 0 END BETWEEN 1.5 AND 4.0 AND (nk < 2 OR confidence >= 0.9 OR (abs(w - mw) / mw <= 0.4 AND abs(h - mh) / mh <= 0.4)) AND confidence >= 0.5""",
    "exr": """SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN 1 END::BIGINT AS exp_start, CASE WHEN doc_id % 3 <> 0 THEN CASE WHEN doc_id % 7 = 1 THEN 2 * max(pdf_page) ELSE max(pdf_page) END END AS exp_end FROM rd GROUP BY doc_id""",
    "sq": """SELECT *, coalesce(num < 1 OR (exp_start IS NOT NULL AND exp_end IS NOT NULL AND (num < exp_start - 5 OR num > exp_end + 5)), false) AS oor
        FROM (SELECT rd.*, exp_start, exp_end, CASE WHEN detected IS NOT NULL AND coalesce(type, '') <> 'range' THEN TRY_CAST(detected AS BIGINT) END AS num FROM rd LEFT JOIN exr USING (doc_id)) q""",
    "nb": """SELECT *, last_value(CASE WHEN num IS NOT NULL AND NOT oor THEN num END IGNORE NULLS) OVER b AS bn, last_value(CASE WHEN num IS NOT NULL AND NOT oor THEN pdf_page END IGNORE NULLS) OVER b AS bp,
        first_value(CASE WHEN num IS NOT NULL AND NOT oor THEN num END IGNORE NULLS) OVER a AS an, first_value(CASE WHEN num IS NOT NULL AND NOT oor THEN pdf_page END IGNORE NULLS) OVER a AS ap FROM sq
        WINDOW b AS (PARTITION BY doc_id ORDER BY pdf_page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), a AS (PARTITION BY doc_id ORDER BY pdf_page ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)""",
    "ex": """SELECT *, CASE WHEN NOT oor THEN NULL WHEN bn IS NOT NULL AND an IS NOT NULL THEN CAST(round_even(bn + (an - bn) / CAST(greatest(ap - bp, 1) AS DOUBLE) * (pdf_page - bp), 0) AS BIGINT)
        WHEN bn IS NOT NULL THEN bn + (pdf_page - bp) WHEN an IS NOT NULL THEN an - (ap - pdf_page) END AS expected FROM nb""",
    "modal": """SELECT doc_id, off FROM (SELECT *, sum(n) OVER (PARTITION BY doc_id) AS total, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first) AS r
        FROM (SELECT doc_id, expected - num AS off, count(*) AS n, min(pdf_page) AS first FROM ex WHERE expected IS NOT NULL GROUP BY ALL) q) t WHERE r = 1 AND n >= total * 0.5 AND off <> 0""",
    "fx": """SELECT ex.doc_id, pdf_page, CASE WHEN off IS NOT NULL AND expected - num = off THEN CAST(num + off AS VARCHAR) ELSE detected END AS detected, type, score, CASE WHEN off IS NOT NULL AND expected - num = off THEN detected END AS old
        FROM ex LEFT JOIN modal USING (doc_id)""",
    "vd": """SELECT *, coalesce(num < 1 OR (exp_start IS NOT NULL AND exp_end IS NOT NULL AND (num < exp_start - 5 OR num > exp_end + 5)), false) AS oor
        FROM (SELECT fx.*, exp_start, exp_end, CASE WHEN detected IS NOT NULL AND coalesce(type, '') <> 'range' THEN TRY_CAST(detected AS BIGINT) END AS num FROM fx LEFT JOIN exr USING (doc_id)) q""",
    "isl": "SELECT *, sum(CASE WHEN detected IS NULL OR coalesce(type, '') = 'range' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pdf_page) AS island FROM vd",
    "prv": "SELECT *, lag(num) OVER o AS prev_num, lag(pdf_page) OVER o AS prev_pdf FROM isl WHERE num IS NOT NULL AND NOT oor WINDOW o AS (PARTITION BY doc_id, island ORDER BY pdf_page)",
    "sqi": "SELECT doc_id, pdf_page, CASE WHEN num = prev_num THEN 'DUPLICATE' WHEN num < prev_num THEN 'BACKWARD' ELSE 'GAP' END AS issue, num, prev_pdf, prev_num FROM prv WHERE num <= prev_num OR num - prev_num > 2",
    "rgb": "SELECT doc_id, pdf_page, CAST(regexp_extract(replace(detected, '–', '-'), '^([0-9]{1,4})\\s*-\\s*([0-9]{1,4})$', 1) AS BIGINT) AS a, CAST(regexp_extract(replace(detected, '–', '-'), '^([0-9]{1,4})\\s*-\\s*([0-9]{1,4})$', 2) AS BIGINT) AS z FROM vd WHERE type = 'range'",
    "rgp": "SELECT doc_id, pdf_page, unnest(generate_series(a, z)) AS page FROM rgb WHERE a <= z",
    "bnd": """SELECT doc_id, CASE WHEN any_value(exp_start) IS NOT NULL AND any_value(exp_end) IS NOT NULL THEN any_value(exp_start) ELSE min(CASE WHEN NOT oor THEN num END) END AS a,
        CASE WHEN any_value(exp_start) IS NOT NULL AND any_value(exp_end) IS NOT NULL THEN any_value(exp_end) ELSE max(CASE WHEN NOT oor THEN num END) END AS z FROM vd GROUP BY doc_id HAVING count(CASE WHEN NOT oor THEN num END) > 0""",
    "mis": """SELECT e.doc_id, e.page FROM (SELECT doc_id, unnest(generate_series(a, z)) AS page FROM bnd) e
        WHERE page >= 1 AND NOT EXISTS (SELECT 1 FROM vd WHERE vd.doc_id = e.doc_id AND num = e.page AND NOT oor) AND NOT EXISTS (SELECT 1 FROM rgp WHERE rgp.doc_id = e.doc_id AND rgp.page = e.page)""",
    "misr": "SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n, min(page) OVER (PARTITION BY doc_id, g) AS first, max(page) OVER (PARTITION BY doc_id, g) AS last FROM (SELECT *, page - row_number() OVER (PARTITION BY doc_id ORDER BY page) AS g FROM mis) q",
    "gapp": "SELECT DISTINCT doc_id, unnest(generate_series(prev_num + 1, num - 1)) AS page FROM sqi WHERE issue = 'GAP' AND num - prev_num - 1 <= 6",
    "ct0": r"SELECT *, trim(raw_text) AS t, trim(trim(raw_text), '.,;:!?()[]{}''""') AS c FROM cand",
    "ct": r"""SELECT * EXCLUDE (t, c), CASE WHEN regexp_matches(t, '^([0-9]{1,4})\s*[–-]\s*([0-9]{1,4})$') OR regexp_matches(t, '^[0-9]{1,4}$') THEN t
        WHEN regexp_matches(c, '^([0-9]{1,4})\s*[–-]\s*([0-9]{1,4})$') OR regexp_matches(c, '^[0-9]{1,4}$') THEN c
        WHEN regexp_extract(t, '(?:^|[^0-9A-Za-z_])([0-9]{1,4})\s*$', 1) <> '' THEN regexp_extract(t, '(?:^|[^0-9A-Za-z_])([0-9]{1,4})\s*$', 1) END AS text,
        CASE WHEN regexp_matches(t, '^([0-9]{1,4})\s*[–-]\s*([0-9]{1,4})$') THEN 'range' WHEN regexp_matches(t, '^[0-9]{1,4}$') THEN 'single'
        WHEN regexp_matches(c, '^([0-9]{1,4})\s*[–-]\s*([0-9]{1,4})$') THEN 'range' WHEN regexp_matches(c, '^[0-9]{1,4}$') THEN 'single'
        WHEN regexp_extract(t, '(?:^|[^0-9A-Za-z_])([0-9]{1,4})\s*$', 1) <> '' THEN 'single' END AS type FROM ct0""",
    "hit": r"""SELECT ct.*, exp_start, exp_end, coalesce(CASE WHEN type = 'range' THEN CAST(regexp_extract(text, '^([0-9]{1,4})\s*[–-]\s*([0-9]{1,4})$', 1) AS BIGINT) >= exp_start - 20 AND CAST(regexp_extract(text, '^([0-9]{1,4})\s*[–-]\s*([0-9]{1,4})$', 2) AS BIGINT) <= exp_end + 20
        ELSE TRY_CAST(text AS BIGINT) BETWEEN exp_start - 20 AND exp_end + 20 END, false) AS ok FROM ct LEFT JOIN exr USING (doc_id) WHERE text IS NOT NULL""",
    "posn": "SELECT * FROM hit WHERE cx IS NULL OR cy IS NULL OR (cy <= 2200 * 0.15 AND (cx <= 1700 * 0.20 OR cx >= 1700 * 0.80))",
    "ft0": "SELECT d.doc_id, d.page_index, det_id, confidence, x1, y1, x2, y2 FROM det d WHERE label_id = 4",
}


def with_parts(sql: str, use_background: bool = True, excluded: bool = False) -> str:
    """``sql`` with the parts it names, and those they name, put before it.

    Zones start at a background only with ``use_background``; markers leave out the excluded with ``excluded``.
    """
    used: set[str] = set()
    without = " AND (doc_id, det_id) NOT IN (SELECT (doc_id, det_id) FROM exids)" if excluded else ""

    def need(text: str) -> None:
        for name in PARTS:
            if name not in used and re.search(rf"\b{name}\b", text):
                used.add(name)
                need(PARTS[name].replace("{EXCLUDED}", without))

    need(sql)
    flag = "(start_id IS NOT NULL)" if use_background else "false"
    heads = [f"{name} AS MATERIALIZED ({PARTS[name]})" for name in PARTS if name in used]
    return ("WITH " + ",\n".join(heads) + "\n" + sql if heads else sql).replace("{BG}", flag).replace("{EXCLUDED}", without)
