"""Queries on file names, side files and export plans."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quirework.functions import names as N
from quirework.functions.labels import ID
from quirework.functions.session import shared_dir
from quirework.operators import layout, outputs, pairing, words as W, zones
from quirework.plans import layout_queries, zone_queries
from quirework.plans.common import query
from quirework.sources import sidecars as J

_NAMES = """SELECT s_suppkey, CASE CAST(s_suppkey % 8 AS INT) WHEN 0 THEN concat('f3d.', CAST(s_suppkey AS STRING), '.1.1200.pdf') WHEN 1 THEN concat('u.s.app.', CAST(s_suppkey AS STRING), '.15.90_redacted.pdf') WHEN 2 THEN concat('sct.', CAST(s_suppkey AS STRING), '.5.2.pdf')
    WHEN 3 THEN concat('rep.', CAST(s_suppkey AS STRING), '.1.9.ocr.pdf') WHEN 4 THEN concat('a3d.', CAST(s_suppkey AS STRING), '.x.9.pdf') WHEN 5 THEN 'scan.pdf' WHEN 6 THEN concat('rep.', CAST(s_suppkey AS STRING), '.0.9.pdf') ELSE concat('b-r.', CAST(s_suppkey AS STRING), '.7.70-copy2.pdf') END AS name FROM {supplier}"""
_STEM = r"regexp_replace(regexp_replace(name, '\.[^.]*$', ''), '[_-](redacted|ocr|compressed|dupes|bitonal|copy|fixed)\b.*', '')"


@query("src14_volume_names", rf"""SELECT s_suppkey, array_to_string(p[1:len(p) - 3], '.') AS reporter, p[-3] AS volume, CAST(p[-2] AS BIGINT) AS first_page, CAST(p[-1] AS BIGINT) AS last_page
    FROM (SELECT s_suppkey, string_split(regexp_replace({_STEM}, '\.(redacted|ocr|compressed)$', ''), '.') AS p FROM ({_NAMES.replace("{supplier}", "supplier")}) n) q WHERE len(p) >= 4 AND TRY_CAST(p[-2] AS BIGINT) >= 1 AND TRY_CAST(p[-1] AS BIGINT) >= TRY_CAST(p[-2] AS BIGINT)""")
def _(v):
    d = v.spark.sql(_NAMES, supplier=v.table("supplier"))
    return d.withColumn("v", N.volume_of(F.col("name"))).where("v IS NOT NULL").select("s_suppkey", "v.*")


@query("x14_pages_of_file_name", rf"""SELECT s_suppkey, coalesce(CASE WHEN b IS NOT NULL THEN a END, 0) AS first_page, coalesce(CASE WHEN a IS NOT NULL THEN b END, 0) AS last_page FROM (SELECT s_suppkey, TRY_CAST(string_split(t, '-')[1] AS BIGINT) AS a, TRY_CAST(string_split(t, '-')[2] AS BIGINT) AS b
    FROM (SELECT s_suppkey, string_split(CASE WHEN s_suppkey % 2 = 0 THEN printf('vol.%d.%04d-%04d', s_suppkey, s_suppkey, s_suppkey + 9) ELSE 'vol.notes' END, '.')[-1] AS t FROM supplier) x) q""")
def _(v):
    name = F.when(F.col("s_suppkey") % 2 == 0, F.format_string("vol.%d.%04d-%04d.pdf", "s_suppkey", "s_suppkey", F.col("s_suppkey") + 9)).otherwise(F.lit("vol.notes.pdf"))
    return v.table("supplier").withColumn("p", N.pages_of(name)).select("s_suppkey", "p.*")


@query("x11_reporter", "SELECT s_suppkey, lower(replace(n, '-', '')) = 'sct' AS is_sct FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'S-Ct' WHEN s_suppkey % 3 = 1 THEN 'sct' ELSE 'F3d' END AS n FROM supplier) q")
def _(v):
    n = F.when(F.col("s_suppkey") % 3 == 0, "S-Ct").when(F.col("s_suppkey") % 3 == 1, "sct").otherwise("F3d")
    return v.table("supplier").select("s_suppkey", N.is_reporter(n).alias("is_sct"))


@query("snk17_target_dpi", "SELECT p_partkey, CASE WHEN p_retailprice <= 148 THEN 300.0::DOUBLE ELSE greatest(100.0::DOUBLE, 300.0::DOUBLE * sqrt(148.0::DOUBLE / p_retailprice)) END AS dpi FROM part")
def _(v):
    return v.table("part").select("p_partkey", N.target_dpi(F.col("p_retailprice"), F.lit(300.0)).alias("dpi"))


@query("snk12_image_names", """SELECT d.doc_id, det_id, printf('%04d-%03d.png', coalesce(page_number, d.page_index + 1), row_number() OVER (PARTITION BY d.doc_id, d.page_index ORDER BY CASE WHEN (x1 + x2) / 2 < midpoint THEN 0 ELSE 1 END, y1, det_id)) AS file_name
    FROM det d JOIN pgf USING (doc_id, page_index) WHERE label_id = 10""")
def _(v):
    d = layout.by_labels(v.detections, v.pages, "IMAGE").join(v.pages.select(*layout.PAGE, "page_number"), layout.PAGE)
    return d.select("doc_id", "det_id", N.image_name(F.coalesce("page_number", F.col("page_index") + 1), F.col("place")).alias("file_name"))


@query("src15_injected", """SELECT doc_id, page_index - 5 AS page_index, det_id, confidence FROM det WHERE page_index BETWEEN 5 AND 14 UNION ALL
    SELECT doc_id, page_index - 5, det_id + 500000, CASE WHEN det_id % 2 = 0 THEN 1.0::DOUBLE ELSE confidence END FROM det WHERE det_id % 10 = 0 AND page_index BETWEEN 5 AND 14""")
def _(v):
    section = J.remap_marks(v.detections, 5, 14)
    extra = v.detections.where("det_id % 10 = 0").withColumns({"confidence": F.when(F.col("det_id") % 2 == 1, F.col("confidence")), "det_id": F.col("det_id") + 500000})
    return J.inject(section, extra, 5, 14).select("doc_id", "page_index", "det_id", "confidence")


@query("src6_rebuilt_pages", """SELECT p.doc_id, p.page_index, 612::DOUBLE AS pdf_width, coalesce(d.w, 1700) AS img_width, d.n AS page_number, p.midpoint FROM pg p
    LEFT JOIN (SELECT DISTINCT det.doc_id, det.page_index, img_width AS w, page_number AS n FROM det JOIN pg USING (doc_id, page_index) WHERE label_id < 3) d ON d.doc_id = p.doc_id AND d.page_index = p.page_index""")
def _(v):
    seen = v.detections.where("label_id < 3").join(v.pages.select(*layout.PAGE, "img_width", "img_height", "page_number", "page_number_end"), layout.PAGE)
    meta = v.pages.select(*layout.PAGE, "pdf_width", "pdf_height", "col_left_x1", "col_left_x2", "col_right_x1", "col_right_x2", "midpoint")
    return J.rebuild(seen, v.pages, meta).select(*layout.PAGE, "pdf_width", "img_width", "page_number", "midpoint")


@query("snk1_detection_records", """SELECT det.doc_id, det_id, det.page_index, label, label_id, round(confidence, 3) AS confidence, list_transform([x1, y1, x2, y2], lambda x: round(x, 1)) AS bbox, page_number, page_number_end, img_width, img_height FROM det JOIN dim USING (label_id) JOIN pg ON pg.doc_id = det.doc_id AND pg.page_index = det.page_index""")
def _(v):
    return J.detection_records(v.detections, v.pages)


@query("src2_detections_round_trip", "SELECT doc_id, page_index, label_id, confidence, x1, y1, x2, y2 FROM det")
def _(v):
    """To JSON text and back by the reader's schema."""
    rows = J.detection_records(v.detections, v.pages)
    fields = [c for c in rows.columns if c not in ("doc_id", "det_id")]
    back = rows.select("doc_id", F.from_json(F.to_json(F.struct(*fields)), J.DETECTION_FIELDS).alias("r")).select("doc_id", "r.*")
    return J.unpack_detections(back).select("doc_id", "page_index", "label_id", "confidence", "x1", "y1", "x2", "y2")


@query("src4_pages_round_trip", "SELECT doc_id, page_index, pdf_width, pdf_height, col_left_x1, col_left_x2, col_right_x1, col_right_x2, midpoint FROM pg")
def _(v):
    text = J.page_records(v.pages).select("doc_id", F.from_json(F.to_json("pages"), J.PAGE_FIELDS).alias("pages"))
    return J.unpack_pages(text)


@query("snk2_page_records", "SELECT doc_id, page_index, pdf_width, pdf_height, col_left_x1, col_left_x2, col_right_x1, col_right_x2, midpoint FROM pg")
def _(v):
    d = J.page_records(v.pages).select("doc_id", F.explode("pages").alias("page_index", "r"))
    return d.select("doc_id", F.col("page_index").cast("long").alias("page_index"), "r.*")


@query("snk3_opinion_records", f"""SELECT op.doc_id, op.opinion, caption_page, 'CASE_CAPTION' AS caption_label, list_transform([caption_x1, caption_y1, caption_x2, caption_y2], lambda x: round(x, 1)) AS caption_bbox, key_page, 'KEY_ICON' AS key_label, list_transform([key_x1, key_y1, key_x2, key_y2], lambda x: round(x, 1)) AS key_bbox,
    key_page - caption_page + 1 AS page_count, coalesce(told, '') AS outside, EXISTS (SELECT 1 FROM det d WHERE d.doc_id = op.doc_id AND d.page_index BETWEEN caption_page AND key_page AND label_id = 10) AS has_image
    FROM op LEFT JOIN (SELECT doc_id, opinion, string_agg(page_index || ':' || r.part || ':' || CAST(round(r.x0 * 10) AS BIGINT) || ',' || CAST(round(r.y0 * 10) AS BIGINT) || ',' || CAST(round(r.x1 * 10) AS BIGINT) || ',' || CAST(round(r.y1 * 10) AS BIGINT), ';' ORDER BY page_index, r.part) AS told FROM ({layout_queries.OUTSIDE}) o GROUP BY ALL) u ON u.doc_id = op.doc_id AND u.opinion = op.opinion""")
def _(v):
    o = v.opinions
    outside = pairing.outside_rects(v.det, v.pg, o)
    records = J.opinion_records(pairing.with_images(o, v.det), outside)
    # The records' rects stand in the order of page and part; a part's name is not stored, so it is set beside them here.
    names = outside.groupBy("doc_id", "opinion").agg(F.transform(F.sort_array(F.collect_list(F.struct("page_index", "part"))), lambda p: p["part"]).alias("parts"))
    tenth = lambda c: F.round(c * 10).cast("long").cast("string")
    told = F.zip_with("outside_rects", "parts", lambda r, p: F.concat_ws(":", r["page_index"].cast("string"), p, F.concat_ws(",", *[tenth(r[c]) for c in ("x0", "y0", "x1", "y1")])))
    return records.join(names, ["doc_id", "opinion"], "left").withColumn("outside", F.coalesce(F.array_join(told, ";"), F.lit(""))).drop("outside_rects", "parts")


@query("snk4_rect_records_round_trip", "SELECT ki.doc_id, ki.page_index, row_number() OVER (PARTITION BY ki.doc_id, ki.page_index ORDER BY det_id) - 1 AS rect_no, round(x1, 1) AS x0, round(y1, 1) AS y0, round(x2, 1) AS x1, round(y2, 1) AS y1, 'black' AS fill, 'KEY_ICON' AS type FROM ki")
def _(v):
    icons = layout.confident(layout.plausible_key_icons(v.detections.where(F.col("label_id") == ID["KEY_ICON"]), *layout.PAGE))
    rects = icons.select(*layout.PAGE, "det_id", F.col("x1").alias("x0"), F.col("y1").alias("y0"), F.col("x2").alias("x1"), F.col("y2").alias("y1"), F.lit("black").alias("fill"), F.lit("KEY_ICON").alias("type"))
    rows = J.rect_records(rects, "det_id")
    back = rows.select("doc_id", F.from_json(F.to_json(F.struct("page_index", "rects")), J.RECT_FIELDS).alias("r")).select("doc_id", "r.*")
    return J.unpack_rects(back)


@query("j18_key_icons_from_rects", "SELECT ki.doc_id, ki.page_index, x1 * (pdf_width / img_width) AS x0, y1 * (pdf_height / img_height) AS y0, x2 * (pdf_width / img_width) AS x1, y2 * (pdf_height / img_height) AS y1 FROM ki JOIN pg ON pg.doc_id = ki.doc_id AND pg.page_index = ki.page_index WHERE img_width > 1")
def _(v):
    icons = layout.confident(layout.plausible_key_icons(v.detections.where(F.col("label_id") == ID["KEY_ICON"]), *layout.PAGE))
    rects = icons.select(*layout.PAGE, F.col("x1").alias("x0"), F.col("y1").alias("y0"), F.col("x2").alias("x1"), F.col("y2").alias("y1"))
    scale = v.pages.where("img_width > 1").select(*layout.PAGE, (F.col("pdf_width") / F.col("img_width")).alias("sx"), (F.col("pdf_height") / F.col("img_height")).alias("sy"))
    return rects.join(scale, layout.PAGE).select(*layout.PAGE, (F.col("x0") * F.col("sx")).alias("x0"), (F.col("y0") * F.col("sy")).alias("y0"), (F.col("x1") * F.col("sx")).alias("x1"), (F.col("y1") * F.col("sy")).alias("y1"))


@query("snk5_margin_records", f"SELECT doc_id, page_index, row_number() OVER (PARTITION BY doc_id, page_index ORDER BY s.side) - 1 AS rect_no, round(s.x0, 1) AS x0, round(s.y0, 1) AS y0, round(s.x1, 1) AS x1, round(s.y1, 1) AS y1 FROM ({zone_queries._MARGINS}) m WHERE s IS NOT NULL")
def _(v):
    return J.unpack_rects(J.rect_records(W.margin_rects(W.page_text_bounds(v.blocks)), "side"))


def _stored(v, records, name: str) -> str:
    path = f"{shared_dir(v.spark)}/{name}-{uuid.uuid4().hex}"
    J.write_records(records, path)
    return path


@query("src5_margin_files", f"SELECT doc_id, page_index, row_number() OVER (PARTITION BY doc_id, page_index ORDER BY s.side) - 1 AS rect_no, round(s.x0, 1) AS x0, round(s.y0, 1) AS y0, round(s.x1, 1) AS x1, round(s.y1, 1) AS y1 FROM ({zone_queries._MARGINS}) m WHERE s IS NOT NULL")
def _(v):
    path = _stored(v, J.rect_records(W.margin_rects(W.page_text_bounds(v.blocks)), "side"), "margin-files")
    return J.read_rects(v.spark, path, lines=True).drop("fill", "type")


@query("src5_opinion_files", "SELECT doc_id, caption_page, key_page, key_page - caption_page + 1 AS page_count, [round(caption_x1, 1), round(caption_y1, 1), round(caption_x2, 1), round(caption_y2, 1)] AS caption_bbox, [round(key_x1, 1), round(key_y1, 1), round(key_x2, 1), round(key_y2, 1)] AS key_bbox FROM op")
def _(v):
    o = v.opinions
    path = _stored(v, J.opinion_records(pairing.with_images(o, v.det), pairing.outside_rects(v.det, v.pg, o)), "opinion-files")
    return J.read_opinions(v.spark, path, lines=True).select("doc_id", "caption_page", "key_page", "page_count", "caption_bbox", "key_bbox")


@query("src3_found_files", "SELECT doc_id, true AS found FROM det GROUP BY doc_id")
def _(v):
    path = _stored(v, J.detection_records(v.det, v.pg).drop("det_id"), "detection-files")
    return J.find_sidecars(v.spark, path, "part-*.json").select("doc_id", F.col("path").contains("detection-files").alias("found"))


@query("src2_detection_files", "SELECT doc_id, page_index, label_id, confidence, x1, y1, x2, y2, page_number, page_number_end, img_width, img_height FROM det JOIN pg USING (doc_id, page_index)")
def _(v):
    path = _stored(v, J.detection_records(v.det, v.pg).drop("det_id"), "detection-files")
    return J.read_detections(v.spark, path, lines=True)


@query("snk9_split_pages", "SELECT doc_id, opinion, page_index, page_index - caption_page AS local_page, is_first, is_last FROM oppg")
def _(v):
    on = pairing.opinion_pages(v.opinions, v.pg)
    return on.select("doc_id", "opinion", "page_index", (F.col("page_index") - F.col("caption_page")).alias("local_page"), "is_first", "is_last")


@query("snk14_drawn_boxes", "SELECT tight.doc_id, tight.det_id, label, x0, y0, x1, y1 FROM tight JOIN dim USING (label_id) WHERE confidence >= min_conf")
def _(v):
    fine = layout.with_labels(layout.confident(v.detections))
    rects = layout.to_points(fine, v.pages)
    return W.tighten(rects, v.words, "doc_id", "det_id").select("doc_id", "det_id", "label", "x0", "y0", "x1", "y1")


_PAGE_RECTS = f"""SELECT ki.doc_id, ki.page_index, 'KEY_ICON' AS type, x1 * sx AS x0, y1 * sy AS y0, x2 * sx AS x1, y2 * sy AS y1, 'black' AS fill FROM ki JOIN pgf ON pgf.doc_id = ki.doc_id AND pgf.page_index = ki.page_index
    UNION ALL SELECT doc_id, page_index, 'margin', s.x0, s.y0, s.x1, s.y1, 'white' FROM ({zone_queries._MARGINS}) m WHERE s IS NOT NULL"""


@query("snk10_generate_plan", f"""SELECT 'full' AS mode, doc_id, NULL::BIGINT AS opinion, page_index, type, x0, y0, x1, y1, fill FROM ({_PAGE_RECTS}) a
    UNION ALL SELECT 'redacted', oppg.doc_id, opinion, oppg.page_index, type, b.x0, b.y0, b.x1, b.y1, b.fill FROM oppg JOIN ({_PAGE_RECTS}) b ON b.doc_id = oppg.doc_id AND b.page_index = oppg.page_index
    UNION ALL SELECT 'redacted', doc_id, opinion, page_index, 'outside', r.x0, r.y0 + 3, r.x1, r.y1, 'white' FROM ({layout_queries.OUTSIDE}) c WHERE r.y0 + 3 < r.y1
    UNION ALL SELECT 'unredacted', doc_id, opinion, page_index, 'outside', r.x0, r.y0, r.x1, r.y1, 'white' FROM ({layout_queries.OUTSIDE}) d""")
def _(v):
    icons = zones.key_icon_rects(v.det, v.pg).select(*layout.PAGE, F.lit("KEY_ICON").alias("type"), "x0", "y0", "x1", "y1", F.lit("black").alias("fill"))
    margins = W.margin_rects(W.page_text_bounds(v.blocks)).select(*layout.PAGE, F.lit("margin").alias("type"), "x0", "y0", "x1", "y1", F.lit("black").alias("fill"))
    return outputs.generate_plan(v.opinions, pairing.outside_rects(v.det, v.pg, v.opinions), icons.unionByName(margins))


@query("snk7_stored_rects_in_points", """SELECT d.doc_id, d.page_index, det_id, x1 * sx AS x0, y1 * sy AS y0, x2 * sx AS x1, y2 * sy AS y1, CASE WHEN det_id % 2 = 0 THEN 'black' ELSE 'white' END AS fill FROM det d JOIN pgf USING (doc_id, page_index)""")
def _(v):
    fill = F.when(F.col("det_id") % 2 == 0, "black").otherwise("white")
    rects = v.detections.select("doc_id", "page_index", "det_id", F.col("x1").alias("x0"), F.col("y1").alias("y0"), F.col("x2").alias("x1"), F.col("y2").alias("y1"), fill.alias("fill"))
    return outputs.stored_rects_in_points(rects, v.pages)


@query("snk7_scan_names", """SELECT doc_id, 'vol.' || doc_id || '.' || coalesce(nullif(a, 0), 1) || '.' || CASE WHEN coalesce(z, 0) <> 0 THEN coalesce(nullif(ze, 0), z) ELSE n END || '.redacted.pdf' AS file_name
    FROM (SELECT doc_id, arg_min({'v': page_number}, page_index).v AS a, arg_max({'v': page_number}, page_index).v AS z, arg_max({'v': page_number_end}, page_index).v AS ze, count(*) AS n FROM pg GROUP BY doc_id) q""")
def _(v):
    return outputs.scan_names(v.pages)
