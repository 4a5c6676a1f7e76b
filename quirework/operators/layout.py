"""Boxes, columns and reading order of page detections.

Tables: detections (doc_id, det_id, page_index, label_id, confidence, x1, y1, x2, y2, model) in
pixels, pages (doc_id, page_index, pdf_width, pdf_height, img_width, img_height, page_number,
page_number_end, column bounds, midpoint). Every operator is keyed by doc_id, so volumes are
independent and a shuffle never gathers more than one volume's rows in a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions import expressions as E
from quirework.functions.labels import ID, label_dimension

PAGE = ["doc_id", "page_index"]


def box_sizes(det: DataFrame) -> DataFrame:
    return det.withColumns({"width": F.col("x2") - F.col("x1"), "height": F.col("y2") - F.col("y1"), "center_x": E.center_x(), "center_y": E.center_y(), "area": (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))})


def with_columns_fallback(pages: DataFrame) -> DataFrame:
    """Pages without a midpoint get an even split with padding and gutter from the image width."""
    w, half = F.col("img_width"), F.floor(F.col("img_width") / 2)
    pad, gutter = F.greatest(F.lit(20), F.floor(w * 0.03)), F.greatest(F.lit(10), F.floor(w * 0.02))
    fresh = {"col_left_x1": pad, "col_left_x2": F.greatest(pad + 10, half - gutter), "col_right_x1": F.least(w - pad - 10, half + gutter), "col_right_x2": w - pad, "midpoint": w / 2}
    none = F.col("midpoint") == 0
    return pages.withColumns({c: F.when(none, v.cast("double")).otherwise(F.col(c)) for c, v in fresh.items()})


def document_midpoints(pages: DataFrame) -> DataFrame:
    """A volume's midpoint is that of its first page."""
    return with_columns_fallback(pages).groupBy("doc_id").agg(F.min_by("midpoint", "page_index").alias("doc_mid"))


def with_pages(det: DataFrame, pages: DataFrame, *extra: str) -> DataFrame:
    """Detections with their page's scale and the page columns asked for; detections without a page go."""
    p = with_columns_fallback(pages).select(*PAGE, E.scale_x().alias("sx"), E.scale_y().alias("sy"), *extra)
    return det.join(p, PAGE)


def to_points(det: DataFrame, pages: DataFrame) -> DataFrame:
    """Rects in PDF points as x0, y0, x1, y1."""
    d = with_pages(det, pages)
    return d.select(*[c for c in det.columns if c not in E.BOX], (F.col("x1") * F.col("sx")).alias("x0"), (F.col("y1") * F.col("sy")).alias("y0"), (F.col("x2") * F.col("sx")).alias("rx1"), (F.col("y2") * F.col("sy")).alias("ry1")).withColumnsRenamed({"rx1": "x1", "ry1": "y1"})


def with_reading_key(det: DataFrame, pages: DataFrame) -> DataFrame:
    """Adds col (0 left, 1 right of the page's midpoint); order by page_index, col, y1."""
    return with_pages(det, pages, "midpoint").withColumn("col", E.column_ordinal(F.col("midpoint"))).drop("sx", "sy")


def with_document_key(det: DataFrame, pages: DataFrame) -> DataFrame:
    """Adds doc_mid, col by it, and the reading key sk = (page_index, col, y1)."""
    d = det.join(document_midpoints(pages), "doc_id").withColumn("col", E.column_ordinal(F.col("doc_mid")))
    return d.withColumn("sk", F.struct("page_index", "col", "y1"))


def reading_order(det: DataFrame, pages: DataFrame) -> DataFrame:
    """Adds the place in reading order within the page, from 1."""
    by = Window.partitionBy(*PAGE).orderBy("col", "y1", "det_id")
    return with_reading_key(det, pages).withColumn("place", F.row_number().over(by).cast("long"))


def overlapping_pairs(det: DataFrame) -> DataFrame:
    """Pairs of detections of one page that overlap, with intersection, iou and the two containment tests."""
    a, b = det.alias("a"), det.alias("b")
    on = (F.col("a.doc_id") == F.col("b.doc_id")) & (F.col("a.page_index") == F.col("b.page_index")) & (F.col("a.det_id") < F.col("b.det_id"))
    touch = (F.col("a.x1") < F.col("b.x2")) & (F.col("b.x1") < F.col("a.x2")) & (F.col("a.y1") < F.col("b.y2")) & (F.col("b.y1") < F.col("a.y2"))
    A, B = E.box("a"), E.box("b")
    inside = lambda o, i: (o["x1"] <= i["x1"]) & (o["y1"] <= i["y1"]) & (o["x2"] >= i["x2"]) & (o["y2"] >= i["y2"])
    return a.join(b, on & touch).select(
        F.col("a.doc_id"), F.col("a.page_index"), F.col("a.det_id").alias("a_id"), F.col("b.det_id").alias("b_id"), E.intersection(A, B).alias("intersection"), E.iou(A, B).alias("iou"),
        (E.intersection(A, B) / E.area(B) >= 0.8).alias("a_contains_b"), (E.intersection(A, B) / E.area(A) >= 0.8).alias("b_contains_a"), (inside(A, B) | inside(B, A)).alias("fully_inside"),
    )


def split_page_ranges(totals: DataFrame, chunks: int) -> DataFrame:
    """doc_id and page_count to at most ``chunks`` nearly equal half-open ranges; empty ones are dropped."""
    size = F.ceil(F.col("page_count") / chunks)
    d = totals.withColumn("size", size).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    start = (F.col("chunk") * F.col("size")).cast("long")
    end = F.least(start + F.col("size"), F.col("page_count")).cast("long")
    return d.select("doc_id", F.col("chunk").cast("long").alias("chunk"), start.alias("page_start"), end.alias("page_end")).where("page_start < page_end")


def box_captions(det: DataFrame) -> DataFrame:
    """The text drawn at a detection's box: label and confidence in whole percent."""
    dim = F.broadcast(label_dimension(det.sparkSession).select("label_id", "label"))
    return det.join(dim, "label_id").select("doc_id", "det_id", F.format_string("%s %d%%", "label", F.bround(F.col("confidence") * 100, 0).cast("long")).alias("caption"))


def with_labels(det: DataFrame) -> DataFrame:
    """Adds the label dimension's columns; unknown label ids are dropped."""
    return det.join(F.broadcast(label_dimension(det.sparkSession)), "label_id")


def by_labels(det: DataFrame, pages: DataFrame, *names: str) -> DataFrame:
    return reading_order(det.where(F.col("label_id").isin([ID[n] for n in names])), pages)


def confident(det: DataFrame) -> DataFrame:
    """Detections at or above their label's least confidence; other columns stay as they are."""
    dim = F.broadcast(label_dimension(det.sparkSession).select("label_id", "min_conf"))
    return det.join(dim, "label_id").where(F.col("confidence") >= F.col("min_conf")).select(*det.columns)


def _mark_condition(tolerance: int) -> Column:
    near = lambda c, m: F.abs(F.bround(F.col(f"d.{c}"), 0) - F.col(f"m.{m}")) <= tolerance
    same = (F.col("d.doc_id") == F.col("m.doc_id")) & (F.col("d.page_index") == F.col("m.page_index")) & (F.col("d.label_id") == F.col("m.label_id"))
    return same & near("x1", "x") & near("y1", "y")


def without_excluded(det: DataFrame, exclusions: DataFrame, tolerance: int = 10) -> DataFrame:
    """Detections that no exclusion of their page and label matches within ``tolerance`` pixels of the origin."""
    return det.alias("d").join(exclusions.alias("m"), _mark_condition(tolerance), "left_anti")


def with_approval(det: DataFrame, approvals: DataFrame, tolerance: int = 10) -> DataFrame:
    """Adds approved: whether a mark of the reviewer matches."""
    hit = det.alias("d").join(approvals.alias("m"), _mark_condition(tolerance), "left_semi").select("doc_id", "det_id").withColumn("approved", F.lit(True))
    return det.join(hit, ["doc_id", "det_id"], "left").withColumn("approved", F.coalesce("approved", F.lit(False)))


def key_icon_ratio(ratio_min: float = 1.5, ratio_max: float = 4.0) -> Column:
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    return F.when(h > 0, w / h).otherwise(F.lit(0.0)).between(ratio_min, ratio_max)


def plausible_key_icons(icons: DataFrame, *scope: str, tolerance: float = 0.4, trusted: float = 0.90) -> DataFrame:
    """Key icons of good ratio and, where a group has two or more, of a size near its median.

    The median is over trusted icons where there are two of them, else over all; trusted icons
    pass by their ratio alone. ``scope`` names the group: the volume or the page.
    """
    w, h, sure = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"), F.col("confidence") >= trusted
    stats = icons.groupBy(*scope).agg(
        F.count("*").alias("n"), F.count(F.when(sure, 1)).alias("n_sure"), F.median(w).alias("w_all"), F.median(h).alias("h_all"), F.median(F.when(sure, w)).alias("w_sure"), F.median(F.when(sure, h)).alias("h_sure"),
    )
    mid = stats.select(*scope, "n", F.when(F.col("n_sure") >= 2, F.col("w_sure")).otherwise(F.col("w_all")).alias("mw"), F.when(F.col("n_sure") >= 2, F.col("h_sure")).otherwise(F.col("h_all")).alias("mh"))
    near = (F.abs(w - F.col("mw")) / F.col("mw") <= tolerance) & (F.abs(h - F.col("mh")) / F.col("mh") <= tolerance)
    return icons.join(mid, list(scope)).where(key_icon_ratio() & ((F.col("n") < 2) | sure | near)).select(*icons.columns)


def key_icon_medians(icons: DataFrame, *scope: str, trusted: float = 0.90) -> DataFrame:
    w, h, sure = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"), F.col("confidence") >= trusted
    many = F.count(F.when(sure, 1)) >= 2
    return icons.groupBy(*scope).agg(F.count("*").alias("n"), F.when(many, F.median(F.when(sure, w))).otherwise(F.median(w)).alias("median_w"), F.when(many, F.median(F.when(sure, h))).otherwise(F.median(h)).alias("median_h")).where("n >= 2")


def trim_state_abbreviations(det: DataFrame) -> DataFrame:
    """State abbreviations cut back from the page numbers they overlap; those left at most 5 pixels wide go.

    Only confident detections count. The page numbers of a page (a handful) are folded one after another.
    """
    fine = confident(det)
    pn = fine.where(F.col("label_id") == ID["PAGE_NUMBER"]).groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.struct("det_id", "x1", "y1", "x2", "y2"))).alias("pns"))
    sa = fine.where(F.col("label_id") == ID["STATE_ABBREVIATION"]).join(pn, PAGE, "left")
    cut = F.expr("""aggregate(coalesce(pns, array()), named_struct('a', x1, 'z', x2), (s, p) ->
        CASE WHEN s.a < p.x2 AND p.x1 < s.z AND y1 < p.y2 AND p.y1 < y2 THEN
            CASE WHEN (s.a + s.z) / 2 < (p.x1 + p.x2) / 2 THEN named_struct('a', s.a, 'z', least(s.z, p.x1)) ELSE named_struct('a', greatest(s.a, p.x2), 'z', s.z) END
        ELSE s END)""")
    trimmed = sa.withColumn("s", cut).where("s.z - s.a > 5").withColumns({"x1": F.col("s.a"), "x2": F.col("s.z")}).select(*det.columns)
    return fine.where(F.col("label_id") != ID["STATE_ABBREVIATION"]).unionByName(trimmed)


def trim_drawn_abbreviations(rects: DataFrame, numbers: DataFrame) -> DataFrame:
    """The same on tightened rects (x0..y1) of drawn boxes: left edges are compared, those left under 3 points wide go."""
    pn = numbers.groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.struct("det_id", "x0", "y0", "x1", "y1"))).alias("pns"))
    cut = F.expr("""aggregate(coalesce(pns, array()), named_struct('a', x0, 'z', x1), (s, p) ->
        CASE WHEN s.a < p.x1 AND p.x0 < s.z AND y0 < p.y1 AND p.y0 < y1 THEN
            CASE WHEN s.a < p.x0 THEN named_struct('a', s.a, 'z', least(s.z, p.x0)) ELSE named_struct('a', greatest(s.a, p.x1), 'z', s.z) END
        ELSE s END)""")
    return rects.join(pn, PAGE, "left").withColumn("s", cut).where("s.z - s.a >= 3").withColumns({"x0": F.col("s.a"), "x1": F.col("s.z")}).select(*rects.columns)


def page_number_boxes(det: DataFrame, least: int = 40, edge: int = 5) -> DataFrame:
    """Usable page-number boxes with their rank by confidence within the page."""
    fine = det.where((F.col("label_id") == ID["PAGE_NUMBER"]) & (F.col("x2") - F.col("x1") >= least) & (F.col("y2") - F.col("y1") >= least) & (F.col("x1") >= edge) & (F.col("y1") >= edge))
    return fine.withColumn("rank", F.row_number().over(Window.partitionBy(*PAGE).orderBy(F.col("confidence").desc(), "det_id")).cast("long"))


def page_number_crops(det: DataFrame, pages: DataFrame, pad: int = 10, least: int = 30, edge: int = 5) -> DataFrame:
    """Crops read for validation: padded boxes away from the page's upper and lower edge, clipped to the image."""
    d = det.where(F.col("label_id") == ID["PAGE_NUMBER"]).join(pages.select(*PAGE, "img_width", "img_height"), PAGE)
    whole = lambda c: F.col(c).cast("long")  # noqa: E731  towards zero
    zero = F.lit(0).cast("long")
    crop = d.where((F.col("y1") >= edge) & (F.col("y2") <= F.col("img_height") - edge)).select(
        "doc_id", "page_index", "det_id", "confidence", F.greatest(zero, whole("x1") - pad).alias("crop_x1"), F.greatest(zero, whole("y1") - pad).alias("crop_y1"),
        F.least(F.col("img_width"), whole("x2") + pad).alias("crop_x2"), F.least(F.col("img_height"), whole("y2") + pad).alias("crop_y2"))
    return crop.where((F.col("crop_x2") - F.col("crop_x1") >= least) & (F.col("crop_y2") - F.col("crop_y1") >= least))


def pages_without_abbreviation(det: DataFrame, pages: DataFrame, wanted: bool | None = None, share: float = 0.10) -> DataFrame:
    """Pages to search again for state abbreviations: all that lack one, where the volume shows the pattern or ``wanted`` says so."""
    has = det.where(F.col("label_id") == ID["STATE_ABBREVIATION"]).select(*PAGE).distinct().withColumn("has", F.lit(1))
    flagged = pages.select(*PAGE).join(has, PAGE, "left")
    if wanted is False:
        return flagged.where(F.lit(False)).select(*PAGE)
    missing = flagged.where("has IS NULL").select(*PAGE)
    if wanted:
        return missing
    pattern = flagged.groupBy("doc_id").agg(F.count("has").alias("n"), F.count("*").alias("total")).where(F.col("n") > F.col("total") * share).select("doc_id")
    return missing.join(pattern, "doc_id", "left_semi")


def margin_bounds(det: DataFrame, pages: DataFrame) -> DataFrame:
    """For every page in points: the lowest edge of what stands in its head and the highest of what stands in its foot."""
    margin, foot = [ID[n] for n in ("PAGE_HEADER", "PAGE_NUMBER", "STATE_ABBREVIATION")], ID["FOOTNOTES"]
    p = pages.select(*PAGE, E.scale_y().alias("sy"), "pdf_height")
    d = p.join(det.where(F.col("label_id").isin(margin + [foot])).select(*PAGE, "label_id", "y1", "y2"), PAGE, "left")
    top, bottom, own = F.col("y1") * F.col("sy"), F.col("y2") * F.col("sy"), F.col("label_id").isin(margin)
    upper = (top + bottom) / 2 < F.col("pdf_height") / 2
    return d.groupBy(*PAGE).agg(
        F.greatest(F.lit(0.0), F.coalesce(F.max(F.when(own & upper, bottom)), F.lit(0.0))).alias("header_bottom"),
        F.least(F.first("pdf_height"), F.coalesce(F.min(F.when((own & ~upper) | (F.col("label_id") == foot), top)), F.first("pdf_height"))).alias("footer_top"),
    )


def column_bounds(det: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages with two or more text columns: bounds of the outermost two in points, and the boundary between them."""
    d = to_points(det.where(F.col("label_id") == ID["TEXT_COLUMN"]), pages)
    key = F.struct(((F.col("x0") + F.col("x1")) / 2).alias("cx"), F.col("det_id"))
    agg = d.groupBy(*PAGE).agg(F.count("*").alias("n"), F.min_by(F.struct("x0", "x1"), key).alias("l"), F.max_by(F.struct("x0", "x1"), key).alias("r")).where("n >= 2")
    return agg.select(*PAGE, F.col("l.x0").alias("left_x0"), F.col("l.x1").alias("left_x1"), F.col("r.x0").alias("right_x0"), F.col("r.x1").alias("right_x1"), ((F.col("l.x1") + F.col("r.x0")) / 2).alias("boundary"))


def right_column_edge(det: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages with headnotes in the right half: the leftmost edge of these, in pixels and points."""
    d = with_pages(det.where(F.col("label_id") == ID["HEADNOTE"]), pages, "midpoint")
    right = d.where((E.center_x() > F.col("midpoint")) & (F.col("x1") >= F.col("midpoint") * 0.75))
    return right.groupBy(*PAGE).agg(F.min("x1").alias("edge_px"), (F.min("x1") * F.first("sx")).alias("edge"))


def grouped_by_page(det: DataFrame) -> DataFrame:
    """A row for each page: the attributes of its first detection, and the number of detections."""
    return det.groupBy(*PAGE).agg(F.min_by("model", "det_id").alias("model"), F.min("det_id").alias("first_id"), F.count("*").alias("n"))


def last_headnote_column(det: DataFrame, pages: DataFrame, least: float = 0.75) -> DataFrame:
    """For each volume the last page and column with a confident headnote."""
    d = with_reading_key(det.where((F.col("label_id") == ID["HEADNOTE"]) & (F.col("confidence") >= least)), pages)
    return d.groupBy("doc_id").agg(F.max(F.struct("page_index", "col")).alias("m")).select("doc_id", F.col("m.page_index").alias("last_page"), F.col("m.col").alias("last_col"))
