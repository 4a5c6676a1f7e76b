"""Headnote zones of opinions, redaction rectangles, and what protects parts of a page from them.

A zone runs from a start to an end marker in reading order; on each page between them it takes
the columns between, clamped to the page's margin bounds. Three variants of the whole
redaction plan exist, which differ on purpose: ``plan_precomputed`` (pixels, as stored for a
review), ``plan_full`` (points, whole volume) and ``plan_split`` (points, for each opinion).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions import expressions as E
from quirework.functions.labels import FILL, ID
from quirework.functions.session import staged
from quirework.operators import layout, pairing, words as W
from quirework.operators.layout import PAGE

OPINION = ["doc_id", "opinion"]


def zone_markers(members: DataFrame, reporter: str | None = None) -> DataFrame:
    """For each opinion the first background after its caption (start) and its end marker, as structs or null.

    The end is the first syllabus (only for the reporter sct), else the first divider, else the
    first case metadata if a headnote or background follows the caption.
    """
    # An opinion's own caption keeps its row; all other labels go before anything is joined or sorted.
    wanted = [ID[n] for n in ("CASE_CAPTION", "BACKGROUND", "SYLLABUS", "DIVIDER", "CASE_METADATA", "HEADNOTE")]
    row = F.struct("page_index", "col", "y1", "det_id", "x1", "x2", "y2")
    after = lambda name: F.min(F.when(F.col("after_caption") & (F.col("label_id") == ID[name]), row))
    noted = F.bool_or(F.col("after_caption") & F.col("label_id").isin(ID["HEADNOTE"], ID["BACKGROUND"]))
    agg = members.where(F.col("label_id").isin(wanted)).groupBy(*OPINION).agg(after("BACKGROUND").alias("zone_start"), after("SYLLABUS").alias("s"), after("DIVIDER").alias("d"), after("CASE_METADATA").alias("m"), noted.alias("noted"))
    is_sct = reporter is not None and reporter.lower().replace("-", "") == "sct"
    end = F.coalesce(*([F.col("s")] if is_sct else []), F.col("d"), F.when(F.col("noted"), F.col("m")))
    return agg.select(*OPINION, "zone_start", end.alias("zone_end"))


def _column_rects(spread: DataFrame, det: DataFrame, pages: DataFrame) -> DataFrame:
    """Each row of ``spread`` (with page_index) for both columns of its page: side, cx0, cx1 and the page's bounds in points."""
    p = layout.with_columns_fallback(pages).select(*PAGE, E.scale_x().alias("sx"), E.scale_y().alias("sy"), "midpoint", "col_left_x1", "col_left_x2", "col_right_x1", "col_right_x2")
    both = F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("side"), (F.col(f"col_{n}_x1") * F.col("sx")).alias("cx0"), (F.col(f"col_{n}_x2") * F.col("sx")).alias("cx1")) for i, n in enumerate(("left", "right"))]))
    return spread.join(p, PAGE).join(layout.margin_bounds(det, pages), PAGE).withColumn("c", both).select(*spread.columns, "midpoint", "sx", "sy", "header_bottom", "footer_top", "c.*")


def zone_rects(opinions: DataFrame, marked: DataFrame, det: DataFrame, pages: DataFrame, use_background: bool = True) -> DataFrame:
    """Rects of opinions with an end marker: doc_id, opinion, page_index, side, x0..y1 in points."""
    o = opinions.join(marked, OPINION).where("zone_end IS NOT NULL")
    background = F.col("zone_start").isNotNull() if use_background else F.lit(False)
    o = o.select(
        *OPINION, background.alias("from_background"), *[F.when(background, F.col(f"zone_start.{f}")).otherwise(F.col(f"caption_{c}")).alias(f"s_{f}") for f, c in (("page_index", "page"), ("x1", "x1"), ("x2", "x2"), ("y1", "y1"), ("y2", "y2"))],
        *[F.col(f"zone_end.{f}").alias(f"e_{f}") for f in ("page_index", "x1", "x2", "y1")],
    )
    for m in ("s", "e"):
        p = pages.select("doc_id", F.col("page_index").alias(f"{m}_page_index"), E.scale_x().alias(f"{m}_sx"), E.scale_y().alias(f"{m}_sy"))
        o = o.join(p, ["doc_id", f"{m}_page_index"])
    spread = o.where("s_page_index <= e_page_index").withColumn("page_index", F.explode(F.sequence("s_page_index", "e_page_index")))
    d = _column_rects(spread, det, pages)
    mid = F.col("midpoint") * F.col("sx")
    side_of = lambda m: F.when((F.col(f"{m}_x1") * F.col(f"{m}_sx") + F.col(f"{m}_x2") * F.col(f"{m}_sx")) / 2 < mid, 0).otherwise(1)
    is_start, is_end = F.col("page_index") == F.col("s_page_index"), F.col("page_index") == F.col("e_page_index")
    start_y = F.when(F.col("from_background"), F.col("s_y1") * F.col("s_sy")).otherwise(F.col("s_y2") * F.col("s_sy"))
    inside = d.where(~(is_start & (F.col("side") < side_of("s"))) & ~(is_end & (F.col("side") > side_of("e"))))
    top = F.when(is_start & (F.col("side") == side_of("s")), start_y).otherwise(F.col("header_bottom"))
    foot = F.when(is_end & (F.col("side") == side_of("e")), F.col("e_y1") * F.col("e_sy")).otherwise(F.col("footer_top"))
    return inside.select(*OPINION, "page_index", "side", F.col("cx0").alias("x0"), F.greatest(top, "header_bottom").alias("y0"), F.col("cx1").alias("x1"), F.least(foot, "footer_top").alias("y1")).where("y0 < y1")


def fallback_rects(opinions: DataFrame, marked: DataFrame, members: DataFrame, det: DataFrame, pages: DataFrame, least: float = 0.75) -> DataFrame:
    """Rects of opinions without an end marker: whole columns from the caption to the last column with a confident headnote.

    On the last page only columns that have headnotes count, on the pages before it all do.
    """
    mids = layout.with_columns_fallback(pages).select(*PAGE, "midpoint")
    hn = members.where(F.col("after_caption") & (F.col("label_id") == ID["HEADNOTE"]) & (F.col("confidence") >= least)).join(mids, PAGE).withColumn("side", E.column_ordinal(F.col("midpoint"))).select(*OPINION, "page_index", "side").distinct()
    last = hn.groupBy(*OPINION).agg(F.max(F.struct("page_index", "side")).alias("m")).select(*OPINION, F.col("m.page_index").alias("last_page"), F.col("m.side").alias("last_side"))
    scale = layout.with_columns_fallback(pages).select("doc_id", F.col("page_index").alias("caption_page"), E.scale_x().alias("c_sx"), E.scale_y().alias("c_sy"), F.col("midpoint").alias("c_mid"))
    o = opinions.join(marked.where("zone_end IS NULL"), OPINION).join(last, OPINION).join(scale, ["doc_id", "caption_page"])
    cap_side = F.when((F.col("caption_x1") * F.col("c_sx") + F.col("caption_x2") * F.col("c_sx")) / 2 < F.col("c_mid") * F.col("c_sx"), 0).otherwise(1)
    o = o.select(*OPINION, "caption_page", "last_page", "last_side", cap_side.alias("cap_side"), (F.col("caption_y2") * F.col("c_sy")).alias("cap_y"))
    d = _column_rects(o.withColumn("page_index", F.explode(F.sequence("caption_page", "last_page"))), det, pages)
    d = d.join(hn.withColumn("has", F.lit(True)), [*OPINION, "page_index", "side"], "left")
    is_start, is_end = F.col("page_index") == F.col("caption_page"), F.col("page_index") == F.col("last_page")
    kept = d.where(~(is_start & (F.col("side") < F.col("cap_side"))) & ~(is_end & ((F.col("side") > F.col("last_side")) | F.col("has").isNull())))
    top = F.when(is_start & (F.col("side") == F.col("cap_side")), F.col("cap_y")).otherwise(F.col("header_bottom"))
    return kept.select(*OPINION, "page_index", "side", F.col("cx0").alias("x0"), F.greatest(top, "header_bottom").alias("y0"), F.col("cx1").alias("x1"), F.col("footer_top").alias("y1")).where("y0 < y1")


def headnote_zones(opinions: DataFrame, det: DataFrame, pages: DataFrame, reporter: str | None = None, use_background: bool = True) -> DataFrame:
    """Zones of all opinions; their marked starts and ends, a row for each opinion, and the zones, a few for each, are staged."""
    m = pairing.members(det, pages, opinions)
    marked = staged(zone_markers(m, reporter), "zone-markers")
    return staged(zone_rects(opinions, marked, det, pages, use_background).unionByName(fallback_rects(opinions, marked, m, det, pages)), "zones")


def _opinions(det: DataFrame, pages: DataFrame, exclusions: DataFrame | None) -> DataFrame:
    return staged(pairing.pair_opinions(det, pages, exclusions), "opinions")


def clip_headnotes(zones: DataFrame, words: DataFrame, det: DataFrame, pages: DataFrame, ocr_applied: bool = False) -> DataFrame:
    """Zones clamped to margin bounds and, unless our own OCR made the words, to their text; those without area go."""
    key = (*OPINION, "page_index", "side")
    z = zones.join(layout.margin_bounds(det, pages), PAGE)
    if ocr_applied:
        fit = {"y0": F.greatest("y0", "header_bottom"), "y1": F.least("y1", "footer_top")}
    else:
        # The text bounds are looked up in the tightened rect.
        z = W.text_bounds_in(W.tighten(z, words, *key), words, *key)
        fit = {"x0": F.greatest("x0", "text_left"), "y0": F.greatest("y0", "header_bottom"), "x1": F.least("x1", "text_right"), "y1": F.least("y1", "footer_top", "text_bottom")}
    return z.withColumns(fit).select(*key, *E.RECT).where("x0 < x1 AND y0 < y1")


def page_number_rects(det: DataFrame, words: DataFrame, pages: DataFrame) -> DataFrame:
    """Page numbers of any confidence, tight where they hold words: never to be redacted."""
    return W.tighten(layout.to_points(det.where(F.col("label_id") == ID["PAGE_NUMBER"]), pages), words, "doc_id", "det_id").select("doc_id", "det_id", "page_index", *E.RECT)


def protect(rects: DataFrame, protected: DataFrame, *key: str) -> DataFrame:
    """``rects`` less the protected rects of their page, as disjoint parts numbered from 1."""
    holes = protected.groupBy(*PAGE).agg(F.sort_array(F.collect_list(F.struct("det_id", *E.RECT))).alias("_holes"))
    none = F.expr("cast(array() AS array<struct<det_id: bigint, x0: double, y0: double, x1: double, y1: double>>)")
    d = rects.join(holes, PAGE, "left").withColumn("_holes", F.coalesce("_holes", none)).withColumn("_rect", F.struct(*E.RECT))
    parts = d.withColumn("_parts", E.subtract_rects("_rect", "_holes"))
    return parts.select(*key, *[c for c in rects.columns if c not in (*key, *E.RECT)], F.posexplode("_parts").alias("part", "_slice")).select(*[c for c in rects.columns if c not in E.RECT], (F.col("part") + 1).cast("long").alias("part"), "_slice.*")


def case_sequence_rects(det: DataFrame, pages: DataFrame, clip_captions: bool = True, least: int = 40, most: int = 60, inset: float = 3.0) -> DataFrame:
    """Case sequence marks of 40 to 60 pixels about their centre, inset, and cut off above captions they overlap."""
    d = layout.with_pages(det.where(F.col("label_id") == ID["CASE_SEQUENCE"]), pages)
    half_w, half_h = (F.greatest(F.lit(float(least)), F.least(F.col(b) - F.col(a), F.lit(float(most)))) / 2 for a, b in (("x1", "x2"), ("y1", "y2")))
    cx, cy = E.center_x(), E.center_y()
    r = d.select("doc_id", "det_id", "page_index", ((cx - half_w) * F.col("sx") + inset).alias("x0"), ((cy - half_h) * F.col("sy") + inset).alias("y0"), ((cx + half_w) * F.col("sx") - inset).alias("x1"), ((cy + half_h) * F.col("sy") - inset).alias("y1"))
    if clip_captions:
        caps = layout.to_points(det.where(F.col("label_id") == ID["CASE_CAPTION"]), pages).groupBy(*PAGE).agg(F.sort_array(F.collect_list(F.struct("det_id", *E.RECT))).alias("caps"))
        cut = F.expr("""aggregate(coalesce(caps, array()), named_struct('x0', x0, 'y0', y0, 'x1', x1, 'y1', y1), (s, c) ->
            CASE WHEN s.x0 < c.x1 AND c.x0 < s.x1 AND s.y0 < c.y1 AND c.y0 < s.y1 THEN
                CASE WHEN s.y0 < c.y0 THEN named_struct('x0', s.x0, 'y0', s.y0, 'x1', s.x1, 'y1', c.y0) ELSE named_struct('x0', 0D, 'y0', 0D, 'x1', 0D, 'y1', 0D) END
            ELSE s END)""")
        r = r.join(caps, PAGE, "left").withColumn("s", cut).select("doc_id", "det_id", "page_index", "s.*")
    return r.where("x0 < x1 AND y0 < y1")


def key_icon_rects(det: DataFrame, pages: DataFrame, exclusions: DataFrame | None = None) -> DataFrame:
    """Key icons that are plausible within their page, then confident, in points: what stamps mark as well."""
    icons = layout.confident(layout.plausible_key_icons(det.where(F.col("label_id") == ID["KEY_ICON"]), *PAGE))
    if exclusions is not None:
        icons = layout.without_excluded(icons, exclusions)
    return layout.to_points(icons, pages).select("doc_id", "det_id", "page_index", *E.RECT)


def stamps(key_rects: DataFrame) -> DataFrame:
    """Where an opinion's end is stamped as invisible text: two points right of the icon's edge, below its middle."""
    return key_rects.select("doc_id", "det_id", "page_index", (F.col("x0") + 2).alias("x"), (F.col("y0") + (F.col("y1") - F.col("y0")) / 2 + 3).alias("y"), F.lit("<--CASEEND-->").alias("stamp"))


def _filled(det: DataFrame, exclusions: DataFrame | None, approvals: DataFrame | None) -> DataFrame:
    """Detections redacted for themselves, with fill: confident or approved ones of the labels that have one."""
    d = layout.with_labels(det).where(F.col("label").isin(list(FILL)))
    if exclusions is not None:
        d = layout.without_excluded(d, exclusions)
    ok = F.col("confidence") >= F.col("min_conf")
    if approvals is not None:
        d = layout.with_approval(d, approvals)
        ok = ok | F.col("approved")
    return d.where(ok).select(*det.columns, "label", F.col("redact_fill").alias("fill"))


def plan_precomputed(det: DataFrame, pages: DataFrame, words: DataFrame, reporter: str | None = None, exclusions: DataFrame | None = None, approvals: DataFrame | None = None) -> DataFrame:
    """All redaction rects in pixels: doc_id, page_index, type, source (opinion or detection), side, x0..y1, fill."""
    opinions = _opinions(det, pages, exclusions)
    zones = headnote_zones(opinions, det, pages, reporter)
    p = layout.with_columns_fallback(pages).select(*PAGE, E.scale_x().alias("sx"), E.scale_y().alias("sy"), "midpoint")
    key = (*OPINION, "page_index", "side")
    raw_left = (F.col("x0") + F.col("x1")) / 2 < F.col("midpoint") * F.col("sx")
    z = zones.join(p, PAGE).withColumn("is_left", raw_left)
    z = W.text_bounds_in(W.tighten(z, words, *key), words, *key).join(layout.margin_bounds(det, pages), PAGE).join(layout.right_column_edge(det, pages), PAGE, "left")
    known = F.col("edge").isNotNull()
    z = z.withColumns({
        "nx0": F.when(known & F.col("is_left"), F.col("text_left")).when(known, F.greatest("text_left", "edge")).otherwise(F.col("x0")),
        "nx1": F.when(known & F.col("is_left"), F.least("text_right", "edge")).when(known, F.col("text_right")).otherwise(F.col("x1")),
        "ny0": F.greatest("y0", "header_bottom"), "ny1": F.least("y1", "footer_top", "text_bottom"),
    })
    px = lambda d, x0="x0", y0="y0", x1="x1", y1="y1": [(F.col(x0) / F.col("sx")).alias("x0"), (F.col(y0) / F.col("sy")).alias("y0"), (F.col(x1) / F.col("sx")).alias("x1"), (F.col(y1) / F.col("sy")).alias("y1")]
    head = z.select(*PAGE, F.lit("headnote").alias("type"), F.col("opinion").alias("source"), "side", *px(z, "nx0", "ny0", "nx1", "ny1"), F.lit("black").alias("fill"))
    filled = _filled(det, exclusions, approvals)
    raw = filled.where(F.col("label").isin("HEADNOTE_BRACKET", "STATE_ABBREVIATION")).select(*PAGE, F.col("label").alias("type"), F.col("det_id").alias("source"), F.lit(0).cast("long").alias("side"), F.col("x1").alias("x0"), F.col("y1").alias("y0"), F.col("x2").alias("x1"), F.col("y2").alias("y1"), "fill")
    tight = W.tighten(layout.to_points(filled.where(~F.col("label").isin("HEADNOTE_BRACKET", "STATE_ABBREVIATION")), pages), words, "doc_id", "det_id").join(p, PAGE)
    tight = tight.select(*PAGE, F.col("label").alias("type"), F.col("det_id").alias("source"), F.lit(0).cast("long").alias("side"), *px(tight), "fill")
    unexcluded = det if exclusions is None else layout.without_excluded(det, exclusions)
    seq = case_sequence_rects(unexcluded.where(F.col("label_id") == ID["CASE_SEQUENCE"]), pages, clip_captions=False).join(p, PAGE)
    seq = seq.select(*PAGE, F.lit("CASE_SEQUENCE").alias("type"), F.col("det_id").alias("source"), F.lit(0).cast("long").alias("side"), *px(seq), F.lit("black").alias("fill"))
    icons = layout.confident(layout.plausible_key_icons(det.where(F.col("label_id") == ID["KEY_ICON"]), *PAGE))
    icons = icons if exclusions is None else layout.without_excluded(icons, exclusions)
    icons = icons.select(*PAGE, F.lit("KEY_ICON").alias("type"), F.col("det_id").alias("source"), F.lit(0).cast("long").alias("side"), F.col("x1").alias("x0"), F.col("y1").alias("y0"), F.col("x2").alias("x1"), F.col("y2").alias("y1"), F.lit("black").alias("fill"))
    return head.unionByName(raw).unionByName(tight).unionByName(seq).unionByName(icons).where("x0 < x1 AND y0 < y1")


def plan_full(det: DataFrame, pages: DataFrame, words: DataFrame, reporter: str | None = None, exclusions: DataFrame | None = None) -> DataFrame:
    """Rects in points for a whole redacted volume, page numbers spared: doc_id, page_index, type, source, side, part, x0..y1, fill."""
    opinions = _opinions(det, pages, exclusions)
    head = clip_headnotes(headnote_zones(opinions, det, pages, reporter), words, det, pages)
    head = head.select(*PAGE, F.lit("headnote").alias("type"), F.col("opinion").alias("source"), "side", *E.RECT, F.lit("black").alias("fill"))
    return protect(head.unionByName(_own_rects(det, pages, words, exclusions, ("HEADNOTE_BRACKET", "STATE_ABBREVIATION"), with_sequence=True)), page_number_rects(det, words, pages), *PAGE)


def _own_rects(det: DataFrame, pages: DataFrame, words: DataFrame, exclusions: DataFrame | None, never_tight: tuple[str, ...], with_sequence: bool) -> DataFrame:
    filled = layout.to_points(_filled(det, exclusions, None), pages)
    tight = W.tighten(filled.where(~F.col("label").isin(list(never_tight))), words, "doc_id", "det_id") if never_tight else W.tighten(filled, words, "doc_id", "det_id")
    columns = lambda d: d.select(*PAGE, F.col("label").alias("type"), F.col("det_id").alias("source"), F.lit(0).cast("long").alias("side"), *E.RECT, "fill")
    out = columns(tight)
    if never_tight:
        out = out.unionByName(columns(filled.where(F.col("label").isin(list(never_tight)))))
    if with_sequence:
        # Captions stay in: a mark is cut by them even where they are excluded.
        both = det if exclusions is None else layout.without_excluded(det.where(F.col("label_id") == ID["CASE_SEQUENCE"]), exclusions).unionByName(det.where(F.col("label_id") == ID["CASE_CAPTION"]))
        out = out.unionByName(case_sequence_rects(both, pages).select(*PAGE, F.lit("CASE_SEQUENCE").alias("type"), F.col("det_id").alias("source"), F.lit(0).cast("long").alias("side"), *E.RECT, F.lit("black").alias("fill")))
    icons = key_icon_rects(det, pages, exclusions).select(*PAGE, F.lit("KEY_ICON").alias("type"), F.col("det_id").alias("source"), F.lit(0).cast("long").alias("side"), *E.RECT, F.lit("black").alias("fill"))
    return out.unionByName(icons)


def plan_split(det: DataFrame, pages: DataFrame, words: DataFrame, reporter: str | None = None, ocr_applied: bool = False, exclusions: DataFrame | None = None) -> DataFrame:
    """Rects in points for each opinion's own file: doc_id, opinion, page_index, type, source, side, part, x0..y1, fill.

    Zones start at the caption, detections outside the opinion count only if they are margin
    labels or key icons (white outside, black inside), and what lies outside is whitened.
    """
    opinions = _opinions(det, pages, exclusions)
    head = clip_headnotes(headnote_zones(opinions, det, pages, reporter, use_background=False), words, det, pages, ocr_applied)
    head = head.select(*OPINION, "page_index", F.lit("headnote").alias("type"), F.col("opinion").alias("source"), "side", *E.RECT, F.lit("black").alias("fill"))
    out = pairing.outside_rects(det, pages, opinions)
    side = F.when(F.col("part").endswith("left"), 0).otherwise(1).cast("long")
    out = out.select(*OPINION, "page_index", F.concat(F.lit("outside-"), F.split("part", "-")[0]).alias("type"), F.col("opinion").alias("source"), side.alias("side"), *E.RECT, F.lit("white").alias("fill"))
    own = _own_rects(det, pages, words, exclusions, (), with_sequence=False)
    within = pairing.members(det, pages, opinions).select(*OPINION, "page_index", F.col("det_id").alias("source")).withColumn("inside", F.lit(True))
    on = pairing.opinion_pages(opinions, pages).select(*OPINION, "page_index")
    marked = on.join(own, PAGE).join(within, [*OPINION, "page_index", "source"], "left").withColumn("inside", F.coalesce("inside", F.lit(False)))
    margin = F.col("type").isin("PAGE_HEADER", "STATE_ABBREVIATION")
    kept = marked.where(F.col("inside") | margin | (F.col("type") == "KEY_ICON")).withColumn("fill", F.when((F.col("type") == "KEY_ICON") & ~F.col("inside"), "white").otherwise(F.col("fill")))
    every = head.unionByName(out).unionByName(kept.select(*OPINION, "page_index", "type", "source", "side", *E.RECT, "fill"))
    return protect(every, page_number_rects(det, words, pages), *OPINION, "page_index")


def footnotes_kept(det: DataFrame, most: float = 0.3) -> DataFrame:
    """Footnotes of a page without those that overlap a kept, more confident one by IoU; the page's boxes are folded in order."""
    boxes = det.where(F.col("label_id") == ID["FOOTNOTES"]).groupBy(*PAGE).agg(F.sort_array(F.collect_list(F.struct((-F.col("confidence")).alias("o"), "det_id", "x1", "y1", "x2", "y2"))).alias("b"))
    kept = F.expr(f"""aggregate(slice(b, 2, size(b)), slice(b, 1, 1), (k, d) -> CASE WHEN exists(k, e ->
        greatest(0D, least(d.x2, e.x2) - greatest(d.x1, e.x1)) * greatest(0D, least(d.y2, e.y2) - greatest(d.y1, e.y1))
          > {most} * ((d.x2 - d.x1) * (d.y2 - d.y1) + (e.x2 - e.x1) * (e.y2 - e.y1) - greatest(0D, least(d.x2, e.x2) - greatest(d.x1, e.x1)) * greatest(0D, least(d.y2, e.y2) - greatest(d.y1, e.y1))))
        THEN k ELSE concat(k, array(d)) END)""")
    return boxes.select(*PAGE, F.explode(kept).alias("f")).select(*PAGE, "f.det_id", "f.x1", "f.y1", "f.x2", "f.y2").withColumn("place", F.row_number().over(Window.partitionBy(*PAGE).orderBy("y1", "det_id")).cast("long"))


def footnote_clips(kept: DataFrame, pages: DataFrame, words: DataFrame, padding: float = 4.0) -> DataFrame:
    """Clips in points, a footnote over both columns giving its left and then its right part, tight to the text; under 2 points: dropped."""
    p = layout.with_columns_fallback(pages).select(*PAGE, E.scale_x().alias("sx"), E.scale_y().alias("sy"), "midpoint")
    d = kept.join(p, PAGE).select("doc_id", "page_index", "det_id", "place", (F.col("x1") * F.col("sx")).alias("a"), (F.col("y1") * F.col("sy")).alias("y0"), (F.col("x2") * F.col("sx")).alias("z"), (F.col("y2") * F.col("sy")).alias("yb"), (F.col("midpoint") * F.col("sx")).alias("mid"))
    part = lambda n, x0, x1: F.struct(F.lit(n).cast("long").alias("part"), x0.alias("x0"), x1.alias("x1"))
    parts = F.when((F.col("a") < F.col("mid")) & (F.col("z") > F.col("mid")), F.array(part(0, F.col("a"), F.col("mid")), part(1, F.col("mid"), F.col("z")))).otherwise(F.array(part(0, F.col("a"), F.col("z"))))
    clips = d.withColumn("p", F.explode(parts)).select("doc_id", "page_index", "det_id", "place", "p.part", "p.x0", "y0", "p.x1", F.col("yb").alias("y1"))
    return W.tighten(clips, words, "doc_id", "det_id", "part", padding=padding).where("x1 - x0 >= 2 AND y1 - y0 >= 2").select("doc_id", "page_index", "det_id", "place", "part", *E.RECT)


def refine_to_lines(rects: DataFrame, boxes: DataFrame, *key: str, scale: float = 200 / 72, reach: float = 10.0, gap: float = 10.0) -> DataFrame:
    """Rects in points cut into the lines of the word boxes (pixels relative to the rect's crop) found in them, at full width.

    A word joins the first line whose first word's centre is less than ``reach`` away, or opens one; lines closer
    than ``gap`` are put together. Folds over the words of one rect.
    boxes: key, box_no, by0, by1. Rects under 10 pixels or without boxes stay as they are, as line 0.
    """
    per = boxes.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("box_no", ((F.col("by0") + F.col("by1")) / 2).alias("c"), F.col("by0").alias("a"), F.col("by1").alias("z")))).alias("_b"))
    px = F.array(*[(F.col(c) * scale).cast("int") for c in E.RECT])
    d = rects.select(*key, *E.RECT).join(per.withColumn("_b", F.expr("transform(_b, w -> struct(w.c, w.a, w.z))")), list(key), "left").withColumn("_px", px)
    lines = F.expr(f"""aggregate(slice(_b, 2, size(_b)), slice(_b, 1, 1), (s, w) ->
        transform(array(array_position(transform(s, l -> abs(l.c - w.c) < {reach}D), true)), k -> CASE WHEN k = 0 THEN concat(s, array(w))
          ELSE concat(slice(s, 1, int(k) - 1), array(struct(s[k - 1].c AS c, least(s[k - 1].a, w.a) AS a, greatest(s[k - 1].z, w.z) AS z)), slice(s, int(k) + 1, size(s))) END)[0])""")
    merged = F.expr(f"""transform(array(array_sort(transform(_lines, l -> struct(l.a, l.z)))), o -> aggregate(slice(o, 2, size(o)), slice(o, 1, 1), (m, l) ->
        CASE WHEN l.a - element_at(m, -1).z < {gap}D THEN concat(slice(m, 1, size(m) - 1), array(struct(element_at(m, -1).a AS a, greatest(element_at(m, -1).z, l.z) AS z)))
          ELSE concat(m, array(l)) END))[0]""")
    cut = F.expr("_b IS NOT NULL AND _px[2] - _px[0] >= 10 AND _px[3] - _px[1] >= 10")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("line"), *[F.col(c).cast("double").alias(c) for c in E.RECT]))
    parts = F.transform("_merged", lambda l, i: F.struct(i.cast("long").alias("line"), (F.get("_px", F.lit(0)) / scale).alias("x0"), ((F.get("_px", F.lit(1)) + l["a"]) / scale).alias("y0"), (F.get("_px", F.lit(2)) / scale).alias("x1"), ((F.get("_px", F.lit(1)) + l["z"]) / scale).alias("y1")))
    d = d.withColumn("_lines", F.when(cut, lines)).withColumn("_merged", merged)
    d = d.select(*key, F.explode(F.when(cut, F.filter(parts, lambda p: p["y0"] < p["y1"])).otherwise(whole)).alias("_part"))
    return d.select(*key, "_part.*")
