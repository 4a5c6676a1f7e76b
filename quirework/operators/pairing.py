"""Start and end markers paired into opinions, and what belongs to each.

An opinion begins at the first caption after the previous key icon and ends at the next key
icon, in reading order over the whole volume. Counting the key icons before each marker cuts
the volume into groups that hold at most one key icon, so pairing needs no state: a group
with a caption and a key icon is an opinion. One volume's markers are one window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions import expressions as E
from quirework.functions.labels import ID
from quirework.operators import layout
from quirework.operators.layout import PAGE


def markers(det: DataFrame, pages: DataFrame, exclusions: DataFrame | None = None) -> DataFrame:
    """Confident captions (kind 0) and plausible key icons (kind 1) with their document-wide reading key."""
    both = layout.confident(det.where(F.col("label_id").isin(ID["CASE_CAPTION"], ID["KEY_ICON"])))
    if exclusions is not None:
        both = layout.without_excluded(both, exclusions)
    icons = layout.plausible_key_icons(both.where(F.col("label_id") == ID["KEY_ICON"]), "doc_id")
    kept = both.where(F.col("label_id") == ID["CASE_CAPTION"]).unionByName(icons)
    keyed = layout.with_document_key(kept, pages)
    return keyed.withColumn("kind", F.when(F.col("label_id") == ID["KEY_ICON"], 1).otherwise(0))


def pair_opinions(det: DataFrame, pages: DataFrame, exclusions: DataFrame | None = None) -> DataFrame:
    """doc_id, opinion (from 0 in reading order) and caption_* and key_* columns: id, page, col, y1 and box."""
    order = Window.partitionBy("doc_id").orderBy("page_index", "col", "y1", "kind", "det_id")
    row = F.struct("page_index", "col", "y1", "kind", "det_id", "x1", "x2", "y2")
    m = markers(det, pages, exclusions).select("doc_id", "kind", row.alias("m"), F.coalesce(F.sum("kind").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("grp"))
    p = m.groupBy("doc_id", "grp").agg(F.min(F.when(F.col("kind") == 0, F.col("m"))).alias("c"), F.min(F.when(F.col("kind") == 1, F.col("m"))).alias("k")).where("c IS NOT NULL AND k IS NOT NULL")
    columns = [F.col(f"{s}.{f}").alias(f"{n}_{t}") for s, n in (("c", "caption"), ("k", "key")) for f, t in (("det_id", "id"), ("page_index", "page"), ("col", "col"), ("x1", "x1"), ("y1", "y1"), ("x2", "x2"), ("y2", "y2"))]
    return p.select("doc_id", (F.row_number().over(Window.partitionBy("doc_id").orderBy("grp")) - 1).cast("long").alias("opinion"), *columns)


def opinion_pages(opinions: DataFrame, pages: DataFrame) -> DataFrame:
    """A row for each opinion and each page it touches that is in ``pages``."""
    spread = opinions.withColumn("page_index", F.explode(F.sequence("caption_page", "key_page")))
    return spread.withColumns({"is_first": F.col("page_index") == F.col("caption_page"), "is_last": F.col("page_index") == F.col("key_page")}).join(pages.select(*PAGE), PAGE)


def members(det: DataFrame, pages: DataFrame, opinions: DataFrame) -> DataFrame:
    """Detections between an opinion's caption and key in reading order, both included.

    The range join is an equality on volume and page: each opinion is spread over its pages.
    """
    d = layout.with_document_key(det, pages)
    o = opinions.select("doc_id", "opinion", F.struct(F.col("caption_page").alias("page_index"), F.col("caption_col").alias("col"), F.col("caption_y1").alias("y1")).alias("from_sk"),
                        F.struct(F.col("key_page").alias("page_index"), F.col("key_col").alias("col"), F.col("key_y1").alias("y1")).alias("to_sk"), F.explode(F.sequence("caption_page", "key_page")).alias("page_index"))
    return d.join(o, PAGE).where((F.col("sk") >= F.col("from_sk")) & (F.col("sk") <= F.col("to_sk"))).withColumn("after_caption", F.col("sk") > F.col("from_sk")).drop("to_sk")


def with_page_numbers(opinions: DataFrame, pages: DataFrame, first_page: int = 1) -> DataFrame:
    """Adds first_number and last_number: an opinion that starts on a page of two numbers takes the second, one that ends there the first; 0 and null fall back on the page's place."""
    p = pages.select("doc_id", "page_index", F.expr("nullif(page_number, 0)").alias("number"), F.expr("nullif(page_number_end, 0)").alias("number_end"), F.col("page_number").alias("raw"))
    a = p.select("doc_id", F.col("page_index").alias("caption_page"), F.coalesce("number_end", "number").alias("first"))
    z = p.select("doc_id", F.col("page_index").alias("key_page"), F.when(F.col("number_end").isNotNull() & F.col("raw").isNotNull(), F.col("raw")).otherwise(F.col("number")).alias("last"))
    return opinions.join(a, ["doc_id", "caption_page"], "left").join(z, ["doc_id", "key_page"], "left").select(
        *opinions.columns, F.coalesce("first", F.col("caption_page") + first_page).alias("first_number"), F.coalesce("last", F.col("key_page") + first_page).alias("last_number"))


def with_file_names(opinions: DataFrame, prefix: str = "vol") -> DataFrame:
    """Adds file_name; opinions of equal page numbers get -1, -2 and so on in reading order."""
    base = F.format_string(f"{prefix}.%d.%04d-%04d", "doc_id", "first_number", "last_number")
    same = Window.partitionBy("doc_id", "base")
    d = opinions.withColumn("base", base)
    n, seq = F.count("*").over(same), F.row_number().over(same.orderBy("opinion"))
    return d.withColumn("file_name", F.concat("base", F.when(n > 1, F.concat(F.lit("-"), seq.cast("string"))).otherwise(F.lit("")), F.lit(".pdf"))).drop("base")


def with_images(opinions: DataFrame, det: DataFrame) -> DataFrame:
    """Adds has_image: whether an image stands on any of the opinion's pages."""
    pages = det.where(F.col("label_id") == ID["IMAGE"]).select(*PAGE).distinct()
    hit = opinions.select("doc_id", "opinion", F.explode(F.sequence("caption_page", "key_page")).alias("page_index")).join(pages, PAGE, "left_semi").select("doc_id", "opinion").distinct().withColumn("has_image", F.lit(True))
    return opinions.join(hit, ["doc_id", "opinion"], "left").withColumn("has_image", F.coalesce("has_image", F.lit(False)))


def outside_rects(det: DataFrame, pages: DataFrame, opinions: DataFrame) -> DataFrame:
    """On an opinion's first and last page the parts of the columns before its caption and after its key, in points.

    Pages with fewer than two text columns have none; an opinion never masks across the column boundary.
    """
    scale = pages.select(*PAGE, E.scale_x().alias("sx"), E.scale_y().alias("sy"))
    d = opinion_pages(opinions, pages).where("is_first OR is_last").join(layout.margin_bounds(det, pages), PAGE).join(layout.column_bounds(det, pages), PAGE).join(scale, PAGE)
    cap_left = (F.col("caption_x1") * F.col("sx") + F.col("caption_x2") * F.col("sx")) / 2 < F.col("boundary")
    key_left = (F.col("key_x1") * F.col("sx") + F.col("key_x2") * F.col("sx")) / 2 < F.col("boundary")
    cap_y, key_y = F.col("caption_y1") * F.col("sy"), F.col("key_y2") * F.col("sy")
    rect = lambda when, side, y0, y1, part: F.when(when, F.struct(F.col(f"{side}_x0").alias("x0"), y0.alias("y0"), F.col(f"{side}_x1").alias("x1"), y1.alias("y1"), F.lit(part).alias("part")))
    top, foot = F.col("header_bottom"), F.col("footer_top")
    rects = F.array(
        rect(F.col("is_first"), "left", top, F.when(cap_left, cap_y).otherwise(foot), "before-left"),
        rect(F.col("is_first") & ~cap_left, "right", top, cap_y, "before-right"),
        rect(F.col("is_last") & key_left, "left", key_y, foot, "after-left"),
        rect(F.col("is_last"), "right", F.when(key_left, top).otherwise(key_y), foot, "after-right"),
    )
    return d.select("doc_id", "opinion", "page_index", F.explode(F.array_compact(rects)).alias("r")).select("doc_id", "opinion", "page_index", "r.*").where("x0 < x1 AND y0 < y1")
