"""Words and text blocks of pages: spatial joins, tight boxes, text bounds and margins.

Words: doc_id, page_index, word_no, x0, y0, x1, y1, word in points. Rect tables hold a page,
x0..y1 and key columns of their own. Spatial joins are equalities on volume and page with the
overlap as a residual condition, so their work is bounded by the words of a page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.functions.expressions import RECT
from quirework.operators.layout import PAGE


def words_in_rects(rects: DataFrame, words: DataFrame, how: str = "inner") -> DataFrame:
    """Each rect's columns with the words whose box strictly overlaps it (wx0..wy1, word, word_no)."""
    w = words.select(*[F.col(c).alias(f"_{c}") for c in PAGE], *[F.col(c).alias(f"w{c}") for c in RECT], "word", "word_no")
    on = (F.col("doc_id") == F.col("_doc_id")) & (F.col("page_index") == F.col("_page_index"))
    touch = (F.col("wx0") < F.col("x1")) & (F.col("wx1") > F.col("x0")) & (F.col("wy0") < F.col("y1")) & (F.col("wy1") > F.col("y0"))
    return rects.join(w, on & touch, how).drop("_doc_id", "_page_index")


def text_extent(rects: DataFrame, words: DataFrame, *key: str) -> DataFrame:
    """key and tx0, ty0, tx1, ty1: the extent of the words in each rect; rects without words have no row."""
    found = words_in_rects(rects.select(*dict.fromkeys((*key, *PAGE)), *RECT), words)
    return found.groupBy(*key).agg(F.min("wx0").alias("tx0"), F.min("wy0").alias("ty0"), F.max("wx1").alias("tx1"), F.max("wy1").alias("ty1"))


def _with_extent(rects: DataFrame, words: DataFrame, *key: str) -> DataFrame:
    """Rects with the extent of their words (null without any) by one join and one aggregation on the key."""
    rest = [F.any_value(c).alias(c) for c in rects.columns if c not in key]
    found = words_in_rects(rects, words, "left").groupBy(*key)
    return found.agg(*rest, F.min("wx0").alias("tx0"), F.min("wy0").alias("ty0"), F.max("wx1").alias("tx1"), F.max("wy1").alias("ty1"))


def tighten(rects: DataFrame, words: DataFrame, *key: str, padding: float = 2.0) -> DataFrame:
    """Rects shrunk to their words with padding; a rect without words stays, and tight tells which. ``key`` is unique."""
    r = _with_extent(rects, words, *key)
    fit = {c: F.coalesce(F.col(f"t{c}") + (padding if c.endswith("1") else -padding), F.col(c)) for c in RECT}
    return r.withColumn("tight", F.col("tx0").isNotNull()).withColumns(fit).drop("tx0", "ty0", "tx1", "ty1")


def text_bounds_in(rects: DataFrame, words: DataFrame, *key: str, padding: float = 2.0) -> DataFrame:
    """Adds text_bottom (the rect's top where no words are) and padded text_left and text_right (its sides)."""
    r = _with_extent(rects, words, *key)
    return r.withColumns({"text_bottom": F.coalesce("ty1", "y0"), "text_left": F.coalesce(F.col("tx0") - padding, F.col("x0")), "text_right": F.coalesce(F.col("tx1") + padding, F.col("x1"))}).drop("tx0", "ty0", "tx1", "ty1")


def needs_ocr(docs: DataFrame, words: DataFrame, sample_pages: int = 3, least: int = 10) -> DataFrame:
    """doc_id and needs_ocr: fewer than ``least`` words on the first pages; volumes without words need it."""
    n = words.where(F.col("page_index") < sample_pages).groupBy("doc_id").agg(F.count("*").alias("n"))
    return docs.select("doc_id").distinct().join(n, "doc_id", "left").select("doc_id", (F.coalesce("n", F.lit(0)) < least).alias("needs_ocr"))


def page_text_bounds(blocks: DataFrame, page_width: float = 612.0, share: float = 0.40) -> DataFrame:
    """Bounds of a page's text, extended upwards and downwards by images over the text column.

    Pages whose text is narrower than ``share`` of the page, or that have none, have no row.
    """
    has_text = (F.col("block_type") == 0) & (F.trim(F.regexp_replace("text", r"\s", " ")) != "")
    text = blocks.where(has_text).groupBy(*PAGE).agg(F.min("x0").alias("left"), F.min("y0").alias("top"), F.max("x1").alias("right"), F.max("y1").alias("bottom")).where(F.col("right") - F.col("left") >= page_width * share)
    image = blocks.where("block_type = 1").select(*PAGE, *RECT)
    over = (F.col("x1") > F.col("left")) & (F.col("x0") < F.col("right"))
    return text.join(image, PAGE, "left").groupBy(*PAGE, "left", "right").agg(F.least(F.first("top"), F.min(F.when(over, F.col("y0")))).alias("top"), F.greatest(F.first("bottom"), F.max(F.when(over, F.col("y1")))).alias("bottom")).select(*PAGE, "left", "top", "right", "bottom")


def margin_rects(bounds: DataFrame, page_width: float = 612.0, page_height: float = 792.0, buffer: float = 5.0) -> DataFrame:
    """The strips of a page beyond its text bounds and a buffer, each only if over a point wide."""
    left, top = F.greatest(F.lit(0.0), F.col("left") - buffer), F.greatest(F.lit(0.0), F.col("top") - buffer)
    right, bottom = F.least(F.lit(page_width), F.col("right") + buffer), F.least(F.lit(page_height), F.col("bottom") + buffer)
    zero, w, h = F.lit(0.0), F.lit(page_width), F.lit(page_height)
    strip = lambda when, side, x0, y0, x1, y1: F.when(when, F.struct(F.lit(side).alias("side"), x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1")))
    strips = F.array(strip(left > 1, "left", zero, zero, left, h), strip(w - right > 1, "right", right, zero, w, h), strip(top > 1, "top", left, zero, right, top), strip(h - bottom > 1, "bottom", left, bottom, right, h))
    return bounds.select(*PAGE, F.explode(F.array_compact(strips)).alias("s")).select(*PAGE, "s.*")


def structural_issues(page_facts: DataFrame) -> DataFrame:
    """Blank pages, and pages turned otherwise than the first. page_facts: doc_id, page_index, has_text, has_image, width, height."""
    first = page_facts.groupBy("doc_id").agg(F.min_by(F.col("width") > F.col("height"), "page_index").alias("first_wide"))
    number, wide = F.col("page_index") + 1, F.col("width") > F.col("height")
    issue = lambda when, name, severity, text: F.when(when, F.struct(number.alias("page_number"), F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), text.alias("message")))
    found = F.array(
        issue(~F.col("has_text") & ~F.col("has_image"), "blank_page", "error", F.concat(F.lit("Page "), number, F.lit(" appears blank (no text or images)."))),
        issue(wide != F.col("first_wide"), "orientation", "info", F.concat(F.lit("Page "), number, F.lit(" is "), F.when(wide, "landscape").otherwise("portrait"), F.lit(", differs from page 1."))),
    )
    return page_facts.join(first, "doc_id").select("doc_id", F.explode(F.array_compact(found)).alias("i")).select("doc_id", "i.*")
