"""What goes where in the output files of a volume."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.functions import expressions as E
from quirework.operators import layout
from quirework.operators.layout import PAGE


def stored_rects_in_points(rects: DataFrame, pages: DataFrame) -> DataFrame:
    """Stored rects (pixels, with fill and type) in points; pages of unknown image size and rects without area are dropped."""
    p = layout.with_columns_fallback(pages).where("img_width > 1").select(*PAGE, E.scale_x().alias("sx"), E.scale_y().alias("sy"))
    d = rects.join(p, PAGE)
    scaled = {"x0": F.col("x0") * F.col("sx"), "y0": F.col("y0") * F.col("sy"), "x1": F.col("x1") * F.col("sx"), "y1": F.col("y1") * F.col("sy")}
    return d.withColumns(scaled).select(*rects.columns).where("x0 < x1 AND y0 < y1")


def generate_plan(opinions: DataFrame, outside: DataFrame, page_rects: DataFrame, unredacted: bool = True, drop: float = 3.0) -> DataFrame:
    """Every rect of every output: mode, doc_id, opinion, page_index, type, x0..y1, fill.

    The full file takes all page rects (margins white) and has no opinion; an opinion's
    redacted file takes those of its pages and whitens what lies outside it, from ``drop``
    points below that part's top; its unredacted file whitens only what lies outside.
    """
    columns = ["mode", "doc_id", "opinion", "page_index", "type", *E.RECT, "fill"]
    page = page_rects.withColumn("fill", F.when(F.col("type") == "margin", "white").otherwise(F.col("fill"))).where("x0 < x1 AND y0 < y1")
    full = page.withColumns({"mode": F.lit("full"), "opinion": F.lit(None).cast("long")}).select(*columns)
    on = opinions.select("doc_id", "opinion", F.explode(F.sequence("caption_page", "key_page")).alias("page_index"))
    redacted = on.join(page, PAGE).withColumn("mode", F.lit("redacted")).select(*columns)
    white = outside.select("doc_id", "opinion", "page_index", F.lit("outside").alias("type"), *E.RECT, F.lit("white").alias("fill"))
    below = white.withColumns({"mode": F.lit("redacted"), "y0": F.col("y0") + drop}).where("y0 < y1").select(*columns)
    out = full.unionByName(redacted).unionByName(below)
    return out.unionByName(white.withColumn("mode", F.lit("unredacted")).select(*columns)) if unredacted else out


def scan_names(pages: DataFrame, prefix: str = "vol", first_page: int = 1) -> DataFrame:
    """A volume's name from the numbers of its first and last page, or their places where these show none."""
    first, last = F.min_by(F.struct("page_number"), "page_index"), F.max_by(F.struct("page_number", "page_number_end"), "page_index")
    d = pages.groupBy("doc_id").agg(first.alias("a"), last.alias("z"), F.count("*").alias("n"))
    a = F.coalesce(F.expr("nullif(a.page_number, 0)"), F.lit(first_page))
    z = F.when(F.expr("nullif(z.page_number, 0)").isNotNull(), F.coalesce(F.expr("nullif(z.page_number_end, 0)"), F.col("z.page_number"))).otherwise(first_page + F.col("n") - 1)
    return d.select("doc_id", F.concat_ws(".", F.lit(prefix), F.col("doc_id").cast("string"), a.cast("string"), z.cast("string"), F.lit("redacted.pdf")).alias("file_name"))
