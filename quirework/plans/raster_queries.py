"""Queries on page images: small bitmaps with a pattern for each page, as the test tables hold no scans."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.operators import rasters as R
from quirework.plans.common import query

WIDTH, HEIGHT = 21, 28


def bitmaps(v) -> DataFrame:
    """Every page as WIDTH x HEIGHT pixels."""
    y, x = np.mgrid[0:HEIGHT, 0:WIDTH]

    def run(batches):
        for b in batches:
            pixels = [((x * 7 + y * 13 + x * y + p * 29 + d * 3) % 256).astype(np.uint8).tobytes() for d, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([WIDTH] * b.num_rows), pa.array([HEIGHT] * b.num_rows), pa.array(pixels, pa.binary())], ["doc_id", "page_index", "width", "height", "pixels"])

    return v.pages.select("doc_id", "page_index").mapInArrow(run, "doc_id long, page_index long, width long, height long, pixels binary")


def unpacked(d: DataFrame, column: str, compressed: bool = False) -> DataFrame:
    """doc_id, page_index and rows: the bits of each row of pixels as text, line by line."""

    def run(batches):
        for b in batches:
            texts = []
            for w, h, data in zip(*(b.column(i).to_pylist() for i in (2, 3, 4))):
                bits = np.unpackbits(np.frombuffer(zlib.decompress(data) if compressed else data, np.uint8).reshape(h, -1), axis=1)[:, :w]
                texts.append("/".join("".join(map(str, r)) for r in bits.tolist()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts)], ["doc_id", "page_index", "rows"])

    return d.select("doc_id", "page_index", "width", "height", column).mapInArrow(run, "doc_id long, page_index long, rows string")


_GRAY = f"""SELECT doc_id, page_index, y, x, (x * 7 + y * 13 + x * y + page_index * 29 + doc_id * 3) % 256 AS g FROM (SELECT doc_id, page_index FROM pg) p, generate_series(0, {HEIGHT - 1}) a(y), generate_series(0, {WIDTH - 1}) b(x)"""
_LINES = "SELECT doc_id, page_index, string_agg(line, '/' ORDER BY y) AS rows FROM (SELECT doc_id, page_index, y, string_agg(CASE WHEN {white} THEN '1' ELSE '0' END, '' ORDER BY x) AS line FROM ({gray}) g GROUP BY ALL) l GROUP BY ALL"


@query("snk16_bitonal_pages", _LINES.format(white="g > 160", gray=_GRAY))
def _(v):
    return unpacked(R.to_bitonal(bitmaps(v)), "bits")


#: Dividers and header boxes, black and white by turns, drawn in the order of their numbers.
_BURNT = f"""SELECT g.doc_id, g.page_index, y, x, coalesce(arg_max(CASE WHEN r.det_id % 2 = 0 THEN 0 ELSE 255 END, r.det_id), any_value(g)) AS g FROM ({_GRAY}) g JOIN (SELECT DISTINCT doc_id, page_index FROM pts WHERE label_id IN (1, 2)) k ON k.doc_id = g.doc_id AND k.page_index = g.page_index
    LEFT JOIN (SELECT doc_id, page_index, det_id, CAST(trunc(x0 * ({WIDTH} / 612.0::DOUBLE)) AS BIGINT) AS a, CAST(trunc(x1 * ({WIDTH} / 612.0::DOUBLE)) AS BIGINT) AS b, CAST(trunc(y0 * ({HEIGHT} / 792.0::DOUBLE)) AS BIGINT) AS c, CAST(trunc(y1 * ({HEIGHT} / 792.0::DOUBLE)) AS BIGINT) AS d FROM pts WHERE label_id IN (1, 2)) r
      ON r.doc_id = g.doc_id AND r.page_index = g.page_index AND x BETWEEN a AND b AND y BETWEEN c AND d GROUP BY ALL"""


@query("snk22_burnt_pages", _LINES.format(white="g > 128", gray=_BURNT))
def _(v):
    from quirework.operators import layout

    rects = layout.to_points(v.detections.where("label_id IN (1, 2)"), v.pages)
    rects = rects.select("doc_id", "page_index", F.col("det_id").alias("place"), "x0", "y0", "x1", "y1", F.when(F.col("det_id") % 2 == 0, "black").otherwise("white").alias("fill"))
    return unpacked(R.burn_rects(bitmaps(v), rects, v.pages), "stream", compressed=True)


@query("src10_effective_dpi", "SELECT doc_id, page_index, img_width / (pdf_width / 72.0::DOUBLE) AS dpi FROM pg")
def _(v):
    return v.pages.select("doc_id", "page_index", R.effective_dpi(F.col("img_width"), F.col("pdf_width")).alias("dpi"))


_IMAGES = "SELECT doc_id, page_index, block_no AS image_no, CASE WHEN (doc_id + block_no) % 3 = 0 THEN 1 ELSE 8 END AS bits FROM {bl}"


@query("src11_bitonal_volumes", f"SELECT doc_id, coalesce(any_value(bits), 0) = 1 AS bitonal FROM (SELECT DISTINCT doc_id FROM bl) d LEFT JOIN (SELECT doc_id, arg_min(bits, image_no) AS bits FROM ({_IMAGES.replace('{bl}', 'bl')}) i WHERE page_index = 0 GROUP BY doc_id) f USING (doc_id) GROUP BY doc_id")
def _(v):
    return R.bitonal_volumes(v.spark.sql(_IMAGES, bl=v.blocks))


@query("snk21_to_recompress", f"SELECT doc_id, n * 3 AS mb, n * 3 > 50 AND NOT bitonal AS recompress FROM (SELECT doc_id, count(*) AS n FROM bl GROUP BY doc_id) c JOIN (SELECT doc_id, coalesce(any_value(bits), 0) = 1 AS bitonal FROM (SELECT DISTINCT doc_id FROM bl) d LEFT JOIN (SELECT doc_id, arg_min(bits, image_no) AS bits FROM ({_IMAGES.replace('{bl}', 'bl')}) i WHERE page_index = 0 GROUP BY doc_id) f USING (doc_id) GROUP BY doc_id) b USING (doc_id)")
def _(v):
    size = v.blocks.groupBy("doc_id").agg((F.count("*") * 3).alias("mb"))
    d = size.join(R.bitonal_volumes(v.spark.sql(_IMAGES, bl=v.blocks)), "doc_id")
    return d.select("doc_id", "mb", R.to_recompress(F.col("mb"), F.col("bitonal")).alias("recompress"))


_ROTATION = "CASE WHEN doc_id % 3 = 1 AND page_index % 5 = 2 THEN 90 WHEN doc_id % 6 = 5 THEN NULL ELSE 0 END"


@query("snk20_rotated_pages", f"""SELECT doc_id, page_index, CASE WHEN rotation = 90 THEN 300 END::BIGINT AS dpi, CASE WHEN rotation = 90 THEN 85 END::BIGINT AS jpg_quality
    FROM (SELECT doc_id, page_index, {_ROTATION} AS rotation, max({_ROTATION}) OVER (PARTITION BY doc_id) AS most FROM pg) p WHERE most = 90""")
def _(v):
    return R.rotation_plan(v.pages.withColumn("rotation", F.expr(_ROTATION)))
