"""Steps on page bitmaps: effective resolution, black and white, and rects burnt into the pixels.

A bitmap is a row: doc_id, page_index, width, height and pixels (gray bytes, row by row). Packed
bits are rows of whole bytes, the first pixel in the highest bit, 1 for white.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.operators.layout import PAGE

#: Gray above this is white when a page is made bitonal, and when one is packed again after redaction.
BITONAL_ABOVE, REPACKED_ABOVE = 160, 128
#: Outputs beyond this many MB have their images compressed anew, unless they are bitonal.
RECOMPRESS_MB = 50


def effective_dpi(img_width: Column, pdf_width: Column) -> Column:
    """Pixels per inch of a page's image; a point is a 72nd of an inch."""
    return img_width / (pdf_width / 72.0)


def bitonal_volumes(images: DataFrame) -> DataFrame:
    """doc_id and bitonal of every volume with images (doc_id, page_index, image_no, bits): the first image of its first page has one bit."""
    first = images.where("page_index = 0").groupBy("doc_id").agg(F.min_by("bits", "image_no").alias("bits"))
    return images.select("doc_id").distinct().join(first, "doc_id", "left").select("doc_id", F.coalesce(F.col("bits") == 1, F.lit(False)).alias("bitonal"))


def to_recompress(size_mb: Column, bitonal: Column) -> Column:
    return (size_mb > RECOMPRESS_MB) & ~bitonal


def _mapped(bitmaps: DataFrame, change: Callable[[np.ndarray, object], bytes], extra: tuple[str, ...], result: str) -> DataFrame:
    source = bitmaps.select(*PAGE, "width", "height", "pixels", *extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 16):
                b = whole.slice(at, 16)
                more = b.column(5).to_pylist() if extra else [None] * b.num_rows
                made = [None if p is None else change(np.frombuffer(p, np.uint8).reshape(h, w), x) for w, h, p, x in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)), more)]
                yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(made, pa.binary())], [*PAGE, "width", "height", result])

    return source.mapInArrow(run, f"doc_id long, page_index long, width long, height long, {result} binary")


def to_bitonal(bitmaps: DataFrame, above: int = BITONAL_ABOVE) -> DataFrame:
    """doc_id, page_index, width, height and bits (packed) of every bitmap."""
    return _mapped(bitmaps, lambda gray, _: np.packbits(gray > above, axis=1).tobytes(), (), "bits")


def burn_rects(bitmaps: DataFrame, rects: DataFrame, pages: DataFrame) -> DataFrame:
    """Rects in points (doc_id, page_index, place, x0..y1, fill) drawn over the pixels in order of place: doc_id, page_index, width, height, stream.

    Corners are cut to whole pixels and both are covered; a rect outside the page, or turned
    inside out, covers nothing. The stream holds packed bits, compressed. Only pages with rects are returned.
    """
    size = pages.select(*PAGE, "pdf_width", "pdf_height")
    edge = lambda c, full, px: (F.col(c) * (F.col(px) / F.col(full))).cast("long").alias(c)
    shade = F.when(F.col("fill") == "black", F.lit(0)).otherwise(F.lit(255)).cast("long").alias("shade")
    placed = rects.join(bitmaps.select(*PAGE, "width", "height"), PAGE).join(size, PAGE)
    pixels = placed.select(*PAGE, F.struct("place", edge("x0", "pdf_width", "width"), edge("y0", "pdf_height", "height"), edge("x1", "pdf_width", "width"), edge("y1", "pdf_height", "height"), shade).alias("r"))
    own = pixels.groupBy(*PAGE).agg(F.sort_array(F.collect_list("r")).alias("rects"))  # the few rects of a page

    def burnt(gray: np.ndarray, todo) -> bytes:
        out = gray.copy()
        for r in todo:
            out[max(r["y0"], 0) : max(r["y1"] + 1, 0), max(r["x0"], 0) : max(r["x1"] + 1, 0)] = r["shade"]
        return zlib.compress(np.packbits(out > REPACKED_ABOVE, axis=1).tobytes())

    return _mapped(bitmaps.join(own, PAGE), burnt, ("rects",), "stream")


def rotation_plan(pages: DataFrame) -> DataFrame:
    """How each page of volumes with a rotated page goes into their upright copy: doc_id, page_index, dpi, jpg_quality.

    Rotated pages (rotation other than 0) are drawn at 300 dpi as JPEG of quality 85 on a page of their size, the others are
    copied as they are (both null). Volumes without such a page stay as they are and have no rows; a null rotation counts as 0.
    """
    turned = F.coalesce(F.col("rotation"), F.lit(0)) != 0
    volumes = pages.where(turned).select("doc_id").distinct()
    whole = lambda n: F.when(turned, F.lit(n).cast("long"))
    return pages.join(volumes, "doc_id", "left_semi").select("doc_id", "page_index", whole(300).alias("dpi"), whole(85).alias("jpg_quality"))
