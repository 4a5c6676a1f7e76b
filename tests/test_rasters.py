"""Page bitmaps: bits, rects at and beyond the edges, pages without pixels."""

import zlib

import numpy as np

from quirework.operators import rasters


def bitmaps(spark, *images):
    rows = [(1, i, 10, 4, None if p is None else bytearray(p.tobytes())) for i, p in enumerate(images)]
    return spark.createDataFrame(rows, "doc_id long, page_index long, width long, height long, pixels binary")


def test_bitonal(spark):
    gray = np.arange(40, dtype=np.uint8).reshape(4, 10) * 6
    got = {r.page_index: r.bits for r in rasters.to_bitonal(bitmaps(spark, gray, None)).collect()}
    assert bytes(got[0]) == np.packbits(gray > 160, axis=1).tobytes() and got[1] is None
    assert rasters.to_bitonal(bitmaps(spark, gray).limit(0)).count() == 0


def test_burnt_rects(spark):
    white, black = np.full((4, 10), 255, np.uint8), np.zeros((4, 10), np.uint8)
    pages = spark.createDataFrame([(1, i, 100.0, 40.0) for i in range(3)], "doc_id long, page_index long, pdf_width double, pdf_height double")
    rects = [(1, 0, 0, 15.0, 9.0, 42.0, 21.0, "black"), (1, 0, 1, 30.0, 0.0, 35.0, 15.0, "white"), (1, 1, 0, -50.0, -9.0, 500.0, 5.0, "white"), (1, 1, 1, 50.0, 20.0, 40.0, 30.0, "white"), (1, 9, 0, 0.0, 0.0, 1.0, 1.0, "black")]
    d = spark.createDataFrame(rects, "doc_id long, page_index long, place long, x0 double, y0 double, x1 double, y1 double, fill string")
    got = {r.page_index: np.unpackbits(np.frombuffer(zlib.decompress(bytes(r.stream)), np.uint8).reshape(4, -1), axis=1)[:, :10] for r in rasters.burn_rects(bitmaps(spark, white, black, white), d, pages).collect()}
    first = np.ones((4, 10), np.uint8)
    first[0:3, 1:5] = 0
    first[0:2, 3:4] = 1
    second = np.zeros((4, 10), np.uint8)
    second[0:1] = 1
    assert sorted(got) == [0, 1] and (got[0] == first).all() and (got[1] == second).all()
