"""JSON side files of a volume, read by fixed schemas and exploded at once, and written back.

Missing fields take the defaults of the format: image size 1 x 1, box (0, 0, 1, 1), page
612 x 792 points, images of unknown size 1700 x 2200 pixels, no column bounds.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.functions.labels import NAMES, label_dimension
from quirework.operators.layout import PAGE

DETECTION_FIELDS = "page_index long, label string, label_id long, confidence double, bbox array<double>, page_number long, page_number_end long, img_width long, img_height long"
PAGE_FIELDS = "map<string, struct<pdf_width: double, pdf_height: double, col_left_x1: double, col_left_x2: double, col_right_x1: double, col_right_x2: double, midpoint: double>>"
RECT_FIELDS = "page_index long, rects array<struct<x0: double, y0: double, x1: double, y1: double, fill: string, type: string>>"
OPINION_FIELDS = "caption_page long, caption_label string, caption_bbox array<double>, key_page long, key_label string, key_bbox array<double>, page_count long, outside_rects array<struct<page_index: long, x0: double, y0: double, x1: double, y1: double>>, has_image boolean, first_page_number long, last_page_number long, filename string, end_page long"


def _doc_of(path: Column) -> Column:
    """A volume's id is the number its folder ends with."""
    return F.regexp_extract(path, r"([0-9]+)/[^/]*$", 1).cast("long")


@contextmanager
def _listed_together(spark: SparkSession):
    """Folders are listed by a few tasks for each core, many folders in each: else Spark runs a task for each of up to 10,000 folders."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    was = spark.conf.get(key)
    spark.conf.set(key, str(min(int(was), 4 * max(4, spark.sparkContext.defaultParallelism))))
    try:
        yield
    finally:
        spark.conf.set(key, was)


def _json(spark: SparkSession, paths: str | list[str], schema: str, lines: bool = False) -> DataFrame:
    """Files that hold one array each, or with ``lines`` a record a line as ``write_records`` makes them."""
    with _listed_together(spark):
        found = spark.read.schema(schema).option("multiLine", not lines).json(paths)
    return found.withColumn("doc_id", _doc_of(F.col("_metadata.file_path")))


def unpack_detections(rows: DataFrame) -> DataFrame:
    """Rows of DETECTION_FIELDS and doc_id to detections with defaults; unknown labels are dropped."""
    at = lambda i, d: F.coalesce(F.get("bbox", F.lit(i)), F.lit(d))
    return rows.where(F.col("label_id").between(0, len(NAMES) - 1)).select(
        "doc_id", "page_index", "label_id", F.coalesce("confidence", F.lit(1.0)).alias("confidence"), at(0, 0.0).alias("x1"), at(1, 0.0).alias("y1"), at(2, 1.0).alias("x2"), at(3, 1.0).alias("y2"),
        "page_number", "page_number_end", F.coalesce("img_width", F.lit(1)).cast("long").alias("img_width"), F.coalesce("img_height", F.lit(1)).cast("long").alias("img_height"))


def read_detections(spark: SparkSession, paths: str | list[str], lines: bool = False) -> DataFrame:
    return unpack_detections(_json(spark, paths, DETECTION_FIELDS, lines))


def unpack_pages(rows: DataFrame, column: str = "pages") -> DataFrame:
    """A map of page index (as text) to attributes, a row for each volume, to pages with defaults."""
    d = rows.select("doc_id", F.explode(column).alias("k", "v"))
    zero = lambda c: F.coalesce(F.col(f"v.{c}"), F.lit(0.0)).alias(c)
    return d.select("doc_id", F.col("k").cast("long").alias("page_index"), F.coalesce("v.pdf_width", F.lit(612.0)).alias("pdf_width"), F.coalesce("v.pdf_height", F.lit(792.0)).alias("pdf_height"), *[zero(c) for c in ("col_left_x1", "col_left_x2", "col_right_x1", "col_right_x2", "midpoint")])


def read_pages(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    with _listed_together(spark):
        text = spark.read.text(paths, wholetext=True)
    text = text.withColumn("doc_id", _doc_of(F.col("_metadata.file_path")))
    return unpack_pages(text.select("doc_id", F.from_json("value", PAGE_FIELDS).alias("pages")))


def unpack_rects(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "page_index", F.posexplode("rects").alias("rect_no", "r")).select("doc_id", "page_index", F.col("rect_no").cast("long").alias("rect_no"), "r.*")


def read_rects(spark: SparkSession, paths: str | list[str], lines: bool = False) -> DataFrame:
    return unpack_rects(_json(spark, paths, RECT_FIELDS, lines))


def read_opinions(spark: SparkSession, paths: str | list[str], lines: bool = False) -> DataFrame:
    return _json(spark, paths, OPINION_FIELDS, lines)


def find_sidecars(spark: SparkSession, root: str, name: str = "detections.json") -> DataFrame:
    """path and doc_id of every side file of a name below ``root``, the uppermost of each volume first; listed by Spark, so any file system does."""
    with _listed_together(spark):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", name).load(root).select("path")
    depth = F.size(F.split("path", "/"))
    return files.select("path", _doc_of(F.col("path")).alias("doc_id"), depth.alias("depth")).groupBy("doc_id").agg(F.min_by("path", F.struct("depth", "path")).alias("path"))


def rebuild(detections: DataFrame, pages: DataFrame, meta: DataFrame | None) -> DataFrame:
    """Pages put together from detections' attributes and page side files: every page of ``pages`` (doc_id, page_index), with defaults."""
    seen = detections.groupBy(*PAGE).agg(F.max("img_width").alias("img_width"), F.max("img_height").alias("img_height"), F.max("page_number").alias("page_number"), F.max("page_number_end").alias("page_number_end"))
    d = pages.select(*PAGE).join(seen, PAGE, "left")
    bounds = ("col_left_x1", "col_left_x2", "col_right_x1", "col_right_x2", "midpoint")
    if meta is None:
        d = d.withColumns({"pdf_width": F.lit(612.0), "pdf_height": F.lit(792.0), **{c: F.lit(0.0) for c in bounds}})
    else:
        d = d.join(meta, PAGE, "left").withColumns({"pdf_width": F.coalesce("pdf_width", F.lit(612.0)), "pdf_height": F.coalesce("pdf_height", F.lit(792.0)), **{c: F.coalesce(c, F.lit(0.0)) for c in bounds}})
    return d.withColumns({"img_width": F.coalesce("img_width", F.lit(1700)).cast("long"), "img_height": F.coalesce("img_height", F.lit(2200)).cast("long")})


def inject(detections: DataFrame, extra: DataFrame, start: int, end: int) -> DataFrame:
    """Detections of a section with a reviewer's added ones: absolute pages become local, others are dropped, confidence is 1 where none is given."""
    local = F.col("page_index") - start
    new = extra.where(local.between(0, end - start) & F.col("label_id").between(0, len(NAMES) - 1)).withColumns({"page_index": local, "confidence": F.coalesce("confidence", F.lit(1.0))})
    return detections.unionByName(new.select(*detections.columns))


def remap_marks(marks: DataFrame, start: int, end: int) -> DataFrame:
    local = F.col("page_index") - start
    return marks.where(local.between(0, end - start)).withColumn("page_index", local)


def detection_records(detections: DataFrame, pages: DataFrame) -> DataFrame:
    """Records of the detections side file: label, rounded box and confidence, and the page's numbers and image size."""
    dim = F.broadcast(label_dimension(detections.sparkSession).select("label_id", "label"))
    p = pages.select(*PAGE, "page_number", "page_number_end", "img_width", "img_height")
    box = F.array(*[F.round(c, 1) for c in ("x1", "y1", "x2", "y2")])
    return detections.join(dim, "label_id").join(p, PAGE).select("doc_id", "det_id", "page_index", "label", "label_id", F.round("confidence", 3).alias("confidence"), box.alias("bbox"), "page_number", "page_number_end", "img_width", "img_height")


def page_records(pages: DataFrame) -> DataFrame:
    """One map of page index to attributes for each volume."""
    fields = F.struct("pdf_width", "pdf_height", "col_left_x1", "col_left_x2", "col_right_x1", "col_right_x2", "midpoint")
    return pages.groupBy("doc_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("page_index").cast("string"), fields)))).alias("pages"))


def rect_records(rects: DataFrame, *order: str) -> DataFrame:
    """Rects gathered by page in the order of ``order``, rounded to a tenth."""
    extra = [c for c in ("fill", "type") if c in rects.columns]
    row = F.struct(*order, *[F.round(c, 1).alias(f"_{c}") for c in ("x0", "y0", "x1", "y1")], *[F.col(c).alias(f"_{c}") for c in extra])
    shape = lambda r: F.struct(*[r[f"_{c}"].alias(c) for c in ("x0", "y0", "x1", "y1", *extra)])
    return rects.groupBy(*PAGE).agg(F.transform(F.sort_array(F.collect_list(row)), shape).alias("rects"))


def opinion_records(opinions: DataFrame, outside: DataFrame) -> DataFrame:
    """Records of the opinions side file with the rects outside each opinion."""
    rows = F.sort_array(F.collect_list(F.struct("page_index", F.col("part"), *[F.round(c, 1).alias(c) for c in ("x0", "y0", "x1", "y1")])))
    o = outside.groupBy("doc_id", "opinion").agg(F.transform(rows, lambda r: F.struct(r["page_index"].alias("page_index"), *[r[c].alias(c) for c in ("x0", "y0", "x1", "y1")])).alias("outside_rects"))
    box = lambda n: F.array(*[F.round(f"{n}_{c}", 1) for c in ("x1", "y1", "x2", "y2")]).alias(f"{n}_bbox")
    extra = [c for c in ("has_image", "first_number", "last_number", "file_name") if c in opinions.columns]
    return opinions.join(o, ["doc_id", "opinion"], "left").select(
        "doc_id", "opinion", "caption_page", F.lit("CASE_CAPTION").alias("caption_label"), box("caption"), "key_page", F.lit("KEY_ICON").alias("key_label"), box("key"), (F.col("key_page") - F.col("caption_page") + 1).alias("page_count"),
        F.coalesce("outside_rects", F.expr("cast(array() AS array<struct<page_index: bigint, x0: double, y0: double, x1: double, y1: double>>)")).alias("outside_rects"), *extra)


def write_records(records: DataFrame, path: str) -> None:
    """As JSON, a folder for each volume, so that a reader finds a volume's rows without a scan of the others."""
    records.withColumn("volume", F.col("doc_id")).repartition("doc_id").sortWithinPartitions(*records.columns[:2]).write.partitionBy("volume").mode("overwrite").json(path)
