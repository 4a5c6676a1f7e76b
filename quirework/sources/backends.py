"""Interfaces of what needs libraries that are not part of this package: pages as images, detection, OCR and PDF files.

Each is called from ``mapInPandas`` with one backend for each task, so models are loaded once.
``backend`` is a picklable factory; without one a call ends with BackendMissing, never with
made-up results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class BackendMissing(RuntimeError):
    """No library for this step is installed."""


class PageRasterizer(Protocol):
    def pages(self, pdf: bytes) -> list[tuple[float, float]]: ...  # width and height in points
    def render(self, pdf: bytes, page_index: int, dpi: int) -> bytes: ...


class Detector(Protocol):
    def detect(self, images: list[bytes]) -> list[list[tuple[int, float, float, float, float, float]]]: ...  # label_id, confidence, x1, y1, x2, y2


class TextExtractor(Protocol):
    def words(self, pdf: bytes, page_index: int) -> list[tuple[float, float, float, float, str]]: ...
    def blocks(self, pdf: bytes, page_index: int) -> list[tuple[float, float, float, float, str, int]]: ...


class OcrBackend(Protocol):
    def read(self, image: bytes) -> list[tuple[str, float, float | None, float | None]]: ...  # text, score, centre


class PdfWriter(Protocol):
    def write(self, pdf: bytes, page_from: int, page_to: int, rects: pd.DataFrame) -> bytes: ...
    def merge(self, parts: list[bytes]) -> bytes: ...


def _made(factory: Callable | None, what: str):
    if factory is None:
        raise BackendMissing(f"no {what} is installed; pass one")
    return factory()


MODELS = ("small", "medium", "large")


def ensure_weights(spark: SparkSession, folder: str, models: list[str] | None = None, fetch: dict[str, Callable[[str], None]] | None = None) -> dict[str, str]:
    """Weights ``<model>.pt`` in ``folder`` (on any file system), handed to every executor: model to path there, for a backend to open by its file name in ``SparkFiles``.

    One that is missing is fetched by ``fetch[model](path)``, which must leave it at that path; without such a
    source the call ends with FileNotFoundError. Weights that are there are never fetched. ``models`` None: all three.
    """
    found = {}
    for model in MODELS if models is None else models:
        path = f"{folder.rstrip('/')}/{model}.pt"
        if not _is_file(spark, path) and model in (fetch or {}):
            fetch[model](path)
        if not _is_file(spark, path):
            raise FileNotFoundError(f"no weights at {path} and no source to fetch them from")
        found[model] = path
    for path in found.values():
        spark.sparkContext.addFile(path)
    return found


def _is_file(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isFile()


def read_volumes(spark: SparkSession, path: str) -> DataFrame:
    """path, content and size of PDF files on any file system."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path).select("path", "content", F.col("length").alias("size"))


def page_table(volumes: DataFrame, backend: Callable[[], PageRasterizer] | None = None) -> DataFrame:
    """doc_id and content to a row for each page: doc_id, page_index, pdf_width, pdf_height."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pages = _made(backend, "page rasterizer")
        for g in batches:
            rows = [(d, i, w, h) for d, c in zip(g["doc_id"], g["content"]) for i, (w, h) in enumerate(pages.pages(c))]
            yield pd.DataFrame(rows, columns=["doc_id", "page_index", "pdf_width", "pdf_height"])

    return volumes.select("doc_id", "content").mapInPandas(run, "doc_id long, page_index long, pdf_width double, pdf_height double")


def detect(images: DataFrame, backend: Callable[[], Detector] | None = None, batch: int = 4, least: float = 0.20) -> DataFrame:
    """doc_id, page_index and image to detections of at least the confidence ``least``; images go to the model in batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _made(backend, "detector")
        for g in batches:
            rows = []
            for at in range(0, len(g), batch):
                part = g.iloc[at : at + batch]
                for d, p, found in zip(part["doc_id"], part["page_index"], model.detect(list(part["image"]))):
                    rows += [(d, p, *f) for f in found if f[1] >= least]
            yield pd.DataFrame(rows, columns=["doc_id", "page_index", "label_id", "confidence", "x1", "y1", "x2", "y2"])

    return images.select("doc_id", "page_index", "image").mapInPandas(run, "doc_id long, page_index long, label_id long, confidence double, x1 double, y1 double, x2 double, y2 double")


def read_text(images: DataFrame, backend: Callable[[], OcrBackend] | None = None) -> DataFrame:
    """doc_id, page_no, zone and image to OCR candidates."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ocr = _made(backend, "OCR backend")
        for g in batches:
            rows = [(d, p, z, i, *hit) for d, p, z, image in zip(g["doc_id"], g["page_no"], g["zone"], g["image"]) for i, hit in enumerate(ocr.read(image))]
            yield pd.DataFrame(rows, columns=["doc_id", "page_no", "zone", "seq", "raw_text", "score", "cx", "cy"])

    return images.select("doc_id", "page_no", "zone", "image").mapInPandas(run, "doc_id long, page_no long, zone string, seq long, raw_text string, score double, cx double, cy double")


def extract_words(volumes: DataFrame, backend: Callable[[], TextExtractor] | None = None) -> DataFrame:
    """doc_id, page_index and content to words; blank ones are dropped."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        text = _made(backend, "text extractor")
        for g in batches:
            rows = [(d, p, i, *w) for d, p, c in zip(g["doc_id"], g["page_index"], g["content"]) for i, w in enumerate(text.words(c, p)) if w[4].strip()]
            yield pd.DataFrame(rows, columns=["doc_id", "page_index", "word_no", "x0", "y0", "x1", "y1", "word"])

    return volumes.select("doc_id", "page_index", "content").mapInPandas(run, "doc_id long, page_index long, word_no long, x0 double, y0 double, x1 double, y1 double, word string")


def write_files(files: DataFrame, plan: DataFrame, backend: Callable[[], PdfWriter] | None = None) -> DataFrame:
    """Output files (doc_id, file_name, page_from, page_to, content) with the rects of their plan burnt in: doc_id, file_name, content.

    plan: doc_id, file_name, page_index, x0..y1, fill. A file's rects are one group, a few for each page.
    """
    rects = plan.groupBy("doc_id", "file_name").agg(F.collect_list(F.struct("page_index", "x0", "y0", "x1", "y1", "fill")).alias("rects"))
    d = files.join(rects, ["doc_id", "file_name"], "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer = _made(backend, "PDF writer")
        for g in batches:
            done = []
            for r in g.itertuples(index=False):
                own = pd.DataFrame([dict(x) for x in r.rects] if r.rects is not None else [], columns=["page_index", "x0", "y0", "x1", "y1", "fill"])
                done.append((r.doc_id, r.file_name, writer.write(r.content, r.page_from, r.page_to, own)))
            yield pd.DataFrame(done, columns=["doc_id", "file_name", "content"])

    return d.select("doc_id", "file_name", "page_from", "page_to", "content", "rects").mapInPandas(run, "doc_id long, file_name string, content binary")


def merge_chunks(chunks: DataFrame, backend: Callable[[], PdfWriter] | None = None) -> DataFrame:
    """The chunks of each volume (doc_id, chunk, content) put together in order."""

    def merge(g: pd.DataFrame) -> pd.DataFrame:
        writer = _made(backend, "PDF writer")
        return pd.DataFrame({"doc_id": [g["doc_id"].iloc[0]], "content": [writer.merge(list(g.sort_values("chunk")["content"]))]})

    return chunks.select("doc_id", "chunk", "content").groupBy("doc_id").applyInPandas(merge, "doc_id long, content binary")
