"""Layout tables made from the star-schema test tables, by the same SQL in Spark and elsewhere.

The test data hold no page scans, so detections come from line items (a volume for each
supplier), page readings and text candidates from events, words from documents (a page each)
and text blocks from conversations. Each view covers its whole source table; ordinals are
counted within a volume, never over the whole table.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from quirework.functions.session import staged
from quirework.operators.pairing import pair_opinions

PAGES_IN_VOLUME = 40

DETECTIONS = """
SELECT l_suppkey AS doc_id,
  CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) AS BIGINT) AS det_id,
  l_orderkey % 40 AS page_index,
  (l_partkey * 7 + l_linenumber * 3 + l_orderkey) % 21 AS label_id,
  (20 + (l_partkey * 13 + l_orderkey * 7 + l_linenumber * 5) % 80) / CAST(100 AS DOUBLE) AS confidence,
  CAST((l_partkey * 37 + l_orderkey * 11) % 1200 AS DOUBLE) AS x1,
  CAST((l_partkey * 53 + l_orderkey * 29 + l_linenumber * 101) % 1900 AS DOUBLE) AS y1,
  CAST((l_partkey * 37 + l_orderkey * 11) % 1200 + 20 + (l_partkey % 7) * 60 AS DOUBLE) AS x2,
  CAST((l_partkey * 53 + l_orderkey * 29 + l_linenumber * 101) % 1900 + 20 + (l_linenumber % 5) * 25 AS DOUBLE) AS y2,
  CASE WHEN l_linenumber % 3 = 0 THEN 'small' WHEN l_linenumber % 3 = 1 THEN 'medium' ELSE 'large' END AS model
FROM {lineitem}
"""

#: The midpoint is 0 on pages without column measurement.
PAGES = """
SELECT doc_id, page_index, CAST(612 AS DOUBLE) AS pdf_width, CAST(792 AS DOUBLE) AS pdf_height,
  CAST(1700 AS BIGINT) AS img_width, CAST(2200 AS BIGINT) AS img_height,
  CASE WHEN page_index % 13 = 5 THEN NULL WHEN page_index % 17 = 3 THEN page_index + 90 ELSE page_index + 1 END AS page_number,
  CASE WHEN page_index % 19 = 7 THEN page_index + 3 END AS page_number_end,
  CAST(CASE WHEN page_index % 11 = 4 THEN 0 ELSE 100 END AS DOUBLE) AS col_left_x1, CAST(CASE WHEN page_index % 11 = 4 THEN 0 ELSE 820 END AS DOUBLE) AS col_left_x2,
  CAST(CASE WHEN page_index % 11 = 4 THEN 0 ELSE 880 END AS DOUBLE) AS col_right_x1, CAST(CASE WHEN page_index % 11 = 4 THEN 0 ELSE 1600 END AS DOUBLE) AS col_right_x2,
  CAST(CASE WHEN page_index % 11 = 4 THEN 0 ELSE 850 END AS DOUBLE) AS midpoint
FROM (SELECT DISTINCT l_suppkey AS doc_id, l_orderkey % 40 AS page_index FROM {lineitem}) p
"""

READINGS = """
SELECT doc_id, pdf_page,
  CASE WHEN event_type = 'error' THEN NULL
       WHEN event_id % 29 = 0 THEN concat(CAST(pdf_page AS STRING), '-', CAST(pdf_page + 1 AS STRING))
       WHEN event_id % 37 = 0 THEN CAST(pdf_page + 800 AS STRING)
       WHEN event_id % 17 = 0 THEN CAST(pdf_page + 3 AS STRING)
       WHEN event_id % 23 = 0 THEN CAST(pdf_page - 1 AS STRING)
       ELSE CAST(pdf_page AS STRING) END AS detected,
  CASE WHEN event_type = 'error' THEN NULL WHEN event_id % 29 = 0 THEN 'range' ELSE 'single' END AS type,
  (event_id % 100) / CAST(100 AS DOUBLE) AS score
FROM (SELECT user_id AS doc_id, event_id, event_type,
        CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS pdf_page FROM {events}) e
"""

#: OCR candidates: three to a page, box centre as cx and cy (null: no box).
CANDIDATES = """
SELECT doc_id, CAST((n - n % 3) / 3 AS BIGINT) AS page_no, CAST(n % 3 AS BIGINT) AS seq, event_id,
  CASE CAST(event_id % 11 AS INT) WHEN 0 THEN concat('(', CAST(n AS STRING), ')') WHEN 1 THEN concat(CAST(n AS STRING), '-', CAST(n + 1 AS STRING)) WHEN 2 THEN concat('Page ', CAST(n AS STRING))
    WHEN 3 THEN 'xiv' WHEN 4 THEN concat(CAST(n AS STRING), ' – ', CAST(n + 2 AS STRING)) WHEN 5 THEN CAST(n + 12345 AS STRING) WHEN 6 THEN concat(CAST(n AS STRING), ', ', CAST(n + 1 AS STRING))
    WHEN 7 THEN '' ELSE CAST(n AS STRING) END AS raw_text,
  (event_id % 97) / CAST(96 AS DOUBLE) AS score,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST((event_id * 131) % 1700 AS DOUBLE) END AS cx,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST((event_id * 61) % 500 AS DOUBLE) END AS cy,
  CASE CAST(event_id % 5 AS INT) WHEN 0 THEN 'yolo-pn' WHEN 1 THEN 'hdr-L' WHEN 2 THEN 'corner-L' WHEN 3 THEN 'corner-R' ELSE 'top' END AS zone,
  CASE CAST(event_id % 3 AS INT) WHEN 0 THEN 'paddle' WHEN 1 THEN 'tesseract' ELSE 'glm' END AS ocr
FROM (SELECT user_id AS doc_id, event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS n FROM {events}) e
"""

BLOCKS = """
SELECT CAST((conv_id - conv_id % 8) / 8 AS BIGINT) AS doc_id, conv_id % 8 AS page_index, turn AS block_no,
  CAST(40 + (conv_id * 17 + turn * 31) % 260 AS DOUBLE) AS x0, CAST(50 + turn * 60 AS DOUBLE) AS y0,
  CAST(40 + (conv_id * 17 + turn * 31) % 260 + 220 AS DOUBLE) AS x1, CAST(50 + turn * 60 + 45 AS DOUBLE) AS y1,
  text, CAST(CASE WHEN turn % 4 = 3 THEN 1 ELSE 0 END AS BIGINT) AS block_type
FROM {conversations}
"""

_WORD_ROWS = "SELECT doc_id AS d, CAST(pos AS BIGINT) AS pos, word FROM {documents} LATERAL VIEW posexplode(split(text, ' ')) t AS pos, word"
_WORD_ROWS_DUCKDB = "SELECT doc_id AS d, pos - 1 AS pos, word FROM {documents}, unnest(string_split(text, ' ')) WITH ORDINALITY AS t(word, pos)"
_WORDS = """
SELECT CAST((d - d % 40) / 40 AS BIGINT) AS doc_id, d % 40 AS page_index, pos AS word_no,
  CAST(36 + (pos % 12) * 45 AS DOUBLE) AS x0, CAST(40 + (CAST((pos - pos % 12) / 12 AS BIGINT) % 60) * 12 AS DOUBLE) AS y0,
  CAST(36 + (pos % 12) * 45 + 40 AS DOUBLE) AS x1, CAST(40 + (CAST((pos - pos % 12) / 12 AS BIGINT) % 60) * 12 + 10 AS DOUBLE) AS y1, word
FROM (ROWS) w WHERE trim(word) <> ''
"""
WORDS = _WORDS.replace("ROWS", _WORD_ROWS)

#: Rows a reviewer would exclude or approve: every 53rd and every 31st detection, moved by a few pixels.
EXCLUSIONS = """
SELECT doc_id, page_index, label_id, CAST(x1 AS BIGINT) + det_id % 14 AS x, CAST(y1 AS BIGINT) - det_id % 9 AS y FROM ({DETECTIONS}) d WHERE det_id % {every} = 0
"""


def duckdb(name: str) -> str:
    """The view's text for DuckDB, over tables of the same names."""
    text = {"det": DETECTIONS, "pg": PAGES, "rd": READINGS, "cand": CANDIDATES, "bl": BLOCKS, "wd": _WORDS.replace("ROWS", _WORD_ROWS_DUCKDB), "excl": EXCLUSIONS.replace("{DETECTIONS}", DETECTIONS).replace("{every}", "53"), "appr": EXCLUSIONS.replace("{DETECTIONS}", DETECTIONS).replace("{every}", "31")}[name]
    for t in ("lineitem", "events", "conversations", "documents"):
        text = text.replace("{" + t + "}", t)
    return text


class Views:
    """The layout tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self._dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._dir}/{name}.parquet")

    @cached_property
    def detections(self) -> DataFrame:
        return self.spark.sql(DETECTIONS, lineitem=self.table("lineitem"))

    @cached_property
    def pages(self) -> DataFrame:
        return self.spark.sql(PAGES, lineitem=self.table("lineitem"))

    @cached_property
    def det(self) -> DataFrame:
        """Detections as a stored table, for plans that read them several times."""
        return staged(self.detections, "detections")

    @cached_property
    def pg(self) -> DataFrame:
        return staged(self.pages, "pages")

    @cached_property
    def opinions(self) -> DataFrame:
        return staged(pair_opinions(self.det, self.pg), "opinions")

    @cached_property
    def readings(self) -> DataFrame:
        return self.spark.sql(READINGS, events=self.table("events"))

    @cached_property
    def candidates(self) -> DataFrame:
        return self.spark.sql(CANDIDATES, events=self.table("events"))

    @cached_property
    def blocks(self) -> DataFrame:
        return self.spark.sql(BLOCKS, conversations=self.table("conversations"))

    @cached_property
    def words(self) -> DataFrame:
        return self.spark.sql(WORDS, documents=self.table("documents"))

    def marks(self, every: int) -> DataFrame:
        return self.spark.sql(EXCLUSIONS.replace("{DETECTIONS}", DETECTIONS).replace("{every}", str(every)), lineitem=self.table("lineitem"))

    @cached_property
    def exclusions(self) -> DataFrame:
        return self.marks(53)

    @cached_property
    def approvals(self) -> DataFrame:
        return self.marks(31)
