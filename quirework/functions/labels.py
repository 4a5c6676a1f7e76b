"""The label dimension of page layout detections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Label ids in order from 0, and the properties of each.
NAMES = (
    "KEY_ICON", "DIVIDER", "PAGE_HEADER", "CASE_CAPTION", "FOOTNOTES", "HEADNOTE_BRACKET", "CASE_METADATA", "CASE_SEQUENCE", "PAGE_NUMBER", "STATE_ABBREVIATION",
    "IMAGE", "HEADNOTE", "BACKGROUND", "SYLLABUS", "EDITORIAL", "JUDGES", "TEXT_COLUMN", "DOCKET", "DATE", "COURT", "CITATION",
)
ID = {name: i for i, name in enumerate(NAMES)}
COPYRIGHTED = ("KEY_ICON", "PAGE_HEADER", "HEADNOTE_BRACKET", "HEADNOTE")
STRUCTURAL = ("DIVIDER", "CASE_CAPTION", "CASE_METADATA", "CASE_SEQUENCE", "PAGE_NUMBER", "STATE_ABBREVIATION", "JUDGES", "TEXT_COLUMN", "DOCKET", "DATE", "COURT", "CITATION")
MARGIN = ("PAGE_HEADER", "PAGE_NUMBER", "STATE_ABBREVIATION")
DEFAULT_CONFIDENCE = 0.20
MIN_CONFIDENCE = {"KEY_ICON": 0.50, "PAGE_HEADER": 0.50, "CASE_CAPTION": 0.50, "HEADNOTE_BRACKET": 0.50, "PAGE_NUMBER": 0.75, "HEADNOTE": 0.50, "BACKGROUND": 0.50}
FILL = {"DIVIDER": "black", "HEADNOTE_BRACKET": "black", "EDITORIAL": "black", "STATE_ABBREVIATION": "white", "PAGE_HEADER": "white"}
#: How boxes of several models are fused: the medium model's only, the smallest box, or the most confident one.
MEDIUM_ONLY = ("KEY_ICON", "CASE_CAPTION")
SMALLEST_BOX = ("CASE_SEQUENCE",)


def ids(names: tuple[str, ...] | list[str]) -> list[int]:
    return [ID[n] for n in names]


def label_dimension(spark: SparkSession) -> DataFrame:
    """One row for each label; 21 rows in the plan itself, so joins with it may broadcast."""
    text = lambda x: "CAST(NULL AS STRING)" if x is None else f"'{x}'"
    rows = ", ".join(
        f"({i}L, '{n}', {n in COPYRIGHTED}, {n in STRUCTURAL}, {n in MARGIN}, {text(FILL.get(n))}, {MIN_CONFIDENCE.get(n, DEFAULT_CONFIDENCE)}D, '{'medium' if n in MEDIUM_ONLY else 'smallest' if n in SMALLEST_BOX else 'confidence'}')"
        for i, n in enumerate(NAMES)
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS labels(label_id, label, is_copyrighted, is_structural, in_margin, redact_fill, min_conf, merge_policy)")
