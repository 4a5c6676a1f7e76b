"""Whole runs over many volumes at once: from detections to output plans, and from readings to issues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.functions.session import staged
from quirework.operators import outputs, pairing, sequence, words as W, zones
from quirework.operators.grouped import repair_page_numbers


def repaired(pages: DataFrame) -> DataFrame:
    """Pages with their numbers set right from the sequence."""
    fixed = repair_page_numbers(pages).drop("changed")
    return pages.drop("page_number", "page_number_end").join(fixed, ["doc_id", "page_index"])


def process(det: DataFrame, pages: DataFrame, words: DataFrame, blocks: DataFrame, reporter: str | None = None, exclusions: DataFrame | None = None, approvals: DataFrame | None = None, first_page: int = 1) -> dict[str, DataFrame]:
    """Tables of a run: opinions with numbers and file names, rects outside them, stored redaction rects, margin rects, stamps and the plan of all output files."""
    pages = staged(repaired(pages), "repaired-pages")
    opinions = staged(pairing.with_file_names(pairing.with_page_numbers(pairing.pair_opinions(det, pages, exclusions), pages, first_page)), "opinions")
    outside = staged(pairing.outside_rects(det, pages, opinions), "outside-rects")
    stored = staged(zones.plan_precomputed(det, pages, words, reporter, exclusions, approvals), "redaction-rects")
    margins = W.margin_rects(W.page_text_bounds(blocks))
    on_page = outputs.stored_rects_in_points(stored, pages).select("doc_id", "page_index", "type", "x0", "y0", "x1", "y1", "fill")
    on_page = on_page.unionByName(margins.select("doc_id", "page_index", F.lit("margin").alias("type"), "x0", "y0", "x1", "y1", F.lit("white").alias("fill")))
    return {
        "pages": pages, "opinions": opinions, "outside_rects": outside, "redaction_rects": stored, "margin_rects": margins,
        "stamps": zones.stamps(zones.key_icon_rects(det, pages, exclusions)), "output_plan": outputs.generate_plan(opinions, outside, on_page), "scan_names": outputs.scan_names(pages, first_page=first_page),
    }


def validate(readings: DataFrame, expected: DataFrame | None = None, page_facts: DataFrame | None = None, correct: bool = True) -> dict[str, DataFrame]:
    """issues, page_map, missing_pages, readings (checked) and corrections of every volume."""
    d, corrections = sequence.validate(readings, expected, correct)
    missing = staged(sequence.missing_pages(d), "missing-pages")
    single, _ = sequence.real_missing(missing)
    structural = None if page_facts is None else W.structural_issues(page_facts)
    return {"issues": sequence.issues(d, corrections, structural), "page_map": sequence.page_map(d, single), "missing_pages": single, "readings": d, "corrections": corrections}
