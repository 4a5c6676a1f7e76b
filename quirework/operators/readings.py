"""Choosing a page number among OCR candidates.

Candidates: doc_id, page_no (page from 0), seq, raw_text, score, cx, cy (box centre, null
without a box), zone and ocr. The best of each is found by ``min_by``/``max_by`` aggregates over
a page's few candidates, so no candidate list is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions import expressions as E

CANDIDATE_PAGE = ["doc_id", "page_no"]
MIN_SCORE = 0.80


def classified(candidates: DataFrame) -> DataFrame:
    """Adds text and type of what a candidate says; candidates that say no number are dropped."""
    d = candidates.withColumn("c", E.classify_page_text(F.btrim("raw_text"))).where("c IS NOT NULL")
    return d.select(*candidates.columns, "c.text", "c.type")


def scan_hits(candidates: DataFrame) -> DataFrame:
    """Every candidate with what it is: a hit, a near miss (some number in it) or nothing."""
    d = candidates.withColumn("c", E.classify_page_text(F.btrim("raw_text")))
    near = F.col("raw_text").rlike("[0-9]{1,4}")
    return d.select(*candidates.columns, F.col("c.text").alias("text"), F.col("c.type").alias("type"), F.when(F.col("c").isNotNull(), "hit").when(near, "near_miss").otherwise("none").alias("outcome"))


def positioned(hits: DataFrame, img_w: float = 1700.0, img_h: float = 2200.0) -> DataFrame:
    """Candidates in the upper corners, and those without a box."""
    corner = (F.col("cy") <= img_h * 0.15) & ((F.col("cx") <= img_w * 0.20) | (F.col("cx") >= img_w * 0.80))
    return hits.where(F.col("cx").isNull() | F.col("cy").isNull() | corner)


def _within(start: Column, end: Column, margin: int = 20) -> Column:
    a, z = E.range_bounds(F.col("text"))
    n = F.when(F.col("type") == "single", F.expr("try_cast(text AS BIGINT)"))
    return F.coalesce(F.when(F.col("type") == "range", (a >= start - margin) & (z <= end + margin)).otherwise((n >= start - margin) & (n <= end + margin)), F.lit(False))


def pool(hits: DataFrame, expected: DataFrame | None) -> DataFrame:
    """Positioned candidates, narrowed to those in the expected range and then to those of good score, each unless none is left."""
    d = positioned(hits)
    if expected is not None:
        d = d.join(expected.select("doc_id", "exp_start", "exp_end"), "doc_id", "left").withColumn("ok", F.coalesce(_within(F.col("exp_start"), F.col("exp_end")), F.lit(False)))
    else:
        d = d.withColumn("ok", F.lit(False))
    # Both steps by grouped flags: in range first, then good among what stays.
    flags = d.groupBy(*CANDIDATE_PAGE).agg(F.bool_or("ok").alias("any_ok"), F.bool_or(F.col("ok") & (F.col("score") >= MIN_SCORE)).alias("ok_good"), F.bool_or(F.col("score") >= MIN_SCORE).alias("any_good"))
    d = d.join(flags, CANDIDATE_PAGE).where(~F.col("any_ok") | F.col("ok"))
    good = F.when(F.col("any_ok"), F.col("ok_good")).otherwise(F.col("any_good"))
    return d.where(~good | (F.col("score") >= MIN_SCORE)).select(*hits.columns)


def best_reading(hits: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """The candidate of highest score of each page's pool; of equal ones the first."""
    key = F.struct((-F.col("score")).alias("s"), F.col("seq"))
    return pool(hits, expected).groupBy(*CANDIDATE_PAGE).agg(F.min_by(F.struct("text", "type", "score", "zone", "ocr"), key).alias("b")).select(*CANDIDATE_PAGE, "b.*")


def first_valid(hits: DataFrame, expected: DataFrame | None = None, backends: tuple[str, ...] = ("paddle", "tesseract", "glm")) -> DataFrame:
    """Of several OCR backends the first in order whose reading is valid: a range, or a number within 20 of the expected range."""
    rank = F.array_position(F.array(*[F.lit(b) for b in backends]), F.col("ocr"))
    d = hits.where(rank > 0)
    if expected is not None:
        d = d.join(expected.select("doc_id", "exp_start", "exp_end"), "doc_id", "left").where((F.col("type") == "range") | F.col("exp_start").isNull() | F.col("exp_end").isNull() | _within(F.col("exp_start"), F.col("exp_end")))
    return d.groupBy(*CANDIDATE_PAGE).agg(F.min_by(F.struct("text", "type", "ocr"), F.struct(rank.alias("r"), F.col("seq"))).alias("b")).select(*CANDIDATE_PAGE, "b.*")


def decide(candidates: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """The reading of each page: a plausible box or header reading, else the best corner or strip reading, else a box reading of good score.

    Zones yolo-pn and hdr-* are box and header readings (boxes before headers); plausible is a
    number within 10 of start + page or a paddle reading of good score. Corner readings are
    taken with the strip's where they alone give nothing of good score.
    """
    hits = classified(candidates)
    boxed = hits.where(F.col("zone").isin("yolo-pn", "hdr-L", "hdr-R"))
    rank = F.when(F.col("zone") == "yolo-pn", 0).when(F.col("zone") == "hdr-L", 1).otherwise(2)
    box = boxed.groupBy(*CANDIDATE_PAGE).agg(F.min_by(F.struct("text", "type", "score", "zone", "ocr"), F.struct(rank.alias("r"), F.col("seq"))).alias("y"))
    corner = best_reading(hits.where(F.col("zone").startswith("corner")), expected).select(*CANDIDATE_PAGE, F.struct("text", "type", "score", "zone", "ocr").alias("c"))
    both = best_reading(hits.where(F.col("zone").startswith("corner") | (F.col("zone") == "top")), expected).select(*CANDIDATE_PAGE, F.struct("text", "type", "score", "zone", "ocr").alias("t"))
    pages = candidates.select(*CANDIDATE_PAGE).distinct()
    d = pages.join(box, CANDIDATE_PAGE, "left").join(corner, CANDIDATE_PAGE, "left").join(both, CANDIDATE_PAGE, "left")
    if expected is not None:
        d = d.join(expected.select("doc_id", "exp_start"), "doc_id", "left")
    else:
        d = d.withColumn("exp_start", F.lit(None).cast("long"))
    n = F.when(F.col("y.type") == "single", F.expr("try_cast(y.text AS BIGINT)"))
    plausible = F.coalesce(F.abs(n - (F.col("exp_start") + F.col("page_no"))) <= 10, F.lit(False)) | F.coalesce((F.col("y.ocr") == "paddle") & (F.col("y.score") >= MIN_SCORE), F.lit(False))
    cornered = F.when(F.col("c").isNotNull() & (F.col("c.score") >= MIN_SCORE), F.col("c")).otherwise(F.col("t"))
    picked = F.when(plausible, F.col("y")).otherwise(F.coalesce(cornered, F.when(F.col("y.score") >= MIN_SCORE, F.col("y"))))
    return d.withColumn("p", picked).select(*CANDIDATE_PAGE, "p.text", "p.type", "p.score", "p.zone", "p.ocr")


def extract_number(candidates: DataFrame, hint: Column) -> DataFrame:
    """number and number_end of each page from its readings in order: the first plausible range or number, else the least far from the hint (or shortest).

    A reading's range is tried before its digits.
    """
    d = candidates.withColumn("hint", hint).withColumn("digits_limit", E.max_digits(F.col("hint"))).withColumn("parsed", E.parse_page_range(F.col("raw_text"))).where("parsed IS NOT NULL")
    a, b, n = F.get("parsed", F.lit(0)), F.get("parsed", F.lit(1)), F.expr("try_cast(regexp_replace(raw_text, '[^0-9]', '') AS BIGINT)")
    ok = lambda x: E.plausible_number(x, F.col("hint"), F.col("digits_limit"))
    ranged = (F.size("parsed") == 2) & (ok(a) | ok(b))
    found = F.when(ranged, F.struct(a.alias("number"), b.alias("number_end"))).when(ok(n), F.struct(n.alias("number"), F.lit(None).cast("long").alias("number_end")))
    far = F.when(F.col("hint") > 0, F.abs(n - F.col("hint"))).otherwise(F.length(n.cast("string")))
    d = d.withColumns({"found": found, "n": n, "far": far})
    g = d.groupBy(*CANDIDATE_PAGE).agg(F.min_by("found", F.when(F.col("found").isNotNull(), F.col("seq"))).alias("f"), F.min_by("n", F.struct("far", "seq")).alias("fallback"))
    return g.select(*CANDIDATE_PAGE, F.coalesce("f.number", "fallback").alias("number"), F.col("f.number_end").alias("number_end"))
