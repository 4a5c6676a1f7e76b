"""Column expressions on boxes and texts; all stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOX = ("x1", "y1", "x2", "y2")
RECT = ("x0", "y0", "x1", "y1")


def center_x(prefix: str = "") -> Column:
    return (F.col(prefix + "x1") + F.col(prefix + "x2")) / 2


def center_y(prefix: str = "") -> Column:
    return (F.col(prefix + "y1") + F.col(prefix + "y2")) / 2


def scale_x() -> Column:
    return F.col("pdf_width") / F.col("img_width")


def scale_y() -> Column:
    return F.col("pdf_height") / F.col("img_height")


def column_ordinal(midpoint: Column, prefix: str = "") -> Column:
    """0 left, 1 right."""
    return F.when(center_x(prefix) < midpoint, F.lit(0)).otherwise(F.lit(1)).cast("long")


def intersection(a: dict[str, Column], b: dict[str, Column]) -> Column:
    zero = F.lit(0.0)
    return F.greatest(zero, F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])) * F.greatest(zero, F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]))


def area(a: dict[str, Column]) -> Column:
    return (a["x2"] - a["x1"]) * (a["y2"] - a["y1"])


def iou(a: dict[str, Column], b: dict[str, Column]) -> Column:
    inter = intersection(a, b)
    union = area(a) + area(b) - inter
    return F.when(union > 0, inter / union).otherwise(F.lit(0.0))


def box(alias: str) -> dict[str, Column]:
    return {c: F.col(f"{alias}.{c}") for c in BOX}


def subtract_rects(rect: str, holes: str) -> Column:
    """``rect`` (struct x0..y1) less the rects of the array ``holes``: an array of disjoint parts.

    A fold over the holes, each cutting every part left so far into the slices above, below,
    left and right of it; only strict overlap cuts, and slices without area are dropped.
    """
    return F.expr(f"""aggregate({holes}, array({rect}), (parts, h) -> flatten(transform(parts, p ->
        CASE WHEN p.x0 < h.x1 AND h.x0 < p.x1 AND p.y0 < h.y1 AND h.y0 < p.y1 THEN filter(array(
            named_struct('x0', p.x0, 'y0', p.y0, 'x1', p.x1, 'y1', h.y0),
            named_struct('x0', p.x0, 'y0', h.y1, 'x1', p.x1, 'y1', p.y1),
            named_struct('x0', p.x0, 'y0', greatest(p.y0, h.y0), 'x1', h.x0, 'y1', least(p.y1, h.y1)),
            named_struct('x0', h.x1, 'y0', greatest(p.y0, h.y0), 'x1', p.x1, 'y1', least(p.y1, h.y1))), s -> s.x0 < s.x1 AND s.y0 < s.y1)
        ELSE array(p) END)))""")


#: A printed page range such as 12-14 or 12–14 (fixed pattern).
RANGE_PATTERN = r"^([0-9]{1,4})\s*[–\-]\s*([0-9]{1,4})$"
#: What may stand around a page number (fixed set).
EDGE_PUNCTUATION = ".,;:!?()[]{}'\""


def classify_page_text(text: Column) -> Column:
    """struct(text, type) of a reading: a range, a single number of up to four digits, or null."""
    cleaned = F.btrim(text, F.lit(EDGE_PUNCTUATION))
    trailing = F.regexp_extract(text, r"(?:^|[^0-9A-Za-z_])([0-9]{1,4})\s*$", 1)
    number = r"^[0-9]{1,4}$"
    found = (
        F.when(text.rlike(RANGE_PATTERN), F.struct(text.alias("text"), F.lit("range").alias("type")))
        .when(text.rlike(number), F.struct(text.alias("text"), F.lit("single").alias("type")))
        .when(cleaned.rlike(RANGE_PATTERN), F.struct(cleaned.alias("text"), F.lit("range").alias("type")))
        .when(cleaned.rlike(number), F.struct(cleaned.alias("text"), F.lit("single").alias("type")))
        .when(trailing != "", F.struct(trailing.alias("text"), F.lit("single").alias("type")))
    )
    return found


def range_bounds(text: Column) -> tuple[Column, Column]:
    """First and last page of a range reading, null for anything else."""
    plain = F.replace(text, F.lit("–"), F.lit("-"))
    first, last = F.regexp_extract(plain, RANGE_PATTERN, 1), F.regexp_extract(plain, RANGE_PATTERN, 2)
    return F.when(first != "", first.cast("long")), F.when(last != "", last.cast("long"))


def parse_page_range(text: Column) -> Column:
    """array(first, last) where the text is a range of two or three pages, array(number) of all its digits, else null."""
    t = F.btrim(text)
    pattern = r"^([0-9]{1,9})\s*[-–,]\s*([0-9]{1,9})$"
    a, b = F.regexp_extract(t, pattern, 1), F.regexp_extract(t, pattern, 2)
    first, last = F.when(a != "", a.cast("long")), F.when(b != "", b.cast("long"))
    digits = F.regexp_replace(t, r"[^0-9]", "")
    return F.when((last > first) & (last - first <= 2), F.array(first, last)).when((F.length(digits) > 0) & (F.length(digits) <= 18), F.array(digits.cast("long")))


def plausible_number(n: Column, hint: Column, max_digits: Column) -> Column:
    """Not zero, not too long, and within 20 of a positive hint."""
    return (F.length(n.cast("string")) <= max_digits) & (n != 0) & ~((hint > 0) & (F.abs(n - hint) > 20))


def max_digits(hint: Column) -> Column:
    return F.when(hint > 0, F.greatest(F.lit(4), F.length(hint.cast("string")) + 1)).otherwise(F.lit(5))
