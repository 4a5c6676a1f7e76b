"""File names: what they tell about a volume, and those of its outputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Endings that processing steps add to a name.
_STEPS = r"[_-](redacted|ocr|compressed|dupes|bitonal|copy|fixed)\b.*"
_SUFFIXES = (".redacted", ".ocr", ".compressed")


def volume_of(name: Column) -> Column:
    """struct(reporter, volume, first_page, last_page) of a name such as rep.12.1.900.pdf; null if it has no such form.

    The reporter may hold dots; the pages must be numbers, the first at least 1 and the last no smaller.
    """
    stem = F.regexp_replace(F.regexp_replace(name, r"\.[^.]*$", ""), _STEPS, "")
    for suffix in _SUFFIXES:
        stem = F.regexp_replace(stem, suffix.replace(".", r"\.") + "$", "")

    def parts(p: Column) -> Column:
        at = lambda i: F.try_element_at(p, F.lit(i))
        number = lambda c: F.when(c.rlike(r"^[0-9]{1,18}$"), c.cast("long"))
        reporter = F.array_join(F.slice(p, 1, F.greatest(F.size(p) - 3, F.lit(0))), ".")
        return F.struct(reporter.alias("reporter"), at(-3).alias("volume"), number(at(-2)).alias("first_page"), number(at(-1)).alias("last_page"))

    # Lambdas over one-element arrays name a value that is used several times.
    told = F.transform(F.array(F.split(stem, r"\.")), lambda p: F.when(F.size(p) >= 4, parts(p)))
    fine = lambda v: (v["reporter"] != "") & (v["volume"] != "") & (v["first_page"] >= 1) & (v["last_page"] >= v["first_page"])
    return F.get(F.filter(told, lambda v: F.coalesce(fine(v), F.lit(False))), F.lit(0))


def pages_of(file_name: Column) -> Column:
    """struct(first_page, last_page) of an output's name, both 0 where it tells none."""
    stem = F.regexp_replace(file_name, r"\.pdf$", "")
    pages = F.split(F.element_at(F.split(stem, r"\."), -1), "-")
    a, z = F.get(pages, F.lit(0)), F.get(pages, F.lit(1))
    fine = a.rlike(r"^[0-9]{1,18}$") & F.coalesce(z.rlike(r"^[0-9]{1,18}$"), F.lit(False))
    zero = F.lit(0).cast("long")
    return F.when(fine, F.struct(a.cast("long").alias("first_page"), z.cast("long").alias("last_page"))).otherwise(F.struct(zero.alias("first_page"), zero.alias("last_page")))


def image_name(number: Column, place: Column) -> Column:
    return F.format_string("%04d-%03d.png", number, place)


def target_dpi(current_kb: Column, current_dpi: Column, target_kb: float = 148.0, least: float = 100.0) -> Column:
    """The resolution that brings a page of ``current_kb`` to the target: size goes by the square, none is enlarged."""
    return F.when(current_kb <= target_kb, current_dpi).otherwise(F.greatest(F.lit(least), current_dpi * F.sqrt(target_kb / current_kb)))


def is_reporter(name: Column, wanted: str = "sct") -> Column:
    return F.replace(F.lower(name), F.lit("-"), F.lit("")) == wanted
