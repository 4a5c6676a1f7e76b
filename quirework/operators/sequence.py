"""Quality of a volume's page-number sequence.

Readings: doc_id, pdf_page (from 1), detected, type (single, range or null), score. Expected
ranges: doc_id, exp_start, exp_end, either null where unknown. A volume is one window; its
order is pdf_page. Nothing here depends on more than one volume at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions import expressions as E
from quirework.functions.session import staged

# The texts of the issues.
MISLABELED = "Filename suggests pages %d–%d but page numbers only go up to %d. Document may be mislabeled or missing a large section."
JUMP = "Large jump from page %d to %d (%d pages) , likely an OCR misread. Correct the page number and recalculate."
IN_GAP = "Page %d appears missing (gap between %d and %d)."
TWICE = "Page number %d appears on both PDF page %d and %d."
BACKWARD = "Page %d (PDF page %d) goes backward from %d (PDF page %d)."
SUSPICIOUS = "PDF page %d detected as '%s' which is outside the expected page range, likely a stray number."
UNREAD = "No page number detected on PDF page %d."
SEVERAL = "Page number %d found on PDF pages [%s]."
RANGE = "PDF page %d covers page range %s. Verify this is expected."
LARGE_GAP = "Large gap: pages %d–%d (%d pages) not found, likely an OCR misread rather than genuinely missing pages."
MISSING = "Page %d is missing from the document."
CORRECTED = "PDF page %d: OCR read '%s', auto-corrected to '%s' based on surrounding page numbers. Verify this is correct."


def _volume():
    return Window.partitionBy("doc_id").orderBy("pdf_page")


SLACK = 5


def _number() -> Column:
    single = F.col("detected").isNotNull() & (F.coalesce(F.col("type"), F.lit("")) != "range")
    return F.when(single, F.expr("try_cast(detected AS BIGINT)"))


def with_expected(readings: DataFrame, expected: DataFrame | None) -> DataFrame:
    """Adds exp_start and exp_end, both null where a volume's range is not fully known, num and out_of_range."""
    if expected is None:
        d = readings.withColumns({"exp_start": F.lit(None).cast("long"), "exp_end": F.lit(None).cast("long")})
    else:
        d = readings.join(expected.select("doc_id", F.col("exp_start").cast("long"), F.col("exp_end").cast("long")), "doc_id", "left")
    return _judged(d)


def _judged(d: DataFrame) -> DataFrame:
    known = F.col("exp_start").isNotNull() & F.col("exp_end").isNotNull()
    d = d.withColumn("num", _number())
    far = known & ((F.col("num") < F.col("exp_start") - SLACK) | (F.col("num") > F.col("exp_end") + SLACK))
    return d.withColumn("out_of_range", F.coalesce((F.col("num") < 1) | far, F.lit(False)))


def auto_correct(d: DataFrame) -> DataFrame:
    """Readings out of range are set right by the most frequent offset from what their neighbours lead to expect.

    Takes and returns ``with_expected``'s columns, with old (the reading before, null if kept).
    The offset must be that of at least half of a volume's readings out of range, and not
    zero; of equally frequent ones the first in page order counts.
    """
    good = F.when(F.col("num").isNotNull() & ~F.col("out_of_range"), F.struct("pdf_page", "num"))
    before, after = _volume().rowsBetween(Window.unboundedPreceding, -1), _volume().rowsBetween(1, Window.unboundedFollowing)
    near = d.withColumns({"b": F.last(good, ignorenulls=True).over(before), "a": F.first(good, ignorenulls=True).over(after)})
    pages_between = F.greatest(F.col("a.pdf_page") - F.col("b.pdf_page"), F.lit(1))
    both = F.bround(F.col("b.num") + (F.col("a.num") - F.col("b.num")) / pages_between * (F.col("pdf_page") - F.col("b.pdf_page")), 0).cast("long")
    expected = F.when(F.col("b").isNotNull() & F.col("a").isNotNull(), both).when(F.col("b").isNotNull(), F.col("b.num") + (F.col("pdf_page") - F.col("b.pdf_page"))).when(F.col("a").isNotNull(), F.col("a.num") - (F.col("a.pdf_page") - F.col("pdf_page")))
    # Staged, so that the windows over a volume are not run again for the counts beside the rows.
    off = staged(near.withColumn("offset", F.when(F.col("out_of_range"), expected - F.col("num"))).drop("a", "b"), "reading-offsets")
    counts = off.where("offset IS NOT NULL").groupBy("doc_id", "offset").agg(F.count("*").alias("n"), F.min("pdf_page").alias("first"))
    modal = counts.groupBy("doc_id").agg(F.sum("n").alias("total"), F.min(F.struct((-F.col("n")).alias("o"), "first", "offset", "n")).alias("m")).where((F.col("m.n") >= F.col("total") * 0.5) & (F.col("m.offset") != 0)).select("doc_id", F.col("m.offset").alias("modal"))
    fixed = off.join(modal, "doc_id", "left")
    hit = F.coalesce(F.col("offset") == F.col("modal"), F.lit(False))
    return fixed.select(*[c for c in d.columns if c not in ("detected", "num", "out_of_range")], F.when(hit, F.col("detected")).alias("old"), F.when(hit, (F.col("num") + F.col("modal")).cast("string")).otherwise(F.col("detected")).alias("detected"))


def expected_numbers(d: DataFrame) -> DataFrame:
    """What the neighbours of every reading out of range lead to expect: doc_id, pdf_page, num, expected."""
    good = F.when(F.col("num").isNotNull() & ~F.col("out_of_range"), F.struct("pdf_page", "num"))
    before, after = _volume().rowsBetween(Window.unboundedPreceding, -1), _volume().rowsBetween(1, Window.unboundedFollowing)
    near = d.withColumns({"b": F.last(good, ignorenulls=True).over(before), "a": F.first(good, ignorenulls=True).over(after)}).where("out_of_range")
    both = F.bround(F.col("b.num") + (F.col("a.num") - F.col("b.num")) / F.greatest(F.col("a.pdf_page") - F.col("b.pdf_page"), F.lit(1)) * (F.col("pdf_page") - F.col("b.pdf_page")), 0).cast("long")
    expected = F.when(F.col("b").isNotNull() & F.col("a").isNotNull(), both).when(F.col("b").isNotNull(), F.col("b.num") + F.col("pdf_page") - F.col("b.pdf_page")).otherwise(F.col("a.num") - F.col("a.pdf_page") + F.col("pdf_page"))
    return near.select("doc_id", "pdf_page", "num", F.col("b.num").alias("before"), F.col("a.num").alias("after"), expected.alias("expected"))


def sequence_issues(d: DataFrame) -> DataFrame:
    """DUPLICATE, BACKWARD and GAP rows between neighbours: doc_id, pdf_page, issue, num, prev_pdf, prev_num.

    Pages without a reading and ranges start anew; readings out of range are passed over. A
    step of two is no gap here: the page between counts as missing elsewhere.
    """
    reset = F.col("detected").isNull() | (F.coalesce(F.col("type"), F.lit("")) == "range")
    d = d.withColumn("island", F.sum(F.when(reset, 1).otherwise(0)).over(_volume())).where("num IS NOT NULL AND NOT out_of_range")
    by = Window.partitionBy("doc_id", "island").orderBy("pdf_page")
    d = d.withColumns({"prev_num": F.lag("num").over(by), "prev_pdf": F.lag("pdf_page").over(by)})
    step = F.col("num") - F.col("prev_num")
    issue = F.when(step == 0, "DUPLICATE").when(step < 0, "BACKWARD").when(step > 2, "GAP")
    return d.withColumn("issue", issue).where("issue IS NOT NULL").select("doc_id", "pdf_page", "issue", "num", "prev_pdf", "prev_num")


def range_pages(readings: DataFrame) -> DataFrame:
    """Pages covered by range readings: doc_id, pdf_page, page. A range that runs backwards covers none."""
    first, last = E.range_bounds(F.col("detected"))
    d = readings.where("type = 'range'").select("doc_id", "pdf_page", first.alias("a"), last.alias("z")).where("a <= z")
    return d.select("doc_id", "pdf_page", F.explode(F.sequence("a", "z")).alias("page"))


def missing_pages(d: DataFrame) -> DataFrame:
    """Numbers of the expected range, or between the lowest and highest reading where none is known, that nothing shows: doc_id, page."""
    return missing_runs(d).select("doc_id", F.explode(F.sequence("first", "last")).alias("page"))


def missing_runs(d: DataFrame) -> DataFrame:
    """``missing_pages`` as runs of consecutive numbers: doc_id, first, last, n.

    They are what lies between the readings of a volume in order of their numbers, so only
    readings are sorted and no number is written out: one shuffle, one sort.
    """
    fine = F.when(F.col("num").isNotNull() & ~F.col("out_of_range"), F.col("num"))
    a, z = E.range_bounds(F.col("detected"))
    ranged = (F.col("type") == "range") & (a <= z)
    shown = d.select("doc_id", "exp_start", "exp_end", fine.alias("fine"), F.coalesce(fine, F.when(ranged, a)).alias("s"), F.coalesce(fine, F.when(ranged, z)).alias("e")).where("s IS NOT NULL")
    by = Window.partitionBy("doc_id").orderBy("s", "e")
    shown = shown.withColumns({"before": F.lag("s").over(by), "next": F.lead("s").over(by), "reach": F.max("e").over(by.rowsBetween(Window.unboundedPreceding, 0))})
    whole, known = Window.partitionBy("doc_id"), F.col("exp_start").isNotNull() & F.col("exp_end").isNotNull()
    shown = shown.withColumns({"lo": F.min("fine").over(whole), "hi": F.max("fine").over(whole), "n_fine": F.count("fine").over(whole)}).where("n_fine > 0")
    shown = shown.withColumns({"lo": F.greatest(F.when(known, F.col("exp_start")).otherwise(F.col("lo")), F.lit(1)), "hi": F.when(known, F.col("exp_end")).otherwise(F.col("hi"))})
    within = lambda c: F.least(F.greatest(c, F.col("lo") - 1), F.col("hi") + 1)
    run = lambda first, last: F.struct(first.alias("first"), last.alias("last"))
    ahead = F.when(F.col("before").isNull(), run(F.col("lo"), within(F.col("s")) - 1))
    behind = run(within(F.col("reach")) + 1, within(F.coalesce("next", F.col("hi") + 1)) - 1)
    runs = shown.select("doc_id", F.explode(F.filter(F.array_compact(F.array(ahead, behind)), lambda r: r["first"] <= r["last"])).alias("r"))
    return runs.select("doc_id", "r.first", "r.last", (F.col("r.last") - F.col("r.first") + 1).alias("n"))


def page_runs(pages: DataFrame, column: str = "page") -> DataFrame:
    """Consecutive numbers as runs: doc_id, first, last, n."""
    by = Window.partitionBy("doc_id").orderBy(column)
    return pages.withColumn("g", F.col(column) - F.row_number().over(by)).groupBy("doc_id", "g").agg(F.min(column).alias("first"), F.max(column).alias("last"), F.count("*").alias("n")).drop("g")


def duplicate_numbers(d: DataFrame) -> DataFrame:
    """Numbers read on several pages, with those pages in order."""
    seen = d.where("num IS NOT NULL AND NOT out_of_range")
    return seen.groupBy("doc_id", "num").agg(F.sort_array(F.collect_list("pdf_page")).alias("pdf_pages")).where(F.size("pdf_pages") > 1)


def page_map(d: DataFrame, missing: DataFrame) -> DataFrame:
    """The volume's pages in viewing order with placeholders for missing ones: doc_id, ord, kind, pdf_index, logical_number, range_label, duplicate.

    A placeholder stands before the first page that has a higher number and is no duplicate,
    else at the end. Ranges do not make later pages duplicates.
    """
    is_range = F.col("detected").isNotNull() & (F.col("type") == "range")
    logical = F.when(~F.col("out_of_range") & (F.col("type") == "single"), F.col("num"))
    m = d.select("doc_id", "pdf_page", F.coalesce(logical, F.col("pdf_page")).alias("logical_number"), F.when(is_range, F.col("detected")).alias("range_label"))
    first = Window.partitionBy("doc_id", "logical_number", F.col("range_label").isNull()).orderBy("pdf_page")
    m = m.withColumn("duplicate", F.col("range_label").isNull() & (F.row_number().over(first) > 1))
    order = F.row_number().over(_volume()).cast("long")
    m = m.withColumn("pos", order)
    ends = m.groupBy("doc_id").agg((F.max("pos") + 1).alias("end"))
    # One order of all numbers, highest first: the least place seen so far among the higher ones.
    higher = Window.partitionBy("doc_id").orderBy(F.col("number").desc()).rangeBetween(Window.unboundedPreceding, -1)
    numbers = m.select("doc_id", F.col("logical_number").alias("number"), F.when(~F.col("duplicate"), F.col("pos")).alias("pos"), F.lit(False).alias("gap"))
    gaps = missing.select("doc_id", F.col("page").alias("number"), F.lit(None).cast("long").alias("pos"), F.lit(True).alias("gap"))
    ahead = numbers.unionByName(gaps).withColumn("ahead", F.min("pos").over(higher)).where("gap")
    place = ahead.join(ends, "doc_id").select("doc_id", F.coalesce("ahead", "end").alias("pos"), F.col("number").alias("page"))
    both = m.select("doc_id", "pos", F.lit(1).alias("k"), F.lit("pdf_page").alias("kind"), (F.col("pdf_page") - 1).alias("pdf_index"), "logical_number", "range_label", "duplicate").unionByName(
        place.select("doc_id", "pos", F.lit(0).alias("k"), F.lit("missing").alias("kind"), F.lit(None).cast("long").alias("pdf_index"), F.col("page").alias("logical_number"), F.lit(None).cast("string").alias("range_label"), F.lit(False).alias("duplicate")))
    by = Window.partitionBy("doc_id").orderBy("pos", "k", "logical_number")
    return both.select("doc_id", F.row_number().over(by).cast("long").alias("ord"), "kind", "pdf_index", "logical_number", "range_label", "duplicate")


def real_missing(missing: DataFrame, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Single missing pages, and runs of over ``most`` of them, which point at a misreading rather."""
    return split_runs(page_runs(missing), most)


def split_runs(runs: DataFrame, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """The same of missing pages that are runs already."""
    return runs.where(F.col("n") <= most).select("doc_id", F.explode(F.sequence("first", "last")).alias("page")), runs.where(F.col("n") > most)


def mislabeled(d: DataFrame) -> DataFrame:
    """Volumes whose highest reading stays far below the expected end: doc_id, exp_start, exp_end, highest."""
    fine = F.when(F.col("num").isNotNull() & ~F.col("out_of_range"), F.col("num"))
    g = d.where("exp_start IS NOT NULL AND exp_end IS NOT NULL").groupBy("doc_id").agg(F.first("exp_start").alias("exp_start"), F.first("exp_end").alias("exp_end"), F.max(fine).alias("highest"))
    return g.where(F.col("highest") < F.col("exp_end") - F.greatest(F.lit(10.0), (F.col("exp_end") - F.col("exp_start") + 1) * 0.1))


def reader_stats(readings: DataFrame) -> DataFrame:
    return readings.groupBy("doc_id").agg(F.count("*").alias("total"), F.count("detected").alias("detected"), F.count(F.when(F.col("detected").isNull(), 1)).alias("not_detected"), F.count(F.when(F.col("type") == "range", 1)).alias("ranges"))


def issues(d: DataFrame, corrections: DataFrame | None = None, structural: DataFrame | None = None) -> DataFrame:
    """Every issue of every volume: doc_id, ord (order of the kinds), spot and sub (order within them), page_number, check_name, severity, message."""
    text = lambda form, *cols: F.format_string(form, *cols)
    row = lambda df, order, number, name, severity, message, at="pdf_page", sub=None: df.select("doc_id", F.lit(order).cast("long").alias("ord"), (F.col(at) if at else F.lit(0)).cast("long").alias("spot"), (F.col(sub) if sub else F.lit(0)).cast("long").alias("sub"), number.cast("long").alias("page_number"), F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), message.alias("message"))
    seq = sequence_issues(d)
    gaps = seq.where("issue = 'GAP'").withColumn("n", F.col("num") - F.col("prev_num") - 1)
    parts = [row(mislabeled(d), 1, F.lit(None), "mislabeled_document", "warning", text(MISLABELED, "exp_start", "exp_end", "highest"), at=None)]
    parts.append(row(gaps.where("n > 6"), 2, F.col("prev_num"), "large_gap", "warning", text(JUMP, "prev_num", "num", "n")))
    in_gap = gaps.where("n <= 6").withColumn("page", F.explode(F.sequence(F.col("prev_num") + 1, F.col("num") - 1))).where("page >= 1")
    parts.append(row(in_gap, 2, F.col("page"), "missing_page", "error", text(IN_GAP, "page", "prev_num", "num"), sub="page"))
    twice = seq.where("issue = 'DUPLICATE'")
    parts.append(row(twice, 2, F.col("num"), "duplicate_page", "warning", text(TWICE, "num", "prev_pdf", "pdf_page")))
    parts.append(row(seq.where("issue = 'BACKWARD'"), 2, F.col("num"), "backward_page", "warning", text(BACKWARD, "num", "pdf_page", "prev_num", "prev_pdf")))
    parts.append(row(d.where("out_of_range"), 3, F.col("pdf_page"), "suspicious_reading", "warning", text(SUSPICIOUS, "pdf_page", "detected")))
    parts.append(row(d.where("detected IS NULL"), 4, F.col("pdf_page"), "no_page_number", "info", text(UNREAD, "pdf_page")))
    dup = duplicate_numbers(d).join(twice.select("doc_id", "num").distinct(), ["doc_id", "num"], "left_anti").withColumn("first", F.get("pdf_pages", F.lit(0)))
    parts.append(row(dup, 5, F.col("num"), "duplicate_page", "warning", text(SEVERAL, F.col("num"), F.array_join("pdf_pages", ", ")), at="first"))
    first, _ = E.range_bounds(F.col("detected"))
    parts.append(row(d.where("type = 'range'").withColumn("a", first).where("a IS NOT NULL"), 6, F.col("a"), "page_range", "warning", text(RANGE, "pdf_page", "detected")))
    single, large = split_runs(missing_runs(d))
    flagged = in_gap.select("doc_id", "page").distinct()
    parts.append(row(large.withColumnRenamed("first", "page").join(flagged, ["doc_id", "page"], "left_anti"), 7, F.col("page"), "large_gap", "warning", text(LARGE_GAP, "page", "last", "n"), at="page"))
    parts.append(row(single.join(flagged, ["doc_id", "page"], "left_anti"), 7, F.col("page"), "missing_page", "error", text(MISSING, "page"), at="page"))
    if corrections is not None:
        parts.append(row(corrections.where("old IS NOT NULL"), 8, F.col("pdf_page"), "auto_corrected", "warning", text(CORRECTED, "pdf_page", "old", "detected")))
    if structural is not None:
        parts.append(structural.select("doc_id", F.lit(0).cast("long").alias("ord"), F.col("page_number").cast("long").alias("spot"), (F.col("check_name") != "blank_page").cast("long").alias("sub"), F.col("page_number").cast("long").alias("page_number"), "check_name", "severity", "message"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def report(d: DataFrame, corrections: DataFrame, found: DataFrame, most_infos: int = 10) -> DataFrame:
    """The lines that tell a volume's reader what was found: doc_id, section, place, line.

    Sections: 1 size, 2 corrections, 3 errors, 4 warnings, 5 infos (the first ``most_infos``, and how
    many more), 6 missing pages as ranges, 7 where there are neither errors nor warnings.
    """
    line = lambda df, section, place, text: df.select("doc_id", F.lit(section).cast("long").alias("section"), place.cast("long").alias("place"), text.alias("line"))
    headed = lambda df, section, form, *group: line(df.groupBy("doc_id").agg(F.count("*").alias("n")), section, F.lit(0), F.format_string(form, "n"))
    parts = [line(d.groupBy("doc_id").agg(F.count("*").alias("n")), 1, F.lit(0), F.format_string("%d pages in PDF", "n"))]
    fixed = corrections.where("old IS NOT NULL")
    parts += [headed(fixed, 2, "Auto-corrections (%d):"), line(fixed, 2, F.col("pdf_page"), F.format_string("  PDF page %d: %s → %s", "pdf_page", "old", "detected"))]
    by = Window.partitionBy("doc_id", "severity").orderBy("ord", "spot", "sub", "page_number", "message")
    told = found.withColumn("place", F.row_number().over(by))
    page = F.when(F.coalesce("page_number", F.lit(0)) != 0, F.concat(F.lit("p."), F.col("page_number").cast("string"))).otherwise(F.lit("doc"))
    text = F.concat(F.lit("  ["), page, F.lit("] "), F.col("message"))
    for section, severity, head in ((3, "error", "Errors (%d):"), (4, "warning", "Warnings (%d):"), (5, "info", "Info (%d):")):
        own = told.where(F.col("severity") == severity)
        parts += [headed(own, section, head), line(own if severity != "info" else own.where(F.col("place") <= most_infos), section, F.col("place"), text)]
    more = told.where("severity = 'info'").groupBy("doc_id").agg((F.count("*") - most_infos).alias("n")).where("n > 0")
    parts.append(line(more, 5, F.lit(most_infos + 1), F.format_string("  ... and %d more", "n")))
    runs = missing_runs(d).where("n <= 6")
    a, z = F.col("first").cast("string"), F.col("last").cast("string")
    span = F.when(F.col("first") == F.col("last"), F.concat(F.lit("  #"), a)).otherwise(F.concat(F.lit("  #"), a, F.lit("-"), z, F.lit(" ("), F.col("n").cast("string"), F.lit(" pages)")))
    parts += [line(runs.groupBy("doc_id").agg(F.sum("n").alias("n")), 6, F.lit(0), F.format_string("Missing pages (%d):", "n")), line(runs, 6, F.col("first"), span)]
    clear = d.select("doc_id").distinct().join(found.where("severity IN ('error', 'warning')").select("doc_id").distinct(), "doc_id", "left_anti")
    parts.append(line(clear, 7, F.lit(0), F.lit("All clear — no issues found.")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def validate(readings: DataFrame, expected: DataFrame | None = None, correct: bool = True) -> tuple[DataFrame, DataFrame]:
    """Readings checked against their expected range, set right if ``correct`` and then staged; and the corrections made."""
    d = with_expected(readings, expected)
    if not correct:
        return d, d.withColumn("old", F.lit(None).cast("string")).where(F.lit(False))
    fixed = auto_correct(d)
    again = staged(_judged(fixed.select("doc_id", "pdf_page", "detected", "type", "score", "old", "exp_start", "exp_end")), "checked-readings")
    return again.drop("old"), again.where("old IS NOT NULL")
