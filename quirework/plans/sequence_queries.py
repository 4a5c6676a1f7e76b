"""Queries on page-number readings, sequences and issues."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirework.functions import expressions as E
from quirework.operators import grouped, readings as R, sequence as S
from quirework.plans.common import query


def expected(v):
    """Two of three volumes have a known range; that of every seventh goes far beyond the pages there are."""
    known = F.col("doc_id") % 3 != 0
    return v.readings.groupBy("doc_id").agg(F.max("pdf_page").alias("n")).select("doc_id", F.when(known, F.lit(1).cast("long")).alias("exp_start"), F.when(known, F.when(F.col("doc_id") % 7 == 1, 2 * F.col("n")).otherwise(F.col("n"))).alias("exp_end"))


def checked(v):
    return S.validate(v.readings, expected(v))[0]


@query("f14_out_of_range", "SELECT doc_id, pdf_page, num, oor AS out_of_range FROM sq")
def _(v):
    return S.with_expected(v.readings, expected(v)).select("doc_id", "pdf_page", "num", "out_of_range")


@query("j10_expected_numbers", "SELECT doc_id, pdf_page, num, bn AS before, an AS after, expected FROM ex WHERE oor")
def _(v):
    return S.expected_numbers(S.with_expected(v.readings, expected(v)))


@query("j17_auto_corrected", "SELECT doc_id, pdf_page, detected, old FROM fx")
def _(v):
    return S.auto_correct(S.with_expected(v.readings, expected(v))).select("doc_id", "pdf_page", "detected", "old")


@query("w1_sequence_issues", "SELECT * FROM sqi")
def _(v):
    return S.sequence_issues(checked(v))


@query("x8_range_pages", "SELECT * FROM rgp")
def _(v):
    return S.range_pages(checked(v))


@query("j9_missing_pages", "SELECT * FROM mis")
def _(v):
    return S.missing_pages(checked(v))


@query("w3_missing_runs", "SELECT DISTINCT doc_id, first, last, n FROM misr")
def _(v):
    return S.missing_runs(checked(v))


@query("a9_duplicate_numbers", "SELECT doc_id, num, array_to_string(list(pdf_page ORDER BY pdf_page), ',') AS pdf_pages FROM vd WHERE num IS NOT NULL AND NOT oor GROUP BY doc_id, num HAVING count(*) > 1")
def _(v):
    return S.duplicate_numbers(checked(v)).withColumn("pdf_pages", F.array_join(F.col("pdf_pages").cast("array<string>"), ","))


@query("a12_distinct_numbers", "SELECT DISTINCT doc_id, num FROM vd WHERE num IS NOT NULL AND NOT oor")
def _(v):
    return checked(v).where("num IS NOT NULL AND NOT out_of_range").select("doc_id", "num").distinct()


@query("f19_mislabeled", "SELECT * FROM (SELECT doc_id, any_value(exp_start) AS exp_start, any_value(exp_end) AS exp_end, max(CASE WHEN NOT oor THEN num END) AS highest FROM vd WHERE exp_start IS NOT NULL GROUP BY doc_id) m WHERE highest < exp_end - greatest(10, (exp_end - exp_start + 1) * 0.1)")
def _(v):
    return S.mislabeled(checked(v))


@query("a17_reader_stats", "SELECT doc_id, count(*) AS total, count(detected) AS detected, count(*) - count(detected) AS not_detected, count(CASE WHEN type = 'range' THEN 1 END) AS ranges FROM rd GROUP BY doc_id")
def _(v):
    return S.reader_stats(v.readings)


@query("j12_page_map", """SELECT * FROM (WITH m AS (SELECT doc_id, pdf_page, row_number() OVER (PARTITION BY doc_id ORDER BY pdf_page) AS pos, CASE WHEN detected IS NOT NULL AND type = 'range' THEN detected END AS range_label,
      CASE WHEN NOT oor AND type = 'single' AND num IS NOT NULL THEN num ELSE pdf_page END AS logical FROM vd),
    m2 AS (SELECT *, range_label IS NULL AND EXISTS (SELECT 1 FROM m e WHERE e.doc_id = m.doc_id AND e.logical = m.logical AND e.range_label IS NULL AND e.pos < m.pos) AS dup FROM m),
    g AS (SELECT doc_id, page, coalesce((SELECT min(pos) FROM m2 WHERE m2.doc_id = misr.doc_id AND logical > page AND NOT dup), (SELECT max(pos) + 1 FROM m2 WHERE m2.doc_id = misr.doc_id)) AS pos FROM misr WHERE n <= 6),
    a AS (SELECT doc_id, pos, 1 AS k, 'pdf_page' AS kind, pdf_page - 1 AS pdf_index, logical AS logical_number, range_label, dup AS duplicate FROM m2 UNION ALL SELECT doc_id, pos, 0, 'missing', NULL, page, NULL, false FROM g)
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos, k, logical_number) AS ord, kind, pdf_index, logical_number, range_label, duplicate FROM a) q""")
def _(v):
    d = checked(v)
    return S.page_map(d, S.split_runs(S.missing_runs(d))[0])


@query("w2_duplicate_flags", """SELECT doc_id, pdf_page, row_number() OVER (PARTITION BY doc_id, num ORDER BY pdf_page) > 1 AS seen_before FROM vd WHERE num IS NOT NULL AND NOT oor""")
def _(v):
    d = checked(v).where("num IS NOT NULL AND NOT out_of_range")
    return d.select("doc_id", "pdf_page", F.expr("row_number() OVER (PARTITION BY doc_id, num ORDER BY pdf_page) > 1").alias("seen_before"))


_ISSUES = r"""
    SELECT doc_id, 1 AS ord, 0 AS spot, 0 AS sub, NULL::BIGINT AS page_number, 'mislabeled_document' AS check_name, 'warning' AS severity, printf('Filename suggests pages %d–%d but page numbers only go up to %d. Document may be mislabeled or missing a large section.', exp_start, exp_end, highest) AS message
      FROM (SELECT doc_id, any_value(exp_start) AS exp_start, any_value(exp_end) AS exp_end, max(CASE WHEN NOT oor THEN num END) AS highest FROM vd WHERE exp_start IS NOT NULL GROUP BY doc_id) m WHERE highest < exp_end - greatest(10, (exp_end - exp_start + 1) * 0.1)
    UNION ALL SELECT doc_id, 2, pdf_page, 0, prev_num, 'large_gap', 'warning', printf('Large jump from page %d to %d (%d pages) , likely an OCR misread. Correct the page number and recalculate.', prev_num, num, num - prev_num - 1) FROM sqi WHERE issue = 'GAP' AND num - prev_num - 1 > 6
    UNION ALL SELECT doc_id, 2, pdf_page, page, page, 'missing_page', 'error', printf('Page %d appears missing (gap between %d and %d).', page, prev_num, num) FROM (SELECT *, unnest(generate_series(prev_num + 1, num - 1)) AS page FROM sqi WHERE issue = 'GAP' AND num - prev_num - 1 <= 6) g WHERE page >= 1
    UNION ALL SELECT doc_id, 2, pdf_page, 0, num, 'duplicate_page', 'warning', printf('Page number %d appears on both PDF page %d and %d.', num, prev_pdf, pdf_page) FROM sqi WHERE issue = 'DUPLICATE'
    UNION ALL SELECT doc_id, 2, pdf_page, 0, num, 'backward_page', 'warning', printf('Page %d (PDF page %d) goes backward from %d (PDF page %d).', num, pdf_page, prev_num, prev_pdf) FROM sqi WHERE issue = 'BACKWARD'
    UNION ALL SELECT doc_id, 3, pdf_page, 0, pdf_page, 'suspicious_reading', 'warning', printf('PDF page %d detected as ''%s'' which is outside the expected page range, likely a stray number.', pdf_page, detected) FROM vd WHERE oor
    UNION ALL SELECT doc_id, 4, pdf_page, 0, pdf_page, 'no_page_number', 'info', printf('No page number detected on PDF page %d.', pdf_page) FROM vd WHERE detected IS NULL
    UNION ALL SELECT doc_id, 5, min(pdf_page), 0, num, 'duplicate_page', 'warning', printf('Page number %d found on PDF pages [%s].', num, array_to_string(list(pdf_page ORDER BY pdf_page), ', ')) FROM vd WHERE num IS NOT NULL AND NOT oor AND NOT EXISTS (SELECT 1 FROM sqi s WHERE s.doc_id = vd.doc_id AND s.num = vd.num AND issue = 'DUPLICATE') GROUP BY doc_id, num HAVING count(*) > 1
    UNION ALL SELECT rgb.doc_id, 6, rgb.pdf_page, 0, a, 'page_range', 'warning', printf('PDF page %d covers page range %s. Verify this is expected.', rgb.pdf_page, detected) FROM rgb JOIN vd ON vd.doc_id = rgb.doc_id AND vd.pdf_page = rgb.pdf_page
    UNION ALL SELECT DISTINCT doc_id, 7, first, 0, first, 'large_gap', 'warning', printf('Large gap: pages %d–%d (%d pages) not found, likely an OCR misread rather than genuinely missing pages.', first, last, n) FROM misr WHERE n > 6 AND (doc_id, first) NOT IN (SELECT (doc_id, page) FROM gapp WHERE page >= 1)
    UNION ALL SELECT doc_id, 7, page, 0, page, 'missing_page', 'error', printf('Page %d is missing from the document.', page) FROM misr WHERE n <= 6 AND (doc_id, page) NOT IN (SELECT (doc_id, page) FROM gapp WHERE page >= 1)
    UNION ALL SELECT doc_id, 8, pdf_page, 0, pdf_page, 'auto_corrected', 'warning', printf('PDF page %d: OCR read ''%s'', auto-corrected to ''%s'' based on surrounding page numbers. Verify this is correct.', pdf_page, old, detected) FROM fx WHERE old IS NOT NULL"""


@query("u5_issues", f"SELECT doc_id, ord::BIGINT AS ord, spot::BIGINT AS spot, sub::BIGINT AS sub, page_number, check_name, severity, message FROM ({_ISSUES}) i")
def _(v):
    d, corrections = S.validate(v.readings, expected(v))
    return S.issues(d, corrections)


_REPORT = f"""SELECT * FROM (WITH i AS ({_ISSUES}), t AS (SELECT *, row_number() OVER (PARTITION BY doc_id, severity ORDER BY ord, spot, sub, page_number, message) AS place FROM i),
    m AS (SELECT * FROM misr WHERE n <= 6),
    l AS (SELECT doc_id, 1 AS section, 0 AS place, count(*) || ' pages in PDF' AS line FROM vd GROUP BY doc_id
    UNION ALL SELECT doc_id, 2, 0, 'Auto-corrections (' || count(*) || '):' FROM fx WHERE old IS NOT NULL GROUP BY doc_id
    UNION ALL SELECT doc_id, 2, pdf_page, '  PDF page ' || pdf_page || ': ' || old || ' → ' || detected FROM fx WHERE old IS NOT NULL
    UNION ALL SELECT doc_id, CASE severity WHEN 'error' THEN 3 WHEN 'warning' THEN 4 ELSE 5 END, 0, CASE severity WHEN 'error' THEN 'Errors (' WHEN 'warning' THEN 'Warnings (' ELSE 'Info (' END || count(*) || '):' FROM t GROUP BY doc_id, severity
    UNION ALL SELECT doc_id, CASE severity WHEN 'error' THEN 3 WHEN 'warning' THEN 4 ELSE 5 END, place, '  [' || CASE WHEN coalesce(page_number, 0) <> 0 THEN 'p.' || page_number ELSE 'doc' END || '] ' || message FROM t WHERE severity <> 'info' OR place <= 10
    UNION ALL SELECT doc_id, 5, 11, '  ... and ' || (count(*) - 10) || ' more' FROM t WHERE severity = 'info' GROUP BY doc_id HAVING count(*) > 10
    UNION ALL SELECT doc_id, 6, 0, 'Missing pages (' || count(*) || '):' FROM m GROUP BY doc_id
    UNION ALL SELECT DISTINCT doc_id, 6, first, '  #' || CASE WHEN first = last THEN CAST(first AS VARCHAR) ELSE first || '-' || last || ' (' || n || ' pages)' END FROM m
    UNION ALL SELECT DISTINCT doc_id, 7, 0, 'All clear — no issues found.' FROM vd WHERE doc_id NOT IN (SELECT doc_id FROM i WHERE severity <> 'info'))
    SELECT doc_id, section::BIGINT AS section, place::BIGINT AS place, line FROM l) q"""


@query("snk24_report", _REPORT)
def _(v):
    d, corrections = S.validate(v.readings, expected(v))
    return S.report(d, corrections, S.issues(d, corrections))


@query("o6_first_infos", f"SELECT * FROM ({_REPORT}) r WHERE section = 5 AND place > 0")
def _(v):
    d, corrections = S.validate(v.readings, expected(v))
    return S.report(d, corrections, S.issues(d, corrections)).where("section = 5 AND place > 0")


@query("a16_issues_by_severity", f"SELECT doc_id, severity, count(*) AS n FROM ({_ISSUES}) i GROUP BY ALL")
def _(v):
    d, corrections = S.validate(v.readings, expected(v))
    return S.issues(d, corrections).groupBy("doc_id", "severity").agg(F.count("*").alias("n"))


@query("x1_classified_texts", "SELECT event_id, text, type FROM ct WHERE text IS NOT NULL")
def _(v):
    return R.classified(v.candidates).select("event_id", "text", "type")


_PARSED = r"""SELECT event_id, doc_id, page_no, seq, raw_text, CASE WHEN b > a AND b - a <= 2 THEN a WHEN d <> '' THEN CAST(d AS BIGINT) END AS first, CASE WHEN b > a AND b - a <= 2 THEN b END AS last
    FROM (SELECT *, TRY_CAST(regexp_extract(trim(raw_text), '^([0-9]{1,9})\s*[-–,]\s*([0-9]{1,9})$', 1) AS BIGINT) AS a, TRY_CAST(regexp_extract(trim(raw_text), '^([0-9]{1,9})\s*[-–,]\s*([0-9]{1,9})$', 2) AS BIGINT) AS b, regexp_replace(raw_text, '[^0-9]', '', 'g') AS d FROM cand) p"""


@query("x2_parsed_ranges", f"SELECT event_id, first, last FROM ({_PARSED}) x WHERE first IS NOT NULL")
def _(v):
    parsed = E.parse_page_range(F.col("raw_text"))
    d = v.candidates.select("event_id", parsed.alias("p")).where("p IS NOT NULL")
    return d.select("event_id", F.get("p", F.lit(0)).alias("first"), F.get("p", F.lit(1)).alias("last"))


@query("x5_scan_outcomes", "SELECT event_id, text, CASE WHEN text IS NOT NULL THEN 'hit' WHEN regexp_matches(raw_text, '[0-9]') THEN 'near_miss' ELSE 'none' END AS outcome FROM ct")
def _(v):
    return R.scan_hits(v.candidates).select("event_id", "text", "outcome")


@query("f11_positioned", "SELECT event_id, text FROM posn")
def _(v):
    return R.positioned(R.classified(v.candidates)).select("event_id", "text")


_POOL = """SELECT * FROM (SELECT *, bool_or(score >= 0.8) OVER (PARTITION BY doc_id, page_no) AS any_good FROM (SELECT *, bool_or(ok) OVER (PARTITION BY doc_id, page_no) AS any_ok FROM posn {where}) a WHERE ok OR NOT any_ok) b WHERE score >= 0.8 OR NOT any_good"""


@query("f12_candidate_pool", f"SELECT event_id, text FROM ({_POOL.format(where='')}) p")
def _(v):
    return R.pool(R.classified(v.candidates), expected(v)).select("event_id", "text")


_BEST = "SELECT doc_id, page_no, arg_min(text, (-score, seq)) AS text, arg_min(type, (-score, seq)) AS type, arg_min(score, (-score, seq)) AS score, arg_min(zone, (-score, seq)) AS zone, arg_min(ocr, (-score, seq)) AS ocr FROM ({pool}) p GROUP BY doc_id, page_no"


def _best(where: str = "") -> str:
    return _BEST.format(pool=_POOL.format(where=where))


@query("w10_best_reading", _best())
def _(v):
    return R.best_reading(R.classified(v.candidates), expected(v))


@query("x4_first_valid_backend", """SELECT doc_id, page_no, arg_min(text, (r, seq)) AS text, arg_min(type, (r, seq)) AS type, arg_min(ocr, (r, seq)) AS ocr FROM (SELECT *, CASE ocr WHEN 'paddle' THEN 1 WHEN 'tesseract' THEN 2 ELSE 3 END AS r FROM hit
    WHERE type = 'range' OR exp_start IS NULL OR ok) p GROUP BY ALL""")
def _(v):
    return R.first_valid(R.classified(v.candidates), expected(v))


@query("x6_decided_readings", f"""SELECT * FROM (WITH y AS (SELECT doc_id, page_no, unnest(arg_min({{'yt': text, 'yy': type, 'ys': score, 'yz': zone, 'yo': ocr}}, (CASE zone WHEN 'yolo-pn' THEN 0 WHEN 'hdr-L' THEN 1 ELSE 2 END, seq))) FROM hit WHERE zone IN ('yolo-pn', 'hdr-L', 'hdr-R') GROUP BY doc_id, page_no),
    c AS ({_best("WHERE starts_with(zone, 'corner')")}), t AS ({_best("WHERE starts_with(zone, 'corner') OR zone = 'top'")}),
    j AS (SELECT p.doc_id, p.page_no, y.*, c.text AS c_text, c.type AS c_type, c.score AS c_score, c.zone AS c_zone, c.ocr AS c_ocr, t.text AS t_text, t.type AS t_type, t.score AS t_score, t.zone AS t_zone, t.ocr AS t_ocr,
      coalesce(yy = 'single' AND abs(TRY_CAST(yt AS BIGINT) - (exp_start + p.page_no)) <= 10, false) OR coalesce(yo = 'paddle' AND ys >= 0.8, false) AS plausible
      FROM (SELECT DISTINCT doc_id, page_no FROM cand) p LEFT JOIN y ON y.doc_id = p.doc_id AND y.page_no = p.page_no LEFT JOIN c ON c.doc_id = p.doc_id AND c.page_no = p.page_no LEFT JOIN t ON t.doc_id = p.doc_id AND t.page_no = p.page_no LEFT JOIN exr ON exr.doc_id = p.doc_id),
    w AS (SELECT *, CASE WHEN plausible THEN 'y' WHEN c_score >= 0.8 THEN 'c' WHEN t_text IS NOT NULL THEN 't' WHEN ys >= 0.8 THEN 'y' END AS pick FROM j)
    SELECT doc_id, page_no, CASE pick WHEN 'y' THEN yt WHEN 'c' THEN c_text WHEN 't' THEN t_text END AS text, CASE pick WHEN 'y' THEN yy WHEN 'c' THEN c_type WHEN 't' THEN t_type END AS type, CASE pick WHEN 'y' THEN ys WHEN 'c' THEN c_score WHEN 't' THEN t_score END AS score,
      CASE pick WHEN 'y' THEN yz WHEN 'c' THEN c_zone WHEN 't' THEN t_zone END AS zone, CASE pick WHEN 'y' THEN yo WHEN 'c' THEN c_ocr WHEN 't' THEN t_ocr END AS ocr FROM w) q""".replace("y.*", "yt, yy, ys, yz, yo"))
def _(v):
    return R.decide(v.candidates, expected(v))


_HINT = "page_no * 3"


@query("x3_extracted_numbers", f"""SELECT * FROM (WITH p AS (SELECT *, {_HINT} AS hint, CASE WHEN {_HINT} > 0 THEN greatest(4, length(CAST({_HINT} AS VARCHAR)) + 1) ELSE 5 END AS md, TRY_CAST(regexp_replace(raw_text, '[^0-9]', '', 'g') AS BIGINT) AS n FROM ({_PARSED}) x WHERE first IS NOT NULL),
    o AS (SELECT *, last IS NOT NULL AND ((length(CAST(first AS VARCHAR)) <= md AND first <> 0 AND NOT (hint > 0 AND abs(first - hint) > 20)) OR (length(CAST(last AS VARCHAR)) <= md AND last <> 0 AND NOT (hint > 0 AND abs(last - hint) > 20))) AS r_ok,
      length(CAST(n AS VARCHAR)) <= md AND n <> 0 AND NOT (hint > 0 AND abs(n - hint) > 20) AS n_ok, CASE WHEN hint > 0 THEN abs(n - hint) ELSE length(CAST(n AS VARCHAR)) END AS far FROM p)
    SELECT doc_id, page_no, coalesce(arg_min(CASE WHEN r_ok THEN first ELSE n END, seq) FILTER (r_ok OR n_ok), arg_min(n, (far, seq))) AS number,
      CASE WHEN arg_min(r_ok, seq) FILTER (r_ok OR n_ok) THEN arg_min(last, CASE WHEN r_ok OR n_ok THEN seq END) END AS number_end FROM o GROUP BY doc_id, page_no) q""")
def _(v):
    return R.extract_number(v.candidates, F.col("page_no") * 3)


# One page is looked at in each step of the recursion, in up to five passes over its volume; ``d0`` and ``d1`` are the distances of the numbers about it.
_REPAIRED = """SELECT * FROM (WITH RECURSIVE v AS (SELECT doc_id, list(page_index ORDER BY page_index) AS pages, list(page_number::BIGINT ORDER BY page_index) AS was, list(page_number_end::BIGINT ORDER BY page_index) AS fin FROM pg GROUP BY doc_id),
    s AS (SELECT doc_id, was AS num, fin, 1 AS i, CASE WHEN len(was) >= 3 THEN 1 ELSE 6 END AS pass, false AS changed FROM v
      UNION ALL SELECT doc_id, CASE WHEN fix THEN list_transform(num, lambda x, j: CASE WHEN j = i THEN want ELSE x END) ELSE num END, CASE WHEN fix THEN list_transform(fin, lambda x, j: CASE WHEN j = i THEN NULL ELSE x END) ELSE fin END,
        CASE WHEN i = len(num) THEN 1 ELSE i + 1 END, CASE WHEN i < len(num) THEN pass WHEN changed OR fix THEN pass + 1 ELSE 6 END, i < len(num) AND (changed OR fix)
      FROM (SELECT *, coalesce(num[i + d1] - num[i - d0] = d0 + d1, false) AND num[i - d0] + d0 IS DISTINCT FROM num[i] AND num[i - d0] + d0 IS DISTINCT FROM fin[i] AS fix, num[i - d0] + d0 AS want
        FROM (SELECT *, list_filter(range(1, 11), lambda d: i - d >= 1 AND num[i - d] IS NOT NULL)[1] AS d0, list_filter(range(1, 11), lambda d: i + d <= len(num) AND num[i + d] IS NOT NULL)[1] AS d1 FROM s WHERE pass <= 5) n) f)
    SELECT doc_id, unnest(pages) AS page_index, unnest(num) AS page_number, unnest(s.fin) AS page_number_end, unnest(list_transform(num, lambda x, j: x IS DISTINCT FROM was[j])) AS changed FROM s JOIN v USING (doc_id) WHERE pass > 5) q"""


@query("w5_repaired_numbers", _REPAIRED)
def _(v):
    return grouped.repair_page_numbers(v.pages)
