"""Page-number sequences, readings, order-dependent operators, names and side files."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quirework.functions import expressions as E
from quirework.functions import names as N
from quirework.functions.labels import ID
from quirework.operators import grouped, readings as R, sequence as S, zones
from quirework.sources import backends, sidecars as J

READ = "doc_id long, pdf_page long, detected string, type string, score double"


def readings(spark, texts, doc=1):
    rows = [(doc, i + 1, t, None if t is None else "range" if "-" in t else "single", 0.9) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, READ)


def expected(spark, a, z, doc=1):
    return spark.createDataFrame([(doc, a, z)], "doc_id long, exp_start long, exp_end long")


def walk(texts, lo=None, hi=None):
    """Sequence issues by one pass."""
    out, prev, where = [], None, None
    for i, t in enumerate(texts):
        if t is None or "-" in t:
            prev = None
            continue
        n = int(t)
        if n < 1 or lo is not None and not lo - 5 <= n <= hi + 5:
            continue
        if prev is not None and (n <= prev or n - prev > 2):
            out.append((i + 1, "DUPLICATE" if n == prev else "BACKWARD" if n < prev else "GAP", n, where, prev))
        prev, where = n, i + 1
    return out


def test_sequence_equals_one_pass(spark):
    rng = random.Random(5)
    for _ in range(4):
        texts = [None if rng.random() < 0.1 else f"{i}-{i + 1}" if rng.random() < 0.1 else str(max(0, i + rng.choice([0, 0, 0, 0, 1, -1, 4, 300]))) for i in range(1, 40)]
        d = S.with_expected(readings(spark, texts), expected(spark, 1, 40))
        got = sorted((r.pdf_page, r.issue, r.num, r.prev_pdf, r.prev_num) for r in S.sequence_issues(d).collect())
        assert got == sorted(walk(texts, 1, 40))


def test_auto_correct_takes_the_modal_offset(spark):
    texts = ["1", "802", "803", "4", "9000", "6"]
    fixed = {r.pdf_page: (r.detected, r.old) for r in S.auto_correct(S.with_expected(readings(spark, texts), expected(spark, 1, 6))).collect()}
    assert fixed[2] == ("2", "802") and fixed[3] == ("3", "803") and fixed[5] == ("9000", None)


def test_missing_runs_and_page_map(spark):
    d, made = S.validate(readings(spark, ["1", "2", "4", "4", None, "15", "16-17"]), expected(spark, 1, 18))
    assert made.count() == 0
    assert sorted(r.page for r in S.missing_pages(d).collect()) == [3, *range(5, 15), 18]
    single, large = S.real_missing(S.missing_pages(d))
    assert sorted(r.page for r in single.collect()) == [3, 18] and [(r["first"], r["last"], r.n) for r in large.collect()] == [(5, 14, 10)]
    m = S.page_map(d, single).orderBy("ord").collect()
    assert [(r.kind, r.logical_number, r.duplicate) for r in m] == [("pdf_page", 1, False), ("pdf_page", 2, False), ("missing", 3, False), ("pdf_page", 4, False), ("pdf_page", 4, True), ("pdf_page", 5, False), ("pdf_page", 15, False), ("pdf_page", 7, False), ("missing", 18, False)]


def test_issue_kinds(spark):
    d, made = S.validate(readings(spark, ["1", "1", None, "5", "4", "900", "7-8"]), expected(spark, 1, 60))
    kinds = Counter(r.check_name for r in S.issues(d, made).collect())
    assert kinds["mislabeled_document"] == kinds["no_page_number"] == kinds["page_range"] == kinds["backward_page"] == 1
    # 900 becomes 5, which then stands on two pages.
    assert kinds["duplicate_page"] == 2 and kinds["suspicious_reading"] == 0 and kinds["auto_corrected"] == 1


def test_empty_readings(spark):
    d, made = S.validate(readings(spark, ["1"]).limit(0), expected(spark, 1, 5).limit(0))
    assert S.issues(d, made).count() == 0 and S.missing_pages(d).count() == 0


@pytest.mark.parametrize("text,want", [("12", ("12", "single")), ("(45)", ("45", "single")), ("12-14", ("12-14", "range")), ("12 – 14", ("12 – 14", "range")), ("Page 7", ("7", "single")), ("12345", None), ("xiv", None), ("", None), (None, None)])
def test_classified_text(spark, text, want):
    r = spark.createDataFrame([(text,)], "t string").select(E.classify_page_text(F.col("t")).alias("c")).first().c
    assert (r and (r.text, r.type)) == want


@pytest.mark.parametrize("text,want", [("31-32", [31, 32]), ("31, 33", [31, 33]), ("31-39", [3139]), ("32-31", [3231]), ("p. 7", [7]), ("none", None)])
def test_parsed_range(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(E.parse_page_range(F.col("t")).alias("p")).first().p == want


CAND = "doc_id long, page_no long, seq long, raw_text string, score double, cx double, cy double, zone string, ocr string"


def test_reading_cascade(spark):
    rows = [
        (1, 0, 0, "1", 0.5, None, None, "yolo-pn", "tesseract"), (1, 0, 1, "99", 0.95, 10.0, 10.0, "corner-L", "paddle"),  # near the expected number
        (1, 1, 0, "500", 0.9, None, None, "yolo-pn", "tesseract"), (1, 1, 1, "2", 0.85, 10.0, 10.0, "corner-L", "paddle"),  # corner instead
        (1, 2, 0, "500", 0.9, None, None, "yolo-pn", "tesseract"), (1, 2, 1, "3", 0.85, 800.0, 900.0, "corner-L", "paddle"),  # corner reading is not in a corner
        (1, 3, 0, "x", 0.9, None, None, "top", "paddle"),
    ]
    got = {r.page_no: r.text for r in R.decide(spark.createDataFrame(rows, CAND), expected(spark, 1, 40)).collect()}
    assert got == {0: "1", 1: "2", 2: "500", 3: None}


def test_extracted_number_prefers_plausible(spark):
    rows = [(1, 0, 0, "7", 1.0, None, None, "t", "t"), (1, 0, 1, "41-42", 1.0, None, None, "t", "t"), (1, 1, 0, "900", 1.0, None, None, "t", "t"), (1, 1, 1, "99", 1.0, None, None, "t", "t")]
    got = {r.page_no: (r.number, r.number_end) for r in R.extract_number(spark.createDataFrame(rows, CAND), F.lit(40)).collect()}
    assert got == {0: (41, 42), 1: (99, None)}


def test_repair_sees_earlier_fixes():
    assert grouped.repaired_numbers([1, 2, 9, 4, None, 6], [None] * 6)[0] == [1, 2, 3, 4, 5, 6]
    assert grouped.repaired_numbers([10, 12, 12], [None, 11, None]) == ([10, 12, 12], [None, 11, None])
    assert grouped.repaired_numbers([5, 9], [None, None])[0] == [5, 9]


def test_repair_on_spark(spark):
    p = spark.createDataFrame([(d, i, n, None) for d in (1, 2) for i, n in enumerate([1, 2, 77, 4, None, 6])], "doc_id long, page_index long, page_number long, page_number_end long")
    got = [(r.page_number, r.changed) for r in grouped.repair_page_numbers(p).orderBy("doc_id", "page_index").collect()]
    assert got == [(1, False), (2, False), (3, True), (4, False), (5, True), (6, False)] * 2


def test_fusion(spark):
    rows = [(1, 0, 0, ID["IMAGE"], .6, 0., 0., 100., 100., "small"), (1, 1, 0, ID["IMAGE"], .9, 5., 5., 105., 105., "large"), (1, 2, 0, ID["IMAGE"], .9, 300., 0., 400., 50., "large"),
            (1, 3, 0, ID["CASE_SEQUENCE"], .9, 0., 0., 50., 50., "large"), (1, 4, 0, ID["CASE_SEQUENCE"], .4, 5., 5., 40., 40., "small"), (1, 5, 0, ID["KEY_ICON"], .9, 0., 0., 50., 50., "large"), (1, 6, 0, ID["KEY_ICON"], .5, 0., 0., 50., 50., "medium")]
    d = spark.createDataFrame(rows, "doc_id long, det_id long, page_index long, label_id long, confidence double, x1 double, y1 double, x2 double, y2 double, model string")
    got = {r.det_id: (r.model_count, r.found_by) for r in grouped.fuse_models(d).collect()}
    assert got == {1: (2, ["small", "large"]), 2: (1, ["large"]), 4: (2, ["large", "small"]), 6: (1, ["medium"])}


def greedy_lines(words, reach=10.0, gap=10.0):
    """The first free word takes all words about its centre, then near lines are put together."""
    free, lines = list(words), []
    while free:
        c = sum(free[0]) / 2
        lines.append([w for w in free if abs(sum(w) / 2 - c) < reach])
        free = [w for w in free if abs(sum(w) / 2 - c) >= reach]
    merged = []
    for a, z in sorted((min(w[0] for w in own), max(w[1] for w in own)) for own in lines):
        if merged and a - merged[-1][1] < gap:
            merged[-1][1] = max(merged[-1][1], z)
        else:
            merged.append([a, z])
    return merged


def test_refined_lines_equal_one_pass(spark):
    rng, rects, boxes, want = random.Random(3), [], [], {}
    given = {0: [(0., 12.), (2., 14.), (40., 48.), (52., 60.), (100., 110.)], 1: [], 2: [(5., 5.)]}
    given.update({k: [(float(y), float(y + rng.randint(4, 14))) for y in (rng.randint(0, 400) for _ in range(rng.randint(1, 40)))] for k in range(3, 30)})
    for k, words in given.items():
        rects.append((k, 72., 72., 144., 288.))
        boxes += [(k, i, a, z) for i, (a, z) in enumerate(words)]
        lines = [(i, (200 + a) / (200 / 72), (200 + z) / (200 / 72)) for i, (a, z) in enumerate(greedy_lines(words)) if a < z]
        want[k] = lines if words else [(0, 72., 288.)]
    rects.append((99, 72., 72., 74., 288.))  # under 10 pixels wide
    boxes.append((99, 0, 0., 10.))
    want[99] = [(0, 72., 288.)]
    got = zones.refine_to_lines(spark.createDataFrame(rects, "doc_id long, x0 double, y0 double, x1 double, y1 double"), spark.createDataFrame(boxes, "doc_id long, box_no long, by0 double, by1 double"), "doc_id").collect()
    near = lambda rows: sorted((k, i, round(a, 6), round(z, 6)) for k, i, a, z in rows)
    assert near((r.doc_id, r.line, r.y0, r.y1) for r in got) == near((k, *line) for k, lines in want.items() for line in lines)


def test_flow_opens_pages(spark):
    clips = spark.createDataFrame([(1, 0, 0, i, 1, 0, 0., 0., 1080., 600.) for i in range(4)], "doc_id long, opinion long, page_index long, det_id long, place long, part long, x0 double, y0 double, x1 double, y1 double")
    got = grouped.flow_footnotes(clips).orderBy("det_id").collect()
    assert [r.out_page for r in got] == [0, 0, 1, 1] and got[0].dx1 == 576 and got[1].dy0 == pytest.approx(36 + 300 + 8)


def test_columns_from_ink():
    ink = np.zeros(1700)
    ink[150:800], ink[900:1550] = 400, 400
    l0, l1, r0, r1, mid = grouped.columns_of_profile(ink)
    assert abs(l0 - 150) < 20 and abs(l1 - 800) < 20 and abs(r0 - 900) < 20 and abs(r1 - 1550) < 20 and 800 < mid < 900
    assert grouped.columns_of_profile(np.zeros(1700)) == (0, 0, 0, 0, 0)


@pytest.mark.parametrize("name,want", [("f3d.100.1.1200.pdf", ("f3d", "100", 1, 1200)), ("u.s.app.7.15.90_redacted.pdf", ("u.s.app", "7", 15, 90)), ("rep.3.1.9.ocr.pdf", ("rep", "3", 1, 9)), ("sct.3.5.2.pdf", None), ("a.b.pdf", None), ("rep.3.0.9.pdf", None), (None, None)])
def test_volume_names(spark, name, want):
    r = spark.createDataFrame([(name,)], "n string").select(N.volume_of(F.col("n")).alias("v")).first().v
    assert (r and tuple(r)) == want


def test_target_dpi(spark):
    got = spark.createDataFrame([(100.0,), (592.0,), (10_000.0,)], "kb double").select(N.target_dpi(F.col("kb"), F.lit(300.0)).alias("d")).collect()
    assert [r.d for r in got] == [300, 150, 100]


def test_side_files_round_trip(spark, tmp_path):
    (tmp_path / "7").mkdir()
    (tmp_path / "7" / "detections.json").write_text('[{"page_index": 0, "label_id": 3, "bbox": [1.0, 2.0, 3.0, 4.0], "confidence": 0.5, "extra": 1}, {"page_index": 1, "label_id": 99}, {"page_index": 2, "label_id": 4}]')
    (tmp_path / "7" / "pages_meta.json").write_text('{"0": {"pdf_width": 600.0, "midpoint": 5.0}, "3": {}}')
    d = J.read_detections(spark, str(tmp_path / "7" / "detections.json")).orderBy("page_index").collect()
    assert [(r.doc_id, r.page_index, r.label_id, r.confidence, r.x2, r.img_width) for r in d] == [(7, 0, 3, 0.5, 3.0, 1), (7, 2, 4, 1.0, 1.0, 1)]
    p = J.read_pages(spark, str(tmp_path / "7" / "pages_meta.json")).orderBy("page_index").collect()
    assert [(r.doc_id, r.page_index, r.pdf_width, r.pdf_height, r.midpoint) for r in p] == [(7, 0, 600.0, 792.0, 5.0), (7, 3, 612.0, 792.0, 0.0)]
    found = J.find_sidecars(spark, str(tmp_path)).collect()
    assert len(found) == 1 and found[0].doc_id == 7
    rects = spark.createDataFrame([(7, 0, 1, 0.04, 1.0, 2.06, 3.0, "black", "KEY_ICON")], "doc_id long, page_index long, n long, x0 double, y0 double, x1 double, y1 double, fill string, type string")
    J.write_records(J.rect_records(rects, "n"), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 1


def test_backends_by_contract(spark):
    class FakePdf:
        def pages(self, pdf):
            return [(612.0, 792.0)] * len(pdf)

        def detect(self, images):
            return [[(3, 0.9, 0.0, 0.0, 1.0, 1.0), (4, 0.1, 0.0, 0.0, 1.0, 1.0)] for _ in images]

        def write(self, pdf, a, z, rects):
            return bytes([len(rects)]) + pdf[a : z + 1]

        def merge(self, parts):
            return b"".join(parts)

    v = spark.createDataFrame([(1, bytearray(b"abc"))], "doc_id long, content binary")
    assert [(r.page_index, r.pdf_width) for r in backends.page_table(v, FakePdf).orderBy("page_index").collect()] == [(0, 612.0), (1, 612.0), (2, 612.0)]
    images = spark.createDataFrame([(1, i, bytearray(b"x")) for i in range(5)], "doc_id long, page_index long, image binary")
    assert backends.detect(images, FakePdf).count() == 5
    files = spark.createDataFrame([(1, "a.pdf", 1, 2, bytearray(b"abc"))], "doc_id long, file_name string, page_from long, page_to long, content binary")
    plan = spark.createDataFrame([(1, "a.pdf", 0, 0.0, 0.0, 1.0, 1.0, "black")] * 2, "doc_id long, file_name string, page_index long, x0 double, y0 double, x1 double, y1 double, fill string")
    assert bytes(backends.write_files(files, plan, FakePdf).first().content) == b"\x02bc"
    parts = spark.createDataFrame([(1, 1, bytearray(b"b")), (1, 0, bytearray(b"a"))], "doc_id long, chunk long, content binary")
    assert bytes(backends.merge_chunks(parts, FakePdf).first().content) == b"ab"
    with pytest.raises(Exception, match="BackendMissing"):
        backends.page_table(v).collect()


def test_weights_reach_the_executors(spark, tmp_path):
    (tmp_path / "small.pt").write_bytes(b"s")
    (tmp_path / "medium.pt").write_bytes(b"m")
    calls = []

    def fetch(path):
        calls.append(path)
        with open(path, "wb") as f:
            f.write(b"l")

    folder = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        backends.ensure_weights(spark, folder)
    with pytest.raises(FileNotFoundError):
        backends.ensure_weights(spark, folder, ["other"], {"large": fetch})
    assert not calls
    assert backends.ensure_weights(spark, folder, ["small"], {"small": fetch}) == {"small": f"{folder}/small.pt"} and not calls
    assert list(backends.ensure_weights(spark, folder, fetch={"large": fetch})) == ["small", "medium", "large"] and len(calls) == 1
    assert backends.ensure_weights(spark, folder, []) == {}

    def opened(batches):
        from pyspark import SparkFiles

        for b in batches:
            yield b.assign(held=open(SparkFiles.get("large.pt")).read())

    assert [r.held for r in spark.range(3).mapInPandas(opened, "id long, held string").collect()] == ["l"] * 3


def test_rotation_plan(spark):
    from quirework.operators import rasters

    rows = [(1, 0, 0), (1, 1, 270), (1, 2, None), (2, 0, 0), (3, 0, None), (4, 0, 90)]
    got = rasters.rotation_plan(spark.createDataFrame(rows, "doc_id long, page_index long, rotation int")).collect()
    assert sorted((r.doc_id, r.page_index, r.dpi or 0, r.jpg_quality or 0) for r in got) == [(1, 0, 0, 0), (1, 1, 300, 85), (1, 2, 0, 0), (4, 0, 300, 85)]
