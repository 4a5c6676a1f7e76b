"""Steps that must not grow faster than their input: plans, row counts and plain models."""

import random

from pyspark.sql import functions as F

from quirework.functions.labels import ID
from quirework.functions.session import staged
from quirework.operators import grouped, pairing, sequence as S, zones
from quirework.sources import sidecars as J


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_files_of_many_rows_are_not_broadcast(spark):
    """Three million rows of a few values take under a megabyte of files."""
    rows = spark.range(3_000_000).select((F.col("id") / 1000).cast("long").alias("doc_id"), (F.col("id") % 10).alias("page_index"), F.lit(612.0).alias("pdf_width"), F.lit(792.0).alias("pdf_height"))
    many, few = staged(rows, "many"), staged(rows.limit(1000), "few")
    other = spark.range(40_000_000).withColumnRenamed("id", "doc_id")
    assert "BroadcastHashJoin" not in plan(other.join(many.select("doc_id", "pdf_width"), "doc_id"))
    assert "BroadcastHashJoin" in plan(other.join(few.select("doc_id", "pdf_width"), "doc_id"))


def slow_runs(rows, start, end):
    """Missing runs of one volume, number by number."""
    fine = [n for n, oor, _ in rows if n is not None and not oor]
    if not fine:
        return []
    lo, hi = (min(fine), max(fine)) if start is None else (start, end)
    shown = set(fine) | {n for *_, r in rows if r for n in range(r[0], r[1] + 1)}
    out = []
    for n in range(max(lo, 1), hi + 1):
        if n not in shown:
            if out and out[-1][1] == n - 1:
                out[-1][1] = n
            else:
                out.append([n, n])
    return [tuple(r) for r in out]


def test_missing_runs_equal_a_count(spark):
    rng, rows, want = random.Random(7), [], {}
    for doc in range(300):
        start, end = (None, None) if doc % 3 == 0 else (rng.randint(-3, 5), rng.randint(3, 40))
        own = []
        for page in range(rng.randint(1, 12)):
            kind = rng.random()
            span = (rng.randint(1, 45), rng.randint(1, 45)) if kind < 0.2 else None
            number = None if kind < 0.3 else rng.randint(-5, 45)
            oor = number is not None and (number < 1 or start is not None and not start - 5 <= number <= end + 5)
            own.append((number, oor, span if span and span[0] <= span[1] else None))
            rows.append((doc, page + 1, f"{span[0]}-{span[1]}" if span else None if number is None else str(number), "range" if span else "single", number, oor, start, end))
        want[doc] = slow_runs(own, start, end)
    d = spark.createDataFrame(rows, "doc_id long, pdf_page long, detected string, type string, num long, out_of_range boolean, exp_start long, exp_end long")
    got = {}
    for r in S.missing_runs(d).orderBy("doc_id", "first").collect():
        assert r.n == r.last - r.first + 1
        got.setdefault(r.doc_id, []).append((r.first, r.last))
    assert got == {k: v for k, v in want.items() if v}
    pages = sorted((k, n) for k, v in want.items() for a, z in v for n in range(a, z + 1))
    assert sorted(map(tuple, S.missing_pages(d).collect())) == pages


def test_missing_runs_of_a_long_range_need_few_rows(spark):
    """A range of a thousand million numbers is two runs, not so many rows."""
    d = spark.createDataFrame([(1, 1, "5", "single", 5, False, 1, 10**9)], "doc_id long, pdf_page long, detected string, type string, num long, out_of_range boolean, exp_start long, exp_end long")
    assert sorted(map(tuple, S.missing_runs(d).collect())) == [(1, 1, 4, 4), (1, 6, 10**9, 10**9 - 5)]


def slow_fusion(boxes, most=0.3):
    """The boxes of one page and label, in order: those each free one takes."""
    free, out = list(range(len(boxes))), []
    while free:
        a = boxes[free[0]]

        def meets(i):
            b = boxes[i]
            inter = max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1]))
            union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter
            inside = lambda o, n: o[0] <= n[0] and o[1] <= n[1] and o[2] >= n[2] and o[3] >= n[3]
            return inter > most * union > 0 or inside(a, b) or inside(b, a)

        own = [free[0]] + [i for i in free[1:] if meets(i)]
        out.append(own)
        free = [i for i in free if i not in own]
    return out


def test_fusion_of_many_small_groups(spark):
    rng, rows, want = random.Random(5), [], {}
    for doc in range(60):
        for label in (ID["IMAGE"], ID["CASE_SEQUENCE"]):
            boxes = sorted((rng.randint(0, 60), rng.randint(0, 40)) for _ in range(rng.randint(1, 9)))
            boxes = sorted(((float(x), float(y), float(x + rng.randint(1, 50)), float(y + rng.randint(1, 50)), rng.randint(1, 9) / 10, rng.choice("abc")) for x, y in boxes), key=lambda b: b[1])
            ids = [len(rows) + i for i in range(len(boxes))]
            rows += [(doc, i, 0, label, b[4], *b[:4], b[5]) for i, b in zip(ids, boxes)]
            for own in slow_fusion(boxes):
                rank = lambda i: -(boxes[i][2] - boxes[i][0]) * (boxes[i][3] - boxes[i][1]) if label == ID["CASE_SEQUENCE"] else boxes[i][4]
                want[ids[max(own, key=rank)]] = (len(own), [boxes[i][5] for i in own])
    d = spark.createDataFrame(rows, "doc_id long, det_id long, page_index long, label_id long, confidence double, x1 double, y1 double, x2 double, y2 double, model string")
    for batch in ("10000", "7"):  # groups cut by batches are put together
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        got = {r.det_id: (r.model_count, r.found_by) for r in grouped.fuse_models(d).collect()}
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert got == want


def test_flow_of_many_opinions(spark):
    rng, rows, want = random.Random(2), [], {}
    for opinion in range(80):
        y, page = 36.0, 0
        for i in range(rng.randint(1, 12)):
            w, h = rng.randint(2, 900), rng.randint(2, 500)
            rows.append((1, opinion, i, len(rows), 1, 0, 5.0, 7.0, 5.0 + w, 7.0 + h))
            scale = min(1.0, 540 / w)
            if y + h * scale > 756 and y > 37:
                page, y = page + 1, 36.0
            want[len(rows) - 1] = (page, 36.0, round(y, 6), round(36 + w * scale, 6), round(y + h * scale, 6))
            y += h * scale + 8
    clips = spark.createDataFrame(rows, "doc_id long, opinion long, page_index long, det_id long, place long, part long, x0 double, y0 double, x1 double, y1 double")
    for batch in ("10000", "5"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        got = {r.det_id: (r.out_page, r.dx0, round(r.dy0, 6), round(r.dx1, 6), round(r.dy1, 6)) for r in grouped.flow_footnotes(clips).collect()}
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert got == want


def test_groups_are_not_run_one_by_one(spark):
    """A call of Python for each group took most of the time of tables of many small groups."""
    clips = spark.createDataFrame([], "doc_id long, opinion long, page_index long, det_id long, place long, part long, x0 double, y0 double, x1 double, y1 double")
    assert "FlatMapGroupsInPandas" not in plan(grouped.flow_footnotes(clips))


def test_columns_of_spans(spark):
    """Spans as wide as a page are no more rows than narrow ones; parts outside the page and empty spans count nothing."""
    spans = spark.createDataFrame([(1, 0, 150, 800, 400.0), (1, 0, 900, 1550, 400.0), (1, 0, -50, 3, 1.0), (1, 0, 1690, 1800, 1.0), (1, 0, 850, 850, 9000.0)], "doc_id long, page_index long, a int, z int, h double")
    got = grouped.detect_columns_of_spans(spans, 1700)
    assert "Generate" not in plan(got)
    ink = [0.0] * 1700
    for a, z, h in ((150, 800, 400.0), (900, 1550, 400.0), (0, 3, 1.0), (1690, 1700, 1.0)):
        ink[a:z] = [x + h for x in ink[a:z]]
    assert tuple(got.first()) == (1, 0, *grouped.columns_of_profile(ink))


def test_marker_labels_are_chosen_before_the_join(spark):
    """Of the 21 labels an opinion's zone markers need six; the rest are neither joined nor sorted."""
    d = spark.createDataFrame([(1, n, 0, n, 0.9, 0.0, float(n), 50.0, n + 1.0, "medium") for n in range(21)], "doc_id long, det_id long, page_index long, label_id long, confidence double, x1 double, y1 double, x2 double, y2 double, model string")
    p = spark.createDataFrame([(1, 0, 100, 50.0, 0.0, 0.0, 0.0, 0.0)], "doc_id long, page_index long, img_width long, midpoint double, col_left_x1 double, col_left_x2 double, col_right_x1 double, col_right_x2 double")
    o = spark.createDataFrame([(1, 0, 0, 0, 3.0, 0, 0, 20.0)], "doc_id long, opinion long, caption_page long, caption_col long, caption_y1 double, key_page long, key_col long, key_y1 double")
    marked = zones.zone_markers(pairing.members(staged(d, "detections"), p, o))
    assert "In(label_id" in plan(marked)
    row = marked.first()
    assert (row.zone_start.det_id, row.zone_end.det_id) == (ID["BACKGROUND"], ID["CASE_METADATA"])


def test_folders_are_listed_by_few_tasks(spark, tmp_path):
    """A task for each folder took longer than what the folders hold."""
    root, sc = str(tmp_path / "files"), spark.sparkContext
    J.write_records(spark.range(60).select(F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("page_index"), F.expr("cast(array() AS array<struct<x0: double, y0: double, x1: double, y1: double, fill: string, type: string>>)").alias("rects")), root)
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    was = spark.conf.get(key)
    for group, read in (("find", lambda: J.find_sidecars(spark, root, "part-*.json")), ("rects", lambda: J.read_rects(spark, root, lines=True))):
        sc.setJobGroup(f"listing-{group}", "")
        found = read()
        status = sc.statusTracker()
        tasks = [status.getStageInfo(s).numTasks for j in status.getJobIdsForGroup(f"listing-{group}") for s in status.getJobInfo(j).stageIds]
        assert tasks and max(tasks) <= 4 * max(4, sc.defaultParallelism) < 60
        if group == "find":
            assert found.select("doc_id").distinct().count() == 60
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert spark.conf.get(key) == was
