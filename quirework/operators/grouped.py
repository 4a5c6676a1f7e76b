"""Operators whose steps depend on what earlier steps did, run for one group at a time.

Each group is bounded by its nature: the boxes of one page, the pages of one volume, the
footnotes of one opinion. They run in Python over columns of numbers, many groups at once
where groups are small.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.functions.labels import ID, MEDIUM_ONLY, SMALLEST_BOX
from quirework.operators.layout import PAGE


def fuse_models(det: DataFrame, most: float = 0.3) -> DataFrame:
    """Boxes of several models for one thing made one: doc_id, page_index, label_id, det_id, confidence, x1..y2, found_by, model_count.

    In the order of upper edges every box not yet taken takes all later ones of its page and
    label that overlap it by IoU or lie inside it or around it; the most confident one stays,
    of case sequence marks the smallest. Key icons and captions count from the medium model only.
    """
    medium = [ID[n] for n in MEDIUM_ONLY]
    smallest = {ID[n] for n in SMALLEST_BOX}
    schema = "doc_id long, page_index long, label_id long, det_id long, confidence double, x1 double, y1 double, x2 double, y2 double, found_by array<string>, model_count long"
    fine = det.where(~F.col("label_id").isin(medium) | (F.col("model") == "medium"))

    key = ["doc_id", "page_index", "label_id"]
    columns = [*key, "det_id", "confidence", "x1", "y1", "x2", "y2"]

    def fuse(rows: pa.Table) -> pa.Table:
        box = np.column_stack([_values(rows, c) for c in ("x1", "y1", "x2", "y2")])
        lead = _takers(box, np.cumsum(_new_group(rows, key)), most)
        order = np.argsort(lead, kind="stable")
        starts = np.flatnonzero(np.r_[True, lead[order][1:] != lead[order][:-1]])
        rank = np.where(np.isin(_values(rows, "label_id"), list(smallest)), -_area(box), _values(rows, "confidence"))
        best = np.lexsort((-rank, lead))[starts]  # the first of equals
        out = rows.select(columns).take(pa.array(best))
        models = rows.column("model").take(pa.array(order)).combine_chunks()
        found = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(order)], pa.int32()), models)
        return out.append_column("found_by", found).append_column("model_count", pa.array(np.diff(np.r_[starts, len(order)]), pa.int64()))

    return fine.select(*columns, "model").repartition(*key).sortWithinPartitions(*key, "y1", "det_id").mapInArrow(_in_whole_groups(fuse, key), schema)


def _in_whole_groups(f, key: list[str]):
    """For mapInArrow over rows sorted by ``key``: ``f`` of one table after another, each of whole groups."""

    def run(batches):
        held = None
        for b in batches:
            new = pa.Table.from_batches([b])
            held = new if held is None else pa.concat_tables([held, new])
            starts = np.flatnonzero(_new_group(held, key))
            if len(starts) > 1:  # the last group may go on in the next batch
                yield from f(held.slice(0, starts[-1]).combine_chunks()).to_batches()
                held = held.slice(starts[-1])
        if held is not None and len(held):
            yield from f(held.combine_chunks()).to_batches()

    return run


def _values(rows: pa.Table, column: str) -> np.ndarray:
    return rows.column(column).to_numpy()


def _new_group(rows: pa.Table, key: list[str]) -> np.ndarray:
    """Whether each row's key differs from that of the row before."""
    if not len(rows):
        return np.zeros(0, bool)
    k = [_values(rows, c) for c in key]
    return np.r_[True, np.any([c[1:] != c[:-1] for c in k], axis=0)]


def _area(box: np.ndarray) -> np.ndarray:
    return (box[:, 2] - box[:, 0]) * (box[:, 3] - box[:, 1])


def _takers(box: np.ndarray, group: np.ndarray, most: float) -> np.ndarray:
    """For each box the place of the one that takes it (or its own): the first free one of its group takes
    all later free ones it meets, until none is free. All groups step at once, so few steps serve many groups.
    """
    lead, left = np.empty(len(box), np.int64), np.arange(len(box))
    while len(left):
        first = np.r_[True, group[left][1:] != group[left][:-1]]
        head = left[np.maximum.accumulate(np.where(first, np.arange(len(left)), 0))]
        a, b = box[head], box[left]
        inter = np.clip(np.minimum(a[:, 2:], b[:, 2:]) - np.maximum(a[:, :2], b[:, :2]), 0, None).prod(axis=1)
        union = _area(a) + _area(b) - inter
        within = (b[:, :2] >= a[:, :2]).all(1) & (b[:, 2:] <= a[:, 2:]).all(1)
        around = (b[:, :2] <= a[:, :2]).all(1) & (b[:, 2:] >= a[:, 2:]).all(1)
        hit = first | ((inter > most * union) & (union > 0)) | within | around
        lead[left[hit]] = head[hit]
        left = left[~hit]
    return lead


def repaired_numbers(numbers: list[int | None], ends: list[int | None], look: int = 10, passes: int = 5) -> tuple[list[int | None], list[int | None]]:
    """Page numbers set right where the nearest numbered neighbours on both sides agree; fixes count for what follows."""
    num, end, n = list(numbers), list(ends), len(numbers)

    def neighbour(i: int, step: int) -> tuple[int | None, int]:
        for dist in range(1, look + 1):
            j = i + step * dist
            if j < 0 or j >= n:
                break
            if num[j] is not None:
                return num[j], dist
        return None, 0

    for _ in range(passes if n >= 3 else 0):
        changed = False
        for i in range(n):
            (before, d0), (after, d1) = neighbour(i, -1), neighbour(i, 1)
            if before is None or after is None or after - before != d0 + d1:
                continue
            want = before + d0
            if num[i] == want or end[i] is not None and end[i] == want:
                continue
            num[i], end[i], changed = want, None, True
        if not changed:
            break
    return num, end


def repair_page_numbers(pages: DataFrame) -> DataFrame:
    """``repaired_numbers`` for each volume: doc_id, page_index, page_number, page_number_end, changed."""

    def repair(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("page_index", kind="stable")
        ints = lambda s: [None if pd.isna(x) else int(x) for x in s]
        before, ends = ints(g["page_number"]), ints(g["page_number_end"])
        num, end = repaired_numbers(before, ends)
        return pd.DataFrame({"doc_id": g["doc_id"], "page_index": g["page_index"], "page_number": pd.array(num, "Int64"), "page_number_end": pd.array(end, "Int64"), "changed": [a != b for a, b in zip(before, num)]})

    return pages.select("doc_id", "page_index", "page_number", "page_number_end").groupBy("doc_id").applyInPandas(repair, "doc_id long, page_index long, page_number long, page_number_end long, changed boolean")


def flow_footnotes(clips: DataFrame, page_w: float = 612.0, page_h: float = 792.0, margin: float = 36.0, gap: float = 8.0) -> DataFrame:
    """Footnote clips of an opinion laid out top to bottom on letter pages: out_page (from 0), dx0..dy1.

    Clips wider than the page are scaled down; one that does not fit any more opens a page.
    clips: doc_id, opinion, page_index, place, part, x0..y1, in that order.
    """

    key = ["doc_id", "opinion"]

    def flow(rows: pa.Table) -> pa.Table:
        """The first clips of all opinions are laid out at once, then their second ones, and so on."""
        w, h = _values(rows, "x1") - _values(rows, "x0"), _values(rows, "y1") - _values(rows, "y0")
        scale = np.minimum(1.0, (page_w - 2 * margin) / w)
        w, h = w * scale, h * scale
        starts = np.flatnonzero(_new_group(rows, key))
        sizes = np.diff(np.r_[starts, len(rows)])
        group = np.repeat(np.arange(len(starts)), sizes)
        nth = np.arange(len(rows)) - starts[group]
        order = np.argsort(nth, kind="stable")
        y, page = np.full(len(starts), margin), np.zeros(len(starts), np.int64)
        top, at = np.empty(len(rows)), np.empty(len(rows), np.int64)
        for i in np.split(order, np.cumsum(np.bincount(nth))[:-1]):
            g = group[i]
            full = (y[g] + h[i] > page_h - margin) & (y[g] > margin + 1)
            page[g] += full
            y[g] = np.where(full, margin, y[g])
            top[i], at[i] = y[g], page[g]
            y[g] += h[i] + gap
        out = rows.select(["doc_id", "opinion", "page_index", "det_id", "part"])
        for name, column in (("out_page", at), ("dx0", np.full(len(rows), margin)), ("dy0", top), ("dx1", margin + w), ("dy1", top + h)):
            out = out.append_column(name, pa.array(column))
        return out

    schema = "doc_id long, opinion long, page_index long, det_id long, part long, out_page long, dx0 double, dy0 double, dx1 double, dy1 double"
    d = clips.select(*key, "page_index", "det_id", "place", "part", "x0", "y0", "x1", "y1").repartition(*key)
    return d.sortWithinPartitions(*key, "page_index", "place", "part").mapInArrow(_in_whole_groups(flow, key), schema)


def columns_of_profile(ink: np.ndarray) -> tuple[float, float, float, float, float]:
    """Bounds of two text columns and the middle between them from the ink of every pixel column; zeros where there are none."""
    none = (0.0, 0.0, 0.0, 0.0, 0.0)
    w = len(ink)
    if w < 8:
        return none
    size = max(5, int(w * 0.02)) | 1
    sigma = 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    at = np.arange(size) - size // 2
    kernel = np.exp(-(at**2) / (2 * sigma**2))
    smooth = np.convolve(np.pad(np.asarray(ink, float), size // 2, "reflect"), kernel / kernel.sum(), "valid")
    centre, band = w // 2, int(w * 0.25)
    lo, hi = max(0, centre - band), min(w, centre + band)
    valley = lo + int(np.argmin(smooth[lo:hi]))
    dry = smooth <= max(1.0, 0.15 * float(np.median(smooth)))
    left = np.flatnonzero(~dry[: valley + 1])
    right = np.flatnonzero(~dry[valley:])
    a = int(left[-1]) if len(left) else 0
    z = valley + int(right[0]) if len(right) else w - 1
    least = max(3, int(w * 0.01))
    if z - a < least:
        a, z = max(0, valley - least // 2), min(w, valley + least // 2)
    mid = (a + z) // 2
    text = smooth > max(1.0, 0.20 * float(smooth.mean()))
    l, r = np.flatnonzero(text[:mid]), np.flatnonzero(text[mid:]) + mid
    if not len(l) or not len(r) or not l[0] < l[-1] < mid < r[0] < r[-1]:
        return none
    return float(l[0]), float(l[-1]), float(r[0]), float(r[-1]), float(mid)


def detect_columns(profiles: DataFrame) -> DataFrame:
    """doc_id, page_index and ink (array of double) to col_left_x1, col_left_x2, col_right_x1, col_right_x2, midpoint."""
    return _detected(profiles, ["ink"], lambda x: np.asarray(x if x is not None else [], float))


def detect_columns_of_spans(spans: DataFrame, width: int) -> DataFrame:
    """The same of pages whose ink is told by spans: doc_id, page_index, a, z, h adds h to every pixel column from a up to z, less z.

    Spans of one place are summed before they are shuffled, and a page's profile is made in the task, so rows
    grow with the spans and not with their width.
    """
    sums = spans.where("a < z").groupBy(*PAGE, "a", "z").agg(F.sum("h").alias("h"))
    pages = sums.groupBy(*PAGE).agg(F.collect_list("a").alias("a"), F.collect_list("z").alias("z"), F.collect_list("h").alias("h"))

    def ink(*told) -> np.ndarray:
        out = np.zeros(width)
        for a, z, h in zip(*told):
            out[max(a, 0) : max(z, 0)] += h
        return out

    return _detected(pages, ["a", "z", "h"], ink)


def _detected(pages: DataFrame, told: list[str], ink) -> DataFrame:
    names = ["col_left_x1", "col_left_x2", "col_right_x1", "col_right_x2", "midpoint"]

    def run(batches):
        for g in batches:
            found = pd.DataFrame([columns_of_profile(ink(*x)) for x in zip(*[g[c] for c in told])], columns=names)
            yield pd.concat([g[PAGE].reset_index(drop=True), found], axis=1)

    return pages.select(*PAGE, *told).mapInPandas(run, "doc_id long, page_index long, " + ", ".join(f"{n} double" for n in names))
