"""Benchmark decontamination: a BM25 index of test items with block-max WAND, then verification.

Test items are cut into units of at most ``UNIT_WORDS`` words and indexed by impact: the BM25
weight of a term in a unit over the unit's own total, so a passage that holds all of a unit
scores 1. Every text is cut into segments of ``SEGMENT_WORDS`` words, each two neighbours
being a passage, and every passage is a query that retrieves all units at or above the threshold.

The search is block-max WAND, taken for all passages of a slice of texts side by side. A range of
units is passed over whole where the largest impacts of a passage's terms in it cannot reach
the threshold. In the ranges left each passage has a cursor into the postings of each of its
terms; ordered by unit, the first cursor at which the terms' largest impacts add up to the
threshold is the pivot, as no unit before it can reach it. If the maxima of the pivot's block of
``BLOCK_UNITS`` units cannot either, all cursors skip to the end of the block or the next cursor;
else the pivot is scored and they go on behind it.

A retrieved item is verified in the text around the passage: at least ``MIN_OVERLAP`` of the
five-word shingles of its question and of its answer must stand there (a part of fewer words
is one shingle). Where items have no answer column, the answer is the last sentence, or the
last five words of an item of one sentence, and the question what is before it; as this parting
is a guess, at least ``MIN_OVERLAP`` of the whole item's shingles will do as well. An item of more
than ``ITEM_WORDS`` words is taken as several of that length, each found for itself.

Statistics of the index (document frequencies, mean length) are over all items. An index
holds at most ``INDEX_UNITS`` units, which bounds what is broadcast; a larger benchmark takes
several, each run over all texts. Null and empty texts match nothing, nor do items without
words; items of equal id count as one, matched if any is, and repeated rows of a document
give one row. Columns beyond those named play no part, or stay as they are in ``drop_leaks``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm.session import materialize, table
from quirework.llm.textvec import SpanHasher, column_bytes, gram_hashes, text_slices, word_bounds, word_hashes, words_of

UNIT_WORDS, SEGMENT_WORDS, BLOCK_UNITS = 48, 32, 16
#: Units in an index, ranges of units bounded at once, and words of an item held together.
INDEX_UNITS, RANGES, ITEM_WORDS = 16_384, 64, 8192
THRESHOLD, MIN_OVERLAP, SHINGLE = 0.5, 0.8, 5
K1, B = 1.2, 0.75
_SENTENCE = re.compile(r"(?<=[.?!])\s+(?=\S)")


def question_and_answer(text: str | None) -> tuple[list[str], list[str]]:
    """The words of both parts of an item that is one text."""
    parts = [w for w in (words_of(s) for s in _SENTENCE.split(text or "")) if w]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0] if parts else []
    return words[:-SHINGLE], words[-SHINGLE:]


def _shingles(words: list[str]) -> np.ndarray:
    if not words:
        return np.zeros(0, np.uint64)
    k = min(SHINGLE, len(words))
    return np.unique(gram_hashes(word_hashes(words), np.array([0, len(words)]), k)[0])


class Index:
    """Impacts of a bounded number of units, sorted by term and unit, with the maxima of blocks and of ranges of blocks."""

    def __init__(self, unit: np.ndarray, term: np.ndarray, impact: np.ndarray, owner: np.ndarray, items: list[tuple], parted: bool = True):
        self.terms, tid = np.unique(term, return_inverse=True)
        self.owner, self.items = owner, items  # unit -> number of its item; item: id, question words, answer words
        self.span = -(-max(len(owner), 1) // BLOCK_UNITS) * BLOCK_UNITS
        order = np.lexsort((unit, tid))
        self.place = tid[order].astype(np.int64) * self.span + unit[order]  # ascending: term, then unit
        self.impact = impact[order].astype(np.float64)
        block = self.place // BLOCK_UNITS
        first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(block) else np.zeros(0, np.int64)
        # Of each posting the largest impact of its term in its block, and of each term in each range of blocks.
        self.block_max = np.repeat(np.maximum.reduceat(self.impact, first), np.diff(np.append(first, len(block)))) if len(block) else self.impact
        blocks = self.span // BLOCK_UNITS
        self.range_units = -(-blocks // min(RANGES, blocks)) * BLOCK_UNITS
        self.ranges = -(-self.span // self.range_units)
        self.range_max = np.zeros(len(self.terms) * self.ranges, np.float32)
        np.maximum.at(self.range_max, self.place // self.span * self.ranges + self.place % self.span // self.range_units, np.nextafter(self.impact.astype(np.float32), np.float32(2)))
        self.range_max = self.range_max.reshape(len(self.terms), self.ranges)
        # A table by the hash's top 16 bits narrows the search for a word.
        self.sieve = np.zeros(1 << 16, bool)
        self.sieve[(self.terms >> np.uint64(48)).astype(np.int64)] = True
        self.question = [_shingles(q) for _, q, _ in items]
        self.answer = [(_shingles(a), min(SHINGLE, max(len(a), 1))) for _, _, a in items]
        # Of items that are one text: the shingles of all of it.
        self.whole = None if parted else [(_shingles(q + a), min(SHINGLE, max(len(q) + len(a), 1))) for _, q, a in items]
        self.length = np.array([len(q) + len(a) for _, q, a in items], np.int64)
        self.scored = 0  # postings read for scores so far

    def search(self, passage: np.ndarray, tid: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, unit, score) of all scores at or above the threshold; passage ascends, each with distinct terms."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if not len(passage):
            return none
        edge = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
        stop = np.append(edge[1:], len(tid))
        found = []
        step = max(1, (1 << 20) // self.ranges)  # rows of range maxima gathered at once
        at = 0
        while at < len(edge):
            upto = max(at + 1, int(np.searchsorted(edge, edge[at] + step, "right")) - 1)
            lo, hi = edge[at], stop[upto - 1]
            bound = np.add.reduceat(self.range_max[tid[lo:hi]], edge[at:upto] - lo, axis=0)
            p, where = np.nonzero(bound >= threshold - 1e-4)  # bounds are sums of rounded-up 32-bit numbers
            # Passages of like length go together; what is missing in a row of terms is a term without postings.
            count = stop[p + at] - edge[p + at]
            for rows in np.array_split(np.argsort(count, kind="stable"), max(1, -(-int(count.sum()) // (1 << 17)))):
                if len(rows):
                    width = int(count[rows].max())
                    cell = edge[p[rows] + at][:, None] + np.arange(width)
                    t = np.where(np.arange(width) < count[rows][:, None], tid[np.minimum(cell, len(tid) - 1)], -1)
                    row, unit, score = self._wand(t, where[rows], threshold - 1e-9)
                    found.append((p[rows][row] + at, unit, score))
            at = upto
        if not found:
            return none
        p, unit, score = (np.concatenate(x) for x in zip(*found))
        return passage[edge[p]], unit, score

    def _wand(self, t: np.ndarray, where: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, unit, score) of rows of term numbers (-1: none), each within one range of units."""
        known = t >= 0
        base = t * self.span
        most = np.where(known, self.range_max[np.maximum(t, 0), where[:, None]], 0).astype(np.float64)
        end = np.minimum((where + 1) * self.range_units, self.span)
        far = self.span  # where a cursor stands that has no posting left in the range
        last = np.append(self.place, np.iinfo(np.int64).max)

        def seek(base, known, end, target):
            """First posting of each term at or after ``target``, and its unit."""
            at = np.searchsorted(self.place, np.where(known, base + target[:, None], 0))
            unit = last[at] - base
            return at, np.where(known & (unit < end[:, None]), unit, far)

        row = np.arange(len(t))
        _, unit = seek(base, known, end, where * self.range_units)
        rows, units, scores = [], [], []
        while len(row):
            order = np.argsort(unit, axis=1)
            sorted_units = np.take_along_axis(unit, order, axis=1)
            upto = np.cumsum(np.take_along_axis(most, order, axis=1), axis=1) >= threshold - 1e-6
            k = upto.argmax(axis=1)
            pivot = np.where(upto.any(axis=1), sorted_units[np.arange(len(row)), k], far)
            alive = pivot < far
            if not alive.all():
                row, base, known, most, end, unit, pivot = (x[alive] for x in (row, base, known, most, end, unit, pivot))
                if not len(row):
                    break
            behind = unit <= pivot[:, None]
            # Terms that stand before the pivot or at it, sought to the beginning of its block: the most they give there.
            block = pivot // BLOCK_UNITS
            at, here = seek(base, known & behind, end, np.maximum(block * BLOCK_UNITS, 0))
            inside = behind & (here // BLOCK_UNITS == block[:, None])
            able = np.where(inside, self.block_max[np.minimum(at, len(self.block_max) - 1)], 0).sum(axis=1) >= threshold - 1e-9
            onward = np.where(behind, far, unit).min(axis=1)
            target = np.where(able, pivot, np.minimum((block + 1) * BLOCK_UNITS, onward))
            if able.any():
                at, here = seek(base[able], (known & behind)[able], end[able], pivot[able])
                hit = here == pivot[able][:, None]
                self.scored += int(hit.sum())
                score = np.where(hit, self.impact[np.minimum(at, len(self.impact) - 1)], 0).sum(axis=1)
                good = score >= threshold
                rows.append(row[able][good])
                units.append(pivot[able][good])
                scores.append(score[good])
                target = np.where(able, pivot + 1, target)
            unit = np.where(behind, seek(base, known & behind, end, target)[1], unit)
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        return np.concatenate(rows), np.concatenate(units), np.concatenate(scores)

    def term_ids(self, words: np.ndarray) -> np.ndarray:
        """Number of each word's term, -1 for words that no unit has."""
        out = np.full(len(words), -1, np.int64)
        if len(self.terms):
            maybe = np.flatnonzero(self.sieve[(words >> np.uint64(48)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.terms, words[maybe]), len(self.terms) - 1)
            out[maybe] = np.where(self.terms[at] == words[maybe], at, -1)
        return out


def units_of(words: list[str]) -> list[list[str]]:
    """Parts of nearly equal length, none over UNIT_WORDS."""
    n = -(-len(words) // UNIT_WORDS)
    return [words[len(words) * i // n : len(words) * (i + 1) // n] for i in range(n)]


def build_indexes(items: DataFrame, index_units: int = INDEX_UNITS, id_col: str = "item_id", text_col: str = "text", answer_col: str | None = None, item_words: int = ITEM_WORDS) -> Iterator[Index]:
    """Indexes that hold all items between them, built one at a time on the driver."""
    source = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("question"), (F.col(answer_col) if answer_col else F.lit(None)).cast("string").alias("answer")).distinct()
    item_words = min(item_words, index_units * UNIT_WORDS // 8)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, q, a in zip(*(c.to_pylist() for c in b.columns)):
                question, answer = question_and_answer(q) if answer_col is None else (words_of(q or ""), words_of(a or ""))
                words, n = question + answer, len(question)
                for at in range(0, len(words), item_words):  # as a rule once
                    own = words[at : at + item_words]
                    parted = max(0, min(n - at, len(own)))
                    yield pa.RecordBatch.from_pylist([{"item_id": item, "question": own[:parted], "answer": own[parted:], "units": units_of(own), "n": len(units_of(own))}], schema=kinds)

    kinds = pa.schema([("item_id", pa.int64()), ("question", pa.list_(pa.string())), ("answer", pa.list_(pa.string())), ("units", pa.list_(pa.list_(pa.string()))), ("n", pa.int64())])
    held = materialize(source.mapInArrow(cut, "item_id long, question array<string>, answer array<string>, units array<array<string>>, n long"), "benchmark-items")
    units = held.select(F.explode("units").alias("u"))
    total, mean = units.agg(F.count("*"), F.avg(F.size("u"))).first()
    if not total:
        return
    frequency = units.select(F.explode(F.array_distinct("u")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    parts = max(1, -(-total * 5 // (index_units * 4)))
    while True:  # dealt by hash, over more indexes if one would hold too many
        dealt = materialize(held.withColumn("part", F.pmod(F.xxhash64("item_id", "question", "answer"), F.lit(parts))), "benchmark-parts")
        if dealt.groupBy("part").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] <= index_units or parts >= total:
            break
        parts = min(2 * parts, total)
    for part in range(parts):
        own = dealt.where(F.col("part") == part)
        rows = own.select("item_id", "question", "answer", "units").collect()  # at most index_units units
        if not rows:
            continue
        df = {r["term"]: r["df"] for r in own.select(F.explode(F.flatten("units")).alias("term")).distinct().join(frequency, "term").collect()}
        rows.sort(key=lambda r: (r["item_id"] is None, r["item_id"], r["question"], r["answer"]))
        unit, term, impact, owner = [], [], [], []
        for i, r in enumerate(rows):
            for u in r["units"]:
                names, tf = np.unique(np.array(u, dtype=object), return_counts=True)
                idf = np.log(1 + (total - np.array([df[x] for x in names]) + 0.5) / (np.array([df[x] for x in names]) + 0.5))
                w = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(u) / mean))
                unit += [len(owner)] * len(names)
                term.append(word_hashes(list(names)))
                impact.append(w / w.sum())
                owner.append(i)
        yield Index(np.array(unit), np.concatenate(term), np.concatenate(impact), np.array(owner), [(r["item_id"], list(r["question"]), list(r["answer"])) for r in rows], answer_col is not None)


def _slice_hits(array: pa.Array, index: Index, threshold: float, min_overlap: float) -> list[tuple[int, int, float, float, float]]:
    """(text number, item number, score, question overlap, answer overlap) of the verified items of one slice of texts."""
    buf, offs = column_bytes(array)
    starts, ends, firsts = word_bounds(buf, offs)
    if not len(starts):
        return []
    words = SpanHasher(buf)(starts, ends)
    n = len(firsts) - 1
    counts = np.diff(firsts)
    segments = -(-counts // SEGMENT_WORDS)
    first_segment = np.concatenate([[0], np.cumsum(segments)])
    tid = index.term_ids(words)
    known = np.flatnonzero(tid >= 0)
    if not len(known):
        return []
    doc = np.repeat(np.arange(n), counts)[known]
    segment = first_segment[doc] + (known - firsts[doc]) // SEGMENT_WORDS
    is_last = segment == first_segment[doc + 1] - 1
    is_first = segment == first_segment[doc]
    here, before = ~is_last | is_first, ~is_first  # passage s is segments s and s + 1; a lone segment is its own
    size = np.int64(len(index.terms))
    key = np.unique(np.concatenate([segment[here] * size + tid[known][here], (segment[before] - 1) * size + tid[known][before]]))
    passage, unit, score = index.search(key // size, key % size, threshold)
    if not len(passage):
        return []
    best: dict[tuple[int, int], list] = {}
    for p, u, s in zip(passage.tolist(), unit.tolist(), score.tolist()):
        d = int(np.searchsorted(first_segment, p, "right")) - 1
        best.setdefault((d, int(index.owner[u])), []).append((p, s))
    out = []
    for (d, item), places in best.items():
        top = None
        for p, s in places:
            length = int(index.length[item])
            begin = firsts[d] + (p - first_segment[d]) * SEGMENT_WORDS
            a, z = max(firsts[d], begin - length), min(firsts[d + 1], begin + 2 * SEGMENT_WORDS + length)
            around = words[a:z]
            question = index.question[item]
            k = min(SHINGLE, max(1, int(length - len(index.items[item][2]))))
            q = float(np.isin(question, gram_hashes(around, np.array([0, len(around)]), k)[0]).mean()) if len(question) else 1.0
            if q < min_overlap and index.whole is None:
                continue
            answer, k = index.answer[item]
            r = float(np.isin(answer, gram_hashes(around, np.array([0, len(around)]), k)[0]).mean()) if len(answer) else 1.0
            found = min(q, r) >= min_overlap
            if not found and index.whole is not None:
                whole, k = index.whole[item]
                found = len(whole) and np.isin(whole, gram_hashes(around, np.array([0, len(around)]), k)[0]).mean() >= min_overlap
            if found and (top is None or (s, q, r) > top):
                top = (s, q, r)
        if top:
            out.append((d, item, *top))
    return out


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, min_overlap: float = MIN_OVERLAP, index_units: int = INDEX_UNITS, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", answer_col: str | None = None) -> DataFrame:
    """One row for each document and test item found in it: id_col, item_id, score, question_overlap, answer_overlap."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"

    def over(index: Index) -> DataFrame:
        shipped = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"]
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
            for whole in batches:
                for b in text_slices(whole, "_text"):
                    hits = _slice_hits(b.column(1), shipped.value, threshold, min_overlap)
                    if hits:
                        ids = b.column(0).to_pylist()
                        rows = [(ids[d], shipped.value.items[i][0], s, q, a) for d, i, s, q, a in hits]
                        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)], names)

        return source.mapInArrow(run, schema)

    found = None
    for index in build_indexes(items, index_units, item_id_col, item_text_col, answer_col):
        hits = over(index)
        found = hits if found is None else found.union(hits)
    if found is None:
        found = spark.createDataFrame([], schema)
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("score", "question_overlap", "answer_overlap")).alias("m"))
    return best.select(F.col("doc_id").alias(id_col), "item_id", "m.*")


def drop_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, min_overlap: float = MIN_OVERLAP, index_units: int = INDEX_UNITS, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", answer_col: str | None = None) -> DataFrame:
    """The rows of ``docs`` in whose text no test item is found, by one pass for each index and without a shuffle."""
    kept = docs

    def without(rows: DataFrame, index: Index) -> DataFrame:
        shipped = rows.sparkSession.sparkContext.broadcast(index)
        at = rows.columns.index(text_col)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for b in text_slices(whole, text_col):
                    clean = np.ones(b.num_rows, bool)
                    clean[[h[0] for h in _slice_hits(b.column(at), shipped.value, threshold, min_overlap)]] = False
                    yield b.filter(pa.array(clean))

        return rows.mapInArrow(run, rows.schema)

    for index in build_indexes(items, index_units, item_id_col, item_text_col, answer_col):
        kept = without(kept, index)
    return kept


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
