"""Toxicity grades by cumulative-link ordinal regression over sparse text features.

Features of a text are its words (A-Z lower-cased) and the beginnings of 4 to 7 bytes of its
longer words, hashed to 64 bits, so a stem tells as much as a word. A feature's value is its
share of the text's words, 1 from a share of ``1 / FULL_SHARE`` on; texts of fewer than
``LEAST_WORDS`` words count as that long. So one chance hit in a long text weighs little.
Grades: 0 for rows labelled clean; rows labelled toxic get 1, 2 or 3 by the tercile of their
evidence (the summed log odds of the features that speak for toxicity). One weight vector is
shared by the thresholds between grades: P(grade > k) = sigmoid(w.x - cut_k) with ascending
cuts; severity is the expected grade.

The model is fitted on a bounded sample of labelled rows: for either label, the
``MAX_LABELLED`` rows of smallest hashed id. All rows are scored over whole texts. Null and
empty texts have no features and severity near zero. Labels that are null, or without a
document, are left out; an id with several labels counts as toxic if one says so, and of several
documents with one id the smallest text is learned from. Repeated rows are scored each for
itself and alike; columns beyond those named play no part, or stay as they are in ``keep_clean``.
With no example of one label there is no model, severity is 0 and nothing is toxic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm.session import materialize, table
from quirework.llm.textvec import SpanHasher, column_bytes, text_slices, word_bounds

MAX_LABELLED = 3000
MAX_FEATURES = 2048
MIN_Z = 5.0
GRADES = 4
PREFIXES = (4, 5, 6, 7)
FULL_SHARE, LEAST_WORDS = 50, 100
#: A text is toxic from this probability of a grade above 0 on.
TOXIC_FROM = 0.5
_WHOLE = np.uint64(0xA0761D6478BD642F)


def _features(buf: np.ndarray, offs: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, feature and value, sorted and distinct; with ``wanted`` (sorted), features among them, by position."""
    starts, ends, firsts = word_bounds(buf, offs)
    n = len(offs) - 1
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.float32)
    doc = np.repeat(np.arange(n), np.diff(firsts))
    spans = SpanHasher(buf)
    sieve = None
    if wanted is not None:
        sieve = np.zeros(1 << 16, bool)
        sieve[(wanted >> np.uint64(48)).astype(np.int64)] = True
    docs, feats = [], []
    for size in (None, *PREFIXES):
        if size is None:
            d, h = doc, spans(starts, ends) ^ _WHOLE
        else:
            long = ends - starts > size
            d, h = doc[long], spans(starts[long], starts[long] + size)
        if sieve is not None:
            ok = sieve[(h >> np.uint64(48)).astype(np.int64)]
            d, h = d[ok], h[ok]
            at = np.minimum(np.searchsorted(wanted, h), max(len(wanted) - 1, 0))
            ok = wanted[at] == h if len(wanted) else np.zeros(len(h), bool)
            d, h = d[ok], at[ok].astype(np.uint64)
        docs.append(d)
        feats.append(h)
    d, h = np.concatenate(docs), np.concatenate(feats)
    if not len(d):
        return d, h, np.zeros(0, np.float32)
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    new = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (h[1:] != h[:-1])]))
    times, d, h = np.diff(np.append(new, len(d))), d[new], h[new]
    length = np.maximum(np.diff(firsts), LEAST_WORDS)
    return d, h, np.minimum(1, FULL_SHARE * times / length[d]).astype(np.float32)


class Grader:
    """Sorted features, their shared weights, and the ascending cuts between grades."""

    def __init__(self, features: np.ndarray, weights: np.ndarray, cuts: np.ndarray):
        self.features, self.weights, self.cuts = features, weights, cuts

    def exceed(self, array: pa.Array) -> np.ndarray:
        """P(grade > k) for each text (rows) and k = 0, 1, 2."""
        if not len(self.cuts):
            return np.zeros((len(array), GRADES - 1))
        buf, offs = column_bytes(array)
        doc, at, value = _features(buf, offs, self.features)
        score = np.bincount(doc, self.weights[at.astype(np.int64)] * value, minlength=len(array))
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.cuts[None, :], -50, 50)))


def fit_grader(rows: np.ndarray, feats: np.ndarray, values: np.ndarray, toxic: np.ndarray, rounds: int = 400, rate: float = 0.05, ridge: float = 2e-4) -> Grader:
    """Fit from row numbers, features and their values, and the rows' labels (True: toxic)."""
    n1, n0 = int(toxic.sum()), int((~toxic).sum())
    if not n1 or not n0:
        return Grader(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0))
    names, column = np.unique(feats, return_inverse=True)
    in1 = np.bincount(column[toxic[rows]], minlength=len(names))
    in0 = np.bincount(column[~toxic[rows]], minlength=len(names))
    p = (in1 + in0) / (n1 + n0)
    z = (in1 / n1 - in0 / n0) / np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / n1 + 1 / n0))
    strength = np.where(in1 + in0 >= 3, np.abs(z), 0)
    chosen = np.sort(np.argsort(-strength, kind="stable")[:MAX_FEATURES])
    chosen = chosen[strength[chosen] >= min(MIN_Z, strength.max())]
    place = np.full(len(names), -1)
    place[chosen] = np.arange(len(chosen))
    use = place[column] >= 0
    x = np.zeros((len(toxic), len(chosen)), np.float32)
    x[rows[use], place[column[use]]] = values[use]
    odds = np.log((in1[chosen] + 0.5) / (n1 + 1)) - np.log((in0[chosen] + 0.5) / (n0 + 1))
    evidence = x @ np.maximum(odds, 0)
    terciles = np.quantile(evidence[toxic], [1 / 3, 2 / 3])
    grade = np.where(toxic, 1 + np.searchsorted(terciles, evidence, "left"), 0)
    # Half the weight to either label, so that the sample's mix plays no part.
    share = np.where(toxic, 0.5 / n1, 0.5 / n0)
    # Cuts are the first one and positive steps (logarithms), so they ascend.
    w, free = np.zeros(len(chosen)), np.array([2.0, 0.0, 0.0])
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(free), np.zeros_like(free)]
    for step in range(1, rounds + 1):
        _, g_w, g_free = objective(x, grade, share, w, free, ridge)
        for value, g, m, v in ((w, g_w, moments[0], moments[1]), (free, g_free, moments[2], moments[3])):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Grader(names[chosen], w, ascending(free))


def ascending(free: np.ndarray) -> np.ndarray:
    """Cuts from the first one and the logarithms of the steps between them."""
    return free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])


def objective(x: np.ndarray, grade: np.ndarray, share: np.ndarray, w: np.ndarray, free: np.ndarray, ridge: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Weighted negative log likelihood of the grades with a ridge on the weights, and its gradients by ``w`` and ``free``."""
    q = 1 / (1 + np.exp(-np.clip((x @ w)[:, None] - ascending(free), -30, 30)))  # P(grade > k)
    full = np.concatenate([np.ones((len(q), 1)), q, np.zeros((len(q), 1))], axis=1)
    i = np.arange(len(q))
    mass = np.maximum(full[i, grade] - full[i, grade + 1], 1e-9)
    slope = full * (1 - full)
    d_eta = share * (slope[i, grade] - slope[i, grade + 1]) / mass
    d_cut = np.zeros(GRADES - 1)
    for k in range(GRADES - 1):
        d_cut[k] = (share * (np.where(grade == k + 1, -1.0, 0.0) + np.where(grade == k, 1.0, 0.0)) * slope[:, k + 1] / mass).sum()
    g_w = -(x.T @ d_eta.astype(x.dtype)) + ridge * w
    g_free = -np.concatenate([[d_cut.sum()], np.exp(free[1:]) * np.cumsum(d_cut[::-1])[::-1][1:]])
    return float(-(share * np.log(mass)).sum() + ridge / 2 * (w @ w)), g_w, g_free


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Grader:
    """Fit on the documents of at most ``max_labelled`` labels of either kind."""
    known = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).alias("_toxic")).where("_id IS NOT NULL AND _toxic IS NOT NULL").groupBy("_id").agg((F.max("_toxic") > 0).alias("_toxic"))
    order = F.xxhash64("_id")
    picked = known.where("_toxic").orderBy(order, "_id").limit(max_labelled).union(known.where("NOT _toxic").orderBy(order, "_id").limit(max_labelled))
    # At most 2 * max_labelled rows of two columns.
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(picked), "_id")
    sample = texts.groupBy("_id").agg(F.first("_toxic").alias("_toxic"), F.min("_text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, "_text"):
                doc, h, value = _features(*column_bytes(b.column(2)))
                cuts = pa.array(np.searchsorted(doc, np.arange(b.num_rows + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (h.view(np.int64), value)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *lists], ["id", "toxic", "features", "vals"])

    held = materialize(sample.mapInArrow(run, "id long, toxic boolean, features array<long>, vals array<float>"), "labelled-features")
    wanted = np.sort(np.array([r["f"] for r in _strongest(held).collect()], np.int64).view(np.uint64))  # at most MAX_FEATURES

    def only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(2)
            flat, value = np.asarray(lists.flatten()), np.asarray(b.column(3).flatten())
            ok = np.isin(flat.view(np.uint64), wanted)
            cuts = pa.array(np.concatenate([[0], np.cumsum(ok)])[np.asarray(lists.offsets) - lists.offsets[0].as_py()].astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.ListArray.from_arrays(cuts, pa.array(x[ok])) for x in (flat, value)]], ["id", "toxic", "features", "vals"])

    got = held.mapInArrow(only, held.schema).toArrow().combine_chunks().sort_by("id")
    if not got.num_rows:
        return Grader(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0))
    lists, values = got.column("features").combine_chunks(), got.column("vals").combine_chunks()
    sizes = np.diff(np.asarray(lists.offsets))
    return fit_grader(np.repeat(np.arange(len(sizes)), sizes), np.asarray(lists.flatten()).view(np.uint64), np.asarray(values.flatten()), np.asarray(got.column("toxic").combine_chunks().to_numpy(zero_copy_only=False), dtype=bool))


def _strongest(held: DataFrame) -> DataFrame:
    """The MAX_FEATURES features (f) that tell most between the labels, counted where the sample lies."""
    n1, n0 = held.agg(F.count(F.when(F.col("toxic"), 1)), F.count(F.when(~F.col("toxic"), 1))).first()
    counts = held.select("toxic", F.explode("features").alias("f")).groupBy("f").agg(F.count(F.when(F.col("toxic"), 1)).alias("in1"), F.count("*").alias("n"))
    share = F.col("n") / max(n1 + n0, 1)
    z = (F.col("in1") / max(n1, 1) - (F.col("n") - F.col("in1")) / max(n0, 1)) / F.sqrt(F.greatest(share * (1 - share), F.lit(1e-9)) * (1 / max(n1, 1) + 1 / max(n0, 1)))
    strength = F.when(F.col("n") >= 3, F.abs(z)).otherwise(F.lit(0.0))
    # Ties by the unsigned value, as the fit itself would.
    return counts.orderBy(strength.desc(), F.col("f").bitwiseXOR(F.lit(-(1 << 63)))).select("f").limit(MAX_FEATURES)


def grade(df: DataFrame, grader: Grader, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), toxic_from: float = TOXIC_FROM) -> DataFrame:
    """The columns ``keep``, severity (expected grade, 0 to 3), p_toxic and toxic of every row."""
    extra = text_col not in keep
    source = df.select(*keep, *([text_col] if extra else []))
    shipped = df.sparkSession.sparkContext.broadcast(grader)  # at most MAX_FEATURES weights
    schema = df.select(*keep).schema.add("severity", "double").add("p_toxic", "double").add("toxic", "boolean")
    names = [*keep, "severity", "p_toxic", "toxic"]
    at = keep.index(text_col) if not extra else len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        for whole in batches:
            for b in text_slices(whole, text_col):
                q = model.exceed(b.column(at))
                yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(q.sum(axis=1)), pa.array(q[:, 0]), pa.array(q[:, 0] >= toxic_from)], names)

    return source.mapInArrow(run, schema)


def keep_clean(df: DataFrame, grader: Grader, text_col: str = "text", toxic_from: float = TOXIC_FROM) -> DataFrame:
    """The rows of ``df`` that are not toxic, all columns as they are."""
    shipped = df.sparkSession.sparkContext.broadcast(grader)
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, text_col):
                yield b.filter(pa.array(shipped.value.exceed(b.column(at))[:, 0] < toxic_from))

    return df.mapInArrow(run, df.schema)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return grade(docs, train(docs, table(spark, sf_dir, "labels")))
