"""The pipeline's near-duplicate stage on edited copies."""

import itertools

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from quirework.llm import near_copies


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def test_edited_copies_go(spark, tmp_path):
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(3000)]
    texts = []
    for k in range(40):
        one = list(rng.choice(words, 150))
        texts.append(" ".join(one))
        for edits in (1, 2, 3, 6):
            other = list(one)
            for at in range(10, 10 + 20 * edits, 20):
                other[at] = f"edit{k}-{edits}-{at}"
            texts.append(" ".join(other))
    texts += [None, "", " \n", "one two", "One  two", "one three"]
    sets = [shingles(t) for t in texts]
    near = lambda a, b: a == b or len(a & b) >= 0.8 * len(a | b)
    root = list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        if near(sets[i], sets[j]) and root[i] != root[j]:
            lo, hi = sorted((root[i], root[j]))
            root = [lo if r == hi else r for r in root]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({c: F.lit(1) for c in ("row", "cls", "size", "id", "sketch")})
    kept = corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(root))


def test_null_and_repeated_ids(spark, tmp_path):
    docs = spark.createDataFrame([(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (None, "other words here now"), (None, None), (None, "")], "doc_id long, text string")
    kept = corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path)).collect()
    assert len(kept) == 3 and sum(r.doc_id == 5 for r in kept) == 1
    assert corpus_pipeline.drop_near_copies(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_a_large_group_in_blocks(spark):
    """Copies edited so much that many of them link only by way of others; parts of buckets, dense ones too."""
    rng = np.random.default_rng(4)
    words, base = [f"w{i}" for i in range(3000)], None
    base = list(rng.choice(words, 150))
    texts = []
    for k in range(150):
        other = list(base)
        for at in rng.choice(150, rng.integers(0, 7), replace=False):
            other[at] = f"edit{k}-{at}"
        texts.append(" ".join(other))
    texts += [" ".join(base[:60] + list(rng.choice(words, 90))) for _ in range(40)]
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and root[i] != root[j]:
            lo, hi = sorted((root[i], root[j]))
            root = [lo if r == hi else r for r in root]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for block_rows in (2000, 25):
        kept = near_copies.one_of_each(docs, block_rows=block_rows)
        assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root)), block_rows


def test_linked_sets():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 60, 120).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(120) < 0.93], rng.integers(0, 1 << 60, int(rng.integers(0, 12))).astype(np.uint64)])) for _ in range(80)]
    got = near_copies.linked_sets(sets, 0.8, cells=2000)
    joined = np.arange(80)
    for i, j in itertools.combinations(range(80), 2):
        both = len(np.intersect1d(sets[i], sets[j]))
        if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
            a, b = sorted((joined[i], joined[j]))
            joined[joined == b] = a
    assert (got == joined).all() and len(set(joined)) > 1
